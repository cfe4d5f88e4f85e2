"""The visited set, the failure log and the contact report kept up to date on streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from callsheet.operators.outcomes import failure_group


def first_visits(stream: DataFrame, url: str, ts: str, delay: str = "1 hour") -> DataFrame:
    """Arriving URLs, each once within the delay; the state is bounded by it."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark([url])


def failures_per_hour(events: DataFrame, ts: str = "log_timestamp", delay: str = "1 hour",
                      width: str = "1 hour") -> DataFrame:
    """Failure count per group and stage in tumbling windows."""
    return (events.withWatermark(ts, delay)
            .groupBy(F.window(ts, width).alias("w"), failure_group(F.col("stage_of_failure")).alias("failure_group"),
                     F.col("stage_of_failure").alias("stage"))
            .agg(F.count(F.lit(1)).alias("n"))
            .select(F.col("w.start").alias("window_start"), "failure_group", "stage", "n"))


def write_updates(windows: DataFrame, path: str, checkpoint: str):
    """Write the windows that a batch changed, open ones too, under the batch's number; a
    repeated batch replaces itself."""
    def step(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return (windows.writeStream.outputMode("update").foreachBatch(step).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def latest_updates(written: DataFrame, keys: list[str], value: str = "n") -> DataFrame:
    """Last state of every window in the table of ``write_updates``."""
    return written.groupBy(*keys).agg(F.max_by(value, "batch").alias(value))


def refresh_by_base(stream: DataFrame, store: str, rebuild, checkpoint: str):
    """Append each batch of items by base bucket and rebuild the touched bases.

    ``rebuild(items) -> DataFrame`` is the batch report. Buckets are directories, so
    a batch reads only those of its bases; results replace the bucket's report."""
    bucket = F.pmod(F.xxhash64("base"), F.lit(256)).cast("int")

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = batch.withColumn("bucket", bucket).withColumn("batch_id", F.lit(batch_id))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            "batch_id", "bucket").parquet(f"{store}/items")
        touched = spark.read.parquet(f"{store}/items").filter(F.col("batch_id") == batch_id).select(
            "bucket").distinct()
        items = spark.read.parquet(f"{store}/items").join(F.broadcast(touched), "bucket", "left_semi")
        report = rebuild(items.drop("batch_id")).withColumn("bucket", bucket)
        report.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            "bucket").parquet(f"{store}/report")

    return (stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
