"""Writing reports, the failure log and the label archive."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

def write_report(df: DataFrame, root: str, name: str, run_id: str, fmt: str = "parquet") -> str:
    """One table per report, partitioned by run; re-running a run replaces its part."""
    path = f"{root}/{name}"
    out = df if "run_id" in df.columns else df.withColumn("run_id", F.lit(run_id))
    writer = out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id")
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)
    return path


def append_failures(events: DataFrame, root: str, run_id: str) -> str:
    """Add events to the failure log. A whole run goes through ``write_report``, so that
    a repeated run replaces its own part."""
    path = f"{root}/failed_rows"
    events.withColumn("run_id", F.lit(run_id)).write.mode("append").partitionBy("run_id").parquet(path)
    return path


def request_archive(cands: DataFrame, site: str = "pathful_url", page: str = "page_url") -> DataFrame:
    """Candidates as JSON text, one row per page of a site (a page bounds the text)."""
    fields = ["number", "snippet", "source_url", "company"]
    rows = F.array_sort(F.collect_list(F.struct("match_ord", *fields)))
    return cands.groupBy(site, page).agg(
        F.count(F.lit(1)).alias("n_items"),
        F.to_json(F.transform(rows, lambda s: F.struct(*[s[f].alias(f) for f in fields]))).alias("body"))


# Fixed value: what parts the chunks of an archived answer.
SEPARATOR = "\n\n---CHUNK_SEPARATOR---\n\n"


def response_archive(responses: DataFrame, site: str = "pathful_url") -> DataFrame:
    """Raw first answers of a site in chunk order; a site has a fixed number of chunks."""
    first = responses.filter(F.col("attempt") == 0)
    parts = F.array_sort(F.collect_list(F.struct("chunk", F.coalesce("raw_text", F.lit("")).alias("t"))))
    return first.groupBy(site).agg(
        F.array_join(F.transform(parts, lambda s: s["t"]), SEPARATOR).alias("raw_output"))
