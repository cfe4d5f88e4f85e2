"""Follow-up analysis of reports: counts, joins, top groups, profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def value_counts(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def group_value_counts(df: DataFrame, group: str, col: str) -> DataFrame:
    return df.filter(F.col(group).isNotNull() & F.col(col).isNotNull()).groupBy(group, col).agg(
        F.count(F.lit(1)).alias("n"))


def top_with_rest(counts: DataFrame, col: str, k: int = 15) -> DataFrame:
    """The ``k`` most frequent values and one row for how many others there are."""
    top = counts.orderBy(F.col("n").desc(), col).limit(k)
    total = counts.agg(F.count(F.lit(1)).alias("values"), F.sum("n").alias("rows"))
    head = top.agg(F.count(F.lit(1)).alias("v"), F.coalesce(F.sum("n"), F.lit(0)).alias("r"))
    rest = (total.withColumn("_k", F.lit(1)).join(head.withColumn("_k", F.lit(1)), "_k")
            .filter(F.col("values") > F.col("v"))
            .select(F.concat(F.lit("plus "), (F.col("values") - F.col("v")).cast("string"),
                             F.lit(" other reasons")).alias(col),
                    (F.col("rows") - F.col("r")).alias("n")))
    return top.unionByName(rest)


def largest(counts: DataFrame, by: list[str], k: int) -> DataFrame:
    return counts.orderBy(F.col("n").desc(), *by).limit(k)


def preview(df: DataFrame, ordinal: str, first: int, n: int) -> DataFrame:
    """A slice of rows by ordinal."""
    return df.filter((F.col(ordinal) >= first) & (F.col(ordinal) < first + n))


def profile(df: DataFrame, numeric: list[str], text: list[str]) -> DataFrame:
    """count, nulls, distinct, most frequent value (the smallest of several) and its count,
    min, max, mean, deviation per column, one row each. Values are counted first, as
    text, so no task holds all values of a column."""
    cells = []
    for c in numeric + text:
        num = c in numeric
        val = F.col(c).cast("double")
        none = F.lit(None).cast("double")
        cells.append(F.struct(
            F.lit(c).alias("column"), F.count(c).alias("filled"),
            F.count_if(F.col(c).isNull()).alias("nulls"),
            (F.min(val) if num else none).alias("min"), (F.max(val) if num else none).alias("max"),
            (F.avg(val) if num else none).alias("mean"),
            (F.stddev_samp(val) if num else none).alias("std")))
    stats = df.agg(F.array(*cells).alias("s")).select(F.inline("s"))
    values = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in numeric + text])
    counts = (df.select(F.inline(values)).filter(F.col("value").isNotNull())
              .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")))
    found = counts.groupBy("column").agg(
        F.count(F.lit(1)).alias("distinct"), F.min(F.struct((-F.col("n")).alias("n"), "value")).alias("t")).select(
        "column", "distinct", F.col("t.value").alias("top"), (-F.col("t.n")).alias("top_n"))
    return stats.join(found, "column", "left").withColumn("distinct", F.coalesce("distinct", F.lit(0)))


def profile_sketch(df: DataFrame, numeric: list[str], text: list[str], error: float = 0.02, tracked: int = 10_000) -> DataFrame:
    """The columns of ``profile`` in one pass of mergeable sketches: no value is shuffled.

    ``distinct`` has a relative standard deviation of ``error``. ``top`` and ``top_n`` are exact
    as long as a column has at most three quarters of ``tracked`` values; with more, a count
    is low by at most the rows divided by that number, and of equally frequent values any
    one is named."""
    cells = []
    for c in numeric + text:
        num, val, none = c in numeric, F.col(c).cast("double"), F.lit(None).cast("double")
        top = F.try_element_at(F.call_function("approx_top_k", F.col(c).cast("string"), F.lit(1), F.lit(tracked)), F.lit(1))
        cells.append(F.struct(
            F.lit(c).alias("column"), F.count(c).alias("filled"), F.count_if(F.col(c).isNull()).alias("nulls"),
            (F.min(val) if num else none).alias("min"), (F.max(val) if num else none).alias("max"),
            (F.avg(val) if num else none).alias("mean"), (F.stddev_samp(val) if num else none).alias("std"),
            F.approx_count_distinct(c, error).alias("distinct"), top["item"].alias("top"), top["count"].alias("top_n")))
    return df.agg(F.array(*cells).alias("s")).select(F.inline("s"))


def join_on_adjusted_id(attrition: DataFrame, rows: DataFrame, shift: int) -> DataFrame:
    """Attrition beside its input row, where the exported id is off by a constant."""
    left = attrition.withColumn("id_adj", F.col("InputRowID") - shift)
    right = rows.select(F.col("input_row_id").alias("id_adj"),
                        F.col("company_name").alias("CompanyName_input"),
                        F.col("characteristic"))
    return left.join(right, "id_adj", "left")
