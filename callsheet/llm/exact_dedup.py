"""Exact duplicates by a 128-bit content hash, with the bytes compared inside a hash group.

Rows are grouped by (hash, text): the hash places a row, the text decides, so two
texts with one hash never meet. Copies are merged on the map side before the shuffle,
which therefore carries at most one text per task and group however large the group is."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from callsheet.functions.stages import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normalised(text: Column) -> Column:
    """A-Z lower-cased, nothing else changed; null is empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def exact_dedup(docs: DataFrame, row: Column | None = None, hash_of: Callable[[Column], Column] = F.md5) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, keep_id, group_size, kept, text_sha256``.

    ``row`` adds a column of that name, e.g. a struct of what should be carried along.
    ``docs`` has ``doc_id`` and ``text``; other columns are not read. The largest id of
    equal texts stays (null ids lose; if all are null, each is kept and ``keep_id`` is
    null). A null text equals an empty one. Rows repeated with one id count in
    ``group_size`` and share ``kept``. An empty table gives an empty result.
    ``hash_of`` may be any hash: a collision only costs a second look at the texts."""
    text = normalised(F.col("text"))
    groups = stored(
        docs.select("doc_id", text.alias("norm")).withColumn("h", hash_of(F.col("norm")))
        .groupBy("h", "norm").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .select("h", "keep_id", "group_size", F.sha2("norm", 256).alias("text_sha256"),
                F.length("norm").alias("n")), "exact_groups")
    shared = groups.groupBy("h").agg(F.count(F.lit(1)).alias("texts")).filter("texts > 1").select("h")
    rows = docs.select("doc_id", hash_of(text).alias("h"), text.alias("norm"), *([row.alias("row")] if row is not None else []))
    extra = ["row"] if row is not None else []
    out = ["doc_id", "keep_id", "group_size", F.expr("doc_id <=> keep_id").alias("kept"), "text_sha256", *extra]
    if shared.isEmpty():
        return rows.join(groups, "h").select(*out)
    # Two texts with one hash: there the join also compares what the texts are.
    alone = rows.join(groups.join(shared, "h", "left_anti"), "h").select(*out)
    again = (rows.join(shared, "h", "left_semi").groupBy("h", "norm")
             .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
             .withColumn("text_sha256", F.sha2("norm", 256)))
    met = rows.join(again, ["h", "norm"]).select(*out)
    return alone.unionByName(met)
