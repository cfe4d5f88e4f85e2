"""Building blocks that keep hot groups spread over many tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def hashed(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` with ``_h``, a hash of the keys, to stand before them in grouping or join keys.

    Rows are sorted by the first eight bytes of the first key and compared in full where these
    agree. URLs and numbers all begin alike; their hash tells them apart at once. The keys
    themselves stay among the grouping keys, so equal hashes of different keys do no harm."""
    return df.withColumn("_h", F.xxhash64(*keys))


def gathered(df: DataFrame, *keys: str) -> DataFrame:
    """``hashed`` rows, brought together before they are grouped by ``_h`` and the keys.

    An aggregate of structs or texts sorts its rows. Where most groups hold a row or two, sorting
    before the shuffle as well takes as long again and takes hardly a row out; and the tasks that
    read a table are few and large, those behind the shuffle are as many as its bytes need."""
    return hashed(df, *keys).repartition("_h")


def ranked(df: DataFrame, keys: list[str], coarse: list[str], fine: list[Column], name: str) -> DataFrame:
    """Exact ``row_number`` per ``keys`` ordered by ``coarse`` then ``fine``.

    Only a (keys, coarse) slice is ever sorted in one task; the slices' start
    positions come from their counts. A key with a third of all rows is spread
    over as many tasks as it has coarse values."""
    slices = df.groupBy(*keys, *coarse).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy(*coarse).rowsBetween(
        Window.unboundedPreceding, -1)
    starts = slices.withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    within = Window.partitionBy(*keys, *coarse).orderBy(*fine)
    on = [F.col(f"l.{c}").eqNullSafe(F.col(f"s.{c}")) for c in keys + coarse]
    cond = on[0]
    for c in on[1:]:
        cond = cond & c
    numbered = df.withColumn("_pos", F.row_number().over(within))
    return (numbered.alias("l").join(starts.alias("s"), cond)
            .select(*[F.col(f"l.{c}") for c in df.columns],
                    (F.col("s._start") + F.col("l._pos")).alias(name)))
