"""Text lists of any length, in pages by exact position.

All values are range-partitioned by key and order, which spreads a long list over as many
tasks as it needs (the ranges come from a sample of the values). A key's share of a range is
a slice; slice sizes give each slice the position of its first value, and a value's page is
its position divided by the page size. No key is gathered as a whole."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from callsheet.functions.stages import stored
from callsheet.operators.skew import hashed

PAGE = 10_000


def _slice_starts(held: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, _slice, _n, n_values, _first``: sizes of slices and keys, and the position of a
    slice's first row."""
    by_key = Window.partitionBy(*keys)
    return held.groupBy(*keys, "_slice").agg(F.count(F.lit(1)).alias("_n")).select(
        *keys, "_slice", "_n", F.sum("_n").over(by_key).alias("n_values"),
        F.coalesce(F.sum("_n").over(by_key.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_first"))


def _same(keys: list[str]) -> Column:
    on = F.lit(True)
    for c in [*keys, "_slice"]:
        on = on & F.col(f"l.{c}").eqNullSafe(F.col(f"s.{c}"))
    return on


def positions(rows: DataFrame, keys: list[str], order: list, name: str = "position") -> DataFrame:
    """``rows`` with their 0-based place per key in ``order``; rows of one place in the order
    take any. A key's rows are sorted range by range, never as a whole in one task."""
    held = stored(rows.repartitionByRange(*keys, *order).withColumn("_slice", F.spark_partition_id()), "ranges")
    in_slice = Window.partitionBy(*keys, "_slice").orderBy(*order)
    numbered = held.withColumn("_at", F.row_number().over(in_slice) - 1).alias("l")
    return numbered.join(_slice_starts(held, keys).alias("s"), _same(keys)).select(
        *[F.col(f"l.`{c}`") for c in rows.columns], (F.col("s._first") + F.col("l._at")).alias(name))


def paged(lists: DataFrame, keys: list[str], sep: str | Column = ", ", page: int = PAGE) -> DataFrame:
    """``keys, part, n_values, cell`` of a table ``keys, value`` with or without ``ord``.

    Values stand in the order of ``ord`` (null first), then of themselves; part ``p`` holds
    the values from ``p * page`` on, joined by ``sep`` (which may depend on the keys).
    Rows are one per key and value; null values are the caller's to leave out."""
    order = [F.col("ord").alias("o")] if "ord" in lists.columns else []
    rows = lists.select(*keys, F.struct(*order, F.col("value").alias("v")).alias("_item"))
    held = stored(rows.repartitionByRange(*keys, "_item").withColumn("_slice", F.spark_partition_id()), "list_slices")
    same = [*keys, "_slice"]
    slices = hashed(held, *same).groupBy("_h", *same).agg(F.array_sort(F.collect_list("_item")).alias("_items")).alias("l")
    met = slices.join(_slice_starts(held, keys).alias("s"), _same(keys)).select(*[F.col(f"l.{c}") for c in same], "n_values", "_first", "_n", "_items")

    def cut(p: Column) -> Column:
        begin = F.greatest(p * page - F.col("_first"), F.lit(0))
        piece = F.slice("_items", (begin + 1).cast("int"), ((p + 1) * page - F.col("_first") - begin).cast("int"))
        text = F.call_function("array_join", F.transform(piece, lambda x: x["v"]), F.lit(sep) if isinstance(sep, str) else sep)
        return F.struct(p.alias("part"), text.alias("text"))

    last = F.floor((F.col("_first") + F.col("_n") - 1) / page)
    pieces = met.select(*same, "n_values", F.inline(F.transform(F.sequence(F.floor(F.col("_first") / page), last), cut)))
    whole = F.transform(F.array_sort(F.collect_list(F.struct("_slice", "text"))), lambda x: x["text"])
    return pieces.groupBy(*keys, "part").agg(
        F.first("n_values").alias("n_values"), F.call_function("array_join", whole, F.lit(sep) if isinstance(sep, str) else F.first(sep)).alias("cell"))


def side_by_side(cells: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """Pages of several lists as columns: ``keys, part`` and one column per list name in
    ``column``; a list that has no such page is null there."""
    return cells.groupBy(*keys, "part").agg(*[F.max(F.when(F.col("column") == n, F.col("cell"))).alias(n) for n in names])


def with_pages(rows: DataFrame, pages: DataFrame, on: list[str]) -> DataFrame:
    """Rows once per page; rows without any list have part 0 alone."""
    return rows.join(pages, on, "left").withColumn("part", F.coalesce("part", F.lit(0)))
