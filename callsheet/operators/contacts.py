"""Consolidation of labelled numbers per base domain and their ranking.

Two flat tables carry everything: ``sources`` (base, number, url, type) and
``numbers`` (base, number). Lists are only built for report cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from callsheet import dims
from callsheet.operators.paging import paged, side_by_side
from callsheet.operators.skew import gathered, hashed, ranked


def _lookup(c: Column, table: dict, other: int) -> Column:
    m = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    return F.coalesce(F.try_element_at(m, c), F.lit(other))


#: Type priorities that another type can be behind, best first.
BETTER_TYPES = sorted({*dims.TYPE_PRIORITY.values(), dims.OTHER_TYPE})[:-1]


def class_priority(c: Column) -> Column:
    return _lookup(c, dims.CLASSIFICATION_PRIORITY, dims.OTHER_CLASSIFICATION)


def type_priority(c: Column) -> Column:
    return _lookup(c, dims.TYPE_PRIORITY, dims.OTHER_TYPE)


def usable_items(items: DataFrame, count_error_items: bool = False) -> DataFrame:
    """Items with a number and a source URL; failed labels are left out unless asked for."""
    out = items.filter((F.coalesce("number", F.lit("")) != "")
                       & (F.coalesce("source_url", F.lit("")) != ""))
    return out if count_error_items else out.filter(
        ~F.coalesce(F.col("type").startswith("Error_"), F.lit(False)))


def malformed_counts(items: DataFrame, *by: str) -> DataFrame:
    bad = (F.coalesce("number", F.lit("")) == "") | (F.coalesce("source_url", F.lit("")) == "")
    return items.groupBy(*by).agg(F.count_if(bad).alias("skipped"), F.count_if(~bad).alias("usable"))


def source_facts(items: DataFrame, by_number: bool = False) -> DataFrame:
    """One row per (base, number, source URL, type): the first item's company, and
    what the classification of the number needs. The only shuffle of all items;
    ``sources`` and ``numbers`` both start from it.

    ``by_number`` brings all items of a number together and keeps ``_h``, by which they lie:
    ``numbers`` of such facts, not stored in between, need no shuffle of their own."""
    keys = ["base", "number", "source_url", "type"]
    t = gathered(items.withColumn("cp", class_priority(F.col("classification"))), *(keys[:2] if by_number else keys))
    facts = t.groupBy("_h", *keys).agg(
        F.min(F.struct("cp", "ord", "classification")).alias("best"),
        F.max(F.struct("ord", "classification")).alias("last"),
        F.min(F.struct("ord", "company")).alias("first"),
        F.count(F.lit(1)).alias("n"))
    return facts if by_number else facts.drop("_h")


def sources(facts: DataFrame) -> DataFrame:
    """One row per (base, number, source URL, type); the first item wins."""
    return facts.select("base", "number", "source_url", "type", F.col("first.ord").alias("ord"),
                        F.col("first.company").alias("company"))


def numbers(facts: DataFrame) -> DataFrame:
    """One row per (base, number): best classification, type of the first source,
    eligibility facts and first position.

    Listed classes: the smallest priority wins. When only unlisted classes occur,
    the first stays unless a later item has a better type than the first source;
    then the last such item wins. Keeping one candidate per type priority (20 at
    most) settles that without gathering a number's items, and in columns of their own
    they need no grouping by type before: one shuffle of the facts, none where these lie by number."""
    unlisted = F.col("best.cp") >= dims.OTHER_CLASSIFICATION
    typed = facts.withColumn("tp", type_priority(F.col("type")))
    t = typed if "_h" in facts.columns else gathered(typed, "base", "number")
    grouped = t.groupBy("_h", "base", "number").agg(
        F.min("best").alias("best"),
        F.min(F.struct(F.col("first.ord").alias("ord"), "tp", "type")).alias("first"),
        F.max(F.col("type").isin(dims.EXCLUDED_CONTACT_TYPES)).alias("excluded"),
        F.sum("n").alias("n_items"),
        *[F.max(F.when(unlisted & (F.col("tp") == p), F.col("last"))).alias(f"_last_{p}") for p in BETTER_TYPES])
    better = F.array(*[F.when(F.col("first.tp") > p, F.col(f"_last_{p}")) for p in BETTER_TYPES])
    override = F.array_max(better)["classification"]
    cls = F.when(F.col("best.cp") < dims.OTHER_CLASSIFICATION, F.col("best.classification")
                 ).otherwise(F.coalesce(override, F.col("best.classification")))
    return grouped.select(
        "base", "number", cls.alias("classification"),
        F.col("best.cp").alias("class_prio"), F.col("first.tp").alias("type_prio"),
        F.col("first.type").alias("first_type"), F.col("first.ord").alias("first_ord"),
        F.coalesce("excluded", F.lit(False)).alias("has_excluded_type"), "n_items")


def base_volume(nums: DataFrame) -> DataFrame:
    """Usable items of each base as ``base, n``, from the counts of its numbers."""
    return nums.groupBy("base").agg(F.sum("n_items").alias("n"))


def eligible(nums: DataFrame) -> DataFrame:
    """Numbers fit for the contact report."""
    return nums.filter((F.col("classification") != "Non-Business") & ~F.col("has_excluded_type"))


RANK = ["class_prio", "type_prio", "first_ord", "number"]


def top_numbers(nums: DataFrame, k: int = 3) -> DataFrame:
    """First ``k`` numbers per base with ``rank``; the limit is applied on the map
    side, so a base with very many numbers sends ``k`` rows per task."""
    w = Window.partitionBy("base").orderBy(*RANK)
    return nums.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def rank_all(nums: DataFrame, slice_of: Column | None = None) -> DataFrame:
    """Full ranking per base. Slices of (class, type, position range) are sorted on
    their own, so a hot base is spread out."""
    cut = slice_of if slice_of is not None else F.lit(0)
    sliced = nums.withColumn("_slice", cut)
    return ranked(sliced, ["base"], ["class_prio", "type_prio", "_slice"],
                  [F.col("first_ord"), F.col("number")], "rank").drop("_slice")


def distinct_values(src: DataFrame, col: str) -> DataFrame:
    """(base, number, value, first position) of a source column."""
    return src.filter(F.col(col).isNotNull()).groupBy("base", "number", F.col(col).alias("value")).agg(
        F.min("ord").alias("ord"))


def number_pages(src: DataFrame, columns: dict[str, str], first_seen: bool = False) -> DataFrame:
    """``base, number, part`` and for each ``{source column: name}`` its distinct values as
    text: sorted, or in order of first sight. All lists go through one paging."""
    lists = None
    for col, name in columns.items():
        one = distinct_values(src, col).withColumn("column", F.lit(name))
        lists = one if lists is None else lists.unionByName(one)
    cells = paged(lists if first_seen else lists.drop("ord"), ["base", "number", "column"])
    return side_by_side(cells, ["base", "number"], list(columns.values()))


def ranked_lists(top: DataFrame, src: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Distinct source values of the ranked numbers as ``base, column, value``; the column
    is the name with the rank behind it. Sources meet their ranks once, for all lists; the
    ranks, few for a base, are looked up, so that the sources need no sorting."""
    ranks = hashed(top.select("base", "number", "rank"), "base", "number").hint("shuffle_hash")
    few = hashed(src, "base", "number").join(ranks, ["_h", "base", "number"])
    cells = F.array(*[F.struct(F.concat(F.lit(name), F.col("rank").cast("string")).alias("column"), F.col(col).alias("value"))
                      for col, name in columns.items()])
    return few.select("base", F.inline(cells)).filter(F.col("value").isNotNull()).distinct()


def wide(top: DataFrame, columns: dict[str, str], k: int = 3) -> DataFrame:
    """Ranks 1..k as columns: {source column: 'Prefix_'} per base."""
    return top.groupBy("base").agg(*[
        F.max(F.when(F.col("rank") == i, F.col(src))).alias(f"{prefix}{i}")
        for src, prefix in columns.items() for i in range(1, k + 1)])


def original_urls(items: DataFrame) -> DataFrame:
    """All source URLs of a base and the base itself, distinct, one per row."""
    found = items.select("base", F.col("source_url").alias("url")).distinct()
    return found.union(found.select("base", F.col("base").alias("url"))).distinct()


def representative_names(rows: DataFrame, bases: DataFrame) -> DataFrame:
    """Smallest company name mapped to each base, else ``Unknown``."""
    names = rows.groupBy("base").agg(F.min("company_name").alias("n"))
    return bases.join(names, "base", "left").select(
        "base", F.coalesce("n", F.lit("Unknown")).alias("company_name"))


def status_rank(c: Column) -> Column:
    return (F.when(c == "Success", 0).when(c == "Unknown", 3)
            .when(c.contains("Error"), 2).otherwise(1))


def base_status(sites: DataFrame) -> DataFrame:
    """Overall status of a base: success, else a status without ``Error``, else an error."""
    return sites.groupBy("base").agg(
        F.min_by("status", F.struct(status_rank(F.col("status")), F.col("ord"))).alias("base_status"))
