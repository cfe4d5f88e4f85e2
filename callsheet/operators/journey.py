"""What happened to each base domain, folded from row, page and site tables.

entries: input_row_id, company_name, given_url, pathful_url, base, status
pages:   base, page_url, page_type
sites:   pathful_url, base, ord, status, candidates, label_called, raw_numbers, error"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from callsheet.operators import contacts
from callsheet.operators.paging import paged, side_by_side

NETWORK = "Timeout|DNS|Network|Unreachable"
DENIED = "403|AccessDenied|Robots"
NOT_FOUND = "404|NotFound"


def site_facts(sites: DataFrame) -> DataFrame:
    """Per base: overall status, whether all sites failed alike, and counters."""
    hit = lambda p: F.bool_and(F.col("status").rlike(p))
    return sites.groupBy("base").agg(
        F.min_by("status", F.struct(contacts.status_rank(F.col("status")), F.col("ord"))).alias("base_status"),
        hit(NETWORK).alias("all_network"), hit(DENIED).alias("all_denied"), hit(NOT_FOUND).alias("all_missing"),
        F.count(F.lit(1)).alias("n_sites"),
        F.bool_or(F.col("candidates") > 0).alias("any_candidates"),
        F.bool_or("label_called").alias("any_calls"),
        F.sum("raw_numbers").alias("raw_numbers"),
        F.bool_or(F.col("error").isNotNull()).alias("any_error"),
        (F.bool_or("label_called") & (F.count_if(F.col("label_called") & F.col("error").isNull()) == 0)).alias("all_errors"))


def page_totals(pages: DataFrame) -> DataFrame:
    """Page count and page types (a closed set) as a map and JSON text, per base."""
    per_type = pages.groupBy("base", "page_type").agg(F.count(F.lit(1)).alias("n"))
    return per_type.groupBy("base").agg(
        F.sum("n").alias("total_pages"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("page_type", "n")))).alias("page_types"))


def _type_pairs(src: DataFrame) -> DataFrame:
    """Source count per type of a base, as ``"type": n`` pairs."""
    counted = src.filter(F.col("type").isNotNull()).groupBy("base", "type").agg(
        F.count(F.lit(1)).alias("n"))
    pair = F.concat(F.to_json(F.array("type")), F.lit(": "), F.col("n").cast("string"))
    return counted.select("base", F.regexp_replace(pair, r"^\[(.*)\]: ([0-9]+)$", "$1: $2").alias("value"))


def type_histogram(src: DataFrame) -> DataFrame:
    """Source count per type of a base as JSON text, an object per page."""
    return paged(_type_pairs(src), ["base"]).select(
        "base", "part", F.concat(F.lit("{"), F.col("cell"), F.lit("}")).alias("types_json"))


def consolidated_totals(nums: DataFrame) -> DataFrame:
    return nums.groupBy("base").agg(F.count(F.lit(1)).alias("consolidated"))


def members(entries: DataFrame, sites: DataFrame) -> DataFrame:
    """Long form of the journey's sets: one row per (base, column, value)."""
    known = entries.filter(F.col("base").isNotNull())
    pick = lambda name, c: known.select("base", F.lit(name).alias("column"), c.cast("string").alias("value"))
    sets = (pick("Input_Row_IDs", F.col("input_row_id"))
            .unionByName(pick("Input_CompanyNames", F.col("company_name")))
            .unionByName(pick("Input_GivenURLs", F.col("given_url")))
            .unionByName(pick("Pathful_URLs_Attempted_List", F.col("pathful_url")))
            .filter(F.col("value").isNotNull()).distinct())
    errors = sites.filter(F.col("error").isNotNull()).select(
        "base", F.lit("LLM_Error_Messages_Aggregated").alias("column"),
        F.concat(F.lit("PathfulURL ("), F.col("pathful_url"), F.lit("): "), F.col("error")).alias("value"))
    return sets.unionByName(errors)


TYPES = "LLM_Consolidated_Number_Types_Summary"
LISTS = ["Input_Row_IDs", "Input_CompanyNames", "Input_GivenURLs",
         "Pathful_URLs_Attempted_List", "LLM_Error_Messages_Aggregated", TYPES]


def member_pages(entries: DataFrame, sites: DataFrame, src: DataFrame) -> DataFrame:
    """All lists of a base, the type counts included, as columns per ``base, part``."""
    long = members(entries, sites).unionByName(_type_pairs(src).withColumn("column", F.lit(TYPES)))
    return side_by_side(paged(long, ["base", "column"]), ["base"], LISTS)


def journey(entries: DataFrame, pages: DataFrame, sites: DataFrame, nums: DataFrame) -> DataFrame:
    """One scalar row per base that any input row reached. All parts are grouped by
    base first, so they meet already partitioned."""
    bases = entries.filter(F.col("base").isNotNull()).groupBy("base").agg(
        F.countDistinct("input_row_id").alias("n_rows"))
    out = (bases.join(site_facts(sites), "base", "left")
           .join(page_totals(pages), "base", "left")
           .join(consolidated_totals(nums), "base", "left"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    no = lambda c: F.coalesce(F.col(c), F.lit(False)).alias(c)
    return out.select(
        "base", "n_rows", F.coalesce("base_status", F.lit("Unknown")).alias("base_status"),
        zero("n_sites"), no("all_network"), no("all_denied"), no("all_missing"),
        no("any_candidates"), no("any_calls"), zero("raw_numbers"), no("any_error"), no("all_errors"),
        zero("total_pages"), F.coalesce(F.to_json("page_types"), F.lit("{}")).alias("page_types_json"),
        zero("consolidated"))
