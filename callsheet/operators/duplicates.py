"""Duplicate profile of the input: names and URL hosts seen more than once."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from callsheet.functions import urls
from callsheet.functions.stages import computed
from callsheet.functions.text import strip

MISSING_URL = "MISSING_OR_INVALID_URL_INPUT"


def with_keys(rows: DataFrame) -> DataFrame:
    return computed(rows, name_key=strip(F.col("company_name")),
                    host_key=F.coalesce(urls.input_host(F.col("given_url")), F.lit(MISSING_URL)))


def _key_counts(keyed: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows of each (name, host), name and host. Names and hosts are counted from the pairs, those
    without a name among them: in one query the pairs are shuffled once, however many ask for them."""
    pairs = keyed.groupBy("name_key", "host_key").agg(F.count(F.lit(1)).alias("n"))
    names = pairs.groupBy(F.col("name_key").alias("_name")).agg(F.sum("n").alias("name_count"))
    hosts = pairs.groupBy("host_key").agg(F.sum("n").alias("host_count"))
    return pairs, names, hosts


def _with_counts(rows: DataFrame, names: DataFrame, hosts: DataFrame) -> DataFrame:
    """Rows or pairs with the counts of their name, 0 without one, and of their host. Equal nulls
    meet: a test for nulls would go down into the pairs, and the names would need a scan of their own."""
    met = rows.join(names, F.col("name_key").eqNullSafe(F.col("_name")), "left").drop("_name").join(hosts, "host_key", "left")
    return met.withColumn("name_count", F.when(F.col("name_key").isNull(), 0).otherwise(F.coalesce("name_count", F.lit(0))))


def with_duplicate_counts(rows: DataFrame) -> DataFrame:
    """Total count of each row's name and host, and the duplicate flags.

    Counts are aggregated first and joined back by key: no window ever holds all
    rows of one name, and a hot key is split by the adaptive skew join."""
    keyed = with_keys(rows)
    _, names, hosts = _key_counts(keyed)
    return (_with_counts(keyed, names, hosts)
            .withColumn("name_dup", F.col("name_count") > 1)
            .withColumn("host_dup", (F.col("host_count") > 1) & (F.col("host_key") != MISSING_URL))
            .withColumn("any_dup", F.col("name_dup") | F.col("host_dup")))


def duplicate_profile(rows: DataFrame) -> DataFrame:
    """The eight duplicate counters of a run, as one row.

    Name and host counters come from their grouped counts; rows that are duplicate
    in both ways are counted over (name, host) groups instead of single rows."""
    pairs, names, hosts = _key_counts(with_keys(rows))
    flagged = _with_counts(pairs, names, hosts)
    name_dup = F.col("name_count") > 1
    host_dup = (F.col("host_count") > 1) & (F.col("host_key") != MISSING_URL)
    rows_if = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0))
    per_row = flagged.agg(
        F.sum("n").alias("input_rows"),
        rows_if(name_dup).alias("rows_dup_name"), rows_if(host_dup).alias("rows_dup_url"),
        rows_if(name_dup | host_dup).alias("rows_dup_any"))
    per_name = names.agg(F.count("_name").alias("distinct_names"),
                         F.count_if(F.col("_name").isNotNull() & (F.col("name_count") > 1)).alias("names_repeated"))
    per_host = hosts.agg(
        F.count(F.lit(1)).alias("distinct_urls"),
        F.count_if((F.col("host_count") > 1) & (F.col("host_key") != MISSING_URL)).alias("urls_repeated"))
    one = lambda df: df.withColumn("_k", F.lit(1))
    return one(per_row).join(one(per_name), "_k").join(one(per_host), "_k").drop("_k")
