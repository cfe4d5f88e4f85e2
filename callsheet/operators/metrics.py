"""Run metrics as one long table (section, metric, key, value)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from callsheet.operators.duplicates import duplicate_profile
from callsheet.operators.outcomes import SUCCESS, failure_group


def failure_rollup(events: DataFrame) -> DataFrame:
    """Failures per group and stage with the group totals (stage NULL), in one pass."""
    keyed = events.select(failure_group(F.col("stage_of_failure")).alias("failure_group"),
                          F.col("stage_of_failure").alias("stage"))
    counted = keyed.rollup("failure_group", "stage").agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(F.col("failure_group").isNotNull())


def fault_counts(outcome_rows: DataFrame) -> DataFrame:
    return outcome_rows.filter(F.col("reason") != SUCCESS).groupBy("fault").agg(
        F.count(F.lit(1)).alias("n"))


def yield_counts(outcome_rows: DataFrame) -> DataFrame:
    got = F.col("reason") == SUCCESS
    return outcome_rows.agg(F.count(F.lit(1)).alias("input_rows"),
                            F.count_if(got).alias("rows_with_contact"),
                            F.count_if(~got).alias("rows_without_contact"))


def attrition_duplicates(attrition: DataFrame) -> DataFrame:
    yes = lambda c: F.count_if(F.col(c) == "Yes")
    return attrition.agg(
        F.count(F.lit(1)).alias("attrition_rows"),
        yes("Is_Input_CompanyName_Duplicate").alias("dup_name"),
        yes("Is_Input_CanonicalURL_Duplicate").alias("dup_url"),
        yes("Is_Input_Row_Considered_Duplicate").alias("dup_any"))


def domain_outcome_counts(domains: DataFrame) -> DataFrame:
    return domains.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def domain_fault_counts(domains: DataFrame) -> DataFrame:
    return domains.filter(F.col("fault") != "N/A").groupBy("fault").agg(F.count(F.lit(1)).alias("n"))


def average(total: Column, items: Column) -> Column:
    """NULL instead of a division by zero."""
    return F.try_divide(total.cast("double"), items.cast("double"))


def page_stats(pages: DataFrame) -> DataFrame:
    return pages.groupBy("page_type").agg(F.count(F.lit(1)).alias("pages"))


def site_stats(sites: DataFrame) -> DataFrame:
    """Scan, label and page counters over the sites."""
    c = F.col
    ok = c("status") == "Success"
    return sites.agg(
        F.count_if(ok).alias("sites_scraped"),
        F.coalesce(F.sum(F.when(ok, c("pages"))), F.lit(0)).alias("pages_scraped"),
        F.count_if(ok & (c("candidates") > 0)).alias("sites_with_candidates"),
        F.coalesce(F.sum("candidates"), F.lit(0)).alias("candidates_found"),
        F.count_if("label_called").alias("sites_labelled"),
        F.count_if(c("error").isNotNull()).alias("label_errors"),
        F.count_if(ok & (c("candidates") == 0)).alias("sites_without_candidates"),
        F.coalesce(F.sum("raw_numbers"), F.lit(0)).alias("raw_numbers"),
    ).withColumn("pages_per_site", average(c("pages_scraped"), c("sites_scraped")))


def task_durations(tasks: DataFrame) -> DataFrame:
    """Seconds and mean per item for every task of an event table."""
    return tasks.groupBy("task").agg(
        F.sum("seconds").alias("seconds"), F.count(F.lit(1)).alias("items")
    ).withColumn("seconds_per_item", average(F.col("seconds"), F.col("items")))


def durations(measured: DataFrame, tasks: DataFrame | None = None) -> DataFrame:
    """Seconds and mean per item of the run's own stages (``task, seconds, items``) and of
    ``tasks``, an event table of times measured elsewhere, if given."""
    own = measured.withColumn("seconds_per_item", average(F.col("seconds"), F.col("items")))
    return own if tasks is None else own.unionByName(task_durations(tasks))


def _long(df: DataFrame, section: str, metrics: list[str] | None = None) -> DataFrame:
    """Columns of a one-row table as metric rows."""
    names = metrics or df.columns
    pairs = F.array(*[F.struct(F.lit(n).alias("metric"), F.lit("").alias("key"),
                               F.col(n).cast("double").alias("value")) for n in names])
    return df.select(F.lit(section).alias("section"), F.inline(pairs))


def _keyed(df: DataFrame, section: str, metric: str, key: str, value: str) -> DataFrame:
    return df.select(F.lit(section).alias("section"), F.lit(metric).alias("metric"),
                     F.coalesce(F.col(key), F.lit("(total)")).alias("key"),
                     F.col(value).cast("double").alias("value"))


def run_metrics(rows: DataFrame, outcome_rows: DataFrame, attrition: DataFrame, domains: DataFrame,
                events: DataFrame, pages: DataFrame, sites: DataFrame, report_sizes: DataFrame,
                items: DataFrame | None = None, tokens: DataFrame | None = None,
                durations: DataFrame | None = None) -> DataFrame:
    """All metrics of a run. Every part is a small aggregate; only those are united.
    ``items``, ``tokens``: one-row results of ``item_counts`` and ``token_totals``;
    ``durations``: result of ``durations`` or ``task_durations``."""
    parts = [
        _long(duplicate_profile(rows), "input_duplicates"),
        _long(attrition_duplicates(attrition), "attrition_duplicates"),
        _long(yield_counts(outcome_rows), "attrition"),
        _keyed(fault_counts(outcome_rows), "attrition", "fault", "fault", "n"),
        _long(site_stats(sites), "sites"),
        _keyed(page_stats(pages), "pages", "by_type", "page_type", "pages"),
        _keyed(domain_outcome_counts(domains), "domains", "outcome", "reason", "n"),
        _keyed(domain_fault_counts(domains), "domains", "fault", "fault", "n"),
        _keyed(failure_rollup(events).withColumn(
            "key", F.concat_ws("/", "failure_group", F.coalesce("stage", F.lit("(total)")))),
            "failures", "stage", "key", "n"),
        _keyed(report_sizes, "reports", "rows", "report", "n"),
    ]
    parts += [_long(df, "labels") for df in (items, tokens) if df is not None]
    if durations is not None:
        parts += [_keyed(durations, "tasks", m, "task", m) for m in ("seconds", "items", "seconds_per_item")]
    return reduce(DataFrame.unionByName, parts)
