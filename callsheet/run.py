"""A whole run: company rows and stored pages in, report tables out.

    spark-submit -m callsheet.run --rows companies.csv --profile default --fetches fetches.parquet --out out/
"""

from __future__ import annotations

import argparse
import time
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from callsheet import dims
from callsheet.functions import html, phones, urls
from callsheet.functions.stages import computed, stored
from callsheet.functions.text import country_list
from callsheet.operators import candidates as cd, contacts as ct, crawl, journey as jn, labels as lb
from callsheet.operators import metrics as mt, outcomes as oc, reports as rp
from callsheet.operators.links import LinkRules
from callsheet.sources import sinks, tables


@dataclass(frozen=True)
class Settings:
    """Defaults of a run: no limit (0 or None) on pages, identical numbers or requests."""

    run_id: str = "run"
    rules: LinkRules = field(default_factory=LinkRules)
    max_depth: int = 1
    max_pages: int = 0
    bypass_score: int = 80
    bypass_pages: int = 5
    snippet_window: int = 300
    identical_per_page: int | None = None
    chunk: int = 10
    max_chunks: int | None = None
    max_retries: int = 1
    template: str | None = dims.PROMPT_PLACEHOLDER
    region: str = dims.DEFAULT_REGION
    count_error_items: bool = False


class Stages:
    """Stores stages and keeps how long each took and how many rows it has."""

    def __init__(self, spark: SparkSession):
        self.spark, self.measured = spark, []

    def stored(self, df: DataFrame, name: str) -> DataFrame:
        seen, started = Observation(name), time.monotonic()
        out = stored(df.observe(seen, F.count(F.lit(1)).alias("items")), name)
        self.measured.append((name, time.monotonic() - started, seen.get["items"]))
        return out

    def timed(self, name: str, made, *args, **options):
        """A step that stores its own stages; it has no item count."""
        started = time.monotonic()
        out = made(*args, **options)
        self.measured.append((name, time.monotonic() - started, None))
        return out

    def table(self) -> DataFrame:
        return self.spark.createDataFrame(self.measured, "task string, seconds double, items long")


def admitted(rows: DataFrame, log: DataFrame, robots: DataFrame | None,
             known_hosts: DataFrame | None, suffix_rules: DataFrame | None = None) -> DataFrame:
    """Clean the given URLs and decide which entry URL each row is crawled from.
    ``log``: result of ``crawl.fetch_log``."""
    cleaned = computed(rows, clean_url=urls.clean_url(F.col("given_url")))
    if known_hosts is not None:
        cleaned = crawl.probe_tlds(cleaned, known_hosts, url="clean_url").drop("clean_url").withColumnRenamed(
            "probed_url", "clean_url")
    cleaned = computed(cleaned, start_url=F.when(urls.is_http(F.col("clean_url")),
                                                 urls.normalize_url(F.col("clean_url"))))
    valid = cleaned.filter(F.col("start_url").isNotNull())
    if robots is not None:
        verdict = crawl.robots_admission(valid.select("input_row_id", "start_url"), robots, "start_url")
        cleaned = cleaned.join(verdict.select("input_row_id", "allowed"), "input_row_id", "left")
    else:
        cleaned = cleaned.withColumn("allowed", F.lit(True))
    tried = crawl.first_resolving_entry(
        cleaned.filter(F.col("start_url").isNotNull() & F.coalesce("allowed", F.lit(True))),
        log.select("url", "status_code", "has_content"), "start_url", rules=suffix_rules)
    picked = tried.select("input_row_id", F.col("entry_url"))
    return stored(cleaned.join(picked, "input_row_id", "left"), "admitted")


def run(rows: DataFrame, fetches: DataFrame, settings: Settings = Settings(),
        robots: DataFrame | None = None, known_hosts: DataFrame | None = None,
        labeler: Callable[[DataFrame], DataFrame] | None = None,
        tasks: DataFrame | None = None, suffix_rules: DataFrame | None = None) -> dict[str, DataFrame]:
    """All reports of a run.

    ``rows(input_row_id, company_name, given_url, given_phone, description,
    target_countries, logged_at)``, ``fetches(url, status_code, landed_url, html)``.
    ``labeler`` maps request slots to a response table; without one a key word rule labels
    the candidates as they are. ``tasks(task, seconds)``: times measured elsewhere, beside
    those that the run measures itself. ``detailed`` is a view on ``detailed_rows`` and
    ``detailed_numbers``, which are written in its place.
    ``suffix_rules(rule)``: public suffixes, for the domains that entry variants try."""
    s = settings
    left_out: dict[str, DataFrame] = {}  # what given limits leave out, as tables
    stage = Stages(rows.sparkSession)
    faulty, rows = oc.row_errors(rows)
    start = stage.timed("admitted", admitted, rows, crawl.fetch_log(fetches), robots, known_hosts, suffix_rules)
    to_crawl = start.filter(F.col("entry_url").isNotNull()).select("input_row_id", "entry_url")
    pages, crawled = stage.timed("crawl", crawl.crawl_stored, to_crawl, fetches, s.rules, s.max_depth, s.max_pages,
                                        s.bypass_score, s.bypass_pages)
    entries = start.join(crawled.select("input_row_id", "status", "pathful_url", "pages"), "input_row_id", "left")
    status = (F.when(F.col("start_url").isNull(), F.lit("InvalidURL"))
              .when(~F.coalesce("allowed", F.lit(True)), F.lit("RobotsDisallowed"))
              .otherwise(F.coalesce("status", F.lit("Unknown"))))
    entries = entries.withColumn("status", status).withColumn(
        "attempted", F.coalesce("pathful_url", F.when(F.col("status") != "InvalidURL", F.col("start_url"))))
    entries = stage.stored(computed(entries, base=urls.base_domain(F.col("attempted")),
                              normalized_phone=phones.e164(F.col("given_phone"), s.region))
                     .drop("pathful_url").withColumnRenamed("attempted", "pathful_url"), "entries")

    # Page texts: each visited page once, joined to its stored source.
    source = crawl.page_sources(fetches, pages).drop("landed_url")
    owner = entries.select("input_row_id", "pathful_url", "base", "company_name",
                           F.array_join(country_list(F.col("target_countries")), ",").alias("codes"))
    unread = oc.page_errors(pages.join(entries.select("input_row_id", "pathful_url"), "input_row_id"), fetches)
    visited = pages.join(owner, "input_row_id").join(source.filter(oc.readable(F.col("html"))), "link_url")
    texts = computed(visited, text=html.html_text(F.col("html")),
                     page_type=urls.page_type(F.col("landed_url")),
                     region=cd.scan_region(F.split("codes", ","))).select(
        "base", "pathful_url", F.col("landed_url").alias("page_url"), "page_type", "region", "text",
        F.col("company_name").alias("company"), "input_row_id", "depth", "score", "link_ord")
    cands = cd.phone_candidates(texts, F.col("region"), s.snippet_window)
    if s.identical_per_page is not None:
        all_cands = stage.stored(cands, "all_candidates")
        left_out["candidates_beyond_cap"] = cd.beyond_cap(all_cands, s.identical_per_page)
        cands = cd.cap_identical(all_cands, s.identical_per_page)
    cands = stage.stored(cands.withColumn("source_url", F.col("page_url")), "candidates")

    order = ["input_row_id", "depth", F.col("score").desc(), "link_ord", "match_ord"]
    unasked = None
    if labeler is not None and not (s.template or "").strip():
        unasked = cands.select("pathful_url", F.lit(s.template).alias("template")).distinct()
        cands = cands.limit(0)
    if labeler is None:
        labelled = stage.stored(lb.rule_labelled(cands), "labelled")
    else:
        slots = stage.stored(lb.request_slots(cands, "pathful_url", order, max_chunks=s.max_chunks, chunk=s.chunk), "slots")
        if s.max_chunks is not None:
            left_out["candidates_not_requested"] = lb.not_requested(cands, "pathful_url", order, max_chunks=s.max_chunks, chunk=s.chunk)
        responses = stage.stored(labeler(slots), "responses")
        labelled = stage.stored(lb.reconcile(slots, responses, s.max_retries), "labelled")
    seen = F.struct("input_row_id", "depth", (-F.col("score")).alias("score"), "link_ord", "match_ord")
    items = ct.usable_items(labelled.withColumn("ord", seen), s.count_error_items)
    found = stage.stored(ct.source_facts(items), "source_facts")
    nums, src = stage.stored(ct.numbers(found), "numbers"), ct.sources(found)

    page_rows = pages.join(entries.select("input_row_id", "base", "pathful_url"), "input_row_id").select(
        "base", "pathful_url", F.col("landed_url").alias("page_url"),
        urls.page_type(F.col("landed_url")).alias("page_type"))
    sites = stage.stored(site_table(entries, page_rows, cands, labelled), "sites")
    facts = stage.stored(jn.journey(entries, page_rows, sites, nums), "journey")
    out = stage.stored(oc.row_outcomes(entries, facts), "outcomes")
    domains = oc.domain_outcomes(facts)
    events = oc.failure_events(entries, sites, unread, unasked, faulty)
    lost = stage.stored(rp.attrition(rp.with_label_error(out, sites), facts, entries), "attrition")
    summary = stage.stored(rp.summary(out, nums, src, s.run_id), "summary")
    final = stage.stored(rp.final_contacts(entries, facts, nums, src, ct.original_urls(src)), "final")
    original = rows.select("input_row_id", "company_name", "given_url", "given_phone", "description")
    factors = {"detailed_rows": rp.detailed_rows(entries), "detailed_numbers": stage.stored(rp.detailed_numbers(facts, nums, src), "detailed_numbers")}
    reports = {
        "detailed": rp.detailed(*factors.values(), s.run_id),
        "summary": summary,
        "final_contacts": final,
        "processed_contacts": rp.processed_contacts(final),
        "attrition": lost,
        "domain_summary": rp.domain_summary(domains, jn.member_pages(entries, sites, src)),
        "augmented_input": rp.augmented_input(original, summary.filter("part = 0"), "given_phone"),
    }
    size = lambda name: reports[name].agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("report"), "n")
    sizes = reduce(DataFrame.unionByName, [size(name) for name in reports])
    reports["failed_rows"] = events
    reports["run_metrics"] = mt.run_metrics(
        rows, out, lost, domains, events, page_rows, sites, sizes, lb.item_counts(labelled),
        None if labeler is None else lb.token_totals(responses), mt.durations(stage.table(), tasks))
    reports["requests"] = sinks.request_archive(cands)
    if labeler is not None:
        reports["responses"] = sinks.response_archive(
            responses.join(slots.select("request_id", "pathful_url", "chunk").distinct(), "request_id"))
    return reports | factors | left_out


def site_table(entries: DataFrame, pages: DataFrame, cands: DataFrame, labelled: DataFrame) -> DataFrame:
    """Facts per entry page: status, pages, candidates, label calls and errors."""
    n = lambda df, name: df.groupBy("pathful_url").agg(F.count(F.lit(1)).alias(name))
    met = entries.filter(F.col("pathful_url").isNotNull()).groupBy("pathful_url", "base").agg(
        F.min("input_row_id").alias("ord"),
        F.min_by("status", F.struct(ct.status_rank(F.col("status")), F.col("input_row_id"))).alias("status"))
    bad = F.col("type").startswith("Error_")
    asked = labelled.groupBy("pathful_url").agg(
        F.count(F.lit(1)).alias("raw_numbers"), F.bool_and(bad).alias("_all_bad"),
        F.min(F.when(bad, F.col("type"))).alias("_error"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    return (met.join(n(pages, "pages"), "pathful_url", "left")
            .join(n(cands, "candidates"), "pathful_url", "left").join(asked, "pathful_url", "left")
            .select("pathful_url", "base", "ord",
                    F.when(F.col("status") == "Already_Processed", "Success").otherwise(F.col("status")).alias("status"),
                    zero("pages"), zero("candidates"), F.col("raw_numbers").isNotNull().alias("label_called"),
                    zero("raw_numbers"), F.when(F.col("_all_bad"), F.col("_error")).alias("error")))


#: Reports that are read as a view on others.
VIEWS = {"detailed"}


def write_all(reports: dict[str, DataFrame], out: str, run_id: str) -> None:
    for name, df in reports.items():
        if name in VIEWS:
            continue
        sinks.write_report(df, out, name, run_id)


def input_rows(spark: SparkSession, path: str, profile: str = "default", row_range: str | None = None,
               stop_after_blank: int = 3, run_id: str = "run") -> DataFrame:
    """Company rows of a CSV, JSON or Parquet table in the columns of a profile, as ``run``
    takes them. A table that has these already is taken as it is."""
    if tables.kind(path) == "csv":
        columns = tables.header(spark, path)
        own = "input_row_id" in columns.names
        df = tables.scan_csv(spark, path, columns, "_position" if own else "input_row_id").drop("_position")
    else:
        df = tables.read_table(spark, path)
    if "given_url" in df.columns:
        return df
    if "input_row_id" not in df.columns:
        if tables.kind(path) == "json":
            raise ValueError("JSON lines have no order of their own: give them an input_row_id")
        df = tables.with_ordinal(df)
    cells = [c for c in df.columns if c != "input_row_id"]
    loaded = tables.load_input(df, cells, profile, row_range, stop_after_blank, run_id)
    codes = F.col("TargetCountryCodes")
    if loaded.schema["TargetCountryCodes"].dataType.typeName() == "array":
        codes = F.concat(F.lit("['"), F.array_join(codes, "','"), F.lit("']"))
    return loaded.select(
        "input_row_id", F.col("CompanyName").alias("company_name"), F.col("GivenURL").alias("given_url"),
        F.col("GivenPhoneNumber").alias("given_phone"), F.col("Description").alias("description"),
        codes.alias("target_countries"), F.current_timestamp().alias("logged_at"))


def main() -> None:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("--rows", required=True)
    p.add_argument("--profile", default="default")
    p.add_argument("--row-range")
    p.add_argument("--stop-after-blank", type=int, default=3)
    p.add_argument("--fetches", required=True)
    p.add_argument("--robots")
    p.add_argument("--hosts")
    p.add_argument("--suffix-rules")
    p.add_argument("--out", required=True)
    p.add_argument("--run-id", required=True)
    a = p.parse_args()
    spark = SparkSession.builder.appName("callsheet").getOrCreate()
    read = lambda path: spark.read.parquet(path) if path else None
    rows = stored(input_rows(spark, a.rows, a.profile, a.row_range, a.stop_after_blank, a.run_id), "input")
    write_all(run(rows, read(a.fetches), Settings(run_id=a.run_id), read(a.robots), read(a.hosts),
                  suffix_rules=read(a.suffix_rules)),
              a.out, a.run_id)


if __name__ == "__main__":
    main()
