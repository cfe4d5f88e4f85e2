"""Crawl decisions over stored fetches: entry URLs, frontier, page budget,
robots rules and outcomes. Nothing is fetched; ``fetches`` stands for the web."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from callsheet import dims
from callsheet.functions import urls
from callsheet.functions.stages import stored
from callsheet.operators.links import LinkRules, score_links
from callsheet.operators.skew import ranked
from callsheet.operators.suffixes import entry_variants


def probe_tlds(rows: DataFrame, known_hosts: DataFrame, url: str = "url", key: str = "input_row_id",
               tlds=None) -> DataFrame:
    """Complete hosts without a top-level domain by the first known candidate.

    Only incomplete hosts are expanded (by the fixed number of candidates), so the
    join carries few rows; all others pass through untouched."""
    tlds = tlds or dims.PROBE_TLDS
    host = urls.url_host(F.col(url))
    tries = (rows.filter(urls.needs_tld(host))
             .select(key, F.posexplode(F.transform(
                 F.array(*[F.lit(t) for t in tlds]),
                 lambda t: F.concat_ws(".", host, t))).alias("pos", "host")))
    hits = (tries.join(known_hosts.select("host").distinct(), "host", "left_semi")
            .groupBy(key).agg(F.min_by("host", "pos").alias("_host")))
    return (rows.join(hits, key, "left")
            .withColumn("probed_url", F.when(F.col("_host").isNotNull(),
                                             urls.with_host(F.col(url), F.col("_host")))
                        .otherwise(F.col(url)))
            .drop("_host"))


def first_resolving_entry(rows: DataFrame, fetches: DataFrame, url: str = "url",
                          key: str = "input_row_id", rules: DataFrame | None = None) -> DataFrame:
    """Walk the DNS variants of every entry URL; the first that does not end in a
    DNS error decides. All failing: the last variant, ``DNSError``. ``rules`` is a table of
    public suffix rules; without it the small fixed set counts."""
    tries = rows.select(key, F.posexplode(urls.dns_variants(F.col(url))).alias("pos", "try_url")) if rules is None else entry_variants(
        rows, rules, url, key)
    status = fetch_status(F.col("status_code"), F.col("has_content"), entry=True)
    seen = tries.join(fetches.select(F.col("url").alias("try_url"), status.alias("status")),
                      "try_url", "left").withColumn(
        "status", F.coalesce("status", F.lit("DNSError")))
    done = F.col("status") != "DNSError"
    picked = seen.groupBy(key).agg(
        F.coalesce(F.min(F.when(done, F.struct("pos", "try_url", "status"))),
                   F.max(F.struct("pos", "try_url", "status"))).alias("p"),
        F.count(F.lit(1)).alias("variants"))
    return picked.select(key, F.col("p.try_url").alias("entry_url"), F.col("p.pos").alias("variant"),
                         F.col("p.status").alias("status"), "variants")


def fetch_status(code: Column, has_content: Column, entry: bool) -> Column:
    """Readable status of a fetch; without a code it depends on the stage."""
    known = F.create_map(*[F.lit(x) for kv in dims.FETCH_STATUS.items() for x in kv])
    missing = "NoStatusFromServer" if entry else "NoContentScraped_Overall"
    out = (F.when(code.isNull(), F.lit(missing))
           .when(code > 0, F.concat(F.lit("HTTPError_"), code.cast("string")))
           .otherwise(F.coalesce(F.try_element_at(known, code), F.lit("UnknownScrapeErrorCode"))))
    return F.when(has_content, F.lit("Success")).otherwise(out)


def first_visits(pages: DataFrame, landed: str, order: list[str]) -> DataFrame:
    """Keep the first row per landed URL. The rank filter sits right on the window,
    so a hot URL is cut to one row per map task before the shuffle."""
    w = Window.partitionBy(landed).orderBy(*order)
    return pages.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") == 1).drop("_n")


def frontier(links: DataFrame, key: str = "entry_url") -> DataFrame:
    """Queue each link once per entry, by its first occurrence, entry page first."""
    return (links.groupBy(key, "link_url")
            .agg(F.min(F.struct("link_ord", "score")).alias("f"))
            .select(key, "link_url", F.col("f.score").alias("score"), F.col("f.link_ord").alias("link_ord")))


def page_budget(queue: DataFrame, key: str = "entry_url", max_pages: int = 20,
                bypass_score: int = 80, bypass_pages: int = 5) -> DataFrame:
    """Fetched pages an entry may keep: ``max_pages`` by score, then a few more of
    high score. The queue is ordered by score, so both limits are one rank. Without a limit
    all are ranked, in slices, so that a site with very many links is spread over tasks."""
    if max_pages == 0:
        cut = queue.withColumns({"_s": -F.col("score"), "_b": F.floor(F.col("link_ord") / 10_000)})
        return ranked(cut, [key], ["_s", "depth", "_b"], [F.col("link_ord")], "visit").drop("_s", "_b")
    w = Window.partitionBy(key).orderBy(F.col("score").desc(), "depth", "link_ord")
    return queue.withColumn("visit", F.row_number().over(w)).filter(F.col("visit") <= max_pages + bypass_pages).filter(
        (F.col("visit") <= max_pages) | (F.col("score") >= bypass_score))


def fetch_log(fetches: DataFrame) -> DataFrame:
    """One row per fetched URL, without the page source: ``url, status_code, landed_url,
    has_content, content_key``. Of several attempts one with content goes first, then the
    smallest status, landed URL and content key."""
    source = F.coalesce("html", F.lit(""))
    light = fetches.select("url", "status_code", "landed_url", (source != "").alias("has_content"),
                           F.xxhash64(source).alias("content_key"))
    w = Window.partitionBy("url").orderBy(
        F.col("has_content").desc(), F.col("status_code").asc_nulls_last(), "landed_url", "content_key")
    return light.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") == 1).drop("_n")


def page_sources(fetches: DataFrame, pages: DataFrame) -> DataFrame:
    """``link_url, landed_url, html`` of the distinct ``pages``: the only place where page
    sources move, one row per page however many rows reached it."""
    wanted = pages.select("link_url", "content_key", "landed_url").distinct()
    held = fetches.select(F.col("url").alias("link_url"), F.xxhash64(F.coalesce("html", F.lit(""))).alias("content_key"), "html")
    return (held.join(wanted, ["link_url", "content_key"])
            .dropDuplicates(["link_url", "content_key"]).drop("content_key"))


def crawl_stored(entries: DataFrame, fetches: DataFrame, rules: LinkRules = LinkRules(),
                 max_depth: int = 1, max_pages: int = 20, bypass_score: int = 80,
                 bypass_pages: int = 5) -> tuple[DataFrame, DataFrame]:
    """Walk stored fetches from each entry URL.

    ``entries(input_row_id, entry_url)``, ``fetches(url, status_code, landed_url,
    html)``. Returns the kept pages (first visit of a landed URL wins, by row) and
    one outcome row per entry. Depth is a small constant; every level's pages and
    queue are written to the shared folder, so the plan does not grow with depth."""
    log = stored(fetch_log(fetches), "fetch-log")
    level = entries.select("input_row_id", "entry_url", F.col("entry_url").alias("link_url"),
                           F.lit(100).alias("score"), F.lit(0).alias("link_ord"),
                           F.lit(0).alias("depth"))
    got = log.filter("has_content").select(
        F.col("url").alias("link_url"), "status_code", "content_key",
        urls.normalize_url(F.col("landed_url")).alias("landed_url"))
    queued = kept = None
    for depth in range(max_depth + 1):
        queue = level.select("input_row_id", "link_url")
        queued = queue if queued is None else queued.unionByName(queue)
        done = stored(_within_budget(level.join(got, "link_url"), kept, max_pages, bypass_score, bypass_pages),
                      "crawl-pages")
        kept = done if kept is None else kept.unionByName(done)
        if depth < max_depth:
            # Links are read once per page and then dealt to the rows that reached it.
            read = page_sources(fetches, done).withColumnRenamed("link_url", "from_url")
            links = score_links(read, rules, "landed_url").select("from_url", "link_url", "link_ord", "score")
            found = done.select("input_row_id", "entry_url", F.col("link_url").alias("from_url")).join(links, "from_url")
            nxt = (found.groupBy("input_row_id", "entry_url", "link_url")
                   .agg(F.min(F.struct("link_ord", "score")).alias("f")))
            seen = queued.unionByName(kept.select("input_row_id", F.col("landed_url").alias("link_url")))
            level = stored(
                nxt.select("input_row_id", "entry_url", "link_url",
                           F.col("f.score").alias("score"), F.col("f.link_ord").alias("link_ord"),
                           F.lit(depth + 1).alias("depth"))
                .join(seen, ["input_row_id", "link_url"], "left_anti"), "crawl-queue")
    pages = first_visits(kept, "landed_url", ["input_row_id", "depth", F.col("score").desc(), "link_ord"])
    pages = stored(pages, "crawl-visits")
    return pages, _outcomes(entries, pages, log)


def _within_budget(hit: DataFrame, kept: DataFrame | None, max_pages: int, bypass_score: int,
                   bypass_pages: int) -> DataFrame:
    """Fetched pages of a level that the entry's budget still allows."""
    if max_pages == 0:
        return hit
    if kept is None:
        hit = hit.withColumn("_used", F.lit(0).cast("bigint"))
    else:
        used = kept.groupBy("input_row_id").agg(F.count(F.lit(1)).alias("_used"))
        hit = hit.join(used, "input_row_id", "left")
    w = Window.partitionBy("input_row_id").orderBy(F.col("score").desc(), "link_ord")
    ranked = hit.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= max_pages + bypass_pages)
    at = F.col("_n") + F.coalesce("_used", F.lit(0))
    return ranked.filter((at <= max_pages) | ((F.col("score") >= bypass_score)
                                              & (at <= max_pages + bypass_pages))).drop("_n", "_used")


def entry_outcomes(entries: DataFrame, pages: DataFrame, fetches: DataFrame) -> DataFrame:
    """Success with at least one new page, else the decoded entry status. An entry
    that only met pages of earlier rows is ``Already_Processed``."""
    return _outcomes(entries, pages, fetch_log(fetches))


def _outcomes(entries: DataFrame, pages: DataFrame, log: DataFrame) -> DataFrame:
    n = pages.groupBy("input_row_id").agg(F.count(F.lit(1)).alias("pages"))
    first = log.select(F.col("url").alias("entry_url"), "status_code", "landed_url", "has_content")
    joined = entries.join(first, "entry_url", "left").join(n, "input_row_id", "left")
    status = (F.when(F.col("pages") > 0, F.lit("Success"))
              .when(F.col("has_content"), F.lit("Already_Processed"))
              .otherwise(fetch_status(F.col("status_code"), F.lit(False), entry=True)))
    return joined.select(
        "input_row_id", "entry_url", F.coalesce("pages", F.lit(0)).alias("pages"),
        status.alias("status"),
        F.when(F.col("has_content"), urls.normalize_url(F.col("landed_url"))).alias("pathful_url"))


def robots_admission(entries: DataFrame, rules: DataFrame, url: str = "entry_url",
                     key: str = "input_row_id", agent: str = "*") -> DataFrame:
    """First matching rule of the host decides; no rule means allowed.

    The prefix match is an equality join: a URL whose host has rules is expanded into
    prefixes of the lengths that these rules have, never paired with all of them."""
    own = (rules.filter(F.col("ua") == agent)
           .select("host", F.col("prefix"), "rule_ord",
                   (F.col("allow") | (F.col("prefix") == "")).alias("allow"))
           .groupBy("host", "prefix").agg(F.min(F.struct("rule_ord", "allow")).alias("r")))
    sizes = own.groupBy("host").agg(F.collect_set(F.length("prefix")).alias("sizes"))
    ruled = entries.select(key, urls.url_host(F.col(url)).alias("host"),
                           F.regexp_replace(F.col(url), urls.ROOT, "").alias("target")).join(sizes, "host")
    tried = (ruled.select(key, "host", "target", F.explode("sizes").alias("n"))
             .filter(F.col("n") <= F.length("target"))
             .select(key, "host", F.substring(F.col("target"), F.lit(1), F.col("n")).alias("prefix")))
    verdict = (tried.join(own, ["host", "prefix"]).groupBy(key)
               .agg(F.min("r").alias("r")).select(key, F.col("r.allow").alias("allow")))
    return entries.join(verdict, key, "left").withColumn(
        "allowed", F.coalesce("allow", F.lit(True))).drop("allow")
