"""Views over the given tables that play the roles of the data model: company
rows, pages, texts, labelled items, fetches, label exchange."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from callsheet.functions import html, phones, urls
from callsheet.functions.stages import computed, spread
from callsheet.operators import labels
from callsheet.operators.links import LinkRules, score_links

RUN_ID = "20240101_000000"
# Words of the navigation bars in the page table.
RULES = LinkRules(target=["the", "and", "nicht", "les", "que", "la", "to"], critical=["the", "la"],
                  high=["and", "que"], excluded=["/attion"])


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def case(c: Column, options: dict, other=None) -> Column:
    out = F
    for k, v in options.items():
        out = out.when(c == k, v if isinstance(v, Column) else F.lit(v))
    return out.otherwise(other if isinstance(other, Column) else F.lit(other))


def host_label(c: Column) -> Column:
    return F.substring_index(urls.input_host(c), ".", 1)


def input_rows(spark, sf) -> DataFrame:
    """Company rows from the page table."""
    i = F.col("page_id")
    phone = (F.when(i % 5 == 0, None).when(i % 7 == 0, "invalid-number")
             .when(i % 3 == 0, F.concat(F.lit("0049 30 "), (200000 + i * 7).cast("string")))
             .when(i % 3 == 1, F.concat(F.lit("+49 (0)89/"), (300000 + i * 11).cast("string")))
             .otherwise(F.concat(F.lit("044 668 "), (10 + i % 90).cast("string"), F.lit(" "),
                                 (10 + i % 80).cast("string"))))
    return table(spark, sf, "pages").select(
        i.alias("input_row_id"),
        F.when(i % 13 != 0, host_label(F.col("url"))).alias("company_name"),
        F.col("url").alias("given_url"), phone.alias("given_phone"),
        case(i % 4, {0: "DE", 1: "CH", 2: "AT"}, "US").alias("region"),
        case(i % 3, {0: "['DE','AT']", 1: "['CH']"}, "DE").alias("target_countries"))


def page_texts(spark, sf) -> DataFrame:
    """Page URL, base, type and visible text."""
    pages = computed(table(spark, sf, "pages").select("page_id", "url", "html"),
                     page_url=urls.normalize_url(F.col("url")), text=html.html_text(F.col("html")))
    return computed(pages, base=urls.base_domain(F.col("page_url")),
                    page_type=urls.page_type(F.col("page_url"))).select(
        "page_id", "page_url", "base", "page_type", "text")


def texts(spark, sf) -> DataFrame:
    """Documents and pages as texts of sites."""
    base = F.concat(F.lit("http://"), F.col("source"), F.lit(".example.com"))
    docs = table(spark, sf, "documents").select(
        base.alias("base"), F.concat(base, F.lit("/doc/"), F.col("doc_id")).alias("page_url"),
        F.concat(base, F.lit("/")).alias("pathful_url"), F.col("source").alias("company"),
        F.lit("general_content").alias("page_type"), F.col("doc_id").alias("page_ord"), "text")
    pages = page_texts(spark, sf).select(
        "base", "page_url", F.concat("base", F.lit("/")).alias("pathful_url"),
        host_label(F.col("page_url")).alias("company"), "page_type",
        (F.lit(10_000_000_000) + F.col("page_id")).alias("page_ord"), "text")
    return docs.unionByName(pages)


def links(spark, sf) -> DataFrame:
    """Scored internal links of all pages."""
    return score_links(pages_html(spark, sf), RULES)


def pages_html(spark, sf) -> DataFrame:
    pages = table(spark, sf, "pages").select("page_id", "url", "html")
    return computed(pages, page_url=urls.normalize_url(F.col("url"))).select("page_id", "page_url", "html")


def items(spark, sf) -> DataFrame:
    """Labelled items at volume, from line items; some are malformed."""
    o, p, s, n = (F.col(c) for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"))
    base = F.concat(F.lit("http://s"), s, F.lit(".example.com"))
    kind = (o + p * 3 + n * 7) % 40
    cls = (o * 7 + n) % 60
    rows = table(spark, sf, "lineitem").select(
        base.alias("base"),
        F.when((o + p) % 101 != 0,
               F.concat(F.lit("+4930"), F.lpad((p % 50).cast("string"), 7, "0"))).alias("number"),
        F.when(o % 103 != 0, F.concat(base, F.lit("/p"), n)).otherwise("").alias("source_url"),
        case(kind, {0: "Main Line", 1: "Sales", 2: "Support Hotline", 3: "Fax", 4: "Mobile",
                    5: "Unknown", 6: "Customer Service", 7: "Hotline X", 8: "Zentrale",
                    9: "Direct Dial", 10: "Error_PersistentMismatchAfterRetries"},
             F.when(kind <= 20, "Main Line").when(kind <= 30, "Sales").otherwise("Info-Hotline")
             ).alias("type"),
        (F.when((p % 10) == 3, F.concat(F.lit("Unlisted "), o % 4))
         .when(cls == 0, "Primary").when(cls <= 4, "Secondary").when(cls <= 9, "Support")
         .when(cls <= 19, "Low Relevance").when(cls <= 49, "Non-Business").otherwise("Odd")
         ).alias("classification"),
        F.when(o % 17 != 0, F.concat(F.lit("Company "), o % 30)).alias("company"),
        ((o * 10 + n) * 100000 + p).alias("ord"))
    told = ["base", "number", "source_url", "type"]  # tested by filters, so computed before these
    return computed(rows, **{c: F.col(c) for c in told}).select(*rows.columns)


def entries(spark, sf) -> DataFrame:
    """Input rows with their crawl result, from customers. URLs and phones cost far more than
    reading the short rows, so these are dealt over all cores first."""
    c = F.col("c_custkey")
    k = (c % 997).cast("string")
    given = (F.when(c % 29 == 0, None)
             .when(c % 19 == 0, F.concat(F.lit("ftp://s"), k, F.lit(".example.com")))
             .when(c % 2 == 0, F.concat(F.lit("http://www.s"), k, F.lit(".example.com/start")))
             .otherwise(F.concat(F.lit("s"), k, F.lit(".example.com/start?b=2&a=1#x"))))
    rows = spread(table(spark, sf, "customer").select("c_custkey", "c_mktsegment")).select(
        c.alias("input_row_id"),
        F.when(c % 23 != 0, F.concat_ws(" ", "c_mktsegment", (c % 400).cast("string"))).alias("company_name"),
        given.alias("given_url"),
        (F.when(c % 5 == 0, None).when(c % 7 == 0, "invalid-number")
         .otherwise(F.concat(F.lit("0049 30 "), F.lpad((c * 13 % 2000).cast("string"), 7, "0")))
         ).alias("given_phone"),
        F.col("c_mktsegment").alias("description"), F.lit("['DE','AT','CH']").alias("target_countries"),
        F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, c_custkey)").alias("logged_at"))
    i = F.col("input_row_id")
    rows = computed(rows, clean_url=urls.clean_url(F.col("given_url"))).withColumn(
        "status", F.when(~urls.is_http(F.col("clean_url")), "InvalidURL")
        .when(i % 11 == 0, "DNSError").when(i % 13 == 0, "HTTPError_404")
        .when(i % 17 == 0, "HTTPError_403").when(i % 31 == 0, "TimeoutError")
        .when(i % 37 == 0, "RobotsDisallowed").when(i % 41 == 0, "Already_Processed")
        .when(i % 47 == 0, "MaxRedirects_InputURL").otherwise("Success"))
    none = (F.col("status").isin("InvalidURL", "MaxRedirects_InputURL")
            | (~F.col("status").isin("Success", "Already_Processed") & (i % 4 == 0)))
    other = i % 43 == 0
    # Inside a branch the long expression would run its common parts again for each use; a NULL costs nothing.
    rows = computed(rows, _same=urls.normalize_url(F.when(~(none | other), F.col("clean_url"))))
    landed = F.when(none, None).when(other, F.concat(F.lit("http://s"), (i % 997 + 1).cast("string"),
                                                     F.lit(".example.com/start"))).otherwise(F.col("_same"))
    rows = computed(rows, pathful_url=landed).drop("_same")
    return computed(rows, base=urls.base_domain(F.col("pathful_url")),
                    normalized_phone=phones.e164(F.col("given_phone"), "DE"))


def sites(rows: DataFrame, volume: DataFrame) -> DataFrame:
    """One row per entry page reached: status, pages, candidates, label facts.
    ``volume`` holds the item count ``n`` of each base."""
    reached = rows.filter(F.col("pathful_url").isNotNull()).groupBy("pathful_url", "base").agg(
        F.min("input_row_id").alias("ord"), F.min_by("status", "input_row_id").alias("first_status"))
    j = reached.join(volume, "base", "left")
    k = F.regexp_extract("base", r"//s([0-9]+)\.", 1).cast("bigint")
    ok = F.col("first_status").isin("Success", "Already_Processed")
    has = F.col("n").isNotNull()
    zero = F.lit(0).cast("bigint")
    failed = ok & ~has & (k % 8 == 2)
    return j.select(
        "pathful_url", "base", "ord", F.when(ok, "Success").otherwise(F.col("first_status")).alias("status"),
        F.when(~ok, 0).when(has, 3).when(k % 4 == 0, 0).otherwise(2).cast("bigint").alias("pages"),
        F.when(~ok, zero).when(has, F.col("n")).when(k % 4 >= 2, 5).otherwise(0).cast("bigint").alias("candidates"),
        (ok & (has | (k % 4 == 3) | (k % 8 == 2))).alias("label_called"),
        F.when(~ok, zero).when(has, F.col("n")).when(k % 8 == 7, 3).otherwise(0).cast("bigint").alias("raw_numbers"),
        F.when(failed, F.concat(F.lit("RuntimeError: quota "), k)).alias("error"))


def site_pages(all_sites: DataFrame) -> DataFrame:
    """Pages of the sites, with their type."""
    seen = all_sites.filter(F.col("pages") > 0).select(
        "base", F.explode(F.sequence(F.lit(1), F.col("pages").cast("int"))).alias("i"))
    return seen.select("base", F.concat("base", F.lit("/p"), "i").alias("page_url"),
                       case(F.col("i"), {1: "homepage", 2: "contact"}, "general_content").alias("page_type"))


def fetches(spark, sf) -> DataFrame:
    """Fetch log from the event stream."""
    e, i = F.col("event_type"), F.col("event_id")
    return table(spark, sf, "events").select(
        "event_id", "ts", F.col("user_id").alias("input_row_id"),
        (F.when(e == "error", -(1 + i % 8)).when(e == "click", 403 + i % 2)
         .when(e.isin("view", "purchase"), 200)).cast("int").alias("status_code"),
        e.isin("view", "purchase").alias("has_content"), "event_type", "value", "props")


def slots(spark, sf) -> DataFrame:
    """Request slots per order: one to three candidates."""
    o = F.col("o_orderkey")
    return (table(spark, sf, "orders")
            .select(o, "o_custkey", F.explode(F.sequence(F.lit(0), (o % 3).cast("int"))).alias("pos"))
            .select(F.concat(F.lit("o"), o).alias("request_id"), o.alias("order_id"), "pos",
                    F.concat(F.lit("+4930"), F.lpad(F.col("o_custkey").cast("string"), 6, "0"), "pos").alias("number"),
                    F.concat(F.lit("call us at "), o).alias("snippet"),
                    F.concat(F.lit("http://c"), F.col("o_custkey"), F.lit(".example.com/")).alias("source_url"),
                    F.concat(F.lit("C"), F.col("o_custkey")).alias("company")))


def _items_json(pick, number) -> Column:
    """JSON list of labelled slots; ``number`` maps a slot to the answered number."""
    one = lambda s: F.concat(
        F.lit('{"number": "'), number(s), F.lit('", "type": "Main Line", "classification": "Primary"}'))
    return F.concat(F.lit('{"extracted_numbers": ['),
                    F.array_join(F.transform(pick, one), ", "), F.lit("]}"))


def responses(spark, sf) -> DataFrame:
    """Responses to ``slots`` with every kind of defect, by order key."""
    per = slots(spark, sf).groupBy("request_id", "order_id").agg(
        F.array_sort(F.collect_list(F.struct("pos", "number"))).alias("s"))
    f = F.col("order_id") % 12
    same = lambda s: s["number"]
    odd_wrong = lambda s: F.when(s["pos"] % 2 == 0, F.concat(F.lit("X"), s["number"])).otherwise(s["number"])
    good = _items_json(F.col("s"), same)
    text = (F.when(f == 0, F.lit("")).when(f == 1, "sorry, nothing here")
            .when(f == 2, '{"extracted_numbers": [}').when(f == 3, "[1, 2]")
            .when(f == 4, '{"extracted_numbers": [{"number": "1", "classification": "Primary"}]}')
            .when(f == 5, _items_json(F.slice(F.col("s"), 2, 10), same))
            .when(f.isin(6, 7), _items_json(F.col("s"), odd_wrong))
            .when(f == 9, F.concat(F.lit("Here:\n```json\n"), good, F.lit("\n```\nbye")))
            .otherwise(good))
    n = F.size("s").cast("bigint")
    first = per.filter(f != 8).select(
        "request_id", F.lit(0).alias("attempt"), text.alias("raw_text"),
        (n * 100).alias("prompt_tokens"), (n * 30).alias("completion_tokens"), (n * 130).alias("total_tokens"))
    again = F.filter("s", lambda s: s["pos"] % 2 == 0)
    second = per.filter(f.isin(6, 7)).select(
        "request_id", F.lit(1).alias("attempt"),
        F.when(f == 6, _items_json(again, same)).otherwise(_items_json(again, odd_wrong)).alias("raw_text"),
        (n * 50).alias("prompt_tokens"), (n * 20).alias("completion_tokens"), (n * 70).alias("total_tokens"))
    return first.unionByName(second)
