"""Registered queries: input, predicates, URLs, page text, links, crawl."""

from __future__ import annotations

from pyspark.sql import functions as F

from callsheet import dims
from callsheet.functions import html, phones, text, urls
from callsheet.functions.regex import any_of
from callsheet.operators import crawl, duplicates, links as lk, suffixes
from callsheet.plans import bindings as b, sqltext as s
from callsheet.plans.registry import query
from callsheet.sources import tables

ROWS = "input_row_id, company_name, given_url, given_phone"


# --- sources -----------------------------------------------------------------------
def raw_input(spark, sf):
    """Company table with the source's own column names."""
    return b.input_rows(spark, sf).select(
        "input_row_id", F.col("company_name").alias("Unternehmen"), F.col("given_url").alias("Webseite"),
        F.col("given_phone").alias("Telefonnummer"))


@query("S2_read_table", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def _(spark, sf):
    return tables.read_parquet(spark, f"{sf}/customer.parquet").select("c_custkey", "c_name", "c_mktsegment")


@query("S3_profile_columns", s.with_(s.V_INPUT) + """
SELECT input_row_id, company_name AS "CompanyName", given_url AS "GivenURL",
       given_phone AS "GivenPhoneNumber" FROM v_input""")
def _(spark, sf):
    return tables.apply_profile(raw_input(spark, sf), "no_such_profile")


@query("S4_default_columns", s.with_(s.V_INPUT) + """
SELECT input_row_id, company_name AS "CompanyName", given_url AS "GivenURL", given_phone AS "GivenPhoneNumber",
  CAST(NULL AS VARCHAR) AS "Description", CAST(NULL AS VARCHAR) AS "NormalizedGivenPhoneNumber",
  'Pending' AS "ScrapingStatus", 'Pending' AS "Overall_VerificationStatus",
  'Pending' AS "Original_Number_Status", 'DE,AT,CH' AS "TargetCountryCodes", '20240101_000000' AS "RunID"
FROM v_input""")
def _(spark, sf):
    out = tables.with_defaults(tables.apply_profile(raw_input(spark, sf)), b.RUN_ID)
    return out.withColumn("TargetCountryCodes", F.array_join("TargetCountryCodes", ","))


@query("S5_row_range", "SELECT c_custkey, c_name FROM customer WHERE c_custkey >= 9 AND c_custkey < 1200")
def _(spark, sf):
    df = b.table(spark, sf, "customer").select("c_custkey", "c_name")
    return tables.row_range(df, "10-1200", "c_custkey")


def blank_rows(spark, sf):
    """Orders as input rows; some are blank, and late in the table three in a row are."""
    o = F.col("o_orderkey")
    gone = (o % 50 < 2) | ((o > 700) & (o % 90 < 4))
    return b.table(spark, sf, "orders").select(
        o.alias("input_row_id"), F.when(~gone, F.col("o_orderpriority")).otherwise("  ").alias("a"),
        F.when(~gone, F.col("o_orderstatus")).alias("b"))


BLANKS = """v_blank AS (SELECT o_orderkey AS input_row_id,
  (o_orderkey % 50 < 2) OR (o_orderkey > 700 AND o_orderkey % 90 < 4) AS gone,
  o_orderpriority AS a, o_orderstatus AS b FROM orders)"""


@query("S6_stop_after_blanks", s.with_(BLANKS) + """, runs AS (
  SELECT input_row_id, sum(gone::INT) OVER (ORDER BY input_row_id ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING) AS n
  FROM v_blank)
SELECT input_row_id, a, b FROM v_blank WHERE NOT gone AND input_row_id < coalesce(
  (SELECT min(input_row_id) FROM runs WHERE n = 3), 9223372036854775807)""")
def _(spark, sf):
    return tables.stop_after_blanks(blank_rows(spark, sf), ["a", "b"], 3)


@query("S7_blank_stop_off", s.with_(BLANKS) + """
SELECT input_row_id, CASE WHEN gone THEN '  ' ELSE a END AS a, CASE WHEN NOT gone THEN b END AS b FROM v_blank""")
def _(spark, sf):
    return tables.stop_after_blanks(blank_rows(spark, sf), ["a", "b"], 0)


@query("S8_page_store", "SELECT page_id, url, length(html) AS n_chars FROM pages")
def _(spark, sf):
    return tables.read_pages(spark, f"{sf}/pages.parquet").select(
        "page_id", "url", F.length("html").cast("bigint").alias("n_chars"))


# --- predicates ----------------------------------------------------------------------
@query("F1_blank_row", s.with_(BLANKS) + "SELECT input_row_id, gone AS is_blank FROM v_blank")
def _(spark, sf):
    return blank_rows(spark, sf).select("input_row_id", text.blank_row(F.col("a"), F.col("b")).alias("is_blank"))


@query("F2_valid_url", s.with_(s.V_ENTRIES) + """
SELECT input_row_id, clean_url, CASE WHEN clean_url LIKE 'http://%' THEN 'Pending' ELSE 'InvalidURL' END AS status
FROM v_entries0""")
def _(spark, sf):
    return b.entries(spark, sf).select(
        "input_row_id", "clean_url",
        F.when(urls.is_http(F.col("clean_url")), "Pending").otherwise("InvalidURL").alias("status"))


def digit_strings(spark, sf):
    """Digit strings of every kind: order keys, prices, repeated and running digits."""
    o = F.col("o_orderkey")
    digits = (F.when(o % 6 == 0, F.repeat((o % 10).cast("string"), (o % 9 + 1).cast("int")))
              .when(o % 6 == 1, F.concat(F.lit("000000"), o))
              .when(o % 6 == 2, F.concat(F.lit("123456"), o % 7))
              .when(o % 6 == 3, F.concat(o % 100, F.repeat((o % 10).cast("string"), (o % 7).cast("int")), o % 3))
              .when(o % 6 == 4, F.substring(F.lit("98765432100123456789"), (o % 13 + 1).cast("int"), F.lit(8)))
              .otherwise(F.concat(o * 7919, F.lit("x"))))
    return b.table(spark, sf, "orders").select(o.alias("id"), digits.alias("digits"))


DIGITS = """v_digits AS (SELECT o_orderkey AS id, CASE o_orderkey % 6
  WHEN 0 THEN repeat((o_orderkey % 10)::VARCHAR, (o_orderkey % 9 + 1)::INT)
  WHEN 1 THEN '000000' || o_orderkey WHEN 2 THEN '123456' || (o_orderkey % 7)
  WHEN 3 THEN (o_orderkey % 100) || repeat((o_orderkey % 10)::VARCHAR, (o_orderkey % 7)::INT) || (o_orderkey % 3)
  WHEN 4 THEN substr('98765432100123456789', (o_orderkey % 13 + 1)::INT, 8)
  ELSE (o_orderkey * 7919) || 'x' END AS digits FROM orders)"""
IS_PLACEHOLDER = """(digits LIKE '000000%' OR digits LIKE '123456%'
  OR (length(digits) > 5 AND length(list_distinct(string_split(digits, ''))) = 1))"""
HAS_REPEATS = "(" + " OR ".join(f"contains(digits, '{str(d) * 5}')" for d in range(10)) + ")"
HAS_SEQUENCE = """(regexp_matches(digits, '^[0-9]+$') AND (contains_run('0123456789') OR contains_run('9876543210')))"""
HAS_SEQUENCE = HAS_SEQUENCE.replace("contains_run('0123456789')", "(" + " OR ".join(
    f"contains(digits, substr('0123456789', {i}, 5))" for i in range(1, 7)) + ")").replace(
    "contains_run('9876543210')", "(" + " OR ".join(
        f"contains(digits, substr('9876543210', {i}, 5))" for i in range(1, 7)) + ")")

for _name, _fn, _sql in [
    ("F3_placeholder", phones.is_placeholder, IS_PLACEHOLDER),
    ("F4_too_short", phones.is_too_short, "(length(digits) < 7)"),
    ("F5_repeats", phones.has_repeats, HAS_REPEATS),
    ("F6_sequences", phones.has_sequence, HAS_SEQUENCE),
    ("F7_plausible", lambda c: phones.plausible(c, c),
     f"NOT ({IS_PLACEHOLDER} OR length(digits) < 7 OR {HAS_REPEATS} OR {HAS_SEQUENCE})"),
]:
    query(_name, s.with_(DIGITS) + f"SELECT id, digits, {_sql} AS flag FROM v_digits")(
        lambda spark, sf, _fn=_fn: digit_strings(spark, sf).select(
            "id", "digits", _fn(F.col("digits")).alias("flag")))


# --- URLs --------------------------------------------------------------------------------
def page_urls(spark, sf):
    return b.table(spark, sf, "pages").select("page_id", "url")


@query("U1_split_url", f"""SELECT page_id, {s.rx('url', '^([a-z]+):', 1)} AS scheme,
 {s.rx('url', '^[a-z]+://([^/?#]*)', 1)} AS authority, {s.rx('url', '^[a-z]+://[^/?#]*([^?#]*)', 1)} AS path,
 {s.rx('url', '[?]([^#]*)', 1)} AS query, {s.rx('url', '#(.*)$', 1)} AS fragment FROM pages""")
def _(spark, sf):
    return page_urls(spark, sf).select("page_id", urls.split_url(F.col("url")).alias("u")).select(
        "page_id", "u.scheme", "u.authority", "u.path", "u.query", "u.fragment")


@query("U2_normalize_url", s.with_(s.V_NORM) + "SELECT page_id, url_norm FROM v_norm")
def _(spark, sf):
    return page_urls(spark, sf).select("page_id", urls.normalize_url(F.col("url")).alias("url_norm"))


@query("U3_base_domain", f"""SELECT page_id,
 {s.rr("regexp_extract(url, '^https?://[^/?#]+')", '://www[.]', '://')} AS base FROM pages""")
def _(spark, sf):
    return page_urls(spark, sf).select("page_id", urls.base_domain(F.col("url")).alias("base"))


@query("U4_input_host", s.with_(s.V_ENTRIES) + """
SELECT input_row_id, nullif(regexp_replace(regexp_extract(clean_url, '^[a-z]+://([^/?#]*)', 1), '^www[.]', ''), '') AS host
FROM v_entries0""")
def _(spark, sf):
    return b.entries(spark, sf).select("input_row_id", urls.input_host(F.col("given_url")).alias("host"))


def typed_urls(spark, sf):
    """URLs as people type them: blanks, umlauts, no scheme."""
    i = F.col("page_id")
    tail = F.regexp_extract("url", r"^https?://(.*)$", 1)
    typed = (F.when(i % 4 == 0, F.concat(F.lit("  "), tail, F.lit("/ü b")))
             .when(i % 4 == 1, F.concat(F.lit("http://x y"), i, F.lit(".de/a%20b?q=a b&c=é#f g")))
             .when(i % 4 == 2, F.concat(F.lit("seite"), i, F.lit(".de")))
             .otherwise(F.col("url")))
    return b.table(spark, sf, "pages").select(i.alias("input_row_id"), typed.alias("given_url"))


@query("U5_clean_url", f"""
SELECT page_id AS input_row_id, CASE page_id % 4
  WHEN 0 THEN {s.rr("u0", "^(http://[^/?#]*)([?#].*)?$", r"\1/\2")}
  WHEN 1 THEN 'http://xy' || page_id || '.de/a%20b?q=a%20b&c=%C3%A9#f%20g'
  WHEN 2 THEN 'http://seite' || page_id || '.de/' ELSE {s.rr("url", "^(https?://[^/?#]*)([?#].*)?$", r"\1/\2")} END AS clean_url
FROM (SELECT *, 'http://' || regexp_extract(url, '^https?://(.*)$', 1) ||
        CASE WHEN contains(url, '#') THEN '/%C3%BC%20b' WHEN contains(url, '?') THEN '/%C3%BC%20b' ELSE '/%C3%BC%20b' END AS u0
      FROM pages)""")
def _(spark, sf):
    return typed_urls(spark, sf).select("input_row_id", urls.clean_url(F.col("given_url")).alias("clean_url"))


def bare_hosts(spark, sf):
    label = b.host_label(F.col("url"))
    rows = b.table(spark, sf, "pages").select(
        F.col("page_id").alias("input_row_id"),
        F.when(F.col("page_id") % 6 == 0, F.col("url")).when(F.col("page_id") % 6 == 1, "http://localhost/x")
        .when(F.col("page_id") % 6 == 2, "http://10.0.0.1/").otherwise(
            F.concat(F.lit("http://"), label, F.lit("/x?y=1"))).alias("url"))
    names = b.table(spark, sf, "pages").select(label.alias("l"), F.length(label).alias("n")).distinct()
    known = names.select(F.explode(F.array_compact(F.array(
        F.when(F.col("n") % 3 == 0, F.concat("l", F.lit(".de"))),
        F.when(F.col("n") % 2 == 0, F.concat("l", F.lit(".com"))),
        F.when(F.col("n") % 5 == 0, F.concat("l", F.lit(".at")))))).alias("host"))
    return rows, known


LABEL = f"split_part({s.INPUT_HOST}, '.', 1)"


@query("U6_probe_tlds", f"""SELECT page_id AS input_row_id, CASE page_id % 6 WHEN 0 THEN url WHEN 1 THEN 'http://localhost/x'
 WHEN 2 THEN 'http://10.0.0.1/' ELSE 'http://' || l || CASE WHEN length(l) % 3 = 0 THEN '.de'
   WHEN length(l) % 2 = 0 THEN '.com' WHEN length(l) % 5 = 0 THEN '.at' ELSE '' END || '/x?y=1' END AS probed_url
FROM (SELECT *, {LABEL} AS l FROM pages)""")
def _(spark, sf):
    rows, known = bare_hosts(spark, sf)
    return crawl.probe_tlds(rows, known).select("input_row_id", "probed_url")


def dns_fetches(spark, sf):
    label = F.translate(b.host_label(F.col("url")), "-", "")
    rows = b.table(spark, sf, "pages").select(
        F.col("page_id").alias("input_row_id"), label.alias("l"),
        F.concat(F.lit("http://"), label, F.lit("-shop.de/")).alias("url"))
    n = F.length("l")
    row = lambda tail, code: F.struct(F.concat(F.lit("http://"), "l", F.lit(tail)).alias("url"),
                                      code.cast("int").alias("status_code"))
    dead = F.lit(-2)
    log = rows.select("l").distinct().select(F.inline(F.array(
        row("-shop.de/", F.when(n % 7 == 0, F.lit(200)).otherwise(dead)),
        row(".de/", F.when(n % 2 == 0, F.lit(200)).otherwise(dead)),
        row("-shop.com/", F.when(n % 3 == 0, F.lit(403)).otherwise(dead)),
        row(".com/", F.when(n % 5 == 0, F.lit(200)).otherwise(dead)))))
    return rows, log.withColumn("has_content", F.col("status_code") == 200)


@query("U7_dns_variants", f"""SELECT page_id AS input_row_id, 4::BIGINT AS variants,
  'http://' || l || CASE v WHEN 0 THEN '-shop.de/' WHEN 1 THEN '.de/' WHEN 2 THEN '-shop.com/' ELSE '.com/' END AS entry_url,
  v AS variant, CASE WHEN n % 7 = 0 OR n % 2 = 0 THEN 'Success' WHEN n % 3 = 0 THEN 'HTTPError_403'
    WHEN n % 5 = 0 THEN 'Success' ELSE 'DNSError' END AS status
FROM (SELECT *, length(l) AS n, CASE WHEN length(l) % 7 = 0 THEN 0 WHEN length(l) % 2 = 0 THEN 1
   WHEN length(l) % 3 = 0 THEN 2 ELSE 3 END AS v FROM (SELECT *, replace({LABEL}, '-', '') AS l FROM pages))""")
def _(spark, sf):
    rows, log = dns_fetches(spark, sf)
    return crawl.first_resolving_entry(rows, log)


SUFFIX_RULES = ["com", "de", "uk", "co.uk", "ac.uk", "jp", "co.jp", "*.kobe.jp", "!city.kobe.jp", "*.ck", "!www.ck", "k12.ma.us", "us", "ma.us"]
#: Host endings, dealt out by supplier key.
ENDINGS = ["shop-{0}.de", "a.b-{0}.co.uk", "x{0}.kobe.jp", "y.x{0}.kobe.jp", "city.kobe.jp", "www.city.kobe.jp", "z{0}.ck", "w.z{0}.ck", "www.ck",
           "v.www.ck", "s{0}.k12.ma.us", "t{0}.museum", "u{0}.Co.Uk", "ck", "co.jp", "m.n{0}.co.jp.", "{0}.ac.uk", "q-{0}.ma.us"]


def suffix_hosts(spark, sf):
    k = F.col("s_suppkey")
    host = b.case(k % len(ENDINGS), {i: F.format_string(e.format("%1$s"), k.cast("string")) if "{0}" in e else e for i, e in enumerate(ENDINGS)})
    return b.table(spark, sf, "supplier").select("s_suppkey", host.alias("host"))


HOSTS_SQL = "CASE s_suppkey % {} {} END".format(len(ENDINGS), " ".join(
    f"WHEN {i} THEN replace('{e}', '{{0}}', s_suppkey::VARCHAR)" for i, e in enumerate(ENDINGS)))
V_SUFFIX = f"""v_hosts AS (SELECT s_suppkey, host, string_split(rtrim(lower(host), '.'), '.') AS l FROM (SELECT s_suppkey, {HOSTS_SQL} AS host FROM supplier)),
v_rules AS (SELECT rule, string_split(ltrim(rule, '!'), '.') AS r FROM (SELECT unnest({SUFFIX_RULES}) AS rule)),
v_met AS (SELECT s_suppkey, max(CASE WHEN rule[1] = '!' THEN len(r) - 1 END) AS less, max(len(r)) AS most FROM v_hosts JOIN v_rules
  ON len(l) >= len(r) AND list_bool_and(list_transform(list_zip(l[len(l) - len(r) + 1:], r), lambda z: z[2] = '*' OR z[1] = z[2])) GROUP BY s_suppkey),
v_suffix AS (SELECT h.s_suppkey, host, array_to_string(l[len(l) - n + 1:], '.') AS suffix, CASE WHEN len(l) > n THEN l[len(l) - n] END AS label
  FROM (SELECT h.*, coalesce(less, most, 1) AS n FROM v_hosts h LEFT JOIN v_met USING (s_suppkey)) h)"""


@query("U7_public_suffixes", f"WITH {V_SUFFIX} SELECT * FROM v_suffix")
def _(spark, sf):
    hosts = suffix_hosts(spark, sf)
    rules = spark.createDataFrame([(r,) for r in SUFFIX_RULES], "rule string")
    return hosts.join(suffixes.public_suffixes(hosts, rules), "host")


@query("U7_variants_by_rules", f"""WITH {V_SUFFIX}, v AS (SELECT *, split_part(label, '-', 1) AS short, contains(label, '-') AS hyphen FROM v_suffix)
SELECT s_suppkey AS input_row_id, try_url FROM (SELECT s_suppkey, unnest(list_distinct(list_filter(['http://' || host || '/',
  CASE WHEN hyphen AND short <> '' THEN 'http://' || short || '.' || suffix || '/' END, CASE WHEN suffix = 'de' THEN 'http://' || label || '.com/' END,
  CASE WHEN hyphen AND short <> '' AND suffix = 'de' THEN 'http://' || short || '.com/' END], lambda x: x IS NOT NULL))) AS try_url FROM v)""")
def _(spark, sf):
    rows = suffix_hosts(spark, sf).select(F.col("s_suppkey").alias("input_row_id"), F.concat(F.lit("http://"), "host", F.lit("/")).alias("url"))
    rules = spark.createDataFrame([(r,) for r in SUFFIX_RULES], "rule string")
    return suffixes.entry_variants(rows, rules).select("input_row_id", "try_url")


@query("U8_source_path", f"""SELECT page_id, CASE WHEN p = '' THEN '/' ELSE p END AS source_path FROM (
  SELECT page_id, regexp_replace(regexp_extract(url, '^https?://[^/?#]*([^#]*)', 1), '[?]$', '') AS p FROM pages)""")
def _(spark, sf):
    return page_urls(spark, sf).select("page_id", urls.source_path(F.col("url")).alias("source_path"))


def typed_pages(spark, sf):
    """Page URLs with a type word in path or host, by page id."""
    word = b.case(F.col("page_id") % 8, {0: "/Kontakt", 1: "/legal-notice", 2: "/datenschutz", 3: "/agb/x",
                                         4: "/Ansprechpartner/impressum"}, "")
    host = F.when(F.col("page_id") % 8 == 5, "http://kontakt.").when(F.col("page_id") % 8 == 6, "http://imprint."
                                                                     ).otherwise("http://")
    root = F.regexp_extract("url", r"^https?://([^/?#]*)", 1)
    return b.table(spark, sf, "pages").select("page_id", F.concat(
        host, root, F.when(F.col("page_id") % 16 == 7, "/").otherwise(word)).alias("url"))


@query("U9_page_type", """SELECT page_id, CASE page_id % 8 WHEN 0 THEN 'contact' WHEN 1 THEN 'imprint'
 WHEN 2 THEN 'legal' WHEN 3 THEN 'legal' WHEN 4 THEN 'contact' WHEN 5 THEN 'contact' WHEN 6 THEN 'imprint'
 ELSE 'homepage' END AS page_type FROM pages""")
def _(spark, sf):
    return typed_pages(spark, sf).select("page_id", urls.page_type(F.col("url")).alias("page_type"))


@query("U10_domain_label", f"""SELECT page_id, CASE
  WHEN page_id % 5 = 4 THEN NULL WHEN page_id % 5 = 3 THEN 'firm' || page_id
  WHEN page_id % 5 = 2 THEN {LABEL}
  WHEN host LIKE '%.com' OR host LIKE '%.org' OR host LIKE '%.net' THEN list_extract(string_split(host, '.'), -2)
  ELSE split_part(host, '.', 1) END AS label
FROM (SELECT *, regexp_replace(regexp_extract(url, '^https?://([^/?#]*)', 1), '^www[.]', '') AS host FROM pages)""")
def _(spark, sf):
    i = F.col("page_id")
    name = (F.when(i % 5 == 4, F.concat(F.lit("Company "), i))
            .when(i % 5 == 3, F.concat(F.lit("firm"), i, F.lit(".co.uk")))
            .when(i % 5 == 2, F.concat(F.lit("https://"), b.host_label(F.col("url")), F.lit(".test.fr - X")))
            .otherwise(F.concat(F.col("url"), F.lit(" - Name"))))
    return b.table(spark, sf, "pages").select(i, urls.domain_label(name).alias("label"))


@query("U11_content_address", """SELECT page_id, left(regexp_replace(regexp_replace(
  regexp_extract(url, '^https?://([^/?#]*)', 1), '^www[.]', ''), '[^A-Za-z0-9_-]', '', 'g'), 15)
  || '_' || left(sha256(url), 16) AS address FROM pages""")
def _(spark, sf):
    return page_urls(spark, sf).select("page_id", urls.content_address(F.col("url")).alias("address"))


@query("U12_safe_name", """SELECT page_id, left(regexp_replace(regexp_replace(url, '^https?://', ''),
  '[^A-Za-z0-9_.-]', '_', 'g'), 25) AS safe_name, left(regexp_replace(regexp_replace(url, 'https?://', ''),
  '[^A-Za-z0-9]', '_', 'g'), 100) AS archive_name FROM pages""")
def _(spark, sf):
    return page_urls(spark, sf).select("page_id", urls.safe_name(F.col("url"), 25).alias("safe_name"),
                                       urls.archive_name(F.col("url")).alias("archive_name"))


@query("U13_redirect_prefix", s.with_(s.V_ENTRIES) + """
SELECT input_row_id, CASE WHEN regexp_replace(regexp_extract(clean_url, '^http://[^/?#]*'), '//www[.]', '//') <> base
    AND clean_url LIKE 'http%' AND base IS NOT NULL
  THEN 'RedirectedTo[' || base || ']_' || status ELSE status END AS status FROM v_entries""")
def _(spark, sf):
    return b.entries(spark, sf).select("input_row_id", urls.with_redirect_prefix(
        F.col("status"), urls.base_domain(F.col("given_url")), F.col("base")).alias("status"))


# --- pages and links -------------------------------------------------------------------------
@query("H1_html_text", s.with_(s.V_PAGE) + "SELECT page_id, text FROM v_page")
def _(spark, sf):
    return b.page_texts(spark, sf).select("page_id", "text")


# Pieces from one opening tag to the next, each cut behind its end tag.
TAGS = f"""list_filter(list_transform(string_split(regexp_replace({s.hidden('html')}, '(?i)(<a\\b[^>]*>)', chr(1) || '\\1', 'g'),
  chr(1))[2:], lambda p: regexp_extract(p, '(?is)^<a\\b[^>]*>.*?(?:</a\\s*>|$)')), lambda p: p <> '')"""

V_ANCHOR = f"""{s.V_NORM}, v_tag AS (
  SELECT page_id, url_norm AS page_url, u_scheme, u_host,
    unnest(range(len(tags))) AS link_ord, unnest(tags) AS tag
  FROM (SELECT *, {TAGS} AS tags FROM v_norm)),
v_anchor AS (
  SELECT page_id, page_url, u_scheme, u_host, link_ord::INT AS link_ord,
    {s.strip(s.decode(s.rx('tag', r'(?is)href="([^"]*)"', 1)))} AS href,
    lower({s.strip(s.decode(s.rr('tag', r'(?s)<[^>]*>', '')))}) AS link_text FROM v_tag)"""


@query("H2_anchors", s.with_(V_ANCHOR) + "SELECT page_id, link_ord, href, link_text FROM v_anchor WHERE href <> ''")
def _(spark, sf):
    return lk.extract_anchors(b.pages_html(spark, sf)).select("page_id", "link_ord", "href", "link_text")


# Every anchor of the page table is root-relative.
V_LINK = V_ANCHOR + """, v_resolved AS (
  SELECT *, u_scheme || '://' || u_host || CASE WHEN href <> '/' AND href LIKE '%/' THEN left(href, length(href) - 1)
    ELSE href END AS link_url, lower(href) AS path FROM v_anchor WHERE href <> '')"""


@query("H3_resolve_links", s.with_(V_LINK) + "SELECT page_id, link_ord, link_url FROM v_resolved")
def _(spark, sf):
    return lk.resolve_links(lk.extract_anchors(b.pages_html(spark, sf))).select("page_id", "link_ord", "link_url")


@query("H4_internal_links", s.with_(V_LINK) + "SELECT page_id, link_ord, link_url FROM v_resolved")
def _(spark, sf):
    return lk.internal_links(lk.resolve_links(lk.extract_anchors(b.pages_html(spark, sf)))).select(
        "page_id", "link_ord", "link_url")


TARGET = "(?:" + "|".join(b.RULES.target) + ")"


def _gated(spark, sf):
    found = lk.internal_links(lk.resolve_links(lk.extract_anchors(b.pages_html(spark, sf))))
    return found.filter(lk.keyword_gate(F.col("link_text"), F.col("link_url"), b.RULES))


GATE = f"({s.like('link_text', TARGET)} OR {s.like('lower(link_url)', TARGET)})"


@query("H5_keyword_gate", s.with_(V_LINK) + f"SELECT page_id, link_ord, link_url FROM v_resolved WHERE {GATE}")
def _(spark, sf):
    return _gated(spark, sf).select("page_id", "link_ord", "link_url")


@query("H6_excluded_paths", s.with_(V_LINK) + f"""
SELECT page_id, link_ord, link_url FROM v_resolved WHERE {GATE} AND NOT contains(path, '/attion')""")
def _(spark, sf):
    return _gated(spark, sf).filter(~lk.excluded_path(F.col("link_url"), b.RULES)).select(
        "page_id", "link_ord", "link_url")


V_SCORED = V_LINK + f""", v_scored AS (
  SELECT page_id, page_url, link_ord, link_url, link_text, CASE WHEN path IN ('/the', '/la') THEN 100
    WHEN path IN ('/and', '/que') THEN 90 WHEN {s.like('path', TARGET)} THEN 50
    WHEN {s.like('link_text', TARGET)} THEN 40 ELSE 0 END AS score
  FROM v_resolved WHERE {GATE} AND NOT contains(path, '/attion'))"""


@query("H7_link_scores", s.with_(V_SCORED) + """
SELECT page_id, link_ord, link_url, link_text, score FROM v_scored WHERE score >= 40""")
def _(spark, sf):
    return b.links(spark, sf).select("page_id", "link_ord", "link_url", "link_text", "score")


V_FRONTIER = V_SCORED + """, v_frontier AS (
  SELECT page_url AS entry_url, link_url, arg_min(score, link_ord) AS score, min(link_ord) AS link_ord
  FROM v_scored WHERE score >= 40 GROUP BY ALL)"""


@query("H8_frontier", s.with_(V_FRONTIER) + "SELECT * FROM v_frontier")
def _(spark, sf):
    return crawl.frontier(b.links(spark, sf).withColumnRenamed("page_url", "entry_url"))


def _queue(spark, sf):
    """All links found on a host, as the queue of that host."""
    found = b.links(spark, sf).withColumn("site", urls.base_domain(F.col("page_url")))
    return found.groupBy("site", "link_url").agg(
        F.min(F.struct(F.col("page_id").alias("p"), "link_ord", "score")).alias("f")).select(
        "site", "link_url", F.col("f.score").alias("score"),
        (F.col("f.p") * 1000 + F.col("f.link_ord")).alias("link_ord"), F.lit(1).alias("depth"))


V_QUEUE = V_SCORED + """, v_queue AS (
  SELECT regexp_extract(page_url, '^https?://[^/]*') AS site, link_url, arg_min(score, page_id * 1000 + link_ord) AS score,
    min(page_id * 1000 + link_ord) AS link_ord FROM v_scored WHERE score >= 40 GROUP BY ALL),
v_budget AS (SELECT *, row_number() OVER (PARTITION BY site ORDER BY score DESC, link_ord) AS visit FROM v_queue)"""


@query("H9_page_budget", s.with_(V_QUEUE) + """
SELECT site, link_url, score, visit::INT AS visit FROM v_budget
WHERE visit <= 4 OR (score >= 80 AND visit <= 6)""")
def _(spark, sf):
    return crawl.page_budget(_queue(spark, sf), "site", max_pages=4, bypass_score=80, bypass_pages=2).select(
        "site", "link_url", "score", "visit")


@query("H10_first_visits", s.with_(V_SCORED) + """
SELECT link_url, min(page_id * 1000 + link_ord) AS first_seen FROM v_scored WHERE score >= 40 GROUP BY 1""")
def _(spark, sf):
    return crawl.first_visits(b.links(spark, sf), "link_url", ["page_id", "link_ord"]).select(
        "link_url", (F.col("page_id") * 1000 + F.col("link_ord")).alias("first_seen"))


def robots_rules(spark, sf):
    hosts = b.table(spark, sf, "pages").select(urls.input_host(F.col("url")).alias("host")).distinct()
    row = lambda o, p, a, ua="*": F.struct(F.lit(ua).alias("ua"), F.lit(o).alias("rule_ord"),
                                           F.lit(p).alias("prefix"), F.lit(a).alias("allow"))
    return hosts.filter(F.length("host") % 3 == 0).select("host", F.inline(F.array(
        row(0, "/en/7", True), row(1, "/en/", False), row(2, "/fr", False), row(3, "", False),
        row(0, "/", False, "other-agent"))))


@query("H11_robots", s.with_(s.V_NORM) + """
SELECT page_id AS input_row_id, url_norm AS entry_url, NOT (length(u_host) % 3 = 0 AND (
  (u_path LIKE '/en/%' AND u_path NOT LIKE '/en/7%') OR u_path LIKE '/fr%')) AS allowed FROM v_norm""")
def _(spark, sf):
    rows = b.pages_html(spark, sf).select(F.col("page_id").alias("input_row_id"),
                                          F.col("page_url").alias("entry_url"))
    return crawl.robots_admission(rows, robots_rules(spark, sf))


STATUS_SQL = """CASE WHEN has_content THEN 'Success' WHEN status_code IS NULL THEN 'NoStatusFromServer'
  WHEN status_code > 0 THEN 'HTTPError_' || status_code ELSE coalesce(list_extract(['TimeoutError', 'DNSError',
    'ConnectionRefused', 'PlaywrightError', 'GenericScrapeError', 'RequestAborted'], -status_code), 'UnknownScrapeErrorCode') END"""


@query("H12_fetch_status", s.with_(s.V_FETCH) + f"""
SELECT event_id, {STATUS_SQL} AS status FROM v_fetch""")
def _(spark, sf):
    return b.fetches(spark, sf).select("event_id", crawl.fetch_status(
        F.col("status_code"), F.col("has_content"), entry=True).alias("status"))


def stored_web(spark, sf):
    """Entries and fetches: page rows, and the links found on them as further URLs."""
    pages = b.pages_html(spark, sf)
    dead = (F.col("page_id") % 9 == 0) | (F.col("page_id") % 14 == 0)
    own = pages.groupBy("page_url").agg(F.min(F.struct("page_id", "html")).alias("p")).select(
        "page_url", F.col("p.page_id").alias("page_id"), F.col("p.html").alias("html"))
    main = own.select(
        F.col("page_url").alias("url"),
        F.when(F.col("page_id") % 9 == 0, 404).when(F.col("page_id") % 14 == 0, -1).otherwise(200).alias("status_code"),
        F.col("page_url").alias("landed_url"), F.when(~dead, F.col("html")).alias("html"))
    n = F.length("link_url")
    child = b.links(spark, sf).select("link_url").distinct().join(
        own.select(F.col("page_url").alias("link_url")), "link_url", "left_anti").select(
        F.col("link_url").alias("url"), F.when(n % 7 == 0, 404).otherwise(200).alias("status_code"),
        F.when(n % 5 == 0, F.concat(F.regexp_extract("link_url", "^https?://[^/]*", 0), F.lit("/"))
               ).otherwise(F.col("link_url")).alias("landed_url"),
        F.when(n % 7 != 0, "<p>page</p>").alias("html"))
    rows = pages.select(F.col("page_id").alias("input_row_id"), F.col("page_url").alias("entry_url"))
    return rows, main.unionByName(child)


V_CRAWL = V_FRONTIER + """, v_entry AS (
  SELECT page_id AS input_row_id, url_norm AS entry_url,
    CASE WHEN min(page_id) OVER (PARTITION BY url_norm) % 9 = 0 THEN 404
         WHEN min(page_id) OVER (PARTITION BY url_norm) % 14 = 0 THEN -1 ELSE 200 END AS code FROM v_norm),
v_hit AS (
  SELECT input_row_id, entry_url AS landed_url, 0 AS depth, 100 AS score, 0 AS link_ord FROM v_entry WHERE code = 200
  UNION ALL
  SELECT input_row_id, CASE WHEN length(link_url) % 5 = 0 AND link_url NOT IN (SELECT url_norm FROM v_norm)
      THEN regexp_extract(link_url, '^https?://[^/]*') || '/' ELSE link_url END, 1, score, link_ord
  FROM v_entry e JOIN v_frontier f ON e.entry_url = f.entry_url
  WHERE code = 200 AND link_url <> e.entry_url AND (
    (link_url NOT IN (SELECT url_norm FROM v_norm) AND length(link_url) % 7 <> 0)
    OR link_url IN (SELECT entry_url FROM v_entry WHERE code = 200))),
v_kept AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY input_row_id, depth ORDER BY score DESC, link_ord) + depth AS visit
    FROM v_hit) WHERE visit <= 4 OR (score >= 80 AND visit <= 6)),
v_first AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY landed_url ORDER BY input_row_id, depth, score DESC, link_ord) AS n
    FROM v_kept) WHERE n = 1)"""


@query("H8_crawl_pages", s.with_(V_CRAWL) + "SELECT input_row_id, landed_url, depth, score FROM v_first")
def _(spark, sf):
    rows, log = stored_web(spark, sf)
    pages, _ = crawl.crawl_stored(rows, log, b.RULES, max_pages=4, bypass_pages=2)
    return pages.select("input_row_id", "landed_url", "depth", "score")


@query("H13_entry_outcomes", s.with_(V_CRAWL) + """, v_pages AS (
  SELECT input_row_id, count(*) AS pages FROM v_first GROUP BY 1)
SELECT e.input_row_id, coalesce(pages, 0) AS pages, CASE WHEN pages > 0 THEN 'Success'
  WHEN code = 200 THEN 'Already_Processed' WHEN code = 404 THEN 'HTTPError_404' ELSE 'TimeoutError' END AS status
FROM v_entry e LEFT JOIN v_pages p ON e.input_row_id = p.input_row_id""")
def _(spark, sf):
    rows, log = stored_web(spark, sf)
    _, outcomes = crawl.crawl_stored(rows, log, b.RULES, max_pages=4, bypass_pages=2)
    return outcomes.select("input_row_id", "pages", "status")
