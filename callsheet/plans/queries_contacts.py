"""Registered queries: phones, candidates, label exchange, consolidation."""

from __future__ import annotations

from pyspark.sql import functions as F

from callsheet import dims
from callsheet.functions import phones, text
from callsheet.functions.stages import computed
from callsheet.operators import candidates as cd, contacts as ct, labels as lb, reports as rp
from callsheet.operators.paging import paged, with_pages
from callsheet.plans import bindings as b, sqltext as s
from callsheet.plans.registry import query
from callsheet.sources import sinks

# --- phone numbers --------------------------------------------------------------------
# Runs of digits with their neighbours, by splitting the text at marked runs.
V_RUN = f"""{s.V_TEXT}, v_marked AS (
  SELECT base, page_url, company, page_type, page_ord, text,
    string_split(regexp_replace(translate(text, chr(1) || chr(2), '  '), {s.lit('(' + phones.RUN + ')')},
      chr(1) || '\\1' || chr(2), 'g'), chr(1)) AS p
  FROM v_text WHERE {s.like('text', phones.RUN)}),
v_run AS (
  SELECT * EXCLUDE (p, piece, prev), split_part(piece, chr(2), 1) AS raw, right(prev, 1) AS before,
    left(split_part(piece, chr(2), 2), 1) AS after
  FROM (SELECT base, page_url, company, page_type, page_ord, text, p, unnest(p[2:]) AS piece,
          unnest(p[:-2]) AS prev, unnest(range(len(p) - 1)) AS match_ord,
          unnest(list_transform(range(1, len(p)), lambda i: list_sum(list_transform(p[1:i],
            lambda x: length(replace(x, chr(2), ''))))::BIGINT)) AS match_start FROM v_marked)),
v_read AS (
  SELECT *, regexp_replace(raw, '[^+0-9]', '', 'g') AS d,
    match_start + length(raw) AS match_end FROM v_run
  WHERE NOT {s.like('raw', phones.IPV4)} AND (left(raw, 1) IN ('+', '(') OR NOT {s.like('before', phones.BLOCKED)})
    AND NOT {s.like('after', phones.BLOCKED)}),
v_match AS (
  SELECT * EXCLUDE (d, f), '+' || f AS number, regexp_replace(f, '^{phones.DIAL_CODES}0*', '') AS digits FROM (
    SELECT *, {s.rr("CASE WHEN d LIKE '+%' THEN substr(d, 2) WHEN d LIKE '011%' THEN substr(d, 4) WHEN d LIKE '1%' THEN d ELSE '1' || d END", phones.TRUNK_ZERO, chr(92) + '1')} AS f
    FROM v_read) WHERE {s.like('f', phones.VALID)})"""


@query("P1_find_phones", s.with_(V_RUN) + "SELECT page_url, match_ord, raw, number FROM v_match")
def _(spark, sf):
    return cd.phone_matches(b.texts(spark, sf)).select("page_url", "match_ord", "raw", "number")


E164_DE = """CASE WHEN page_id % 5 = 0 THEN NULL WHEN page_id % 7 = 0 THEN 'InvalidFormat'
  WHEN page_id % 3 = 0 THEN %s WHEN page_id % 3 = 1 THEN '+4989' || (300000 + page_id * 11) ELSE %s END"""


@query("P2_e164", "SELECT page_id AS input_row_id, " + E164_DE.replace("%s", "'+4930' || (200000 + page_id * 7)", 1).replace(
    "%s", "'+4944668' || (10 + page_id % 90) || (10 + page_id % 80)", 1) + " AS number FROM pages")
def _(spark, sf):
    return b.input_rows(spark, sf).select("input_row_id", phones.e164(F.col("given_phone"), "DE").alias("number"))


@query("P3_e164_by_hint", "SELECT page_id AS input_row_id, " + E164_DE.replace(
    "%s", "CASE WHEN page_id % 4 = 3 THEN 'InvalidFormat' ELSE '+4930' || (200000 + page_id * 7) END", 1).replace(
    "%s", """CASE page_id % 4 WHEN 0 THEN '+4944668' WHEN 1 THEN '+4144668' WHEN 2 THEN '+4344668'
      ELSE '' END || CASE WHEN page_id % 4 = 3 THEN 'InvalidFormat' ELSE (10 + page_id % 90) || '' || (10 + page_id % 80) END""", 1)
    + " AS number FROM pages")
def _(spark, sf):
    return b.input_rows(spark, sf).select(
        "input_row_id", phones.e164(F.col("given_phone"), F.col("region")).alias("number"))


@query("P4_e164_any", "SELECT page_id AS input_row_id, " + E164_DE.replace("'InvalidFormat'", "'invalid-number'").replace(
    "%s", "'+4930' || (200000 + page_id * 7)", 1).replace(
    "%s", "'+4944668' || (10 + page_id % 90) || (10 + page_id % 80)", 1) + " AS number FROM pages")
def _(spark, sf):
    return b.input_rows(spark, sf).select("input_row_id", phones.e164_any(F.col("given_phone")).alias("number"))


@query("F8_target_country", s.with_(V_RUN) + """
SELECT page_url, match_ord, (number LIKE '+49%' OR number LIKE '+43%' OR (number LIKE '+41%')) AS in_target FROM v_match""")
def _(spark, sf):
    return cd.phone_matches(b.texts(spark, sf)).select(
        "page_url", "match_ord", phones.is_target_country(F.col("number")).alias("in_target"))


@query("P5_match_offsets", s.with_(V_RUN) + "SELECT page_url, match_ord, match_start, match_end FROM v_match")
def _(spark, sf):
    return cd.phone_matches(b.texts(spark, sf)).select("page_url", "match_ord", "match_start", "match_end")


V_SNIPPET = V_RUN + f""", v_window AS (
  SELECT *, greatest(match_start - 150, 0) AS f0, least(length(text), match_end + 150) AS l0 FROM v_match),
v_cut AS (
  SELECT *, CASE WHEN contains(left(text, f0), ' ') THEN f0 - instr(reverse(left(text, f0)), ' ') + 1 ELSE f0 END AS f1,
    CASE WHEN l0 < length(text) AND instr(substr(text, l0 + 1), ' ') > 0 THEN l0 + instr(substr(text, l0 + 1), ' ') - 1
         ELSE l0 END AS l1 FROM v_window),
v_snippet AS (SELECT *, {s.strip('substr(text, f1 + 1, l1 - f1)')} AS snippet FROM v_cut)"""


@query("P6_snippets", s.with_(V_SNIPPET) + "SELECT page_url, match_ord, snippet FROM v_snippet")
def _(spark, sf):
    return cd.phone_matches(b.texts(spark, sf), window=300).select("page_url", "match_ord", "snippet")


def _plausible_sql(raw: str, nsn: str) -> str:
    from callsheet.plans.queries_urls import HAS_REPEATS, HAS_SEQUENCE, IS_PLACEHOLDER

    of = lambda t, c: t.replace("digits", c)
    return (f"NOT ({of(IS_PLACEHOLDER, raw)} OR {of(IS_PLACEHOLDER, nsn)} OR length({nsn}) < 7 "
            f"OR {of(HAS_REPEATS, nsn)} OR {of(HAS_SEQUENCE, nsn)})")


V_CAND = V_SNIPPET + f""", v_cand AS (
  SELECT base, page_url, company, page_type, page_ord, match_ord, raw, number, snippet
  FROM v_snippet WHERE {_plausible_sql('raw', 'digits')}),
v_capped AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY page_url, number ORDER BY match_ord) AS rn FROM v_cand)
  WHERE rn <= 3)"""


@query("P1_neighbouring_numbers", """SELECT o_orderkey, unnest(CASE o_orderkey % 4 WHEN 1 THEN ['+4930' || a, '+431' || b]
    ELSE ['+4930' || a, '+4930' || b] END) AS number FROM (
  SELECT o_orderkey, (2000000 + o_orderkey * 7 % 1000000)::VARCHAR AS a, (3000000 + o_orderkey * 11 % 1000000)::VARCHAR AS b FROM orders
)""")
def _(spark, sf):
    """Two numbers side by side, parted by blanks only; the SQL knows them from how the texts are made."""
    k = F.col("o_orderkey")
    a, c = (F.lit(2000000) + k * 7 % 1000000).cast("string"), (F.lit(3000000) + k * 11 % 1000000).cast("string")
    text = F.when(k % 4 == 1, F.format_string("+49 30 %s 0043 1 %s", a, c)).otherwise(F.format_string("030 %s 030 %s", a, c))
    texts = b.table(spark, sf, "orders").select("o_orderkey", text.alias("text"))
    return cd.phone_matches(texts, "DE").select("o_orderkey", "number")


@query("P7_candidates", s.with_(V_CAND) + "SELECT page_url, match_ord, number, snippet, company FROM v_cand")
def _(spark, sf):
    return cd.phone_candidates(b.texts(spark, sf)).select("page_url", "match_ord", "number", "snippet", "company")


@query("P8_cap_identical", s.with_(s.V_ITEM) + """
SELECT base, number, ord FROM (SELECT base, number, ord, row_number() OVER (PARTITION BY base, number ORDER BY ord) AS rn
  FROM v_good) WHERE rn <= 3""")
def _(spark, sf):
    good = ct.usable_items(b.items(spark, sf)).select("base", "number", F.col("ord").alias("match_ord"))
    return cd.cap_identical(good, 3, page="base").withColumnRenamed("match_ord", "ord")


@query("P8_beyond_cap", s.with_(s.V_ITEM) + """
SELECT base, number, ord, rn - 1 AS place FROM (SELECT base, number, ord, row_number() OVER (PARTITION BY base, number ORDER BY ord) AS rn
  FROM v_good) WHERE rn > 3""")
def _(spark, sf):
    good = ct.usable_items(b.items(spark, sf)).select("base", "number", F.col("ord").alias("match_ord"))
    return cd.beyond_cap(good, 3, page="base").withColumnRenamed("match_ord", "ord")


@query("W1_capped_candidates", s.with_(V_CAND) + "SELECT page_url, number, match_ord FROM v_capped")
def _(spark, sf):
    return cd.cap_identical(cd.phone_candidates(b.texts(spark, sf)), 3).select("page_url", "number", "match_ord")


def rendered(spark, sf):
    """Rendered contacts as an outside report file would hold them."""
    o = F.col("o_orderkey")
    shown = (F.when(o % 5 == 0, None).when(o % 5 == 1, F.concat(F.lit("+4930 "), o, F.lit("-7 (Main Line) [C]")))
             .when(o % 5 == 2, F.concat(F.lit("0"), o)).when(o % 5 == 3, "unknown (Fax) [X]")
             .otherwise(F.concat(F.lit("+43 "), o, F.lit(" (Sales, Support) [A, B]"))))
    return b.table(spark, sf, "orders").select(o, shown.alias("shown"))


@query("P9_report_number", """SELECT o_orderkey, CASE o_orderkey % 5 WHEN 1 THEN '+4930' || o_orderkey || '7'
 WHEN 2 THEN '0' || o_orderkey WHEN 4 THEN '+43' || o_orderkey END AS number FROM orders""")
def _(spark, sf):
    return rendered(spark, sf).select("o_orderkey", rp.report_number(F.col("shown")).alias("number"))


@query("P10_report_type", """SELECT o_orderkey, CASE o_orderkey % 5 WHEN 1 THEN 'Main Line' WHEN 2 THEN 'Unknown'
 WHEN 3 THEN 'Fax' WHEN 4 THEN 'Sales, Support' END AS type FROM orders""")
def _(spark, sf):
    return rendered(spark, sf).select("o_orderkey", rp.report_type(F.col("shown")).alias("type"))


# --- label exchange ------------------------------------------------------------------------
def slot_items(spark, sf):
    return ct.usable_items(b.items(spark, sf)).select(F.col("base").alias("site"), "number", "ord", "source_url", "company")


V_REQ = s.V_ITEM + """, v_req AS (
  SELECT *, (rn - 1) // 10 AS chunk, (rn - 1) % 10 AS pos FROM (
    SELECT *, row_number() OVER (PARTITION BY base ORDER BY ord, number) AS rn FROM v_good))"""


@query("L1_request_slots", s.with_(V_REQ) + """
SELECT base || '#' || chunk AS request_id, pos, number, ord FROM v_req WHERE rn <= 100""")
def _(spark, sf):
    """The request limit of a site: ten chunks of ten."""
    return lb.request_slots(slot_items(spark, sf), "site", ["ord", "number"], max_chunks=10).select("request_id", "pos", "number", "ord")


@query("L1_not_requested", s.with_(V_REQ) + "SELECT base AS site, number, ord, rn - 1 AS place FROM v_req WHERE rn > 100")
def _(spark, sf):
    """What the limit leaves out."""
    return lb.not_requested(slot_items(spark, sf), "site", ["ord", "number"], max_chunks=10).select("site", "number", "ord", "place")


@query("W3_chunk_sizes", s.with_(V_REQ) + "SELECT base AS site, chunk, count(*) AS n FROM v_req GROUP BY ALL")
def _(spark, sf):
    slots = lb.request_slots(slot_items(spark, sf), "site", ["ord", "number"], max_chunks=None)
    return slots.groupBy("site", "chunk").agg(F.count(F.lit(1)).alias("n"))


TEMPLATE = "Label these:\n" + dims.PROMPT_PLACEHOLDER + "\nAnswer in JSON."


@query("L2_render_requests", s.with_(s.V_SLOTS) + """
SELECT request_id, count(*)::INT AS n_items, 'Label these:' || chr(10) || '[' || string_agg(
  '{"number":"' || number || '","snippet":"' || snippet || '","source_url":"' || source_url
  || '","company":"' || company || '"}', ',' ORDER BY pos) || ']' || chr(10) || 'Answer in JSON.' AS prompt
FROM v_slots GROUP BY request_id""")
def _(spark, sf):
    return lb.render_requests(b.slots(spark, sf), TEMPLATE)


FAULT_SQL = """CASE o_orderkey % 12 WHEN 0 THEN 'Error_ChunkEmptyResponse' WHEN 1 THEN 'Error_ChunkNoJsonBlock'
  WHEN 2 THEN 'Error_ChunkJsonParseValidate_JSONDecodeError' WHEN 3 THEN 'Error_ChunkUnexpected_TypeError'
  WHEN 4 THEN 'Error_ChunkJsonParseValidate_ValidationError' END"""


@query("L3_json_block", s.with_(s.V_RESPONSES) + r"""
SELECT request_id, attempt, CASE WHEN contains(raw_text, '{') THEN regexp_extract(raw_text, '(?s)\{.*\}')
  WHEN contains(raw_text, '[') THEN regexp_extract(raw_text, '(?s)\[.*\]') END AS block FROM v_responses""")
def _(spark, sf):
    return b.responses(spark, sf).select("request_id", "attempt", text.json_block(F.col("raw_text")).alias("block"))


@query("L4_parse_responses", f"""SELECT 'o' || o_orderkey AS request_id, 0 AS attempt, {FAULT_SQL} AS fault,
  CASE WHEN o_orderkey % 12 < 4 THEN NULL WHEN o_orderkey % 12 = 4 THEN 1
       WHEN o_orderkey % 12 = 5 THEN o_orderkey % 3 ELSE o_orderkey % 3 + 1 END AS n_items
FROM orders WHERE o_orderkey % 12 <> 8
UNION ALL SELECT 'o' || o_orderkey, 1, NULL, CASE WHEN o_orderkey % 3 = 2 THEN 2 ELSE 1 END
FROM orders WHERE o_orderkey % 12 IN (6, 7)""")
def _(spark, sf):
    parsed = lb.parse_responses(b.responses(spark, sf))
    return parsed.select("request_id", "attempt", "fault",
                         F.when(F.col("items").isNotNull(), F.size("items")).alias("n_items"))


def reconciled(spark, sf):
    return lb.reconcile(b.slots(spark, sf).drop("order_id"), b.responses(spark, sf))


LABEL_SQL = """CASE f WHEN 0 THEN 'Error_ChunkEmptyResponse' WHEN 1 THEN 'Error_ChunkNoJsonBlock'
  WHEN 2 THEN 'Error_ChunkJsonParseValidate_JSONDecodeError' WHEN 3 THEN 'Error_ChunkUnexpected_TypeError'
  WHEN 4 THEN 'Error_ChunkJsonParseValidate_ValidationError' WHEN 5 THEN 'Error_LLMItemCountMismatch'
  WHEN 7 THEN CASE WHEN pos % 2 = 0 THEN 'Error_PersistentMismatchAfterRetries' ELSE 'Main Line' END
  WHEN 8 THEN 'Error_NotProcessedInChunk' ELSE 'Main Line' END"""
V_LABELLED = s.V_SLOTS + f""", v_labelled AS (
  SELECT request_id, pos, number, source_url, company, {LABEL_SQL} AS type,
    CASE WHEN {LABEL_SQL} = 'Main Line' THEN 'Primary' ELSE 'Non-Business' END AS classification,
    CASE WHEN {LABEL_SQL} <> 'Main Line' THEN NULL WHEN f = 6 AND pos % 2 = 0 THEN 1 ELSE 0 END AS answered_by
  FROM v_slots)"""
V_LABELLED_0 = V_LABELLED.replace("WHEN 7 THEN CASE", "WHEN 6 THEN CASE WHEN pos % 2 = 0 THEN "
                                  "'Error_PersistentMismatchAfterRetries' ELSE 'Main Line' END WHEN 7 THEN CASE")


@query("L5_positions", s.with_(V_LABELLED_0) + """
SELECT request_id, pos, CASE WHEN answered_by = 0 THEN number END AS answered FROM v_labelled""")
def _(spark, sf):
    done = lb.reconcile(b.slots(spark, sf).drop("order_id"), b.responses(spark, sf), max_retries=0)
    return done.select("request_id", "pos", F.when(F.col("answered_by") == 0, F.col("number")).alias("answered"))


@query("L6_count_mismatch", """SELECT 'o' || o_orderkey AS request_id, o_orderkey % 3 + 1 AS n
FROM orders WHERE o_orderkey % 12 = 5""")
def _(spark, sf):
    return reconciled(spark, sf).filter(F.col("type") == "Error_LLMItemCountMismatch").groupBy("request_id").agg(
        F.count(F.lit(1)).alias("n"))


@query("L7_reconcile", s.with_(V_LABELLED) + "SELECT request_id, pos, type, answered_by FROM v_labelled")
def _(spark, sf):
    return reconciled(spark, sf).select("request_id", "pos", "type", "answered_by")


@query("L7_open_slots", s.with_(V_LABELLED_0) + "SELECT request_id, pos, number FROM v_labelled WHERE answered_by IS NULL")
def _(spark, sf):
    asked = b.slots(spark, sf).drop("order_id")
    done = lb.reconcile(asked, b.responses(spark, sf), max_retries=0)
    return lb.open_slots(asked, done).select("request_id", "pos", "number")


@query("L8_error_items", s.with_(V_LABELLED) + """
SELECT request_id, pos, number, type, classification FROM v_labelled WHERE type LIKE 'Error%'""")
def _(spark, sf):
    return reconciled(spark, sf).filter(F.col("type").startswith("Error_")).select(
        "request_id", "pos", "number", "type", "classification")


@query("L9_success_items", s.with_(V_LABELLED) + """
SELECT request_id, pos, number, source_url, company FROM v_labelled WHERE type NOT LIKE 'Error%'""")
def _(spark, sf):
    return reconciled(spark, sf).filter(~F.col("type").startswith("Error_")).select(
        "request_id", "pos", "number", "source_url", "company")


@query("L10_tokens", s.with_(s.V_RESPONSES) + """
SELECT request_id, sum(prompt_tokens) AS prompt_tokens, sum(completion_tokens) AS completion_tokens,
  sum(total_tokens) AS total_tokens, count(*) AS calls FROM v_responses GROUP BY 1""")
def _(spark, sf):
    return lb.token_totals(b.responses(spark, sf), "request_id")


@query("L11_item_counts", s.with_(V_LABELLED) + """
SELECT count(*) FILTER (type NOT LIKE 'Error%') AS success_items, count(*) FILTER (type LIKE 'Error%') AS error_items
FROM v_labelled""")
def _(spark, sf):
    return lb.item_counts(reconciled(spark, sf))


def enriched(spark, sf):
    """Enriched responses from orders: two numbers, details for the first one."""
    o = F.col("o_orderkey")
    n = F.concat(F.lit("+4930"), F.lpad(F.col("o_custkey").cast("string"), 6, "0"))
    text_ = F.concat(
        F.lit('{"extracted_numbers": [{"number": "'), n, F.lit('1", "type": "Sales", "classification": "Primary"}, '
                                                           '{"number": "'), n,
        F.lit('2", "type": "Fax", "classification": "Support"}], "additional_info": [{"info_type": "email", "value": "a'),
        o, F.lit('@x.de", "associated_number": "'), n, F.lit('1", "confidence": 0.'), o % 9 + 1,
        F.lit('}, {"info_type": "role", "value": "CEO", "associated_number": "'), n,
        F.lit('1", "confidence": '), o % 3, F.lit('.5}], "overall_confidence": 0.5}'))
    return b.table(spark, sf, "orders").select(F.concat(F.lit("o"), o).alias("request_id"), text_.alias("raw_text"))


@query("L12_enriched", """WITH e AS (SELECT 'o' || o_orderkey AS request_id, o_orderkey AS o,
  '+4930' || lpad(o_custkey::VARCHAR, 6, '0') AS n FROM orders)
SELECT request_id, 0 AS pos, n || '1' AS number, 'Sales' AS type, 'Primary' AS classification, 'email' AS info_type,
  'a' || o || '@x.de' AS value, (o % 9 + 1) / 10.0::DOUBLE AS confidence, 0.5::DOUBLE AS overall_confidence FROM e
UNION ALL SELECT request_id, 0, n || '1', 'Sales', 'Primary', 'role', 'CEO', 0.5, 0.5 FROM e WHERE o % 3 = 0
UNION ALL SELECT request_id, 1, n || '2', 'Fax', 'Support', NULL, NULL, NULL, 0.5 FROM e""")
def _(spark, sf):
    return lb.enriched_items(enriched(spark, sf))


RULE_TYPE = r"""CASE WHEN regexp_matches(snippet, '(?i)\bfax') THEN 'Fax' WHEN regexp_matches(snippet, '(?i)\b(?:mobil|handy)') THEN 'Mobile'
  WHEN regexp_matches(snippet, '(?i)\b(?:support|hotline|helpdesk)') THEN 'Support Hotline'
  WHEN regexp_matches(snippet, '(?i)\b(?:sales|vertrieb)') THEN 'Sales'
  WHEN regexp_matches(snippet, '(?i)\b(?:zentrale|headquarter)') THEN 'Headquarters' ELSE 'Main Line' END"""
RULE_CLASS = f"""CASE {RULE_TYPE} WHEN 'Fax' THEN 'Low Relevance' WHEN 'Mobile' THEN 'Low Relevance'
  WHEN 'Support Hotline' THEN 'Support' WHEN 'Sales' THEN 'Secondary' WHEN 'Headquarters' THEN 'Primary'
  ELSE CASE WHEN page_type IN ('contact', 'imprint', 'homepage') THEN 'Primary' ELSE 'Secondary' END END"""


@query("L13_rule_labels", f"""SELECT doc_id, {RULE_TYPE.replace('snippet', 'text')} AS type,
  {RULE_CLASS.replace('snippet', 'text').replace('page_type', "(CASE WHEN lang = 'de' THEN 'contact' ELSE 'legal' END)")} AS classification
FROM documents""")
def _(spark, sf):
    kind, cls = lb.rule_label(F.col("text"), F.when(F.col("lang") == "de", "contact").otherwise("legal"))
    return b.table(spark, sf, "documents").select("doc_id", kind.alias("type"), cls.alias("classification"))


@query("S11_request_archive", s.with_(s.V_SLOTS) + """
SELECT 'http://c' || (order_id % 500) || '.example.com/' AS pathful_url, request_id AS page_url, count(*) AS n_items,
  '[' || string_agg('{"number":"' || number || '","snippet":"' || snippet || '","source_url":"' || source_url
  || '","company":"' || company || '"}', ',' ORDER BY pos) || ']' AS body FROM v_slots GROUP BY ALL""")
def _(spark, sf):
    cands = b.slots(spark, sf).select(
        F.concat(F.lit("http://c"), F.col("order_id") % 500, F.lit(".example.com/")).alias("pathful_url"),
        F.col("request_id").alias("page_url"), F.col("pos").alias("match_ord"),
        "number", "snippet", "source_url", "company")
    return sinks.request_archive(cands)


@query("S11_response_archive", s.with_(s.V_RESPONSES) + """
SELECT request_id AS pathful_url, raw_text AS raw_output FROM v_responses WHERE attempt = 0""")
def _(spark, sf):
    return sinks.response_archive(b.responses(spark, sf).select(
        F.col("request_id").alias("pathful_url"), F.lit(0).alias("chunk"), "attempt", "raw_text"))


# --- consolidation -----------------------------------------------------------------------------
def good_items(spark, sf):
    return ct.usable_items(b.items(spark, sf))


def numbers(spark, sf):
    return ct.numbers(ct.source_facts(good_items(spark, sf)))


def sources(spark, sf):
    return ct.sources(ct.source_facts(good_items(spark, sf)))


@query("F9_malformed_items", s.with_(s.V_ITEM) + """
SELECT base, count(*) FILTER (coalesce(number, '') = '' OR source_url = '') AS skipped,
  count(*) FILTER (coalesce(number, '') <> '' AND source_url <> '') AS usable FROM v_item GROUP BY base""")
def _(spark, sf):
    return ct.malformed_counts(b.items(spark, sf), "base")


NUMBER_COLUMNS = "base, number, classification, class_prio, type_prio, first_type, first_ord, has_excluded_type, n_items"


@query("A2_consolidate", s.with_(s.V_NUMBERS) + f"SELECT {NUMBER_COLUMNS} FROM v_numbers")
def _(spark, sf):
    return numbers(spark, sf)


@query("A3_sources", s.with_(s.V_NUMBERS) + "SELECT * FROM v_sources")
def _(spark, sf):
    return sources(spark, sf)


@query("A4_best_classification", s.with_(s.V_NUMBERS) + "SELECT base, number, classification, class_prio FROM v_numbers")
def _(spark, sf):
    return numbers(spark, sf).select("base", "number", "classification", "class_prio")


@query("A5_original_urls", s.with_(s.V_ITEM) + """
SELECT base, source_url AS url FROM v_good UNION SELECT base, base FROM v_good""")
def _(spark, sf):
    return ct.original_urls(good_items(spark, sf))


@query("X3_url_union_size", s.with_(s.V_ITEM) + """
SELECT base, count(*) AS n FROM (SELECT base, source_url AS url FROM v_good UNION SELECT base, base FROM v_good)
GROUP BY base""")
def _(spark, sf):
    return ct.original_urls(good_items(spark, sf)).groupBy("base").agg(F.count(F.lit(1)).alias("n"))


@query("A6_representative_name", s.with_(s.V_ITEM, s.V_ENTRIES) + """
SELECT g.base, coalesce(min(company_name), 'Unknown') AS company_name
FROM (SELECT DISTINCT base FROM v_good) g LEFT JOIN v_entries e ON g.base = e.base GROUP BY 1""")
def _(spark, sf):
    bases = good_items(spark, sf).select("base").distinct()
    return ct.representative_names(b.entries(spark, sf), bases)


@query("A7_base_status", s.with_(s.V_ITEM, s.V_ENTRIES, s.V_SITES) + """
SELECT base, arg_min(status, (CASE WHEN status = 'Success' THEN 0 WHEN status = 'Unknown' THEN 3
  WHEN contains(status, 'Error') THEN 2 ELSE 1 END) * 1000000000000 + ord) AS base_status FROM v_sites GROUP BY base""")
def _(spark, sf):
    volume = good_items(spark, sf).groupBy("base").agg(F.count(F.lit(1)).alias("n"))
    return ct.base_status(b.sites(b.entries(spark, sf), volume))


FIRST_SEEN = s.pages("SELECT base, number, {c} AS v, min(ord) AS o FROM v_sources WHERE {c} IS NOT NULL GROUP BY ALL", "base, number", "o, v")
SORTED = s.pages("SELECT DISTINCT base, number, {c} AS v FROM v_sources WHERE {c} IS NOT NULL", "base, number")


@query("A10_types_first_seen", s.with_(s.V_NUMBERS) + FIRST_SEEN.format(c="type"))
def _(spark, sf):
    return ct.number_pages(sources(spark, sf), {"type": "cell"}, first_seen=True)


@query("A10_urls_first_seen", s.with_(s.V_NUMBERS) + FIRST_SEEN.format(c="source_url"))
def _(spark, sf):
    return ct.number_pages(sources(spark, sf), {"source_url": "cell"}, first_seen=True)


@query("A11_types_sorted", s.with_(s.V_NUMBERS) + SORTED.format(c="type"))
def _(spark, sf):
    return ct.number_pages(sources(spark, sf), {"type": "cell"})


@query("A11_companies_sorted", s.with_(s.V_NUMBERS) + f"""
SELECT base, number, coalesce(part, 0) AS part, coalesce(cell, 'UnknownCompany') AS cell
FROM (SELECT DISTINCT base, number FROM v_sources) LEFT JOIN ({SORTED.format(c="company")}) USING (base, number)""")
def _(spark, sf):
    src = sources(spark, sf)
    found = with_pages(src.select("base", "number").distinct(), ct.number_pages(src, {"company": "cell"}), ["base", "number"])
    return found.withColumn("cell", F.coalesce("cell", F.lit("UnknownCompany")))


@query("A11_overflow_parts", s.with_(s.V_NUMBERS) + s.pages(
    "SELECT DISTINCT base, number, source_url AS v FROM v_sources", "base, number", page=2))
def _(spark, sf):
    """Parts of two values each: which values, in which order, in which part."""
    lists = ct.distinct_values(sources(spark, sf), "source_url").drop("ord")
    return paged(lists, ["base", "number"], page=2).select("base", "number", "part", "cell")


LONG = "SELECT l_returnflag, l_orderkey || '-' || l_linenumber AS v, l_shipdate AS o FROM lineitem"


@query("A11_long_lists", s.pages(LONG, "l_returnflag"))
def _(spark, sf):
    """Lists of some ten thousand values and more per key, sorted."""
    return _long(spark, sf, False)


@query("A10_long_lists", s.pages(LONG, "l_returnflag", "o, v"))
def _(spark, sf):
    """The same in an order of their own."""
    return _long(spark, sf, True)


def _long(spark, sf, ordered: bool):
    lists = b.table(spark, sf, "lineitem").select(
        "l_returnflag", F.concat_ws("-", "l_orderkey", "l_linenumber").alias("value"), F.col("l_shipdate").alias("ord"))
    return paged(lists if ordered else lists.drop("ord"), ["l_returnflag"]).select("l_returnflag", "part", "cell")


@query("F10_eligible", s.with_(s.V_NUMBERS) + """
SELECT base, number FROM v_numbers WHERE classification <> 'Non-Business' AND NOT has_excluded_type""")
def _(spark, sf):
    return ct.eligible(numbers(spark, sf)).select("base", "number")


@query("X4_excluded_types", s.with_(s.V_NUMBERS) + """
SELECT base, number, len(list_intersect(list(DISTINCT type), ['Unknown', 'Fax', 'Mobile', 'Date', 'ID'])) > 0 AS hit
FROM v_sources GROUP BY ALL""")
def _(spark, sf):
    return numbers(spark, sf).select("base", "number", F.col("has_excluded_type").alias("hit"))


RANKED = """SELECT base, number, row_number() OVER (PARTITION BY base ORDER BY class_prio, type_prio, first_ord, number) AS rank
FROM v_numbers"""


@query("W2_contact_rank", s.with_(s.V_NUMBERS) + RANKED)
def _(spark, sf):
    cut = F.floor(F.col("first_ord") / 10_000_000_000)
    return ct.rank_all(numbers(spark, sf), cut).select("base", "number", "rank")


@query("K1_top_numbers", s.with_(s.V_NUMBERS) + f"""
SELECT base, max(CASE WHEN rank = 1 THEN number END) AS n_1, max(CASE WHEN rank = 2 THEN number END) AS n_2,
  max(CASE WHEN rank = 3 THEN number END) AS n_3 FROM ({RANKED}) GROUP BY base""")
def _(spark, sf):
    return ct.wide(ct.top_numbers(numbers(spark, sf)), {"number": "n_"})


@query("K2_top_eligible", s.with_(s.V_NUMBERS) + f"""
SELECT base, max(CASE WHEN rank = 1 THEN number END) AS n_1, max(CASE WHEN rank = 2 THEN number END) AS n_2,
  max(CASE WHEN rank = 3 THEN number END) AS n_3
FROM ({RANKED} WHERE classification <> 'Non-Business' AND NOT has_excluded_type) GROUP BY base""")
def _(spark, sf):
    return ct.wide(ct.top_numbers(ct.eligible(numbers(spark, sf))), {"number": "n_"})


@query("J9_priorities", s.with_(s.V_ITEM) + f"""
SELECT DISTINCT classification, type, {s.CLASS_PRIO} AS class_prio, {s.TYPE_PRIO} AS type_prio FROM v_item""")
def _(spark, sf):
    return b.items(spark, sf).select("classification", "type").distinct().select(
        "classification", "type", ct.class_priority(F.col("classification")).alias("class_prio"),
        ct.type_priority(F.col("type")).alias("type_prio"))


@query("X1_union_of_labels", s.with_(V_LABELLED) + """
SELECT regexp_extract(source_url, '^http://[^/]*') AS base, count(*) AS n FROM v_labelled GROUP BY 1""")
def _(spark, sf):
    return reconciled(spark, sf).groupBy(F.regexp_extract("source_url", "^http://[^/]*", 0).alias("base")).agg(
        F.count(F.lit(1)).alias("n"))


@query("X2_union_of_candidates", s.with_(V_CAND) + "SELECT base, count(*) AS n FROM v_cand GROUP BY base")
def _(spark, sf):
    return cd.phone_candidates(b.texts(spark, sf)).groupBy("base").agg(F.count(F.lit(1)).alias("n"))
