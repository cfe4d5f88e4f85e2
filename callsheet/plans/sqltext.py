"""Reference SQL for the views in ``bindings`` and shared expression builders."""

from __future__ import annotations

from callsheet import dims
from callsheet.functions import html, phones, regex, urls


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def rx(c: str, pattern: str, group: int = 0) -> str:
    return f"regexp_extract({c}, {lit(pattern)}, {group})"


def rr(c: str, pattern: str, by: str) -> str:
    return f"regexp_replace({c}, {lit(pattern)}, {by if by.startswith('chr') else lit(by)}, 'g')"


def like(c: str, pattern: str) -> str:
    return f"regexp_matches({c}, {lit(pattern)})"


def strip(c: str) -> str:
    return rr(c, regex.TRIM, "")


def values(rows, columns: str) -> str:
    body = ", ".join("(" + ", ".join(lit(x) if isinstance(x, str) else str(x) for x in r) + ")" for r in rows)
    return f"(VALUES {body}) AS v({columns})"


SCHEME = rx("{c}", r"^([A-Za-z][A-Za-z0-9+.\-]*):", 1)


def parts(src: str, col: str, out: str = "n") -> str:
    """CTE body: ``src`` plus scheme, host, path, query of ``col`` and the normal form ``url_norm``."""
    index = "/" + regex.any_of(dims.INDEX_FILES) + "$"
    return f"""
    SELECT * EXCLUDE (q0, p0, p1, p2),
      u_scheme || '://' || u_host || u_path || CASE WHEN u_query <> '' THEN '?' || u_query ELSE '' END AS url_norm
    FROM (SELECT *, CASE WHEN p2 = '' THEN '/' ELSE p2 END AS u_path,
            array_to_string(list_sort(list_filter(string_split(q0, '&'),
              lambda p: lower(split_part(p, '=', 1)) <> 'fallback')), '&') AS u_query
      FROM (SELECT *, CASE WHEN p1 <> '/' AND p1 LIKE '%/' THEN left(p1, length(p1) - 1) ELSE p1 END AS p2
        FROM (SELECT *, {rr('p0', index, '/')} AS p1
          FROM (SELECT *, lower({rx(col, '^([A-Za-z]+):', 1)}) AS u_scheme,
                  {rr(f"lower({rx(col, '^[A-Za-z]+://([^/?#]*)', 1)})", '^www[.]', '')} AS u_host,
                  {rx(col, '^[A-Za-z]+://[^/?#]*([^?#]*)', 1)} AS p0,
                  {rx(col, '^[^?#]*[?]([^#]*)', 1)} AS q0
                FROM {src}))))"""


# Named references that occur in the test tables.
ENTITIES = {
    "amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": " ",
    "auml": "ä", "ouml": "ö", "uuml": "ü", "Auml": "Ä", "Ouml": "Ö", "Uuml": "Ü",
    "szlig": "ß", "eacute": "é", "egrave": "è", "agrave": "à", "ecirc": "ê",
    "ccedil": "ç", "ntilde": "ñ", "aacute": "á", "iacute": "í", "oacute": "ó",
    "uacute": "ú", "copy": "©", "reg": "®", "euro": "€", "middot": "·",
    "bull": "•", "ndash": "–", "mdash": "—", "hellip": "…", "laquo": "«",
    "raquo": "»", "sect": "§",
}


def decode(c: str) -> str:
    """Decoded character references of an expression."""
    names = "MAP {" + ", ".join(f"{lit(k)}: {lit(v)}" for k, v in ENTITIES.items()) + "}"
    name, rest = rx("p", html.REFERENCE, 1), rx("p", html.REFERENCE, 2)
    char = f"""coalesce({names}[{name}],
        CASE WHEN {like(name, '^#[0-9]')} THEN chr(try_cast({name}[2:] AS INTEGER)) END)"""
    return f"""array_to_string(list_transform(string_split({c}, '&'), lambda p, i:
      CASE WHEN i = 1 THEN p WHEN {name} <> '' AND {char} IS NOT NULL THEN {char} || {rest}
           ELSE '&' || p END), '')"""


def hidden(c: str) -> str:
    return rr(c, html.HIDDEN, " ")


def page_text(c: str) -> str:
    bare = rr(hidden(c), html.TAG, " ")
    return strip(rr(decode(bare), f"[{regex.SPACE}]+", " "))


INPUT_HOST = rr(f"lower({rx('url', '^[A-Za-z]+://([^/?#]*)', 1)})", "^www[.]", "")

V_INPUT = f"""v_input AS (
  SELECT page_id AS input_row_id,
    CASE WHEN page_id % 13 <> 0 THEN split_part({INPUT_HOST}, '.', 1) END AS company_name,
    url AS given_url,
    CASE WHEN page_id % 5 = 0 THEN NULL WHEN page_id % 7 = 0 THEN 'invalid-number'
         WHEN page_id % 3 = 0 THEN '0049 30 ' || (200000 + page_id * 7)
         WHEN page_id % 3 = 1 THEN '+49 (0)89/' || (300000 + page_id * 11)
         ELSE '044 668 ' || (10 + page_id % 90) || ' ' || (10 + page_id % 80) END AS given_phone,
    CASE page_id % 4 WHEN 0 THEN 'DE' WHEN 1 THEN 'CH' WHEN 2 THEN 'AT' ELSE 'US' END AS region,
    CASE page_id % 3 WHEN 0 THEN '[''DE'',''AT'']' WHEN 1 THEN '[''CH'']' ELSE 'DE' END AS target_countries
  FROM pages)"""

V_NORM = f"v_norm AS ({parts('pages', 'url')})"

V_PAGE = f"""{V_NORM}, v_page AS (
  SELECT page_id, url_norm AS page_url, u_scheme || '://' || u_host AS base, u_host, u_path,
    'general_content' AS page_type, {page_text('html')} AS text FROM v_norm)"""

V_TEXT = f"""{V_PAGE}, v_text AS (
  SELECT 'http://' || source || '.example.com' AS base,
    'http://' || source || '.example.com/doc/' || doc_id AS page_url, source AS company,
    'general_content' AS page_type, doc_id AS page_ord, text FROM documents
  UNION ALL
  SELECT base, page_url, split_part(u_host, '.', 1), page_type, 10000000000 + page_id, text FROM v_page)"""

V_ITEM = """v_item AS (
  SELECT 'http://s' || l_suppkey || '.example.com' AS base,
    CASE WHEN (l_orderkey + l_partkey) % 101 <> 0 THEN '+4930' || lpad((l_partkey % 50)::VARCHAR, 7, '0') END AS number,
    CASE WHEN l_orderkey % 103 <> 0 THEN 'http://s' || l_suppkey || '.example.com/p' || l_linenumber ELSE '' END AS source_url,
    CASE WHEN kind = 0 THEN 'Main Line' WHEN kind = 1 THEN 'Sales' WHEN kind = 2 THEN 'Support Hotline'
      WHEN kind = 3 THEN 'Fax' WHEN kind = 4 THEN 'Mobile' WHEN kind = 5 THEN 'Unknown'
      WHEN kind = 6 THEN 'Customer Service' WHEN kind = 7 THEN 'Hotline X' WHEN kind = 8 THEN 'Zentrale'
      WHEN kind = 9 THEN 'Direct Dial' WHEN kind = 10 THEN 'Error_PersistentMismatchAfterRetries'
      WHEN kind <= 20 THEN 'Main Line' WHEN kind <= 30 THEN 'Sales' ELSE 'Info-Hotline' END AS type,
    CASE WHEN l_partkey % 10 = 3 THEN 'Unlisted ' || (l_orderkey % 4) WHEN cls = 0 THEN 'Primary'
      WHEN cls <= 4 THEN 'Secondary' WHEN cls <= 9 THEN 'Support' WHEN cls <= 19 THEN 'Low Relevance'
      WHEN cls <= 49 THEN 'Non-Business' ELSE 'Odd' END AS classification,
    CASE WHEN l_orderkey % 17 <> 0 THEN 'Company ' || (l_orderkey % 30) END AS company,
    (l_orderkey * 10 + l_linenumber) * 100000 + l_partkey AS ord
  FROM (SELECT *, (l_orderkey + l_partkey * 3 + l_linenumber * 7) % 40 AS kind,
               (l_orderkey * 7 + l_linenumber) % 60 AS cls FROM lineitem)),
v_good AS (SELECT * FROM v_item WHERE coalesce(number, '') <> '' AND source_url <> '' AND type NOT LIKE 'Error\\_%' ESCAPE '\\')"""


def _cases(table: dict, c: str, other: int) -> str:
    return f"CASE {c} " + " ".join(f"WHEN {lit(k)} THEN {v}" for k, v in table.items()) + f" ELSE {other} END"


CLASS_PRIO = _cases(dims.CLASSIFICATION_PRIORITY, "classification", dims.OTHER_CLASSIFICATION)
TYPE_PRIO = _cases(dims.TYPE_PRIORITY, "type", dims.OTHER_TYPE)

# The fold of the data model: first source type, then best class with the rule
# for unlisted classes.
V_NUMBERS = f"""{V_ITEM}, v_prio AS (
  SELECT *, {CLASS_PRIO} AS cp, {TYPE_PRIO} AS tp,
    first_value(type) OVER w AS first_type, first_value({TYPE_PRIO}) OVER w AS first_tp
  FROM v_good WINDOW w AS (PARTITION BY base, number ORDER BY ord)),
v_numbers AS (
  SELECT base, number,
    CASE WHEN min(cp) < 99 THEN arg_min(classification, cp * 1000000000000000 + ord)
         ELSE coalesce(arg_max(classification, ord) FILTER (tp < first_tp), arg_min(classification, ord)) END AS classification,
    min(cp)::INT AS class_prio, any_value(first_tp)::INT AS type_prio, any_value(first_type) AS first_type,
    min(ord) AS first_ord,
    bool_or(type IN ('Unknown', 'Fax', 'Mobile', 'Date', 'ID')) AS has_excluded_type, count(*) AS n_items
  FROM v_prio GROUP BY ALL),
v_sources AS (
  SELECT base, number, source_url, type, min(ord) AS ord, arg_min_null(company, ord) AS company
  FROM v_good GROUP BY ALL)"""

V_ENTRIES = """v_entries0 AS (
  SELECT c_custkey AS input_row_id,
    CASE WHEN c_custkey % 23 <> 0 THEN c_mktsegment || ' ' || (c_custkey % 400) END AS company_name,
    CASE WHEN c_custkey % 29 = 0 THEN NULL WHEN c_custkey % 19 = 0 THEN 'ftp://s' || (c_custkey % 997) || '.example.com'
      WHEN c_custkey % 2 = 0 THEN 'http://www.s' || (c_custkey % 997) || '.example.com/start'
      ELSE 's' || (c_custkey % 997) || '.example.com/start?b=2&a=1#x' END AS given_url,
    CASE WHEN c_custkey % 29 = 0 THEN NULL WHEN c_custkey % 19 = 0 THEN 'ftp://s' || (c_custkey % 997) || '.example.com/'
      WHEN c_custkey % 2 = 0 THEN 'http://www.s' || (c_custkey % 997) || '.example.com/start'
      ELSE 'http://s' || (c_custkey % 997) || '.example.com/start?b=2&a=1#x' END AS clean_url,
    CASE WHEN c_custkey % 5 = 0 THEN NULL WHEN c_custkey % 7 = 0 THEN 'invalid-number'
      ELSE '0049 30 ' || lpad((c_custkey * 13 % 2000)::VARCHAR, 7, '0') END AS given_phone,
    CASE WHEN c_custkey % 5 = 0 THEN NULL WHEN c_custkey % 7 = 0 THEN 'InvalidFormat'
      ELSE '+4930' || lpad((c_custkey * 13 % 2000)::VARCHAR, 7, '0') END AS normalized_phone,
    c_mktsegment AS description, '[''DE'',''AT'',''CH'']' AS target_countries,
    TIMESTAMP '2024-01-01 00:00:00' + to_seconds(c_custkey) AS logged_at
  FROM customer),
v_entries1 AS (
  SELECT *, CASE WHEN clean_url IS NULL OR clean_url LIKE 'ftp%' THEN 'InvalidURL'
    WHEN input_row_id % 11 = 0 THEN 'DNSError' WHEN input_row_id % 13 = 0 THEN 'HTTPError_404'
    WHEN input_row_id % 17 = 0 THEN 'HTTPError_403' WHEN input_row_id % 31 = 0 THEN 'TimeoutError'
    WHEN input_row_id % 37 = 0 THEN 'RobotsDisallowed' WHEN input_row_id % 41 = 0 THEN 'Already_Processed'
    WHEN input_row_id % 47 = 0 THEN 'MaxRedirects_InputURL' ELSE 'Success' END AS status
  FROM v_entries0),
v_entries2 AS (
  SELECT *, CASE WHEN status IN ('InvalidURL', 'MaxRedirects_InputURL') THEN NULL
    WHEN status NOT IN ('Success', 'Already_Processed') AND input_row_id % 4 = 0 THEN NULL
    WHEN input_row_id % 43 = 0 THEN 'http://s' || (input_row_id % 997 + 1) || '.example.com/start'
    WHEN input_row_id % 2 = 0 THEN 'http://s' || (input_row_id % 997) || '.example.com/start'
    ELSE 'http://s' || (input_row_id % 997) || '.example.com/start?a=1&b=2' END AS pathful_url
  FROM v_entries1),
v_entries AS (SELECT *, regexp_extract(pathful_url, '^http://[^/]*') AS base FROM v_entries2)"""

V_SITES = """v_volume AS (SELECT base, count(*) AS n FROM v_good GROUP BY base),
v_sites0 AS (
  SELECT pathful_url, base, min(input_row_id) AS ord, arg_min(status, input_row_id) AS first_status
  FROM v_entries WHERE pathful_url IS NOT NULL GROUP BY ALL),
v_sites1 AS (
  SELECT s.*, v.n, first_status IN ('Success', 'Already_Processed') AS ok, v.n IS NOT NULL AS has,
    regexp_extract(s.base, '//s([0-9]+)', 1)::BIGINT AS k
  FROM v_sites0 s LEFT JOIN v_volume v ON s.base = v.base),
v_sites AS (
  SELECT pathful_url, base, ord, CASE WHEN ok THEN 'Success' ELSE first_status END AS status,
    (CASE WHEN NOT ok THEN 0 WHEN has THEN 3 WHEN k % 4 = 0 THEN 0 ELSE 2 END)::BIGINT AS pages,
    (CASE WHEN NOT ok THEN 0 WHEN has THEN n WHEN k % 4 >= 2 THEN 5 ELSE 0 END)::BIGINT AS candidates,
    ok AND (has OR k % 4 = 3 OR k % 8 = 2) AS label_called,
    (CASE WHEN NOT ok THEN 0 WHEN has THEN n WHEN k % 8 = 7 THEN 3 ELSE 0 END)::BIGINT AS raw_numbers,
    CASE WHEN ok AND NOT has AND k % 8 = 2 THEN 'RuntimeError: quota ' || k END AS error
  FROM v_sites1),
v_site_pages AS (
  SELECT base, base || '/p' || i AS page_url,
    CASE i WHEN 1 THEN 'homepage' WHEN 2 THEN 'contact' ELSE 'general_content' END AS page_type
  FROM (SELECT base, unnest(generate_series(1, pages)) AS i FROM v_sites))"""

V_FETCH = """v_fetch AS (
  SELECT event_id, ts, user_id AS input_row_id,
    CASE WHEN event_type = 'error' THEN -(1 + event_id % 8) WHEN event_type = 'click' THEN 403 + event_id % 2
         WHEN event_type IN ('view', 'purchase') THEN 200 END AS status_code,
    event_type IN ('view', 'purchase') AS has_content, event_type, value, props FROM events)"""

V_SLOTS = """v_slots AS (
  SELECT 'o' || o_orderkey AS request_id, o_orderkey AS order_id, pos::INT AS pos,
    '+4930' || lpad(o_custkey::VARCHAR, 6, '0') || pos AS number, 'call us at ' || o_orderkey AS snippet,
    'http://c' || o_custkey || '.example.com/' AS source_url, 'C' || o_custkey AS company, o_orderkey % 12 AS f
  FROM (SELECT *, unnest(generate_series(0, o_orderkey % 3)) AS pos FROM orders))"""

_ONE = "'{\"number\": \"' || %s || '\", \"type\": \"Main Line\", \"classification\": \"Primary\"}'"
_LIST = "'{\"extracted_numbers\": [' || coalesce(string_agg(%s, ', ' ORDER BY pos)%s, '') || ']}'"
_WRONG = "CASE WHEN pos % 2 = 0 THEN 'X' || number ELSE number END"
V_RESPONSES = f"""{V_SLOTS}, v_responses AS (
  SELECT request_id, 0 AS attempt,
    CASE any_value(f) WHEN 0 THEN '' WHEN 1 THEN 'sorry, nothing here' WHEN 2 THEN '{{"extracted_numbers": [}}'
      WHEN 3 THEN '[1, 2]'
      WHEN 4 THEN '{{"extracted_numbers": [{{"number": "1", "classification": "Primary"}}]}}'
      WHEN 5 THEN {_LIST % (_ONE % 'number', ' FILTER (pos > 0)')}
      WHEN 6 THEN {_LIST % (_ONE % _WRONG, '')} WHEN 7 THEN {_LIST % (_ONE % _WRONG, '')}
      WHEN 9 THEN 'Here:' || chr(10) || '```json' || chr(10) || {_LIST % (_ONE % 'number', '')} || chr(10) || '```' || chr(10) || 'bye'
      ELSE {_LIST % (_ONE % 'number', '')} END AS raw_text,
    count(*) * 100 AS prompt_tokens, count(*) * 30 AS completion_tokens, count(*) * 130 AS total_tokens
  FROM v_slots WHERE f <> 8 GROUP BY request_id
  UNION ALL
  SELECT request_id, 1,
    CASE any_value(f) WHEN 6 THEN {_LIST % (_ONE % 'number', ' FILTER (pos % 2 = 0)')}
      ELSE {_LIST % (_ONE % _WRONG, ' FILTER (pos % 2 = 0)')} END,
    count(*) * 50, count(*) * 20, count(*) * 70
  FROM v_slots WHERE f IN (6, 7) GROUP BY request_id)"""


def pages(rows: str, keys: str, order: str = "v", sep: str = ", ", page: int = 10_000) -> str:
    """Lists of ``v`` per key as text, ``page`` values by position to a part."""
    return f"""SELECT {keys}, part, string_agg(v, '{sep}' ORDER BY place) AS cell FROM (
  SELECT *, place // {page} AS part FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) - 1 AS place FROM ({rows})))
  GROUP BY {keys}, part"""


def with_(*ctes: str) -> str:
    return "WITH " + ", ".join(ctes) + " "
