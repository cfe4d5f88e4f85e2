"""Registered queries: duplicates, joins, journeys, outcomes, reports, metrics, analysis."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, functions as F

from callsheet import dims
from callsheet.functions import urls
from callsheet.functions.stages import stored
from callsheet.operators import analysis as an, candidates as cd, contacts as ct, crawl, duplicates as dp
from callsheet.operators import journey as jn, labels as lb, metrics as mt, outcomes as oc, reports as rp
from callsheet.operators.paging import with_pages
from callsheet.plans import bindings as b, sqltext as s
from callsheet.plans.registry import query

RUN = b.RUN_ID
#: All assigned calling codes: the fixed values of the numbering plan.
DIAL_CODE_SET = {p[1] for p in dims.DIAL_PLAN} | set(dims.CALLING_CODES)


@dataclass
class Run:
    """The tables of one run, each built on first use. ``listed``: the query shows numbers or
    their sources, not only what came of them."""

    spark: object
    sf: str
    listed: bool = False

    @cached_property
    def entries(self):
        return stored(b.entries(self.spark, self.sf), "entries")

    @cached_property
    def items(self):
        return ct.usable_items(b.items(self.spark, self.sf))

    @cached_property
    def numbers(self):
        return stored(ct.numbers(self.source_facts), "numbers")

    @cached_property
    def counted(self):
        """The numbers with their item counts, all that sites and journeys take from them. A query that
        lists no numbers stores no more of them, and has them from the pass that makes the sources."""
        if self.listed:
            return self.numbers
        found = ct.numbers(ct.source_facts(self.items, by_number=True))
        return stored(found.select("base", "number", "n_items"), "counted")

    @cached_property
    def source_facts(self):
        return stored(ct.source_facts(self.items), "source_facts")

    @cached_property
    def sources(self):
        return ct.sources(self.source_facts)

    @cached_property
    def sites(self):
        return stored(b.sites(self.entries, ct.base_volume(self.counted)), "sites")

    @cached_property
    def pages(self):
        return b.site_pages(self.sites)

    @cached_property
    def journey(self):
        return stored(jn.journey(self.entries, self.pages, self.sites, self.counted), "journey")

    @cached_property
    def outcomes(self):
        return oc.row_outcomes(self.entries, self.journey)

    @cached_property
    def domains(self):
        return oc.domain_outcomes(self.journey)

    @cached_property
    def events(self):
        return oc.failure_events(self.entries, self.sites)

    @cached_property
    def attrition(self):
        return rp.attrition(rp.with_label_error(self.outcomes, self.sites), self.journey, self.entries)

    @cached_property
    def final(self):
        return rp.final_contacts(self.entries, self.journey, self.numbers, self.sources,
                                 ct.original_urls(self.sources))


# --- duplicates ---------------------------------------------------------------------------
V_KEYS = s.V_ENTRIES + """, v_keys AS (
  SELECT *, coalesce(nullif(regexp_replace(regexp_extract(clean_url, '^[a-z]+://([^/?#]*)', 1), '^www[.]', ''), ''),
    'MISSING_OR_INVALID_URL_INPUT') AS host_key FROM v_entries),
v_counts AS (
  SELECT *, CASE WHEN company_name IS NULL THEN 0 ELSE count(*) OVER (PARTITION BY company_name) END AS name_count,
    count(*) OVER (PARTITION BY host_key) AS host_count FROM v_keys),
v_dups AS (
  SELECT *, name_count > 1 AS name_dup, host_count > 1 AND host_key <> 'MISSING_OR_INVALID_URL_INPUT' AS host_dup
  FROM v_counts)"""


@query("A1_duplicate_profile", s.with_(V_KEYS) + """
SELECT count(*) AS input_rows, count(*) FILTER (name_dup) AS rows_dup_name, count(*) FILTER (host_dup) AS rows_dup_url,
  count(*) FILTER (name_dup OR host_dup) AS rows_dup_any, count(DISTINCT company_name) AS distinct_names,
  count(DISTINCT company_name) FILTER (name_dup) AS names_repeated, count(DISTINCT host_key) AS distinct_urls,
  count(DISTINCT host_key) FILTER (host_dup) AS urls_repeated FROM v_dups""")
def _(spark, sf):
    return dp.duplicate_profile(Run(spark, sf).entries)


@query("W6_duplicate_counts", s.with_(V_KEYS) + """
SELECT input_row_id, name_count, host_count, name_dup, host_dup, name_dup OR host_dup AS any_dup FROM v_dups""")
def _(spark, sf):
    return dp.with_duplicate_counts(Run(spark, sf).entries).select(
        "input_row_id", "name_count", "host_count", "name_dup", "host_dup", "any_dup")


# --- journeys and outcomes -----------------------------------------------------------------
V_FACTS = f"""{s.V_NUMBERS}, {s.V_ENTRIES}, {s.V_SITES}, v_facts AS (
  SELECT base, arg_min(status, (CASE WHEN status = 'Success' THEN 0 WHEN contains(status, 'Error') THEN 2 ELSE 1 END)
      * 1000000000000 + ord) AS base_status, count(*) AS n_sites,
    bool_and(status IN ('TimeoutError', 'DNSError')) AS all_network,
    bool_and(status IN ('HTTPError_403', 'RobotsDisallowed')) AS all_denied,
    bool_and(status = 'HTTPError_404') AS all_missing, bool_or(candidates > 0) AS any_candidates,
    bool_or(label_called) AS any_calls, sum(raw_numbers)::BIGINT AS raw_numbers, bool_or(error IS NOT NULL) AS any_error,
    bool_or(label_called) AND count(*) FILTER (label_called AND error IS NULL) = 0 AS all_errors,
    max(error) AS error, sum(pages)::BIGINT AS total_pages,
    sum((pages > 0)::INT)::BIGINT AS homepage, sum((pages > 1)::INT)::BIGINT AS contact, sum((pages > 2)::INT)::BIGINT AS general
  FROM v_sites GROUP BY base),
v_types AS (SELECT base, part, '{{' || cell || '}}' AS types_json FROM ({s.pages(
    "SELECT base, '" + '"' + "' || type || '" + '": ' + "' || count(*) AS v FROM v_sources WHERE type IS NOT NULL GROUP BY base, type", "base")})),
v_journey AS (
  SELECT f.*, coalesce(c.consolidated, 0) AS consolidated,
    '{{' || concat_ws(',', CASE WHEN contact > 0 THEN '"contact":' || contact END,
      CASE WHEN general > 0 THEN '"general_content":' || general END,
      CASE WHEN homepage > 0 THEN '"homepage":' || homepage END) || '}}' AS page_types_json,
    (SELECT count(*) FROM v_entries e WHERE e.base = f.base) AS n_rows
  FROM v_facts f LEFT JOIN (SELECT base, count(*) AS consolidated FROM v_numbers GROUP BY base) c ON f.base = c.base)"""


@query("A8_journey", s.with_(V_FACTS) + """
SELECT base, n_rows, base_status, n_sites, all_network, all_denied, all_missing, any_candidates, any_calls,
  raw_numbers, any_error, all_errors, total_pages, page_types_json, consolidated, coalesce(part, 0) AS part,
  coalesce(types_json, '{}') AS types_json FROM v_journey LEFT JOIN v_types USING (base)""")
def _(spark, sf):
    run = Run(spark, sf, listed=True)
    return with_pages(run.journey, jn.type_histogram(run.sources), ["base"]).withColumn(
        "types_json", F.coalesce("types_json", F.lit("{}")))


@query("A8_journey_members", s.with_(s.V_ITEM, s.V_ENTRIES, s.V_SITES) + """
SELECT base, 'Input_Row_IDs' AS "column", input_row_id::VARCHAR AS value FROM v_entries WHERE base IS NOT NULL
UNION SELECT base, 'Input_CompanyNames', company_name FROM v_entries WHERE base IS NOT NULL AND company_name IS NOT NULL
UNION SELECT base, 'Input_GivenURLs', given_url FROM v_entries WHERE base IS NOT NULL AND given_url IS NOT NULL
UNION SELECT base, 'Pathful_URLs_Attempted_List', pathful_url FROM v_entries WHERE base IS NOT NULL
UNION SELECT base, 'LLM_Error_Messages_Aggregated', 'PathfulURL (' || pathful_url || '): ' || error FROM v_sites
  WHERE error IS NOT NULL""")
def _(spark, sf):
    run = Run(spark, sf)
    return jn.members(run.entries, run.sites)


@query("A9_type_histogram", s.with_(V_FACTS) + "SELECT base, part, types_json FROM v_types")
def _(spark, sf):
    return jn.type_histogram(Run(spark, sf).sources)


V_ROWS = V_FACTS + """, v_rows AS (
  SELECT e.*, j.base_status, coalesce(j.consolidated, 0) AS consolidated, j.error AS base_error,
    CASE WHEN status = 'InvalidURL' THEN 'Input_URL_Invalid'
      WHEN status = 'MaxRedirects_InputURL' THEN 'Pipeline_Skipped_MaxRedirects_ForInputURL'
      WHEN consolidated > 0 THEN 'Contact_Successfully_Extracted'
      WHEN e.base IS NULL AND status NOT IN ('', 'Success', 'Not_Run') THEN 'ScrapingFailure_InputURL_' || status
      WHEN e.base IS NULL THEN 'Unknown_NoCanonicalURLDetermined'
      WHEN all_errors AND any_candidates THEN 'LLM_Processing_Error_AllAttempts'
      WHEN base_status <> 'Success' AND all_network THEN 'Scraping_AllAttemptsFailed_Network'
      WHEN base_status <> 'Success' AND all_denied THEN 'Scraping_AllAttemptsFailed_AccessDenied'
      WHEN base_status <> 'Success' AND all_missing THEN 'Scraping_ContentNotFound_AllAttempts'
      WHEN base_status <> 'Success' THEN 'ScrapingFailed_Canonical_' || base_status
      WHEN status = 'Already_Processed' THEN 'Canonical_Duplicate_SkippedProcessing'
      WHEN NOT any_candidates THEN 'Canonical_NoRegexCandidatesFound'
      WHEN NOT any_calls THEN 'LLM_NoInput_NoRegexCandidates'
      WHEN raw_numbers = 0 THEN 'LLM_Output_NoNumbersFound_AllAttempts'
      ELSE 'LLM_Output_NumbersFound_NoneRelevant_AllAttempts' END AS reason
  FROM v_entries e LEFT JOIN v_journey j ON e.base = j.base),
v_outcomes AS (
  SELECT *, CASE WHEN reason = 'Contact_Successfully_Extracted' THEN 'N/A'
    WHEN reason = 'Input_URL_Invalid' THEN 'Input Data Issue'
    WHEN reason LIKE 'Scraping%' OR reason LIKE '%MaxRedirects%' THEN 'Website Issue'
    WHEN reason LIKE 'Canonical%' OR reason = 'LLM_NoInput_NoRegexCandidates' THEN 'Pipeline Logic/Configuration'
    WHEN reason LIKE 'LLM%' THEN 'LLM Issue' ELSE 'Unknown' END AS fault FROM v_rows)"""


@query("D1_row_outcomes", s.with_(V_ROWS) + "SELECT input_row_id, reason, fault FROM v_outcomes")
def _(spark, sf):
    return Run(spark, sf).outcomes.select("input_row_id", "reason", "fault")


V_DOMAINS = V_FACTS + """, v_domains0 AS (
  SELECT *, CASE WHEN consolidated > 0 THEN 'Contact_Successfully_Extracted_For_Domain'
    WHEN base_status <> 'Success' AND all_network THEN 'Scraping_AllPathfulsFailed_Network_ForDomain'
    WHEN base_status <> 'Success' AND all_denied THEN 'Scraping_AllPathfulsFailed_AccessDenied_ForDomain'
    WHEN base_status <> 'Success' AND all_missing THEN 'Scraping_AllPathfuls_ContentNotFound_ForDomain'
    WHEN base_status <> 'Success' THEN 'ScrapingFailed_Domain_' || base_status
    WHEN NOT any_candidates AND total_pages = 0 THEN 'Scraping_Success_NoPagesScraped_ForDomain'
    WHEN NOT any_candidates THEN 'Domain_NoRegexCandidatesFound_OnAnyPage'
    WHEN NOT any_calls THEN 'LLM_NotCalled_DespiteRegexCandidates_ForDomain'
    WHEN any_error THEN 'LLM_Processing_Error_Encountered_ForDomain'
    WHEN raw_numbers = 0 THEN 'LLM_Output_NoRawNumbersFound_ForDomain'
    ELSE 'LLM_Output_RawNumbersFound_NoneConsolidated_ForDomain' END AS reason FROM v_journey),
v_domains AS (
  SELECT *, CASE WHEN consolidated > 0 THEN 'N/A' WHEN reason LIKE 'Scraping%' THEN 'Website Issue'
    WHEN reason LIKE 'Domain%' OR reason LIKE 'LLM_NotCalled%' THEN 'Pipeline Logic/Configuration'
    ELSE 'LLM Issue' END AS fault FROM v_domains0)"""


@query("D2_domain_outcomes", s.with_(V_DOMAINS) + "SELECT base, reason, fault FROM v_domains")
def _(spark, sf):
    return Run(spark, sf).domains.select("base", "reason", "fault")


RANKED = """SELECT *, row_number() OVER (PARTITION BY base ORDER BY class_prio, type_prio, first_ord, number) AS rank
  FROM v_numbers"""
def v_lists(name: str, **columns: str) -> str:
    """Pages of sorted source values per base and number, the columns side by side."""
    rows = " UNION ALL ".join(f"SELECT DISTINCT base, number, '{n}' AS c, {src} AS v FROM v_sources WHERE {src} <> ''" for n, src in columns.items())
    picked = ", ".join(f"max(CASE WHEN c = '{n}' THEN cell END) AS {n}" for n in columns)
    return f"{name} AS (SELECT base, number, part, {picked} FROM ({s.pages(rows, 'base, number, c')}) GROUP BY base, number, part)"


V_SUMMARY = V_ROWS + f""", {v_lists('v_cells', types='type', urls='source_url')},
v_best AS (
  SELECT base, {', '.join(f"max(CASE WHEN rank = {i} THEN number END) AS Top_Number_{i}" for i in (1, 2, 3))} FROM ({RANKED}) r GROUP BY base),
v_top AS (
  SELECT base, part, {', '.join(f"max(CASE WHEN rank = {i} THEN {c} END) AS {n}_{i}" for i in (1, 2, 3)
                          for c, n in (("types", "Top_Type"), ("urls", "Top_SourceURL")))}
  FROM ({RANKED}) r JOIN v_cells c USING (base, number) WHERE rank <= 3 GROUP BY base, part),
v_summary AS (
  SELECT o.*, n.* EXCLUDE (base), t.* EXCLUDE (base, part), coalesce(t.part, 0) AS part, CASE WHEN o.base IS NULL THEN 'Unknown_NoTrueBase'
      ELSE coalesce(base_status, 'Unknown') END AS shown_status,
    CASE WHEN normalized_phone IS NULL THEN 'Original_Not_Provided'
      WHEN normalized_phone = 'InvalidFormat' THEN 'Original_InvalidFormat'
      WHEN normalized_phone IN (Top_Number_1, Top_Number_2, Top_Number_3) THEN 'Verified'
      WHEN consolidated > 0 THEN 'Corrected'
      WHEN reason LIKE 'LLM_Output%' THEN 'LLM_OutputEmpty_Or_NoRelevant_For_Canonical'
      WHEN reason LIKE 'LLM_NoInput%' OR reason LIKE 'LLM_Processing_Error%' OR reason LIKE 'ScrapingFailed_Canonical%'
        OR reason = 'Unknown_NoCanonicalURLDetermined' THEN 'LLM_Not_Run_Or_NoOutput_For_Canonical'
      ELSE 'No Relevant Match Found by LLM' END AS number_status
  FROM v_outcomes o LEFT JOIN v_best n ON o.base = n.base LEFT JOIN v_top t ON o.base = t.base),
v_verified AS (
  SELECT *, CASE WHEN regexp_replace(regexp_extract(clean_url, '^http://[^/?#]*'), '//www[.]', '//') <> base
      THEN 'RedirectedTo[' || base || ']_' ELSE '' END || CASE
    WHEN reason = 'Contact_Successfully_Extracted' THEN 'Verified_LLM_Match_Found'
    WHEN reason LIKE 'ScrapingFailed_Canonical%' OR reason LIKE 'Scraping_AllAttempts%'
      OR reason = 'Scraping_ContentNotFound_AllAttempts' THEN 'Unverified_Scrape_' || shown_status
    WHEN reason LIKE 'LLM_Output%' THEN 'Unverified_LLM_NoRelevantNumbers'
    WHEN reason = 'LLM_Processing_Error_AllAttempts' THEN 'Error_LLM_Processing_For_Canonical'
    ELSE 'Unverified' END AS overall,
    CASE WHEN consolidated > 0 THEN 'Processed' ELSE shown_status END AS label_status FROM v_summary)"""


def _summary(spark, sf):
    run = Run(spark, sf, listed=True)
    return rp.summary(run.outcomes, run.numbers, run.sources, RUN)


@query("D3_number_status", s.with_(V_SUMMARY) + 'SELECT input_row_id, number_status AS "Original_Number_Status" FROM v_summary')
def _(spark, sf):
    return _summary(spark, sf).select("input_row_id", "Original_Number_Status")


@query("D4_verification_status", s.with_(V_SUMMARY) + 'SELECT input_row_id, overall AS "Overall_VerificationStatus" FROM v_verified')
def _(spark, sf):
    return _summary(spark, sf).select("input_row_id", "Overall_VerificationStatus")


@query("D5_label_status", s.with_(V_SUMMARY) + 'SELECT input_row_id, label_status AS "LLM_Processing_Status_Canonical" FROM v_verified')
def _(spark, sf):
    return _summary(spark, sf).select("input_row_id", "LLM_Processing_Status_Canonical")


@query("D6_first_pass_status", s.with_(s.V_ENTRIES) + """
SELECT input_row_id, CASE WHEN status = 'InvalidURL' THEN 'Skipped_InvalidURL'
    WHEN status <> 'Success' THEN 'Unverified_Scrape_' || status END AS overall,
  CASE WHEN status IN ('Success', 'InvalidURL') THEN NULL WHEN normalized_phone IS NULL THEN 'Original_Not_Provided'
    ELSE 'Scrape_' || status END AS number_status FROM v_entries""")
def _(spark, sf):
    overall, number = oc.first_pass_status(F.col("status"), F.col("normalized_phone"))
    return Run(spark, sf).entries.select("input_row_id", overall.alias("overall"), number.alias("number_status"))


V_EVENTS = f"""{s.V_ITEM}, {s.V_ENTRIES}, {s.V_SITES}, v_events AS (
  SELECT logged_at AS log_timestamp, input_row_id AS input_row_identifier, company_name AS "CompanyName",
    coalesce(given_url, '') AS "GivenURL",
    CASE WHEN status = 'InvalidURL' THEN 'URL_Validation_InvalidOrMissing' ELSE 'Scraping_' || status END AS stage_of_failure,
    CASE WHEN status = 'InvalidURL' THEN 'Invalid or missing URL after processing: ' || coalesce(clean_url, 'None')
      ELSE 'Scraper returned status: ' || status END AS error_reason,
    CASE WHEN status <> 'InvalidURL' THEN '{{' || concat_ws(',', '"pathful_canonical_url":"' || pathful_url || '"',
        '"true_base_domain":"' || base || '"') || '}}'
      ELSE '{{' || concat_ws(',', '"original_url":"' || given_url || '"', '"processed_url":"' || clean_url || '"') || '}}'
      END AS error_details,
    CASE WHEN status = 'InvalidURL' THEN '' ELSE coalesce(pathful_url, '') END AS "Associated_Pathful_Canonical_URL"
  FROM v_entries WHERE status <> 'Success'
  UNION ALL
  SELECT e.logged_at, e.input_row_id, e.company_name, coalesce(e.given_url, ''), 'LLM_Processing_GeneralError',
    'LLM processing error', '{{"canonical_url":"' || x.pathful_url || '","exception_message":"' || x.error || '"}}', x.pathful_url
  FROM v_sites x JOIN v_entries e ON e.input_row_id = x.ord WHERE x.error IS NOT NULL)"""


@query("D7_failure_events", s.with_(V_EVENTS) + "SELECT * FROM v_events")
def _(spark, sf):
    return Run(spark, sf).events


@query("D7_all_stages", s.with_(V_EVENTS) + """SELECT stage_of_failure, input_row_identifier, error_reason, error_details, "Associated_Pathful_Canonical_URL" FROM v_events
UNION ALL SELECT 'Regex_Extraction_FileReadError', ord, 'Error reading scraped content file',
  '{"file_path":"' || base || '/p3","canonical_url":"' || pathful_url || '","exception":"not valid UTF-8"}', pathful_url FROM v_sites WHERE pages > 2
UNION ALL SELECT 'LLM_Setup_PromptTemplateMissing', ord, 'LLM prompt template file not found',
  '{"canonical_url":"' || pathful_url || '","prompt_path":""}', pathful_url FROM v_sites WHERE candidates = 5
UNION ALL SELECT 'RowProcessing_Pass1_UnhandledException', input_row_id, 'Unhandled exception during Pass 1 row processing',
  '{"exception_type":"InvalidText","exception_message":"not valid UTF-8: company_name"}', '' FROM v_entries WHERE company_name IS NULL""")
def _(spark, sf):
    """All six stages: pages of three were not readable, sites of five candidates had no template, rows without a name were faulty."""
    run = Run(spark, sf)
    none = F.lit(None).cast("string")
    unread = run.sites.filter("pages > 2").select(F.col("ord").alias("input_row_id"), "pathful_url", F.concat("base", F.lit("/p3")).alias("file_path"),
                                                  F.lit("not valid UTF-8").alias("exception"))
    unasked = run.sites.filter("candidates = 5").select("pathful_url", none.alias("template"))
    # Names that are missing stand for names whose bytes are no text.
    named = b.entries(spark, sf).withColumn("company_name", F.coalesce("company_name", F.unhex(F.lit("ff")).cast("string")))
    faulty, _ = oc.row_errors(named.select("input_row_id", "company_name", "given_url", "logged_at"))
    events = oc.failure_events(run.entries, run.sites, unread, unasked, faulty)
    return events.select("stage_of_failure", "input_row_identifier", "error_reason", "error_details", "Associated_Pathful_Canonical_URL")


@query("R9_failed_rows", s.with_(V_EVENTS) + """
SELECT *, CASE WHEN stage_of_failure LIKE 'Scraping%' THEN 'Scraping' WHEN stage_of_failure LIKE 'LLM%' THEN 'LLM'
  ELSE 'URL Validation' END AS failure_group FROM v_events""")
def _(spark, sf):
    return Run(spark, sf).events.withColumn("failure_group", oc.failure_group(F.col("stage_of_failure")))


@query("S10_failure_log", s.with_(s.V_FETCH) + f"""
SELECT event_id, ts AS log_timestamp, 'line one two' AS error_reason, props || ' x' AS error_details
FROM v_fetch WHERE NOT has_content""")
def _(spark, sf):
    from callsheet.functions.text import one_line

    bad = b.fetches(spark, sf).filter(~F.col("has_content"))
    return bad.select("event_id", F.col("ts").alias("log_timestamp"),
                      one_line(F.lit("line one\ntwo\r")).alias("error_reason"),
                      one_line(F.concat("props", F.lit("\r\nx"))).alias("error_details"))


# --- joins ----------------------------------------------------------------------------------------
@query("J1_rows_with_contacts", s.with_(V_FACTS) + """
SELECT input_row_id, n.number FROM v_entries e LEFT JOIN (SELECT base, min(number) AS number FROM v_numbers GROUP BY base) n
  ON e.base = n.base""")
def _(spark, sf):
    run = Run(spark, sf)
    best = run.numbers.groupBy("base").agg(F.min("number").alias("number"))
    return run.entries.select("input_row_id", "base").join(best, "base", "left").select("input_row_id", "number")


V_HEADERS = f"""{s.V_NUMBERS}, {s.V_ENTRIES}, v_bases AS (SELECT DISTINCT base FROM v_good),
v_names AS ({s.pages("SELECT DISTINCT base, company_name AS v FROM v_entries WHERE company_name IS NOT NULL AND base IS NOT NULL", "base", sep=" - ")}),
v_given AS ({s.pages("SELECT DISTINCT base, given_url AS v FROM v_entries WHERE given_url IS NOT NULL AND base IS NOT NULL", "base")}),
v_own AS ({s.pages("SELECT base, source_url AS v FROM v_good UNION SELECT base, base FROM v_good", "base")}),
v_headers AS (
  SELECT base, part, CASE WHEN part = 0 THEN base || ' - ' || coalesce(n.cell, 'Unknown') ELSE n.cell END AS "CompanyName",
    coalesce(g.cell, o.cell) AS "GivenURL"
  FROM (SELECT base, 0 AS part FROM v_bases UNION SELECT base, part FROM v_names SEMI JOIN v_bases USING (base)
      UNION SELECT base, part FROM v_given SEMI JOIN v_bases USING (base)
      UNION SELECT base, part FROM v_own ANTI JOIN v_given USING (base)) p
    LEFT JOIN v_names n USING (base, part) LEFT JOIN v_given g USING (base, part)
    LEFT JOIN (SELECT * FROM v_own ANTI JOIN v_given USING (base)) o USING (base, part))"""


@query("J2_domain_headers", s.with_(V_HEADERS) + "SELECT * FROM v_headers")
def _(spark, sf):
    run = Run(spark, sf)
    return rp.domain_headers(run.entries, run.sources.select("base").distinct(), ct.original_urls(run.sources))


@query("A12_header_texts", s.with_(V_HEADERS) + 'SELECT base, part, "CompanyName" FROM v_headers')
def _(spark, sf):
    run = Run(spark, sf)
    return rp.domain_headers(run.entries, run.sources.select("base").distinct(),
                             ct.original_urls(run.sources)).select("base", "part", "CompanyName")


@query("J3_base_to_sites", s.with_(s.V_ENTRIES) + """
SELECT base, count(DISTINCT pathful_url) AS sites FROM v_entries WHERE base IS NOT NULL GROUP BY base""")
def _(spark, sf):
    return Run(spark, sf).entries.filter(F.col("base").isNotNull()).groupBy("base").agg(
        F.countDistinct("pathful_url").alias("sites"))


@query("J4_status_lookup", s.with_(V_FACTS) + """
SELECT input_row_id, CASE WHEN e.base IS NULL THEN 'Unknown_NoTrueBase' ELSE coalesce(base_status, 'Unknown') END AS status
FROM v_entries e LEFT JOIN v_facts f ON e.base = f.base""")
def _(spark, sf):
    run = Run(spark, sf)
    j = run.entries.select("input_row_id", "base").join(ct.base_status(run.sites), "base", "left")
    return j.select("input_row_id", oc.shown_base_status(F.col("base"), F.col("base_status")).alias("status"))


V_FIRST = s.V_ENTRIES + """, v_first AS (
  SELECT pathful_url, min(input_row_id) AS input_row_id FROM v_entries WHERE pathful_url IS NOT NULL GROUP BY 1)"""


@query("J5_first_site_rows", s.with_(V_FIRST) + """
SELECT e.input_row_id, e.pathful_url, f.input_row_id AS done_by FROM v_entries e JOIN v_first f ON e.pathful_url = f.pathful_url""")
def _(spark, sf):
    rows = Run(spark, sf).entries.filter(F.col("pathful_url").isNotNull()).select("input_row_id", "pathful_url")
    first = crawl.first_visits(rows, "pathful_url", ["input_row_id"]).withColumnRenamed("input_row_id", "done_by")
    return rows.join(first, "pathful_url").select("input_row_id", "pathful_url", "done_by")


@query("W5_first_visits", s.with_(V_FIRST) + "SELECT * FROM v_first")
def _(spark, sf):
    rows = Run(spark, sf).entries.filter(F.col("pathful_url").isNotNull()).select("input_row_id", "pathful_url")
    return crawl.first_visits(rows, "pathful_url", ["input_row_id"])


@query("J6_rows_without_contact", s.with_(V_FACTS) + """
SELECT input_row_id FROM v_entries e WHERE NOT EXISTS (SELECT 1 FROM v_numbers n WHERE n.base = e.base)""")
def _(spark, sf):
    run = Run(spark, sf)
    return run.entries.join(run.numbers.select("base"), "base", "left_anti").select("input_row_id")


@query("J7_outcome_link", s.with_(s.V_ENTRIES) + """
, last_map AS (SELECT given_url, arg_max(base, input_row_id) AS mapped FROM v_entries
  WHERE base IS NOT NULL GROUP BY 1)
SELECT input_row_id, coalesce(e.base, m.mapped) AS linked FROM v_entries e LEFT JOIN last_map m ON e.given_url = m.given_url""")
def _(spark, sf):
    rows = Run(spark, sf).entries.select("input_row_id", "given_url", "base")
    last = rows.filter(F.col("base").isNotNull()).groupBy("given_url").agg(
        F.max_by("base", "input_row_id").alias("mapped"))
    return rows.join(last, "given_url", "left").select(
        "input_row_id", F.coalesce("base", "mapped").alias("linked"))


@query("J8_fault_lookup", s.with_(V_ROWS) + """
SELECT input_row_id, reason, CASE WHEN reason LIKE 'Scraping%Canonical%' OR reason LIKE 'ScrapingFailure%'
  OR reason IN ('Contact_Successfully_Extracted', 'Unknown_NoCanonicalURLDetermined') THEN NULL ELSE fault END AS fault
FROM v_outcomes""")
def _(spark, sf):
    rows = Run(spark, sf).outcomes.select("input_row_id", "reason")
    return rows.join(F.broadcast(oc.fault_table(spark)), "reason", "left")


@query("J12_compound_key", """
SELECT s_suppkey, n_name, count(*) AS n FROM supplier JOIN nation ON s_nationkey = n_nationkey
JOIN customer ON c_nationkey = s_nationkey AND c_custkey % 10 = s_suppkey % 10 GROUP BY ALL""")
def _(spark, sf):
    sup = b.table(spark, sf, "supplier").select("s_suppkey", "s_nationkey", (F.col("s_suppkey") % 10).alias("d"))
    cust = b.table(spark, sf, "customer").groupBy(
        F.col("c_nationkey").alias("s_nationkey"), (F.col("c_custkey") % 10).alias("d")).agg(
        F.count(F.lit(1)).alias("n"))
    nation = b.table(spark, sf, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    return sup.join(cust, ["s_nationkey", "d"]).join(nation, "s_nationkey").select("s_suppkey", "n_name", "n")


@query("J13_prefix_lookup", f"""WITH codes AS (SELECT unnest({sorted(DIAL_CODE_SET)}) AS code),
k AS (SELECT o_orderkey, (o_orderkey * 104729 % 1000000)::VARCHAR AS digits FROM orders)
SELECT o_orderkey, arg_max(code, length(code)) AS dial_code FROM k LEFT JOIN codes ON starts_with(digits, code) GROUP BY o_orderkey""")
def _(spark, sf):
    """Longest dial-code prefix by equality, one look-up per length that codes have."""
    digits = (F.col("o_orderkey") * 104729 % 1000000).cast("string")
    rows = b.table(spark, sf, "orders").select("o_orderkey", digits.alias("digits"))
    lengths = sorted({len(c) for c in DIAL_CODE_SET}, reverse=True)
    codes = F.broadcast(spark.createDataFrame([(c,) for c in sorted(DIAL_CODE_SET)], "code string"))  # the fixed set of calling codes
    for n in lengths:
        rows = rows.join(codes.withColumnRenamed("code", f"code_{n}"), F.substring("digits", 1, n) == F.col(f"code_{n}"), "left")
    return rows.select("o_orderkey", F.coalesce(*[F.col(f"code_{n}") for n in lengths]).alias("dial_code"))


# --- reports ---------------------------------------------------------------------------------------
SEEN = "SELECT base, number, {0} AS v, min(ord) AS o FROM v_sources WHERE {0} IS NOT NULL GROUP BY ALL"
DETAILED_SQL = s.with_(V_FACTS) + f""", t AS ({s.pages(SEEN.format('type'), 'base, number', 'o, v')}),
u AS ({s.pages(SEEN.format('source_url'), 'base, number', 'o, v')}),
p AS (SELECT base, number, part FROM t UNION SELECT base, number, part FROM u)
SELECT company_name AS "CompanyName", n.number AS "Number", t.cell AS "LLM_Type", n.classification AS "LLM_Classification",
  u.cell AS "LLM_Source_URL", 'Success' AS "ScrapingStatus", target_countries AS "TargetCountryCodes",
  '{RUN}' AS "RunID", p.part
FROM v_entries e JOIN v_facts f ON e.base = f.base AND base_status = 'Success' JOIN v_numbers n ON n.base = e.base
JOIN p ON p.base = n.base AND p.number = n.number LEFT JOIN t ON t.base = n.base AND t.number = n.number AND t.part = p.part
LEFT JOIN u ON u.base = n.base AND u.number = n.number AND u.part = p.part"""


@query("R1_detailed", DETAILED_SQL)
def _(spark, sf):
    run = Run(spark, sf, listed=True)
    return rp.detailed(rp.detailed_rows(run.entries), rp.detailed_numbers(run.journey, run.numbers, run.sources), RUN)


@query("R1_detailed_factors", s.with_(V_FACTS) + """, t AS (SELECT base, count(*) AS n_rows FROM v_entries WHERE base IS NOT NULL GROUP BY base)
SELECT n.base, n.number, n.classification, t.n_rows FROM v_numbers n JOIN v_facts f ON f.base = n.base AND base_status = 'Success'
LEFT JOIN t ON t.base = n.base""")
def _(spark, sf):
    """What is stored in place of the report, with the rows that each number is shown for."""
    run = Run(spark, sf, listed=True)
    per_base = rp.detailed_rows(run.entries).groupBy("base").agg(F.count(F.lit(1)).alias("n_rows"))
    numbers = rp.detailed_numbers(run.journey, run.numbers, run.sources).filter("part = 0")
    return numbers.select("base", "number", "classification").join(per_base, "base", "left")


@query("K3_detailed_sorted", DETAILED_SQL)
def _(spark, sf):
    run = Run(spark, sf, listed=True)
    return rp.sort_detailed(rp.detailed(rp.detailed_rows(run.entries), rp.detailed_numbers(run.journey, run.numbers, run.sources), RUN))


WIDE = ", ".join(f'Top_{k}_{i} AS "Top_{k}_{i}"' for i in (1, 2, 3) for k in ("Number", "Type", "SourceURL"))


@query("R2_summary", s.with_(V_SUMMARY) + f"""
SELECT input_row_id, company_name AS "CompanyName", given_url AS "GivenURL", given_phone AS "GivenPhoneNumber",
  number_status AS "Original_Number_Status", description AS "Description", shown_status AS "ScrapingStatus_Canonical",
  base AS "CanonicalEntryURL", {WIDE}, overall AS "Overall_VerificationStatus",
  label_status AS "LLM_Processing_Status_Canonical", reason AS "Final_Row_Outcome_Reason",
  fault AS "Determined_Fault_Category", target_countries AS "TargetCountryCodes", '{RUN}' AS "RunID", part FROM v_verified""")
def _(spark, sf):
    return _summary(spark, sf)


@query("F12_summary_columns", s.with_(V_SUMMARY) + """
SELECT company_name AS "CompanyName", given_url AS "GivenURL", given_phone AS "GivenPhoneNumber",
  Top_Number_1 AS "Top_Number_1", Top_Type_1 AS "Top_Type_1" FROM v_summary""")
def _(spark, sf):
    return _summary(spark, sf).select("CompanyName", "GivenURL", "GivenPhoneNumber", "Top_Number_1", "Top_Type_1")


V_FINAL = f"""{V_FACTS}, {V_HEADERS[len(s.V_NUMBERS) + len(s.V_ENTRIES) + 4:]}, {v_lists('v_three', types='type', urls='source_url', companies='company')},
v_parts AS (
  SELECT *, number || ' (' || coalesce(types, '') || ') [' || coalesce(companies, CASE WHEN part = 0 THEN 'UnknownCompany' ELSE '' END) || ']' AS shown
  FROM v_three WHERE part = 0 OR types IS NOT NULL OR companies IS NOT NULL OR urls IS NOT NULL),
v_few AS (
  SELECT base, part, {', '.join(f'max(CASE WHEN rank = {i} THEN {c} END) AS "{n}_{i}"' for i in (1, 2, 3)
        for c, n in (("CASE WHEN part = 0 OR types IS NOT NULL OR companies IS NOT NULL THEN shown END", "PhoneNumber"), ("urls", "SourceURL")))}
  FROM ({RANKED} WHERE classification <> 'Non-Business' AND NOT has_excluded_type) r JOIN v_parts USING (base, number)
  WHERE rank <= 3 GROUP BY base, part),
v_final AS (
  SELECT h."CompanyName", h."GivenURL", base AS "CanonicalEntryURL", coalesce(base_status, 'Unknown') AS "ScrapingStatus",
    w.* EXCLUDE (base, part), part
  FROM (SELECT base, part FROM v_few UNION SELECT base, part FROM v_headers SEMI JOIN v_few USING (base)) p
    LEFT JOIN v_few w USING (base, part) LEFT JOIN v_headers h USING (base, part) LEFT JOIN v_facts f USING (base))"""


@query("R3_final_contacts", s.with_(V_FINAL) + "SELECT * FROM v_final")
def _(spark, sf):
    return Run(spark, sf, listed=True).final


@query("F11_rows_with_phone", s.with_(V_FINAL) + 'SELECT "CanonicalEntryURL" FROM v_final')
def _(spark, sf):
    return Run(spark, sf, listed=True).final.filter(F.coalesce("PhoneNumber_1", "PhoneNumber_2", "PhoneNumber_3").isNotNull()
                                       ).select("CanonicalEntryURL")


@query("R4_processed_contacts", s.with_(V_FINAL) + """
SELECT 'example' AS "Company Name", "CanonicalEntryURL" AS "URL", split_part("PhoneNumber_1", ' (', 1) AS "Number",
  split_part(split_part("PhoneNumber_1", ' (', 2), ')', 1) AS "Number Type", "SourceURL_1" AS "Number Found At", part FROM v_final""")
def _(spark, sf):
    return rp.processed_contacts(Run(spark, sf, listed=True).final)


YES = "CASE WHEN {} THEN 'Yes' ELSE 'No' END"
V_ATTRITION = V_ROWS + ", " + V_KEYS[len(s.V_ENTRIES) + 2:] + f""", v_attrition AS (
  SELECT o.input_row_id AS "InputRowID", o.company_name AS "CompanyName", coalesce(o.given_url, '') AS "GivenURL",
    nullif(d.host_key, 'MISSING_OR_INVALID_URL_INPUT') AS "Derived_Input_CanonicalURL",
    o.base AS "Final_Processed_Canonical_Domain", o.base AS "Link_To_Canonical_Domain_Outcome",
    reason AS "Final_Row_Outcome_Reason", fault AS "Determined_Fault_Category",
    coalesce(o.base, 'N/A') AS "Relevant_Canonical_URLs",
    CASE WHEN reason = 'LLM_Processing_Error_AllAttempts' THEN base_error ELSE '' END AS "LLM_Error_Detail_Summary",
    name_count AS "Input_CompanyName_Total_Count", host_count AS "Input_CanonicalURL_Total_Count",
    {YES.format('name_dup')} AS "Is_Input_CompanyName_Duplicate", {YES.format('host_dup')} AS "Is_Input_CanonicalURL_Duplicate",
    {YES.format('name_dup OR host_dup')} AS "Is_Input_Row_Considered_Duplicate", o.logged_at AS "Timestamp_Of_Determination"
  FROM v_outcomes o JOIN v_dups d ON o.input_row_id = d.input_row_id WHERE reason <> 'Contact_Successfully_Extracted')"""


@query("R5_attrition", s.with_(V_ATTRITION) + "SELECT * FROM v_attrition")
def _(spark, sf):
    return Run(spark, sf).attrition


MEMBERS = " UNION ALL ".join(f"SELECT DISTINCT base, '{n}' AS c, {v} AS v FROM v_entries WHERE base IS NOT NULL AND {v} IS NOT NULL" for n, v in (
    ("ids", "input_row_id::VARCHAR"), ("names", "company_name"), ("given", "given_url"), ("paths", "pathful_url"))) + """
  UNION ALL SELECT base, 'errors', 'PathfulURL (' || pathful_url || '): ' || error FROM v_sites WHERE error IS NOT NULL
  UNION ALL SELECT base, 'types', '"' || type || '": ' || count(*) FROM v_sources WHERE type IS NOT NULL GROUP BY base, type"""


@query("R6_domain_summary", s.with_(V_DOMAINS) + f""", l AS (
  SELECT base, part, {', '.join(f"coalesce(max(CASE WHEN c = '{c}' THEN cell END), '') AS {c}" for c in ('ids', 'names', 'given', 'paths', 'errors', 'types'))}
  FROM ({s.pages(MEMBERS, 'base, c')}) GROUP BY base, part)
SELECT d.base AS "Canonical_Domain", ids AS "Input_Row_IDs", names AS "Input_CompanyNames", given AS "Input_GivenURLs",
  paths AS "Pathful_URLs_Attempted_List", base_status AS "Overall_Scraper_Status_For_Domain",
  total_pages AS "Total_Pages_Scraped_For_Domain", page_types_json AS "Scraped_Pages_Details_Aggregated",
  any_candidates AS "Regex_Candidates_Found_For_Any_Pathful", any_calls AS "LLM_Calls_Made_For_Domain",
  raw_numbers AS "LLM_Total_Raw_Numbers_Extracted", consolidated AS "LLM_Total_Consolidated_Numbers_Found",
  '{{' || types || '}}' AS "LLM_Consolidated_Number_Types_Summary", any_error AS "LLM_Processing_Error_Encountered_For_Domain",
  errors AS "LLM_Error_Messages_Aggregated", part, reason AS "Final_Domain_Outcome_Reason",
  fault AS "Primary_Fault_Category_For_Domain"
FROM v_domains d JOIN l ON d.base = l.base""")
def _(spark, sf):
    run = Run(spark, sf, listed=True)
    return rp.domain_summary(run.domains, jn.member_pages(run.entries, run.sites, run.sources))


@query("R7_augmented_input", s.with_(V_SUMMARY) + """
SELECT input_row_id, company_name AS "Unternehmen", given_url AS "Webseite", coalesce(Top_Number_1, '') AS "Telefonnummer"
FROM v_summary""")
def _(spark, sf):
    run = Run(spark, sf)
    original = run.entries.select("input_row_id", F.col("company_name").alias("Unternehmen"),
                                  F.col("given_url").alias("Webseite"), F.col("given_phone").alias("Telefonnummer"))
    best = ct.wide(ct.top_numbers(run.numbers, 1), {"number": "Top_Number_"}, 1)
    rows = run.entries.select("input_row_id", "base").join(best, "base", "left")
    return rp.augmented_input(original, rows, "Telefonnummer")


@query("J10_best_number", s.with_(V_SUMMARY) + "SELECT input_row_id, Top_Number_1 AS number FROM v_summary")
def _(spark, sf):
    run = Run(spark, sf)
    best = ct.wide(ct.top_numbers(run.numbers, 1), {"number": "number_"}, 1)
    return run.entries.select("input_row_id", "base").join(best, "base", "left").select(
        "input_row_id", F.col("number_1").alias("number"))


# --- metrics ------------------------------------------------------------------------------------------
V_ROLLUP = """SELECT CASE WHEN stage_of_failure LIKE 'Scraping%' THEN 'Scraping' WHEN stage_of_failure LIKE 'LLM%' THEN 'LLM'
  ELSE 'URL Validation' END AS failure_group, stage_of_failure AS stage, count(*) AS n FROM v_events GROUP BY 1, 2
UNION ALL SELECT CASE WHEN stage_of_failure LIKE 'Scraping%' THEN 'Scraping' WHEN stage_of_failure LIKE 'LLM%' THEN 'LLM'
  ELSE 'URL Validation' END, NULL, count(*) FROM v_events GROUP BY 1"""


@query("A13_failure_rollup", s.with_(V_EVENTS) + V_ROLLUP)
def _(spark, sf):
    return mt.failure_rollup(Run(spark, sf).events)


@query("A14_fault_counts", s.with_(V_ROWS) + """
SELECT fault, count(*) AS n FROM v_outcomes WHERE reason <> 'Contact_Successfully_Extracted' GROUP BY fault""")
def _(spark, sf):
    return mt.fault_counts(Run(spark, sf).outcomes)


YIELD = """SELECT count(*) AS input_rows, count(*) FILTER (reason = 'Contact_Successfully_Extracted') AS rows_with_contact,
  count(*) FILTER (reason <> 'Contact_Successfully_Extracted') AS rows_without_contact FROM v_outcomes"""


@query("A14_yield", s.with_(V_ROWS) + YIELD)
def _(spark, sf):
    return mt.yield_counts(Run(spark, sf).outcomes)


DUP_SQL = """SELECT count(*) AS attrition_rows, count(*) FILTER ("Is_Input_CompanyName_Duplicate" = 'Yes') AS dup_name,
  count(*) FILTER ("Is_Input_CanonicalURL_Duplicate" = 'Yes') AS dup_url,
  count(*) FILTER ("Is_Input_Row_Considered_Duplicate" = 'Yes') AS dup_any FROM v_attrition"""


@query("A15_attrition_duplicates", s.with_(V_ATTRITION) + DUP_SQL)
def _(spark, sf):
    return mt.attrition_duplicates(Run(spark, sf).attrition)


@query("A16_domain_outcomes", s.with_(V_DOMAINS) + "SELECT reason, count(*) AS n FROM v_domains GROUP BY reason")
def _(spark, sf):
    return mt.domain_outcome_counts(Run(spark, sf).domains)


@query("A16_domain_faults", s.with_(V_DOMAINS) + """
SELECT fault, count(*) AS n FROM v_domains WHERE fault <> 'N/A' GROUP BY fault""")
def _(spark, sf):
    return mt.domain_fault_counts(Run(spark, sf).domains)


@query("A17_pages_by_type", s.with_(s.V_ITEM, s.V_ENTRIES, s.V_SITES) + """
SELECT page_type, count(*) AS pages FROM v_site_pages GROUP BY page_type""")
def _(spark, sf):
    return mt.page_stats(Run(spark, sf).pages)


SITE_STATS = """SELECT count(*) FILTER (status = 'Success') AS sites_scraped,
  sum(pages)::BIGINT AS pages_scraped, count(*) FILTER (status = 'Success' AND candidates > 0) AS sites_with_candidates,
  sum(candidates)::BIGINT AS candidates_found, count(*) FILTER (label_called) AS sites_labelled,
  count(error) AS label_errors, count(*) FILTER (status = 'Success' AND candidates = 0) AS sites_without_candidates,
  sum(raw_numbers)::BIGINT AS raw_numbers, sum(pages) / count(*) FILTER (status = 'Success')::DOUBLE AS pages_per_site
  FROM v_sites"""


@query("A17_site_stats", s.with_(s.V_ITEM, s.V_ENTRIES, s.V_SITES) + SITE_STATS)
def _(spark, sf):
    return mt.site_stats(Run(spark, sf).sites)


@query("A18_token_averages", s.with_(s.V_RESPONSES) + """
SELECT round(sum(prompt_tokens)::DOUBLE / count(*), 6) AS prompt, round(sum(completion_tokens)::DOUBLE / count(*), 6) AS completion,
  round(sum(total_tokens)::DOUBLE / count(*), 6) AS total, CAST(NULL AS DOUBLE) AS per_none FROM v_responses""")
def _(spark, sf):
    t = lb.token_totals(b.responses(spark, sf))
    per = lambda c: F.round(mt.average(F.col(c), F.col("calls")), 6)
    return t.select(per("prompt_tokens").alias("prompt"), per("completion_tokens").alias("completion"),
                    per("total_tokens").alias("total"),
                    mt.average(F.col("total_tokens"), F.col("calls") - F.col("calls")).alias("per_none"))


@query("A19_task_durations", """SELECT event_type AS task, round(sum(value), 4) AS seconds, count(*) AS items,
  round(sum(value) / count(*), 6) AS seconds_per_item FROM events GROUP BY event_type""")
def _(spark, sf):
    tasks = b.fetches(spark, sf).select(F.col("event_type").alias("task"), F.col("value").alias("seconds"))
    return mt.task_durations(tasks).select("task", F.round("seconds", 4).alias("seconds"), "items",
                                           F.round("seconds_per_item", 6).alias("seconds_per_item"))


def _pairs(select: str, section: str) -> str:
    return f"SELECT '{section}' AS section, name AS metric, '' AS key, value::DOUBLE AS value FROM (UNPIVOT (SELECT COLUMNS(*)::DOUBLE FROM ({select})) ON COLUMNS(*))"


PROFILE_SQL = """SELECT count(*) AS input_rows, count(*) FILTER (name_dup) AS rows_dup_name, count(*) FILTER (host_dup) AS rows_dup_url,
  count(*) FILTER (name_dup OR host_dup) AS rows_dup_any, count(DISTINCT company_name) AS distinct_names,
  count(DISTINCT company_name) FILTER (name_dup) AS names_repeated, count(DISTINCT host_key) AS distinct_urls,
  count(DISTINCT host_key) FILTER (host_dup) AS urls_repeated FROM v_dups"""
R8_SQL = (s.with_(V_ATTRITION + ", " + V_DOMAINS[len(V_FACTS) + 2:] + ", " + V_EVENTS[V_EVENTS.index("v_events AS"):])
          + " UNION ALL ".join([
              _pairs(PROFILE_SQL, "input_duplicates"), _pairs(DUP_SQL, "attrition_duplicates"),
              _pairs(YIELD, "attrition"),
              "SELECT 'attrition', 'fault', fault, count(*)::DOUBLE FROM v_outcomes WHERE reason <> 'Contact_Successfully_Extracted' GROUP BY fault",
              _pairs(SITE_STATS, "sites"),
              "SELECT 'pages', 'by_type', page_type, count(*)::DOUBLE FROM v_site_pages GROUP BY page_type",
              "SELECT 'domains', 'outcome', reason, count(*)::DOUBLE FROM v_domains GROUP BY reason",
              "SELECT 'domains', 'fault', fault, count(*)::DOUBLE FROM v_domains WHERE fault <> 'N/A' GROUP BY fault",
              f"SELECT 'failures', 'stage', failure_group || '/' || coalesce(stage, '(total)'), n::DOUBLE FROM ({V_ROLLUP})",
              "SELECT 'reports', 'rows', 'summary', count(*)::DOUBLE FROM v_entries",
              "SELECT 'reports', 'rows', 'domain_summary', count(*)::DOUBLE FROM v_domains"]))


@query("R8_run_metrics", R8_SQL)
def _(spark, sf):
    run = Run(spark, sf)
    size = lambda df, name: df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("report"), "n")
    sizes = size(run.entries, "summary").unionByName(size(run.domains, "domain_summary"))
    return mt.run_metrics(run.entries, run.outcomes, run.attrition, run.domains, run.events, run.pages,
                          run.sites, sizes)


# --- analysis ---------------------------------------------------------------------------------------------
@query("A20_reason_counts", s.with_(V_ROWS) + "SELECT reason, count(*) AS n FROM v_outcomes GROUP BY reason")
def _(spark, sf):
    return an.value_counts(Run(spark, sf).outcomes, "reason")


GROUPED = """SELECT description, reason, count(*) AS n FROM v_outcomes GROUP BY ALL"""


@query("A21_reasons_by_segment", s.with_(V_ROWS) + GROUPED)
def _(spark, sf):
    return an.group_value_counts(Run(spark, sf).outcomes, "description", "reason")


def _top(c: str) -> str:
    seen = f"(SELECT {c}::VARCHAR AS v, count(*) AS n FROM orders WHERE {c} IS NOT NULL GROUP BY {c})"
    return ", ".join([f"(SELECT count(*) FROM {seen}) AS \"distinct\"",
                      f"(SELECT v FROM {seen} ORDER BY n DESC, v LIMIT 1) AS top", f"(SELECT max(n) FROM {seen}) AS top_n"])


@query("A22_profile", f"""SELECT * FROM (
SELECT 'o_totalprice' AS "column", count(o_totalprice) AS filled, count(*) - count(o_totalprice) AS nulls,
  min(o_totalprice) AS min, max(o_totalprice) AS max, round(avg(o_totalprice), 2) AS mean,
  round(stddev_samp(o_totalprice), 2) AS std, {_top('o_totalprice')} FROM orders
UNION ALL SELECT 'o_orderstatus', count(o_orderstatus), count(*) - count(o_orderstatus), NULL, NULL, NULL, NULL, {_top('o_orderstatus')}
FROM orders)""")
def _(spark, sf):
    p = an.profile(b.table(spark, sf, "orders"), ["o_totalprice"], ["o_orderstatus"])
    return p.withColumn("mean", F.round("mean", 2)).withColumn("std", F.round("std", 2))


@query("A22_profile_sketch", """SELECT 'l_extendedprice' AS "column", count(l_extendedprice) AS filled, min(l_extendedprice) AS min,
  max(l_extendedprice) AS max, true AS distinct_near, NULL AS top, NULL AS top_n FROM lineitem
UNION ALL SELECT 'l_returnflag', count(l_returnflag), NULL, NULL, true, (SELECT l_returnflag FROM lineitem GROUP BY ALL ORDER BY count(*) DESC LIMIT 1),
  (SELECT count(*) FROM lineitem GROUP BY l_returnflag ORDER BY 1 DESC LIMIT 1) FROM lineitem
UNION ALL SELECT 'l_partkey', count(l_partkey), min(l_partkey)::DOUBLE, max(l_partkey)::DOUBLE, true, NULL, NULL FROM lineitem""")
def _(spark, sf):
    """One pass of sketches; distinct counts are within a tenth of the exact ones, few values are counted exactly."""
    items = b.table(spark, sf, "lineitem")
    got = an.profile_sketch(items, ["l_extendedprice", "l_partkey"], ["l_returnflag"])
    exact = items.agg(*[F.countDistinct(c).alias(c) for c in ("l_extendedprice", "l_partkey", "l_returnflag")]).select(F.inline(F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).alias("exact")) for c in ("l_extendedprice", "l_partkey", "l_returnflag")])))
    few = F.col("column") == "l_returnflag"
    return got.join(exact, "column").select(
        "column", "filled", "min", "max", (F.abs(F.col("distinct") - F.col("exact")) <= F.col("exact") / 10).alias("distinct_near"),
        F.when(few, F.col("top")).alias("top"), F.when(few, F.col("top_n")).alias("top_n"))


@query("J11_adjusted_join", s.with_(V_ATTRITION) + """
SELECT "InputRowID", "Final_Row_Outcome_Reason", c_name AS name_input, c_nationkey AS characteristic
FROM v_attrition LEFT JOIN customer ON c_custkey = "InputRowID" - 2""")
def _(spark, sf):
    rows = b.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("input_row_id"), F.col("c_name").alias("company_name"),
        F.col("c_nationkey").alias("characteristic"))
    j = an.join_on_adjusted_id(Run(spark, sf).attrition, rows, 2)
    return j.select("InputRowID", "Final_Row_Outcome_Reason", F.col("CompanyName_input").alias("name_input"),
                    "characteristic")


@query("K4_top_reasons", s.with_(V_ROWS) + """, c AS (SELECT reason, count(*) AS n FROM v_outcomes GROUP BY reason),
r AS (SELECT *, row_number() OVER (ORDER BY n DESC, reason) AS rn FROM c)
SELECT reason, n FROM r WHERE rn <= 5
UNION ALL SELECT 'plus ' || count(*) || ' other reasons', sum(n)::BIGINT FROM r WHERE rn > 5""")
def _(spark, sf):
    return an.top_with_rest(an.value_counts(Run(spark, sf).outcomes, "reason"), "reason", 5)


@query("K5_largest_groups", s.with_(V_ROWS) + f"{GROUPED} ORDER BY n DESC, description, reason LIMIT 10")
def _(spark, sf):
    counts = an.group_value_counts(Run(spark, sf).outcomes, "description", "reason")
    return an.largest(counts, ["description", "reason"], 10)


@query("K6_sorted_histogram", s.with_(V_DOMAINS) + "SELECT reason, count(*) AS n FROM v_domains GROUP BY reason ORDER BY reason")
def _(spark, sf):
    return mt.domain_outcome_counts(Run(spark, sf).domains).orderBy("reason")


@query("K7_preview", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey >= 100 AND o_orderkey < 140")
def _(spark, sf):
    return an.preview(b.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), "o_orderkey", 100, 40)


@query("X5_links_minus_visited", None)
def _(spark, sf):
    found = b.links(spark, sf).select("link_url").distinct()
    seen = b.pages_html(spark, sf).select(F.col("page_url").alias("link_url"))
    return found.join(seen, "link_url", "left_anti")


# --- from raw texts to the contact report -------------------------------------------------------------------
def contacts_from_texts(spark, sf) -> DataFrame:
    """Texts to candidates, labels, consolidated numbers and contacts."""
    cands = cd.phone_candidates(b.texts(spark, sf))
    asked = cands.select("base", F.concat("base", F.lit("/")).alias("pathful_url"), "page_url", "page_type",
                         "page_ord", "match_ord", "number", "snippet", F.col("page_url").alias("source_url"),
                         "company")
    labelled = stored(lb.rule_labelled(asked), "labelled")
    items = ct.usable_items(labelled.withColumn("ord", F.struct("page_ord", "match_ord")))
    facts = stored(ct.source_facts(items), "source_facts")
    nums, src = stored(ct.numbers(facts), "numbers"), ct.sources(facts)
    status = items.select("base").distinct().withColumn("base_status", F.lit("Success"))
    rows = items.select("base", F.col("company").alias("company_name"), F.col("base").alias("given_url")).distinct()
    return rp.final_contacts(rows, status, nums, src, ct.original_urls(src))


def _flow_sql() -> str:
    from callsheet.plans.queries_contacts import RULE_CLASS, RULE_TYPE, V_CAND

    return s.with_(V_CAND) + f""", lab AS (SELECT *, {RULE_TYPE} AS type, {RULE_CLASS} AS classification FROM v_cand),
prio AS (SELECT *, {s.CLASS_PRIO} AS cp, first_value({s.TYPE_PRIO}) OVER w AS tp, row_number() OVER w AS seen
  FROM lab WINDOW w AS (PARTITION BY base, number ORDER BY page_ord, match_ord)),
nums AS (SELECT base, number, min(cp) AS cp, any_value(tp) AS tp, min(page_ord) AS o1, arg_min(match_ord, page_ord * 100000 + match_ord) AS o2,
    bool_or(type IN ('Unknown', 'Fax', 'Mobile', 'Date', 'ID')) AS excluded FROM prio GROUP BY base, number),
best AS (SELECT *, row_number() OVER (PARTITION BY base ORDER BY cp, tp, o1, o2, number) AS rank FROM nums WHERE NOT excluded),
cells AS (SELECT base, number, part, {', '.join(f"max(CASE WHEN c = '{c}' THEN cell END) AS {c}" for c in ('types', 'urls', 'companies'))} FROM ({s.pages(
    "SELECT DISTINCT base, number, 'types' AS c, type AS v FROM lab UNION ALL SELECT DISTINCT base, number, 'urls', page_url FROM lab "
    "UNION ALL SELECT DISTINCT base, number, 'companies', company FROM lab WHERE company <> ''", 'base, number, c')}) GROUP BY base, number, part),
shown AS (SELECT *, CASE WHEN part = 0 OR types IS NOT NULL OR companies IS NOT NULL THEN number || ' (' || coalesce(types, '') || ') ['
    || coalesce(companies, CASE WHEN part = 0 THEN 'UnknownCompany' ELSE '' END) || ']' END AS shown FROM cells),
names AS ({s.pages('SELECT DISTINCT base, company AS v FROM lab WHERE company IS NOT NULL', 'base', sep=' - ')}),
few AS (SELECT base, part, {', '.join(f'max(CASE WHEN rank = {i} THEN {c} END) AS "{n}_{i}"' for i in (1, 2, 3)
    for c, n in (("shown", "PhoneNumber"), ("urls", "SourceURL")))} FROM best JOIN shown USING (base, number) WHERE rank <= 3 GROUP BY base, part)
SELECT CASE WHEN part = 0 THEN base || ' - ' || coalesce(cell, 'Unknown') ELSE cell END AS "CompanyName",
  CASE WHEN part = 0 THEN base END AS "GivenURL", base AS "CanonicalEntryURL", 'Success' AS "ScrapingStatus", few.* EXCLUDE (base, part), part
FROM (SELECT base, part FROM few UNION SELECT base, part FROM names SEMI JOIN few USING (base)) LEFT JOIN few USING (base, part) LEFT JOIN names USING (base, part)"""


query("contacts_from_texts", _flow_sql())(contacts_from_texts)
