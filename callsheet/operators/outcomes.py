"""Outcome, fault and verification status of input rows and domains."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from callsheet import dims
from callsheet.functions import urls
from callsheet.functions.stages import computed
from callsheet.functions.text import one_line

SUCCESS = "Contact_Successfully_Extracted"
NETWORK_FAULT = dims.FAULTS["Scraping_AllAttemptsFailed_Network"]


def fault_table(spark) -> DataFrame:
    """The fixed outcome to fault dimension (16 rows)."""
    return spark.createDataFrame(list(dims.FAULTS.items()), "reason string, fault string")


def fault_of(reason: Column) -> Column:
    m = F.create_map(*[F.lit(x) for kv in dims.FAULTS.items() for x in kv])
    return F.try_element_at(m, reason)


def _decide(steps: list[tuple[Column, object, str]]) -> Column:
    """First true condition gives ``struct(reason, fault)``."""
    out = F
    for cond, reason, fault in steps:
        text = F.lit(reason) if isinstance(reason, str) else reason
        out = out.when(cond, F.struct(text.alias("reason"), F.lit(fault).alias("fault")))
    return out


def row_outcomes(entries: DataFrame, facts: DataFrame) -> DataFrame:
    """Adds ``reason`` and ``fault`` to every input row. ``facts`` is the journey
    table: one row per base, so this is one equality join on the base."""
    f = dims.FAULTS
    keep = ["base", "base_status", "n_sites", "all_network", "all_denied", "all_missing",
            "any_candidates", "any_calls", "all_errors", "raw_numbers", "consolidated"]
    j = entries.join(facts.select(*keep), "base", "left")
    c = F.col
    status = F.coalesce(c("status"), F.lit(""))
    base_status = F.coalesce(c("base_status"), F.lit("Unknown"))
    steps = [
        (status == "InvalidURL", "Input_URL_Invalid", f["Input_URL_Invalid"]),
        (status == "MaxRedirects_InputURL", "Pipeline_Skipped_MaxRedirects_ForInputURL",
         f["Pipeline_Skipped_MaxRedirects_ForInputURL"]),
        (c("consolidated") > 0, SUCCESS, "N/A"),
        (c("base").isNull() & ~status.isin("", "Success", "Not_Run"),
         F.concat(F.lit("ScrapingFailure_InputURL_"), status), NETWORK_FAULT),
        (c("base").isNull(), "Unknown_NoCanonicalURLDetermined", f["Unknown_Processing_Gap_NoContact"]),
        (c("all_errors") & c("any_candidates"), "LLM_Processing_Error_AllAttempts",
         f["LLM_Processing_Error_AllAttempts"]),
        ((base_status != "Success") & (F.coalesce(c("n_sites"), F.lit(0)) == 0),
         "Scraping_NoPathfulURLs_ForCanonical", NETWORK_FAULT),
        ((base_status != "Success") & c("all_network"), "Scraping_AllAttemptsFailed_Network", NETWORK_FAULT),
        ((base_status != "Success") & c("all_denied"), "Scraping_AllAttemptsFailed_AccessDenied",
         f["Scraping_AllAttemptsFailed_AccessDenied"]),
        ((base_status != "Success") & c("all_missing"), "Scraping_ContentNotFound_AllAttempts",
         f["Scraping_ContentNotFound_AllAttempts"]),
        (base_status != "Success", F.concat(F.lit("ScrapingFailed_Canonical_"), base_status), NETWORK_FAULT),
        (status.contains("Already_Processed"), "Canonical_Duplicate_SkippedProcessing",
         f["Canonical_Duplicate_SkippedProcessing"]),
        (~c("any_candidates"), "Canonical_NoRegexCandidatesFound", f["Canonical_NoRegexCandidatesFound"]),
        (~c("any_calls"), "LLM_NoInput_NoRegexCandidates", f["LLM_NoInput_NoRegexCandidates"]),
        (c("raw_numbers") == 0, "LLM_Output_NoNumbersFound_AllAttempts",
         f["LLM_Output_NoNumbersFound_AllAttempts"]),
        (c("raw_numbers") > 0, "LLM_Output_NumbersFound_NoneRelevant_AllAttempts",
         f["LLM_Output_NumbersFound_NoneRelevant_AllAttempts"]),
        (F.lit(True), "Unknown_Processing_Gap_NoContact", f["Unknown_Processing_Gap_NoContact"]),
    ]
    return j.withColumn("_o", _decide(steps)).select(
        *entries.columns, F.col("base_status"), F.coalesce("consolidated", F.lit(0)).alias("consolidated"),
        F.col("_o.reason").alias("reason"), F.col("_o.fault").alias("fault"))


def domain_outcomes(facts: DataFrame) -> DataFrame:
    """Adds ``reason`` and ``fault`` to the journey table."""
    f = dims.FAULTS
    c = F.col
    bad = c("base_status") != "Success"
    input_like = c("base_status").rlike("InvalidURL|MaxRedirects")
    steps = [
        (c("consolidated") > 0, SUCCESS + "_For_Domain", "N/A"),
        (bad & (c("n_sites") == 0) & input_like,
         F.concat(F.lit("Domain_InputLikeFailure_"), c("base_status")), f["Input_URL_Invalid"]),
        (bad & (c("n_sites") == 0), "Scraping_NoPathfulURLs_Processed_ForDomain", NETWORK_FAULT),
        (bad & c("all_network"), "Scraping_AllPathfulsFailed_Network_ForDomain", NETWORK_FAULT),
        (bad & c("all_denied"), "Scraping_AllPathfulsFailed_AccessDenied_ForDomain",
         f["Scraping_AllAttemptsFailed_AccessDenied"]),
        (bad & c("all_missing"), "Scraping_AllPathfuls_ContentNotFound_ForDomain",
         f["Scraping_ContentNotFound_AllAttempts"]),
        (bad, F.concat(F.lit("ScrapingFailed_Domain_"), c("base_status")), NETWORK_FAULT),
        (~c("any_candidates") & (c("total_pages") == 0), "Scraping_Success_NoPagesScraped_ForDomain",
         f["Scraping_Success_NoRelevantContentPagesFound"]),
        (~c("any_candidates"), "Domain_NoRegexCandidatesFound_OnAnyPage",
         f["Canonical_NoRegexCandidatesFound"]),
        (~c("any_calls"), "LLM_NotCalled_DespiteRegexCandidates_ForDomain",
         f["LLM_NoInput_NoRegexCandidates"]),
        (c("any_error"), "LLM_Processing_Error_Encountered_ForDomain",
         f["LLM_Processing_Error_AllAttempts"]),
        (c("raw_numbers") == 0, "LLM_Output_NoRawNumbersFound_ForDomain",
         f["LLM_Output_NoNumbersFound_AllAttempts"]),
        (c("raw_numbers") > 0, "LLM_Output_RawNumbersFound_NoneConsolidated_ForDomain",
         f["LLM_Output_NumbersFound_NoneRelevant_AllAttempts"]),
        (F.lit(True), "Unknown_Domain_Processing_Gap_NoContact", f["Unknown_Processing_Gap_NoContact"]),
    ]
    return facts.withColumn("_o", _decide(steps)).select(
        *facts.columns, F.col("_o.reason").alias("reason"), F.col("_o.fault").alias("fault"))


def original_number_status(given: Column, top: Column, contacts: Column, reason: Column) -> Column:
    """How the given number compares with the best three found."""
    none_relevant = reason.isin("LLM_Output_NoNumbersFound_AllAttempts",
                                "LLM_Output_NumbersFound_NoneRelevant_AllAttempts")
    not_run = (reason.rlike("^(?:LLM_NoInput|LLM_Processing_Error|ScrapingFailed_Canonical)")
               | (reason == "Unknown_NoCanonicalURLDetermined"))
    return (F.when(given.isNull() | (given == ""), F.lit("Original_Not_Provided"))
            .when(given == "InvalidFormat", F.lit("Original_InvalidFormat"))
            .when(F.array_contains(top, given), F.lit("Verified"))
            .when(contacts > 0, F.lit("Corrected"))
            .when(none_relevant, F.lit("LLM_OutputEmpty_Or_NoRelevant_For_Canonical"))
            .when(not_run, F.lit("LLM_Not_Run_Or_NoOutput_For_Canonical"))
            .otherwise(F.lit("No Relevant Match Found by LLM")))


SCRAPE_REASONS = ["Scraping_AllAttemptsFailed_Network", "Scraping_AllAttemptsFailed_AccessDenied",
                  "Scraping_ContentNotFound_AllAttempts", "Scraping_NoPathfulURLs_ForCanonical"]


def shown_base_status(base: Column, base_status: Column) -> Column:
    return F.when(base.isNull(), F.lit("Unknown_NoTrueBase")).otherwise(
        F.coalesce(base_status, F.lit("Unknown")))


def verification_status(reason: Column, base: Column, base_status: Column, given_url: Column) -> Column:
    shown = shown_base_status(base, base_status)
    scrape = reason.startswith("ScrapingFailed_Canonical") | reason.isin(SCRAPE_REASONS)
    overall = (F.when(reason == SUCCESS, F.lit("Verified_LLM_Match_Found"))
               .when(scrape, F.concat(F.lit("Unverified_Scrape_"), shown))
               .when(reason.startswith("LLM_Output_"), F.lit("Unverified_LLM_NoRelevantNumbers"))
               .when(reason == "LLM_Processing_Error_AllAttempts",
                     F.lit("Error_LLM_Processing_For_Canonical"))
               .otherwise(F.lit("Unverified")))
    return urls.with_redirect_prefix(overall, urls.base_domain(given_url), base)


def label_status(contacts: Column, base: Column, base_status: Column) -> Column:
    return F.when(contacts > 0, F.lit("Processed")).otherwise(shown_base_status(base, base_status))


def first_pass_status(status: Column, given: Column) -> tuple[Column, Column]:
    """(overall, original number) status set while crawling fails."""
    failed = ~status.isin("Success", "InvalidURL")
    overall = F.when(status == "InvalidURL", F.lit("Skipped_InvalidURL")).when(
        failed, F.concat(F.lit("Unverified_Scrape_"), status))
    number = F.when(failed & (F.coalesce(given, F.lit("")) != ""),
                    F.concat(F.lit("Scrape_"), status)).when(failed, F.lit("Original_Not_Provided"))
    return overall, number


FAILURE_COLUMNS = ["log_timestamp", "input_row_identifier", "CompanyName", "GivenURL",
                   "stage_of_failure", "error_reason", "error_details",
                   "Associated_Pathful_Canonical_URL"]


def readable(c: Column) -> Column:
    """Whether a cell holds valid text; a null cell does."""
    return c.isNull() | F.is_valid_utf8(c)


def row_errors(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Input rows that cannot be processed, with what is wrong, and the rows without them.
    Wrong are a missing row id and cells that are no valid text; nothing is raised."""
    texts = [f.name for f in rows.schema.fields if f.dataType.typeName() == "string"]
    bad = F.array_compact(F.array(*[F.when(~readable(F.col(f"`{t}`")), F.lit(t)) for t in texts])) if texts else F.array().cast("array<string>")
    reason = F.when(F.col("input_row_id").isNull(), F.struct(F.lit("MissingRowId").alias("type"), F.lit("the row has no id").alias("message"))).when(
        F.size(bad) > 0, F.struct(F.lit("InvalidText").alias("type"), F.concat(F.lit("not valid UTF-8: "), F.array_join(bad, ", ")).alias("message")))
    told = computed(rows, _error=reason)
    plain = lambda name: F.try_validate_utf8(F.col(name)).alias(name)
    wrong = told.filter(F.col("_error").isNotNull()).select(
        "input_row_id", plain("company_name"), plain("given_url"), "logged_at", F.lit(None).cast("string").alias("pathful_url"),
        F.col("_error.type").alias("exception_type"), F.col("_error.message").alias("exception_message"))
    return wrong, told.filter(F.col("_error").isNull()).drop("_error")


def page_errors(visited: DataFrame, fetches: DataFrame, source: str = "html") -> DataFrame:
    """Visited pages (``input_row_id, pathful_url, link_url, landed_url``) whose stored source
    is no valid text. Sources are only tested where they lie; what moves are page URLs."""
    unreadable = fetches.filter(~readable(F.col(source))).select(F.col("url").alias("link_url")).distinct()
    return visited.join(unreadable, "link_url").select(
        "input_row_id", "pathful_url", F.col("landed_url").alias("file_path"), F.lit("not valid UTF-8").alias("exception"))


def failure_events(entries: DataFrame, sites: DataFrame, unread: DataFrame | None = None,
                   unasked: DataFrame | None = None, faulty: DataFrame | None = None) -> DataFrame:
    """One row per failed stage: bad URL, failed scrape, failed label exchange, and given
    their tables: pages that could not be read (``page_errors``), sites not asked for lack of
    a template (``pathful_url, template``), rows that could not be processed (``row_errors``).
    ``entries`` carries ``clean_url`` and ``logged_at``; a site's failure is logged
    for the first row that reached it."""
    c = F.col
    bad_url = entries.filter(c("status") == "InvalidURL").select(
        c("logged_at").alias("log_timestamp"), c("input_row_id").alias("input_row_identifier"),
        c("company_name").alias("CompanyName"), F.coalesce("given_url", F.lit("")).alias("GivenURL"),
        F.lit("URL_Validation_InvalidOrMissing").alias("stage_of_failure"),
        F.concat(F.lit("Invalid or missing URL after processing: "),
                 F.coalesce("clean_url", F.lit("None"))).alias("error_reason"),
        F.to_json(F.struct(c("given_url").alias("original_url"), c("clean_url").alias("processed_url"))
                  ).alias("error_details"),
        F.lit("").alias("Associated_Pathful_Canonical_URL"))
    scrape = entries.filter(~c("status").isin("InvalidURL", "Success")).select(
        c("logged_at").alias("log_timestamp"), c("input_row_id").alias("input_row_identifier"),
        c("company_name").alias("CompanyName"), F.coalesce("given_url", F.lit("")).alias("GivenURL"),
        F.concat(F.lit("Scraping_"), c("status")).alias("stage_of_failure"),
        F.concat(F.lit("Scraper returned status: "), c("status")).alias("error_reason"),
        F.to_json(F.struct(c("pathful_url").alias("pathful_canonical_url"),
                           c("base").alias("true_base_domain"))).alias("error_details"),
        F.coalesce("pathful_url", F.lit("")).alias("Associated_Pathful_Canonical_URL"))
    first = entries.filter(c("pathful_url").isNotNull()).groupBy("pathful_url").agg(
        F.min(F.struct("input_row_id", "logged_at", "company_name", "given_url")).alias("r"))
    label = sites.filter(c("error").isNotNull()).join(first, "pathful_url").select(
        c("r.logged_at").alias("log_timestamp"), c("r.input_row_id").alias("input_row_identifier"),
        c("r.company_name").alias("CompanyName"), F.coalesce("r.given_url", F.lit("")).alias("GivenURL"),
        F.lit("LLM_Processing_GeneralError").alias("stage_of_failure"),
        F.lit("LLM processing error").alias("error_reason"),
        F.to_json(F.struct(c("pathful_url").alias("canonical_url"),
                           c("error").alias("exception_message"))).alias("error_details"),
        c("pathful_url").alias("Associated_Pathful_Canonical_URL"))
    out = bad_url.unionByName(scrape).unionByName(label)
    if unread is not None:
        owner = entries.select("input_row_id", "logged_at", "company_name", "given_url")
        out = out.unionByName(unread.join(owner, "input_row_id").select(
            c("logged_at").alias("log_timestamp"), c("input_row_id").alias("input_row_identifier"), c("company_name").alias("CompanyName"),
            F.coalesce("given_url", F.lit("")).alias("GivenURL"), F.lit("Regex_Extraction_FileReadError").alias("stage_of_failure"),
            F.lit("Error reading scraped content file").alias("error_reason"),
            F.to_json(F.struct("file_path", c("pathful_url").alias("canonical_url"), "exception")).alias("error_details"),
            c("pathful_url").alias("Associated_Pathful_Canonical_URL")))
    if unasked is not None:
        out = out.unionByName(unasked.join(first, "pathful_url").select(
            c("r.logged_at").alias("log_timestamp"), c("r.input_row_id").alias("input_row_identifier"), c("r.company_name").alias("CompanyName"),
            F.coalesce("r.given_url", F.lit("")).alias("GivenURL"), F.lit("LLM_Setup_PromptTemplateMissing").alias("stage_of_failure"),
            F.lit("LLM prompt template file not found").alias("error_reason"),
            F.to_json(F.struct(c("pathful_url").alias("canonical_url"), F.coalesce("template", F.lit("")).alias("prompt_path"))).alias("error_details"),
            c("pathful_url").alias("Associated_Pathful_Canonical_URL")))
    if faulty is not None:
        out = out.unionByName(faulty.select(
            c("logged_at").alias("log_timestamp"), c("input_row_id").alias("input_row_identifier"), c("company_name").alias("CompanyName"),
            F.coalesce("given_url", F.lit("")).alias("GivenURL"), F.lit("RowProcessing_Pass1_UnhandledException").alias("stage_of_failure"),
            F.lit("Unhandled exception during Pass 1 row processing").alias("error_reason"),
            F.to_json(F.struct("exception_type", "exception_message")).alias("error_details"),
            F.coalesce("pathful_url", F.lit("")).alias("Associated_Pathful_Canonical_URL")))
    return out.withColumn("error_reason", one_line(c("error_reason"))).withColumn(
        "error_details", one_line(c("error_details")))


def failure_group(stage: Column) -> Column:
    out = F
    for prefix, group in dims.FAILURE_GROUPS:
        out = out.when(stage.startswith(prefix), F.lit(group))
    return out.otherwise(F.lit("Other"))
