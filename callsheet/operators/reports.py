"""Report tables: rows, contacts, attrition, domains."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from callsheet import dims
from callsheet.functions import phones, urls
from callsheet.operators import contacts, journey as jn, outcomes
from callsheet.operators.duplicates import with_duplicate_counts
from callsheet.operators.paging import paged, side_by_side, with_pages


def report_class_rank(c: Column) -> Column:
    m = F.create_map(*[F.lit(x) for i, n in enumerate(dims.REPORT_CLASS_ORDER) for x in (n, i)])
    return F.try_element_at(m, c)


def detailed_rows(entries: DataFrame) -> DataFrame:
    """One factor of the detailed report: the input rows of each base."""
    return entries.filter(F.col("base").isNotNull()).select("base", "company_name", "target_countries")


def detailed_numbers(facts: DataFrame, nums: DataFrame, src: DataFrame) -> DataFrame:
    """The other factor: the numbers of each base scraped with success, with their list pages."""
    good = facts.filter(F.col("base_status") == "Success").select("base")
    pages = contacts.number_pages(src, {"type": "LLM_Type", "source_url": "LLM_Source_URL"}, first_seen=True)
    return with_pages(nums.select("base", "number", "classification").join(good, "base", "left_semi"), pages, ["base", "number"])


def detailed(rows: DataFrame, numbers: DataFrame, run_id: str) -> DataFrame:
    """Input row by number and list page: a view on the two factors, which are stored in its
    place. It is as large as rows times numbers of a base; the factors are rows plus numbers."""
    return rows.join(numbers, "base").select(
        F.col("company_name").alias("CompanyName"), F.col("number").alias("Number"),
        F.when(F.col("part") == 0, F.coalesce("LLM_Type", F.lit("Unknown"))).otherwise(F.col("LLM_Type")).alias("LLM_Type"),
        F.col("classification").alias("LLM_Classification"), "LLM_Source_URL", F.lit("Success").alias("ScrapingStatus"),
        F.col("target_countries").alias("TargetCountryCodes"), F.lit(run_id).alias("RunID"), "part")


def sort_detailed(report: DataFrame) -> DataFrame:
    return report.orderBy(F.col("CompanyName").asc_nulls_last(),
                          report_class_rank(F.col("LLM_Classification")).asc_nulls_last(),
                          F.col("Number").asc_nulls_last(), "part")


def names_of(prefix: str, k: int = 3) -> list[str]:
    return [f"{prefix}{i}" for i in range(1, k + 1)]


def summary(outcome_rows: DataFrame, nums: DataFrame, src: DataFrame, run_id: str) -> DataFrame:
    """One row per input row and list page. ``outcome_rows`` are the results of ``row_outcomes``.
    Only sources of the best three numbers are gathered."""
    ranks = contacts.top_numbers(nums).select("base", "number", "rank")
    lists = contacts.ranked_lists(ranks, src, {"type": "Top_Type_", "source_url": "Top_SourceURL_"})
    pages = side_by_side(paged(lists, ["base", "column"]), ["base"], names_of("Top_Type_") + names_of("Top_SourceURL_"))
    top = with_pages(contacts.wide(ranks, {"number": "Top_Number_"}), pages, ["base"])
    j = with_pages(outcome_rows, top, ["base"])
    best = F.array_compact(F.array(*[F.col(f"Top_Number_{i}") for i in (1, 2, 3)]))
    c = F.col
    wide = [f"Top_{k}_{i}" for i in (1, 2, 3) for k in ("Number", "Type", "SourceURL")]
    return j.select(
        "input_row_id", c("company_name").alias("CompanyName"), c("given_url").alias("GivenURL"),
        c("given_phone").alias("GivenPhoneNumber"),
        outcomes.original_number_status(c("normalized_phone"), best, c("consolidated"),
                                        c("reason")).alias("Original_Number_Status"),
        c("description").alias("Description"),
        outcomes.shown_base_status(c("base"), c("base_status")).alias("ScrapingStatus_Canonical"),
        c("base").alias("CanonicalEntryURL"), *wide,
        outcomes.verification_status(c("reason"), c("base"), c("base_status"),
                                     c("given_url")).alias("Overall_VerificationStatus"),
        outcomes.label_status(c("consolidated"), c("base"), c("base_status")).alias(
            "LLM_Processing_Status_Canonical"),
        c("reason").alias("Final_Row_Outcome_Reason"), c("fault").alias("Determined_Fault_Category"),
        c("target_countries").alias("TargetCountryCodes"), F.lit(run_id).alias("RunID"), "part")


HEADERS = ["names", "given", "own"]


def header_lists(entries: DataFrame, original_urls: DataFrame) -> DataFrame:
    """Names, given URLs and, for bases without these, the found URLs as ``base, column, value``."""
    rows = entries.filter(F.col("base").isNotNull())
    pick = lambda src, name: rows.filter(F.col(src).isNotNull()).select(
        "base", F.lit(name).alias("column"), F.col(src).alias("value")).distinct()
    given = pick("given_url", "given")
    unmet = original_urls.join(given.select("base"), "base", "left_anti").select(
        "base", F.lit("own").alias("column"), F.col("url").alias("value"))
    return pick("company_name", "names").unionByName(given).unionByName(unmet)


def separator() -> Column:
    """Between the values of a list: names stand between dashes."""
    return F.when(F.col("column") == "names", " - ").otherwise(", ")


def header_columns(part: Column) -> list[Column]:
    """The two header texts of a page; the base and the word for no name open the first one."""
    first = F.concat_ws(" - ", "base", F.coalesce("names", F.lit("Unknown")))
    return [F.when(part == 0, first).otherwise(F.col("names")).alias("CompanyName"), F.coalesce("given", "own").alias("GivenURL")]


def domain_headers(entries: DataFrame, bases: DataFrame, original_urls: DataFrame) -> DataFrame:
    """Names and given URLs of a base as text, falling back to the base's own; a row per page."""
    pages = side_by_side(paged(header_lists(entries, original_urls), ["base", "column"], separator()), ["base"], HEADERS)
    return with_pages(bases, pages, ["base"]).select("base", "part", *header_columns(F.col("part")))


def final_contacts(entries: DataFrame, facts: DataFrame, nums: DataFrame, src: DataFrame,
                   original_urls: DataFrame) -> DataFrame:
    """One row per list page of a base with at least one eligible number. The lists of the
    numbers and of the headers are paged together. A number is shown on the first page and on
    those that go on with its types or companies."""
    ranks = contacts.top_numbers(contacts.eligible(nums)).select("base", "number", "rank")
    numbers = contacts.wide(ranks, {"number": "number_"})
    bases = numbers.select("base")
    of_numbers = contacts.ranked_lists(ranks, src.withColumn("company", F.nullif("company", F.lit(""))),
                                       {"type": "types_", "source_url": "urls_", "company": "companies_"})
    of_headers = header_lists(entries.join(bases, "base", "left_semi"), original_urls.join(bases, "base", "left_semi"))
    names = [n for prefix in ("types_", "urls_", "companies_") for n in names_of(prefix)]
    pages = side_by_side(paged(of_numbers.unionByName(of_headers), ["base", "column"], separator()), ["base"], names + HEADERS)
    rows = with_pages(numbers, pages, ["base"]).join(facts.select("base", "base_status"), "base", "left")
    first = F.col("part") == 0

    def shown(i: int) -> Column:
        types, companies = F.col(f"types_{i}"), F.col(f"companies_{i}")
        text = F.concat(F.col(f"number_{i}"), F.lit(" ("), F.coalesce(types, F.lit("")), F.lit(") ["),
                        F.coalesce(companies, F.when(first, "UnknownCompany").otherwise("")), F.lit("]"))
        return F.when(first | types.isNotNull() | companies.isNotNull(), text).alias(f"PhoneNumber_{i}")

    return rows.select(*header_columns(F.col("part")), F.col("base").alias("CanonicalEntryURL"),
                       F.coalesce("base_status", F.lit("Unknown")).alias("ScrapingStatus"),
                       *[shown(i) for i in (1, 2, 3)], *[F.col(f"urls_{i}").alias(f"SourceURL_{i}") for i in (1, 2, 3)], "part")


def report_number(c: Column) -> Column:
    """Digits of the number part of a rendered contact."""
    digits = F.regexp_replace(F.substring_index(c, " (", 1), "[^0-9+]", "")
    return F.nullif(digits, F.lit(""))


def report_type(c: Column) -> Column:
    """Text of the first parenthesis of a rendered contact; ``Unknown`` without one."""
    opened = F.instr(c, "(")
    rest = F.substring(c, opened + 1, F.length(c))
    return F.when((opened > 0) & (F.instr(rest, ")") > 0), F.trim(F.substring_index(rest, ")", 1))).when(
        c != "", F.lit("Unknown"))


def processed_contacts(final: DataFrame) -> DataFrame:
    """Five columns on the best contact of each base; a row per list page."""
    return final.select(
        urls.domain_label(F.when(F.col("part") == 0, F.col("CompanyName")).otherwise(F.col("CanonicalEntryURL"))).alias("Company Name"),
        F.col("CanonicalEntryURL").alias("URL"),
        report_number(F.col("PhoneNumber_1")).alias("Number"),
        report_type(F.col("PhoneNumber_1")).alias("Number Type"),
        F.col("SourceURL_1").alias("Number Found At"), "part")


def attrition(outcome_rows: DataFrame, facts: DataFrame, all_rows: DataFrame) -> DataFrame:
    """Input rows without a contact, with duplicate counts over all input rows and
    a link to the domain they ended at."""
    counted = with_duplicate_counts(all_rows).select(
        "input_row_id", "host_key", "name_count", "host_count", "name_dup", "host_dup", "any_dup")
    known = facts.select("base", F.col("base").alias("known_base"))
    yes = lambda c: F.when(F.col(c), F.lit("Yes")).otherwise(F.lit("No"))
    lost = outcome_rows.filter(F.col("reason") != outcomes.SUCCESS)
    j = lost.join(counted, "input_row_id").join(known, "base", "left")
    return j.select(
        F.col("input_row_id").alias("InputRowID"), F.col("company_name").alias("CompanyName"),
        F.coalesce("given_url", F.lit("")).alias("GivenURL"),
        urls.input_host(F.col("given_url")).alias("Derived_Input_CanonicalURL"),
        F.col("base").alias("Final_Processed_Canonical_Domain"),
        F.col("known_base").alias("Link_To_Canonical_Domain_Outcome"),
        F.col("reason").alias("Final_Row_Outcome_Reason"),
        F.col("fault").alias("Determined_Fault_Category"),
        F.coalesce("base", F.lit("N/A")).alias("Relevant_Canonical_URLs"),
        F.coalesce("label_error", F.lit("")).alias("LLM_Error_Detail_Summary"),
        F.col("name_count").alias("Input_CompanyName_Total_Count"),
        F.col("host_count").alias("Input_CanonicalURL_Total_Count"),
        yes("name_dup").alias("Is_Input_CompanyName_Duplicate"),
        yes("host_dup").alias("Is_Input_CanonicalURL_Duplicate"),
        yes("any_dup").alias("Is_Input_Row_Considered_Duplicate"),
        F.col("logged_at").alias("Timestamp_Of_Determination"))


def with_label_error(outcome_rows: DataFrame, sites: DataFrame) -> DataFrame:
    """First label error of the base, for rows that failed because of it."""
    first = sites.filter(F.col("error").isNotNull()).groupBy("base").agg(
        F.min_by("error", "ord").alias("_error"))
    mine = (F.col("fault") == "LLM Issue") & F.col("reason").contains("Error")
    return outcome_rows.join(first, "base", "left").withColumn(
        "label_error", F.when(mine, F.col("_error"))).drop("_error")


def domain_summary(domains: DataFrame, pages: DataFrame) -> DataFrame:
    """Seventeen columns per domain and list page. ``domains``: result of ``domain_outcomes``;
    ``pages``: the journey's lists."""
    j = with_pages(domains, pages, ["base"])
    text = lambda n: F.coalesce(F.col(n), F.lit("")).alias(n)
    c = F.col
    return j.select(
        c("base").alias("Canonical_Domain"), *[text(n) for n in jn.LISTS[:4]],
        c("base_status").alias("Overall_Scraper_Status_For_Domain"),
        c("total_pages").alias("Total_Pages_Scraped_For_Domain"),
        c("page_types_json").alias("Scraped_Pages_Details_Aggregated"),
        c("any_candidates").alias("Regex_Candidates_Found_For_Any_Pathful"),
        c("any_calls").alias("LLM_Calls_Made_For_Domain"),
        c("raw_numbers").alias("LLM_Total_Raw_Numbers_Extracted"),
        c("consolidated").alias("LLM_Total_Consolidated_Numbers_Found"),
        F.concat(F.lit("{"), F.coalesce(jn.TYPES, F.lit("")), F.lit("}")).alias(jn.TYPES),
        c("any_error").alias("LLM_Processing_Error_Encountered_For_Domain"),
        text("LLM_Error_Messages_Aggregated"),
        c("reason").alias("Final_Domain_Outcome_Reason"),
        c("fault").alias("Primary_Fault_Category_For_Domain"), "part")


def augmented_input(original: DataFrame, best: DataFrame, phone: str,
                    key: str = "input_row_id") -> DataFrame:
    """Original rows with the phone column replaced by the best number or blank.
    ``best``: (key, Top_Number_1). Rows that were not processed keep theirs."""
    j = original.join(best.select(key, "Top_Number_1", F.lit(True).alias("_done")), key, "left")
    new = F.when(F.col("_done"), F.coalesce("Top_Number_1", F.lit(""))).otherwise(F.col(phone))
    return j.withColumn(phone, new).select(*original.columns)
