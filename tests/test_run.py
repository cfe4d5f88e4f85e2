"""A whole run on a handful of stored pages, and the registered queries' shape."""

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from callsheet.plans import catalog
from callsheet.run import Settings, run, write_all

SF = "/root/testdata/sf0.001"
ROWS = ("input_row_id bigint, company_name string, given_url string, given_phone string, description string, "
        "target_countries string, logged_at timestamp")
FETCH = "url string, status_code int, landed_url string, html string"


@pytest.fixture(scope="module")
def reports(spark):
    at = datetime.datetime(2024, 1, 1)
    de = "['DE']"
    rows = spark.createDataFrame([
        (1, "Alpha", "www.alpha.de", "030 2468101", "a", de, at),
        (2, "Alpha Nord", "http://alpha.de/", None, "a", de, at),
        (3, "Beta", "http://beta-bau.de", "0301", "b", de, at),
        (4, "Gone", "http://gone.de/x", None, "c", de, at),
        (5, "None", None, None, "d", de, at),
        (6, "Closed", "http://closed.de", None, "e", de, at),
        (7, "Quiet", "http://quiet.de", None, "f", de, at)], ROWS)
    fetches = spark.createDataFrame([
        ("http://alpha.de/", 200, "http://www.alpha.de/",
         '<a href="/kontakt">Kontakt</a><a href="/impressum">Impressum</a><a href="/news">News</a><p>Willkommen</p>'),
        ("http://alpha.de/kontakt", 200, "http://alpha.de/kontakt",
         "<p>Zentrale: 030 2468101</p>"),
        ("http://alpha.de/impressum", 200, "http://alpha.de/impressum", "<p>Fax: 030/2468102</p>"),
        ("http://alpha.de/news", 200, "http://alpha.de/news", "<p>030 2468199</p>"),
        ("http://beta-bau.de/", -2, None, None), ("http://beta.de/", -2, None, None),
        ("http://beta-bau.com/", 200, "http://beta-bau.com/", "<p>Hotline +49 89 7351904</p>"),
        ("http://gone.de/x", 404, None, None),
        ("http://closed.de/", 200, "http://closed.de/", "<p>x</p>"),
        ("http://quiet.de/", 200, "http://quiet.de/", "<p>no number here</p>")], FETCH)
    robots = spark.createDataFrame([("closed.de", "*", 0, False, "/")],
                                   "host string, ua string, rule_ord int, allow boolean, prefix string")
    return run(rows, fetches, Settings(run_id="r1"), robots=robots)


def table(df, key):
    return {r[key]: r.asDict() for r in df.collect()}


def test_outcome_of_every_row(reports):
    s = table(reports["summary"], "input_row_id")
    assert len(s) == 7
    assert s[1]["Top_Number_1"] == "+49302468101" and s[1]["Original_Number_Status"] == "Verified"
    assert s[1]["Final_Row_Outcome_Reason"] == "Contact_Successfully_Extracted"
    assert s[2]["Final_Row_Outcome_Reason"] == "Contact_Successfully_Extracted"
    assert s[3]["CanonicalEntryURL"] == "http://beta-bau.com" and s[3]["Top_Number_1"] == "+49897351904"
    assert s[3]["Overall_VerificationStatus"] == "RedirectedTo[http://beta-bau.com]_Verified_LLM_Match_Found"
    assert s[4]["Final_Row_Outcome_Reason"] == "Scraping_ContentNotFound_AllAttempts"
    assert s[5]["Final_Row_Outcome_Reason"] == "Input_URL_Invalid"
    assert s[6]["Final_Row_Outcome_Reason"] == "Scraping_AllAttemptsFailed_AccessDenied"
    assert s[7]["Final_Row_Outcome_Reason"] == "Canonical_NoRegexCandidatesFound"


def test_contact_report(reports):
    f = table(reports["final_contacts"], "CanonicalEntryURL")
    assert set(f) == {"http://alpha.de", "http://beta-bau.com"}
    a = f["http://alpha.de"]
    assert a["CompanyName"] == "http://alpha.de - Alpha - Alpha Nord"
    shown = [a[f"PhoneNumber_{i}"] for i in (1, 2, 3)]
    assert not any("+49302468102" in (x or "") for x in shown), "fax numbers are not contacts"
    assert a["SourceURL_1"] == "http://alpha.de/kontakt"
    p = table(reports["processed_contacts"], "URL")
    assert p["http://alpha.de"]["Company Name"] == "alpha"


def test_rows_add_up(reports):
    lost = reports["attrition"].count()
    got = reports["summary"].filter("Final_Row_Outcome_Reason = 'Contact_Successfully_Extracted'").count()
    assert lost + got == 7
    assert reports["augmented_input"].count() == 7
    m = {(r.section, r.metric, r.key): r.value for r in reports["run_metrics"].collect()}
    assert m["attrition", "rows_with_contact", ""] == got == 3
    assert m["reports", "rows", "summary"] == 7
    assert {r.part for r in reports["summary"].select("part").collect()} == {0}


def test_reports_can_be_written_twice(spark, reports, tmp_path):
    some = {k: reports[k] for k in ("summary", "failed_rows")}
    write_all(some, str(tmp_path), "r1")
    write_all({"summary": reports["summary"]}, str(tmp_path), "r1")
    assert spark.read.parquet(f"{tmp_path}/summary").count() == 7
    assert spark.read.parquet(f"{tmp_path}/failed_rows").count() == reports["failed_rows"].count()


def test_smoke_query(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(catalog.SQL) == set(catalog.QUERIES)


@pytest.mark.parametrize("name", ["U2_normalize_url", "H7_link_scores", "P8_cap_identical", "A2_consolidate",
                                  "W2_contact_rank", "A11_types_sorted", "L7_reconcile"])
def test_plans_stay_on_the_engine(spark, name):
    plan = catalog.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan and "SinglePartition" not in plan


def test_rank_limits_reach_the_map_side(spark):
    plan = catalog.QUERIES["P8_cap_identical"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


SAMPLE = ["S6_stop_after_blanks", "U2_normalize_url", "U5_clean_url", "H1_html_text", "H7_link_scores", "P7_candidates",
          "A2_consolidate", "A3_sources", "K2_top_eligible", "L7_reconcile", "D1_row_outcomes", "R5_attrition"]


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_sql(spark, name):
    from oracle_check import check, make_duck

    state, _, _, note = check(spark, make_duck(SF), name, SF, catalog.QUERIES, catalog.SQL)
    assert state == "ok", note


def test_from_a_company_file_to_reports(spark, tmp_path):
    from callsheet.run import input_rows

    (tmp_path / "in.csv").mkdir()
    for i, rows in enumerate((["Alpha", "Beta"], ["Gamma"])):
        body = "".join(f'"{n}\nGmbH",http://{n.lower()}.de,030 2468101,x\n' for n in rows)
        (tmp_path / "in.csv" / f"{i}.csv").write_text("Unternehmen,Webseite,Telefonnummer,Beschreibung\n" + body + ",,,\n,,,\n" * i)
    rows = input_rows(spark, str(tmp_path / "in.csv"), "default")
    got = {r.input_row_id: (r.company_name, r.given_url, r.target_countries) for r in rows.collect()}
    codes = "['DE','AT','CH']"
    assert got == {0: ("Alpha\nGmbH", "http://alpha.de", codes), 1: ("Beta\nGmbH", "http://beta.de", codes),
                   2: ("Gamma\nGmbH", "http://gamma.de", codes)}
    assert [r.input_row_id for r in input_rows(spark, str(tmp_path / "in.csv"), "default", "2-2").collect()] == [1]
    fetches = spark.createDataFrame([(f"http://{n}.de/", 200, f"http://{n}.de/", "<p>Zentrale: 030 2468101</p>")
                                     for n in ("alpha", "beta", "gamma")], FETCH)
    found = run(rows, fetches, Settings(run_id="r2"))
    write_all({k: found[k] for k in ("final_contacts", "augmented_input")}, str(tmp_path / "out"), "r2")
    out = spark.read.parquet(str(tmp_path / "out" / "final_contacts")).collect()
    assert sorted(r.CanonicalEntryURL for r in out) == ["http://alpha.de", "http://beta.de", "http://gamma.de"]


def test_rule_as_columns_equals_the_exchange(spark):
    from callsheet.operators import labels as lb

    rows = [(f"s{i % 3}", i, f"+4930246{8000 + i}", ("Fax: ", "Hotline ", "Zentrale ", "")[i % 4] + "030", "contact" if i % 5 == 0 else "legal",
             f"u{i}", "c") for i in range(70)]
    cands = spark.createDataFrame(rows, "pathful_url string, match_ord int, number string, snippet string, page_type string, source_url string, company string")
    slots = lb.request_slots(cands, "pathful_url", ["match_ord"], max_chunks=None)
    both = [sorted((r.match_ord, r.number, r.asked_number, r.type, r.classification, r.answered_by) for r in df.collect())
            for df in (lb.rule_labelled(cands), lb.reconcile(slots, lb.rule_labeler(slots)))]
    assert both[0] == both[1] and len(both[0]) == 70


def test_failures_of_pages_templates_and_rows(spark):
    """Undecodable cells and pages, a missing id and a blank template end as events, not as errors."""
    at = datetime.datetime(2024, 1, 1)
    rows = spark.createDataFrame([(1, "Alpha", "http://alpha.de", None, "a", "['DE']", at), (2, "bad", "http://beta.de", None, "b", "['DE']", at),
                                  (None, "no id", "http://gamma.de", None, "c", "['DE']", at)], ROWS)
    broken = F.unhex(F.lit("41ff42")).cast("string")
    rows = rows.withColumn("company_name", F.when(F.col("company_name") == "bad", broken).otherwise(F.col("company_name")))
    fetches = spark.createDataFrame([("http://alpha.de/", 200, "http://alpha.de/", '<a href="/kontakt">Kontakt</a> 030 2468101'),
                                     ("http://alpha.de/kontakt", 200, "http://alpha.de/kontakt", "broken"), ("http://beta.de/", 200, "http://beta.de/", "x")], FETCH)
    fetches = fetches.withColumn("html", F.when(F.col("html") == "broken", broken).otherwise(F.col("html")))
    out = run(rows, fetches, Settings(run_id="r1", template=" "), labeler=lambda slots: spark.createDataFrame(
        [], "request_id string, attempt int, raw_text string, prompt_tokens long, completion_tokens long, total_tokens long"))
    stages = {(r.stage_of_failure, r.input_row_identifier) for r in out["failed_rows"].collect()}
    assert stages == {("Regex_Extraction_FileReadError", 1), ("LLM_Setup_PromptTemplateMissing", 1),
                      ("RowProcessing_Pass1_UnhandledException", 2), ("RowProcessing_Pass1_UnhandledException", None)}
    assert [r.input_row_id for r in out["summary"].collect()] == [1] and out["requests"].count() == 0


def test_a_run_measures_its_stages(reports):
    m = {(r.metric, r.key): r.value for r in reports["run_metrics"].filter("section = 'tasks'").collect()}
    assert m["items", "entries"] == 7 and m["seconds", "crawl"] > 0 and m["items", "crawl"] is None
    assert abs(m["seconds_per_item", "entries"] - m["seconds", "entries"] / 7) < 1e-9


def test_detailed_is_a_view_on_its_factors(spark, reports, tmp_path):
    write_all({k: reports[k] for k in ("detailed", "detailed_rows", "detailed_numbers")}, str(tmp_path), "r1")
    assert sorted(p.name for p in tmp_path.iterdir()) == ["detailed_numbers", "detailed_rows"]
    from callsheet.operators import reports as rp

    read = lambda name: spark.read.parquet(f"{tmp_path}/{name}").drop("run_id")
    again = rp.detailed(read("detailed_rows"), read("detailed_numbers"), "r1")
    assert sorted(map(str, again.collect())) == sorted(map(str, reports["detailed"].collect()))
