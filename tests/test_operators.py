"""Operators against plain loops, on small tables and with hot keys."""

from __future__ import annotations

import random
import re

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from callsheet import dims
from callsheet.operators import candidates as cd, contacts as ct, crawl, duplicates as dp, labels as lb
from callsheet.operators.paging import paged, positions, side_by_side, with_pages
from callsheet.operators.skew import ranked
from callsheet.sources import tables

CLASSES = ["Primary", "Secondary", "Non-Business", "Odd A", "Odd B", "Odd C"]
TYPES = ["Main Line", "Sales", "Fax", "Strange", "Unknown"]
ITEMS = "base string, number string, source_url string, type string, classification string, company string, ord bigint"


def priority(cls, kind):
    return dims.CLASSIFICATION_PRIORITY.get(cls, 99), dims.TYPE_PRIORITY.get(kind, 90)


def fold(items):
    """Number by number in order: the class improves, the first source's type stays."""
    out = {}
    for number, kind, cls in items:
        if number not in out:
            out[number] = [cls, kind]
        elif priority(cls, kind) < priority(*out[number]):
            out[number][0] = cls
    return {n: c for n, (c, _) in out.items()}


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.tuples(st.sampled_from(["1", "2"]), st.sampled_from(TYPES), st.sampled_from(CLASSES)),
                         min_size=1, max_size=9), min_size=20, max_size=60))
def test_consolidation_equals_fold(spark, groups):
    rows = [(f"b{g}", n, f"u{i}", t, c, None, i) for g, items in enumerate(groups)
            for i, (n, t, c) in enumerate(items)]
    got = {(r.base, r.number): r.classification for r in ct.numbers(
        ct.source_facts(spark.createDataFrame(rows, ITEMS))).collect()}
    want = {(f"b{g}", n): c for g, items in enumerate(groups) for n, c in fold(items).items()}
    assert got == want


def test_sources_keep_first(spark):
    rows = [("b", "1", "u", "Fax", "Primary", "late", 5), ("b", "1", "u", "Fax", "Primary", "early", 2),
            ("b", "1", "u", "Sales", "Primary", None, 3)]
    got = {(r.type): (r.ord, r.company) for r in ct.sources(
        ct.source_facts(spark.createDataFrame(rows, ITEMS))).collect()}
    assert got == {"Fax": (2, "early"), "Sales": (3, None)}


def test_ranked_with_hot_key(spark):
    rng = random.Random(3)
    rows = [("hot" if rng.random() < 0.5 else f"k{rng.randint(0, 20)}", rng.randint(0, 5), i) for i in range(4000)]
    df = spark.createDataFrame(rows, "k string, c int, v int")
    got = {r.v: r.pos for r in ranked(df, ["k"], ["c"], [F.col("v")], "pos").collect()}
    by_key = {}
    for k, c, v in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        by_key[k] = by_key.get(k, 0) + 1
        assert got[v] == by_key[k]


def test_pages_by_position(spark):
    """A hot list over many ranges, short ones, values with commas, an order of its own."""
    rng = random.Random(3)
    hot = [("hot", f"v{i:05d}", rng.randrange(40)) for i in range(5000)]
    rows = hot + [("cold", "b", 1), ("cold", "a", 2), ("one", "x, y", None), (None, "n", 1), (None, "m", None)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, value string, ord int").repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for order in (False, True):
            got = paged(df if order else df.drop("ord"), ["k"], "|", page=300).collect()
            by = {}
            for k, v, o in sorted(rows, key=lambda r: ((r[2] is not None, r[2] or 0) if order else 0, r[1])):
                by.setdefault(k, []).append(v)
            want = {(k, i // 300): (len(vs), "|".join(vs[i:i + 300])) for k, vs in by.items() for i in range(0, len(vs), 300)}
            assert {(r.k, r.part): (r.n_values, r.cell) for r in got} == want and len(got) == len(want)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert paged(df.limit(0), ["k"]).collect() == []


def test_lists_side_by_side_show_all_pages(spark):
    rows = [("b", "1", f"u{i:03d}", "Sales" if i % 2 else "Fax", "Primary", None, i) for i in range(60)]
    src = ct.sources(ct.source_facts(spark.createDataFrame(rows, ITEMS)))
    lists = ct.distinct_values(src, "source_url").select("base", F.lit("urls").alias("column"), "value").unionByName(
        ct.distinct_values(src, "type").select("base", F.lit("types").alias("column"), "value"))
    got = side_by_side(paged(lists, ["base", "column"], page=25), ["base"], ["urls", "types"]).orderBy("part").collect()
    assert [r.part for r in got] == [0, 1, 2] and [r.types for r in got] == ["Fax, Sales", None, None]
    assert ", ".join(r.urls for r in got).split(", ") == [r[2] for r in rows]
    base = spark.createDataFrame([("b",), ("none",)], "base string")
    assert sorted((r.base, r.part) for r in with_pages(base, side_by_side(paged(lists, ["base", "column"], page=25), ["base"], ["urls"]), ["base"]).collect()) == [
        ("b", 0), ("b", 1), ("b", 2), ("none", 0)]


def test_blank_stop_equals_loop(spark):
    rng = random.Random(5)
    for case in range(4):
        gone = [rng.random() < 0.5 for _ in range(40)]
        df = spark.createDataFrame([(i, None if g else "x", "  " if g else None) for i, g in enumerate(gone)],
                                   "input_row_id bigint, a string, b string")
        want, run = [], 0
        for i, g in enumerate(gone):
            run = run + 1 if g else 0
            if run == 3:
                break
            if not g:
                want.append(i)
        got = sorted(r.input_row_id for r in tables.stop_after_blanks(df, ["a", "b"], 3).collect())
        assert got == want


def test_every_slot_is_answered_once(spark):
    slots = spark.createDataFrame([(f"r{i}", p, f"+49301234{i}{p}") for i in range(6) for p in range(3)],
                                  "request_id string, pos int, number string")
    item = '{{"number": "{}", "type": "Sales", "classification": "Primary"}}'
    doc = lambda ns: '{"extracted_numbers": [' + ", ".join(item.format(n) for n in ns) + "]}"
    n = lambda i, p: f"+49301234{i}{p}"
    answers = [("r0", 0, doc([n(0, p) for p in range(3)])),
               ("r1", 0, doc([n(1, 0), "wrong", "wrong"])), ("r1", 1, doc([n(1, 1), n(1, 2)])),
               ("r2", 0, doc([n(2, 0), "wrong", n(2, 2)])), ("r2", 1, doc([n(2, 0), n(2, 1)])),
               ("r3", 0, doc([n(3, 0)])), ("r4", 0, "nothing")]
    got = {(r.request_id, r.pos): (r.type, r.answered_by) for r in lb.reconcile(
        slots, spark.createDataFrame(answers, "request_id string, attempt int, raw_text string")).collect()}
    assert len(got) == 18
    assert all(got["r0", p] == ("Sales", 0) for p in range(3))
    assert [got["r1", p] for p in range(3)] == [("Sales", 0), ("Sales", 1), ("Sales", 1)]
    assert got["r2", 1] == ("Error_PersistentMismatchAfterRetries", None)
    assert got["r3", 0][0] == "Error_LLMItemCountMismatch"
    assert got["r4", 2][0] == "Error_ChunkNoJsonBlock"
    assert got["r5", 0][0] == "Error_NotProcessedInChunk"


def test_page_budget(spark):
    rows = [("e", f"u{i}", s, i, 1) for i, s in enumerate([90] * 6 + [50] * 4)]
    queue = spark.createDataFrame(rows, "entry_url string, link_url string, score int, link_ord int, depth int")
    kept = lambda n, b: sorted(r.link_url for r in crawl.page_budget(queue, max_pages=n, bypass_pages=b).collect())
    assert kept(4, 1) == ["u0", "u1", "u2", "u3", "u4"]
    assert kept(8, 5) == [f"u{i}" for i in range(8)]
    assert len(kept(0, 0)) == 10


def test_robots_first_match(spark):
    rows = spark.createDataFrame([(1, "http://h.de/a/b"), (2, "http://h.de/a"), (3, "http://h.de/c"), (4, "http://o.de/a")],
                                 "input_row_id bigint, entry_url string")
    rules = spark.createDataFrame([("h.de", "*", 0, True, "/a/"), ("h.de", "*", 1, False, "/a"),
                                   ("h.de", "x", 0, False, "/")],
                                  "host string, ua string, rule_ord int, allow boolean, prefix string")
    got = {r.input_row_id: r.allowed for r in crawl.robots_admission(rows, rules).collect()}
    assert got == {1: True, 2: False, 3: True, 4: True}


def test_duplicate_profile_of_hot_name(spark):
    rows = [(i, "same" if i % 3 else f"n{i}", f"http://h{i % 5}.de" if i % 2 else None) for i in range(60)]
    df = spark.createDataFrame(rows, "input_row_id int, company_name string, given_url string")
    p = dp.duplicate_profile(df).first()
    flags = dp.with_duplicate_counts(df).collect()
    assert p.input_rows == 60 and p.names_repeated == 1 and p.urls_repeated == 5
    assert p.rows_dup_name == sum(r.name_dup for r in flags) == 40
    assert p.rows_dup_url == sum(r.host_dup for r in flags) == 30
    assert p.rows_dup_any == sum(r.any_dup for r in flags)


def test_candidates_read_whole_texts(spark):
    text = ("filler words " * 20000) + "+49 30 2468101 end"
    df = spark.createDataFrame([("p", text), ("q", "no digits")], "page_url string, text string")
    got = cd.phone_candidates(df, "DE").collect()
    assert [(r.page_url, r.number) for r in got] == [("p", "+49302468101")]


def test_a_base_with_one_good_site_is_no_label_error(spark):
    from callsheet.operators import journey

    sites = spark.createDataFrame(
        [("b1", 1, "Success", 2, True, 3, "Error_X"), ("b1", 2, "Success", 2, True, 3, None),
         ("b2", 1, "Success", 2, True, 3, "Error_X"), ("b2", 2, "Success", 0, False, 0, None),
         ("b3", 1, "Success", 0, False, 0, None)],
        "base string, ord int, status string, candidates int, label_called boolean, raw_numbers int, error string")
    got = {r.base: (r.any_error, r.all_errors) for r in journey.site_facts(sites).collect()}
    assert got == {"b1": (True, False), "b2": (True, True), "b3": (False, False)}


def test_a_retried_fetch_gives_one_outcome(spark):
    from callsheet.operators import crawl

    entries = spark.createDataFrame([(1, "http://a.de"), (2, "http://b.de")], "input_row_id long, entry_url string")
    log = spark.createDataFrame(
        [("http://a.de", 500, None, None), ("http://a.de", 200, "http://a.de/", "<a>x</a>"), ("http://b.de", 404, None, "")],
        "url string, status_code int, landed_url string, html string")
    pages = spark.createDataFrame([(1,)], "input_row_id long")
    got = sorted((r.input_row_id, r.status) for r in crawl.entry_outcomes(entries, pages, log).collect())
    assert [i for i, _ in got] == [1, 2] and got[0][1] == "Success"


def test_a_repeated_run_replaces_its_failures(spark, tmp_path):
    from callsheet.run import write_all

    for _ in range(2):
        write_all({"failed_rows": spark.createDataFrame([(1, "x")], "input_row_id long, stage string")}, str(tmp_path), "r1")
    assert spark.read.parquet(str(tmp_path / "failed_rows")).count() == 1


def test_ordinals_over_files_of_unlike_size(spark, tmp_path):
    from callsheet.sources import tables

    values = []
    for i, n in enumerate((3, 5000, 40)):  # Spark reads the largest file first
        part = [(len(values) + j,) for j in range(n)]
        values += part
        spark.createDataFrame(part, "v long").coalesce(1).write.parquet(str(tmp_path / f"in/part={i}"))
    got = tables.with_ordinal(spark.read.parquet(str(tmp_path / "in")).select("v")).collect()
    assert len(got) == len(values) and all(r.v == r.input_row_id for r in got)


def test_page_sources_move_once(spark):
    """A page that many rows reach is read once, with its best attempt; the rank over attempts carries no source."""
    from callsheet.operators import crawl

    log = spark.createDataFrame(
        [("http://a.de/", 500, None, None), ("http://a.de/", 200, "http://a.de/", '<a href="/kontakt">Kontakt'),
         ("http://a.de/", 200, "http://a.de/", '<a href="/kontakt">Kontakt'), ("http://a.de/kontakt", 200, "http://a.de/kontakt", "x")],
        "url string, status_code int, landed_url string, html string")
    entries = spark.createDataFrame([(i, "http://a.de/") for i in range(20)], "input_row_id long, entry_url string")
    pages, outcomes = crawl.crawl_stored(entries, log, max_pages=0)
    assert sorted((r.link_url, r.input_row_id) for r in pages.collect()) == [("http://a.de/", 0), ("http://a.de/kontakt", 0)]
    assert outcomes.count() == 20
    assert sorted(r.link_url for r in crawl.page_sources(log, pages).collect()) == ["http://a.de/", "http://a.de/kontakt"]
    plan = crawl.fetch_log(log)._jdf.queryExecution().optimizedPlan().toString()
    assert "html" not in plan[:plan.rindex("Window")]


def test_profile_of_empty_and_tied_columns(spark):
    from callsheet.operators import analysis

    df = spark.createDataFrame([(1, "b", None), (1, "a", None), (2, "a", None), (None, "b", None)], "n int, s string, e string")
    got = {r.column: (r.filled, r.distinct, r.top, r.top_n) for r in analysis.profile(df, ["n"], ["s", "e"]).collect()}
    assert got == {"n": (3, 2, "1", 2), "s": (4, 2, "a", 2), "e": (0, 0, None, None)}


def test_public_suffix_rules(spark):
    from callsheet.operators import suffixes

    rules = spark.createDataFrame([(r,) for r in ("com", "uk", "co.uk", "*.ck", "!www.ck", "*.kobe.jp", "!city.kobe.jp", "jp", " co.UK ", "", None)], "rule string")
    want = {"a.com": ("com", "a"), "b.a.co.uk": ("co.uk", "a"), "co.uk": ("co.uk", None), "uk": ("uk", None), "x.ck": ("x.ck", None), "ck": ("ck", None),
            "y.x.ck": ("x.ck", "y"), "www.ck": ("ck", "www"), "z.www.ck": ("ck", "www"), "a.city.kobe.jp": ("kobe.jp", "city"), "c.d.kobe.jp": ("d.kobe.jp", "c"),
            "kobe.jp": ("jp", "kobe"), "n.unknown": ("unknown", "n"), "localhost": ("localhost", None), "A.Co.Uk.": ("co.uk", "a")}
    hosts = spark.createDataFrame([(h,) for h in [*want, "a.com", "", None]], "host string")
    got = {r.host: (r.suffix, r.label) for r in suffixes.public_suffixes(hosts, rules).collect()}
    assert got == want
    assert suffixes.public_suffixes(hosts, rules.limit(0)).filter("host = 'b.a.co.uk'").first().suffix == "uk"
    rows = spark.createDataFrame([(1, "http://a-b.co.uk/x"), (2, "http://a-b.de/"), (3, "http://www.ck/"), (4, None), (5, "http://c-d.x.ck/")], "input_row_id int, url string")
    tries = {}
    for r in suffixes.entry_variants(rows, rules).orderBy("input_row_id", "pos").collect():
        tries.setdefault(r.input_row_id, []).append(r.try_url)
    assert tries[1] == ["http://a-b.co.uk/x", "http://a.co.uk/x"] and tries[5] == ["http://c-d.x.ck/", "http://c.x.ck/"]
    assert tries[2] == ["http://a-b.de/", "http://a.de/", "http://a-b.com/", "http://a.com/"] and tries[3] == ["http://www.ck/"] and tries[4] == [None]


def test_positions_and_what_limits_leave_out(spark):
    rng = random.Random(4)
    rows = [("hot", i) for i in range(3000)] + [("cold", 5), ("cold", 3), (None, 1), (None, 2)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "site string, n int").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {(r.site, r.n): r.position for r in positions(df, ["site"], [F.col("n").desc()]).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == {("hot", i): 2999 - i for i in range(3000)} | {("cold", 5): 0, ("cold", 3): 1, (None, 2): 0, (None, 1): 1}
    kept = lb.request_slots(df, "site", ["n"], max_chunks=2, chunk=3).select("site", "n").collect()
    left = lb.not_requested(df, "site", ["n"], max_chunks=2, chunk=3).select("site", "n").collect()
    whole = lb.request_slots(df, "site", ["n"], max_chunks=None, chunk=3).collect()
    assert len(kept) == 10 and sorted(map(tuple, kept + left), key=str) == sorted(rows, key=str)
    assert all(r.n == 3 * r.chunk + r.pos for r in whole if r.site == "hot") and len(whole) == len(rows)


def test_answers_are_read_from_one_variant(spark):
    """Odd answers: what is usable, and why the rest is not."""
    one = '{"number": "1", "type": "t", "classification": "c"}'
    cases = {
        '{"extracted_numbers": [%s]}' % one: (1, None), 'so: ```json\n{"extracted_numbers": [%s, %s]}\n```' % (one, one): (2, None),
        '{"extracted_numbers": [], "more": 1}': (0, None), "": (None, "EmptyResponse"), "no json": (None, "NoJsonBlock"), "{broken]}": (None, "JSONDecodeError"),
        "[%s]" % one: (None, "TypeError"), '{"other": 1}': (None, "ValidationError"), '{"extracted_numbers": null}': (None, "ValidationError"),
        '{"extracted_numbers": ["x"]}': (None, "ValidationError"), '{"extracted_numbers": [{"number": "1"}]}': (1, "ValidationError"),
        '{"extracted_numbers": [{"number": 1, "type": "t", "classification": "c", "extra": [1]}]}': (1, None)}
    df = spark.createDataFrame([(i, t) for i, t in enumerate(cases)], "i int, raw_text string")
    plan = lb.parse_responses(df)._jdf.queryExecution().optimizedPlan().toString().lower()
    assert plan.count("parse_json") + plan.count("parsejson") >= 1 and "from_json" not in plan and "jsontostructs" not in plan
    got = {r.i: r for r in lb.parse_responses(df).collect()}
    for i, (text, (n, fault)) in enumerate(cases.items()):
        items = got[i]["items"]
        assert (got[i].fault is None) == (fault is None) and (fault is None or got[i].fault.endswith(fault)), text
        assert fault is not None or len(items) == n, text


def test_costly_expressions_on_a_small_file_run_on_all_cores(spark, tmp_path):
    from callsheet.plans import bindings as b

    spark.range(500).selectExpr("id AS c_custkey", "'A' AS c_mktsegment").coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    rows = b.entries(spark, str(tmp_path)).withColumn("at", F.spark_partition_id())
    per_task = [r["count"] for r in rows.groupBy("at").count().collect()]
    assert len(per_task) >= spark.sparkContext.defaultParallelism and max(per_task) < 100 and sum(per_task) == 500


def test_items_are_grouped_by_a_hash_before_their_texts(spark):
    from callsheet.operators.skew import hashed

    items = spark.createDataFrame([("b", n, "u", "Main Line", "Primary", "c", i) for i, n in enumerate(["x", None, "x", None])], ITEMS)
    got = {r.number: (r.n, r.first.ord, r["last"].ord) for r in ct.source_facts(items).collect()}
    assert got == {"x": (2, 0, 2), None: (2, 1, 3)}
    for df in (ct.source_facts(items), ct.numbers(ct.source_facts(items))):
        sorts = re.findall(r"Sort \[(\w+)#", df._jdf.queryExecution().executedPlan().toString())
        assert sorts and set(sorts) == {"_h"}
    same = hashed(items, "base", "number").groupBy("base", "number").agg(F.countDistinct("_h").alias("n")).collect()
    assert [r.n for r in same] == [1, 1]


def test_ranked_lists_hold_every_value_of_the_ranked_numbers_once(spark):
    src = spark.createDataFrame([("b", "1", "u", "T"), ("b", "1", "v", "T"), ("b", "2", "u", None), ("b", "3", "w", "T"), (None, "1", "u", "T")],
                                "base string, number string, source_url string, type string")
    top = spark.createDataFrame([("b", "1", 1), ("b", "2", 2), (None, "1", 1)], "base string, number string, rank int")
    lists = ct.ranked_lists(top, src, {"type": "T_", "source_url": "U_"})
    assert sorted(map(tuple, lists.collect())) == [("b", "T_1", "T"), ("b", "U_1", "u"), ("b", "U_1", "v"), ("b", "U_2", "u")]
    assert lists._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 1


def test_numbers_take_one_shuffle_and_the_last_better_type(spark):
    rows = [("b", "1", "u", "Fax", "Odd", None, 1), ("b", "1", "v", "Sales", "Odder", None, 2), ("b", "1", "w", "Main Line", "Oddest", None, 3),
            ("b", "1", "x", "Sales", "Even", None, 4), ("b", "1", "y", "Unknown", "Late", None, 5),
            ("b", "2", "u", "Main Line", "Odd", None, 1), ("b", "2", "v", "Unknown", None, None, 2), ("b", "2", "w", None, "Late", None, 3),
            (None, None, "u", None, None, None, 1), (None, None, "v", "Fax", "Primary", None, 2)]
    facts = ct.source_facts(spark.createDataFrame(rows, ITEMS)).localCheckpoint()
    nums = ct.numbers(facts)
    got = {(r.base, r.number): (r.classification, r.first_type, r.n_items) for r in nums.collect()}
    assert got == {("b", "1"): ("Even", "Fax", 5), ("b", "2"): ("Odd", "Main Line", 3), (None, None): ("Primary", None, 2)}
    assert {r.base: r.n for r in ct.base_volume(nums).collect()} == {"b": 8, None: 2}
    assert nums._jdf.queryExecution().sparkPlan().toString().count("SortAggregate") == 2  # before and after one shuffle


def test_page_urls_of_entries_are_normalised_outside_branches(spark, tmp_path):
    from callsheet.plans import bindings as b

    spark.range(1, 90).selectExpr("id AS c_custkey", "'A' AS c_mktsegment").write.parquet(f"{tmp_path}/customer.parquet")
    rows = b.entries(spark, str(tmp_path))
    got = {r.input_row_id: (r.status, r.pathful_url) for r in rows.collect()}
    assert got[2] == ("Success", "http://s2.example.com/start") and got[3] == ("Success", "http://s3.example.com/start?a=1&b=2")
    assert got[44] == ("DNSError", None) and got[55] == ("DNSError", "http://s55.example.com/start?a=1&b=2")
    assert got[43] == ("Success", "http://s44.example.com/start") and got[47] == ("MaxRedirects_InputURL", None)
    assert "_same" not in rows.columns
    assert "struct(_same" in rows._jdf.queryExecution().executedPlan().toString()


def test_facts_and_numbers_are_sorted_once_behind_their_shuffle(spark):
    rows = [("b", "1", "u", "Fax", "Primary", "c", i) for i in range(3)] + [(None, "1", None, None, None, None, 9)]
    facts = ct.source_facts(spark.createDataFrame(rows, ITEMS))
    assert {r.base: (r.n, r.first.ord, r["last"].ord) for r in facts.collect()} == {"b": (3, 0, 2), None: (1, 9, 9)}
    nums = ct.numbers(facts.localCheckpoint())
    assert {r.base: r.n_items for r in nums.collect()} == {"b": 3, None: 1}
    for df in (facts, nums):
        planned = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
        assert planned.count("Sort [_h") == 1 and planned.count("Exchange ") == 1


def test_ranks_are_looked_up_and_urls_of_a_base_are_distinct(spark):
    src = spark.createDataFrame([("b", "1", "u", "T"), ("b", "2", "u", "T"), ("c", "1", None, None), (None, "1", "v", "T")],
                                "base string, number string, source_url string, type string")
    assert sorted(map(str, ct.original_urls(src).collect())) == sorted(map(str, spark.createDataFrame(
        [("b", "u"), ("b", "b"), ("c", None), ("c", "c"), (None, "v"), (None, None)], "base string, url string").collect()))
    lists = ct.ranked_lists(src.selectExpr("base", "number", "1 AS rank"), src, {"type": "T_"})
    assert "ShuffledHashJoin" in lists._jdf.queryExecution().sparkPlan().toString()


def test_numbers_of_facts_that_lie_by_number_need_no_shuffle(spark):
    rng = random.Random(5)
    rows = [(rng.choice(["a", "b", None]), rng.choice(["1", "2", None]), f"u{rng.randrange(3)}", rng.choice(TYPES), rng.choice(CLASSES), "c", i)
            for i in range(120)]
    items = spark.createDataFrame(rows + rows[:7], ITEMS)
    nums = ct.numbers(ct.source_facts(items, by_number=True))
    key = lambda df: sorted(map(str, df.collect()))
    assert key(nums) == key(ct.numbers(ct.source_facts(items).localCheckpoint()))
    counts = nums.select("base", "number", "n_items")
    assert {(r.base, r.number): r.n_items for r in counts.collect()} == {
        k: sum((r[0], r[1]) == k for r in rows + rows[:7]) for k in {(r[0], r[1]) for r in rows}}
    for df in (nums, counts):
        planned = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
        assert planned.count("Exchange ") == 1
    assert "Sort" not in counts._jdf.queryExecution().sparkPlan().toString()


def test_outcomes_store_no_sources_and_lists_store_them_once(spark, tmp_path):
    from callsheet.plans import queries_reports as q

    line = "id AS l_orderkey, id % 60 AS l_partkey, id % 5 AS l_suppkey, cast(id % 7 AS int) AS l_linenumber"
    spark.range(1, 200).selectExpr(*line.split(", ")).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(1, 90).selectExpr("id AS c_custkey", "'A' AS c_mktsegment").write.parquet(f"{tmp_path}/customer.parquet")
    plain, listed = q.Run(spark, str(tmp_path)), q.Run(spark, str(tmp_path), listed=True)
    key = lambda df: sorted(map(str, df.collect()))
    assert key(plain.outcomes) == key(listed.outcomes) and key(plain.journey) == key(listed.journey)
    assert "source_facts" not in vars(plain) and "numbers" not in vars(plain)
    assert key(plain.counted) == key(listed.numbers.select("base", "number", "n_items"))
    assert "source_facts" in vars(listed) and listed.counted is listed.numbers


def test_names_and_hosts_are_counted_from_one_shuffle_of_pairs(spark):
    rows = [(1, "A ", "http://www.x.de/a"), (2, " A", "x.de"), (2, "B", "  "), (3, None, None), (4, "", "HTTP://X.de:80/"), (None, "B", "http://y.de")]
    df = spark.createDataFrame(rows, "input_row_id bigint, company_name string, given_url string")
    counted = dp.with_duplicate_counts(df)
    got = sorted((str(r.input_row_id), r.name_count, r.host_key, r.host_count, r.name_dup, r.host_dup, r.any_dup) for r in counted.collect())
    assert got == [("1", 2, "x.de", 2, True, True, True), ("2", 2, dp.MISSING_URL, 2, True, False, True), ("2", 2, "x.de", 2, True, True, True),
                   ("3", 0, dp.MISSING_URL, 2, False, False, False), ("4", 1, "x.de:80", 1, False, False, False),
                   ("None", 2, "y.de", 1, True, False, True)]
    assert "ReusedExchange" in counted._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    told = dp.duplicate_profile(df).first()
    assert (told.rows_dup_name, told.rows_dup_url, told.rows_dup_any, told.names_repeated, told.urls_repeated) == (4, 2, 4, 2, 1)
