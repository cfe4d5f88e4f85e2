"""Golden values and properties of the column functions."""

from __future__ import annotations

import random
import time

import pytest
from pyspark.sql import functions as F

from callsheet.functions import html, phones, text, urls
from callsheet.functions.text import blocks
from callsheet.operators.links import LinkRules, link_score
from callsheet.sources.tables import parse_row_range


def apply(spark, fn, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    rows = df.select("i", fn(F.col("v")).alias("r")).collect()
    return [r.r for r in sorted(rows, key=lambda r: r.i)]


@pytest.mark.parametrize("fn, cases", [
    (urls.normalize_url, {
        "HTTP://WWW.Example.com/a/index.html?b=2&a=1&fallback=x#top": "http://example.com/a?a=1&b=2",
        "http://example.com": "http://example.com/",
        "https://blog.x.example.com/en/853/": "https://blog.x.example.com/en/853",
        "http://x.de/a/;p": "http://x.de/a;p", "mailto:a@b": "mailto:a@b", "http://x.de/?": "http://x.de/",
        "http://index.html": "http://index.html/", "http://x.de//": "http://x.de/",
        "http://x.de/?Fallback&z": "http://x.de/?z"}),
    (urls.base_domain, {
        "http://www.example.com/path?query": "http://example.com", "example.com/path": "http://example.com",
        "localhost": None, "HTTP://a.de": None, "": None, "https://u:p@www.x.de:80/a": "https://u:p@www.x.de:80"}),
    (urls.input_host, {" www.A.de/x ": "a.de", "http://": None, "": None, "x": "x"}),
    (urls.clean_url, {
        "/ü b/%20": "http:///%C3%BC%20b/%20", "x y.de/ü b?q=a b&c#f g": "http://xy.de/%C3%BC%20b?q=a%20b&c#f%20g",
        "http://a.de": "http://a.de/", "x.de:8080/a": "x.de:8080/a", "": None,
        "a.de?x": "http://a.de/?x", "http://a.de/?#": "http://a.de/"}),
    (urls.page_type, {
        "http://a.de/kontakt": "contact", "http://a.de/legal-notice": "imprint", "http://a.de/datenschutz": "legal",
        "http://x.de/": "homepage", "http://kontakt.x.de/foo": "contact", "http://a.de/produkte": "general_content",
        "": "unknown"}),
    (urls.domain_label, {
        "https://wolterskluwer.com - AnNoText": "wolterskluwer", "http://a.co.uk - X": "a",
        "http://shop.example.fr - Z": "shop", "example.de": "example", "foo": None}),
    (urls.source_path, {"http://a.de": "/", "http://a.de/b?c=1#d": "/b?c=1", "http://a.de?x": "?x"}),
    (lambda c: phones.e164(c, "DE"), {
        "+49 30 123456": "+4930123456", "089/123456": "+4989123456", "invalid-number": "InvalidFormat", "": None,
        "0049 (0)30 123456": "+4930123456", "+1 (743) 555-3824": "+17435553824"}),
    (lambda c: phones.is_placeholder(c), {
        "0000000000": True, "123456789": True, "5555555": True, "55555": False}),
    (lambda c: phones.has_repeats(c), {"1222223": True, "1222234": False}),
    (lambda c: phones.has_sequence(c), {"9812345": True, "9854321": True, "9812340": False, "12345x": False}),
    (lambda c: phones.is_target_country(c), {"+4930123456": True, "+17435553824": False, "030 1": False}),
    (html.html_text, {
        '<p>a&amp;b<b>c</b>&#228;&#x20AC;&foo;&nbsp;<script>x="</p>"</script><!-- z -->d': "a&b c ä€&foo; d",
        "": "", "plain": "plain"}),
    (text.json_block, {
        'Hi ```json\n{"a": [1]}\n``` bye': '{"a": [1]}', "x [1, 2] y": "[1, 2]", "none": None}),
])
def test_golden(spark, fn, cases):
    assert dict(zip(cases, apply(spark, fn, list(cases)))) == cases


def test_dns_variants(spark):
    got = apply(spark, urls.dns_variants, ["http://a-b.de/", "http://www.a-b.co.uk/x", "http://x.com/"])
    assert got[0] == ["http://a-b.de/", "http://a.de/", "http://a-b.com/", "http://a.com/"]
    assert got[1] == ["http://www.a-b.co.uk/x", "http://a.co.uk/x"]
    assert got[2] == ["http://x.com/"]


def test_resolve_link(spark):
    base = F.lit("http://h.de/a/b/c.html?x=1")
    cases = {"d": "http://h.de/a/b/d", "../d": "http://h.de/a/d", "/../d/./e": "http://h.de/d/e",
             "?q": "http://h.de/a/b/c.html?q", "#f": "http://h.de/a/b/c.html?x=1#f", "//o.de/x": "http://o.de/x",
             "mailto:x": "mailto:x", "./": "http://h.de/a/b/", "..": "http://h.de/a/",
             "d?x=../y": "http://h.de/a/b/d?x=../y"}
    assert dict(zip(cases, apply(spark, lambda c: urls.resolve_link(base, c), list(cases)))) == cases


def test_normalize_is_idempotent(spark):
    rng = random.Random(1)
    words = ["a", "B", "index.htm", "x;y", "ü"]
    samples = [f"http{rng.choice(['', 's'])}://Host{i}.de/" + "/".join(rng.choices(words[:3] + words[4:], k=rng.randint(0, 3)))
               + rng.choice(["", "?b=1&a=2", "?fallback=1", "#z"]) for i in range(200)]
    samples = [u for u in samples if "index.htm/" not in u and not u.split("?")[0].split("#")[0].endswith("index.htm")]
    once = apply(spark, urls.normalize_url, samples)
    assert apply(spark, urls.normalize_url, once) == once


def test_row_ranges():
    cases = {"10-20": (9, 11), "10-": (9, None), "-50": (0, 50), "20": (0, 20), "0": (0, None),
             "20-10": (0, None), "0-5": (0, None), "": (0, None), None: (0, None), "x": (0, None)}
    assert {k: parse_row_range(k) for k in cases} == cases


def test_digit_runs_and_snippet(spark):
    t = "call +1 (743) 555-3824 x, 7435553825, 9991112222% 10.20.30.400"
    df = spark.createDataFrame([(t,)], "t string").select(F.inline(phones.digit_runs(F.col("t"))))
    for r in df.collect():
        assert t[r.start:r.start + len(r.raw)] == r.raw
        assert (t[r.start - 1:r.start], t[r.start + len(r.raw):][:1]) == (r.before, r.after)
    long = "lead " + "word " * 100 + "+49 30 1234567" + " tail" * 100
    at = long.index("+49")
    got = spark.createDataFrame([(long,)], "t string").select(
        phones.snippet(blocks(F.col("t")), F.length("t"), F.lit(at), F.lit(at + 14)).alias("s")).first().s
    first = long.rfind(" ", 0, at - 150) + 1
    last = long.find(" ", at + 14 + 150)
    assert got == long[first:last].strip()


def tier_score(path, link_text, rules):
    """Tier by tier, as a loop."""
    segs = [s for s in path.strip("/").split("/") if s]
    extra = max(0, len(segs) - rules.max_segments)
    score = 0
    for w in rules.critical:
        if w in segs:
            score = max(score, 100 - min(20, 5 * extra))
    if score < 90:
        for w in rules.high:
            if w in segs:
                score = max(score, 90 - min(20, 5 * extra))
    if score < 80:
        for w in set(rules.critical + rules.high):
            if w in segs:
                score = max(score, 80 - 5 * segs.index(w) - min(15, 5 * extra))
    if score < 50 and any(w in s for w in rules.target for s in segs):
        score = 50
    if score < 40 and any(w in link_text for w in rules.target):
        score = 40
    return score


def test_link_scores(spark):
    rules = LinkRules()
    fixed = {("/kontakt", ""): 100, ("/a/b/c/kontakt", ""): 95, ("/legal", ""): 90,
             ("/a/b/c/d/e/f/legal", ""): 70, ("/mycontact", ""): 50, ("/foo", "contact us"): 40, ("/foo", ""): 0}
    rng = random.Random(7)
    pool = ["a", "b", "kontakt", "legal", "mycontact", "about-us", "x", "imprint", "terms"]
    cases = list(fixed) + [("/" + "/".join(rng.choices(pool, k=rng.randint(0, 7))), rng.choice(["", "about us", "z"]))
                           for _ in range(400)]
    df = spark.createDataFrame([(i, p, t) for i, (p, t) in enumerate(cases)], "i int, p string, t string")
    got = {r.i: r.s for r in df.select("i", link_score(F.col("p"), F.col("t"), rules).alias("s")).collect()}
    for i, (p, t) in enumerate(cases):
        assert got[i] == fixed.get((p, t), tier_score(p, t, rules)), (p, t)


def test_digit_runs_of_a_long_text(spark):
    """Offsets across many blocks, and a table-like page in good time."""
    rows = "".join(f"{i % 7 * 'q'}; {100000000 + i}; " for i in range(20_000))
    started = time.time()
    got = spark.createDataFrame([(rows,), ("",), (None,), ("no digits",)], "t string").select(
        F.length("t").alias("n"), phones.digit_runs(F.col("t")).alias("r")).select("n", F.explode_outer("r").alias("r")).select("n", "r.*").collect()
    assert time.time() - started < 30
    found = [r for r in got if r.n == len(rows)]
    assert len(found) == 20_000 and len(got) == 20_003
    for r in found:
        assert rows[r.start:r.start + len(r.raw)] == r.raw and rows[r.start - 1] == r.before and rows[r.start + len(r.raw)] == r.after


def test_snippets_reach_the_next_blank_however_far(spark):
    """Against slices of the text: blanks near, blocks away, and none at all."""
    rng = random.Random(6)
    cases = []
    for _ in range(60):
        words = ["x" * rng.choice((1, 5, 40, 300, 1100, 2500)) for _ in range(rng.randint(0, 12))]
        t = " ".join(words) + rng.choice(("", " ", "-")) + "0302468105" + rng.choice(("", " ", "-")) + " ".join(words[::-1])
        at = t.index("0302468105")
        cases.append((t, at, at + 10))
    got = spark.createDataFrame(cases, "t string, a int, z int").select("t", "a", "z", phones.snippet(
        blocks(F.col("t")), F.length("t"), F.col("a"), F.col("z")).alias("s")).collect()
    for r in got:
        low, high = max(r.a - 150, 0), min(r.z + 150, len(r.t))
        first = r.t.rfind(" ", 0, low) + 1 or low
        last = r.t.find(" ", high)
        assert r.s == r.t[first:last if last >= 0 else high].strip()


def test_many_numbers_in_one_long_text(spark):
    from callsheet.operators import candidates as cd

    page = " ".join(f"tel {f'030 24{i % 100000:05d}':>14}" for i in range(100_000))
    texts = spark.createDataFrame([("p", page)], "page_url string, text string")
    plan = cd.phone_candidates(texts, "DE")._jdf.queryExecution().optimizedPlan().toString()
    assert "text" not in plan[:plan.index("Generate")]
    started = time.time()
    n = cd.phone_candidates(texts, "DE").agg(F.count(F.lit(1)).alias("n"), F.max(F.length("snippet")).alias("m")).first()
    assert n.n > 50_000 and n.m < 400 and time.time() - started < 60


def test_runs_of_any_length(spark):
    """A table of figures is one run; it may be as long as the text."""
    from callsheet.operators import candidates as cd

    runs = ["7" * 30_000, "7 3 " * 15_000, "(030) 2468105 " + "12-34 " * 9_000]
    texts = spark.createDataFrame([(f"tel 030 2468105; {r}; 030 2468207 {'ü😀' * 3_000}",) for r in runs], "text string")
    found = texts.select("text", F.inline(phones.digit_runs(F.col("text")))).collect()
    assert len(found) == 9
    for r in found:
        assert r.text[r.start:r.start + len(r.raw)] == r.raw
    assert {len(r.raw) for r in found} >= {30_000, 29_999 * 2 + 1}
    got = cd.phone_matches(texts, "DE", window=300).collect()
    assert [r.number for r in got] == ["+49302468105", "+49302468207"] * 3
    assert cd.phone_candidates(texts, "DE").count() == 6
    assert texts.filter(F.col("text").rlike(phones.WHOLE_RUN)).count() == 3


def test_numbers_inside_one_long_word(spark):
    """Each snippet is as long as the word, or short where no blank comes, at no cost for the blanks that are not there."""
    from callsheet.operators import candidates as cd

    word = ";".join(f"{'x' * 185}+4930246{i:05d}" for i in range(150)) + ";" + "x" * 185
    long = ";".join(f"word+4930246{i:05d}" for i in range(60_000))
    texts = spark.createDataFrame([(1, word), (2, f"a {word} z"), (3, f"a {word}"), (4, None), (5, "none")], "i int, text string")
    sizes = F.count(F.lit(1)).alias("n"), F.min(F.length("snippet")).alias("least"), F.max(F.length("snippet")).alias("most")
    for f in (cd.phone_candidates, lambda t: cd.phone_matches(t, window=300)):
        got = {r.i: r for r in f(texts).groupBy("i").agg(*sizes).collect()}
        assert set(got) == {1, 2, 3} and got[1].n == got[2].n == got[3].n > 100
        assert (got[2].least, got[2].most) == (len(word), len(word)) and got[1].most == 313 and got[3].most > len(word) - 400
    started = time.time()
    got = cd.phone_candidates(spark.createDataFrame([(long,)], "text string")).agg(*sizes).first()
    assert got.n > 40_000 and got.most == 313 and time.time() - started < 60


def test_snippets_of_many_matches_equal_slices(spark):
    """Against slices of the text, over more matches than leave a text in one row, with spans that cross blocks."""
    from callsheet.operators import candidates as cd

    rng = random.Random(8)
    texts = []
    for size in (1, 255, 256, 257, 700):
        texts.append("".join(f"{rng.choice(('', ' ', 'ü' * rng.choice((3, 200, 1500)), 'w ' * 90, chr(160)))}; +49 30 2{i:06d}{rng.choice(('', ' ', ', y'))}" for i in range(size)))
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    got = cd.phone_matches(df, window=300).collect()
    assert {r.i: r.match_ord for r in got if r.i == 4}[4] > 600
    for r in got:
        t = texts[r.i]
        low, high = max(r.match_start - 150, 0), min(r.match_end + 150, len(t))
        last = t.find(" ", high)
        assert t[r.match_start:r.match_end] == r.raw
        assert r.snippet == t[t.rfind(" ", 0, low) + 1 or low:last if last >= 0 else high].strip()


def test_numbers_of_other_countries_and_neighbours(spark):
    from callsheet.operators import candidates as cd

    cases = {
        "call +55 11 5555 1234 now": ["+551155551234"], "+81 3 1234 6789": ["+81312346789"], "+354 555 12345": ["+35455512345"],
        "+999 1234567": [], "(030) 2468105 (030) 2468207": ["+49302468105", "+49302468207"],
        "+49 (0)30 2468105 / 030 2468207": ["+49302468105", "+49302468207"], "(030) 2468105": ["+49302468105"]}
    texts = spark.createDataFrame(list(enumerate(cases)), "i int, text string")
    got = {}
    for r in cd.phone_matches(texts, "DE").orderBy("i", "match_ord").collect():
        got.setdefault(r.i, []).append(r.number)
        assert list(cases)[r.i][r.match_start:r.match_end] == r.raw
    assert [got.get(i, []) for i in range(len(cases))] == list(cases.values())


def test_named_references_and_open_anchors(spark):
    from callsheet.functions import html

    t = "a &rarr; b &hearts; c &times; &amp;rarr; &unknown; &#8594;&Auml;"
    page = '<a href="/x">one<a href="/y">two</a><p>z</p><a href="/k">three\n'
    r = spark.createDataFrame([(t, page)], "t string, p string").select(
        html.html_text(F.col("t")).alias("t"), F.transform(html.anchors(F.col("p")), html.anchor_href).alias("h"),
        F.transform(html.anchors(F.col("p")), html.anchor_text).alias("x")).first()
    assert r.t == "a \u2192 b \u2665 c \u00d7 &rarr; &unknown; \u2192\u00c4"
    assert r.h == ["/x", "/y", "/k"] and r.x == ["one", "two", "three"]


def test_csv_cells_with_line_breaks(spark, tmp_path):
    from callsheet.sources import tables

    (tmp_path / "rows.csv").write_text('firma,url\n"A ""B""\nC",http://a.de\n')
    got = tables.read_csv(spark, str(tmp_path / "rows.csv"), tables.string_schema("firma", "url")).collect()
    assert [tuple(r) for r in got] == [('A "B"\nC', "http://a.de")]


def test_csv_by_many_tasks_equals_one(spark, tmp_path):
    """Quoted line breaks, doubled quotes, CRLF, blank lines, short rows; several files in small ranges."""
    from callsheet.sources import tables

    rng = random.Random(8)
    cells = ["", "x", '"a, b"', '"line\nbreak"', '"say ""hi"""', '"\n\n"', "plain text", '""', '"é,\n""\n"', "7"]
    for i, end in enumerate(("\n", "\r\n", "\n")):
        rows = []
        for _ in range((300, 5, 900)[i]):
            row = ",".join(rng.choice(cells) for _ in range(3 if rng.random() < 0.95 else 2))
            rows.append(row if end == "\n" else row.replace("\n", " "))
            if rng.random() < 0.05:
                rows.append("")
        (tmp_path / f"part{i}.csv").write_text("a,b,c" + end + end.join(rows) + (end if i else ""), newline="")
    schema = tables.string_schema("a", "b", "c")
    want = tables.with_text_ordinal(tables.read_csv(spark, str(tmp_path), schema)).orderBy("input_row_id").select("input_row_id", "a", "b", "c").collect()
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
    spark.conf.set("spark.sql.files.openCostInBytes", "10")
    try:
        got = tables.scan_csv(spark, str(tmp_path), schema)
        assert spark.read.option("lineSep", "\n").text(str(tmp_path)).rdd.getNumPartitions() > 5
        assert [tuple(r) for r in got.orderBy("input_row_id").collect()] == [tuple(r) for r in want]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_numbers_inside_a_run_against_every_split(spark):
    """The dynamic program against all ways to cut a run of groups into numbers and rest."""
    import re

    rng = random.Random(9)
    runs = ["030 2468105 030 2468207", "030 2468105 7 030 2468207", "2024 030 2468105 / 030 2468207 11", "+49 30 2468105 0043 1 5551234", "1 2 3 4 5 6 7", "999"]
    runs += [rng.choice(" -./").join("".join(rng.choice("0123456789") for _ in range(rng.choice((1, 2, 3, 4, 7, 8)))) for _ in range(rng.randint(2, 7))) for _ in range(120)]
    runs += [("030 " + r) for r in runs[6:46]]
    pieces = sorted({r[a.start():z.end()] for r in runs for a in re.finditer("[+(]{0,2}[0-9]+", r) for z in re.finditer("[+(]{0,2}[0-9]+", r) if z.start() >= a.start()})
    valid = {r.t: r.n for r in spark.createDataFrame([(p,) for p in pieces], "t string").select("t", phones.e164_or_null(F.col("t"), "DE").alias("n")).collect()}

    def best(run):
        groups = [(m.start(), m.end()) for m in re.finditer("[+(]{0,2}[0-9]+", run)]

        def tail(i):
            """All (digits, -numbers, marked beginnings, cuts) of the groups from i on."""
            if i == len(groups):
                return [(0, 0, 0, ())]
            out = tail(i + 1)
            for j in range(i, min(i + 10, len(groups))):
                text = run[groups[i][0]:groups[j][1]]
                n = len(re.sub("[^0-9]", "", text))
                if 7 <= n <= 17 and valid[text]:
                    out += [(n + d, c - 1, m + (text[0] in "0+("), ((groups[i][0], text, valid[text]), *cuts)) for d, c, m, cuts in tail(j + 1)]
            return out

        return max((d, c, m) for d, c, m, _ in tail(0)) if len(groups) > 1 else (0, 0, 0)

    df = spark.createDataFrame([(r,) for r in runs], "t string").select("t", phones.numbers_in_run(F.col("t"), "DE").alias("found"))
    for r in df.collect():
        ends = 0
        for f in r.found:
            assert r.t[f.offset:f.offset + len(f.raw)] == f.raw and valid[f.raw] == f.number and f.offset >= ends
            ends = f.offset + len(f.raw)
        assert (sum(len(re.sub("[^0-9]", "", f.raw)) for f in r.found), -len(r.found),
                sum(f.raw[0] in "0+(" for f in r.found)) == best(r.t), r.t
    first = df.filter(F.col("t") == runs[0]).first().found
    assert [f.number for f in first] == ["+49302468105", "+49302468207"]


def test_clean_url_runs_its_steps_once_on_urls_that_are_not_plain(spark):
    df = spark.createDataFrame([("S1.de/a b;c d?x=1 2#f\u00e4",), ("s2.de/a?b=1#x",), ("http://s3.de/a",), ("",), (None,)], "v string")
    out = df.select(urls.clean_url(F.col("v")).alias("r"))
    assert [r.r for r in out.collect()] == ["http://S1.de/a%20b;c d?x=1%202#f%C3%A4", "http://s2.de/a?b=1#x", "http://s3.de/a", None, None]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("u{0085}") < 60 and len(plan) < 20_000, (plan.count("u{0085}"), plan.count("x{0085}"), len(plan))


def test_url_steps_run_once_and_plain_urls_with_fragments_stay_as_they_are(spark):
    rows = [("a.de/b?x=1#top/2?", "http://a.de/b?x=1#top/2?", "http://a.de/b?x=1"), ("a.de/b=c#x", "http://a.de/b%3Dc#x", "http://a.de/b=c"),
            ("http://a.de/b?c;d#x y", "http://a.de/b?c%3Bd#x%20y", None), ("http://a.de#", "http://a.de/", "http://a.de/"),
            ("http://a.de?#", "http://a.de/", "http://a.de/"), ("http://a.de/?b=2&fallback=1&a=1", "http://a.de/?b=2&fallback=1&a=1", "http://a.de/?a=1&b=2"),
            (None, None, None)]
    given = spark.createDataFrame(rows, "given string, clean string, normal string")
    got = given.select("*", urls.clean_url(F.col("given")).alias("c"), urls.normalize_url(F.col("given")).alias("n"))
    for r in got.collect():
        assert r.c == r.clean
        assert r.normal is None or r.n.endswith(r.normal.removeprefix("http://"))
    assert given.select(F.lit("http://a.de/b?x=1#top").rlike(urls.PLAIN).alias("p")).first().p
    plan = given.select(urls.normalize_url(F.col("given")).alias("n"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("www") == 1
