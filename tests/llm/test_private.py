"""Personal data: base spans against plain Python, learned spans, odd texts, redaction."""

from __future__ import annotations

import hashlib
import re
import time

import numpy as np
from pyspark.sql import functions as F

from callsheet.llm import private

SCHEMA = "doc_id long, text string, row string, base string, spans string, known int"


def luhn(d: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(d)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def brute(t: str | None) -> list[tuple[str, int, int]]:
    t, out = t or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t):
        out.append(("email", m.start(), m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m[0])
        if 13 <= len(d) <= 19 and luhn(d):
            out.append(("card", m.start(), m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append(("phone", m.start(), m.end()))
    return out


def listed(spans) -> str:
    return ",".join(f"{k}:{a}:{z}" for k, a, z in spans)


def checked(spark, texts: list[str | None]):
    frame = spark.createDataFrame([(i, t, "r", None, "s", 1) for i, t in enumerate(texts)], SCHEMA)
    rows = private.digests(private.find_private(frame)).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = brute(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(listed(want).encode()).hexdigest(), texts[r.doc_id][:200]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x for x, _, _ in want) for k in private.KINDS]
        assert set(filter(None, listed(want).split(","))) <= set(r.spans.split(","))
    return {r.doc_id: r for r in rows}


ODD = [None, "", " ", "a@b", "a@b.c_d@e.f", "a@b.c@d.e.f", "x@-.-", "@b.c", "é@b.co ü.a@b.co", "😀 a@b.co 1.2.3.4 😀 +1 (743) 555-3824", "a@b..c", "%+-@h.i-",
       "1.2.3.4.5.6.7.8", "256.1.1.1", "1.2.3.0255", "0001.2.3.4", "1.2.3.99999999999999999999", "9.256.1.2.3", "1.2.3.", "01.02.03.04",
       "4465758382889437", "4465 7583 8288 9437 4465-7583-8288-9437", "4465  7583", "4-4-6-5", "5 ", "0000000000000", "12345678901234567890123", "+1 2", "+1((2", "+1 234-567-89",
       "+12345678901234567890", "+1 (2) 3.4-5 678 9 0 ()", "++1 234 567 890", "+1 234 567 890 +1 234 567 890", "+1" + " " * 500 + "234567890", "1.2.3.4 a@b.c" * 300]


def test_base_spans_against_plain_python(spark):
    rng = np.random.default_rng(1)
    parts = ["a", "b.c", "@", ".", "..", " ", "-", "+", "+1", "(", ")", "12", "255", "256", "1.2.3.4", "4465758382889437", "é", "😀", "555-3824", "x@y.de", "_", "%", "\n", "0"]
    checked(spark, ODD + ["".join(rng.choice(parts, int(rng.integers(1, 60)))) for _ in range(1500)])


def test_empty_table_and_repeated_rows(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert private.find_private(none).collect() == []
    twice = spark.createDataFrame([(1, "a@b.co"), (1, "a@b.co"), (None, "1.2.3.4"), (None, None)], "doc_id long, text string")
    got = sorted((str(r.doc_id), r.spans) for r in private.digests(private.find_private(twice)).collect())
    assert got == [("1", "email:0:6"), ("1", "email:0:6"), ("None", ""), ("None", "ip:0:7")]


def test_long_texts_take_linear_time(spark):
    """One text of half a million characters of each kind; the plain patterns would need their square."""
    texts = [("a", None), ("1", None), ("1 ", None), ("+1 ", None), ("a@", None), ("1.", None), ("a@b.c ", "n_email"), (".b", None), ("(", None), ("@ ", None), ("1.2.3.4 ", "n_ip")]
    frame = spark.createDataFrame([(i, t * (500_000 // len(t)), n) for i, (t, n) in enumerate(texts)], "doc_id long, text string, row string")
    started = time.time()
    rows = {r.doc_id: r for r in private.digests(private.find_private(frame)).collect()}
    assert time.time() - started < 90
    for i, (t, n) in enumerate(texts):
        if n:
            assert rows[i][n] == 500_000 // len(t)


def documents(rng) -> list[str]:
    """Known data, the same in other writing, and look-alikes that fail their check."""
    out = []
    for i in range(1500):
        a, b, c = (int(x) for x in rng.integers(200, 999, 3))
        ip = ".".join(str(int(x)) for x in rng.integers(1, 255, 4))
        card = "4" + "".join(str(int(x)) for x in rng.integers(0, 9, 14))
        card += next(str(d) for d in range(10) if luhn(card + str(d)))
        out.append([f"call +1 ({a}) {b}-{c}1 now", f"host {ip} is up", f"mail user{a}@mail{b % 7}.example.com here", f"pay by {card} today",
                    f"order {b}{c}{a}{b}{c}{a % 10 or 3} sent", f"version {a}.{a}.{b}.{c} is out"][i % 6])
    return out


def test_other_writing_is_learned_and_failed_checks_are_not(spark):
    texts = documents(np.random.default_rng(2))
    other = ["call (743) 555-3824 now", "host 10[.]20[.]30[.]40 is up", "mail user7 (at) mail3.example.com here", "mail user7 [at] mail3 [dot] example [dot] com here",
             "pay by 4465.7583.8288.9437 today", "pay by 4465 7583 8288 9438 today", "version 300.300.400.500 is out", "in 1999 and 2004, some 300 people", "meet at home. then go"]
    rows = checked(spark, texts + other)
    added = {t: rows[len(texts) + i].spans for i, t in enumerate(other)}
    assert added[other[0]] == "phone:5:19" and added[other[2]] == "email:5:33" and added[other[3]].startswith("email:5:")
    assert [added[t] for t in other[5:]] == [""] * 4
    assert all(rows[i].spans == listed(brute(t)) for i, t in enumerate(texts))


def test_trees_in_columns_equal_trees_in_arrays(spark):
    rng = np.random.default_rng(3)
    x = rng.integers(0, 6, (200, 4))
    n, known = rng.integers(1, 30, 200).astype(float), np.zeros(200)
    known = np.floor(n * (x[:, 0] > 2) * (x[:, 2] < 4))
    trees = private.boosted(x, known, n)
    want = sum(private.tree_values(t, x) for t in trees)
    score = sum((private.tree_column(t, F.col("f")) for t in trees[1:]), private.tree_column(trees[0], F.col("f")))
    got = spark.createDataFrame([(x.tolist()[i], i) for i in range(200)], "f array<int>, i int").select("i", score.alias("s")).collect()
    assert all(abs(r.s - want[r.i]) < 1e-12 for r in got)
    assert ((want > 0) == (known / n > 0.5)).mean() > 0.97  # a learnable rule is learned


def test_threshold_is_the_lowest_calibrated_score():
    score, n = np.array([0.1, 0.2, 0.3, 0.4]), np.array([10.0, 10, 10, 10])
    assert private.threshold(score, np.array([0.0, 1, 6, 9]), n, 0.5) == 0.3
    assert private.threshold(score, np.array([0.0, 9, 1, 9]), n, 0.5) == 0.2  # the fall is pooled: 10 of 20
    assert private.threshold(score, np.zeros(4), n, 0.5) == np.inf


def test_redacted_text(spark):
    text = "é a@b.co, 1.2.3.4 and +1 (743) 555-3824!" + "x" * 9000 + "1.2.3.4"
    frame = spark.createDataFrame([(1, text), (2, "plain"), (3, ""), (4, "1.2.3.4")], "doc_id long, text string")
    got = private.find_private(frame, row=F.struct("text")).select("doc_id", private.redacted(F.col("row.text"), F.col("spans")).alias("t")).collect()
    assert {r.doc_id: r.t for r in got} == {1: "é [EMAIL], [IP] and [PHONE]!" + "x" * 9000 + "[IP]", 2: "plain", 3: "", 4: "[IP]"}
    overlapping = spark.sql("SELECT '0123456789' AS t, array(named_struct('kind', 3, 'start', 4L, 'end', 8L), named_struct('kind', 2, 'start', 2L, 'end', 6L)) AS s")
    assert overlapping.select(private.redacted(F.col("t"), F.col("s"))).first()[0] == "01[CARD]89"
