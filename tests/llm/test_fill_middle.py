"""Fill-in-the-middle: the boundary set against plain search, cuts against plain Python."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from callsheet.llm import fill_middle

SCHEMA = "doc_id long, text string, form string, n long, output string"


@pytest.mark.parametrize("text", ["", "x", "a" * 200_000, "é" * 100_000, "漢字a" * 60_000, "aé" * 90_000, "a" * 65_535 + "é" * 3, "😀" * 50_000, "mixed"])
def test_boundary_set_against_search(text):
    rng = np.random.default_rng(0)
    if text == "mixed":
        text = "".join(rng.choice(list("ab cdefgé漢😀"), 150_000))
    data = np.frombuffer(text.encode(), np.uint8)
    points, want = fill_middle.BoundarySet(data), np.flatnonzero((data & 0xC0) != 0x80)
    assert len(points) == len(text) == len(want)
    k, at = rng.integers(0, len(text) + 2, 400), rng.integers(0, len(data) + 1, 400)
    assert (points.select(k) == np.append(want, [len(data), len(data)])[k]).all()
    assert (points.rank(at) == np.searchsorted(want, at)).all()


def test_all_container_kinds_are_used():
    text = "a" * 65_536 + "漢" * 65_536 + "".join(np.random.default_rng(1).choice(list("aé"), 80_000)) + "ࠀ" * 40_000
    assert {p.kind for p in fill_middle.BoundarySet(np.frombuffer(text.encode(), np.uint8)).parts} >= {fill_middle.RUN, fill_middle.BITMAP}
    sparse = np.full(65_536, 0x80, np.uint8)  # no valid text, but few boundaries
    sparse[::40] = 65
    assert fill_middle.BoundarySet(sparse).parts[0].kind == fill_middle.ARRAY


def plain(doc_id, text):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    n = len(text)
    a, z = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    p, m, s = text[:a], text[a:z], text[z:]
    return (n, "spm", a, z - a, f"<S>{s}<P>{p}<M>{m}") if h[3] % 100 < 20 else (n, "psm", a, z - a, f"<P>{p}<S>{s}<M>{m}")


def test_cuts_against_plain_python_and_round_trip(spark):
    rng = np.random.default_rng(2)
    letters = list("ab <>PSM\né漢😀́")
    texts = [None, "", "x", "<P>", "a<S>b", "<", "<P", "P>", "long " * 200_000, "😀" * 70_000] + ["".join(rng.choice(letters, int(rng.integers(0, 40)))) for _ in range(400)]
    rows = [(i, t, "f", 1, "o") for i, t in enumerate(texts)] + [(None, "null id", "f", 1, "o"), (12, texts[12], "f", 1, "o")]
    cut = fill_middle.fill_in_middle(spark.createDataFrame(rows, SCHEMA))
    got = cut.withColumn("back", fill_middle.restored(F.col("output"), F.col("form"))).collect()
    assert len(got) == len(rows)
    by = {r[0]: r[1] for r in rows}
    for r in got:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == plain(r.doc_id, by[r.doc_id])
        assert r.back == (by[r.doc_id] or "")
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_empty_table_and_other_marks(spark):
    assert fill_middle.digests(fill_middle.fill_in_middle(spark.createDataFrame([], SCHEMA))).collect() == []
    marks = ("[a+]", "|b|", "(c")
    frame = spark.createDataFrame([(i, f"text <P> number {i} é") for i in range(30)], "doc_id long, text string")
    cut = fill_middle.fill_in_middle(frame, plain_percent=0, spm_percent=50, marks=marks)
    for r in cut.withColumn("back", fill_middle.restored(F.col("output"), F.col("form"), marks)).collect():
        assert r.back == f"text <P> number {r.doc_id} é" and r.form != "plain"
