"""The pipeline's stages on odd tables and as a whole against plain Python."""

from __future__ import annotations

from collections import Counter

import pytest

import corpus_pipeline as cp

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, kept boolean, h string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, None, "r", True, "h") for i, t, s in rows], SCHEMA)


LONG = " ".join(f"word{i}" for i in range(400))
ROWS = [(1, "same text here", "a"), (2, "SAME text here", "a"), (2, "SAME text here", "a"), (None, "only null ids", "b"), (None, "only null ids", None),
        (None, "", "b"), (3, None, "b"), (4, LONG, "c"), (5, LONG + " end", None), (None, "another one with a null id", "c"), (7, "quite another text it is", "c")]


def test_exact_stage_keeps_one_row_of_equal_texts(spark):
    got = cp.drop_copies(spark, frame(spark, ROWS), "").collect()
    assert Counter((r.text or "").lower() for r in got) == {t: 1 for t in {(t or "").lower() for _, t, _ in ROWS}}
    by = {(r.text or "").lower(): r for r in got}
    assert by["same text here"].doc_id == 2 and by[""].doc_id == 3 and by["only null ids"].doc_id is None
    assert got[0].__fields__ == [f.split()[0] for f in SCHEMA.split(", ")] and {r.h for r in got} == {"h"}


def test_near_stage_keeps_one_row_of_each_group(spark):
    got = cp.drop_near_copies(spark, frame(spark, ROWS), "").collect()
    assert sorted(str(r.doc_id) for r in got) == ["1", "3", "4", "7", "None", "None"]
    assert {r.text for r in got if r.doc_id is None} == {"only null ids", "another one with a null id"}
    assert [r.doc_id for r in got if r.text and r.text.startswith("word0")] == [4]


def test_mix_and_pack_stages(spark):
    mixed = cp.mix_sources(spark, frame(spark, ROWS), "")
    assert mixed.columns == [f.split()[0] for f in SCHEMA.split(", ")]
    n = Counter(r.text for r in mixed.collect())
    assert n[None] == n[""] == 0 and max(n.values()) <= 2 * 3
    rows = cp.pack_windows(spark, frame(spark, ROWS), "").collect()
    assert sum(r.start == 0 for r in rows) == len(ROWS) and all(r.offset + r.length <= 4096 for r in rows)


@pytest.mark.parametrize("stage", [s for _, s in cp.STAGES])
def test_stages_take_empty_tables(spark, tmp_path, stage):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert stage(spark, frame(spark, []), str(tmp_path)).collect() == []


def test_a_whole_run_adds_up(spark, tmp_path):
    """What each stage leaves, from its own input; texts lost or doubled would show in the pieces."""
    sf = "/root/testdata/sf0.001"
    left, docs = [], spark.read.parquet(f"{sf}/documents.parquet")
    for i, (_, stage) in enumerate(cp.STAGES):
        stage(spark, docs, sf).write.parquet(str(tmp_path / f"s{i}"))
        docs = spark.read.parquet(str(tmp_path / f"s{i}"))
        left.append(docs.collect())
    good, unique, near, mixed, pieces = left
    lower = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    best = {}
    for r in good:
        best[lower(r.text)] = max(best.get(lower(r.text), -1), r.doc_id)
    assert sorted(r.doc_id for r in unique) == sorted(best.values())
    assert {r.doc_id for r in near} <= {r.doc_id for r in unique} and len(near) == len({r.doc_id for r in near})
    taken = Counter(r.doc_id for r in mixed)
    assert set(taken) <= {r.doc_id for r in near} and max(taken.values()) <= 2
    assert Counter(r.doc_id for r in pieces if r.start == 0) == taken
    whole = Counter()
    for r in pieces:
        whole[r.doc_id] += r.length
    assert all(whole[r.doc_id] == r.doc_tokens * taken[r.doc_id] for r in pieces)
    assert sum(whole.values()) == sum(r.length for r in cp.run(spark, sf).collect())
