"""Each operator on small tables: nulls, empty and long texts, ties, repeated rows, extra
columns, and against brute force or the tokenizer library."""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from callsheet.llm import components, exact_dedup, langid, mixing, neighbours, packing, quality, repeats, simhash, token_counts, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, row string, kept boolean"
LONG = "wort " * 30_000
TEXTS = [None, "", "  \n", "Ab c", "aB C", "aB C", "éÀ ü", "x", LONG, "The end. The end. The end.", "<|endoftext|> it's 12", "漢字 naïve ǅ"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, None if i % 4 == 0 else "en", None if i % 5 == 0 else f"s{i % 3}", "r", True) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame([*rows, (None, "null id", "en", "s1", None, None), rows[4]], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, i % 3 // 2) for i in range(12)] + [(3, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_all_take_empty_tables(spark, labels):
    none = labels.limit(0)
    d = empty(spark)
    for frame in (quality.score_quality(d, none), token_counts.token_counts(d, public_tokenizers.path("byte_bpe_50k.json")),
                  packing.pack(d, public_tokenizers.path("word_bpe_49k.json")), repeats.cut_repeats(d), langid.identify(d), exact_dedup.exact_dedup(d),
                  toxicity.score_toxicity(d, none), mixing.mix(d), simhash.near_duplicates(d),
                  neighbours.nearest(spark.createDataFrame([], "vec_id long, embedding array<float>"))):
        assert frame.collect() == []


def test_exact_dedup_and_collisions(docs):
    got = exact_dedup.exact_dedup(docs).collect()
    # A hash that knows three values only: texts still decide.
    weak = exact_dedup.exact_dedup(docs, hash_of=lambda c: (F.length(c) % 3).cast("string")).collect()
    assert sorted(map(str, got)) == sorted(map(str, weak))
    by = {r.doc_id: r for r in got}
    assert by[0].keep_id == by[1].keep_id == 1 and by[1].kept and not by[0].kept and by[0].group_size == 2
    assert by[3].keep_id == 5 and by[3].group_size == 4 and by[None].kept
    assert by[6].text_sha256 == hashlib.sha256("éÀ ü".encode()).hexdigest()  # only A-Z are lower-cased


def test_token_counts_match_the_library(docs):
    path = public_tokenizers.path("byte_bpe_50k.json")
    lib = Tokenizer.from_file(path)
    for r in token_counts.token_counts(docs, path).join(docs.select("doc_id", "text").distinct(), "doc_id").collect():
        assert r.n_tokens == len(lib.encode(r.text or "", add_special_tokens=False).ids)
        assert r.n_bytes == len((r.text or "").encode()) and r.over_limit == (r.n_tokens > 512)


def test_splitter_does_not_depend_on_chunks():
    split = token_counts.Splitter()
    line = "it's  we'll \n\n 'tis don't!! 'r 12ab " * 40
    kinds = split.kinds[[ord(c) for c in line]]
    whole = split.starts(kinds, chunk=len(line))
    for chunk in (1, 2, 7, 64):
        assert split.starts(kinds, chunk).tolist() == whole.tolist()


def test_packing_is_whole_and_within_capacity(docs):
    path = public_tokenizers.path("word_bpe_49k.json")
    lib = Tokenizer.from_file(path)
    rows = packing.pack(docs, path, batch=2).collect()
    used = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == used.get(r.sequence_id, 0) and len(r.ids) == 4 * r.length
        used[r.sequence_id] = r.offset + r.length
    assert max(used.values()) <= 4096
    for i, t in enumerate(TEXTS):
        if i == 4:  # repeated whole
            continue
        pieces = sorted((r for r in rows if r.doc_id == i), key=lambda r: r.start)
        ids = np.frombuffer(b"".join(r.ids for r in pieces), "<u4").tolist()
        assert ids == [*lib.encode(t or "", add_special_tokens=False).ids, 2] and pieces[0].doc_tokens == len(ids)
    crc = {r.ids_crc32 for r in packing.digests(packing.pack(docs, path, batch=2)).collect()}
    assert crc == {zlib.crc32(r.ids) for r in rows}


def test_differencing_reaches_near_equal_windows():
    rng = np.random.default_rng(1)
    sizes = rng.integers(1, 1024, 900)
    window, k = packing.pack_sizes(sizes, 4096)
    sums = np.bincount(window, weights=sizes, minlength=k)
    assert sums.sum() == sizes.sum() and sums.max() <= 4096 and sizes.sum() / (4096 * k) > 0.97
    assert packing.pack_sizes(np.array([4096, 4096, 1]), 4096)[1] == 3


def brute_cut(texts: dict, width: int) -> dict:
    seen, out = set(), {}
    for d in sorted(texts):
        b, mask = texts[d], np.zeros(len(texts[d]), bool)
        for i in range(len(b) - width + 1):
            if b[i:i + width] in seen:
                mask[i:i + width] = True
            seen.add(b[i:i + width])
        out[d] = (int(mask.sum()), bytes(np.frombuffer(b, np.uint8)[~mask]))
    return out


@pytest.mark.parametrize("crowd", [2, 2048])
def test_repeats_against_brute_force(spark, monkeypatch, crowd):
    monkeypatch.setattr(repeats, "CROWD", crowd)
    rng = np.random.default_rng(2)
    words = ["ab", "cde", "f", "ghij", "é"]
    passage = " ".join(rng.choice(words, 60))
    texts = {}
    for d in range(40):
        body = " ".join(rng.choice(words, int(rng.integers(1, 80))))
        at = int(rng.integers(0, 40))
        texts[d] = body[:at] + (passage[int(rng.integers(0, 30)):] if d % 2 else "") + body[at:] + ("na" * 80 if d % 5 == 0 else "")
    frame = spark.createDataFrame([(d, t) for d, t in texts.items()] + [(99, None), (None, passage)], "doc_id long, text string")
    want = brute_cut({d: t.encode() for d, t in texts.items()}, 40)
    for r in repeats.cut_repeats(frame, width=40, core=12).collect():
        if r.doc_id in want:
            assert (r.n_removed, bytes(r.kept)) == want[r.doc_id]
        else:
            assert r.n_removed == 0


def test_suffix_order_is_sorted():
    rng = np.random.default_rng(3)
    for _ in range(200):
        s = rng.integers(1, 4, int(rng.integers(1, 70))).astype(np.int64)
        assert repeats._order(s, 1, 1000).tolist() == sorted(range(len(s)), key=lambda i: s[i:].tolist())


def test_simhash_components_against_brute_force(spark):
    rng = np.random.default_rng(4)
    base = rng.integers(0, 2**63, 30, dtype=np.uint64)
    fps = [int(b ^ np.uint64(sum(1 << int(k) for k in rng.choice(64, int(rng.integers(0, 5)), replace=False)))) for b in base for _ in range(8)]
    distinct = sorted({int(np.uint64(x).astype(np.int64)) for x in fps})
    frame = spark.createDataFrame([(x,) for x in distinct], "fp long")
    roots = {r.node: r.root for r in components.components(simhash.near_links(frame, 3)).collect()}
    x = np.array(distinct).astype(np.uint64)
    label = np.arange(len(x))
    near = np.bitwise_count(x[:, None] ^ x[None, :]) <= 3
    for _ in range(len(x)):
        label = np.where(near, label[None, :], len(x)).min(axis=1)
    for i, fp in enumerate(distinct):
        assert roots.get(fp, fp) == distinct[label[i]]


def test_threshold_plan_covers_the_distance():
    rng = np.random.default_rng(5)
    bits = (rng.random((500, 64)) < 0.5).astype(float)
    for n in (100, 10**6, 10**11):
        plan = simhash.allocate(n, bits.T @ bits / 500 * n, 3)
        assert sorted(b for g, _ in plan for b in g) == list(range(64))
        assert sum(t for _, t in plan) == 3 - len(plan) + 1


def test_near_duplicates_on_odd_texts(docs):
    by = {}
    for r in simhash.near_duplicates(docs).collect():
        by[r.doc_id] = r
    assert by[0].fingerprint == by[1].fingerprint == by[2].fingerprint == "0" * 16 and by[2].component_id == 0
    assert by[3].component_id == by[5].component_id == 3


def test_mix_meets_targets(spark, docs):
    rows = spark.createDataFrame([(i, "w " * (1 + i * i % 37), f"s{i % 4}" if i % 9 else None) for i in range(2000)], "doc_id long, text string, source string")
    got = mixing.mix(rows).toPandas()
    assert (got["taken"] % got["size"] == 0).all() and (got["taken"] <= 2 * got["size"]).all()
    got = got.merge(rows.select("doc_id", "source").toPandas(), on="doc_id")  # two sources may be of one size
    for _, g in got.groupby("source", dropna=False):
        assert abs(g["taken"].sum() - g["target"].iloc[0]) <= 1
    again = mixing.mix(rows).toPandas().set_index("doc_id")["taken"]
    assert (again.loc[got["doc_id"]].to_numpy() == got["taken"].to_numpy()).all()
    sources = got.drop_duplicates("source")
    assert abs(sources["target"].sum() - 1.5 * got["size"].sum()) < 1e-6
    assert mixing.mix(docs).filter("size = 0").agg(F.sum("taken")).first()[0] == 0
    assert mixing.mixed_rows(docs).columns == docs.columns


def taken_words(target, lengths, counts):
    lengths, counts = np.array(lengths), np.array(counts)
    copies, extra = mixing.fit_budget(target, lengths, counts)
    assert (extra >= 0).all() and (extra <= counts).all() and copies * counts.sum() + extra.sum() <= 2 * counts.sum()
    return int((lengths * (copies * counts + extra)).sum())


def test_mix_fits_beside_long_documents_and_from_above():
    assert taken_words(350_000, [200, 400_000], [3000, 1]) == 350_000
    assert taken_words(83, [100], [1]) == 100 and taken_words(167, [100], [1]) == 200 and taken_words(40, [100], [1]) == 0
    assert taken_words(120_000, [60_000, 100_000], [2, 1]) == 120_000
    # So many lengths that the knapsack does not hold all: filled down to its range.
    lengths = list(range(1001, 9001))
    assert taken_words(10_000_000.4, [*lengths, 90_000_000], [3] * len(lengths) + [1]) == 10_000_000


def test_mix_is_as_near_as_brute_force():
    rng = np.random.default_rng(8)
    for _ in range(200):
        lengths = rng.choice(np.arange(1, 60), rng.integers(1, 5), replace=False)
        counts = rng.integers(1, 4, len(lengths))
        size = int((lengths * counts).sum())
        target = float(rng.uniform(0, 2 * size))
        sums = {int(target // size) * size}
        for n, c in zip(lengths, counts):
            sums = {s + k * int(n) for s in sums for k in range(int(c) + 1)}
        assert abs(taken_words(target, lengths, counts) - target) <= min(abs(s - target) for s in sums) + 1e-9


def test_learned_scores(spark, docs, labels):
    for frame in (quality.score_quality(docs, labels), toxicity.score_toxicity(docs, labels)):
        rows = frame.collect()
        assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    lang = {r.doc_id: r for r in langid.identify(docs).collect()}
    assert lang[0].lang_pred == lang[1].lang_pred == lang[2].lang_pred == "und" and lang[3].lang_pred == "en"


@pytest.mark.parametrize("clean,toxic", [("слово дом река", "дурак гад урод"), ("今日 天気 山川", "馬鹿 阿呆 屑物"), ("5h4t f+ck a--s", "5h1t f*ck a$$s")])
def test_toxicity_in_other_scripts_and_spellings(spark, clean, toxic):
    rng = np.random.default_rng(3)
    # Same word lengths in both kinds; the words differ in letters, digits or marks only.
    pairs = list(zip(clean.split(), toxic.split()))
    rows = [(i, " ".join(pairs[k][i % 2] for k in rng.integers(0, 3, 12))) for i in range(400)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    lab = spark.createDataFrame([(i, i % 2) for i in range(400)], "doc_id long, toxic int")
    got = toxicity.score_toxicity(d, lab).filter("held_out").toPandas()
    assert (got["predicted"] == got["doc_id"] % 2).mean() > 0.95


def test_held_out_accuracy_on_the_given_tables(spark):
    sf = "/root/testdata/sf0.01"
    d, lab = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    q = quality.score_quality(d, lab).filter("held_out").join(lab, "doc_id").toPandas()
    assert (q["predicted"] == q["quality"]).mean() > 0.95
    t = toxicity.score_toxicity(d, lab).filter("held_out").join(lab, "doc_id").toPandas()
    assert (t["predicted"] == t["toxic"]).mean() > 0.93
    g = langid.identify(d).filter("held_out").join(d.select("doc_id", "lang"), "doc_id").toPandas()
    assert (g["lang_pred"] == g["lang"]).mean() > 0.95


def test_neighbours_recall_and_odd_vectors(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(1500, 16)) * rng.uniform(0.5, 2, (1500, 1))
    x[100:130] = x[100]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(5000, None), (5020, [0.0] * 16), (5040, [float("nan")] * 16), (5060, [1.0, 2.0]), (5080, [None] * 16)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = neighbours.nearest(frame, rounds=3).toPandas()
    hits, total = 0, 0
    for q in range(0, 1500, 20):
        s = x @ x[q]
        s[q] = -np.inf
        want = np.lexsort((np.arange(1500), -s))[:20]
        mine = got[got["query_id"] == q].sort_values("rank")
        assert len(mine) == 20 and np.allclose(mine["score"], s[mine["vec_id"]])
        hits, total = hits + len(set(want) & set(mine["vec_id"])), total + 20
    assert hits / total > 0.9 and got["query_id"].max() < 5000
    few = neighbours.nearest(frame.filter("vec_id < 3")).toPandas()
    assert len(few) == 2


def neighbour_recall(spark, x):
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = neighbours.nearest(frame).groupBy("query_id").agg(F.collect_set("vec_id").alias("ids")).toPandas()
    hits = 0
    for q, ids in zip(got["query_id"], got["ids"]):
        s = x @ x[q]
        s[q] = -np.inf
        hits += len(set(np.argsort(-s)[:20]) & set(ids))
    return hits / (20 * len(range(0, len(x), 20)))


@pytest.mark.parametrize("lengths", ["one", "spread"])
def test_neighbours_recall_with_unequal_lengths(spark, lengths):
    rng = np.random.default_rng(16)
    x = rng.normal(size=(2000, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    if lengths == "one":
        x[777] *= 1000
    else:  # four orders of magnitude
        x *= 10 ** rng.uniform(-2, 2, (2000, 1))
    assert neighbour_recall(spark, x) > 0.9


def test_pipeline_runs_and_keeps_columns(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    d = spark.read.parquet(f"{sf}/documents.parquet")
    docs = d
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf)
        assert docs.columns == d.columns, name
    kept = corpus_pipeline.drop_copies(spark, d, sf)
    assert kept.select(F.lower("text")).distinct().count() == kept.count() == d.select(F.lower("text")).distinct().count()
    assert corpus_pipeline.run(spark, sf).count() > 0


def test_suffix_order_makes_pairs_dense_only_where_they_would_not_fit(monkeypatch):
    from callsheet.llm import repeats

    rng = np.random.default_rng(11)
    t = np.concatenate([rng.integers(1, 50, 3_000), np.zeros(6, np.int64)])
    a, b = rng.integers(0, 3_000, 900), rng.integers(0, 3_000, 900)
    plain, dense = repeats._pairs(t, a, b, 50, 3_000), repeats._pairs(t, a, b, 50, 1 << 60)
    both = lambda x: np.concatenate(x)
    assert (np.unique(both(plain), return_inverse=True)[1] == both(dense)).all()
    s = rng.integers(1, 4, 4_000)
    expected = sorted(range(len(s)), key=lambda i: s[i:].tolist())

    def unneeded(*args, **kw):
        raise AssertionError("numbers were made dense")

    monkeypatch.setattr(repeats.np, "unique", unneeded)
    assert repeats._order(s, 1, len(s)).tolist() == expected
