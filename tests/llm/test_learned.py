"""Learned scores against plain versions: Kneser-Ney by dictionaries, Bradley-Terry by its gradient."""

from __future__ import annotations

import math
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

from callsheet.llm import quality, toxicity


def plain_kneser_ney(classes: list[list[bytes]]):
    """log P(last byte | four before) of each 5-gram in both classes, all orders written out."""
    fold = lambda t: bytes(c + 32 if 65 <= c <= 90 else 32 if 9 <= c <= 13 else c for c in t)
    five = [Counter(s[i:i + 5] for t in texts for s in [b" " * 4 + fold(t)] for i in range(len(s) - 4)) for texts in classes]
    keys = sorted(set(five[0]) | set(five[1]))
    four = {k[1:] for k in keys}
    three = Counter(g[1:] for g in four)
    one, two = Counter(g[2:] for g in three), Counter(g[1:] for g in three)

    def interpolated(counts: Counter, d: float, lower):
        total, kinds = defaultdict(float), Counter()
        for g, n in counts.items():
            total[g[:-1]] += n
            kinds[g[:-1]] += n > 0
        return lambda g: (max(counts[g] - d, 0) + d * kinds[g[:-1]] * lower(g)) / total[g[:-1]] if total[g[:-1]] else lower(g)

    def discount(counts):
        n1, n2 = sum(n == 1 for n in counts), sum(n == 2 for n in counts)
        return n1 / (n1 + 2 * n2) if n1 and n2 else 0.75

    p1 = interpolated(one, 0.75, lambda g: 1 / 256)
    p2 = interpolated(two, 0.75, lambda g: p1(g[1:]))
    p3 = interpolated(three, 0.75, lambda g: p2(g[1:]))
    logs = []
    for own in five:
        cont = Counter(k[1:] for k in own)
        p4 = interpolated(cont, discount(cont.values()), lambda g: p3(g[1:]))
        p5 = interpolated(own, discount(own.values()), lambda g: p4(g[1:]))
        logs.append({k: math.log(p5(k)) for k in keys})
    return keys, logs


def test_ratios_against_plain_kneser_ney():
    rng = np.random.default_rng(1)
    words = ["Gut", "böse", "the", "end", "x", "漢字", "you", "fool\n"]
    texts = [[" ".join(rng.choice(words[c:c + 6], int(rng.integers(1, 30)))).encode() for _ in range(40)] for c in (2, 0)]
    batch = pa.RecordBatch.from_arrays([pa.array([t.decode() for c in texts for t in c]), pa.array([1] * 40 + [0] * 40), pa.array([0] * 80)], names=["text", "label", "half"])
    table = pa.Table.from_batches(list(toxicity._count([batch])))
    models = toxicity.build(table["gram"].to_numpy(), np.column_stack([table["c0"].to_numpy(), table["c1"].to_numpy()]))
    keys, logs = plain_kneser_ney(texts)
    numbers = np.array([int.from_bytes(k, "big") for k in keys])
    assert sorted(numbers.tolist()) == sorted(table["gram"].to_pylist())
    want = np.clip([16 * (logs[0][k] - logs[1][k]) for k in keys], -127, 127)
    assert np.abs(models.ratios(numbers) - want).max() <= 0.51


def test_document_comparison_is_the_mean_of_its_ratios():
    texts = [[b"you fool you fool"] * 3, [b"the end is near", b"a good end"]]
    keys, logs = plain_kneser_ney(texts)
    counts = [Counter(), Counter()]
    for c, own in enumerate(texts):
        for t in own:
            s = b"    " + t
            counts[c].update(s[i:i + 5] for i in range(len(s) - 4))
    models = toxicity.build(np.array([int.from_bytes(k, "big") for k in keys]), np.array([[counts[0][k], counts[1][k]] for k in keys]))
    text = b"you fool"
    grams = [(b"    " + text)[i:i + 5] for i in range(len(text))]
    want = np.mean([np.rint(np.clip(16 * (logs[0][g] - logs[1][g]), -127, 127)) for g in grams]) / 16
    assert abs(models.compare([text])[0, 0] - want) < 1e-9
    assert models.compare([b""]).tolist() == [[0.0, 0.0]]
    assert models.compare([b"you fool" * 5000])[0, 0] > 0 > models.compare([b"the end is near " * 5000])[0, 0]


def test_bradley_terry_weights_are_at_the_minimum():
    """The loss over the drawn pairs, plain: its gradient vanishes and steps away cost."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(60, quality.WIDTH))
    good = x[:, 0] + 0.5 * rng.normal(size=60) > 0
    ranker = quality.fit(x, good, pairs=4, ridge=1.0, seed=7)
    z = (x - x.mean(0)) / (x.std(0) + 1e-3)
    win, lose, draw = z[good], z[~good], np.random.default_rng(7)
    a = np.concatenate([np.repeat(np.arange(len(win)), 4), draw.integers(len(win), size=4 * len(lose))])
    b = np.concatenate([draw.integers(len(lose), size=4 * len(win)), np.repeat(np.arange(len(lose)), 4)])
    pairs = [win[i] - lose[j] for i, j in zip(a, b)]
    loss = lambda w: sum(math.log1p(math.exp(-float(d @ w))) for d in pairs) + 0.5 * float(w @ w)
    gradient = sum(-d / (1 + math.exp(float(d @ ranker.weights))) for d in pairs) + ranker.weights
    assert np.abs(gradient).max() < 1e-4
    assert all(loss(ranker.weights) <= loss(ranker.weights + 0.05 * rng.normal(size=len(ranker.weights))) for _ in range(20))
    assert (ranker.scores(x) < 0.5).sum() == (~good).sum()


def test_equal_documents_have_equal_scores_and_one_kind_has_no_order():
    x = np.repeat(np.random.default_rng(3).normal(size=(5, quality.WIDTH)), 3, axis=0)
    ranker = quality.fit(x, np.arange(15) % 2 == 0)
    s = ranker.scores(x).reshape(5, 3)
    assert (s == s[:, :1]).all()
    assert (quality.fit(x, np.ones(15, bool)).scores(x) >= 0.5).all()


def test_memory_of_features_and_ids_does_not_follow_the_batch():
    import tracemalloc

    import public_tokenizers
    from callsheet.llm import packing
    from callsheet.llm.common import slabs

    words = np.random.default_rng(5).integers(97, 123, size=(40_000, 5), dtype=np.uint8)
    words[:, 4] = 32
    texts = [words[i:i + 400].tobytes() for i in range(0, 40_000, 400)] * 20  # 4 MB

    def peak(work):
        tracemalloc.start()
        try:
            work()
            return tracemalloc.get_traced_memory()[1]
        finally:
            tracemalloc.stop()

    assert peak(lambda: quality.features(texts)) < 120 << 20
    table = packing.TextIds(public_tokenizers.path("word_bpe_49k.json"))
    table.encode(texts[:5])
    first, last = next(slabs(texts, packing.SLAB))
    assert peak(lambda: table.encode(texts[first:last])) < 120 << 20
