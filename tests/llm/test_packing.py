"""Packing on extreme inputs: very many tiny texts, one very long word, many distinct words."""

from __future__ import annotations

import random
import time
import tracemalloc

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from callsheet.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def dense(sizes, k):
    """Plain differencing on lists of all k windows."""
    parts = [([s] + [0] * (k - 1), [[i]] + [[] for _ in range(k - 1)]) for i, s in enumerate(sizes)]
    while len(parts) > 1:
        parts.sort(key=lambda p: p[0][0] - p[0][-1])
        (a, x), (b, y) = parts.pop(), parts.pop()
        both = sorted(((s + t, u + v) for s, t, u, v in zip(a, b[::-1], x, y[::-1])), key=lambda p: -p[0])
        parts.append(([s for s, _ in both], [w for _, w in both]))
    return parts[0][0]


def test_sparse_partitions_equal_dense_ones_in_their_spread():
    rng = np.random.default_rng(1)
    for k in (2, 3, 7):
        for n in (1, 2, 5, 40):
            sizes = rng.integers(1, 10**6, n)  # hardly any ties
            window, sums = packing.difference(sizes, k)
            assert (np.sort(np.bincount(window, weights=sizes, minlength=k)) == np.sort(sums)).all()
            assert sorted(sums.tolist()) == sorted(dense(sizes.tolist(), k))


def test_memory_follows_the_pieces_not_pieces_times_windows():
    sizes = np.full(100_000, 5)
    tracemalloc.start()
    window, k = packing.pack_sizes(sizes, 4096)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200 << 20 and np.bincount(window, weights=sizes).max() <= 4096 and k <= 124


def test_small_neighbours_go_together():
    bundle = packing.bundles(np.array([1, 1, 62, 1, 500, 3, 64, 2, 2]), 64)
    assert bundle.tolist() == [0, 0, 0, 1, 2, 3, 4, 5, 5]


def test_a_million_empty_texts_in_one_task(spark):
    docs = spark.range(1_200_000).coalesce(1).select(F.col("id").alias("doc_id"), F.lit(None).cast("string").alias("text"))
    got = packing.pack(docs, PATH).groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end"))
    row = got.agg(F.sum("n").alias("tokens"), F.max("end").alias("end"), F.count(F.lit(1)).alias("windows")).first()
    assert row.tokens == 1_200_000 and row.end <= 4096 and row.windows <= 320


def test_ids_equal_the_library_on_odd_words():
    rng, lib, table = random.Random(2), Tokenizer.from_file(PATH), packing.TextIds(PATH)
    parts = ["a", "B", "é", "É", "'", "s", "<", "|", "endoftext", "|>", " ", "\n", "1", "23", "½", "!", "ﬁ", "İ", "漢", "😀", "　", "_", "-", "x" * 20, "ß", "'ll", "ǅ", "\x85"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 60))) for _ in range(3000)] + ["", "abc1" * 20_000]
    for t, ids in zip(texts, table.encode([t.encode() for t in texts])):
        assert ids.tolist() == lib.encode(t, add_special_tokens=False).ids


def test_distinct_words_are_told_by_their_bytes():
    table = packing.TextIds(PATH)
    data = np.frombuffer(b"aa bb aa cc", np.uint8)
    first, which = table.distinct(data, np.array([0, 3, 6, 9]), np.array([2, 2, 2, 2]))
    assert which[0] == which[2] and len(set(which.tolist())) == 3 and len(first) == 3


def test_one_word_of_a_million_bytes():
    rng, table = random.Random(3), packing.TextIds(PATH)
    word = "".join(rng.choice("abcdefghijklmnopqrstuvwxyzABCXYZ0123456789+/") for _ in range(1_000_000))
    started = time.time()
    assert len(table.encode([word.encode()])[0]) > 1000
    assert time.time() - started < 10
