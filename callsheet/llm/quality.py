"""Document quality by Bradley-Terry pairwise ranking.

Preference pairs (a good document over a poor one) are learned by the logistic loss on
feature differences; a document's strength is the weighted sum of its features. The
threshold is a quantile of the strengths. Features describe form only: shares of byte
classes, words and lines, and how often words repeat close by."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .common import blobs, fold, labelled, logistic, slabs, spaced

#: Byte classes: lower, upper, digit, blank, line break, sentence marks, other ASCII, beyond ASCII.
CLASSES = np.full(256, 6, dtype=np.uint8)
CLASSES[ord("a"):ord("z") + 1] = 0
CLASSES[ord("A"):ord("Z") + 1] = 1
CLASSES[ord("0"):ord("9") + 1] = 2
CLASSES[[9, 11, 12, 13, 32]] = 3
CLASSES[10] = 4
CLASSES[[ord(c) for c in ".,;:'\"-()?"]] = 5
CLASSES[128:] = 7
NAMES = 8
LAGS = (1, 2, 3, 4)
#: Bytes of text read at a time: arrays of eight bytes a character are made of each slab.
SLAB = 1 << 20
WIDTH = 2 * (NAMES + len(LAGS) + 4)


def _word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit value of each word's bytes."""
    power = np.cumprod(np.full(len(data) + 1, 0x9E3779B97F4A7C15, dtype=np.uint64))
    back = np.cumprod(np.full(len(data) + 1, pow(0x9E3779B97F4A7C15, -1, 1 << 64), dtype=np.uint64))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:-1], dtype=np.uint64)])
    return (total[ends] - total[starts]) * back[starts]


def features(parts: list[bytes]) -> np.ndarray:
    """One row per text: shares and their roots, all between 0 and 1; zeros without words."""
    out = np.zeros((len(parts), WIDTH))
    for first, last in slabs(parts, SLAB):
        data, starts, ends = spaced(parts[first:last])
        n, size = last - first, ends - starts
        kinds = CLASSES[data]
        doc = np.repeat(np.arange(n), size)
        inside = np.ones(len(data), dtype=bool)
        inside[0] = False
        inside[ends] = False
        share = np.bincount(doc * NAMES + kinds[inside], minlength=n * NAMES).reshape(n, NAMES) / np.maximum(size, 1)[:, None]
        word = (kinds != 3) & (kinds != 4)
        edge = np.flatnonzero(np.diff(word.astype(np.int8), prepend=0, append=0))
        lo, hi = edge[0::2], edge[1::2]
        of = np.searchsorted(starts, lo, side="right") - 1
        words = np.bincount(of, minlength=n)
        per = np.maximum(words, 1)
        h = _word_hashes(data, lo, hi)
        near, any_near = [], np.zeros(len(lo), dtype=bool)
        for lag in LAGS:
            same = np.zeros(len(lo), dtype=bool)
            same[lag:] = (h[lag:] == h[:-lag]) & (of[lag:] == of[:-lag])
            any_near |= same
            near.append(np.bincount(of[same], minlength=n) / per)
        edged = (kinds[hi - 1] == 6) if len(hi) else np.zeros(0, bool)
        bare = (kinds[lo] == 6) & (hi - lo == 1) if len(lo) else np.zeros(0, bool)
        rest = [np.bincount(of[any_near], minlength=n) / per, np.bincount(of[edged], minlength=n) / per,
                np.bincount(of[bare], minlength=n) / per, np.minimum(size / per / 40, 1)]
        x = np.column_stack([share, *near, *rest])
        out[first:last] = np.hstack([x, np.sqrt(x)])
        out[first:last][words == 0] = 0
    return out


def strengths(z: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Weighted sums, row by row, so that equal rows have equal sums wherever they stand; a
    matrix product adds in an order that depends on the place."""
    return (np.ascontiguousarray(z) * weights).sum(axis=1)


@dataclass
class Ranker:
    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    threshold: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        """0 to 1, one half at the threshold. Each distinct strength is looked up once: the last
        bit of an exponential may depend on its place in the array."""
        raw, at = np.unique(strengths((x - self.mean) / self.spread, self.weights) - self.threshold, return_inverse=True)
        return (1 / (1 + np.exp(-np.clip(raw, -30, 30))))[at]


def fit(x: np.ndarray, good: np.ndarray, pairs: int = 8, ridge: float = 1.0, seed: int = 1) -> Ranker:
    """Learn from ``pairs`` random opponents per document. The threshold is the quantile of
    the strengths at the share of poor documents, half-way to the next strength.
    Without documents of both kinds every score is one half or above."""
    mean, spread = (x.mean(axis=0), x.std(axis=0) + 1e-3) if len(x) else (np.zeros(WIDTH), np.ones(WIDTH))
    z = (x - mean) / spread
    win, lose = z[good], z[~good]
    if not len(win) or not len(lose):
        return Ranker(mean, spread, np.zeros(WIDTH), 0.0)
    rng = np.random.default_rng(seed)
    a = np.concatenate([np.repeat(np.arange(len(win)), pairs), rng.integers(len(win), size=pairs * len(lose))])
    b = np.concatenate([rng.integers(len(lose), size=pairs * len(win)), np.repeat(np.arange(len(lose)), pairs)])
    diff = win[a] - lose[b]
    weights = logistic(diff, np.ones(len(diff)), ridge)
    strength = np.sort(strengths(z, weights))
    k = len(lose)  # as many fall below as there are poor ones
    threshold = (strength[k - 1] + strength[min(k, len(strength) - 1)]) / 2
    return Ranker(mean, spread, weights, float(threshold))


def training_rows(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """Labelled rows to learn from: all, or the ``sample`` first by hash of the id."""
    rows = labelled(docs, labels.orderBy(F.xxhash64("doc_id"), "doc_id", "quality").filter("quality is not null")
                    .filter(fold(F.col("doc_id"), 3) != 1).limit(sample), "quality", F.lit(True), few=True)
    return rows.select("text", "label")


def learn(docs: DataFrame, labels: DataFrame, sample: int = 10_000) -> Ranker:
    """Fit on at most ``sample`` labelled documents whose id is not held out."""
    def run(batches):
        for b in batches:
            x = features(blobs(b.column("text")))
            yield pa.RecordBatch.from_arrays([pa.array(list(x), pa.list_(pa.float64())), b.column("label")], names=["x", "label"])

    rows = training_rows(docs, labels, sample).mapInArrow(run, "x array<double>, label int").toPandas()
    rows = rows.sort_values("label", kind="stable") if len(rows) else rows
    x = np.array(rows["x"].tolist(), dtype=float).reshape(-1, WIDTH)
    y = rows["label"].to_numpy(dtype=int)
    order = np.lexsort([*x.T, y])  # the fit must not depend on the order of tasks
    return fit(x[order], y[order] == 1)


def score_quality(docs: DataFrame, labels: DataFrame, sample: int = 10_000, model: Ranker | None = None, row: Column | None = None) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, held_out, score, predicted``.

    ``row`` adds a column of that name to carry along. ``docs`` has ``doc_id`` and ``text``,
    ``labels`` has ``doc_id`` and ``quality``; nothing else is read. Null and empty texts
    have all-zero features and a score like any other. A null id is not held out. Rows
    repeated with one id are scored each. Null labels are not learned; of several labels of
    one document the larger counts. With no label of one kind every score is 0.5. An empty
    table gives an empty result."""
    model = model or learn(docs, labels, sample)
    carried = ["row"] if row is not None else []

    def run(batches):
        for b in batches:
            score = model.scores(features(blobs(b.column("text"))))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(score), pa.array((score >= 0.5).astype(np.int32)),
                                              *[b.column(c) for c in carried]], names=["doc_id", "held_out", "score", "predicted", *carried])

    rows = docs.select("doc_id", F.coalesce(fold(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out"), "text", *([row.alias("row")] if carried else []))
    schema = (T.StructType().add(rows.schema["doc_id"]).add("held_out", "boolean").add("score", "double").add("predicted", "integer"))
    return rows.mapInArrow(run, schema.add(rows.schema["row"]) if carried else schema)
