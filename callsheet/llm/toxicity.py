"""Toxicity by two class-conditional Kneser-Ney models over the bytes of UTF-8.

Each class has its own 5- and 4-gram counts; both share the pooled 3-, 2- and 1-gram
continuation counts, so an expression rare in both scores alike in both. The models
meet as one table of log-likelihood ratios per 5-gram. A document is compared by its
length-normalised log-likelihoods, as a whole and in its most toxic passage.

Counts are gathered from all labelled documents to learn from. Symbols are all 256 bytes,
so scripts, digits and marks differ; A-Z count as a-z, line breaks as blanks. Tables hold the grams seen, their
number grows with the corpus."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import blobs, fold, labelled, logistic, slabs, spaced

#: Symbols: every byte is its own, but A-Z are a-z and line breaks and tabs are blanks.
SYMBOLS = 256
SYMBOL = np.arange(256)
SYMBOL[ord("A"):ord("Z") + 1] += 32
SYMBOL[9:14] = 32
ORDER = 5
#: Bytes of a passage; also the blanks between texts, so that passages stay in one.
PASSAGE = 32
#: Log-likelihood ratios are kept in steps of 1/16 in one byte; this one means "not seen".
STEP, UNSEEN = 16, -128


def grams(data: np.ndarray) -> np.ndarray:
    """Number of the 5-gram that ends at each position from the fifth on."""
    s = SYMBOL[data]
    out = s[:len(s) - ORDER + 1].astype(np.int64)
    for k in range(1, ORDER):
        out *= SYMBOLS
        out += s[k:len(s) - ORDER + 1 + k]
    return out


def _positions(starts: np.ndarray, ends: np.ndarray, total: int) -> np.ndarray:
    """True at each gram that ends inside a text."""
    mark = np.zeros(total + 1, dtype=np.int8)
    np.add.at(mark, starts, 1)
    np.add.at(mark, ends, -1)
    return np.cumsum(mark[:-1], dtype=np.int8)[ORDER - 1:].astype(bool)


@dataclass
class Table:
    """Values by gram, for the grams seen (sorted); any other has ``default``."""
    keys: np.ndarray
    values: np.ndarray
    default: float

    def __getitem__(self, g: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(g), self.default, self.values.dtype)
        at = np.minimum(np.searchsorted(self.keys, g), len(self.keys) - 1)
        return np.where(self.keys[at] == g, self.values[at], self.values.dtype.type(self.default))


def _sums(keys: np.ndarray, weights: np.ndarray | None = None) -> Table:
    """How often each key occurs, or the sum of its weights."""
    kinds, at = np.unique(keys, return_inverse=True)
    return Table(kinds, np.bincount(at, weights=weights, minlength=len(kinds)).astype(float), 0.0)


@dataclass
class Models:
    """``ratio`` by 5-gram, then ``ratio4`` by 4-gram plus ``step4``/``step3`` by context."""
    ratio: Table
    ratio4: Table
    step4: Table
    step3: Table

    def ratios(self, g: np.ndarray) -> np.ndarray:
        """log P(toxic) - log P(ordinary) of each gram's last byte, in 1/16."""
        out = self.ratio[g].astype(np.int32)
        new = np.flatnonzero(out == UNSEEN)
        if len(new):
            k = g[new]
            low = self.ratio4[k % SYMBOLS ** 4].astype(np.int32)
            deeper = low == UNSEEN
            low[deeper] = self.step3[k[deeper] // SYMBOLS % SYMBOLS ** 3]
            out[new] = low + self.step4[k // SYMBOLS]
        return out

    def compare(self, parts: list[bytes]) -> np.ndarray:
        """Per text: mean ratio per character, highest mean of a passage."""
        out = np.zeros((len(parts), 2))
        for first, last in slabs(parts, 2 << 20):
            data, starts, ends = spaced(parts[first:last], PASSAGE)
            lead = ORDER - 1
            value = np.zeros(len(data), dtype=np.int32)
            inside = _positions(starts, ends, len(data))
            value[lead:] = np.where(inside, self.ratios(grams(data)), 0)
            total = np.concatenate([[0], np.cumsum(value, dtype=np.int64)])
            out[first:last, 0] = (total[ends] - total[starts]) / np.maximum(ends - starts, 1) / STEP
            # A passage ends at each position of its text.
            passage = total[PASSAGE:] - total[:-PASSAGE]
            at = np.maximum.reduceat(np.concatenate([passage, [0]]), np.column_stack([starts - PASSAGE + 1, ends - PASSAGE + 1]).ravel())[::2]
            out[first:last, 1] = np.where(ends > starts, at, 0) / PASSAGE / STEP
        return out


def _packed(x: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(x * STEP), -127, 127).astype(np.int8)


def _discount(counts: np.ndarray) -> float:
    """Kneser-Ney discount n1 / (n1 + 2 n2)."""
    n1, n2 = float((counts == 1).sum()), float((counts == 2).sum())
    return n1 / (n1 + 2 * n2) if n1 and n2 else 0.75


def build(keys: np.ndarray, counts: np.ndarray) -> Models:
    """Models from 5-grams and their counts in (toxic, ordinary) documents."""
    s, four, three = SYMBOLS, SYMBOLS ** 4, SYMBOLS ** 3
    keys, counts = keys[counts.sum(axis=1) > 0], counts[counts.sum(axis=1) > 0]
    kinds4 = np.unique(keys % four)
    # Shared continuation counts: how many bytes precede a 3-gram, and below.
    seen3 = _sums(kinds4 % three)
    base = np.full(s, 1 / s)
    for order in (1, 2):
        table = np.bincount(seen3.keys % s ** order, minlength=s ** order).astype(float).reshape(-1, s)
        total, kinds = table.sum(axis=1, keepdims=True), (table > 0).sum(axis=1, keepdims=True)
        lower = base.reshape(1, s) if order == 1 else base.reshape(1, s).repeat(s, axis=0)
        base = np.where(total > 0, (np.maximum(table - 0.75, 0) + 0.75 * kinds * lower) / np.maximum(total, 1), lower).ravel()

    def below(cont: Table, d: float, lower, grams: np.ndarray, share: Table) -> np.ndarray:
        """Discounted share of each gram after its context, and what is left by the order below."""
        total = _sums(cont.keys // s, cont.values)[grams // s]
        return np.where(total > 0, np.maximum(cont[grams] - d, 0) / np.maximum(total, 1), 0) + share[grams // s] * lower

    def shares(cont: Table, d: float) -> Table:
        """What each context leaves to the order below; all in a context not seen."""
        total, kinds = _sums(cont.keys // s, cont.values), _sums(cont.keys // s)
        return Table(total.keys, d * kinds.values / np.maximum(total.values, 1), 1.0)

    grams3 = np.unique(kinds4 % three)
    p3 = Table(grams3, below(seen3, 0.75, base[grams3 % s ** 2], grams3, shares(seen3, 0.75)), 0.0)
    contexts4, contexts3 = np.unique(keys // s), np.unique(kinds4 // s)
    logs, step4, p4s, step3 = [], [], [], []
    for c in range(2):
        own = counts[:, c] > 0
        cont = _sums(keys[own] % four)
        share = shares(cont, _discount(cont.values))
        p4 = Table(kinds4, below(cont, _discount(cont.values), p3[kinds4 % three], kinds4, share), 0.0)
        full = Table(keys[own], counts[own, c].astype(float), 0.0)
        d5 = _discount(counts[:, c])
        share5 = shares(full, d5)
        logs.append(np.log(np.maximum(below(full, d5, p4[keys % four], keys, share5), 1e-12)))
        p4s.append(np.log(np.maximum(p4.values, 1e-12)))
        step4.append(np.log(np.maximum(share5[contexts4], 1e-6)))
        step3.append(np.log(np.maximum(share[contexts3], 1e-6)))
    return Models(Table(keys, _packed(logs[0] - logs[1]), UNSEEN), Table(kinds4, _packed(p4s[0] - p4s[1]), UNSEEN),
                  Table(contexts4, _packed(step4[0] - step4[1]), 0), Table(contexts3, _packed(step3[0] - step3[1]), 0))


def _count(batches):
    """Partial counts per task: 5-gram and how often in each (half, class)."""
    keys, sums = np.zeros(0, np.int64), np.zeros((0, 4), np.int64)
    for b in batches:
        cell = 2 * b.column("half").to_numpy(zero_copy_only=False) + (1 - b.column("label").to_numpy(zero_copy_only=False))
        texts = blobs(b.column("text"))
        for c in range(4):
            own = [t for t, k in zip(texts, cell) if k == c]
            for first, last in slabs(own):
                data, starts, ends = spaced(own[first:last], ORDER - 1)
                new, n = np.unique(grams(data)[_positions(starts, ends, len(data))], return_counts=True)
                at = np.searchsorted(keys, new)
                old = (at < len(keys)) & (keys[np.minimum(at, max(len(keys) - 1, 0))] == new) if len(keys) else np.zeros(len(new), bool)
                sums[at[old], c] += n[old]
                if not old.all():
                    grown = np.zeros((int((~old).sum()), 4), np.int64)
                    grown[:, c] = n[~old]
                    keys, sums = np.concatenate([keys, new[~old]]), np.concatenate([sums, grown])
                    order = np.argsort(keys, kind="stable")
                    keys, sums = keys[order], sums[order]
    for i in range(0, len(keys), 1 << 16):
        yield pa.RecordBatch.from_arrays([pa.array(keys[i:i + (1 << 16)]), *[pa.array(sums[i:i + (1 << 16), c]) for c in range(4)]],
                                         names=["gram", "c0", "c1", "c2", "c3"])


@dataclass
class Scorer:
    models: Models
    weights: np.ndarray

    def scores(self, parts: list[bytes]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(_design(self.models.compare(parts)) @ self.weights, -30, 30)))


def _design(x: np.ndarray) -> np.ndarray:
    return np.column_stack([np.ones(len(x)), 10 * x[:, 0], 10 * x[:, 1]])


def learn(docs: DataFrame, labels: DataFrame, sample: int = 8000) -> Scorer:
    """Count n-grams of all documents to learn from. The weights of the two comparisons come
    from at most ``sample`` documents of one half, scored by models of the other half."""
    rows = labelled(docs, labels, "toxic", fold(F.col("doc_id"), 4) != 2)
    rows = rows.select("doc_id", "text", F.col("label").cast("int").alias("label"), F.pmod(F.xxhash64("doc_id"), F.lit(2)).cast("int").alias("half")).filter("label in (0, 1)")
    table = (rows.mapInArrow(_count, "gram long, c0 long, c1 long, c2 long, c3 long").groupBy("gram")
             .agg(*[F.sum(f"c{i}").alias(f"c{i}") for i in range(4)]).toArrow())  # a row per gram seen
    keys = table.column("gram").to_numpy().astype(np.int64)
    order = np.argsort(keys)
    counts = np.column_stack([table.column(f"c{i}").to_numpy() for i in range(4)])[order] if len(keys) else np.zeros((0, 4), np.int64)
    keys = keys[order]
    first = build(keys, counts[:, :2])

    def run(batches):
        for b in batches:
            x = first.compare(blobs(b.column("text")))
            yield pa.RecordBatch.from_arrays([pa.array(x[:, 0]), pa.array(x[:, 1]), b.column("label")], names=["whole", "passage", "label"])

    marks = (labels.filter("toxic in (0, 1)").filter(fold(F.col("doc_id"), 4) != 2).filter(F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 1)
             .orderBy(F.xxhash64("doc_id", F.lit(1)), "doc_id").limit(sample))
    tried = labelled(docs, marks, "toxic", F.lit(True), few=True).select("text", "label").mapInArrow(run, "whole double, passage double, label int").toPandas()
    tried = tried.sort_values(["label", "whole", "passage"])
    y = tried["label"].to_numpy(dtype=float)
    if y.sum() == 0 or y.sum() == len(y):
        weights = np.array([-4.0, 1.0, 1.0])
    else:
        weights = logistic(_design(tried[["whole", "passage"]].to_numpy()), y, 0.05)
    return Scorer(build(keys, counts[:, :2] + counts[:, 2:]), weights)


def score_toxicity(docs: DataFrame, labels: DataFrame, sample: int = 8000) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, held_out, score, predicted``.

    ``docs`` has ``doc_id`` and ``text``, ``labels`` has ``doc_id`` and ``toxic``; nothing else
    is read. Null and empty texts compare as equal in both models. A null id is not held
    out. Rows repeated with one id are scored each. Null labels are not learned; of several
    labels of one document the larger counts. Without labels of both kinds the weights are
    fixed ones. An empty table gives an empty result."""
    scorer = learn(docs, labels, sample)
    shipped = docs.sparkSession.sparkContext.broadcast(scorer)  # some ten bytes per gram seen

    def run(batches):
        for b in batches:
            score = shipped.value.scores(blobs(b.column("text")))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(score),
                                              pa.array((score >= 0.3).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    rows = docs.select("doc_id", F.coalesce(fold(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out"), "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int")
