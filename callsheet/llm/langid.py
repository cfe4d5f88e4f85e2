"""Language identification by a bidirectional gated recurrent network over bytes.

Trained in numpy by backpropagation through time on a bounded sample. Texts are read in
windows of a fixed number of bytes, each with fresh states, so that all windows of a
batch step together; every position of a text gets label probabilities and a document
takes their mean."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window, functions as F

from callsheet.functions.stages import stored

from .common import blobs, fold, slabs

HIDDEN = 6
WINDOW = 96
#: Windows stepped together.
ROWS = 2048
LETTERS = regex.compile(r"\p{L}")


@dataclass
class Net:
    """Per direction: input table (256, 3H), gate weights (H, 2H), candidate weights (H, H);
    then the output weights (2H, L) and bias."""
    languages: list[str]
    directions: list[list[np.ndarray]]
    out: np.ndarray
    bias: np.ndarray

    def parameters(self) -> list[np.ndarray]:
        return [p for d in self.directions for p in d] + [self.out, self.bias]


def _gate(x: np.ndarray) -> np.ndarray:
    """Piecewise linear sigmoid."""
    return np.clip(0.25 * x + 0.5, 0, 1)


def _step(x: np.ndarray, h: np.ndarray, gates: np.ndarray, inner: np.ndarray):
    size = h.shape[1]
    zr = _gate(x[:, :2 * size] + h @ gates)
    z, r = zr[:, :size], zr[:, size:]
    n = np.tanh(x[:, 2 * size:] + (r * h) @ inner)
    return n + z * (h - n), z, r, n


def positions(net: Net, data: np.ndarray) -> np.ndarray:
    """Label probabilities (positions, labels, windows) of rows of bytes.

    The same steps as in training, with one row per unit so that each operation runs
    over all windows in a row, in place."""
    rows, width = data.shape
    columns = np.ascontiguousarray(data.T).astype(np.intp)
    size = net.out.shape[0] // 2
    logits = np.empty((width, len(net.bias), rows), np.float32)
    x, g, c = (np.empty((k * size, rows), np.float32) for k in (3, 2, 1))
    part = np.empty((len(net.bias), rows), np.float32)
    for d, order in enumerate((range(width), range(width - 1, -1, -1))):
        table, gates, inner = net.directions[d]
        # The gate's slope and offset go into its weights.
        table = np.ascontiguousarray(np.concatenate([0.25 * table[:, :2 * size] + 0.5, table[:, 2 * size:]], axis=1).T)
        gates, inner = np.ascontiguousarray(0.25 * gates.T), np.ascontiguousarray(inner.T)
        out = np.ascontiguousarray(net.out[d * size:(d + 1) * size].T)
        h = np.zeros((size, rows), np.float32)
        for t in order:
            np.take(table, columns[t], axis=1, out=x, mode="clip")
            np.matmul(gates, h, out=g)
            g += x[:2 * size]
            np.maximum(g, 0, out=g)
            np.minimum(g, 1, out=g)
            z, r = g[:size], g[size:]
            r *= h
            np.matmul(inner, r, out=c)
            c += x[2 * size:]
            np.tanh(c, out=c)
            h -= c
            h *= z
            h += c
            if d:
                np.matmul(out, h, out=part)
                logits[t] += part
            else:
                np.matmul(out, h, out=logits[t])
                logits[t] += net.bias[:, None]
    logits -= logits.max(axis=1, keepdims=True)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=1, keepdims=True)
    return logits


def gradients(net: Net, data: np.ndarray, label: np.ndarray, mask: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean loss per position and its gradient for each parameter."""
    rows, width = data.shape
    size, count = net.out.shape[0] // 2, max(float(mask.sum()), 1.0)
    states, traces = np.zeros((2, width, rows, size), np.float32), []
    orders = (list(range(width)), list(range(width - 1, -1, -1)))
    for d in range(2):
        table, gates, inner = net.directions[d]
        h, trace = np.zeros((rows, size), np.float32), []
        for t in orders[d]:
            new, z, r, n = _step(table[data[:, t]], h, gates, inner)
            trace.append((t, h, z, r, n))
            h = states[d, t] = new
        traces.append(trace)
    both = np.concatenate([states[0], states[1]], axis=2)
    logits = both @ net.out + net.bias
    logits -= logits.max(axis=2, keepdims=True)
    p = np.exp(logits)
    p /= p.sum(axis=2, keepdims=True)
    loss = -float((np.log(np.maximum(p[:, np.arange(rows), label], 1e-9)) * mask.T).sum()) / count
    p[:, np.arange(rows), label] -= 1
    p *= (mask.T / count)[:, :, None]
    d_out = np.einsum("trh,trl->hl", both, p)
    d_both = p @ net.out.T
    grads = []
    for d in range(2):
        _, gates, inner = net.directions[d]
        d_gates, d_inner = np.zeros_like(gates), np.zeros_like(inner)
        d_x = np.zeros((width, rows, 3 * size), np.float32)
        back = np.zeros((rows, size), np.float32)
        for t, h, z, r, n in reversed(traces[d]):
            dh = back + d_both[t, :, d * size:(d + 1) * size]
            dn = dh * (1 - z) * (1 - n * n)
            drh = dn @ inner.T
            dzr = np.concatenate([dh * (h - n), drh * h], axis=1)
            zr = np.concatenate([z, r], axis=1)
            dzr *= 0.25 * ((zr > 0) & (zr < 1))
            back = dh * z + drh * r + dzr @ gates.T
            d_gates += h.T @ dzr
            d_inner += (r * h).T @ dn
            d_x[t] = np.concatenate([dzr, dn], axis=1)
        flat = data.T.ravel()
        order = np.argsort(flat, kind="stable")
        seen, start = np.unique(flat[order], return_index=True)
        d_table = np.zeros((256, 3 * size), np.float32)
        d_table[seen] = np.add.reduceat(d_x.reshape(-1, 3 * size)[order], start, axis=0)
        grads += [d_table, d_gates, d_inner]
    return loss, [*grads, d_out, p.sum(axis=(0, 1))]


def train(texts: list[bytes], labels: list[str], steps: int = 300, rows: int = 192, seed: int = 3) -> Net | None:
    """Adam on windows drawn from the whole texts, languages alike often. None without texts."""
    languages = sorted(set(labels))
    if not languages:
        return None
    rng = np.random.default_rng(seed)
    own = [[t for t, lab in zip(texts, labels) if lab == lang and t] or [b" "] for lang in languages]
    weight = lambda *s: rng.normal(0, 1 / np.sqrt(s[0]), s).astype(np.float32)
    directions = [[rng.normal(0, 0.3, (256, 3 * HIDDEN)).astype(np.float32), weight(HIDDEN, 2 * HIDDEN), weight(HIDDEN, HIDDEN)] for _ in range(2)]
    net = Net(languages, directions, weight(2 * HIDDEN, len(languages)), np.zeros(len(languages), np.float32))
    first = [np.zeros_like(p) for p in net.parameters()]
    second = [np.zeros_like(p) for p in net.parameters()]
    for step in range(1, steps + 1):
        label = rng.integers(len(languages), size=rows)
        data, mask = np.zeros((rows, WINDOW), np.uint8), np.zeros((rows, WINDOW), np.float32)
        for i, lab in enumerate(label):
            t = own[lab][rng.integers(len(own[lab]))]
            a = int(rng.integers(max(1, len(t) - WINDOW // 2)))
            piece = np.frombuffer(t[a:a + WINDOW], np.uint8)
            data[i, :len(piece)], mask[i, :len(piece)] = piece, 1
        _, grads = gradients(net, data, label, mask)
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
        rate = 0.03 * min(1.0, 2 * (1 - step / (steps + 1)))
        for p, g, m, v in zip(net.parameters(), grads, first, second):
            g = g * min(1.0, 1.0 / (norm + 1e-9))
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return net


def document_scores(net: Net, parts: list[bytes]) -> np.ndarray:
    """Mean label probabilities over all positions of each text; zeros for an empty one."""
    out = np.zeros((len(parts), len(net.languages)))
    for first, last in slabs(parts, 1 << 20):
        n = np.array([len(p) for p in parts[first:last]], np.int64)
        windows = -(-n // WINDOW)
        padded = b"".join(p + b"\0" * (int(w) * WINDOW - len(p)) for p, w in zip(parts[first:last], windows))
        data = np.frombuffer(padded, np.uint8).reshape(-1, WINDOW)
        owner = np.repeat(np.arange(last - first), windows)
        for a in range(0, len(data), ROWS):
            own = owner[a:a + ROWS]
            p = positions(net, data[a:a + ROWS])
            left = n[own] - WINDOW * (np.arange(a, a + len(own)) - (np.cumsum(windows) - windows)[own])
            short = np.flatnonzero(left < WINDOW)  # only a text's last window has positions past its end
            for i in short:
                p[left[i]:, :, i] = 0
            p = p.sum(axis=0, dtype=np.float64)
            for c in range(len(p)):
                out[first:last, c] += np.bincount(own, weights=p[c], minlength=last - first)
        out[first:last] /= np.maximum(n, 1)[:, None]
    return out


def learn(docs: DataFrame, per_language: int = 400, total: int = 102_400, most_chars: int = 1 << 16) -> Net | None:
    """Train on at most ``per_language`` documents of every language, first by hash of the id,
    and on ``total`` in all: with very many languages each has fewer (beyond ``total``
    languages the most frequent count). Of a text of more than ``most_chars`` characters
    sixteen pieces from all over it are in the sample.

    Candidates are cut by a hash threshold that follows a language's count, so that ranking
    meets a few hundred rows a language however frequent it is."""
    rows = docs.select("doc_id", "text", "lang").filter("lang is not null and text is not null")
    rows = rows.filter(fold(F.col("doc_id"), 3) != 1).filter(F.length("text") > 0)
    known = stored(rows.select("doc_id", "lang", F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)).alias("h")), "labelled_ids")
    count = known.groupBy("lang").agg(F.count(F.lit(1)).alias("c")).orderBy(F.desc("c"), "lang").limit(total)
    each = max(1, min(per_language, total // max(1, count.count())))
    # Four times as many as are taken: fewer than ``each`` of a large language pass next to never, and then all of them count.
    few = known.join(F.broadcast(count), "lang").filter(F.col("h").cast("double") * F.col("c") <= float(4 * each + 64) * (1 << 40))
    first = Window.partitionBy("lang").orderBy("h", "doc_id")
    ids = few.withColumn("n", F.row_number().over(first)).filter(F.col("n") <= each).select("doc_id", "lang")
    piece = most_chars // 16
    pieces = F.transform(F.sequence(F.lit(0), F.lit(15)), lambda i: F.substring(
        "text", (F.pmod(F.xxhash64(F.col("doc_id"), i), F.length("text") - piece) + 1).cast("int"), F.lit(piece)))
    text = F.when(F.length("text") > most_chars, F.array_join(pieces, " ")).otherwise(F.col("text"))
    sample = rows.join(F.broadcast(ids), ["doc_id", "lang"]).select("doc_id", "lang", text.alias("text")).toPandas()  # ``total`` ids at most
    sample = sample.sort_values(["lang", "doc_id", "text"])
    # As many windows a language as four languages get in 300 steps.
    return train([t.encode() for t in sample["text"]], sample["lang"].tolist(), steps=max(300, 75 * sample["lang"].nunique()))


def identify(docs: DataFrame, per_language: int = 400, total: int = 102_400) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, held_out, lang_pred, score``. ``per_language`` and
    ``total`` bound the documents to learn from, see ``learn``.

    Reads ``doc_id`` and ``text``, and ``lang`` of the rows to learn from. ``und`` with score 0
    where the text is null, empty or has no letter, and everywhere if there is no labelled
    text to learn from. A null id is not held out and not learned from. Rows repeated with
    one id are labelled each. An empty table gives an empty result."""
    net = learn(docs, per_language, total)

    def run(batches):
        for b in batches:
            texts = blobs(b.column("text"))
            lettered = np.array([LETTERS.search(t.decode("utf-8", "replace")) is not None for t in texts], bool)
            names, score = np.full(len(texts), "und", dtype=object), np.zeros(len(texts))
            if net is not None and lettered.any():
                p = document_scores(net, [t if ok else b"" for t, ok in zip(texts, lettered)])
                best = p.argmax(axis=1)
                names[lettered] = np.array(net.languages, dtype=object)[best[lettered]]
                score[lettered] = np.clip(p[np.arange(len(texts)), best], 0, 1)[lettered]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(names, pa.string()), pa.array(score)],
                                             names=["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select("doc_id", F.coalesce(fold(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out"), "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double")
