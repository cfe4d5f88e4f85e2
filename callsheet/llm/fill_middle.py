"""Fill-in-the-middle texts, cut at code points by a Roaring-style boundary set.

A slab of texts is one run of UTF-8 bytes. The offsets at which a code point begins form a
set in containers of 65 536 offsets: a run container where all bytes are of one-byte code
points, an array where few offsets are set, a bitmap otherwise. Containers keep cumulative
cardinalities, so a cut "after so many code points" is a search for the container and a
select inside it; one pass serves all texts of the slab. Nothing is shuffled."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from callsheet.functions.regex import any_of

from .common import blobs, joined, slabs

SPAN = 1 << 16
RUN, ARRAY, BITMAP = range(3)


class _Runs:
    """Stretches of neighbouring offsets: first offsets and offsets before each stretch."""

    kind = RUN

    def __init__(self, first: np.ndarray, size: np.ndarray):
        self.first, self.before = first, np.cumsum(size) - size
        self.size = size

    def select(self, k: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.before, k, side="right") - 1
        return self.first[at] + k - self.before[at]

    def rank(self, offset: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.first, offset, side="right") - 1
        inside = np.clip(offset - self.first[at], 0, self.size[at])
        return np.where(at < 0, 0, self.before[at] + inside)


class _Array:
    kind = ARRAY

    def __init__(self, low: np.ndarray):
        self.low = low.astype(np.uint16)

    def select(self, k: np.ndarray) -> np.ndarray:
        return self.low[k].astype(np.int64)

    def rank(self, offset: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.low, offset, side="left")


class _Bitmap:
    """One bit an offset in 64-bit words, with the bits set before each word."""

    kind = BITMAP

    def __init__(self, marks: np.ndarray):
        packed = np.packbits(marks, bitorder="little")
        self.words = np.pad(packed, (0, -len(packed) % 8)).view("<u8")
        ones = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.cumsum(ones) - ones

    def select(self, k: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.before, k, side="right") - 1
        word, left, out = self.words[at], k - self.before[at], at * 64
        for width in (32, 16, 8, 4, 2, 1):  # halves of what is left of the word
            low = np.bitwise_count(word & np.uint64((1 << width) - 1)).astype(np.int64)
            up = left >= low
            left = np.where(up, left - low, left)
            word = np.where(up, word >> np.uint64(width), word)
            out = out + np.where(up, width, 0)
        return out

    def rank(self, offset: np.ndarray) -> np.ndarray:
        at = np.minimum(offset >> 6, len(self.words) - 1)
        below = np.where(offset - at * 64 >= 64, ~np.uint64(0), (np.uint64(1) << (offset & 63).astype(np.uint64)) - np.uint64(1))
        return self.before[at] + np.bitwise_count(self.words[at] & below).astype(np.int64)


class BoundarySet:
    """Offsets of ``data`` (UTF-8 bytes) at which a code point begins."""

    def __init__(self, data: np.ndarray):
        self.size = len(data)
        self.parts, cards = [], []
        for lo in range(0, len(data), SPAN):
            marks = (data[lo:lo + SPAN] & 0xC0) != 0x80
            card = int(np.count_nonzero(marks))
            edge = np.flatnonzero(marks[1:] != marks[:-1]) + 1 if card < len(marks) else np.zeros(0, np.int64)
            # First and past-the-end offset of each run, in turn.
            edge = np.concatenate([[0] if marks[0] else [], edge, [len(marks)] if marks[-1] else []]).astype(np.int64)
            if 2 * len(edge) <= min(2 * card, SPAN // 8):
                self.parts.append(_Runs(edge[0::2], edge[1::2] - edge[0::2]))
            elif 2 * card <= SPAN // 8:
                self.parts.append(_Array(np.flatnonzero(marks)))
            else:
                self.parts.append(_Bitmap(marks))
            cards.append(card)
        self.before = np.concatenate([[0], np.cumsum(cards)]).astype(np.int64)

    def __len__(self) -> int:
        return int(self.before[-1])

    def _each(self, container: np.ndarray, values: np.ndarray, out: np.ndarray, ask) -> np.ndarray:
        order = np.argsort(container, kind="stable")
        bounds = np.searchsorted(container[order], np.arange(len(self.parts) + 1))
        for c in np.unique(container).tolist():
            if 0 <= c < len(self.parts):
                rows = order[bounds[c]:bounds[c + 1]]
                out[rows] = ask(self.parts[c], c, values[rows])
        return out

    def rank(self, offset: np.ndarray) -> np.ndarray:
        """Boundaries before each offset."""
        offset = np.asarray(offset, np.int64)
        return self._each(offset // SPAN, offset, np.full(len(offset), len(self), np.int64),
                          lambda part, c, x: self.before[c] + part.rank(x - c * SPAN))

    def select(self, k: np.ndarray) -> np.ndarray:
        """Offset of each k-th boundary (from 0); the end of the data beyond the last."""
        k = np.asarray(k, np.int64)
        container = np.where(k < len(self), np.searchsorted(self.before, k, side="right") - 1, len(self.parts))
        return self._each(container, k, np.full(len(k), self.size, np.int64),
                          lambda part, c, x: c * SPAN + part.select(x - self.before[c]))


def _draw(doc_id: Column, seed: int) -> list[Column]:
    """Four unsigned 32-bit numbers from the hash of seed and id; a null id counts as empty."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def fill_in_middle(docs: DataFrame, seed: int = 1, plain_percent: int = 10, spm_percent: int = 20,
                   marks: tuple[str, str, str] = ("<P>", "<S>", "<M>")) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n, form, prefix_chars, middle_chars, output``.

    Reads ``doc_id`` and ``text`` (null: empty), no other column. ``n`` counts code points.
    An empty text, one that contains a mark, and ``plain_percent`` of the others stay as they
    are (form ``plain``, no lengths). The rest is cut at two places drawn from the id and put
    together as prefix, suffix, middle (``psm``) or, ``spm_percent`` of them, suffix, prefix,
    middle (``spm``). Rows repeated with one id are cut alike if their texts are; null ids
    share one draw. An empty table gives an empty result."""
    text = F.coalesce(F.col("text"), F.lit(""))
    h1, h2, h3, h4 = _draw(F.col("doc_id"), seed)
    marked = text.contains(marks[0]) | text.contains(marks[1]) | text.contains(marks[2])
    form = (F.when((text == "") | marked | (h3 % 100 >= 100 - plain_percent), "plain")
            .when(h4 % 100 < spm_percent, "spm").otherwise("psm"))
    rows = docs.select("doc_id", text.alias("text"), h1.alias("h1"), h2.alias("h2"), form.alias("form"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    p, s, m = (x.encode() for x in marks)

    def run(batches):
        for b in batches:
            texts, forms = blobs(b.column("text")), b.column("form").to_pylist()
            draws = [b.column(c).to_numpy(zero_copy_only=False) for c in ("h1", "h2")]
            for lo, hi in slabs(texts):
                data, starts, ends = joined(texts[lo:hi])
                points = BoundarySet(data)
                first = points.rank(starts)
                n = points.rank(ends) - first
                one, two = draws[0][lo:hi] % (n + 1), draws[1][lo:hi] % (n + 1)
                a, z = np.minimum(one, two), np.maximum(one, two)
                cut, back = (np.minimum(points.select(first + k), ends) - starts for k in (a, z))
                out = []
                for t, f, i, j in zip(texts[lo:hi], forms[lo:hi], cut.tolist(), back.tolist()):
                    out.append(t if f == "plain" else b"".join((p, t[:i], s, t[j:], m, t[i:j]) if f == "psm" else (s, t[j:], p, t[:i], m, t[i:j])))
                plain = np.array([f == "plain" for f in forms[lo:hi]])
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id")[lo:hi], pa.array(n), b.column("form")[lo:hi], pa.array(a, mask=plain), pa.array(z - a, mask=plain),
                     pa.array(out, pa.binary())], names=names)

    return rows.mapInArrow(run, f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output binary").withColumn(
        "output", F.col("output").cast("string"))


def restored(output: Column, form: Column, marks: tuple[str, str, str] = ("<P>", "<S>", "<M>")) -> Column:
    """The text behind an output: in ``psm`` and ``spm`` each mark stands exactly once."""
    part = F.split(output, any_of(marks), -1)
    return (F.when(form == "psm", F.concat(F.get(part, F.lit(1)), F.get(part, F.lit(3)), F.get(part, F.lit(2))))
            .when(form == "spm", F.concat(F.get(part, F.lit(2)), F.get(part, F.lit(3)), F.get(part, F.lit(1)))).otherwise(output))


def digests(cut: DataFrame) -> DataFrame:
    """Cut texts as hashes of the output and of what is rebuilt from it."""
    return cut.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                      F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))
