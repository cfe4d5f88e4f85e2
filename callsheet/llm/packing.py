"""Pack tokenised documents into windows by Karmarkar-Karp multiway differencing.

Each task packs its own documents, some hundred windows' worth at a time, so nothing is
shuffled and memory is bounded by one batch. In a batch every piece starts as a partial
partition of k windows; the two with the largest imbalance are merged so that large
windows of one meet small ones of the other, until one partition is left. If a window
then exceeds the capacity, k rises and the batch is packed again."""

from __future__ import annotations

import heapq
import json
import os
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import blobs, slabs
from .token_counts import byte_letters


def difference(sizes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Window of each size and the windows' sums, by multiway differencing into ``k``.

    A partial partition keeps its filled windows only, largest first: their sums and, for
    each, a node. Windows that meet in a merge become a node with two children, so memory
    follows the number of sizes, not sizes times windows."""
    n = len(sizes)
    if k == 1 or n == 0:
        return np.zeros(n, np.int64), np.array([int(sizes.sum())] + [0] * (k - 1), np.int64)
    parts = {i: (sizes[i:i + 1].astype(np.int64), np.array([i])) for i in range(n)}
    heap = [(-int(s), i) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    left, right, name, nodes = [], [], n, n
    while len(heap) > 1:
        (_, a), (_, b) = heapq.heappop(heap), heapq.heappop(heap)
        (sums, at), (more, others) = parts.pop(a), parts.pop(b)
        more, others = more[::-1], others[::-1]  # small windows meet large ones
        both = max(0, len(sums) + len(more) - k)
        if both:
            own = len(sums) - both
            met = np.arange(nodes, nodes + both)
            nodes += both
            left += at[own:].tolist()
            right += others[:both].tolist()
            sums = np.concatenate([sums[:own], sums[own:] + more[:both], more[both:]])
            at = np.concatenate([at[:own], met, others[both:]])
        else:
            sums, at = np.concatenate([sums, more]), np.concatenate([at, others])
        order = np.argsort(-sums, kind="stable")
        sums, at = sums[order], at[order]
        parts[name] = sums, at
        heapq.heappush(heap, (-int(sums[0] - (sums[-1] if len(sums) == k else 0)), name))
        name += 1
    (sums, at), = parts.values()
    window = np.zeros(nodes, np.int64)
    window[at] = np.arange(len(at))
    window = window.tolist()
    for node in range(nodes - 1, n - 1, -1):  # from the last merge back to the sizes
        window[left[node - n]] = window[right[node - n]] = window[node]
    return np.array(window[:n], np.int64), np.pad(sums, (0, k - len(sums)))


def bundles(sizes: np.ndarray, small: int) -> np.ndarray:
    """Bundle of each size: neighbours below ``small`` go together until they reach it."""
    out, bundle, filled = np.empty(len(sizes), np.int64), -1, small
    for i, s in enumerate(sizes.tolist()):
        if s >= small:
            bundle, filled = bundle + 1, small
        elif filled >= small:
            bundle, filled = bundle + 1, s
        else:
            filled += s
        out[i] = bundle
    return out


def pack_sizes(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, int]:
    """Window of each piece, none above ``capacity``, and the number of windows."""
    k = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        window, sums = difference(sizes, k)
        if sums.max() <= capacity:
            return window, k
        k += 1


class TextIds:
    """Token ids of whole texts, as the tokenizer library gives them.

    Made for tokenizers that drop white space before anything can join across it, so that
    a text's ids are those of its words. Words of plain characters are split by character
    class; any other word (quotes, special strings, characters that normalising may change)
    goes to the library as it is. The library's merges run once for each distinct plain
    word of a slab."""

    BLANK, LETTER, DIGIT, OTHER, ODD = range(5)
    SHORT = 16  # bytes of a word that two numbers hold

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task's core only
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        before = spec["pre_tokenizer"]["pretokenizers"]
        if [x["type"] for x in before] != ["Split", "ByteLevel"] or before[1].get("use_regex", True):
            raise ValueError("made for files that split by a pattern and drop white space")
        self.letters = {b: c for c, b in byte_letters().items()}  # how the vocabulary writes bytes
        self.kind, self.low = np.full(0x110000, self.ODD, np.uint8), np.arange(0x110000, dtype=np.uint32)
        for c in map(chr, range(0x21, 0x250)):
            # Plain: no part of a contraction or special string, kept by normalising, lower-cased to one.
            if c not in "'<" and not c.isspace() and unicodedata.normalize("NFC", c) == c and len(c.lower()) == 1:
                group = unicodedata.category(c)[0]
                self.kind[ord(c)] = self.LETTER if group == "L" else self.DIGIT if group == "N" else self.OTHER
                self.low[ord(c)] = ord(c.lower())
        self.kind[[9, 10, 11, 12, 13, 32]] = self.BLANK

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        out: list[np.ndarray] = []
        for first, last in slabs(texts, 4 << 20):
            out += self._slab([t.decode("utf-8", "replace") for t in texts[first:last]])
        return out

    def plain(self, data: np.ndarray, a: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of plain words one after another, and how many each has."""
        before = np.cumsum(size) - size
        at = np.arange(size.sum())
        line = np.full(len(at) + len(a), ord("\n"), np.uint8)
        line[at + np.repeat(np.arange(len(a)), size)] = data[at + np.repeat(a - before, size)]
        words = line.tobytes().decode("latin-1").translate(self.letters | {ord("\n"): "\n"}).split("\n")[:-1]
        ids, count, tokens = [], [], self.tokenizer.model.tokenize
        for w in words:
            got = tokens(w)
            count.append(len(got))
            ids += [t.id for t in got]
        return np.array(ids, np.uint32), np.array(count, np.int64)

    def odd(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for words of any characters."""
        got = [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        return np.concatenate([np.zeros(0, np.uint32), *got]), np.array([len(g) for g in got], np.int64)

    def distinct(self, data: np.ndarray, a: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For words of up to 16 bytes: one place per distinct word, and which one each is."""
        padded = np.concatenate([data, np.zeros(16, np.uint8)])
        words = np.ndarray((len(data) + 9,), "<u8", buffer=padded, strides=(1,))
        mask = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
        low, high = words[a] & mask[np.minimum(size, 8)], words[a + 8] & mask[np.clip(size - 8, 0, 8)]
        mixed = (low ^ (low >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + (high ^ (high >> np.uint64(31))) * np.uint64(0xC2B2AE3D27D4EB4F)
        _, first, which = np.unique(mixed, return_index=True, return_inverse=True)
        if not ((low == low[first][which]) & (high == high[first][which])).all():  # the bytes decide
            _, first, which = np.unique(np.stack([low, high], axis=1), axis=0, return_index=True, return_inverse=True)
        return first, which.ravel()

    def _slab(self, texts: list[str]) -> list[np.ndarray]:
        points = np.frombuffer(("\n" + "\n".join(texts) + "\n").encode("utf-32-le"), "<u4")
        stops = np.cumsum([len(t) + 1 for t in texts])
        kind = self.kind[points]
        change = kind[1:] != kind[:-1]
        digit = kind == self.DIGIT
        full = kind != self.BLANK
        starts = np.flatnonzero(full[1:] & (change | digit[1:])) + 1
        ends = np.flatnonzero(full[:-1] & (change | digit[:-1])) + 1
        odd = np.flatnonzero(kind == self.ODD)
        odd_lo = odd_hi = np.zeros(0, np.int64)
        if len(odd):  # whole words that hold an odd character leave the plain path
            edge = np.flatnonzero(np.diff(full.astype(np.int8)))
            lo, hi = edge[0::2] + 1, edge[1::2] + 1
            word = np.unique(np.searchsorted(lo, odd, side="right") - 1)
            odd_lo, odd_hi = lo[word], hi[word]
            at = np.searchsorted(odd_lo, starts, side="right") - 1
            plain = (at < 0) | (starts >= odd_hi[at])
            starts, ends = starts[plain], ends[plain]
        low = self.low[points]
        data, a, z = np.frombuffer(low.astype("<u4").tobytes().decode("utf-32-le").encode(), np.uint8), starts, ends
        if len(data) != len(points):
            where = np.concatenate([[0], np.cumsum(1 + (low >= 0x80) + (low >= 0x800) + (low >= 0x10000).astype(np.int64))])
            a, z = where[starts], where[ends]
        size = z - a
        short, long = np.flatnonzero(size <= self.SHORT), np.flatnonzero(size > self.SHORT)
        first, which = self.distinct(data, a[short], size[short])
        kept = np.concatenate([short[first], long])  # the words the library reads
        place = np.empty(len(a), np.int64)  # which of them each word is
        place[short], place[long] = which, len(first) + np.arange(len(long))
        pool, count = self.plain(data, a[kept], size[kept])
        if len(odd_lo):
            more, extra = self.odd([points[i:j].tobytes().decode("utf-32-le") for i, j in zip(odd_lo, odd_hi)])
            pool, place = np.concatenate([pool, more]), np.concatenate([place, len(count) + np.arange(len(extra))])
            count, starts = np.concatenate([count, extra]), np.concatenate([starts, odd_lo])
            order = np.argsort(starts, kind="stable")
            starts, place = starts[order], place[order]
        n, begin = count[place], (np.cumsum(count) - count)[place]
        total = np.concatenate([[0], np.cumsum(n)])
        ids = pool[np.arange(total[-1]) + np.repeat(begin - total[:-1], n)]
        cuts = total[np.concatenate([[0], np.searchsorted(starts, stops)])]
        return [ids[i:j] for i, j in zip(cuts, cuts[1:])]


_TABLES: dict[str, TextIds] = {}
#: Bytes of text read at a time. Some twenty arrays of a slab's length live at once, up to eight
#: bytes a character each, and a worker keeps what its largest slab took.
SLAB = 1 << 20


def pack(docs: DataFrame, path: str, capacity: int = 4096, end_id: int = 2, piece: int = 1024, batch: int = 256, crowd: int = 1 << 17) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids, doc_tokens, sequence_id, offset``.

    Reads ``doc_id`` and ``text``. A document's tokens (whole text; a null text has none)
    are followed by ``end_id``, so each document has at least one piece. ``ids`` holds the
    piece as little-endian unsigned 32-bit numbers. Full windows are cut off a long document
    first; the rest goes into pieces of at most ``piece`` tokens, packed ``batch`` windows'
    worth or ``crowd`` pieces at a time; neighbouring pieces below a sixteenth of ``piece``
    are placed together up to that size. ``sequence_id`` is made from task and window number and so repeats for
    the same input split. Rows repeated with one id are packed each; null ids stay null.
    An empty table gives an empty result."""
    rows = docs.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]

    def run(batches):
        if path not in _TABLES:
            _TABLES[path] = TextIds(path)
        table, sequence = _TABLES[path], TaskContext.get().partitionId() << 32
        held, tokens = [], 0

        def out(pieces, window, offset):
            doc, start, ids, total = zip(*pieces)
            return pa.RecordBatch.from_arrays(
                [pa.array(doc, doc_type), pa.array(start, pa.int64()), pa.array([len(x) for x in ids], pa.int64()), pa.array([x.tobytes() for x in ids], pa.binary()),
                 pa.array(total, pa.int64()), pa.array(window, pa.int64()), pa.array(offset, pa.int64())], names=names)

        def settle():
            sizes = np.array([len(p[2]) for p in held], np.int64)
            bundle = bundles(sizes, piece // 16)
            window, k = pack_sizes(np.bincount(bundle, weights=sizes).astype(np.int64), capacity)
            window = window[bundle]
            order = np.argsort(window, kind="stable")
            ends = np.cumsum(sizes[order])
            first = np.searchsorted(window[order], window[order], side="left")
            offset = (ends - sizes[order]) - (ends - sizes[order])[first]
            return out([held[i] for i in order], sequence + window[order], offset), k

        doc_type = None
        for b in batches:
            doc_type = b.column("doc_id").type
            ids_of, texts = b.column("doc_id").to_pylist(), blobs(b.column("text"))
            for lo, hi in slabs(texts, SLAB):
                full = []
                for doc, ids in zip(ids_of[lo:hi], table.encode(texts[lo:hi])):
                    ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                    total, whole = len(ids), len(ids) // capacity * capacity
                    full += [(doc, a, ids[a:a + capacity], total) for a in range(0, whole, capacity)]
                    # The rest in pieces of like size, none above ``piece``.
                    cuts = np.linspace(whole, total, -(-(total - whole) // piece) + 1).astype(int).tolist() if total > whole else []
                    held += [(doc, a, ids[a:z], total) for a, z in zip(cuts, cuts[1:])]
                    tokens += total - whole
                    if tokens >= batch * capacity or len(held) >= crowd:
                        rows_out, k = settle()
                        yield rows_out
                        sequence, held, tokens = sequence + k, [], 0
                if full:
                    yield out(full, sequence + np.arange(len(full)), np.zeros(len(full), np.int64))
                    sequence += len(full)
        if held:
            yield settle()[0]

    return rows.mapInArrow(run, f"doc_id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")


def digests(pieces: DataFrame) -> DataFrame:
    """Pieces with a checksum in place of their ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
