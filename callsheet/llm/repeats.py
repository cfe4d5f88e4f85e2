"""Repeated passages by a distributed difference-cover suffix sort.

Any two equal strings of ``width`` bytes hold the same anchor: the leftmost smallest
hash of their inner ``core``-byte strings. Suffixes are therefore dealt out by anchor,
and no match is lost between tasks. A document is cut into runs, each the windows (the
start positions) with one anchor.

1. Runs meet by anchor, in one shuffle; copies inside a task are merged before it. All but
   the earliest of runs with equal content repeat as a whole; the earliest one stands for its
   kind, and a kind alone under its anchor has nobody left to be compared with.
2. The texts of these kinds meet by anchor and are sorted by the difference-cover
   algorithm: sampled positions get names by sorting triples, the sort recurses on the
   names until a name covers ``width`` bytes, the remaining suffixes are merged in, and
   adjacent prefixes are compared. Kinds of a crowded anchor are first cut into shorter runs
   by longer anchors, and where these are crowded too into windows.
3. A document's repeated windows are joined to its text and cut out."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from callsheet.functions.stages import stored

from .common import blobs, joined, slabs

BASE = 0x9E3779B97F4A7C15
#: Text that one suffix sort holds, and kinds of one anchor that it may have.
SORTED, CROWD = 1 << 20, 2048
#: Text that is hashed at a time, and runs of one task whose copies are merged at a time.
PIECE, MERGED = 1 << 18, 1 << 19
#: What is known of a run: it repeats as a whole; its kind meets others; it meets more than CROWD.
WHOLE, OPEN, CROWDED = 0, 1, 2


class Hashes:
    """64-bit hashes of any substring of a byte array."""

    def __init__(self, data: np.ndarray):
        power = np.cumprod(np.full(len(data) + 1, BASE, np.uint64))
        self.back = np.cumprod(np.full(len(data) + 1, pow(BASE, -1, 1 << 64), np.uint64))
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:-1], dtype=np.uint64)])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        x = (self.sums[ends] - self.sums[starts]) * self.back[starts]
        for shift, factor in ((31, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        return x ^ (x >> np.uint64(31))


def _first_least(view: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Where the leftmost smallest of each row lies, some rows at a time."""
    out = np.empty(len(at), np.int64)
    for a in range(0, len(at), 1 << 15):
        out[a:a + (1 << 15)] = view[at[a:a + (1 << 15)]].argmin(axis=1)
    return out


def runs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, width: int, core: int):
    """Document, first window, number of windows, anchor hash and content hash of each run."""
    span = width - core + 1
    n = len(data) - width + 1
    none = np.zeros(0, np.int64)
    if n <= 0:
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    h = Hashes(data)
    at = np.arange(n + span - 1)
    g = h.of(at, at + core)
    # Smallest of each `span` neighbours, by running minima within blocks from both sides.
    padded = np.full(-(-len(g) // span) * span, np.uint64(2**64 - 1))
    padded[:len(g)] = g
    block = padded.reshape(-1, span)
    right = np.minimum.accumulate(block, axis=1).ravel()
    left = np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(left[:n], right[span - 1:span - 1 + n])
    doc = np.repeat(np.arange(len(starts)), ends - starts)[:n]
    inside = np.flatnonzero(np.arange(n) + width <= ends[doc])
    if not len(inside):
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    value = least[inside]
    new = np.ones(len(inside), bool)
    new[1:] = (value[1:] != value[:-1]) | (inside[1:] != inside[:-1] + 1) | (doc[inside[1:]] != doc[inside[:-1]])
    first = inside[new]
    count = np.diff(np.append(np.flatnonzero(new), len(inside)))
    view = np.lib.stride_tricks.sliding_window_view(g, span)
    place = _first_least(view, first)
    parts, todo = [], (first, count, place)
    while len(todo[0]):  # periodic text: past its anchor a run goes on with the next equal one
        first, count, place = todo
        parts.append((first, np.minimum(count, place + 1), place, least[first]))
        on = count > place + 1
        first, count = first[on] + place[on] + 1, (count - place - 1)[on]
        todo = (first, count, _first_least(view, first))
    first, count, place, value_at = (np.concatenate(x) for x in zip(*parts))
    if core == width:  # there the anchor is the content; read it backwards for a second hash
        return doc[first], first - starts[doc[first]], count, value_at, Hashes(data[::-1]).of(len(data) - first - width, len(data) - first)
    content = h.of(first, first + count + width - 1) ^ (place.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return doc[first], first - starts[doc[first]], count, value_at, content


def ranks(s: np.ndarray, covered: int, need: int) -> np.ndarray:
    """Rank of each suffix of ``s`` (symbols from 1 on) by at least its first ``need`` bytes;
    a symbol covers ``covered`` bytes. Suffixes equal that far may share or split a rank,
    but nothing else stands between them."""
    order = _order(s, covered, need)
    out = np.empty(len(s), np.int64)
    out[order] = np.arange(1, len(s) + 1)
    return out


def _order(s: np.ndarray, covered: int, need: int) -> np.ndarray:
    n = len(s)
    if n < 6:
        return np.array(sorted(range(n), key=lambda i: s[i:].tolist()), np.int64)
    t = np.concatenate([s, np.zeros(6, s.dtype)]).astype(np.int64)
    size = int(t.max()) + 1
    one, two = np.arange(1, n + 1, 3), np.arange(2, n + 1, 3)
    sample = np.concatenate([one, two])
    triple = (t[sample] * size + t[sample + 1]) * size + t[sample + 2]
    by = np.argsort(triple)  # equal triples get one name in any order
    name = np.empty(len(sample), np.int64)
    name[by] = np.cumsum(np.concatenate([[1], (np.diff(triple[by]) != 0).astype(np.int64)]))
    if 3 * covered < need and name.max() < len(sample):
        # A zero parts the two halves, so that no name is read across.
        half = ranks_tied(np.concatenate([name[:len(one)], [0], name[len(one):]]) + 1, 3 * covered, need)
        name = np.concatenate([half[:len(one)], half[len(one) + 1:]])
    rank = np.zeros(n + 6, np.int64)
    rank[sample] = name
    wide = int(rank.max()) + 1
    sample = sample[sample < n]
    ordered = sample[np.argsort(rank[sample], kind="stable")]
    zero = np.arange(0, n, 3)
    zero = zero[np.argsort(t[zero] * wide + rank[zero + 1], kind="stable")]
    # Merge: against positions 1 mod 3 by (symbol, rank after), 2 mod 3 by (two symbols, rank after).
    ones, twos = ordered[ordered % 3 == 1], ordered[ordered % 3 == 2]
    below = np.searchsorted(np.sort(t[ones] * wide + rank[ones + 1]), t[zero] * wide + rank[zero + 1])
    pair = _pairs(t, twos, zero, size, wide)
    below += np.searchsorted(np.sort(pair[0] * wide + rank[twos + 2]), pair[1] * wide + rank[zero + 2])
    return np.insert(ordered, np.maximum.accumulate(below), zero)


def _pairs(t: np.ndarray, a: np.ndarray, b: np.ndarray, size: int, wide: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the two symbols at ``a`` and at ``b``, in order; made dense only where they,
    times ``wide``, would not fit 63 bits."""
    if size * size * wide < 1 << 63:
        return t[a] * size + t[a + 1], t[b] * size + t[b + 1]
    both = np.concatenate([t[a] * size + t[a + 1], t[b] * size + t[b + 1]])
    dense = np.unique(both, return_inverse=True)[1]
    return dense[:len(a)], dense[len(a):]


def ranks_tied(s: np.ndarray, covered: int, need: int) -> np.ndarray:
    """Ranks by sorted order; neighbours equal in their first ``need`` bytes share one."""
    order = _order(s, covered, need)
    reach = -(-need // covered)
    t = np.concatenate([s, np.zeros(reach + 1, s.dtype)])
    same = np.ones(len(order) - 1, bool)
    for k in range(reach):
        same &= t[order[1:] + k] == t[order[:-1] + k]
    out = np.empty(len(s), np.int64)
    out[order] = np.cumsum(np.concatenate([[1], (~same).astype(np.int64)]))
    return out


def _repeated(texts: list[bytes], counts: np.ndarray, doc: np.ndarray, first: np.ndarray, width: int):
    """Kind number and offset of each window that also starts earlier in another kind."""
    data, starts, _ = joined(texts)
    valid = np.zeros(len(data), bool)
    owner = np.repeat(np.arange(len(texts)), counts)
    at = starts[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    valid[at] = True
    order = _order(data.astype(np.int64) + 1, 1, width)
    order = order[valid[order]]
    windows = np.lib.stride_tricks.sliding_window_view(data, width)
    same = np.empty(len(order), bool)
    same[0] = False
    for a in range(1, len(order), 1 << 16):
        z = min(a + (1 << 16), len(order))
        same[a:z] = (windows[order[a:z]] == windows[order[a - 1:z - 1]]).all(axis=1)
    many = same.copy()  # windows that are alone need no further order
    many[:-1] |= same[1:]
    order, same = order[many], same[many]
    kind = np.empty(len(data), np.int64)
    kind[at] = owner
    if not len(order):
        return order, order
    group = np.cumsum(~same)
    d, w = doc[kind[order]], first[kind[order]] + order - starts[kind[order]]
    by = np.lexsort([w, d, group])
    lead = np.concatenate([[True], group[by][1:] != group[by][:-1]])
    earliest = np.flatnonzero(lead)[np.cumsum(lead) - 1]
    later = (d[by] != d[by][earliest]) | (w[by] != w[by][earliest])
    hit = order[by[later]]
    return kind[hit], hit - starts[kind[hit]]


def _stretches(kind: np.ndarray, offset: np.ndarray):
    """Maximal stretches of consecutive offsets of each kind: kind, first, length."""
    order = np.lexsort([offset, kind])
    kind, offset = kind[order], offset[order]
    new = np.ones(len(kind), bool)
    new[1:] = (kind[1:] != kind[:-1]) | (offset[1:] != offset[:-1] + 1)
    first = np.flatnonzero(new)
    return kind[first], offset[first], np.diff(np.append(first, len(kind)))


def _merged(held: list[tuple]):
    """Runs without later copies among themselves, then the copies as settled stretches.
    A column of pieces after the others goes along."""
    ids, *pieces = (pa.concat_arrays(list(x)) for x in [*zip(*held)][::5])
    first, n, anchor, content = (np.concatenate(x) for x in [*zip(*held)][1:5])
    if not len(first):
        return
    doc = np.unique(ids.to_numpy(zero_copy_only=False), return_inverse=True)[1]
    by = np.lexsort([first, doc, content, anchor])
    d, f = doc[by], first[by]
    new = np.ones(len(by), bool)
    new[1:] = (anchor[by][1:] != anchor[by][:-1]) | (content[by][1:] != content[by][:-1])
    lead = np.flatnonzero(new)[np.cumsum(new) - 1]
    copy = by[(d != d[lead]) | (f != f[lead])]
    kept = np.sort(by[new])
    copy = copy[np.lexsort([first[copy], doc[copy]])]
    start = np.ones(len(copy), bool)
    start[1:] = (doc[copy[1:]] != doc[copy[:-1]]) | (first[copy[1:]] != first[copy[:-1]] + n[copy[:-1]])
    head = copy[start]
    length = np.add.reduceat(n[copy], np.flatnonzero(start)) if len(copy) else n[:0]
    for at, count, settled in ((kept, n[kept], False), (head, length, True)):
        yield pa.RecordBatch.from_arrays([ids.take(pa.array(at)), pa.array(first[at]), pa.array(count.astype(np.int32)), pa.array(np.full(len(at), settled)),
                                          pa.array(anchor[at]), pa.array(content[at]), *[p.take(pa.array(at)) for p in pieces]],
                                         names=["doc_id", "first", "n", "settled", "anchor", "content", "piece"][:6 + len(pieces)])


def _met(batches, crowd: int):
    """From runs in order of (settled, anchor, content, place): the runs that repeat as a whole
    and, for anchors with several kinds, the earliest run of each kind. At most one batch and
    the kinds of one anchor are held, and of these no more than ``crowd``."""
    def out(state, doc, first, n, anchor, _, *piece):
        return pa.RecordBatch.from_arrays([pa.array(doc, id_type), pa.array(first), pa.array(n), pa.array(anchor), pa.array(np.broadcast_to(np.int32(state), len(first)).copy()),
                                           *[pa.array(p, pa.binary()) for p in piece]], names=["doc_id", "first", "n", "anchor", "state", "piece"][:5 + len(piece)])

    def where(rows, at):
        return [x[at] for x in rows]

    held, over = None, False
    for b in batches:
        id_type = b.schema.field("doc_id").type
        names = [c for c in b.schema.names if c != "settled"]
        settled = b.column("settled").to_numpy(zero_copy_only=False)
        rows = [b.column(c).to_numpy(zero_copy_only=False) for c in names]
        if settled.any():
            yield out(WHOLE, *where(rows, settled))
        rows = where(rows, ~settled)
        if held is not None:
            rows = [np.concatenate(x) for x in zip(held, rows)]
        doc, first, _, anchor, content = rows[:5]
        if not len(doc):
            continue
        fresh = np.ones(len(doc), bool)
        fresh[1:] = anchor[1:] != anchor[:-1]
        new = fresh.copy()
        new[1:] |= content[1:] != content[:-1]
        lead = np.flatnonzero(new)[np.cumsum(new) - 1]
        yield out(WHOLE, *where(rows, (doc != doc[lead]) | (first != first[lead])))
        rows = where(rows, new)
        group = np.cumsum(fresh[new]) - 1
        kinds = np.bincount(group)
        if over:
            kinds[0] += crowd
        last = int(np.searchsorted(group, group[-1]))
        of = kinds[group[:last]]
        some = np.flatnonzero(of > 1)
        yield out(np.where(of[some] > crowd, CROWDED, OPEN).astype(np.int32), *where(rows, some))
        over = over and last == 0
        if len(group) - last > crowd:  # the last one stays, its copies may follow
            yield out(CROWDED, *where(rows, slice(last, -1)))
            over, last = True, len(group) - 1
        held = where(rows, slice(last, None))
    if held is not None and (over or len(held[0]) > 1):
        yield out(CROWDED if over else OPEN, *held)


def repeated_windows(docs: DataFrame, width: int = 100, core: int = 32) -> DataFrame:
    """``doc_id, first, n``: stretches of start positions whose ``width`` bytes also start earlier."""
    id_type = docs.schema["doc_id"].dataType
    found = T.StructType().add("doc_id", id_type).add("first", "long").add("n", "long")

    crowd = CROWD

    def meet(rows: DataFrame, core: int, piecewise: bool) -> DataFrame:
        """What is known of the runs of ``rows``: whole texts, or pieces that start at ``first``."""
        def cut(batches):
            held, size = [], 0
            for b in batches:
                texts = blobs(b.column("text"))
                for lo, hi in slabs(texts, PIECE):
                    doc, first, count, anchor, content = runs(*joined(texts[lo:hi]), width, core)
                    own = [pa.array([texts[lo + d][f:f + c + width - 1] for d, f, c in zip(doc, first, count)], pa.binary())] if piecewise else []
                    first = first + b.column("first").to_numpy()[doc + lo] if piecewise else first
                    held.append((b.column("doc_id").take(pa.array(doc + lo)), first, count, anchor.view(np.int64), content.view(np.int64), *own))
                    size += len(doc)
                    if size > MERGED >> 2 * piecewise:
                        yield from _merged(held)
                        held, size = [], 0
            if held:
                yield from _merged(held)

        place = T.StructType().add("doc_id", id_type).add("first", "long").add("n", "integer")
        cuts = rows.mapInArrow(cut, with_piece(T.StructType(place.fields[:]).add("settled", "boolean").add("anchor", "long").add("content", "long"), piecewise))
        # Runs meet by anchor; what is settled is spread by place, so that a hot text stays spread.
        dealt = cuts.repartition(F.when(F.col("settled"), F.xxhash64("doc_id", "first")).otherwise(F.col("anchor")))
        return stored(dealt.sortWithinPartitions("settled", "anchor", "content", "doc_id", "first")
                      .mapInArrow(lambda batches: _met(batches, crowd), with_piece(T.StructType(place.fields[:]).add("anchor", "long").add("state", "integer"), piecewise)), "runs")

    def with_piece(schema: T.StructType, piecewise: bool) -> T.StructType:
        return schema.add("piece", "binary") if piecewise else schema

    def settled(met: DataFrame) -> DataFrame:
        return met.filter(F.col("state") == WHOLE).select("doc_id", "first", F.col("n").cast("long").alias("n"))

    rows = docs.filter("doc_id is not null").select("doc_id", "text")
    runs_met = meet(rows, core, False)
    whole = settled(runs_met)

    def fetch(batches):
        for b in batches:
            texts = blobs(b.column("text"))
            doc, first, n, anchor, state, piece = [], [], [], [], [], []
            for i, (t, own) in enumerate(zip(texts, b.column("own").to_pylist())):
                for k in own:
                    doc.append(i)
                    first.append(k["first"])
                    n.append(k["n"])
                    anchor.append(k["anchor"])
                    state.append(k["state"])
                    piece.append(t[k["first"]:k["first"] + k["n"] + width - 1])
            yield pa.RecordBatch.from_arrays([b.column("doc_id").take(pa.array(doc, pa.int64())), pa.array(first, pa.int64()), pa.array(n, pa.int64()), pa.array(anchor, pa.int64()),
                                              pa.array(state, pa.int32()), pa.array(piece, pa.binary())], names=["doc_id", "first", "n", "anchor", "state", "piece"])

    open_ = runs_met.filter(F.col("state") != WHOLE).select("doc_id", F.struct("first", "n", "anchor", "state").alias("k"))
    own = open_.groupBy("doc_id").agg(F.collect_list("k").alias("own"))  # as many as the document has runs
    texts = stored(rows.join(own, "doc_id").mapInArrow(fetch, T.StructType().add("doc_id", id_type).add("first", "long").add("n", "long")
                                                       .add("anchor", "long").add("state", "integer").add("piece", "binary")), "pieces")
    # A crowded anchor's kinds are cut anew by longer anchors, in the end by whole windows.
    alike, crowded = texts.filter(F.col("state") == OPEN), texts.filter(F.col("state") == CROWDED)
    for longer in ((core + width) // 2, width):
        if crowded.isEmpty():
            break
        again = meet(crowded.select("doc_id", "first", F.col("piece").alias("text")), longer, True)
        whole = whole.unionByName(settled(again))
        again = again.withColumn("n", F.col("n").cast("long"))
        alike, crowded = alike.unionByName(again.filter(F.col("state") == OPEN)), again.filter(F.col("state") == CROWDED)

    def settle(held):
        doc, first, n, piece = (np.concatenate(x) if i < 3 else sum(x, []) for i, x in enumerate(zip(*held)))
        # Ids of any ordered kind are compared through their order.
        ids, number = np.unique(doc, return_inverse=True)
        kind, offset = _repeated(piece, n, number, first, width)
        kind, start, length = _stretches(kind, offset)
        return pa.RecordBatch.from_arrays([pa.array(doc[kind], from_pandas=False), pa.array(first[kind] + start), pa.array(length)], names=["doc_id", "first", "n"])

    def sort(batches):
        held, size, last = [], 0, None
        for b in batches:
            cols = [b.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "first", "n")]
            anchor, piece = b.column("anchor").to_numpy(zero_copy_only=False), b.column("piece").to_pylist()
            ends = np.append(np.flatnonzero(anchor[1:] != anchor[:-1]) + 1, len(anchor))
            lo = 0
            for hi in ends.tolist():
                if hi == lo:
                    continue
                if size > SORTED and anchor[lo] != last:  # the kinds of an anchor stay together
                    yield settle(held)
                    held, size = [], 0
                held.append((*[c[lo:hi] for c in cols], piece[lo:hi]))
                size += sum(map(len, piece[lo:hi]))
                last, lo = anchor[lo], hi
        if held:
            yield settle(held)

    met = alike.repartition("anchor").sortWithinPartitions("anchor").select("doc_id", "first", "n", "anchor", "piece").mapInArrow(sort, found)
    return stored(whole.unionByName(met), "repeated")


def cut_repeats(docs: DataFrame, width: int = 100, core: int = 32) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_bytes, n_removed, n_spans, kept`` (the bytes left).

    Reads ``doc_id`` and ``text`` (null: empty). Each byte that lies in a string of ``width``
    bytes which also starts earlier (smaller id, or same document and earlier start) is
    removed; strings are judged on the whole input. Texts shorter than ``width`` stay. Rows
    with a null id stay whole and remove nothing from others; ids are unique but for rows
    repeated whole, which are treated alike. An empty table gives an empty result."""
    id_type = docs.schema["doc_id"].dataType
    covers = (repeated_windows(docs, width, core).groupBy("doc_id")
              .agg(F.collect_list(F.struct("first", "n")).alias("own")))  # at most one per run of its text

    def run(batches):
        for b in batches:
            texts, size, removed, spans, kept = blobs(b.column("text")), [], [], [], []
            for t, own in zip(texts, b.column("own").to_pylist()):
                gone = np.zeros(len(t) + 1, np.int32)
                for k in own or ():
                    gone[k["first"]] += 1
                    gone[k["first"] + k["n"] + width - 1] -= 1
                mask = np.cumsum(gone[:-1]) > 0
                size.append(len(t))
                removed.append(int(mask.sum()))
                spans.append(int((np.diff(mask.astype(np.int8), prepend=0) == 1).sum()))
                kept.append(np.frombuffer(t, np.uint8)[~mask].tobytes())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(size, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept, pa.binary())],
                                             names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    rows = docs.select("doc_id", "text").join(covers, "doc_id", "left")
    return rows.mapInArrow(run, T.StructType().add("doc_id", id_type).add("n_bytes", "long").add("n_removed", "long").add("n_spans", "long").add("kept", "binary"))


def digests(cut: DataFrame) -> DataFrame:
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
