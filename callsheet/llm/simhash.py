"""SimHash near-duplicates with a generalised pigeonhole index.

Equal fingerprints are one row from the start. The 64 bits are grouped into partitions
of correlated bits; a dynamic program gives each partition its own distance threshold
(-1: not probed), so that any two fingerprints within the distance agree within the
threshold on some partition, at the least estimated number of candidates. Rows are
probed by (partition, value), verified in their task, and only the links that connect
a bucket are emitted, never its pairs. Crowded buckets are compared block by block."""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from callsheet.functions.stages import stored

from .common import blobs
from .components import components

BITS = 64
#: Members of a bucket compared in one task at a time.
BLOCK = 4096
#: Cost of handing one probe row to another task, in candidate comparisons.
ROW_COST = 60


def simhash(text: bytes, words: int = 3, seed: int = 42) -> int:
    """Bit set where over half of the shingle hashes have it; 0 without words."""
    low = text.lower().split()
    if not low:
        return 0
    line = b" ".join(low)
    h = xxhash.xxh64_intdigest
    if len(low) < words:
        hashes = [h(line, seed)]
    else:
        ends = np.cumsum([len(w) + 1 for w in low])
        starts = [0, *ends[:len(low) - words].tolist()]
        hashes = [h(line[a:b], seed) for a, b in zip(starts, (ends[words - 1:] - 1).tolist())]
    count = np.zeros(BITS, dtype=np.int64)
    for i in range(0, len(hashes), 1 << 16):
        part = np.array(hashes[i:i + (1 << 16)], dtype="<u8")
        count += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits((2 * count > len(hashes)).astype(np.uint8), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """``doc_id, fp`` (the 64 bits as a signed long) of every row, whole texts."""
    def run(batches):
        for b in batches:
            fps = np.array([simhash(t, words) for t in blobs(b.column("text"))], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(fps, pa.int64())], names=["doc_id", "fp"])

    rows = docs.select("doc_id", "text")
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, fp long")


def bit_counts(fps: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints and how many have bits i and j, over all rows of ``fp``."""
    def run(batches):
        n, both = 0, np.zeros((BITS, BITS))
        for b in batches:
            x = b.column("fp").to_numpy(zero_copy_only=False).astype("<i8")
            bits = np.unpackbits(x.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
            for i in range(0, len(bits), 1 << 16):
                both += bits[i:i + (1 << 16)].T @ bits[i:i + (1 << 16)]
            n += len(x)
        cells = pa.array(np.concatenate([[n], both.ravel()]).astype(np.int64))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(BITS * BITS + 1)), cells], names=["cell", "n"])

    sums = fps.select("fp").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    flat = np.zeros(BITS * BITS + 1)
    for r in sums.collect():  # 4097 rows at any input size
        flat[r["cell"]] = r["n"]
    return int(flat[0]), flat[1:].reshape(BITS, BITS)


def agreement(n: int, both: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Chance that two fingerprints agree on bit i, and on bits i and j, by counts of all."""
    n = max(n, 1)
    p11 = both / n
    p1 = np.diag(p11)
    p10, p01 = p1[:, None] - p11, p1[None, :] - p11
    p00 = 1 - p11 - p10 - p01
    return p1 ** 2 + (1 - p1) ** 2, p11 ** 2 + p10 ** 2 + p01 ** 2 + p00 ** 2


def bit_groups(one: np.ndarray, two: np.ndarray, m: int) -> list[list[int]]:
    """``m`` partitions of near-equal width; correlated bits share one."""
    tie = np.abs(two - np.outer(one, one))
    np.fill_diagonal(tie, 0)
    free, groups = set(range(BITS)), []
    for k in range(m):
        width = (BITS - (BITS - len(free))) // (m - k)
        own = [max(sorted(free), key=lambda b: tie[b, sorted(free)].sum())]
        free.remove(own[0])
        while len(own) < width:
            nxt = max(sorted(free), key=lambda b: tie[b, own].sum())
            own.append(nxt)
            free.remove(nxt)
        groups.append(own)
    return groups


def near_chance(group: list[int], one: np.ndarray, two: np.ndarray, most: int) -> np.ndarray:
    """Chance that two fingerprints differ in at most 0..``most`` bits of ``group``.

    Bits form a chain, each depending on the one before it."""
    state = np.zeros((most + 1, 2))  # by differing bits so far and whether the last differs
    state[0, 0] = one[group[0]]
    if most:
        state[1, 1] = 1 - one[group[0]]
    for a, b in zip(group, group[1:]):
        same = np.clip(np.array([two[a, b], one[b] - two[a, b]]), 0, 1)  # last same/differs, this same
        base = np.maximum(np.array([one[a], 1 - one[a]]), 1e-12)
        stay = np.clip(same / base, 0, 1)
        new = np.zeros_like(state)
        new[:, 0] = state @ stay
        new[1:, 1] = (state @ (1 - stay))[:-1]
        state = new
    return np.cumsum(state.sum(axis=1))


def allocate(n: int, both: np.ndarray, distance: int) -> list[tuple[list[int], int]]:
    """(bits, threshold) of each partition; thresholds add up to distance - m + 1.

    Dynamic program over partitions and threshold sums on estimated cost: candidate
    pairs plus the rows that probing sends, for each number of partitions."""
    one, two = agreement(n, both)
    best = (float("inf"), [])
    for m in range(1, distance + 2):
        groups = bit_groups(one, two, m)
        costs = []
        for g in groups:
            near = near_chance(g, one, two, distance)
            row = {-1: 0.0}
            for t in range(distance + 1):
                probes = sum(comb(len(g), k) for k in range(t + 1))
                row[t] = n * n / 2 * float(near[t]) + ROW_COST * n * (1 + probes * (t > 0))
            costs.append(row)
        table = {0: (0.0, [])}
        for row in costs:
            step: dict[int, tuple[float, list[int]]] = {}
            for total, (cost, chosen) in table.items():
                for t, c in row.items():
                    key = total + t
                    if key not in step or cost + c < step[key][0]:
                        step[key] = (cost + c, [*chosen, t])
            table = step
        cost, chosen = table[distance - m + 1]
        if cost < best[0]:
            best = (cost, list(zip(groups, chosen)))
    return best[1]


def _keys(x: np.ndarray, bits: list[int]) -> np.ndarray:
    out = np.zeros(len(x), dtype=np.uint64)
    for k, b in enumerate(bits):
        out |= (x >> np.uint64(b) & np.uint64(1)) << np.uint64(k)
    return out


def probes(fps: DataFrame, plan: list[tuple[list[int], int]]) -> DataFrame:
    """``part, key, fp, home``: where each fingerprint lies (home) and where it probes."""
    parts = [(i, bits, t) for i, (bits, t) in enumerate(plan) if t >= 0]

    def run(batches):
        for b in batches:
            for i0 in range(0, b.num_rows, 1 << 14):
                fp = b.column("fp").to_numpy(zero_copy_only=False)[i0:i0 + (1 << 14)]
                x = fp.astype(np.int64).view(np.uint64)
                for i, bits, t in parts:
                    key = _keys(x, bits)
                    for flips in range(t + 1):
                        for chosen in combinations(range(len(bits)), flips):
                            mask = np.uint64(sum(1 << c for c in chosen))
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(np.full(len(x), i, np.int32)), pa.array((key ^ mask).view(np.int64)), pa.array(fp.astype(np.int64)),
                                 pa.array(np.full(len(x), flips == 0))], names=["part", "key", "fp", "home"])

    return fps.select("fp").mapInArrow(run, "part int, key long, fp long, home boolean")


def connect(x: np.ndarray, home: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what is linked in one bucket (home with any), by search
    through what is not reached yet: each member is compared once, then dropped."""
    left, a, b = np.arange(len(x)), [], []
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            i = queue.pop()
            near = np.bitwise_count(x[left] ^ x[i]) <= distance
            if not home[i]:
                near &= home[left]
            hit = left[near]
            if len(hit):
                a += [i] * len(hit)
                b += hit.tolist()
                queue += hit.tolist()
                left = left[~near]
    return np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)


def _links(distance: int):
    """Links within runs of equal keys of sorted rows."""
    def settle(x, home, run_start, run_end):
        a, b = [], []
        size = run_end - run_start
        small = size <= 32
        lo, hi = run_start[small], run_end[small]
        if len(lo):
            owner_end = np.repeat(hi, hi - lo)
            at = _ranges(lo, hi)
            step = 1
            while len(at):
                keep = at + step < owner_end
                at, owner_end = at[keep], owner_end[keep]
                other = at + step
                ok = (np.bitwise_count(x[at] ^ x[other]) <= distance) & (home[at] | home[other])
                a.append(at[ok])
                b.append(other[ok])
                step += 1
        for s, e in zip(run_start[~small], run_end[~small]):
            i, j = connect(x[s:e], home[s:e], distance)
            a.append(i + s)
            b.append(j + s)
        return (np.concatenate(a), np.concatenate(b)) if a else (np.zeros(0, np.int64),) * 2

    def run(batches):
        rest = None
        for batch in _with_end(batches):
            if batch is None:
                now, rest = rest, None
            else:
                cols = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("part", "key", "cell", "fp", "home")]
                now = cols if rest is None else [np.concatenate(z) for z in zip(rest, cols)]
                rest = None
            if now is None or not len(now[0]):
                continue
            part, key, cell, fp, home = now
            change = np.flatnonzero((part[1:] != part[:-1]) | (key[1:] != key[:-1]) | (cell[1:] != cell[:-1])) + 1
            starts = np.concatenate([[0], change])
            ends = np.concatenate([change, [len(part)]])
            if batch is not None:  # the last run may go on
                rest = [z[starts[-1]:] for z in now]
                starts, ends = starts[:-1], ends[:-1]
            i, j = settle(fp.view(np.uint64), home.astype(bool), starts, ends)
            if len(i):
                yield pa.RecordBatch.from_arrays([pa.array(fp[i]), pa.array(fp[j])], names=["a", "b"])

    return run


def _ranges(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    n = hi - lo
    return np.arange(n.sum()) + np.repeat(lo - (np.cumsum(n) - n), n)


def _with_end(batches):
    yield from batches
    yield None


def near_links(fps: DataFrame, distance: int) -> DataFrame:
    """``a, b``: links of distinct fingerprints that connect all within ``distance``."""
    n, both = bit_counts(fps)
    rows = stored(probes(fps, allocate(n, both, distance)), "probes")
    crowded = (rows.groupBy("part", "key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > BLOCK)
               .select("part", "key", F.ceil(F.col("n") / (BLOCK // 2)).cast("int").alias("blocks")))
    rows = rows.join(crowded, ["part", "key"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    # A block meets each block once: cell (i, j) with i <= j holds both.
    cell = F.explode(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1),
                                 lambda j: F.least(j, own) * F.col("blocks") + F.greatest(j, own)))
    rows = rows.select("part", "key", cell.alias("cell"), "fp", "home")
    rows = rows.repartition("part", "key", "cell").sortWithinPartitions("part", "key", "cell")
    return rows.mapInArrow(_links(distance), "a long, b long")


def near_duplicates(docs: DataFrame, words: int = 3, distance: int = 3) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, fingerprint, component_id``.

    Reads ``doc_id`` and ``text``. Null, empty and blank texts have fingerprint zero and
    link like any other. Equal fingerprints are one component whatever their number;
    ``component_id`` is the smallest non-null id reachable. Rows repeated with one id
    stay rows. An empty table gives an empty result."""
    fps = stored(fingerprints(docs, words), "fingerprints")
    kinds = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "kinds")
    roots = components(near_links(kinds, distance))
    placed = kinds.join(roots, kinds.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    names = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    named = placed.join(names, "root").select("fp", "component_id")
    return fps.join(named, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
