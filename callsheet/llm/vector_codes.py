"""Vector codes (one codebook entry per part of a vector) by metric trees of balls.

Vectors are stored in blocks; each block has, for every part position, a tree of balls made
middle-out: about sqrt(n) anchors are chosen, each the point farthest from its anchor, and
take over the points nearer to them; anchors are joined upwards, the cheapest ball first,
and crowded ones divided downwards the same way. Balls cache sums and counts. A round sends
all balls of a level through the codebook with the entries their parents left: an entry that
is farther than the best one for every point of the ball leaves the list, and a ball with one
entry left is owned by it as a whole. Only points of balls that stay open at the bottom meet
the remaining entries one by one.

Everything that decides is an integer; bounds are floats with a margin on the safe side.
Between rounds only sums per entry travel: entries times components, whatever the rows."""

from __future__ import annotations

import hashlib
import math
import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from callsheet.functions.stages import stored

LEAF = 64


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of ``a`` to all of ``b``."""
    return (a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None, :]


def anchors(x: np.ndarray, k: int) -> tuple[np.ndarray, int]:
    """Owner of each point among up to ``k`` anchors, and how many there are."""
    owner, dist = np.zeros(len(x), np.int64), ((x - x[0]) ** 2).sum(1)
    pivots = [0]
    while len(pivots) < k:
        far = int(dist.argmax())  # the point farthest out in the widest ball
        if dist[far] == 0:
            break
        gap = ((x[pivots] - x[far]) ** 2).sum(1)
        # A point nearer to its anchor than half the way to the new one stays.
        may = np.flatnonzero(4.0 * dist > gap[owner] * (1 - 1e-9))
        d = ((x[may] - x[far]) ** 2).sum(1)
        win = d < dist[may]
        owner[may[win]], dist[may[win]] = len(pivots), d[win]
        pivots.append(far)
    return owner, len(pivots)


def _middle_out(x: np.ndarray, idx: np.ndarray):
    """A ball is its points' places (a leaf) or a pair of balls."""
    if len(idx) <= LEAF:
        return idx
    owner, k = anchors(x[idx], math.isqrt(len(idx)))
    if k == 1:
        return idx  # equal points
    groups = np.split(idx[np.argsort(owner, kind="stable")], np.cumsum(np.bincount(owner, minlength=k))[:-1])
    balls = [_middle_out(x, g) for g in groups]
    n = np.array([len(g) for g in groups], float)
    centre = np.array([x[g].mean(0) for g in groups])
    radius = np.array([np.sqrt(((x[g] - c) ** 2).sum(1).max()) for g, c in zip(groups, centre)])

    def cost(i):
        d = np.sqrt(((centre - centre[i]) ** 2).sum(1))
        return np.maximum((d + radius + radius[i]) / 2, np.maximum(radius, radius[i]))

    price = np.array([cost(i) for i in range(k)])
    np.fill_diagonal(price, np.inf)
    for _ in range(k - 1):
        i, j = divmod(int(price.argmin()), k)
        middle = (n[i] * centre[i] + n[j] * centre[j]) / (n[i] + n[j])
        radius[i] = max(np.sqrt(((middle - centre[i]) ** 2).sum()) + radius[i], np.sqrt(((middle - centre[j]) ** 2).sum()) + radius[j])
        centre[i], n[i], balls[i] = middle, n[i] + n[j], (balls[i], balls[j])
        gone = np.isinf(price[i])
        price[i] = np.where(gone, np.inf, cost(i))
        price[i, i] = np.inf
        price[:, i] = price[i]
        price[j, :] = price[:, j] = np.inf
    return balls[i]


@dataclass
class Tree:
    """Balls over points in tree order; ball ``b`` covers ``lo[b]`` to ``hi[b]``."""

    order: np.ndarray
    points: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    children: np.ndarray  # -1, -1: a leaf
    pivot: np.ndarray
    radius2: np.ndarray
    sums: np.ndarray


def build(x: np.ndarray) -> Tree:
    leaves, lo, hi, children, depth = [], [], [], [], []
    at, stack = 0, [(_middle_out(x, np.arange(len(x))), -1, 0, 0)]
    while stack:  # a ball, its parent, which child it is, its depth
        ball, parent, side, level = stack.pop()
        me = len(lo)
        lo.append(at)
        hi.append(at)
        children.append([-1, -1])
        depth.append(level)
        if parent >= 0:
            children[parent][side] = me
        if isinstance(ball, tuple):
            stack += [(ball[1], me, 1, level + 1), (ball[0], me, 0, level + 1)]
        else:
            leaves.append(ball)
            at += len(ball)
            hi[me] = at
    children = np.array(children)
    for b in range(len(lo) - 1, -1, -1):  # children stand after their parent
        if children[b, 0] >= 0:
            hi[b] = hi[children[b, 1]]
    lo, hi, depth = np.array(lo), np.array(hi), np.array(depth)
    order = np.concatenate(leaves)
    points = x[order]
    before = np.concatenate([np.zeros((1, x.shape[1]), np.int64), np.cumsum(points, axis=0)])
    sums = before[hi] - before[lo]
    pivot, radius2 = sums // (hi - lo)[:, None], np.zeros(len(lo), np.int64)
    for level in range(int(depth.max()) + 1):  # balls of one depth have no point in common
        at = np.flatnonzero(depth == level)
        size = hi[at] - lo[at]
        rows = np.repeat(lo[at] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        radius2[at] = np.maximum.reduceat(((points[rows] - np.repeat(pivot[at], size, axis=0)) ** 2).sum(1), np.cumsum(size) - size)
    return Tree(order, points, lo, hi, children, pivot, radius2, sums)


def settle(tree: Tree, book: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Nearest entry (ties: the lowest) of all points: owned balls with their entries, and
    places of the remaining points with theirs."""
    k = len(book)
    gap = np.sqrt(_squares(book, book).astype(float))
    balls, left = np.zeros(1, np.int64), np.ones((1, k), bool)
    owned, owner, rest, nearest = [], [], [], []
    far = np.iinfo(np.int64).max
    while len(balls):
        d = np.where(left, _squares(tree.pivot[balls], book), far)
        best = d.argmin(1)
        more = np.where(left, d - d[np.arange(len(balls)), best][:, None], 0).astype(float)
        radius, apart = np.sqrt(tree.radius2[balls].astype(float))[:, None], gap[best]
        # Farther than the best one for each point of the ball; equal entries and single places: the lowest stays.
        out = (more > 2 * radius * apart * (1 + 1e-9)) | (((apart == 0) | (radius == 0)) & (np.arange(k) != best[:, None]))
        left = left & ~out
        alone = left.sum(1) == 1
        owned.append(balls[alone])
        owner.append(best[alone])
        balls, left = balls[~alone], left[~alone]
        leaf = tree.children[balls, 0] < 0
        if leaf.any():
            at, size = balls[leaf], (tree.hi - tree.lo)[balls[leaf]]
            rows = np.repeat(tree.lo[at] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            rest.append(rows)
            nearest.append(np.where(np.repeat(left[leaf], size, axis=0), _squares(tree.points[rows], book), far).argmin(1))
        balls, left = tree.children[balls[~leaf]].ravel(), np.repeat(left[~leaf], 2, axis=0)
    whole = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return whole(owned), whole(owner), whole(rest), whole(nearest)


def entry_sums(tree: Tree, book: np.ndarray, sums: np.ndarray, counts: np.ndarray) -> None:
    """Add the points of each entry to ``sums`` and ``counts``; owned balls add what they cache."""
    owned, owner, rest, nearest = settle(tree, book)
    np.add.at(sums, owner, tree.sums[owned])
    np.add.at(counts, owner, (tree.hi - tree.lo)[owned])
    np.add.at(sums, nearest, tree.points[rest])
    counts += np.bincount(nearest, minlength=len(book))


def codes(tree: Tree, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entry and squared distance of each point, in the points' own order."""
    owned, owner, rest, nearest = settle(tree, book)
    entry = np.empty(len(tree.order), np.int64)
    size = (tree.hi - tree.lo)[owned]
    entry[np.repeat(tree.lo[owned] - (np.cumsum(size) - size), size) + np.arange(size.sum())] = np.repeat(owner, size)
    entry[rest] = nearest
    code, error = np.empty_like(entry), np.empty_like(entry)
    code[tree.order], error[tree.order] = entry, ((tree.points - book[entry]) ** 2).sum(1)
    return code, error


def limit(width: int) -> int:
    """Largest component: squared distances of vectors of ``width`` then fit a long."""
    return math.isqrt((1 << 61) // width)


def integers(vectors: pa.ListArray, width: int, scale: int) -> np.ndarray:
    """floor(scale * x) of each component, zeros after a vector's end."""
    flat = np.floor(vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale)
    size = np.diff(vectors.offsets.to_numpy())
    out = np.zeros((len(size), width), np.int64)
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = np.clip(flat, -limit(width), limit(width))
    return out


def compress(vectors: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256, block: int = 4096) -> DataFrame:
    """One row per kept row: ``vec_id, code, error, label_error, codebooks_sha256``.

    Reads ``vec_id``, ``embedding`` and ``label``. Rows whose vector is null or holds null or
    non-finite components are left out. Vectors shorter than the longest, or than a multiple
    of ``parts``, are read as ending in zeros; integer components beyond ``limit`` are held
    there. The first codebooks are the parts of the smallest ids (null ids last, rows of one
    id by vector); fewer rows than ``entries`` make smaller codebooks. Rows repeated with one
    id stay rows and count each; null labels share one sum. An empty table gives an empty result."""
    if entries > 256:
        raise ValueError("a code has two hex digits a part")
    spark = vectors.sparkSession
    good = vectors.select("vec_id", "embedding", "label").filter(
        "embedding is not null and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))")
    longest = good.agg(F.max(F.size("embedding")).alias("n")).first()["n"]
    kinds = {f.name: f.dataType.simpleString() for f in good.schema}
    if longest is None:
        return spark.createDataFrame([], f"vec_id {kinds['vec_id']}, code string, error long, label_error long, codebooks_sha256 string")
    part = max(1, -(-longest // parts))
    width = part * parts

    def grow(batches):
        for b in batches:
            for lo in range(0, b.num_rows, block):
                piece = b.slice(lo, block)
                n = piece.num_rows
                x = integers(pa.concat_arrays([piece.column("embedding")]), width, scale)
                trees = [build(np.ascontiguousarray(x[:, p * part:(p + 1) * part])) for p in range(parts)]
                rows = pa.array([0, n], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.ListArray.from_arrays(rows, pa.concat_arrays([piece.column(c)])) for c in ("vec_id", "label")]
                    + [pa.array([pickle.dumps(t)], pa.binary()) for t in trees], names=["vec_ids", "labels", *names])

    names = [f"tree_{p}" for p in range(parts)]
    blocks = stored(good.mapInArrow(grow, f"vec_ids array<{kinds['vec_id']}>, labels array<{kinds['label']}>, " + ", ".join(f"{c} binary" for c in names)), "vector_balls")
    first = good.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(entries).select("embedding").toArrow().column("embedding").combine_chunks()
    start = integers(first, width, scale)
    books = [start[:, p * part:(p + 1) * part].copy() for p in range(parts)]

    def gather(batches):
        sums, counts = np.zeros((parts, len(start), part), np.int64), np.zeros((parts, len(start)), np.int64)
        for b in batches:
            for p, c in enumerate(names):
                for tree in b.column(c):
                    entry_sums(pickle.loads(tree.as_py()), books[p], sums[p], counts[p])
        at, entry = np.nonzero(counts)
        flat = sums[at, entry]
        yield pa.RecordBatch.from_arrays(
            [pa.array(at, pa.int32()), pa.array(entry, pa.int32()), pa.array(counts[at, entry]),
             pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1) * part, pa.int32()), pa.array(flat.ravel()))], names=["part", "entry", "n", "sums"])

    for _ in range(rounds):
        # At most parts x entries x components rows come back, at any size of the table.
        totals = (blocks.select(*names).mapInArrow(gather, "part int, entry int, n long, sums array<long>")
                  .select("part", "entry", "n", F.posexplode("sums").alias("place", "v"))
                  .groupBy("part", "entry", "place").agg(F.sum("n").alias("n"), F.sum(F.col("v").cast("decimal(38,0)")).alias("v"))).collect()
        books = [b.copy() for b in books]
        for r in totals:
            books[r["part"]][r["entry"], r["place"]] = int(r["v"]) // r["n"]

    def assign(batches):
        for b in batches:
            for i in range(b.num_rows):
                trees = [pickle.loads(b.column(c)[i].as_py()) for c in names]
                got = [codes(t, book) for t, book in zip(trees, books)]
                text = np.stack([c for c, _ in got], axis=1).astype(np.uint8).tobytes().hex()
                n = len(trees[0].order)
                yield pa.RecordBatch.from_arrays(
                    [b.column("vec_ids").slice(i, 1).flatten(), pa.array([text[2 * parts * r:2 * parts * (r + 1)] for r in range(n)]),
                     pa.array(sum(e for _, e in got)), b.column("labels").slice(i, 1).flatten()], names=["vec_id", "code", "error", "label"])

    coded = stored(blocks.mapInArrow(assign, f"vec_id {kinds['vec_id']}, code string, error long, label {kinds['label']}"), "vector_codes")
    sums = coded.groupBy(F.col("label").alias("same")).agg(F.try_sum(F.col("error").cast("decimal(38,0)")).try_cast("long").alias("label_error"))
    digest = hashlib.sha256(",".join(str(v) for b in books for row in b.tolist() for v in row).encode()).hexdigest()
    return (coded.join(sums, F.col("label").eqNullSafe(F.col("same")))
            .select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256")))
