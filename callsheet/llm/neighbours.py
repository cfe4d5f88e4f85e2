"""Approximate nearest neighbours by largest inner product: NN-descent and greedy search.

Equal vectors are one node. Every node first gets neighbours from a few random trees
(range-partitioned by a random projection, split to small leaves in the task). Rounds of
NN-descent then compare the neighbours of each node with one another: Spark joins the
lists and brings each cell of nodes the distinct vectors it needs, once. Queries walk
the finished graph, always expanding their best nodes, until nothing better is found.

For vectors of unequal length one more component makes all lengths equal, so that the
graph joins vectors that are near by inner product. Vectors are compared in single
precision whatever their lengths; what is returned is in double precision."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from callsheet.functions.stages import stored

#: Rows that one tree task holds, nodes that one leaf compares, nodes of one descent cell.
TREE_ROWS, LEAF, CELL = 8192, 192, 1024


def dot(a: Column, b: Column) -> Column:
    """Inner product in double precision."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, vector`` (doubles) without null, zero, null-holding or non-finite vectors and
    null ids; of several dimensions the most frequent one. Equal rows are one."""
    v = F.col("embedding").cast("array<double>")
    rows = vectors.select("vec_id", v.alias("vector")).filter("vec_id is not null and size(vector) > 0")
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.filter(~bad).filter(F.exists("vector", lambda x: x != 0))
    sizes = rows.groupBy(F.size("vector").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").first()
    return rows.filter(F.size("vector") == (sizes["d"] if sizes else 0)).distinct()


def _matrix(column) -> np.ndarray:
    """Rows of packed vectors."""
    parts = list(column)
    return np.frombuffer(b"".join(parts), np.float32).reshape(len(parts), -1) if parts else np.zeros((0, 1), np.float32)


def nearness(x: np.ndarray) -> np.ndarray:
    """Inner products of packed rows, lengthened to norm one, less one: with the component
    1 - e they are xy - e - e' + ee', which keeps its precision however short x and y are."""
    return x @ x.T - x[:, -1:] - x[:, -1]


def packed(nodes: DataFrame, longest: float, trees: int, seed: int) -> DataFrame:
    """``id, vec`` (divided by the longest norm; then ``e``, what the component that lengthens
    it to norm one is short of one) and a random projection for each tree."""
    def run(batches):
        for b in batches:
            x = np.array(b.column("vector").to_pylist(), dtype=np.float64).reshape(b.num_rows, -1) / longest
            square = (x ** 2).sum(axis=1)
            x = np.column_stack([x, square / (1 + np.sqrt(np.maximum(1 - square, 0)))])
            p = x @ np.random.default_rng(seed).normal(size=(x.shape[1], trees))
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array([r.tobytes() for r in x.astype(np.float32)], pa.binary()), *[pa.array(p[:, t]) for t in range(trees)]],
                                             names=["id", "vec", *[f"p{t}" for t in range(trees)]])

    return nodes.mapInArrow(run, "id long, vec binary, " + ", ".join(f"p{t} double" for t in range(trees)))


def _dots(batches):
    for b in batches:
        s = np.einsum("ij,ij->i", _matrix(b.column("vec").to_pylist()), _matrix(b.column("qvec").to_pylist()))
        yield pa.RecordBatch.from_arrays([b.column("q"), b.column("id"), pa.array(s.astype(np.float32)), pa.array(np.zeros(len(s), bool))], names=["q", "id", "s", "done"])


def leaves(x: np.ndarray, most: int, rng) -> list[np.ndarray]:
    """Row numbers of the leaves of a random hyperplane tree."""
    out, todo = [], [np.arange(len(x))]
    while todo:
        rows = todo.pop()
        if len(rows) <= most:
            out.append(rows)
            continue
        a, b = x[rows[rng.integers(len(rows))]], x[rows[rng.integers(len(rows))]]
        side = x[rows] @ (a - b)
        middle = np.median(side)
        left = side < middle
        if not left.any() or left.all():
            left = np.arange(len(rows)) < len(rows) // 2
        todo += [rows[~left], rows[left]]
    return out


def tree_edges(points: DataFrame, tree: int, parts: int, k: int) -> DataFrame:
    """``u, v, s, cell``: the nearest of each node in its leaf, and a cell of near nodes."""
    def run(batches):
        ids, vecs = [], []
        for b in batches:
            ids.append(b.column("id").to_numpy(zero_copy_only=False))
            vecs.append(_matrix(b.column("vec").to_pylist()))
        if not ids or not sum(map(len, ids)):
            return
        ids, x = np.concatenate(ids), np.concatenate([v for v in vecs if len(v)])
        task = TaskContext.get().partitionId()
        cell, held = task << 24, 0
        for rows in leaves(x, LEAF, np.random.default_rng(1000 * tree + task)):
            if held + len(rows) > CELL:
                cell, held = cell + 1, 0
            held += len(rows)
            s = nearness(x[rows])
            np.fill_diagonal(s, -np.inf)
            n = min(k, len(rows) - 1)
            if n == 0:  # alone in its leaf: a row for its cell only
                yield pa.RecordBatch.from_arrays([pa.array(ids[rows]), pa.array(ids[rows]), pa.array(np.full(len(rows), -1e9, np.float32)), pa.array(np.full(len(rows), cell))], names=["u", "v", "s", "cell"])
                continue
            near = np.argpartition(-s, n - 1, axis=1)[:, :n]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(ids[rows], n)), pa.array(ids[rows][near].ravel()), pa.array(np.take_along_axis(s, near, 1).ravel().astype(np.float32)),
                 pa.array(np.full(len(rows) * n, cell, np.int64))], names=["u", "v", "s", "cell"])

    rows = points.select("id", "vec", f"p{tree}").repartitionByRange(parts, f"p{tree}", "id")
    return rows.select("id", "vec").mapInArrow(run, "u long, v long, s float, cell long")


def best(edges: DataFrame, k: int) -> DataFrame:
    """The ``k`` nearest of each node; an edge met before is not fresh."""
    once = edges.groupBy("u", "v").agg(F.max("s").alias("s"), F.min("fresh").alias("fresh"))
    order = Window.partitionBy("u").orderBy(F.desc("s"), "v")
    return once.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= k).drop("r")


def both_ways(graph: DataFrame, k: int) -> DataFrame:
    """``x, m, fresh``: neighbours of each node and up to ``k`` nodes it is a neighbour of."""
    order = Window.partitionBy("x").orderBy(F.desc("fresh"), F.xxhash64("m", "x"))
    back = (graph.select(F.col("v").alias("x"), F.col("u").alias("m"), "fresh")
            .withColumn("r", F.row_number().over(order)).filter(F.col("r") <= k).drop("r"))
    return graph.select(F.col("u").alias("x"), F.col("v").alias("m"), "fresh").unionByName(back).groupBy("x", "m").agg(F.max("fresh").alias("fresh"))


def _join_cell(k: int):
    def run(lists: pd.DataFrame, nodes: pd.DataFrame) -> pd.DataFrame:
        """Compare the neighbours of each node with one another; keep what improves."""
        nodes = nodes.sort_values("id")
        ids, x, floor = nodes["id"].to_numpy(np.int64), _matrix(nodes["vec"]), nodes["floor"].to_numpy(np.float32)
        u, v, s = [], [], []
        for members, fresh in zip(lists["members"], lists["fresh"]):
            at = np.searchsorted(ids, np.asarray(members, np.int64))
            new = np.asarray(fresh, bool)
            sims = nearness(x[at])
            ok = (new[:, None] | new[None, :]) & (sims > floor[at][:, None])
            np.fill_diagonal(ok, False)
            i, j = np.nonzero(ok)
            u.append(at[i])
            v.append(at[j])
            s.append(sims[i, j])
        if not u:
            return pd.DataFrame({"u": [], "v": [], "s": []})
        u, v, s = np.concatenate(u), np.concatenate(v), np.concatenate(s)
        _, first = np.unique(u * len(ids) + v, return_index=True)
        u, v, s = u[first], v[first], s[first]
        order = np.lexsort([-s, u])
        u, v, s = u[order], v[order], s[order]
        rank = np.arange(len(u)) - np.searchsorted(u, u, side="left")
        keep = rank < k
        return pd.DataFrame({"u": ids[u[keep]], "v": ids[v[keep]], "s": s[keep]})

    return run


def descend(points: DataFrame, k: int, trees: int, rounds: int, count: int) -> DataFrame:
    """The neighbour graph ``u, v, s, fresh`` with ``k`` neighbours a node."""
    parts = max(1, -(-count // TREE_ROWS))
    first = stored(tree_edges(points, 0, parts, k), "tree")
    cells = first.groupBy(F.col("u").alias("id")).agg(F.min("cell").alias("cell"))
    nodes = stored(points.select("id", "vec").join(cells, "id"), "nodes")
    edges = first.drop("cell")
    for t in range(1, trees):
        edges = edges.unionByName(tree_edges(points, t, parts, k).drop("cell"))
    graph = stored(best(edges.filter("u <> v").withColumn("fresh", F.lit(True)), k), "graph")
    for _ in range(rounds):
        pairs = both_ways(graph, k)
        lists = pairs.groupBy("x").agg(F.collect_list(F.struct("m", "fresh")).alias("all"), F.max("fresh").alias("any"))  # at most 2k of a node
        lists = lists.filter("any").join(nodes.select(F.col("id").alias("x"), "cell"), "x")
        lists = lists.select("cell", F.expr("array_append(all.m, x)").alias("members"), F.expr("array_append(all.fresh, false)").alias("fresh"))
        lists = stored(lists, "lists")
        floor = graph.groupBy(F.col("u").alias("id")).agg(F.when(F.count(F.lit(1)) >= k, F.min("s")).alias("floor"))
        known = nodes.select("id", "vec").join(floor, "id", "left").select("id", "vec", F.coalesce("floor", F.lit(-1e9)).cast("float").alias("floor"))
        needed = lists.select(F.col("cell").alias("in_cell"), F.explode("members").alias("id")).distinct().join(known, "id")
        found = lists.groupBy("cell").cogroup(needed.groupBy("in_cell")).applyInPandas(_join_cell(k), "u long, v long, s float")
        grown = graph.withColumn("fresh", F.lit(False)).unionByName(found.withColumn("fresh", F.lit(True)))
        graph = stored(best(grown, k), "graph")
        if graph.filter("fresh").limit(max(1, count * k // 1000)).count() < max(1, count * k // 1000):
            break
    return graph


def nearest(vectors: DataFrame, every: int = 20, k: int = 20, degree: int = 32, trees: int = 6, rounds: int = 8, beam: int = 192, expand: int = 32, seed: int = 5) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found of each query.

    Reads ``vec_id`` and ``embedding``. Queries are the ids divisible by ``every``;
    candidates are all other rows. Vectors that are null, zero or hold a null or
    non-finite component take no part, nor do null ids and vectors of another dimension
    than the most frequent. Nearest first, ties to the smaller id; a row repeated whole
    counts once. Fewer candidates than ``k``: all of them. Empty: an empty result.

    The beam grows with the logarithm of the table, and a walk goes on until all that is in
    it has been opened."""
    rows = stored(usable(vectors), "vectors")
    nodes = stored(rows.groupBy("vector").agg(F.min("vec_id").alias("id")), "distinct")
    stats = nodes.agg(F.count(F.lit(1)).alias("n"), F.max(F.sqrt(dot(F.col("vector"), F.col("vector")))).alias("longest")).first()
    empty = "query_id long, rank int, vec_id long, score double"
    if not stats["n"]:
        return vectors.sparkSession.createDataFrame([], empty)
    points = stored(packed(nodes.select("id", "vector"), stats["longest"], trees, seed), "points")
    graph = descend(points, degree, trees, rounds, stats["n"])
    ways = stored(both_ways(graph, degree).select("x", "m"), "ways")
    placed = rows.join(nodes, "vector").select("vec_id", "id", "vector")
    queries = stored(placed.filter(F.col("vec_id") % every == 0), "queries")
    code = points.select("id", "vec")
    own = queries.select(F.col("vec_id").alias("q"), "id")
    # A query has no lengthening component: its product with a node is the inner product.
    asked = stored(own.join(code, "id").select("q", F.expr("concat(substr(vec, 1, length(vec) - 4), X'00000000')").alias("qvec")), "asked")

    def scored(pairs: DataFrame) -> DataFrame:
        return pairs.join(code, "id").join(asked, "q").select("q", "id", "vec", "qvec").mapInArrow(_dots, "q long, id long, s float, done boolean")

    # The longest nodes are far from all others in the graph, but may have the largest products with any query.
    beam = max(beam, 12 * stats["n"].bit_length())
    longest = [r["id"] for r in nodes.orderBy(F.desc(dot(F.col("vector"), F.col("vector"))), "id").limit(beam).select("id").collect()]
    start = own.join(ways, own.id == ways.x).select("q", F.col("m").alias("id")).unionByName(own)
    start = start.unionByName(own.select("q", F.explode(F.array(*map(F.lit, longest))).alias("id"))).distinct()
    seen = stored(scored(start), "beam")
    order = Window.partitionBy("q").orderBy(F.desc("s"), "id")
    while True:  # each hop opens nodes that were never open, until the beam holds none
        ranked = seen.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= beam)
        todo = Window.partitionBy("q", "done").orderBy("r")
        ranked = stored(ranked.withColumn("t", F.row_number().over(todo)).withColumn("go", ~F.col("done") & (F.col("t") <= expand)).drop("t", "r"), "beam")
        front = ranked.filter("go").select("q", "id")
        if front.isEmpty():
            break
        reached = front.join(ways, front.id == ways.x).select("q", F.col("m").alias("id")).distinct().join(ranked.select("q", "id"), ["q", "id"], "left_anti")
        seen = stored(ranked.select("q", "id", "s", (F.col("done") | F.col("go")).alias("done")).unionByName(scored(reached)), "beam")
    vector = nodes.select("id", "vector")
    near = seen.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= 3 * k).select("q", "id")
    exact = (near.join(vector, "id").join(queries.select(F.col("vec_id").alias("q"), F.col("vector").alias("qv")), "q")
             .select("q", "id", dot(F.col("vector"), F.col("qv")).alias("s")))
    # Each node found stands for all rows with its vector; the k + 1 smallest ids suffice.
    few = Window.partitionBy("id").orderBy("vec_id")
    members = placed.select("id", "vec_id").withColumn("r", F.row_number().over(few)).filter(F.col("r") <= k + 1).select("id", "vec_id")
    last = Window.partitionBy("q").orderBy(F.desc("s"), "vec_id")
    return (exact.join(members, "id").filter("vec_id <> q").withColumn("rank", F.row_number().over(last)).filter(F.col("rank") <= k)
            .select(F.col("q").alias("query_id"), "rank", "vec_id", F.col("s").alias("score")))
