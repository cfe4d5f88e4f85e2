"""Vector codes: trees against full comparison, the whole operator against plain rounds."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest

from callsheet.llm import vector_codes as vc

SCHEMA = "vec_id long, embedding array<double>, label int, code string, error long"


@pytest.mark.parametrize("n, width, scale", [(1, 4, 50), (5, 4, 50), (700, 4, 3), (3000, 4, 100), (2000, 1, 4), (2000, 9, 60), (500, 4, 0)])
def test_trees_against_full_comparison(n, width, scale):
    rng = np.random.default_rng(n)
    x = np.floor(rng.normal(size=(n, width)) * scale).astype(np.int64)
    x[: n // 3] = x[0]  # a third are equal
    tree, book = vc.build(x), x[rng.integers(0, n, min(n, 64))]
    assert sorted(tree.order.tolist()) == list(range(n))
    for b in range(len(tree.lo)):
        inside = tree.points[tree.lo[b]:tree.hi[b]]
        assert (inside.sum(0) == tree.sums[b]).all() and ((inside - tree.pivot[b]) ** 2).sum(1).max() == tree.radius2[b]
    d = ((x[:, None] - book[None]) ** 2).sum(2)
    code, error = vc.codes(tree, book)
    assert (code == d.argmin(1)).all() and (error == d.min(1)).all()
    sums, counts, want = np.zeros_like(book), np.zeros(len(book), np.int64), np.zeros_like(book)
    vc.entry_sums(tree, book, sums, counts)
    np.add.at(want, code, x)
    assert (sums == want).all() and (counts == np.bincount(code, minlength=len(book))).all()


def test_balls_of_apart_groups_are_owned_whole():
    rng = np.random.default_rng(5)
    middles = np.array([[i * 1000, j * 1000] for i in range(4) for j in range(4)])
    x = np.repeat(middles, 200, axis=0) + rng.integers(-20, 20, (3200, 2))
    tree = vc.build(x)
    owned, _, rest, _ = vc.settle(tree, middles)
    assert len(rest) == 0 and (tree.hi - tree.lo)[owned].sum() == 3200


def plain(rows, parts=16, entries=64, rounds=2):
    kept = sorted(((i, v, lab) for i, v, lab in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)),
                  key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return []
    width = max(1, -(-max(len(v) for _, v, _ in kept) // parts)) * parts
    x = np.array([[int(np.floor(256 * c)) for c in v] + [0] * (width - len(v)) for _, v, _ in kept], dtype=np.int64).reshape(len(kept), parts, -1)
    books = x[:entries].transpose(1, 0, 2).copy()
    near = lambda: np.array([((x[:, p, None] - books[p][None]) ** 2).sum(2) for p in range(parts)])
    for _ in range(rounds):
        best = near().argmin(2)
        for p in range(parts):
            for e in range(books.shape[1]):
                mine = x[best[p] == e, p]
                if len(mine):
                    books[p, e] = mine.sum(0) // len(mine)
    d = near()
    code, error = d.argmin(2), d.min(2).sum(0)
    sha = hashlib.sha256(",".join(map(str, books.ravel())).encode()).hexdigest()
    total = {}
    for (_, _, lab), e in zip(kept, error):
        total[lab] = total.get(lab, 0) + int(e)
    return sorted(((i, "".join(f"{c:02x}" for c in code[:, r]), int(error[r]), total[lab], sha) for r, (i, _, lab) in enumerate(kept)), key=str)


def same(spark, rows, **options):
    got = vc.compress(spark.createDataFrame([(i, v, lab, "c", 1) for i, v, lab in rows], SCHEMA), **options).collect()
    assert sorted(map(tuple, got), key=str) == plain(rows, **{k: v for k, v in options.items() if k != "block"})


def test_codes_against_plain_rounds(spark):
    rng = np.random.default_rng(7)
    rows = [(i, (rng.normal(size=32) * 0.5).tolist(), int(i % 4) if i % 5 else None) for i in range(300)]
    rows += [(500 + i, rows[0][1], 0) for i in range(200)]  # a hot vector
    rows += [(10, rows[10][1], 1), (None, rows[3][1], 2), (11, None, 1), (12, [1.0, None], 1), (13, [float("nan")] * 32, 1), (14, [float("inf")] * 32, 0), (15, [0.5, -0.25], 3), (16, [], 3)]
    same(spark, rows, block=64)


def test_few_rows_odd_widths_and_ties(spark):
    same(spark, [(i, [0.1 * (i % 3)] * 19, 0) for i in range(9)])
    same(spark, [(3, [1.0] * 16, None), (1, [1.0] * 16, None), (2, [1.0] * 16, None)])
    same(spark, [(i, [float(i % 2), -float(i % 3)], 1) for i in range(40)], parts=2, entries=5)
    same(spark, [(1, [], 0)])


def test_empty_table_and_huge_components(spark):
    assert vc.compress(spark.createDataFrame([], SCHEMA)).collect() == []
    assert vc.compress(spark.createDataFrame([(1, None, 1, "c", 1)], SCHEMA)).collect() == []
    got = vc.compress(spark.createDataFrame([(i, [1e300 * (-1) ** i] * 16, 1, "c", 1) for i in range(70)], SCHEMA)).collect()
    assert len(got) == 70 and {r.error for r in got} == {0}
