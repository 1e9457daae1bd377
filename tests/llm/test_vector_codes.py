import hashlib
import math

import numpy as np
import pytest

from corpusflow.llm import vector_codes as V
from corpusflow.llm.q_llm import QUERIES


def brute(rows, entries=256, rounds=4):
    """Codes and errors by row number, and the codebooks, measuring every part against every entry."""
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    dim = len(rows[0][1])
    width = -(-dim // 4)
    x = np.zeros((len(rows), 4 * width), dtype=np.int64)
    x[:, :dim] = [[math.floor(1024 * c) for c in r[1]] for r in rows]
    x = x.reshape(-1, 4, width)
    codes, error, books = np.zeros((len(rows), 4), dtype=int), np.zeros(len(rows), dtype=np.int64), []
    for p in range(4):
        book = x[:entries, p].copy()
        for turn in range(rounds + 1):
            d = ((x[:, p, None, :] - book[None]) ** 2).sum(axis=2)
            at = d.argmin(axis=1)
            if turn < rounds:
                for e in np.unique(at):
                    book[e] = x[at == e, p].sum(axis=0) // (at == e).sum()
        codes[:, p] = at
        error += d.min(axis=1)
        books.append(book)
    return rows, ["".join(f"{c:02x}" for c in r) for r in codes], error.tolist(), np.array(books)


def test_query_equals_brute_force(spark, sf):
    table = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    rows, codes, error, books = brute(table)
    sums = {}
    for r, e in zip(rows, error):
        sums[r[2]] = sums.get(r[2], 0) + e
    digest = hashlib.sha256(",".join(str(v) for p in books for e in p for v in e).encode()).hexdigest()
    want = sorted((r[0], c, e, sums[r[2]], digest) for r, c, e in zip(rows, codes, error))
    got = QUERIES["op13_hilbert_codes"](spark, sf).select("vec_id", "code", "error", "label_error", "codebooks_sha256")
    assert sorted(map(tuple, got.collect())) == want


def test_short_lists_hold_the_nearest_entry():
    rng = np.random.default_rng(1)
    book = rng.integers(-50, 50, size=(40, 5))
    points = rng.integers(-9, 9, size=(200, 5)) + rng.integers(-40, 40, size=(20, 5)).repeat(10, axis=0)
    ends = np.arange(0, 201, 10)
    blocks = points.reshape(20, 10, 5)
    low, high = blocks.min(axis=1), blocks.max(axis=1)
    lists = V.short_lists(low, high, book)
    d = ((points[:, None] - book[None]) ** 2).sum(axis=2)
    assert lists.repeat(10, axis=0)[np.arange(200), d.argmin(axis=1)].all() and lists.sum() < lists.size / 2
    code, dist = V.assign(points, low, high, ends, book)
    assert (code == d.argmin(axis=1)).all() and (dist == d.min(axis=1)).all()


def test_kernels_are_exact_for_large_values():
    rng = np.random.default_rng(2)
    points, book = rng.integers(-(1 << 27), 1 << 27, size=(50, 3)), rng.integers(-(1 << 27), 1 << 27, size=(9, 3))
    at, d = V.nearest(points, book)
    want = [[sum((int(a) - int(b)) ** 2 for a, b in zip(p, c)) for c in book] for p in points]
    assert at.tolist() == [w.index(min(w)) for w in want] and d.tolist() == [min(w) for w in want]


@pytest.mark.parametrize("width", [1, 2, 3])
def test_hilbert_neighbours_are_neighbours(width):
    """On a full grid the curve visits every cell once and each step changes one component by one."""
    side = 8 if width > 1 else 64
    grid = np.stack(np.meshgrid(*[np.arange(side)] * width, indexing="ij"), axis=-1).reshape(-1, width)
    bits = max(1, min(16, 63 // width))
    scale = (1 << bits) - 1
    key = V.hilbert_keys(grid * (1 << bits) // side, np.zeros(width, dtype=np.int64), np.full(width, scale))
    assert len(set(key.tolist())) == len(grid)
    walk = grid[np.argsort(key)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [(i, [i / 7, -i / 3, 0.5, 1.0, 2.0 * (i % 3), 0.0], "ab"[i % 2]) for i in range(12)]
    odd = [(3, good[3][1], "b"), (None, good[5][1], None), (20, None, "a"), (21, [nan] * 6, "a"), (22, [1.0, inf, 0.0, 0.0, 0.0, 0.0], "a"),
           (23, [1.0, None, 0.0, 0.0, 0.0, 0.0], "a"), (24, [1.0], "b"), (25, [], "b"), (26, [1e30, -1e30, 0.0, 0.0, 0.0, 0.0], None)]
    df = spark.createDataFrame(good + odd, "vec_id long, embedding array<double>, label string").repartition(3)
    out, books = V.compress(df, entries=5)
    rows = V.with_label_error(out, "label").collect()
    assert sorted(str(r.vec_id) for r in rows) == sorted(str(i) for i in [*range(12), 3, None, 24, 25, 26])
    by = {}
    for r in rows:
        by.setdefault(r.vec_id, []).append((r.code, r.error, r.label))
    assert by[24] == [(None, None, "b")] and by[25] == [(None, None, "b")]
    assert by[3][0] == by[3][1] and by[None][0][0] == by[5][0][0]
    assert books.shape == (4, 5, 2)
    top = V.limit(2)
    assert abs(V.parts_of(np.array([[1e30, -1e30, 0, 0, 0, 0]]))).max() == top
    total = {}
    for r in rows:
        total[r.label] = total.get(r.label, 0) + (r.error or 0)
    assert all(r.label_error == total[r.label] for r in rows)
    assert V.compress(df.filter("false"))[0].count() == 0


def test_partitioning_changes_nothing(spark, sf, rows_of):
    df = spark.read.parquet(f"{sf}/embeddings.parquet")
    one, a = V.compress(df.coalesce(1))
    many, b = V.compress(df.repartition(9))
    assert (a == b).all() and rows_of(one) == rows_of(many)
