import random

import numpy as np
import pytest

from memberfold.llm import oracles, top_products
from memberfold.llm.top_products import Search, Vectors, largest_products

COLUMNS = "vec_id long, embedding array<float>"


def brute(rows, k=5, every=50):
    kept = []
    for vec_id, v in rows:
        if vec_id is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        whole = [int(np.floor(256.0 * float(x))) for x in v]
        if sum(x * x for x in whole) < 1 << 62:
            kept.append((vec_id, whole))
    out = []
    for n, (query_id, q) in enumerate(kept):
        if query_id % every:
            continue
        found = [(-sum(a * b for a, b in zip(q, c)), vec_id) for m, (vec_id, c) in enumerate(kept) if m != n]
        out += [(query_id, rank + 1, vec_id, -s) for rank, (s, vec_id) in enumerate(sorted(found)[:k])]
    return sorted(out)


def answered(df, **options):
    return sorted(tuple(r) for r in largest_products(df, **options).collect())


def vectors(n, spread=0.0, dims=16, seed=1, groups=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dims))
    if groups:  # near copies
        x = x[rng.integers(0, groups, n)] + rng.normal(scale=0.02, size=(n, dims))
    x *= np.exp(spread * rng.normal(size=(n, 1)))
    return [(int(k), [float(np.float32(c)) for c in v]) for k, v in zip(rng.permutation(n), x)]


@pytest.mark.parametrize("rows", [vectors(900), vectors(900, 1.0), vectors(900, 0.3, groups=30)], ids=["even", "spread", "copies"])
@pytest.mark.parametrize("size", [1 << 20, 1500])
def test_equals_brute_force(spark, monkeypatch, rows, size):
    monkeypatch.setattr(top_products, "BUCKET_BYTES", size)
    monkeypatch.setattr(top_products, "QUERY_BYTES", size)
    monkeypatch.setattr(top_products, "STRIP", 3)
    df = spark.createDataFrame(rows, COLUMNS).repartition(3)
    assert answered(df, every=20) == brute(rows, every=20)


def test_equals_sql(spark, sql):
    rows = vectors(300, 0.5) + [(50, [0.1] * 16), (50, [0.1] * 16), (100, [0.0] * 16)]
    table = spark.createDataFrame(rows, COLUMNS)
    want = sql(oracles.largest_products(5, 50, "embedding"), embeddings=table)
    assert answered(table) == sorted(tuple(r.values()) for r in want) == brute(rows)


def test_ties_and_a_very_common_vector(spark, monkeypatch):
    monkeypatch.setattr(top_products, "BUCKET_BYTES", 1500)
    rows = vectors(400) + [(1000 + k, [0.5] * 16) for k in range(500)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, COLUMNS)
    assert answered(df) == brute(rows)
    same = [(k, [1.0, 1.0]) for k in range(120)]
    assert answered(spark.createDataFrame(same, COLUMNS)) == brute(same)


def test_vectors_that_take_no_part_and_few_candidates(spark):
    nan, inf = float("nan"), float("inf")
    odd = [(0, [1.0, 2.0]), (50, [1.0, None]), (100, None), (150, [nan, 1.0]), (200, [-inf, 1.0]), (None, [1.0, 1.0])]
    odd += [(250, [3e38, 1.0]), (3, [-0.001, -5.0]), (4, []), (5, [2.0, 1.0, 7.0]), (-50, [-1.0, -1.0]), (0, [1.0, 2.0])]
    df = spark.createDataFrame(odd, COLUMNS)
    assert answered(df) == brute(odd)
    assert answered(spark.createDataFrame([], COLUMNS)) == []
    assert answered(spark.createDataFrame([(0, [1.0])], COLUMNS)) == []
    assert answered(spark.createDataFrame([(1, [1.0])], COLUMNS)) == []
    zeros = [(0, [0.0, 0.0]), (1, [0.0, 0.0]), (2, [-1.0, 0.0])]
    assert answered(spark.createDataFrame(zeros, COLUMNS)) == brute(zeros)


def test_large_components_stay_exact(spark):
    rng = np.random.default_rng(4)
    for top in (30.0, 3e4, 1e6):
        rows = [(k, [float(np.float32(c)) for c in rng.uniform(-top, top, 5)]) for k in range(200)]
        assert answered(spark.createDataFrame(rows, COLUMNS)) == brute(rows)


def test_other_columns(spark):
    rows = [(*r, 1, 2, "x") for r in vectors(120)]
    df = spark.createDataFrame(rows, COLUMNS + ", score long, part int, chunk string")
    assert answered(df) == brute([r[:2] for r in rows])


def packed(matrix, ids):
    matrix = np.asarray(matrix, "<i4")
    squares = (matrix.astype(np.int64) ** 2).sum(axis=1).astype("<i8")
    order = np.argsort(-squares, kind="stable")
    ids = np.asarray(ids, "<i8")[order]
    return Vectors(ids.tobytes(), squares[order].tobytes(), matrix.shape[1], matrix[order].tobytes())


def test_buckets_are_pruned_by_length_and_by_coordinates(monkeypatch):
    rng = np.random.default_rng(6)
    query = packed([[100, 100, 0, 0]], [0])
    own = np.array([[9, 9, 9]], "<i8").tobytes()
    search, seen = Search(query, own, 1), []
    merge = Search._merge
    monkeypatch.setattr(Search, "_merge", lambda self, q, p, i: (seen.append(len(q)), merge(self, q, p, i)))
    search.bucket(0, 0, packed([[90, 110, 0, 0], [5, 0, 0, 0]], [1, 2]))
    assert search.found[0, 0] == 1 and search.scores[0, 0] == 20000
    # Too short for any product of that size: nothing is looked at.
    assert search.cosines(50.0)[0] > 1
    search.bucket(0, 1, packed(rng.integers(-20, 20, (50, 4)), range(10, 60)))
    assert len(seen) == 1
    # Just long enough: coordinates leave the one vector that points the same way.
    long = [[0, 0, 145, 0], [0, 145, 0, 0], [-102, -102, 0, 0], [102, 102, 0, 0]]
    search.bucket(0, 2, packed(long, [70, 71, 72, 73]))
    assert search.found[0, 0] == 73 and seen == [1, 1]
