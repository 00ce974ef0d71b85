import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from touchtrail.llm import topk

SCHEMA = "vec_id bigint, embedding array<float>, row int, v string, is_query string, rank int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", "y", 2) for i, v in rows], SCHEMA).repartition(3)


def expected(rows, top):
    """Scores of each query with all other rows, one at a time in whole numbers."""
    ints = []
    for i, v in rows:
        if v is not None and all(x is not None and math.isfinite(x) for x in v):
            ints.append((i, [math.floor(256 * float(np.float32(x))) for x in v]))
    out = []
    for k, (q, a) in enumerate(ints):
        if q is None or q % 50:
            continue
        scored = [(-sum(x * y for x, y in zip(a, b)), math.inf if i is None else i) for n, (i, b) in enumerate(ints) if n != k]
        out += [(q, r + 1, None if i == math.inf else i, -s) for r, (s, i) in enumerate(sorted(scored)[:top])]
    return Counter(out)


def vectors(seed, n, width, spread):
    rng = np.random.default_rng(seed)
    scale = rng.lognormal(0, spread, n)[:, None]
    return [(int(k), [float(x) for x in v]) for k, v in enumerate((rng.normal(size=(n, width)) * scale).astype(np.float32))]


@pytest.mark.parametrize("block_bytes", [8 * 3, topk.QUERY_BLOCK_BYTES])
def test_equals_brute_force(spark, monkeypatch, block_bytes):
    """Ties, repeated rows and ids, short, empty and unusable vectors; queries in one and many blocks."""
    monkeypatch.setattr(topk, "QUERY_BLOCK_BYTES", block_bytes)
    rows = vectors(1, 60, 6, 1.0)
    rows += [(1000 + k, [0.5] * 6) for k in range(12)] + [(0, [0.5] * 6), (50, [0.5] * 6), (50, [0.5] * 6)]
    rows += [(100, None), (150, [1.0, None]), (150, [float("nan")] * 6), (200, [float("inf")] * 6)]
    rows += [(250, [2.0, -1.0]), (300, []), (None, [3.0] * 6), (None, [0.5] * 6), (-50, [-0.1] * 6)]
    found = topk.exact_top_k(frame(spark, rows), F.col("vec_id") % 50 == 0)
    assert Counter(map(tuple, found.collect())) == expected(rows, 5)


def test_few_candidates_and_none(spark):
    rows = [(0, [1.0]), (1, [2.0]), (2, [-2.0])]
    assert Counter(map(tuple, topk.exact_top_k(frame(spark, rows), F.col("vec_id") % 50 == 0).collect())) == expected(rows, 5)
    assert topk.exact_top_k(frame(spark, rows[1:]), F.col("vec_id") % 50 == 0).count() == 0
    assert topk.exact_top_k(frame(spark, rows[:0]), F.col("vec_id") % 50 == 0).count() == 0


def test_bounds_leave_most_pairs_out():
    rng = np.random.default_rng(2)
    low_rank = rng.normal(size=(3000, 4)) @ rng.normal(size=(4, 32)) * rng.lognormal(0, 1, 3000)[:, None]
    m = np.floor(256 * low_rank).astype(np.int64)
    m = m[np.argsort(-(m.astype(float) ** 2).sum(1))]
    basis = np.linalg.eigh(m.T.astype(float) @ m)[1][:, ::-1]
    queries = topk._Queries(np.arange(10) - 100, m[::300], np.full(10, -np.inf), basis, 5)
    exact = sum(len(queries.meet(np.arange(3000)[a : a + 200], m[a : a + 200])[0]) for a in range(0, 3000, 200))
    assert exact < 3000
    best = np.sort(m[::300] @ m.T, axis=1)[:, ::-1][:, :5]
    assert (queries.best == best).all()


def test_large_values_stay_exact(spark):
    rows = [(0, [2.0**20, 1.0]), (1, [2.0**20, 3.0]), (2, [2.0**20, 2.0])]
    found = topk.exact_top_k(frame(spark, rows), F.col("vec_id") == 0, scale=2.0**14)
    want = [(0, 1, 1, 2**68 + 3 * 2**28), (0, 2, 2, 2**68 + 2 * 2**28)]
    assert [(r.query_id, r.rank, r.vec_id) for r in found.orderBy("rank").collect()] == [w[:3] for w in want]
