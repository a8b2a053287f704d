import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from linkweave.llm import topk


def brute(rows, every, k):
    used = [
        (i, [math.floor(256 * float(x)) for x in v]) for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for q, (qi, qv) in enumerate(used):
        if qi % every:
            continue
        found = sorted(
            (-sum(a * b for a, b in zip(qv, v)), i) for c, (i, v) in enumerate(used) if c != q
        )[:k]
        out += [(qi, rank, i, -s) for rank, (s, i) in enumerate(found, 1)]
    return sorted(out)


def run(spark, rows, every=5, k=5):
    df = spark.createDataFrame(
        [(i, v, 1, 2.0) for i, v in rows], "vec_id long, embedding array<float>, rank int, uid double"
    )
    got = topk.top_k(df, F.col("vec_id") % every == 0, k).collect()
    return sorted(tuple(r) for r in got)


def floats(v):
    return np.array(v, np.float32).astype(float).tolist()


def vectors(n, dims=16, seed=0):
    rng = random.Random(seed)
    return [(i, floats([rng.gauss(0, 0.2) for _ in range(dims)])) for i in range(n)]


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 64)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 16)
    monkeypatch.setattr(topk, "AT_ONCE", 7)


def test_against_brute_force(spark, small_blocks):
    rows = vectors(400)
    assert run(spark, rows) == brute(rows, 5, 5)


def test_ties_repeated_and_unusable_rows(spark, small_blocks):
    same = floats([0.1, -0.2, 0.3])
    rows = [(i, same) for i in range(100)] + [
        (5, same), (100, None), (105, [0.1, None, 0.2]), (110, [float("nan"), 0.0, 1.0]),
        (115, [float("inf"), 0.0, 0.0]), (None, same), (120, []), (125, floats([0.5])), (130, floats([0.0, 0.0, 0.0])),
    ]
    assert run(spark, rows) == brute(rows, 5, 5)


def test_few_rows_and_none(spark):
    assert run(spark, []) == []
    rows = [(0, [0.5, 0.5]), (1, [1.0, -1.0])]
    assert run(spark, rows) == [(0, 1, 1, 0)] == brute(rows, 5, 5)


def test_large_components(spark):
    rows = [(i, floats([1e4 * (i + 1), -3e3, 7.0])) for i in range(30)]
    assert run(spark, rows) == brute(rows, 5, 5)


def test_early_stop_is_proven():
    """With a clear winner some queries stop early, and the possible ones hold the best."""
    rng = np.random.default_rng(3)
    vectors = rng.integers(-80, 80, (3000, 32))
    queries = vectors[:20] * 2
    index = topk.ImpactIndex(vectors)
    own = np.full(20, -1)
    for q, can in zip(queries, index.possible(queries, own, 5), strict=True):
        best = set(np.argsort(-(vectors @ q), kind="stable")[:5].tolist())
        assert best <= set(can.tolist())
        assert len(can) < len(vectors)


def test_registered_query(spark):
    from linkweave.llm.queries import QUERIES

    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").select("vec_id", "embedding").collect()]
    got = sorted(tuple(r) for r in QUERIES["op4_impact_top_k"](spark, "/root/testdata/sf0.001").collect())
    assert got == brute(rows, 50, 5)
