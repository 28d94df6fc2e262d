import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.llm import topk
from tickloom.llm.queries import op9_top_k, table

SF = "/root/testdata/sf0.001"


def brute(rows, is_query, k):
    good = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            good[i] = [math.floor(256 * float(np.float32(x))) for x in v]
    out = []
    for q in filter(is_query, good):
        scores = sorted(
            (-sum(a * b for a, b in zip(good[q], v, strict=True)), i)
            for i, v in good.items() if i != q and len(v) == len(good[q])
        )
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return sorted(out)


def test_query_equals_brute_force(spark):
    rows = [(r.vec_id, r.embedding) for r in table(spark, SF, "embeddings").collect()]
    got = sorted(tuple(r) for r in op9_top_k(spark, SF).select("query_id", "rank", "vec_id", "score").collect())
    assert got == brute(rows, lambda i: i % 50 == 0, 5)


@pytest.mark.parametrize("block", [3, 8192])
def test_edge_cases(spark, monkeypatch, block):
    monkeypatch.setattr(topk, "BLOCK", block)
    monkeypatch.setattr(topk, "CHUNK", 4)
    monkeypatch.setattr(topk, "FIRST_READ", 2)
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=4)]) for i in range(40)]
    rows += [(i, [1.0, 0.5, -0.25, 0.0]) for i in range(40, 60)]  # equal vectors
    rows += [(60, None), (62, [1.0, None, 0.0, 0.0]), (64, [math.nan] * 4), (66, [math.inf, 0.0, 0.0, 0.0])]
    rows += [(70, [1.0]), (72, [0.5]), (74, []), (75, []), (None, [1.0])]
    df = spark.createDataFrame([(i, v, i) for i, v in rows], "vec_id long, embedding array<float>, uid long")
    for k in (1, 5, 100):
        got = topk.top_k(df, F.col("vec_id") % 2 == 0, k).collect()
        assert sorted(tuple(r) for r in got) == brute(rows, lambda i: i % 2 == 0, k)
    assert topk.top_k(df.limit(0), F.lit(True)).count() == 0
    doubled = topk.top_k(df.union(df), F.col("vec_id") % 2 == 0, 5).collect()
    assert sorted(tuple(r) for r in doubled) == brute(rows, lambda i: i % 2 == 0, 5)


@pytest.mark.parametrize("size", [1e5, 1e10, 1e13])
def test_large_components_are_ranked_exactly(spark, size):
    rng = np.random.default_rng(6)
    rows = [(i, [float(x) for x in rng.normal(size=8)]) for i in range(40)]
    rows += [(40 + i, [float(x) for x in rng.normal(size=8) * size]) for i in range(20)]
    rows += [(60, rows[45][1][:7] + [rows[45][1][7] * (1 + 1e-12)])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    good = {i: [math.floor(256 * x) for x in v] for i, v in rows}
    want = []
    for q in (i for i in good if i % 2 == 0):
        scores = sorted((-sum(a * b for a, b in zip(good[q], v)), i) for i, v in good.items() if i != q)
        want += [(q, n + 1, i, -s if -(1 << 63) <= -s < 1 << 63 else None) for n, (s, i) in enumerate(scores[:5])]
    got = topk.top_k(df, F.col("vec_id") % 2 == 0).collect()
    assert sorted(tuple(r)[:3] for r in got) == sorted(w[:3] for w in want)
    assert sorted(map(str, got)) == sorted(str(g) for g in got) and {tuple(r) for r in got} == set(want)


def test_components_beyond_a_score_take_no_part(spark):
    rows = [(0, [1.0, 2.0]), (2, [3.0, 4.0]), (4, [1e300, 1.0]), (6, [-1e16, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk.top_k(df, F.lit(True)).collect()
    assert sorted((r.query_id, r.vec_id) for r in got) == [(0, 2), (2, 0)]
