import math

import numpy as np
import pytest
from oracle import compare, connect
from pyspark.sql import functions as F

from rateloom.llm import exact_search as op
from rateloom.llm import vector_blocks
from rateloom.llm.queries import ORACLE, QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int"


def whole(vector, scale):
    """floor(scale * x) as Python numbers, or None if the vector takes no part."""
    if vector is None or any(x is None or not math.isfinite(x) for x in vector):
        return None
    return [math.floor(scale * float(np.float32(x))) for x in vector]


def brute_force(rows, top, every):
    good = [(i, whole(v, op.SCALE)) for i, v in rows]
    good = [(i, v) for i, v in good if v is not None]
    out = []
    for k, (query_id, q) in enumerate(good):
        if query_id is None or query_id % every:
            continue
        scored = [(-sum(x * y for x, y in zip(q, v)), i is None, i) for j, (i, v) in enumerate(good) if j != k]
        out += [(query_id, n + 1, i, -s) for n, (s, _, i) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:top])]
    return sorted(out, key=str)


def check(spark, rows, top=4, every=3):
    got = op.top_products(spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA), top=top, every=every)
    assert sorted(map(tuple, got.collect()), key=str) == brute_force(rows, top, every)


@pytest.mark.parametrize("dim", [1, 5, 24])
def test_against_brute_force(spark, monkeypatch, dim):
    """Many small parts and groups of parts; near groups, copies of one vector, coarse values with many ties."""
    monkeypatch.setattr(vector_blocks, "BLOCK", 40)
    monkeypatch.setattr(vector_blocks, "TILES_AT_ONCE", 3)
    monkeypatch.setattr(op, "FIRST_DEPTH", 2)
    rng = np.random.default_rng(dim)
    points = [*rng.standard_normal((150, dim)), *(rng.standard_normal(dim) + 0.05 * rng.standard_normal((60, dim)))]
    points += [points[3]] * 120 + [*rng.integers(-1, 2, (60, dim))] + [np.zeros(dim)] * 3
    rows = [(int(i) - 50, [float(x) for x in p]) for i, p in zip(rng.permutation(len(points)), points)]
    check(spark, rows)


def test_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (3, None), (6, [nan, 1.0]), (9, [1.0, inf]), (12, [None, 1.0]), (15, []), (18, [0.0, 0.0])]
    rows += [(None, [3.0, 0.5]), (0, [1.0, 2.0]), (21, [4.0]), (24, [-1.0, 0.25, 9.0]), (-3, [1e9, -1e9]), (2, [1.0, 2.0])]
    check(spark, rows)
    check(spark, rows, top=50)
    check(spark, [(0, [1.0])])
    check(spark, [(0, None)])
    check(spark, [])
    table = spark.createDataFrame([(0, [1.0], 0), (1, [2.0], 1)], SCHEMA)
    extra = table.withColumns({c: F.lit("x") for c in ("score", "rank", "tie", "side", "part")})
    got = op.top_products(extra)
    assert got.columns == ["query_id", "rank", "vec_id", "score"] and got.collect() == [(0, 1, 1, 2 * 1024**2)]
    doubles = table.withColumn("embedding", F.col("embedding").cast("array<double>"))
    assert op.top_products(doubles).collect() == [(0, 1, 1, 2 * 1024**2)]


def test_products_beyond_doubles():
    """Products that doubles don't hold exactly are whole numbers still."""
    rng = np.random.default_rng(5)
    whole = rng.integers(-(1 << 29), 1 << 29, (50, 3))
    row = {"part": 0, "cut": 0, "n": 50, "ids": np.arange(50).tobytes(), "vectors": vector_blocks.narrow(whole)}
    row["lists"] = np.argsort(whole, axis=0, kind="stable").astype(np.uint16).tobytes()
    places, scores = next(op.Lists(row).search(whole[:1], 5, [None], np.array([0])))
    want = sorted(((-sum(int(a) * int(b) for a, b in zip(whole[0], v)), k) for k, v in enumerate(whole) if k))[:5]
    assert [(-s, p) for s, p in zip(scores, places)] == want


def test_stops_early(monkeypatch):
    """Where few components are large, only a part of the block is looked at, or nothing at all."""
    rng = np.random.default_rng(6)
    whole = (rng.pareto(1.0, (4000, 8)) * 20).astype(np.int64)
    row = {"part": 0, "cut": 0, "n": 4000, "ids": np.arange(4000).tobytes(), "vectors": vector_blocks.narrow(whole)}
    row["lists"] = np.argsort(whole, axis=0, kind="stable").astype(np.uint16).tobytes()
    seen = []
    monkeypatch.setattr(op, "leading", lambda s, i, top: (seen.append(len(s)), vector_blocks.leading(s, i, top))[1])
    places, scores = next(op.Lists(row).search(np.ones((1, 8), np.int64), 5, [None]))
    assert scores.tolist() == sorted(whole.sum(axis=1).tolist(), reverse=True)[:5] and sum(seen) < 1000
    seen.clear()
    assert len(next(op.Lists(row).search(np.ones((1, 8), np.int64), 5, [10**9]))[0]) == 0 and not seen


def test_sql(spark):
    sf_dir = "/root/testdata/sf0.1"
    name = "op11_exact_top_k_search"
    result = compare(spark, sf_dir, QUERIES[name], ORACLE[name], connect(sf_dir))
    assert result["ok"], result
