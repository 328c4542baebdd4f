import numpy as np
import pytest
from oracle import compare, connect
from pyspark.sql import functions as F
from test_exact_search import SCHEMA, whole

from rateloom.llm import hard_negatives as op
from rateloom.llm import vector_blocks
from rateloom.llm.queries import ORACLE, QUERIES


def brute_force(rows, every):
    good = [(i, whole(v, op.SCALE), None if label is None else (label + 1) % 10 if i is not None and i % 7 == 0 else label) for i, v, label in rows]
    good = [(i, v, label) for i, v, label in good if v is not None and label is not None]
    out = []
    for k, (anchor, a, label) in enumerate(good):
        if anchor is None or anchor % every:
            continue
        scored = [(-sum(x * y for x, y in zip(a, v)), i is None, i or 0, own == label, i) for j, (i, v, own) in enumerate(good) if j != k]
        scored.sort(key=lambda x: x[:3])
        for positive in [s for s in scored if s[3]][: op.POSITIVES]:
            p = -positive[0]
            fits = [s for s in scored if not s[3] and 30 * p <= -100 * s[0] <= 90 * p][: op.NEGATIVES]
            out += [(anchor, positive[4], n + 1, s[4], p, -s[0]) for n, s in enumerate(fits)]
    return sorted(out, key=str)


def check(spark, rows, every=3):
    got = op.hard_negatives(spark.createDataFrame(rows, SCHEMA), every=every)
    want = brute_force(rows, every)
    assert sorted(map(tuple, got.collect()), key=str) == want
    return want


@pytest.mark.parametrize("dim", [1, 2, 7, 24])
def test_against_brute_force(spark, monkeypatch, dim):
    """Many small parts and cells; labels that differ in size, copies of one vector, coarse values with many ties."""
    for module, name, value in ((vector_blocks, "BLOCK", 40), (vector_blocks, "TILES_AT_ONCE", 3), (op, "FIRST_STEP", 4), (op, "CODES", 6), (op, "SAMPLE", 100)):
        monkeypatch.setattr(module, name, value)
    rng = np.random.default_rng(dim)
    middle = rng.standard_normal(dim)
    points = [*rng.standard_normal((120, dim)), *(middle + 0.3 * rng.standard_normal((90, dim)))]
    points += [points[3]] * 80 + [*rng.integers(-1, 2, (60, dim))] + [np.zeros(dim)] * 4
    labels = rng.choice([0, 0, 0, 1, 2, 9], len(points))
    rows = [(int(i) - 50, [float(x) for x in p], int(c)) for i, p, c in zip(rng.permutation(len(points)), points, labels)]
    assert len(check(spark, rows)) > 100


def test_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0], 1), (3, None, 1), (6, [nan, 1.0], 1), (9, [1.0, -inf], 1), (12, [None, 1.0], 1), (15, [1.0, 1.0], None)]
    rows += [(None, [3.0, 0.5], 1), (0, [1.0, 2.0], 1), (18, [0.5, 1.0], 3), (21, [0.5, 1.0], 2), (None, [0.5, 1.0], 3), (24, [], 1)]
    rows += [(27, [0.0, 0.0], 3), (30, [1.0, 0.5, 4.0], 1), (33, [-1.0, -2.0], 1), (36, [0.6], 5), (2, [0.7, 0.7], 6), (2, [0.7, 0.7], 6)]
    assert check(spark, rows)
    check(spark, rows[:1])
    check(spark, [(0, None, 1)])
    check(spark, [])
    table = spark.createDataFrame([(0, [1.0], 3), (3, [1.0], 4), (1, [0.5], 7), (2, [0.5], 7)], SCHEMA)
    extra = table.withColumns({c: F.lit("x") for c in ("score", "rank", "tie", "first", "part", "place", "anchor_id")})
    got = op.hard_negatives(extra)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(got.collect()) == [(0, 3, 1, 1, 65536, 32768), (0, 3, 2, 2, 65536, 32768)]


def test_windows():
    assert op.window_of(100) == (30, 90) and op.window_of(7) == (3, 6) and op.window_of(0) == (0, 0) and op.window_of(1) == (1, 0)
    low, high = op.window_of(-10)
    assert low > high


def test_walk_order_and_bounds():
    """Every vector is walked once, none scores more than the bound it comes with, bounds fall."""
    rng = np.random.default_rng(8)
    middles = rng.standard_normal((9, 12))[rng.integers(0, 9, 500)]
    whole = np.floor(256 * (middles + 0.1 * rng.standard_normal((500, 12)))).astype(np.int64)
    books = op.codebook(whole[:, :6], 9, rng), op.codebook(whole[:, 6:], 9, rng)
    codes = [op._nearest(h, c) for h, c in zip(op.halves(whole, books), books)]
    row = {"part": 0, "cut": 0, "n": 500, "ids": np.arange(500).tobytes(), "label": np.zeros(500, np.int64).tobytes()}
    row |= {"first": codes[0].tobytes(), "second": codes[1].tobytes(), "vectors": vector_blocks.narrow(whole)}
    cells = op.Cells(row, books)
    query = whole[17]
    scores, last, seen = whole @ query, np.inf, []
    for bound, places in cells.walk(query):
        assert bound <= last and scores[places].max() <= bound
        assert all(scores[p] <= bound for p in np.setdiff1d(np.arange(500), seen))
        seen, last = [*seen, *places.tolist()], bound
    assert sorted(seen) == list(range(500))
    few = [p for _, places in cells.walk(query, above=0) for p in places]
    assert set(np.flatnonzero(scores <= 0)) <= set(few) and len(few) < 500


def test_sql(spark):
    sf_dir = "/root/testdata/sf0.1"
    name = "op13_hard_negative_mining"
    result = compare(spark, sf_dir, QUERIES[name], ORACLE[name], connect(sf_dir))
    assert result["ok"], result
