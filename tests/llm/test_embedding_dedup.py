import numpy as np
import pytest
from helpers import union_find
from pyspark.sql import functions as F

from rateloom.llm import embedding_dedup as op
from rateloom.llm.queries import op1_embedding_near_dedup

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute_force(rows):
    """rows: (vec_id, vector or None); links and components by all pairs."""
    good = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if v is not None and all(x is not None for x in v)]
    good = [(i, v / np.linalg.norm(v)) for i, v in good if np.isfinite(v).all() and np.any(v)]
    points = np.array([v for _, v in good])
    near = points @ points.T >= 0.9
    np.fill_diagonal(near, False)
    links = {i: 0 for i, _ in rows} | {i: int(n) for (i, _), n in zip(good, near.sum(axis=1))}
    pairs = [(good[a][0], good[b][0]) for a, b in np.argwhere(near) if a < b]
    return links, union_find([i for i, _ in rows], pairs)


def clustered(rng, n, dim, clusters):
    """Vectors of their own, and clusters of different spread with links around the threshold."""
    points = [rng.standard_normal(dim) for _ in range(n)]
    for size, spread in clusters:
        middle = rng.standard_normal(dim)
        points += [middle + spread * rng.standard_normal(dim) for _ in range(size)]
    return [(int(i), [float(x) for x in p]) for i, p in zip(rng.permutation(len(points)), points)]


def check(got, rows, recall=0.99):
    links, reach = brute_force(rows)
    got = {r.vec_id: r for r in got}
    assert set(got) == set(links)
    assert all(got[i].n_links <= links[i] for i in links)
    assert sum(r.n_links for r in got.values()) >= recall * sum(links.values())
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())
    wrong = sum(got[i].component_id != reach[i] for i in reach)
    assert wrong <= (1 - recall) * len(reach)


def test_against_brute_force(spark, monkeypatch):
    """Small leaves, so that trees are deep, leaves are split further and dense groups go by blocks."""
    for name, value in (("LARGEST", 64), ("BLOCK", 32)):
        monkeypatch.setattr(op, name, value)
    rng = np.random.default_rng(4)
    rows = clustered(rng, 600, 24, [(300, 0.01), (60, 0.25), (40, 0.3), (20, 0.2), (2, 0.1), (2, 0.1), (5, 0.0)])
    table = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    monkeypatch.setattr(op.split_large, "__defaults__", (64,))
    got = op.near_embeddings(table, sample=200, leaf=32).collect()
    check(got, rows, recall=0.97)


def test_cases(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(5, v), (3, v), (3, v), (9, [2.0, 4.0, 6.0]), (1, [-1.0, -2.0, -3.0]), (2, None), (4, []), (6, [0.0, 0.0, 0.0])]
    rows += [(7, [float("nan"), 1.0, 1.0]), (8, [float("inf"), 1.0, 1.0]), (10, [None, 2.0, 3.0]), (11, [1.0, 2.0]), (None, v)]
    table = spark.createDataFrame([(i, x, 0) for i, x in rows], SCHEMA).withColumns({"cid": F.lit(1), "n": F.lit("x")})
    got = sorted(((r.vec_id or -1, r.n_links, r.component_id, r.kept) for r in op.near_embeddings(table).collect()))
    assert got == sorted(
        [(5, 4, 3, False), (3, 4, 3, True), (3, 4, 3, True), (9, 4, 3, False), (-1, 4, 3, False)]
        + [(i, 0, i, True) for i in (1, 2, 4, 6, 7, 8, 10, 11)]
    )
    assert op.near_embeddings(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("size", ["0.01"])
def test_query(spark, size):
    sf_dir = f"/root/testdata/sf{size}"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    check(op1_embedding_near_dedup(spark, sf_dir).collect(), rows, recall=1.0)


def test_large_loose_group(spark):
    """A group of vectors of their own, mean cosine 0.95 or 0.92, that is much larger than a leaf."""
    rng = np.random.default_rng(11)
    points = rng.standard_normal((7000, 64))
    for at, cosine in ((0, 0.95), (2500, 0.92)):
        middle, noise = rng.standard_normal(64), rng.standard_normal((2500, 64))
        points[at : at + 2500] = middle / np.linalg.norm(middle) + noise * np.sqrt((1 / cosine - 1) / 64)
    points = points.astype(np.float32).astype(float)
    unit = points / np.linalg.norm(points, axis=1, keepdims=True)
    links = np.array([int((unit[k] @ unit.T >= 0.9).sum()) - 1 for k in range(len(unit))])
    table = spark.createDataFrame([(k, p.tolist(), 0) for k, p in enumerate(points)], SCHEMA)
    got = {r.vec_id: r.n_links for r in op.near_embeddings(table).collect()}
    found = np.array([got[k] for k in range(len(points))])
    assert (found <= links).all()
    for at in (0, 2500):
        assert found[at : at + 2500].sum() >= 0.99 * links[at : at + 2500].sum() > 0
