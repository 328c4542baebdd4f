import zlib

import numpy as np
from helpers import docs
from pyspark.sql import functions as F

from rateloom.llm import quality as op
from rateloom.llm.queries import op6_quality

LABELS = "doc_id long, quality int, toxic int"


def test_curve_is_isotonic():
    rng = np.random.default_rng(1)
    x = rng.random(300)
    y = (rng.random(300) < x).astype(float)
    points, chances = op.fit_curve(x, y)
    assert (np.diff(points) > 0).all() and (np.diff(chances) >= 0).all()
    assert abs(np.interp(0.5, points, chances) - 0.5) < 0.2
    assert np.interp(3.0, *op.fit_curve(np.array([]), np.array([]))) == 0.5


def test_cases(spark):
    good, bad = "the cat sat on the mat and was happy ", "#### $$$ BUY!!! NOW!!! "
    texts = [good * (1 + i % 5) if i % 2 else bad * (1 + i % 5) for i in range(200)]
    texts += [None, "", good * 9, bad * 9, bad * 20000, good]
    ids = [*range(200), 300, 301, 302, 303, 304, None]
    table = docs(spark, texts, ids).withColumns({"quality": F.lit(0), "held_out": F.lit("x"), "quality_score": F.lit(1)})
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(200)] + [(0, 1, 0), (None, 1, 0), (3, None, 0), (999, 1, 0), (1, 1, 0)], LABELS)
    got = {r.doc_id: r for r in op.score_documents(table, labels).collect()}
    assert len(got) == len(ids) and all(0 <= r.quality_score <= 1 for r in got.values())
    right = [got[i].quality_predicted == i % 2 for i in range(200)]
    assert np.mean(right) > 0.95 and got[302].quality_predicted == 1 and got[303].quality_predicted == 0
    assert got[300].quality_score == got[301].quality_score
    assert all(r.held_out == (zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 0) for i, r in got.items())
    assert op.score_documents(docs(spark, []), labels).collect() == []
    none = spark.createDataFrame([], LABELS)
    assert {r.quality_score for r in op.score_documents(table, none).collect()} == {0.5}
    one = op.score_documents(table, labels.where("quality = 1")).collect()
    assert len(one) == len(ids)


def test_held_out_labels_are_not_used(spark):
    """Turning around all labels that are held out changes no score."""
    sf_dir = "/root/testdata/sf0.001"
    table, labels = (spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("documents", "labels"))
    turned = labels.withColumn("quality", F.when(op.remainder(5) == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (sorted((r.doc_id, r.quality_score) for r in op.score_documents(table, x).collect()) for x in (labels, turned))
    assert a == b


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.1"
    got = {r.doc_id: r for r in op6_quality(spark, sf_dir).collect()}
    truth = [(r.doc_id, r.quality) for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()]
    out = [(got[i].score, got[i].predicted, q) for i, q in truth if got[i].held_out]
    good, bad = (np.array([s for s, _, q in out if q == k]) for k in (1, 0))
    assert (good[:, None] > bad[None, :]).mean() > 0.97
    assert np.mean([p == q for _, p, q in out]) > 0.94
    assert np.mean([p for _, p, q in out if q == 1]) > 0.98
