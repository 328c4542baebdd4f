import math
import zlib

import numpy as np
import pytest
from helpers import docs
from pyspark.sql import functions as F

from rateloom.llm import language as op
from rateloom.llm.queries import vocabulary_path, op8_language_id

EN = "the cat sat on the mat and the dog ran to the house with the children of the town"
DE = "der hund lief durch die strasse und das kind spielte mit dem ball im garten des hauses"


def all_segmentations(word, chances):
    if not word:
        return 1.0
    return sum(
        chances.get(word[:k], op.UNKNOWN if k == 1 else 0.0) * all_segmentations(word[k:], chances)
        for k in range(1, len(word) + 1)
    )


def test_forward_sums_all_segmentations():
    chances = {"▁": 0.1, "a": 0.2, "b": 0.05, "ab": 0.15, "▁a": 0.1, "▁ab": 0.2, "ba": 0.1, "bab": 0.1}
    ids = {p: i for i, p in enumerate(chances)}
    sizes = np.array([len(p) for p in ids])
    table = op.scaled(np.array(list(chances.values()))[:, None], sizes)
    words = ["▁a", "▁abab", "▁babab", "▁xa", "b", "ab" * 6]
    got = op.Lattice(words, ids, 3).logs(table)[:, 0]
    assert np.allclose(got, [math.log(all_segmentations(w, chances)) for w in words])


def test_expected_counts_cover_the_words():
    ids = {p: i for i, p in enumerate(["▁", "a", "b", "ab", "▁a"])}
    sizes = np.array([len(p) for p in ids])
    found = op.Lattice(["▁ab", "▁bb"], ids, 2).counts(op.scaled(np.full((5, 1), 0.2), sizes), np.array([3.0, 1.0]))
    assert math.isclose(float((found * np.append(sizes, 1)).sum()), 3 * 3 + 3)


def test_places_of_words_are_not_looked_up_one_by_one():
    class Counted(dict):
        asked = 0

        def get(self, *key):
            Counted.asked += 1
            return super().get(*key)

    ids = Counted({p: i for i, p in enumerate(["▁", "a", "b", "ab", "▁a", "aba", "𝒳é"])})
    words = ["▁abab", "▁xa", "b𝒳é", "𝒳", ""] * 50
    got = op.Lattice(words, ids, 3)
    want = []
    for k, w in enumerate(words):
        for i in range(len(w)):
            want += [(j, k, i, ids[w[i:j]]) for j in range(i + 1, min(len(w), i + 3) + 1) if w[i:j] in ids]
            want += [(i + 1, k, i, len(ids))] * (w[i] not in ids)
    assert list(zip(got.end, got.row, got.start, got.piece)) == sorted(want)
    assert Counted.asked == 0
    assert len(op.Lattice(["▁x"], {}, 3).piece) == 2 and len(op.Lattice([], ids, 3).piece) == 0


def test_cases(spark):
    texts = [EN, DE] * 8 + [None, "", " 12 !!", "THE CAT!!", "der " * 40000, "ab" * 30000, EN, EN]
    langs = ["en", "de"] * 8 + ["en"] * 5 + [None] * 3
    table = docs(spark, texts, [*range(22), 22, None], lang=langs).withColumn("lang_score", F.lit("clash"))
    got = {(r.doc_id, r.lang): r for r in op.identify_documents(table, vocabulary_path("piece_bpe_32k.model")).collect()}
    assert len(got) == len(texts)
    pred = [got[i, langs[i]].lang_pred for i in range(22)]
    assert pred[:16] == ["en", "de"] * 8
    assert pred[16:19] == ["und"] * 3 and [got[i, langs[i]].lang_score for i in (16, 17, 18)] == [0.0] * 3
    assert pred[19:21] == ["en", "de"] and pred[21] in ("en", "de")
    assert all(0.0 <= r.lang_score <= 1.0 for r in got.values())
    kept = op.keep_identified(table, vocabulary_path("piece_bpe_32k.model"))
    assert kept.columns == table.columns
    assert not {16, 17, 18} & {r.doc_id for r in kept.collect()}


def test_nothing_learned(spark):
    path = vocabulary_path("piece_bpe_32k.model")
    assert op.identify_documents(docs(spark, []), path).collect() == []
    rows = op.identify_documents(docs(spark, ["some text"], lang=[None]), path).collect()
    assert [(r.lang_pred, r.lang_score) for r in rows] == [("und", 0.0)]


@pytest.mark.parametrize("size", ["0.01"])
def test_held_out_accuracy(spark, size):
    sf_dir = f"/root/testdata/sf{size}"
    got = {r.doc_id: r for r in op8_language_id(spark, sf_dir).collect()}
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang").collect()}
    assert set(got) == set(truth)
    out = [i for i in truth if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(got[i].held_out == (i in set(out)) for i in truth)
    assert sum(got[i].lang_pred == truth[i] for i in out) >= 0.99 * len(out)
