import hashlib
import random

import numpy as np
import pytest
from helpers import docs, union_find
from pyspark.sql import functions as F

from rateloom.llm import fingerprints as op
from rateloom.llm.queries import op5_fingerprints


def check(got, texts):
    """texts: (doc_id, text) in order of the ids."""
    words = op._Words()
    assert len(got) == len(texts)
    by_id = {r.doc_id: r for r in got}
    for k, (i, text) in enumerate(texts):
        text, following = text or "", texts[(k + 1) % len(texts)][1] or ""
        n = len(text) // 4
        changed = text[: len(text) - n] + following[:n]
        row = by_id[i]
        own, other, after = (op.fingerprint(t, words) for t in (text, changed, following))
        assert (row.n_chars, row.edited_sha256) == (len(text), hashlib.sha256(changed.encode()).hexdigest())
        assert (row.fingerprint, row.edited_fingerprint) == (own.hex(), other.hex())
        assert row.near_edited == pytest.approx(op.likeness(own, other)) and row.near_next == pytest.approx(op.likeness(own, after))


def test_fingerprint_is_the_weighted_vote():
    words = op._Words()
    text = "the cat the dog the cat"
    h = [np.uint64(words[w]) for w in text.split()]
    with np.errstate(over="ignore"):
        terms = [op._mixed(x) for x in h] + [op._mixed(op._mixed(a + op._STEP) + b) for a, b in zip(h, h[1:])]
        votes = np.zeros(128)
        for t in set(map(int, terms)):
            weight = 1 + np.log([int(x) for x in terms].count(t))
            raw = np.array([t, int(op._mixed(np.uint64(t) + op._STEP))], np.uint64).view(np.uint8)
            votes += weight * (np.unpackbits(raw).astype(int) * 2 - 1)
    assert op.fingerprint(text, words) == np.packbits(votes > 0).tobytes()
    assert op.fingerprint("", words) == bytes(16) == op.fingerprint(" \n", words)
    assert op.fingerprint("The CAT", words) == op.fingerprint("the cat", words)


def test_cases(spark):
    texts = [(None, "before all"), (1, None), (2, ""), (3, "é漢 x"), (4, "word " * 50000), (5, "a b c d e f g h"), (9, "a b c d e f g h")]
    table = docs(spark, [t for _, t in texts], [i for i, _ in texts]).repartition(4).withColumns({"fingerprint": F.lit(1), "n": F.lit(2)})
    got = op.fingerprint_documents(table).collect()
    check(got, texts)
    assert {r.doc_id: (r.n_near, r.class_id) for r in got if r.doc_id in (5, 9)} == {5: (1, 5), 9: (1, 5)}
    check(op.fingerprint_documents(docs(spark, ["only one here"], [7])).collect(), [(7, "only one here")])
    assert op.fingerprint_documents(docs(spark, [])).collect() == []
    twice = op.fingerprint_documents(docs(spark, ["same text"] * 3, [1, 1, 1])).collect()
    assert len(twice) == 3 and all(r.near_next == 1.0 and r.n_near == 2 for r in twice)


def test_block_tables_find_all(spark, monkeypatch):
    monkeypatch.setattr(op, "BLOCK", 16)
    rng, prints = random.Random(2), []
    for _ in range(80):
        x = rng.getrandbits(128)
        for _ in range(rng.choice([1, 1, 2, 12])):
            prints.append(x)
            for _ in range(rng.choice([0, 1, 3])):
                x ^= 1 << rng.randrange(128)
    middle = rng.getrandbits(96)
    prints += [middle << 32 | rng.getrandbits(3) << rng.randrange(29) for _ in range(60)]
    rows = [(i, bytearray(x.to_bytes(16, "big"))) for i, x in enumerate(prints)]
    got = {r.doc_id: r for r in op.within_radius(spark.createDataFrame(rows, "doc_id long, fingerprint binary")).collect()}
    near = [[j for j, y in enumerate(prints) if j != i and (x ^ y).bit_count() <= 3] for i, x in enumerate(prints)]
    assert {i: r.n_near for i, r in got.items()} == {i: len(own) for i, own in enumerate(near)}
    assert {i: r.class_id for i, r in got.items()} == union_find(range(len(prints)), [(i, j) for i, own in enumerate(near) for j in own])


def test_query(spark):
    sf_dir = "/root/testdata/sf0.001"
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect()]
    got = op5_fingerprints(spark, sf_dir).collect()
    check(got, texts)
    apart = np.array([(r.near_edited, r.near_next) for r in got if r.n_chars > 200])
    assert (apart[:, 0] > apart[:, 1]).mean() > 0.98 and np.median(apart[:, 1]) < 0.6 < np.median(apart[:, 0])
