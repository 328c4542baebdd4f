import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from helpers import docs
from oracle import compare, connect
from pyspark.sql import functions as F

from rateloom.llm import lexical_search as op
from rateloom.llm.queries import ORACLE, QUERIES

ITEMS = "item_id long, text string"
TERM = re.compile("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute_force(rows, items, top):
    """rows: (doc_id, text); items: (item_id, text). Every document of every item, scored by itself."""
    held = [(i, Counter(terms(t))) for i, t in rows if terms(t)]
    n_docs, n_words = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item_id, text in set(items):
        found = []
        for doc_id, c in held:
            m = 100 - 50 + (50 * sum(c.values()) * n_docs) // n_words
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m))
                for t in set(terms(text))
                if t in c
            )
            if score > 0:
                found.append((-score, doc_id is None, doc_id))
        out += [(item_id, k + 1, doc_id, -s) for k, (s, _, doc_id) in enumerate(sorted(found)[:top])]
    return sorted(out, key=str)


def check(spark, rows, items, top=5, **kw):
    got = op.rank_documents(docs(spark, [t for _, t in rows], [i for i, _ in rows]), spark.createDataFrame(items, ITEMS), top, **kw)
    assert sorted(map(tuple, got.collect()), key=str) == brute_force(rows, items, top)


@pytest.mark.parametrize("seed", range(3))
def test_against_brute_force(spark, seed, monkeypatch):
    """Small blocks and steps; words of very different frequency, copies, ties, masks of more than 64 terms."""
    monkeypatch.setattr(op, "BLOCK_DOCS", 37)
    monkeypatch.setattr(op, "FIRST_STEP", 2)
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(150)] + ["Äpfel", "ÄPFEL", "x_y", "THE"]

    def text(n):
        return " ".join(words[min(int(rng.paretovariate(0.6)) - 1, len(words) - 1)] for _ in range(n))

    rows = [(i, text(rng.randrange(1, 60))) for i in range(300)]
    rows += [(1000 + i, rows[7][1]) for i in range(150)] + [rows[8]] * 3
    items = [(k, text(rng.choice([1, 3, 20]))) for k in range(12)] + [(90, " ".join(words)), (91, " ".join(words[:70]))]
    check(spark, rows, items)
    check(spark, rows, items, terms_at_once=40)


def test_cases(spark):
    long = "needle " + "hay " * 300_000
    rows = [(1, None), (2, ""), (3, "..."), (4, "Needle"), (None, "needle"), (5, "needle"), (5, "needle"), (6, long), (7, "a\x00b c")]
    items = [(1, "needle, NEEDLE hay"), (1, "needle, NEEDLE hay"), (None, "hay"), (2, None), (3, "--"), (4, "absent"), (5, "a B"), (6, " ")]
    check(spark, rows, items, top=3)
    check(spark, [], items)
    check(spark, rows, [])
    check(spark, [(1, None)], items)
    wide = docs(spark, ["needle"]).withColumns({"rank": F.lit(1), "score": F.lit("x"), "query": F.lit(0)})
    asked = spark.createDataFrame([(1, "needle")], ITEMS).withColumns({"doc_id": F.lit(1), "terms": F.lit("x")})
    assert op.rank_documents(wide, asked).columns == ["item_id", "rank", "doc_id", "score"]
    assert op.rank_documents(wide, asked).count() == 1


def test_grouping():
    rng = np.random.default_rng(3)
    for n_terms in (1, 8, 63, 65, 130):
        masks = (rng.random((n_terms, 200)) < 0.02).astype(np.uint8)
        first, group = op.grouped(masks)
        assert (masks[:, first][:, group] == masks).all()
        assert len(first) == len({m.tobytes() for m in masks.T})


def test_masks_are_skipped():
    """Masks that can't reach the best documents are not evaluated, ties at the edge are."""
    row = {
        "doc_ids": np.arange(8), "sizes": np.full(8, 10), "terms": np.array([0, 1], np.int32), "df": np.array([8, 1], np.int32),
        "places": np.array([*range(8), 5], np.int32), "tf": np.ones(9, np.int64),
    }
    block = op.Block({k: v.tobytes() for k, v in row.items()}, 8, 80)
    none = np.zeros(0, np.int64)
    scores, ids = block.best(np.array([0, 1]), np.array([1, 100]), none, none, 3)
    assert ids.tolist() == [5, 0, 1]
    again = block.best(np.array([0]), np.array([1]), np.array([10**9, 10**8]), np.array([77, 78]), 2)
    assert again[1].tolist() == [77, 78]


def test_sql(spark):
    sf_dir = "/root/testdata/sf0.01"
    name = "op12_ranked_lexical_search"
    result = compare(spark, sf_dir, QUERIES[name], ORACLE[name], connect(sf_dir))
    assert result["ok"], result
