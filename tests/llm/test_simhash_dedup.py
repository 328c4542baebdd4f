import random
import re

import numpy as np
import xxhash
from helpers import docs, union_find
from pyspark.sql import functions as F

from rateloom.llm import common
from rateloom.llm import simhash_dedup as op
from rateloom.llm.queries import op10_simhash_near_dedup


def plain_print(text, n=3):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    runs = [" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, radius=2):
    """prints: (doc_id, fingerprint); doc_id to the smallest id reached."""
    links = [
        (a, b) for i, (a, x) in enumerate(prints) for b, y in prints[:i] if (x ^ y).bit_count() <= radius
    ]
    return union_find([a for a, _ in prints], links)


def test_fingerprint():
    for text in ("", " \t\n", "A", "a B", "The The the the", "x é É y\x0bz", "a\x1cb c", "w " * 3000):
        assert op.fingerprint_of(text.encode()) == plain_print(text), text


def test_cases(spark):
    base = " ".join(f"w{i}" for i in range(400))
    texts = [None, "", "  ", base, base.upper(), base + " end", "other text of its own", "hi", "hi", "x " * 60000]
    ids = [7, 3, 9, 5, 4, 6, 20, 2, 2, None]
    table = docs(spark, texts, ids).withColumns({"fp": F.lit("x"), "component": F.lit(None)})
    got = op.simhash_groups(table).collect()
    assert len(got) == len(texts)
    prints = [(i, plain_print(t)) for i, t in zip(ids, texts) if i is not None]
    assert sorted((r.doc_id, r.fp & (2**64 - 1)) for r in got if r.doc_id is not None) == sorted(prints)
    by_id = {r.doc_id: r.component_id for r in got}
    want = plain_components(prints)
    assert {k: v for k, v in by_id.items() if k is not None} == want
    kept = op.drop_near_copies(table)
    assert kept.columns == table.columns
    assert sorted(r.doc_id or -1 for r in kept.collect()) == sorted([*set(want.values()), -1])


def test_empty(spark):
    assert op.simhash_groups(docs(spark, [])).collect() == []
    assert op.drop_near_copies(docs(spark, [])).collect() == []


def test_index_finds_all_links(spark, monkeypatch):
    """Clusters, chains and single fingerprints over many small blocks against all pairs."""
    monkeypatch.setattr(op, "BLOCK", 16)
    monkeypatch.setattr(op, "GROUP", 4)
    rng = random.Random(3)
    prints = {0, 2**64 - 1}
    for _ in range(60):
        x = rng.getrandbits(64)
        for _ in range(rng.choice([1, 1, 2, 12])):
            prints.add(x)
            for _ in range(rng.choice([1, 2, 3])):
                x ^= 1 << rng.randrange(64)
    signed = np.array(sorted(prints), np.uint64).view(np.int64).tolist()
    table = spark.createDataFrame([(x, k) for k, x in enumerate(signed)], "fp long, first_id long").repartition(5)
    links = op.fingerprint_links(table).collect()
    got = union_find(signed, [(r.a, r.b) for r in links])
    pairs = [(a, b) for i, a in enumerate(signed) for b in signed[:i] if ((a ^ b) & (2**64 - 1)).bit_count() <= 2]
    assert got == union_find(signed, pairs)


def test_rounds_of_components(spark, monkeypatch):
    """Edges that one task reads take no round; those of many tasks come to the same components."""
    rounds = []
    monkeypatch.setattr(common, "written", lambda df, name, f=common.written: rounds.append(name) or f(df, name))
    many = list(range(-40, 40))
    rng = random.Random(5)
    cases = [
        [],
        [(3, 1), (1, 3), (2, 1), (5, 4), (7, 7), (None, 1), (8, None), (-2, -9)],
        [(3, 1), (3, 2), (-5, 3)],
        [(k, k + 1) for k in many],
        [(rng.choice(many), rng.choice(many)) for _ in range(70)] * 2,
        [(0, -k) for k in many],
    ]
    for links in cases:
        real = [(a, b) for a, b in links if a is not None and b is not None and a != b]
        want = sorted(union_find({x for pair in real for x in pair}, real).items())
        table = spark.createDataFrame(links, "a long, b long").repartition(6)
        # By their cost to open, all files are read by one task, or each by its own.
        for cost in ("1", "128m"):
            rounds.clear()
            spark.conf.set("spark.sql.files.openCostInBytes", cost)
            spark.conf.set("spark.sql.files.minPartitionNum", "1")
            try:
                got = common.components(table)
                assert sorted((r.node, r.component) for r in got.collect()) == want, (links, cost)
            finally:
                spark.conf.unset("spark.sql.files.openCostInBytes")
                spark.conf.unset("spark.sql.files.minPartitionNum")
            assert cost != "1" or rounds == ["edges"]


def test_forests(spark):
    a, b = np.array([5, 3, -7, 9, 3]), np.array([3, 1, 8, 9, 1])
    x, y = common._forest(a, b)
    assert list(zip(x.tolist(), y.tolist())) == [(3, 1), (5, 1), (8, -7)]


def test_query(spark, sf_dir):
    sf_dir = "/root/testdata/sf0.001"
    texts = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    prints = [(r.doc_id, plain_print(r.text)) for r in texts]
    want = plain_components(prints)
    got = op10_simhash_near_dedup(spark, sf_dir).collect()
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in got) == sorted(
        (i, f"{p:016x}", want[i]) for i, p in prints
    )
