import random

import numpy as np
from helpers import docs
from oracle import compare
from pyspark.sql import functions as F

from rateloom.llm import mixing as op
from rateloom.llm.queries import ORACLE, QUERIES


def plain_targets(sizes, weights=(5, 2, 1), most=3):
    """The excess of sources above their limit is dealt again until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    stopped, total = set(), sum(sizes.values())
    while True:
        free = [s for s in names if s not in stopped]
        rest = total - sum(most * sizes[s] for s in stopped)
        goal = {s: rest * weight[s] / sum(weight[t] for t in free) for s in free}
        over = {s for s in free if goal[s] > most * sizes[s]}
        if not over:
            return {s: goal.get(s, most * sizes[s]) for s in names}
        stopped |= over


def plain_seats(votes, caps, seats):
    got = [0] * len(votes)
    for _ in range(seats):
        open_ = [i for i in range(len(votes)) if votes[i] > 0 and got[i] < caps[i]]
        if not open_:
            break
        got[max(open_, key=lambda i: (votes[i] / (2 * got[i] + 1), -i))] += 1
    return got


def test_sainte_lague():
    rng = random.Random(5)
    for _ in range(200):
        n = rng.randint(1, 8)
        votes = [rng.choice([0, 1, 5, 5, 20, rng.random() * 100]) for _ in range(n)]
        caps = [rng.choice([0, 2, 1000]) for _ in range(n)]
        seats = rng.randint(0, 60)
        assert op.sainte_lague(np.array(votes, float), np.array(caps), seats).tolist() == plain_seats(votes, caps, seats)
    assert op.sainte_lague(np.array([]), np.array([]), 3).tolist() == []


def words(rng, n):
    return rng.choice([" ", "\n", "\t "]).join(f"w{rng.randint(0, 99)}" for _ in range(n))


def test_targets_and_shares(spark, monkeypatch):
    monkeypatch.setattr(op, "SHARD_DOCS", 30)
    rng = random.Random(2)
    rows = [(i, rng.choice(["a", "b", "b", "b", "é", "Z", None, ""])) for i in range(400)]
    rows += [(400 + i, "tiny") for i in range(3)] + [(403, "void")]
    texts = [words(rng, rng.choice([0, 1, 10, 200, 900])) for _ in range(403)] + [None]
    table = docs(spark, texts, [i for i, _ in rows], source=[s for _, s in rows])
    got = op.mix(table).select("doc_id", "source", "size", "source_size", "target", "taken").collect()
    assert sorted(r.doc_id for r in got) == list(range(404))
    sizes = {}
    for (_, s), t in zip(rows, texts):
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    goal = plain_targets(sizes)
    taken = {s: sum(r.taken for r in got if r.source == s) for s in sizes}
    for r in got:
        assert r.size == len((texts[r.doc_id] or "").split())
        assert r.source_size == sizes[r.source] and abs(r.target - goal[r.source]) < 1e-6 * max(1, goal[r.source])
        assert 0 <= r.taken <= 3 * r.size
    for s in sizes:
        assert abs(taken[s] - goal[s]) <= 16 * 30 and taken[s] <= 3 * sizes[s]
    again = op.mix(table.repartition(7).orderBy("text")).select("doc_id", "taken").collect()
    assert sorted(again) == sorted((r.doc_id, r.taken) for r in got)
    mixed = {r.doc_id: r for r in op.mixed_documents(table).collect()}
    assert {i: len(r.text.split()) for i, r in mixed.items()} == {r.doc_id: r.taken for r in got if r.taken}
    assert all(r.n_chars == len(r.text) for r in mixed.values())


def test_cases(spark):
    assert op.mix(docs(spark, [])).collect() == [] and op.mixed_documents(docs(spark, [])).collect() == []
    only_empty = op.mix(docs(spark, [None, "", " "], [1, None, 1])).collect()
    assert [(r.size, r.target, r.taken) for r in only_empty] == [(0, 0.0, 0)] * 3
    table = docs(spark, ["a b c"] * 4 + ["x " * 100000], [1, 1, 1, None, 2], source=["s"] * 4 + [None])
    table = table.withColumns({"size": F.lit("clash"), "words": F.lit(1), "place": F.lit(2), "shard": F.lit(3)})
    mixed = op.mixed_documents(table)
    assert mixed.columns == table.columns
    assert {r["size"] for r in mixed.collect()} == {"clash"}
    assert op.mix(table).count() == 5


def test_query(spark, sf_dir):
    result = compare(spark, sf_dir, QUERIES["op2_mix_sources"], ORACLE["op2_mix_sources"])
    assert result["ok"], result
