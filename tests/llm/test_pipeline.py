from collections import defaultdict

import corpus_pipeline as pipeline
from helpers import docs
from pyspark.sql import functions as F
from test_mixing import plain_targets
from test_packing import check_rows
from test_simhash_dedup import plain_components, plain_print

SF = "/root/testdata/sf0.001"


def test_stages_against_plain_versions(spark):
    """Each stage on its own input: what it drops, what it keeps, what it changes."""
    table = spark.read.parquet(f"{SF}/documents.parquet")
    columns, results = table.columns, []
    for _, stage in pipeline.STAGES:
        rows = table.collect()
        table = pipeline.written(stage(spark, table, SF), "test")
        results.append((rows, table.collect()))
    before, after = results[0]
    assert len(after) == len(before) and after[0].__fields__ == columns
    before, after = results[1]
    groups = plain_components([(r.doc_id, plain_print(r.text)) for r in before])
    assert sorted(after) == sorted(r for r in before if groups[r.doc_id] == r.doc_id)
    before, after = results[2]
    assert sorted(r.doc_id for r in before) == sorted(r.doc_id for r in after)
    old = {r.doc_id: r.text for r in before}
    changed = [r for r in after if r.text != old[r.doc_id]]
    assert all("@" in old[r.doc_id] or any(c.isdigit() for c in old[r.doc_id]) for r in changed) and changed
    assert all(r.n_chars == len(r.text) for r in after)
    before, after = results[3]
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in before:
        sizes[r.source] += len(r.text.split())
    for r in after:
        taken[r.source] += len(r.text.split())
    goal = plain_targets(sizes)
    assert all(abs(taken[s] - goal[s]) <= 64 for s in sizes)
    before, after = results[4]
    check_rows(after, {r.doc_id: r.text for r in before})


def test_run(spark):
    got = pipeline.run(spark, SF)
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert got.count() > 0


def test_stages_hold_odd_rows(spark):
    """Nulls everywhere, empty texts, repeated rows, an empty table, extra columns."""
    good = " ".join(["the cat sat on the mat and the dog ran to the house"] * 4)
    rows = [good, good, None, "", " ", "12", good + " mail a.b@c.org", good]
    table = docs(spark, rows, [1, 1, 2, 3, None, 5, 6, None], lang=["en"] * 4 + [None] * 4, source=["s", "s", None, "s"] * 2)
    for extra in (table, table.withColumns({"size": F.lit("x"), "fp": F.lit(2), "h": F.lit(3), "lang_pred": F.lit(4)})):
        for empty in (False, True):
            at = extra.limit(0) if empty else extra
            for name, stage in pipeline.STAGES:
                columns = at.columns
                at = pipeline.written(stage(spark, at, SF), "odd")
                if name != pipeline.STAGES[-1][0]:
                    assert at.columns == columns, name
            assert (at.count() == 0) == empty


