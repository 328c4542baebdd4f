"""Packs documents into sequences by a best-fit plan over the histogram of their lengths.

Pieces of documents are counted by length; there are no more lengths than a sequence has tokens. The
plan places counts, not documents: from the longest length down, all pieces of a length go into the
sequences with the smallest gap that holds them, as many at once as there are. It is a list of ranges of
slots; a piece takes the slot of its rank among those of its length, by a join. The plan's size is bound
by the sequence length, whatever the number of documents: a length opens or splits at most three runs of
equal sequences, and a run's gap at least halves with every range.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rateloom.llm.common import batch, map_batches, slices, written
from rateloom.llm.tokens import Encoder

CAPACITY = 2048
END = 0
BUCKET_ROWS = 20_000


def best_fit_plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Ranges ``(length, first, last, sequence, per_sequence, offset)``.

    Pieces of ``length`` with ranks from ``first`` to before ``last`` lie in sequences from ``sequence``
    on, ``per_sequence`` in each, one after the other from ``offset``.
    """
    gaps: list[int] = []
    runs: dict[int, list[tuple[int, int]]] = {}
    plan, sequences = [], 0

    def add(gap: int, first: int, n: int) -> None:
        if gap and n:
            if gap not in runs:
                insort(gaps, gap)
                runs[gap] = []
            runs[gap].append((first, n))

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            at = bisect_left(gaps, length)
            if at < len(gaps):
                gap = gaps[at]
                first, n = runs[gap].pop()
                if not runs[gap]:
                    del runs[gap], gaps[at]
            else:
                gap, first = capacity, sequences
                n = -(-left // (capacity // length))
                sequences += n
            per = gap // length
            full = min(n, left // per)
            if full:
                plan.append((length, rank, rank + full * per, first, per, capacity - gap))
                add(gap - per * length, first, full)
                rank, left = rank + full * per, left - full * per
            if left and full < n:
                plan.append((length, rank, rank + left, first + full, left, capacity - gap))
                add(gap - left * length, first + full, 1)
                rank, left, full = rank + left, 0, full + 1
            add(gap, first + full, n - full)
    return plan


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of every piece of every row; null texts are empty."""
    schema = pa.schema(
        [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
    )
    end = END.to_bytes(4, "little")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder.of(tokenizer, words=True)
        for b in batches:
            for part in slices(b, 1):
                rows = []
                encoded = encode([t or "" for t in part.column(1).to_pylist()])
                for doc_id, ids in zip(part.column(0).to_pylist(), encoded):
                    ids += end
                    for k, first in enumerate(range(0, len(ids), 4 * capacity)):
                        own = ids[first : first + 4 * capacity]
                        rows.append((doc_id, k, first // 4, len(own) // 4, zlib.crc32(own)))
                yield batch(schema, *zip(*rows))

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_batches(slim, "doc_id long, piece int, start long, length long, ids_crc32 long", work)


def ranked(found: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``found`` with ``rank``, from 0 without gaps among the pieces of a length.

    A length is dealt into buckets of a bounded number of rows; they are numbered on their own and
    after those before them.
    """
    buckets = max(1, -(-found.count() // bucket_rows))
    dealt = found.withColumn(
        "bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets))
    )
    sizes = dealt.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.select("length", "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    own = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    return (
        dealt.withColumn("own", F.row_number().over(own))
        .join(base, ["length", "bucket"])
        .withColumn("rank", F.col("base") + F.col("own") - 1)
        .drop("bucket", "own", "base")
    )


def pack_pieces(found: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``found`` (with a ``length`` of 1 to ``capacity``) with ``sequence_id`` and ``offset``."""
    spark = found.sparkSession
    counts = {r["length"]: r["n"] for r in found.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = spark.createDataFrame(
        best_fit_plan(counts, capacity),
        "len long, first long, last long, sequence long, per_sequence long, from_offset long",
    )
    # The plan has a bounded number of rows (see above), so every task may hold it.
    placed = ranked(found).join(
        F.broadcast(plan), (F.col("length") == F.col("len")) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("last"))
    )
    step = F.col("rank") - F.col("first")
    return placed.select(
        *found.columns,
        (F.col("sequence") + F.floor(step / F.col("per_sequence"))).cast("long").alias("sequence_id"),
        (F.col("from_offset") + step % F.col("per_sequence") * F.col("length")).cast("long").alias("offset"),
    )


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` per piece of ``docs``.

    A document is its token ids and an end id (0); only longer ones than ``capacity`` are cut. Null and
    empty texts are the end id alone. Rows that repeat, or share an id, are packed each on their own;
    other columns don't matter; an empty table gives an empty one. ``offset`` leaves no gaps, and the
    sequences of the longest lengths come first.
    """
    return pack_pieces(written(pieces(docs, tokenizer, capacity), "pieces"), capacity)
