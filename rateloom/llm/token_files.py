"""Token ids of documents as Huffman-coded blocks, written and read by Spark.

A token file is a folder of three Parquet tables: ``code`` (the length of every id's canonical code),
``blocks`` and ``parts``. A block holds whole documents, one after the other in ascending id order; ``part``
and ``block`` number them in that order, ``before`` counts the ids before it in its part, and ``parts``
those before each part. It can be decoded by itself, and from every checkpoint in it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rateloom.llm.common import batch, map_batches, slices, worker_state
from rateloom.llm.huffman import LIMIT, Decoder, code_lengths, codes_of, encode
from rateloom.llm.tokens import Encoder

END = 2
#: A block is closed once it has so many ids; a longer document makes a longer block.
BLOCK_IDS = 1 << 19


def raw_blocks(docs: DataFrame, tokenizer: str, end: int = END) -> DataFrame:
    """``part, block, before, doc_ids, sizes, ids``: documents in ascending id order, by blocks.

    Null ids come first; rows of one id by a hash of their text. Null texts are empty.
    """
    schema = pa.schema(
        [("part", pa.int64()), ("block", pa.int64()), ("before", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())), ("ids", pa.binary())]
    )
    close = end.to_bytes(4, "little")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, block = Encoder.of(tokenizer, words=False), TaskContext.get().partitionId(), 0
        doc_ids, sizes, parts, held, before = [], [], [], 0, 0

        def row():
            ids = np.concatenate([np.frombuffer(p, "<u4") for p in parts])
            narrow = ids.astype("<u2") if int(ids.max()) < 1 << 16 else ids
            return batch(schema, [part], [block], [before], [doc_ids], [sizes], [bytes([narrow.itemsize]) + narrow.tobytes()])

        for b in batches:
            for own in slices(b, 1):
                encoded = encoder([t or "" for t in own.column(1).to_pylist()])
                for doc_id, ids in zip(own.column(0).to_pylist(), encoded):
                    doc_ids.append(doc_id)
                    sizes.append(len(ids) // 4 + 1)
                    parts += [ids, close]
                    held += sizes[-1]
                    if held >= BLOCK_IDS:
                        yield row()
                        doc_ids, sizes, parts, held, before, block = [], [], [], 0, before + held, block + 1
        if doc_ids:
            yield row()

    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", F.xxhash64("text"))
    )
    return map_batches(
        ordered, "part long, block long, before long, doc_ids array<long>, sizes array<long>, ids binary", work
    )


def _ids(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, "<u2" if raw[0] == 2 else "<u4", offset=1)


def _cut(ids: np.ndarray, ends: np.ndarray) -> pa.BinaryArray:
    """The bytes of a block's ids by documents. They are shared, not viewed: Arrow never lets go of a memoryview
    that it made an array from, nor of the block behind it."""
    places = pa.py_buffer(4 * np.append(0, ends))
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends), [None, places, pa.py_buffer(ids)]).cast(pa.binary())


def global_counts(raw: DataFrame) -> np.ndarray:
    """How often each id occurs; what reaches the driver is bounded by the vocabulary."""
    schema = pa.schema([("id", pa.int64()), ("n", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1, np.int64)
        for b in batches:
            for ids in b.column(0):
                own = np.bincount(_ids(ids.as_py()))
                if len(own) > len(total):
                    total = np.append(total, np.zeros(len(own) - len(total), np.int64))
                total[: len(own)] += own
        used = np.flatnonzero(total)
        yield batch(schema, pa.array(used), pa.array(total[used]))

    rows = map_batches(raw.select("ids"), "id long, n long", work).groupBy("id").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(max((r["id"] for r in rows), default=-1) + 1, np.int64)
    for r in rows:
        counts[r["id"]] = r["n"]
    return counts


def write_token_file(docs: DataFrame, tokenizer: str, path: str, end: int = END, limit: int = LIMIT) -> None:
    """Writes the ids of all ``docs``, each with ``end`` after it, to the folder ``path``.

    Texts are tokenized once: the ids are written as plain blocks first (``path/raw``), counted, and
    coded from there.
    """
    spark = docs.sparkSession
    raw_blocks(docs, tokenizer, end).write.option("compression", "zstd").parquet(f"{path}/raw")
    raw = spark.read.parquet(f"{path}/raw")
    lengths = code_lengths(global_counts(raw), limit)
    code = [(i, int(n)) for i, n in enumerate(lengths) if n]
    spark.createDataFrame(code, "id long, bits int").coalesce(1).write.parquet(f"{path}/code")
    known = spark.sparkContext.broadcast((lengths, codes_of(lengths)))
    schema = pa.schema(
        [("part", pa.int64()), ("block", pa.int64()), ("before", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())), ("payload", pa.binary()), ("checkpoints", pa.binary())]
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                payload, marks = encode(_ids(b.column(5)[k].as_py()), *known.value)
                yield pa.RecordBatch.from_arrays(
                    [*(b.column(i).slice(k, 1).cast(schema.field(i).type) for i in range(5)), pa.array([payload]), pa.array([marks])],
                    schema=schema,
                )

    map_batches(
        raw.select("part", "block", "before", "doc_ids", "sizes", "ids"),
        "part long, block long, before long, doc_ids array<long>, sizes array<long>, payload binary, checkpoints binary",
        work,
    ).write.option("compression", "none").parquet(f"{path}/blocks")
    # A row per part goes through one window, a row per range of ids.
    held = spark.read.parquet(f"{path}/blocks").select("part", F.expr("aggregate(sizes, 0L, (s, x) -> s + x)").alias("n"))
    held.groupBy("part").agg(F.sum("n").alias("n")).selectExpr(
        "part", "coalesce(sum(n) over (order by part rows between unbounded preceding and 1 preceding), 0) as base"
    ).write.parquet(f"{path}/parts")


def read_token_file(spark: SparkSession, path: str, limit: int = LIMIT) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of every document of a token file; ``ids`` as little-endian
    unsigned 32-bit numbers, ``start`` the ids of all documents before it."""
    lengths_of = {r["id"]: r["bits"] for r in spark.read.parquet(f"{path}/code").collect()}
    lengths = np.zeros(max(lengths_of, default=-1) + 1, np.uint8)
    lengths[list(lengths_of)] = list(lengths_of.values())
    # As many rows as the file was written by tasks.
    bases = {r["part"]: r["base"] for r in spark.read.parquet(f"{path}/parts").collect()}
    known = spark.sparkContext.broadcast((lengths, bases))
    blocks = spark.read.parquet(f"{path}/blocks")
    schema = pa.schema(
        [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())]
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = worker_state("huffman")
        if state.get("path") != path:
            state |= {"path": path, "decode": Decoder(known.value[0], limit)}
        decode, bases = state["decode"], known.value[1]
        for b in batches:
            for part, before, doc_ids, sizes, payload, marks in zip(*(c for c in b.columns)):
                sizes = np.array(sizes.as_py(), np.int64)
                ids = decode(payload.as_py(), marks.as_py(), int(sizes.sum()))
                ends = np.cumsum(sizes)
                yield batch(
                    schema,
                    doc_ids.values,
                    pa.array(bases[part.as_py()] + before.as_py() + ends - sizes),
                    pa.array(sizes),
                    _cut(ids, ends),
                )

    return map_batches(
        blocks.select("part", "before", "doc_ids", "sizes", "payload", "checkpoints"),
        "doc_id long, start long, n_tokens long, ids binary",
        work,
    )


def digest(found: DataFrame) -> DataFrame:
    """``found`` of ``read_token_file`` with the CRC-32 of the ids in place of them."""
    return found.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


