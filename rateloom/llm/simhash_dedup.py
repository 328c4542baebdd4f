"""SimHash near-dedup over a hierarchical index of fingerprints in Gray order.

The distinct fingerprints are sorted by Gray rank, so that neighbours differ in few bits, and cut into
blocks of equal size whatever their distribution. Every block keeps the bits that all its members share
(a mask and a pattern); upper nodes hold what their children share. A search descends from the root
against itself: a pair of nodes whose shared bits differ in more than the radius is dropped with all
below it. Blocks that remain are compared in tasks of bounded size, again by groups first. Copies of a
fingerprint enter the index once, and a pair of blocks gives no more links than it has fingerprints (a
spanning forest of all its links), so a group that holds a third of all rows costs no more than others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rateloom.llm.common import batch, components, linked_to, map_batches, written

SHINGLE = 3
RADIUS = 2
SEED = 42
BLOCK = 4096
GROUP = 64
FAN_BITS = 6

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def fingerprint_of(text: bytes, shingle: int = SHINGLE) -> int:
    """The 64-bit majority over the XXH64 of all word shingles, repeats included; 0 without words."""
    words = text.translate(_LOWER).split()
    if not words:
        return 0
    line = b" ".join(words)
    width = min(shingle, len(words))
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-1]))[: len(words) - width + 1].tolist()
    ends = (ends[width - 1 :] - 1).tolist()
    digest = xxhash.xxh64_digest
    hashes = b"".join([digest(line[s:e], SEED) for s, e in zip(starts, ends)])
    bits = np.frombuffer(hashes, np.uint8).reshape(-1, 8)
    votes = np.zeros(64, np.int64)
    for at in range(0, len(bits), 1 << 15):
        votes += np.unpackbits(bits[at : at + (1 << 15)], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(votes * 2 > len(bits)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, text_hash, fp`` per row of ``docs``; null texts count as empty.

    ``fp`` is the fingerprint as a signed long, ``text_hash`` tells rows of one id apart.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("fp", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array(
                [fingerprint_of(t.as_py() or b"", shingle) for t in b.column(2)], dtype=np.uint64
            )
            yield batch(schema, b.column(0), b.column(1), pa.array(fps.view(np.int64)))

    slim = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64("text").alias("text_hash"),
        F.col("text").cast("binary").alias("text"),
    )
    return map_batches(slim, "doc_id long, text_hash long, fp long", work)


def gray_rank(fp) -> F.Column:
    """The place of a fingerprint in the reflected Gray order, as a signed key that sorts like it."""
    rank = F.col(fp) if isinstance(fp, str) else fp
    for shift in (1, 2, 4, 8, 16, 32):
        rank = rank.bitwiseXOR(F.shiftrightunsigned(rank, shift))
    return rank.bitwiseXOR(F.lit(-(1 << 63)))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [("part", pa.int64()), ("seq", pa.int64()), ("lo", pa.int64()), ("hi", pa.int64()), ("fps", pa.binary())]
    )
    part, seq, rest = TaskContext.get().partitionId(), 0, np.empty(0, np.int64)

    def row(fps):
        return batch(
            schema,
            [part],
            [seq],
            [int(np.bitwise_and.reduce(fps))],
            [int(np.bitwise_or.reduce(fps))],
            [fps.astype("<i8").tobytes()],
        )

    for b in batches:
        rest = np.concatenate([rest, b.column(0).to_numpy(zero_copy_only=False)])
        while len(rest) >= BLOCK:
            yield row(rest[:BLOCK])
            seq, rest = seq + 1, rest[BLOCK:]
    if len(rest):
        yield row(rest)


def gray_blocks(distinct: DataFrame) -> DataFrame:
    """``id, lo, hi, fps``: the fingerprints in Gray order, in numbered blocks of at most BLOCK.

    A bit that all members of a block share is one where ``lo`` (all of them and-ed) equals ``hi``
    (all or-ed).
    """
    ordered = (
        distinct.select("fp", gray_rank("fp").alias("rank")).repartitionByRange("rank").sortWithinPartitions("rank")
    )
    cut = written(
        map_batches(ordered.select("fp"), "part long, seq long, lo long, hi long, fps binary", _cut), "blocks"
    )
    # One row per partition goes through this window, whatever the number of fingerprints.
    firsts = cut.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = firsts.selectExpr(
        "part", "coalesce(sum(n) over (order by part rows between unbounded preceding and 1 preceding), 0) as base"
    )
    return cut.join(before, "part").selectExpr("base + seq as id", "lo", "hi", "fps")


def near_blocks(blocks: DataFrame, n_blocks: int, radius: int = RADIUS) -> DataFrame:
    """Pairs of block numbers ``a <= b`` that may hold fingerprints within the radius."""
    spark = blocks.sparkSession
    levels = [written(blocks.select("id", "lo", "hi"), "leaves")]
    size = n_blocks
    while size > 1:
        levels.append(
            levels[-1]
            .groupBy(F.shiftright("id", FAN_BITS).alias("id"))
            .agg(F.bit_and("lo").alias("lo"), F.bit_or("hi").alias("hi"))
        )
        size = -(-size // (1 << FAN_BITS))
    pairs = spark.createDataFrame([(0, 0)], "a long, b long")
    for nodes in reversed(levels[:-1]):
        up = F.shiftright("id", FAN_BITS)
        left = nodes.select(up.alias("a"), F.col("id").alias("x"), F.col("lo").alias("xl"), F.col("hi").alias("xh"))
        right = nodes.select(up.alias("b"), F.col("id").alias("y"), F.col("lo").alias("yl"), F.col("hi").alias("yh"))
        pairs = (
            pairs.join(left, "a")
            .join(right, "b")
            .where("x <= y")
            .where(f"bit_count(~(xl ^ xh) & ~(yl ^ yh) & (xl ^ yl)) <= {int(radius)}")
            .select(F.col("x").alias("a"), F.col("y").alias("b"))
        )
    return pairs


def _groups(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    full = -(-len(fps) // GROUP) * GROUP
    padded = np.concatenate([fps, np.full(full - len(fps), fps[-1])]).reshape(-1, GROUP)
    return padded, np.bitwise_and.reduce(padded, axis=1), np.bitwise_or.reduce(padded, axis=1)


def join_links(left: np.ndarray, right: np.ndarray, radius: int) -> np.ndarray:
    """For every place of ``left`` and ``right`` (one after the other) the first place it is linked to."""
    # Unsigned, as numpy counts the bits of a signed number's absolute value.
    a, alo, ahi = _groups(left.astype(np.int64).view(np.uint64))
    b, blo, bhi = _groups(right.astype(np.int64).view(np.uint64))
    shared = ~(alo ^ ahi)[:, None] & ~(blo ^ bhi)[None, :]
    ga, gb = np.nonzero(np.bitwise_count(shared & (alo[:, None] ^ blo[None, :])) <= radius)
    root = np.arange(len(left) + len(right))
    for at in range(0, len(ga), 64):
        x, y = ga[at : at + 64], gb[at : at + 64]
        k, i, j = np.nonzero(np.bitwise_count(a[x][:, :, None] ^ b[y][:, None, :]) <= radius)
        i, j = x[k] * GROUP + i, y[k] * GROUP + j
        real = (i < len(left)) & (j < len(right))
        i, j = i[real], j[real] + len(left)
        root = linked_to(root, i, j)
    return root


def fingerprint_links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``a, b``: links that connect the same fingerprints as all links within ``radius`` do."""
    blocks = written(gray_blocks(distinct), "index")
    n_blocks = blocks.count()
    pairs = near_blocks(blocks, n_blocks, radius)
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for left, right in zip(b.column(0), b.column(1)):
                fps = [np.frombuffer(x.as_py(), "<i8") for x in (left, right)]
                root, both = join_links(*fps, radius), np.concatenate(fps)
                moved = root != np.arange(len(root))
                yield batch(schema, pa.array(both[moved]), pa.array(both[root[moved]]))

    left = blocks.select(F.col("id").alias("a"), F.col("fps").alias("left"))
    right = blocks.select(F.col("id").alias("b"), F.col("fps").alias("right"))
    held = pairs.join(left, "a").join(right, "b").select("left", "right")
    return map_batches(held, "a long, b long", work)


def simhash_groups(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``doc_id, text_hash, fp, component, component_id`` per row of ``docs (doc_id, text, ...)``.

    ``component`` is the smallest fingerprint that can be reached over fingerprints with at most
    ``radius`` differing bits, ``component_id`` the smallest id of its documents (null if they have
    none). Null and empty texts have fingerprint 0. Repeated rows and other columns of any name are
    fine; an empty table gives an empty one.
    """
    prints = written(fingerprints(docs, shingle), "fingerprints")
    distinct = written(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct")
    reached = components(fingerprint_links(distinct, radius))
    named = distinct.join(reached.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first_id", F.coalesce("component", "fp").alias("component")
    )
    least = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    by_print = named.join(least, "component").select("fp", "component", "component_id")
    return prints.join(by_print, "fp").select("doc_id", "text_hash", "fp", "component", "component_id")


def drop_near_copies(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` without near copies: of each group one document stays, all columns kept.

    That is the one with the smallest id (nulls last), then the smallest text hash; repeated rows of it
    count once.
    """
    groups = written(simhash_groups(docs, shingle, radius), "groups")
    rows = groups.groupBy("component", "doc_id", "text_hash").agg(F.count(F.lit(1)).alias("n"))
    best = rows.groupBy("component").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash", "n")).alias("k")
    )
    chosen = best.select(
        F.col("k.doc_id").alias("__id"), F.col("k.text_hash").alias("__hash"), (F.col("k.n") > 1).alias("__twice")
    )
    found = docs.join(
        chosen,
        docs["doc_id"].cast("long").eqNullSafe(F.col("__id")) & (F.xxhash64(docs["text"]) == F.col("__hash")),
    )
    once = found.where("not __twice").select(*[docs[c] for c in docs.columns])
    twice = found.where("__twice").dropDuplicates(["__id", "__hash"]).select(*[docs[c] for c in docs.columns])
    return once.union(twice)
