"""SimHash fingerprints of documents, and all fingerprints within a Hamming radius.

The terms of a text are its words and pairs of neighbouring words in lower case; a term that occurs n
times weighs 1 + ln n. Every term has 128 hashed bits and votes with its weight for each of them, for a
one or a zero; the fingerprint holds the winners. To find near fingerprints they are cut into one block
more than the radius: two within the radius agree in a whole block, so in the table permuted to begin
with that block they share a key.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rateloom.llm.common import batch, components, linked_to, map_batches, worker_state, written

BITS = 128
RADIUS = 3
SEED = 5
REMEMBERED = 400_000
BLOCK = 2048

_STEP = np.uint64(0x9E3779B97F4A7C15)
_SIGNS = (np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.float32) * 2 - 1).copy()


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all (the finaliser of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Words(dict):
    """Hashes of words."""

    def __missing__(self, word: str) -> int:
        value = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"), SEED)
        if len(word) <= 64:
            self[word] = value
        return value


def fingerprint(text: str, words: dict) -> bytes:
    """The 16 bytes of a text's fingerprint; all zero without words."""
    hashes = np.fromiter(map(words.__getitem__, text.lower().split()), np.uint64)
    if not len(hashes):
        return bytes(BITS // 8)
    pairs = _mixed(hashes[:-1] + _STEP) + hashes[1:]
    terms, counts = np.unique(np.concatenate([_mixed(hashes), _mixed(pairs)]), return_counts=True)
    weights = (1 + np.log(counts)).astype(np.float32)
    votes = np.zeros(BITS, np.float32)
    for at in range(0, len(terms), 1 << 14):
        some, own = terms[at : at + (1 << 14)], weights[at : at + (1 << 14)]
        bits = np.stack([some, _mixed(some + _STEP)], axis=1).view(np.uint8)
        votes += own @ _SIGNS[bits].reshape(len(some), BITS)
    return np.packbits(votes > 0).tobytes()


def likeness(a: bytes, b: bytes) -> float:
    """The share of equal bits."""
    return 1 - (int.from_bytes(a, "big") ^ int.from_bytes(b, "big")).bit_count() / (8 * len(a))


def edited(text: str, following: str) -> str:
    """The text with its last quarter of code points replaced by the first as many of another."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


_DONE = "doc_id long, n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary, next_fingerprint binary"
_SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.binary()), ("edited_fingerprint", pa.binary()), ("next_fingerprint", pa.binary())]
)


def _words() -> _Words:
    state = worker_state("fingerprints")
    if len(state.get("words", ())) > REMEMBERED or "words" not in state:
        state["words"] = _Words()
    return state["words"]


def _row(doc_id, text: str, own: bytes, following: str, next_own: bytes, words: dict) -> tuple:
    changed = edited(text, following)
    digest = hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest()
    return doc_id, len(text), digest, own, fingerprint(changed, words), next_own


def neighbours(docs: DataFrame) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, next_fingerprint`` per row.

    Documents are dealt out by ranges of ids and walked in order, so texts are shuffled once. The last
    document of a range needs the first of the next: those two of each range are kept aside with their
    texts and joined by the number of the range.
    """
    schema = pa.schema([*_SCHEMA, ("part", pa.int64()), ("edge", pa.int32()), ("text", pa.string())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, words, before = TaskContext.get().partitionId(), _words(), None
        for b in batches:
            rows = []
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                text = text or ""
                own = fingerprint(text, words)
                if before is None:
                    rows.append((doc_id, None, None, own, None, None, part, 0, text))
                else:
                    rows.append((*_row(*before, text, own, words), part, None, None))
                before = doc_id, text, own
            words = _words()
            yield batch(schema, *zip(*rows)) if rows else batch(schema, *[[]] * len(schema))
        if before is not None:
            doc_id, text, own = before
            yield batch(schema, *([x] for x in (doc_id, None, None, own, None, None, part, 1, text)))

    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", F.xxhash64("text"))
    )
    found = written(map_batches(ordered, _DONE + ", part long, edge int, text string", work), "walked")
    done = found.where("edge is null").select(*_SCHEMA.names)
    # One row per range goes through this window. After the last range comes the first.
    firsts = found.where("edge = 0")
    order = firsts.selectExpr("part", "lead(part) over (order by part) as later", "min(part) over () as least")
    pairs = (
        found.where("edge = 1").select("part", "doc_id", "fingerprint", "text")
        .join(order.selectExpr("part", "coalesce(later, least) as later"), "part")
        .join(
            firsts.select(F.col("part").alias("later"), F.col("fingerprint").alias("next"), F.col("text").alias("following")),
            "later",
        )
        .select("doc_id", "text", "fingerprint", "following", "next")
    )

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [_row(*r, _words()) for r in zip(*(c.to_pylist() for c in b.columns))]
            yield batch(_SCHEMA, *zip(*rows)) if rows else batch(_SCHEMA, *[[]] * len(_SCHEMA))

    return done.union(map_batches(pairs, _DONE, finish))


def compare_block(frame: pd.DataFrame, radius: int = RADIUS) -> pd.DataFrame:
    """``fid, links, root``: documents of other fingerprints found in this table first, and a forest."""
    frame = frame.sort_values("fid", kind="stable").reset_index(drop=True)
    raw = np.frombuffer(b"".join(frame["fingerprint"]), np.uint8).reshape(len(frame), -1)
    wide, table, n = raw.view(np.uint64), int(frame["table"].iloc[0]), frame["n"].to_numpy()
    low, high, own = (frame[c].to_numpy() for c in ("low", "high", "own"))
    left = np.flatnonzero(own == low)
    right = left if low[0] == high[0] else np.flatnonzero(own == high)
    size = raw.shape[1] // (radius + 1)
    links, root = np.zeros(len(frame), np.int64), np.arange(len(frame))
    for at in range(0, len(left), 256):
        apart = np.bitwise_count(wide[left[at : at + 256]][:, None, :] ^ wide[right][None, :, :]).sum(axis=2)
        i, j = np.nonzero(apart <= radius)
        i, j = left[at + i], right[j]
        if right is left:
            i, j = i[i < j], j[i < j]
        root = linked_to(root, i, j)
        same = (raw[i] == raw[j])[:, : table * size].reshape(len(i), table, size).all(axis=2).any(axis=1)
        np.add.at(links, i[~same], n[j[~same]])
        np.add.at(links, j[~same], n[i[~same]])
    fid = frame["fid"].to_numpy()
    told = (links > 0) | (root != np.arange(len(root)))
    return pd.DataFrame({"fid": fid[told], "links": links[told], "root": fid[root[told]]})


def within_radius(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``doc_id, fingerprint, n_near, class_id`` per row of ``prints (doc_id, fingerprint)``.

    ``n_near`` counts the other rows within ``radius`` bits, ``class_id`` is the smallest id reachable
    over such links. Equal fingerprints are compared once; keys with one fingerprint go, large ones are
    compared by pairs of blocks of bounded size, and counted in the first table that shows the pair.
    """
    if BITS // 8 % (radius + 1):
        raise ValueError("the fingerprint must be cut into radius + 1 blocks of whole bytes")
    distinct = written(
        prints.groupBy("fingerprint")
        .agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_id"))
        .withColumn("fid", F.monotonically_increasing_id()),
        "prints",
    )
    size = BITS // 8 // (radius + 1)
    keyed = distinct.select(
        "fid", "n", "fingerprint", F.explode(F.sequence(F.lit(0), F.lit(radius))).alias("table")
    ).withColumn("key", F.expr(f"substring(fingerprint, table * {size} + 1, {size})"))
    shared = keyed.groupBy("table", "key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    dealt = (
        keyed.join(shared, ["table", "key"])
        .withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int"))
        .withColumn("own", F.pmod(F.xxhash64("fid"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumns({"low": F.least("own", "other"), "high": F.greatest("own", "other")})
        .select("table", "key", "low", "high", "own", "fid", "n", "fingerprint")
    )
    found = written(
        dealt.groupBy("table", "key", "low", "high").applyInPandas(
            lambda frame: compare_block(frame, radius), "fid long, links long, root long"
        ),
        "near",
    )
    reached = components(found.select(F.col("fid").alias("a"), F.col("root").alias("b")))
    named = (
        distinct.join(found.groupBy("fid").agg(F.sum("links").alias("links")), "fid", "left")
        .join(reached.withColumnRenamed("node", "fid"), "fid", "left")
        .withColumn("component", F.coalesce("component", "fid"))
        .withColumn("n_near", F.coalesce("links", F.lit(0)) + F.col("n") - 1)
    )
    least = named.groupBy("component").agg(F.min("first_id").alias("class_id"))
    by_print = named.join(least, "component").select("fingerprint", "n_near", "class_id")
    return prints.select("doc_id", "fingerprint").join(by_print, "fingerprint").select("doc_id", "fingerprint", "n_near", "class_id")


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """Fingerprints of all documents, of their edited texts, how like they are, and near ones.

    ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint`` (hexadecimal), ``near_edited``,
    ``near_next``, ``n_near``, ``class_id``. Null texts are empty and have fingerprint zero; null ids
    come before others; rows of one id follow each other by a hash of their text; a single row is
    followed by itself; an empty table gives an empty one.
    """
    found = written(neighbours(docs), "neighbours")
    share = lambda other: F.expr(
        "1 - aggregate(sequence(0, 1), 0L, (s, i) -> s + bit_count("
        f"cast(conv(substr(hex(fingerprint), i * 16 + 1, 16), 16, -10) as bigint) ^ cast(conv(substr(hex({other}), i * 16 + 1, 16), 16, -10) as bigint)"
        f")) / {float(BITS)}D"
    )
    near = within_radius(found).groupBy("fingerprint").agg(F.max("n_near").alias("n_near"), F.min("class_id").alias("class_id"))
    return found.join(near, "fingerprint").select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        F.lower(F.hex("fingerprint")).alias("fingerprint"),
        F.lower(F.hex("edited_fingerprint")).alias("edited_fingerprint"),
        share("edited_fingerprint").alias("near_edited"),
        share("next_fingerprint").alias("near_next"),
        "n_near",
        "class_id",
    )
