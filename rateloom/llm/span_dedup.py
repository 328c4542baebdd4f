"""Removes repeated passages: every run of consecutive sentences is hashed and joined globally.

From every sentence a run goes forward and one goes backward until it has SENTENCES sentences and
LEAST_WORDS words; two letters of a script without blanks count as a word. The first occurrence of a run
(by id, then by place) stays; the sentences of all others go, and what stays is as it was, blanks
included. An occurrence that is not the first of its batch is not the first of all either, so only one
occurrence per batch of BATCH_ROWS rows meets the others, however often a passage repeats. Time grows with the
length of a text; a text of any length is worked on as a whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rateloom.llm.common import batch, map_batches

SENTENCES = 2
LEAST_WORDS = 20
BATCH_ROWS = 4096
#: Letters of scripts without blanks (Thai to Khmer, kana, Han) that count as one more word.
LETTERS_PER_WORD = 2

_THAI = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff"
_UNSPACED = re.compile(f"[{_THAI}\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")
_CLOSING = "\"'”’»›)\\]}」』】》）］"
# Latin marks end a sentence before a blank, marks of other scripts anywhere; Thai and its like have blanks only.
_END = re.compile(
    f"[.!?][{_CLOSING}]*(?=[^\\S\n])|[。！？｡।॥؟۔።။។][{_CLOSING}]*|[{_THAI}](?=[^\\S\n])"
)

# Two odd multipliers, for two polynomials over the sentences' hashes modulo 2^64, and their inverses.
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_INVERSES = tuple(pow(b, -1, 1 << 64) for b in _BASES)


def pieces_of(text: str) -> list[str]:
    """The text cut before every line feed and after every sentence; joined they are the text.

    A full stop, exclamation or question mark ends a sentence if white space follows, also after closing
    quotes and brackets; marks of other scripts always do, and so does a blank after Thai, Lao, Khmer or
    Burmese. Text without any of these is one sentence up to the line feed.
    """
    # Cuts are marked by a character that the text doesn't have.
    mark = next(c for c in map(chr, range(len(text) + 1)) if c not in text and c not in "\n.!?")
    text = _END.sub(lambda m: m[0] + mark, text)
    return text.replace("\n", mark + "\n").split(mark)


def sentences_of(text: str) -> tuple[list[str], list[int], list[int]]:
    """The pieces of a text, which of them hold words, and how many."""
    pieces = pieces_of(text)
    words = [len(p.split()) for p in pieces]
    if not text.isascii() and _UNSPACED.search(text):
        words = [n + len(_UNSPACED.findall(p)) // LETTERS_PER_WORD for n, p in zip(words, pieces)]
    at = [k for k, n in enumerate(words) if n]
    return pieces, at, [words[k] for k in at]


def runs_of(words: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Where runs begin and end (exclusively), over sentences with so many words; each run once."""
    n = len(words)
    total = np.concatenate([[0], np.cumsum(words)])
    i = np.arange(n)
    ends = np.maximum(i + SENTENCES, np.searchsorted(total, total[:-1] + LEAST_WORDS))
    forward = np.stack([i, ends], axis=1)[ends <= n]
    j = i + 1
    starts = np.minimum(j - SENTENCES, np.searchsorted(total, total[1:] - LEAST_WORDS, side="right") - 1)
    backward = np.stack([starts, j], axis=1)[starts >= 0]
    both = np.unique(np.concatenate([forward, backward]), axis=0)
    return both[:, 0], both[:, 1]


class _Powers:
    """Powers of the multipliers and their inverses, as far as needed."""

    def __init__(self):
        self.tables = np.ones((4, 1), np.uint64)

    def __call__(self, n: int) -> np.ndarray:
        if self.tables.shape[1] < n:
            steps = np.array([*_BASES, *_INVERSES], np.uint64)[:, None]
            self.tables = np.cumprod(np.concatenate([np.ones((4, 1), np.uint64), np.repeat(steps, 2 * n, axis=1)], axis=1), axis=1)
        return self.tables[:, :n]


def span_hashes(text: str, powers: _Powers) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last (exclusive) sentence of every run, and its two 64-bit hashes."""
    pieces, at, words = sentences_of(text)
    if not at:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty((2, 0), np.uint64)
    first, last = runs_of(words)
    digest = xxhash.xxh3_64_intdigest
    own = np.array([digest(" ".join(pieces[k].lower().split()).encode("utf-8", "surrogatepass")) for k in at], np.uint64)
    power = powers(len(own) + 1)
    sums = np.zeros((2, len(own) + 1), np.uint64)
    np.cumsum(own[None, :] * power[:2, :-1], axis=1, out=sums[:, 1:])
    hashes = (sums[:, last] - sums[:, first]) * power[2:, first] + (last - first).astype(np.uint64)
    return first, last, hashes ^ (hashes >> np.uint64(31))


def spans(docs: DataFrame) -> DataFrame:
    """``h1, h2, doc_id, text_hash, first, last, repeated`` of every run of every row.

    ``repeated`` ones have an earlier occurrence in the same batch; their hashes no longer matter and
    only spread them evenly.
    """
    schema = pa.schema(
        [("h1", pa.int64()), ("h2", pa.int64()), ("doc_id", pa.int64()), ("text_hash", pa.int64()), ("first", pa.int32()), ("last", pa.int32()), ("repeated", pa.bool_())]
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = _Powers()
        for b in batches:
            for at in range(0, b.num_rows, BATCH_ROWS):
                part = b.slice(at, BATCH_ROWS)
                found = [span_hashes(t or "", powers) for t in part.column(2).to_pylist()]
                row = np.repeat(np.arange(len(found)), [len(f[0]) for f in found])
                first, last = (np.concatenate([f[k] for f in found]) for k in (0, 1))
                h1, h2 = (np.concatenate([f[2][k] for f in found]) for k in (0, 1))
                ids = part.column(0).fill_null(0).to_numpy(zero_copy_only=False)
                none, texts = part.column(0).is_null().to_numpy(zero_copy_only=False), part.column(1).to_numpy(zero_copy_only=False)
                order = np.lexsort((first, texts[row], ids[row], none[row], h2, h1))
                again = np.zeros(len(row), bool)
                again[order[1:]] = (h1[order[1:]] == h1[order[:-1]]) & (h2[order[1:]] == h2[order[:-1]])
                # Rows that are alike in everything are one document, not a repetition.
                twin = np.zeros(len(row), bool)
                same = [x[order[1:]] == x[order[:-1]] for x in (first, texts[row], ids[row], none[row])]
                twin[order[1:]] = again[order[1:]] & np.logical_and.reduce(same)
                keep = ~twin
                spread = (texts[row].view(np.uint64) + np.arange(len(row), dtype=np.uint64) * np.uint64(_BASES[0]))
                own = np.where(again, spread, h1)
                yield batch(
                    schema,
                    pa.array(own.view(np.int64)[keep]),
                    pa.array(np.where(again, np.uint64(0), h2).view(np.int64)[keep]),
                    part.column(0).take(pa.array(row[keep])),
                    pa.array(texts[row][keep]),
                    pa.array(first.astype(np.int32)[keep]),
                    pa.array(last.astype(np.int32)[keep]),
                    pa.array(again[keep]),
                )

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    return map_batches(
        slim, "h1 long, h2 long, doc_id long, text_hash long, first int, last int, repeated boolean", work
    )


def repeated_spans(docs: DataFrame) -> DataFrame:
    """``doc_id, text_hash, first, last`` of the runs that are not the first of their kind."""
    place = F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash", "first")
    found = spans(docs).withColumn("place", place)
    earliest = F.min("place").over(Window.partitionBy("h1", "h2", "repeated"))
    return (
        found.withColumn("earliest", earliest)
        .where("repeated or place != earliest")
        .select("doc_id", "text_hash", "first", "last")
    )


def _without(text: str, cuts: list) -> tuple[str, int]:
    pieces, at, _ = sentences_of(text)
    gone = np.zeros(len(at) + 1, np.int64)
    for cut in cuts:
        gone[cut["first"]] += 1
        gone[cut["last"]] -= 1
    gone = np.cumsum(gone)[:-1] > 0
    drop = {at[k] for k in np.flatnonzero(gone).tolist()}
    return "".join([p for k, p in enumerate(pieces) if k not in drop]), len(drop)


def drop_repeated_passages(docs: DataFrame) -> DataFrame:
    """``docs`` without the sentences of repeated passages, and ``n_removed``, the number of those.

    ``n_removed`` replaces a column of that name; a document may become empty, but no row goes. Texts
    without repeated runs, empty and null ones stay exactly as they are. Rows that agree in id and text
    are one document; of other rows with the same text, that with the smallest id keeps it (null ids
    last). An empty table gives an empty one.
    """
    plain = docs.select(*[c for c in docs.columns if c != "n_removed"])
    cuts = repeated_spans(plain).groupBy(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")).agg(
        F.collect_set(F.struct("first", "last")).alias("__cuts")
    )
    joined = plain.join(
        cuts,
        plain["doc_id"].cast("long").eqNullSafe(F.col("__id")) & (F.xxhash64(plain["text"]) == F.col("__hash")),
        "left",
    )
    names = [*plain.columns, "n_removed"]
    # Columns other than the text pass through as one value, whatever they are called.
    others = [c for c in plain.columns if c != "text"]
    packed = joined.select(
        F.struct(*[plain[c].alias(f"c{k}") for k, c in enumerate(others)]).alias("own"), plain["text"].alias("text"), "__cuts"
    )
    schema = packed.select("own", "text").schema.add("n_removed", "long")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            done = [
                (t, 0) if t is None or not c else _without(t, c)
                for t, c in zip(b.column(1).to_pylist(), b.column(2).to_pylist())
            ]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([t for t, _ in done], pa.string()), pa.array([n for _, n in done], pa.int64())],
                names=["own", "text", "n_removed"],
            )

    from_own = {c: F.col(f"own.c{k}").alias(c) for k, c in enumerate(others)}
    return map_batches(packed, schema, work).select(*[from_own.get(c, F.col(c)) for c in names])
