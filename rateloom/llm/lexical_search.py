"""Ranked lexical search: the best documents of every query text, by presence masks.

One pass over the texts writes postings of the queries' terms, in blocks of documents. A query takes the
bitmap of each of its terms in a block and groups the documents by the mask of terms they hold. All
documents of a mask score at most the sum of its terms' largest parts in the block, so masks are evaluated
by descending maximum score until the next one is below the worst of the best documents so far. A task
carries these from block to block and gives the best of a query once; the best of all tasks are merged.

Terms are runs of letters, digits and characters beyond ASCII; only A-Z are lower-cased. With N documents
that have a term, L terms in all and df documents with the term, a term weighs floor(1000 ln((2N+2)/(2df+1)));
tf occurrences in a document of n terms count (10^9 tf) div (1000 tf + 20 m), m being 50 + (50 n N) div L.

Only terms of the queries are kept, so texts are never shuffled. Queries go through in blocks of some
``TERMS_AT_ONCE`` terms, which bounds what is broadcast; each block of queries is a pass over the documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rateloom.llm.common import batch, map_batches, written

TOP = 50
#: Terms of the queries that one pass over the documents looks for, about.
TERMS_AT_ONCE = 1 << 16
#: A block of documents is closed at so many documents or words; a longer document makes a longer block.
BLOCK_DOCS = 4096
BLOCK_WORDS = 1 << 21
#: Documents of the best masks that are evaluated at first; each further step takes twice as many.
FIRST_STEP = 64
#: The place of a null id among equal scores: after all others.
NO_ID = np.iinfo(np.int64).max

_SEPARATORS = bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
_UPPER = bytes(range(0x41, 0x5B))
#: Bytes beyond ASCII belong to terms, so folding and cutting UTF-8 is the same as doing so to characters.
_FOLD = bytes.maketrans(_SEPARATORS + _UPPER, b" " * len(_SEPARATORS) + _UPPER.lower())

POSTINGS = pa.schema(
    [("n_docs", pa.int64()), ("n_words", pa.int64()), ("doc_ids", pa.binary()), ("sizes", pa.binary())]
    + [("terms", pa.binary()), ("df", pa.binary()), ("places", pa.binary()), ("tf", pa.binary())]
)
_POSTINGS = "n_docs long, n_words long, doc_ids binary, sizes binary, terms binary, df binary, places binary, tf binary"


def split_terms(text: str | None) -> list[bytes]:
    """The terms of a text in UTF-8, in order, with repeats; none for null."""
    return (text or "").encode().translate(_FOLD).split()


def query_terms(queries: DataFrame, key: str, text: str) -> DataFrame:
    """``key, terms`` of the distinct queries; a query without terms is left out."""
    schema = pa.schema([("key", pa.int64()), ("terms", pa.list_(pa.binary()))])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            terms = [sorted(set(split_terms(t))) for t in b.column(1).to_pylist()]
            found = batch(schema, b.column(0), terms)
            yield found.filter(pa.array([bool(t) for t in terms], pa.bool_()))

    own = queries.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text")).distinct()
    return map_batches(own, "key long, terms array<binary>", work)


def postings(docs: DataFrame, vocabulary) -> DataFrame:
    """Blocks of documents that have a term: their ids and sizes, and where the terms of the broadcast
    ``vocabulary`` (term to number) occur. ``places`` are sorted within a term."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = vocabulary.value.get
        ids, sizes, found, held = [], [], [], 0

        def block():
            of = np.repeat(np.arange(len(found)), [len(f) for f in found])
            term = np.concatenate(found)
            keys, tf = np.unique(term.astype(np.int64) * len(found) + of, return_counts=True)
            term, place = keys // len(found), keys % len(found)
            terms, df = np.unique(term, return_counts=True)
            columns = (np.array(ids, np.int64), np.array(sizes, np.int64), terms.astype(np.int32), df.astype(np.int32), place.astype(np.int32), tf.astype(np.int64))
            return batch(POSTINGS, [len(ids)], [sum(sizes)], *([c.tobytes()] for c in columns))

        for b in batches:
            for doc_id, text in zip(b.column(0), b.column(1)):
                terms = split_terms(text.as_py())
                if not terms:
                    continue
                ids.append(doc_id.as_py() if doc_id.is_valid else NO_ID)
                sizes.append(len(terms))
                got = np.fromiter(map(number, terms, repeat(-1)), np.int32, len(terms))
                found.append(got[got >= 0])
                held += len(terms)
                if len(ids) >= BLOCK_DOCS or held >= BLOCK_WORDS:
                    yield block()
                    ids, sizes, found, held = [], [], [], 0
        if ids:
            yield block()

    return map_batches(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), _POSTINGS, work)


def document_counts(blocks: DataFrame, n_terms: int) -> np.ndarray:
    """How many documents hold each term of the vocabulary, which bounds what reaches the driver."""
    schema = pa.schema([("term", pa.int32()), ("df", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_terms, np.int64)
        for b in batches:
            for terms, df in zip(b.column(0), b.column(1)):
                total[np.frombuffer(terms.as_py(), np.int32)] += np.frombuffer(df.as_py(), np.int32)
        used = np.flatnonzero(total)
        yield batch(schema, pa.array(used.astype(np.int32)), pa.array(total[used]))

    rows = map_batches(blocks.select("terms", "df"), "term int, df long", work)
    counts = np.zeros(n_terms, np.int64)
    for r in rows.groupBy("term").agg(F.sum("df").alias("df")).collect():
        counts[r["term"]] = r["df"]
    return counts


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def length_norm(sizes: np.ndarray, n_docs: int, n_words: int) -> np.ndarray:
    """``m`` of documents of these sizes."""
    if int(sizes.max()) * 50 * n_docs < 1 << 62:
        return 50 + 50 * sizes * n_docs // n_words
    return np.array([50 + 50 * int(n) * n_docs // n_words for n in sizes], np.int64)


def grouped(masks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Columns of equal bits in ``masks`` (terms x documents, 0 or 1): a column of each group, and the
    group of every column."""
    packed = np.packbits(masks, axis=0)
    words = np.zeros((-(-len(packed) // 8) * 8, masks.shape[1]), np.uint8)
    words[: len(packed)] = packed
    words = np.ascontiguousarray(words.T).view(np.uint64).T
    _, first, group = np.unique(words[0], return_index=True, return_inverse=True)
    for word in words[1:]:
        _, other = np.unique(word, return_inverse=True)
        _, first, group = np.unique(group * (int(other.max()) + 1) + other, return_index=True, return_inverse=True)
    return first, group


class Block:
    """The postings of a block of documents, with what every occurrence adds before its term's weight."""

    def __init__(self, row: dict, n_docs: int, n_words: int):
        kinds = {"doc_ids": np.int64, "sizes": np.int64, "terms": np.int32, "df": np.int32, "places": np.int32, "tf": np.int64}
        doc_ids, sizes, self.terms, df, places, tf = (np.frombuffer(row[k], kind) for k, kind in kinds.items())
        self.doc_ids, self.size = doc_ids, len(doc_ids)
        row_of = np.repeat(np.arange(len(df)), df)
        self.parts = 10**9 * tf // (1000 * tf + 20 * length_norm(sizes, n_docs, n_words)[places])
        self.keys = row_of * self.size + places
        starts = np.cumsum(df) - df
        self.most = np.maximum.reduceat(self.parts, starts) if len(df) else np.zeros(0, np.int64)
        self.bitmaps = np.zeros((len(df), -(-self.size // 8)), np.uint8)
        np.bitwise_or.at(self.bitmaps, (row_of, places >> 3), np.uint8(128) >> (places & 7).astype(np.uint8))

    def best(self, terms: np.ndarray, weights: np.ndarray, scores: np.ndarray, ids: np.ndarray, top: int):
        """``scores, ids`` (the best so far) with the documents of this block."""
        at = np.searchsorted(self.terms, terms)
        there = (at < len(self.terms)) & (weights > 0)
        there[there] = self.terms[at[there]] == terms[there]
        rows, weights = at[there], weights[there]
        if not len(rows):
            return scores, ids
        masks = np.unpackbits(self.bitmaps[rows], axis=1, count=self.size)
        first, group = grouped(masks)
        of_group = masks[:, first]
        bound = (weights * self.most[rows]) @ of_group.astype(np.int64)
        by_group = np.argsort(group, kind="stable")
        ends = np.cumsum(np.bincount(group, minlength=len(first)))
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > 0]
        done, step = 0, FIRST_STEP
        sizes = np.cumsum((ends - np.append(0, ends[:-1]))[order])
        while done < len(order):
            if len(scores) == top and bound[order[done]] < scores[-1]:
                break
            before = sizes[done - 1] if done else 0
            until = max(done + 1, int(np.searchsorted(sizes, before + step)))
            some = order[done:until]
            if len(scores) == top:
                some = some[bound[some] >= scores[-1]]
            docs = np.concatenate([by_group[ends[g - 1] if g else 0 : ends[g]] for g in some])
            which, doc = np.nonzero(masks[:, docs])
            added = weights[which] * self.parts[np.searchsorted(self.keys, rows[which] * self.size + docs[doc])]
            own = np.zeros(len(docs), np.int64)
            np.add.at(own, doc, added)
            scores, ids = leading(np.append(scores, own), np.append(ids, self.doc_ids[docs]), top)
            done, step = until, 2 * step
        return scores, ids


def leading(scores: np.ndarray, ids: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    """The highest scores above 0, equal ones by ascending id."""
    order = np.lexsort((ids, -scores))[:top]
    order = order[scores[order] > 0]
    return scores[order], ids[order]


def _ranked(docs: DataFrame, queries: list[tuple[int | None, list[bytes]]], top: int) -> DataFrame:
    spark = docs.sparkSession
    vocabulary = {t: i for i, t in enumerate(sorted({t for _, terms in queries for t in terms}))}
    blocks = written(postings(docs, spark.sparkContext.broadcast(vocabulary)), "postings")
    total = blocks.agg(F.sum("n_docs").alias("n_docs"), F.sum("n_words").alias("n_words")).first()
    n_docs, n_words = int(total["n_docs"] or 0), int(total["n_words"] or 0)
    counts = document_counts(blocks, len(vocabulary))
    weights = np.array([weight(n_docs, int(n)) if n else 0 for n in counts], np.int64)
    numbers = [np.array([vocabulary[t] for t in terms], np.int32) for _, terms in queries]
    known = spark.sparkContext.broadcast(([(n, weights[n]) for n in numbers], n_docs, n_words))
    keys = [key for key, _ in queries]
    schema = pa.schema([("query", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, n_docs, n_words = known.value
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in asked]
        for b in batches:
            for row in b.to_pylist():
                block = Block(row, n_docs, n_words)
                for k, (terms, weights) in enumerate(asked):
                    best[k] = block.best(terms, weights, *best[k], top)
        for k, (scores, ids) in enumerate(best):
            if len(ids):
                yield batch(schema, pa.array(np.full(len(ids), k)), pa.array(ids, mask=ids == NO_ID), pa.array(scores))

    found = map_batches(blocks.drop("n_docs", "n_words"), "query long, doc_id long, score long", work)
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    # The keys of this block of queries: as many rows as were broadcast with their terms.
    names = spark.createDataFrame(list(enumerate(keys)), "query long, item_id long")
    return ranked.join(F.broadcast(names), "query").select("item_id", "rank", "doc_id", "score")


def rank_documents(
    docs: DataFrame, queries: DataFrame, top: int = TOP, key: str = "item_id", terms_at_once: int = TERMS_AT_ONCE
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``top`` best documents above 0 of each query ``(key, text)``.

    Null and termless texts have no terms: such documents count nowhere, such queries get no rows. Equal
    scores are ranked by ascending id, null ids last. Repeated rows of a document are documents of their
    own; repeated queries count once, and queries of one key but different texts each have their ranks. A
    very long text makes a block by itself. Empty tables give no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    asked = written(query_terms(queries, key, "text"), "query-terms")
    n_terms = asked.agg(F.sum(F.size("terms"))).first()[0] or 0
    n_blocks = max(1, -(-int(n_terms) // terms_at_once))
    results = []
    for k in range(n_blocks):
        part = asked.where(F.pmod(F.xxhash64("key", "terms"), F.lit(n_blocks)) == k).collect()
        if part:
            own = [(r["key"], [bytes(t) for t in r["terms"]]) for r in part]
            results.append(written(_ranked(docs, own, top), "ranked"))
    if not results:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return reduce(DataFrame.union, results)


def oracle() -> str:
    upper, terms = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ'", r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'"
    cut = f"regexp_extract_all(translate(text, {upper}, lower({upper})), {terms})"
    return f"""
with numbered as (select row_number() over () as r, doc_id, {cut} as terms from documents),
occurring as (select r, unnest(terms) as term from numbered),
counted as (select r, term, count(*) as tf from occurring group by r, term),
sized as (select r, cast(sum(tf) as bigint) as n from counted group by r),
totals as (select count(*) as n_docs, cast(sum(n) as bigint) as n_words from sized),
asked as (select distinct item_id, unnest({cut}) as term from benchmark),
weighed as (
  select term, cast(floor(1000 * ln((2 * n_docs + 2) / cast(2 * count(*) + 1 as double))) as bigint) as w
  from counted, totals where term in (select term from asked) group by term, n_docs
),
scored as (
  select item_id, r, cast(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_words)))) as bigint) as score
  from asked join weighed using (term) join counted using (term) join sized using (r), totals
  group by item_id, r
),
ranked as (
  select item_id, row_number() over (partition by item_id order by score desc, doc_id nulls last) as rank, doc_id, score
  from scored join numbered using (r) where score > 0
)
select item_id, cast(rank as integer) as rank, doc_id, score from ranked where rank <= {TOP}
"""
