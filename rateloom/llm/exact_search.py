"""Exact top-k search by inner product: the threshold algorithm over sorted per-dimension lists.

Blocks of vectors that lie on the same sides of random planes keep a list per dimension, sorted by the
component. A query walks all lists of a block at once, from the end that raises its score, and takes the
product with every vector it meets. No vector that it hasn't met can score more than the sum over the
dimensions of the query's component times the one the list stands at; when that bound is below the k-th
best score so far, the block is done. Queries search their own block first, and take the k-th score found
there into all other blocks, of which most end after a few steps or at once. The best of all blocks are
merged. Lists are read in steps of doubling depth, which changes how many vectors are looked at, never the
result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rateloom.llm.common import batch, map_batches, written
from rateloom.llm.vector_blocks import NO_ID, Block, blocks_of, leading, matrix_of, meet, narrow, whole_rows, widened

SCALE = 1024
TOP = 10
EVERY = 100
#: Planes whose sides bring vectors together.
PLANES = 16
#: How deep all lists are read at first; each further step doubles it.
FIRST_DEPTH = 16
SEED = 11

#: The rows of a search: whose they are (block and place in it), and what was found.
_FOUND = "part int, cut int, at int, query_id long, vec_id long, score long"
_FOUND_ARROW = pa.schema(
    [("part", pa.int32()), ("cut", pa.int32()), ("at", pa.int32()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())]
)


def _sides(rows: DataFrame) -> DataFrame:
    """``rows`` with ``side``: on which sides of fixed random planes the vector lies."""
    schema = pa.schema([("vec_id", pa.int64()), ("tie", pa.int64()), ("vector", pa.binary()), ("side", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = matrix_of(b.column(2).to_pylist())
            # A row of numbers per dimension, the same however many there are: zeros at the end change no side.
            planes = np.random.default_rng(SEED).standard_normal((x.shape[1], PLANES))
            yield batch(schema, *b.columns, pa.array((x @ planes > 0) @ (1 << np.arange(PLANES)), pa.int64()))

    return map_batches(rows.select("vec_id", "tie", "vector"), "vec_id long, tie long, vector binary, side long", work)


def _with_lists(blocks: DataFrame) -> DataFrame:
    """``blocks`` with ``lists``: the places of the vectors, a column per dimension, by rising component."""
    names = ["part", "cut", "n", "ids", "vectors"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                own = b.slice(k, 1)
                block = Block(own.to_pylist()[0])
                lists = np.argsort(block.whole, axis=0, kind="stable").astype(np.uint16 if block.size <= 1 << 16 else np.uint32)
                yield pa.RecordBatch.from_arrays([*own.columns, pa.array([lists.tobytes()])], names=[*names, "lists"])

    return map_batches(blocks.select(*names), "part int, cut int, n int, ids binary, vectors binary, lists binary", work)


class Lists:
    """A block of vectors with its sorted lists."""

    def __init__(self, row: dict):
        self.block = Block(row)
        kind = np.uint16 if self.block.size <= 1 << 16 else np.uint32
        self.order = np.frombuffer(row["lists"], kind).reshape(self.block.whole.shape)

    def search(self, queries: np.ndarray, top: int, known: list, own: np.ndarray | None = None):
        """For each query the places and scores of its ``top`` best vectors here, none of them below the
        query's ``known`` score (None: none is known); ``own`` are the places of the queries themselves."""
        n, order = self.block.size, self.order
        vectors, asked = self.block.fitting(queries)
        depths = [0]
        while depths[-1] < n:
            depths.append(min(n, max(FIRST_DEPTH, 2 * depths[-1])))
        # The most that a vector can score which is in no list before a depth, by depth and query.
        dims = np.arange(self.block.dim)
        at = np.array(depths[:-1])[:, None]
        rising, falling = vectors[order[at, dims], dims], vectors[order[n - 1 - at, dims], dims]
        parts = asked[:, : self.block.dim]
        bounds = falling @ np.maximum(parts, 0).T + rising @ np.minimum(parts, 0).T
        for k in range(len(asked)):
            up, down = np.flatnonzero(parts[k] > 0), np.flatnonzero(parts[k] < 0)
            if not len(up) + len(down):
                up = dims[:1]  # a query of zeros: any list has all vectors
            met = np.zeros(n, bool)
            places, scores, least = np.zeros(0, np.int64), np.zeros(0, asked.dtype), known[k]
            if own is not None:
                met[own[k]] = True
            for level, (before, depth) in enumerate(zip(depths, depths[1:])):
                if least is not None and bounds[level, k] < least:
                    break
                if self.block.dim:
                    now = np.zeros(n, bool)
                    now[order[n - depth : n - before, up]] = True
                    now[order[before:depth, down]] = True
                    new = np.flatnonzero(now & ~met)
                else:
                    new = np.flatnonzero(~met)
                met[new] = True
                own_scores = vectors[new] @ asked[k]
                if least is not None:
                    new, own_scores = new[own_scores >= least], own_scores[own_scores >= least]
                places, scores = np.append(places, new), np.append(scores, own_scores)
                best = leading(scores, self.block.ids[places], top)
                places, scores = places[best], scores[best]
                if len(scores) == top:
                    least = scores[-1] if least is None else max(least, scores[-1])
            yield places, scores


def _rows(part: int, cut: int, tile_ids: np.ndarray, tile_at: np.ndarray, found, lists: Lists) -> list[tuple]:
    rows = []
    for query_id, at, (places, scores) in zip(tile_ids.tolist(), tile_at.tolist(), found):
        for i, s in zip(lists.block.ids[places].tolist(), scores.tolist()):
            rows.append((part, cut, at, query_id, None if i == NO_ID else i, int(s)))
    return rows


def _at_home(indexed: DataFrame, every: int, top: int) -> DataFrame:
    """A tile per block with queries: ``part, cut, at, ids, vectors``, and what each finds in its block
    (``found``); ``least`` is its k-th score, null if there are fewer."""
    row = "struct<part:int,cut:int,at:int,query_id:bigint,vec_id:bigint,score:bigint>"
    schema = pa.schema(
        [("part", pa.int32()), ("cut", pa.int32()), ("at", pa.binary()), ("ids", pa.binary()), ("vectors", pa.binary())]
        + [("least", pa.list_(pa.int64())), ("found", pa.list_(pa.struct(list(_FOUND_ARROW))))]
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for block in b.to_pylist():
                lists = Lists(block)
                ids = lists.block.ids
                at = np.flatnonzero((ids % every == 0) & (ids != NO_ID))
                if not len(at):
                    continue
                queries = lists.block.whole[at]
                found = list(lists.search(queries, top, [None] * len(at), at))
                least = [int(s[-1]) if len(s) == top else None for _, s in found]
                own = [dict(zip(_FOUND_ARROW.names, r)) for r in _rows(*lists.block.place, ids[at], at, found, lists)]
                yield batch(
                    schema, [block["part"]], [block["cut"]], [at.astype(np.int64).tobytes()], [ids[at].tobytes()], [narrow(queries)], [least], [own]
                )

    return map_batches(
        indexed, f"part int, cut int, at binary, ids binary, vectors binary, least array<long>, found array<{row}>", work
    )


def top_products(
    table: DataFrame, scale: int = SCALE, top: int = TOP, every: int = EVERY
) -> DataFrame:
    """``query_id, rank, vec_id, score``: of each row whose ``vec_id`` is divisible by ``every`` the ``top``
    other rows with the highest product of floor(scale * x), equal ones by ascending id, null ids last.

    Vectors that are null or hold null or non-finite components take no part; zero and empty vectors do.
    Shorter vectors count as filled up with zeros. Repeated rows are rows of their own: a row is found by
    its copies, and every copy of a query has its own list. An empty table gives no rows; other columns
    are ignored. Products beyond 64 bits are an error.
    """
    rows = written(_sides(whole_rows(table, scale, {})), "sides")
    indexed = written(_with_lists(blocks_of(rows, ["side"], [], rows.count())), "lists")
    tiles = written(_at_home(indexed, every, top), "tiles")

    def work(parts: pa.Table, sent: pa.Table) -> pa.Table:
        rows = []
        for block in parts.to_pylist():
            lists = Lists(block)
            for tile in sent.to_pylist():
                if (tile["part"], tile["cut"]) != lists.block.place:
                    ids, at = (np.frombuffer(tile[c], np.int64) for c in ("ids", "at"))
                    queries = widened(tile["vectors"]).reshape(len(ids), -1)
                    found = lists.search(queries, top, tile["least"])
                    rows += _rows(tile["part"], tile["cut"], ids, at, found, lists)
        return pa.Table.from_pylist([dict(zip(_FOUND_ARROW.names, r)) for r in rows], schema=_FOUND_ARROW)

    away = meet(tiles.drop("found"), indexed, _FOUND, work)
    found = tiles.select(F.inline("found")).union(away)
    order = Window.partitionBy("part", "cut", "at").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("query_id", "rank", "vec_id", "score")


def oracle() -> str:
    return f"""
with numbers as (
  select row_number() over () as r, vec_id, [floor({SCALE} * cast(x as double)) for x in embedding] as v
  from embeddings
  where embedding is not null and len([x for x in embedding if x is null or not isfinite(x)]) = 0
),
scored as (
  select q.r, q.vec_id as query_id, c.vec_id, cast(list_dot_product(q.v, c.v) as bigint) as score
  from numbers q join numbers c on q.r <> c.r where q.vec_id % {EVERY} = 0
),
ranked as (
  select *, row_number() over (partition by r order by score desc, vec_id nulls last) as rank from scored
)
select query_id, cast(rank as integer) as rank, vec_id, score from ranked where rank <= {TOP}
"""
