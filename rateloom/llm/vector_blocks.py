"""Vectors in whole numbers, in blocks of near ones, and tiles of queries that meet the blocks.

A block is one row of a written table: some thousand vectors that a key brings together, their ids and
further whole numbers of each, as plain arrays. Every partition of the key's range is a ``part`` of one or
more blocks (``cut``). Queries leave the block they stand in as a tile. Tiles go to all parts in groups, so
a task holds one part and a bounded number of tiles whatever the tables' sizes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rateloom.llm.common import map_batches

#: Vectors that a part should have; a part with over twice as many has several blocks.
BLOCK = 8192
#: Parts whose tiles meet a part in one call.
TILES_AT_ONCE = 256
#: The place of a null id among equal scores: after all others.
NO_ID = np.iinfo(np.int64).max
#: Whole numbers up to here are exact in double precision.
EXACT = 1 << 53

_KINDS = {2: np.dtype("<i2"), 4: np.dtype("<i4"), 8: np.dtype("<i8")}


def finite(column: str):
    """Not null, and neither null, NaN nor infinite in any component."""
    return F.expr(
        f"coalesce({column} is not null and forall({column}, x -> x is not null and not isnan(x) and abs(x) < double('infinity')), false)"
    )


def narrow(values: np.ndarray) -> bytes:
    """Whole numbers as bytes, after their width in bytes."""
    most = int(np.abs(values).max(initial=0))
    width = 2 if most < 1 << 15 else 4 if most < 1 << 31 else 8
    return bytes([width]) + values.astype(_KINDS[width]).tobytes()


def widened(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, _KINDS[raw[0]], offset=1).astype(np.int64)


def whole_rows(table: DataFrame, scale: int, columns: dict) -> DataFrame:
    """``vec_id, <columns>, tie, vector`` of the rows with a finite ``embedding``: floor(scale * x) of its
    components, x in double precision. ``tie`` tells rows apart. A component of 2^62 or more is an error."""
    schema = pa.schema([("vec_id", pa.int64()), *((c, pa.int64()) for c in columns), ("tie", pa.int64()), ("vector", pa.binary())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            vectors = b.column(b.num_columns - 1)
            x = np.floor(scale * vectors.flatten().to_numpy(zero_copy_only=False))
            if np.abs(x).max(initial=0) >= 2.0**62:
                raise OverflowError("a component is too large for whole numbers of 64 bits")
            ends = np.cumsum(np.array(pa.compute.list_value_length(vectors)))
            own = [narrow(v) for v in np.split(x.astype(np.int64), ends[:-1])] if len(ends) else []
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(own, pa.binary())], schema=schema)

    rows = table.where(finite("embedding")).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        *(c.cast("long").alias(name) for name, c in columns.items()),
        F.monotonically_increasing_id().alias("tie"),
        F.col("embedding").cast("array<double>").alias("vector"),
    )
    return map_batches(rows, "vec_id long, " + "".join(f"{c} long, " for c in columns) + "tie long, vector binary", work)


def block_schema(extras: list[str]) -> str:
    return "part int, cut int, n int, ids binary, " + "".join(f"{c} binary, " for c in extras) + "vectors binary"


def matrix_of(vectors: list[bytes]) -> np.ndarray:
    """A row per vector; shorter ones get zeros."""
    rows = [widened(v) for v in vectors]
    matrix = np.zeros((len(rows), max(map(len, rows), default=0)), np.int64)
    for k, row in enumerate(rows):
        matrix[k, : len(row)] = row
    return matrix


def blocks_of(rows: DataFrame, keys: list[str], extras: list[str], n_rows: int) -> DataFrame:
    """``rows`` (as ``whole_rows`` gives them) as blocks of near ``keys``. Shorter vectors get zeros.

    Rows of one key are dealt to parts by id and ``tie``, so copies don't meet in one part.
    """
    schema = pa.schema(
        [("part", pa.int32()), ("cut", pa.int32()), ("n", pa.int32()), ("ids", pa.binary()), *((c, pa.binary()) for c in extras), ("vectors", pa.binary())]
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, cut, held = TaskContext.get().partitionId(), 0, []

        def block(table: pa.Table) -> pa.RecordBatch:
            ids, *own, vectors = (table.column(c) for c in ("vec_id", *extras, "vector"))
            matrix = matrix_of(vectors.to_pylist())
            packed = [ids.fill_null(NO_ID).to_numpy(), *(c.to_numpy() for c in own)]
            return pa.RecordBatch.from_arrays(
                [*(pa.array([x], pa.int32()) for x in (part, cut, len(matrix))), *(pa.array([x.astype(np.int64).tobytes()]) for x in packed), pa.array([narrow(matrix)])],
                schema=schema,
            )

        for b in batches:
            if b.num_rows:
                held.append(b)
            while sum(x.num_rows for x in held) > 2 * BLOCK:
                table = pa.Table.from_batches(held)
                yield block(table.slice(0, BLOCK))
                held, cut = table.slice(BLOCK).to_batches(), cut + 1
        if held:
            yield block(pa.Table.from_batches(held))

    order = [*keys, "vec_id", "tie"]
    dealt = rows.repartitionByRange(max(1, round(n_rows / BLOCK)), *order).sortWithinPartitions(*order)
    return map_batches(dealt, block_schema(extras), work)


class Block:
    """A row of a table of blocks: ``ids``, ``numbers`` (the extras) and ``vectors``, a row per vector."""

    def __init__(self, row: dict, extras: list[str] = ()):
        self.place, self.size = (row["part"], row["cut"]), row["n"]
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.numbers = {c: np.frombuffer(row[c], np.int64) for c in extras}
        whole = widened(row["vectors"]).reshape(self.size, -1)
        self.most, self.dim = int(np.abs(whole).max(initial=0)), whole.shape[1]
        self.whole, self.vectors = whole, whole.astype(np.float64)

    def fitting(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Vectors and queries of one length, in a type that holds all their products exactly."""
        dim = max(self.dim, queries.shape[1])
        exact = self.most * int(np.abs(queries).max(initial=0)) * max(1, dim) < EXACT
        wide = [np.pad(m, ((0, 0), (0, dim - m.shape[1]))) if m.shape[1] < dim else m for m in (self.vectors if exact else self.whole, queries)]
        return wide[0], wide[1].astype(np.float64) if exact else wide[1].astype(object)


def leading(scores: np.ndarray, ids: np.ndarray, top: int) -> np.ndarray:
    """Places of the highest scores, equal ones by ascending id."""
    if len(scores) > 4 * top:
        far = len(scores) - top
        least = np.partition(scores, far)[far]
        some = np.flatnonzero(scores >= least)
        return some[np.lexsort((ids[some], -scores[some]))[:top]]
    return np.lexsort((ids, -scores))[:top]


def number_of_parts(blocks: DataFrame) -> int:
    return int(blocks.agg(F.max("part")).first()[0] or 0) + 1


def meet(tiles: DataFrame, blocks: DataFrame, schema: str, work: Callable[[pa.Table, pa.Table], pa.Table]) -> DataFrame:
    """``work`` of every part's blocks with the tiles of a group of parts, over all parts and groups.

    This is the stated set of queries against all rows, in blocks: a tile is sent to every part, a part
    to every group of ``TILES_AT_ONCE`` parts' tiles.
    """
    n_parts = number_of_parts(blocks)
    groups = -(-n_parts // TILES_AT_ONCE)
    sent = tiles.withColumns({"block_part": F.explode(F.sequence(F.lit(0), F.lit(n_parts - 1))), "tile_group": F.col("part") % groups})
    ready = blocks.withColumns({"block_part": F.col("part"), "tile_group": F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))})
    keys = ["block_part", "tile_group"]
    return ready.groupBy(*keys).cogroup(sent.groupBy(*keys)).applyInArrow(work, schema)
