"""What several operators share: written tables, connected components, batch loops."""

from __future__ import annotations

import ctypes
import functools
import sys
import tempfile
import types
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a local session without the setting gets one of its own."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = _own_folder()
    return root.rstrip("/")


@functools.cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="rateloom-")


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df`` from a table in the shared folder: computed once, kept if executors are lost."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def worker_state(owner: str) -> dict:
    """A place in a Python worker that outlives a task, as Spark reuses its workers.

    A worker serves one owner at a time: what others kept is let go, so that a job of several operators
    needs no more memory than the largest of them.
    """
    module = sys.modules.setdefault("rateloom_worker_state", types.ModuleType("rateloom_worker_state"))
    held = module.__dict__.setdefault("held", {})
    if list(held) != [owner]:
        held.clear()
        held[owner] = {}
        give_back()
    return held[owner]


def give_back() -> None:
    """Returns memory that this process has freed to the machine: allocators keep it otherwise, and a Python
    worker lives on when its task is over."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


#: Rows and bytes of text that are worked on at once, about; a longer text makes a slice by itself.
SLICE_ROWS = 2048
SLICE_BYTES = 8 << 20


def slices(b: pa.RecordBatch, at: int) -> Iterator[pa.RecordBatch]:
    """``b`` in slices bounded by rows and by the bytes of the texts in column ``at``."""
    sizes = pa.compute.fill_null(pa.compute.binary_length(b.column(at)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    first = 0
    while first < b.num_rows:
        before = int(ends[first - 1]) if first else 0
        last = int(np.searchsorted(ends, before + SLICE_BYTES, "right"))
        last = min(max(last, first + 1), first + SLICE_ROWS, b.num_rows)
        yield b.slice(first, last - first)
        first = last


def map_batches(
    df: DataFrame, schema: str, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]
) -> DataFrame:
    """``mapInArrow``; what a task has freed goes back to the machine at its end."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(batches)
        give_back()

    return df.mapInArrow(task, schema)


def batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    arrays = [
        c if isinstance(c, pa.Array) else pa.array(c, type=f.type, from_pandas=False)
        for c, f in zip(columns, schema)
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def linked_to(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """``root`` (the place that every place hangs on, its own at first) after linking ``i`` with ``j``."""
    root = root.copy()
    while len(i):
        ri, rj = root[i], root[j]
        apart = ri != rj
        i, j, ri, rj = i[apart], j[apart], ri[apart], rj[apart]
        np.minimum.at(root, np.maximum(ri, rj), np.minimum(ri, rj))
        while (root != root[root]).any():
            root = root[root]
    return root


#: Edges that a task holds before it gives them out as a forest, about.
HELD_EDGES = 1 << 20


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect what those of ``a`` with ``b`` do: each node with the smallest that it reaches."""
    nodes, places = np.unique(np.concatenate([a, b]), return_inverse=True)
    root = linked_to(np.arange(len(nodes)), places[: len(a)], places[len(a) :])
    moved = root != np.arange(len(root))
    return nodes[moved], nodes[root[moved]]


def _forests(edges: DataFrame) -> DataFrame:
    """Edges that connect what ``edges`` do; of each HELD_EDGES that a task reads a forest is left."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in batches:
            held.append([c.to_numpy(zero_copy_only=False) for c in b.columns])
            size += b.num_rows
            if size >= HELD_EDGES:
                yield batch(schema, *map(pa.array, _forest(*np.hstack(held))))
                held, size = [], 0
        if size:
            yield batch(schema, *map(pa.array, _forest(*np.hstack(held))))

    return map_batches(edges, "a long, b long", work)


def _nodes(edges: DataFrame) -> DataFrame:
    """Each ``node`` of ``edges``, with the ``least`` and ``most`` it hangs on and whether some hang on it."""
    ends = F.expr("inline(array(struct(a as node, b as up), struct(b as node, cast(null as bigint) as up)))")
    return edges.select(ends).groupBy("node").agg(
        F.min("up").alias("least"), F.max("up").alias("most"), (F.count("up") < F.count(F.lit(1))).alias("below")
    )


def _large_star(edges: DataFrame) -> DataFrame:
    # As many rows as edges at most; the small star that follows leaves each once.
    both = edges.select(F.expr("inline(array(struct(a, b), struct(b as a, a as b)))"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    # The edge to the smallest stays, the ends of the others move to the smallest.
    moved = F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a")
    return edges.join(least, "a").select(moved, F.col("m").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` of the undirected ``edges (a, b)``; the component is its smallest node.

    What a task reads of the edges it joins by itself. Large-star and small-star steps join the rest, in
    turn until every node hangs on the smallest one it reaches. Every round is written to the shared
    folder; only a count reaches the driver. Nodes are long; nulls and loops are ignored; nodes without
    an edge don't appear.
    """
    now = written(
        edges.where("a is not null and b is not null and a != b").select(
            F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")
        ),
        "edges",
    )
    while True:
        nodes = _nodes(_forests(now))
        left = nodes.where("least != most or least is not null and below").agg(F.count(F.lit(1))).first()[0]
        if not left:
            return nodes.select("node", F.coalesce("least", "node").alias("component"))
        now = written(_small_star(_large_star(_forests(now))), "star")
