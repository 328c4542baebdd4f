"""Object listing and reading, on executors.

Spark's binaryFile source is not used: it skips empty objects and hidden names, and its listing lives
in the driver's memory. Here folders are listed by tasks, and objects are read by the tasks that hold
their keys.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType, LongType, StringType, StructType, TimestampType

from rateloom.functions import mime_type, utc_ntz
from rateloom.session import scratch_dir

# Folders of the sink next to the objects: tags, and objects that are not complete yet.
MANIFEST, PENDING = "_manifest", "_pending"

_FLUSH_ROWS = 50_000
_FLUSH_BYTES = 32 << 20
_TASK_BYTES = 128 << 20

_ENTRY = (
    StructType()
    .add("key", StringType())
    .add("length", LongType())
    .add("modified", TimestampType())
    .add("is_folder", BooleanType())
)


def open_storage(root: str):
    """The file system of ``root`` and the path in it."""
    from pyarrow import fs

    system, base = fs.FileSystem.from_uri(root if "://" in root else f"file://{root}")
    return system, base.rstrip("/")


def _list_folders(folders: DataFrame, root: str) -> DataFrame:
    """The direct entries of every folder in ``folders(key)``."""

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        arrow = pa.schema(
            [
                ("key", pa.string()),
                ("length", pa.int64()),
                ("modified", pa.timestamp("us", tz="UTC")),
                ("is_folder", pa.bool_()),
            ]
        )
        system, base = open_storage(root)
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                found = system.get_file_info(
                    fs.FileSelector(f"{base}/{folder}".rstrip("/"), allow_not_found=True)
                )
                for i in range(0, len(found), _FLUSH_ROWS):
                    part = found[i : i + _FLUSH_ROWS]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([f.path.removeprefix(f"{base}/") for f in part], pa.string()),
                            pa.array([f.size for f in part], pa.int64()),
                            pa.array([f.mtime for f in part], pa.timestamp("us", tz="UTC")),
                            pa.array([f.type == fs.FileType.Directory for f in part], pa.bool_()),
                        ],
                        schema=arrow,
                    )

    return folders.mapInArrow(entries, _ENTRY)


def list_objects(
    spark: SparkSession, root: str, prefix: str = "", where: Column | None = None
) -> DataFrame:
    """``key, name, mime_type, length, modified`` of every object whose key starts with ``prefix``.

    Folders are listed level by level, the folders of a level spread over all cores; the entries of
    one folder come from one call to the storage. Each level is
    written to the shared scratch folder, so the result is one consistent listing that is not
    repeated. ``where`` searches the metadata.
    """
    scratch = scratch_dir(spark, "listing")
    # Only the folder part of the prefix narrows the listing; the rest is tested on the key.
    folders = spark.createDataFrame([(prefix.rpartition("/")[0],)], "key string")
    level = 0
    while True:
        target = f"{scratch}/{level:04d}"
        _list_folders(folders, root).write.parquet(target)
        entries = spark.read.schema(_ENTRY).parquet(target)
        wanted = F.col("key").startswith(prefix) | F.lit(prefix).startswith(F.concat("key", F.lit("/")))
        folders = entries.where(F.col("is_folder") & wanted & ~F.col("key").isin(MANIFEST, PENDING)).select("key")
        if folders.isEmpty():
            break
        # A fixed number of tasks: the rows are few, but each stands for a call to the storage.
        folders, level = folders.repartition(spark.sparkContext.defaultParallelism, "key"), level + 1
    listed = (
        spark.read.schema(_ENTRY)
        .parquet(*[f"{scratch}/{i:04d}" for i in range(level + 1)])
        .where(~F.col("is_folder") & F.col("key").startswith(prefix))
        .select(
            "key",
            F.substring_index("key", "/", -1).alias("name"),
            mime_type("key").alias("mime_type"),
            "length",
            utc_ntz("modified").alias("modified"),
        )
    )
    return listed if where is None else listed.where(where)


def read_objects(spark: SparkSession, root: str, prefix: str = "", where: Column | None = None) -> DataFrame:
    """``key, content`` of every object under the prefix.

    Objects are dealt to as many tasks as shuffles have, whatever their number and size, so that many
    tiny ones are not read by one task; a task holds a few objects at a time.
    """
    listed = list_objects(spark, root, prefix, where)
    return read_keys(listed.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "key"), root)


def read_keys(keys: DataFrame, root: str, column: str = "key") -> DataFrame:
    """``key, content`` of the objects named in ``keys``, read by the tasks that hold the keys.

    A key that does not exist has null content.
    """
    schema = StructType().add("key", StringType()).add("content", BinaryType())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = pa.schema([("key", pa.string()), ("content", pa.binary())])
        system, base = open_storage(root)
        rows, held = [], 0
        for batch in batches:
            for key in batch.column(0).to_pylist():
                try:
                    with system.open_input_stream(f"{base}/{key}", compression=None) as stream:
                        content = stream.read()
                except FileNotFoundError:
                    content = None
                rows.append({"key": key, "content": content})
                held += len(content or b"")
                if held >= _FLUSH_BYTES:
                    yield pa.RecordBatch.from_pylist(rows, schema=arrow)
                    rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    return keys.select(F.col(column).cast("string").alias("key")).mapInArrow(read, schema)
