"""Object sink: a Python data source that puts one object per row from the executors."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime, timezone

import pyarrow as pa
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from rateloom.functions import stamped_key, tag_string
from rateloom.sources.files import MANIFEST, PENDING, open_storage

from .manifest import read_manifest

FORMAT = "rateloom_objects"


@dataclass
class _Written(WriterCommitMessage):
    count: int


class ObjectWriter(DataSourceArrowWriter):
    """Puts ``content`` under ``<path>/<key>`` and notes key and tags in the manifest.

    An object appears under its key only when it is complete, and putting it again gives the same
    object; a task's part of the manifest is named after its partition. So a task that is repeated
    does no harm.
    """

    def __init__(self, root: str, write_id: str, written_at: str) -> None:
        self.root, self.write_id, self.written_at = root, write_id, written_at

    def write(self, batches: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        system, base = open_storage(self.root)
        task = TaskContext.get()
        # Object stores show an object when its upload ends; a file is moved into place.
        moves = system.type_name == "local"
        pending = f"{base}/{PENDING}/{self.write_id}-{task.taskAttemptId()}"
        folders: set[str] = set()

        def put(key: str, content: pa.Buffer) -> None:
            target = f"{base}/{key}"
            for folder in (target.rpartition("/")[0], pending) if moves else (target.rpartition("/")[0],):
                if folder not in folders:
                    system.create_dir(folder, recursive=True)
                    folders.add(folder)
            with system.open_output_stream(f"{pending}/object" if moves else target, compression=None) as stream:
                stream.write(content)
            if moves:
                system.move(f"{pending}/object", target)

        noted = []
        for batch in batches:
            columns = [batch.column(name) for name in ("key", "content", "tags")]
            for key, content, tags in zip(*columns):
                put(key.as_py(), content.as_buffer())
                row = {"key": key.as_py(), "tags": tags.as_py(), "written_at": self.written_at}
                noted.append(json.dumps(row) + "\n")
        if noted:
            lines = "".join(noted).encode()
            put(f"{MANIFEST}/{self.write_id}-{task.partitionId()}.json", pa.py_buffer(lines))
        return _Written(len(noted))


class ObjectSink(DataSource):
    """``df.write.format('rateloom_objects').option('path', root)`` over ``key, content, tags`` rows."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "key string, content binary, tags string"

    def writer(self, schema, overwrite: bool) -> ObjectWriter:
        if overwrite:
            raise ValueError("objects are only added or replaced one by one: use mode('append')")
        now = datetime.now(timezone.utc).replace(tzinfo=None).isoformat()
        return ObjectWriter(
            self.options["path"],
            self.options.get("write_id", uuid.uuid4().hex),
            self.options.get("written_at", now),
        )


def write_objects(objects: DataFrame, root: str, use_timestamp: bool = False) -> DataFrame:
    """Put every row of ``objects(key, content[, tags])`` and return the keys used.

    ``use_timestamp`` puts the UTC time before each key. ``tags``, a map, goes to the manifest. The
    rows are computed once: the keys returned are read from the manifest of this write.
    """
    spark = objects.sparkSession
    write_id = uuid.uuid4().hex
    now = datetime.now(timezone.utc).replace(tzinfo=None).isoformat()
    stamp = F.lit(now).cast("timestamp_ntz") if use_timestamp else None
    tags = F.lit(None).cast("string")
    if "tags" in objects.columns:
        tags = F.when(F.size("tags") > 0, tag_string("tags"))
    rows = objects.select(
        stamped_key("key", stamp).alias("key"),
        F.col("content").cast("binary").alias("content"),
        tags.alias("tags"),
    )
    spark.dataSource.register(ObjectSink)
    sink = rows.write.format(FORMAT).options(path=root, write_id=write_id, written_at=now)
    sink.mode("append").save()
    try:
        return read_manifest(spark, root, write_id).select("key")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "key string")
