"""A small table next to the data that keeps what plain files cannot: the tags of each object."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rateloom.sources.files import MANIFEST  # hidden from Spark's readers by the underscore


def append_manifest(rows: DataFrame, root: str) -> None:
    """Append ``key, tags, written_at`` rows."""
    rows.select("key", "tags", "written_at").write.mode("append").json(f"{root.rstrip('/')}/{MANIFEST}")


def read_manifest(spark: SparkSession, root: str, write_id: str = "") -> DataFrame:
    """What is noted under ``root``, or by one write: ``key, tags, written_at``; tags may be null."""
    schema = "key string, tags string, written_at timestamp_ntz"
    return spark.read.schema(schema).json(f"{root.rstrip('/')}/{MANIFEST}/{write_id}*.json")
