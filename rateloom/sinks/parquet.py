"""Parquet sink."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from rateloom.functions import now_utc, tag_string

from .manifest import append_manifest


def _exists(spark, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def _delete(spark, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def write_parquet(
    df: DataFrame,
    root: str,
    prefix: str,
    filename: str | None = None,
    tags: dict[str, str] | None = None,
    partition_by: Sequence[str] = (),
    single_file: bool = False,
) -> str:
    """Write ``df`` to ``<root>/<prefix>/<filename>`` and return that URI.

    The target is a folder of files written in parallel, named by the UTC time unless ``filename``
    (ending in .parquet) is given. With ``partition_by`` the rows are rebalanced on those columns,
    so each value gets few files and AQE splits a value that holds much of the data. ``single_file``
    writes through one task and is meant for small outputs. An existing target is an error; so is
    an empty result, which leaves nothing behind. Tags go to the manifest.
    """
    if filename is None:
        filename = f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S}.parquet"
    elif not filename.endswith(".parquet"):
        raise ValueError(f"not a .parquet name: {filename!r}")
    if single_file and partition_by:
        raise ValueError("a single file cannot be partitioned")
    spark = df.sparkSession
    key = "/".join(p for p in (prefix.strip("/"), filename) if p)
    uri = f"{root.rstrip('/')}/{key}"
    # Counted while they are written: a test beforehand would run the plan twice, one afterwards read it all.
    counted = Observation()
    rows = df.hint("rebalance", *partition_by) if partition_by else df
    rows = rows.observe(counted, F.count(F.lit(1)).alias("rows"))
    if single_file:
        rows = rows.coalesce(1)
    was_there = _exists(spark, uri)
    writer = rows.write.mode("errorifexists")
    try:
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(uri)
    except Exception:
        # What this call began would be in the way of a retry; a target that was there stays.
        if not was_there:
            _delete(spark, uri)
        raise
    if not counted.get["rows"]:
        _delete(spark, uri)
        raise ValueError(f"no rows to write to {uri}")
    if tags:
        pairs = F.create_map(*[F.lit(x) for pair in tags.items() for x in pair])
        row = spark.range(1).select(
            F.lit(key).alias("key"), tag_string(pairs).alias("tags"), now_utc().alias("written_at")
        )
        append_manifest(row, root)
    return uri
