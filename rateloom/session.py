"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession


def shuffle_partitions(shuffle_bytes: int, per_task: int = 200 << 20) -> int:
    """Partitions to start a shuffle of that size with; AQE merges small ones, but never adds any."""
    return max(200, -(-shuffle_bytes // per_task))


def build_session(
    app_name: str = "rateloom",
    master: str | None = None,
    shuffle_bytes: int | None = None,
    **conf: str,
) -> SparkSession:
    """A session pinned to UTC, with AQE on.

    ``shuffle_bytes`` is the largest shuffle expected (after map-side aggregation), so that its tasks
    fit in memory: Spark's default of 200 partitions suits some 40 GB. Executors are sized by
    spark-submit.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Keeps the state of streams on disk rather than on the heap.
        "spark.sql.streaming.stateStore.providerClass": (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        ),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    if shuffle_bytes is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions(shuffle_bytes))
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, name: str, root: str | None = None) -> str:
    """A fresh folder path under ``root``, or the shared folder named in ``spark.checkpoint.dir``.

    There is no default: on a cluster a machine's own folder would be another one for every executor.
    """
    root = root or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if "://" not in root:
        root = os.path.abspath(root)
    return f"{root.rstrip('/')}/rateloom/{name}-{uuid.uuid4().hex}"
