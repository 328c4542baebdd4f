"""Conversion of amounts as they arrive, at rates that arrive as well, in any order.

Amounts wait until all rates they may be converted at have come: until a rate has been seen that is ``delay``
later (the watermark). What is then due is joined as of its time and written, once. A folder holds::

    amounts/changes, rates/changes    what has arrived, load by load (see ``running``)
    settled/run=<n>                   amounts converted by a run
    runs/run=<n>                      up to which load and time the runs so far have settled

A run that broke off leaves no row in ``runs``; the next one writes its folder anew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rateloom.operators.asof import convert_amounts
from rateloom.sinks.folders import finished
from rateloom.streaming.running import land_change, run_changes


def land_amounts(amounts: DataFrame, path: str, load: int) -> None:
    """Lands ``amounts(from_currency, to_currency, amount, ts, ...)`` of load number ``load``."""
    land_change(amounts, f"{path.rstrip('/')}/amounts", "amounts", load)


def land_rates(rates: DataFrame, path: str, load: int) -> None:
    """Lands ``rates(base_currency, target_currency, rate, rate_timestamp, ...)`` of load number ``load``."""
    land_change(rates, f"{path.rstrip('/')}/rates", "rates", load)


def run_amounts(stream: DataFrame, path: str, checkpoint: str):
    """Lands what is new in a stream of amounts."""
    return run_changes(stream, lambda rows: rows, f"{path.rstrip('/')}/amounts", checkpoint, "amounts")


def run_rates(stream: DataFrame, path: str, checkpoint: str):
    """Lands what is new in a stream of rates."""
    return run_changes(stream, lambda rows: rows, f"{path.rstrip('/')}/rates", checkpoint, "rates")


def _loads(spark: SparkSession, path: str, source: str) -> dict[int, str]:
    folder = f"{path}/{source}/changes"
    return {int(name.rpartition("-")[2]): f"{folder}/{name}" for name in finished(spark, folder)}


def _runs(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(name.removeprefix("run=")) for name in finished(spark, f"{path}/runs"))


def settle(spark: SparkSession, path: str, delay: str, **options) -> int:
    """Converts the amounts that are due and writes them; returns the number of the run, 0 if none was needed.

    ``delay`` is how much later a rate may arrive than one of a later time. A rate that comes later still
    doesn't change what is settled; an amount may come as late as it likes, and is settled by the next run.
    ``options`` are those of ``convert_amounts``. One run at a time.
    """
    path = path.rstrip("/")
    amounts, rates = _loads(spark, path, "amounts"), _loads(spark, path, "rates")
    if not amounts or not rates:
        return 0
    number = max(_runs(spark, path), default=0)
    settled = spark.read.parquet(f"{path}/runs/run={number}").first() if number else None
    quotes = spark.read.parquet(*rates.values())
    until = quotes.agg((F.max("rate_timestamp") - F.expr(f"interval {delay}")).alias("t")).first()["t"]
    if until is None:
        return 0
    last = max(amounts)
    if settled and until <= settled["until"]:
        until = settled["until"]
        if last <= settled["load"]:
            return 0
    parts = []
    for is_new, loads in ((False, [n for n in amounts if settled and n <= settled["load"]]), (True, [n for n in amounts if not settled or n > settled["load"]])):
        if loads:
            rows = spark.read.parquet(*[amounts[n] for n in sorted(loads)]).where(F.col("ts") <= F.lit(until))
            # Of earlier loads what was due then is settled; of new ones all that is due now is not.
            parts.append(rows if is_new else rows.where(F.col("ts") > F.lit(settled["until"])))
    due = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    known = quotes.where(F.col("rate_timestamp") <= F.lit(until))
    convert_amounts(due, known, **options).write.mode("overwrite").parquet(f"{path}/settled/run={number + 1}")
    row = spark.createDataFrame([(until, last)], "until timestamp_ntz, load long").coalesce(1)
    row.write.mode("overwrite").parquet(f"{path}/runs/run={number + 1}")
    return number + 1


def settled_amounts(spark: SparkSession, path: str) -> DataFrame:
    """All amounts that have been converted, each once."""
    path = path.rstrip("/")
    runs = _runs(spark, path)
    if not runs:
        raise FileNotFoundError(f"nothing is settled in {path}")
    return spark.read.parquet(*[f"{path}/settled/run={n}" for n in runs])
