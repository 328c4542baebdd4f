"""Backfill jobs: plan the requests, fetch and land the responses, write the table, audit the gaps."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rateloom.functions import classify_response
from rateloom.schemas import LANDED
from rateloom.sinks.parquet import write_parquet
from rateloom.sources import fx, stocks
from rateloom.sources.audit import judged_landing, with_verdict
from rateloom.sources.envelope import USABLE, latest_responses, settled_pages
from rateloom.sources.planning import DEFAULT_FEED, bar_requests, historical_rate_requests
from rateloom.sources.requests import SYMBOLS_PER_REQUEST, Transport, fetch_responses


LANDING_PARTITIONS = ("feed", "request_date")


def _judged(requests: DataFrame, landing: str) -> DataFrame:
    """All copies that have landed of ``requests``, and whether their feed can use them.

    Only the partitions of the requests' feed and days are read; responses to other requests are left
    out before copies are compared. A missing folder holds nothing.
    """
    spark = requests.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(landing)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], LANDED).withColumn(USABLE, F.lit(False))
    asked = requests.select(F.col("request_key").alias("_asked"))
    days = F.coalesce(F.try_element_at("params", F.lit("date")), F.try_element_at("params", F.lit("start")))
    # One row: the feeds asked for, and the first and last day. Requests without days may land on any.
    span = requests.agg(
        F.collect_set("endpoint").alias("feeds"), F.min(days).alias("lo"), F.max(days).alias("hi"),
        F.count_if(days.isNull()).alias("undated"),
    ).first()
    landed = spark.read.schema(LANDED).parquet(landing).where(F.col("feed").isin(span["feeds"]))
    if not span["undated"] and span["lo"] is not None:
        landed = landed.where(F.col("request_date").between(F.lit(span["lo"]).cast("date"), F.lit(span["hi"]).cast("date")))
    mine = landed.join(asked, landed["request_key"] == asked["_asked"], "left_semi")
    return judged_landing(mine, span["feeds"])


def landed_of(requests: DataFrame, landing: str) -> DataFrame:
    """What has landed of ``requests``: of each the last whole run, and of its pages the best copy.

    A run is whole if its feed can use every page: a cut-off body counts as little as an error status.
    """
    return latest_responses(_judged(requests, landing)).drop(USABLE)


def outstanding(requests: DataFrame, landing: str) -> DataFrame:
    """The ``requests`` that still have to be called: those without a whole answer that their feed can use.

    A request that the API called wrong is settled too: asked again, it would be wrong again. It stays in
    the landing table for the audit.
    """
    wrong = classify_response(F.col("status"))["action"] == "bad_request"
    left = F.count_if(~F.col(USABLE) & ~wrong).alias("_left")
    known = settled_pages(_judged(requests, landing)).groupBy("request_key").agg(left).where("_left = 0")
    return requests.join(known, "request_key", "left_anti").select(*requests.columns)


def land(fetched: DataFrame, endpoint: str, landing: str) -> None:
    """Adds responses of one endpoint to the landing folder, by feed and day, each with its verdict.

    ``fetched`` is computed once, so it may be the calls themselves.
    """
    with_verdict(fetched, endpoint).write.mode("append").partitionBy(*LANDING_PARTITIONS).parquet(landing)


def land_responses(requests: DataFrame, transport: Transport, landing: str, **options) -> DataFrame:
    """Fetch what ``requests`` asks for and hasn't landed, add it to the landing folder, and return
    all that has landed of it.

    The bodies are on shared storage before anything reads them, so no later step calls again, and a
    run that broke off goes on where it was. The folder is partitioned by feed and day.
    """
    run = {"run_id": uuid.uuid4().hex} | options
    # As many endpoints as there are feeds.
    for endpoint in sorted(r["endpoint"] for r in requests.select("endpoint").distinct().collect()):
        todo = outstanding(requests.where(F.col("endpoint") == endpoint), landing)
        land(fetch_responses(todo, transport, **run), endpoint, landing)
    return landed_of(requests, landing)


def write_rates(
    landed: DataFrame, bases: DataFrame, start: str, end: str, root: str, prefix: str, batch_size: int = 7,
    filename: str | None = None,
) -> tuple[str, DataFrame]:
    """The table of landed daily rates, partitioned by day, and the audit of ``bases``."""
    rates = fx.rates_timeseries(landed, start, end, batch_size).drop("batch")
    uri = write_parquet(rates, root, prefix, filename, partition_by=["rate_date"])
    return uri, fx.rates_timeseries_audit(landed, bases, start, end, batch_size)


def backfill_rates(
    bases: DataFrame,
    start: str,
    end: str,
    transport: Transport,
    landing: str,
    root: str,
    prefix: str,
    batch_size: int = 7,
    filename: str | None = None,
    symbols: Sequence[str] | None = None,
    **options,
) -> tuple[str, DataFrame]:
    """Rates of every base and day in [start, end], partitioned by day; of ``symbols`` only, if given.

    Returns where the table is, and the audit: per base and window the days that failed.
    """
    ranges = bases.select("base_currency", F.lit(start).alias("start"), F.lit(end).alias("end"))
    landed = land_responses(historical_rate_requests(ranges, symbols=symbols), transport, landing, **options)
    return write_rates(landed, bases, start, end, root, prefix, batch_size, filename)


def backfill_bars(
    symbols: DataFrame,
    start: str,
    end: str,
    transport: Transport,
    landing: str,
    root: str,
    prefix: str,
    timeframe: str = "1Day",
    batch_days: int = 30,
    filename: str | None = None,
    feed: str = DEFAULT_FEED,
    limit: int | None = None,
    per_request: int = SYMBOLS_PER_REQUEST,
    **options,
) -> tuple[str, DataFrame]:
    """Bars of ``symbols(symbol)`` in [start, end], partitioned by day, and the audit per window.

    ``limit`` is what the API may put on a page; all pages are fetched.
    """
    requests = bar_requests(symbols, start, end, timeframe, feed, limit, batch_days, per_request)
    landed = land_responses(requests, transport, landing, **options)
    table = stocks.bars_timeseries(landed, start, end, batch_days).drop("batch")
    uri = write_parquet(table, root, prefix, filename, partition_by=["bar_date"])
    return uri, stocks.bars_timeseries_audit(landed, start, end, batch_days, requests)
