"""Which responses a feed cannot use, and why."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rateloom.functions import classify_response
from rateloom.schemas import LANDED

from . import fx, stocks
from .envelope import USABLE
from .planning import ENDPOINTS

READERS = {
    "rates_latest": fx.read_latest,
    "rates_historical": fx.read_historical,
    "convert_currency": fx.read_conversions,
    "currencies": fx.read_currencies,
    "bars_latest": stocks.read_latest,
    "bars_historical": stocks.read_historical,
    "snapshots": stocks.read_snapshots,
}


def judged(responses: DataFrame, feed: str) -> DataFrame:
    """``responses`` with ``_usable``: whether the feed can use the body, not its status alone."""
    read, _, ok = READERS[feed](responses)
    # Out of a generator, so that what is asked of the verdict does not parse the body again.
    verdict = F.explode(F.array(F.coalesce(ok, F.lit(False)))).alias(USABLE)
    return read.select(*[c for c in responses.columns if c != USABLE], verdict)


def judged_landing(landed: DataFrame, endpoints: list[str]) -> DataFrame:
    """The rows of ``landed`` of the ``endpoints`` with ``_usable``: as stored with the response, or else
    judged by the endpoint's feed now (by the status alone if no feed has it).

    Whether any row still has to be judged is found from that one column; if none, no body is read.
    """
    feeds = {e: f for f, e in ENDPOINTS.items()}
    if "usable" in landed.columns:
        stored = landed.where(F.col("usable").isNotNull() & F.col("feed").isin(endpoints)).withColumn(USABLE, F.col("usable"))
        landed = landed.where(F.col("usable").isNull())
        if landed.where(F.col("feed").isin(endpoints)).isEmpty():
            return stored
        parts = [stored]
    else:
        parts = []
    parts += [judged(landed.where(F.col("feed") == e), feeds[e]) for e in endpoints if e in feeds]
    other = [e for e in endpoints if e not in feeds]
    if other or not parts:
        rest = landed.where(F.col("feed").isin(other))
        parts.append(rest.withColumn(USABLE, F.coalesce(F.col("status") < 400, F.lit(False))))
    return functools.reduce(DataFrame.unionByName, parts)


def with_verdict(fetched: DataFrame, endpoint: str) -> DataFrame:
    """Responses of one endpoint as they land, with ``usable``: whether their feed can use them.

    Every body is parsed here, once, as it is fetched; what reads the landing table later need not.
    """
    feeds = {e: f for f, e in ENDPOINTS.items()}
    if endpoint in feeds:
        found = judged(fetched, feeds[endpoint])
    else:
        found = fetched.withColumn(USABLE, F.coalesce(F.col("status") < 400, F.lit(False)))
    return found.withColumn("usable", F.col(USABLE)).select(*LANDED.names)


def unusable_responses(responses: DataFrame, feed: str) -> DataFrame:
    """``request_key, status, reason, body`` of the responses that ``on_error='drop'`` leaves out.

    The reason is status (an error or no answer), json (no well-formed body) or content (a value that
    is missing or cannot be read).
    """
    read, _, ok = READERS[feed](responses)
    reason = (
        F.when(F.coalesce(ok, F.lit(False)), F.lit(None))
        .when(F.coalesce(F.col("status") >= 400, F.lit(True)), "status")
        .when(~F.col("readable"), "json")
        .otherwise("content")
    )
    # Out of a generator, so that the filter does not parse the body again.
    judged = read.select("request_key", "status", F.explode(F.array(reason)).alias("reason"), "body")
    return judged.where(F.col("reason").isNotNull())


def response_audit(responses: DataFrame) -> DataFrame:
    """Responses by status and what the status calls for: ``status, action, n``.

    Statuses are counted first, so the verdict is formed once per status, not once per response.
    """
    counts = responses.groupBy("status").agg(F.count(F.lit(1)).alias("n"))
    return counts.select("status", classify_response(F.col("status"))["action"].alias("action"), "n")
