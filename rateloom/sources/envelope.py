"""Shared handling of landed response bodies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_BAD = "_bad"
#: Whether the feed can use a response, where that was judged (``audit.judged``).
USABLE = "_usable"


def read_body(responses: DataFrame, body_schema: str) -> DataFrame:
    """Add ``doc`` (the parsed body) and ``readable``: a 2xx/3xx status and well-formed JSON."""
    parsed = F.from_json("body", f"{body_schema}, {_BAD} string", {"columnNameOfCorruptRecord": _BAD})
    return responses.withColumn("doc", parsed).withColumn(
        "readable",
        F.coalesce(F.col("status") < 400, F.lit(False))
        & F.col("doc").isNotNull()
        & F.col(f"doc.{_BAD}").isNull(),
    )


def guard(ok: Column, value: Column, on_error: str) -> Column:
    """``value`` where ``ok``; elsewhere null (``drop``) or an error naming the request (``raise``).

    The test sits inside the generator's argument, not in a filter: a filter would be pushed below
    the projection and parse every body twice.
    """
    if on_error not in ("raise", "drop"):
        raise ValueError(f"unknown on_error {on_error!r}")
    guarded = F.when(F.coalesce(ok, F.lit(False)), value)
    if on_error == "raise":
        return guarded.otherwise(F.raise_error(F.concat(F.lit("unusable response "), F.col("request_key"))))
    return guarded


def usable(responses: DataFrame, ok: Column, n_rows: Column, *keys: Column) -> DataFrame:
    """One row per response for the audit: request_key, status, keys, ok, n_rows.

    The columns come out of a generator for the same reason as in ``guard``: what a join or filter on
    them implies then stays above the parse.
    """
    good = F.coalesce(ok, F.lit(False))
    rows = F.when(good, F.greatest(F.coalesce(n_rows, F.lit(0)), F.lit(0))).otherwise(0)
    result = F.struct(*keys, good.alias("ok"), rows.cast("long").alias("n_rows"))
    return responses.select("request_key", "status", F.explode(F.array(result)).alias("_r")).select(
        "request_key", "status", "_r.*"
    )


def _good(responses: DataFrame) -> Column:
    """Whether a response counts as usable: as its feed judged it, or else by the status alone."""
    return F.col(USABLE) if USABLE in responses.columns else F.coalesce(F.col("status") < 400, F.lit(False))


def _rank(good: Column) -> Column:
    """Orders copies of a response: usable ones last, then by fetch time, then by status.

    One long, so that the best of many copies is found by hashing, without sorting any body.
    """
    good = F.shiftleft(good.cast("long"), 62)
    at = F.coalesce(F.unix_micros("fetched_at"), F.lit(0)) * 1000
    return good + at + 999 - F.coalesce("status", F.lit(999))


def _ranked(responses: DataFrame) -> tuple[DataFrame, list[str]]:
    """``responses`` with ``_rank`` and, if they have runs and pages, ``_run``; and what tells pages apart."""
    if not {"run_id", "page"} <= set(responses.columns):
        return responses.withColumn("_rank", _rank(_good(responses))), ["request_key"]
    added = {"page": F.coalesce("page", F.lit(0)), "_run": F.xxhash64("run_id"), "_rank": _rank(_good(responses))}
    return responses.withColumns(added), ["request_key", "_run", "page"]


def _winners(ranked: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, _rank, _copies, status`` and ``_usable`` of the best copy of every page that counts.

    Of the runs of a request the last whole one counts (one of which every copy is usable), or else the
    last. Only fixed width columns are read, once, and copies are counted before they are shuffled.
    """
    good = _good(ranked).cast("long")
    began = F.when(F.col("page") == 0, F.unix_micros("fetched_at")) if "page" in keys else F.lit(None).cast("long")
    copies = ranked.groupBy(*keys, "_rank").agg(
        F.count(F.lit(1)).alias("_copies"), F.max("status").alias("status"),
        F.min(good).alias("_good"), F.max(began).alias("_began"),
    )
    # All copies of one rank have the same status and verdict, and a usable one outranks all others.
    pages = copies.groupBy(*keys).agg(
        F.max_by("_copies", "_rank").alias("_copies"), F.max_by("status", "_rank").alias("status"),
        (F.max("_good") == 1).alias(USABLE), F.min("_good").alias("_good"), F.max("_began").alias("_began"),
        F.max("_rank").alias("_rank"),
    )
    if "_run" in keys:
        order = F.shiftleft(F.min("_good"), 62) + F.coalesce(F.max("_began"), F.lit(0))
        runs = pages.groupBy("request_key", "_run").agg(order.alias("_order"))
        last = runs.groupBy("request_key").agg(F.max(F.struct("_order", "_run"))["_run"].alias("_run"))
        pages = pages.join(last, ["request_key", "_run"])
    return pages.drop("_good", "_began")


def settled_pages(responses: DataFrame) -> DataFrame:
    """``request_key, status, _usable`` of what ``latest_responses`` would return, without the bodies: they
    are not read if the responses hold their verdicts. One pass over ``responses``."""
    return _winners(*_ranked(responses)).select("request_key", "status", USABLE)


def latest_responses(responses: DataFrame) -> DataFrame:
    """One row per request and page: the usable copy fetched last, or the last if none is usable.

    Pages count only with the run that fetched them: of the runs of a request the last whole one is
    taken. Usable is what the feed can use if the responses were judged (``audit.judged``), else what has
    no error status. Rows without a key are left out. The best copies are found by hash aggregates over fixed
    width columns and joined back, so ``responses`` are read twice, once without the bodies; only copies that
    tie in everything are ordered, by their bodies' hash.
    """
    ranked, keys = _ranked(responses)
    won = ranked.join(_winners(ranked, keys).drop("status", USABLE), [*keys, "_rank"])
    first = Window.partitionBy(*keys).orderBy(F.xxhash64("body"))
    tied = won.where("_copies > 1").withColumn("_copies", F.row_number().over(first)).where("_copies = 1")
    return won.where("_copies = 1").union(tied).select(*responses.columns)
