"""Stock feeds: landed responses to the STOCK_BARS and STOCK_SNAPSHOT tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rateloom import schemas
from rateloom.functions import now_utc, parse_iso_utc, zero_fill
from rateloom.operators.bars import first_bars
from rateloom.operators.calendar import batch_calendar, batch_no
from rateloom.operators.shape import enforce_schema

from .envelope import guard, read_body, usable

_FIELDS = ["o", "h", "l", "c", "v", "n", "vw"]


def _complete(bar: Column) -> Column:
    present = bar["t"].try_cast("timestamp").isNotNull()
    for field in _FIELDS:
        present = present & bar[field].isNotNull()
    return present


def _bar_table(rows: DataFrame) -> DataFrame:
    """``symbol, bar`` to STOCK_BARS."""
    table = rows.select(
        "symbol",
        parse_iso_utc("bar.t").alias("timestamp"),
        F.col("bar.o").alias("open"),
        F.col("bar.h").alias("high"),
        F.col("bar.l").alias("low"),
        F.col("bar.c").alias("close"),
        F.col("bar.v").alias("volume"),
        F.col("bar.n").alias("trade_count"),
        F.col("bar.vw").alias("vwap"),
    )
    table = table.withColumn("bar_date", F.to_date("timestamp")).withColumn("ingestion_datetime", now_utc())
    return enforce_schema(table, schemas.STOCK_BARS)


def _every(found: Column, test) -> Column:
    """Whether all values of a map pass; true for a missing or empty map."""
    return F.coalesce(F.forall(F.map_values(found), lambda v: F.coalesce(test(v), F.lit(False))), F.lit(True))


def _time_ok(text: Column) -> Column:
    return text.isNull() | text.try_cast("timestamp").isNotNull()


# Each feed's reader gives the parsed responses, where the rows are found, and which are usable.
Found = tuple[DataFrame, Column, Column]


def read_latest(responses: DataFrame) -> Found:
    read = read_body(responses, schemas.BODY_LATEST_BARS)
    found = F.col("doc.bars")
    return read, found, F.col("readable") & _every(found, _complete)


def read_historical(responses: DataFrame) -> Found:
    read = read_body(responses, schemas.BODY_HISTORICAL_BARS)
    found = F.col("doc.bars")
    return read, found, F.col("readable") & _every(found, lambda bars: F.forall(bars, _complete))


def read_snapshots(responses: DataFrame) -> Found:
    read = read_body(responses, schemas.BODY_SNAPSHOTS)
    bare = F.from_json("body", schemas.BODY_SNAPSHOTS_BARE)
    # The body as a whole is a map too, whose only symbol would then be the envelope's name.
    found = F.coalesce(F.col("doc.snapshots"), F.map_filter(bare, lambda symbol, _: symbol != "snapshots"))
    read = read.withColumn("found", F.when(F.col("readable"), found))
    times = lambda s: _time_ok(s["latestTrade"]["t"]) & _time_ok(s["latestQuote"]["t"])
    return read, F.col("found"), F.col("readable") & _every(F.col("found"), times)


def bars_latest(responses: DataFrame, on_error: str = "raise") -> DataFrame:
    """The latest bar of each symbol in the responses."""
    read, found, ok = read_latest(responses)
    return _bar_table(read.select(F.explode(guard(ok, found, on_error)).alias("symbol", "bar")))


def bars_historical(responses: DataFrame, limit: int | None = None, on_error: str = "raise") -> DataFrame:
    """All bars of all pages. Pages are landing rows of their own, so they parse in parallel.

    ``limit`` is the documented cap on the number of bars, applied in order of symbol and time.
    """
    read, found, ok = read_historical(responses)
    by_symbol = read.select(F.explode(guard(ok, found, on_error)).alias("symbol", "bars"))
    table = _bar_table(by_symbol.select("symbol", F.explode("bars").alias("bar")))
    return table if limit is None else first_bars(table, limit)


def bars_timeseries(responses: DataFrame, start: str, end: str, batch_days: int = 30) -> DataFrame:
    """Bars of [start, end] plus ``batch``, the window each falls in; unusable pages are left out."""
    lo, hi = F.lit(start).cast("date"), F.lit(end).cast("date")
    # What the request asked for tells which pages can hold such bars, before any body is parsed.
    first, last = (F.try_element_at("params", F.lit(p)).try_cast("date") for p in ("start", "end"))
    near = F.coalesce(first <= hi, F.lit(True)) & F.coalesce(last >= lo, F.lit(True))
    table = bars_historical(responses.where(near), on_error="drop")
    return table.where(F.col("bar_date").between(lo, hi)).withColumn("batch", batch_no("bar_date", lo, batch_days))


def bar_results(responses: DataFrame) -> DataFrame:
    """One row per page: the day its request starts on, whether it is usable and how many bars it has."""
    read, found, ok = read_historical(responses)
    n_bars = F.aggregate(F.map_values(found), F.lit(0), lambda n, bars: n + F.size(bars))
    return usable(read, ok, n_bars, F.try_element_at("params", F.lit("start")).try_cast("date").alias("day"))


def bars_timeseries_audit(
    responses: DataFrame, start: str, end: str, batch_days: int = 30, requests: DataFrame | None = None
) -> DataFrame:
    """Per window: pages received, pages that are unusable, and bars; a window without pages has 0.

    Pages are counted by the window their request starts in. With ``requests``, those without any page
    count as failed, and ``missing`` tells how many they are.
    """
    lo, hi = F.lit(start).cast("date"), F.lit(end).cast("date")
    pages = bar_results(responses).where(F.col("day").between(lo, hi))
    per_window = pages.groupBy(batch_no("day", lo, batch_days).alias("batch")).agg(
        F.count(F.lit(1)).alias("pages"),
        F.count_if(~F.col("ok")).alias("failed_pages"),
        F.sum("n_rows").alias("n_rows"),
    )
    one = responses.sparkSession.range(1).select(lo.alias("_from"), hi.alias("_to"))
    windows = batch_calendar(one, "_from", "_to", batch_days)
    found = windows.join(per_window, "batch", "left").na.fill(0, ["pages", "failed_pages", "n_rows"])
    if requests is None:
        return found
    asked = requests.select(
        "request_key", F.try_element_at("params", F.lit("start")).try_cast("date").alias("day")
    ).where(F.col("day").between(lo, hi))
    absent = asked.join(responses.select("request_key").distinct(), "request_key", "left_anti")
    missing = absent.groupBy(batch_no("day", lo, batch_days).alias("batch")).agg(F.count(F.lit(1)).alias("missing"))
    both = found.join(missing, "batch", "left").na.fill(0, ["missing"])
    return both.withColumn("failed_pages", F.col("failed_pages") + F.col("missing"))


def snapshots(responses: DataFrame, zero_missing: bool = True, on_error: str = "raise") -> DataFrame:
    """Latest trade, quote and previous close per symbol.

    The symbols are under ``snapshots`` or at the top level of the body; an empty ``snapshots``
    means no rows. Missing prices and sizes are 0, or null with ``zero_missing=False``.
    """
    read, found, ok = read_snapshots(responses)
    rows = read.select(F.explode(guard(ok, found, on_error)).alias("symbol", "s"))
    table = rows.select(
        "symbol",
        zero_fill("s.latestTrade.p", enabled=zero_missing).alias("latest_trade_price"),
        zero_fill("s.latestTrade.s", "long", zero_missing).alias("latest_trade_size"),
        parse_iso_utc("s.latestTrade.t").alias("latest_trade_timestamp"),
        zero_fill("s.latestQuote.ap", enabled=zero_missing).alias("latest_quote_ask_price"),
        zero_fill("s.latestQuote.bp", enabled=zero_missing).alias("latest_quote_bid_price"),
        parse_iso_utc("s.latestQuote.t").alias("latest_quote_timestamp"),
        zero_fill("s.prevDailyBar.c", enabled=zero_missing).alias("prev_daily_close"),
        now_utc().alias("ingestion_datetime"),
    )
    return enforce_schema(table, schemas.STOCK_SNAPSHOT)
