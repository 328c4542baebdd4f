"""Tables of requests for every feed, ready for ``fetch_responses``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rateloom.functions import now_utc
from rateloom.operators.calendar import batch_calendar, day_calendar, repair_windows
from rateloom.schemas import REQUESTS, TIMEFRAMES

from .requests import SYMBOLS_PER_REQUEST, request_params

# The endpoint of each feed, and the stock feed used unless another is named.
ENDPOINTS = {
    "rates_latest": "latest",
    "rates_historical": "historical",
    "convert_currency": "convert",
    "currencies": "currencies",
    "bars_latest": "stocks/bars/latest",
    "bars_historical": "stocks/bars",
    "snapshots": "stocks/snapshots",
}
DEFAULT_FEED = "iex"


def request_identity(endpoint: Column, params: Column) -> Column:
    """A key that two requests share only if endpoint and all parameters agree."""
    pairs = F.transform(F.map_entries(params), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return F.md5(F.concat(endpoint, F.lit("?"), F.array_join(F.array_sort(pairs), "&")))


def _requests(df: DataFrame, feed: str, params: Column) -> DataFrame:
    endpoint = F.lit(ENDPOINTS[feed])
    row = df.select(
        request_identity(endpoint, params).alias("request_key"),
        F.lit("GET").alias("method"),
        endpoint.alias("endpoint"),
        params.alias("params"),
        F.create_map().cast("map<string,string>").alias("headers"),
        F.lit(None).cast("string").alias("body"),
    )
    return row.select(*REQUESTS.names)


def _params(**values: Column | str | None) -> Column:
    """A parameter map without the optional ones that are missing."""
    entries = [
        F.struct(F.lit(k).alias("key"), (v if isinstance(v, Column) else F.lit(v)).cast("string").alias("value"))
        for k, v in values.items()
    ]
    return F.map_from_entries(F.filter(F.array(*entries), lambda e: e["value"].isNotNull()))


def _joined(symbols: Sequence[str] | None) -> str | None:
    return ",".join(symbols) if symbols else None


def latest_rate_requests(bases: DataFrame, symbols: Sequence[str] | None = None) -> DataFrame:
    """One request per ``bases(base_currency)``."""
    base = F.col("base_currency")
    return _requests(bases, "rates_latest", _params(base=base, symbols=_joined(symbols)))


def historical_rate_requests(
    ranges: DataFrame, start: str = "start", end: str = "end", symbols: Sequence[str] | None = None
) -> DataFrame:
    """One request per base and day of ``ranges(base_currency, start, end)``, both ends included."""
    days = day_calendar(ranges, start, end, keep=["base_currency"])
    params = _params(date=F.col("day"), base=F.col("base_currency"), symbols=_joined(symbols))
    return _requests(days, "rates_historical", params)


def repair_rate_requests(
    missing: DataFrame, symbols: Sequence[str] | None = None, day: str = "day"
) -> DataFrame:
    """One request per base and day of ``missing(base_currency, day)``."""
    windows = repair_windows(missing, ["base_currency"], day=day)
    return historical_rate_requests(windows, symbols=symbols)


def conversion_requests(amounts: DataFrame) -> DataFrame:
    """One request per different ``amounts(from_currency, to_currency, amount)``."""
    amounts = amounts.select("from_currency", "to_currency", "amount").distinct()
    params = _params(**{"from": F.col("from_currency"), "to": F.col("to_currency"), "amount": F.col("amount")})
    return _requests(amounts, "convert_currency", params)


def currency_requests(kinds: DataFrame) -> DataFrame:
    """One request per ``kinds(type)``, such as fiat or crypto."""
    return _requests(kinds, "currencies", _params(type=F.col("type")))


def _symbol_requests(symbols: DataFrame, feed: str, source: str, per_request: int) -> DataFrame:
    groups = request_params(symbols, [], "symbol", {"feed": source}, per_request)
    return _requests(groups, feed, F.col("params"))


def latest_bar_requests(
    symbols: DataFrame, feed: str = DEFAULT_FEED, per_request: int = SYMBOLS_PER_REQUEST
) -> DataFrame:
    """Requests that between them name all of ``symbols(symbol)``."""
    return _symbol_requests(symbols, "bars_latest", feed, per_request)


def snapshot_requests(
    symbols: DataFrame, feed: str = DEFAULT_FEED, per_request: int = SYMBOLS_PER_REQUEST
) -> DataFrame:
    """Requests that between them name all of ``symbols(symbol)``."""
    return _symbol_requests(symbols, "snapshots", feed, per_request)


def bar_requests(
    symbols: DataFrame,
    start: str,
    end: str | None = None,
    timeframe: str = "1Day",
    feed: str = DEFAULT_FEED,
    limit: int | None = None,
    batch_days: int = 30,
    per_request: int = SYMBOLS_PER_REQUEST,
) -> DataFrame:
    """One request per window of ``batch_days`` days and part of ``symbols(symbol)``.

    Both ends are included; without ``end`` the last day is today in UTC.
    """
    if timeframe not in TIMEFRAMES:
        raise ValueError(f"unknown timeframe {timeframe!r}")
    last = F.to_date(now_utc()) if end is None else F.lit(end).cast("date")
    groups = request_params(symbols, [], "symbol", per_request=per_request).withColumns(
        {"_from": F.lit(start).cast("date"), "_to": last}
    )
    windows = batch_calendar(groups, "_from", "_to", batch_days, ["part", "params"])
    more = _params(
        start=F.col("batch_start"),
        end=F.col("batch_end"),
        timeframe=timeframe,
        feed=feed,
        limit=None if limit is None else str(limit),
    )
    return _requests(windows, "bars_historical", F.map_concat("params", more))


def repair_bar_requests(
    missing: DataFrame,
    timeframe: str = "1Day",
    feed: str = DEFAULT_FEED,
    limit: int | None = None,
    batch_days: int = 30,
    per_request: int = SYMBOLS_PER_REQUEST,
    day: str = "day",
) -> DataFrame:
    """Requests for exactly the days of ``missing(symbol, day)``, symbols with the same window together.

    Runs of days become the fewest windows of at most ``batch_days`` days.
    """
    if timeframe not in TIMEFRAMES:
        raise ValueError(f"unknown timeframe {timeframe!r}")
    windows = repair_windows(missing, ["symbol"], batch_days, day)
    groups = request_params(windows, ["start", "end"], "symbol", per_request=per_request)
    more = _params(
        start=F.col("start"),
        end=F.col("end"),
        timeframe=timeframe,
        feed=feed,
        limit=None if limit is None else str(limit),
    )
    return _requests(groups, "bars_historical", F.map_concat("params", more))
