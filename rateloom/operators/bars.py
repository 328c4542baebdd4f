"""OHLCV bars from trades, and selections over them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rateloom.functions import order_key
from rateloom.schemas import TIMEFRAMES


def window_start(ts: Column | str, timeframe: str) -> Column:
    """Start of the bar that holds ``ts``; windows are aligned to midnight UTC."""
    if timeframe not in TIMEFRAMES:
        raise ValueError(f"unknown timeframe {timeframe!r}")
    return F.window(ts, TIMEFRAMES[timeframe]).getField("start")


def bars(trades: DataFrame, timeframe: str = "1Day", tie: str | None = None) -> DataFrame:
    """Bars per symbol and window from ``trades(symbol, ts, price, size)``.

    One hash aggregate with a map-side partial step: a symbol with a third of all trades still
    reaches the shuffle as one row per task and window. ``tie`` names a long column that orders
    trades of the same microsecond. A window without volume has a null vwap.
    """
    key = order_key("ts", tie)
    start = window_start("ts", timeframe)
    return (
        trades.groupBy("symbol", start.alias("timestamp"))
        .agg(
            F.min_by("price", key).alias("open"),
            F.max("price").alias("high"),
            F.min("price").alias("low"),
            F.max_by("price", key).alias("close"),
            F.sum("size").alias("volume"),
            F.count(F.lit(1)).alias("trade_count"),
            F.sum(F.col("price") * F.col("size")).alias("_turnover"),
        )
        .select(
            "symbol",
            "timestamp",
            F.to_date("timestamp").alias("bar_date"),
            "open",
            "high",
            "low",
            "close",
            "volume",
            "trade_count",
            F.try_divide("_turnover", "volume").alias("vwap"),
        )
    )


_FIRST_AND_LAST = (("open", F.min_by, F.min), ("close", F.max_by, F.max))


def bar_parts(trades: DataFrame, timeframe: str = "1Day", tie: str | None = None) -> DataFrame:
    """What ``trades`` add to the bars: rows that can be merged, one per symbol and window.

    Beside the figures of a bar they keep the keys of its first and last trade, its turnover, its end and the
    time of its last trade.
    """
    key = order_key("ts", tie)
    window = F.window("ts", TIMEFRAMES[timeframe])
    return (
        trades.groupBy("symbol", window.alias("_window"))
        .agg(
            *[pick("price", key).alias(name) for name, pick, _ in _FIRST_AND_LAST],
            *[end(key).alias(f"{name}_key") for name, _, end in _FIRST_AND_LAST],
            F.max("price").alias("high"),
            F.min("price").alias("low"),
            F.sum("size").alias("volume"),
            F.count(F.lit(1)).alias("trade_count"),
            F.sum(F.col("price") * F.col("size")).alias("turnover"),
            F.max("ts").alias("last_ts"),
        )
        .withColumns({"timestamp": F.col("_window.start"), "bar_end": F.col("_window.end")})
        .drop("_window")
    )


def merge_bar_parts(parts: DataFrame, *keys: str) -> DataFrame:
    """One row per symbol and window (and ``keys``, which follow from them) of any number of parts."""
    merged = parts.groupBy("symbol", "timestamp", *keys).agg(
        *[pick(name, f"{name}_key").alias(name) for name, pick, _ in _FIRST_AND_LAST],
        *[end(f"{name}_key").alias(f"{name}_key") for name, _, end in _FIRST_AND_LAST],
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.sum("volume").alias("volume"),
        F.sum("trade_count").alias("trade_count"),
        F.sum("turnover").alias("turnover"),
        F.max("last_ts").alias("last_ts"),
        F.max("bar_end").alias("bar_end"),
    )
    return merged.select(*parts.columns)


def last_windows(parts: DataFrame) -> DataFrame:
    """The parts of each symbol's last window."""
    last = parts.groupBy("symbol").agg(F.max("timestamp").alias("_last")).withColumnRenamed("symbol", "_symbol")
    kept = F.col("symbol").eqNullSafe(F.col("_symbol")) & (F.col("timestamp") == F.col("_last"))
    return parts.join(last, kept, "left_semi")


def bars_of_parts(parts: DataFrame) -> DataFrame:
    """The bars, as ``bars`` gives them, of merged parts."""
    return parts.select(
        "symbol",
        "timestamp",
        F.to_date("timestamp").alias("bar_date"),
        "open",
        "high",
        "low",
        "close",
        "volume",
        "trade_count",
        F.try_divide("turnover", "volume").alias("vwap"),
    )


def latest_bar(bars_df: DataFrame) -> DataFrame:
    """The last bar of each symbol. All fields follow one key, so they come from one bar."""
    names = [f for f in bars_df.columns if f not in ("symbol", "timestamp")]
    return bars_df.groupBy("symbol").agg(
        F.max("timestamp").alias("timestamp"),
        *[F.max_by(f, "timestamp").alias(f) for f in names],
    ).select(*bars_df.columns)


def latest_bar_of_trades(trades: DataFrame, timeframe: str = "1Min", tie: str | None = None) -> DataFrame:
    """The last bar of each symbol straight from trades.

    Each symbol's last window is found from two columns; only the trades of those windows are
    aggregated. How the trades meet the windows is left to the size of either side.
    """
    last = trades.groupBy("symbol").agg(F.max("ts").alias("ts")).where(F.col("ts").isNotNull())
    windows = last.select(F.col("symbol").alias("_symbol"), window_start("ts", timeframe).alias("_last"))
    stamped = trades.withColumn("_start", window_start("ts", timeframe))
    # Null-safe, because trades without a symbol form a group of their own in bars.
    kept = F.col("symbol").eqNullSafe(F.col("_symbol")) & (F.col("_start") == F.col("_last"))
    return bars(stamped.join(windows, kept, "left_semi"), timeframe, tie)


def select_range(
    df: DataFrame,
    start: str | None = None,
    end: str | None = None,
    symbols: Sequence[str] | None = None,
    feed: str | None = None,
    ts: str = "timestamp",
    day: str | None = None,
    feed_column: str = "feed",
    symbol_column: str = "symbol",
) -> DataFrame:
    """Rows of the inclusive date range, symbols and feed.

    All tests are on bare columns, so they reach the Parquet scan. The range is tested on ``ts``, or
    on the date column ``day``: of a table that is partitioned by it, other days are not opened.
    """
    if start is not None:
        first = F.lit(start).cast("date")
        df = df.where(F.col(day) >= first if day else F.col(ts) >= first.cast(df.schema[ts].dataType))
    if end is not None:
        last = F.lit(end).cast("date")
        after = F.date_add(last, 1)
        df = df.where(F.col(day) <= last if day else F.col(ts) < after.cast(df.schema[ts].dataType))
    if symbols is not None:
        df = df.where(F.col(symbol_column).isin(list(symbols)))
    if feed is not None:
        df = df.where(F.col(feed_column) == feed)
    return df


def first_bars(bars_df: DataFrame, limit: int) -> DataFrame:
    """At most ``limit`` bars, in order of symbol and time (the request's documented cap)."""
    return bars_df.orderBy("symbol", "timestamp").limit(limit)


def close_on_date(requests: DataFrame, bars_df: DataFrame) -> DataFrame:
    """Each ``(symbol, date)`` of ``requests`` with the first close of that day, or null.

    Bars are reduced to one row per symbol and day first, so the join cannot fan out.
    """
    closes = bars_df.groupBy("symbol", F.col("bar_date").alias("date")).agg(
        F.min_by("close", "timestamp").alias("close")
    )
    return requests.join(closes, ["symbol", "date"], "left")
