"""Latest trade, latest quote and previous daily close per symbol."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rateloom.functions import order_key, zero_fill


_KEYS = ("symbol", "kind", "day")
_VALUES = ("key", "price", "size", "ask", "bid", "ts")


def _last_days(rows: DataFrame, n: int = 2) -> DataFrame:
    """The rows of each symbol's last ``n`` days, of any kind; there is one per symbol, kind and day."""
    recent = Window.partitionBy("symbol", "kind").orderBy(F.desc("day"))
    return rows.withColumn("_rank", F.row_number().over(recent)).where(F.col("_rank") <= n)


def trade_parts(trades: DataFrame, tie: str | None = None) -> DataFrame:
    """What ``trades`` add to a snapshot: the last trade of each symbol's last two days.

    Trades are reduced to one row per symbol and day, and both the latest trade and the previous
    day's close come from those rows, so the window sees days, not trades.
    """
    key = order_key("ts", tie)
    daily = trades.groupBy("symbol", F.to_date("ts").alias("day")).agg(
        F.max(key).alias("key"),
        F.max_by("price", key).alias("price"),
        F.max_by("size", key).cast("long").alias("size"),
        F.max("ts").alias("ts"),
    )
    nothing = {"kind": F.lit("trade"), "ask": F.lit(None).cast("double"), "bid": F.lit(None).cast("double")}
    return _last_days(daily.withColumns(nothing)).select(*_KEYS, *_VALUES)


def quote_parts(quotes: DataFrame, tie: str | None = None) -> DataFrame:
    """What ``quotes`` add to a snapshot, in the columns of ``trade_parts``: each symbol's last quote."""
    key = order_key("ts", tie)
    last = quotes.groupBy("symbol").agg(
        F.max(key).alias("key"),
        F.max_by("ask_price", key).alias("ask"),
        F.max_by("bid_price", key).alias("bid"),
        F.max("ts").alias("ts"),
    )
    nothing = {"day": F.lit(None).cast("date"), "price": F.lit(None).cast("double"), "size": F.lit(None).cast("long")}
    return last.withColumns({"kind": F.lit("quote"), **nothing}).select(*_KEYS, *_VALUES)


def merge_parts(parts: DataFrame, *keys: str) -> DataFrame:
    """Parts of the same symbols merged to what one load of all rows would give; ``keys`` follow from
    the symbol."""
    merged = parts.groupBy(*_KEYS, *keys).agg(
        F.max("key").alias("key"),
        *[F.max_by(name, "key").alias(name) for name in ("price", "size", "ask", "bid")],
        F.max("ts").alias("ts"),
    )
    return _last_days(merged).select(*parts.columns)


def snapshot_of_parts(parts: DataFrame, zero_missing: bool = True) -> DataFrame:
    """The snapshot of merged parts. Trades and quotes without a symbol share a row."""
    trade, quote = F.col("kind") == "trade", F.col("kind") == "quote"
    # Days fall, and one without a date comes last.
    day = F.row_number().over(Window.partitionBy("symbol", "kind").orderBy(F.desc("day")))
    ranked = parts.withColumn("_day", day)
    last, before = trade & (F.col("_day") == 1), trade & (F.col("_day") == 2)
    pick = lambda which, name: F.max(F.when(which, F.col(name)))
    found = ranked.groupBy("symbol").agg(
        pick(last, "price").alias("price"),
        pick(last, "size").alias("size"),
        pick(last, "ts").alias("trade_ts"),
        pick(quote, "ask").alias("ask"),
        pick(quote, "bid").alias("bid"),
        pick(quote, "ts").alias("quote_ts"),
        pick(before, "price").alias("prev_close"),
    )
    return _layout(found, zero_missing)


def _layout(found: DataFrame, zero_missing: bool) -> DataFrame:
    return found.select(
        "symbol",
        zero_fill("price", enabled=zero_missing).alias("latest_trade_price"),
        zero_fill("size", "long", zero_missing).alias("latest_trade_size"),
        F.col("trade_ts").alias("latest_trade_timestamp"),
        zero_fill("ask", enabled=zero_missing).alias("latest_quote_ask_price"),
        zero_fill("bid", enabled=zero_missing).alias("latest_quote_bid_price"),
        F.col("quote_ts").alias("latest_quote_timestamp"),
        zero_fill("prev_close", enabled=zero_missing).alias("prev_daily_close"),
    )


def snapshot(
    trades: DataFrame, quotes: DataFrame, tie: str | None = None, zero_missing: bool = True
) -> DataFrame:
    """One row per symbol of ``trades(symbol, ts, price, size)`` or ``quotes(symbol, ts, ask_price,
    bid_price)``.

    Trades are read once: they are reduced to one row per symbol and day, and both the latest trade
    and the previous day's close come from those rows, so the window sees days, not trades. Missing
    prices and sizes are 0 unless ``zero_missing`` is off; missing timestamps stay null.
    """
    key = order_key("ts", tie)
    daily = trades.groupBy("symbol", F.to_date("ts").alias("day")).agg(
        F.max_by("price", key).alias("price"),
        F.max_by("size", key).alias("size"),
        F.max("ts").alias("ts"),
    )
    recent = Window.partitionBy("symbol").orderBy(F.desc("day"))
    last = F.col("rank") == 1
    from_trades = (
        daily.withColumn("rank", F.row_number().over(recent))
        .where(F.col("rank") <= 2)
        .groupBy("symbol")
        .agg(
            F.max(F.when(last, F.col("price"))).alias("price"),
            F.max(F.when(last, F.col("size"))).alias("size"),
            F.max(F.when(last, F.col("ts"))).alias("trade_ts"),
            F.max(F.when(~last, F.col("price"))).alias("prev_close"),
        )
    )
    from_quotes = quotes.groupBy("symbol").agg(
        F.max_by("ask_price", key).alias("ask"),
        F.max_by("bid_price", key).alias("bid"),
        F.max("ts").alias("quote_ts"),
    )
    return _layout(from_trades.join(from_quotes, "symbol", "full"), zero_missing)
