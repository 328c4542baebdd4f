"""Queries over tables that are kept up load by load, each with the SQL of the whole."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rateloom.streaming import arriving, running

from . import bindings as b
from .catalog import ORACLE, _bars_sql, _with_date, query

#: Three loads of the events; the last two hold late rows of every day.
_LOADS = ("event_id % 10 < 6 and day(ts) <= 20", "event_id % 10 < 8 and (event_id % 10 > 5 or day(ts) > 20)", "event_id % 10 > 7")


def _stream(spark: SparkSession, root: str, name: str, rows: DataFrame, load: str) -> DataFrame:
    """Adds a load's rows to a folder and reads the folder as a stream."""
    rows.where(load).write.mode("append").parquet(f"{root}/in-{name}")
    return spark.readStream.schema(rows.schema).parquet(f"{root}/in-{name}")


def _kept_up(
    spark: SparkSession,
    root: str,
    sources: Sequence[tuple[str, DataFrame, running.Rows]],
    table: running.Running,
    fold_after: int = 1,
) -> None:
    """Runs all loads; the table is folded after one of them, so that later ones meet a base."""
    for n, load in enumerate(_LOADS):
        for name, rows, parts in sources:
            stream = _stream(spark, root, name, rows, load)
            running.run_changes(stream, parts, f"{root}/table", f"{root}/checkpoint-{name}", name)
        if n == fold_after:
            running.fold(spark, f"{root}/table", table)


@query("running_bars", _with_date(_bars_sql("1Hour")))
def running_bars(spark, sf_dir):
    root = b.folder(spark, "running")
    sources = [("trades", b.trades(spark, sf_dir), running.bar_changes("1Hour", "event_id"))]
    _kept_up(spark, root, sources, running.BARS)
    return running.current(spark, f"{root}/table", running.BARS)


@query(
    "settled_bars",
    f"""select * from ({_with_date(_bars_sql("1Hour"))})
        where "timestamp" + interval '1 hour' <= (select max(ts) from events) - interval '2 days'""",
)
def settled_bars(spark, sf_dir):
    root = b.folder(spark, "running")
    sources = [("trades", b.trades(spark, sf_dir), running.bar_changes("1Hour", "event_id"))]
    _kept_up(spark, root, sources, running.BARS, fold_after=2)
    return running.settled_bars(spark, f"{root}/table", "2 days")


@query("running_latest_bar", ORACLE["latest_bar_of_trades"])
def running_latest_bar(spark, sf_dir):
    root = b.folder(spark, "running")
    trades = b.trades(spark, sf_dir, b.user_symbol())
    _kept_up(spark, root, [("trades", trades, running.latest_bar_changes("1Min", "event_id"))], running.LATEST_BAR)
    return running.current(spark, f"{root}/table", running.LATEST_BAR)


@query("running_snapshot", ORACLE["snapshot"])
def running_snapshot(spark, sf_dir):
    """Trades and quotes arrive as streams of their own."""
    root = b.folder(spark, "running")
    sources = [
        ("trades", b.purchases(spark, sf_dir), running.trade_changes("event_id")),
        ("quotes", b.quotes(spark, sf_dir), running.quote_changes("event_id")),
    ]
    _kept_up(spark, root, sources, running.SNAPSHOT)
    return running.current(spark, f"{root}/table", running.SNAPSHOT)


@query("arriving_amounts", f"select * from ({ORACLE['convert_amounts']}) where ts <= (select max(ts) from events) - interval '1 day'")
def arriving_amounts(spark, sf_dir):
    """Three loads, settled after each; rates come up to 23 hours late, amounts in any order."""
    root = b.folder(spark, "arriving")
    comes = F.col("rate_timestamp") + F.make_dt_interval(hours=(F.col("event_id") % 24).cast("int"))
    day = F.datediff(comes, F.lit("2024-01-01").cast("date"))
    rates, amounts = b.rate_quotes(spark, sf_dir), b.amounts(spark, sf_dir)
    for n, days in enumerate(((0, 9), (10, 19), (20, 99))):
        arriving.land_rates(rates.where(day.between(*days)), root, n)
        arriving.land_amounts(amounts.where(F.col("o_orderkey") % 3 == n), root, n)
        arriving.settle(spark, root, "1 day", tie="event_id")
    return arriving.settled_amounts(spark, root)
