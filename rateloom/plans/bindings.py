"""The test tables seen as feeds: events are trades, quotes and rates, orders are amounts.

Response bodies are built with Spark from the tables, so the parsers can be checked against SQL on
the same tables. Each body holds one page: the rows collected into it are bounded by what a page
names (20 targets, the bars of a symbol and day, 50 catalogue entries), never by the table.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rateloom.operators.bars import bars, latest_bar
from rateloom.operators.snapshots import snapshot
from rateloom.schemas import LANDED
from rateloom.session import scratch_dir
from rateloom.sources.planning import ENDPOINTS, request_identity

N_TARGETS = 20
PAGE = 50


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def folder(spark: SparkSession, name: str) -> str:
    """A folder for what a query writes. A local session without a shared folder gets one of its own."""
    local = spark.sparkContext.master.startswith("local[") and not spark.conf.get("spark.checkpoint.dir", None)
    return scratch_dir(spark, name, tempfile.mkdtemp(prefix="rateloom-") if local else None)


def as_landed(responses: DataFrame, feed: str, run_id: str = "run-1") -> DataFrame:
    """Single-page responses as a run that fetched them would land them."""
    endpoint = F.lit(ENDPOINTS[feed])
    asked = F.coalesce(F.try_element_at("params", F.lit("date")), F.try_element_at("params", F.lit("start")))
    return responses.withColumns(
        {
            "request_key": request_identity(endpoint, F.col("params")),
            "run_id": F.lit(run_id),
            "page": F.lit(0),
            "feed": endpoint,
            "request_date": F.coalesce(asked.try_cast("date"), F.to_date("fetched_at")),
            "usable": F.lit(None).cast("boolean"),
        }
    ).select(*LANDED.names)


def landed_bar_run(
    spark: SparkSession, sf_dir: str, requests: DataFrame, page_days: int, run_id: str, at: str
) -> DataFrame:
    """What a run lands for bar requests (hourly): a page for every ``page_days`` days with bars."""
    made = bars(trades(spark, sf_dir), "1Hour", tie="event_id")
    start = F.col("params")["start"].cast("date")
    asked = requests.select(
        "request_key", "params", "endpoint", F.explode(F.split(F.col("params")["symbols"], ",")).alias("symbol")
    )
    found = made.join(asked, "symbol").where(F.col("bar_date").between(start, F.col("params")["end"].cast("date")))
    keys = ["request_key", "text_params", "endpoint", "page"]
    numbered = found.withColumns(
        {"page": F.floor(F.datediff("bar_date", start) / page_days).cast("int"), "text_params": F.to_json("params")}
    )
    by_symbol = numbered.groupBy(*keys, "symbol").agg(F.sort_array(F.collect_list(_bar_json())).alias("b"))
    pages = by_symbol.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("symbol", "b"))).alias("bars"))
    params = F.from_json("text_params", "map<string,string>")
    return pages.select(
        "request_key",
        params.alias("params"),
        F.lit(200).alias("status"),
        F.to_json(F.struct("bars")).alias("body"),
        F.lit(at).cast("timestamp").alias("fetched_at"),
        F.lit(run_id).alias("run_id"),
        "page",
        F.col("endpoint").alias("feed"),
        params["start"].cast("date").alias("request_date"),
        F.lit(None).cast("boolean").alias("usable"),
    )


def user_symbol(column: str = "user_id", n: int = N_TARGETS) -> Column:
    return F.concat(F.lit("U"), (F.col(column) % n).cast("string"))


def size() -> Column:
    return F.get_json_object("props", "$.k").cast("long")


def iso(ts: Column | str) -> Column:
    """``2024-01-02T03:04:05.678Z`` from a TIMESTAMP_NTZ."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.concat(F.replace(ts.cast("string"), F.lit(" "), F.lit("T")), F.lit("Z"))


def trades(
    spark: SparkSession, sf_dir: str, symbol: Column | None = None, price: Column | None = None
) -> DataFrame:
    """symbol, ts, price, size, event_id

    Prices are whole cents: sums of them are exact, so a vwap does not depend on the order of rows.
    """
    return table(spark, sf_dir, "events").select(
        (F.col("event_type") if symbol is None else symbol).alias("symbol"),
        "ts",
        (F.rint(F.col("value") * 100) if price is None else price).alias("price"),
        size().alias("size"),
        "event_id",
    )


def is_quote() -> Column:
    """Every event is one or the other: views and clicks are quotes, all else is a trade."""
    return F.col("event_type").isin("view", "click")


def purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trades by user symbol: the events that are no quotes."""
    events = table(spark, sf_dir, "events").where(~is_quote())
    return events.select(
        user_symbol().alias("symbol"), "ts", F.col("value").alias("price"), size().alias("size"), "event_id"
    )


def quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """symbol, ts, ask_price, bid_price, event_id: the view and click events."""
    events = table(spark, sf_dir, "events").where(is_quote())
    return events.select(
        user_symbol().alias("symbol"),
        "ts",
        (F.col("value") + size() * F.lit(0.01)).alias("ask_price"),
        F.col("value").alias("bid_price"),
        "event_id",
    )


def rate_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a rate: base_currency, target_currency, rate, rate_date, rate_timestamp, event_id."""
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("base_currency"),
        user_symbol().alias("target_currency"),
        F.col("value").alias("rate"),
        F.to_date("ts").alias("rate_date"),
        F.col("ts").alias("rate_timestamp"),
        "event_id",
    )


def daily_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last rate of each day: base_currency, target_currency, rate, rate_date, rate_timestamp."""
    pair = F.struct(F.col("event_type").alias("base"), user_symbol().alias("target"))
    daily = bars(trades(spark, sf_dir, pair, F.col("value")), "1Day", tie="event_id")
    return daily.select(
        F.col("symbol.base").alias("base_currency"),
        F.col("symbol.target").alias("target_currency"),
        F.col("close").alias("rate"),
        F.col("bar_date").alias("rate_date"),
        F.col("timestamp").alias("rate_timestamp"),
    )


def amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as amounts to convert, keyed by day of month: their own years hold no rates."""
    types = F.array(*[F.lit(t) for t in ("click", "error", "purchase", "signup", "view")])
    minutes = (F.day("o_orderdate") - 1) * 1440 + F.col("o_orderkey") % 1440
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.get(types, (F.col("o_orderkey") % 5).cast("int")).alias("from_currency"),
        user_symbol("o_custkey", 25).alias("to_currency"),
        F.col("o_totalprice").alias("amount"),
        (F.expr("timestamp_ntz'2024-01-01 00:00:00'") + minutes * F.expr("interval '1' minute")).alias("ts"),
    )


def _landing(df: DataFrame, key: Column, params: dict[str, Column], body: Column, fetched: Column, status=None) -> DataFrame:
    pairs = [x for k, v in params.items() for x in (F.lit(k), v.cast("string"))]
    return df.select(
        key.alias("request_key"),
        F.create_map(*pairs).alias("params"),
        (F.lit(200) if status is None else status).cast("int").alias("status"),
        body.alias("body"),
        fetched.cast("timestamp").alias("fetched_at"),
    )


def _rate_map() -> Column:
    return F.map_from_entries(F.collect_list(F.struct("target_currency", "rate")))


def landed_historical(spark: SparkSession, sf_dir: str, failures: bool = False) -> DataFrame:
    """One historical-rates response per base and day.

    With ``failures`` every seventh day is a server error, the bodies of day 12 are cut off, and on
    day 20 one rate is no number.
    """
    days = daily_rates(spark, sf_dir).groupBy("base_currency", "rate_date").agg(_rate_map().alias("rates"))
    day = F.day("rate_date")
    body = F.to_json(
        F.struct(
            F.struct(
                F.col("base_currency").alias("base"),
                F.col("rate_date").cast("string").alias("date"),
                "rates",
            ).alias("response")
        )
    )
    status = F.lit(200)
    if failures:
        status = F.when(day % 7 == 3, 500).otherwise(200)
        body = (
            F.when(day % 7 == 3, F.lit(None))
            .when(day == 12, F.left(body, F.lit(40)))
            .when(day == 20, F.replace(body, F.lit('"rates":{'), F.lit('"rates":{"ZZ":"n/a",')))
            .otherwise(body)
        )
    return _landing(
        days,
        F.concat_ws("-", "base_currency", "rate_date"),
        {"base": F.col("base_currency"), "date": F.col("rate_date")},
        body,
        F.col("rate_date"),
        status,
    )


def landed_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One latest-rates response per base, stamped with the base's last event."""
    last = rate_quotes(spark, sf_dir).groupBy("base_currency", "target_currency").agg(
        F.max_by("rate", "rate_timestamp").alias("rate"), F.max("rate_timestamp").alias("at")
    )
    bases = last.groupBy("base_currency").agg(_rate_map().alias("rates"), F.max("at").alias("at"))
    body = F.to_json(
        F.struct(
            F.struct(iso("at").alias("last_updated_at")).alias("meta"),
            F.struct(F.col("base_currency").alias("base"), "rates").alias("response"),
        )
    )
    return _landing(bases, F.col("base_currency"), {"base": F.col("base_currency")}, body, F.col("at"))


def landed_conversions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One conversion response per order; every tenth order asks for an amount of 0."""
    orders = amounts(spark, sf_dir).withColumn(
        "amount", F.when(F.col("o_orderkey") % 10 == 0, F.lit(0.0)).otherwise(F.col("amount"))
    )
    body = F.to_json(
        F.struct(
            F.struct(iso("ts").alias("last_updated_at")).alias("meta"),
            F.struct((F.col("amount") * F.lit(1.25) + F.lit(0.5)).alias("value")).alias("response"),
        )
    )
    params = {"from": F.col("from_currency"), "to": F.col("to_currency"), "amount": F.col("amount")}
    return _landing(orders, F.col("o_orderkey").cast("string"), params, body, F.col("ts"))


def landed_currencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as currencies, 50 keys to a page."""
    parts = table(spark, sf_dir, "part").select(
        F.floor(F.col("p_partkey") / PAGE).alias("page"),
        F.struct(
            F.col("p_partkey").alias("id"),
            F.col("p_name").alias("name"),
            F.col("p_brand").alias("short_code"),
            F.col("p_type").alias("symbol"),
        ).alias("c"),
    )
    pages = parts.groupBy("page").agg(F.collect_list("c").alias("response"))
    body = F.to_json(F.struct("response"))
    return _landing(
        pages, F.col("page").cast("string"), {"type": F.lit("fiat")}, body, F.lit("2024-01-01 00:00:00")
    )


def _bar_json() -> Column:
    return F.struct(
        iso("timestamp").alias("t"),
        F.col("open").alias("o"),
        F.col("high").alias("h"),
        F.col("low").alias("l"),
        F.col("close").alias("c"),
        F.col("volume").alias("v"),
        F.col("trade_count").alias("n"),
        F.coalesce("vwap", F.lit(0.0)).alias("vw"),
    )


def landed_latest_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One latest-bar response per user symbol: its last daily bar."""
    daily = bars(trades(spark, sf_dir, user_symbol()), "1Day", tie="event_id")
    last = latest_bar(daily)
    body = F.to_json(F.struct(F.create_map("symbol", _bar_json()).alias("bars")))
    return _landing(last, F.col("symbol"), {"symbols": F.col("symbol")}, body, F.col("timestamp"))


def landed_bars(spark: SparkSession, sf_dir: str, timeframe: str = "1Hour") -> DataFrame:
    """One page of bars per symbol and day; the page names the next one."""
    made = bars(trades(spark, sf_dir), timeframe, tie="event_id")
    pages = made.groupBy("symbol", "bar_date").agg(F.sort_array(F.collect_list(_bar_json())).alias("b"))
    body = F.to_json(
        F.struct(
            F.create_map("symbol", "b").alias("bars"),
            F.date_add("bar_date", 1).cast("string").alias("next_page_token"),
        )
    )
    return _landing(
        pages,
        F.concat_ws("-", "symbol", "bar_date"),
        {"symbols": F.col("symbol"), "start": F.col("bar_date")},
        body,
        F.col("bar_date"),
    )


def landed_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One snapshot response per symbol; every other one is without the ``snapshots`` envelope."""
    made = snapshot(
        purchases(spark, sf_dir), quotes(spark, sf_dir), tie="event_id", zero_missing=False
    )
    one = F.create_map(
        "symbol",
        F.struct(
            F.struct(
                F.col("latest_trade_price").alias("p"),
                F.col("latest_trade_size").alias("s"),
                iso("latest_trade_timestamp").alias("t"),
            ).alias("latestTrade"),
            F.struct(
                F.col("latest_quote_ask_price").alias("ap"),
                F.col("latest_quote_bid_price").alias("bp"),
                iso("latest_quote_timestamp").alias("t"),
            ).alias("latestQuote"),
            F.struct(F.col("prev_daily_close").alias("c")).alias("prevDailyBar"),
        ),
    )
    bare = F.substring("symbol", 2, 9).cast("int") % 2 == 1
    body = F.when(bare, F.to_json(one)).otherwise(F.to_json(F.struct(one.alias("snapshots"))))
    return _landing(
        made, F.col("symbol"), {"symbols": F.col("symbol")}, body, F.lit("2024-02-01 00:00:00")
    )
