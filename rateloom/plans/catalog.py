"""Queries over the test tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, LongType, StringType, StructType

from rateloom import schemas
from rateloom.functions import (
    classify_response,
    json_columns,
    json_string,
    normalize_percent,
    parse_iso_utc,
    percent_text,
    safe_ratio,
    stamped_key,
    tag_string,
    text_to_double,
    zero_fill,
)
from rateloom.operators import asof, calendar, rates, shape
from rateloom.operators import bars as bar_ops
from rateloom.operators.snapshots import snapshot
from rateloom.sinks.objects import write_objects
from rateloom.sinks.parquet import write_parquet
from rateloom.sinks.sheet import write_sheet_table
from rateloom.sources import audit, envelope, files, fx, planning, requests, stocks, tables
from rateloom.streaming.landing import run_feed, run_landing

from . import bindings as b
from .backfill import land, landed_of, outstanding, write_rates
from .latest_rates import write_latest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

_CENTS = 'round("value" * 100)'
_K = "cast(json_extract_string(props, '$.k') as bigint)"
_USER = "'U' || (user_id % 20)"
_TYPES = "['click', 'error', 'purchase', 'signup', 'view']"
# Daily last rate per event type and user symbol.
_DAILY = f"""
    daily as (
        select event_type as base_currency, {_USER} as target_currency,
               arg_max("value", (ts, event_id)) as rate, cast(ts as date) as rate_date
        from events group by all)"""
_AMOUNTS = f"""
    amounts as (
        select o_orderkey, {_TYPES}[1 + o_orderkey % 5] as from_currency,
               'U' || (o_custkey % 25) as to_currency, o_totalprice as amount,
               timestamp '2024-01-01' + to_minutes((day(o_orderdate) - 1) * 1440 + o_orderkey % 1440) as ts
        from orders)"""


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return add


# ---- bars, snapshots, selections -------------------------------------------------------------


def _bars_sql(timeframe: str, symbol: str = "event_type") -> str:
    return f"""
        select {symbol} as symbol,
               time_bucket(interval '{schemas.TIMEFRAMES[timeframe]}', ts, timestamp '1970-01-01') as "timestamp",
               arg_min({_CENTS}, (ts, event_id)) as open, max({_CENTS}) as high, min({_CENTS}) as low,
               arg_max({_CENTS}, (ts, event_id)) as close, cast(sum({_K}) as bigint) as volume,
               count(*) as trade_count, sum({_CENTS} * {_K}) / nullif(sum({_K}), 0) as vwap
        from events group by 1, 2"""


def _with_date(sql: str) -> str:
    return f'select *, cast("timestamp" as date) as bar_date from ({sql})'


def _register_bars(timeframe: str) -> None:
    @query(f"bars_{timeframe.lower()}", _with_date(_bars_sql(timeframe)))
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return bar_ops.bars(b.trades(spark, sf_dir), timeframe, tie="event_id")


for _timeframe in schemas.TIMEFRAMES:
    _register_bars(_timeframe)


@query(
    "latest_bar",
    f"""select * from ({_with_date(_bars_sql("1Day", _USER))})
        qualify row_number() over (partition by symbol order by "timestamp" desc) = 1""",
)
def latest_bar(spark, sf_dir):
    daily = bar_ops.bars(b.trades(spark, sf_dir, b.user_symbol()), "1Day", tie="event_id")
    return bar_ops.latest_bar(daily)


@query(
    "latest_bar_of_trades",
    f"""select * from ({_with_date(_bars_sql("1Min", _USER))})
        qualify row_number() over (partition by symbol order by "timestamp" desc) = 1""",
)
def latest_bar_of_trades(spark, sf_dir):
    return bar_ops.latest_bar_of_trades(b.trades(spark, sf_dir, b.user_symbol()), "1Min", tie="event_id")


_SNAPSHOT = f"""
    with t as (select {_USER} as symbol, ts, event_id, "value" as price, {_K} as size
               from events where event_type not in ('view', 'click')),
    d as (select symbol, cast(ts as date) as day, arg_max(price, (ts, event_id)) as price,
                 arg_max(size, (ts, event_id)) as size, max(ts) as ts from t group by 1, 2),
    r as (select *, row_number() over w as n, lead(price) over w as prev
          from d window w as (partition by symbol order by day desc)),
    q as (select {_USER} as symbol, arg_max("value", (ts, event_id)) as bid,
                 arg_max("value" + {_K} * cast(0.01 as double), (ts, event_id)) as ask, max(ts) as ts
          from events where event_type in ('view', 'click') group by 1)
    select coalesce(a.symbol, q.symbol) as symbol, coalesce(a.price, 0) as latest_trade_price,
           coalesce(a.size, 0) as latest_trade_size, a.ts as latest_trade_timestamp,
           coalesce(q.ask, 0) as latest_quote_ask_price, coalesce(q.bid, 0) as latest_quote_bid_price,
           q.ts as latest_quote_timestamp, coalesce(a.prev, 0) as prev_daily_close
    from (select * from r where n = 1) a full join q on a.symbol = q.symbol"""


@query("snapshot", _SNAPSHOT)
def snapshot_of_trades(spark, sf_dir):
    return snapshot(b.purchases(spark, sf_dir), b.quotes(spark, sf_dir), tie="event_id")


@query(
    "range_selection",
    """select event_id, ts, event_type, "value" from events
       where ts >= '2024-01-05' and ts < '2024-01-13' and event_type in ('view', 'click')""",
)
def range_selection(spark, sf_dir):
    events = b.table(spark, sf_dir, "events")
    chosen = bar_ops.select_range(
        events, "2024-01-05", "2024-01-12", ["view", "click"], ts="ts", symbol_column="event_type"
    )
    return chosen.select("event_id", "ts", "event_type", "value")


@query(
    "partition_selection",
    f"""select * from ({_with_date(_bars_sql("4Hour"))})
        where bar_date between '2024-01-10' and '2024-01-12' and symbol in ('view', 'error')""",
)
def partition_selection(spark, sf_dir):
    made = bar_ops.bars(b.trades(spark, sf_dir), "4Hour", tie="event_id")
    uri = write_parquet(made, b.folder(spark, "bars"), "four-hourly", "b.parquet", partition_by=["bar_date"])
    stored = spark.read.parquet(uri).select(*made.columns)
    return bar_ops.select_range(stored, "2024-01-10", "2024-01-12", ["view", "error"], day="bar_date")


@query("feed_selection", "select o_orderkey, o_totalprice from orders where o_orderstatus = 'F'")
def feed_selection(spark, sf_dir):
    orders = b.table(spark, sf_dir, "orders")
    return bar_ops.select_range(orders, feed="F", feed_column="o_orderstatus").select("o_orderkey", "o_totalprice")


# ---- exchange rates --------------------------------------------------------------------------


@query(
    "convert_amounts",
    f"""with {_AMOUNTS},
        quotes as (select event_type as f, {_USER} as t, ts as at, arg_max("value", event_id) as rate
                   from events group by all)
        select a.*, q.at as rate_timestamp, q.rate as rate, a.amount * q.rate as converted_amount
        from amounts a asof left join quotes q
          on a.from_currency = q.f and a.to_currency = q.t and a.ts >= q.at""",
)
def convert_amounts(spark, sf_dir):
    return asof.convert_amounts(b.amounts(spark, sf_dir), b.rate_quotes(spark, sf_dir), tie="event_id")


@query(
    "asof_quote_of_trade",
    f"""with q as (select {_USER} as u, ts as at, "value" as bid, "value" + {_K} * cast(0.01 as double) as ask
                   from events where event_type in ('view', 'click'))
        select {_USER} as symbol, e.ts, e."value" as price, {_K} as size, e.event_id,
               q.at as rate_timestamp, q.ask as ask_price, q.bid as bid_price
        from events e asof left join q on {_USER} = q.u and e.ts >= q.at
        where e.event_type not in ('view', 'click')""",
)
def asof_quote_of_trade(spark, sf_dir):
    quotes = b.quotes(spark, sf_dir)
    return asof.asof_join(
        b.purchases(spark, sf_dir), quotes, ["symbol"], ["ask_price", "bid_price"], tie="event_id"
    )


@query(
    "rate_for_pair",
    f"""with {_AMOUNTS},
        pairs as (select distinct from_currency as base_currency, to_currency as target_currency from amounts),
        last as (select event_type as b, {_USER} as t, arg_max("value", (ts, event_id)) as rate
                 from events group by all)
        select p.*, l.rate from pairs p left join last l on p.base_currency = l.b and p.target_currency = l.t""",
)
def rate_for_pair(spark, sf_dir):
    pairs = b.amounts(spark, sf_dir).select(
        F.col("from_currency").alias("base_currency"), F.col("to_currency").alias("target_currency")
    )
    return rates.rate_for_pair(pairs.distinct(), b.rate_quotes(spark, sf_dir), tie="event_id")


@query(
    "rate_for_pair_on_date",
    f"""with {_AMOUNTS}, {_DAILY}
        select a.o_orderkey, a.from_currency as base_currency, a.to_currency as target_currency,
               cast(a.ts as date) as rate_date, d.rate
        from amounts a left join daily d on a.from_currency = d.base_currency
          and a.to_currency = d.target_currency and cast(a.ts as date) = d.rate_date""",
)
def rate_for_pair_on_date(spark, sf_dir):
    pairs = b.amounts(spark, sf_dir).select(
        "o_orderkey",
        F.col("from_currency").alias("base_currency"),
        F.col("to_currency").alias("target_currency"),
        F.to_date("ts").alias("rate_date"),
    )
    return rates.rate_for_pair(pairs, b.rate_quotes(spark, sf_dir), on_date=True, tie="event_id")


@query(
    "rebase_rates",
    f"""with {_DAILY}
        select r.base_currency as via_currency, n.target_currency as base_currency, r.target_currency,
               r.rate / n.rate as rate, r.rate_date, cast(r.rate_date as timestamp) as rate_timestamp
        from daily r join daily n on r.base_currency = n.base_currency and r.rate_date = n.rate_date
        where n.target_currency in ('U0', 'U7')""",
)
def rebase_rates(spark, sf_dir):
    return rates.rebase(b.daily_rates(spark, sf_dir), ["U0", "U7"])


@query(
    "cross_rates",
    f"""with {_DAILY},
        pairs as (select distinct 'U' || (c_custkey % 20) as f, 'U' || (c_nationkey % 20) as t from customer)
        select x.base_currency as via_currency, f as from_currency, t as to_currency,
               y.rate / x.rate as rate, x.rate_date, cast(x.rate_date as timestamp) as rate_timestamp
        from daily x join pairs on x.target_currency = f
        join daily y on y.target_currency = t and x.base_currency = y.base_currency and x.rate_date = y.rate_date""",
)
def cross_rates(spark, sf_dir):
    pairs = b.table(spark, sf_dir, "customer").select(
        b.user_symbol("c_custkey").alias("from_currency"), b.user_symbol("c_nationkey").alias("to_currency")
    )
    return rates.cross_rates(b.daily_rates(spark, sf_dir), pairs)


@query("currency_kind", "select p_partkey, p_name from part where p_type = 'ECONOMY'")
def currency_kind(spark, sf_dir):
    parts = b.table(spark, sf_dir, "part")
    return rates.currency_kind(parts, "ECONOMY", "p_type").select("p_partkey", "p_name")


_CODES = """(select o_orderkey, chr(cast(65 + o_orderkey % 26 as int)) || chr(cast(65 + o_custkey % 26 as int))
             || chr(cast(65 + (o_orderkey // 26) % 26 as int)) as code from orders)"""
_CODE_LIST = ", ".join(f"'{c}'" for c in schemas.CURRENCY_CODES)


def _codes(spark, sf_dir):
    letter = lambda c: F.char(F.lit(65) + c % 26)
    orders = b.table(spark, sf_dir, "orders")
    third = F.floor(F.col("o_orderkey") / 26)
    code = F.concat(letter(F.col("o_orderkey")), letter(F.col("o_custkey")), letter(third))
    return orders.select("o_orderkey", code.alias("code"))


@query("currency_accepted", f"select o_orderkey, code from {_CODES} where code in ({_CODE_LIST})")
def currency_accepted(spark, sf_dir):
    return rates.validate_currency(_codes(spark, sf_dir), "code")


@query("currency_rejected", f"select o_orderkey, code from {_CODES} where code not in ({_CODE_LIST})")
def currency_rejected(spark, sf_dir):
    return rates.validate_currency(_codes(spark, sf_dir), "code", rejects=True)


# ---- feeds -----------------------------------------------------------------------------------

# The load time differs from run to run, so it is left out of what is compared.
_LOADED = "ingestion_datetime"


@query(
    "rates_latest",
    f"""with q as (select event_type as base_currency, {_USER} as target_currency,
                          arg_max("value", ts) as rate from events group by all),
        m as (select event_type, max(ts) as last_ts from events group by 1)
        select q.*, cast(last_ts as date) as rate_date, last_ts as rate_timestamp
        from q join m on base_currency = event_type""",
)
def rates_latest(spark, sf_dir):
    return fx.rates_latest(b.landed_latest(spark, sf_dir)).drop(_LOADED)


@query(
    "rates_historical",
    f"with {_DAILY} select *, cast(rate_date as timestamp) as rate_timestamp from daily",
)
def rates_historical(spark, sf_dir):
    return fx.rates_historical(b.landed_historical(spark, sf_dir)).drop(_LOADED)


_FAILED_DAY = "(day(rate_date) % 7 = 3 or day(rate_date) in (12, 20))"


@query(
    "rates_timeseries",
    f"""with {_DAILY}
        select *, cast(rate_date as timestamp) as rate_timestamp,
               cast(floor(date_diff('day', date '2024-01-04', rate_date) / 7) as int) as batch
        from daily where not {_FAILED_DAY} and rate_date between '2024-01-04' and '2024-02-10'""",
)
def rates_timeseries(spark, sf_dir):
    landed = b.landed_historical(spark, sf_dir, failures=True)
    return fx.rates_timeseries(landed, "2024-01-04", "2024-02-10").drop(_LOADED)


_CALENDAR = """
    calendar as (
        select base_currency, cast(d as date) as rate_date,
               cast(floor(date_diff('day', date '2024-01-04', cast(d as date)) / 7) as int) as batch
        from (select distinct event_type as base_currency from events),
             generate_series(date '2024-01-04', date '2024-02-10', interval 1 day) g(d))"""


@query(
    "batch_audit",
    f"""with {_DAILY}, {_CALENDAR},
        got as (select base_currency, rate_date, count(*) as n from daily where not {_FAILED_DAY} group by 1, 2)
        select base_currency, batch, min(rate_date) as batch_start, max(rate_date) as batch_end,
               count(*) as days, count(*) - count(n) as failed_days,
               cast(coalesce(sum(n), 0) as bigint) as n_rows
        from calendar left join got using (base_currency, rate_date) group by 1, 2""",
)
def batch_audit(spark, sf_dir):
    landed = b.landed_historical(spark, sf_dir, failures=True)
    bases = b.table(spark, sf_dir, "events").select(F.col("event_type").alias("base_currency")).distinct()
    return fx.rates_timeseries_audit(landed, bases, "2024-01-04", "2024-02-10")


@query(
    "missing_days",
    f"""with {_DAILY}, {_CALENDAR}
        select base_currency, rate_date as day, batch from calendar
        anti join (select * from daily where not {_FAILED_DAY}) using (base_currency, rate_date)""",
)
def missing_days(spark, sf_dir):
    landed = b.landed_historical(spark, sf_dir, failures=True)
    bases = b.table(spark, sf_dir, "events").select(
        F.col("event_type").alias("base_currency"), F.lit("2024-01-04").alias("a"), F.lit("2024-02-10").alias("z")
    )
    days = calendar.day_calendar(bases.distinct(), "a", "z", 7, ["base_currency"])
    return calendar.missing_days(days, fx.historical_results(landed), ["base_currency"])


@query(
    "convert_currency",
    f"""with {_AMOUNTS},
        a as (select * replace (case when o_orderkey % 10 = 0 then 0 else amount end as amount) from amounts)
        select from_currency, to_currency, amount, amount * 1.25::double + 0.5::double as converted_amount,
               case when amount = 0 then 0 else (amount * 1.25::double + 0.5::double) / amount end as rate,
               ts as rate_timestamp
        from a""",
)
def convert_currency(spark, sf_dir):
    return fx.convert_currency(b.landed_conversions(spark, sf_dir)).drop(_LOADED)


@query(
    "currencies",
    """select cast(p_partkey as varchar) as currency_code, p_name as currency_name,
              p_brand as short_code, p_type as symbol from part""",
)
def currencies(spark, sf_dir):
    return fx.currencies(b.landed_currencies(spark, sf_dir)).drop(_LOADED)


@query(
    "bars_latest",
    f"""select * replace (coalesce(vwap, 0) as vwap) from ({_with_date(_bars_sql("1Day", _USER))})
        qualify row_number() over (partition by symbol order by "timestamp" desc) = 1""",
)
def bars_latest(spark, sf_dir):
    return stocks.bars_latest(b.landed_latest_bars(spark, sf_dir)).drop(_LOADED)


_HOURS = f"""select * replace (coalesce(vwap, 0) as vwap) from ({_with_date(_bars_sql("1Hour"))})"""


@query("bars_historical", _HOURS)
def bars_historical(spark, sf_dir):
    return stocks.bars_historical(b.landed_bars(spark, sf_dir)).drop(_LOADED)


@query("bars_historical_limit", f'{_HOURS} order by symbol, "timestamp" limit 100')
def bars_historical_limit(spark, sf_dir):
    return stocks.bars_historical(b.landed_bars(spark, sf_dir), limit=100).drop(_LOADED)


@query(
    "bars_timeseries",
    f"""select *, cast(floor(date_diff('day', date '2024-01-03', bar_date) / 10) as int) as batch
        from ({_HOURS}) where bar_date between '2024-01-03' and '2024-01-25'""",
)
def bars_timeseries(spark, sf_dir):
    chosen = stocks.bars_timeseries(b.landed_bars(spark, sf_dir), "2024-01-03", "2024-01-25", 10)
    return chosen.drop(_LOADED)


@query("snapshot_feed", _SNAPSHOT)
def snapshot_feed(spark, sf_dir):
    return stocks.snapshots(b.landed_snapshots(spark, sf_dir)).drop(_LOADED)


@query(
    "close_on_date",
    f"""with r as (select o_orderkey, 'U' || (o_custkey % 25) as symbol,
                          cast(date '2024-01-01' + cast(day(o_orderdate) - 1 as int) as date) as "date" from orders),
        c as (select {_USER} as symbol, cast(ts as date) as "date", arg_max({_CENTS}, (ts, event_id)) as close
              from events group by 1, 2)
        select r.*, c.close from r left join c using (symbol, "date")""",
)
def close_on_date(spark, sf_dir):
    daily = bar_ops.bars(b.trades(spark, sf_dir, b.user_symbol()), "1Day", tie="event_id")
    wanted = b.amounts(spark, sf_dir).select(
        "o_orderkey", F.col("to_currency").alias("symbol"), F.to_date("ts").alias("date")
    )
    return bar_ops.close_on_date(wanted, daily)


@query(
    "latest_responses",
    f"""with {_DAILY} select *, cast(rate_date as timestamp) as rate_timestamp from daily""",
)
def latest_responses(spark, sf_dir):
    landed = b.landed_historical(spark, sf_dir)
    # A first try of every request that failed, and a second copy of the good answer.
    failed = landed.withColumn("status", F.lit(500)).withColumn("body", F.lit(None).cast("string"))
    failed = failed.withColumn("fetched_at", F.col("fetched_at") - F.expr("interval '1' hour"))
    copies = shape.concat_batches([landed, failed, landed])
    return fx.rates_historical(envelope.latest_responses(copies)).drop(_LOADED)


def _land_run(rows: DataFrame, landing: str, feed: str = "rates_historical") -> None:
    land(rows, planning.ENDPOINTS[feed], landing)


def _bases(spark, sf_dir) -> DataFrame:
    return b.table(spark, sf_dir, "events").select(F.col("event_type").alias("base_currency")).distinct()


def _rate_requests(spark, sf_dir, start: str, end: str) -> DataFrame:
    ranges = _bases(spark, sf_dir).select("base_currency", F.lit(start).alias("start"), F.lit(end).alias("end"))
    return planning.historical_rate_requests(ranges)


@query(
    "fetch_responses",
    f"with {_DAILY} select *, cast(rate_date as timestamp) as rate_timestamp from daily",
)
def fetch_responses(spark, sf_dir):
    """What landed of the planned requests; an earlier run that failed is in the folder too."""
    landed = b.as_landed(b.landed_historical(spark, sf_dir), "rates_historical", "run-2")
    failed = landed.withColumns(
        {"status": F.lit(500), "body": F.lit(None).cast("string"), "run_id": F.lit("run-1")}
    )
    root = b.folder(spark, "landing")
    _land_run(shape.concat_batches([failed, landed]), root)
    asked = _rate_requests(spark, sf_dir, "2024-01-01", "2024-02-10")
    return fx.rates_historical(landed_of(asked, root)).drop(_LOADED)


@query(
    "outstanding_requests",
    f"""with {_DAILY}, r as (select distinct base_currency, rate_date, day(rate_date) as d from daily),
        asked as (select base, cast(g as date) as day from (select distinct event_type as base from events),
                  generate_series(date '2024-01-01', date '2024-02-10', interval 1 day) t(g))
        select base, cast(day as varchar) as "date" from asked a
        where not exists (select 1 from r where base_currency = base and rate_date = day and d % 7 != 3 and d not in (12, 20))""",
)
def outstanding_requests(spark, sf_dir):
    """The requests that a resumed backfill calls: those without an answer, and those whose answer failed
    or can't be used by the feed (cut off, or with a rate that is no number)."""
    root = b.folder(spark, "landing")
    _land_run(b.as_landed(b.landed_historical(spark, sf_dir, failures=True), "rates_historical"), root)
    left = outstanding(_rate_requests(spark, sf_dir, "2024-01-01", "2024-02-10"), root)
    return left.select(F.col("params")["base"].alias("base"), F.col("params")["date"].alias("date"))


_STATUS = "[200, 200, 200, 302, 400, 401, 403, 404, 429, 500, 503, null]"


@query(
    "classify_response",
    f"""with r as (select event_id, {_STATUS}[1 + cast({_K} % 12 as int)] as status, event_id % 5 + 1 as attempt,
                          case when user_id % 3 = 0 then cast(user_id % 10 as int) end as after,
                          ['pending', 'failed', 'done', 'none'][1 + cast(event_id % 4 as int)] as reauth from events),
        a as (select *, case when status < 400 then 'ok' when status = 400 then 'bad_request'
                when status = 401 and reauth = 'pending' then 'reauth'
                when status = 401 and reauth = 'failed' then 'auth_error'
                when attempt >= 5 then 'stop' else 'retry' end as action from r)
        select event_id, cast(status as int) as status, action, cast(case when action = 'retry' then
               case when status = 429 then coalesce(after, 1) else 2 end end as int) as wait_seconds from a""",
)
def classify(spark, sf_dir):
    codes = F.array(*[F.lit(s) for s in (200, 200, 200, 302, 400, 401, 403, 404, 429, 500, 503, None)])
    states = F.array(*[F.lit(s) for s in ("pending", "failed", "done", "none")])
    tries = b.table(spark, sf_dir, "events").select(
        "event_id",
        F.get(codes, (b.size() % 12).cast("int")).alias("status"),
        (F.col("event_id") % 5 + 1).alias("attempt"),
        F.when(F.col("user_id") % 3 == 0, (F.col("user_id") % 10).cast("int")).alias("after"),
        F.get(states, (F.col("event_id") % 4).cast("int")).alias("state"),
    )
    verdict = classify_response(
        F.col("status"), F.col("after"), F.col("attempt"), reauth=F.col("state")
    )
    return tries.select("event_id", "status", verdict.alias("v")).select("event_id", "status", "v.*")


@query(
    "response_audit",
    f"""with {_DAILY}, r as (select distinct base_currency, rate_date from daily),
        s as (select case when day(rate_date) % 7 = 3 then 500 else 200 end as status from r)
        select cast(status as int) as status, case status when 200 then 'ok' else 'retry' end as action,
               count(*) as n from s group by 1, 2""",
)
def response_audit(spark, sf_dir):
    return audit.response_audit(b.landed_historical(spark, sf_dir, failures=True))


@query(
    "unusable_responses",
    f"""with {_DAILY}, r as (select distinct base_currency, rate_date, day(rate_date) as d from daily)
        select base_currency || '-' || rate_date as request_key,
               cast(case when d % 7 = 3 then 500 else 200 end as int) as status,
               case when d % 7 = 3 then 'status' when d = 12 then 'json' else 'content' end as reason
        from r where {_FAILED_DAY}""",
)
def unusable_responses(spark, sf_dir):
    landed = b.landed_historical(spark, sf_dir, failures=True)
    return audit.unusable_responses(landed, "rates_historical").drop("body")


_WINDOWS = """
        w as (select cast(i as int) as batch, cast(date '2023-12-25' + cast(i * 10 as int) as date) as batch_start,
                     least(cast(date '2023-12-25' + cast(i * 10 + 9 as int) as date), date '2024-02-25') as batch_end
              from range(7) t(i))"""


@query(
    "bars_timeseries_audit",
    f"""with h as (select symbol, bar_date, day(bar_date) as d, count(*) as n from ({_HOURS}) group by all),
        asked as (select symbol, cast(g as date) as day from (select distinct symbol from h),
                  generate_series(date '2023-12-25', date '2024-02-25', interval 1 day) t(g)),
        p as (select cast(floor(date_diff('day', date '2023-12-25', day) / 10) as int) as batch,
                     count(h.symbol) as pages, count(*) filter (d % 7 = 3 or d = 12) as bad,
                     count(*) filter (h.symbol is null) as missing,
                     coalesce(sum(n) filter (d % 7 != 3 and d != 12), 0)::bigint as n_rows
              from asked left join h on asked.symbol = h.symbol and day = bar_date and d % 5 != 0 group by 1), {_WINDOWS}
        select w.*, pages, bad + missing as failed_pages, n_rows, missing from w join p using (batch)""",
)
def bars_timeseries_audit(spark, sf_dir):
    """Every fifth day never landed, every seventh failed, the bodies of day 12 are cut off."""
    day = F.day("request_date")
    landed = b.as_landed(b.landed_bars(spark, sf_dir), "bars_historical").where(day % 5 != 0)
    landed = landed.withColumns(
        {
            "status": F.when(day % 7 == 3, 500).otherwise(200),
            "body": F.when(day % 7 == 3, F.lit(None)).when(day == 12, F.left("body", F.lit(40))).otherwise(F.col("body")),
        }
    )
    symbols = b.trades(spark, sf_dir).select("symbol").distinct()
    days = calendar.day_calendar(
        symbols.withColumns({"_from": F.lit("2023-12-25"), "_to": F.lit("2024-02-25")}), "_from", "_to", keep=["symbol"]
    )
    params = F.create_map(F.lit("symbols"), F.col("symbol"), F.lit("start"), F.col("day").cast("string"))
    asked = days.select(params.alias("params")).select(
        planning.request_identity(F.lit(planning.ENDPOINTS["bars_historical"]), F.col("params")).alias("request_key"), "params"
    )
    return stocks.bars_timeseries_audit(landed, "2023-12-25", "2024-02-25", 10, asked)


@query(
    "plan_rate_requests",
    """with r as (select 'B' || user_id as base, cast(min(ts) as date) as lo, cast(max(ts) as date) as hi
                  from events group by 1),
       d as (select base, cast(unnest(generate_series(lo, hi, interval 1 day)) as date) as day from r)
       select md5('historical?base=' || base || '&date=' || day) as request_key, 'historical' as endpoint, base, cast(day as varchar) as "date" from d""",
)
def plan_rate_requests(spark, sf_dir):
    base = F.concat(F.lit("B"), F.col("user_id").cast("string")).alias("base_currency")
    ranges = b.table(spark, sf_dir, "events").groupBy(base).agg(F.min("ts").alias("start"), F.max("ts").alias("end"))
    made = planning.historical_rate_requests(ranges)
    params = F.col("params")
    return made.select("request_key", "endpoint", params["base"].alias("base"), params["date"].alias("date"))


@query(
    "plan_bar_requests",
    """select 'U' || user_id as symbol, d as "start",
              cast(least(cast(d as date) + 9, date '2024-02-20') as varchar) as "end", 'iex' as feed
       from (select distinct user_id from events),
            (select cast(cast(g as date) as varchar) as d
             from generate_series(date '2024-01-01', date '2024-02-20', interval 10 day) t(g))""",
)
def plan_bar_requests(spark, sf_dir):
    symbols = b.table(spark, sf_dir, "events").select(
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("symbol")
    )
    made = planning.bar_requests(symbols, "2024-01-01", "2024-02-20", "1Hour", batch_days=10, per_request=40)
    named = F.explode(F.split(F.col("params")["symbols"], ",")).alias("symbol")
    return made.select(named, *[F.col("params")[p].alias(p) for p in ("start", "end", "feed")])


def _backfill(spark, sf_dir):
    root = b.folder(spark, "backfill")
    _land_run(b.as_landed(b.landed_historical(spark, sf_dir, failures=True), "rates_historical"), f"{root}/landing")
    asked = _rate_requests(spark, sf_dir, "2024-01-04", "2024-02-10")
    landed = landed_of(asked, f"{root}/landing")
    return write_rates(
        landed, _bases(spark, sf_dir), "2024-01-04", "2024-02-10", root, "rates", filename="rates.parquet"
    )


@query(
    "backfill_rates",
    f"""with {_DAILY} select *, cast(rate_date as timestamp) as rate_timestamp from daily
        where not {_FAILED_DAY} and rate_date between '2024-01-04' and '2024-02-10'""",
)
def backfill(spark, sf_dir):
    uri, _ = _backfill(spark, sf_dir)
    return spark.read.parquet(uri).drop(_LOADED)


def _bar_backfills(spark, sf_dir) -> tuple[DataFrame, str]:
    """The later of two backfills of other symbols, feeds and pages into one folder, and that folder.

    The later one has been run before, with more and smaller pages.
    """
    root = b.folder(spark, "landing")
    names = lambda *n: spark.createDataFrame([(x,) for x in n], "symbol string")
    one = planning.bar_requests(names("click", "error", "view"), "2024-01-01", "2024-01-30", "1Hour", "sip", batch_days=10)
    two = planning.bar_requests(names("view", "purchase"), "2024-01-01", "2024-01-30", "1Hour", "iex", 500, 15)
    runs = ((one, 1, "run-1", "2024-02-01"), (two, 1, "run-2", "2024-02-02"), (two, 5, "run-3", "2024-02-03"))
    for asked, page_days, run, at in runs:
        _land_run(b.landed_bar_run(spark, sf_dir, asked, page_days, run, at), root, "bars_historical")
    return two, root


@query(
    "second_backfill",
    f"select * from ({_HOURS}) where symbol in ('view', 'purchase') and bar_date <= '2024-01-30'",
)
def second_backfill(spark, sf_dir):
    asked, root = _bar_backfills(spark, sf_dir)
    return stocks.bars_historical(landed_of(asked, root)).drop(_LOADED)


@query(
    "backfill_pages",
    f"""select 'view,purchase' as symbols, least((day(bar_date) - 1) // 15, 1) * 15 + 1 as first_day,
               cast(floor(((day(bar_date) - 1) % 15) / 5) as int) as page, 'run-3' as run_id, count(*) as n_bars
        from ({_HOURS}) where symbol in ('view', 'purchase') and bar_date <= '2024-01-30' group by all""",
)
def backfill_pages(spark, sf_dir):
    """Which run's pages count."""
    asked, root = _bar_backfills(spark, sf_dir)
    read, found, _ = stocks.read_historical(landed_of(asked, root))
    n_bars = F.aggregate(F.map_values(found), F.lit(0), lambda n, bars: n + F.size(bars))
    return read.select(
        F.lit("view,purchase").alias("symbols"),
        F.day("request_date").cast("long").alias("first_day"),
        "page",
        "run_id",
        n_bars.cast("long").alias("n_bars"),
    )


@query("backfill_audit", ORACLE["batch_audit"])
def backfill_audit(spark, sf_dir):
    _, gaps = _backfill(spark, sf_dir)
    return gaps


# ---- objects, sheets, SQL, sinks -------------------------------------------------------------


def _put_pages(spark, sf_dir) -> str:
    root = b.folder(spark, "pages")
    pages = b.table(spark, sf_dir, "pages").select(
        F.format_string("%s/p%d.html", F.regexp_extract("url", "^(https?):", 1), "page_id").alias("key"),
        F.col("html").alias("content"),
        F.create_map(F.lit("url"), F.col("url")).alias("tags"),
    )
    write_objects(pages, root)
    return root


_KEY = "regexp_extract(url, '^(https?):', 1) || '/p' || page_id || '.html'"


@query(
    "list_objects",
    f"""select {_KEY} as key, 'p' || page_id || '.html' as name, 'text/html' as mime_type,
               cast(octet_length(encode(html)) as bigint) as length from pages""",
)
def list_objects(spark, sf_dir):
    listed = files.list_objects(spark, _put_pages(spark, sf_dir), where=F.col("mime_type") == "text/html")
    return listed.drop("modified")


@query("read_objects", f"select {_KEY} as key, html from pages where url like 'https:%'")
def read_objects(spark, sf_dir):
    found = files.read_objects(spark, _put_pages(spark, sf_dir), prefix="https/")
    return found.select("key", F.col("content").cast("string").alias("html"))


@query("read_keys", f"select {_KEY} as key, html from pages where url like '%/en/%'")
def read_keys(spark, sf_dir):
    root = _put_pages(spark, sf_dir)
    pages = b.table(spark, sf_dir, "pages").where(F.col("url").contains("/en/"))
    keys = pages.select(F.format_string("%s/p%d.html", F.regexp_extract("url", "^(https?):", 1), "page_id").alias("key"))
    found = files.read_keys(keys, root)
    return found.select("key", F.col("content").cast("string").alias("html"))


@query(
    "write_objects",
    f"""select {_KEY} as key, 'url=' || replace(url_encode(url), '%20', '+') as tags from pages""",
)
def object_tags(spark, sf_dir):
    from rateloom.sinks.manifest import read_manifest

    return read_manifest(spark, _put_pages(spark, sf_dir)).select("key", "tags")


@query(
    "sheet_table",
    """select conv_id, cast(turn as varchar) as turn, role, text from conversations""",
)
def sheet_table(spark, sf_dir):
    path = b.folder(spark, "sheet")
    write_sheet_table(b.table(spark, sf_dir, "conversations"), path)
    return tables.read_sheet_table(spark, path, {"conv_id": LongType(), "text": StringType()}, multi_line=True)


_SQL = """select o_orderpriority, count(*) as n, max(o_totalprice) as top, min(l_shipdate) as first_ship
          from orders join lineitem on l_orderkey = o_orderkey
          where l_quantity > 25 group by o_orderpriority"""


@query("sql_query", _SQL)
def sql_query(spark, sf_dir):
    views = {name: b.table(spark, sf_dir, name) for name in ("orders", "lineitem")}
    return tables.query(spark, _SQL, views)


@query("write_parquet", _with_date(_bars_sql("1Hour")))
def parquet_round_trip(spark, sf_dir):
    made = bar_ops.bars(b.trades(spark, sf_dir), "1Hour", tie="event_id")
    uri = write_parquet(
        made, b.folder(spark, "bars"), "/stocks/hourly/", "bars.parquet", {"kind": "bars"}, ["bar_date"]
    )
    return spark.read.parquet(uri).select(*made.columns)


@query(
    "latest_rates_job",
    f"""select * from ({ORACLE["rates_latest"]}) where base_currency in ('click', 'view')""",
)
def latest_rates_job(spark, sf_dir):
    codes = ("click", "error", "purchase", "signup", "view")
    landed = b.as_landed(b.landed_latest(spark, sf_dir), "rates_latest", "poll-2")
    # An earlier poll with other rates, and a later one that failed.
    earlier = landed.withColumns(
        {
            "run_id": F.lit("poll-1"),
            "fetched_at": F.col("fetched_at") - F.expr("interval '1' hour"),
            "body": F.regexp_replace("body", '"rates":.*', '"rates":{"OLD":1}}}'),
        }
    )
    failed = landed.withColumns(
        {
            "run_id": F.lit("poll-3"),
            "fetched_at": F.col("fetched_at") + F.expr("interval '1' hour"),
            "status": F.lit(500),
            "body": F.lit(None).cast("string"),
        }
    )
    root = b.folder(spark, "fx")
    _land_run(shape.concat_batches([earlier, landed, failed]), f"{root}/landing", "rates_latest")
    bases = ["click", "view"]
    asked = planning.latest_rate_requests(spark.createDataFrame([(x,) for x in bases], "base_currency string"))
    uri, _ = write_latest(asked, f"{root}/landing", bases, root, "latest", codes)
    return spark.read.parquet(uri).drop(_LOADED)


def _deliveries(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Two deliveries of responses; the second repeats days 11 to 20."""
    day = F.day(F.to_date("fetched_at"))
    landed = b.landed_historical(spark, sf_dir)
    at = F.to_date("fetched_at").cast("timestamp") + F.expr("interval '1' second")
    landed = b.as_landed(landed.withColumn("fetched_at", at), "rates_historical").withColumn("day", day)
    return landed.where("day <= 20").drop("day"), landed.where("day > 10").drop("day")


def _land(spark, root: str, delivery: DataFrame) -> None:
    delivery.write.mode("append").json(f"{root}/in")
    partitions = spark.sparkContext.defaultParallelism
    run_landing(spark, f"{root}/in", f"{root}/landing", f"{root}/landing-checkpoint", partitions=partitions)


@query("incremental_landing", ORACLE["rates_historical"])
def incremental_landing(spark, sf_dir):
    root = b.folder(spark, "stream")
    for delivery in _deliveries(spark, sf_dir):
        _land(spark, root, delivery)
    return fx.rates_historical(spark.read.parquet(f"{root}/landing")).drop(_LOADED)


@query("polled_rates", ORACLE["rates_historical"])
def polled_rates(spark, sf_dir):
    """One request per base, asked again every day: all polls land, redelivered ones once."""
    landed = b.landed_historical(spark, sf_dir)
    asked = F.create_map(F.lit("base"), F.col("params")["base"])
    polls = b.as_landed(landed.withColumn("params", asked), "rates_latest").withColumn(
        "run_id", F.concat(F.lit("poll-"), F.to_date("fetched_at").cast("string"))
    )
    root = b.folder(spark, "stream")
    for delivery in (polls.where("day(fetched_at) <= 16"), polls.where("day(fetched_at) > 14")):
        _land(spark, root, delivery)
    return fx.rates_historical(spark.read.parquet(f"{root}/landing")).drop(_LOADED)


@query(
    "rejected_lines",
    """select case when event_id % 3 = 0 then '{"request_key":"' || event_id
              when event_id % 3 = 1 then '{"status":' || event_id || '}' else 'line ' || event_id end as line
       from events where event_id % 20 < 10""",
)
def rejected_lines(spark, sf_dir):
    """Lines that are cut off, without a key, or no JSON, among good ones."""
    number = F.col("event_id").cast("string")
    line = (
        F.when(F.col("event_id") % 20 >= 10, F.concat(F.lit('{"request_key":"'), number, F.lit('","status":200}')))
        .when(F.col("event_id") % 3 == 0, F.concat(F.lit('{"request_key":"'), number))
        .when(F.col("event_id") % 3 == 1, F.concat(F.lit('{"status":'), number, F.lit("}")))
        .otherwise(F.concat(F.lit("line "), number))
    )
    root = b.folder(spark, "stream")
    b.table(spark, sf_dir, "events").select(line.alias("value")).write.text(f"{root}/in")
    run_landing(
        spark, f"{root}/in", f"{root}/landing", f"{root}/checkpoint",
        partitions=spark.sparkContext.defaultParallelism, rejects=f"{root}/rejects",
    )
    return spark.read.parquet(f"{root}/rejects").select("line")


@query("incremental_rates", ORACLE["rates_historical"])
def incremental_rates(spark, sf_dir):
    root = b.folder(spark, "stream")
    for delivery in _deliveries(spark, sf_dir):
        _land(spark, root, delivery)
        run_feed(
            spark,
            f"{root}/landing",
            f"{root}/rates",
            f"{root}/rates-checkpoint",
            partial(fx.rates_historical, on_error="drop"),
            ["rate_date"],
        )
    rates_table = spark.read.schema(schemas.EXCHANGE_RATES).parquet(f"{root}/rates")
    return rates_table.drop(_LOADED)


# ---- transformations -------------------------------------------------------------------------


@query(
    "enforce_schema",
    """select cast(l_linenumber as varchar) as l_linenumber, cast(l_orderkey as double) as l_orderkey,
              cast(null as varchar) as note, cast(l_shipdate as date) as l_shipdate,
              l_extendedprice, cast(l_quantity as bigint) as l_quantity from lineitem""",
)
def enforce(spark, sf_dir):
    wanted = (
        StructType()
        .add("l_linenumber", StringType())
        .add("l_orderkey", DoubleType())
        .add("note", StringType())
        .add("l_shipdate", DateType())
        .add("l_extendedprice", DoubleType())
        .add("l_quantity", LongType())
    )
    return shape.enforce_schema(b.table(spark, sf_dir, "lineitem"), wanted)


@query(
    "json_string",
    """select c_custkey, cast(to_json(cast(c_custkey as varchar)) as varchar) as key_json,
              cast(to_json(c_name) as varchar) as name_json,
              cast(to_json(cast(c_acctbal as varchar)) as varchar) as balance_json,
              cast(to_json(case when c_acctbal > 5000 then 'True' else 'False' end) as varchar) as rich_json,
              cast(to_json({'name': c_name, 'nation': c_nationkey, 'note': null}) as varchar) as struct_json
       from customer""",
)
def to_json_string(spark, sf_dir):
    customers = b.table(spark, sf_dir, "customer").withColumns(
        {
            "rich": F.col("c_acctbal") > 5000,
            "record": F.struct(
                F.col("c_name").alias("name"),
                F.col("c_nationkey").alias("nation"),
                F.lit(None).cast("string").alias("note"),
            ),
        }
    )
    return customers.select(
        "c_custkey",
        json_string(customers, "c_custkey").alias("key_json"),
        json_string(customers, "c_name").alias("name_json"),
        json_string(customers, "c_acctbal").alias("balance_json"),
        json_string(customers, "rich").alias("rich_json"),
        json_string(customers, "record").alias("struct_json"),
    )


@query(
    "json_columns",
    """select l_orderkey, l_linenumber, '{"a":[' || l_partkey || ',' || l_suppkey || '],"b":["' || l_returnflag
              || '","' || l_linestatus || '"]}' as cell from lineitem""",
)
def frame_to_json(spark, sf_dir):
    pair = lambda a, c: F.struct(F.col(a).alias("a"), F.col(c).alias("b"))
    cell = F.array(pair("l_partkey", "l_returnflag"), pair("l_suppkey", "l_linestatus"))
    lines = b.table(spark, sf_dir, "lineitem")
    return lines.select("l_orderkey", "l_linenumber", json_columns(cell, ["a", "b"]).alias("cell"))


_CELL = f"""(select event_id, case {_K} % 5 when 0 then '' when 1 then 'n/a' when 2 then ' ' || "value" || ' '
             when 3 then '1,' || {_K} || '0%' else "value" || '%' end as cell from events)"""


@query(
    "normalize_percent",
    f"""select event_id, try_cast(replace(replace(trim(cell), ',', ''), '%', '') as double) / 100.0::double as ratio,
               case when trim(cell) = '' then ''
                    when try_cast(replace(replace(trim(cell), ',', ''), '%', '') as double) is null then cell
               end as rest from {_CELL}""",
)
def percents(spark, sf_dir):
    k, value = b.size(), F.col("value").cast("string")
    cell = (
        F.when(k % 5 == 0, "")
        .when(k % 5 == 1, "n/a")
        .when(k % 5 == 2, F.concat(F.lit(" "), value, F.lit(" ")))
        .when(k % 5 == 3, F.concat(F.lit("1,"), k.cast("string"), F.lit("0%")))
        .otherwise(F.concat(value, F.lit("%")))
    )
    cells = b.table(spark, sf_dir, "events").select("event_id", cell.alias("cell"))
    return cells.select("event_id", normalize_percent("cell").alias("ratio"), percent_text("cell").alias("rest"))


@query(
    "parse_iso_utc",
    f"""select event_id, case when {_K} % 3 = 1 then ts - interval 2 hour else ts end as ts, cast(null as timestamp) as none
        from events""",
)
def iso_times(spark, sf_dir):
    zone = F.when(b.size() % 3 == 0, "Z").when(b.size() % 3 == 1, "+02:00").otherwise("")
    text = F.concat(F.replace(F.col("ts").cast("string"), F.lit(" "), F.lit("T")), zone)
    texts = b.table(spark, sf_dir, "events").select("event_id", text.alias("text"))
    return texts.select(
        "event_id", parse_iso_utc("text").alias("ts"), parse_iso_utc(F.lit(None).cast("string")).alias("none")
    )


@query(
    "explode_keyed",
    f"""select event_id, event_type as key, "value" as "value" from events
        union all select event_id, 'k', {_K}::double from events where {_K} > 50""",
)
def keyed(spark, sf_dir):
    events = b.table(spark, sf_dir, "events")
    entry = F.create_map(F.col("event_type"), F.col("value"))
    both = F.create_map(F.col("event_type"), F.col("value"), F.lit("k"), b.size().cast("double"))
    maps = events.select("event_id", F.when(b.size() > 50, both).otherwise(entry).alias("m"))
    return shape.explode_keyed(maps, "m", "key")


@query(
    "numeric_coercion",
    f"""select event_id, case when {_K} % 4 = 0 then null else "value" end as number, {_K} as whole from events""",
)
def numbers(spark, sf_dir):
    text = F.when(b.size() % 4 == 0, F.lit("1d")).otherwise(F.col("value").cast("string"))
    events = b.table(spark, sf_dir, "events")
    return events.select(
        "event_id", text_to_double(text).alias("number"), b.size().cast("double").cast("long").alias("whole")
    )


@query(
    "default_fill",
    f"""select event_id, case when {_K} % 3 = 0 then 0 else "value" end as price,
               case when {_K} % 2 = 0 then 0 else {_K} end as size,
               case when {_K} % 2 = 1 then {_K} end as kept from events""",
)
def default_fill(spark, sf_dir):
    k = b.size()
    events = b.table(spark, sf_dir, "events").select(
        "event_id", F.when(k % 3 != 0, F.col("value")).alias("p"), F.when(k % 2 != 0, k).alias("s")
    )
    return events.select(
        "event_id",
        zero_fill("p").alias("price"),
        zero_fill("s", "long").alias("size"),
        zero_fill("s", "long", enabled=False).alias("kept"),
    )


@query(
    "nested_extraction",
    f"""select event_id, {_K} as k, cast(null as varchar) as gone from events""",
)
def nested(spark, sf_dir):
    wrapped = F.concat(F.lit('{"outer":'), F.col("props"), F.lit("}"))
    doc = F.from_json(wrapped, "outer struct<k:bigint, deep:struct<x:string>>")
    return b.table(spark, sf_dir, "events").select(
        "event_id", doc["outer"]["k"].alias("k"), doc["outer"]["deep"]["x"].alias("gone")
    )


@query("ingestion_time", "select event_id, true as recent from events")
def ingestion_time(spark, sf_dir):
    loaded = shape.with_ingestion_time(b.table(spark, sf_dir, "events").select("event_id"))
    return loaded.select(
        "event_id", (F.col(_LOADED) > F.expr("timestamp_ntz'2024-01-01 00:00:00'")).alias("recent")
    )


@query("derive_date", "select event_id, cast(ts as date) as bar_date from events")
def derive_date(spark, sf_dir):
    return b.table(spark, sf_dir, "events").select("event_id", F.to_date("ts").alias("bar_date"))


@query(
    "concat_batches",
    """select event_id, event_type, "value" from events
       union all select event_id, event_type, "value" from events where event_type = 'click'""",
)
def concat_batches(spark, sf_dir):
    events = b.table(spark, sf_dir, "events")
    parts = [events.where(F.col("event_type") == t) for t in ("view", "click", "error", "click", "purchase", "signup")]
    first, *others = [p.select("event_id", "event_type", "value") for p in parts]
    return shape.concat_batches([first, *[o.select("value", "event_type", "event_id") for o in others]])


@query(
    "batch_calendar",
    """with r as (select o_custkey, cast(min(o_orderdate) as date) as lo, cast(max(o_orderdate) as date) as hi
                  from orders group by 1),
       s as (select o_custkey, hi, lo, unnest(generate_series(lo, hi, interval 30 day)) as s from r)
       select o_custkey, cast(date_diff('day', lo, cast(s as date)) // 30 as int) as batch,
              cast(s as date) as batch_start, least(cast(s + interval 29 day as date), hi) as batch_end from s""",
)
def batch_calendar(spark, sf_dir):
    spans = b.table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.min("o_orderdate").alias("lo"), F.max("o_orderdate").alias("hi")
    )
    return calendar.batch_calendar(spans, "lo", "hi", 30, ["o_custkey"])


@query(
    "first_row",
    """select o_custkey, arg_min(o_totalprice, (o_orderdate, o_orderkey)) as o_totalprice,
              arg_min(o_orderstatus, (o_orderdate, o_orderkey)) as o_orderstatus from orders group by 1""",
)
def first_row(spark, sf_dir):
    orders = b.table(spark, sf_dir, "orders")
    return shape.first_row(orders, ["o_custkey"], "o_orderdate", ["o_totalprice", "o_orderstatus"], "o_orderkey")


@query(
    "all_to_string",
    """select cast(c_custkey as varchar) as c_custkey, c_name, cast(c_nationkey as varchar) as c_nationkey,
              cast(c_acctbal as varchar) as c_acctbal, c_mktsegment from customer""",
)
def all_to_string(spark, sf_dir):
    return shape.all_to_string(b.table(spark, sf_dir, "customer"))


@query(
    "safe_ratio",
    f"""select event_id, case when {_K} = 0 then 0 else "value" / {_K} end as ratio from events""",
)
def ratio(spark, sf_dir):
    return b.table(spark, sf_dir, "events").select("event_id", safe_ratio("value", b.size()).alias("ratio"))


@query(
    "request_params",
    """select distinct cast(ts as date) as day, 'U' || user_id as symbol,
              cast(cast(ts as date) as varchar) as "start", 2 as n_params, true as within from events""",
)
def request_params(spark, sf_dir):
    events = b.table(spark, sf_dir, "events").select(
        F.to_date("ts").alias("day"), F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("symbol")
    )
    made = requests.request_params(events, ["day"], "symbol", {"start": F.col("day"), "feed": None}, per_request=50)
    return made.select(
        "day",
        F.explode(F.split(F.col("params")["symbols"], ",")).alias("symbol"),
        F.col("params")["start"].alias("start"),
        F.size("params").alias("n_params"),
        (F.size(F.split(F.col("params")["symbols"], ",")) <= 50).alias("within"),
    )


@query(
    "stamped_key",
    """select event_id, 'a/b/' || strftime(ts, '%Y%m%dT%H%M%S') || '_e' || event_id || '.json' as key from events""",
)
def keys(spark, sf_dir):
    name = F.concat(F.lit("e"), F.col("event_id").cast("string"), F.lit(".json"))
    return b.table(spark, sf_dir, "events").select("event_id", stamped_key(name, "ts", F.lit("/a/b/")).alias("key"))


@query(
    "tag_string",
    """select doc_id, 'lang=' || lang || '&text=' || replace(url_encode(text), '%20', '+') as tags from documents""",
)
def tags(spark, sf_dir):
    pairs = F.create_map(F.lit("lang"), F.col("lang"), F.lit("text"), F.col("text"))
    return b.table(spark, sf_dir, "documents").select("doc_id", tag_string(pairs).alias("tags"))


# The queries of further modules join the same lists.
from . import intervals, kept_up  # noqa: E402, F401
