"""Queries over paths of rates, missing days, validity intervals and windows of any length."""

from __future__ import annotations

from pyspark.sql import functions as F

from rateloom.operators import asof, calendar, intervals
from rateloom.operators import bars as bar_ops
from rateloom.operators.paths import path_rates
from rateloom.sources import fx, planning

from . import bindings as b
from .catalog import _AMOUNTS, _CALENDAR, _DAILY, _FAILED_DAY, _USER, _bars_sql, query

# Every base quotes only some targets, so that most pairs are connected through several others; the bases by number.

_TYPE_NO = "case {} when 'click' then 0 when 'error' then 1 when 'purchase' then 2 when 'signup' then 3 else 4 end"
_HOPS = 6


def _hop(n: int) -> str:
    """One round of the search, as CTEs: of all new codes the path with the latest oldest quote."""
    return f"""
        steps{n} as (
            select f, g.t as c, l.rate * g.rate as rate, {n} as hops, least(coalesce(l.since, g.since), g.since) as since, l.path || '>' || g.t as path
            from hop{n - 1} l join graph g on l.c = g.f0
            where (l.f, g.t) not in (select (f, c) from reached{n - 1})),
        hop{n} as (select * from steps{n} qualify row_number() over (partition by f, c order by since desc, path) = 1),
        reached{n} as (select * from reached{n - 1} union all select * from hop{n})"""


@query(
    "path_rates",
    f"""with {_DAILY},
        quotes as (
            select base_currency as base, target_currency as target, rate, rate_date as since from daily
            where (cast(substr(target_currency, 2) as int) % 5 - {_TYPE_NO.format("base_currency")} + 5) % 5 in (0, 1)
              and rate > 0),
        last as (select base, target, arg_max(rate, since) as rate, cast(max(since) as timestamp) as since from quotes group by all),
        ways as (select base as f0, target as t, rate, since, 1 as own from last
                 union all select target, base, 1 / rate, since, 0 from last),
        graph as (select f0, t, arg_max(rate, (since, own)) as rate, max(since) as since from ways group by all),
        asked as (select distinct 'U' || (c_custkey % 20) as f, 'U' || (c_nationkey % 22) as c from customer),
        hop0 as (select distinct f, f as c, 1::double as rate, 0 as hops, null::timestamp as since, f as path
                 from asked where f in (select f0 from graph)),
        reached0 as (select * from hop0),
        {", ".join(_hop(n) for n in range(1, _HOPS + 1))}
        select a.f as from_currency, a.c as to_currency, rate, hops, since as rate_timestamp, path
        from asked a left join reached{_HOPS} r on a.f = r.f and a.c = r.c""",
)
def rates_along_paths(spark, sf_dir):
    rates = b.daily_rates(spark, sf_dir)
    number = F.expr(_TYPE_NO.format("base_currency"))
    near = F.pmod(F.substring("target_currency", 2, 9).cast("int") % 5 - number, F.lit(5)).isin(0, 1)
    pairs = b.table(spark, sf_dir, "customer").select(
        b.user_symbol("c_custkey").alias("from_currency"), b.user_symbol("c_nationkey", 22).alias("to_currency")
    )
    return path_rates(pairs, rates.where(near), _HOPS, b.folder(spark, "paths"))


def _missing(spark, sf_dir):
    landed = b.landed_historical(spark, sf_dir, failures=True)
    bases = b.table(spark, sf_dir, "events").select(
        F.col("event_type").alias("base_currency"), F.lit("2024-01-04").alias("a"), F.lit("2024-02-10").alias("z")
    )
    days = calendar.day_calendar(bases.distinct(), "a", "z", 7, ["base_currency"])
    return calendar.missing_days(days, fx.historical_results(landed), ["base_currency"])


_MISSING = f"""missing as (
            select base_currency, rate_date as day from calendar
            anti join (select * from daily where not {_FAILED_DAY}) using (base_currency, rate_date)),
        runs as (select *, day - cast(row_number() over (partition by base_currency order by day) as int) as run from missing),
        cut as (select *, date_diff('day', min(day) over (partition by base_currency, run), day) // 5 as part from runs)"""


@query(
    "repair_windows",
    f"""with {_DAILY}, {_CALENDAR}, {_MISSING}
        select base_currency, min(day) as start, max(day) as "end", count(*) as days
        from cut group by base_currency, run, part""",
)
def repair_windows(spark, sf_dir):
    return calendar.repair_windows(_missing(spark, sf_dir), ["base_currency"], 5)


@query(
    "repair_requests",
    f"""with {_DAILY}, {_CALENDAR}, {_MISSING},
        windows as (select base_currency, min(day) as a, max(day) as z from cut group by base_currency, run, part),
        named as (select a, z, string_agg(base_currency, ',' order by base_currency) as symbols from windows group by a, z)
        select symbols, cast(a as varchar) as start, cast(z as varchar) as "end" from named""",
)
def repair_requests(spark, sf_dir):
    """The same gaps as requests for bars, symbols with the same window together."""
    missing = _missing(spark, sf_dir).withColumnRenamed("base_currency", "symbol")
    asked = planning.repair_bar_requests(missing, "1Day", batch_days=5)
    return asked.select(*[F.col("params")[p].alias(p) for p in ("symbols", "start", "end")])


_POLLS = f"""polls as (
            select event_type as base_currency, {_USER} as target_currency, ts, floor("value" / 20) as rate from events
            qualify row_number() over (partition by event_type, {_USER}, ts order by floor("value" / 20) desc) = 1)"""
_RUNS = """marked as (
            select *, rate is distinct from lag(rate) over w or lag(ts) over w is null as new from polls
            window w as (partition by base_currency, target_currency order by ts)),
        numbered as (select *, sum(cast(new as int)) over (partition by base_currency, target_currency order by ts) as run from marked),
        runs as (select base_currency, target_currency, run, min(rate) as rate, min(ts) as valid_from, max(ts) as last from numbered group by all)"""


def _polls(spark, sf_dir):
    rough = F.floor(F.col("rate") / 20).cast("double")
    return b.rate_quotes(spark, sf_dir).withColumn("rate", rough)


@query(
    "rate_intervals",
    f"""with {_POLLS}, {_RUNS}
        select base_currency, target_currency, rate, valid_from,
               lead(valid_from) over (partition by base_currency, target_currency order by valid_from) as valid_to
        from runs""",
)
def rate_intervals(spark, sf_dir):
    held = intervals.validity_intervals(_polls(spark, sf_dir), ["base_currency", "target_currency"], "rate")
    return held.drop("n_polls")


@query(
    "asof_on_intervals",
    f"""with {_AMOUNTS}, {_POLLS}
        select a.*, q.rate, a.amount * q.rate as converted_amount
        from amounts a asof left join polls q
          on a.from_currency = q.base_currency and a.to_currency = q.target_currency and a.ts >= q.ts""",
)
def asof_on_intervals(spark, sf_dir):
    """Amounts converted at the intervals of the rates give what the polls themselves give."""
    held = intervals.validity_intervals(_polls(spark, sf_dir), ["base_currency", "target_currency"], "rate")
    rates = held.withColumnRenamed("valid_from", "rate_timestamp")
    return asof.convert_amounts(b.amounts(spark, sf_dir), rates).drop("rate_timestamp")


# From some minutes to weeks, at any time of the month: nested, overlapping, and some empty ones.
_MINUTES = "(c_custkey * 37) % 40000"
_LENGTH = "cast(pow(3, c_custkey % 10) as bigint) - 1"


@query(
    "bars_in_windows",
    f"""with w as (
            select c_custkey, ['click', 'error', 'purchase', 'signup', 'view'][1 + c_custkey % 5] as symbol,
                   timestamp '2024-01-01' + to_minutes(cast({_MINUTES} as bigint)) as start,
                   timestamp '2024-01-01' + to_minutes(cast({_MINUTES} + {_LENGTH} as bigint)) as "end" from customer),
        bars as ({_bars_sql("1Hour")})
        select c_custkey, symbol, count(*) as n_bars, min("timestamp") as first_bar, max("timestamp") as last_bar,
               cast(sum(volume) as bigint) as volume, max(high) as high
        from w join bars using (symbol) where "timestamp" >= start and "timestamp" < "end" group by all""",
)
def bars_in_windows(spark, sf_dir):
    types = F.array(*[F.lit(t) for t in ("click", "error", "purchase", "signup", "view")])
    origin, minute = F.expr("timestamp_ntz'2024-01-01 00:00:00'"), F.expr("interval '1' minute")
    begins, length = F.expr(_MINUTES), F.expr(_LENGTH)
    windows = b.table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.get(types, (F.col("c_custkey") % 5).cast("int")).alias("symbol"),
        (origin + begins * minute).alias("start"),
        (origin + (begins + length) * minute).alias("end"),
    )
    hourly = bar_ops.bars(b.trades(spark, sf_dir), "1Hour", tie="event_id")
    found = intervals.in_windows(windows, hourly, ["symbol"], ts="timestamp")
    return found.groupBy("c_custkey", "symbol").agg(
        F.count(F.lit(1)).alias("n_bars"),
        F.min("timestamp").alias("first_bar"),
        F.max("timestamp").alias("last_bar"),
        F.sum("volume").alias("volume"),
        F.max("high").alias("high"),
    )
