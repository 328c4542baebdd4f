import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructType, TimestampNTZType

from rateloom.operators import asof, bars, calendar, rates, shape
from rateloom.operators.snapshots import snapshot

START = datetime(2024, 1, 1)


def rows(df, *names):
    return sorted((tuple(r) for r in df.select(*names).collect()), key=repr)


# ---- shape


def test_enforce_schema(spark):
    df = spark.createDataFrame([("1", 2.5, "x")], "b string, a double, extra string")
    wanted = StructType().add("a", LongType()).add("new", StringType()).add("b", IntegerType())
    table = shape.enforce_schema(df, wanted)
    assert table.dtypes == [("a", "bigint"), ("new", "string"), ("b", "int")]
    assert rows(table, "*") == [(2, None, 1)]


def test_enforce_schema_on_bad_values(spark):
    df = spark.createDataFrame([("x",), ("2",)], "a string")
    wanted = StructType().add("a", DoubleType())
    with pytest.raises(PySparkException):
        shape.enforce_schema(df, wanted).collect()
    assert rows(shape.enforce_schema(df, wanted, "null"), "a") == [(2.0,), (None,)]
    with pytest.raises(ValueError):
        shape.enforce_schema(df, wanted, "other")


def test_enforce_schema_keeps_the_schema_of_nothing(spark):
    empty = spark.createDataFrame([], "z string")
    wanted = StructType().add("a", DoubleType())
    table = shape.enforce_schema(empty, wanted)
    assert table.count() == 0 and table.dtypes == [("a", "double")]


def test_enforce_schema_reads_instants_as_utc(other_zone):
    df = other_zone.range(1).select(F.lit("2024-01-02T03:04:05Z").cast("timestamp").alias("t"))
    table = shape.enforce_schema(df, StructType().add("t", TimestampNTZType()))
    assert table.first()[0] == datetime(2024, 1, 2, 3, 4, 5)


def test_names_are_matched_exactly(spark):
    df = spark.createDataFrame([(1, 2)], "`a.b` int, A int")
    wanted = StructType().add("a.b", LongType()).add("a", LongType())
    assert rows(shape.enforce_schema(df, wanted), "*") == [(1, None)]


def test_explode_keyed(spark):
    df = spark.createDataFrame([(1, {"a": 1.0}), (2, {}), (3, None)], "i int, m map<string,double>")
    assert rows(shape.explode_keyed(df, "m", "k"), "i", "k", "value") == [(1, "a", 1.0)]


# ---- calendar


def spans(spark, *pairs):
    return spark.createDataFrame([(i, *map(date.fromisoformat, p)) for i, p in enumerate(pairs)], "i int, a date, z date")


def test_batch_calendar(spark):
    df = spans(spark, ("2024-01-01", "2024-01-10"), ("2024-01-05", "2024-01-05"), ("2024-01-02", "2024-01-01"))
    windows = calendar.batch_calendar(df, "a", "z", 7, ["i"])
    assert rows(windows, "i", "batch", "batch_start", "batch_end") == [
        (0, 0, date(2024, 1, 1), date(2024, 1, 7)),
        (0, 1, date(2024, 1, 8), date(2024, 1, 10)),
        (1, 0, date(2024, 1, 5), date(2024, 1, 5)),
    ]
    days = calendar.day_calendar(df, "a", "z", 7, ["i"])
    assert days.where("i = 0").count() == 10 and days.where("i = 0 and batch = 1").count() == 3
    with pytest.raises(ValueError):
        calendar.batch_calendar(df, "a", "z", 0)


def test_batch_no_agrees_with_the_calendar(spark):
    df = spans(spark, ("2023-12-20", "2024-03-15"))
    days = calendar.day_calendar(df, "a", "z", 9, ["a"])
    assert days.where(F.col("batch") != calendar.batch_no("day", "a", 9)).count() == 0


# ---- bars


def trades(spark, data):
    return spark.createDataFrame(data, "symbol string, ts timestamp_ntz, price double, size bigint, id bigint")


def at(seconds, micros=0):
    return START + timedelta(seconds=seconds, microseconds=micros)


def test_ties_are_settled_by_id(spark):
    data = [("A", at(0), float(i), 1, i) for i in range(50)]
    random.Random(1).shuffle(data)
    row = bars.bars(trades(spark, data).repartition(8), "1Min", tie="id").first()
    assert (row["open"], row["close"], row["volume"], row["trade_count"]) == (0.0, 49.0, 50, 50)


def test_bars_without_volume_have_no_vwap(spark):
    row = bars.bars(trades(spark, [("A", at(0), 5.0, 0, 1)])).first()
    assert row["volume"] == 0 and row["vwap"] is None


def test_bars_do_not_depend_on_the_session_zone(other_zone):
    data = [("A", datetime(2024, 3, 10, 2, 30), 5.0, 1, 1), ("A", datetime(2024, 3, 10, 3, 10), 6.0, 1, 2)]
    row = bars.bars(trades(other_zone, data), "1Day", tie="id").first()
    assert (row["timestamp"], row["open"], row["close"]) == (datetime(2024, 3, 10), 5.0, 6.0)
    assert bars.bars(trades(other_zone, data), "4Hour").first()["timestamp"] == datetime(2024, 3, 10)


def test_unknown_timeframe(spark):
    with pytest.raises(ValueError):
        bars.bars(trades(spark, []), "2Day")


def test_one_shuffle_with_a_partial_step(spark):
    plan = bars.bars(trades(spark, [("A", at(0), 5.0, 1, 1)]), tie="id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_min_by" in plan and "SortAggregate" not in plan


def test_selection_reaches_the_scan(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    chosen = bars.select_range(events, "2024-01-05", "2024-01-12", ["view"], ts="ts", symbol_column="event_type")
    plan = chosen.select("event_id")._jdf.queryExecution().executedPlan().toString()
    assert "l(ts,2024-01-05T00:00), LessThan(ts,2024-" in plan


def test_selection_prunes_partitions(spark, folder):
    made = bars.bars(trades(spark, [("A", at(86_400 * i), 1.0, 1, i) for i in range(5)]))
    made.write.partitionBy("bar_date").parquet(folder)
    chosen = bars.select_range(spark.read.parquet(folder), "2024-01-02", "2024-01-03", ["A"], day="bar_date")
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bar_date" in plan and "EqualTo(symbol,A)" in plan
    assert chosen.count() == 2


def test_latest_bar_of_trades(spark):
    data = [("A", at(i), float(i), 1, i) for i in range(100)] + [("B", at(i), float(i), 1, i) for i in range(30)]
    data += [(None, at(0), 7.0, 1, 1)]
    got = bars.latest_bar_of_trades(trades(spark, data), "1Min", "id")
    assert rows(got, "*") == rows(bars.latest_bar(bars.bars(trades(spark, data), "1Min", "id")), "*")
    assert rows(got, "symbol", "open", "trade_count") == [("A", 60.0, 40), ("B", 0.0, 30), (None, 7.0, 1)]


def test_close_on_date(spark):
    made = bars.bars(trades(spark, [("A", at(0), 1.0, 1, 1), ("A", at(7200), 2.0, 1, 2)]), "1Hour")
    wanted = spark.createDataFrame([("A", START.date()), ("A", date(2024, 1, 2)), ("B", START.date())], "symbol string, date date")
    assert rows(bars.close_on_date(wanted, made), "symbol", "date", "close") == [
        ("A", date(2024, 1, 1), 1.0),
        ("A", date(2024, 1, 2), None),
        ("B", date(2024, 1, 1), None),
    ]


def test_snapshot_of_either_side(spark):
    t = trades(spark, [("A", at(0), 1.0, 5, 1), ("A", at(86400), 2.0, 6, 2), ("A", at(90000), 3.0, 7, 3)])
    q = spark.createDataFrame(
        [("B", at(5), 9.0, 8.0, 1)], "symbol string, ts timestamp_ntz, ask_price double, bid_price double, id bigint"
    )
    assert rows(snapshot(t, q, tie="id"), "*") == [
        ("A", 3.0, 7, at(90000), 0.0, 0.0, None, 1.0),
        ("B", 0.0, 0, None, 9.0, 8.0, at(5), 0.0),
    ]
    kept = snapshot(t, q, tie="id", zero_missing=False)
    assert rows(kept, "latest_trade_price", "prev_daily_close") == [(3.0, 1.0), (None, None)]


# ---- as-of


def brute_force(probes, quotes):
    out = []
    for pid, key, when in probes:
        known = [q for q in quotes if key is not None and when is not None and q[0] == key and q[1] is not None and q[1] <= when]
        best = max(known, key=lambda q: (q[1], q[3]), default=None)
        out.append((pid, best and best[1], best and best[2]))
    return sorted(out)


@pytest.mark.parametrize("seed,spread", [(1, 40), (2, 4_000), (3, 400_000), (4, 20_000_000)])
def test_asof_against_brute_force(spark, seed, spread):
    rnd = random.Random(seed)

    def when():
        # Many shared instants, slot edges, and long gaps.
        return at(rnd.choice([0, 30, 59, 60, 61, rnd.randrange(spread)]), rnd.choice([0, 0, 999_999, 1]))

    def key():
        # One key holds two thirds of the rows.
        return rnd.choice(["HOT", "HOT", rnd.choice(["A", "B", "C", None])])

    quotes = [(key(), when(), float(i), i) for i in range(250)]
    probes = [(i, rnd.choice([key(), "NONE"]), rnd.choice([when(), when(), when(), None])) for i in range(400)]
    q = spark.createDataFrame(quotes, "k string, ts timestamp_ntz, rate double, id bigint")
    p = spark.createDataFrame(probes, "pid int, k string, ts timestamp_ntz")
    for slot in ("1 minute", "1 second", "1 day"):
        got = asof.asof_join(p, q, ["k"], ["rate"], tie="id", slot=slot)
        assert got.columns == ["pid", "k", "ts", "rate_timestamp", "rate"]
        found = sorted(tuple(r) for r in got.select("pid", "rate_timestamp", "rate").collect())
        assert found == brute_force(probes, quotes)


def test_asof_without_a_tie_takes_the_largest_value(spark):
    q = spark.createDataFrame([("A", at(0), 1.0, 5.0), ("A", at(0), 2.0, 4.0)], "k string, ts timestamp_ntz, x double, y double")
    p = spark.createDataFrame([("A", at(0)), ("A", at(100_000))], "k string, ts timestamp_ntz")
    assert rows(asof.asof_join(p, q, ["k"], ["x", "y"]), "x", "y") == [(2.0, 4.0)] * 2
    assert rows(asof.asof_join(p, q, ["k"], ["y"]), "y") == [(5.0,)] * 2


def test_asof_keeps_a_null_rate_that_matched(spark):
    q = spark.createDataFrame([("A", at(0), 1.0), ("A", at(100_000), None)], "k string, ts timestamp_ntz, x double")
    p = spark.createDataFrame([("A", at(99_999)), ("A", at(200_000))], "k string, ts timestamp_ntz")
    got = asof.asof_join(p, q, ["k"], ["x"])
    assert rows(got, "rate_timestamp", "x") == rows(
        spark.createDataFrame([(at(0), 1.0), (at(100_000), None)], "a timestamp_ntz, x double"), "a", "x"
    )


def test_convert_amounts(spark):
    quotes = spark.createDataFrame(
        [("USD", "EUR", 0.9, at(0)), ("USD", "EUR", 0.8, at(60))],
        "base_currency string, target_currency string, rate double, rate_timestamp timestamp_ntz",
    )
    wanted = spark.createDataFrame(
        [("USD", "EUR", 10.0, at(59)), ("USD", "EUR", 10.0, at(60)), ("EUR", "USD", 10.0, at(60))],
        "from_currency string, to_currency string, amount double, ts timestamp_ntz",
    )
    got = asof.convert_amounts(wanted, quotes)
    assert rows(got, "from_currency", "rate", "converted_amount") == [("EUR", None, None), ("USD", 0.8, 8.0), ("USD", 0.9, 9.0)]


# ---- rates


@pytest.fixture
def quoted(spark):
    day = date(2024, 1, 1)
    return spark.createDataFrame(
        [("USD", t, r, day, START) for t, r in (("EUR", 0.5), ("JPY", 100.0), ("ZERO", 0.0))]
        + [("USD", "EUR", 0.6, date(2024, 1, 2), START + timedelta(days=1))],
        "base_currency string, target_currency string, rate double, rate_date date, rate_timestamp timestamp_ntz",
    )


def test_rate_lookups(spark, quoted):
    assert rates.first_rate(quoted, "USD", "EUR") == 0.6
    assert rates.first_rate(quoted, "USD", "EUR", "2024-01-01") == 0.5
    with pytest.raises(ValueError, match="USD/XXX"):
        rates.first_rate(quoted, "USD", "XXX")
    pairs = spark.createDataFrame([("USD", "EUR"), ("USD", "XXX")], "base_currency string, target_currency string")
    assert rows(rates.rate_for_pair(pairs, quoted), "target_currency", "rate") == [("EUR", 0.6), ("XXX", None)]


def test_rebase_and_cross(spark, quoted):
    got = rates.rebase(quoted, ["EUR"])
    assert rows(got.where("rate_date = '2024-01-01'"), "base_currency", "target_currency", "rate") == [
        ("EUR", "EUR", 1.0),
        ("EUR", "JPY", 200.0),
        ("EUR", "ZERO", 0.0),
    ]
    assert {r[0] for r in rates.rebase(quoted, ["ZERO"]).select("rate").collect()} == {None}
    pairs = spark.createDataFrame([("EUR", "JPY"), ("JPY", "EUR"), ("EUR", "XXX")] * 2, "from_currency string, to_currency string")
    assert rows(rates.cross_rates(quoted, pairs), "from_currency", "to_currency", "rate") == [
        ("EUR", "JPY", 200.0),
        ("JPY", "EUR", 0.005),
    ]


def test_validate_currency(spark):
    df = spark.createDataFrame([("USD",), ("usd",), ("XXX",), (None,)], "c string")
    assert rows(rates.validate_currency(df, "c"), "c") == [("USD",)]
    assert rows(rates.validate_currency(df, "c", rejects=True), "c") == [("XXX",), ("usd",), (None,)]
