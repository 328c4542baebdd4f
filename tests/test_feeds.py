import json
from datetime import date, datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from rateloom import schemas
from rateloom.operators import calendar
from rateloom.sources import audit, envelope, fx, stocks

FETCHED = datetime(2024, 3, 1, 12, 0)


def landing(spark, *bodies, params=None, status=200):
    rows = []
    for i, body in enumerate(bodies):
        text = body if isinstance(body, (str, type(None))) else json.dumps(body)
        rows.append((f"r{i}", params or {}, status, text, FETCHED))
    return spark.createDataFrame(rows, schemas.LANDING)


def rows(df, *names):
    return sorted(tuple(r) for r in df.select(*names).collect())


def names_and_types(schema):
    return [(f.name, f.dataType) for f in schema.fields]


LATEST = {"meta": {"last_updated_at": "2024-01-02T03:04:05Z"}, "response": {"base": "USD", "rates": {"EUR": 0.91, "PHP": 55.4}}}


def test_rates_latest(spark):
    table = fx.rates_latest(landing(spark, LATEST))
    assert names_and_types(table.schema) == names_and_types(schemas.EXCHANGE_RATES)
    at = datetime(2024, 1, 2, 3, 4, 5)
    assert rows(table, *table.columns[:5]) == [
        ("USD", "EUR", 0.91, date(2024, 1, 2), at),
        ("USD", "PHP", 55.4, date(2024, 1, 2), at),
    ]


@pytest.mark.parametrize("meta", [{}, {"last_updated_at": None}, {"last_updated_at": ""}])
def test_a_response_without_a_time_takes_the_fetch_time(spark, meta):
    table = fx.rates_latest(landing(spark, {**LATEST, "meta": meta}))
    assert {r[0] for r in table.select("rate_timestamp").collect()} == {FETCHED}


@pytest.mark.parametrize("body", ["{}", '{"response":{}}', '{"response":{"base":"USD","rates":{}}}', '{"response":null}'])
def test_no_rates_no_rows(spark, body):
    table = fx.rates_latest(landing(spark, body))
    assert table.count() == 0 and table.columns == schemas.EXCHANGE_RATES.names


def test_text_rates_are_read(spark):
    body = '{"response":{"base":"USD","rates":{"EUR":"0.91","JPY":1.5e2,"XAU":1}}}'
    assert rows(fx.rates_latest(landing(spark, body)), "target_currency", "rate") == [("EUR", 0.91), ("JPY", 150.0), ("XAU", 1.0)]


BAD_BODIES = [
    None,
    "",
    '{"response":{"base":"USD","rates":{"EUR":0.',
    '{"response":{"base":"USD","rates":{"EUR":0.91,"X":"n/a"}}}',
    '{"response":{"base":"USD","rates":{"EUR":null}}}',
    '{"meta":{"last_updated_at":"soon"},"response":{"base":"USD","rates":{"EUR":1}}}',
]


@pytest.mark.parametrize("body", BAD_BODIES)
def test_unusable_bodies_raise_or_are_dropped(spark, body):
    responses = landing(spark, body, LATEST)
    with pytest.raises(PySparkException, match="unusable response r0"):
        fx.rates_latest(responses).collect()
    assert fx.rates_latest(responses, on_error="drop").count() == 2


@pytest.mark.parametrize("status", [400, 401, 404, 429, 500, None])
def test_error_statuses_are_unusable(spark, status):
    responses = landing(spark, LATEST, status=status)
    with pytest.raises(PySparkException):
        fx.rates_latest(responses).collect()
    assert fx.rates_latest(responses, on_error="drop").count() == 0


def test_bodies_are_parsed_once(spark):
    responses = landing(spark, LATEST)
    bases = spark.createDataFrame([("USD",)], "base_currency string")
    days = spark.createDataFrame([("USD", date(2024, 1, 1))], "base_currency string, day date")
    for table in (
        fx.rates_latest(responses),
        fx.rates_timeseries_audit(responses, bases, "2024-01-01", "2024-01-31"),
        calendar.missing_days(days, fx.historical_results(responses), ["base_currency"]),
        stocks.bars_timeseries_audit(responses, "2024-01-01", "2024-01-31"),
        audit.unusable_responses(responses, "rates_latest"),
        audit.unusable_responses(responses, "bars_historical"),
        fx.rates_timeseries(responses, "2024-01-01", "2024-01-31"),
        fx.convert_currency(responses),
        fx.currencies(responses),
        stocks.bars_latest(responses),
        stocks.bars_historical(responses),
        stocks.bars_timeseries(responses, "2024-01-01", "2024-01-31"),
    ):
        plan = table._jdf.queryExecution().executedPlan().toString()
        assert plan.count("from_json") == 1, plan
    # One reading for either envelope; the second runs only without the first.
    plan = stocks.snapshots(responses)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 2, plan


def test_historical_stamps_midnight(spark, other_zone):
    body = {"response": {"base": "USD", "date": "2024-01-02", "rates": {"EUR": 0.91}}}
    table = fx.rates_historical(landing(spark, body))
    assert rows(table, "rate_date", "rate_timestamp") == [(date(2024, 1, 2), datetime(2024, 1, 2))]


def day(d, **rates):
    return {"response": {"base": "USD", "date": d, "rates": rates or {"EUR": 1.0}}}


def test_timeseries_and_audit(spark):
    def row(d, body, status=200):
        return (f"USD-{d}", {"base": "USD", "date": d}, status, body and json.dumps(body), FETCHED)

    responses = spark.createDataFrame(
        [
            row("2024-01-01", day("2024-01-01")),
            row("2024-01-02", None, 500),
            row("2024-01-02", day("2024-01-02", EUR=2, PHP=3)),
            row("2024-01-03", day("2024-01-03", EUR="n/a", PHP=3)),
            row("2024-01-08", day("2024-01-08")),
            row("2024-02-01", day("2024-02-01")),
        ],
        schemas.LANDING,
    )
    table = fx.rates_timeseries(responses, "2024-01-01", "2024-01-09", batch_size=7)
    assert rows(table, "rate_date", "target_currency", "rate", "batch") == [
        (date(2024, 1, 1), "EUR", 1.0, 0),
        (date(2024, 1, 2), "EUR", 2.0, 0),
        (date(2024, 1, 2), "PHP", 3.0, 0),
        (date(2024, 1, 8), "EUR", 1.0, 1),
    ]
    bases = spark.createDataFrame([("USD",), ("EUR",)], "base_currency string")
    audit = fx.rates_timeseries_audit(responses, bases, "2024-01-01", "2024-01-09", 7)
    assert rows(audit, "base_currency", "batch", "days", "failed_days", "n_rows") == [
        ("EUR", 0, 7, 7, 0),
        ("EUR", 1, 2, 2, 0),
        ("USD", 0, 7, 5, 3),
        ("USD", 1, 2, 1, 1),
    ]


def test_convert_currency(spark):
    body = {"meta": {"last_updated_at": None}, "response": {"value": 91.0}}
    half = fx.convert_currency(landing(spark, body, params={"from": "USD", "to": "EUR", "amount": "100"}))
    assert rows(half, *half.columns[:6]) == [("USD", "EUR", 100.0, 91.0, 0.91, FETCHED)]
    zero = fx.convert_currency(landing(spark, body, params={"from": "USD", "to": "EUR", "amount": "0"}))
    assert rows(zero, "rate") == [(0.0,)]
    with pytest.raises(PySparkException):
        fx.convert_currency(landing(spark, {"response": {}}, params={"amount": "1"})).collect()


def test_currencies(spark):
    body = {"response": [{"id": 840, "name": "US Dollar", "short_code": "USD", "symbol": "$"}, {"id": 978}]}
    table = fx.currencies(landing(spark, body, {"response": []}, {}))
    assert sorted(map(str, rows(table, *table.columns[:4]))) == sorted(
        map(str, [("840", "US Dollar", "USD", "$"), ("978", None, None, None)])
    )


BAR = {"t": "2024-01-02T05:00:00Z", "o": 1, "h": 2.5, "l": 0.5, "c": 2, "v": 10.0, "n": 3, "vw": 1.7}


def test_bars_latest(spark):
    table = stocks.bars_latest(landing(spark, {"bars": {"AAA": BAR}}, "{}", '{"bars":{}}', '{"bars":null}'))
    assert names_and_types(table.schema) == names_and_types(schemas.STOCK_BARS)
    assert rows(table, *table.columns[:10]) == [
        ("AAA", datetime(2024, 1, 2, 5), date(2024, 1, 2), 1.0, 2.5, 0.5, 2.0, 10, 3, 1.7)
    ]


@pytest.mark.parametrize("bar", [None, {**BAR, "o": None}, {k: v for k, v in BAR.items() if k != "vw"}, {**BAR, "t": "?"}])
def test_incomplete_bars_make_the_body_unusable(spark, bar):
    latest = landing(spark, {"bars": {"AAA": BAR, "BBB": bar}})
    with pytest.raises(PySparkException):
        stocks.bars_latest(latest).collect()
    assert stocks.bars_latest(latest, on_error="drop").count() == 0
    pages = landing(spark, {"bars": {"AAA": [BAR, bar]}}, {"bars": {"AAA": [BAR]}})
    assert stocks.bars_historical(pages, on_error="drop").count() == 1


def test_bars_historical_pages_and_limit(spark):
    def bar(hour):
        return {**BAR, "t": f"2024-01-02T{hour:02d}:00:00Z"}

    pages = landing(
        spark,
        {"bars": {"BBB": [bar(1)], "AAA": [bar(2), bar(3)]}, "next_page_token": "x"},
        {"bars": {"AAA": [bar(1)], "CCC": []}, "next_page_token": None},
    )
    assert stocks.bars_historical(pages).count() == 4
    capped = stocks.bars_historical(pages, limit=3)
    assert rows(capped, "symbol", F.hour("timestamp")) == [("AAA", 1), ("AAA", 2), ("AAA", 3)]
    assert stocks.bars_historical(pages, limit=9).count() == 4


def test_bars_timeseries(spark):
    def page(d):
        return {"bars": {"AAA": [{**BAR, "t": f"{d}T00:00:00Z"}]}}

    pages = landing(spark, page("2024-01-01"), page("2024-01-31"), page("2024-02-01"), page("2024-03-01"), "{")
    table = stocks.bars_timeseries(pages, "2024-01-02", "2024-02-15", 30)
    assert rows(table, "bar_date", "batch") == [(date(2024, 1, 31), 0), (date(2024, 2, 1), 1)]


SNAP = {
    "latestTrade": {"p": 2.0, "s": 5, "t": "2024-01-02T05:00:00.123456789Z"},
    "latestQuote": {},
    "prevDailyBar": {"c": 1.9},
}


def test_snapshots(spark):
    table = stocks.snapshots(landing(spark, {"snapshots": {"AAA": SNAP}}, {"BBB": {"latestTrade": {"p": 3}}}))
    assert names_and_types(table.schema) == names_and_types(schemas.STOCK_SNAPSHOT)
    at = datetime(2024, 1, 2, 5, 0, 0, 123456)
    assert rows(table, *table.columns[:8]) == [
        ("AAA", 2.0, 5, at, 0.0, 0.0, None, 1.9),
        ("BBB", 3.0, 0, None, 0.0, 0.0, None, 0.0),
    ]
    kept = stocks.snapshots(landing(spark, {"snapshots": {"AAA": SNAP}}), zero_missing=False)
    assert rows(kept, *kept.columns[:8]) == [("AAA", 2.0, 5, at, None, None, None, 1.9)]


@pytest.mark.parametrize("body", ['{"snapshots":{}}', '{"snapshots":null}', "{}"])
def test_no_snapshots_no_rows(spark, body):
    assert stocks.snapshots(landing(spark, body)).count() == 0


def test_latest_responses_keeps_the_last_copy(spark):
    copies = spark.createDataFrame(
        [
            ("a", {"n": "1"}, 500, None, datetime(2024, 1, 1)),
            ("a", {"n": "1"}, 200, "x", datetime(2024, 1, 2)),
            ("b", {"n": "2"}, 200, "y", datetime(2024, 1, 1)),
            ("b", {"n": "2"}, 503, None, datetime(2024, 1, 2)),
            ("c", {}, None, None, datetime(2024, 1, 1)),
            ("c", {}, 500, "z", datetime(2024, 1, 2)),
        ],
        schemas.LANDING,
    )
    kept = envelope.latest_responses(copies)
    assert kept.columns == copies.columns
    assert rows(kept, "request_key", "status", "body") == [("a", 200, "x"), ("b", 200, "y"), ("c", 500, "z")]


@pytest.mark.parametrize("feed", sorted(audit.READERS))
def test_unusable_responses(spark, feed):
    bad = {
        "rates_latest": BAD_BODIES[3],
        "rates_historical": '{"response":{"date":"soon","rates":{}}}',
        "convert_currency": '{"response":{"value":null}}',
        "bars_latest": '{"bars":{"AAA":{}}}',
        "bars_historical": '{"bars":{"AAA":[{}]}}',
        "snapshots": '{"snapshots":{"AAA":{"latestTrade":{"t":"soon"}}}}',
    }
    good = {"rates_historical": day("2024-01-01"), "convert_currency": {"response": {"value": 1}}}
    responses = landing(spark, good.get(feed, "{}"), "{", None, bad.get(feed, "["))
    failed = landing(spark, "{}", status=503).withColumn("request_key", F.lit("r9"))
    got = rows(audit.unusable_responses(responses.unionByName(failed), feed), "request_key", "status", "reason")
    last = "content" if feed in bad else "json"
    assert got == [("r1", 200, "json"), ("r2", 200, "json"), ("r3", 200, last), ("r9", 503, "status")]


def test_unreadable_snapshot_times_are_dropped(spark):
    responses = landing(spark, {"snapshots": {"AAA": {"latestTrade": {"t": "soon"}}}}, {"BBB": {}})
    with pytest.raises(PySparkException, match="r0"):
        stocks.snapshots(responses).collect()
    assert rows(stocks.snapshots(responses, on_error="drop"), "symbol") == [("BBB",)]
