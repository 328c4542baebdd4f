"""Request planning and whole jobs, with replies from a small in-process provider."""

import json
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from rateloom import schemas
from rateloom.operators.shape import first_row
from rateloom.plans.backfill import backfill_bars, backfill_rates, landed_of, outstanding
from rateloom.plans.latest_rates import fetch_latest_rates
from rateloom.sources import fx, planning, requests, stocks
from rateloom.sources.envelope import latest_responses
from rateloom.sources.rates_api import register_rates


def rows(df, *names):
    return sorted((tuple(r) for r in df.select(*names).collect()), key=repr)


def symbols(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "symbol string")


def test_every_planner_gives_request_rows(spark):
    one = spark.createDataFrame([("USD", "EUR", 2.5, "2024-01-01", "2024-01-02")], "base_currency string, b string, amount double, start string, end string")
    pair = one.select(F.lit(7).alias("id"), F.col("base_currency").alias("from_currency"), F.col("b").alias("to_currency"), "amount")
    kinds = spark.createDataFrame([("fiat",), ("crypto",)], "type string")
    plans = {
        "latest": planning.latest_rate_requests(one, ["EUR", "PHP"]),
        "historical": planning.historical_rate_requests(one),
        "convert": planning.conversion_requests(pair),
        "currencies": planning.currency_requests(kinds),
        "stocks/bars/latest": planning.latest_bar_requests(symbols(spark, "B", "A", "A")),
        "stocks/snapshots": planning.snapshot_requests(symbols(spark, "B", "A"), feed="sip"),
        "stocks/bars": planning.bar_requests(symbols(spark, "A"), "2024-01-01", "2024-01-31", limit=5),
    }
    expected = {
        "latest": [{"base": "USD", "symbols": "EUR,PHP"}],
        "historical": [{"base": "USD", "date": d} for d in ("2024-01-01", "2024-01-02")],
        "convert": [{"from": "USD", "to": "EUR", "amount": "2.5"}],
        "currencies": [{"type": "crypto"}, {"type": "fiat"}],
        "stocks/bars/latest": [{"symbols": "A,B", "feed": "iex"}],
        "stocks/snapshots": [{"symbols": "A,B", "feed": "sip"}],
        "stocks/bars": [
            {"symbols": "A", "start": s, "end": e, "timeframe": "1Day", "feed": "iex", "limit": "5"}
            for s, e in (("2024-01-01", "2024-01-30"), ("2024-01-31", "2024-01-31"))
        ],
    }
    for endpoint, plan in plans.items():
        assert plan.schema.simpleString() == schemas.REQUESTS.simpleString(), endpoint
        got = plan.collect()
        assert {r["endpoint"] for r in got} == {endpoint}
        assert sorted(map(str, (r["params"] for r in got))) == sorted(map(str, expected[endpoint])) or sorted(
            sorted(r["params"].items()) for r in got
        ) == sorted(sorted(e.items()) for e in expected[endpoint])
        assert len({r["request_key"] for r in got}) == len(got)


def test_bar_requests_up_to_today(spark):
    today = spark.range(1).select(F.to_date(F.current_timestamp())).first()[0]
    plan = planning.bar_requests(symbols(spark, "A"), str(today - timedelta(days=2)))
    assert rows(plan, F.col("params")["end"]) == [(str(today),)]
    with pytest.raises(ValueError):
        planning.bar_requests(symbols(spark, "A"), "2024-01-01", timeframe="2Day")


def test_many_symbols_are_spread(spark):
    many = spark.range(1000).select(F.col("id").cast("string").alias("symbol"))
    plan = planning.latest_bar_requests(many, per_request=100)
    lists = [r[0].split(",") for r in plan.select(F.col("params")["symbols"]).collect()]
    assert max(map(len, lists)) == 100 and len(lists) <= 11 and len({x for part in lists for x in part}) == 1000
    keys = plan.select("request_key").distinct().count()
    assert keys == len(lists)
    few = planning.latest_bar_requests(many.limit(40), per_request=7)
    assert max(len(r[0].split(",")) for r in few.select(F.col("params")["symbols"]).collect()) == 7


def rate_provider(request, attempt):
    params = dict(request["params"])
    if params["date"] == "2024-01-03":
        return requests.Reply(500)
    rates = {"EUR": 0.9, "PHP": 55}
    return requests.Reply(200, json.dumps({"response": {"base": params["base"], "date": params["date"], "rates": rates}}))


def test_backfill_rates(spark, folder):
    bases = spark.createDataFrame([("USD",), ("JPY",)], "base_currency string")

    def run(name):
        return backfill_rates(
            bases, "2024-01-01", "2024-01-09", rate_provider, f"{folder}/landing", folder, "fx",
            filename=name, max_concurrency=2, sleep=lambda s: None,
        )

    uri, audit = run("one.parquet")
    table = spark.read.parquet(uri)
    assert table.count() == 2 * 8 * 2
    assert rows(audit, "base_currency", "batch", "days", "failed_days", "n_rows") == [
        (b, i, days, failed, n) for b in ("JPY", "USD") for i, days, failed, n in ((0, 7, 1, 12), (1, 2, 0, 4))
    ]
    # What landed for other requests is not this run's.
    feed, day = "historical", date(2024, 1, 1)
    other = spark.createDataFrame([("X-1", {"base": "X", "date": "2024-01-01"}, 200, "{", None, "r", 0, feed, day, None)], schemas.LANDED)
    other.write.mode("append").partitionBy("feed", "request_date").parquet(f"{folder}/landing")
    # A second run calls only for what failed; the table is the same.
    before = spark.read.parquet(f"{folder}/landing").count()
    again, _ = run("two.parquet")
    assert spark.read.parquet(f"{folder}/landing").count() == before + 2
    names = ["base_currency", "target_currency", "rate", "rate_date"]
    assert rows(spark.read.parquet(again), *names) == rows(table, *names)


class Noted:
    """A provider that notes every call in a file."""

    def __init__(self, path):
        self.path = path

    def __call__(self, request, attempt):
        with open(self.path, "a") as out:
            out.write(request["request_key"] + "\n")
        return rate_provider(request, attempt)


FILTERS = {
    "base_currency = 'USD' and day between '2024-01-05' and '2024-01-06'": {"USD-2024-01-05", "USD-2024-01-06"},
    "base_currency in ('USD', 'XXX') and day = date '2024-01-07'": {"USD-2024-01-07"},
    "day > '2024-01-07' and day < '2024-01-09'": {"USD-2024-01-08", "JPY-2024-01-08"},
    "day = date '2025-01-01'": set(),
    "base_currency != 'USD' and day = '2024-01-05'": {"JPY-2024-01-05"},
    "base_currency not in ('USD', 'EUR') and day = '2024-01-05'": {"JPY-2024-01-05"},
    "(base_currency = 'JPY' or base_currency is null) and day = '2024-01-05'": {"JPY-2024-01-05"},
    "not (base_currency = 'USD' or base_currency <=> null) and day = '2024-01-05'": {"JPY-2024-01-05"},
    "base_currency = 'USD' and day >= '2024-01-08' and status = 200 and request_key like '%9'": {"USD-2024-01-08", "USD-2024-01-09"},
}


@pytest.mark.parametrize("condition", FILTERS)
def test_rates_as_a_table(spark, tmp_path, condition):
    calls = tmp_path / "calls"
    calls.touch()
    name = register_rates(spark, Noted(str(calls)), sleep=lambda s: None)
    table = spark.read.format(name).options(bases="USD, JPY", start="2024-01-01", end="2024-01-09", tasks=3).load()
    got = table.where(condition)
    kept = {k for k in FILTERS[condition] if "like" not in condition or k.endswith("9")}
    assert {r["request_key"] for r in got.collect()} == kept
    called = set(calls.read_text().split())
    # Filters that the calls can't express are left to Spark.
    assert called == FILTERS[condition] or "JPY-2024-01-05" in FILTERS[condition] and called >= FILTERS[condition]
    assert fx.rates_historical(got).count() == 2 * len(kept)


def bar_provider(request, attempt):
    """Two pages per request: the first and the last day asked for."""
    params = dict(request["params"])
    second = params.get("page_token") == "2"
    day = params["end"] if second else params["start"]
    bar = {"t": f"{day}T00:00:00Z", "o": 1, "h": 2, "l": 1, "c": 2, "v": 3, "n": 1, "vw": 1.5}
    if params["start"] == "2024-01-11":
        return requests.Reply(404)
    found = {s: [bar] for s in params["symbols"].split(",")}
    return requests.Reply(200, json.dumps({"bars": found, "next_page_token": None if second else "2"}))


def test_backfill_bars(spark, folder):
    uri, audit = backfill_bars(
        symbols(spark, "A", "B"), "2024-01-01", "2024-01-25", bar_provider, f"{folder}/landing", folder, "bars",
        batch_days=10, filename="b.parquet", sleep=lambda s: None,
    )
    days = (date(2024, 1, 1), date(2024, 1, 10), date(2024, 1, 21), date(2024, 1, 25))
    assert rows(spark.read.parquet(uri), "bar_date", "symbol") == sorted(((d, s) for d in days for s in "AB"), key=repr)
    assert rows(audit, "batch", "batch_start", "batch_end", "pages", "failed_pages", "n_rows") == [
        (0, date(2024, 1, 1), date(2024, 1, 10), 2, 0, 4),
        (1, date(2024, 1, 11), date(2024, 1, 20), 1, 1, 0),
        (2, date(2024, 1, 21), date(2024, 1, 25), 2, 0, 4),
    ]


def pages_of(n):
    """A provider with ``n`` pages per request, one bar each."""

    def provider(request, attempt):
        params = dict(request["params"])
        page = int(params.get("page_token", 0))
        bar = {"t": f"2024-01-01T{page:02d}:00:00Z", "o": 1, "h": 2, "l": 1, "c": 2, "v": 3, "n": 1, "vw": 1.5}
        found = {s: [bar] for s in params["symbols"].split(",")}
        return requests.Reply(200, json.dumps({"bars": found, "next_page_token": str(page + 1) if page + 1 < n else None}))

    return provider


def test_second_backfill_into_one_folder(spark, folder):
    """Other symbols, another feed, a larger page: never rows of an earlier backfill."""

    def run(names, provider, **options):
        uri, audit = backfill_bars(
            symbols(spark, *names), "2024-01-01", "2024-01-05", provider, f"{folder}/landing", folder, "bars",
            filename=f"{'-'.join(names)}-{options.get('feed')}-{options.get('limit')}.parquet", sleep=lambda s: None, **options,
        )
        return sorted((r.symbol, r.timestamp.hour) for r in spark.read.parquet(uri).collect()), audit.collect()

    assert run(["AAA"], pages_of(5))[0] == [("AAA", h) for h in range(5)]
    table, audit = run(["BBB"], pages_of(2))
    assert table == [("BBB", 0), ("BBB", 1)]
    assert [(r.pages, r.failed_pages, r.missing) for r in audit] == [(2, 0, 0)]
    assert run(["AAA"], pages_of(1), feed="sip")[0] == [("AAA", 0)]
    assert run(["AAA"], pages_of(3), limit=7)[0] == [("AAA", h) for h in range(3)]
    # A later run of the same request with fewer pages replaces all pages of the earlier one.
    one = planning.bar_requests(symbols(spark, "CCC"), "2024-01-01", "2024-01-05")
    for n in (4, 2):
        fetched = requests.fetch_responses(one, pages_of(n), sleep=lambda s: None)
        fetched.write.mode("append").partitionBy("feed", "request_date").parquet(f"{folder}/landing")
    assert rows(landed_of(one, f"{folder}/landing"), "page") == [(0,), (1,)]


def test_windows_nobody_answered_are_missing(spark):
    one = planning.bar_requests(symbols(spark, "A"), "2024-01-01", "2024-01-25", batch_days=10)
    none = spark.createDataFrame([], schemas.LANDED)
    audit = stocks.bars_timeseries_audit(none, "2024-01-01", "2024-01-25", 10, one)
    assert rows(audit, "batch", "pages", "failed_pages", "missing") == [(i, 0, 1, 1) for i in range(3)]


def test_latest_rates_polls(spark, folder):
    """Two polls of two bases; one base fails at the second."""

    def provider(rate, down=()):
        def answer(request, attempt):
            base = dict(request["params"])["base"]
            if base in down:
                return requests.Reply(500)
            body = {"meta": {"last_updated_at": "2024-01-01T00:00:00Z"}, "response": {"base": base, "rates": {"EUR": rate}}}
            return requests.Reply(200, json.dumps(body))

        return answer

    def poll(name, *args):
        uri, bad = fetch_latest_rates(
            spark, ["USD", "JPY"], provider(*args), f"{folder}/landing", folder, "fx", filename=name, sleep=lambda s: None
        )
        return rows(spark.read.parquet(uri), "base_currency", "rate"), rows(bad, "status", "reason")

    assert poll("a.parquet", 0.9) == ([("JPY", 0.9), ("USD", 0.9)], [])
    assert poll("b.parquet", 0.8, ("JPY",)) == ([("JPY", 0.9), ("USD", 0.8)], [(500, "status")])


def test_copies_are_found_without_sorting(spark):
    landed = spark.createDataFrame([("a", {}, 200, "x", None)] * 3 + [("b", {}, 200, "y", None)], schemas.LANDING)
    chosen = latest_responses(landed)
    assert rows(chosen, "request_key", "body") == [("a", "x"), ("b", "y")]
    assert "SortAggregate" not in chosen._jdf.queryExecution().executedPlan().toString()
    first = first_row(landed, ["request_key"], "fetched_at", ["body"])
    assert "SortAggregate" not in first._jdf.queryExecution().executedPlan().toString()


def test_cut_off_pages_are_called_again(spark, folder):
    """Status 200 and half a body is no answer: the next backfill calls for all pages again."""

    def broken(request, attempt):
        reply = pages_of(3)(request, attempt)
        second = dict(request["params"]).get("page_token") == "1"
        return requests.Reply(200, reply.body[: len(reply.body) // 2]) if second else reply

    def run(provider, name):
        uri, audit = backfill_bars(
            symbols(spark, "AAA"), "2024-01-01", "2024-01-05", provider, f"{folder}/landing", folder, "bars",
            filename=name, sleep=lambda s: None,
        )
        return sorted(r.timestamp.hour for r in spark.read.parquet(uri).collect()), [r.failed_pages for r in audit.collect()]

    one = planning.bar_requests(symbols(spark, "AAA"), "2024-01-01", "2024-01-05")
    assert run(broken, "a.parquet") == ([0], [1])
    assert outstanding(one, f"{folder}/landing").count() == 1
    assert run(pages_of(3), "b.parquet") == ([0, 1, 2], [0])
    assert outstanding(one, f"{folder}/landing").count() == 0


def test_broken_poll_leaves_the_last_good_one(spark, folder):
    def provider(rate, cut=None):
        body = json.dumps({"response": {"base": "USD", "rates": {"EUR": rate}}})
        return lambda request, attempt: requests.Reply(200, body[:cut])

    for rate, cut in ((0.9, None), (0.8, 20)):
        uri, bad = fetch_latest_rates(
            spark, ["USD"], provider(rate, cut), f"{folder}/landing", folder, "fx", filename=f"{rate}.parquet", sleep=lambda s: None
        )
    assert rows(spark.read.parquet(uri), "base_currency", "rate") == [("USD", 0.9)]
    assert rows(bad, "status", "reason") == [(200, "json")]
