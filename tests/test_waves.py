"""Calls at a pace, in waves that land; amounts that wait for their rates."""

import json
import os
import random
import time
from datetime import datetime, timedelta

import pytest

from rateloom.operators.asof import convert_amounts
from rateloom.plans.backfill import outstanding
from rateloom.plans.latest_rates import recent_polls
from rateloom.plans.waves import Paced, land_in_waves
from rateloom.sinks.folders import children
from rateloom.sources import planning, requests
from rateloom.streaming import arriving


class Provider:
    """Answers rate requests; notes every call with its time, and may fail by count."""

    def __init__(self, path, fail=None):
        self.path, self.fail = path, fail

    def __call__(self, request, attempt):
        params = dict(request["params"])
        name = f"{params['base']}-{params['date']}"
        with open(self.path, "a") as out:
            out.write(f"{time.time()} {name}\n")
        if self.fail:
            with open(self.path) as lines:
                before = sum(line.split()[1] == name for line in lines) - 1
            status = self.fail(name, before)
            if status is not None:
                return requests.Reply(status)
        body = {"response": {"base": params["base"], "date": params["date"], "rates": {"EUR": 0.9}}}
        return requests.Reply(200, json.dumps(body))


def calls(path):
    if not os.path.exists(path):
        return []
    with open(path) as lines:
        return [(float(at), name) for at, name in map(str.split, lines)]


def asked(spark, bases, days):
    ranges = spark.createDataFrame([(b, "2024-01-01", f"2024-01-{days:02d}") for b in bases], "base_currency string, start string, end string")
    return planning.historical_rate_requests(ranges)


def test_pace(spark, folder, tmp_path):
    """At most ten calls in a second, over callers and waves; every request is called once."""
    log = str(tmp_path / "calls")
    todo = asked(spark, ["USD", "JPY"], 15)
    landed = land_in_waves(todo, Provider(log), f"{folder}/landing", 10, wave_seconds=1.5, root=folder)
    made = calls(log)
    assert len(made) == len({n for _, n in made}) == 30 and landed.count() == 30
    times = sorted(t for t, _ in made)
    # A call may start a little after its point of the grid.
    assert all(sum(t <= u < t + 0.9 for u in times) <= 10 for t in times)
    assert land_in_waves(todo, Provider(log), f"{folder}/landing", 10, root=folder).count() == 30 and len(calls(log)) == 30


def test_keys_have_a_pace_of_their_own(spark, folder, tmp_path):
    from pyspark.sql import functions as F

    log = str(tmp_path / "calls")
    todo = asked(spark, ["USD", "JPY", "EUR", "GBP"], 5)
    land_in_waves(todo, Provider(log), f"{folder}/landing", 8, F.col("params")["base"], wave_seconds=5, shares=2, root=folder)
    for base in ("USD", "JPY", "EUR", "GBP"):
        times = sorted(t for t, n in calls(log) if n.startswith(base))
        assert len(times) == 5 and all(sum(t <= u < t + 0.9 for u in times) <= 8 for t in times)


def test_failed_calls_join_the_next_wave(spark, folder, tmp_path):
    """429 and 503 are tried again, five times in all; what is called wrong is not, nor asked for again."""
    log = str(tmp_path / "calls")

    def fail(name, before):
        day = int(name[-2:])
        if day == 2 and before < 2:
            return 429
        return {3: 400, 4: 503}.get(day)

    todo = asked(spark, ["USD"], 6)
    land_in_waves(todo, Provider(log, fail), f"{folder}/landing", 50, wave_seconds=1, root=folder, pause=lambda s: None)
    n = {name: sum(x == name for _, x in calls(log)) for _, name in calls(log)}
    assert n == {"USD-2024-01-01": 1, "USD-2024-01-02": 3, "USD-2024-01-03": 1, "USD-2024-01-04": 5, "USD-2024-01-05": 1, "USD-2024-01-06": 1}
    left = outstanding(todo, f"{folder}/landing").collect()
    assert [r.params["date"] for r in left] == ["2024-01-04"]


def test_a_broken_wave_repeats_only_itself(spark, folder, tmp_path):
    log, stop = str(tmp_path / "calls"), str(tmp_path / "stop")

    class Breaks(Provider):
        def __call__(self, request, attempt):
            if len(calls(self.path)) >= 25 and os.path.exists(stop):
                raise RuntimeError("the job is lost")
            return super().__call__(request, attempt)

    open(stop, "w").close()
    todo = asked(spark, ["USD", "JPY"], 20)
    run = lambda: land_in_waves(todo, Breaks(log), f"{folder}/landing", 100, wave_seconds=0.1, shares=2, root=folder)
    with pytest.raises(Exception, match="the job is lost"):
        run()
    landed = 40 - outstanding(todo, f"{folder}/landing").count()
    assert landed > 0
    os.remove(stop)
    before = {n for _, n in calls(log)}
    assert run().count() == 40
    again = [n for n in before if sum(x == n for _, x in calls(log)) > 1]
    assert len(again) <= 25 - landed


def test_grid():
    now, slept, made = [100.0], [], []
    paced = Paced(lambda r, a: made.append(now[0]), 100.2, 0.5, lambda: now[0], lambda s: (slept.append(s), now.__setitem__(0, now[0] + s)))
    for pause in (0, 0, 0, 2.0, 0):
        now[0] += pause
        paced({}, 1)
    assert [round(x, 6) for x in made] == [100.2, 100.7, 101.2, 103.2, 103.7]


def test_polls_are_walked_back(spark, folder):
    """Only the days back to the last usable poll of every base are read."""
    rows = []
    todo = planning.latest_rate_requests(spark.createDataFrame([("USD",), ("JPY",)], "base_currency string"))
    keys = {r.params["base"]: r.request_key for r in todo.collect()}
    from rateloom.schemas import LANDED

    for day in range(1, 21):
        for base, key in keys.items():
            good = base == "USD" or day in (3, 14)
            at = datetime(2024, 1, day)
            rows.append((key, {"base": base}, 200, "{}", at, f"r{day}", 0, "latest", at.date(), good))
    landing = f"{folder}/landing"
    spark.createDataFrame(rows, LANDED).write.partitionBy("feed", "request_date").parquet(landing)
    days = sorted({r.request_date.day for r in recent_polls(todo, landing).collect()})
    assert days == list(range(13, 21))
    other = planning.latest_rate_requests(spark.createDataFrame([("EUR",)], "base_currency string"))
    assert recent_polls(todo.union(other), landing).count() == 40
    assert len(children(spark, f"{landing}/feed=latest")) == 20


def test_amounts_wait_for_their_rates(spark, folder):
    """Rates up to an hour late, amounts in any order: as if all had been there at once."""
    rng = random.Random(9)
    start = datetime(2024, 1, 1)
    rates = [(rng.choice("AB"), "X", float(rng.randrange(1, 99)), start + timedelta(minutes=m)) for m in range(0, 3000, 7)]
    amounts = [(n, rng.choice("ABC"), "X", float(rng.randrange(1, 99)), start + timedelta(minutes=rng.randrange(-60, 3100))) for n in range(400)]
    # One amount stands at the very time of a watermark.
    amounts.append((400, "A", "X", 1.0, max(r[3] for r in rates) - timedelta(hours=1)))
    rate_frame = lambda x: spark.createDataFrame(x, "base_currency string, target_currency string, rate double, rate_timestamp timestamp_ntz")
    amount_frame = lambda x: spark.createDataFrame(x, "n long, from_currency string, to_currency string, amount double, ts timestamp_ntz")
    comes = {r: r[3] + timedelta(minutes=rng.randrange(59)) for r in rates}
    with pytest.raises(FileNotFoundError):
        arriving.settled_amounts(spark, folder)
    for load in range(4):
        now = [r for r in rates if load * 800 <= (comes[r] - start).total_seconds() // 60 < load * 800 + 800]
        arriving.land_rates(rate_frame(now), folder, load)
        arriving.land_amounts(amount_frame(amounts[load::4]), folder, load)
        assert arriving.settle(spark, folder, "1 hour") > 0
        assert arriving.settle(spark, folder, "1 hour") == 0
        seen = [r for r in rates if (comes[r] - start).total_seconds() // 60 < load * 800 + 800]
        until = max(r[3] for r in seen) - timedelta(hours=1)
        came = [a for k in range(load + 1) for a in amounts[k::4]]
        want = convert_amounts(amount_frame([a for a in came if a[4] <= until]), rate_frame(rates))
        got = arriving.settled_amounts(spark, folder)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
