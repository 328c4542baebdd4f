"""Rates along paths, repair windows, validity intervals and windows of any length, against plain versions."""

import itertools
import random
from datetime import date, datetime, timedelta

import pytest

from rateloom.operators.asof import asof_join
from rateloom.operators.calendar import repair_windows
from rateloom.operators.intervals import in_windows, validity_intervals
from rateloom.operators.paths import path_rates
from rateloom.sources.planning import repair_bar_requests, repair_rate_requests

RATES = "base_currency string, target_currency string, rate double, rate_timestamp timestamp_ntz"
PAIRS = "from_currency string, to_currency string"
DAY = datetime(2024, 1, 1)


def plain_paths(pairs, rates, max_hops):
    """All simple paths of the fewest hops; the best by its oldest quote, then by its codes."""
    last = {}
    for base, target, rate, at in rates:
        if base and target and base != target and rate and rate > 0 and at:
            last[base, target] = max(last.get((base, target), (datetime.min, 0)), (at, rate))
    edges = {}
    for (base, target), (at, rate) in last.items():
        for f, t, r, own in ((base, target, rate, 1), (target, base, 1 / rate, 0)):
            edges[f, t] = max(edges.get((f, t), (datetime.min, 0, 0)), (at, own, r))
    codes = {c for e in edges for c in e}
    out = {}
    for f, t in set(pairs):
        found = []
        if f == t and f in codes:
            found = [(0, 0, f, 1.0, None)]
        for hops in range(1, max_hops + 1):
            if found or f not in codes or t not in codes:
                break
            for middle in itertools.permutations(codes - {f, t}, hops - 1):
                path = (f, *middle, t)
                steps = [edges.get(e) for e in zip(path, path[1:])]
                if all(steps):
                    rate = 1.0
                    for s in steps:
                        rate *= s[2]
                    at = min(s[0] for s in steps)
                    found.append((hops, -at.timestamp(), ">".join(path), rate, at))
        best = min(found, default=None)
        out[f, t] = (best[3], best[0], best[4], best[2]) if best else (None, None, None, None)
    return out


@pytest.mark.parametrize("seed", range(3))
def test_paths(spark, folder, seed):
    rng = random.Random(seed)
    codes = "ABCDEFG"
    # Times differ for every quote, so the path with the latest oldest quote is one.
    rates = [
        (rng.choice(codes), rng.choice(codes), rng.choice([0.5, 2.0, 4.0, 1.25, 0.0, -1.0, None]), DAY + timedelta(minutes=rng.randrange(10**6)))
        for _ in range(9)
    ] + [("A", None, 2.0, DAY), (None, "B", 2.0, DAY), ("A", "B", 2.0, None)]
    pairs = [(f, t) for f in codes + "Z" for t in codes + "Z"] + [("A", "B"), ("A", None), (None, "B")]
    got = path_rates(spark.createDataFrame(pairs, PAIRS), spark.createDataFrame(rates, RATES), 4, folder).collect()
    want = plain_paths([p for p in pairs if None not in p], rates, 4)
    known = {(r.from_currency, r.to_currency): r for r in got if r.from_currency and r.to_currency}
    assert len(got) == len(set(pairs)) and set(known) == set(want)
    for pair, (rate, hops, at, path) in want.items():
        r = known[pair]
        assert (r.hops, r.rate_timestamp) == (hops, at), pair
        assert (r.rate is None) == (rate is None)
        if rate is not None:
            assert r.path.count(">") == hops and r.path[0] == pair[0] and r.path[-1] == pair[1]
    assert all(r.rate is None for r in got if not (r.from_currency and r.to_currency))


def test_paths_prefer_hops_then_freshness_then_codes(spark, folder):
    at = lambda n: DAY + timedelta(days=n)
    rates = [("A", "B", 2.0, at(9)), ("B", "C", 3.0, at(9)), ("A", "D", 5.0, at(3)), ("D", "C", 7.0, at(8)), ("C", "E", 1.0, at(1))]
    rates += [("A", "C", 100.0, at(0)), ("A", "C", 50.0, at(0)), ("F", "A", 4.0, at(2)), ("A", "F", 0.3, at(2))]
    rates += [("X", "Y", 2.0, at(0))]
    pairs = [("A", "C"), ("B", "D"), ("A", "E"), ("A", "F"), ("F", "A"), ("A", "Y"), ("C", "A")]
    got = {
        (r.from_currency, r.to_currency): (r.rate, r.hops, r.path)
        for r in path_rates(spark.createDataFrame(pairs, PAIRS), spark.createDataFrame(rates, RATES), 5, folder).collect()
    }
    assert got["A", "C"] == (100.0, 1, "A>C") and got["C", "A"] == (0.01, 1, "C>A")
    assert got["B", "D"] == (3.0 * (1 / 7.0), 2, "B>C>D")  # by way of A the oldest quote is older
    assert got["A", "E"] == (100.0, 2, "A>C>E")
    assert got["A", "F"] == (0.3, 1, "A>F") and got["F", "A"] == (4.0, 1, "F>A")
    assert got["A", "Y"] == (None, None, None)
    none = spark.createDataFrame([], RATES)
    assert [r.rate for r in path_rates(spark.createDataFrame(pairs[:1], PAIRS), none, 5, folder).collect()] == [None]


@pytest.mark.parametrize("most", [None, 1, 3, 7])
def test_repair_windows(spark, most):
    rng = random.Random(most)
    days = [date(2024, 2, 1) + timedelta(days=n) for n in range(60)]
    missing = [(k, d) for k in ("A", "B", None) for d in rng.sample(days, 35)] + [("C", days[0]), ("C", days[0]), ("C", None)]
    got = repair_windows(spark.createDataFrame(missing, "symbol string, day date"), ["symbol"], most).collect()
    covered = [(r.symbol, r.start + timedelta(days=n)) for r in got for n in range((r.end - r.start).days + 1)]
    assert sorted(covered, key=str) == sorted({m for m in missing if m[1]}, key=str)
    assert all(r.days == (r.end - r.start).days + 1 and (most is None or r.days <= most) for r in got)
    # The fewest: as many as the runs of days need.
    wanted = 0
    for k in ("A", "B", None, "C"):
        own = sorted({d for s, d in missing if s == k and d})
        runs = [len(list(g)) for _, g in itertools.groupby(enumerate(own), lambda x: x[1] - timedelta(days=x[0]))]
        wanted += sum(1 if most is None else -(-n // most) for n in runs)
    assert len(got) == wanted


def test_repair_requests(spark):
    d = lambda n: date(2024, 1, n)
    missing = [("A", d(1)), ("A", d(2)), ("B", d(1)), ("B", d(2)), ("B", d(9)), ("C", d(2))]
    bars = repair_bar_requests(spark.createDataFrame(missing, "symbol string, day date"), "1Hour", limit=10)
    got = sorted((r.params["symbols"], r.params["start"], r.params["end"], r.params["limit"]) for r in bars.collect())
    assert got == [("A,B", "2024-01-01", "2024-01-02", "10"), ("B", "2024-01-09", "2024-01-09", "10"), ("C", "2024-01-02", "2024-01-02", "10")]
    rates = repair_rate_requests(spark.createDataFrame(missing, "base_currency string, day date"))
    got = sorted((r.params["base"], r.params["date"]) for r in rates.collect())
    assert got == sorted((s, str(x)) for s, x in missing)
    with pytest.raises(ValueError):
        repair_bar_requests(spark.createDataFrame(missing, "symbol string, day date"), "2Hour")


def plain_intervals(polls):
    by_key, out = {}, []
    for k, v, ts in polls:
        if k is not None and ts is not None:
            own = by_key.setdefault(k, {})
            values, n = own.get(ts, ([], 0))
            own[ts] = (values + [v], n + 1)
    for k, own in by_key.items():
        runs = []
        for ts in sorted(own):
            values, n = own[ts]
            value = max((v for v in values if v is not None), default=None)
            if runs and runs[-1][1] == value:
                runs[-1][3] += n
            else:
                runs.append([k, value, ts, n])
        ends = [r[2] for r in runs[1:]] + [None]
        out += [(k, v, a, z, n) for (k, v, a, n), z in zip(runs, ends)]
    return sorted(out, key=str)


@pytest.mark.parametrize("slot", ["1 hour", "1 day", "3650 days"])
def test_validity_intervals(spark, slot):
    """Runs within a slot, across many slots, over slots without a change; null values, times and keys."""
    rng = random.Random(5)
    polls = []
    for k in ("A", "B", "C", None):
        value = 1.0
        for _ in range(120):
            value = rng.choice([1.0, 2.0, None]) if rng.random() < {"A": 0.5, "B": 0.05}.get(k, 0.0) else value
            ts = DAY + timedelta(minutes=30 * rng.randrange(300))
            polls.append((k, value, None if rng.random() < 0.02 else ts))
    frame = spark.createDataFrame(polls, "symbol string, rate double, rate_timestamp timestamp_ntz")
    held = validity_intervals(frame, ["symbol"], "rate", slot=slot)
    assert sorted(map(tuple, held.collect()), key=str) == plain_intervals(polls)
    assert validity_intervals(frame.limit(0), ["symbol"], "rate").collect() == []


def test_asof_on_intervals(spark):
    """As of any time the intervals say what the polls say."""
    rng = random.Random(6)
    polls = [(rng.choice("AB"), float(rng.randrange(3)), DAY + timedelta(minutes=rng.randrange(5000))) for _ in range(300)]
    polls = list({(k, ts): (k, v, ts) for k, v, ts in polls}.values())
    frame = spark.createDataFrame(polls, "symbol string, rate double, rate_timestamp timestamp_ntz")
    probes = spark.createDataFrame([(n, rng.choice("ABZ"), DAY + timedelta(minutes=rng.randrange(-50, 5500))) for n in range(400)], "n long, symbol string, ts timestamp_ntz")
    held = validity_intervals(frame, ["symbol"], "rate").drop("n_polls")
    ask = lambda rates, at: sorted((r.n, r.rate) for r in asof_join(probes, rates, ["symbol"], ["rate"], rate_ts=at, matched_ts="m").collect())
    assert ask(held, "valid_from") == ask(frame, "rate_timestamp")
    inside = in_windows(held.na.fill({}).selectExpr("symbol", "rate", "valid_from as start", "coalesce(valid_to, timestamp_ntz'2999-01-01') as end"), probes, ["symbol"])
    assert sorted((r.n, r.rate) for r in inside.collect()) == [(n, v) for n, v in ask(frame, "rate_timestamp") if v is not None]


@pytest.mark.parametrize("unit", [60_000_000, 3_600_000_000, 1_000_000])
def test_in_windows(spark, unit):
    """Nested, overlapping, touching, empty, turned and endless windows; points on their edges, before 1970 too."""
    rng = random.Random(7)
    start = datetime(1969, 12, 31)
    moment = lambda: start + timedelta(seconds=rng.choice([1, 60, 3600]) * rng.randrange(100), microseconds=rng.choice([0, 0, 1]))
    windows = []
    for n in range(60):
        a = moment()
        windows.append((n, rng.choice("AB"), a, a + timedelta(seconds=rng.choice([0, 1, 59, 60, 61, 4000, 100_000, 10**9, -5]))))
    windows += [(100, "A", None, start), (101, "A", start, None), (102, None, start, start + timedelta(days=9)), (103, "A", datetime(1, 1, 2), datetime(9999, 1, 1))]
    windows += [(1, windows[1][1], windows[1][2], windows[1][3])]
    points = [(n, rng.choice("ABC"), moment()) for n in range(200)] + [(300, "A", None), (301, None, start)]
    points += [(400 + k, s, t + timedelta(microseconds=d)) for k, (_, s, a, z) in enumerate(windows[:20]) for t in (a, z) for d in (-1, 0)]
    got = in_windows(
        spark.createDataFrame(windows, "w long, symbol string, start timestamp_ntz, end timestamp_ntz"),
        spark.createDataFrame(points, "p long, symbol string, ts timestamp_ntz"),
        ["symbol"],
        unit=unit,
    )
    want = sorted(
        (w, p) for w, s, a, z in windows for p, k, t in points if s and s == k and a and z and t and a <= t < z
    )
    assert sorted((r.w, r.p) for r in got.collect()) == want
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    none = got.where("false")
    assert none.collect() == []
    empty = spark.createDataFrame([], "w long, symbol string, start timestamp_ntz, end timestamp_ntz")
    assert in_windows(empty, spark.createDataFrame(points, "p long, symbol string, ts timestamp_ntz"), ["symbol"]).collect() == []
