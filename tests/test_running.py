"""Running tables: the same rows as the batch operators after every load, and safe at every step."""

import random
from datetime import datetime, timedelta

import pytest

from rateloom.operators.bars import bars, latest_bar
from rateloom.operators.snapshots import snapshot
from rateloom.sinks.folders import children
from rateloom.streaming import running

TRADES = "symbol string, ts timestamp_ntz, price double, size long, n long"
QUOTES = "symbol string, ts timestamp_ntz, ask_price double, bid_price double, n long"


def rows(seed, n, days=6):
    """Rows in no order of time, several at the same instant, some without a symbol, time, price or size."""
    rng = random.Random(seed)
    start = datetime(2024, 1, 1)
    out = []
    for k in range(n):
        ts = start + timedelta(minutes=rng.randrange(days * 1440 // 30) * 30)
        hole = rng.random()
        out.append(
            (
                None if hole < 0.03 else rng.choice("AAAABCDEFGH"),
                None if 0.03 <= hole < 0.05 else ts,
                None if 0.05 <= hole < 0.08 else float(rng.randrange(1, 500)),
                None if 0.08 <= hole < 0.11 else rng.randrange(0, 9),
                seed * 100_000 + k,
            )
        )
    return out


def frame(spark, data, schema=TRADES):
    return spark.createDataFrame(data, schema)


def same(got, want):
    assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))


def quotes_of(trades):
    return [(s, ts, p, None if q is None else q / 2.0, n) for s, ts, p, q, n in trades]


@pytest.mark.parametrize("folds", [(), (0,), (1,), (0, 1, 2)])
def test_every_load(spark, folder, folds):
    """Bars, latest bars and snapshots equal the batch operators after each of three loads."""
    seen = []
    for load in range(3):
        new = rows(load + 1, 150)
        seen += new
        trades, quotes = frame(spark, new), frame(spark, quotes_of(new), QUOTES)
        running.land_change(running.bar_changes("1Hour", "n")(trades), f"{folder}/bars", "t", load)
        running.land_change(running.latest_bar_changes("1Hour", "n")(trades), f"{folder}/last", "t", load)
        running.land_change(running.trade_changes("n")(trades), f"{folder}/snap", "trades", load)
        running.land_change(running.quote_changes("n")(quotes), f"{folder}/snap", "quotes", load)
        if load in folds:
            for name, table in (("bars", running.BARS), ("last", running.LATEST_BAR), ("snap", running.SNAPSHOT)):
                assert running.fold(spark, f"{folder}/{name}", table) > 0
                assert running.fold(spark, f"{folder}/{name}", table) == 0
        trades, quotes = frame(spark, seen), frame(spark, quotes_of(seen), QUOTES)
        made = bars(trades, "1Hour", tie="n")
        same(running.current(spark, f"{folder}/bars", running.BARS), made)
        same(running.current(spark, f"{folder}/last", running.LATEST_BAR), latest_bar(made))
        # The batch operator joins trades and quotes by symbol, and so not those without one.
        got = running.current(spark, f"{folder}/snap", running.SNAPSHOT).where("symbol is not null")
        same(got, snapshot(trades, quotes, tie="n").where("symbol is not null"))


def test_repeated_loads_count_once(spark, folder):
    """A load that is landed again, before or after it is folded, changes nothing."""
    first, second = frame(spark, rows(1, 80)), frame(spark, rows(2, 80))
    parts = running.bar_changes("1Day", "n")
    want = bars(first.union(second), "1Day", tie="n")
    running.land_change(parts(first), folder, "t", 0)
    running.land_change(parts(first), folder, "t", 0)
    running.land_change(parts(second), folder, "t", 1)
    same(running.current(spark, folder, running.BARS), want)
    assert running.fold(spark, folder, running.BARS) == 2
    running.land_change(parts(second), folder, "t", 1)
    same(running.current(spark, folder, running.BARS), want)
    assert running.fold(spark, folder, running.BARS) == 0
    same(running.current(spark, folder, running.BARS), want)


class Broken(Exception):
    pass


@pytest.mark.parametrize("step", ["base", "folds"])
def test_a_fold_that_breaks_off(spark, folder, step, monkeypatch):
    """Whatever a broken fold leaves behind, readers see the rows of before, and the next one mends it."""
    parts = running.bar_changes("1Day", "n")
    data = [frame(spark, rows(k, 60)) for k in range(3)]
    for load, new in enumerate(data[:2]):
        running.land_change(parts(new), folder, "t", load)
    running.fold(spark, folder, running.BARS)
    running.land_change(parts(data[2]), folder, "t", 2)
    want = bars(data[0].union(data[1]).union(data[2]), "1Day", tie="n")
    if step == "base":
        # Half a base: files without the row that makes them count.
        running.current_parts(spark, folder, running.BARS).limit(3).write.partitionBy("part").parquet(f"{folder}/base/fold=2")
    else:
        real = spark.createDataFrame

        def broken(rows, schema=None, **kw):
            if schema == "kind string, name string, n long":
                raise Broken
            return real(rows, schema, **kw)

        monkeypatch.setattr(spark, "createDataFrame", broken)
        with pytest.raises(Broken):
            running.fold(spark, folder, running.BARS)
        monkeypatch.undo()
    same(running.current(spark, folder, running.BARS), want)
    assert running.fold(spark, folder, running.BARS) == 1
    same(running.current(spark, folder, running.BARS), want)


def test_a_fold_rewrites_what_changed(spark, folder):
    """Shares without a change stay where they are; what is replaced goes one fold later."""
    parts = running.bar_changes("1Hour", "n")
    all_days = [r for r in rows(1, 300) if r[1] is not None]
    running.land_change(parts(frame(spark, all_days)), folder, "t", 0)
    running.fold(spark, folder, running.BARS)
    late = [("A", datetime(2024, 1, 2, 5, 1), 7.0, 3, 999_999)]
    running.land_change(parts(frame(spark, late)), folder, "t", 1)
    before = running.current(spark, folder, running.BARS)
    running.fold(spark, folder, running.BARS)
    assert [c for c in children(spark, f"{folder}/base/fold=2") if c.startswith("part=")] == ["part=2024-01-02"]
    want = bars(frame(spark, all_days + late), "1Hour", tie="n")
    same(running.current(spark, folder, running.BARS), want)
    same(before, want)  # planned before the fold, read after it
    assert children(spark, f"{folder}/changes") == ["t-000000000001"]
    running.fold(spark, folder, running.BARS)
    assert children(spark, f"{folder}/changes") == []
    assert "part=2024-01-02" not in children(spark, f"{folder}/base/fold=1")
    assert children(spark, f"{folder}/folds") == ["fold=2"]
    same(running.current(spark, folder, running.BARS), want)


def test_reads_no_more_than_the_change(spark, folder):
    """A load's plan holds its own rows only; shares without a change are read without a shuffle."""
    parts = running.bar_changes("1Hour", "n")
    running.land_change(parts(frame(spark, rows(1, 300))), folder, "t", 0)
    running.fold(spark, folder, running.BARS)
    plan = running.current(spark, folder, running.BARS)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Aggregate" not in plan


def test_settled(spark, folder):
    parts = running.bar_changes("1Hour", "n")
    at = lambda h, m=0: datetime(2024, 1, 1, h, m)
    running.land_change(parts(frame(spark, [("A", at(1), 1.0, 1, 1), ("A", at(2, 30), 2.0, 1, 2)])), folder, "t", 0)
    assert running.settled_bars(spark, folder, "1 hour").count() == 0
    running.land_change(parts(frame(spark, [("B", at(4), 3.0, 1, 3)])), folder, "t", 1)
    got = running.settled_bars(spark, folder, "1 hour").orderBy("timestamp").collect()
    assert [(r.symbol, r.timestamp, r.close) for r in got] == [("A", at(1), 1.0), ("A", at(2), 2.0)]
    running.land_change(parts(frame(spark, [("A", at(1, 59), 9.0, 1, 4)])), folder, "t", 2)
    got = running.settled_bars(spark, folder, "1 hour").orderBy("timestamp").collect()
    assert [(r.timestamp, r.close, r.trade_count) for r in got] == [(at(1), 9.0, 2), (at(2), 2.0, 1)]


def test_nothing_landed(spark, folder):
    with pytest.raises(FileNotFoundError):
        running.current(spark, folder, running.BARS)
    running.land_change(running.bar_changes("1Hour")(frame(spark, [])), folder, "t", 0)
    assert running.current(spark, folder, running.BARS).collect() == []
    assert running.settled_bars(spark, folder, "1 hour").collect() == []
    running.fold(spark, folder, running.BARS)


def test_stream_goes_on(spark, folder):
    """A stream that runs again lands only what is new; a repeated micro-batch replaces its change."""
    seen = []
    for load in range(2):
        new = rows(load + 7, 50)
        seen += new
        frame(spark, new).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(TRADES).parquet(f"{folder}/in")
        running.run_changes(stream, running.bar_changes("1Day", "n"), f"{folder}/table", f"{folder}/checkpoint")
    assert children(spark, f"{folder}/table/changes") == ["rows-000000000000", "rows-000000000001"]
    same(running.current(spark, f"{folder}/table", running.BARS), bars(frame(spark, seen), "1Day", tie="n"))
