"""Running tables: kept up by what arrives, without computing them anew.

What a load adds is reduced to rows that can be merged, a few per key (*parts*), and lands as a change of
its own. A reader merges the changes with the base; ``fold`` does so once and for all, and rewrites only
those shares of the base that the changes touch. Late rows need no special case: they are parts of an old
key, and open it again.

A running table is a folder::

    changes/<source>-<batch>    parts of a load; a load that is repeated replaces its own
    base/fold=<n>/part=<p>      merged parts
    folds/fold=<n>              which fold holds each share of the base, and which loads are folded

A change counts once its job has ended, a fold once its row in ``folds`` is there. So a reader never sees
half of either, and a job that broke off between two steps is simply run again.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rateloom.operators import bars as bar_ops
from rateloom.operators import snapshots as snapshot_ops
from rateloom.sinks.folders import children, delete, finished

Rows = Callable[[DataFrame], DataFrame]

#: Shares of a table that is kept by symbol.
SHARES = 16


class Running(NamedTuple):
    """What a running table holds: how parts of the same keys become one, and rows come from them.

    Parts have a text column ``part``, the share of the table they are stored in, which follows from
    their keys.
    """

    merge: Rows
    result: Rows


class _State(NamedTuple):
    fold: int
    #: The fold that holds each share.
    shares: dict[str, int]
    #: The last load of each source that is folded.
    folded: dict[str, int]


def _state(spark: SparkSession, path: str) -> _State:
    done = [int(name.removeprefix("fold=")) for name in finished(spark, f"{path}/folds")]
    if not done:
        return _State(0, {}, {})
    # As many rows as the table has shares and sources.
    rows = spark.read.parquet(f"{path}/folds/fold={max(done)}").collect()
    of_kind = lambda kind: {r["name"]: r["n"] for r in rows if r["kind"] == kind}
    return _State(max(done), of_kind("share"), of_kind("source"))


def _pending(spark: SparkSession, path: str, state: _State) -> dict[str, tuple[str, int]]:
    """Changes that have landed and are not folded: name to (source, load)."""
    named = {name: name.rpartition("-") for name in finished(spark, f"{path}/changes")}
    loads = {name: (source, int(n)) for name, (source, _, n) in named.items()}
    return {name: (source, n) for name, (source, n) in loads.items() if n > state.folded.get(source, -1)}


def land_change(parts: DataFrame, path: str, source: str, load: int) -> None:
    """Lands what load number ``load`` of ``source`` adds. Landing the same load again replaces it.

    Loads of a source are numbered as they come; only the rows of the load are read and shuffled.
    """
    parts.write.mode("overwrite").parquet(f"{path.rstrip('/')}/changes/{source}-{load:012d}")


def run_changes(rows: DataFrame, parts: Rows, path: str, checkpoint: str, source: str = "rows") -> StreamingQuery:
    """Lands the parts of all that is new in the stream ``rows`` and stops; run it again for more.

    A micro-batch is a load. One that is repeated after a crash has the same rows by the checkpoint and
    replaces its own change, folded or not, so no row counts twice. Each ``source`` of a table has a
    checkpoint of its own.
    """

    def land(batch: DataFrame, number: int) -> None:
        land_change(parts(batch), path, source, number)

    writer = rows.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def _base(spark: SparkSession, path: str, shares: dict[str, int]) -> DataFrame | None:
    if not shares:
        return None
    folders = [f"{path}/base/fold={n}/part={share}" for share, n in sorted(shares.items())]
    rows = spark.read.option("basePath", f"{path}/base").parquet(*folders)
    return rows.withColumn("part", F.col("part").cast("string")).drop("fold")


def _changes(spark: SparkSession, path: str, names) -> DataFrame | None:
    return spark.read.parquet(*[f"{path}/changes/{n}" for n in sorted(names)]) if names else None


def _touched(changes: DataFrame) -> list[str]:
    # As many rows as the table has shares.
    return [r["part"] for r in changes.select("part").distinct().collect()]


def _union(one: DataFrame | None, other: DataFrame | None) -> DataFrame:
    found = [df for df in (one, other) if df is not None]
    return found[0].unionByName(found[1]) if len(found) == 2 else found[0]


def current_parts(spark: SparkSession, path: str, running: Running) -> DataFrame:
    """The merged parts of all that has landed. Shares without a change are read as they are."""
    path = path.rstrip("/")
    state = _state(spark, path)
    changes = _changes(spark, path, _pending(spark, path, state))
    if changes is None:
        if not state.shares:
            raise FileNotFoundError(f"nothing has landed in {path}")
        return _base(spark, path, state.shares)
    touched = set(_touched(changes))
    merged = running.merge(_union(_base(spark, path, {s: n for s, n in state.shares.items() if s in touched}), changes))
    return _union(merged, _base(spark, path, {s: n for s, n in state.shares.items() if s not in touched}))


def current(spark: SparkSession, path: str, running: Running) -> DataFrame:
    """The rows of a running table: what the batch operator gives for all that has landed."""
    return running.result(current_parts(spark, path, running))


def fold(spark: SparkSession, path: str, running: Running, min_changes: int = 1) -> int:
    """Merges what has landed into the base; returns the number of changes that were folded.

    Only the shares that they touch are read and written, as a new fold beside the old ones; the row in
    ``folds`` puts it in their place. Files that no reader needs any more are removed by the fold after, so
    readers that began before this one go on undisturbed. One fold at a time.
    """
    path = path.rstrip("/")
    state = _state(spark, path)
    _clear(spark, path, state)
    pending = _pending(spark, path, state)
    if len(pending) < max(1, min_changes):
        return 0
    changes, number = _changes(spark, path, pending), state.fold + 1
    touched = _touched(changes)
    old = _base(spark, path, {s: n for s, n in state.shares.items() if s in set(touched)})
    merged = running.merge(_union(old, changes)).hint("rebalance", "part")
    merged.write.mode("overwrite").partitionBy("part").parquet(f"{path}/base/fold={number}")
    shares = state.shares | dict.fromkeys(touched, number)
    folded = dict(state.folded)
    for source, load in pending.values():
        folded[source] = max(load, folded.get(source, -1))
    rows = [("share", s, n) for s, n in shares.items()] + [("source", s, n) for s, n in folded.items()]
    row = spark.createDataFrame(rows, "kind string, name string, n long").coalesce(1)
    row.write.mode("overwrite").parquet(f"{path}/folds/fold={number}")
    return len(pending)


def _clear(spark: SparkSession, path: str, state: _State) -> None:
    """Removes what the last fold has replaced: shares of older folds, older rows, folded changes."""
    for name in children(spark, f"{path}/changes"):
        source, _, load = name.rpartition("-")
        if int(load) <= state.folded.get(source, -1):
            delete(spark, f"{path}/changes/{name}")
    for name in children(spark, f"{path}/base"):
        number = int(name.removeprefix("fold="))
        held = [c for c in children(spark, f"{path}/base/{name}") if c.startswith("part=")]
        stale = [c for c in held if state.shares.get(c.removeprefix("part=")) != number]
        if len(stale) == len(held):
            delete(spark, f"{path}/base/{name}")
            continue
        for c in stale:
            delete(spark, f"{path}/base/{name}/{c}")
    for name in finished(spark, f"{path}/folds"):
        if int(name.removeprefix("fold=")) < state.fold:
            delete(spark, f"{path}/folds/{name}")


def share_of(symbol: str = "symbol"):
    """The share of a table that is kept by symbol."""
    return F.pmod(F.xxhash64(symbol), F.lit(SHARES)).cast("string")


# ---- what can be kept up ----------------------------------------------------------------------


def bar_changes(timeframe: str, tie: str | None = None) -> Rows:
    """Trades to parts of bars, stored by the day of the bar."""
    return lambda trades: bar_ops.bar_parts(trades, timeframe, tie).withColumn(
        "part", F.coalesce(F.to_date("timestamp").cast("string"), F.lit("none"))
    )


BARS = Running(lambda parts: bar_ops.merge_bar_parts(parts, "part"), bar_ops.bars_of_parts)


def settled_bars(spark: SparkSession, path: str, delay: str) -> DataFrame:
    """The bars that ended at least ``delay`` (an interval, as ``1 day``) before the last trade seen.

    They stand unless a later trade still comes; then the bar is simply there with the new values.
    """
    parts = current_parts(spark, path, BARS)
    last = parts.agg(F.max("last_ts")).first()[0]
    ended = F.col("bar_end") <= F.lit(last) - F.expr(f"interval {delay}")
    return bar_ops.bars_of_parts(parts.where(ended) if last is not None else parts.where(F.lit(False)))


def latest_bar_changes(timeframe: str, tie: str | None = None) -> Rows:
    """Trades to parts of every symbol's last bar, stored by symbol."""
    made = lambda trades: bar_ops.bar_parts(trades, timeframe, tie)
    return lambda trades: bar_ops.last_windows(made(trades)).withColumn("part", share_of())


LATEST_BAR = Running(
    lambda parts: bar_ops.merge_bar_parts(bar_ops.last_windows(parts), "part"), bar_ops.bars_of_parts
)


def trade_changes(tie: str | None = None) -> Rows:
    """Trades to parts of a snapshot: every symbol's last trade of its last two days."""
    return lambda trades: snapshot_ops.trade_parts(trades, tie).withColumn("part", share_of())


def quote_changes(tie: str | None = None) -> Rows:
    """Quotes to parts of a snapshot: every symbol's last quote."""
    return lambda quotes: snapshot_ops.quote_parts(quotes, tie).withColumn("part", share_of())


SNAPSHOT = Running(lambda parts: snapshot_ops.merge_parts(parts, "part"), snapshot_ops.snapshot_of_parts)
