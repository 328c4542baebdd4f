"""Rates as the intervals in which they held, and joins of intervals with points in time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rateloom.functions import epoch_micros


def validity_intervals(
    polls: DataFrame,
    keys: Sequence[str],
    value: str,
    ts: str = "rate_timestamp",
    slot: str = "1 day",
) -> DataFrame:
    """``keys, value, valid_from, valid_to, n_polls``: runs of equal ``value`` in the order of ``ts``.

    ``valid_from`` is the first poll of a run, ``valid_to`` the first poll of the next one (null for the last).
    Of several values at one time the largest counts; polls without a key or time are left out, a null value
    is a value like others.

    No window grows with a key: changes are found within a key and ``slot`` and, from one row per key
    and slot, between slots. A run reaches the second shuffle as one row per slot, whatever the polls.
    """
    keys = list(keys)
    given = polls.where(" and ".join(f"`{c}` is not null" for c in [*keys, ts]))
    # A null value sorts below all others, so that copies are settled in the same way for any value.
    moments = given.groupBy(*keys, F.col(ts).alias("_ts")).agg(
        F.max(F.struct(F.col(value).isNotNull().alias("_is"), F.col(value).alias("_v"))).alias("_s"), F.count(F.lit(1)).alias("_n")
    )
    placed = moments.select(
        *keys, F.window("_ts", slot).getField("start").alias("_slot"), "_ts", F.col("_s._v").alias("_v"), "_n"
    )
    within = Window.partitionBy(*keys, "_slot").orderBy("_ts")
    changed = F.lag("_ts").over(within).isNull() | ~F.col("_v").eqNullSafe(F.lag("_v").over(within))
    numbered = placed.withColumn("_new", changed.cast("int")).withColumn("_run", F.sum("_new").over(within))
    # Runs of a slot; the first may go on from the slot before.
    runs = numbered.groupBy(*keys, "_slot", "_run").agg(
        F.min("_ts").alias("_from"), F.first("_v").alias("_v"), F.sum("_n").alias("_n")
    )
    ends = runs.groupBy(*keys, "_slot").agg(F.max_by(F.struct("_v"), "_run").alias("_last"), F.max("_run").alias("_runs"))
    over = Window.partitionBy(*keys).orderBy("_slot")
    before = ends.select(*keys, "_slot", F.lag("_last").over(over).alias("_before"))
    heads = runs.join(before, [*keys, "_slot"]).withColumn(
        "_goes_on", (F.col("_run") == 1) & F.col("_before").isNotNull() & F.col("_before._v").eqNullSafe(F.col("_v"))
    )
    # What goes on belongs to the last run that began: of this slot, or of one before.
    begun = heads.where("not _goes_on").select(*keys, "_slot", "_run", "_from", "_v", "_n")
    firsts = begun.groupBy(*keys, "_slot").agg(F.min("_from").alias("_first"), F.max("_from").alias("_open"))
    slots = (
        heads.groupBy(*keys, "_slot")
        .agg(F.sum(F.when(F.col("_goes_on"), F.col("_n")).otherwise(0)).alias("_more"))
        .join(firsts, [*keys, "_slot"], "left")
    )
    earlier = over.rowsBetween(Window.unboundedPreceding, -1)
    later = over.rowsBetween(1, Window.unboundedFollowing)
    carried = slots.select(
        *keys, "_slot", "_more", F.last("_open", True).over(earlier).alias("_owner"), F.first("_first", True).over(later).alias("_next")
    )
    added = carried.where("_more > 0").groupBy(*keys, F.col("_owner").alias("_from")).agg(F.sum("_more").alias("_more"))
    next_here = F.lead("_from").over(Window.partitionBy(*keys, "_slot").orderBy("_from"))
    return (
        begun.withColumn("_to", next_here)
        .join(carried.select(*keys, "_slot", "_next"), [*keys, "_slot"])
        .join(added, [*keys, "_from"], "left")
        .select(
            *keys,
            F.col("_v").alias(value),
            F.col("_from").alias("valid_from"),
            F.coalesce("_to", "_next").alias("valid_to"),
            (F.col("_n") + F.coalesce("_more", F.lit(0))).alias("n_polls"),
        )
    )


#: A bin is this many microseconds times a power of two; longer intervals take few large bins.
UNIT = 60_000_000
#: Microseconds that any interval between two timestamps is shorter than.
LONGEST = 10_000 * 366 * 86_400 * 1_000_000


def covering_bins(start: str, end: str, unit: int = UNIT):
    """Column of ``array<struct<level, bin>>``: the bins that make up the units from ``start`` to before ``end``.

    A bin of level n holds 2^n units. On each level one is taken at the left end if its number is odd and
    one at the right end if the number after it is; what is left goes on with bins of twice the size.
    """
    none = "cast(array() as array<struct<level:int,bin:bigint>>)"
    return F.expr(
        f"""aggregate(sequence(0, {(LONGEST // unit).bit_length()}),
            named_struct('bins', {none}, 'lo', {start}, 'hi', {end}),
            (s, n) -> named_struct(
                'bins', concat(s.bins,
                    if(s.lo < s.hi and pmod(s.lo, 2) = 1, array(named_struct('level', n, 'bin', s.lo)), {none}),
                    if(s.lo + pmod(s.lo, 2) < s.hi and pmod(s.hi, 2) = 1, array(named_struct('level', n, 'bin', s.hi - 1)), {none})),
                'lo', if(s.lo < s.hi, cast(floor((s.lo + pmod(s.lo, 2)) / 2) as bigint), s.lo),
                'hi', if(s.lo < s.hi, cast(floor((s.hi - pmod(s.hi, 2)) / 2) as bigint), s.hi)),
            s -> s.bins)"""
    )


def in_windows(
    windows: DataFrame,
    points: DataFrame,
    keys: Sequence[str],
    start: str = "start",
    end: str = "end",
    ts: str = "ts",
    unit: int = UNIT,
) -> DataFrame:
    """Every point with every window of the same ``keys`` that holds it: start <= ts < end.

    Windows may overlap, nest and have any length. A window is cut into bins of doubling size, at most two
    of each, so its rows follow the logarithm of its length; a point is looked for in the one bin that
    holds it on each level that any window uses. Window and point share exactly one bin, so each pair
    comes once, from equi joins, and only the two units at a window's ends need a test. Columns of both
    sides are kept; those of the points that the windows have too, but the keys, are left out. A window
    that is empty or lacks an end holds nothing.
    """
    keys = list(keys)
    lo, hi = epoch_micros(start), epoch_micros(end)
    cut = (
        windows.where(F.col(start) < F.col(end))
        .withColumns({"_lo": F.floor(lo / unit).cast("long"), "_hi": F.ceil(hi / unit).cast("long")})
        .withColumn("_bin", F.explode(covering_bins("_lo", "_hi", unit)))
        .select(*windows.columns, F.col("_bin.level").alias("_level"), F.col("_bin.bin").alias("_bin"))
    )
    levels = cut.select("_level").distinct()
    mine = [c for c in points.columns if c in keys or c not in windows.columns]
    if ts not in mine:
        raise ValueError(f"windows have a column {ts!r} of their own")
    # As many levels as there are sizes of bins.
    used = [r["_level"] for r in levels.collect()]
    if not used:
        return windows.join(points.select(*mine).where(F.lit(False)), keys)
    bins = F.explode(F.array(*[F.lit(n) for n in sorted(used)]))
    at = F.floor(epoch_micros(ts) / unit).cast("long")
    placed = points.select(*mine, at.alias("_at"), bins.alias("_level")).withColumn("_bin", F.expr("shiftright(_at, _level)"))
    joined = cut.join(placed.drop("_at"), [*keys, "_level", "_bin"])
    inside = (F.col(ts) >= F.col(start)) & (F.col(ts) < F.col(end))
    return joined.where(inside).drop("_level", "_bin")
