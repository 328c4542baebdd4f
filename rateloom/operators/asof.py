"""As-of join: the last rate at or before each probe."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def asof_join(
    probes: DataFrame,
    rates: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    ts: str = "ts",
    rate_ts: str = "ts",
    slot: str = "1 minute",
    matched_ts: str = "rate_timestamp",
    tie: str | None = None,
) -> DataFrame:
    """``probes`` plus ``values`` and ``matched_ts`` of the latest rate with the same ``keys`` whose
    time is not after the probe's; null where there is none.

    No group grows with the data, even when one pair holds most of it:

    * probes and rates meet as moments: one row per key and microsecond, after a map-side aggregate,
      so a batch of probes stamped alike is one row;
    * the running last value is taken per key and ``slot``;
    * what a slot inherits is found from one row per key and slot, so that window has as many rows
      as there are slots in the time covered (minutes: half a million a year).

    Rates of one key and microsecond are settled by the largest ``tie`` (a long column), or without
    one by the largest values. The wide probe rows are shuffled once, for the final equi join. Its
    right side has one row per moment, so its hash partitions are even, and AQE can split a skewed
    probe key without copying much.
    """
    keys, values = list(keys), list(values)
    on = [f"_k{i}" for i in range(len(keys))]
    vals = [f"_v{i}" for i in range(len(values))]

    def rows(df: DataFrame, time: str, *extra: Column) -> DataFrame:
        return df.where(reduce(and_, [F.col(c).isNotNull() for c in [*keys, time]])).select(
            *[F.col(k).alias(o) for k, o in zip(keys, on)],
            F.col(time).alias("_ts"),
            F.window(F.col(time), slot).getField("start").alias("_slot"),
            *extra,
        )

    quoted = rows(
        rates,
        rate_ts,
        *[F.col(v).alias(o) for v, o in zip(values, vals)],
        (F.col(tie) if tie else F.lit(None).cast("long")).alias("_tie"),
        F.lit(True).alias("_is_rate"),
    )
    asked = rows(probes, ts, F.lit(False).alias("_is_rate"))
    if tie:
        best = [F.max_by(v, "_tie").alias(v) for v in vals]
    elif len(vals) == 1:
        best = [F.max(vals[0]).alias(vals[0])]
    else:
        top = F.max(F.when(F.col("_is_rate"), F.struct(*vals)))
        best = [top[v].alias(v) for v in vals]
    # Put in place once: the window and the slots below read the same shuffle.
    moments = (
        quoted.unionByName(asked, allowMissingColumns=True)
        .groupBy(*on, "_slot", "_ts")
        .agg(*best, F.max("_is_rate").alias("_has_rate"), F.max(~F.col("_is_rate")).alias("_asked"))
        .repartition(*on, "_slot")
    )

    rate_at = F.when(F.col("_has_rate"), F.col("_ts"))
    slots = moments.groupBy(*on, "_slot").agg(
        F.max(rate_at).alias("_at"),
        *[F.max_by(v, rate_at).alias(v) for v in vals],
        F.max("_asked").alias("_asked"),
    )
    earlier = Window.partitionBy(*on).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    last_of_slot = F.when(F.col("_at").isNotNull(), F.struct("_at", *vals))
    carried = (
        slots.withColumn("_carry", F.last(last_of_slot, True).over(earlier))
        .where(F.col("_asked") & F.col("_carry").isNotNull())
        .select(*on, "_slot", "_carry")
    )

    so_far = (
        Window.partitionBy(*on, "_slot")
        .orderBy("_ts")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    rate_here = F.when(F.col("_has_rate"), F.struct(F.col("_ts").alias("_at"), *vals))
    hit = F.coalesce("_hit", "_carry")
    answers = (
        moments.withColumn("_hit", F.last(rate_here, True).over(so_far))
        .where("_asked")
        .join(carried, [*on, "_slot"], "left")
        .select(
            *on,
            "_ts",
            hit["_at"].alias(matched_ts),
            *[hit[o].alias(v) for v, o in zip(values, vals)],
        )
    )
    match = [probes[k] == answers[o] for k, o in zip(keys, on)]
    joined = probes.join(answers, [*match, probes[ts] == answers["_ts"]], "left")
    return joined.drop(*on, "_ts")


def convert_amounts(amounts: DataFrame, rates: DataFrame, ts: str = "ts", **options) -> DataFrame:
    """``amounts(from_currency, to_currency, amount, ts, ...)`` converted at the as-of rate.

    ``rates`` has base_currency, target_currency, rate and rate_timestamp. Adds rate,
    converted_amount and the rate_timestamp that was used; all null where no rate is known yet.
    """
    quoted = rates.select(
        F.col("base_currency").alias("from_currency"),
        F.col("target_currency").alias("to_currency"),
        "rate",
        F.col("rate_timestamp").alias("_rate_ts"),
        *([options["tie"]] if options.get("tie") else []),
    )
    joined = asof_join(
        amounts, quoted, ["from_currency", "to_currency"], ["rate"], ts=ts, rate_ts="_rate_ts", **options
    )
    return joined.withColumn("converted_amount", F.col("amount") * F.col("rate"))
