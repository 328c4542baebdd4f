"""Exchange-rate lookups, cross rates and code checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rateloom.functions import order_key
from rateloom.schemas import CURRENCY_CODES

_PAIR = ["base_currency", "target_currency"]


def rate_for_pair(
    pairs: DataFrame, rates: DataFrame, on_date: bool = False, tie: str | None = None
) -> DataFrame:
    """The rate of each pair of ``pairs``: the latest, or the last of ``rate_date`` (``on_date``).

    A pair without a rate keeps a null. Rates are reduced to one row per pair (and day) before the
    join.
    """
    on = _PAIR + (["rate_date"] if on_date else [])
    last = rates.groupBy(*on).agg(F.max_by("rate", order_key("rate_timestamp", tie)).alias("rate"))
    return pairs.join(last, on, "left")


def first_rate(rates: DataFrame, base: str, target: str, date: str | None = None) -> float:
    """One pair's latest rate, or the rate of a day; ValueError when there is none."""
    found = rates.where((F.col("base_currency") == base) & (F.col("target_currency") == target))
    if date is not None:
        found = found.where(F.col("rate_date") == F.lit(date).cast("date"))
    # A global aggregate: always one row, whatever the number of rates.
    rate = found.agg(F.max_by("rate", "rate_timestamp").alias("rate")).first()["rate"]
    if rate is None:
        raise ValueError(f"no rate for {base}/{target}")
    return rate


def one_per_quote(rates: DataFrame) -> DataFrame:
    """One rate per base, target and time: of copies the one loaded last, then the largest."""
    loaded = F.unix_micros(F.col("ingestion_datetime").cast("timestamp")) if "ingestion_datetime" in rates.columns else F.lit(0)
    quote = ["base_currency", "target_currency", "rate_date", "rate_timestamp"]
    ranked = rates.select(*quote, "rate", loaded.alias("_loaded"))
    last = ranked.groupBy(*quote, "_loaded").agg(F.max("rate").alias("rate"))
    return last.groupBy(*quote).agg(F.max_by("rate", "_loaded").alias("rate"))


def rebase(rates: DataFrame, bases: Sequence[str]) -> DataFrame:
    """Rates against each of ``bases``, derived from rates that share another base.

    ``rate(new, t) = rate(old, t) / rate(old, new)`` at the same old base and time. The divisor
    side has one row per old base, time and new base, so each rate gives one row per new base.
    """
    at = ["base_currency", "rate_timestamp"]
    quoted = one_per_quote(rates)
    divisors = quoted.where(F.col("target_currency").isin(list(bases))).select(
        *at, F.col("target_currency").alias("new_base"), F.col("rate").alias("_divisor")
    )
    return quoted.join(divisors, at).select(
        F.col("base_currency").alias("via_currency"),
        F.col("new_base").alias("base_currency"),
        "target_currency",
        F.try_divide("rate", "_divisor").alias("rate"),
        "rate_date",
        "rate_timestamp",
    )


def cross_rates(rates: DataFrame, pairs: DataFrame) -> DataFrame:
    """``rate(from, to)`` for the asked ``pairs(from_currency, to_currency)`` at every base and time
    that quotes both.

    Only asked pairs are formed: each leg is an equi join, first on the pair's from-side, then on
    base, time and to-side.
    """
    pairs = pairs.select("from_currency", "to_currency").distinct()
    legs = one_per_quote(rates)
    first = legs.select(
        "base_currency",
        "rate_date",
        "rate_timestamp",
        F.col("target_currency").alias("from_currency"),
        F.col("rate").alias("from_rate"),
    )
    second = legs.select(
        "base_currency",
        "rate_timestamp",
        F.col("target_currency").alias("to_currency"),
        F.col("rate").alias("to_rate"),
    )
    return (
        first.join(pairs, "from_currency")
        .join(second, ["base_currency", "rate_timestamp", "to_currency"])
        .select(
            F.col("base_currency").alias("via_currency"),
            "from_currency",
            "to_currency",
            F.try_divide("to_rate", "from_rate").alias("rate"),
            "rate_date",
            "rate_timestamp",
        )
    )


def currency_kind(currencies: DataFrame, kind: str = "fiat", column: str = "type") -> DataFrame:
    """Currencies of one kind."""
    return currencies.where(F.col(column) == kind)


def validate_currency(
    df: DataFrame, column: str, codes: Sequence[str] = tuple(CURRENCY_CODES), rejects: bool = False
) -> DataFrame:
    """Rows whose code is on the list, or (``rejects``) those whose code is missing or not on it.

    The list is short and fixed, so it is a set in the filter itself: no join.
    """
    listed = F.coalesce(F.col(column).isin(list(codes)), F.lit(False))
    return df.where(~listed if rejects else listed)
