"""Exchange-rate feeds: landed responses to the EXCHANGE_RATES, CONVERSION and CURRENCIES tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from rateloom import schemas
from rateloom.functions import is_number_text, now_utc, parse_iso_utc, safe_ratio, utc_ntz
from rateloom.operators.calendar import batch_audit, batch_no, day_calendar
from rateloom.operators.shape import enforce_schema

from .envelope import guard, read_body, usable


def _all_numbers(rates: Column) -> Column:
    return F.coalesce(F.forall(F.map_values(rates), is_number_text), F.lit(True))


def _with_stated_time(read: DataFrame) -> DataFrame:
    """Add ``stated``, the time the provider states, and ``time_ok``: none stated, or one that can be read."""
    text = F.col("doc.meta.last_updated_at")
    return read.withColumn("stated", parse_iso_utc(text, strict=False)).withColumn(
        "time_ok", F.col("stated").isNotNull() | text.isNull() | (text == "")
    )


def _rate_time() -> Column:
    """A response that states no time was current when it was fetched."""
    return F.coalesce("stated", utc_ntz("fetched_at"))


# Each feed's reader gives the parsed responses, where the rows are found, and which are usable.
Found = tuple[DataFrame, Column, Column]


def read_latest(responses: DataFrame) -> Found:
    read = _with_stated_time(read_body(responses, schemas.BODY_LATEST_RATES))
    rates = F.col("doc.response.rates")
    return read, rates, F.col("readable") & F.col("time_ok") & _all_numbers(rates)


def read_historical(responses: DataFrame) -> Found:
    read = read_body(responses, schemas.BODY_HISTORICAL_RATES)
    read = read.withColumn("day", F.col("doc.response.date").try_cast("date"))
    rates = F.col("doc.response.rates")
    return read, rates, F.col("readable") & F.col("day").isNotNull() & _all_numbers(rates)


def read_conversions(responses: DataFrame) -> Found:
    read = _with_stated_time(read_body(responses, schemas.BODY_CONVERSION))
    value = F.col("doc.response.value")
    return read, F.array(value), F.col("readable") & F.col("time_ok") & value.isNotNull()


def read_currencies(responses: DataFrame) -> Found:
    read = read_body(responses, schemas.BODY_CURRENCIES)
    return read, F.col("doc.response"), F.col("readable")


def rates_latest(responses: DataFrame, on_error: str = "raise") -> DataFrame:
    """Latest rates of every base in the responses; one row per base and target."""
    read, rates, ok = read_latest(responses)
    rows = read.select(
        F.col("doc.response.base").alias("base_currency"),
        _rate_time().alias("rate_timestamp"),
        F.explode(guard(ok, rates, on_error)).alias("target_currency", "rate"),
    )
    rows = rows.withColumn("rate_date", F.to_date("rate_timestamp"))
    return enforce_schema(rows.withColumn("ingestion_datetime", now_utc()), schemas.EXCHANGE_RATES)


def _asked(name: str) -> Column:
    return F.try_element_at("params", F.lit(name))


def _historical_rows(read: DataFrame, found: Column) -> DataFrame:
    return read.select(
        "params",
        F.col("doc.response.base").alias("base_currency"),
        F.col("day").alias("rate_date"),
        F.col("day").cast("timestamp_ntz").alias("rate_timestamp"),
        F.explode(found).alias("target_currency", "rate"),
        now_utc().alias("ingestion_datetime"),
    )


def rates_historical(responses: DataFrame, on_error: str = "raise") -> DataFrame:
    """Rates of past days, stamped midnight UTC of the response's own date."""
    read, rates, ok = read_historical(responses)
    return enforce_schema(_historical_rows(read, guard(ok, rates, on_error)), schemas.EXCHANGE_RATES)


def rates_timeseries(responses: DataFrame, start: str, end: str, batch_size: int = 7) -> DataFrame:
    """Historical rates of every day asked for in [start, end], plus ``batch``, the day's window.

    Days whose response is unusable are left out; ``rates_timeseries_audit`` counts them. The window
    number is computed from the date, so the rows need no join with a calendar, and responses to
    requests outside the range are dropped before they are parsed.
    """
    lo, hi = F.lit(start).cast("date"), F.lit(end).cast("date")
    asked = _asked("date").try_cast("date")
    read, rates, ok = read_historical(responses.where(F.coalesce(asked.between(lo, hi), F.lit(True))))
    day = F.coalesce(asked, F.col("day"))
    # In the guard rather than in a filter, which would be pushed down and parse the body again.
    rows = _historical_rows(read, guard(ok & day.between(lo, hi), rates, "drop"))
    batch = batch_no(F.coalesce(asked, F.col("rate_date")), lo, batch_size)
    with_batch = StructType([*schemas.EXCHANGE_RATES.fields, StructField("batch", IntegerType())])
    return enforce_schema(rows.withColumn("batch", batch), with_batch)


def historical_results(responses: DataFrame) -> DataFrame:
    """One row per response: base, the day asked for, whether it is usable and how many rates it has."""
    read, rates, ok = read_historical(responses)
    asked = F.coalesce(_asked("date").try_cast("date"), F.col("day"))
    base = F.coalesce(_asked("base"), F.col("doc.response.base"))
    return usable(read, ok, F.size(rates), base.alias("base_currency"), asked.alias("day"))


def rates_timeseries_audit(
    responses: DataFrame, bases: DataFrame, start: str, end: str, batch_size: int = 7
) -> DataFrame:
    """Per base and window: days, failed or missing days, and rates received."""
    ranges = bases.select("base_currency", F.lit(start).alias("_from"), F.lit(end).alias("_to"))
    calendar = day_calendar(ranges, "_from", "_to", batch_size, ["base_currency"])
    return batch_audit(calendar, historical_results(responses), ["base_currency"])


def convert_currency(responses: DataFrame, on_error: str = "raise") -> DataFrame:
    """Conversions as answered; from, to and amount come from the request's parameters."""
    read, value, ok = read_conversions(responses)
    amount = _asked("amount").cast("double")
    rows = read.select(
        _asked("from").alias("from_currency"),
        _asked("to").alias("to_currency"),
        amount.alias("amount"),
        F.explode(guard(ok, value, on_error)).alias("converted_amount"),
        _rate_time().alias("rate_timestamp"),
    )
    rows = rows.withColumn("rate", safe_ratio("converted_amount", "amount"))
    return enforce_schema(rows.withColumn("ingestion_datetime", now_utc()), schemas.CONVERSION)


def currencies(responses: DataFrame, on_error: str = "raise") -> DataFrame:
    """The currency lists in the responses, one row per currency."""
    read, listed, ok = read_currencies(responses)
    rows = read.select(F.explode(guard(ok, listed, on_error)).alias("c"))
    rows = rows.select(
        F.col("c.id").alias("currency_code"),
        F.col("c.name").alias("currency_name"),
        "c.short_code",
        "c.symbol",
    )
    return enforce_schema(rows.withColumn("ingestion_datetime", now_utc()), schemas.CURRENCIES)
