"""UTC wall-clock timestamps that do not depend on the session's time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def utc_ntz(instant: Column | str) -> Column:
    """TIMESTAMP to the UTC wall clock as TIMESTAMP_NTZ, whatever the session zone is."""
    return F.expr(_EPOCH) + F.unix_micros(_col(instant)) * F.expr("interval '0.000001' second")


def now_utc() -> Column:
    """The query's start time in UTC: one value per query, so replayed tasks agree."""
    return utc_ntz(F.current_timestamp())


def parse_iso_utc(text: Column | str, strict: bool = True) -> Column:
    """ISO-8601 text to UTC. ``Z`` or no offset keeps the wall clock; ``+02:00`` is shifted.

    Digits past the microsecond are cut. Null stays null; bad text raises under ANSI, or is null when
    not ``strict``.
    """
    text = _col(text)
    cast = Column.cast if strict else Column.try_cast
    clock = F.substring(text, 11, 40)
    offset = ~text.endswith("Z") & (clock.contains("+") | clock.contains("-"))
    # The NTZ cast drops any offset, which is right for Z and for text without one.
    return F.when(offset, utc_ntz(cast(text, "timestamp"))).otherwise(cast(text, "timestamp_ntz"))


def epoch_micros(ts: Column | str) -> Column:
    """TIMESTAMP_NTZ to microseconds since 1970, without going through the session zone."""
    ts = _col(ts)
    seconds = (
        F.unix_date(ts.cast("date")).cast("long") * 86400
        + F.hour(ts) * 3600
        + F.minute(ts) * 60
    )
    return seconds * 1_000_000 + (F.extract(F.lit("SECOND"), ts) * 1_000_000).cast("long")


def order_key(ts: Column | str, tie: Column | str | None = None) -> Column:
    """A fixed-width sort key for ``min_by``/``max_by``: time, then ``tie`` (a long).

    A struct key would force a sort-based aggregate over all input rows; timestamps and decimals
    keep the aggregate hash-based. Without ``tie`` the timestamp itself is the key, which is the
    cheaper one, and rows of the same microsecond are in no particular order.
    """
    if tie is None:
        return _col(ts)
    # The factor exceeds the span of a long, so the tie breaker never carries into the time.
    span = F.lit("20000000000000000000").cast("decimal(20,0)")
    major = (epoch_micros(ts).cast("decimal(18,0)") * span).cast("decimal(38,0)")
    return (major + _col(tie).cast("decimal(19,0)")).cast("decimal(38,0)")


def time_stamp(ts: Column | str) -> Column:
    """``20240102T030405`` from a TIMESTAMP_NTZ."""
    return F.translate(F.substring(_col(ts).cast("string"), 1, 19), " -:", "T")


def stamped_key(
    name: Column | str, ts: Column | str | None = None, prefix: Column | str | None = None
) -> Column:
    """Object key: ``prefix`` without outer slashes, then ``<stamp>_<name>`` (or the bare name)."""
    key = _col(name)
    if ts is not None:
        key = F.concat(time_stamp(ts), F.lit("_"), key)
    if prefix is None:
        return key
    return F.concat_ws("/", F.trim(_col(prefix), F.lit("/")), key)
