"""Historical rates of an API as a Spark table: filters on base and day become fewer calls."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from datetime import date, timedelta

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    LessThan,
    LessThanOrEqual,
)

from rateloom.schemas import LANDING

from .requests import CONCURRENCY, Caller, Transport, batched, landing_arrow

FORMAT = "rateloom_historical_rates"
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"

_DAY = timedelta(days=1)


@dataclass
class _Calls(InputPartition):
    """Numbers of calls: day by day, and within a day base by base."""

    numbers: range


class RatesReader(DataSourceReader):
    """Calls for every base and day asked for, shared out over ``tasks`` tasks."""

    def __init__(self, options: dict[str, str], caller: Caller) -> None:
        self.caller = caller
        self.bases = sorted({b.strip() for b in options["bases"].split(",")})
        self.start = date.fromisoformat(options["start"])
        self.end = date.fromisoformat(options["end"])
        self.symbols = options.get("symbols")
        self.tasks = int(options.get("tasks", str(CONCURRENCY)))

    def _narrow(self, f: Filter) -> bool:
        """Take a filter into the plan of calls; False if it says nothing about them."""
        if not isinstance(f, (EqualTo, In, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)):
            return False
        value = f.value if hasattr(f, "value") else f.values
        if f.attribute == ("base_currency",) and isinstance(f, (EqualTo, In)):
            wanted = {value} if isinstance(f, EqualTo) else set(value)
            self.bases = [b for b in self.bases if b in wanted]
        elif f.attribute == ("day",) and isinstance(f, EqualTo):
            self.start, self.end = max(self.start, value), min(self.end, value)
        elif f.attribute == ("day",) and isinstance(f, (GreaterThan, GreaterThanOrEqual)):
            self.start = max(self.start, value + _DAY if isinstance(f, GreaterThan) else value)
        elif f.attribute == ("day",) and isinstance(f, (LessThan, LessThanOrEqual)):
            self.end = min(self.end, value - _DAY if isinstance(f, LessThan) else value)
        else:
            return False
        return True

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if not self._narrow(f):
                yield f

    def partitions(self) -> list[InputPartition]:
        n_calls = max(0, (self.end - self.start).days + 1) * len(self.bases)
        # Without any partition Spark would ask for a read of everything.
        n = max(1, min(self.tasks, n_calls))
        return [_Calls(range(i, n_calls, n)) for i in range(n)]

    def read(self, partition: _Calls) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[dict]:
            for number in partition.numbers:
                base = self.bases[number % len(self.bases)]
                day = self.start + number // len(self.bases) * _DAY
                params = {"date": day.isoformat(), "base": base}
                if self.symbols:
                    params["symbols"] = self.symbols
                key = "-".join(str(x) for x in (base, day, self.symbols) if x)
                request = {"request_key": key, "endpoint": "historical", "params": params}
                for row in self.caller.pages(request):
                    yield {**row, "base_currency": base, "day": day}

        extra = [pa.field("base_currency", pa.string()), pa.field("day", pa.date32())]
        landing = [f for f in landing_arrow() if f.name in LANDING.names]
        yield from batched(rows(), pa.schema([*landing, *extra]))


def register_rates(spark: SparkSession, transport: Transport, **options) -> str:
    """Make ``spark.read.format(...)`` for historical rates available and return the format's name.

    The table has the landing columns plus base_currency and day. Options of the read: bases (joined
    by commas), start, end, symbols, tasks. Filters on base_currency and day are turned into fewer
    calls; Spark keeps that switched off for Python sources, so it is switched on here. ``options``
    are those of ``Caller``.
    """
    caller = Caller(transport, **options)

    class HistoricalRates(DataSource):
        @classmethod
        def name(cls) -> str:
            return FORMAT

        def schema(self) -> str:
            return (
                "request_key string, params map<string,string>, status int, body string, "
                "fetched_at timestamp, base_currency string, day date"
            )

        def reader(self, schema) -> RatesReader:
            return RatesReader(dict(self.options), caller)

    spark.conf.set(PUSHDOWN, "true")
    spark.dataSource.register(HistoricalRates)
    return FORMAT
