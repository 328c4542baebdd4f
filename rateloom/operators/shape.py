"""Schema enforcement and other whole-table projections."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType, TimestampNTZType, TimestampType

from rateloom.functions import now_utc, order_key, utc_ntz


def _cast(df: DataFrame, name: str, dtype: DataType, mode: str) -> Column:
    column = F.col(f"`{name}`")
    source = df.schema[name].dataType
    if source == dtype:
        return column
    if isinstance(source, TimestampType) and isinstance(dtype, TimestampNTZType):
        return utc_ntz(column).alias(name)
    return (column.cast(dtype) if mode == "strict" else column.try_cast(dtype)).alias(name)


def enforce_schema(df: DataFrame, schema: StructType, mode: str = "strict") -> DataFrame:
    """Exactly the columns of ``schema``, in its order: cast, missing ones null, others dropped.

    A value that cannot be cast raises (``strict``) or becomes null (``mode='null'``).
    """
    if mode not in ("strict", "null"):
        raise ValueError(f"unknown mode {mode!r}")
    present = set(df.columns)
    return df.select(
        *[
            _cast(df, f.name, f.dataType, mode)
            if f.name in present
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def with_ingestion_time(df: DataFrame, name: str = "ingestion_datetime") -> DataFrame:
    """Add the load time in UTC, one value for the whole query."""
    return df.withColumn(name, now_utc())


def all_to_string(df: DataFrame) -> DataFrame:
    """Every column as text, for text sinks."""
    return df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])


def concat_batches(batches: list[DataFrame]) -> DataFrame:
    """All rows of the batches, duplicates kept; columns are matched by name."""
    if not batches:
        raise ValueError("no batches")
    return reduce(DataFrame.unionByName, batches)


def explode_keyed(df: DataFrame, column: str, key: str, value: str = "value") -> DataFrame:
    """One row per entry of a map column, its key as a column; empty and missing maps give none."""
    keep = [F.col(f"`{c}`") for c in df.columns if c != column]
    return df.select(*keep, F.explode(F.col(f"`{column}`")).alias(key, value))


def first_row(
    df: DataFrame, keys: list[str], order: str, values: list[str], tie: str | None = None
) -> DataFrame:
    """The first row's ``values`` per key, in an order that is stated rather than found.

    The least order of a key is found by a hash aggregate over fixed-width columns and joined back;
    of rows that tie in it, the one whose values hash lowest counts. Keys without any order have nulls.
    """
    ranked = df.select(*keys, *[c for c in values if c not in keys], order_key(order, tie).alias("_first"))
    best = ranked.groupBy(*keys).agg(F.min("_first").alias("_first"))
    hashed = ranked.withColumn("_hash", F.xxhash64(*values))
    same = [F.col(f"b.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys] + [F.col("b._first") == F.col("r._first")]
    joined = best.alias("b").join(hashed.alias("r"), same, "left")
    own = joined.select(*[F.col(f"b.{k}").alias(k) for k in keys], *[F.col(f"r.{v}").alias(f"_v{i}") for i, v in enumerate(values)], F.col("r._hash").alias("_hash"))
    nth = Window.partitionBy(*keys).orderBy("_hash")
    one = own.withColumn("_nth", F.row_number().over(nth)).where("_nth = 1")
    return one.select(*keys, *[F.col(f"_v{i}").alias(v) for i, v in enumerate(values)])
