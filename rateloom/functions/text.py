"""JSON text, tag strings and file kinds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DoubleType,
    FloatType,
    MapType,
    StructType,
    TimestampNTZType,
)

from rateloom.schemas import MIME_TYPES

_KEEP_NULLS = {"ignoreNullFields": "false"}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _double_text(value: Column) -> Column:
    """Double as text with exponents only below 1e-4 and from 1e16 on, written ``1e+20``."""
    text = value.cast("string")
    plain = F.rtrim(text.try_cast("decimal(38,20)").cast("string"), F.lit("0"))
    mantissa = F.regexp_replace(F.regexp_extract(text, r"^(.*)E", 1), r"\.0$", "")
    exponent = F.ltrim(F.regexp_extract(text, r"E(-?\d+)$", 1), F.lit("-"))
    return (
        F.when(text == "NaN", "nan")
        .when(text.endswith("Infinity"), F.replace(text, F.lit("Infinity"), F.lit("inf")))
        .when(~text.contains("E"), text)
        .when(
            (F.abs(value) >= 1e-4) & (F.abs(value) < 1e16),
            F.when(plain.endswith("."), F.concat(plain, F.lit("0"))).otherwise(plain),
        )
        .otherwise(
            F.concat(
                mantissa,
                F.lit("e"),
                F.when(text.contains("E-"), "-").otherwise("+"),
                F.when(F.length(exponent) < 2, F.concat(F.lit("0"), exponent)).otherwise(exponent),
            )
        )
    )


def json_columns(rows: Column | str, fields: list[str]) -> Column:
    """An array of structs as one JSON object of column lists: ``{"a":[...],"b":[...]}``."""
    rows = _col(rows)
    return F.when(
        rows.isNotNull(),
        F.to_json(F.struct(*[rows.getField(f).alias(f) for f in fields]), _KEEP_NULLS),
    )


def json_string(df: DataFrame, name: str) -> Column:
    """Column ``name`` of ``df`` as JSON text.

    Nested values become JSON, an array of structs (a small table in a cell) becomes an object of
    column lists, any other scalar becomes the JSON string of its text. Null stays null.
    """
    column, dtype = F.col(f"`{name}`"), df.schema[name].dataType
    if isinstance(dtype, ArrayType) and isinstance(dtype.elementType, StructType):
        return json_columns(column, dtype.elementType.fieldNames())
    if isinstance(dtype, (StructType, MapType, ArrayType)):
        return F.to_json(column, _KEEP_NULLS)
    if isinstance(dtype, BooleanType):
        text = F.initcap(column.cast("string"))
    elif isinstance(dtype, (DoubleType, FloatType)):
        text = _double_text(column)
    elif isinstance(dtype, TimestampNTZType):
        # A fraction has all six digits or is left out.
        text = column.cast("string")
        text = F.when(text.contains("."), F.rpad(text, 26, "0")).otherwise(text)
    else:
        text = column.cast("string")
    return F.when(column.isNotNull(), F.to_json(text.cast("variant")))


def _form_encode(text: Column) -> Column:
    # Java's encoder keeps '*' and escapes '~'; form encoding of tags wants it the other way.
    return F.replace(F.replace(F.url_encode(text), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def tag_string(tags: Column | str) -> Column:
    """A tag map as ``k1=v1&k2=v2``, form-encoded, in the map's own order."""
    pair = lambda e: F.concat(_form_encode(e["key"]), F.lit("="), _form_encode(e["value"]))
    return F.concat_ws("&", F.transform(F.map_entries(_col(tags)), pair))


def mime_type(path: Column | str) -> Column:
    """File kind by extension; unknown ones are plain bytes."""
    kinds = F.create_map(*[F.lit(x) for pair in MIME_TYPES.items() for x in pair])
    extension = F.lower(F.regexp_extract(_col(path), r"\.([^./]+)$", 1))
    return F.coalesce(F.try_element_at(kinds, extension), F.lit("application/octet-stream"))
