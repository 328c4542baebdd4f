"""Number parsing and small arithmetic with the feeds' edge rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spark reads '1d' and '2f' as doubles, so text is checked before it is cast.
_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_number_text(text: Column | str) -> Column:
    """True where the text is a plain decimal number; null counts as no number."""
    return F.coalesce(_col(text).rlike(_NUMBER), F.lit(False))


def text_to_double(text: Column | str) -> Column:
    """Text to double; null where the text is no plain number."""
    text = _col(text)
    return F.when(is_number_text(text), text.try_cast("double"))


def safe_ratio(a: Column | str, b: Column | str) -> Column:
    """``a / b``, and 0 where ``b`` is 0."""
    a, b = _col(a), _col(b)
    return F.when(b == 0, F.lit(0.0)).otherwise(a / b)


def zero_fill(value: Column | str, dtype: str = "double", enabled: bool = True) -> Column:
    """A missing price or size becomes 0 (``enabled=False`` keeps the null)."""
    value = _col(value).cast(dtype)
    return F.coalesce(value, F.lit(0).cast(dtype)) if enabled else value


def _bare_percent(cell: Column) -> Column:
    return F.translate(cell, ",%", "")


def normalize_percent(cell: Column | str) -> Column:
    """``'1,234.5%'`` to 12.345; null for blank cells and for text that is no number."""
    return text_to_double(_bare_percent(_col(cell))) / F.lit(100.0)


def percent_text(cell: Column | str) -> Column:
    """What ``normalize_percent`` leaves: '' for blank cells, the cell itself for non-numbers."""
    cell = _col(cell)
    return F.when(F.coalesce(cell.rlike(r"^\s*$"), F.lit(True)), F.lit("")).when(
        ~is_number_text(_bare_percent(cell)), cell
    )
