"""Sheet sink: a text table with a header row."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame

from rateloom.operators.shape import all_to_string
from rateloom.sources.tables import SHEET_OPTIONS


def write_sheet_table(df: DataFrame, path: str, replace: bool = False) -> bool:
    """Write all cells as text. False, with nothing written, for an empty table or a taken path.

    ``replace`` overwrites an existing table. Emptiness is tested before writing, because by then an
    overwrite would have removed the old table; that test reads rows until it finds one.
    """
    if df.isEmpty():
        return False
    writer = all_to_string(df).write.options(**SHEET_OPTIONS)
    try:
        writer.mode("overwrite" if replace else "errorifexists").csv(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_ALREADY_EXISTS":
            return False
        raise
    return True
