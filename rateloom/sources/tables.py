"""Sheet-like text tables and SQL sources."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, StructType

# Cells may hold quotes and line breaks, and blanks at either end count.
SHEET_OPTIONS = {
    "header": "true",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def read_sheet_table(
    spark: SparkSession,
    path: str,
    schema: dict[str, DataType] | StructType | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """A text table with a header row.

    With ``schema`` the listed columns are cast and the others stay text; without, types are
    inferred by a pass over the data. A blank cell is '' in a text column and null in any other. A
    missing or empty table gives no rows. Files are split, so that several tasks read a large one; cells
    that hold line breaks ask for ``multi_line``, which reads a file by one task.
    """
    if isinstance(schema, StructType):
        schema = {f.name: f.dataType for f in schema.fields}
    nothing = StructType()
    for name, dtype in (schema or {}).items():
        nothing.add(name, dtype)
    reader = spark.read.options(**SHEET_OPTIONS).option("multiLine", str(multi_line).lower())
    try:
        sheet = reader.option("inferSchema", str(schema is None).lower()).csv(path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], nothing)
    if not sheet.columns:
        return spark.createDataFrame([], nothing)
    unknown = sorted(set(schema or {}) - set(sheet.columns))
    if unknown:
        raise ValueError(f"no such columns in {path}: {', '.join(unknown)}")
    columns = []
    for f in sheet.schema.fields:
        dtype = (schema or {}).get(f.name, f.dataType)
        cell = F.col(f"`{f.name}`")
        cell = F.coalesce(cell, F.lit("")) if isinstance(dtype, StringType) else cell.cast(dtype)
        columns.append(cell.alias(f.name))
    return sheet.select(*columns)


def query(spark: SparkSession, text: str, views: dict[str, DataFrame] | None = None) -> DataFrame:
    """Run SQL over the session's tables and the given views.

    The views are there for this text only; a view of the session of the same name is put back.
    """
    views = views or {}
    before = {name: spark.table(name) for name in views if any(t.name == name.lower() and t.isTemporary for t in spark.catalog.listTables())}
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    try:
        return spark.sql(text)
    finally:
        for name in views:
            if name in before:
                before[name].createOrReplaceTempView(name)
            else:
                spark.catalog.dropTempView(name)


def query_jdbc(
    spark: SparkSession,
    url: str,
    text: str,
    partition_column: str | None = None,
    lower: str | None = None,
    upper: str | None = None,
    partitions: int = 1,
    **options: str,
) -> DataFrame:
    """Run SQL on a database server whose JDBC driver is on the class path.

    One connection reads the whole result unless a partition column with its bounds is named; the
    bounds only set the strides, rows outside them are read too.
    """
    reader = spark.read.format("jdbc").option("url", url).options(**options)
    if partition_column is None:
        return reader.option("query", text).load()
    return (
        reader.option("dbtable", f"({text}) q")
        .option("partitionColumn", partition_column)
        .option("lowerBound", lower)
        .option("upperBound", upper)
        .option("numPartitions", partitions)
        .load()
    )
