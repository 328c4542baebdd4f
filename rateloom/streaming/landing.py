"""Incremental loads: new response files into a landing table, and from there into a feed's table."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from rateloom.schemas import LANDED


_BAD = "_bad"


def read_landing_stream(spark: SparkSession, source: str, max_files: int | None = None) -> DataFrame:
    """Landed response files (JSON lines) as a stream; ``max_files`` bounds a micro-batch.

    ``_line`` is the line as it came, ``_file`` where from. A line that is no response, or has no
    request key, is ``_rejected``.
    """
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    layout = StructType([*LANDED.fields, StructField(_BAD, StringType())])
    row = F.from_json("value", layout, {"columnNameOfCorruptRecord": _BAD})
    lines = reader.text(source).select(
        F.col("value").alias("_line"), F.col("_metadata.file_path").alias("_file"), row.alias("_row")
    )
    bad = F.col(f"_row.{_BAD}").isNotNull() | F.col("_row.request_key").isNull()
    return lines.select("_row.*", "_line", "_file", bad.alias("_rejected")).drop(_BAD)


def dedupe_stream(responses: DataFrame, delay: str = "1 day", spread: int = 1) -> DataFrame:
    """Every response once, however often it is delivered within ``delay`` of its arrival.

    A response is known by its request, run, page, fetch time and status: polls of one request are
    different responses, and ``latest_responses`` chooses between them. The watermark follows the time
    of the micro-batch, not ``fetched_at``: a response that is delivered late would otherwise be taken
    for expired and lost. Copies of one response meet in one task. Where responses are sent over and over,
    ``spread`` drops copies within that many shares first, at the price of a second state: the share
    follows from the file, not from a random number, so a repeated task puts a row where it was before.
    """
    share = F.pmod(F.xxhash64("_file"), F.lit(spread)).cast("int")
    identity = ["request_key", "run_id", "page", "fetched_at", "status"]
    arrived = responses.withColumns({"_share": share, "_arrived": F.current_timestamp()}).withWatermark("_arrived", delay)
    if spread > 1:
        arrived = arrived.dropDuplicatesWithinWatermark([*identity, "_share"])
    return arrived.dropDuplicatesWithinWatermark(identity).select(*LANDED.names)


def run_landing(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    delay: str = "1 day",
    max_files: int | None = None,
    partitions: int | None = None,
    rejects: str | None = None,
) -> StreamingQuery:
    """Load what is new under ``source`` into ``target`` and stop. Run it again to load more.

    Lines that are no responses never land; with ``rejects`` they are kept there as they came, with
    their file, by a stream of their own. The first run fixes the number of state partitions for the
    checkpoint: ``partitions``, or the session's shuffle setting.
    """
    read = read_landing_stream(spark, source, max_files)
    if rejects:
        bad = read.where("_rejected").select(F.col("_line").alias("line"), F.col("_file").alias("file"))
        _writer(bad, rejects, f"{checkpoint.rstrip('/')}-rejects").start().awaitTermination()
    writer = _writer(dedupe_stream(read.where("not _rejected"), delay), target, checkpoint)
    # Expired state is dropped along with the next data; no output waits for it.
    settings = {"spark.sql.streaming.noDataMicroBatches.enabled": "false"}
    if partitions:
        settings["spark.sql.shuffle.partitions"] = str(partitions)
    query = _start(spark, writer, settings)
    query.awaitTermination()
    return query


def _writer(rows: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    to = rows.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return to.trigger(availableNow=True)


def _start(spark: SparkSession, writer: DataStreamWriter, settings: dict[str, str]) -> StreamingQuery:
    """Start a query under some settings: it takes its own copy of them, the session keeps its own."""
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        return writer.start()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def run_feed(
    spark: SparkSession,
    landing: str,
    target: str,
    checkpoint: str,
    parse: Callable[[DataFrame], DataFrame],
    partition_by: Sequence[str] = (),
    max_files: int | None = None,
) -> StreamingQuery:
    """Parse what is new in the landing table with a feed's parser, add it to ``target``, and stop.

    ``parse`` is one of the parsers of ``rateloom.sources``, told to drop unusable responses: they
    stay in the landing table, for the audit.
    """
    reader = spark.readStream.schema(LANDED)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    writer = _writer(parse(reader.parquet(landing)), target, checkpoint)
    query = (writer.partitionBy(*partition_by) if partition_by else writer).start()
    query.awaitTermination()
    return query
