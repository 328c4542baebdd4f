"""Calls at a pace, wave by wave: what a key may be asked for in a second is never exceeded, what has
landed is never asked for again."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from rateloom.functions import classify_response
from rateloom.plans.backfill import land, landed_of, outstanding
from rateloom.schemas import LANDED, REQUESTS
from rateloom.session import scratch_dir
from rateloom.sources.requests import Caller, Reply, Transport, batched, landing_arrow

#: A key that was told to slow down is asked for this part of its pace in the next wave, and for this
#: much more after a wave without such an answer, up to what was asked for.
SLOWER, FASTER = 0.5, 1.25


@dataclass
class Paced:
    """A transport that calls at the points of a grid: ``first``, and every ``step`` seconds after.

    A point is used once; one that has passed is lost, so that calls never catch up in a burst.
    """

    transport: Transport
    first: float
    step: float
    clock: Callable[[], float] = time.time
    sleep: Callable[[float], None] = time.sleep
    used: int = field(default=-1, init=False)

    def __call__(self, request: dict, attempt: int) -> Reply:
        now = self.clock()
        point = max(self.used + 1, -(-(now - self.first) // self.step))
        self.used = int(point)
        self.sleep(max(0.0, self.first + self.used * self.step - now))
        return self.transport(request, attempt)


def _dealt(requests: DataFrame, key: Column, shares: int) -> DataFrame:
    """``requests`` with ``_key`` and ``_share``, its place among the callers of the key."""
    share = F.pmod(F.xxhash64("request_key"), F.lit(shares)).cast("int")
    return requests.select(*REQUESTS.names, F.coalesce(key.cast("string"), F.lit("")).alias("_key"), share.alias("_share"))


def fetch_paced(
    dealt: DataFrame,
    transport: Transport,
    pace: dict[str, float],
    per_second: float,
    shares: int,
    run_id: str,
    start: float,
    **options,
) -> DataFrame:
    """One landing row per page of ``dealt`` requests; a key is called ``pace[key]`` times a second at most.

    The ``shares`` callers of a key have grids that lie between each other's, all from ``start`` on the
    clock of the machines. Every call takes a point of its caller's grid: pages, retries and repeats with
    new credentials as well.
    """

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        callers: dict[tuple[str, int], Caller] = {}

        def rows() -> Iterator[dict]:
            for batch in batches:
                for request in batch.to_pylist():
                    key, share = request.pop("_key"), request.pop("_share")
                    if (key, share) not in callers:
                        rate = pace.get(key, per_second)
                        paced = Paced(transport, start + share / rate, shares / rate)
                        callers[key, share] = Caller(paced, **{"max_attempts": 1, "run_id": run_id} | options)
                    yield from callers[key, share].pages(request)

        yield from batched(rows(), landing_arrow())

    # All requests of a caller are in one task, as its grid is.
    return dealt.repartition(shares, "_key", "_share").mapInArrow(fetch, LANDED)


def land_in_waves(
    requests: DataFrame,
    transport: Transport,
    landing: str,
    per_second: float,
    key: Column | None = None,
    wave_seconds: float = 60.0,
    shares: int = 4,
    max_attempts: int = 5,
    root: str | None = None,
    pause: Callable[[float], None] = time.sleep,
    **options,
) -> DataFrame:
    """Like ``land_responses``, for more calls than one run may make at once.

    ``key`` tells which requests share a limit (all, if it is left out). A wave holds what each key may be
    asked for in ``wave_seconds``; it is one job, and lands before the next begins. A job or executor that
    is lost repeats a wave at most, a run that broke off goes on with what is outstanding.
    Failed calls that may be tried again join the next wave, ``max_attempts`` times in all. After an
    answer of 429 a key goes on at half its pace, and slowly back. Per wave the driver sees two numbers a
    key.
    """
    spark = requests.sparkSession
    folder = scratch_dir(spark, "waves", root)
    key = F.lit("") if key is None else key
    run_id, pace = options.pop("run_id", uuid.uuid4().hex), {}
    for endpoint in sorted(r["endpoint"] for r in requests.select("endpoint").distinct().collect()):
        mine = f"{folder}/{uuid.uuid4().hex}"
        todo = outstanding(requests.where(F.col("endpoint") == endpoint), landing)
        dealt = _dealt(todo, key, shares)
        size = max(1, round(per_second * wave_seconds / shares))
        # A caller's requests are dealt to its waves by hash, so no task ranks all of a key.
        counts = dealt.groupBy("_key", "_share").agg(F.count(F.lit(1)).alias("n"))
        n_waves = F.greatest(F.ceil(F.col("n") / size), F.lit(1))
        spread = dealt.join(counts.withColumn("_waves", n_waves).drop("n"), ["_key", "_share"])
        wave = F.pmod(F.xxhash64("request_key", F.lit("wave")), F.col("_waves")).cast("int")
        spread.withColumn("wave", wave).drop("_waves").write.partitionBy("wave").parquet(f"{mine}/plan")
        plan = spark.read.schema(StructType([*dealt.schema.fields, StructField("wave", IntegerType())])).parquet(f"{mine}/plan")
        last = plan.agg(F.max("wave")).first()[0]
        if last is None:
            continue
        again, number = None, 0
        while number <= last or again is not None:
            now = plan.where(F.col("wave") == number).drop("wave").withColumn("_tried", F.lit(0))
            now = now if again is None else now.unionByName(again)
            now.write.parquet(f"{mine}/{number}-asked")
            now = spark.read.schema(now.schema).parquet(f"{mine}/{number}-asked")
            start = time.time() + 0.5
            # A run of its own: pages of two tries of a request don't mix.
            run = f"{run_id}-{number}"
            fetched = fetch_paced(now.drop("_tried"), transport, pace, per_second, shares, run, start, **options)
            # First beside the landing folder: what a wave brought decides the next one.
            fetched.write.parquet(f"{mine}/{number}-answers")
            answers = spark.read.schema(LANDED).parquet(f"{mine}/{number}-answers")
            land(answers, endpoint, landing)
            seen = now.join(answers.select("request_key", "status"), "request_key")
            told = seen.groupBy("_key").agg(F.count_if(F.col("status") == 429).alias("slow"), F.count(F.lit(1)).alias("n")).collect()
            for r in told:
                own = pace.get(r["_key"], per_second)
                pace[r["_key"]] = max(own * SLOWER, per_second / 64) if r["slow"] else min(own * FASTER, per_second)
            retry = classify_response(F.col("status"), attempt=F.col("_tried") + 1, max_attempts=max_attempts)["action"] == "retry"
            failed = seen.where(retry).withColumn("_tried", F.col("_tried") + 1).drop("status").dropDuplicates(["request_key"])
            failed.write.parquet(f"{mine}/{number}-again")
            again = spark.read.schema(failed.schema).parquet(f"{mine}/{number}-again")
            again = None if again.isEmpty() else again
            number += 1
            if again is not None and number > last:
                pause(min(wave_seconds, 1.0))
    return landed_of(requests, landing)
