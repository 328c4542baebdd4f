"""Rates between any two codes, along the quotes that connect them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rateloom.session import scratch_dir


def quote_graph(rates: DataFrame) -> DataFrame:
    """``from_code, to_code, rate, at``: what a unit of one code is in another, and since when.

    ``rates`` has base_currency, target_currency, rate and rate_timestamp. Of several quotes of a pair the
    latest counts (of one time the highest rate); it counts both ways, unless the other way has a later quote
    of its own, or one of the same time. Quotes that are null or not above zero connect nothing.
    """
    good = rates.where("rate > 0 and base_currency != target_currency and rate_timestamp is not null")
    last = (
        good.groupBy("base_currency", "target_currency", "rate_timestamp")
        .agg(F.max("rate").alias("rate"))
        .groupBy("base_currency", "target_currency")
        .agg(F.max_by("rate", "rate_timestamp").alias("rate"), F.max("rate_timestamp").alias("at"))
    )
    own = last.select(F.col("base_currency").alias("from_code"), F.col("target_currency").alias("to_code"), "rate", "at", F.lit(1).alias("own"))
    turned = last.select(
        F.col("target_currency").alias("from_code"),
        F.col("base_currency").alias("to_code"),
        (F.lit(1.0) / F.col("rate")).alias("rate"),
        "at",
        F.lit(0).alias("own"),
    )
    best = F.max_by(F.struct("rate", "at"), F.struct("at", "own")).alias("q")
    return own.unionByName(turned).groupBy("from_code", "to_code").agg(best).select("from_code", "to_code", "q.*")


def path_rates(pairs: DataFrame, rates: DataFrame, max_hops: int = 6, root: str | None = None) -> DataFrame:
    """``from_currency, to_currency, rate, hops, rate_timestamp, path`` of the distinct ``pairs``.

    The path with the fewest quotes counts, and of several the one whose oldest quote is the latest, then the
    first by its codes; ``rate_timestamp`` is that oldest quote's time. A code is itself at a rate of 1 in
    0 hops, if any quote names it. Pairs that are not connected within ``max_hops`` have nulls.

    A round of the search adds one hop: an equi join of the codes reached last with the quotes, so a
    round moves at most one row per asked code, reached code and quote of it. Each round is a table in the
    shared folder (or under ``root``): later rounds and lost executors read it again. The search ends when
    every pair is found or nothing new is reached; what reaches the driver are two counts a round.
    """
    spark = pairs.sparkSession
    folder = scratch_dir(spark, "paths", root)

    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    graph = kept(quote_graph(rates), "graph")
    asked = kept(pairs.select("from_currency", "to_currency").distinct(), "pairs")
    codes = graph.select(F.col("from_code").alias("from_currency")).distinct()
    sources = asked.select("from_currency").distinct().join(codes, "from_currency", "left_semi")
    here = F.col("from_currency")
    start = sources.select(
        "from_currency", here.alias("code"), F.lit(1.0).alias("rate"), F.lit(0).alias("hops"),
        F.lit(None).cast(graph.schema["at"].dataType).alias("at"), here.alias("path"),
    )
    reached = last = kept(start, "hop-0")
    wanted = asked.withColumnRenamed("to_currency", "code")
    for hop in range(1, max_hops + 1):
        # Sources whose codes are all found go no further.
        left = wanted.join(reached, ["from_currency", "code"], "left_anti").select("from_currency").distinct()
        steps = (
            last.join(left, "from_currency", "left_semi")
            .join(
                graph.select(
                    F.col("from_code").alias("code"), F.col("to_code").alias("next"), F.col("rate").alias("step"), F.col("at").alias("step_at")
                ),
                "code",
            )
            .select(
                "from_currency",
                F.col("next").alias("code"),
                (F.col("rate") * F.col("step")).alias("rate"),
                F.lit(hop).alias("hops"),
                F.least("at", "step_at").alias("at"),
                F.concat_ws(">", "path", "next").alias("path"),
            )
        )
        new = steps.join(reached.select("from_currency", "code"), ["from_currency", "code"], "left_anti")
        # The latest of the oldest quotes, then the first path.
        oldest = new.groupBy("from_currency", "code").agg(F.max("at").alias("at"))
        first = F.min_by(F.struct("rate", "hops", "path"), "path").alias("b")
        best = new.join(oldest, ["from_currency", "code", "at"]).groupBy("from_currency", "code", "at").agg(first)
        last = kept(best.select("from_currency", "code", "b.rate", "b.hops", "at", "b.path"), f"hop-{hop}")
        if last.isEmpty():
            break
        reached = reached.unionByName(last)
    found = reached.withColumnsRenamed({"code": "to_currency", "at": "rate_timestamp"})
    return asked.join(found, ["from_currency", "to_currency"], "left").select(
        "from_currency", "to_currency", "rate", "hops", "rate_timestamp", "path"
    )
