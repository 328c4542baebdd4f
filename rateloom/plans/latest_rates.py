r"""The latest-rates job: check the bases, parse the responses, write Parquet.

    PYTHONPATH=. spark-submit rateloom/plans/latest_rates.py \
        --responses LANDING --bases USD EUR --root OUT --prefix fx
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rateloom.plans.backfill import land
from rateloom.schemas import CURRENCY_CODES, LANDED
from rateloom.session import build_session
from rateloom.sinks.folders import children
from rateloom.sinks.parquet import write_parquet
from rateloom.sources.audit import judged, judged_landing, unusable_responses
from rateloom.sources.envelope import USABLE, latest_responses
from rateloom.sources.fx import rates_latest
from rateloom.sources.planning import ENDPOINTS, latest_rate_requests
from rateloom.sources.requests import Transport, fetch_responses


def check_bases(bases: Sequence[str], codes: Sequence[str] = tuple(CURRENCY_CODES)) -> list[str]:
    """The bases as a list; ValueError names those that are not on the list of codes."""
    unknown = sorted(set(bases) - set(codes))
    if unknown:
        raise ValueError(f"unknown base currencies: {', '.join(unknown)}")
    return list(bases)


def run_latest_rates(
    spark: SparkSession,
    responses: DataFrame,
    bases: Sequence[str],
    root: str,
    prefix: str,
    codes: Sequence[str] = tuple(CURRENCY_CODES),
    **options,
) -> tuple[str, DataFrame]:
    """Write the latest rates of ``bases``; returns where, and the responses that can't be used.

    Responses are picked by the base they were asked for, so others are never parsed. Of several polls
    of a base the last that the feed can use counts; failed and broken ones go to the audit and stop nothing.
    """
    asked: Column = F.try_element_at("params", F.lit("base"))
    chosen = responses.where(asked.isin(check_bases(bases, codes)))
    feed = "rates_latest"
    marked = judged_landing(chosen, [ENDPOINTS[feed]]) if "usable" in chosen.columns else judged(chosen, feed)
    good = latest_responses(marked.where(USABLE)).drop(USABLE)
    uri = write_parquet(rates_latest(good, on_error="drop"), root, prefix, **options)
    return uri, unusable_responses(chosen, "rates_latest")


def fetch_latest_rates(
    spark: SparkSession,
    bases: Sequence[str],
    transport: Transport,
    landing: str,
    root: str,
    prefix: str,
    symbols: Sequence[str] | None = None,
    codes: Sequence[str] = tuple(CURRENCY_CODES),
    filename: str | None = None,
    **options,
) -> tuple[str, DataFrame]:
    """Poll the latest rates of ``bases``, land the answers, write the table; returns as above.

    Every call is a poll of its own: it lands beside earlier ones, and the table is made of this one's
    answers and, for bases that failed now, of the last that didn't.
    """
    asked = spark.createDataFrame([(b,) for b in check_bases(bases, codes)], "base_currency string")
    requests = latest_rate_requests(asked, symbols)
    land(fetch_responses(requests, transport, **options), ENDPOINTS["rates_latest"], landing)
    return write_latest(requests, landing, bases, root, prefix, codes, filename=filename)


def write_latest(requests: DataFrame, landing: str, bases: Sequence[str], root: str, prefix: str, *args, **options):
    """The table of the last usable polls of ``requests`` in the landing folder; returns as above."""
    return run_latest_rates(requests.sparkSession, recent_polls(requests, landing), bases, root, prefix, *args, **options)


def recent_polls(requests: DataFrame, landing: str) -> DataFrame:
    """The landed polls of ``requests``, of as many of the last days as it takes for each to have a usable one.

    The days of the folder are walked back in steps of doubling length; each step reads the keys and
    verdicts of its days alone. So a poll costs what the days since the last good polls hold, not what was
    ever polled. A request that never had an answer makes the walk go to the first day.
    """
    spark, feed = requests.sparkSession, ENDPOINTS["rates_latest"]
    landed = spark.read.schema(LANDED).parquet(landing).where(F.col("feed") == feed)
    # No more requests than there are codes.
    keys = [r["request_key"] for r in requests.select("request_key").distinct().collect()]
    mine = landed.where(F.col("request_key").isin(keys))
    names = children(spark, f"{landing.rstrip('/')}/feed={feed}")
    days = sorted((n.removeprefix("request_date=") for n in names if n.startswith("request_date=2") or n.startswith("request_date=1")), reverse=True)
    back = 1
    while back < len(days):
        since = F.lit(days[back - 1]).cast("date")
        answered = mine.where((F.col("request_date") >= since) & F.col("usable")).select("request_key").distinct()
        if answered.count() == len(keys):
            return mine.where(F.col("request_date") >= since)
        back *= 2
    return mine


def main(argv: Sequence[str] | None = None) -> str:
    """Command line of the job; returns where the table is."""
    parser = argparse.ArgumentParser(description="Write the latest exchange rates as Parquet")
    parser.add_argument("--responses", required=True, help="landed responses (Parquet)")
    parser.add_argument("--bases", required=True, nargs="+", choices=CURRENCY_CODES)
    parser.add_argument("--root", required=True)
    parser.add_argument("--prefix", required=True)
    parser.add_argument("--shuffle-bytes", type=int, help="size of the chosen responses, for the shuffle")
    args = parser.parse_args(argv)
    spark = build_session("latest-rates", shuffle_bytes=args.shuffle_bytes)
    responses = spark.read.parquet(args.responses)
    return run_latest_rates(spark, responses, args.bases, args.root, args.prefix)[0]


if __name__ == "__main__":
    print(main())
