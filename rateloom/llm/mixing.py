"""Mixes sources to target weights with blocks of equal size, apportioned by Sainte-Laguë.

Every source is dealt into shards by a seeded hash, and the documents of a shard lie one after the other
in seeded order, cut into blocks of BLOCK words. The blocks of the whole mix go to the sources, and those
of a source to its shards, by the highest quotients size / (2k + 1). A shard gives its blocks as often as
its quota says: whole passes, and for the rest a run of blocks from a seeded place. So what is taken from
a document follows from where it lies, without a row per block.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rateloom.llm.common import written

WEIGHTS = (5, 2, 1)
MOST = 3
BLOCK = 16
SHARD_DOCS = 4096
SEED = "mix-1"
#: A word, in the regular expressions of Java and of DuckDB.
WORD = r"[^\x20\x09-\x0D]+"


def sainte_lague(votes: np.ndarray, caps: np.ndarray, seats: int) -> np.ndarray:
    """Seats by the highest quotients votes / (2k + 1), at most ``caps`` each; of equal quotients the
    first party's counts. A search for the divisor gives nearly all seats, the last ones go singly."""
    votes, caps = np.asarray(votes, float), np.asarray(caps, np.int64)
    caps = np.where(votes > 0, caps, 0)

    def given(cut: float) -> np.ndarray:
        return np.minimum(caps, np.floor((votes / cut + 1) / 2)).astype(np.int64)

    if not len(votes) or not caps.any():
        return np.zeros(len(votes), np.int64)
    low, high = 0.0, float(votes.max()) * 2
    for _ in range(200):
        mid = (low + high) / 2
        if mid in (low, high):
            break
        low, high = (low, mid) if given(mid).sum() <= seats else (mid, high)
    got = given(high)
    open_ = [(-votes[i] / (2 * got[i] + 1), i) for i in np.flatnonzero(got < caps)]
    heapq.heapify(open_)
    for _ in range(int(seats - got.sum())):
        if not open_:
            break
        _, i = heapq.heappop(open_)
        got[i] += 1
        if got[i] < caps[i]:
            heapq.heappush(open_, (-votes[i] / (2 * got[i] + 1), i))
    return got


def word_count(text: str = "text"):
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _hash32(text):
    return F.conv(F.left(F.md5(text), F.lit(8)), 16, 10).cast("long")


def targets(sources: DataFrame, weights: tuple = WEIGHTS, most: int = MOST) -> DataFrame:
    """``sources (source, source_size)`` with ``place`` and ``target``, what the mix shall hold of each.

    Weights go round by code point of the source, null last. All targets together are all sizes; one
    that would be above ``most`` times its source's size stops there and the excess goes to the others
    by weight. That is one level, target = level x weight, found by sorting the sources by the level at
    which they stop; of those still open the first has the highest level. The windows hold one row per source.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    listed = "array(" + ", ".join(map(str, weights)) + ")"
    ranked = sources.withColumn("place", F.row_number().over(order).cast("long")).withColumn(
        "weight", F.expr(f"element_at({listed}, cast((place - 1) % {len(weights)} as int) + 1)").cast("double")
    )
    stops = Window.orderBy(F.col("source_size") / F.col("weight"), "place")
    before, all_ = stops.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(F.lit(1))
    level = (F.sum("source_size").over(all_) - most * F.coalesce(F.sum("source_size").over(before), F.lit(0))) / (
        F.sum("weight").over(all_) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    )
    open_ = F.when(most * F.col("source_size") / F.col("weight") > F.col("level"), F.col("level"))
    return (
        ranked.withColumn("level", level)
        .withColumn("level", F.max(open_).over(all_))
        .withColumn(
            "target",
            F.coalesce(
                F.least(most * F.col("source_size").cast("double"), F.col("level") * F.col("weight")), F.lit(0.0)
            ),
        )
        .select("source", "source_size", "place", "target")
    )


def shard_plan(laid: DataFrame, weights: tuple = WEIGHTS, most: int = MOST, block: int = BLOCK) -> DataFrame:
    """``source_key, shard, source_size, target, blocks, passes, from_block, run`` of every shard.

    ``laid`` has ``source, source_key, shard, size``. Sources are apportioned in one task with a row
    per source, the shards of a source in one with a row per shard.
    """
    shards = written(
        laid.groupBy("source", "source_key", "shard").agg(F.sum("size").alias("words")), "shards"
    )
    sources = shards.groupBy("source", "source_key").agg(F.sum("words").alias("source_size"))
    aimed = targets(sources.select("source", "source_size"), weights, most).join(
        sources.select(F.col("source").alias("s"), "source_key"), F.col("source").eqNullSafe(F.col("s"))
    )

    def to_sources(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("place")
        seats = round(float(frame["source_size"].sum()) / block)
        caps = most * -(-frame["source_size"].to_numpy() // block)
        frame["seats"] = sainte_lague(frame["target"].to_numpy(), caps, seats)
        return frame[["source_key", "source_size", "target", "seats"]]

    seated = (
        aimed.select("source_key", "source_size", "place", "target")
        .withColumn("mix", F.lit(1))
        .groupBy("mix")
        .applyInPandas(to_sources, "source_key string, source_size long, target double, seats long")
    )

    def to_shards(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("shard")
        blocks = -(-frame["words"].to_numpy() // block)
        quota = sainte_lague(frame["words"].to_numpy(), most * blocks, int(frame["seats"].iloc[0]))
        frame["blocks"] = blocks
        frame["passes"] = quota // np.maximum(blocks, 1)
        frame["run"] = quota % np.maximum(blocks, 1)
        return frame[["source_key", "shard", "words", "source_size", "target", "blocks", "passes", "run"]]

    planned = (
        shards.select("source_key", "shard", "words")
        .join(seated, "source_key")
        .groupBy("source_key")
        .applyInPandas(
            to_shards,
            "source_key string, shard long, words long, source_size long, target double, blocks long, "
            "passes long, run long",
        )
    )
    at = _hash32(F.concat_ws("|", F.lit(SEED), "source_key", "shard")) % F.greatest("blocks", F.lit(1))
    return planned.withColumn("from_block", at)


def mix(docs: DataFrame, weights: tuple = WEIGHTS, most: int = MOST, block: int = BLOCK) -> DataFrame:
    """``docs`` with what the mix takes of every row.

    Adds ``size`` (words; null texts 0), ``source_size``, ``target``, ``taken`` (words, repeats counted),
    and where they lie: ``passes`` times the whole text and the words from ``a1`` up to ``b1`` and from
    ``a2`` up to ``b2``; these replace columns of the same names. Null sources are a source of their
    own, null ids an id. The same rows always give the same mix, however they are partitioned. A source
    without words has target 0. An empty table gives an empty one.
    """
    own = ["size", "source_size", "target", "taken", "passes", "a1", "b1", "a2", "b2"]
    names = [c for c in docs.columns if c not in own]
    kept = {c: f"__kept_{i}" for i, c in enumerate(names) if c not in ("doc_id", "text", "source")}
    plain = docs.select(*[F.col(c).alias(kept.get(c, c)) for c in names])
    n_shards = max(1, -(-docs.count() // SHARD_DOCS))
    place = F.md5(F.concat_ws("|", F.lit(SEED), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    laid = plain.withColumns(
        {
            "size": word_count(),
            "source_key": F.coalesce(F.concat(F.lit("="), "source"), F.lit("-")),
            "__place": place,
        }
    ).withColumn("shard", F.conv(F.left("__place", F.lit(8)), 16, 10).cast("long") % F.lit(n_shards))
    plan = written(shard_plan(laid, weights, most, block), "mix")
    line = Window.partitionBy("source_key", "shard").orderBy("__place", "doc_id", "size", F.xxhash64("text"))
    after = F.sum("size").over(line.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    first = F.col("from_block") * block
    last = F.least((F.col("from_block") + F.col("run")) * block, "words")
    wrapped = F.greatest(F.col("from_block") + F.col("run") - F.col("blocks"), F.lit(0)) * block

    def cut(x):
        return F.least(F.greatest(x - F.col("__start"), F.lit(0)), F.col("size"))

    return (
        laid.withColumn("__start", after - F.col("size"))
        .join(plan, ["source_key", "shard"])
        .withColumns({"a1": cut(first), "b1": cut(last), "a2": F.lit(0).cast("long"), "b2": cut(wrapped)})
        .withColumn(
            "taken", F.col("passes") * F.col("size") + F.col("b1") - F.col("a1") + F.col("b2") - F.col("a2")
        )
        .select(*[F.col(kept.get(c, c)).alias(c) for c in names], *own)
    )


def mixed_documents(docs: DataFrame, weights: tuple = WEIGHTS, most: int = MOST) -> DataFrame:
    """The mix as documents, in the columns of ``docs``: one row per document of which words are taken.

    Its text is the whole text once per pass, then the further words taken, on lines of their own;
    ``n_chars`` follows. Documents of which nothing is taken go.
    """
    kept = {c: f"__own_{i}" for i, c in enumerate(docs.columns) if c not in ("doc_id", "text", "source")}
    mixed = mix(docs.withColumnsRenamed(kept), weights, most).where("taken > 0")

    def part(a, b):
        words = F.slice(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), F.col(a).cast("int") + 1, (F.col(b) - F.col(a)).cast("int"))
        whole = (F.col(a) == 0) & (F.col(b) == F.col("size"))
        return F.when(F.col(b) > F.col(a), F.when(whole, F.col("text")).otherwise(F.array_join(words, " ")))

    text = F.concat_ws("\n", F.array_repeat("text", F.col("passes").cast("int")), part("a1", "b1"), part("a2", "b2"))
    done = mixed.withColumn("text", text)
    size = F.length("text").cast("long")
    return done.select(
        *[
            (size if c == "n_chars" else F.col(kept.get(c, c))).alias(c)
            for c in docs.columns
        ]
    )


def oracle(weights: tuple = WEIGHTS, most: int = MOST, block: int = BLOCK) -> str:
    """DuckDB SQL for ``doc_id, size, source_size, target, taken``; it enumerates all quotients."""
    listed = ", ".join(map(str, weights))
    return f"""
with sized as (
  select doc_id, source, coalesce('=' || source, '-') as source_key,
    coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::bigint as size,
    md5('{SEED}|' || coalesce(doc_id::varchar, '')) as place
  from documents),
laid as (
  select *, ('0x' || left(place, 8))::bigint
    % (select greatest(1, (count(*) + {SHARD_DOCS - 1}) // {SHARD_DOCS}) from documents) as shard from sized),
sources as (
  select source_key, sum(size)::bigint as source_size,
    row_number() over (order by source asc nulls last) as p,
    [{listed}][(row_number() over (order by source asc nulls last) - 1) % {len(weights)} + 1]::double as weight
  from laid group by source, source_key),
levels as (
  select *, ((sum(source_size) over ())::bigint
      - {most} * coalesce((sum(source_size) over stops)::bigint, 0))::double
    / (sum(weight) over () - coalesce(sum(weight) over stops, 0)) as level
  from sources window stops as (order by source_size / weight, p rows between unbounded preceding and 1 preceding)),
aimed as (
  select source_key, source_size, p, coalesce(least({most} * source_size::double, weight * (
      select max(level) from levels where {most} * source_size / weight > level)), 0.0) as target from levels),
seats as (
  select source_key, count(*) as seats from (
    select source_key, row_number() over (order by target / (2 * k + 1) desc, p) as r
    from (select *, unnest(range(0, {most} * ((source_size + {block - 1}) // {block}))) as k from aimed where target > 0))
  where r <= (select round(sum(source_size) / {block}) from aimed) group by source_key),
shards as (
  select source_key, shard, sum(size)::bigint as words, (sum(size)::bigint + {block - 1}) // {block} as blocks
  from laid group by source_key, shard),
quotas as (
  select q.source_key, shard, count(*) as quota from (
    select source_key, shard, row_number() over (partition by source_key order by words / (2 * k + 1) desc, shard) as r
    from (select *, unnest(range(0, {most} * blocks)) as k from shards where words > 0)) q
  join seats using (source_key) where r <= seats group by q.source_key, shard),
plans as (
  select s.*, coalesce(quota, 0) // greatest(blocks, 1) as passes, coalesce(quota, 0) % greatest(blocks, 1) as run,
    ('0x' || left(md5('{SEED}|' || source_key || '|' || shard), 8))::bigint % greatest(blocks, 1) as from_block
  from shards s left join quotas using (source_key, shard)),
lines as (
  select *, (sum(size) over (partition by source_key, shard order by place, doc_id, size
      rows between unbounded preceding and current row))::bigint - size as start from laid)
select doc_id, size, source_size, target, (passes * size
  + least(greatest(least((from_block + run) * {block}, words) - start, 0), size)
  - least(greatest(from_block * {block} - start, 0), size)
  + least(greatest(greatest(from_block + run - blocks, 0) * {block} - start, 0), size))::bigint as taken
from lines join plans using (source_key, shard) join aimed using (source_key)
"""
