"""Hard negatives from an inverted multi-index.

The components are cut into two halves, and a codebook for each half is fitted on a bounded sample. Every
vector belongs to the cell of its two nearest codes; blocks hold runs of cells, with the radius of every code
in the block. For a query, a half's score with any vector of a code lies within the code's own score and
the length of the query's half times the radius. A heap walks the cells of a block in the order of their
summed upper bounds, starting from the best pair of codes and always adding its neighbours (the
multi-sequence way), so that once the next cell's bound is below what is still needed, the result is certain.

First every anchor finds its positives, the best rows of its label: in its own block, then in all others
with the score found there as the least that counts. Each positive then opens a window of scores for its
negatives. The second walk leaves out cells that lie wholly above all windows of an anchor, and ends when
no window can gain from the next cell. The index decides what is looked at, never the result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rateloom.llm.common import batch, map_batches, written
from rateloom.llm.vector_blocks import NO_ID, Block, blocks_of, leading, matrix_of, meet, narrow, whole_rows, widened

SCALE = 256
EVERY = 100
POSITIVES = 5
NEGATIVES = 10
#: A negative's score, times 100, lies between these times its positive's.
WINDOW = (30, 90)
#: Every TURNED-th id has the next of LABELS labels.
TURNED, LABELS = 7, 10
#: Documented bounds of what the codebooks are fitted on: vectors, about, and rounds.
SAMPLE = 16_384
ROUNDS = 8
#: Codes of a half.
CODES = 32
#: Rows of the first cells that are scored at once; each further step takes twice as many.
FIRST_STEP = 128
#: Bounds are in double precision: they are widened by this share of what they are summed from.
SLACK = 1e-9
SEED = 13

_EXTRAS = ["label", "first", "second"]
_POSITIVES = "part int, cut int, at int, vec_id long, score long"
_POSITIVES_ARROW = pa.schema([("part", pa.int32()), ("cut", pa.int32()), ("at", pa.int32()), ("vec_id", pa.int64()), ("score", pa.int64())])
_NEGATIVES = "part int, cut int, at int, place int, vec_id long, score long"
_NEGATIVES_ARROW = pa.schema([*list(_POSITIVES_ARROW)[:3], ("place", pa.int32()), *list(_POSITIVES_ARROW)[3:]])


def _nearest(points: np.ndarray, codes: np.ndarray) -> np.ndarray:
    return ((codes * codes).sum(axis=1) - 2 * points @ codes.T).argmin(axis=1)


def codebook(points: np.ndarray, n_codes: int, rng: np.random.Generator) -> np.ndarray:
    """At most ``n_codes`` middles of the points, by k-means; the first are points, each likelier the farther
    it is from those before. One of zeros without points."""
    if not points.size:
        return np.zeros((1, points.shape[1]))
    chosen = [int(rng.integers(len(points)))]
    far = ((points - points[chosen[0]]) ** 2).sum(axis=1)
    while len(chosen) < n_codes and far.any():
        chosen.append(int(rng.choice(len(points), p=far / far.sum())))
        far = np.minimum(far, ((points - points[chosen[-1]]) ** 2).sum(axis=1))
    codes = points[chosen].astype(np.float64)
    for _ in range(ROUNDS):
        own = _nearest(points, codes)
        sums = np.zeros_like(codes)
        np.add.at(sums, own, points)
        sizes = np.bincount(own, minlength=len(codes))
        codes[sizes > 0] = sums[sizes > 0] / sizes[sizes > 0, None]
    return codes


def fit(rows: DataFrame, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """The codebooks of the two halves, from a sample chosen by hash."""
    chance = F.pmod(F.xxhash64("vec_id", "tie"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    some = rows.where(chance * F.lit(float(max(1, n_rows))) < F.lit(float(SAMPLE))).select("vec_id", "tie", "vector").limit(2 * SAMPLE)
    held = sorted((r["vec_id"] is None, r["vec_id"] or 0, r["tie"], bytes(r["vector"])) for r in some.collect())
    vectors = [widened(v) for *_, v in held]
    points = np.zeros((len(vectors), max(map(len, vectors), default=0)))
    for k, v in enumerate(vectors):
        points[k, : len(v)] = v
    rng, half = np.random.default_rng(SEED), points.shape[1] // 2
    return codebook(points[:, :half], CODES, rng), codebook(points[:, half:], CODES, rng)


def halves(matrix: np.ndarray, books: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The two halves of vectors: as long as the first codebook's codes, and the rest; never shorter than the codes."""
    widths = [b.shape[1] for b in books]
    if matrix.shape[1] < sum(widths):
        matrix = np.pad(matrix, ((0, 0), (0, sum(widths) - matrix.shape[1])))
    return matrix[:, : widths[0]], matrix[:, widths[0] :]


def _wide(codes: np.ndarray, width: int) -> np.ndarray:
    """Codes filled up with zeros, for vectors longer than any of the sample."""
    return np.pad(codes, ((0, 0), (0, width - codes.shape[1]))) if codes.shape[1] < width else codes


def with_cells(rows: DataFrame, books) -> DataFrame:
    """``rows`` with ``first`` and ``second``, the nearest codes of the two halves."""
    schema = pa.schema([("vec_id", pa.int64()), ("label", pa.int64()), ("tie", pa.int64()), ("vector", pa.binary()), ("first", pa.int64()), ("second", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = halves(matrix_of(b.column(3).to_pylist()).astype(np.float64), books.value)
            yield batch(schema, *b.columns, *(pa.array(_nearest(h, _wide(c, h.shape[1]))) for h, c in zip(x, books.value)))

    return map_batches(
        rows.select("vec_id", "label", "tie", "vector"), "vec_id long, label long, tie long, vector binary, first long, second long", work
    )


class Cells:
    """A block of vectors with its part of the index."""

    def __init__(self, row: dict, books: tuple[np.ndarray, np.ndarray]):
        self.block = Block(row, _EXTRAS)
        self.ids, self.labels = self.block.ids, self.block.numbers["label"]
        first, second = self.block.numbers["first"], self.block.numbers["second"]
        self.books, self.sides = books, []
        for own, codes, half in zip((first, second), books, halves(self.block.vectors, books)):
            used, code = np.unique(own, return_inverse=True)
            middles = _wide(codes, half.shape[1])[used]
            radius = np.zeros(len(used))
            np.maximum.at(radius, code, np.sqrt(((half - middles[code]) ** 2).sum(axis=1)))
            self.sides.append((middles, radius, code))
        cell = self.sides[0][2] * len(self.sides[1][0]) + self.sides[1][2]
        self.by_cell = np.argsort(cell, kind="stable")
        used, sizes = np.unique(cell, return_counts=True)
        ends = np.cumsum(sizes)
        self.rows = {int(c): self.by_cell[e - n : e] for c, n, e in zip(used, sizes, ends)}

    def bounds(self, query: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """The most and the least that a half of a vector can add to the score, by code, for both halves."""
        found = []
        for (middles, radius, _), own in zip(self.sides, halves(query[None].astype(np.float64), self.books)):
            own = own[0]
            width = max(middles.shape[1], len(own))
            middles, own = _wide(middles, width), np.pad(own, (0, width - len(own)))
            length = np.sqrt(own @ own)
            score, reach = middles @ own, length * radius
            slack = SLACK * (length * (np.sqrt((middles * middles).sum(axis=1)) + radius) + 1)
            found.append((score + reach + slack, score - reach - slack))
        return found

    def walk(self, query: np.ndarray, above: float = np.inf) -> Iterator[tuple[float, np.ndarray]]:
        """Places of vectors, cell after cell by falling bound, some at once: (bound of the first, places).

        No vector that comes later scores more than the bound. Cells wholly above ``above`` are left out.
        """
        (most1, least1), (most2, least2) = self.bounds(query)
        by1, by2 = np.argsort(-most1, kind="stable"), np.argsort(-most2, kind="stable")
        most1, most2 = most1[by1].tolist(), most2[by2].tolist()
        heap, wide = [(-most1[0] - most2[0], 0, 0)], len(by2)
        bound, held, size, step = None, [], 0, FIRST_STEP
        while heap:
            top, a, b = heapq.heappop(heap)
            if b + 1 < len(most2):
                heapq.heappush(heap, (-most1[a] - most2[b + 1], a, b + 1))
            if b == 0 and a + 1 < len(most1):
                heapq.heappush(heap, (-most1[a + 1] - most2[0], a + 1, 0))
            i, j = by1[a], by2[b]
            rows = self.rows.get(int(i) * wide + int(j))
            if rows is None or least1[i] + least2[j] > above:
                continue
            if not held:
                bound = -top
            held.append(rows)
            size += len(rows)
            if size >= step:
                yield bound, np.concatenate(held)
                held, size, step = [], 0, 2 * step
        if held:
            yield bound, np.concatenate(held)


class Asked:
    """The queries of a tile against a block: exact scores of any of its places."""

    def __init__(self, cells: Cells, queries: np.ndarray):
        self.cells = cells
        self.vectors, self.queries = cells.block.fitting(queries)

    def positives(self, k: int, label: int, known: int | None, own: int | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the best rows of ``label``, none below ``known``."""
        ids, scores, least = np.zeros(0, np.int64), np.zeros(0, self.queries.dtype), known
        for bound, places in self.cells.walk(self.queries[k]):
            if least is not None and bound < least:
                break
            places = places[self.cells.labels[places] == label]
            if own is not None:
                places = places[places != own]
            found = self.vectors[places] @ self.queries[k]
            if least is not None:
                places, found = places[found >= least], found[found >= least]
            ids, scores = np.append(ids, self.cells.ids[places]), np.append(scores, found)
            best = leading(scores, ids, POSITIVES)
            ids, scores = ids[best], scores[best]
            if len(ids) == POSITIVES:
                least = scores[-1] if least is None else max(least, scores[-1])
        return ids, scores

    def negatives(self, k: int, label: int, windows: list[tuple[int, int]]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each window (least, most) ids and scores of the best rows of other labels within it."""
        found = [(np.zeros(0, np.int64), np.zeros(0, self.queries.dtype)) for _ in windows]
        needed = [low if low <= high else np.inf for low, high in windows]
        for bound, places in self.cells.walk(self.queries[k], max((high for low, high in windows if low <= high), default=-np.inf)):
            if bound < min(needed):
                break
            places = places[self.cells.labels[places] != label]
            scores = self.vectors[places] @ self.queries[k]
            for w, (low, high) in enumerate(windows):
                own = (scores >= needed[w]) & (scores <= high)
                if own.any():
                    ids, held = np.append(found[w][0], self.cells.ids[places[own]]), np.append(found[w][1], scores[own])
                    best = leading(held, ids, NEGATIVES)
                    found[w] = ids[best], held[best]
                    if len(best) == NEGATIVES:
                        needed[w] = max(low, held[best[-1]])
        return found


def _ids(ids: np.ndarray) -> list:
    return [None if i == NO_ID else i for i in ids.tolist()]


def _at_home(blocks: DataFrame, books, every: int) -> DataFrame:
    """A tile per block with anchors, with the positives that the anchors find in their block."""
    schema = pa.schema(
        [("part", pa.int32()), ("cut", pa.int32()), ("at", pa.binary()), ("ids", pa.binary()), ("labels", pa.binary()), ("vectors", pa.binary())]
        + [("least", pa.list_(pa.int64())), ("found", pa.list_(pa.struct(list(_POSITIVES_ARROW))))]
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                cells = Cells(row, books.value)
                at = np.flatnonzero((cells.ids % every == 0) & (cells.ids != NO_ID))
                if not len(at):
                    continue
                part, cut = cells.block.place
                queries, labels = cells.block.whole[at], cells.labels[at]
                asked, least, found = Asked(cells, queries), [], []
                for k, place in enumerate(at.tolist()):
                    ids, scores = asked.positives(k, int(labels[k]), None, place)
                    least.append(int(scores[-1]) if len(ids) == POSITIVES else None)
                    found += [{"part": part, "cut": cut, "at": place, "vec_id": i, "score": int(s)} for i, s in zip(_ids(ids), scores)]
                yield batch(
                    schema, [part], [cut], *([x.astype(np.int64).tobytes()] for x in (at, cells.ids[at], labels)), [narrow(queries)], [least], [found]
                )

    row = "struct<part:int,cut:int,at:int,vec_id:bigint,score:bigint>"
    return map_batches(
        blocks, f"part int, cut int, at binary, ids binary, labels binary, vectors binary, least array<long>, found array<{row}>", work
    )


def _tile(row: dict) -> tuple:
    at, labels = (np.frombuffer(row[c], np.int64).tolist() for c in ("at", "labels"))
    return at, labels, widened(row["vectors"]).reshape(len(at), -1)


def positives_of(tiles: DataFrame, blocks: DataFrame, books) -> DataFrame:
    """``part, cut, at, vec_id, score, place``: the positives of every anchor, which stands at ``at``."""

    def work(parts: pa.Table, sent: pa.Table) -> pa.Table:
        rows = []
        for row in parts.to_pylist():
            cells = Cells(row, books.value)
            for tile in sent.to_pylist():
                if (tile["part"], tile["cut"]) == cells.block.place:
                    continue
                at, labels, queries = _tile(tile)
                asked = Asked(cells, queries)
                for k, place in enumerate(at):
                    ids, scores = asked.positives(k, labels[k], tile["least"][k], None)
                    rows += [{"part": tile["part"], "cut": tile["cut"], "at": place, "vec_id": i, "score": int(s)} for i, s in zip(_ids(ids), scores)]
        return pa.Table.from_pylist(rows, schema=_POSITIVES_ARROW)

    found = tiles.select(F.inline("found")).union(meet(tiles.drop("found", "ids"), blocks, _POSITIVES, work))
    order = Window.partitionBy("part", "cut", "at").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= POSITIVES)


def window_of(score: int) -> tuple[int, int]:
    """The least and the most whole score of a negative; nothing lies between them if the first is larger."""
    low, high = WINDOW
    return -(-low * score // 100), high * score // 100


def negatives_of(tiles: DataFrame, blocks: DataFrame, books, positives: DataFrame) -> DataFrame:
    """``part, cut, at, place, vec_id, score, rank``: the negatives of every anchor's positive number ``place``."""
    # At most POSITIVES rows for each query of a tile, and a tile has no more queries than a block rows.
    asked = positives.groupBy("part", "cut").agg(F.sort_array(F.collect_list(F.struct("at", "place", "score"))).alias("windows"))
    ready = tiles.drop("found", "least", "ids").join(asked, ["part", "cut"])

    def work(parts: pa.Table, sent: pa.Table) -> pa.Table:
        rows = []
        for row in parts.to_pylist():
            cells = Cells(row, books.value)
            for tile in sent.to_pylist():
                at, labels, queries = _tile(tile)
                windows: dict[int, list[tuple[int, tuple[int, int]]]] = {}
                for w in tile["windows"]:
                    windows.setdefault(w["at"], []).append((w["place"], window_of(w["score"])))
                asked = Asked(cells, queries)
                for k, place in enumerate(at):
                    own = windows.get(place, [])
                    if not own:
                        continue
                    for (positive, _), (ids, scores) in zip(own, asked.negatives(k, labels[k], [w for _, w in own])):
                        rows += [
                            {"part": tile["part"], "cut": tile["cut"], "at": place, "place": positive, "vec_id": i, "score": int(s)}
                            for i, s in zip(_ids(ids), scores)
                        ]
        return pa.Table.from_pylist(rows, schema=_NEGATIVES_ARROW)

    found = meet(ready, blocks, _NEGATIVES, work)
    order = Window.partitionBy("part", "cut", "at", "place").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= NEGATIVES)


def hard_negatives(table: DataFrame, scale: int = SCALE, every: int = EVERY) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for the rows whose
    ``vec_id`` is divisible by ``every``.

    Rows with a null label or vector, or a null or non-finite component, take no part; zero and empty
    vectors do. Shorter vectors count as filled up with zeros. Rows with a null id keep their label, are
    no anchors, and come last among equal scores. Repeated rows are rows of their own: copies of an
    anchor are positives of each other, and each has its own. A positive with a score of 0 takes negatives of score 0,
    one below 0 has none. An empty table gives no rows; other columns are ignored. Scores beyond 64 bits
    are an error.
    """
    spark = table.sparkSession
    turned = F.when(F.col("vec_id").cast("long") % TURNED == 0, (F.col("label").cast("long") + 1) % LABELS)
    plain = whole_rows(table.where("label is not null"), scale, {"label": F.coalesce(turned, F.col("label").cast("long"))})
    rows = written(plain, "whole-vectors")
    n_rows = rows.count()
    books = spark.sparkContext.broadcast(fit(rows, n_rows))
    blocks = written(blocks_of(with_cells(rows, books), ["first", "second"], _EXTRAS, n_rows), "cells")
    tiles = written(_at_home(blocks, books, every), "anchors")
    positives = written(positives_of(tiles, blocks, books), "positives")
    negatives = negatives_of(tiles, blocks, books, positives)
    keys = ["part", "cut", "at"]
    anchors = map_batches(
        tiles.select("part", "cut", "at", "ids"), "part int, cut int, at int, anchor_id long", _anchor_rows
    )
    named = positives.select(*keys, "place", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return (
        negatives.withColumnsRenamed({"vec_id": "negative_id", "score": "negative_score"})
        .join(named, [*keys, "place"])
        .join(anchors, keys)
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("part", pa.int32()), ("cut", pa.int32()), ("at", pa.int32()), ("anchor_id", pa.int64())])
    for b in batches:
        for row in b.to_pylist():
            at, ids = (np.frombuffer(row[c], np.int64) for c in ("at", "ids"))
            yield batch(schema, pa.array([row["part"]] * len(at), pa.int32()), pa.array([row["cut"]] * len(at), pa.int32()), pa.array(at.astype(np.int32)), pa.array(ids))


def oracle() -> str:
    low, high = WINDOW
    return f"""
with numbers as (
  select row_number() over () as r, vec_id, [floor({SCALE} * cast(x as double)) for x in embedding] as v,
    case when vec_id % {TURNED} = 0 then (label + 1) % {LABELS} else label end as label
  from embeddings
  where label is not null and embedding is not null and len([x for x in embedding if x is null or not isfinite(x)]) = 0
),
scored as (
  select a.r as anchor, a.vec_id as anchor_id, c.r, c.vec_id, a.label = c.label as same,
    cast(list_dot_product(a.v, c.v) as bigint) as score
  from numbers a join numbers c on a.r <> c.r where a.vec_id % {EVERY} = 0
),
positives as (
  select *, row_number() over (partition by anchor order by score desc, vec_id nulls last) as place
  from scored where same
),
ranked as (
  select p.anchor_id, p.vec_id as positive_id, n.vec_id as negative_id, p.score as positive_score, n.score as negative_score,
    row_number() over (partition by p.anchor, p.place order by n.score desc, n.vec_id nulls last) as rank
  from positives p join scored n on p.anchor = n.anchor
  where p.place <= {POSITIVES} and not n.same
    and {low} * p.score <= 100 * n.score and 100 * n.score <= {high} * p.score
)
select anchor_id, positive_id, cast(rank as integer) as rank, negative_id, positive_score, negative_score
from ranked where rank <= {NEGATIVES}
"""
