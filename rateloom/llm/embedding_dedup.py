"""Near-copies among embeddings by a forest of random-projection trees with spill.

Every tree splits the vectors again and again along random directions, near the median; vectors close to
a split go to both sides. "Close" follows the deviation of the node, but never falls below a share of how
far apart two linked vectors lie along a direction. The upper levels are fitted on a bounded sample and
every vector is placed; leaves that are still too large are split further with exact statistics of their
members. A node whose spread is near the linking distance is a dense group: no split pays, and it is
compared whole, in blocks of bounded size. Trees are added until a pair at the threshold is expected to
meet, wherever in the sample it is. All vectors of a
leaf are compared by cosine in double precision, and the links of all trees are united. A pair counts in
the first of its common leaves only, so no list of pairs is ever formed; a leaf gives counts and a
spanning forest of its links. Exact copies enter the forest once.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rateloom.llm.common import batch, components, linked_to, map_batches, written

THRESHOLD = 0.9
#: Trees at least; there are more where a pair at the threshold is likelier than MISSED to meet in none.
TREES = 6
MISSED = 0.01
#: Vectors of the sample that the upper levels are fitted on, about.
SAMPLE = 16_384
#: Members that a leaf should have; beyond LARGEST it is split further.
LEAF = 512
LARGEST = 4096
BLOCK = 2048
#: Spill: the half width of the overlap, as a part of the standard deviation along the direction.
SPILL = 0.2
#: The same at least, as a part of the standard deviation of linked vectors' distance along a direction.
LINKED_SPILL = 0.5
#: Where a node is split: near the median, or where the other parts are if a tight group holds the median.
PLACES = (0.5, 0.3, 0.7, 0.1, 0.9)
#: A split is none if comparing its children takes more than this part of the work of comparing the node.
LEAST_GAIN = 0.95
SEED = 7


def unit(values: np.ndarray) -> np.ndarray:
    """Rows of length 1, in double precision."""
    values = values.astype(np.float64)
    values /= np.abs(values).max(axis=1, keepdims=True)
    return values / np.sqrt((values * values).sum(axis=1, keepdims=True))


def usable(column: str = "embedding"):
    """Not null or empty, only finite components, not all of them zero."""
    finite = f"forall({column}, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))"
    return F.expr(f"coalesce({column} is not null and {finite} and exists({column}, x -> x != 0), false)")


def reach(dim: int, threshold: float = THRESHOLD) -> float:
    """The standard deviation, along random directions, of the distance of vectors at the threshold."""
    return float(np.sqrt(2 * max(1e-12, 1 - threshold) / dim))


def _below(x: np.ndarray) -> np.ndarray:
    """The normal distribution function, to three digits."""
    return (1 + np.tanh(0.7978846 * (x + 0.044715 * x**3))) / 2


def grow(
    points: np.ndarray, leaf: float, rng: np.random.Generator, threshold: float = THRESHOLD
) -> tuple[list[tuple], np.ndarray]:
    """Nodes of a tree over the sample: (direction, split, margin, left, right), or None for a leaf; and
    for every point the chance that a vector at the threshold from it shares a leaf with it."""
    nodes: list = [None]
    far, meets = reach(points.shape[1], threshold), np.zeros(len(points))
    todo = [(0, np.arange(len(points)), np.ones(len(points)))]
    while todo:
        at, own, chance = todo.pop()
        if len(own) <= leaf:
            meets[own] += chance
            continue
        direction = rng.standard_normal(points.shape[1])
        along = points[own] @ (direction / np.linalg.norm(direction))
        margin, ordered = float(max(SPILL * along.std(), LINKED_SPILL * far)), np.sort(along)
        splits = np.quantile(ordered, [rng.uniform(0.4, 0.6), *PLACES[1:]])
        sizes = np.searchsorted(ordered, splits + margin, "right"), len(own) - np.searchsorted(ordered, splits - margin)
        work = (sizes[0] / len(own)) ** 2 + (sizes[1] / len(own)) ** 2
        best = 0 if work[0] <= LEAST_GAIN else int(work.argmin())
        if work[best] > LEAST_GAIN:
            meets[own] += chance
            continue
        split = float(splits[best])
        left, right = along <= split + margin, along >= split - margin
        # The other vector is looked for left and right of the split, or up to the far end of the overlap.
        to_left = _below((split + np.where(right[left], 0, margin) - along[left]) / far)
        to_right = _below((along[right] - split + np.where(left[right], 0, margin)) / far)
        nodes[at] = (direction / np.linalg.norm(direction), split, margin, len(nodes), len(nodes) + 1)
        todo += [(len(nodes), own[left], chance[left] * to_left), (len(nodes) + 1, own[right], chance[right] * to_right)]
        nodes += [None, None]
    return nodes, meets


def grow_forest(
    points: np.ndarray, leaf: float, rng: np.random.Generator, trees: int = TREES, threshold: float = THRESHOLD
) -> list[list[tuple]]:
    """Trees until all but a hundredth of the points have a chance of MISSED or less to miss a link."""
    forest, misses = [], np.ones(len(points))
    while len(forest) < trees or np.quantile(misses, 0.99) > MISSED:
        nodes, meets = grow(points, leaf, rng, threshold)
        forest.append(nodes)
        misses *= 1 - np.minimum(meets, 1)
    return forest


def leaves_of(points: np.ndarray, nodes: list) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a point and a leaf it lies in."""
    rows, leaves, todo = [], [], [(0, np.arange(len(points)))]
    while todo:
        at, own = todo.pop()
        if not len(own):
            continue
        if nodes[at] is None:
            rows.append(own)
            leaves.append(np.full(len(own), at))
            continue
        direction, split, margin, left, right = nodes[at]
        along = points[own] @ direction
        todo += [(left, own[along <= split + margin]), (right, own[along >= split - margin])]
    return np.concatenate(rows), np.concatenate(leaves)


def place(
    classes: DataFrame, trees: int = TREES, sample: int = SAMPLE, leaf: int = LEAF, threshold: float = THRESHOLD
) -> DataFrame:
    """``cid, n, dim, embedding, codes`` of ``classes (cid, n, embedding)``: the leaves of every vector.

    ``codes`` number tree and leaf, and the dimension: vectors of different ones are never compared.
    """
    total = max(1, classes.count())
    chance = F.pmod(F.xxhash64("cid", F.lit("sample")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    # At most about ``sample`` vectors reach the driver.
    rows = classes.where(chance * F.lit(float(total)) < F.lit(float(sample))).select("embedding").toArrow()
    by_dim: dict[int, list] = {}
    for e in rows.column(0).to_pylist():
        by_dim.setdefault(len(e), []).append(e)
    forests = {}
    for dim, own in by_dim.items():
        points, rng = unit(np.array(own)), np.random.default_rng([SEED, dim])
        size = max(16.0, leaf * min(1.0, len(rows) / total))
        forests[dim] = grow_forest(points, size, rng, trees, threshold)
    known = classes.sparkSession.sparkContext.broadcast(forests)
    schema = pa.schema(
        [("cid", pa.int64()), ("n", pa.int64()), ("dim", pa.int32()), ("embedding", pa.list_(pa.float64())), ("codes", pa.list_(pa.int64()))]
    )

    def work(batches):
        for b in batches:
            sizes = np.array([len(e) for e in b.column(2)], np.int64)
            for dim in np.unique(sizes).tolist():
                own = b.filter(pa.array(sizes == dim))
                points = unit(own.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim))
                codes: list[list[int]] = [[] for _ in range(len(points))]
                for t, nodes in enumerate(known.value.get(dim, [[None]])):
                    for row, at in zip(*(x.tolist() for x in leaves_of(points, nodes))):
                        codes[row].append((dim << 48) + (t << 32) + at)
                yield batch(schema, own.column(0), own.column(1), [dim] * len(points), own.column(2), codes)

    slim = classes.select("cid", "n", F.col("embedding").cast("array<double>").alias("embedding"))
    return map_batches(slim, "cid long, n long, dim int, embedding array<double>, codes array<long>", work)


def _along(points: DataFrame, threshold: float) -> DataFrame:
    """``cid, code, along, far``: places of ``points (cid, code, embedding)`` along their leaf's direction,
    and how far linked vectors lie apart there."""
    schema = pa.schema([("cid", pa.int64()), ("code", pa.int64()), ("along", pa.float64()), ("far", pa.float64())])

    def work(batches):
        for b in batches:
            out = []
            for code, e in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                direction = np.random.default_rng([SEED, code & (2**63 - 1)]).standard_normal(len(e))
                out.append(float(unit(np.array([e]))[0] @ direction / np.linalg.norm(direction)))
            far = [reach(len(e), threshold) for e in b.column(2)]
            yield batch(schema, b.column(0), b.column(1), out, far)

    return map_batches(
        points.select("cid", "code", "embedding"), "cid long, code long, along double, far double", work
    )


def split_large(
    placed: DataFrame, largest: int = LARGEST, *, threshold: float = THRESHOLD
) -> tuple[DataFrame, DataFrame | None]:
    """``placed`` with all leaves split that are larger than ``largest`` and can be, level by level;
    and ``code, size`` of those that can't be (None if there are none)."""
    dense = None
    while True:
        sizes = placed.select(F.explode("codes").alias("code")).groupBy("code").agg(F.count(F.lit(1)).alias("size"))
        large = sizes.where(F.col("size") > largest)
        if dense is not None:
            large = large.join(dense.select("code"), "code", "left_anti")
        large = written(large, "large")
        if large.isEmpty():
            return placed, dense
        members = placed.select("cid", "embedding", F.explode("codes").alias("code"))
        along = written(_along(members.join(large.select("code"), "code"), threshold), "along")
        middle = along.groupBy("code").agg(
            F.percentile_approx("along", list(PLACES), 1000).alias("splits"),
            F.greatest(SPILL * F.stddev_pop("along"), LINKED_SPILL * F.max("far")).alias("margin"),
        )
        sided = along.join(middle, "code").select(
            "cid", "code", F.transform("splits", lambda s: F.col("along") <= s + F.col("margin")).alias("left"),
            F.transform("splits", lambda s: F.col("along") >= s - F.col("margin")).alias("right"),
        )
        share = lambda side, k: F.avg(F.col(side)[k].cast("double"))
        work = [share("left", k) * share("left", k) + share("right", k) * share("right", k) for k in range(len(PLACES))]
        gain = sided.groupBy("code").agg(F.count(F.lit(1)).alias("size"), F.array(*work).alias("work"))
        gain = gain.withColumn("least", F.array_min("work")).withColumn(
            "best", F.when(F.col("work")[0] <= LEAST_GAIN, 0).otherwise(F.array_position("work", F.col("least")) - 1).cast("int")
        )
        gain = written(gain, "gain")
        stuck = gain.where(F.col("least") > LEAST_GAIN).select("code", "size")
        dense = stuck if dense is None else dense.union(stuck)
        chosen = gain.where(F.col("least") <= LEAST_GAIN).select("code", "best")
        sided = sided.join(chosen, "code").select(
            "cid", "code", F.col("left")[F.col("best")].alias("left"), F.col("right")[F.col("best")].alias("right")
        )
        new = (
            sided.groupBy("cid")
            .agg(
                F.collect_list("code").alias("old"),
                F.flatten(
                    F.collect_list(
                        F.array_compact(
                            F.array(
                                F.when(F.col("left"), F.xxhash64("code", F.lit(0))),
                                F.when(F.col("right"), F.xxhash64("code", F.lit(1))),
                            )
                        )
                    )
                ).alias("new"),
            )
        )
        changed = F.when(F.col("old").isNull(), F.col("codes")).otherwise(
            F.array_union(F.array_except("codes", "old"), F.col("new"))
        )
        placed = written(placed.join(new, "cid", "left").withColumn("codes", changed).drop("old", "new"), "placed")


def _first_common(codes: list, code: int):
    """A function that tells which pairs of members have a common leaf before ``code``."""
    earlier = [np.array([c for c in own if c < code], np.int64) for own in codes]
    width = max(map(len, earlier), default=0)
    table = np.zeros((len(earlier), width), np.int64)
    there = np.zeros((len(earlier), width), bool)
    for k, own in enumerate(earlier):
        table[k, : len(own)], there[k, : len(own)] = own, True

    def few(i, j):
        same = (table[i][:, :, None] == table[j][:, None, :]) & there[i][:, :, None] & there[j][:, None, :]
        return same.any(axis=(1, 2))

    def many(i, j):
        rows, columns = np.unique(i), np.unique(j)
        used = np.unique(table[rows][there[rows]])
        seen = np.zeros((len(rows), len(columns)), bool)
        for at in range(0, len(used), 2048):
            part = used[at : at + 2048]

            def held(members):
                out = np.zeros((len(members), len(part)), np.float32)
                k, slot = np.nonzero(there[members] & np.isin(table[members], part))
                out[k, np.searchsorted(part, table[members][k, slot])] = 1
                return out

            seen |= held(rows) @ held(columns).T > 0
        return seen[np.searchsorted(rows, i), np.searchsorted(columns, j)]

    return lambda i, j: few(i, j) if len(i) * width * width <= 1 << 22 else many(i, j)


def compare_leaf(frame: pd.DataFrame, threshold: float = THRESHOLD) -> pd.DataFrame:
    """``cid, links, root`` of members with links: how many vectors of other classes are linked for the
    first time in this leaf (or pair of blocks of it), and the member it hangs on."""
    frame = frame.sort_values(["cid"], kind="stable").reset_index(drop=True)
    low, high, own = (frame[c].to_numpy() for c in ("low", "high", "own"))
    left = np.flatnonzero(own == low)
    right = left if low[0] == high[0] else np.flatnonzero(own == high)
    points, weight = unit(np.stack(frame["embedding"].to_numpy())), frame["n"].to_numpy()
    links, root, common = np.zeros(len(frame), np.int64), np.arange(len(frame)), None
    for at in range(0, len(left), 512):
        near = points[left[at : at + 512]] @ points[right].T >= threshold
        i, j = np.nonzero(near)
        i, j = left[at + i], right[j]
        if right is left:
            i, j = i[i < j], j[i < j]
        if not len(i):
            continue
        root = linked_to(root, i, j)
        common = common or _first_common(frame["codes"].tolist(), int(frame["code"].iloc[0]))
        for k in range(0, len(i), 1 << 20):
            x, y = i[k : k + (1 << 20)], j[k : k + (1 << 20)]
            new = ~common(x, y)
            np.add.at(links, x[new], weight[y[new]])
            np.add.at(links, y[new], weight[x[new]])
    cid = frame["cid"].to_numpy()
    told = (links > 0) | (root != np.arange(len(root)))
    return pd.DataFrame({"cid": cid[told], "links": links[told], "root": cid[root[told]]})


def near_embeddings(
    table: DataFrame, threshold: float = THRESHOLD, trees: int = TREES, sample: int = SAMPLE, leaf: int = LEAF
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` per row of ``table (vec_id, embedding, ...)``.

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing, as do
    vectors of different lengths. Rows that repeat are vectors of their own and link with each other.
    Null ids never are the smallest of a component while there are others; other columns don't matter;
    an empty table gives an empty one.
    """
    plain = table.select("vec_id", "embedding")
    good = plain.where(usable())
    classes = written(
        good.groupBy("embedding")
        .agg(F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("first_id"))
        .withColumn("cid", F.monotonically_increasing_id()),
        "classes",
    )
    placed = written(place(classes, trees, sample, leaf, threshold), "placed")
    placed, dense = split_large(placed, threshold=threshold)
    members = placed.select("cid", "n", "embedding", "codes", F.explode("codes").alias("code"))
    if dense is None:
        dealt = members.withColumns({"own": F.lit(0), "low": F.lit(0), "high": F.lit(0)})
    else:
        blocks = F.coalesce(F.ceil(F.col("size") / BLOCK), F.lit(1))
        dealt = (
            members.join(dense, "code", "left")
            .withColumn("blocks", blocks.cast("int"))
            .withColumn("own", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .withColumns({"low": F.least("own", "other"), "high": F.greatest("own", "other")})
            .drop("size", "blocks", "other")
        )
    found = written(
        dealt.groupBy("code", "low", "high").applyInPandas(
            lambda frame: compare_leaf(frame, threshold), "cid long, links long, root long"
        ),
        "links",
    )
    reached = components(found.select(F.col("cid").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("cid").agg(F.sum("links").alias("links"))
    named = (
        classes.join(links, "cid", "left")
        .join(reached.withColumnRenamed("node", "cid"), "cid", "left")
        .withColumn("component", F.coalesce("component", "cid"))
        .withColumn("n_links", F.coalesce("links", F.lit(0)) + F.col("n") - 1)
    )
    least = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    by_class = named.join(least, "component").select("embedding", "n_links", "component_id")
    linked = good.join(by_class, "embedding").select("vec_id", "n_links", "component_id")
    alone = plain.where(~usable()).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
