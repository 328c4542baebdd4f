"""A quality classifier from compressed sizes.

Two zstandard dictionaries are built from good and from bad labelled text. A text is compressed with
either; the difference of the two sizes, per byte of the text, says which it resembles. Of text that repeats
itself, and so takes few bytes either way, no more bytes count than REPEATS times its compressed size.
A rising curve fitted
on labelled rows that the dictionaries didn't see turns it into the chance of a good label. Work grows with
the length of a text, whole texts are scored; equal texts have equal scores.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rateloom.llm.common import map_batches, worker_state

#: Documented bounds of what is learned from: documents of a label for the dictionaries, as many again
#: for the curve, and characters of each, from a place that a hash chooses.
SAMPLE_DOCS = 3000
SAMPLE_CHARS = 8000
DICTIONARY = 110 << 10
LEVEL = 3
#: Texts are compressed in stretches of so many bytes, each with the dictionary, so that what a long
#: text holds of its own doesn't replace it.
STRETCH = 2048
#: Text compresses some twofold; what compresses more than this repeats itself.
REPEATS = 4
THRESHOLD = 0.3


def remainder(parts: int):
    """CRC-32 of the id as text, modulo ``parts``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % parts


def _dictionary(texts: list[bytes], size: int = DICTIONARY) -> bytes:
    """Trained by zstandard; the texts themselves if they are too few or too short for that."""
    pieces = [t[i : i + STRETCH] for t in texts for i in range(0, len(t), STRETCH)]
    try:
        return zstandard.train_dictionary(size, pieces).as_bytes()
    except zstandard.ZstdError:
        return b"".join(texts)[-size:]


class Sizes:
    """Compressed sizes of a text under two dictionaries, as one normalised difference."""

    def __init__(self, good: bytes, bad: bytes):
        self.tools = []
        for raw in (good, bad):
            kind = zstandard.DICT_TYPE_AUTO if raw else zstandard.DICT_TYPE_RAWCONTENT
            held = zstandard.ZstdCompressionDict(raw, dict_type=kind)
            held.precompute_compress(level=LEVEL)
            self.tools.append(
                zstandard.ZstdCompressor(level=LEVEL, dict_data=held, write_content_size=False, write_dict_id=False)
            )

    def difference(self, text: bytes) -> float:
        """Positive if the good dictionary helps more; 0 for an empty text."""
        good = bad = 0
        for at in range(0, len(text), STRETCH):
            part = text[at : at + STRETCH]
            good += len(self.tools[0].compress(part))
            bad += len(self.tools[1].compress(part))
        return (bad - good) / min(len(text), REPEATS * (bad + good) / 2) if text else 0.0


def fit_curve(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Points of a rising curve from differences to the chance of a good label.

    Isotonic regression: neighbours are pooled as long as the earlier pool has the higher share of good
    labels. Every pool gives a point at its mean; between points the curve is straight.
    """
    pools: list[list[float]] = []  # rows, good ones, sum of differences
    for at in np.argsort(x, kind="stable").tolist():
        pools.append([1.0, float(y[at]), float(x[at])])
        while len(pools) > 1 and pools[-2][1] * pools[-1][0] >= pools[-1][1] * pools[-2][0]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    if not pools:
        return np.zeros(1), np.full(1, 0.5)
    rows, good, total = np.array(pools).T
    return total / rows, np.maximum.accumulate((good + 0.5) / (rows + 1))


def _labelled(docs: DataFrame, labels: DataFrame, sample_docs: int) -> list:
    """A bounded sample of labelled documents that are not held out: label, part, text."""
    marks = (
        labels.where("doc_id is not null and quality in (0, 1)")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"), F.max("quality").alias("other"))
        .where("quality = other")
        .withColumn("part", remainder(5))
        .where("part != 0")
    )
    # Remainder 4 fits the curve, 1 to 3 the dictionaries. Both in the proportions of the labels.
    role = F.when(F.col("part") == 4, "curve").otherwise("words").alias("role")
    marks = marks.select("doc_id", "quality", role)
    total = marks.groupBy("role", "quality").agg(F.count(F.lit(1)).alias("n"))
    chance = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    of_all = F.when(F.col("role") == "words", F.col("n")).otherwise(F.sum("n").over(Window.partitionBy("role")))
    # At most about twice ``sample_docs`` ids of either role, whatever the table's size.
    chosen = marks.join(
        F.broadcast(total.withColumn("of", of_all).drop("n")), ["role", "quality"]
    ).where(chance * F.col("of") < F.lit(float(sample_docs)))
    start = F.pmod(F.xxhash64("text"), F.greatest(F.length("text") - SAMPLE_CHARS, F.lit(0)) + 1).cast("int") + 1
    texts = docs.where("text is not null").select(F.col("doc_id").alias("id"), "text")
    # One text of each id, so that what reaches the driver is bounded by the ids.
    return (
        texts.join(F.broadcast(chosen), F.col("id") == F.col("doc_id"))
        .select("role", "quality", "id", F.substring("text", start, F.lit(SAMPLE_CHARS)).alias("text"))
        .groupBy("role", "quality", "id")
        .agg(F.min("text").alias("text"))
        .orderBy("role", "quality", "id")
        .collect()
    )


def learn(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> tuple:
    """The two dictionaries and the curve, from labelled documents that are not held out.

    Documents with both labels are left out. Without labels all scores are 0.5; with one label only,
    they follow its share in the sample.
    """
    rows = _labelled(docs, labels, sample_docs)
    words = {q: [r.text.encode() for r in rows if r.role == "words" and r.quality == q] for q in (0, 1)}
    good, bad = _dictionary(words[1]), _dictionary(words[0])
    sizes = Sizes(good, bad)
    held = [r for r in rows if r.role == "curve"] or rows
    x = np.array([sizes.difference(r.text.encode()) for r in held])
    return good, bad, fit_curve(x, np.array([r.quality for r in held], float))


def score(docs: DataFrame, model: tuple) -> DataFrame:
    """``docs`` with ``quality_score``, which it replaces; null texts count as empty. No row is shuffled."""
    plain = docs.select(*[c for c in docs.columns if c != "quality_score"])
    schema = StructType([*plain.schema.fields, *StructType().add("quality_score", "double")])
    names, at = schema.names, plain.columns.index("text")
    known, key = docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        good, bad, (points, chances) = known.value
        state = worker_state("quality")
        if state.get("quality", ("",))[0] != key:
            state["quality"] = (key, Sizes(good, bad))
        sizes = state["quality"][1]
        for b in batches:
            x = np.array([sizes.difference((t.as_py() or "").encode()) for t in b.column(at)])
            p = np.interp(x, points, chances)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(p, pa.float64())], names=names)

    return map_batches(plain, schema, work)


def score_documents(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """Every row of ``docs`` with ``held_out``, ``quality_score`` and ``quality_predicted``.

    Columns of these names are replaced; others, repeated rows and null ids are fine; an empty table
    gives an empty one.
    """
    own = ("held_out", "quality_predicted")
    scored = score(docs.select(*[c for c in docs.columns if c not in own]), learn(docs, labels, sample_docs))
    return scored.withColumns(
        {
            "held_out": remainder(5) == 0,
            "quality_predicted": (F.col("quality_score") >= THRESHOLD).cast("int"),
        }
    )
