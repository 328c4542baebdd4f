"""Language identification by unigram pieces, marginalised over all segmentations.

The pieces are those of a fixed public vocabulary. For every language the probability of each piece is
learned by expectation maximisation; the score of a word is the sum over all its segmentations into
pieces (a forward pass), the score of a text the product over its words.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rateloom.llm.common import map_batches, worker_state

#: About so many documents of each language are used to learn; a documented bound, not a limit on scoring.
SAMPLE_DOCS = 300
ROUNDS = 3
#: Words are cut into runs of so many letters, so that probabilities stay within doubles.
LONGEST_WORD = 48
UNKNOWN = 1e-7
#: Probabilities are kept times this to the power of the letters they cover.
SCALE = 16.0
SMOOTHING = 50.0
UNDETERMINED = "und"
REMEMBERED = 400_000


def vocabulary(path: str) -> list[str]:
    """The pieces of a sentencepiece model, without control and byte pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [
        model.id_to_piece(i)
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_byte(i) or model.is_unknown(i) or model.is_unused(i))
    ]


def letters(chunk: str) -> str:
    return chunk if chunk.isalpha() else "".join(c for c in chunk if c.isalpha())


def pieces_of(word: str) -> list[str]:
    """A word of letters as the runs that are segmented; the first carries the mark of a word's start."""
    word = "▁" + word
    return [word[i : i + LONGEST_WORD] for i in range(0, len(word), LONGEST_WORD)]


class Trie:
    """The pieces letter by letter, so that many places of many words are looked up at once."""

    def __init__(self, ids: dict[str, int]):
        self.n = len(ids)
        nodes, steps = {"": 0}, {}
        for piece in ids:
            for k in range(len(piece)):
                if piece[: k + 1] not in nodes:
                    nodes[piece[: k + 1]] = len(nodes)
                    steps[nodes[piece[:k]], piece[k]] = nodes[piece[: k + 1]]
        self.letters = np.array(sorted({ord(c) for _, c in steps}), np.int64)
        place = {chr(c): k for k, c in enumerate(self.letters.tolist())}
        keys = np.array([node * len(place) + place[c] for node, c in steps], np.int64)
        order = np.argsort(keys)
        # The last of each is that of no step.
        self.keys = np.append(keys[order], np.iinfo(np.int64).max)
        self.after = np.append(np.array(list(steps.values()), np.int64)[order], 0)
        self.piece = np.full(len(nodes), -1, np.int32)
        self.piece[[nodes[p] for p in ids]] = list(ids.values())

    def places(self, letters: np.ndarray) -> np.ndarray:
        """The numbers of letters by code point; -1 for those of no piece."""
        if not len(self.letters):
            return np.full(len(letters), -1, np.int64)
        at = np.minimum(np.searchsorted(self.letters, letters), len(self.letters) - 1)
        return np.where(self.letters[at] == letters, at, -1)


class Lattice:
    """All segmentations of many words: arcs (word, from, to, piece), sorted by where they end."""

    def __init__(self, words: list[str], ids: dict[str, int] | Trie, longest: int):
        trie = Trie(ids) if isinstance(ids, dict) else ids
        self.n, self.width = len(words), max(map(len, words), default=0)
        self.lengths = np.array([len(w) for w in words], np.int64)
        letter = trie.places(np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4"))
        row = np.repeat(np.arange(self.n), self.lengths)
        start = np.arange(len(row)) - np.repeat(np.cumsum(self.lengths) - self.lengths, self.lengths)
        left = self.lengths[row] - start
        unknown = np.ones(len(row), bool)
        at, node, found = np.arange(len(row)), np.zeros(len(row), np.int64), []
        for size in range(1, longest + 1):
            inside = left[at] >= size
            at, node = at[inside], node[inside]
            own = letter[at + size - 1]
            key = np.where(own < 0, -1, node * len(trie.letters) + own)
            step = np.searchsorted(trie.keys, key)
            there = trie.keys[step] == key
            at, node = at[there], trie.after[step[there]]
            piece = trie.piece[node]
            whole = piece >= 0
            found.append((at[whole], size, piece[whole]))
            if size == 1:
                unknown[at[whole]] = False
        # A letter that is no piece has the same chance in every language.
        rest = np.flatnonzero(unknown)
        found.append((rest, 1, np.full(len(rest), trie.n, np.int32)))
        at = np.concatenate([a for a, _, _ in found])
        end = start[at] + np.repeat([size for _, size, _ in found], [len(a) for a, _, _ in found])
        order = np.argsort((end * self.n + row[at]) * (self.width + 1) + start[at])
        self.row, self.start, self.end, self.piece = (
            x[order].astype(np.int32) for x in (row[at], start[at], end, np.concatenate([p for _, _, p in found]))
        )
        self.cuts = np.searchsorted(self.end, np.arange(self.width + 2))

    def forward(self, chances: np.ndarray) -> np.ndarray:
        """alpha[position, word, language]; ``chances`` by piece and language."""
        alpha = np.zeros((self.width + 1, self.n, chances.shape[1]))
        alpha[0] = 1.0
        for j in range(1, self.width + 1):
            s = slice(self.cuts[j], self.cuts[j + 1])
            reached = alpha[self.start[s], self.row[s]] * chances[self.piece[s]]
            for lang in range(chances.shape[1]):
                alpha[j, :, lang] = np.bincount(self.row[s], weights=reached[:, lang], minlength=self.n)
        return alpha

    def logs(self, chances: np.ndarray) -> np.ndarray:
        """Natural logarithm of each word's probability by language."""
        ends = self.forward(chances)[self.lengths, np.arange(self.n)]
        return np.log(np.maximum(ends, 1e-300)) - self.lengths[:, None] * np.log(SCALE)

    def counts(self, chances: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Expected uses of every piece, for one language."""
        alpha = self.forward(chances)[:, :, 0]
        beta = np.zeros_like(alpha)
        beta[self.lengths, np.arange(self.n)] = 1.0
        for j in range(self.width, 0, -1):
            s = slice(self.cuts[j], self.cuts[j + 1])
            np.add.at(beta, (self.start[s], self.row[s]), beta[j, self.row[s]] * chances[self.piece[s], 0])
        total = np.maximum(alpha[self.lengths, np.arange(self.n)], 1e-300)
        used = alpha[self.start, self.row] * chances[self.piece, 0] * beta[self.end, self.row]
        return np.bincount(
            self.piece, weights=used / total[self.row] * weights[self.row], minlength=len(chances)
        )


def scaled(chances: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Chances by piece and language times SCALE to the piece's letters, with the unknown letter last."""
    unknown = np.full((1, chances.shape[1]), UNKNOWN)
    return np.vstack([chances, unknown]) * SCALE ** np.append(sizes, 1)[:, None]


def fit_language(words: list[str], weights: np.ndarray, ids: dict[str, int], sizes: np.ndarray) -> np.ndarray:
    """Piece probabilities of one language from its words and how often they occur."""
    longest, n, trie = int(sizes.max()), len(ids), Trie(ids)
    parts = [Lattice(words[at : at + 20_000], trie, longest) for at in range(0, len(words), 20_000)]
    found = np.zeros(n + 1)
    for k, part in enumerate(parts):  # the start: pieces by how often they occur anywhere
        found += np.bincount(part.piece, weights=weights[k * 20_000 :][part.row], minlength=n + 1)
    for _ in range(ROUNDS):
        chances = (found[:n] + SMOOTHING / n) / (found[:n].sum() + SMOOTHING)
        table = scaled(chances[:, None], sizes)
        found = sum(p.counts(table, weights[k * 20_000 :][: p.n]) for k, p in enumerate(parts))
    return (found[:n] + SMOOTHING / n) / (found[:n].sum() + SMOOTHING)


def learn(docs: DataFrame, pieces: list[str], sample_docs: int = SAMPLE_DOCS) -> tuple[list[str], np.ndarray]:
    """Languages in order, and the chances of every piece by language.

    Learns from ``text`` and non-null ``lang`` of ``docs``. Of each language about ``sample_docs``
    documents are used, chosen by a hash of the text; what reaches the driver is one number per piece
    and language.
    """
    usable = docs.select("lang", "text").where("lang is not null and text is not null")
    per_lang = usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    share = F.pmod(F.xxhash64("text", F.lit("sample")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    # One row per language, as many as the model that the driver holds; texts aren't shuffled for it.
    chosen = usable.join(F.broadcast(per_lang), "lang").where(share * F.col("n") < F.lit(float(sample_docs)))
    words = (
        chosen.select("lang", F.explode(F.split(F.lower("text"), r"[^\p{L}]+")).alias("word"))
        .where("word != ''")
        .groupBy("lang", "word")
        .count()
    )
    ids = {p: i for i, p in enumerate(pieces)}
    sizes = np.array([len(p) for p in pieces])

    def fit(frame: pd.DataFrame) -> pd.DataFrame:
        runs = [(r, n) for w, n in zip(frame["word"], frame["count"]) for r in pieces_of(letters(w))]
        weights = np.array([n for _, n in runs], float)
        chances = fit_language([r for r, _ in runs], weights, ids, sizes)
        return pd.DataFrame({"lang": [frame["lang"].iloc[0]], "chances": [chances]})

    rows = words.groupBy("lang").applyInPandas(fit, "lang string, chances array<double>").collect()
    rows.sort(key=lambda r: r.lang)
    if not rows:
        return [], np.empty((len(pieces), 0))
    return [r.lang for r in rows], np.array([r.chances for r in rows]).T


class _Scores(dict):
    """Place of each chunk of text in a table of its log probabilities by language."""

    def __init__(self, trie, chances, longest):
        super().__init__()
        self.trie, self.chances, self.longest = trie, chances, longest
        self.new: list[str] = []
        self.logs = np.empty((0, chances.shape[1]))
        self.sizes = np.empty(0, np.int64)

    def __missing__(self, chunk):
        self.new.append(chunk)
        self[chunk] = place = len(self)
        return place

    def settle(self):
        added, sizes = [], []
        for at in range(0, len(self.new), 8192):
            runs, owner, size = [], [], []
            for k, chunk in enumerate(self.new[at : at + 8192]):
                word = letters(chunk)
                size.append(len(word))
                if word:
                    own = pieces_of(word)
                    runs += own
                    owner += [k] * len(own)
            logs = np.zeros((len(size), self.chances.shape[1]))
            if runs:
                found = Lattice(runs, self.trie, self.longest).logs(self.chances)
                np.add.at(logs, np.array(owner), found)
            added.append(logs)
            sizes += size
        if added:
            self.logs = np.vstack([self.logs, *added])
            self.sizes = np.append(self.sizes, sizes)
        self.new = []


def identify(docs: DataFrame, pieces: list[str], langs: list[str], chances: np.ndarray) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``lang_score``, the posterior of that language among all learned.

    All languages are equally likely beforehand. Texts that are null or hold no letter (and all texts,
    if nothing was learned) get ``und`` and 0.0. Columns of those two names are replaced. Nothing is
    shuffled; every whole text is scored.
    """
    plain = docs.select(*[c for c in docs.columns if c not in ("lang_pred", "lang_score")])
    schema = StructType([*plain.schema.fields, *StructType().add("lang_pred", "string").add("lang_score", "double")])
    names, at = schema.names, plain.columns.index("text")
    ids = {p: i for i, p in enumerate(pieces)}
    sizes = np.array([len(p) for p in pieces])
    # The table has one row per piece of the fixed vocabulary, whatever the data.
    known = docs.sparkSession.sparkContext.broadcast((Trie(ids), scaled(chances, sizes), int(sizes.max()), langs))
    model = uuid.uuid4().hex

    def predict(text: str | None, scores: _Scores) -> np.ndarray | None:
        if not text:
            return None
        return np.fromiter(map(scores.__getitem__, text.lower().split()), np.int64)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, table, longest, langs = known.value
        state = worker_state("language")
        if state.get("language", ("",))[0] != model:
            state["language"] = (model, _Scores(trie, table, longest))
        scores = state["language"][1]
        for b in batches:
            for start in range(0, b.num_rows, 256):
                part = b.slice(start, 256)
                places = [predict(t.as_py(), scores) for t in part.column(at)]
                scores.settle()
                preds, values = [], []
                for p in places:
                    if p is None or not langs or not scores.sizes[p].any():
                        preds.append(UNDETERMINED)
                        values.append(0.0)
                        continue
                    total = scores.logs[p].sum(axis=0)
                    chance = np.exp(total - total.max())
                    best = int(np.argmax(chance))
                    preds.append(langs[best])
                    values.append(float(chance[best] / chance.sum()))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(preds, pa.string()), pa.array(values, pa.float64())],
                    names=names,
                )
                if len(scores) > REMEMBERED:
                    scores = _Scores(trie, table, longest)
                    state["language"] = (model, scores)

    return map_batches(plain, schema, work)


def held_out(parts: int, part: int):
    """Whether the CRC-32 of the id as text leaves that remainder; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % parts == part


def identify_documents(docs: DataFrame, model_path: str, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """Learns from the documents that are not held out (CRC-32 of the id mod 4 is not 2), scores all."""
    pieces = vocabulary(model_path)
    langs, chances = learn(docs.where(~held_out(4, 2)), pieces, sample_docs)
    return identify(docs, pieces, langs, chances)


def keep_identified(docs: DataFrame, model_path: str, least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose language is found with a score of ``least``; an unset one is filled in."""
    found = identify_documents(docs, model_path)
    kept = found.where((F.col("lang_pred") != UNDETERMINED) & (F.col("lang_score") >= least))
    filled = F.coalesce(F.col("lang"), F.col("lang_pred")).alias("lang")
    return kept.select(*[filled if c == "lang" else F.col(c) for c in docs.columns])


