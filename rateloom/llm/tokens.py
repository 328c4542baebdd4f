"""Token ids of whole texts with a public tokenizer, by the words of a slice of texts."""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from rateloom.llm.common import worker_state

#: Words that are joined for one call of the tokenizer, and letters of the longest of them.
AT_ONCE = 2000
LONGEST = 64
#: Bytes of chunks and their ids that are kept for the next slices.
KEPT_BYTES = 16 << 20
#: Punctuation that may come after the letters of a word: tokenizers cut between the two.
_TAIL = """.,!?;:%*$&#|"()-"""
#: All white space but the space and the line feed.
_ODD_SPACE = re.compile("[" + "".join(chr(c) for c in range(0x3001) if chr(c).isspace() and chr(c) not in " \n") + "]")
_SEPARATORS = re.compile("[\x1c-\x1f]")


def _strings(array: pa.StringArray) -> list[str]:
    return array.to_numpy(zero_copy_only=False).tolist()


def _taken_apart(chunks: pa.StringArray) -> tuple[pa.StringArray, pa.StringArray, pa.StringArray]:
    """Every chunk as a line feed or nothing, what is between, and the punctuation at its end."""
    line = pc.starts_with(chunks, "\n").to_numpy(zero_copy_only=False)
    kept = pc.binary_length(pc.utf8_rtrim(chunks, _TAIL)).to_numpy(zero_copy_only=False)
    ends = np.append(0, np.cumsum(pc.binary_length(chunks).to_numpy(zero_copy_only=False)))
    # The strings of one array, cut at more places.
    cuts = np.stack([ends[:-1], ends[:-1] + line, ends[:-1] + kept], axis=1).ravel()
    letters = pa.py_buffer(b"".join(pc.cast(chunks, pa.binary()).to_numpy(zero_copy_only=False)))
    cut = pa.StringArray.from_buffers(len(cuts), pa.py_buffer(np.append(cuts, ends[-1]).astype(np.int32)), letters)
    return tuple(cut.take(pa.array(np.arange(k, len(cuts), 3))) for k in range(3))


def _cut_before_spaces(texts: list[str]) -> tuple[pa.LargeStringArray, np.ndarray, np.ndarray]:
    """The chunks of all texts, with the space or line feed before them, where texts end in them, and which
    texts have to be encoded as a whole; these have no chunks."""
    strings = pa.array(texts, pa.large_string())
    whole = pc.match_substring_regex(strings, _ODD_SPACE.pattern).to_numpy(zero_copy_only=False).copy()
    raw, ends, space = _spaces(strings)
    # Two in a row are in one text, or the first of them ends one.
    whole[np.searchsorted(ends[1:], np.flatnonzero(space[1:] & space[:-1]), "right")] = True
    filled = np.flatnonzero(np.diff(ends))
    whole[filled[space[ends[filled + 1] - 1]]] = True
    if whole.any():
        raw, ends, space = _spaces(pa.array(["" if w else t for t, w in zip(texts, whole)], pa.large_string()))
        filled = np.flatnonzero(np.diff(ends))
    space[ends[filled]] = True
    starts = np.flatnonzero(space)
    chunks = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(np.append(starts, len(raw))), pa.py_buffer(raw))
    return chunks, np.searchsorted(starts, ends[1:]), whole


def _spaces(strings: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all strings, where each begins and ends, and which bytes are spaces or line feeds."""
    ends = np.frombuffer(strings.buffers()[1], np.int64, len(strings) + 1)
    raw = np.frombuffer(strings.buffers()[2] or b"", np.uint8)[: ends[-1]]
    return raw, ends, (raw == ord(" ")) | (raw == ord("\n"))


class _Parts:
    """Ids of distinct strings, one after the other, and where each begins."""

    def __init__(self):
        self.ids, self.sizes, self.n = [], [], 0

    def add(self, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Adds strings of ``sizes`` ids; returns their numbers."""
        self.ids.append(ids)
        self.sizes.append(sizes)
        self.n += len(sizes)
        return np.arange(self.n - len(sizes), self.n)

    def taken(self, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the strings in ``order``, and how many of each."""
        return taken(np.concatenate(self.ids), np.concatenate(self.sizes), order)


def taken(ids: np.ndarray, sizes: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of strings of ``sizes`` ids, one after the other, the ids of those in ``order``, and how many of each."""
    ends = np.append(0, np.cumsum(sizes, dtype=np.int64)) * ids.itemsize
    rows = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(ids)])
    found = rows.take(pa.array(order)).buffers()[2]
    return np.frombuffer(found or b"", ids.dtype), sizes[order]


class _Kept:
    """Distinct chunks and their ids, one after the other."""

    def __init__(self):
        self.chunks, self.ids, self.sizes = pa.array([], pa.string()), np.zeros(0, "<u4"), np.zeros(0, np.int32)

    def find(self, chunks: pa.StringArray) -> np.ndarray:
        """The numbers of distinct chunks; -1 for those that aren't kept."""
        if len(chunks) >= len(self.chunks):
            return pc.index_in(chunks, value_set=self.chunks).fill_null(-1).to_numpy(zero_copy_only=False).copy()
        # The fewer make the table that is looked up in: what is kept is asked for all of them.
        place = pc.index_in(self.chunks, value_set=chunks).fill_null(-1).to_numpy(zero_copy_only=False)
        number, there = np.full(len(chunks), -1, np.int32), np.flatnonzero(place >= 0)
        number[place[there]] = there
        return number

    def keep(self, seen: pa.StringArray, number: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
        """Keeps the short ones of a slice's distinct chunks ``seen`` as well, or only them if all are too many.
        ``ids`` and ``sizes`` are of the chunks kept so far and of more, ``number`` the place of each seen."""
        seen, number = self._short(seen, number)
        more = np.flatnonzero(number >= len(self.chunks))
        chunks = pa.concat_arrays([self.chunks, seen.take(pa.array(more))])
        order = np.append(np.arange(len(self.chunks)), number[more])
        if chunks.nbytes + 4 * int(sizes[order].sum()) > KEPT_BYTES:
            chunks, order = seen, number
            if chunks.nbytes + 4 * int(sizes[order].sum()) > KEPT_BYTES:
                chunks, order = seen.slice(0, 0), number[:0]
        self.chunks, (self.ids, self.sizes) = chunks, taken(ids, sizes, order)

    @staticmethod
    def _short(chunks: pa.StringArray, number: np.ndarray) -> tuple[pa.StringArray, np.ndarray]:
        short = np.flatnonzero(pc.less_equal(pc.binary_length(chunks), LONGEST).to_numpy(zero_copy_only=False))
        return chunks.take(pa.array(short)), number[short]


class Encoder:
    """Little-endian unsigned 32-bit ids of a text, the same as the tokenizer gives for it as a whole.

    A tokenizer that drops white space (``words``) is asked for every word between spaces, one
    that keeps it for every word with the space before it: neither joins anything across those cuts.
    Lines are cut apart as well, and punctuation after a word. Of a slice of texts every word is asked for
    once, and words of letters many at a time; where one ends is seen from the tokens. Texts for which that
    could differ (rare kinds and runs of white space) are encoded as a whole. Between slices a bounded
    number of words is kept, in arrays.
    """

    def __init__(self, path: str, words: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.words, self.kept = Tokenizer.from_file(path), words, _Kept()
        # What ends a word (or begins one, with the space before it), and what stands for a line feed, by id.
        vocabulary = self.tokenizer.get_vocab()
        self.edge = np.zeros(max(vocabulary.values()) + 1, bool)
        self.edge[[i for t, i in vocabulary.items() if (t.endswith("</w>") if words else t.startswith("Ġ"))]] = True
        self.line = np.zeros(len(self.edge), bool)
        self.line[[i for t, i in vocabulary.items() if t.startswith("Ċ")]] = True

    @staticmethod
    def of(path: str, words: bool) -> Encoder:
        state, key = worker_state("encoder"), f"{path}:{words}"
        if key not in state:
            state.clear()
            state[key] = Encoder(path, words)
        return state[key]

    def _cut(self, texts: list[str]) -> tuple[pa.LargeStringArray, np.ndarray, np.ndarray]:
        """The chunks of all texts, where texts end in them, and which texts have to be encoded as a whole."""
        if not self.words:
            return _cut_before_spaces(texts)
        whole = np.array([bool(_SEPARATORS.search(t)) for t in texts], bool)
        cut = [
            "" if w else " ".join(t.split()) if _ODD_SPACE.search(t) else t.replace("\n", " ")
            for t, w in zip(texts, whole)
        ]
        lists = pc.split_pattern(pa.array(cut, pa.large_string()), " ")
        return lists.flatten(), np.cumsum(pc.list_value_length(lists).to_numpy()), whole

    def _marked(self, chunks: pa.StringArray) -> pa.StringArray:
        """Where white space counts, a chunk that begins a line with the line feed before it, the first of a
        text with two, and all others without the space before them."""
        if self.words:
            return chunks
        first = pc.binary_join_element_wise("\n\n", chunks, "")
        line, space = pc.starts_with(chunks, "\n"), pc.starts_with(chunks, " ")
        return pc.if_else(space, pc.utf8_slice_codeunits(chunks, 1), pc.if_else(line, chunks, first))

    def _text(self, chunk: str) -> str:
        """What a marked chunk stands for."""
        if self.words:
            return chunk
        return chunk[2:] if chunk.startswith("\n\n") else chunk if chunk[:1] == "\n" else " " + chunk

    def _plain(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        ids = [e.ids for e in found]
        return np.array([i for own in ids for i in own], "<u4"), np.array([len(own) for own in ids], np.int64)

    def _bulk(self, words: list[str], line: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words of letters, after a space or line feed: of many at once, cut apart where words end or begin."""
        ids, sizes = [np.zeros(0, "<u4")], [np.zeros(0, np.int64)]
        lead = "" if self.words else "\n" if line else " "
        for at in range(0, len(words), AT_ONCE):
            some = words[at : at + AT_ONCE]
            joined = " ".join(some) if self.words else lead + lead.join(some)
            own = np.array(self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, "<u4")
            edges = np.flatnonzero((self.line if line else self.edge)[own])
            if len(edges) != len(some):
                own, size = self._plain([lead + w for w in some])
            else:
                size = np.diff(edges, prepend=-1) if self.words else np.diff(edges, append=len(own))
            ids.append(own)
            sizes.append(size)
        return np.concatenate(ids), np.concatenate(sizes)

    def _asked(self, words: pa.StringArray, parts: _Parts) -> np.ndarray:
        """The numbers of words of letters; those that aren't kept are asked for, each once."""
        coded = words.dictionary_encode()
        words = coded.dictionary
        number = self.kept.find(words if self.words else pc.binary_join_element_wise(" ", words, ""))
        new = np.flatnonzero(number < 0)
        number[new] = parts.add(*self._bulk(_strings(words.take(pa.array(new)))))
        return number[coded.indices.to_numpy()]

    def _numbers(self, chunks: pa.StringArray, parts: _Parts) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of the one or two parts of every distinct marked chunk; -1 for none."""
        first, second = np.full(len(chunks), -1, np.int32), np.full(len(chunks), -1, np.int32)
        # Most chunks are letters alone; only the others are taken apart.
        letters = pc.and_(pc.utf8_is_alpha(chunks), pc.less_equal(pc.binary_length(chunks), LONGEST))
        letters = letters.to_numpy(zero_copy_only=False)
        mixed = np.flatnonzero(~letters)
        line, head, tail = _taken_apart(chunks.take(pa.array(mixed)))
        is_word = pc.and_(pc.utf8_is_alpha(head), pc.less_equal(pc.utf8_length(head), LONGEST))
        is_word = is_word.to_numpy(zero_copy_only=False)
        at_line = pc.equal(line, "\n").to_numpy(zero_copy_only=False)
        if self.words:
            # Some letters become a letter and a mark, which goes with the punctuation after it.
            plain = pc.utf8_is_alpha(pc.utf8_lower(pc.utf8_normalize(head, form="NFC")))
            odd = pc.match_substring(head, "\u0130")
            is_word = is_word & ~at_line & plain.to_numpy(zero_copy_only=False) & ~odd.to_numpy(zero_copy_only=False)
        own = np.flatnonzero(letters)
        heads = head.take(pa.array(np.flatnonzero(is_word & ~at_line)))
        number = self._asked(pa.concat_arrays([chunks.take(pa.array(own)), heads]), parts)
        first[own], first[mixed[is_word & ~at_line]] = number[: len(own)], number[len(own) :]
        at = np.flatnonzero(is_word & at_line)
        if len(at):
            heads = head.take(pa.array(at)).dictionary_encode()
            first[mixed[at]] = parts.add(*self._bulk(_strings(heads.dictionary), True))[heads.indices.to_numpy()]
        ended = np.flatnonzero(is_word & pc.not_equal(tail, "").to_numpy(zero_copy_only=False))
        if len(ended):
            tails = tail.take(pa.array(ended)).dictionary_encode()
            second[mixed[ended]] = parts.add(*self._plain(_strings(tails.dictionary)))[tails.indices.to_numpy()]
        other = mixed[~is_word]
        texts = _strings(chunks.take(pa.array(other)))
        filled = np.array([bool(t) for t in texts], bool)
        if filled.any():
            first[other[filled]] = parts.add(*self._plain([self._text(t) for t in texts if t]))
        return first, second

    def _encoded(self, chunks: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of distinct chunks, and how many of each."""
        parts = _Parts()
        parts.add(self.kept.ids, self.kept.sizes)
        both = np.stack(self._numbers(self._marked(chunks), parts), axis=1)
        there = both >= 0
        ids, sizes = parts.taken(both[there])
        ends = np.append(0, np.cumsum(sizes))[np.cumsum(there.sum(axis=1))]
        return ids, np.diff(ends, prepend=0).astype(np.int32)

    def __call__(self, texts: list[str]) -> list[bytes]:
        cut, ends, whole = self._cut(texts)
        coded = cut.dictionary_encode()
        chunks = coded.dictionary.cast(pa.string())
        number = self.kept.find(chunks)
        unknown = np.flatnonzero(number < 0)
        number[unknown] = len(self.kept.sizes) + np.arange(len(unknown))
        ids, sizes = self._encoded(chunks.take(pa.array(unknown)))
        ids, sizes = np.append(self.kept.ids, ids), np.append(self.kept.sizes, sizes)
        order = number[coded.indices.to_numpy()]
        del cut, coded
        self.kept.keep(chunks, number, ids, sizes)
        ids, sizes = taken(ids, sizes, order)
        # Where texts end, over their chunks, over ids.
        ends = np.append(0, np.cumsum(sizes))[ends]
        raw = memoryview(ids).cast("B")
        done = [bytes(raw[4 * a : 4 * b]) for a, b in zip([0, *ends.tolist()], ends.tolist())]
        for k in np.flatnonzero(whole).tolist():
            done[k] = self._plain([texts[k]])[0].tobytes()
        return done
