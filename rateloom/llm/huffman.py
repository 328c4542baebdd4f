"""Canonical Huffman codes of limited length, and blocks of bits that are decoded by a table."""

from __future__ import annotations

import numpy as np

LIMIT = 18
#: Ids between two checkpoints of a block; all stretches of a block are decoded side by side.
STEP = 256


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Lengths of an optimal prefix code of at most ``limit`` bits (package-merge); 0 for unused ids.

    Of equal counts the smaller id is the rarer. A single used id gets one bit.
    """
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} ids don't fit codes of {limit} bits")
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.int64)
    levels, packages = [], np.empty(0, np.int64)
    for _ in range(limit):
        both = np.concatenate([leaves, packages])
        at = np.argsort(both, kind="stable")
        levels.append(at < len(leaves))
        both = both[at]
        both = both[: len(both) // 2 * 2]
        packages = both[::2] + both[1::2]
    need = 2 * len(leaves) - 2
    depth = np.zeros(len(leaves), np.int64)
    for is_leaf in reversed(levels):
        own = int(is_leaf[:need].sum())
        depth[:own] += 1
        need = 2 * (need - own)
    lengths[order] = depth
    return lengths


def codes_of(lengths: np.ndarray) -> np.ndarray:
    """The canonical codes: by length, then by id, each one more than the one before."""
    codes = np.zeros(len(lengths), np.uint64)
    used = np.flatnonzero(lengths)
    code, before = 0, 0
    for i in used[np.argsort(lengths[used], kind="stable")].tolist():
        code <<= int(lengths[i]) - before
        before = int(lengths[i])
        codes[i] = code
        code += 1
    return codes


def encode(ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[bytes, bytes]:
    """The bits of ``ids``, and the bits between checkpoints as little-endian 16-bit numbers."""
    if not len(ids):
        return b"", b""
    sizes = lengths[ids].astype(np.int64)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    bits = codes[ids] << (64 - (starts & 31) - sizes).astype(np.uint64)
    # Codes are shorter than a word of 32 bits, so a code starts in every word.
    word = starts >> 5
    first = np.flatnonzero(np.diff(word, prepend=-1))
    words = np.zeros(int(word[-1]) + 2, np.uint64)
    words[:-1] = np.bitwise_or.reduceat(bits >> np.uint64(32), first)
    words[1:] |= np.bitwise_or.reduceat(bits & np.uint64(0xFFFFFFFF), first)
    marks = np.append(starts[::STEP], ends[-1])
    payload = words.astype(">u4").tobytes()[: -(-int(ends[-1]) // 8)]
    return payload, np.diff(marks).astype("<u2").tobytes()


class Decoder:
    """Looks up the next bits in a table of all windows of the limit's length."""

    def __init__(self, lengths: np.ndarray, limit: int = LIMIT):
        self.limit = limit
        self.symbol = np.zeros(1 << limit, np.uint32)
        self.size = np.zeros(1 << limit, np.int64)
        used = np.flatnonzero(lengths)
        # In canonical order the windows of the codes lie one after the other.
        order = used[np.argsort(lengths[used], kind="stable")]
        spans = 1 << (limit - lengths[order].astype(np.int64))
        self.symbol[: spans.sum()] = np.repeat(order, spans)
        self.size[: spans.sum()] = np.repeat(lengths[order], spans)

    def __call__(self, payload: bytes, marks: bytes, n: int) -> np.ndarray:
        """The ``n`` ids of a block, as unsigned 32-bit numbers."""
        gaps = np.frombuffer(marks, "<u2").astype(np.int64)
        at = np.cumsum(gaps) - gaps
        spare = STEP * self.limit // 8 + 8
        raw = np.concatenate([np.frombuffer(payload, np.uint8), np.zeros(spare, np.uint8)]).astype(np.uint64)
        window = raw[:-3] << np.uint64(24) | raw[1:-2] << np.uint64(16) | raw[2:-1] << np.uint64(8) | raw[3:]
        out = np.empty((min(STEP, n), len(at)), "<u4")
        mask, shift = np.uint64(0xFFFFFFFF), np.uint64(32 - self.limit)
        for k in range(len(out)):
            place = ((window[at >> 3] << (at & 7).astype(np.uint64)) & mask) >> shift
            out[k] = self.symbol[place]
            at += self.size[place]
        return out.T.reshape(-1)[:n]
