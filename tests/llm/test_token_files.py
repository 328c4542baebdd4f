import heapq
import random
import tracemalloc
import uuid
import zlib

import numpy as np
import public_tokenizers
import pytest
from helpers import docs
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rateloom.llm import huffman, token_files as op, tokens
from rateloom.llm.queries import op9_token_files

PATH = public_tokenizers.path("byte_bpe_50k.json")


def plain_cost(counts):
    """Bits of an unlimited Huffman code."""
    heap, cost = [int(c) for c in counts if c], 0
    heapq.heapify(heap)
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        cost += both
        heapq.heappush(heap, both)
    return cost


def test_code_lengths():
    rng = random.Random(3)
    for _ in range(100):
        counts = np.array([rng.choice([0, 1, 1, 3, rng.randint(1, 1000)]) for _ in range(rng.randint(2, 60))])
        lengths = huffman.code_lengths(counts, 18).astype(int)
        if (counts > 0).sum() < 2:
            continue
        assert (lengths[counts > 0] * counts[counts > 0]).sum() == plain_cost(counts)
        assert sum(2.0 ** -n for n in lengths[counts > 0]) == 1.0 and not lengths[counts == 0].any()
    steep = 2 ** np.arange(30)
    assert huffman.code_lengths(steep, 6).max() == 6
    assert sum(2.0 ** -int(n) for n in huffman.code_lengths(steep, 6)) <= 1.0
    assert huffman.code_lengths(np.array([0, 7, 0])).tolist() == [0, 1, 0]
    with pytest.raises(ValueError):
        huffman.code_lengths(np.ones(5, int), 2)


def test_limited_code_is_optimal():
    """Against all length vectors of small codes."""
    from itertools import product

    for counts in ([1, 1, 2, 4, 8], [1, 2, 4, 8, 16, 32], [5, 5, 5, 5, 5], [1, 1, 1, 100]):
        best = min(
            sum(c * n for c, n in zip(counts, own))
            for own in product(range(1, 4), repeat=len(counts))
            if sum(2.0**-n for n in own) <= 1
        )
        got = huffman.code_lengths(np.array(counts), 3).astype(int)
        assert (got * counts).sum() == best


def test_round_trip_of_blocks():
    rng = np.random.default_rng(1)
    for n in (0, 1, 255, 256, 257, 5000):
        ids = np.minimum(rng.zipf(1.3, n), 50_000).astype(np.uint32)
        counts = np.bincount(np.append(ids, [3, 50_256]))
        lengths = huffman.code_lengths(counts)
        payload, marks = huffman.encode(ids, lengths, huffman.codes_of(lengths))
        assert huffman.Decoder(lengths)(payload, marks, n).tolist() == ids.tolist()
    codes = sorted(f"{c:0{n}b}" for c, n in zip(huffman.codes_of(lengths), lengths) if n)
    assert not any(b.startswith(a) for a, b in zip(codes, codes[1:]))


def check(rows, texts):
    """texts: (doc_id, text) in the order of the file."""
    tokenizer, start = Tokenizer.from_file(PATH), 0
    for row, (i, text) in zip(sorted(rows, key=lambda r: r.start), texts, strict=True):
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        assert (row.doc_id, row.start, row.n_tokens, row.ids_crc32) == (i, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_cases(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(op, "BLOCK_IDS", 500)
    texts = [(1, "a  b\n c"), (2, None), (3, ""), (4, "word " * 4000), (5, "<|endoftext|>"), (7, "x" * 5000), (8, "é漢 \n\n")]
    table = docs(spark, [t for _, t in texts], [i for i, _ in texts]).repartition(3).withColumns({"ids": F.lit(1), "part": F.lit(2)})
    path = f"file://{tmp_path}/{uuid.uuid4().hex}"
    op.write_token_file(table, PATH, path)
    found = op.read_token_file(spark, path)
    assert {r.doc_id: len(r.ids) for r in found.collect()} == {r.doc_id: 4 * r.n_tokens for r in found.collect()}
    check(op.digest(found).collect(), texts)
    for k, (rows, want) in enumerate([([], []), ([(None, "b"), (1, "a"), (1, "a"), (None, "b")], [(None, "b")] * 2 + [(1, "a")] * 2)]):
        path = f"file://{tmp_path}/{uuid.uuid4().hex}"
        op.write_token_file(docs(spark, [t for _, t in rows], [i for i, _ in rows]), PATH, path)
        check(op.digest(op.read_token_file(spark, path)).collect(), want)


def test_query(spark):
    sf_dir = "/root/testdata/sf0.001"
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect()]
    check(op9_token_files(spark, sf_dir).collect(), texts)


def test_reading_keeps_nothing_of_a_block(spark, monkeypatch, tmp_path):
    """A Python worker reads blocks of many tasks, one after the other."""
    path, works = f"file://{tmp_path}/{uuid.uuid4().hex}", []
    op.write_token_file(docs(spark, ["word " * 1000] * 20), PATH, path)
    monkeypatch.setattr(op, "map_batches", lambda df, schema, work: works.append((df, work)))
    op.read_token_file(spark, path)
    blocks, work = works[0][0].toArrow().to_batches(), works[0][1]
    size = sum(len(ids.as_py()) for b in work(iter(blocks)) for ids in b["ids"])
    tracemalloc.start()
    try:
        for _ in range(3):
            assert sum(b.num_rows for b in work(iter(blocks))) == 20
        assert tracemalloc.get_traced_memory()[0] < size / 4
    finally:
        tracemalloc.stop()


def test_words_of_earlier_slices_are_not_asked_for_again(monkeypatch):
    plain, encoder = Tokenizer.from_file(PATH), tokens.Encoder(PATH, False)
    asked = []
    bulk = encoder._bulk
    monkeypatch.setattr(encoder, "_bulk", lambda words, line=False: asked.extend(words) or bulk(words, line))
    texts = ["Some words, and more words.\nNext line", "more new words and some", "new, words"]
    for kept, again in ((tokens.KEPT_BYTES, False), (60, True), (0, True)):
        monkeypatch.setattr(tokens, "KEPT_BYTES", kept)
        for text in texts * 3:
            asked.clear()
            assert encoder([text]) == [np.array(plain.encode(text).ids, "<u4").tobytes()]
        assert bool(asked) == again
        assert encoder.kept.chunks.nbytes + encoder.kept.ids.nbytes <= kept


def test_texts_of_one_slice_are_cut_apart():
    """Texts that meet in the bytes of a slice, and those that are encoded as a whole between others."""
    plain, encoder = Tokenizer.from_file(PATH), tokens.Encoder(PATH, False)
    odd = ["", "a", "a ", " a", "\na", "a\n", " ", "\n", "a  b", "a \nb", "a\n b", "a\n\nb", "a\nb c", "ä漢 é,\nx!", "a b", "a　"]
    odd += ["\tb", "b\x1cc", "b\xa0c", "b\x85", " b", "a\x00b \x01", "<|endoftext|> a", "a b", "b\n12.5, (c)"]
    texts = [*odd, *reversed(odd), *(x for pair in zip(odd, odd[7:]) for x in pair)]
    assert encoder([]) == []
    for own in (texts, texts[::3], texts):
        assert encoder(own) == [np.array(plain.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in own]


def test_what_is_kept_is_not_made_a_table_again_for_few_words(monkeypatch):
    encoder, tables = tokens.Encoder(PATH, False), []
    encoder([" ".join(f"word{'abcdefghij'[k % 10]}{chr(97 + k // 10)}" for k in range(200))])
    kept, real = len(encoder.kept.chunks), tokens.pc.index_in

    class Compute:
        def __getattr__(self, name):
            return getattr(real_pc, name)

        def index_in(self, values, value_set):
            tables.append(len(value_set))
            return real(values, value_set=value_set)

    real_pc = tokens.pc
    monkeypatch.setattr(tokens, "pc", Compute())
    text = "some wordaa, some new words"
    assert encoder([text]) == [np.array(Tokenizer.from_file(PATH).encode(text).ids, "<u4").tobytes()]
    assert kept > 100 and tables and max(tables) < 10
