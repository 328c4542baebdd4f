import random
import unicodedata
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from helpers import docs
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rateloom.llm import packing as op
from rateloom.llm import tokens
from rateloom.llm.queries import op4_best_fit_packing
from rateloom.llm.tokens import Encoder

PATH = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")


def check_rows(rows, texts, capacity=2048):
    """Round trip of ids, and no gap or overlap in any sequence. rows and texts by id."""
    tokenizer = Tokenizer.from_file(PATH)
    for i, text in texts.items():
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        own = sorted((r for r in rows if r.doc_id == i), key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(-(-len(ids) // capacity)))
        for r in own:
            part = np.array(ids[r.piece * capacity : (r.piece + 1) * capacity], "<u4")
            assert (r.start, r.length, r.ids_crc32) == (r.piece * capacity, len(part), zlib.crc32(part.tobytes()))
    check_sequences(rows, capacity)


def check_sequences(rows, capacity):
    held = defaultdict(list)
    for r in rows:
        held[r.sequence_id].append((r.offset, r.length))
    for slots in held.values():
        at = 0
        for offset, length in sorted(slots):
            assert offset == at
            at += length
        assert at <= capacity
    return len(held)


def plain_best_fit(lengths, capacity):
    gaps = []
    for length in sorted(lengths, reverse=True):
        fit = [g for g in gaps if g >= length]
        if fit:
            gaps.remove(min(fit))
            gaps.append(min(fit) - length)
        else:
            gaps.append(capacity - length)
    return len(gaps)


def test_encoder_is_the_tokenizer(monkeypatch):
    monkeypatch.setattr(tokens, "AT_ONCE", 50)
    odd = ["", " ", "a", "a  b", "a   b", "a\n b", " a\nb ", "x y", "a\x1cb c", "don't can't's", "<|endoftext|> a <|endoftext|>"]
    odd += ["é é Ünï 漢字 かな", "THE!! Of,&&& 12 345", "\t\r\n x", "z" * 500, "a　b", "tail ", "tail \n", "l\nm\n", "\nl", "a b\nc d\n\ne", "a\nb \nc", "\n\n\nq", "a ́b"]
    rng = random.Random(1)
    odd += ["".join(rng.choice("ab'sé  \n\t.1<|>") for _ in range(40)) for _ in range(300)]
    odd += ["".join(rng.choice(["The", "ÉTÉ", "ß", "²x", "İi", "Σας", ",", "!!", "&&&", " ", " ", "-", "'s", "|", "\n"]) for _ in range(30)) for _ in range(300)]
    letters = [c for c in map(chr, range(0x20, 0x30000)) if unicodedata.category(c) not in ("Cs", "Cn", "Co")]
    odd += [f"x{c}, {c} a{c}b\n{c}z." for c in letters[::31] + list("\u095c\u0a36\u0f5c\ufb2c\ufb33\u0130")]
    for path, words in ((PATH, True), (BYTES, False)):
        tokenizer, encode = Tokenizer.from_file(path), Encoder(path, words)
        want = [np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in odd]
        assert encode(odd) == want and encode(odd) == want
        assert [x for at in range(0, len(odd), 7) for x in encode(odd[at : at + 7])] == want


def test_letters_of_known_words_are_not_asked_for_with_punctuation(monkeypatch):
    tokenizer, encode = Tokenizer.from_file(PATH), Encoder(PATH, True)
    encode(["Some words " + "w" * 64 + " é"])
    asked = []
    bulk = encode._bulk
    monkeypatch.setattr(encode, "_bulk", lambda words, line=False: asked.extend(words) or bulk(words, line))
    text = "words! Some words, (words) é. new.. " + "w" * 64 + "; " + "w" * 65 + ", ,,"
    assert encode([text]) == [np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()]
    assert asked == ["new"]


def test_plan_is_best_fit():
    rng = random.Random(4)
    for capacity in (10, 64, 100):
        for _ in range(60):
            lengths = [rng.choice([capacity, 1, 2, 3, rng.randint(1, capacity)]) for _ in range(rng.randint(0, 80))]
            counts = {n: lengths.count(n) for n in lengths}
            plan = op.best_fit_plan(counts, capacity)
            slots = defaultdict(list)
            for n, first, last, sequence, per, offset in plan:
                for r in range(first, last):
                    slots[sequence + (r - first) // per].append((offset + (r - first) % per * n, n))
            assert sorted(n for s in slots.values() for _, n in s) == sorted(lengths)
            for s in slots.values():
                at = 0
                for offset, n in sorted(s):
                    assert offset == at
                    at += n
                assert at <= capacity
            assert len(slots) == plain_best_fit(lengths, capacity)


def test_plan_does_not_grow_with_the_counts():
    small = op.best_fit_plan({n: 7 for n in range(1, 2049)}, 2048)
    large = op.best_fit_plan({n: 7_000_000_007 + n for n in range(1, 2049)}, 2048)
    assert len(small) < 70_000 and len(large) < 70_000


def test_cases(spark, monkeypatch):
    monkeypatch.setattr(op, "BUCKET_ROWS", 3)
    texts = [None, "", " ", "word", "word", "many words " * 3000, "x" * 9000, "a b c d"]
    table = docs(spark, texts).withColumns({"length": F.lit("x"), "rank": F.lit(1), "piece": F.lit(2)})
    rows = op.pack(table, PATH).collect()
    check_rows(rows, dict(enumerate(texts)))
    assert op.pack(docs(spark, []), PATH).collect() == []
    twice = op.pack(docs(spark, ["same text"] * 3 + ["other"], [5, 5, None, 5]), PATH).collect()
    assert len(twice) == 4 and check_sequences(twice, 2048) == 1


def test_query(spark):
    sf_dir = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = op4_best_fit_packing(spark, sf_dir).collect()
    check_rows(rows, texts)
    used = sum(r.length for r in rows)
    assert len({r.sequence_id for r in rows}) <= max(-(-used // 2048) + 1, plain_best_fit([r.length for r in rows], 2048))
