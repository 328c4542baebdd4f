import random

from helpers import docs
from pyspark.sql import functions as F

from rateloom.llm import span_dedup as op
from rateloom.llm.queries import op3_substring_dedup


def plain_runs(words):
    """Shortest runs from and to every sentence, by trying all."""

    def holds(i, j):
        return j - i >= op.SENTENCES and sum(words[i:j]) >= op.LEAST_WORDS

    n, out = len(words), set()
    for i in range(n):
        out |= {(i, j) for j in range(i + 1, n + 1) if holds(i, j) and not any(holds(i, k) for k in range(i + 1, j))}
    for j in range(1, n + 1):
        out |= {(i, j) for i in range(j) if holds(i, j) and not any(holds(k, j) for k in range(i + 1, j))}
    return out


def brute_force(texts):
    """texts: (doc_id, text) in the order of the ids; the texts without repeated passages."""
    seen, gone = set(), {}
    for k, (_, text) in enumerate(texts):
        pieces, at, words = op.sentences_of(text or "")
        norm = [" ".join(pieces[p].lower().split()) for p in at]
        for i, j in sorted(plain_runs(words)):
            key = tuple(norm[i:j])
            if key in seen:
                gone.setdefault(k, set()).update(at[i:j])
            seen.add(key)
    out = []
    for k, (i, text) in enumerate(texts):
        cut = gone.get(k, set())
        pieces = op.pieces_of(text) if text else []
        out.append((i, "".join(p for x, p in enumerate(pieces) if x not in cut) if cut else text, len(cut)))
    return out


def test_runs():
    rng = random.Random(3)
    for _ in range(200):
        words = [rng.choice([1, 1, 2, 5, 9, 20, 40]) for _ in range(rng.randint(1, 20))]
        first, last = op.runs_of(words)
        assert set(zip(first.tolist(), last.tolist())) == plain_runs(words)


def test_runs_hold_several_sentences():
    assert [x.tolist() for x in op.runs_of([21])] == [[], []]
    assert [x.tolist() for x in op.runs_of([90, 1, 90])] == [[0, 1], [2, 3]]


def test_pieces_are_the_text():
    """Whatever characters a text has, also those that could mark cuts."""
    texts = ["", "\0", "a\0b. c", "".join(map(chr, range(300))), "\n\n. \0\1\2! ", "x.\ty"]
    for text in texts:
        assert "".join(op.pieces_of(text)) == text
    assert op.pieces_of("a\0b. c\nd") == ["a\0b.", " c", "\nd"]


def sentence(rng):
    return " ".join(f"w{rng.randint(0, 5000)}" for _ in range(rng.choice([1, 3, 8, 12, 40]))) + rng.choice(".!?")


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(op, "BATCH_ROWS", 7)
    rng = random.Random(6)
    shared = [[sentence(rng) for _ in range(rng.randint(3, 8))] for _ in range(5)]
    texts = []
    for i in range(120):
        own = [sentence(rng) for _ in range(rng.randint(0, 12))]
        at = rng.randint(0, len(own))
        if rng.random() < 0.6:
            own[at:at] = rng.choice(shared)
        texts.append((i, rng.choice([" ", "\n"]).join(own)))
    texts += [(120, texts[3][1]), (121, " ".join(["Again and again this sentence has words enough for it."] * 30))]
    rows = docs(spark, [t for _, t in texts], [i for i, _ in texts]).repartition(4)
    got = sorted((r.doc_id, r.text, r.n_removed) for r in op.drop_repeated_passages(rows).collect())
    assert got == sorted(brute_force(texts))


def test_cases(spark):
    passage = "One two three four five six seven. Eight nine ten eleven twelve thirteen fourteen. Fifteen sixteen seventeen eighteen nineteen twenty!"
    texts = [None, "", " ", passage, passage, passage, "Short. Again.", "Short. Again.", " a\0b. " + passage, "x " * 90000]
    table = docs(spark, texts, [1, 2, 3, 9, 9, 5, 6, 7, None, 8]).withColumns({"first": F.lit(1), "h1": F.lit("x"), "n_removed": F.lit("y")})
    got = op.drop_repeated_passages(table)
    assert [c for c in got.columns if c != "n_removed"] == [c for c in table.columns if c != "n_removed"]
    found = sorted(((r.doc_id or 99, r.text, r.n_removed) for r in got.collect()), key=str)
    want = [(1, None, 0), (2, "", 0), (3, " ", 0), (9, "", 3), (9, "", 3), (5, passage, 0), (6, "Short. Again.", 0)]
    want += [(7, "Short. Again.", 0), (99, " a\0b.", 3), (8, "x " * 90000, 0)]
    assert found == sorted(want, key=str)
    assert op.drop_repeated_passages(docs(spark, [])).collect() == []


def test_query(spark):
    sf_dir = "/root/testdata/sf0.001"
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect()]
    got = sorted((r.doc_id, r.text, r.n_removed) for r in op3_substring_dedup(spark, sf_dir).collect())
    assert got == sorted(brute_force(texts)) and any(n for _, _, n in got)


def test_other_scripts_and_closing_marks(spark):
    """Passages between sentences of their own, on one line."""
    passages = [
        "今天的天气非常好我们去公园散步。孩子们在草地上奔跑玩耍非常开心！你想和我们一起去吗？",
        "यह एक लंबा वाक्य है जो कई बार आता है। दूसरा वाक्य भी यहाँ बार बार आता है। तीसरा वाक्य यहीं समाप्त होता है।",
        "He said \"one two three four five.\" Then (six seven eight nine ten.)\tAt last eleven twelve thirteen fourteen, fifteen sixteen and seventeen!\u00a0",
        "วันนี้อากาศดีมากเราไปเดินเล่นที่สวนสาธารณะ เด็กๆวิ่งเล่นบนสนามหญ้าอย่างมีความสุข ",
    ]
    own = [("甲乙丙。", "丁戊。"), ("पहला। ", " अंत।"), ("She left?\" ", "Never again."), ("กขค ", "งจฉ")]
    texts = [t for p, (a, b) in zip(passages, own) for t in (p, a + p + b)]
    got = {r.doc_id: r for r in op.drop_repeated_passages(docs(spark, texts)).collect()}
    for k, (a, b) in enumerate(own):
        assert got[2 * k].text == texts[2 * k] and got[2 * k].n_removed == 0
        assert got[2 * k + 1].n_removed >= 2 and got[2 * k + 1].text.split() == (a + b).split() or k in (0, 2)
    assert got[1].text == "".join(own[0]) and got[5].text.replace("\u00a0", " ").split() == "".join(own[2]).split()
    for text in texts:
        assert "".join(op.pieces_of(text)) == text
