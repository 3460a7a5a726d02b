import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as public
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from tallyward.llm import alignment

A, B = public.path("byte_bpe_50k.json"), public.path("piece_bpe_32k.model")
TEXTS = [
    "Plain words, 123 numbers and more words.",
    "  Zwei  Räume\tund\nZeilen äöü ß  ",
    "日本語のテキスト、中文 🙂🏽 <|endoftext|> <s> <0x41> ▁under",
    "the the the\r\n\r\n   the",
    "x" * 3000 + " " + "é" * 500,
    "\u0000\u0001 control ‍",
    "<unk>",
    " ",
    "a",
]


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(2)
    words = sum((t.split() for t in TEXTS[:4]), [])
    more = [" ".join(rnd.choices(words, k=rnd.randint(1, 30))) for _ in range(80)]
    texts = TEXTS + more + more[:10] + [None, "", "word " * 30_000]
    return list(enumerate(texts))


def byte_tokens():
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    chars = {c: bytes([b]) for b, c in zip(plain, map(chr, plain))}
    chars |= {chr(256 + i): bytes([b]) for i, b in enumerate(b for b in range(256) if b not in plain)}
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = SentencePieceProcessor(model_file=B)

    def piece(i):
        return bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()

    def both(text):
        if not text:
            return [], []
        x, y = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        bytes_x = [b"".join(chars[c] for c in a.id_to_token(i)) for i in x]
        bytes_y = [piece(i) for i in y]
        whole = (" " + text).encode()
        if b"".join(bytes_x) != whole or b"".join(bytes_y) != whole:
            return [], []
        return [(i, len(t)) for i, t in zip(x, bytes_x)], [(i, len(t)) for i, t in zip(y, bytes_y)]

    return both


def spans(tokens):
    out, at = [], 0
    for i, n in tokens:
        out.append((at, at + n, i))
        at += n
    return out


def brute_force(rows):
    both, docs = byte_tokens(), []
    for n, text in rows:
        a, b = map(spans, both(text))
        links = []
        first = 0
        for s, e, i in a:  # tokens in order, so those that end before s need no second look
            while first < len(b) and b[first][1] <= s:
                first += 1
            k = first
            while k < len(b) and b[k][0] < e:
                links.append((i, b[k][2]))
                k += 1
        cuts = sorted({e for _, e, _ in a} & {e for _, e, _ in b})
        groups, start = [], 0
        token_of = [defaultdict(list), defaultdict(list)]
        for side, tokens in enumerate((a, b)):
            k = 0
            for s, e, i in tokens:
                while cuts[k] < e:
                    k += 1
                token_of[side][k].append(str(i))
        groups = [f"{','.join(token_of[0][k])}|{','.join(token_of[1][k])}" for k in range(len(cuts))]
        docs.append((n, a, b, links, groups))
    counts = Counter(p for d in docs for p in set(d[3]))
    most = defaultdict(int)
    for (i, _), c in counts.items():
        most[i] = max(most[i], c)
    return {
        (n, len(a), len(b), len(groups), len(links), sum(counts[p] == most[p[0]] for p in links), sum(counts[p] for p in links), ";".join(groups))
        for n, a, b, links, groups in docs
    }


@pytest.mark.parametrize("options", [{}, {"max_pairs": 10}])
def test_equals_brute_force(spark, rows, options):
    docs = spark.createDataFrame([(*r, 5, "z", [1]) for r in rows], "doc_id long, text string, n_a int, extra string, `odd.name` array<int>")
    got = alignment.align_tokenizers(docs.repartition(6), A, B, **options)
    assert got.columns == ["doc_id", "extra", "odd.name", *alignment._OUT]
    got = got.collect()
    assert all(r.extra == "z" and r["odd.name"] == [1] for r in got)
    assert {(r.doc_id, *[r[c] for c in alignment._OUT]) for r in got} == brute_force(rows) and len(got) == len(rows)


class Letters:
    """Knows a space and the letter a; others come out as a."""

    tokens = [b" ", b"a"]

    def __init__(self, cuts):
        self.cuts = cuts

    def encode(self, texts):
        return [[int(c != " ") for c in " " + t] for t in texts]


def lists(column):
    return [np.frombuffer(p, "<u2").tolist() for p in column.to_pylist()]


@pytest.mark.parametrize("cuts", [False, True])
def test_texts_that_do_not_come_back_have_no_tokens(cuts):
    a, b = alignment.Encoder(Letters(cuts)), alignment.Encoder(Letters(False))
    texts = pa.array(["aa aa", "aa ab", "ba aa", None, "", "  ", "é aaa", "a"])
    want = [[0, 1, 1, 0, 1, 1], [], [], [], [], [0, 0, 0], [], [0, 1]]
    for _ in range(2):
        assert list(map(lists, alignment.tokenize(texts, a, b))) == [want, want]


@pytest.fixture(scope="module")
def encoders():
    found = [alignment.encoder(alignment.read_file(None, path)) for path in (A, B)]
    assert all(e.tokenizer.cuts for e in found)
    return found


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab' s1.,!~ \t\n\u00a0\u3000éß中🙂\u0301▁<>") | st.characters(exclude_categories=["Cs"]), max_size=40), max_size=4))
def test_remembered_pieces_give_the_ids_of_whole_texts(encoders, texts):
    texts = texts + [" ".join(texts) + "a", None]
    want = [[e.whole(t) if t else [] for t in texts] for e in encoders]
    good = [x is not None and y is not None for x, y in zip(*want)]
    got = alignment.tokenize(pa.array(texts, pa.string()), *encoders)
    assert [lists(c) for c in got] == [[i if g else [] for i, g in zip(side, good)] for side in want]


def test_hashes_that_meet_do_no_harm(monkeypatch):
    monkeypatch.setattr(alignment, "hash_slices", lambda data, start, end: np.zeros(len(start), np.uint64))
    e = alignment.Encoder(alignment.encoder(alignment.read_file(None, A)).tokenizer)
    texts = ["one two three", "two", "", "one"]
    assert lists(alignment.tokenize(pa.array(texts), e, e)[0]) == [e.whole(t) if t else [] for t in texts]


@pytest.mark.parametrize("n", [0, 1, 2, 63, 64, 65, 5000])
def test_perfect_hash_is_minimal(n):
    keys = np.unique(np.random.default_rng(n).integers(0, 1 << 40, n))
    number = alignment.PerfectHash(keys)
    assert sorted(number(keys).tolist()) == list(range(len(keys))) and number.n == len(keys)
    assert sum(words.nbytes for _, words, _ in number.levels) * 8 < 8 * n + 1000


def test_pairs_that_were_not_counted_are_refused():
    keys = np.arange(100, 200)
    number = alignment.PerfectHash(keys)
    ordered = np.zeros(100, np.int64)
    ordered[number(keys)] = keys
    table = alignment.PairTable(number, ordered, np.ones(100, np.int64), np.ones(100, bool))
    assert (ordered[table.places(keys)] == keys).all()
    with pytest.raises(KeyError):
        table.places(np.array([7]))


def test_dense_vectors_sum_as_a_tree(spark, monkeypatch):
    monkeypatch.setattr(alignment, "FAN_IN", 2)
    keys = np.arange(0, 300_000, 3)
    partial = spark.range(0, 300_000, 3, 7).selectExpr("id pair", "id % 5 n").union(spark.range(0, 300_000, 30, 4).selectExpr("id pair", "1L n"))
    number = alignment.PerfectHash(keys)
    total = alignment.dense_counts(partial, number)
    assert total[number(keys)].tolist() == [k % 5 + (k % 30 == 0) for k in keys.tolist()]


def test_small_steps_change_nothing(spark, rows, monkeypatch):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = {tuple(r) for r in alignment.align_tokenizers(docs, A, B).collect()}
    monkeypatch.setattr(alignment, "PAIRS_AT_ONCE", 50)
    monkeypatch.setattr(alignment, "MAX_KNOWN", 5)
    assert {tuple(r) for r in alignment.align_tokenizers(docs, A, B).collect()} == want


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.align_tokenizers(docs, A, B).collect() == []
    none = spark.createDataFrame([(1, None), (None, "")], "doc_id long, text string")
    assert {tuple(r) for r in alignment.align_tokenizers(none, A, B).collect()} == {(1, 0, 0, 0, 0, 0, 0, ""), (None, 0, 0, 0, 0, 0, 0, "")}
