import base64
import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyward.llm import tokens

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def ranks():
    with open(PATH, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}


@pytest.fixture(scope="module")
def encoder(ranks):
    return tokens.Encoder(tokens.Vocabulary(ranks), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("test", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="abeht né'1 9\n\t日😀.", max_size=60), min_size=1, max_size=4))
def test_ids_equal_the_library(encoder, library, texts):
    ids, bounds = encoder.encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])] == [library.encode_ordinary(t) for t in texts]
    data, ends = encoder.vocabulary.decode(ids.astype(np.int64), bounds)
    assert [data[a:b].tobytes().decode() for a, b in zip(ends[:-1], ends[1:])] == texts


@pytest.mark.parametrize("text", ["a" * 3000, "thing" * 400, " " * 900, "é" * 700, "0" * 513, "ab" * 256])
def test_long_pieces_and_texts(encoder, library, text, monkeypatch):
    assert encoder.encode([text])[0].tolist() == library.encode_ordinary(text)
    monkeypatch.setattr(tokens, "LONG_TEXT", 10)
    assert encoder.encode([text, "", "x y"])[0].tolist() == library.encode_ordinary(text) + library.encode_ordinary("x y")


def test_memory_is_bounded(ranks, library, monkeypatch):
    monkeypatch.setattr(tokens, "MAX_PIECES", 5)
    small = tokens.Encoder(tokens.Vocabulary(ranks), public_tokenizers.PATTERN)
    for text in ("one two three", "four five six seven", "one nine ten"):
        assert small.encode([text])[0].tolist() == library.encode_ordinary(text)
    assert len(small.number) <= 12


def test_query_rows(spark, library):
    rows = [(1, "The the\nthing", "own"), (1, "The the\nthing", "own"), (None, None, "x"), (3, "", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, IDS string")
    coded = tokens.encode(docs, PATH, public_tokenizers.PATTERN)
    assert coded.columns == ["doc_id", "text", "ids"]  # the column of that name gave way
    found = {r.doc_id: r for r in tokens.decode(coded, PATH).collect()}
    want = np.array(library.encode_ordinary("The the\nthing"), "<u4").tobytes()
    assert bytes(found[1].ids) == want and bytes(found[1].decoded) == b"The the\nthing"
    assert bytes(found[None].ids) == b"" and bytes(found[3].decoded) == b""
    assert hashlib.sha256(want).hexdigest() and coded.count() == 4
    assert tokens.encode(docs.limit(0), PATH, public_tokenizers.PATTERN).count() == 0
