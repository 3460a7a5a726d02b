import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyward.llm import text as tx

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aB9 \té,\n日!", max_size=40)), min_size=1, max_size=6)
FOLD = {i: i + 32 for i in range(65, 91)}


def words(values, alphabet):
    data, bounds = tx.utf8(pa.array(values, pa.string()))
    data = tx.LOWER[data]
    found = tx.split_words(data, bounds, alphabet)
    return [
        [data[found.start[j] : found.end[j]].tobytes().decode() for j in range(a, b)]
        for a, b in zip(found.first[:-1], found.first[1:])
    ], found


@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_words_equal_the_pattern(values):
    got, _ = words(values, tx.WORD_BYTES)
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    assert got == [re.findall(pattern, (v or "").translate(FOLD)) for v in values]
    got, _ = words(values, tx.INK_BYTES)
    assert got == [re.findall(r"[^\x20\x09-\x0D]+", (v or "").translate(FOLD)) for v in values]


def test_equal_words_have_equal_hashes_wherever_they_stand():
    long = "x" * 5000
    got, found = words(["ab cd " + long, "cd", None, "", long + " ab"], tx.WORD_BYTES)
    flat = [w for row in got for w in row]
    assert len({(w, int(k)) for w, k in zip(flat, found.key)}) == len(set(flat)) == 3


def test_windows_of_words():
    keys = np.arange(10, dtype=np.uint64)
    twice = np.concatenate([keys, keys])
    found = tx.window_keys(twice, 4)
    assert len(found) == 17 and (found[:7] == found[10:]).all() and len(set(found[:10].tolist())) == 10
    assert len(tx.window_keys(keys, 11)) == 0


def test_pieces_hold_all_rows():
    batch = pa.RecordBatch.from_pydict({"text": ["a" * 10, None, "b" * 100, "c", ""]})
    parts = list(tx.pieces(batch, "text", 12))
    assert pa.Table.from_batches(parts).to_pydict() == batch.to_pydict()
    assert [p.num_rows for p in parts] == [2, 1, 2]
