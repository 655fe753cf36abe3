"""Words, shingles and sets against plain Python."""

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from quire.llm import words

TEXT = st.one_of(st.none(), st.text(alphabet="ab A\n\t\x0b.é世", max_size=40))


def plain_words(text):
    low = (text or "").encode().translate(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123))))
    return re.findall(rb"[^\x20\x09-\x0D]+", low)


def plain_set(text, n):
    found = plain_words(text)
    return {tuple(found[i:i + n]) for i in range(len(found) - n + 1)} if len(found) >= n else {tuple(found)} - {()}


@settings(max_examples=150, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=8), st.integers(1, 4))
def test_sets_have_the_sizes_and_overlaps_of_plain_sets(texts, n):
    column = pa.array(texts, pa.string())
    hashes, first = words.word_hashes(column)
    assert np.diff(first).tolist() == [len(plain_words(t)) for t in texts]
    sets = words.shingle_sets(column, n)
    plain = [plain_set(t, n) for t in texts]
    assert np.diff(sets[1]).tolist() == [len(s) for s in plain]
    turned = words.shingle_sets(pa.array(texts[::-1], pa.string()), n)
    assert words.shared_counts(sets, turned).tolist() == [len(a & b) for a, b in zip(plain, plain[::-1])]


def test_portions_cover_all_rows_once():
    batch = pa.RecordBatch.from_pydict({"text": ["x" * k for k in (0, 5, 50, 3, 0)] + [None, "y" * 200], "id": range(7)})
    for limit, rows in ((1, 100), (10, 2), (1000, 3), (1000, 100)):
        assert [i for part in words.portions([batch], "text", limit, rows) for i in part["id"].to_pylist()] == list(range(7))


def test_hashes_do_not_depend_on_the_neighbours():
    alone = words.shingle_sets(pa.array(["a b c d"]), 2)[0]
    hashes, first = words.shingle_sets(pa.array(["q r s", None, "a b c d", ""]), 2)
    assert sorted(alone.tolist()) == sorted(hashes[first[2]:first[3]].tolist())
