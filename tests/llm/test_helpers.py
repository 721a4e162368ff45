import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from memberfold.llm.common import WORD, WordHashes, run_hashes, sliced, word_hashes


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet=" \t\n\x0b\x0c\r\x1c\x85\xa0 abcÄ"))
def test_bytes_are_cut_into_the_words_of_the_pattern(text):
    assert [w.decode() for w in text.encode().split()] == re.findall(WORD, text)


@settings(max_examples=50, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b"]), max_size=40), st.integers(1, 9))
def test_equal_runs_have_equal_hashes(words, k):
    hashes = run_hashes(WordHashes().array(words), k)
    runs = [tuple(words[i : i + k]) for i in range(len(words) - k + 1)]
    assert len(hashes) == len(runs)
    assert len(set(hashes.tolist())) == len(set(runs))
    assert len(set(zip(hashes.tolist(), runs))) == len(set(runs))


def test_slices_keep_all_rows_and_the_limit():
    texts = ["x" * n for n in (0, 5, 30, 3, 3, 3, 0)] + [None]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    parts = [p.column("text").to_pylist() for p in sliced([batch], limit=10)]
    assert [t for p in parts for t in p] == texts
    assert all(len(p) == 1 or sum(len(t or "") for t in p) <= 10 for p in parts)
    assert list(sliced([batch.slice(0, 0)])) == []


def test_hash_cache_stays_bounded():
    hashes = WordHashes()
    hashes.LIMIT = 10
    words = [str(n).encode() for n in range(100)]
    assert np.array_equal(hashes.array(words), WordHashes().array(words))
    assert len(hashes) <= 10


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet=" \t\n\x0b\x0c\r\x1c\x85\xa0 abcÄB")), max_size=6), st.booleans())
def test_word_hashes_of_a_column(texts, lower):
    hashes, bounds = word_hashes(pa.array(texts, pa.string()), lower)
    for text, a, b in zip(texts, bounds, bounds[1:]):
        data = (text or "").encode()
        assert hashes[a:b].tolist() == WordHashes().array((data.lower() if lower else data).split()).tolist()
    assert len(bounds) == len(texts) + 1 and bounds[-1] == len(hashes)
