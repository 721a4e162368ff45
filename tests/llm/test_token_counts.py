import glob
import math
import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from memberfold.llm import token_counts
from memberfold.llm.queries import tokenizer_path
from memberfold.llm.token_counts import BYTES, UNKNOWN, Counter, Lattices, count_tokens, estimated, saved, vocabulary


def library_counts(pieces):
    """The tokenizers library's own unigram model over the same pieces."""
    from tokenizers import Tokenizer, models, pre_tokenizers

    tokenizer = Tokenizer(models.Unigram([("<unk>", 0.0), *pieces], 0, False))
    tokenizer.pre_tokenizer = pre_tokenizers.Metaspace(split=False)
    return lambda text: len(tokenizer.encode(text, add_special_tokens=False).ids)


@pytest.fixture(scope="module")
def real():
    pieces = vocabulary(tokenizer_path("piece_bpe_32k.model"))
    return Counter(pieces), library_counts(pieces)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "the", " ", "  ", "ing", "\n", "é", "日", "☃", "☃☃", ".", "ss"]), max_size=25).map("".join))
def test_counts_of_the_public_vocabulary(real, text):
    counter, library = real
    assert counter.text(text) == library(text)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abc x", max_size=20))
def test_ties_and_unknown_characters(text):
    pieces = [("a", -1.0), ("b", -1.0), ("ab", -2.0), ("aba", -3.0), ("▁", -1.0), ("▁a", -2.0), ("ba", -2.0), ("bab", -2.5)]
    assert Counter(pieces).text(text) == library_counts(pieces)(text)


def test_pieces_over_the_start_of_a_word_are_refused():
    with pytest.raises(ValueError, match="reach over"):
        Counter([("a▁b", -1.0)])


def test_column(documents):
    pieces = [("▁a", -1.0), ("▁", -1.0), ("b", -1.0)]
    rows = documents([(1, None), (2, ""), (3, "a a"), (3, "a a"), (4, "ab" * 5000)])
    got = [(r["doc_id"], r["n_tokens"]) for r in count_tokens(rows, pieces).orderBy("doc_id").collect()]
    want = [(1, 0), (2, 0), (3, 2), (3, 2), (4, Counter(pieces).text("ab" * 5000))]
    assert got == want
    assert count_tokens(documents([]), pieces).count() == 0


def brute_expected(pieces, scores, text):
    """Expected counts of pieces by listing all segmentations."""
    score, low = dict(zip(pieces, scores)), min(scores) - 10

    def ways(rest):
        if not rest:
            yield 0.0, []
        for k in range(1, len(rest) + 1):
            head = rest[:k]
            if head in score:
                for s, more in ways(rest[k:]):
                    yield s + score[head], [head, *more]
            elif k == 1:
                for s, more in ways(rest[1:]):
                    yield s + low, [*(f"<0x{b:02X}>" for b in head.encode()), *more]

    found = [(math.exp(s), names) for s, names in ways(text)]
    total = sum(s for s, _ in found)
    return {p: sum(s * names.count(p) for s, names in found) / total for p in {x for _, n in found for x in n}}, math.log(total)


def test_expected_counts_match_all_segmentations():
    rng = random.Random(1)
    pieces = [UNKNOWN, *BYTES, "▁", "a", "b", "ab", "▁a", "bab", "aba", "日本"]
    scores = np.array([-rng.uniform(1, 6) for _ in pieces])
    texts = ["▁abab", "▁a☃ba", "日本a日", "b", "▁ababbab"]
    for text in texts:
        got, likelihood = Lattices(pieces, scores).expected([text], np.array([1000]))
        want, total = brute_expected(pieces, scores.tolist(), text)
        assert likelihood / 1024 / 1000 == pytest.approx(total, abs=1e-5)
        assert {p: n / 1024 / 1000 for p, n in zip(pieces, got) if n} == pytest.approx({p: n for p, n in want.items() if n > 1e-6}, abs=1e-4)
    n = np.arange(1, 6)
    several = Lattices(pieces, scores).expected(texts, n)
    single = [Lattices(pieces, scores).expected([t], np.array([k])) for t, k in zip(texts, n)]
    assert (several[0] == sum(s[0] for s in single)).all()


def test_counts_are_those_of_the_saved_model(spark, documents):
    from tokenizers import Tokenizer

    texts = ["international development of nations", "nation  and development ", "☃𓀀𓀁 snow\nman 日本語", None, "", "a<0x41>b <unk>"] * 3
    names = [p for p, _ in vocabulary(tokenizer_path("piece_bpe_32k.model"))]
    rows = documents(list(enumerate(texts)))
    path = estimated(rows, names)
    pieces = saved(spark, path)
    assert sum(math.exp(score) for _, score in pieces) == pytest.approx(1)
    (part,) = glob.glob(f"{path}/part-*")
    model = Tokenizer.from_file(part)
    got = {r["doc_id"]: r["n_tokens"] for r in count_tokens(rows, pieces).collect()}
    assert got == {k: len(model.encode(t or "", add_special_tokens=False).ids) for k, t in enumerate(texts)}
    assert Counter(pieces).text("𓀀𓀁𓀀") == 13  # the mark and the bytes
    assert Counter(pieces).text("international development") < 10  # by ranks as scores it is 10
    counter, library = Counter(pieces), lambda t: len(model.encode(t, add_special_tokens=False).ids)
    for text in ["x\n\ny", "☃a𓀀𓀀 b", "  nations", "developmental ré日"]:
        assert counter.text(text) == library(text)


def test_a_model_of_no_documents(spark, documents):
    pieces = saved(spark, estimated(documents([]), ["▁a", "b"]))
    assert len(pieces) == 259 and len({score for _, score in pieces}) == 1


def test_long_words_keep_few_places(monkeypatch):
    monkeypatch.setattr(token_counts, "KEPT_PLACES", 10)
    rng = random.Random(2)
    pieces = [("▁", -1.0), ("a", -1.5), ("b", -1.5), ("ab", -2.0), ("ba" * 6, -9.0), ("aab", -2.5), ("▁a", -2.0)]
    for k in range(60):
        text = "".join(rng.choices("ab☃", [5, 5, 1], k=rng.choice([1, 50, 3000])))
        assert Counter(pieces).text(text) == library_counts(pieces)(text)


def test_a_very_long_text_without_spaces():
    counter = Counter([("▁", -1.0), ("a", -1.0), ("b", -1.0), ("ab", -1.5)])
    assert counter.text("ab" * 1_000_000) == 1_000_001
    assert not counter.known


def test_columns_of_texts_are_counted_as_single_texts():
    texts = ["a b", None, "", " a", "a ", "a  b", "▁a b", "a▁ b", "   ", "\n", "b\nb a b", "a b"] * 2
    pieces = [("▁a", -1.0), ("▁", -1.0), ("b", -1.0), ("▁▁", -1.5), ("a", -3.0)]
    counter, library = Counter(pieces), library_counts(pieces)
    got = counter.column(pa.array(texts, pa.string())).tolist()
    assert got == [counter.text(t or "") for t in texts] == [library(t) if t else 0 for t in texts]
    which, distinct, bounds = token_counts.distinct_words(pa.array(texts, pa.string()))
    found = [[distinct[k] for k in which[a:b]] for a, b in zip(bounds, bounds[1:])]
    assert found == [token_counts.words(t or "") for t in texts]


def test_a_column_of_the_same_name_is_replaced(spark):
    rows = spark.createDataFrame([("x", 1, "a b", 7.5)], "n_tokens string, doc_id long, text string, chunk double")
    got = count_tokens(rows, [("▁a", -1.0), ("▁", -1.0), ("b", -1.0)])
    assert got.first().asDict() == {"doc_id": 1, "text": "a b", "chunk": 7.5, "n_tokens": 3}


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="ab☃𓀀é▁x", max_size=14), max_size=12), st.booleans())
def test_words_at_once_are_counted_as_one_by_one(words, with_bytes):
    pieces = [("a", -1.0), ("b", -1.0), ("ab", -2.0), ("aba", -3.0), ("▁", -1.0), ("▁a", -2.0), ("▁▁", -2.0), ("bab", -2.5), ("éa", -1.0), ("ab", -2.0)]
    counter = Counter(pieces + [(b, -8.0) for b in BYTES] if with_bytes else pieces)
    assert counter.counts(words) == [counter.word("▁" + w) for w in words]


@pytest.mark.parametrize("columns", [1, 3, 128])
def test_matches_of_many_words_need_no_step_a_match(columns, monkeypatch):
    monkeypatch.setattr(token_counts.Trie, "COLUMNS", columns)
    pieces = [("▁", -1.0), ("▁a", -2.0), ("a", -1.5), ("ab", -1.2), ("abc", -4.0), ("é", -2.0), ("bé", -1.0), ("𝄞", -3.0)]
    texts = ["abc", "", "a", "bébé", "𝄞ab", "xyz", "cab" * 9]
    trie = token_counts.Trie(p for p, _ in pieces)
    for text in texts:
        codes = np.array([ord(c) for c in text], np.int64)
        found = zip(*(x.tolist() for x in trie.matches(codes, len(text) - np.arange(len(text)))))
        want = {(i, len(p), k) for k, (p, _) in enumerate(pieces) for i in range(len(text)) if text.startswith(p, i)}
        assert sorted(found) == sorted(want)
    counter = token_counts.Counter(pieces)
    one_by_one = [counter.word("▁" + text) for text in texts]
    counter.automaton = None  # one Python step for each match: only long words go through it
    assert counter.counts(texts) == one_by_one
