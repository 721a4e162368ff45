import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from memberfold.llm import token_file
from memberfold.llm.queries import tokenizer_path

PATH = tokenizer_path("byte_bpe_50k.json")
ODD = " \n\t\x0b\x1c\x85\xa0 ​ ab'sÄ9!<|endoftext|>日"


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder():
    return token_file.Encoder(PATH)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([*ODD, "the", " the", "  ", "<|endoftext|>", "'ll", ".", ",", "é.", "\n", "a, b"]), max_size=30).map("".join))
def test_pieces_make_the_ids_of_the_whole_text(tokenizer, encoder, text):
    want = tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == want


def test_memory_of_pieces_is_bounded(tokenizer):
    encoder = token_file.Encoder(PATH)
    encoder.LIMIT = 5
    texts = [f"one two{k} three four{k}" for k in range(20)]
    for text in texts:
        assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == tokenizer.encode(text).ids
    assert sum(map(len, encoder.known + encoder.older)) < 60


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(0, 400), st.integers(1, 10**9), min_size=1, max_size=60), st.integers(6, 12))
def test_code_lengths_are_limited_and_complete(counts, limit):
    lengths = token_file.code_lengths(counts, limit)
    assert set(lengths) == set(counts) and max(lengths.values()) <= limit
    if len(counts) > 1:
        assert sum(2.0**-n for n in lengths.values()) == 1
    assert all(lengths[a] <= lengths[b] for a in counts for b in counts if counts[a] > counts[b])


def huffman_cost(counts):
    import heapq

    heap, cost = sorted(counts), 0
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        cost += both
        heapq.heappush(heap, both)
    return cost


def test_a_wide_limit_gives_huffman_codes():
    counts = {k: v for k, v in enumerate([1, 1, 2, 3, 5, 8, 13, 21, 34, 55, 55, 100])}
    lengths = token_file.code_lengths(counts, 20)
    assert sum(counts[k] * n for k, n in lengths.items()) == huffman_cost(counts.values())


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 300), min_size=1, max_size=300), min_size=1, max_size=8))
def test_blocks_round_trip(arrays):
    ids = np.concatenate([np.array(a, np.int64) for a in arrays])
    ends = np.cumsum([len(a) for a in arrays])
    lengths = token_file.code_lengths(dict(zip(*(x.tolist() for x in np.unique(ids, return_counts=True)))))
    bits, at = token_file.pack(ids, ends, *token_file.canonical_codes(lengths))
    back = token_file.unpack(bits, at[:: token_file.STRIDE], len(ids), token_file.decoding_table(lengths), ends)
    assert back.tolist() == ids.tolist()


def test_dataset_round_trip(spark, documents, tokenizer, monkeypatch):
    monkeypatch.setattr(token_file, "BLOCK", 400)
    rows = [(k, f"text {k} " * (k % 9)) for k in range(60, 0, -1)]
    rows += [(None, "no id"), (100, None), (101, ""), (102, "long " * 3000), (103, "!!! <|endoftext|>"), (5, "same id"), (5, "same id")]
    folder = token_file.tokenized_dataset(documents(rows).withColumnRenamed("n_chars", "ids"), PATH)
    got = token_file.read_dataset(spark, folder).orderBy("start").collect()
    assert len(got) == len(rows)
    order = [r["doc_id"] for r in got]
    assert order == sorted(order, key=lambda d: (d is not None, d or 0))
    want = sorted((str(d), tuple([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0])) for d, t in rows)
    assert want == sorted((str(r["doc_id"]), tuple(np.frombuffer(r["ids"], "<u4").tolist())) for r in got)
    at = 0
    for r in got:
        assert (r["start"], r["n_tokens"]) == (at, len(r["ids"]) // 4)
        at += r["n_tokens"]
    sums = token_file.read_checksums(spark, folder).collect()
    assert sorted((r["start"], r["ids_crc32"]) for r in sums) == sorted((r["start"], zlib.crc32(r["ids"])) for r in got)


def test_empty_dataset(spark, documents):
    folder = token_file.tokenized_dataset(documents([]), PATH)
    assert token_file.read_checksums(spark, folder).count() == 0


def whole_ids(path, texts):
    from tokenizers import Tokenizer

    return [x.ids for x in Tokenizer.from_file(str(path)).encode_batch(texts, add_special_tokens=False)]


def encoded_ids(path, texts):
    return [np.frombuffer(x, "<u4").tolist() for x in token_file.Encoder(str(path)).encode(texts)]


def test_tokenizers_whose_cuts_are_not_known_encode_whole_texts(tmp_path):
    from tokenizers import Tokenizer, models, pre_tokenizers

    texts = ["a b c", "a  b\nc, d", "", "The end. a", "x"]
    unigram = Tokenizer(models.Unigram([("<unk>", 0.0), ("a b", -1.0), ("a", -2.0), (" b", -2.0), (" c", -3.0)], 0, False))
    unigram.save(str(tmp_path / "unigram.json"))
    assert not token_file.Encoder(str(tmp_path / "unigram.json")).by_pieces
    changed = []
    for name, change in [
        ("prefix", lambda t: setattr(t, "pre_tokenizer", pre_tokenizers.ByteLevel(add_prefix_space=True))),
        ("bare", lambda t: setattr(t, "pre_tokenizer", pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False))),
        ("added", lambda t: t.add_tokens(["b\nc"])),
        ("letters", lambda t: t.add_tokens(["end"])),
    ]:
        tokenizer = Tokenizer.from_file(PATH)
        change(tokenizer)
        tokenizer.save(str(tmp_path / f"{name}.json"))
        changed.append(tmp_path / f"{name}.json")
        assert not token_file.Encoder(str(changed[-1])).by_pieces, name
    for path in [tmp_path / "unigram.json", tokenizer_path("word_bpe_49k.json"), *changed]:
        assert encoded_ids(path, texts) == whole_ids(path, texts)
    assert token_file.Encoder(PATH).by_pieces


def test_bytes_that_stand_for_themselves_and_others(tokenizer, encoder):
    words = ["é", " Éa", "ÀÖØöøÿ", " naïve", "ﬁ", "x×y", "日本", "a\0b c", "\0"]
    got = [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(words)]
    assert got == [tokenizer.encode(w, add_special_tokens=False).ids for w in words]
    assert len(set(token_file._byte_signs().values())) == 256


def test_a_very_long_text_without_spaces():
    encoder = token_file.Encoder(PATH)
    text = "ab" * 200_000 + "." + "é" * 1000
    assert [np.frombuffer(encoder.encode([text])[0], "<u4").tolist()] == whole_ids(PATH, [text])
    assert all(len(p) <= encoder.LONGEST for table in encoder.known + encoder.older for p in table)


def test_letters_and_what_follows_them_are_encoded_apart(tokenizer, encoder):
    words = [f"{space}{head}{rest}" for space in ("", " ") for head in ("word", "été", "ß") for rest in (
        ".", "'s", "'ve!!", "123abc", "###", "µ", "ªb", "º", "×y", "日", "́", "ʰx", "Ж.", "<|endoftext|>z", "¼½", "’s", "...x'll"
    )]
    got = [np.frombuffer(x, "<u4").tolist() for x in encoder.encode([" ".join(words), *words])]
    assert got == [tokenizer.encode(w, add_special_tokens=False).ids for w in [" ".join(words), *words]]


def test_ids_of_a_slice_are_counted_at_once(monkeypatch):
    """A count of one document alone still has as many numbers as its largest id."""
    import pyarrow as pa

    documents = [np.array([k % 7, 50_000 + k % 3, 0], "<u2") for k in range(500)]
    batch = pa.RecordBatch.from_arrays(
        [pa.array([3] * 500), pa.array([x.tobytes() for x in documents])], names=["n_tokens", "ids"]
    )
    calls, bincount = [], np.bincount
    monkeypatch.setattr(token_file.np, "bincount", lambda ids: calls.append(len(ids)) or bincount(ids))
    total = token_file._id_counts(iter([batch, batch.slice(0, 1)]), lambda n, data: np.frombuffer(data, "<u2"))
    assert calls == [1500, 3]
    assert total.tolist() == bincount(np.concatenate([*documents, documents[0]])).tolist()


def test_runs_that_end_at_the_last_bit_are_read_to_their_end():
    """Codes of the greatest length, and a run that goes on far past its only code."""
    counts = {k: 1 << min(k, 24) for k in range(26)}
    lengths = token_file.code_lengths(counts)
    assert max(lengths.values()) == token_file.MAX_BITS
    codes, sizes = token_file.canonical_codes(lengths)
    ids = np.array([25, 0] * 64 + [0, 1], np.int64)
    ends = np.array([1, 128, 130])
    bits, at = token_file.pack(ids, ends, codes, sizes)
    out = token_file.unpack(bits, at[:: token_file.STRIDE], len(ids), token_file.decoding_table(lengths), ends)
    assert out.tolist() == ids.tolist()


def test_only_pieces_of_two_parts_are_cut(tokenizer, encoder, monkeypatch):
    """Telling where all pieces are cut took a tenth of the encoding."""
    texts, cut = ["one two, three four.\nfive 66 seven8 é9 a  b", "", "x, x, x"], []
    extract = token_file.pc.extract_regex
    monkeypatch.setattr(token_file.pc, "extract_regex", lambda x, pattern: cut.extend(x.to_pylist()) or extract(x, pattern=pattern))
    got = [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)]
    assert got == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert sorted(cut) == [" four.", " seven8", " two,", " x,", " é9", "x,"]


def test_what_a_tokenizer_file_says_is_told_once(monkeypatch):
    monkeypatch.setattr(token_file, "cuts_are_safe", lambda text: pytest.fail("told again"))
    for known in (True, False):
        assert token_file.Encoder(PATH, known).by_pieces == known
        assert token_file.Encoder(PATH, known).encode(["a b, c"]) == token_file.Encoder(PATH, not known).encode(["a b, c"])
