import hashlib

import numpy as np
from hypothesis import given, settings, strategies as st

from memberfold.llm import fingerprints
from memberfold.llm.fingerprints import compare_neighbours, fingerprint, likeness, phrase_hashes, unpacked


def phrases(data: bytes) -> set[bytes]:
    seen, start = set(), 0
    for end in range(1, len(data) + 1):
        if data[start:end] not in seen:
            seen.add(data[start:end])
            start = end
    return seen


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="abä", max_size=120), st.text(alphabet="abä", max_size=120))
def test_small_sets_are_compared_exactly(a, b):
    x, y = phrases(a.encode()), phrases(b.encode())
    assert len(phrase_hashes(a.encode())) == min(len(x), fingerprints.KEPT)
    if len(x | y) <= fingerprints.KEPT:
        want = len(x & y) / len(x | y) if x | y else 1.0
        assert likeness(phrase_hashes(a.encode()), phrase_hashes(b.encode())) == want


def test_estimate_is_near_the_exact_share():
    rng = np.random.default_rng(1)
    text = bytes(rng.integers(97, 107, 30_000).astype(np.uint8))
    other = text[:20_000] + bytes(rng.integers(97, 107, 10_000).astype(np.uint8))
    x, y = phrases(text), phrases(other)
    assert abs(likeness(phrase_hashes(text), phrase_hashes(other)) - len(x & y) / len(x | y)) < 0.15


def pieces(data: bytes) -> list[bytes]:
    ends = [
        k for k in range(fingerprints.RUN, len(data) + 1)
        if int.from_bytes(data[k - fingerprints.RUN : k], "little") * fingerprints._STEP % (1 << 64) >> 64 - fingerprints.ZERO_BITS == 0
    ]
    return [data[a:b] for a, b in zip([0, *ends], [*ends, len(data)])]


def test_dictionaries_end_where_the_contents_say(monkeypatch):
    monkeypatch.setattr(fingerprints, "ZERO_BITS", 6)
    monkeypatch.setattr(fingerprints, "_BLOCK", 100)
    text = bytes(np.random.default_rng(2).integers(97, 100, 5000).astype(np.uint8))
    monkeypatch.setattr(fingerprints, "KEPT", 100_000)
    assert len(pieces(text)) > 20
    want = set().union(*map(phrases, pieces(text)))
    assert len(phrase_hashes(text)) == len(want)
    for cut in (0, 3, 700, 4999, *[4 + sum(map(len, pieces(text)[:k])) for k in (1, 2)]):
        parser = fingerprints.Parser().feed(text[:cut])
        parser.copy().feed(b"elsewhere")
        assert np.array_equal(parser.feed(text[cut:]).smallest(), phrase_hashes(text))


def test_long_texts_follow_the_rule_of_short_ones():
    text = bytes(np.random.default_rng(5).integers(97, 123, 3_000_000).astype(np.uint8))
    edited = text[:1000] + b"a word more" + text[1000:]
    longer = text + bytes(np.random.default_rng(6).integers(97, 123, 600_000).astype(np.uint8))
    hashes = phrase_hashes(text)
    assert likeness(hashes, phrase_hashes(edited)) > 0.75
    assert likeness(hashes, phrase_hashes(longer)) > 0.7
    assert len(phrase_hashes(b"ab" * 5_000_000)) == fingerprints.KEPT


def test_neighbours_match_a_plain_loop(spark, documents):
    rows = [(k * 3, f"document {k} " * (k % 13) + "äöü" * (k % 4)) for k in range(200)]
    rows += [(1, None), (2, ""), (4, "x" * 40_000), (7, "x" * 40_000)]
    got = {r["doc_id"]: r for r in compare_neighbours(documents(rows).withColumnRenamed("lang", "part")).collect()}
    ordered = sorted((d, t or "") for d, t in rows)
    assert len(got) == len(rows)
    for (d, text), (_, following) in zip(ordered, ordered[1:] + ordered[:1]):
        cut = len(text) // 4
        edited = text[: len(text) - cut] + following[:cut]
        row = got[d]
        assert row["n_chars"] == len(text)
        assert row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert row["fingerprint"] == fingerprint(text.encode())
        assert row["edited_fingerprint"] == fingerprint(edited.encode())
        parts = [unpacked(fingerprint(t.encode())) for t in (text, edited, following)]
        assert row["near_edited"] == likeness(parts[0], parts[1])
        assert row["near_next"] == likeness(parts[0], parts[2])
    assert got[4]["fingerprint"] == got[7]["fingerprint"]


def test_single_null_and_repeated_ids(spark, documents):
    assert compare_neighbours(documents([])).count() == 0
    one = compare_neighbours(documents([(9, "abcdefgh")])).collect()
    assert [(r["doc_id"], r["near_next"], r["edited_sha256"]) for r in one] == [(9, 1.0, hashlib.sha256(b"abcdefab").hexdigest())]
    odd = compare_neighbours(documents([(None, "null"), (1, "b"), (1, "a"), (1, "a")])).collect()
    assert sorted(str(r["doc_id"]) for r in odd) == ["1", "1", "1", "None"]


def test_fingerprint_column(documents):
    rows = fingerprints.fingerprints(documents([(1, None), (2, "ab"), (3, "ab")])).orderBy("doc_id").collect()
    assert [r["fingerprint"] for r in rows] == ["", fingerprint(b"ab"), fingerprint(b"ab")]
