import hashlib
import random

import pytest

from memberfold.llm import substring_dedup
from memberfold.llm.substring_dedup import Automaton, without_repeats


def brute(rows):
    first = {}
    for d, t in rows:
        words = (t or "").encode().split()
        for i in range(len(words) - 49):
            if d is not None:
                key = tuple(words[i : i + 50])
                first[key] = min(d, first.get(key, d))
    out = []
    for d, t in rows:
        words = (t or "").encode().split()
        stays = [True] * len(words)
        for i in range(len(words) - 49):
            if d is not None and first[tuple(words[i : i + 50])] < d:
                stays[i : i + 50] = [False] * 50
        kept = b" ".join(w for w, s in zip(words, stays) if s)
        out.append((str(d), len(words), stays.count(False), kept.decode()))
    return sorted(out)


@pytest.fixture
def rows():
    rng = random.Random(7)
    text = lambda n: rng.choices([f"w{k}" for k in range(3000)], k=n)
    passages = [text(n) for n in (49, 50, 51, 74, 75, 99, 130, 400)]
    out = []
    for k in range(250):
        parts = text(rng.randrange(80))
        for _ in range(rng.randrange(3)):
            p = list(rng.choice(passages))
            start = rng.randrange(0, 20) if len(p) > 80 else 0
            p = p[start : len(p) - rng.randrange(0, 20)] if len(p) > 80 else p
            if rng.random() < 0.3:
                p[rng.randrange(len(p))] = "changed"
            parts += p + text(rng.randrange(60))
        out.append((k * 7 % 251, " ".join(parts) if k % 4 else "\n".join(parts)))
    copy = out[10][1] + " " + " ".join(passages[7])
    out += [(k, copy) for k in (300, 301, 302)]
    out += [(310, "same " * 200), (311, "same " * 120), (312, "a b " * 90), (313, "b a " * 90), (314, " ".join(passages[7] * 2))]
    out += [(320, None), (321, ""), (322, " \t "), (None, copy), (None, copy), (302, copy), (302, "other " + copy), (5, copy.upper())]
    return out


@pytest.mark.parametrize("shard", [substring_dedup.SHARD_WORDS, 300])
def test_matches_every_window_of_the_input(documents, rows, shard, monkeypatch):
    monkeypatch.setattr(substring_dedup, "SHARD_WORDS", shard)
    monkeypatch.setattr(substring_dedup, "STREAM_WORDS", shard * 40)
    frame = documents(rows).withColumnRenamed("lang", "anchors").withColumnRenamed("source", "n")
    got = sorted((str(r["doc_id"]), r["n_words"], r["n_removed"], r["kept"]) for r in without_repeats(frame).collect())
    assert got == brute(rows)


def test_digest_and_empty_table(documents):
    row = without_repeats(documents([(1, " a  b\n")]), digest=True).first()
    assert tuple(row) == (1, 2, 0, hashlib.sha256(b"a b").hexdigest())
    assert without_repeats(documents([])).count() == 0


def test_words_that_share_a_symbol_are_told_apart(monkeypatch):
    monkeypatch.setattr(substring_dedup, "_SYMBOLS", 3)
    words = [f"w{k}".encode() for k in range(60)]
    automaton = Automaton([(1, b" ".join(words))])
    assert automaton.covered(2, b" ".join(words)).all()
    assert not automaton.covered(1, b" ".join(words)).any()
    assert not automaton.covered(2, b" ".join(words[:30] + words[:30])).any()


def test_without_hits_nothing_is_found_and_hits_alone_are_not_enough(monkeypatch):
    """What goes is decided by the automaton's hits, extended word by word."""
    words = [f"w{k}".encode() for k in range(200)]
    text = b" ".join(words)
    found = Automaton([(1, text)])
    assert found.covered(2, b"x " + text + b" y").tolist() == [False, *[True] * 200, False]
    # 25 + 24 words around a phrase are no window, 25 + 25 are.
    for more, good in ((24, False), (25, True)):
        part = b" ".join(words[25 : 50 + more])
        assert found.covered(2, b"x " + part + b" y").any() == good

    class Deaf:
        def iter(self, text):
            return iter(())

    class Wild:
        def iter(self, text):
            return ((end, k % 8) for k, end in enumerate(range(24, len(text))))

    found.automaton = Deaf()
    assert not found.covered(2, text).any()
    found.automaton = Wild()
    assert not found.covered(2, b" ".join(words[::-1])).any()


def test_a_phrase_of_very_many_passages(monkeypatch):
    monkeypatch.setattr(substring_dedup, "COMPARED", 64)
    license = [f"l{k}" for k in range(30)]
    passages = [(k, " ".join([f"a{k}_{j}" for j in range(25)] + license + [f"b{k}_{j}" for j in range(25)]).encode()) for k in range(300)]
    automaton = Automaton(passages)
    one = passages[250][1]
    assert automaton.covered(251, one).all() and not automaton.covered(250, one).any()
    other = " ".join([f"q{j}" for j in range(25)] + license + [f"r{j}" for j in range(25)]).encode()
    assert not automaton.covered(1000, other).any()


def test_very_long_texts(documents):
    line = " ".join(f"w{k % 977}" for k in range(400_000))
    rows = [(1, line), (2, "start " + line), (3, "x" * 3_000_000)]
    got = {r["doc_id"]: (r["n_words"], r["n_removed"]) for r in without_repeats(documents(rows)).collect()}
    assert got == {1: (400_000, 0), 2: (400_001, 400_000), 3: (1, 0)}


def test_divided_routes_lose_nothing(documents, rows, monkeypatch):
    """Routes of many passages go to several automata by the hashes of whole windows."""
    monkeypatch.setattr(substring_dedup, "ROUTE_WORDS", 100)
    monkeypatch.setattr(substring_dedup, "PART_WORDS", 1000)
    # A line in every document, around which each pair of documents has words of its own.
    line = " ".join(f"l{k}" for k in range(60))
    edged = [
        (1000 + 2 * g + c, " ".join([f"a{g}_{k}" for k in range(30)] + [line] + [f"b{g}_{k}" for k in range(30)]))
        for g in range(40)
        for c in range(2)
    ]
    got = without_repeats(documents(rows + edged)).collect()
    assert sorted((str(r["doc_id"]), r["n_words"], r["n_removed"], r["kept"]) for r in got) == brute(rows + edged)


def test_equal_texts_are_streamed_once_for_all_documents(documents, monkeypatch):
    passage = " ".join(f"p{k}" for k in range(70))
    rows = [(k, passage) for k in range(30)] + [(31, "x " + passage), (-5, passage + " y")]
    got = without_repeats(documents(rows)).collect()
    assert sorted((str(r["doc_id"]), r["n_words"], r["n_removed"], r["kept"]) for r in got) == brute(rows)
