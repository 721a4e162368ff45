import random

import pytest

from memberfold.llm import ngram_join
from memberfold.llm.components import components
from memberfold.llm.ngram_join import near_groups, representatives


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} - {()}


def brute(rows):
    sets = [(d, shingles(t)) for d, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            if a and b and min(len(a), len(b)) * 100 >= max(len(a), len(b)) * 80:
                if 100 * len(a & b) >= 80 * len(a | b):
                    root[find(i)] = find(j)
    names = {}
    for i, (d, _) in enumerate(sets):
        if d is not None:
            names[find(i)] = min(d, names.get(find(i), d))
    return sorted((str(d), len(s), str(names.get(find(i)))) for i, (d, s) in enumerate(sets))


@pytest.fixture
def rows():
    rng = random.Random(3)
    text = lambda n: [f"w{rng.randrange(2000)}" for _ in range(n)]
    out, number = [], 0
    common = text(40)
    for size, copies, edits in [(60, 80, 2), (150, 60, 5), (20, 20, 1), (9, 12, 1), (300, 15, 9), (5, 6, 1), (3, 5, 1)]:
        base = text(size)
        for _ in range(copies):
            words = list(base)
            for _ in range(rng.randrange(edits + 1)):
                at = rng.randrange(len(words))
                if rng.random() < 0.3:
                    words[at : at + 1] = []
                else:
                    words[at : at + 1] = text(rng.randrange(1, 3))
            out.append((number * 7 % 1009, " ".join(words)))
            number += 1
    base = text(100)
    for n in range(80, 130, 3):  # sets inside one another, about the limit
        out.append((2000 - n, " ".join((base + common)[:n])))
    for _ in range(30):  # a passage that many share, which links nothing
        out.append((number * 7 % 1009, " ".join(text(rng.randrange(60)) + common + text(90))))
        number += 1
    out += [(5000 + k, "exact copy of these words here") for k in range(30)] + [(4000, "EXACT copy of these words here")]
    out += [(6000, None), (6001, ""), (6002, " \n"), (6003, ""), (None, out[0][1]), (None, "no id at all"), (6004, out[3][1]), (6004, out[3][1]), (6004, "x y")]
    return out


@pytest.mark.parametrize("block", [256, 5])
def test_groups_match_all_pairs(documents, rows, block, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_DOCUMENTS", block)
    frame = documents(rows).withColumnRenamed("lang", "n").withColumnRenamed("source", "sid")
    got = [tuple(r) for r in near_groups(frame).collect()]
    assert sorted((str(d), n, str(c)) for d, n, c in got) == brute(rows)


def test_without_rows_or_words(documents):
    assert near_groups(documents([])).count() == 0
    got = near_groups(documents([(2, None), (1, "")])).collect()
    assert sorted(tuple(r) for r in got) == [(1, 0, 1), (2, 0, 2)]


def test_one_of_each_group_stays(documents):
    near = " ".join(f"w{k}" for k in range(100))
    rows = [(3, near), (2, near + " more"), (9, "something else entirely here now"), (4, None), (5, None), (2, near + " more"), (None, near)]
    kept = representatives(documents(rows))
    assert kept.columns == documents(rows).columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["2", "4", "5", "9", "None"]


def test_unlike_texts_of_one_id_stay_for_each_group(documents):
    near, other = " ".join(f"w{k}" for k in range(100)), " ".join(f"v{k}" for k in range(50))
    third = " ".join(f"u{k}" for k in range(50))
    rows = [(3, near), (5, near + " more"), (5, other), (5, other.upper()), (5, third), (5, None), (5, ""), (7, third + " x"), (8, "a b c")]
    for given in (rows, rows[::-1]):
        kept = representatives(documents(given)).collect()
        want = [(3, near), (5, None), (5, other.upper()), (5, third), (8, "a b c")]
        assert sorted(((r["doc_id"], r["text"]) for r in kept), key=str) == sorted(want, key=str)


def test_one_of_each_group_is_found_in_a_bounded_number_of_jobs(spark, documents):
    """Each query stays in the driver's memory for a while, with a thread an exchange; these rows took 104 jobs."""
    near = " ".join(f"w{k}" for k in range(100))
    rows = documents([(3, near), (2, near + " more"), (9, "something else entirely here now"), (4, None), (None, near)])
    spark.sparkContext.setJobGroup("near", "jobs of one search")
    try:
        assert representatives(rows).count() == 4
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("near")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) < 80


def test_components(spark):
    rng = random.Random(5)
    links = [(k, k + 1) for k in range(60)] + [(100, k) for k in range(101, 140)] + [(7, 7), (500, 500)]
    links += [(rng.randrange(1000, 1200), rng.randrange(1000, 1200)) for _ in range(120)]
    root = {x: x for pair in links for x in pair}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: find(x) for x in root}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
