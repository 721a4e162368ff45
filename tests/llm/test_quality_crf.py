import itertools

import numpy as np
import pytest

from memberfold.llm import quality_crf
from memberfold.llm.quality_crf import Model, document_scores, fit, line_features, line_marginals, marginals, score, train


def by_enumeration(unary, pairs):
    n = len(unary)
    good, total = np.zeros(n), 0.0
    for labels in itertools.product((0, 1), repeat=n):
        weight = np.exp(sum(u for u, y in zip(unary, labels) if y) + sum(pairs[a][b] for a, b in zip(labels, labels[1:])))
        good += weight * np.array(labels)
        total += weight
    return good / total


def test_marginals_match_enumeration():
    rng = np.random.default_rng(0)
    chains = [rng.normal(size=n) * 2 for n in (1, 4, 7, 2, 1)]
    pairs = rng.normal(size=(2, 2))
    starts = np.concatenate([np.arange(len(c)) == 0 for c in chains])
    good, expected = marginals(np.concatenate(chains), pairs, starts)
    assert good == pytest.approx(np.concatenate([by_enumeration(c, pairs) for c in chains]))
    assert expected.sum() == pytest.approx(sum(len(c) - 1 for c in chains))


def test_neighbours_are_features():
    x, sizes = line_features(b"one line.\n\nTWO!! TWO!!\nthree lines here.")
    assert len(x) == len(sizes) == 3  # blank lines do not count
    n = quality_crf.N_OWN
    assert np.array_equal(x[1, n : 2 * n], x[0, :n]) and np.array_equal(x[1, 2 * n :], x[2, :n])
    assert not x[0, n : 2 * n].any() and x.shape[1] == 3 * n
    assert len(line_features(b"")[0]) == 1


def made(k, good):
    rng = np.random.default_rng(k)
    words = ["".join(rng.choice(list("abcdefgh"), 5)) for _ in range(30)]
    lines = [" ".join(words[i : i + 6]) + "." for i in range(0, 30, 6)]
    return "\n".join(lines if good else [x.upper().replace(" ", "!! ") for x in lines])


def test_learns_and_keeps_the_range(spark, documents):
    rows = [(k, made(k, k % 4 != 0)) for k in range(200)] + [(900, None), (901, ""), (902, "x" * 300_000), (None, made(3, True))]
    frame = documents(rows).withColumnRenamed("lang", "score")
    labels = spark.createDataFrame(
        [(k, int(k % 4 != 0)) for k in range(100)] + [(None, 1), (5, None), (6, 7)], "doc_id long, quality int"
    )
    model = train(frame, labels)
    found = score(frame, model).collect()
    assert len(found) == len(rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in found)
    assert all(r["predicted"] == int(r["doc_id"] % 4 != 0) for r in found if r["doc_id"] is not None and r["doc_id"] < 200)
    again = {r["doc_id"]: r["score"] for r in score(frame, train(frame, labels)).collect()}
    assert all(again[r["doc_id"]] == r["score"] for r in found)
    assert [r["score"] for r in found if r["doc_id"] == 900] == [r["score"] for r in found if r["doc_id"] == 901]


def test_scores_match_enumeration():
    model = fit([made(k, k % 2 == 0).encode() for k in range(40)], [int(k % 2 == 0) for k in range(40)])
    texts = [made(51, True).encode(), made(52, False).encode(), b"", made(53, True).encode() + b"\n\n" + made(54, False).encode()]
    for text, got in zip(texts, document_scores(model, texts)):
        x, sizes = line_features(text)
        good = by_enumeration(x @ model.weights, model.pairs)
        share = (good * (sizes + 1)).sum() / (sizes + 1).sum()
        assert got == pytest.approx(1 / (1 + np.exp(-model.slope * (share - model.shift))))


def test_lines_of_spliced_documents_are_told_apart():
    model = fit([made(k, k % 3 != 0).encode() for k in range(150)], [int(k % 3 != 0) for k in range(150)])
    for k in range(200, 220):
        halves = made(k, True), made(k + 100, False)
        for first in (0, 1):
            good = line_marginals(model, "\n".join((halves[first], halves[1 - first])).encode())
            mine, theirs = (good[:5], good[5:]) if first == 0 else (good[5:], good[:5])
            assert mine.min() > 0.5 > theirs.max()


def test_sample_ends_by_bytes_whatever_the_lengths(spark, documents, monkeypatch):
    rows = [(k, made(k, k % 4 != 0) * (1 + 9 * (k % 2))) for k in range(60)]
    labels = spark.createDataFrame([(k, int(k % 4 != 0)) for k in range(60)], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(quality_crf, "fit", lambda texts, labels: seen.append([len(t) for t in texts]))
    train(documents(rows), labels)
    monkeypatch.setattr(quality_crf, "SAMPLE_BYTES", 60_000)
    train(documents(rows), labels)
    assert len(seen[0]) == 60 and 0 < len(seen[1]) < 60 and seen[1] == seen[0][: len(seen[1])]
    monkeypatch.setattr(quality_crf, "SAMPLE_BYTES", 1)
    train(documents(rows), labels)
    assert len(seen[2]) == 1


def test_nothing_to_learn(spark, documents):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    model = train(documents([]), labels)
    assert score(documents([]), model).count() == 0
    assert score(documents([(1, "a")]), model).first()["predicted"] == 1
    assert document_scores(fit([b"a", b"b"], [0, 0]), [b"a"])[0] < 0.3
    assert isinstance(fit([], []), Model)
