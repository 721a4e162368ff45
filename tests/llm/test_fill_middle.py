import hashlib
import random

import numpy as np
import pytest

from memberfold.llm import fill_middle, oracles
from memberfold.llm.fill_middle import BoundaryIndex, fill_in_middle, fitted_segments, restored_texts

COLUMNS = "doc_id long, text string"


def brute(doc_id, text, plain_percent=10, spm_percent=20):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[k : k + 8], 16) for k in range(0, 32, 8)]
    a, b = sorted(x % (len(text) + 1) for x in h[:2])
    p, m, s = text[:a], text[a:b], text[b:]
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 100 - plain_percent:
        return doc_id, len(text), "plain", None, None, text
    if h[3] % 100 < spm_percent:
        return doc_id, len(text), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, len(text), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def by_id(rows):
    return sorted(map(tuple, rows), key=repr)


@pytest.fixture
def rows():
    rng = random.Random(5)
    alphabets = ["ab ", "aé ", "漢字", "🎉a", "é‍", "<PSM>", "\x00\n"]
    texts = ["".join(rng.choices(rng.choice(alphabets), k=rng.choice([0, 1, 2, 30, 3000]))) for _ in range(400)]
    texts += ["<P>", "a<S>b", "<<M>", "<P", "S><", None, "", "same", "same"]
    return [(k, t) for k, t in enumerate(texts)] + [(3, texts[3]), (None, "no id, but a text"), (-7, "é")]


def test_examples_equal_brute_force(spark, rows):
    examples = fill_in_middle(spark.createDataFrame(rows, COLUMNS).repartition(4))
    assert by_id(examples.collect()) == by_id(brute(*r) for r in rows)
    assert {r.form for r in examples.collect()} == {"plain", "psm", "spm"}
    assert by_id(restored_texts(examples).collect()) == by_id((d, t or "") for d, t in rows)


def test_digests_equal_sql(spark, sql, rows):
    table = spark.createDataFrame(rows, COLUMNS)
    got = [r.asDict() for r in fill_in_middle(table, digest=True).collect()]
    want = sql(oracles.fill_in_middle(1, 10, 20), documents=table)
    key = lambda r: repr((r["doc_id"], r["n"], r["output_sha256"]))
    assert sorted(got, key=key) == sorted(want, key=key)
    assert all(r["restored_sha256"] for r in got)


def boundaries(data):
    starts = np.flatnonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)
    return np.append(starts, len(data))


@pytest.mark.parametrize("block", [1 << 20, 64, 7])
def test_index_is_exact_and_bounded(monkeypatch, block):
    monkeypatch.setattr(fill_middle, "BLOCK", block)
    rng = random.Random(3)
    mixed = "".join("".join(rng.choices(rng.choice(["a", "é", "漢🎉"]), k=rng.randrange(900))) for _ in range(60))
    for text in ("", "a", "漢", "a" * 5000, "é" * 5000, mixed):
        data = text.encode()
        index, exact = BoundaryIndex(data), boundaries(data)
        ranks = np.arange(len(text) + 1)
        assert (index.offset(ranks) == exact).all()
        assert np.abs(index.predicted(ranks) - exact).max() <= fill_middle.ERROR + 1


def test_segments_go_as_far_as_a_line_can():
    offsets = np.cumsum(np.random.default_rng(2).integers(1, 5, 5000))
    for error in (1, 8, 126):
        for start, stop, slope in fitted_segments(offsets, error):
            run = np.arange(stop - start)
            assert np.abs(offsets[start] + slope * run - offsets[start:stop]).max() <= error + 1e-6
            if stop < len(offsets):
                more = (offsets[start + 1 : stop + 1] - offsets[start]).astype(float)
                run = np.arange(1, len(more) + 1)
                assert ((more - error) / run).max() > ((more + error) / run).min()


def test_defined_cases(spark):
    assert fill_in_middle(spark.createDataFrame([], COLUMNS)).collect() == []
    extra = spark.createDataFrame([(1, "some text", "x", 9)], COLUMNS + ", form string, n int")
    assert [tuple(r) for r in fill_in_middle(extra).collect()] == [brute(1, "some text")]
    long = [(k, "aé漢 " * 1_500_000 + str(k)) for k in range(3)]
    got = fill_in_middle(spark.createDataFrame(long, COLUMNS), digest=True).collect()
    want = {d: brute(d, t)[-1] for d, t in long}
    assert {r.doc_id: r.output_sha256 for r in got} == {
        d: hashlib.sha256(x.encode()).hexdigest() for d, x in want.items()
    }


def test_shares_of_forms(spark):
    table = spark.range(4000).selectExpr("id AS doc_id", "'some text' AS text")
    forms = {r.form: r["count"] for r in fill_in_middle(table).groupBy("form").count().collect()}
    assert abs(forms["plain"] - 400) < 90 and abs(forms["spm"] - 720) < 120
    assert fill_in_middle(table, plain_percent=100).where("form = 'plain'").count() == 4000
    assert fill_in_middle(table, plain_percent=0, spm_percent=100).where("form = 'spm'").count() == 4000
