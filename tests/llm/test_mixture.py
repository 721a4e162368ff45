import re

import pytest
from pyspark.sql import functions as F

from memberfold.llm.mixture import CAP, mixed_documents, mixture, source_targets

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def targets_by_resharing(sizes, weights=(5, 2, 1), share=1.5, cap=2.0):
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    total, fixed = share * sum(sizes.values()), {}
    while True:
        free = {s: w for s, w in weight.items() if s not in fixed}
        left = total - sum(fixed.values())
        given = {s: left * w / sum(free.values()) for s, w in free.items()}
        over = [s for s in given if given[s] >= cap * sizes[s]]
        if not over:
            return {**fixed, **given}
        fixed.update({s: cap * sizes[s] for s in over})
        if len(fixed) == len(sizes):
            return fixed


@pytest.fixture
def many(documents):
    rows = []
    for k in range(1200):
        source = ("hot", "hot", "b", "c", None, "é", "z")[k % 7]
        rows.append((k, " ".join(["w"] * (1 + k * 37 % 90 + (900 if k % 200 == 0 else 0))), source))
    rows += [(5000, None, "b"), (5001, "", "b"), (5002, " \t", "empty"), (None, "no id here", "c"), (7, "again", "c"), (7, "again", "c")]
    return documents(rows)


def test_targets_follow_the_rule(spark):
    sizes = {"a": 10, "B": 1000, "b": 5, "é": 400, None: 70, "z": 0, "c": 333, "d": 1}
    table = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r["source"]: r["target"] for r in source_targets(table).collect()}
    want = targets_by_resharing(sizes)
    assert got == pytest.approx(want)
    assert sum(got.values()) == pytest.approx(1.5 * sum(sizes.values()))


def test_mix_meets_targets_and_reruns_agree(many):
    rows = mixture(many).collect()
    assert len(rows) == many.count()
    sizes, taken, target = {}, {}, {}
    for r in rows:
        n = len(WORDS.findall(r["text"] or ""))
        assert (r["size"], 0 <= r["copies"] <= CAP) == (n, True)
        sizes[r["source"]] = sizes.get(r["source"], 0) + n
        taken[r["source"]] = taken.get(r["source"], 0) + n * r["copies"]
        target[r["source"]] = r["target"]
    assert target == pytest.approx(targets_by_resharing(sizes))
    assert all(r["source_size"] == sizes[r["source"]] for r in rows)
    for source, words in taken.items():
        assert words == pytest.approx(target[source], rel=0.03), source
    order = lambda r: (str(r["doc_id"]), r["text"] or "", r["copies"])
    again = mixture(many.repartition(5, "text")).collect()
    assert sorted(map(order, rows)) == sorted(map(order, again))


def test_rates_are_tilted_by_size(many):
    rows = mixture(many).where("source = 'hot' AND size > 0").collect()
    ratio = rows[0]["target"] / rows[0]["source_size"]
    if 1 < ratio < CAP:
        small = [r["copies"] for r in rows if r["size"] < 20]
        large = [r["copies"] for r in rows if r["size"] > 60]
        assert sum(large) / len(large) > sum(small) / len(small)


def test_mixed_rows_and_clashing_columns(many):
    clashing = many.withColumns({"size": F.lit("mine"), "copies": F.lit(-1), "key": F.lit("k"), "plan": F.lit(0)})
    mixed = mixed_documents(clashing.drop("size", "copies"))
    assert mixed.columns == clashing.drop("size", "copies").columns
    copies = mixture(clashing)
    assert mixed.count() == copies.agg(F.sum("copies")).first()[0]
    assert set(copies.columns) == {*clashing.columns, "source_size", "target"}


def test_without_words(documents):
    assert mixture(documents([])).count() == 0
    rows = mixture(documents([(1, None), (2, "")])).collect()
    assert [(r["size"], r["copies"], r["target"]) for r in rows] == [(0, 0, 0.0)] * 2


def test_a_mix_is_planned_in_a_bounded_number_of_jobs(spark, many):
    """Each query stays in the driver's memory for a while; the mix of this table took 180 jobs."""
    spark.sparkContext.setJobGroup("mix", "jobs of one mix")
    try:
        mixture(many).collect()
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("mix")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) < 130
