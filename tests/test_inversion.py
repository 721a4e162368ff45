"""The inversion on hand-made rows, including large lists."""

from collections import Counter

import pytest

from memberfold.operators import invert
from memberfold.operators.counters import (
    as_report,
    category_count_histogram,
    category_sizes,
    counters_report,
    inversion_counters,
)
from memberfold.operators.invert import as_text, employee_categories, membership_counts
from memberfold.operators.pairs import category_ids, tag, union_all, union_tagged
from memberfold.schemas import LAST_BUCKET, SIZE_BUCKETS

PAIRS = "empId string, categoryId string"


@pytest.fixture(params=["wide", "long"])
def strategy(request, monkeypatch):
    if request.param == "long":
        monkeypatch.setattr(invert, "WIDE_CATEGORIES", 0)
    return request.param


def lists(records):
    """{employee: sorted list}, joined over an employee's records."""
    found = {}
    for row in records.collect():
        found.setdefault(row.empId, []).extend(info.categoryId for info in row.categoryInfoList)
    return {employee: sorted(ids) for employee, ids in found.items()}


def brute_force(rows):
    found = {}
    for employee, category in rows:
        found.setdefault(employee, []).append(category)
    return {employee: sorted(ids) for employee, ids in found.items()}


def report(frame):
    return {row.counter: row.value for row in frame.collect()}


def test_null_employee_and_repeats_are_kept(spark, strategy):
    rows = [(None, "a"), (None, "b"), ("e", "a"), ("e", "a"), ("f", "b")]
    records = employee_categories(spark.createDataFrame(rows, PAIRS), ["a", "b"])
    assert lists(records) == {None: ["a", "b"], "e": ["a", "a"], "f": ["b"]}


def test_lists_are_sorted_by_id_in_byte_order(spark, strategy):
    rows = [("e", c) for c in ["10", "9", "é", "a", "Z"]]
    pairs = spark.createDataFrame(rows, PAIRS)
    text = as_text(employee_categories(pairs, ["9", "10", "a", "Z", "é"])).first()
    assert text.categories == "10,9,Z,a,é"
    assert text.n_categories == 5


def test_both_strategies_agree_with_brute_force_on_skewed_rows(spark, strategy):
    # one employee holds a third of the rows, the null one another
    rows = [("hot", f"c{i % 7}") for i in range(3000)]
    rows += [(None, f"c{i % 5}") for i in range(3000)]
    rows += [(f"e{i % 500}", f"c{i % 6}") for i in range(3000)]
    pairs = spark.createDataFrame(rows, PAIRS)
    records = employee_categories(pairs, [f"c{i}" for i in range(7)])
    assert lists(records) == brute_force(rows)
    assert records.count() == 502


def test_one_record_an_employee_however_long_its_list(spark, strategy):
    hot = spark.range(1_200_000).selectExpr("'hot' AS empId", "concat('c', id % 3) AS categoryId")
    rest = spark.createDataFrame([(f"e{k % 1000}", "c0") for k in range(3000)], PAIRS)
    records = employee_categories(hot.unionAll(rest), ["c0", "c1", "c2"])
    sizes = records.selectExpr("empId", "size(categoryInfoList) AS n").collect()
    assert Counter(row.empId for row in sizes).most_common(1)[0][1] == 1
    assert {row.empId: row.n for row in sizes}["hot"] == 1_200_000 and len(sizes) == 1001


def test_list_that_no_row_can_hold_raises(spark, strategy, monkeypatch):
    monkeypatch.setattr(invert, "ROW_BYTES", 40 * 100)
    pairs = spark.createDataFrame([("hot", "a")] * 130 + [("e", "a")], PAIRS)
    with pytest.raises(Exception, match="employee hot has 130 entries"):
        employee_categories(pairs, ["a"]).collect()
    assert employee_categories(pairs.where("empId = 'e'"), ["a"]).count() == 1


def test_categories_without_a_list(spark):
    rows = [("e", "b"), ("e", "a"), ("e", "b"), (None, "x"), ("f", None)]
    found = membership_counts(spark.createDataFrame(rows, PAIRS)).table().collect()
    assert {r.empId: (r.n_categories, [tuple(x) for x in r.runs]) for r in found} == {
        "e": (3, [("a", 1), ("b", 2)]), None: (1, [("x", 1)]), "f": (1, [(None, 1)])
    }


def test_unlisted_category_raises(spark, strategy):
    pairs = spark.createDataFrame([("e", "a"), ("e", "x")], PAIRS)
    with pytest.raises(Exception, match="category not in the list"):
        employee_categories(pairs, ["a"]).collect()


def test_null_category_raises(spark, strategy):
    pairs = spark.createDataFrame([("e", "a"), ("e", None)], PAIRS)
    with pytest.raises(Exception, match="category not in the list"):
        employee_categories(pairs, ["a"]).collect()
    with pytest.raises(ValueError, match="null"):
        category_ids(pairs)


def test_runs(spark, strategy):
    rows = [("e", "b"), ("e", "a"), ("e", "b"), (None, "a")]
    table = membership_counts(spark.createDataFrame(rows, PAIRS), ["a", "b", "c"]).table()
    found = {row.empId: (row.n_categories, [tuple(run) for run in row.runs]) for row in table.collect()}
    assert found == {"e": (3, [("a", 1), ("b", 2)]), None: (1, [("a", 1)])}


def test_no_rows(spark, strategy):
    pairs = spark.createDataFrame([], PAIRS)
    assert employee_categories(pairs, ["a"]).collect() == []


def test_no_categories_is_refused(spark):
    with pytest.raises(ValueError, match="no categories"):
        membership_counts(spark.createDataFrame([], PAIRS), [])


def test_too_many_categories_are_refused(spark, monkeypatch):
    monkeypatch.setattr("memberfold.operators.pairs.MAX_CATEGORIES", 2)
    pairs = spark.createDataFrame([("e", "a"), ("e", "b"), ("e", "c")], PAIRS)
    with pytest.raises(ValueError, match="more than 2"):
        category_ids(pairs)


def test_union_keeps_duplicates(spark):
    members = spark.createDataFrame([("e", "x"), ("e", "y"), (None, "z")], "empid string, email string")
    pairs = union_tagged({"1": (members, "empid"), "2": (members.limit(1), "empid")})
    assert sorted(map(tuple, pairs.collect()), key=str) == sorted(
        [("e", "1"), ("e", "1"), (None, "1"), ("e", "2")], key=str
    )


def test_counters(spark):
    rows = [(None, "a"), (None, "b"), ("e", "a"), ("e", "a"), ("f", "a")]
    rows += [("g", c) for c in "aabbcc"]
    pairs = spark.createDataFrame(rows, PAIRS)
    categories = spark.createDataFrame([("a",), ("b",), ("c",), ("empty",)], "category_id string")
    assert report(counters_report(pairs, categories)) == {
        "EMPLOYEE_CATEGORY_PAIRS": 11,
        "NUMBER_OF_EMPLOYEE": 4,
        "NULL_EMPLOYEE_PAIRS": 2,
        "NUMBER_OF_CATEGORY": 4,
        "ONE_CATEGORY": 1,
        "TWO_CATEGORIES": 2,
        "THREE_CATEGORIES": 0,
        "FOUR_CATEGORIES": 0,
        "FIVE_CATEGORIES": 0,
        "MORE_THAN_FIVE_CATEGORIES": 1,
    }


def test_counters_of_nothing_are_zero(spark):
    empty = spark.createDataFrame([], PAIRS)
    assert set(report(as_report(category_sizes(empty).agg(*inversion_counters()))).values()) == {0}


def test_histogram_has_every_bucket(spark):
    rows = [(f"e{n}", "a") for n in range(1, 8) for _ in range(n)]
    sizes = category_sizes(spark.createDataFrame(rows, PAIRS))
    found = {row.bucket: row.n_employees for row in category_count_histogram(sizes).collect()}
    assert found == {**{name: 1 for name in SIZE_BUCKETS}, LAST_BUCKET: 2}


def test_counters_agree_with_lists(spark):
    rows = [(f"e{i * i % 83}", f"c{i % 4}") for i in range(1000)]
    pairs = spark.createDataFrame(rows, PAIRS)
    found = report(counters_report(pairs, pairs.select("categoryId").distinct()))
    expected = brute_force(rows)
    assert found["EMPLOYEE_CATEGORY_PAIRS"] == sum(map(len, expected.values()))
    assert found["NUMBER_OF_EMPLOYEE"] == len(expected)
    assert sum(found[name] for name in [*SIZE_BUCKETS, LAST_BUCKET]) == len(expected)


def test_pairs_from_many_frames(spark):
    frames = [tag(spark.createDataFrame([(str(i),)], "empid string"), f"c{i}") for i in range(5)]
    assert union_all(frames).count() == 5
