"""What the physical plans must and must not contain."""

import re

import pytest
from pyspark.sql import Observation, functions as F

import __spark_entry__ as registered
from memberfold.operators import invert
from memberfold.operators.counters import category_count_histogram, category_sizes, inversion_counters
from memberfold.operators.envelope import envelope
from memberfold.operators.pairs import union_tagged
from memberfold.sinks.avro import write_key_values
from memberfold.sources.avro import read_key_values

SF_DIR = "/root/testdata/sf0.001"
IDS = registered.PRIORITIES


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def final_plan(frame):
    frame.collect()
    return plan(frame).split("== Initial Plan ==")[0]


@pytest.fixture(scope="module")
def order_pairs(spark):
    return registered._order_pairs(spark, SF_DIR)


OWN = set(registered.queries()) - {"pipeline"} - set(
    registered.text_queries.queries() if registered.text_queries else ()
)


@pytest.mark.parametrize("name", sorted(OWN))
def test_no_python_workers_and_no_cross_joins(spark, name):
    text = plan(registered.queries()[name](spark, SF_DIR))
    assert not re.search("EvalPython|InPandas|InArrow|PythonRDD", text)
    assert not re.search("CartesianProduct|NestedLoopJoin", text)


def test_counting_needs_one_combined_shuffle(order_pairs):
    text = plan(invert.membership_counts(order_pairs, IDS).table())
    assert re.findall(r"Exchange (\w+)\((\w+)#", text) == [("hashpartitioning", "empId")]
    assert "partial_count" in text
    assert "ObjectHashAggregate" not in text and "SortAggregate" not in text


def test_scan_reads_only_what_it_needs(order_pairs):
    text = plan(category_sizes(order_pairs))
    assert re.findall(r"ReadSchema: (\S+)", text) == ["struct<o_custkey:bigint>"]


def test_histogram_combines_before_both_shuffles(order_pairs):
    text = plan(category_count_histogram(category_sizes(order_pairs)))
    assert text.count("Exchange hashpartitioning") == 2 and text.count("partial_count") == 2


@pytest.mark.parametrize("ids, exchanges", [(IDS, ["empId"]), (None, ["empId, categoryId", "empId"])])
def test_records_come_from_one_scan_and_one_last_aggregation(order_pairs, ids, exchanges):
    counts = invert.membership_counts(order_pairs, ids)
    observed = counts.observe(Observation(), *inversion_counters())
    for each in (counts, observed):
        text = final_plan(invert.employee_records(each))
        assert text.count("FileScan") == 1 and "Union" not in text and "REPARTITION_BY" not in text
        found = [re.sub(r"#\d+L?", "", x) for x in re.findall(r"Exchange hashpartitioning\(([^)]*), \d+\)", text)]
        assert sorted(found) == sorted(exchanges)
        assert text.count("keys=[empId") == 2 * len(exchanges)  # partial and final


def test_building_a_query_runs_no_job_for_ids(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("ids", "building queries")
    for name in ("employee_categories", "employee_categories_nested", "publish_envelope", "publish_outcome"):
        registered.queries()[name](spark, SF_DIR)
    jobs = tracker.getJobIdsForGroup("ids")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # Reading a table's schema may take a job; none has the shuffle of distinct ids.
    assert all(len(tracker.getJobInfo(j).stageIds) == 1 for j in jobs)


def test_source_tags_become_constants(spark):
    tables = {"orders": "o_custkey", "customer": "c_custkey"}
    pairs = union_tagged(
        {name: (registered._table(spark, SF_DIR, name), key) for name, key in tables.items()}
    )
    text = plan(invert.membership_counts(pairs, sorted(tables)).table())
    assert "true AS" in text and "false AS" in text
    assert text.count("Exchange hashpartitioning") == 1


def test_many_sources_are_one_scan(spark):
    text = plan(registered.scan_many_sources(spark, SF_DIR))
    assert text.count("FileScan") == 1 and "Union" not in text
    assert "Exchange hashpartitioning" not in text


def test_publishing_does_not_shuffle(spark, order_pairs, tmp_path):
    records = invert.employee_categories(order_pairs, IDS)
    write_key_values(records, str(tmp_path / "kv"))
    messages = envelope(read_key_values(spark, str(tmp_path / "kv")), "t").coalesce(2)
    text = plan(messages.where(F.col("key").isNotNull()))
    assert "Exchange" not in text and "Coalesce" in text
