"""Registered queries and the SQL each is checked against.

Every query reads whole tables. The tables play these parts: a customer key (or
another key) is the employee, a priority (or the table itself) is the category.
"""

from __future__ import annotations

from collections.abc import Callable
from importlib.util import find_spec

from pyspark.sql import DataFrame, SparkSession, functions as F

from memberfold.functions.dates import compute_date, input_date, local_date
from memberfold.functions.locations import lookup_address
from memberfold.operators.categories import parse_specs, resolve_locations
from memberfold.operators.counters import (
    category_count_histogram,
    category_sizes,
    counters_report,
)
from memberfold.operators.envelope import (
    FAILURE,
    MESSAGE_OVERHEAD,
    SUCCESS,
    envelope,
    publish_outcome,
    rejected_messages,
)
from memberfold.operators.invert import as_text, employee_categories
from memberfold.operators.pairs import tag, union_tagged
from memberfold.operators.snapshots import latest_snapshot
from memberfold.plans.invert_job import run_inversion, write_inversion
from memberfold.schemas import EMPLOYEE_AVRO
from memberfold.session import shared_folder
from memberfold.sinks.delivery import Delivery, deliver
from memberfold.sources.avro import avro_format, read_key_values, read_members
from memberfold.sources.members import scan_categories

# The subpackage and its pipeline are optional; one that is there but does not import raises.
text_queries = corpus_pipeline = None
if find_spec("memberfold.llm.queries" if find_spec("memberfold.llm") else "memberfold.llm"):
    from memberfold.llm import queries as text_queries
if find_spec("corpus_pipeline") and text_queries is not None:
    import corpus_pipeline

SMOKE_DIR = "/root/testdata/sf0.001"
TOPIC = "employee-categories"
# Splits the messages of the small test tables about evenly.
SMALL_MESSAGE = 400
# The category list that comes with the orders, and a category that has no members.
PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
EMPTY_CATEGORY = "6-UNUSED"
# Category id -> table and the key that plays the employee.
SOURCES = {
    "customer": "c_custkey",
    "events": "user_id",
    "lineitem": "l_suppkey",
    "orders": "o_custkey",
    "part": "p_partkey",
    "supplier": "s_suppkey",
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _order_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tag(_table(spark, sf_dir, "orders"), F.col("o_orderpriority"), "o_custkey")


def _source_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return union_tagged({name: (_table(spark, sf_dir, name), key) for name, key in SOURCES.items()})


def _order_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return employee_categories(_order_pairs(spark, sf_dir), PRIORITIES)


def _write_members(
    spark: SparkSession, sf_dir: str, *subfolders: str
) -> tuple[str, list[tuple[str, str]]]:
    """Orders as Employee records in Avro, one folder per priority.

    Returns the folder and ``(category id, location)`` of every priority.
    """
    folder = shared_folder(spark, "members")
    orders = _table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("empid"),
        F.col("o_orderdate").cast("date").cast("string").alias("empdate"),
        F.lit(None).cast("string").alias("email"),
        F.lit(None).cast("string").alias("phone"),
        F.col("o_orderstatus").alias("empdata"),
        F.col("o_orderpriority").alias("category_id"),
        F.col("o_orderstatus").alias("status"),
    )
    (
        orders.drop(*({"status"} - set(subfolders)))
        .write.format(avro_format(spark))
        .option("avroSchema", EMPLOYEE_AVRO)
        .partitionBy("category_id", *subfolders)
        .save(folder)
    )
    return folder, [(id_, f"{folder}/category_id={id_}") for id_ in PRIORITIES]


def scan_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tag(_table(spark, sf_dir, "orders"), "orders", "o_custkey")


def scan_members_avro(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, _ = _write_members(spark, sf_dir)
    return tag(read_members(spark, folder), F.col("empdata"))


def scan_many_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, locations = _write_members(spark, sf_dir)
    return scan_categories(spark, locations)


def scan_nested_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every priority's folder has a subfolder for each order status."""
    _, locations = _write_members(spark, sf_dir, "status")
    return scan_categories(spark, locations)


def employee_categories_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _order_records(spark, sf_dir).select(
        "empId", F.to_json("categoryInfoList").alias("category_info_list")
    )


def employee_categories_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_text(_order_records(spark, sf_dir))


def employee_categories_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_text(employee_categories(_source_pairs(spark, sf_dir), list(SOURCES)))


def histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = tag(_table(spark, sf_dir, "lineitem"), F.col("l_returnflag"), "l_orderkey")
    return category_count_histogram(category_sizes(pairs))


def counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = [(id_,) for id_ in (*PRIORITIES, EMPTY_CATEGORY)]
    return counters_report(
        _order_pairs(spark, sf_dir), spark.createDataFrame(ids, "category_id string")
    )


def kv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "kv")
    write_inversion(_order_pairs(spark, sf_dir), list(PRIORITIES), folder)
    return as_text(read_key_values(spark, folder))


def kv_named_employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in progress have no employee; the output replaces one of all orders."""
    folder = shared_folder(spark, "kv")
    orders = _table(spark, sf_dir, "orders")
    write_inversion(_order_pairs(spark, sf_dir), list(PRIORITIES), folder)
    employee = F.when(F.col("o_orderstatus") != "P", F.col("o_custkey"))
    pairs = tag(orders.withColumn("employee", employee), F.col("o_orderpriority"), "employee")
    write_inversion(pairs, list(PRIORITIES), folder, mode="overwrite", drop_null_keys=True)
    return as_text(read_key_values(spark, folder))


def inversion_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job: spec, locations, Avro scans, inversion, key/value output."""
    _, locations = _write_members(spark, sf_dir)
    spec = "_".join(f"{id_}#{id_.lower()}" for id_ in PRIORITIES)
    located = spark.createDataFrame(locations, "category_id string, location string")
    bodies = located.select("category_id", F.to_json(F.struct("location")).alias("body"))
    output = shared_folder(spark, "inversion")
    run_inversion(spark, spec, bodies, output)
    return as_text(read_key_values(spark, output))


def category_spec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A spec per line item: the supplier's id comes twice, and a trailing delimiter ends it."""
    entries = F.concat_ws(
        "_",
        F.concat_ws("#", F.col("l_suppkey").cast("string"), "l_returnflag"),
        F.concat_ws(
            "#",
            F.concat(F.lit("p"), F.col("l_partkey").cast("string")),
            "l_linestatus",
            "l_returnflag",
        ),
        F.concat_ws("#", F.col("l_suppkey").cast("string"), "l_linestatus"),
        F.lit(""),
    )
    return parse_specs(_table(spark, sf_dir, "lineitem"), entries, "l_orderkey", "l_linenumber")


def resolve_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events").withColumn(
        "category_id", F.col("event_id").cast("string")
    )
    categories = events.select(
        "category_id", lookup_address("http://locations/", F.col("category_id")).alias("address")
    )
    bodies = events.select("category_id", F.col("props").alias("body"))
    return resolve_locations(categories, bodies, field="k")


def latest_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers, orders = _table(spark, sf_dir, "customer"), _table(spark, sf_dir, "orders")
    day = F.col("o_orderdate").cast("date").cast("string")
    roots = customers.select(F.col("c_custkey").cast("string").alias("root"))
    listing = orders.select(
        F.col("o_custkey").cast("string").alias("root"),
        F.concat(F.lit("/snapshots/"), day).alias("path"),
    )
    return latest_snapshot(roots, listing)


def run_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind, ts = F.col("event_type"), F.col("ts")
    origin = F.when(kind == "error", "manual__").otherwise("scheduled__")
    run_id = F.concat(origin, F.col("event_id"))
    configured = F.when(kind == "view", "2023-05-05").when(kind == "click", "")
    return _table(spark, sf_dir, "events").select(
        "event_id",
        local_date(ts).alias("local_date"),
        compute_date(run_id, ts, configured).alias("compute_date"),
        input_date(run_id, ts, configured).alias("input_date"),
    )


def publish_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return envelope(_order_records(spark, sf_dir), TOPIC)


def publish_envelope_unkeyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return envelope(_order_records(spark, sf_dir), TOPIC, keyed=False)


def outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish_outcome(publish_envelope(spark, sf_dir), max_bytes=SMALL_MESSAGE)


def publish_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejected_messages(publish_envelope(spark, sf_dir), max_bytes=SMALL_MESSAGE)


def _delivered(spark: SparkSession, sf_dir: str) -> tuple[Delivery, str]:
    """Messages sent to files; those that are too large are left to the log."""
    folder = shared_folder(spark, "sent")
    client, settings = "memberfold.sinks.clients:FolderClient", {"path": folder}
    messages = publish_envelope(spark, sf_dir)
    log = shared_folder(spark, "delivery")
    return deliver(messages, client, settings, log, True, SMALL_MESSAGE, MESSAGE_OVERHEAD), folder


def publish_delivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What became of each message; a repeated task may have sent one more than once."""
    delivery, folder = _delivered(spark, sf_dir)
    sent = spark.read.schema("topic string, key string, value string").json(folder).distinct()
    rejected = delivery.rejected(spark).drop("reason")
    status = lambda frame, name: frame.withColumn("status", F.lit(name))
    return status(sent, SUCCESS).unionByName(status(rejected, FAILURE))


def publish_delivery_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counters that the sink's tasks committed."""
    counters = _delivered(spark, sf_dir)[0].counters()
    return spark.createDataFrame(list(counters.items()), "counter string, value long")


def run_dates_zoned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dates of events whose time is a ``timestamp``, a point in time."""
    events = _table(spark, sf_dir, "events")
    micros = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)")
    at = F.timestamp_micros(micros)
    run_id = F.concat(F.lit("manual__"), F.col("event_id"))
    return events.select(
        "event_id",
        local_date(at).alias("local_date"),
        compute_date(run_id, at, F.lit("")).alias("compute_date"),
    )


def entry(spark: SparkSession) -> DataFrame:
    """The inversion, on the smallest tables."""
    return employee_categories_text(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "scan_members": scan_members,
        "scan_members_avro": scan_members_avro,
        "scan_many_sources": scan_many_sources,
        "scan_nested_sources": scan_nested_sources,
        "union_tagged": _source_pairs,
        "employee_categories": employee_categories_text,
        "employee_categories_nested": employee_categories_nested,
        "employee_categories_sources": employee_categories_sources,
        "category_count_histogram": histogram,
        "counters_report": counters,
        "kv_roundtrip": kv_roundtrip,
        "kv_named_employees": kv_named_employees,
        "inversion_job": inversion_job,
        "category_spec": category_spec,
        "resolve_location": resolve_location,
        "latest_snapshot": latest_snapshots,
        "run_dates": run_dates,
        "publish_envelope": publish_envelope,
        "publish_envelope_unkeyed": publish_envelope_unkeyed,
        "publish_outcome": outcome,
        "publish_rejected": publish_rejected,
        "publish_delivered": publish_delivered,
        "publish_delivery_counters": publish_delivery_counters,
        "run_dates_zoned": run_dates_zoned,
        **_text_queries(),
    }


def _text_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {} if text_queries is None else text_queries.queries()
    return found if corpus_pipeline is None else {**found, "pipeline": corpus_pipeline.run}


def _text_sql() -> dict[str, str]:
    found = {} if text_queries is None else text_queries.oracle_sql()
    if corpus_pipeline is None or corpus_pipeline.ORACLE_SQL is None:
        return found
    return {**found, "pipeline": corpus_pipeline.ORACLE_SQL}


_SOURCE_PAIRS_SQL = " UNION ALL ".join(
    f"SELECT CAST({key} AS VARCHAR) AS \"empId\", '{name}' AS \"categoryId\" FROM {name}"
    for name, key in SOURCES.items()
)

_ORDER_LISTS_SQL = """
    SELECT CAST(o_custkey AS VARCHAR) AS "empId", CAST(count(*) AS BIGINT) AS n_categories,
           string_agg(o_orderpriority, ',' ORDER BY o_orderpriority) AS categories
    FROM orders GROUP BY o_custkey
"""

_RECORD_VALUE_SQL = """
    SELECT CAST(o_custkey AS VARCHAR) AS emp,
           '{"empId":"' || CAST(o_custkey AS VARCHAR) || '","categoryInfoList":['
           || string_agg('{"categoryId":"' || o_orderpriority || '"}', ',' ORDER BY o_orderpriority)
           || ']}' AS value
    FROM orders GROUP BY o_custkey
"""

_ORDER_SIZES_SQL = "SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey"

_OUTCOME_SQL = f"""
    WITH sizes AS (SELECT strlen(value) + strlen(emp) + {MESSAGE_OVERHEAD} AS bytes FROM ({_RECORD_VALUE_SQL}))
    SELECT 'KAFKA_SUCCESS' AS counter,
           CAST(count(*) FILTER (bytes <= {SMALL_MESSAGE}) AS BIGINT) AS value FROM sizes
    UNION ALL
    SELECT 'KAFKA_FAILURES', CAST(count(*) FILTER (bytes > {SMALL_MESSAGE}) AS BIGINT)
    FROM sizes"""

_BUCKET_SQL = """CASE n WHEN 1 THEN 'ONE_CATEGORY' WHEN 2 THEN 'TWO_CATEGORIES'
    WHEN 3 THEN 'THREE_CATEGORIES' WHEN 4 THEN 'FOUR_CATEGORIES' WHEN 5 THEN 'FIVE_CATEGORIES'
    ELSE 'MORE_THAN_FIVE_CATEGORIES' END"""


def oracle_sql() -> dict[str, str]:
    return {
        "scan_members": """
            SELECT CAST(o_custkey AS VARCHAR) AS "empId", 'orders' AS "categoryId" FROM orders""",
        "scan_members_avro": """
            SELECT CAST(o_custkey AS VARCHAR) AS "empId", o_orderstatus AS "categoryId" FROM orders""",
        "scan_many_sources": """
            SELECT CAST(o_custkey AS VARCHAR) AS "empId", o_orderpriority AS "categoryId" FROM orders""",
        "scan_nested_sources": """
            SELECT CAST(o_custkey AS VARCHAR) AS "empId", o_orderpriority AS "categoryId" FROM orders""",
        "union_tagged": _SOURCE_PAIRS_SQL,
        "employee_categories": _ORDER_LISTS_SQL,
        "employee_categories_nested": """
            SELECT CAST(o_custkey AS VARCHAR) AS "empId",
                   '[' || string_agg('{"categoryId":"' || o_orderpriority || '"}', ','
                                     ORDER BY o_orderpriority) || ']' AS category_info_list
            FROM orders GROUP BY o_custkey""",
        "employee_categories_sources": f"""
            SELECT "empId", CAST(count(*) AS BIGINT) AS n_categories,
                   string_agg("categoryId", ',' ORDER BY "categoryId") AS categories
            FROM ({_SOURCE_PAIRS_SQL}) GROUP BY "empId\"""",
        "category_count_histogram": f"""
            SELECT {_BUCKET_SQL} AS bucket, CAST(count(*) AS BIGINT) AS n_employees
            FROM (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey) GROUP BY 1""",
        "counters_report": f"""
            WITH sizes AS ({_ORDER_SIZES_SQL})
            SELECT 'EMPLOYEE_CATEGORY_PAIRS' AS counter, CAST(sum(n) AS BIGINT) AS value FROM sizes
            UNION ALL SELECT 'NUMBER_OF_EMPLOYEE', CAST(count(*) AS BIGINT) FROM sizes
            UNION ALL SELECT 'NULL_EMPLOYEE_PAIRS',
                             CAST(coalesce(sum(n) FILTER (o_custkey IS NULL), 0) AS BIGINT) FROM sizes
            UNION ALL SELECT 'NUMBER_OF_CATEGORY',
                             CAST(count(DISTINCT o_orderpriority) + 1 AS BIGINT) FROM orders
            UNION ALL SELECT 'ONE_CATEGORY', CAST(count(*) FILTER (n = 1) AS BIGINT) FROM sizes
            UNION ALL SELECT 'TWO_CATEGORIES', CAST(count(*) FILTER (n = 2) AS BIGINT) FROM sizes
            UNION ALL SELECT 'THREE_CATEGORIES', CAST(count(*) FILTER (n = 3) AS BIGINT) FROM sizes
            UNION ALL SELECT 'FOUR_CATEGORIES', CAST(count(*) FILTER (n = 4) AS BIGINT) FROM sizes
            UNION ALL SELECT 'FIVE_CATEGORIES', CAST(count(*) FILTER (n = 5) AS BIGINT) FROM sizes
            UNION ALL SELECT 'MORE_THAN_FIVE_CATEGORIES',
                             CAST(count(*) FILTER (n > 5) AS BIGINT) FROM sizes""",
        "kv_roundtrip": _ORDER_LISTS_SQL,
        "kv_named_employees": _ORDER_LISTS_SQL.replace("FROM orders", "FROM orders WHERE o_orderstatus <> 'P'"),
        "inversion_job": _ORDER_LISTS_SQL,
        "category_spec": """
            SELECT l_orderkey, l_linenumber, CAST(l_suppkey AS VARCHAR) AS category_id,
                   l_linestatus AS category_name FROM lineitem
            UNION ALL
            SELECT l_orderkey, l_linenumber, 'p' || CAST(l_partkey AS VARCHAR), l_linestatus
            FROM lineitem""",
        "resolve_location": """
            SELECT CAST(event_id AS VARCHAR) AS category_id,
                   'http://locations/' || CAST(event_id AS VARCHAR) || '/ACCOUNTID' AS address,
                   json_extract_string(props, '$.k') AS location
            FROM events""",
        "latest_snapshot": """
            SELECT CAST(c_custkey AS VARCHAR) AS root, coalesce(latest, '') AS latest
            FROM customer LEFT JOIN (
                SELECT o_custkey, max('/snapshots/' || strftime(o_orderdate, '%Y-%m-%d')) AS latest
                FROM orders GROUP BY o_custkey) ON o_custkey = c_custkey""",
        "run_dates": """
            WITH runs AS (
                SELECT event_id, event_type, CAST(ts + INTERVAL '5 hours 30 minutes' AS DATE) AS day
                FROM events),
            computed AS (
                SELECT event_id, day, CASE event_type WHEN 'error' THEN day - 1
                    WHEN 'view' THEN DATE '2023-05-05' ELSE day END AS compute_day
                FROM runs)
            SELECT event_id, strftime(day, '%Y-%m-%d') AS local_date,
                   strftime(compute_day, '%Y-%m-%d') AS compute_date,
                   strftime(compute_day - 1, '%Y-%m-%d') AS input_date
            FROM computed""",
        "publish_envelope": f"""
            SELECT '{TOPIC}' AS topic, emp AS key, value FROM ({_RECORD_VALUE_SQL})""",
        "publish_envelope_unkeyed": f"""
            SELECT '{TOPIC}' AS topic, CAST(NULL AS VARCHAR) AS key, value
            FROM ({_RECORD_VALUE_SQL})""",
        "publish_outcome": _OUTCOME_SQL,
        "publish_delivery_counters": _OUTCOME_SQL,
        "publish_delivered": f"""
            SELECT '{TOPIC}' AS topic, emp AS key, value,
                   CASE WHEN strlen(value) + strlen(emp) + {MESSAGE_OVERHEAD} <= {SMALL_MESSAGE}
                        THEN 'SUCCESS' ELSE 'FAILURE' END AS status
            FROM ({_RECORD_VALUE_SQL})""",
        "publish_rejected": f"""
            SELECT '{TOPIC}' AS topic, emp AS key, value FROM ({_RECORD_VALUE_SQL})
            WHERE strlen(value) + strlen(emp) + {MESSAGE_OVERHEAD} > {SMALL_MESSAGE}""",
        "run_dates_zoned": """
            SELECT event_id, strftime(day, '%Y-%m-%d') AS local_date,
                   strftime(day - 1, '%Y-%m-%d') AS compute_date
            FROM (SELECT event_id, CAST(ts + INTERVAL '5 hours 30 minutes' AS DATE) AS day FROM events)""",
        **_text_sql(),
    }
