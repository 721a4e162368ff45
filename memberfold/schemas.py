"""Record layouts, counter names and limits shared by the whole package."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Avro record names and fields of the files that are exchanged.
# The namespaces are part of the file format, as Avro resolves records by name.
# ---------------------------------------------------------------------------
RECORD_NAMESPACE = "com.main.java.avro"
KEY_VALUE_NAMESPACE = "org.apache.avro.mapreduce"
KEY_VALUE_NAME = "KeyValuePair"
EMPLOYEE_FIELDS = ["empid", "empdate", "email", "phone", "empdata"]


def _optional_string(name: str) -> dict:
    return {"name": name, "type": ["null", "string"], "default": None}


def employee_avro(fields: Sequence[str] = EMPLOYEE_FIELDS) -> str:
    """The schema of Employee records, or a reader's schema for some of their fields."""
    return json.dumps(
        {
            "type": "record",
            "name": "Employee",
            "namespace": RECORD_NAMESPACE,
            "fields": [_optional_string(name) for name in fields],
        }
    )


EMPLOYEE_AVRO = employee_avro()

_CATEGORY_INFO = {
    "type": "record",
    "name": "CategoryInfo",
    "namespace": RECORD_NAMESPACE,
    "fields": [{"name": "categoryId", "type": "string"}],
}

_EMPLOYEE_CATEGORY = {
    "type": "record",
    "name": "EmployeeCategory",
    "namespace": RECORD_NAMESPACE,
    "fields": [
        _optional_string("empId"),
        {"name": "categoryInfoList", "type": {"type": "array", "items": _CATEGORY_INFO}},
    ],
}

KEY_VALUE_AVRO = json.dumps(
    {
        "type": "record",
        "name": KEY_VALUE_NAME,
        "namespace": KEY_VALUE_NAMESPACE,
        "fields": [
            {"name": "key", "type": "string"},
            {"name": "value", "type": _EMPLOYEE_CATEGORY},
        ],
    }
)

EMPLOYEE = T.StructType([T.StructField(name, T.StringType()) for name in EMPLOYEE_FIELDS])

# ---------------------------------------------------------------------------
# Counter names.
# ---------------------------------------------------------------------------
EMPLOYEE_CATEGORY_PAIRS = "EMPLOYEE_CATEGORY_PAIRS"
NUMBER_OF_EMPLOYEE = "NUMBER_OF_EMPLOYEE"
NUMBER_OF_CATEGORY = "NUMBER_OF_CATEGORY"
SIZE_BUCKETS = [
    "ONE_CATEGORY",
    "TWO_CATEGORIES",
    "THREE_CATEGORIES",
    "FOUR_CATEGORIES",
    "FIVE_CATEGORIES",
]
LAST_BUCKET = "MORE_THAN_FIVE_CATEGORIES"
# A counter of this library: pairs of the null employee, which no key/value file can hold.
NULL_EMPLOYEE_PAIRS = "NULL_EMPLOYEE_PAIRS"
KAFKA_SUCCESS = "KAFKA_SUCCESS"
KAFKA_FAILURES = "KAFKA_FAILURES"

# ---------------------------------------------------------------------------
# Limits of this library.
# ---------------------------------------------------------------------------
# Locations of categories pass through the driver and are broadcast, so their number
# is checked; a longer list is refused, never cut.
MAX_CATEGORIES = 10_000
