"""Messages for publishing, and the check of what can be published."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from memberfold.operators.counters import as_report
from memberfold.schemas import KAFKA_FAILURES, KAFKA_SUCCESS

# Default of a producer's max.request.size.
MAX_MESSAGE_BYTES = 1_048_576
# What a producer adds to key and value at most when it checks that limit: 61 bytes of a
# batch, 21 of a record, two lengths of up to 5 and one of the headers.
MESSAGE_OVERHEAD = 93
SUCCESS = "SUCCESS"
FAILURE = "FAILURE"


def envelope(records: DataFrame, topic: str, keyed: bool = True) -> DataFrame:
    """``topic, key, value``: key = employee id (or null), value = the record as JSON."""
    value = F.to_json(F.struct("empId", "categoryInfoList"), {"ignoreNullFields": "false"})
    key = F.col("empId") if keyed else F.lit(None).cast("string")
    return records.select(F.lit(topic).alias("topic"), key.alias("key"), value.alias("value"))


def message_bytes() -> Column:
    """Size of a message as the producer's limit counts it."""
    key = F.coalesce(F.octet_length("key"), F.lit(0))
    return key + F.octet_length("value") + MESSAGE_OVERHEAD


def publish_status(keyed: bool = True, max_bytes: int = MAX_MESSAGE_BYTES) -> Column:
    """SUCCESS for a message that can be sent, else FAILURE.

    It must have a value, keep to the size limit and, where messages are keyed, have a
    key. The last is this library's rule: brokers take null keys, but a record without
    an employee has no use for those who read by key.
    """
    fits = F.col("value").isNotNull() & (message_bytes() <= max_bytes)
    return F.when(fits & F.col("key").isNotNull() if keyed else fits, SUCCESS).otherwise(FAILURE)


def publish_counters(status: str = "status") -> list[Column]:
    return [
        F.count_if(F.col(status) == SUCCESS).alias(KAFKA_SUCCESS),
        F.count_if(F.col(status) == FAILURE).alias(KAFKA_FAILURES),
    ]


def publish_outcome(
    messages: DataFrame, keyed: bool = True, max_bytes: int = MAX_MESSAGE_BYTES
) -> DataFrame:
    """``counter, value`` for the two publishing counters."""
    checked = messages.select(publish_status(keyed, max_bytes).alias("status"))
    return as_report(checked.agg(*publish_counters()))


def rejected_messages(
    messages: DataFrame, keyed: bool = True, max_bytes: int = MAX_MESSAGE_BYTES
) -> DataFrame:
    """The messages that cannot be sent, whole."""
    return messages.where(publish_status(keyed, max_bytes) == FAILURE)
