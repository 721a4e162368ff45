"""Key/value Avro output."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from memberfold.schemas import KEY_VALUE_AVRO
from memberfold.sinks.replace import replacing
from memberfold.sources.avro import avro_format


def key_values(records: DataFrame, drop_null_keys: bool = False) -> DataFrame:
    """``key, value`` rows: key = employee id, value = the whole record.

    The key may not be null. A null employee raises unless the caller asks to drop it.
    """
    if drop_null_keys:
        records = records.where(F.col("empId").isNotNull())
    null_key = F.raise_error(F.lit("the null employee cannot be written as a key"))
    return records.select(
        F.coalesce(F.col("empId"), null_key.cast("string")).alias("key"),
        F.struct("empId", "categoryInfoList").alias("value"),
    )


def write_key_values(
    records: DataFrame, path: str, mode: str = "errorifexists", drop_null_keys: bool = False
) -> None:
    """``mode`` is that of Spark's writer, but that ``overwrite`` replaces an older output only
    once the new one is written: a write that fails leaves the older one readable.
    """
    spark = records.sparkSession
    if mode == "overwrite":
        with replacing(spark, path) as staged:
            write_key_values(records, staged, drop_null_keys=drop_null_keys)
        return
    (
        key_values(records, drop_null_keys)
        .write.format(avro_format(spark))
        .option("avroSchema", KEY_VALUE_AVRO)
        .mode(mode)
        .save(path)
    )
