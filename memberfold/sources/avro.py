"""Avro scans with a reader schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from memberfold.schemas import EMPLOYEE_FIELDS, KEY_VALUE_AVRO, employee_avro

# The reader that ships inside Spark; where the external module is installed,
# set the configuration below to its short name, "avro".
BUILT_IN = "org.apache.spark.sql.avro.AvroFileFormat"
AVRO_FORMAT = "spark.memberfold.avroFormat"


def avro_format(spark: SparkSession) -> str:
    return spark.conf.get(AVRO_FORMAT, BUILT_IN)


def read_members(
    spark: SparkSession, *paths: str, fields: Sequence[str] = EMPLOYEE_FIELDS, **options: str
) -> DataFrame:
    """Employee records, only the fields wanted: the reader builds no others.

    A defaulted field that a file lacks is null, an extra one ignored.
    """
    reader = spark.read.format(avro_format(spark)).options(**options)
    return reader.option("avroSchema", employee_avro(fields)).load(list(paths))


def read_key_values(spark: SparkSession, path: str) -> DataFrame:
    """Key/value files as ``key, empId, categoryInfoList``."""
    pairs = spark.read.format(avro_format(spark)).option("avroSchema", KEY_VALUE_AVRO).load(path)
    return pairs.select("key", "value.*")
