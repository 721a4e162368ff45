"""Run counters, as aggregates.

Counting is exact because it is done on grouped rows, not by side effects of tasks
that may run twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from memberfold.functions.buckets import size_bucket
from memberfold.schemas import (
    EMPLOYEE_CATEGORY_PAIRS,
    LAST_BUCKET,
    NULL_EMPLOYEE_PAIRS,
    NUMBER_OF_CATEGORY,
    NUMBER_OF_EMPLOYEE,
    SIZE_BUCKETS,
)


def category_sizes(pairs: DataFrame) -> DataFrame:
    """``empId, n_categories``: list lengths without the lists."""
    return pairs.groupBy("empId").agg(F.count(F.lit(1)).alias("n_categories"))


def category_count_histogram(sizes: DataFrame) -> DataFrame:
    """``bucket, n_employees`` for the buckets that occur."""
    return sizes.groupBy(size_bucket(F.col("n_categories")).alias("bucket")).agg(
        F.count(F.lit(1)).alias("n_employees")
    )


def inversion_counters(size: str = "n_categories") -> list[Column]:
    """Aggregates over one row per employee; the null employee is one of them."""
    bucket = size_bucket(F.col(size))
    return [
        F.coalesce(F.sum(size), F.lit(0)).cast("bigint").alias(EMPLOYEE_CATEGORY_PAIRS),
        F.count(F.lit(1)).alias(NUMBER_OF_EMPLOYEE),
        F.coalesce(F.sum(F.when(F.col("empId").isNull(), F.col(size))), F.lit(0))
        .cast("bigint")
        .alias(NULL_EMPLOYEE_PAIRS),
        *[F.count_if(bucket == name).alias(name) for name in [*SIZE_BUCKETS, LAST_BUCKET]],
    ]


def as_report(counters: DataFrame) -> DataFrame:
    """One row of counters to ``counter, value`` rows; a counter that saw nothing is 0."""
    return counters.unpivot([], counters.columns, "counter", "value")


def counters_report(pairs: DataFrame, categories: DataFrame) -> DataFrame:
    """``counter, value`` for the inversion counters.

    ``categories`` is the category table: a category without members counts too.
    """
    counted = as_report(category_sizes(pairs).agg(*inversion_counters()))
    configured = categories.agg(F.count(F.lit(1)).alias(NUMBER_OF_CATEGORY))
    return counted.unionByName(as_report(configured))
