"""Bucket of an employee by the number of categories."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from memberfold.schemas import LAST_BUCKET, SIZE_BUCKETS


def size_bucket(size: Column) -> Column:
    """Named bucket for a list length of 1 to 5, the last bucket for any other."""
    first, *others = enumerate(SIZE_BUCKETS, start=1)
    chain = reduce(
        lambda column, item: column.when(size == item[0], item[1]),
        others,
        F.when(size == first[0], first[1]),
    )
    return chain.otherwise(LAST_BUCKET)
