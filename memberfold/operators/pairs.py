"""(empId, categoryId) pairs: tagging and bag union."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from memberfold.schemas import MAX_CATEGORIES


def tag(members: DataFrame, category_id: Column | str, employee: str = "empid") -> DataFrame:
    """Keep the employee id and attach the category id: a plain string is a constant."""
    category = F.lit(category_id) if isinstance(category_id, str) else category_id
    return members.select(
        F.col(employee).cast("string").alias("empId"), category.alias("categoryId")
    )


def union_all(pairs: list[DataFrame]) -> DataFrame:
    """Bag union: duplicates stay."""
    return reduce(DataFrame.unionByName, pairs)


def union_tagged(sources: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """One dataset per category, given as ``{category id: (members, employee column)}``."""
    return union_all([tag(members, id_, column) for id_, (members, column) in sources.items()])


def category_ids(pairs: DataFrame) -> list[str]:
    """All category ids in ``pairs``, for data that comes without a category spec.

    Runs a job over that one column. More than ``MAX_CATEGORIES`` ids are refused.
    """
    rows = pairs.select("categoryId").distinct().limit(MAX_CATEGORIES + 1).collect()
    if len(rows) > MAX_CATEGORIES:
        raise ValueError(f"more than {MAX_CATEGORIES} categories")
    if any(row.categoryId is None for row in rows):
        raise ValueError("a category id is null")
    return sorted(row.categoryId for row in rows)
