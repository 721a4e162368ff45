"""The inversion: employee -> list of categories, duplicates kept.

A list is first held as *runs*, one ``(categoryId, n)`` per distinct category, and
only then written out in full. Runs are counts, so they combine on the map side
and a hot employee (the null one, say) costs the shuffle no more than any other:
the number of runs is bounded by the category list, whatever the number of pairs.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, functions as F

# Up to this many categories each gets a count column of its own; see README.
WIDE_CATEGORIES = 32
# A row of Spark holds less than 2 GiB; an entry of a list takes these bytes and its id's.
ROW_BYTES = (1 << 31) - (1 << 20)
ENTRY_BYTES = 32


@dataclass(frozen=True)
class MembershipCounts:
    """Counted pairs: ``frame`` has one row per employee.

    Its columns ``empId`` and ``n_categories`` (every pair counts, repeated ones too)
    are for use; the others depend on how the counting was done. ``runs`` and
    ``whole_list`` are expressions over them: ``array<struct<categoryId, n>>``, and
    the list written out, both sorted by category id.
    """

    frame: DataFrame
    runs: Column
    whole_list: Column

    def table(self) -> DataFrame:
        """``empId, n_categories, runs``"""
        return self.frame.select("empId", "n_categories", self.runs.alias("runs"))

    def observe(self, seen: Observation, *metrics: Column) -> MembershipCounts:
        return replace(self, frame=self.frame.observe(seen, *metrics))

    def named(self, drop_null: bool) -> MembershipCounts:
        """Without the null employee, or raising for it, before any list is written out."""
        if drop_null:
            return replace(self, frame=self.frame.where(F.col("empId").isNotNull()))
        null_key = F.raise_error(F.lit("the null employee cannot be written as a key"))
        known = F.coalesce(F.col("empId"), null_key.cast("string"))
        return replace(self, frame=self.frame.withColumn("empId", known))


def _unlisted(category: Column) -> Column:
    return F.raise_error(
        F.concat(F.lit("category not in the list: "), F.coalesce(category, F.lit("null")))
    )


def _fitting(n: Column, longest: Column) -> Column:
    """The list's length, if a row can hold the list; otherwise this raises."""
    problem = F.concat(
        F.lit("list too long for one record: employee "),
        F.coalesce(F.col("empId"), F.lit("null")),
        F.lit(" has "),
        n.cast("string"),
        F.lit(" entries"),
    )
    fits = n * (longest + ENTRY_BYTES) <= ROW_BYTES
    return F.when(fits, n).otherwise(F.raise_error(problem).cast("bigint"))


def _repeated(category: Column, n: Column) -> Column:
    return F.array_repeat(F.struct(category.alias("categoryId")), n.cast("int"))


def _position(category: Column, ids: list[str]) -> Column:
    """Number of a category in the list, so that counting compares integers.

    It is a constant where the category is one, as in a union of tagged sources. A
    category outside the list raises.
    """
    listed = reduce(
        lambda chain, item: chain.when(category == item[1], item[0]),
        enumerate(ids[1:], start=1),
        F.when(category == ids[0], 0),
    )
    return listed.otherwise(_unlisted(category).cast("int"))


def _wide_counts(pairs: DataFrame, ids: list[str]) -> MembershipCounts:
    """One shuffle, on the employee: fixed-width count columns, combined map-side."""
    counted = (
        pairs.select("empId", _position(F.col("categoryId"), ids).alias("position"))
        .groupBy("empId")
        .agg(
            F.count(F.lit(1)).alias("n_pairs"),
            *[F.count_if(F.col("position") == i).alias(f"n{i}") for i in range(len(ids))],
        )
    )
    columns = [(F.lit(id_), F.col(f"n{i}")) for i, id_ in enumerate(ids)]
    every = F.array(*[F.struct(id_.alias("categoryId"), n.alias("n")) for id_, n in columns])
    longest = F.lit(max(len(id_.encode()) for id_ in ids))
    return MembershipCounts(
        counted.withColumn("n_categories", _fitting(F.col("n_pairs"), longest)).drop("n_pairs"),
        F.filter(every, lambda run: run["n"] > 0),
        F.concat(*[_repeated(id_, n) for id_, n in columns]),
    )


def _long_counts(pairs: DataFrame, ids: list[str] | None) -> MembershipCounts:
    """Two shuffles: counts per (employee, category), then at most one run per category."""
    counted = pairs.groupBy("empId", "categoryId").agg(F.count(F.lit(1)).alias("n"))
    if ids is not None:
        listed = pairs.sparkSession.createDataFrame([(id_,) for id_ in ids], "listed string")
        joined = counted.join(listed, F.col("categoryId") == F.col("listed"), "left")
        checked = F.coalesce(F.col("listed"), _unlisted(F.col("categoryId")).cast("string"))
        counted = joined.select("empId", checked.alias("categoryId"), "n")
    listed = counted.groupBy("empId").agg(
        F.sum("n").alias("n_pairs"),
        F.max(F.octet_length("categoryId")).alias("longest"),
        F.sort_array(F.collect_list(F.struct("categoryId", "n"))).alias("runs"),
    )
    fitting = _fitting(F.col("n_pairs"), F.coalesce("longest", F.lit(0)))
    written_out = F.transform("runs", lambda run: _repeated(run["categoryId"], run["n"]))
    return MembershipCounts(
        listed.select("empId", fitting.alias("n_categories"), "runs"),
        F.col("runs"),
        F.flatten(written_out),
    )


def membership_counts(pairs: DataFrame, ids: Sequence[str] | None = None) -> MembershipCounts:
    """Count the pairs of every employee by category.

    ``ids`` is the complete category list; a pair outside it raises. Without it any
    category is taken as it comes, a null one too.
    """
    if ids is None:
        return _long_counts(pairs, None)
    ids = sorted(set(ids))
    if not ids:
        raise ValueError("no categories")
    return (_wide_counts if len(ids) <= WIDE_CATEGORIES else _long_counts)(pairs, ids)


def employee_records(counts: MembershipCounts) -> DataFrame:
    """``empId, categoryInfoList array<struct<categoryId>>``: one record an employee, lists sorted.

    A list that one row cannot hold raises, with the employee and the length.
    """
    whole = counts.whole_list.alias("categoryInfoList")
    # The length is checked first; every length passes the filter.
    return counts.frame.where(F.col("n_categories") >= 0).select("empId", whole)


def employee_categories(pairs: DataFrame, ids: Sequence[str] | None = None) -> DataFrame:
    """The inversion: ``employee_records`` of pairs with the complete category list ``ids``."""
    return employee_records(membership_counts(pairs, ids))


def as_text(records: DataFrame) -> DataFrame:
    """Flat form of each record: ``empId, n_categories, categories`` (ids joined by commas)."""
    ids = F.transform("categoryInfoList", lambda info: info["categoryId"])
    return records.select(
        "empId",
        F.size("categoryInfoList").cast("bigint").alias("n_categories"),
        F.array_join(ids, ",").alias("categories"),
    )
