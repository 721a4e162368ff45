"""Listing of snapshot directories."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from memberfold.operators.snapshots import latest_snapshot
from memberfold.sources.files import Files, side_by_side

LISTING = "root string, path string"
# Names that count as snapshots unless told otherwise: all but hidden and marker files,
# which would sort after digits.
SNAPSHOT_NAMES = r"[^_.].*"


def list_snapshots(spark: SparkSession, *roots: str, names: str = ".*") -> DataFrame:
    """``root, path`` for the direct children of every root; a missing root has none.

    Only children whose whole name matches the pattern are listed. One listing call per root,
    several at a time, names only: no file is opened.
    """
    files = Files(spark)
    rows = [
        (root, path)
        for root, found in zip(roots, side_by_side(files.children, roots))
        for name, path in found
        if re.fullmatch(names, name)
    ]
    return spark.createDataFrame(rows, LISTING)


def latest_paths(spark: SparkSession, *roots: str, names: str = ".*") -> dict[str, str]:
    """The latest snapshot of each root, independently; "" for a root that has none."""
    named = spark.createDataFrame([(root,) for root in dict.fromkeys(roots)], "root string")
    rows = latest_snapshot(named, list_snapshots(spark, *dict.fromkeys(roots), names=names)).collect()
    return {row.root: row.latest for row in rows}
