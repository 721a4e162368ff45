"""Latest snapshot of a source."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def latest_snapshot(roots: DataFrame, listing: DataFrame) -> DataFrame:
    """``root, latest`` for every row of ``roots (root)``, from ``listing (root, path)``.

    The greatest path by string order, so ``/d/9`` comes after ``/d/10``. A root with
    no paths gets the empty string.
    """
    latest = listing.groupBy("root").agg(F.max("path").alias("latest"))
    return roots.join(latest, "root", "left").select(
        "root", F.coalesce("latest", F.lit("")).alias("latest")
    )
