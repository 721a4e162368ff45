"""The category table, and where each category's dataset lies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from memberfold.functions.locations import LOCATION_FIELD, location_of
from memberfold.functions.spec import entry_name, ranked_entries, winning_entries


def parse_specs(specs: DataFrame, spec: str | Column, *keys: str) -> DataFrame:
    """``keys..., category_id, category_name`` for every row of ``specs``.

    The last entry of a repeated id wins. All of it happens within the row, in steps,
    as the optimizer keeps a column that is used more than once.
    """
    column = F.col(spec) if isinstance(spec, str) else spec
    text = specs.select(*[F.col(key) for key in keys], column.alias("_spec"))
    ranked = text.select(*keys, ranked_entries(F.col("_spec")).alias("ranked"))
    return ranked.select(*keys, F.inline(winning_entries("ranked"))).select(
        *keys, F.col("id").alias("category_id"), entry_name(F.col("entry")).alias("category_name")
    )


def resolve_locations(
    categories: DataFrame, bodies: DataFrame, field: str = LOCATION_FIELD
) -> DataFrame:
    """``categories`` with a ``location`` taken from ``bodies (category_id, body)``.

    A category with no location raises, and so does one with two different ones.
    Bodies are reduced to one row per id before the join, so repeats cannot multiply
    rows; adaptive execution broadcasts a side only once it knows that it is small.
    """
    found = (
        bodies.select("category_id", location_of(F.col("body"), field).alias("location"))
        .groupBy("category_id")
        .agg(F.min("location").alias("location"), F.max("location").alias("other"))
    )
    id_ = F.col("category_id").cast("string")
    checked = (
        F.when(
            F.col("location").isNull(),
            F.raise_error(F.concat(F.lit("no location for category "), id_)).cast("string"),
        )
        .when(
            F.col("location") != F.col("other"),
            F.raise_error(F.concat(F.lit("several locations for category "), id_)).cast("string"),
        )
        .otherwise(F.col("location"))
    )
    return categories.join(found, "category_id", "left").select(
        *categories.columns, checked.alias("location")
    )
