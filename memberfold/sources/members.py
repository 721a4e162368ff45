"""Scan of many categories, each with a dataset of its own."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

from memberfold.operators.pairs import tag
from memberfold.schemas import MAX_CATEGORIES
from memberfold.sources.avro import read_members
from memberfold.sources.files import NO_AUTHORITY, Files, is_glob, side_by_side


def collect_locations(located: DataFrame) -> list[tuple[str, str]]:
    """``(category id, location)`` on the driver, ordered by id.

    A list longer than ``MAX_CATEGORIES`` is refused.
    """
    rows = located.select("category_id", "location").limit(MAX_CATEGORIES + 1).collect()
    if len(rows) > MAX_CATEGORIES:
        raise ValueError(f"more than {MAX_CATEGORIES} categories")
    return sorted((row.category_id, row.location) for row in rows)


@contextmanager
def _reading(category_id: str, path: str) -> Iterator[None]:
    try:
        yield
    except Exception as error:
        raise RuntimeError(f"cannot read category {category_id} at {path}") from error


# Tasks that list folders, for each core, where the session does not say otherwise.
LISTING_TASKS = 4
_LISTING_PARALLELISM = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


@contextmanager
def _listing_in_few_tasks(spark: SparkSession) -> Iterator[None]:
    """The scan's listing of many folders takes a task each by default, mostly overhead."""
    if spark.conf.get(_LISTING_PARALLELISM) != "10000":
        yield
        return
    spark.conf.set(_LISTING_PARALLELISM, LISTING_TASKS * spark.sparkContext.defaultParallelism)
    try:
        yield
    finally:
        spark.conf.unset(_LISTING_PARALLELISM)


def scan_categories(spark: SparkSession, locations: list[tuple[str, str]]) -> DataFrame:
    """``empId, categoryId`` pairs of all categories; one that cannot be read raises.

    A location is a folder, read with all its subfolders (plain or ``k=v``), a file, or a
    glob of these. One scan reads all of them. A row belongs to every category whose
    location its file lies in, so locations may be shared or lie inside one another.
    A file that belongs to none raises. An existing empty folder has no rows.
    """
    if not locations:
        raise ValueError("no categories")
    if len(locations) > MAX_CATEGORIES:
        raise ValueError(f"more than {MAX_CATEGORIES} categories")
    files = Files(spark)

    def places(location: tuple[str, str]) -> list[str]:
        with _reading(*location):
            return files.existing(location[1])

    owners: dict[str, list[str]] = {}
    paths: dict[str, str] = {}
    for (category_id, path), found in zip(locations, side_by_side(places, locations)):
        for place in found:
            owners.setdefault(place, []).append(category_id)
            paths[place] = place if is_glob(path) else path
    if len(owners) > MAX_CATEGORIES:
        raise ValueError(f"more than {MAX_CATEGORIES} places")
    with _listing_in_few_tasks(spark):
        members = read_members(spark, *paths.values(), fields=["empid"], recursiveFileLookup="true")
    file = F.regexp_replace("_metadata.file_path", NO_AUTHORITY, "$1:/")
    members = members.select("empid", file.alias("file"))
    # One join for each depth of a location; its table has one row a place, at most
    # MAX_CATEGORIES in all, so it is broadcast.
    by_depth: dict[int, list[tuple[str, list[str]]]] = {}
    for place, ids in owners.items():
        by_depth.setdefault(place.count("/") + 1, []).append((place, ids))
    found = []
    for depth, rows in sorted(by_depth.items()):
        places = spark.createDataFrame(rows, f"place{depth} string, ids{depth} array<string>")
        prefix = F.substring_index("file", "/", depth)
        members = members.join(F.broadcast(places), prefix == F.col(f"place{depth}"), "left")
        found.append(F.coalesce(f"ids{depth}", F.array().cast("array<string>")))
    ids = F.concat(*found)
    unknown = F.raise_error(F.concat(F.lit("file outside every location: "), F.col("file")))
    # The check decides how many rows there are, so that counting cannot leave it out.
    checked = F.when(F.size(ids) > 0, ids).otherwise(unknown.cast("array<string>"))
    return tag(members.select("empid", F.explode(checked).alias("id")), F.col("id"))
