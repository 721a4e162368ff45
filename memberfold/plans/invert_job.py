"""The inversion job: category spec -> datasets -> employee records -> key/value Avro.

    spark-submit --py-files memberfold.zip memberfold/plans/invert_job.py --spec '1#home_2#toys' \
        --locations <table of category_id, body> --output <folder>
"""

from __future__ import annotations

import argparse
import json
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from memberfold.functions.dates import input_date
from memberfold.functions.locations import LOCATION_FIELD
from memberfold.operators.categories import parse_specs, resolve_locations
from memberfold.operators.counters import inversion_counters
from memberfold.operators.invert import employee_records, membership_counts
from memberfold.schemas import NUMBER_OF_CATEGORY
from memberfold.sinks.avro import write_key_values
from memberfold.sources.members import collect_locations, scan_categories
from memberfold.sources.snapshots import SNAPSHOT_NAMES, latest_paths

INPUT_DATE = "{input_date}"


def write_inversion(
    pairs: DataFrame,
    ids: list[str],
    output: str,
    mode: str = "errorifexists",
    drop_null_keys: bool = False,
) -> dict[str, int]:
    """Write the inversion of ``pairs`` and return its counters, in one job.

    The counters are observed on the grouped rows, in the stage that writes them, so
    a task that is run again does not count twice.
    """
    seen = Observation()
    counts = membership_counts(pairs, ids).observe(seen, *inversion_counters())
    records = employee_records(counts.named(drop_null_keys))
    write_key_values(records, output, mode)
    return {**seen.get, NUMBER_OF_CATEGORY: len(set(ids))}


def dated_locations(
    spark: SparkSession,
    locations: list[tuple[str, str]],
    run_id: str,
    at: datetime,
    configured: str = "",
) -> list[tuple[str, str]]:
    """Locations with ``{input_date}`` filled in for a run at a point in time."""
    run = spark.createDataFrame([(run_id, at, configured)], "id string, at timestamp, day string")
    day = run.select(input_date(F.col("id"), F.col("at"), F.col("day"))).first()[0]
    return [(id_, path.replace(INPUT_DATE, day)) for id_, path in locations]


def latest_locations(
    spark: SparkSession, locations: list[tuple[str, str]], names: str = SNAPSHOT_NAMES
) -> list[tuple[str, str]]:
    """Each location taken as a root, its latest snapshot in its place; none raises."""
    latest = latest_paths(spark, *[path for _, path in locations], names=names)
    for id_, root in locations:
        if not latest[root]:
            raise ValueError(f"no snapshot of category {id_} under {root}")
    return [(id_, latest[root]) for id_, root in locations]


def run_inversion(
    spark: SparkSession,
    spec: str,
    bodies: DataFrame,
    output: str,
    field: str = LOCATION_FIELD,
    latest: bool = False,
    snapshot_names: str = SNAPSHOT_NAMES,
    run_id: str | None = None,
    run_at: datetime | None = None,
    configured_date: str = "",
    **write_options,
) -> dict[str, int]:
    """``bodies (category_id, body)`` says where each category of ``spec`` lies.

    With a ``run_id`` the input date of the run stands in for ``{input_date}`` in locations;
    with ``latest`` a location is a root of which the newest snapshot is read.
    """
    specs = spark.createDataFrame([(spec,)], "spec string")
    located = resolve_locations(parse_specs(specs, "spec"), bodies, field)
    locations = collect_locations(located)
    if run_id is not None:
        run_at = run_at or datetime.now(timezone.utc)
        locations = dated_locations(spark, locations, run_id, run_at, configured_date)
    if latest:
        locations = latest_locations(spark, locations, snapshot_names)
    pairs = scan_categories(spark, locations)
    return write_inversion(pairs, [id_ for id_, _ in locations], output, **write_options)


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Invert category datasets by employee")
    parser.add_argument("--spec", required=True, help="id#name_id#name")
    parser.add_argument("--locations", required=True, help="table of category_id, body (JSON)")
    parser.add_argument("--locations-format", default="parquet")
    parser.add_argument("--output", required=True)
    parser.add_argument("--overwrite", action="store_true")
    parser.add_argument("--drop-null-keys", action="store_true")
    parser.add_argument("--latest", action="store_true", help="read each location's newest snapshot")
    parser.add_argument("--snapshot-names", default=SNAPSHOT_NAMES, help="pattern of snapshot names")
    parser.add_argument("--run-id", help="fills {input_date} in locations by the rule of run dates")
    parser.add_argument("--run-at", type=datetime.fromisoformat, help="the run's time, else now")
    parser.add_argument("--configured-date", default="")
    options = parser.parse_args(arguments)

    spark = SparkSession.builder.appName("memberfold-invert").getOrCreate()
    bodies = (
        spark.read.format(options.locations_format)
        .schema("category_id string, body string")
        .load(options.locations)
    )
    counters = run_inversion(
        spark,
        options.spec,
        bodies,
        options.output,
        mode="overwrite" if options.overwrite else "errorifexists",
        drop_null_keys=options.drop_null_keys,
        latest=options.latest,
        snapshot_names=options.snapshot_names,
        run_id=options.run_id,
        run_at=options.run_at,
        configured_date=options.configured_date,
    )
    print(json.dumps(counters))


if __name__ == "__main__":
    main()
