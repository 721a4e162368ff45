"""Avro files, category specs, locations, snapshots and dates."""

import random
import shutil
import threading
import time
from glob import glob
from types import SimpleNamespace

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from memberfold.functions.dates import compute_date, input_date, local_date
from memberfold.functions.locations import lookup_address
from memberfold.functions.spec import is_malformed
from memberfold.operators.categories import parse_specs, resolve_locations
from memberfold.operators.snapshots import latest_snapshot
from memberfold.schemas import EMPLOYEE
from memberfold.session import shared_folder
from memberfold.sources import members
from memberfold.sources.avro import avro_format, read_members
from memberfold.sources.members import collect_locations, scan_categories
from memberfold.sources.snapshots import latest_paths


def write_members(spark, path, *ids, **options):
    rows = [(id_, None, None, None, None) for id_ in ids]
    spark.createDataFrame(rows, EMPLOYEE).write.format(avro_format(spark)).options(**options).save(
        str(path)
    )
    return str(path)


def pairs_of(frame):
    return sorted(((row.empId, row.categoryId) for row in frame.collect()), key=str)


# --- Avro scans ---------------------------------------------------------------


@pytest.mark.parametrize("codec", ["uncompressed", "deflate", "snappy", "bzip2"])
def test_compressed_input(spark, tmp_path, codec):
    path = write_members(spark, tmp_path / codec, "e", None, compression=codec)
    assert sorted((r.empid for r in read_members(spark, path).collect()), key=str) == [None, "e"]


def test_reader_schema(spark, tmp_path):
    path = str(tmp_path / "old")
    spark.createDataFrame([("e", "d", 7)], "empid string, empdata string, extra int").write.format(
        avro_format(spark)
    ).save(path)
    row = read_members(spark, path).first()
    assert row.asDict() == {
        "empid": "e", "empdate": None, "email": None, "phone": None, "empdata": "d"
    }


def test_many_categories(spark, tmp_path):
    first = write_members(spark, tmp_path / "with space", "e", "e", None)
    second = write_members(spark, tmp_path / "b,c:d", "e", "f")
    empty = write_members(spark, tmp_path / "empty")
    (tmp_path / "nothing").mkdir()
    locations = [("1", first), ("2", second), ("3", empty), ("4", second + "/"), ("5", str(tmp_path / "nothing"))]
    pairs = scan_categories(spark, locations)
    assert pairs_of(pairs) == sorted(
        [("e", "1"), ("e", "1"), (None, "1"), ("e", "2"), ("f", "2"), ("e", "4"), ("f", "4")],
        key=str,
    )


@pytest.mark.parametrize("more", [0, 99, 100, 400])
def test_one_rule_for_all_layouts(spark, tmp_path, more):
    write_members(spark, tmp_path / "flat", "a")
    write_members(spark, tmp_path / "plain" / "2024-01-02", "b")
    write_members(spark, tmp_path / "plain" / "2024-01-03" / "deep", "c")
    write_members(spark, tmp_path / "keyed" / "day=1", "d")
    write_members(spark, tmp_path / "keyed" / "day=2", "e")
    file = max((tmp_path / "flat").glob("part-*.avro"), key=lambda part: part.stat().st_size)
    root = str(tmp_path)
    locations = [
        ("flat", f"{root}/flat"), ("plain", f"{root}/plain"), ("keyed", f"{root}/keyed"), ("file", str(file)),
        ("glob", f"{root}/keyed/day=*"), ("inside", f"{root}/plain/2024-01-03"), ("shared", f"file:{root}/keyed/"),
        *[(f"more{k}", f"{root}/flat") for k in range(more)],
    ]
    want = {
        "flat": "a", "plain": "bc", "keyed": "de", "file": "a", "glob": "de", "inside": "c", "shared": "de",
        **{f"more{k}": "a" for k in range(more)},
    }
    pairs = scan_categories(spark, locations)
    expected = sorted((e, id_) for id_, employees in want.items() for e in employees)
    assert sorted(map(tuple, pairs.collect())) == expected
    assert pairs.count() == len(expected)


@pytest.mark.parametrize("path", ["absent", "absent/*"])
def test_missing_input_names_the_category_and_keeps_the_cause(spark, tmp_path, path):
    good = write_members(spark, tmp_path / "good", "e")
    with pytest.raises(RuntimeError, match="category 2") as caught:
        scan_categories(spark, [("1", good), ("2", str(tmp_path / path))])
    assert caught.value.__cause__ is not None


def test_a_file_that_belongs_to_no_location_raises_even_when_counted(spark, tmp_path, monkeypatch):
    good = write_members(spark, tmp_path / "good", "e")
    monkeypatch.setattr(members.Files, "existing", lambda files, path: [f"file:{path}/elsewhere"])
    with pytest.raises(PySparkException, match="outside every location"):
        scan_categories(spark, [("1", good)]).count()


def test_listing_asks_for_several_locations_at_a_time(spark, tmp_path, monkeypatch):
    waiting, most, lock = [0], [0], threading.Lock()
    existing = members.Files.existing

    def slow(files, path):
        with lock:
            waiting[0] += 1
            most[0] = max(most[0], waiting[0])
        time.sleep(0.05)
        with lock:
            waiting[0] -= 1
        return existing(files, path)

    monkeypatch.setattr(members.Files, "existing", slow)
    locations = [(str(k), write_members(spark, tmp_path / f"m{k}", f"e{k}")) for k in range(12)]
    before = spark.conf.get(members._LISTING_PARALLELISM)
    pairs = scan_categories(spark, locations)
    assert sorted(map(tuple, pairs.collect())) == sorted((f"e{k}", str(k)) for k in range(12))
    assert most[0] >= 6
    assert spark.conf.get(members._LISTING_PARALLELISM) == before


def test_two_thousand_locations_are_listed_in_seconds(spark, tmp_path):
    one = glob(write_members(spark, tmp_path / "one", "e") + "/*.avro")[0]
    for k in range(2000):
        (tmp_path / f"c{k}").mkdir()
        shutil.copy(one, tmp_path / f"c{k}" / "a.avro")
    start = time.perf_counter()
    pairs = scan_categories(spark, [(str(k), str(tmp_path / f"c{k}")) for k in range(2000)])
    # About four seconds on eight cores; one call after the other took more than twenty.
    assert time.perf_counter() - start < 15
    assert pairs.count() == 2000


def test_only_the_fields_wanted_are_built(spark, tmp_path):
    path = write_members(spark, tmp_path / "m", "e")
    assert read_members(spark, path, fields=["empid"]).columns == ["empid"]
    pairs = scan_categories(spark, [("1", path)])
    text = pairs._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<empid:string>" in text


def test_no_categories(spark):
    with pytest.raises(ValueError, match="no categories"):
        scan_categories(spark, [])


# --- category specs -----------------------------------------------------------


def parse(spark, spec):
    rows = parse_specs(spark.createDataFrame([(spec,)], "spec string"), "spec").collect()
    return {row.category_id: row.category_name for row in rows}


@pytest.mark.parametrize(
    "spec, expected",
    [
        ("1#a_2#b", {"1": "a", "2": "b"}),
        ("1#a_2#b_1#c", {"1": "c", "2": "b"}),
        ("1#z_1#a_1#m", {"1": "m"}),
        ("1#a_", {"1": "a"}),
        ("1#a__", {"1": "a"}),
        ("1#a#z", {"1": "a"}),
        ("#a", {"": "a"}),
        ("1##z", {"1": ""}),
        ("1#a##_2#b#", {"1": "a", "2": "b"}),
        ("a1#x_a#y_a1#z", {"a1": "z", "a": "y"}),
        ("_", {}),
    ],
)
def test_spec(spark, spec, expected):
    assert parse(spark, spec) == expected


@pytest.mark.parametrize("spec", ["1", "1#", "_1#a", "1#a__2#b", "", "#", "1##", "1_1#a", "1#a_2_3#c", "1#a_#_", None])
def test_malformed_spec_raises(spark, spec):
    with pytest.raises(PySparkException, match="malformed category spec"):
        parse(spark, spec)


def test_long_spec_keeps_the_last_of_every_id(spark):
    entries = [(str(i % 97), f"n{i}") for i in range(1500)]
    assert parse(spark, "_".join(f"{id_}#{name}" for id_, name in entries)) == dict(entries)


def split_like_the_format(text, delimiter):
    """Pieces of a text, without trailing empty ones; an empty text is one empty piece."""
    pieces = text.split(delimiter)
    while len(pieces) > 1 and not pieces[-1]:
        pieces.pop()
    return [] if pieces == [""] and text else pieces


def model(spec):
    """What a spec means, or None if it is malformed."""
    found = {}
    for entry in split_like_the_format(spec, "_"):
        fields = split_like_the_format(entry, "#")
        if len(fields) < 2:
            return None
        found[fields[0]] = fields[1]
    return found


def test_random_specs(spark):
    rng = random.Random(5)
    specs = {"".join(rng.choices("ab1#_", k=rng.randint(0, 12))) for _ in range(20_000)}
    expected = {text: model(text) for text in specs}
    valid = [(text,) for text, meaning in expected.items() if meaning is not None]
    assert len(valid) > 500
    rows = parse_specs(spark.createDataFrame(valid, "spec string"), "spec", "spec").collect()
    found = {text: {} for (text,) in valid}
    for row in rows:
        assert row.category_id not in found[row.spec]
        found[row.spec][row.category_id] = row.category_name
    assert found == {text: expected[text] for (text,) in valid}

    # the malformed ones, all at once: each must be caught by the check
    malformed = [(text,) for text, meaning in expected.items() if meaning is None]
    frame = spark.createDataFrame(malformed, "spec string")
    caught = frame.where(is_malformed(F.col("spec"))).count()
    assert caught == len(malformed) > 500


# --- locations ----------------------------------------------------------------

BODIES = "category_id string, body string"


def locate(spark, ids, bodies):
    categories = spark.createDataFrame([(id_,) for id_ in ids], "category_id string")
    return resolve_locations(categories, spark.createDataFrame(bodies, BODIES))


def test_location_is_whole(spark):
    bodies = [("1", '{"id": 1, "location" : "hdfs://nn:8020/a,b"}'), ("9", '{"location":"/unused"}')]
    assert collect_locations(locate(spark, ["1"], bodies)) == [("1", "hdfs://nn:8020/a,b")]


def test_repeated_bodies_do_not_multiply_rows(spark):
    located = locate(spark, ["1"], [("1", '{"location":"/a"}')] * 50)
    assert collect_locations(located) == [("1", "/a")]


@pytest.mark.parametrize(
    "bodies", [[], [("1", "{}")], [("1", None)], [("1", '{"location":"/a"}'), ("1", '{"location":"/b"}')]]
)
def test_missing_or_ambiguous_location_raises(spark, bodies):
    with pytest.raises(PySparkException, match="locations? for category 1"):
        locate(spark, ["1"], bodies).collect()


def test_lookup_address(spark):
    frame = spark.createDataFrame([("7",)], "id string")
    assert frame.select(lookup_address("http://h/", F.col("id"))).first()[0] == "http://h/7/ACCOUNTID"


def test_long_location_list_is_refused(spark, monkeypatch):
    monkeypatch.setattr("memberfold.sources.members.MAX_CATEGORIES", 1)
    located = locate(spark, ["1", "2"], [("1", '{"location":"/a"}'), ("2", '{"location":"/b"}')])
    with pytest.raises(ValueError, match="more than 1"):
        collect_locations(located)


# --- snapshots ----------------------------------------------------------------


def test_latest_by_string_order(spark):
    roots = spark.createDataFrame([("/d",), ("/none",)], "root string")
    listing = spark.createDataFrame([("/d", "/d/9"), ("/d", "/d/10")], "root string, path string")
    found = {row.root: row.latest for row in latest_snapshot(roots, listing).collect()}
    assert found == {"/d": "/d/9", "/none": ""}


def test_latest_of_each_root_can_be_read(spark, tmp_path):
    write_members(spark, tmp_path / "d" / "2024-01-02", "old")
    write_members(spark, tmp_path / "d" / "2024-01-10", "new")
    (tmp_path / "empty").mkdir()
    roots = [str(tmp_path / name) for name in ["d", "empty", "absent"]]
    found = latest_paths(spark, *roots, roots[0])
    assert found[roots[0]].endswith("/d/2024-01-10")
    assert found[roots[1]] == found[roots[2]] == ""
    assert [row.empid for row in read_members(spark, found[roots[0]]).collect()] == ["new"]


# --- dates --------------------------------------------------------------------


@pytest.mark.parametrize(
    "run_id, ts, configured, interval, expected",
    [
        ("scheduled__1", "2024-01-01 18:29:59", None, 0, ("2024-01-01", "2024-01-01", "2023-12-31")),
        ("scheduled__1", "2024-01-01 18:30:00", None, 0, ("2024-01-02", "2024-01-02", "2024-01-01")),
        ("manual__1", "2024-01-01 18:30:00", "2023-05-05", 0, ("2024-01-02", "2024-01-01", "2023-12-31")),
        ("scheduled__1", "2024-01-01 18:30:00", "2023-05-05", 3, ("2024-01-02", "2023-05-05", "2023-05-04")),
        ("scheduled__1", "2024-01-01 18:30:00", "2023-5-5", 0, ("2024-01-02", "2023-05-05", "2023-05-04")),
        ("scheduled__1", "2024-01-01 18:30:00", "", 0, ("2024-01-02", "2024-01-02", "2024-01-01")),
        ("scheduled__1", "2024-02-28 00:00:00", None, 2, ("2024-02-28", "2024-03-01", "2024-02-29")),
    ],
)
def test_dates(spark, run_id, ts, configured, interval, expected):
    frame = spark.createDataFrame([(run_id, ts, configured)], "run string, ts string, conf string")
    run, utc, conf = F.col("run"), F.col("ts").cast("timestamp_ntz"), F.col("conf")
    row = frame.select(
        local_date(utc), compute_date(run, utc, conf, interval), input_date(run, utc, conf, interval)
    ).first()
    assert tuple(row) == expected


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("configured", ["soon", "2024-13-01", "2023-05-05x"])
def test_malformed_configured_date_raises(spark, ansi, configured):
    frame = spark.createDataFrame([("scheduled__1", "2024-01-01 00:00:00", configured)], "run string, ts string, conf string")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(PySparkException, match="malformed configured date"):
            frame.select(compute_date(F.col("run"), F.col("ts").cast("timestamp_ntz"), F.col("conf"))).collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


@pytest.mark.parametrize("zone", ["UTC", "Asia/Kolkata", "America/Los_Angeles"])
def test_dates_do_not_depend_on_the_session_zone(spark, zone):
    texts = ["2024-01-01 13:00:00", "2024-01-01 18:29:59", "2024-01-01 18:30:00", "2024-03-10 10:30:00", "1969-12-31 20:00:00"]
    wants = ["2024-01-01", "2024-01-01", "2024-01-02", "2024-03-10", "1970-01-01"]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        frame = spark.createDataFrame([(t,) for t in texts], "text string").select(
            F.col("text").cast("timestamp_ntz").alias("plain"),
            F.concat("text", F.lit("Z")).cast("timestamp").alias("point"),
        )
        rows = frame.select(local_date(F.col("plain")), local_date(F.col("point"))).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert [tuple(r) for r in rows] == [(w, w) for w in wants]


# --- shared folder ------------------------------------------------------------


def session_naming(folder, master):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda name, default: folder),
        sparkContext=SimpleNamespace(master=master),
    )


def test_shared_folder_is_new_and_under_the_named_one():
    session = session_naming("hdfs://nn/shared/", "yarn")
    paths = {shared_folder(session, "kv") for _ in range(2)}
    assert len(paths) == 2
    assert all(path.startswith("hdfs://nn/shared/kv-") for path in paths)


def test_cluster_must_name_a_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(session_naming(None, "yarn"), "kv")
    assert "/kv-" in shared_folder(session_naming(None, "local[2]"), "kv")
