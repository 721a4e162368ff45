"""Delivery through clients: each message's fate, repeated tasks, aborted jobs, replacement."""

import json
import os
import subprocess
import sys
import types

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from memberfold.operators.envelope import MESSAGE_OVERHEAD
from memberfold.operators.invert import employee_categories
from memberfold.plans import publish_job
from memberfold.plans.publish_job import run_publish
from memberfold.sinks import delivery
from memberfold.sinks.avro import write_key_values
from memberfold.sinks.clients import KafkaClient, client, producer_arguments
from memberfold.sinks.delivery import deliver, read_delivery
from memberfold.sinks.kafka import producer_settings
from memberfold.sinks.replace import REPLACED, STAGED, recover, replacing
from memberfold.sources.avro import read_key_values

FOLDER = "memberfold.sinks.clients:FolderClient"
MESSAGES = "topic string, key string, value string"


def messages(spark, n=100):
    return spark.range(n).select(
        F.lit("t").alias("topic"), F.col("id").cast("string").alias("key"), F.concat(F.lit("value "), "id").alias("value")
    )


def delivered(spark, tmp_path, frame, name=FOLDER, keyed=True, max_bytes=1000, overhead=0, **settings):
    settings = {"path": str(tmp_path / "sent"), **settings}
    return deliver(frame, name, settings, str(tmp_path / "log"), keyed, max_bytes, overhead)


def sent(tmp_path):
    rows = []
    for file in (tmp_path / "sent").glob("*.jsonl"):
        rows += [json.loads(line) for line in file.read_text().splitlines()]
    return [(r["topic"], r["key"], r["value"]) for r in rows]


def test_every_message_arrives_and_is_counted(spark, tmp_path):
    frame = messages(spark).unionAll(spark.createDataFrame([("t", "é\n\"", "{\n}"), ("t", "", "")], MESSAGES))
    found = delivered(spark, tmp_path, frame)
    assert found.status == "committed" and found.counters() == {"KAFKA_SUCCESS": 102, "KAFKA_FAILURES": 0}
    assert sorted(sent(tmp_path)) == sorted(map(tuple, frame.collect()))
    assert found.rejected(spark).collect() == []
    assert sum(t["sent"] for t in found.tasks) == 102 and len(found.tasks) == len({t["task"] for t in found.tasks})


def test_messages_that_cannot_be_sent_are_told_with_a_reason(spark, tmp_path):
    odd = [("t", None, "no key"), ("t", "k", None), ("t", "long", "x" * 90), ("t", "é" * 5, "y" * 80)]
    found = delivered(spark, tmp_path, spark.createDataFrame(odd, MESSAGES).unionAll(messages(spark, 9)), max_bytes=100, overhead=10)
    reasons = {(r.key, r.value): r.reason for r in found.rejected(spark).collect()}
    assert reasons == {(None, "no key"): "no key", ("k", None): "no value", ("long", "x" * 90): "104 bytes, 100 allowed"}
    assert found.counters() == {"KAFKA_SUCCESS": 10, "KAFKA_FAILURES": 3}
    assert ("t", "é" * 5, "y" * 80) in sent(tmp_path)


def test_messages_without_keys_are_sent_where_keys_are_not_wanted(spark, tmp_path):
    frame = spark.createDataFrame([("t", None, "v")], MESSAGES)
    assert delivered(spark, tmp_path, frame, keyed=False).counters() == {"KAFKA_SUCCESS": 1, "KAFKA_FAILURES": 0}


@pytest.mark.parametrize("open_bytes", [32 << 20, 50])
def test_what_the_client_refuses_later_is_counted_as_failed(spark, tmp_path, monkeypatch, open_bytes):
    monkeypatch.setattr(delivery, "OPEN_BYTES", open_bytes)
    found = delivered(spark, tmp_path, messages(spark), "tests.clients:Picky")
    assert found.counters() == {"KAFKA_SUCCESS": 90, "KAFKA_FAILURES": 10}
    rejected = {r.key: r.reason for r in found.rejected(spark).collect()}
    assert rejected == {str(k): "TimeoutError: no answer" for k in range(7, 100, 10)}
    assert sorted(k for _, k, _ in sent(tmp_path)) == sorted(str(k) for k in range(100) if k % 10 != 7)


def test_an_aborted_job_is_seen_as_such(spark, tmp_path):
    assert read_delivery(str(tmp_path / "log")).status is None
    with pytest.raises(PySparkException, match="the broker went away"):
        delivered(spark, tmp_path, messages(spark, 1000), "tests.clients:Stumbling", fails=9)
    found = read_delivery(str(tmp_path / "log"))
    assert found.status == "aborted" and found.counters()["KAFKA_SUCCESS"] < 1000
    with pytest.raises(FileExistsError, match="earlier delivery"):
        delivered(spark, tmp_path, messages(spark))


def test_a_client_that_does_not_answer_fails_the_job(spark, tmp_path):
    with pytest.raises(PySparkException, match="told the fate of 0 of"):
        delivered(spark, tmp_path, messages(spark), "tests.clients:Forgetful")
    assert read_delivery(str(tmp_path / "log")).status == "aborted"


def test_no_messages(spark, tmp_path):
    found = delivered(spark, tmp_path, messages(spark, 0))
    assert found.status == "committed" and set(found.counters().values()) == {0}


def test_only_messages_and_only_appended(spark, tmp_path):
    with pytest.raises(ValueError, match="module:name"):
        client("nonsense", {})
    spark.dataSource.register(delivery.MessageSink)
    with pytest.raises(PySparkException):
        spark.range(3).write.format(delivery.FORMAT).mode("append").save()
    with pytest.raises(PySparkException):
        messages(spark).write.format(delivery.FORMAT).mode("overwrite").save()


REPEATED = """
import sys
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[4, 4]").config("spark.ui.enabled", "false").getOrCreate())
spark.sparkContext.setLogLevel("OFF")
from tests.test_delivery import messages
from memberfold.sinks.delivery import deliver
found = deliver(messages(spark, 1000).repartition(6), "tests.clients:Stumbling", {"path": sys.argv[1] + "/sent", "fails": 2},
                sys.argv[1] + "/log", True, 1000, 0)
rejected = found.rejected(spark)
print(found.status, *found.counters().values(), rejected.count(), rejected.select("key").distinct().count())
"""


def test_repeated_tasks_send_at_least_once_and_count_once(tmp_path):
    """Each task fails twice in the middle: what it sent then stays, but is in no count."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    environment = {**os.environ, "PYTHONPATH": root}
    run = subprocess.run(
        [sys.executable, "-c", REPEATED, str(tmp_path)], cwd=root, env=environment, capture_output=True, text=True, timeout=300
    )
    assert run.stdout.split("\n")[-2:] == ["committed 900 100 100 100", ""], run.stderr[-2000:]
    keys = [key for _, key, _ in sent(tmp_path)]
    assert set(keys) == {str(k) for k in range(1000) if k % 10 != 7}
    assert len(keys) > 900
    # Files of attempts that did not commit may be there, but are in no answer.
    assert len(list((tmp_path / "log" / "rejected").glob("*"))) >= 6


# --- the client of the kafka package -------------------------------------------


def test_kafka_client(monkeypatch):
    class Future:
        def __init__(self):
            self.back, self.err = [], []

        def add_callback(self, f):
            self.back.append(f)

        def add_errback(self, f):
            self.err.append(f)

    made = []

    class Producer:
        def __init__(self, **arguments):
            self.arguments, self.sent, self.state = arguments, [], []
            made.append(self)

        def send(self, topic, key, value):
            if value == b"large":
                raise ValueError("too large")
            future = Future()
            self.sent.append((topic, key, value, future))
            return future

        def flush(self):
            for _, _, value, future in self.sent:
                for f in future.err if value == b"lost" else future.back:
                    f(TimeoutError() if value == b"lost" else "metadata")

        def close(self):
            self.state.append("closed")

    monkeypatch.setitem(sys.modules, "kafka", types.SimpleNamespace(KafkaProducer=Producer))
    sink = KafkaClient(producer_settings({"bootstrap.servers": "h:1", "acks": "all", "linger.ms": 5}))
    assert made[0].arguments == {
        "bootstrap_servers": "h:1", "buffer_memory": 33554432, "batch_size": 16384, "acks": "all", "retries": 2,
        "client_id": "client", "linger_ms": 5, "compression_type": None, "request_timeout_ms": 30000, "retry_backoff_ms": 100,
    }
    fates = {}
    for value in ("fine", "large", "lost"):
        sink.send("t", None if value == "fine" else "k", value, lambda error, value=value: fates.__setitem__(value, error))
    assert set(fates) == {"large"}
    sink.flush()
    assert fates["fine"] is None and isinstance(fates["lost"], TimeoutError) and isinstance(fates["large"], ValueError)
    assert made[0].sent[0][:3] == ("t", None, b"fine") and made[0].sent[1][1] == b"k"
    sink.close()
    assert made[0].state == ["closed"]
    assert producer_arguments({"compression.type": "gzip", "x": "-1"}) == {"compression_type": "gzip", "x": -1}


# --- the publish job -------------------------------------------------------------


def test_publish_job_with_a_client(spark, tmp_path, capsys):
    rows = [(f"e{i}", "a") for i in range(40)] + [("big", "b")] * 100
    records = employee_categories(spark.createDataFrame(rows, "empId string, categoryId string"), ["a", "b"])
    write_key_values(records, str(tmp_path / "kv"))
    limited = {"bootstrap.servers": "h:1", "max.request.size": 500}
    options = dict(partitions=2, client="tests.clients:Picky", path=str(tmp_path / "sent"))
    with pytest.raises(ValueError, match="log"):
        run_publish(spark, str(tmp_path / "kv"), "t", limited, **options)
    counters = run_publish(
        spark, str(tmp_path / "kv"), "t", limited, log=str(tmp_path / "log"), rejected=str(tmp_path / "rejected"), **options
    )
    assert counters == {"KAFKA_SUCCESS": 36, "KAFKA_FAILURES": 5}
    rejected = spark.read.parquet(str(tmp_path / "rejected"))
    assert sorted(r.key for r in rejected.collect()) == ["big", "e17", "e27", "e37", "e7"]
    assert len(sent(tmp_path)) == 36 and len(read_delivery(str(tmp_path / "log")).tasks) <= 2
    publish_job.main(
        ["--input", str(tmp_path / "kv"), "--topic", "t", "--producer", "bootstrap.servers=h:1", "--client", FOLDER,
         "--log", str(tmp_path / "log2"), "--sink", f"path={tmp_path / 'all'}"]
    )
    assert json.loads(capsys.readouterr().out) == {"KAFKA_SUCCESS": 41, "KAFKA_FAILURES": 0}


def test_the_connectors_limit_counts_the_same(spark, tmp_path):
    """What the check before sending lets pass and what the sink delivers are the same messages."""
    frame = messages(spark, 20)
    found = delivered(spark, tmp_path, frame, max_bytes=8 + MESSAGE_OVERHEAD, overhead=MESSAGE_OVERHEAD)
    from memberfold.operators.envelope import publish_outcome

    checked = {r.counter: r.value for r in publish_outcome(frame, max_bytes=8 + MESSAGE_OVERHEAD).collect()}
    assert found.counters() == checked and checked["KAFKA_FAILURES"] > 0


# --- replacement -------------------------------------------------------------------


def stored(spark, path):
    return sorted(row.key for row in read_key_values(spark, str(path)).collect())


def records(spark, *keys):
    return employee_categories(spark.createDataFrame([(k, "a") for k in keys], "empId string, categoryId string"), ["a"])


def beside(tmp_path):
    return sorted(p.name for p in tmp_path.iterdir())


def test_a_failing_write_leaves_the_old_output_readable(spark, tmp_path):
    path = str(tmp_path / "out")
    write_key_values(records(spark, "old"), path, mode="overwrite")
    with pytest.raises(PySparkException, match="null employee"):
        write_key_values(records(spark, "new", None), path, mode="overwrite")
    assert stored(spark, path) == ["old"]
    write_key_values(records(spark, "new"), path + "/", mode="overwrite")
    assert stored(spark, path) == ["new"]
    assert beside(tmp_path) == ["out"]


def test_a_writer_never_sees_half_a_folder(spark, tmp_path):
    path = str(tmp_path / "out")
    write_key_values(records(spark, "old"), path)
    with replacing(spark, path) as staged:
        assert STAGED in staged and not os.path.exists(staged)
        write_key_values(records(spark, "new"), staged)
        assert stored(spark, path) == ["old"]
    assert stored(spark, path) == ["new"]


def test_a_replacement_that_ended_between_its_renames(spark, tmp_path):
    path = str(tmp_path / "out")
    write_key_values(records(spark, "old"), path)
    os.rename(path, path + REPLACED)
    recover(spark, path)
    assert stored(spark, path) == ["old"]
    # The new folder had its name already: only the old one is left to delete.
    os.rename(path, path + REPLACED)
    write_key_values(records(spark, "new"), path)
    write_key_values(records(spark, "newer"), path, mode="overwrite")
    assert stored(spark, path) == ["newer"] and beside(tmp_path) == ["out"]


def test_a_rename_that_fails_brings_the_old_folder_back(spark, tmp_path, monkeypatch):
    from memberfold.sources.files import Files

    path, move = str(tmp_path / "out"), Files.move
    write_key_values(records(spark, "old"), path)

    def refused(files, source, to):
        if STAGED in source:
            raise OSError("no")
        move(files, source, to)

    monkeypatch.setattr(Files, "move", refused)
    with pytest.raises(OSError):
        write_key_values(records(spark, "new"), path, mode="overwrite")
    assert stored(spark, path) == ["old"] and beside(tmp_path) == ["out"]
