"""Delivery of messages one by one, and a log of what became of them.

A task sends its messages through a client. Its commit message says how many were delivered,
how many were not, and which file holds the latter. Only tasks that committed are counted:
what an attempt did that failed or came second is in no count, so that delivered and failed
add up to the messages given, however often tasks are repeated. Delivery itself is at least
once, as a repeated task sends again.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Mapping
from dataclasses import asdict, dataclass
from threading import Lock

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from memberfold.schemas import KAFKA_FAILURES, KAFKA_SUCCESS
from memberfold.sinks.clients import Client, client

FORMAT = "memberfold_messages"
# Names of options that are this sink's own; all others are the client's settings.
CLIENT, LOG, MAX_BYTES, KEYED, OVERHEAD = "sink.client", "sink.log", "sink.max.bytes", "sink.keyed", "sink.overhead"
# Bytes of messages whose fate may be open at a time.
OPEN_BYTES = 32 << 20
COMMITTED, ABORTED = "committed", "aborted"
_SUMMARY = "delivery.json"
REJECTED = "topic string, key string, value string, reason string"


@dataclass
class Delivered(WriterCommitMessage):
    """What a task that committed delivered; ``rejected`` names its file of the others."""

    task: int
    sent: int
    failed: int
    rejected: str | None


class _Rejected:
    """The file of a task attempt's undelivered messages, made when there is one."""

    def __init__(self, log: str):
        self.system, folder = fs.FileSystem.from_uri(log)
        self.folder, self.name, self.file = f"{folder}/rejected", None, None

    def add(self, topic: str, key: str | None, value: str | None, reason: str) -> None:
        if self.file is None:
            self.system.create_dir(self.folder, recursive=True)
            self.name = f"{uuid.uuid4().hex}.jsonl"
            self.file = self.system.open_output_stream(f"{self.folder}/{self.name}")
        row = {"topic": topic, "key": key, "value": value, "reason": reason}
        self.file.write(json.dumps(row, ensure_ascii=False).encode() + b"\n")

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


class _Sending:
    """Sends messages, with a bounded number of bytes whose fate is open."""

    def __init__(self, sink: Client, rejected: _Rejected):
        self.sink, self.rejected, self.lock = sink, rejected, Lock()
        self.sent = self.failed = self.open = 0

    def reject(self, topic: str, key: str | None, value: str | None, reason: str) -> None:
        with self.lock:
            self.failed += 1
            self.rejected.add(topic, key, value, reason)

    def send(self, topic: str, key: str | None, value: str, size: int) -> None:
        def done(error: Exception | None) -> None:  # may be called by a thread of the client
            if error is not None:
                self.reject(topic, key, value, f"{type(error).__name__}: {error}")
                return
            with self.lock:
                self.sent += 1

        self.sink.send(topic, key, value, done)
        self.open += size
        if self.open >= OPEN_BYTES:
            self.sink.flush()
            self.open = 0


class MessageWriter(DataSourceArrowWriter):
    def __init__(self, options: Mapping[str, str]):
        self.options = dict(options)

    def write(self, batches: Iterator[pa.RecordBatch]) -> Delivered:
        own = (CLIENT, LOG, MAX_BYTES, KEYED, OVERHEAD)
        settings = {k: v for k, v in self.options.items() if k not in own}
        most, overhead = int(self.options[MAX_BYTES]), int(self.options[OVERHEAD])
        keyed = self.options[KEYED] == "true"
        rejected = _Rejected(self.options[LOG])
        sink = client(self.options[CLIENT], settings)
        sending = _Sending(sink, rejected)
        given = 0
        try:
            for batch in batches:
                given += batch.num_rows
                columns = (batch.column(name).to_pylist() for name in ("topic", "key", "value"))
                for topic, key, value in zip(*columns):
                    size = sum(len(x.encode()) for x in (key, value) if x is not None) + overhead
                    if value is None or (keyed and key is None):
                        sending.reject(topic, key, value, "no value" if value is None else "no key")
                    elif size > most:
                        sending.reject(topic, key, value, f"{size} bytes, {most} allowed")
                    else:
                        sending.send(topic, key, value, size)
            sink.flush()
        finally:
            sink.close()
            rejected.close()
        if sending.sent + sending.failed != given:
            raise RuntimeError(f"the client told the fate of {sending.sent + sending.failed} of {given} messages")
        return Delivered(TaskContext.get().partitionId(), sending.sent, sending.failed, rejected.name)

    def _finish(self, status: str, messages: list[Delivered | None]) -> None:
        told = [asdict(m) for m in messages if m is not None]
        system, folder = fs.FileSystem.from_uri(self.options[LOG])
        system.create_dir(folder, recursive=True)
        # Written beside its name first: whoever finds a summary finds a whole one.
        new = f"{folder}/{uuid.uuid4().hex}.tmp"
        with system.open_output_stream(new) as file:
            file.write(json.dumps({"status": status, "tasks": told}).encode())
        system.move(new, f"{folder}/{_SUMMARY}")

    def commit(self, messages: list[Delivered | None]) -> None:
        self._finish(COMMITTED, messages)

    def abort(self, messages: list[Delivered | None]) -> None:
        self._finish(ABORTED, messages)


class MessageSink(DataSource):
    """``topic, key, value`` rows to a client; append only."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema, overwrite: bool) -> MessageWriter:
        if overwrite:
            raise ValueError("messages can only be appended")
        missing = {"topic", "key", "value"} - set(schema.fieldNames())
        if missing:
            raise ValueError(f"columns are missing: {sorted(missing)}")
        return MessageWriter(self.options)


@dataclass(frozen=True)
class Delivery:
    """The log of a delivery: ``status`` is null while no job has finished or aborted."""

    log: str
    status: str | None
    tasks: list[dict]

    def counters(self) -> dict[str, int]:
        """Messages of the tasks that committed; of an aborted job these are not all."""
        return {
            KAFKA_SUCCESS: sum(t["sent"] for t in self.tasks),
            KAFKA_FAILURES: sum(t["failed"] for t in self.tasks),
        }

    def rejected(self, spark: SparkSession) -> DataFrame:
        """``topic, key, value, reason`` of the messages that committed tasks did not deliver."""
        files = [f"{self.log.rstrip('/')}/rejected/{t['rejected']}" for t in self.tasks if t["rejected"]]
        if not files:
            return spark.createDataFrame([], REJECTED)
        return spark.read.schema(REJECTED).json(files)


def read_delivery(log: str) -> Delivery:
    system, folder = fs.FileSystem.from_uri(log)
    path = f"{folder}/{_SUMMARY}"
    if system.get_file_info(path).type == fs.FileType.NotFound:
        return Delivery(log, None, [])
    with system.open_input_stream(path) as file:
        found = json.loads(file.read())
    return Delivery(log, found["status"], found["tasks"])


def deliver(
    messages: DataFrame,
    name: str,
    settings: Mapping[str, object],
    log: str,
    keyed: bool,
    max_bytes: int,
    overhead: int,
) -> Delivery:
    """Send ``topic, key, value`` rows through the client ``name`` and return the log.

    ``log`` is a new folder that tasks and driver can reach (a local path, or a URI of a
    store that pyarrow knows). A message without value, above ``max_bytes`` with
    ``overhead``, or without key where messages are ``keyed``, is not sent; it is rejected
    like one that the client could not deliver. A job that fails raises; its log then says
    that it was aborted, and what had been delivered by then.
    """
    if read_delivery(log).status is not None:
        raise FileExistsError(f"{log} is the log of an earlier delivery")
    spark = messages.sparkSession
    spark.dataSource.register(MessageSink)
    own = {CLIENT: name, LOG: log, MAX_BYTES: max_bytes, KEYED: str(keyed).lower(), OVERHEAD: overhead}
    options = {k: str(v) for k, v in {**settings, **own}.items()}
    messages.select("topic", "key", "value").write.format(FORMAT).options(**options).mode("append").save()
    return read_delivery(log)
