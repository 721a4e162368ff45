"""Clients that take messages one by one and tell of each whether it was delivered.

A client is made in the task that uses it, by a callable that is named ``module:name`` and
takes the settings. It has three methods: ``send(topic, key, value, done)``, which calls
``done(None)`` or ``done(error)`` once the message's fate is known, at once or later;
``flush()``, which returns when every fate is; and ``close()``.
"""

from __future__ import annotations

import importlib
import json
import uuid
from collections.abc import Callable, Mapping
from typing import Protocol

from pyarrow import fs

Done = Callable[[Exception | None], None]


class Client(Protocol):
    def send(self, topic: str, key: str | None, value: str, done: Done) -> None: ...

    def flush(self) -> None: ...

    def close(self) -> None: ...


def client(name: str, settings: Mapping[str, str]) -> Client:
    module, separator, attribute = name.partition(":")
    if not separator:
        raise ValueError(f"expected module:name of a client, got {name!r}")
    return getattr(importlib.import_module(module), attribute)(settings)


class FolderClient:
    """Appends messages as JSON lines to a file of its own in the folder ``path``."""

    def __init__(self, settings: Mapping[str, str]):
        system, folder = fs.FileSystem.from_uri(settings["path"])
        system.create_dir(folder, recursive=True)
        self.file = system.open_output_stream(f"{folder}/{uuid.uuid4().hex}.jsonl")

    def send(self, topic: str, key: str | None, value: str, done: Done) -> None:
        line = json.dumps({"topic": topic, "key": key, "value": value}, ensure_ascii=False)
        self.file.write(line.encode() + b"\n")
        done(None)

    def flush(self) -> None:
        self.file.flush()

    def close(self) -> None:
        self.file.close()


def producer_arguments(settings: Mapping[str, str]) -> dict[str, object]:
    """Producer settings as arguments in Python: dots are underscores, numbers are numbers."""
    found: dict[str, object] = {}
    for name, value in settings.items():
        text = str(value)
        found[name.replace(".", "_")] = int(text) if text.lstrip("-").isdigit() else text
    if found.get("compression_type") == "none":
        found["compression_type"] = None
    return found


class KafkaClient:
    """A producer of the ``kafka`` package, which has to be installed where tasks run."""

    def __init__(self, settings: Mapping[str, str]):
        from kafka import KafkaProducer

        self.producer = KafkaProducer(**producer_arguments(settings))

    def send(self, topic: str, key: str | None, value: str, done: Done) -> None:
        try:
            sent = self.producer.send(
                topic, key=None if key is None else key.encode(), value=value.encode()
            )
        except Exception as error:  # refused before it was sent: too large, or no metadata
            done(error)
            return
        sent.add_callback(lambda _: done(None))
        sent.add_errback(done)

    def flush(self) -> None:
        self.producer.flush()

    def close(self) -> None:
        self.producer.close()
