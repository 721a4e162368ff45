"""The publish job: key/value Avro -> messages. Separate, so that it can run narrower.

    spark-submit --py-files memberfold.zip memberfold/plans/publish_job.py --input <folder> --topic <topic> \
        --producer bootstrap.servers=host:9092 --partitions 20 [--client module:name --log <folder>]
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Mapping

from pyspark.sql import SparkSession

from memberfold.operators.envelope import (
    MAX_MESSAGE_BYTES,
    MESSAGE_OVERHEAD,
    SUCCESS,
    envelope,
    publish_counters,
    publish_status,
    rejected_messages,
)
from memberfold.schemas import KAFKA_FAILURES
from memberfold.sinks.delivery import deliver
from memberfold.sinks.kafka import producer_settings, write_messages
from memberfold.sources.avro import read_key_values

MAX_REQUEST = "max.request.size"


def run_publish(
    spark: SparkSession,
    input: str,
    topic: str,
    producer: Mapping[str, object],
    partitions: int | None = None,
    keyed: bool = True,
    format: str = "kafka",
    rejected: str | None = None,
    client: str | None = None,
    log: str | None = None,
    **sink_options: str,
) -> dict[str, int]:
    """Publish all records and return how many employees could be sent and could not.

    With a ``client`` (``module:name``, see ``sinks.clients``) messages are sent one by one,
    in one pass, and the counts are those that its tasks committed to the new folder
    ``log``. Without one, the connector ``format`` takes them: what cannot be sent is told
    by a check before, and stops the job before anything is sent, unless ``rejected`` names
    a new folder.

    Messages that are not sent are written to ``rejected``, whole. There is no shuffle:
    ``partitions`` only limits how many tasks send.
    """
    max_bytes = int(producer.get(MAX_REQUEST, MAX_MESSAGE_BYTES))
    messages = envelope(read_key_values(spark, input), topic, keyed)
    if client is not None:
        if log is None:
            raise ValueError("name a new folder for the log of the delivery")
        settings = {**producer_settings(producer), **sink_options}
        narrow = messages.coalesce(partitions) if partitions else messages
        delivery = deliver(narrow, client, settings, log, keyed, max_bytes, MESSAGE_OVERHEAD)
        if rejected is not None:
            delivery.rejected(spark).drop("reason").write.parquet(rejected)
        return delivery.counters()
    status = publish_status(keyed, max_bytes)
    counters = messages.select(status.alias("status")).agg(*publish_counters()).first().asDict()
    failures = counters[KAFKA_FAILURES]
    if failures and rejected is None:
        raise ValueError(f"{failures} messages cannot be sent; name a folder for rejected ones")
    if rejected is not None:
        rejected_messages(messages, keyed, max_bytes).write.parquet(rejected)
    sendable = messages.where(status == SUCCESS) if failures else messages
    if partitions:
        sendable = sendable.coalesce(partitions)
    write_messages(sendable, producer, format, **sink_options)
    return counters


def _setting(text: str) -> tuple[str, str]:
    name, separator, value = text.partition("=")
    if not separator:
        raise argparse.ArgumentTypeError(f"expected name=value, got {text!r}")
    return name, value


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Publish employee records")
    parser.add_argument("--input", required=True)
    parser.add_argument("--topic", required=True)
    parser.add_argument("--producer", type=_setting, action="append", default=[])
    parser.add_argument("--partitions", type=int)
    parser.add_argument("--unkeyed", action="store_true")
    parser.add_argument("--format", default="kafka")
    parser.add_argument("--rejected", help="new folder for messages that cannot be sent")
    parser.add_argument("--client", help="module:name of a client that sends one by one")
    parser.add_argument("--log", help="new folder for the client's delivery log")
    parser.add_argument("--sink", type=_setting, action="append", default=[])
    options = parser.parse_args(arguments)

    spark = SparkSession.builder.appName("memberfold-publish").getOrCreate()
    counters = run_publish(
        spark,
        options.input,
        options.topic,
        dict(options.producer),
        options.partitions,
        keyed=not options.unkeyed,
        format=options.format,
        rejected=options.rejected,
        client=options.client,
        log=options.log,
        **dict(options.sink),
    )
    print(json.dumps(counters))


if __name__ == "__main__":
    main()
