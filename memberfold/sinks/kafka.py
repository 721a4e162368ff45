"""Kafka output."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

BROKERS = "bootstrap.servers"

# Producer settings used where the caller gives none.
PRODUCER_DEFAULTS = {
    "buffer.memory": "33554432",
    "batch.size": "16384",
    "acks": "1",
    "retries": "2",
    "client.id": "client",
    "linger.ms": "0",
    "compression.type": "none",
    "request.timeout.ms": "30000",
    "retry.backoff.ms": "100",
}


def producer_settings(config: Mapping[str, object] | None) -> dict[str, str]:
    """A producer configuration with defaults where it gives none; brokers are required."""
    if config is None:
        raise ValueError("producer configuration is missing")
    if not config.get(BROKERS):
        raise ValueError(f"{BROKERS} is missing from the producer configuration")
    return {name: str(value) for name, value in {**PRODUCER_DEFAULTS, **config}.items()}


def producer_options(config: Mapping[str, object] | None) -> dict[str, str]:
    """Writer options of the connector for a producer configuration."""
    return {f"kafka.{name}": value for name, value in producer_settings(config).items()}


def write_messages(
    messages: DataFrame, config: Mapping[str, object], format: str = "kafka", **options: str
) -> None:
    """Append ``topic, key, value`` rows. ``format`` names another sink for a dry run."""
    kafka = producer_options(config)
    settings = {**kafka, **options} if format == "kafka" else options
    messages.write.format(format).options(**settings).mode("append").save()
