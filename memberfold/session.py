"""Session helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new, unused path for an intermediate table that every executor can reach.

    It lies under the folder the cluster names in ``spark.checkpoint.dir``. Only a
    local session that names none gets a temporary folder of its own.
    """
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="memberfold-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def shuffle_partitions(spark: SparkSession) -> int:
    """How many partitions a shuffle of this session starts with."""
    fixed = spark.conf.get("spark.sql.shuffle.partitions")
    initial = spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    return max(int(fixed), int(initial or 0))
