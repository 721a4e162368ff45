"""Replacement of a folder that leaves the old one readable until the new one is whole."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

from memberfold.sources.files import Files

# Added to a folder's name while it is replaced.
STAGED, REPLACED = ".staged-", ".replaced"


def recover(spark: SparkSession, path: str) -> None:
    """Finish a replacement that ended between its two renames: the old folder comes back."""
    files, old = Files(spark), path.rstrip("/") + REPLACED
    if not files.exists(old):
        return
    if files.exists(path):
        files.remove(old)
    else:
        files.move(old, path)


@contextmanager
def replacing(spark: SparkSession, path: str) -> Iterator[str]:
    """A new folder beside ``path`` to write to, put in its place if the body ends well.

    If the body fails, the new folder is removed and the old one stays as it was. The old
    one is renamed away before the new one gets its name, and deleted after that; what
    ended in between is put right by the next replacement, or by ``recover``. Only where
    a rename is one step, as on HDFS or a local disk, is there never half a folder.
    """
    files = Files(spark)
    recover(spark, path)
    bare = path.rstrip("/")
    staged, old = f"{bare}{STAGED}{uuid.uuid4().hex}", bare + REPLACED
    try:
        yield staged
        if files.exists(path):
            files.move(path, old)
        try:
            files.move(staged, path)
        except BaseException:
            recover(spark, path)
            raise
        files.remove(old)
    finally:
        files.remove(staged)
