"""File system calls of the driver: names only, several at a time."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark.sql import SparkSession

# Calls that wait for a store at the same time.
THREADS = 16
_GLOB = re.compile(r"[*?\[{]")
# A URI without authority may be spelled with one slash or three.
NO_AUTHORITY = r"^([A-Za-z][A-Za-z0-9+.-]*):///"


def is_glob(path: str) -> bool:
    return bool(_GLOB.search(path))


class Files:
    """The file systems that the session reaches, asked through its own configuration."""

    def __init__(self, spark: SparkSession):
        context = spark.sparkContext
        self._path = context._jvm.org.apache.hadoop.fs.Path
        self._configuration = context._jsc.hadoopConfiguration()

    def at(self, path: str) -> tuple[Any, Any]:
        """File system and path object."""
        found = self._path(path)
        return found.getFileSystem(self._configuration), found

    def existing(self, path: str) -> list[str]:
        """Full URIs of the folder or file at a path, or of all that a glob names.

        Each has one spelling, whatever way the location was written.
        """
        system, found = self.at(path)
        if is_glob(path):
            statuses = list(system.globStatus(found) or [])
            if not statuses:
                raise FileNotFoundError(f"nothing matches {path}")
        else:
            statuses = [system.getFileStatus(found)]
        return [re.sub(NO_AUTHORITY, r"\1:/", s.getPath().toUri().toString()) for s in statuses]

    def children(self, root: str) -> list[tuple[str, str]]:
        """Name and path of the direct children of a folder; a missing folder has none."""
        system, found = self.at(root)
        if not system.exists(found):
            return []
        paths = [status.getPath() for status in system.listStatus(found)]
        return [(p.getName(), p.toString()) for p in paths]


    def exists(self, path: str) -> bool:
        system, found = self.at(path)
        return system.exists(found)

    def move(self, path: str, to: str) -> None:
        """Renames a folder to a name that is free; raises where that fails."""
        system, found = self.at(path)
        target = self._path(to)
        # An existing folder would take the other one in as a child.
        if system.exists(target) or not system.rename(found, target):
            raise OSError(f"cannot rename {path} to {to}")

    def remove(self, path: str) -> None:
        """Deletes a folder with all that it holds, if it is there."""
        system, found = self.at(path)
        system.delete(found, True)


def side_by_side(call: Callable[[Any], Any], items: Iterable[Any]) -> list[Any]:
    """``call`` of every item, in order; the first item that fails raises."""
    with ThreadPoolExecutor(THREADS) as pool:
        return list(pool.map(call, items))
