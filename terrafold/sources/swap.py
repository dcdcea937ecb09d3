"""Replaces a directory by a new version of it, so that a stop at any point loses no rows.

The new version is written beside the current one. The current one is then moved to a fixed name, the new one
takes its place, and the moved one goes. A stop in between leaves the moved version under that fixed name:
readers take it for the current one, and the next writer moves it back before it reads."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Swap:
    """Names and moves of one directory; paths go through Hadoop's file system."""

    def __init__(self, spark: SparkSession, at: str, fresh: str, old: str):
        self.at, self.fresh, self.old = at, fresh, old
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(at).getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def current(self) -> str | None:
        """Where the current version is, if there is one. Changes nothing."""
        return next((p for p in (self.at, self.old) if self.exists(p)), None)

    def recover(self) -> bool:
        """Ends what a stopped writer began; whether there is a current version, which then is at `at`."""
        if not self.exists(self.at):
            if not self.exists(self.old):
                return False
            self.move(self.old, self.at)
        elif self.exists(self.old):
            self.remove(self.old)
        return True

    def commit(self) -> str:
        """Puts the version written to `fresh` in the place of the current one."""
        if self.exists(self.at):
            self.remove(self.old)
            self.move(self.at, self.old)
        self.move(self.fresh, self.at)
        self.remove(self.old)
        return self.at

    def make(self, path: str) -> None:
        self._fs.mkdirs(self._path(path))

    def move(self, source: str, target: str) -> None:
        if not self._fs.rename(self._path(source), self._path(target)):
            raise OSError(f"can't move {source} to {target}")

    def remove(self, path: str) -> None:
        if self.exists(path) and not self._fs.delete(self._path(path), True):
            raise OSError(f"can't remove {path}")
