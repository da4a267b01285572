"""Files of a store, through Hadoop's file systems: local, HDFS or an object store."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.errors import PySparkException
from pyspark.sql import SparkSession


class Files:
    """The files below one root."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm, self._root = spark._jvm, root.rstrip("/")
        self._system = self._at("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self._root}/{name}" if name else self._root)

    def exists(self, name: str) -> bool:
        return self._system.exists(self._at(name))

    def claim(self, name: str) -> bool:
        """Make an empty file; False if it is there already."""
        from py4j.protocol import Py4JJavaError

        try:
            self._system.create(self._at(name), False).close()
        except (Py4JJavaError, PySparkException):
            if self.exists(name):
                return False
            raise
        return True

    def delete(self, name: str) -> None:
        self._system.delete(self._at(name), True)

    def move(self, name: str, target: str) -> None:
        """Put a folder in the place of another, if there is one."""
        self.delete(target)
        self._system.mkdirs(self._at(target).getParent())
        if not self._system.rename(self._at(name), self._at(target)):
            raise OSError(f"{name} can't be moved to {target}")

    def folders(self, name: str, depth: int) -> Iterator[str]:
        """Folders ``depth`` levels below a folder, which may be missing."""
        if not self.exists(name):
            return
        for status in self._system.listStatus(self._at(name)):
            if status.isDirectory():
                below = f"{name}/{status.getPath().getName()}"
                if depth == 1:
                    yield below
                else:
                    yield from self.folders(below, depth - 1)
