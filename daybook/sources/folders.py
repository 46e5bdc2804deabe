"""The few file operations that DataFrame readers and writers do not offer, on any file system Spark knows."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Folder:
    def __init__(self, spark: SparkSession, path: str):
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self.root = path.rstrip("/")
        self._system = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def names(self, below: str = "") -> list[str]:
        folder = self._path(f"{self.root}/{below}") if below else self._path(self.root)
        return [s.getPath().getName() for s in self._system.listStatus(folder)] if self._system.exists(folder) else []

    def mark(self, name: str) -> None:
        self._system.create(self._path(f"{self.root}/{name}"), True).close()

    def remove(self, name: str) -> None:
        self._system.delete(self._path(f"{self.root}/{name}"), True)
