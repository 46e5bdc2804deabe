"""Tables in hash buckets: a merge rewrites the buckets it touches and leaves the files of all others alone."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.sources.folders import Folder
from daybook.sources.tables import upsert

BUCKETS = 256


class BucketedTable:
    """A table whose rows lie in ``buckets`` folders by a hash of ``keys``.

    A version is a list of one folder per bucket, written last: readers see the whole old version until it is there, and a
    merge that is repeated under its number gives the same version. Versions before the last but one, and folders that only they name, are
    removed. ``buckets`` stays as it was when the table began; k changed keys rewrite at most k buckets. One writer at a time.
    """

    def __init__(self, spark: SparkSession, root: str, keys: list[str], buckets: int = BUCKETS):
        self.spark, self.root, self.keys, self.buckets = spark, root.rstrip("/"), keys, buckets

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def versions(self) -> list[int]:
        """Numbers of the versions present and whole."""
        folder = Folder(self.spark, self.root)
        names = [n for n in folder.names("versions") if "_SUCCESS" in folder.names(f"versions/{n}")]
        return sorted(int(n.removeprefix("version=")) for n in names)

    def folders(self, version: int) -> dict[int, str]:
        """The folder of each bucket that has rows: at most ``buckets`` names."""
        listed = self.spark.read.schema("bucket int, folder string").parquet(f"{self.root}/versions/version={version}")
        return {r.bucket: r.folder for r in listed.collect()}

    def _read(self, folders: list[str], schema: T.StructType) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{f}" for f in sorted(folders)])

    def latest(self, schema: T.StructType | None = None) -> DataFrame:
        """All rows of the last version; ``schema`` is needed for a table that may be empty."""
        found = self.versions()
        folders = list(self.folders(found[-1]).values()) if found else []
        if schema is None:
            schema = self.spark.read.parquet(f"{self.root}/{folders[0]}").schema
        return self._read(folders, schema)

    def merge(self, rows: DataFrame, version: int, combine: Callable[[DataFrame, DataFrame], DataFrame]) -> None:
        """Version ``version``: in the buckets of ``rows`` what ``combine`` makes of their old rows and ``rows``, elsewhere the version before.

        ``combine`` works on rows of whole keys and returns the columns of ``rows``.
        """
        found = self.versions()
        if found and found[-1] > version or version and version - 1 not in found:
            raise ValueError(f"{self.root} holds versions {found}, which do not belong before version {version}")
        old = self.folders(version - 1) if version else {}
        touched = {r.b for r in rows.select(self._bucket().alias("b")).distinct().collect()}
        if touched:
            merged = combine(self._read([f for b, f in old.items() if b in touched], rows.schema), rows).select(*rows.columns)
            placed = merged.withColumn("_bucket", self._bucket()).hint("rebalance", F.col("_bucket"))
            placed.write.mode("overwrite").partitionBy("_bucket").parquet(f"{self.root}/data/version={version}")
        folder = Folder(self.spark, self.root)
        written = [n for n in folder.names(f"data/version={version}") if n.startswith("_bucket=")] if touched else []
        now = {b: f for b, f in old.items() if b not in touched}
        now |= {int(n.removeprefix("_bucket=")): f"data/version={version}/{n}" for n in written}
        listed = self.spark.createDataFrame(sorted(now.items()), "bucket int, folder string").coalesce(1)
        listed.write.mode("overwrite").parquet(f"{self.root}/versions/version={version}")
        self._clean(folder, version, {*now.values(), *old.values()})

    def _clean(self, folder: Folder, version: int, named: set[str]) -> None:
        for v in [v for v in self.versions() if v < version - 1]:
            folder.remove(f"versions/version={v}")
        for v in folder.names("data"):
            rest = [f"data/{v}/{b}" for b in folder.names(f"data/{v}")]
            kept = [f for f in rest if f in named]
            for gone in [f for f in rest if f not in named and "_bucket=" in f] if kept else [f"data/{v}"]:
                folder.remove(gone)

    def upsert(self, updates: DataFrame, order: list[str] | None = None) -> int:
        """Put rows in place by key as the next version; its number. Repeated keys as in ``tables.upsert``."""
        version = self.versions()[-1] + 1 if self.versions() else 0
        self.merge(updates, version, lambda old, new: upsert(old, new, self.keys, order))
        return version
