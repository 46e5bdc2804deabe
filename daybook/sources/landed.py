"""API responses landed as JSON files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _envelope(columns: list[str]) -> T.StructType:
    record = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return T.StructType([T.StructField("data", T.ArrayType(record))])


def read_landed_records(
    spark: SparkSession, path: str, columns: list[str] | None = None, multiline: bool = False, after: str | None = None
) -> DataFrame:
    """One row per record of the envelopes ``{"data": [{...}, ...]}``, all values as text.

    With ``columns`` the files are read once; without, a first pass finds the columns.
    Envelopes without data give no row. With ``after`` only pages (files) whose name is greater are
    opened, so a load by page names in rising order goes on where the last one stopped.
    """
    reader = spark.read.option("primitivesAsString", "true").option("multiLine", str(multiline).lower())
    if columns:
        reader = reader.schema(_envelope(columns))
    pages = reader.json(path)
    if after is not None:
        pages = pages.where(F.col("_metadata.file_name") > after)
    return pages.select(F.explode("data").alias("r")).select("r.*")


def stream_landed_records(
    spark: SparkSession, path: str, columns: list[str], multiline: bool = False, pages_per_batch: int | None = None
) -> DataFrame:
    """The same records as a stream over the pages that land in a folder.

    The checkpoint of the stream remembers which pages were read; a restart reads the others only.
    """
    reader = spark.readStream.schema(_envelope(columns)).option("primitivesAsString", "true").option("multiLine", str(multiline).lower())
    if pages_per_batch:
        reader = reader.option("maxFilesPerTrigger", str(pages_per_batch))
    return reader.json(path).select(F.explode("data").alias("r")).select("r.*")
