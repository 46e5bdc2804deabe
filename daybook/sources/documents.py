"""Documents from a folder or object store, loaded once per content."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.functions.latest import first_row
from daybook.functions.text import document_text


def list_documents(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """All files below ``path`` with the hash of their content."""
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path)
    )
    return files.select(
        F.md5("content").alias("file_hash"), F.element_at(F.split("path", "/"), -1).alias("document_name"),
        F.col("modificationTime").alias("creation_date"), "content",
    )


def ingest_new_documents(documents: DataFrame, existing: DataFrame) -> DataFrame:
    """Documents whose content hash is not stored yet, one per hash, with their text.

    ``documents``: file_hash, document_name, creation_date, content. The choice is made on hash, time and name alone:
    stored hashes go first, then among copies the earliest by time and name is kept. Contents move once, to the
    chosen rows; rows equal in all three have equal contents, and one of them is taken.
    """
    order = ["file_hash", "creation_date", "document_name"]
    known = existing.select(F.col("file_hash").alias("_known")).where("_known IS NOT NULL").distinct()
    unknown = documents.select(*order).join(known, F.col("file_hash") == F.col("_known"), "left_anti")
    one = first_row(unknown, ["file_hash"], ["creation_date", "document_name"])
    chosen = one.select(*[F.col(c).alias(f"_{c}") for c in order])
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in order]
    new = documents.join(chosen, same, "left_semi").dropDuplicates(order)
    return new.select(
        "file_hash", "document_name", "creation_date",
        document_text(F.col("document_name"), F.col("content")).alias("document_text"),
    )
