"""Tables in files and databases: reading, loading, replacing and upserting."""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.functions.latest import latest_row


def read_table(spark: SparkSession, path: str, kind: str = "parquet", schema: T.StructType | None = None,
               **options: str) -> DataFrame:
    """A Parquet, CSV, JSON or ORC table. CSV has a header; without schema its columns are text."""
    reader: DataFrameReader = spark.read.format(kind).options(**options)
    if kind == "csv":
        reader = reader.option("header", "true")
    return (reader.schema(schema) if schema else reader).load(path)


def write_table(df: DataFrame, path: str, kind: str = "parquet", mode: str = "append", **options: str) -> None:
    """Append to or replace a table in files."""
    writer = df.write.format(kind).mode(mode).options(**options)
    if kind == "csv":
        writer = writer.option("header", "true")
    writer.save(path)


def jdbc_options(url: str, table: str | None = None, query: str | None = None, fetchsize: int = 10_000,
                 partition_column: str | None = None, bounds: tuple[str, str] | None = None,
                 partitions: int = 1, **properties: str) -> dict[str, str]:
    """Options of a JDBC scan; with a partition column the scan is split over ``partitions`` connections."""
    if (table is None) == (query is None):
        raise ValueError("give either a table or a query")
    options = {"url": url, "fetchsize": str(fetchsize), **properties}
    if partition_column and bounds:
        # a split scan takes a table expression, not the query option
        options |= {"dbtable": table or f"({query}) AS q", "partitionColumn": partition_column,
                    "lowerBound": bounds[0], "upperBound": bounds[1], "numPartitions": str(partitions)}
    elif table:
        options["dbtable"] = table
    else:
        options["query"] = query
    return options


def read_jdbc(spark: SparkSession, url: str, **arguments) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(url, **arguments)).load()


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", batchsize: int = 10_000,
               **properties: str) -> None:
    """Append to or replace a database table; replacing keeps the table's definition."""
    options = {"url": url, "dbtable": table, "batchsize": str(batchsize), "truncate": "true", **properties}
    df.write.format("jdbc").mode(mode).options(**options).save()


def full_refresh(df: DataFrame, path: str) -> None:
    """Truncate and load. ``df`` must not read from ``path``."""
    df.write.mode("overwrite").parquet(path)


def replace_partitions(df: DataFrame, path: str, partition: str | list[str]) -> None:
    """Replace the partitions that occur in ``df`` and leave all others, so that a rerun changes nothing.

    Rows are rebalanced by the partition columns before writing: a folder gets few files of a
    useful size, and a folder with many rows is split over several tasks.
    """
    names = [partition] if isinstance(partition, str) else partition
    balanced = df.hint("rebalance", *[F.col(n) for n in names])
    balanced.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*names).parquet(path)


def upsert(target: DataFrame, updates: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """``target`` with the rows of ``updates`` put in place by key and new keys added.

    Repeated keys in ``updates`` are reduced to one: the last by ``order``, by default by all
    other columns. Keys are compared null-safe.
    """
    rest = [c for c in target.columns if c not in keys]
    last = latest_row(updates.select(*target.columns), keys, order or rest or keys)
    changed = last.select(*[F.col(k).alias(f"_u_{k}") for k in keys])
    same = [F.col(k).eqNullSafe(F.col(f"_u_{k}")) for k in keys]
    return target.join(changed, same, "left_anti").unionByName(last)


def upsert_table(updates: DataFrame, path: str, new_path: str, keys: list[str], order: list[str] | None = None) -> str:
    """Write the upserted table to a new folder; the one being read stays as it is."""
    if path.rstrip("/") == new_path.rstrip("/"):
        raise ValueError("the new version needs its own folder")
    target = updates.sparkSession.read.parquet(path)
    upsert(target, updates, keys, order).write.mode("overwrite").parquet(new_path)
    return new_path


def latest_rows(df: DataFrame, ts: str, n: int = 5, tiebreak: list[str] | None = None) -> DataFrame:
    """The last ``n`` rows by time; every task keeps only its own last ``n``."""
    return df.orderBy(F.col(ts).desc(), *[F.col(c).desc() for c in tiebreak or []]).limit(n)
