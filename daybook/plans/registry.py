"""Registered queries: a name, the Spark builder and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class Tables:
    """The given tables of one folder, read when first used."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Tables], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.build(Tables(spark, folder))


REGISTERED: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register a builder; without ``sql`` only its rows are checked."""

    def register(build: Callable[[Tables], DataFrame]):
        if name in REGISTERED:
            raise ValueError(f"query {name} is registered twice")
        REGISTERED[name] = Query(name, build, sql)
        return build

    return register


# presentation shared by the queries: plain types that compare equally everywhere


def day_text(column: str | Column) -> Column:
    return F.date_format(column, "yyyy-MM-dd")


def per_month(df: DataFrame, keys: list[str | Column], day: str, *aggregates: Column) -> DataFrame:
    """Aggregates per key and month; the month is made text after the rows are grouped."""
    grouped = df.groupBy(*keys, F.trunc(day, "month").alias("month")).agg(*aggregates)
    return grouped.withColumn("month", F.date_format("month", "yyyy-MM"))


def days_text(column: str | Column) -> Column:
    c = F.col(column) if isinstance(column, str) else column
    return F.array_join(F.transform(c, lambda d: F.date_format(d, "yyyy-MM-dd")), ",")


def numbers_text(column: str | Column) -> Column:
    c = F.col(column) if isinstance(column, str) else column
    return F.array_join(F.transform(c, lambda n: n.cast("string")), ",")


def rounded(column: str | Column, digits: int = 6) -> Column:
    """Rounded double without a negative zero."""
    c = F.col(column) if isinstance(column, str) else column
    return F.round(c.cast("double"), digits) + F.lit(0.0)


def rounded_price(column: str | Column, digits: int = 6) -> Column:
    """Rounded half up from its decimal value, three digits further.

    Sums in another order differ in the last bits only; a value that lies on the border between two results is the same decimal either way.
    """
    c = F.col(column) if isinstance(column, str) else column
    return F.round(c.cast("double").cast(f"decimal(28,{digits + 3})"), digits).cast("double")


def rounded_price_sql(expression: str, digits: int = 6) -> str:
    """The same in SQL."""
    return f"CAST(round(CAST({expression} AS DECIMAL(28, {digits + 3})), {digits}) AS DOUBLE)"


def cents(column: str | Column) -> Column:
    """Sum of two-digit amounts, to the cent."""
    return rounded(F.sum(column), 2)
