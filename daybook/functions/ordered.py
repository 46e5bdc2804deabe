"""Windows over the rows before, in one order of the whole table, without one task that sorts it all."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.session import fresh_path

RANGE_ROWS = 4_000_000


def rows_before(df: DataFrame, order: list[str], size: int, columns: dict[str, Callable], range_rows: int = RANGE_ROWS) -> DataFrame:
    """``df`` with ``columns``: each a function from a window over the ``size`` rows before a row to a column.

    1. The rows are dealt into ranges of ``order``, as many as the session has shuffle partitions or more, so that a range has about ``range_rows``
       rows at most. They are written, so that a range stays the same when it is read again.
    2. The last ``size`` rows of each range travel to the ranges after it, as far as these still lie within ``size`` rows (the halo);
       the rows counted per range tell how far. That is ``size`` rows per range in most cases.
    3. Each range with its halo is a partition of the window.

    ``order`` must tell all rows apart where the result is to be determined; rows equal in it come in any order, though a
    range may end between them. Nulls come first. An empty table gives an empty result.
    """
    spark = df.sparkSession
    n_ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(df.count() / range_rows))
    path = fresh_path(spark, "ordered")
    df.repartitionByRange(n_ranges, *order).withColumn("_ordered_range", F.spark_partition_id()).write.parquet(path)
    ranged = spark.read.schema(T.StructType([*df.schema, T.StructField("_ordered_range", T.IntegerType())])).parquet(path)

    counts = dict(map(tuple, ranged.groupBy("_ordered_range").count().collect()))  # one row per range
    reach = []  # range, later range, rows between them
    ranges = sorted(counts)
    for k, here in enumerate(ranges):
        between = 0
        for later in ranges[k + 1 :]:
            reach.append((here, later, between))
            between += counts[later]
            if between >= size:
                break
    later = spark.createDataFrame(reach, "_ordered_from int, _ordered_to int, _ordered_between long")
    backwards = Window.partitionBy("_ordered_range").orderBy(*[F.col(c).desc() for c in order])
    ends = ranged.withColumn("_ordered_nth", F.row_number().over(backwards)).where(F.col("_ordered_nth") <= size)
    # at most one row per range and reach: small beside the table
    halo = ends.join(F.broadcast(later), F.col("_ordered_range") == F.col("_ordered_from")).where(F.col("_ordered_nth") + F.col("_ordered_between") <= size)
    halo = halo.select(*df.columns, F.col("_ordered_to").alias("_ordered_range"), F.lit(True).alias("_ordered_halo"))
    window = Window.partitionBy("_ordered_range").orderBy(*order).rowsBetween(-size, -1)
    whole = ranged.withColumn("_ordered_halo", F.lit(False)).unionByName(halo)
    return whole.withColumns({name: make(window) for name, make in columns.items()}).where("not _ordered_halo").drop("_ordered_halo", "_ordered_range")


def before(df: DataFrame, partition_by: list[str] | None, order: list[str], size: int, columns: dict[str, Callable], range_rows: int = RANGE_ROWS) -> DataFrame:
    """``columns`` over the ``size`` rows before, within each series of ``partition_by`` or, without one, over the whole table."""
    if not partition_by:
        return rows_before(df, order, size, columns, range_rows)
    window = Window.partitionBy(*partition_by).orderBy(*order).rowsBetween(-size, -1)
    return df.withColumns({name: make(window) for name, make in columns.items()})


def last_value(column: str) -> Callable:
    """The value of the row before."""
    return lambda window: F.last(column).over(window)
