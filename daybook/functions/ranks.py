"""Numbering of distinct values in sorted order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daybook.session import fresh_path


def ordered_codes(values: DataFrame, group: str, value: str, code: str = "code") -> DataFrame:
    """Codes 0, 1, 2, ... of the distinct texts of each group in binary order.

    The distinct texts are dealt into ranges of about equal size, whatever their first characters, and numbered within their range;
    running counts of the ranges before give the codes, so no task sorts all values of a group. The ranges
    are written to the session's shared folder, as they rest on a sample and must be the same in both uses.
    """
    spark = values.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    distinct = values.select(F.col(group).alias("_group"), F.col(value).alias("_value")).where("_value IS NOT NULL").distinct()
    path = fresh_path(spark, "ordered-codes")
    distinct.repartitionByRange(ranges, "_group", "_value").withColumn("_range", F.spark_partition_id()).write.parquet(path)
    ranged = spark.read.parquet(path)
    sizes = ranged.groupBy("_group", "_range").agg(F.count(F.lit(1)).alias("_n"))
    order = Window.partitionBy("_group").orderBy("_range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    shifts = sizes.withColumn("_shift", F.sum("_n").over(order) - F.col("_n")).select(
        F.col("_group").alias("_g"), F.col("_range").alias("_r"), "_shift")
    within = Window.partitionBy("_group", "_range").orderBy("_value")
    numbered = ranged.withColumn("_k", F.row_number().over(within) - 1)
    return numbered.join(shifts, F.col("_group").eqNullSafe(F.col("_g")) & (F.col("_range") == F.col("_r"))).select(
        F.col("_group").alias(group), F.col("_value").alias(value), (F.col("_k") + F.col("_shift")).cast("long").alias(code)
    )
