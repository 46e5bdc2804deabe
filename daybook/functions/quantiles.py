"""Exact quantiles with linear interpolation that never gather a whole group in one task.

An approximate sketch gives, for each wanted quantile, a narrow interval that is certain to
contain it. Rows below the interval are only counted, rows inside are counted per distinct
value, and the wanted ranks are read from the running count. With the accuracy below the
interval holds about 1 in 10,000 rows of a large group; small groups fall wholly inside.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.functions.skew import attach_per_key

ACCURACY = 50_000


def exact_quantiles(
    df: DataFrame, keys: list[str], value: str | Column, probabilities: list[float], name: str = "quantiles",
    few_keys: bool = False,
) -> DataFrame:
    """One row per key with the array ``name`` of quantiles in the order of ``probabilities``.

    ``few_keys`` says that the number of keys has a bound that does not grow with the data, such
    as the columns of a table or the clusters of a model. The intervals then reach the rows by
    broadcast and the rows are not shuffled; without keys they are a single scalar. Otherwise
    rows and intervals are joined with hot keys spread out.
    """
    column = F.col(value) if isinstance(value, str) else value
    rows = df.select(*keys, column.cast("double").alias("_v")).where("_v IS NOT NULL")
    if not keys:
        rows = rows.withColumn("_all", F.lit(1))
    group = keys or ["_all"]

    # the sketch's rank error is at most n / ACCURACY, so twice that on both sides is safe
    margin = 2.0 / ACCURACY
    low = [F.lit(max(0.0, p - margin)) for p in probabilities]
    high = [F.lit(min(1.0, p + margin)) for p in probabilities]
    bounds = rows.groupBy(*group).agg(
        F.count(F.lit(1)).alias("_n"),
        F.percentile_approx("_v", F.array(*low), F.lit(ACCURACY)).alias("_low"),
        F.percentile_approx("_v", F.array(*high), F.lit(ACCURACY)).alias("_high"),
    )
    if not keys:
        fields = F.struct("_n", "_low", "_high")
        bounded = rows.withColumn("_b", bounds.select(fields).scalar()).select("_all", "_v", "_b.*")
    elif few_keys:
        renamed = bounds.withColumnsRenamed({k: f"_r_{k}" for k in group})
        same = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in group]
        bounded = rows.join(F.broadcast(renamed), same).drop(*[f"_r_{k}" for k in group])
    else:
        bounded = attach_per_key(rows, bounds, group)
    index = F.array(*[F.lit(i) for i in range(len(probabilities))])
    # slot -1 and 1 gather what lies below and above; their nearest values serve an interpolation
    # that reaches one rank over the edge
    placed = (
        bounded.withColumn("_i", F.explode(index))
        .withColumn("_lo", F.element_at("_low", F.col("_i") + 1))
        .withColumn("_hi", F.element_at("_high", F.col("_i") + 1))
        .withColumn("_slot", F.when(F.col("_v") < F.col("_lo"), -1).when(F.col("_v") > F.col("_hi"), 1).otherwise(0))
        .withColumn("_inside", F.when(F.col("_slot") == 0, F.col("_v")))
        .groupBy(*group, "_i", "_slot", "_inside")
        .agg(F.count(F.lit(1)).alias("_c"), F.max("_n").alias("_n"), F.min("_v").alias("_min"), F.max("_v").alias("_max"))
    )
    order = Window.partitionBy(*group, "_i").orderBy("_slot", "_inside")
    ranked = placed.withColumn(
        "_upto", F.sum("_c").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ).withColumn("_before", F.col("_upto") - F.col("_c"))

    wanted = F.element_at(F.array(*[F.lit(float(p)) for p in probabilities]), F.col("_i") + 1)
    position = (F.col("_n") - 1) * wanted
    lower, upper = F.floor(position), F.ceil(position)

    def at(rank: Column) -> Column:
        slot = F.col("_slot")
        inside = (slot == 0) & (F.col("_before") <= rank) & (rank < F.col("_upto"))
        return F.max(
            F.when(inside, F.col("_inside"))
            .when((slot == -1) & (rank == F.col("_upto") - 1), F.col("_max"))
            .when((slot == 1) & (rank == F.col("_before")), F.col("_min"))
        )

    per_quantile = (
        ranked.withColumns({"_rl": lower, "_ru": upper, "_frac": position - lower})
        .groupBy(*group, "_i", "_frac")
        .agg(at(F.col("_rl")).alias("_a"), at(F.col("_ru")).alias("_b"))
        .withColumn("_q", F.col("_a") + (F.col("_b") - F.col("_a")) * F.col("_frac"))
    )
    result = per_quantile.groupBy(*group).agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("_i", "_q"))), lambda x: x["_q"]
        ).alias(name)
    )
    return result.drop("_all")


def most_frequent(df: DataFrame, keys: list[str], value: str, name: str = "mode") -> DataFrame:
    """Most frequent non-null value per key, the smallest one on a tie."""
    counted = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_c"))
    best = F.min_by(F.col(value), F.struct(-F.col("_c"), F.col(value))).alias(name)
    return counted.groupBy(*keys).agg(best)
