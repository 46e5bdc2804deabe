"""Linear recurrences along a series, in blocks, so that a long series is the work of many tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 512
_STEP = "struct<start:double,add:double,factor:double>"


def _after(value: Column, step: Column) -> Column:
    """What a step makes of the value before it."""
    return F.when(value.isNull(), step["start"]).otherwise(step["add"] + step["factor"] * value)


def _composed(first: Column, second: Column) -> Column:
    """Both steps as one: steps are closed under composition."""
    ends = first["add"].isNull()  # whatever came before, the first step gives null
    return F.struct(
        _after(first["start"], second).alias("start"),
        F.when(ends, second["start"]).otherwise(second["add"] + second["factor"] * first["add"]).alias("add"),
        F.when(ends, F.when(second["start"].isNotNull(), F.lit(0.0))).otherwise(second["factor"] * first["factor"]).alias("factor"),
    )


def block_of(position: Column, size: int) -> Column:
    return F.floor(position / size).cast("long")


def chained(steps: DataFrame, keys: list[str], position: str, block: int = BLOCK) -> DataFrame:
    """(keys, position, value): the value after each step of each series, in the order of ``position``.

    A step has the columns ``start``, ``add`` and ``factor``: after a value v it gives ``add + factor * v`` (null where ``add`` is null), after
    null or at the beginning ``start``. Steps of ``block`` positions are composed into one array of prefixes, blocks in parallel.
    Only the last prefix of each block goes on to the scan of a series, which gives the value before each block; a series of n positions
    is n / ``block`` steps there. Positions may have gaps, but none occurs twice in a series; ``start`` and ``factor`` may be null with ``add``.
    """
    step = F.struct("start", "add", "factor").cast(_STEP)
    gathered = steps.groupBy(*keys, block_of(F.col(position), block).alias("_block")).agg(
        F.array_sort(F.collect_list(F.struct(F.col(position).alias("at"), step.alias("step")))).alias("_steps")
    )
    nothing = F.struct(F.lit(None), F.lit(0.0), F.lit(1.0)).cast(_STEP)  # the step that changes nothing

    def extend(done: Column, now: Column) -> Column:
        last = F.coalesce(F.try_element_at(done, F.lit(-1)), nothing)
        return F.array_append(done, _composed(last, now["step"]).cast(_STEP))

    prefixes = gathered.select(*keys, "_block", F.col("_steps.at").alias("_at"), F.aggregate(
        "_steps", F.array().cast(f"array<{_STEP}>"), extend).alias("_prefix"))
    whole = F.struct(F.col("_block").alias("block"), F.element_at("_prefix", -1).alias("step"))
    blocks = prefixes.groupBy(*keys).agg(F.array_sort(F.collect_list(whole)).alias("_blocks"))
    before = F.aggregate(
        "_blocks", F.array().cast("array<double>"),
        lambda done, now: F.array_append(done, _after(F.try_element_at(done, F.lit(-1)), now["step"])),
    )
    # the value before a block is the one after the block before it
    pairs = F.arrays_zip(F.col("_blocks.block").alias("block"), F.concat(F.array(F.lit(None).cast("double")), before).alias("value"))
    carried = blocks.select(*[F.col(k).alias(f"_of_{k}") for k in keys], F.explode(pairs).alias("_c"))
    same = [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys] + [F.col("_block") == F.col("_c.block")]
    zipped = F.explode(F.arrays_zip(F.col("_at").alias("at"), F.col("_prefix").alias("step"))).alias("_s")
    each = prefixes.join(carried, same).select(*keys, F.col("_c.value").alias("_carry"), zipped)
    return each.select(*keys, F.col("_s.at").alias(position), _after(F.col("_carry"), F.col("_s")["step"]).alias("value"))


def last_before(df: DataFrame, keys: list[str], position: str, marked: Column, block: int = BLOCK) -> DataFrame:
    """``df`` with ``last_marked``, the greatest position up to the row's own where ``marked`` holds, and ``first_position`` of the series.

    Runs over a series in blocks like ``chained``: one row per block goes through the scan of the series.
    """
    at = F.when(marked, F.col(position))
    cut = df.withColumn("_block", block_of(F.col(position), block))
    blocks = cut.groupBy(*keys, "_block").agg(F.max(at).alias("_last"), F.min(position).alias("_first"))
    earlier = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(*[F.col(k).alias(f"_of_{k}") for k in keys], F.col("_block").alias("_of"), F.max("_last").over(earlier).alias("_before"),
                           F.min("_first").over(Window.partitionBy(*keys)).alias("first_position"))
    same = [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys] + [F.col("_block") == F.col("_of")]
    inside = Window.partitionBy(*keys, "_block").orderBy(position).rowsBetween(Window.unboundedPreceding, 0)
    found = cut.withColumn("_inside", F.max(at).over(inside)).join(blocks, same)
    return found.withColumn("last_marked", F.coalesce("_inside", "_before")).select(*df.columns, "last_marked", "first_position")
