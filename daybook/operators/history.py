"""Cumulative tables per period and slowly changing (type 2) histories."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# fixed values: class names and the rating each must exceed
QUALITY_CLASSES = [("Star", 8), ("Good", 7), ("Average", 6)]
LOWEST_CLASS = "Bad"


def quality_class(rating: Column) -> Column:
    """Class of a rating; an unknown rating falls into the lowest class."""
    chain = reduce(lambda acc, c: acc.when(rating > c[1], c[0]), QUALITY_CLASSES[1:],
                   F.when(rating > QUALITY_CLASSES[0][1], QUALITY_CLASSES[0][0]))
    return chain.otherwise(LOWEST_CLASS)


def period_summary(
    events: DataFrame, entity: list[str], period: str, rating: str, last_period: int | Column
) -> DataFrame:
    """One row per entity and period from its first period to ``last_period``.

    ``latest_rating`` is the mean rating of the period (one decimal) or the last known one;
    the class follows from it. Only pre-aggregated rows reach the window.
    """
    last = last_period if isinstance(last_period, Column) else F.lit(last_period)
    per_period = (
        events.where((F.col(period) <= last))
        .groupBy(*entity, period)
        .agg(
            F.count(F.lit(1)).alias("_events"),
            F.round(F.avg(F.col(rating).cast("decimal(18,4)")), 1).cast("double").alias("avg_rating"),
        )
    )
    by_entity = Window.partitionBy(*entity).orderBy(period)
    held = per_period.withColumn("_next", F.lead(period).over(by_entity)).withColumn(
        "latest_rating", F.last("avg_rating", ignorenulls=True).over(by_entity)
    )
    return (
        held.withColumn("_active", F.col(period))
        .withColumn(period, F.explode(F.sequence(F.col("_active"), F.coalesce(F.col("_next") - 1, last))))
        .withColumn("quality_class", quality_class(F.col("latest_rating")))
        .withColumn("years_since_last_active", F.col(period) - F.col("_active"))
        .withColumn("is_active", F.col("years_since_last_active") == 0)
        .select(*entity, period, "latest_rating", "quality_class", "years_since_last_active", "is_active")
    )


def cumulative_history(
    events: DataFrame,
    entity: list[str],
    period: str,
    event_columns: list[str],
    event_id: str,
    rating: str,
    last_period: int,
    array_name: str = "films",
) -> DataFrame:
    """Cumulative table: per entity and period the array of all events so far, class and activity.

    The array is ordered by period and event id. The grain never depends on size: an entity has one row per
    period. A row holds all events of its entity, so an entity whose events exceed the size of one row (2 GB)
    is an error of the engine, not cut; keep such histories as events.
    """
    events = events.where(F.col(period) <= last_period)
    element = F.struct(period, event_id, *[c for c in event_columns if c not in (period, event_id)])
    per_period = events.groupBy(*entity, period).agg(F.array_sort(F.collect_list(element)).alias("_added"))
    by_entity = Window.partitionBy(*entity).orderBy(period)
    grown = per_period.withColumn("_next", F.lead(period).over(by_entity)).withColumn(
        array_name, F.flatten(F.collect_list("_added").over(by_entity))
    )
    dense = grown.withColumn(
        period, F.explode(F.sequence(F.col(period), F.coalesce(F.col("_next") - 1, F.lit(last_period))))
    ).drop("_next", "_added")
    summary = period_summary(events, entity, period, rating, last_period)
    ordered = F.transform(F.col(array_name), lambda x: F.struct(*[x[c].alias(c) for c in event_columns]))
    return (
        dense.join(summary, [*entity, period])
        .withColumn(array_name, ordered)
        .select(*entity, array_name, "quality_class", period, "years_since_last_active", "is_active")
    )


def scd2_backfill(
    df: DataFrame, key: list[str], period: str, tracked: list[str], upto: int, carried: list[str] | None = None
) -> DataFrame:
    """One row per unbroken streak of equal tracked values, with its first and last period.

    ``df`` has one row per key and period. The first row of a key is no change; a change to or
    from null counts as a change.
    """
    by_key = Window.partitionBy(*key).orderBy(period)
    first = F.row_number().over(by_key) == 1
    differs = [~F.col(c).eqNullSafe(F.lag(c).over(by_key)) for c in tracked]
    changed = F.when(~first & reduce(lambda a, b: a | b, differs), 1).otherwise(0)
    streaks = (
        df.where(F.col(period) <= upto)
        .withColumn("_changed", changed)
        .withColumn("streak_identifier", F.sum("_changed").over(by_key))
    )
    return (
        streaks.groupBy(*key, *(carried or []), "streak_identifier", *tracked)
        .agg(F.min(period).alias("start_date"), F.max(period).alias("end_date"))
        .withColumn("current_year", F.lit(upto))
    )


def scd2_incremental(
    history: DataFrame, current: DataFrame, key: list[str], period: str, tracked: list[str], upto: int,
    carried: list[str] | None = None,
) -> DataFrame:
    """History through ``upto`` from the history through ``upto - 1`` and the rows of ``upto``.

    Open streaks are extended when nothing tracked changed; on a change the old streak stays
    closed and a new one opens; new keys open streak 0. Keys without a row keep their history.
    ``carried`` columns, such as a name, stay with their streak; a new streak takes them from the row that opens it.
    The columns are those of the backfill.
    """
    carried = carried or []
    last = upto - 1
    previous = history.where((F.col("current_year") == last) & (F.col("end_date") <= last))
    is_open = F.col("end_date") == last
    closed = previous.where(~is_open)
    now = current.where(F.col(period) == upto).select(
        *[F.col(k).alias(f"_k_{k}") for k in key], *[F.col(c).alias(f"_n_{c}") for c in [*carried, *tracked]],
        F.lit(True).alias("_present"),
    )
    same_key = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in key]
    merged = previous.where(is_open).join(now, same_key, "full_outer")
    old_key = F.coalesce(F.col("start_date").isNotNull(), F.lit(False))
    equal = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_n_{c}")) for c in tracked])
    present = F.coalesce(F.col("_present"), F.lit(False))

    keys = [F.coalesce(F.col(k), F.col(f"_k_{k}")).alias(k) for k in key]
    fields = [*carried, "streak_identifier", *tracked, "start_date", "end_date"]
    kinds = {f.name: f.dataType for f in history.schema.fields}

    def row(values: dict[str, Column]) -> Column:
        return F.struct(*[values[f].cast(kinds[f]).alias(f) for f in fields])

    old = {f: F.col(f) for f in fields}
    extended = row({**old, "end_date": F.lit(upto)})
    opened = row({
        **{c: F.col(f"_n_{c}") for c in [*carried, *tracked]},
        "streak_identifier": F.coalesce(F.col("streak_identifier") + 1, F.lit(0)),
        "start_date": F.lit(upto),
        "end_date": F.lit(upto),
    })
    rows = (
        F.when(old_key & ~present, F.array(row(old)))
        .when(old_key & equal, F.array(extended))
        .when(old_key, F.array(row(old), opened))
        .otherwise(F.array(opened))
    )
    updated = merged.select(*keys, F.explode(rows).alias("_r")).select(*key, "_r.*")
    kept = closed.select(*key, *fields)
    return kept.unionByName(updated).withColumn("current_year", F.lit(upto))
