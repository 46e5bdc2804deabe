"""Dense daily balances from an event log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.functions.dates import as_date, hold_until_next
from daybook.functions.latest import first_row, latest_row
from daybook.functions.skew import spread


def keep_statuses(events: DataFrame, status: str | None, excluded: list[str]) -> DataFrame:
    """Drop rows whose status is excluded (a null status is dropped too, as ``NOT IN`` does)."""
    if status is None or not excluded:
        return events
    return events.where(~F.col(status).isin(excluded))


def last_event_per_day(
    events: DataFrame,
    keys: list[str],
    ts: str,
    tiebreak: list[str] | None = None,
    status: str | None = None,
    excluded: list[str] | None = None,
) -> DataFrame:
    """The last event of each key on each calendar day, with the day in column ``day``."""
    kept = keep_statuses(events, status, excluded or []).withColumn("day", F.to_date(ts))
    return latest_row(kept, [*keys, "day"], [ts, *(tiebreak or [])])


def first_event_per_day(
    events: DataFrame, keys: list[str], ts: str, tiebreak: list[str] | None = None
) -> DataFrame:
    """The first event of each key on each calendar day, with the day in column ``day``."""
    return first_row(events.withColumn("day", F.to_date(ts)), [*keys, "day"], [ts, *(tiebreak or [])])


def daily_balance(
    events: DataFrame,
    keys: list[str],
    ts: str,
    values: dict[str, str],
    through: str | Column,
    start: str | Column | None = None,
    tiebreak: list[str] | None = None,
    status: str | None = None,
    excluded: list[str] | None = None,
) -> DataFrame:
    """One row per key and day from its first event through ``through``.

    ``values`` maps output columns to event columns; the last known value is carried over days
    without events. ``start`` cuts the calendar, not the events: an earlier event still gives
    the balance of the first days. ``latest_trans_at`` is the time of the event that set it.
    """
    columns = [F.col(src).alias(out) for out, src in values.items()]
    narrow = keep_statuses(events, status, excluded or []).select(
        *keys, F.col(ts).alias("latest_trans_at"), *columns,
        *[F.col(t).alias(f"_t{i}") for i, t in enumerate(tiebreak or [])],
        F.to_date(ts).alias("date"),
    )
    ties = [f"_t{i}" for i in range(len(tiebreak or []))]
    daily = latest_row(narrow, [*keys, "date"], ["latest_trans_at", *ties]).drop(*ties)
    first = None if start is None else as_date(start)
    dense = hold_until_next(daily, keys, "date", as_date(through), first)
    return dense.select("date", *keys, *values, "latest_trans_at")


def daily_balance_incremental(
    events: DataFrame,
    keys: list[str],
    ts: str,
    values: dict[str, str],
    as_of: str | Column,
    tiebreak: list[str] | None = None,
    status: str | None = None,
    excluded: list[str] | None = None,
) -> DataFrame:
    """The latest balance of every key, stamped with the day before ``as_of``."""
    columns = [F.col(src).alias(out) for out, src in values.items()]
    narrow = keep_statuses(events, status, excluded or []).select(
        *keys, F.col(ts).alias("latest_trans_at"), *columns,
        *[F.col(t).alias(f"_t{i}") for i, t in enumerate(tiebreak or [])],
    )
    ties = [f"_t{i}" for i in range(len(tiebreak or []))]
    latest = latest_row(narrow, keys, ["latest_trans_at", *ties])
    stamped = latest.withColumn("date", F.date_sub(as_date(as_of), 1))
    return stamped.select("date", *keys, *values, "latest_trans_at")


def balance_as_of(
    events: DataFrame,
    keys: list[str],
    ts: str,
    values: dict[str, str],
    day: str | Column,
    tiebreak: list[str] | None = None,
    status: str | None = None,
    excluded: list[str] | None = None,
) -> DataFrame:
    """Last known values of every key at the end of ``day``; keys without events are absent."""
    past = events.where(F.col(ts) < F.date_add(as_date(day), 1).cast("timestamp"))
    latest = daily_balance_incremental(
        past, keys, ts, values, F.date_add(as_date(day), 1), tiebreak, status, excluded
    )
    return latest


def balance_from_snapshots(snapshots: DataFrame, day: str | Column, date_col: str = "date") -> DataFrame:
    """Rows of one day of a snapshot table; on a date-partitioned table only that folder is read."""
    return snapshots.where(F.col(date_col) == as_date(day))


def balances_as_of(
    events: DataFrame,
    probes: DataFrame,
    keys: list[str],
    ts: str,
    values: dict[str, str],
    day: str = "date",
    tiebreak: list[str] | None = None,
    status: str | None = None,
    excluded: list[str] | None = None,
) -> DataFrame:
    """Last known values at the end of each day asked for: any number of (key, ``day``) rows in ``probes``, in one pass over the events.

    Events are reduced to the last of each key and day inside the tasks that read them, probes to distinct ones; then both lie in one order per key,
    of at most two rows for a day and spread over tasks by key, and each probe takes the last event before it. Probes before the first event of their key are absent. Keys
    are compared null-safe.
    """
    ties = [f"_t{i}" for i in range(len(tiebreak or []))]
    narrow = keep_statuses(events, status, excluded or []).select(
        *keys, F.to_date(ts).alias("_day"), F.col(ts).alias("latest_trans_at"), *[F.col(src).alias(out) for out, src in values.items()],
        *[F.col(t).alias(name) for t, name in zip(tiebreak or [], ties)],
    )
    daily = latest_row(narrow, [*keys, "_day"], ["latest_trans_at", *ties])
    known = daily.select(*keys, "_day", F.lit(False).alias("_asked"), F.struct(*values, "latest_trans_at").alias("_last"))
    kind = known.schema["_last"].dataType
    asked = probes.select(*keys, F.to_date(day).alias("_day")).distinct()
    both = known.unionByName(asked.withColumns({"_asked": F.lit(True), "_last": F.lit(None).cast(kind)}))
    in_order = Window.partitionBy(*keys).orderBy("_day", "_asked").rowsBetween(Window.unboundedPreceding, 0)
    found = spread(both, keys).withColumn("_last", F.last("_last", ignorenulls=True).over(in_order))
    return found.where("_asked and _last is not null").select(F.col("_day").alias("date"), *keys, "_last.*")
