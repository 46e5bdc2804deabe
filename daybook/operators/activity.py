"""Activity datelists, activity bitmasks and monthly activity arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.functions.dates import as_date, hold_until_next
from daybook.functions.latest import first_row


def first_device_row(devices: DataFrame, device: str, carried: str) -> DataFrame:
    """One row per device and carried value, the smallest by all other columns."""
    others = [c for c in devices.columns if c not in (device, carried)]
    return first_row(devices, [device, carried], others or [device]).select(device, carried)


def activity_datelist(
    events: DataFrame,
    keys: list[str],
    ts: str,
    start: str | Column,
    end: str | Column,
    datelist: str = "activity_datelist",
    required: list[str] | None = None,
) -> DataFrame:
    """One row per key and day from its first activity to ``end`` with the active dates so far.

    Rows with a null in a ``required`` column are left out. Days before ``start`` are not
    shown, and activity outside the calendar is not listed.
    """
    kept = events.dropna(subset=required) if required else events
    active = kept.select(*keys, F.to_date(ts).alias("date")).where(F.col("date") <= as_date(end)).distinct()
    by_key = Window.partitionBy(*keys).orderBy("date")
    shown = F.when(F.col("date") >= as_date(start), F.col("date"))
    grown = active.withColumn(datelist, F.collect_list(shown).over(by_key))
    return hold_until_next(grown, keys, "date", as_date(end), as_date(start)).select(*keys, "date", datelist)


def device_activity(
    events: DataFrame, devices: DataFrame, user: str, device: str, carried: str, ts: str, start, end
) -> DataFrame:
    """Datelist per user, device and a device attribute such as the browser.

    Devices missing from the device table drop out, as with an inner join. The attribute is
    joined before the days are expanded, on rows already reduced to one per key and day.
    """
    kept = events.where(F.col(user).isNotNull())
    per_day = kept.groupBy(user, device, F.to_date(ts).alias("_day")).agg(F.min(ts).alias(ts)).drop("_day")
    described = per_day.join(first_device_row(devices, device, carried), device)
    return activity_datelist(described, [user, device, carried], ts, start, end, "device_activity_datelist")


def datelist_to_bitmask(
    df: DataFrame, keys: list[str], datelist: str, reference: str | Column, days: int = 32
) -> DataFrame:
    """Datelist as a number: bit ``days - 1 - age`` is set for a day that is ``age`` days old.

    Only the last ``days`` days count. ``active_days`` is the number of set bits.
    """
    ref = as_date(reference)
    age = lambda d: F.datediff(ref, d)
    recent = F.filter(F.array_distinct(F.col(datelist)), lambda d: (age(d) >= 0) & (age(d) < days))
    powers = F.array(*[F.lit(1 << (days - 1 - i)).cast("long") for i in range(days)])
    mask = F.aggregate(
        recent, F.lit(0).cast("long"), lambda acc, d: acc.bitwiseOR(F.element_at(powers, age(d) + 1))
    )
    return df.select(
        *keys, mask.alias("datelist_int"), F.bit_count(mask).cast("long").alias("active_days"),
        F.lpad(F.bin(mask), days, "0").alias("datelist_bits"),
    )


def monthly_activity_arrays(
    events: DataFrame, key: list[str], user: str, ts: str, month: str | Column
) -> DataFrame:
    """Per key one row of the month with daily hits and daily unique visitors, ordered by day.

    The arrays run from the key's first active day in the month to the month end; empty days
    count 0. Events repeated with the same user and time count once, null users never.
    """
    first = F.trunc(as_date(month), "month")
    last = F.last_day(first)
    day = F.to_date(ts)
    in_month = events.where(F.col(user).isNotNull() & (day >= first) & (day <= last))
    per_user = (
        in_month.select(*key, user, ts, day.alias("_day")).distinct()
        .groupBy(*key, "_day", user).agg(F.count(F.lit(1)).alias("_hits"))
    )
    per_day = per_user.groupBy(*key, "_day").agg(
        F.sum("_hits").alias("_hits"), F.count(F.lit(1)).alias("_visitors")
    )
    by_key = per_day.groupBy(*key).agg(
        F.min("_day").alias("_first"),
        F.map_from_entries(F.collect_list(F.struct("_day", F.struct("_hits", "_visitors")))).alias("_by_day"),
    )
    days = F.sequence(F.col("_first"), last)
    value = lambda field: F.transform(
        days, lambda d: F.coalesce(F.try_element_at("_by_day", d)[field], F.lit(0)).cast("int")
    )
    return by_key.select(
        F.date_format(first, "yyyy-MM").alias("month"), F.date_format(first, "MMM").alias("month_name"), *key,
        value("_hits").alias("hit_array"), value("_visitors").alias("unique_visitors_array"),
    )
