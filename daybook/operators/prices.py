"""Market prices per product and day: closing prices, ranges and period changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.functions.dates import as_date, calendar_columns


def ratio_change(value: Column, base: Column) -> Column:
    """``value / base - 1``; null where the base is null or 0."""
    return value / F.nullif(base, F.lit(0.0)) - 1


def eod_prices(
    historical: DataFrame,
    current: DataFrame,
    metadata: DataFrame,
    first_day: str | Column,
    last_day: str | Column,
    fill: str = "previous_day",
) -> DataFrame:
    """Dense (day, product) table of closing prices from two sources.

    ``historical`` (date, product_code, product_name, price) is rescaled by 10/1000; ``current``
    (date, code, price) loses zero prices and takes its names from ``metadata`` (code,
    product_code, product_name). Where both sources price a day, the current one wins. A day
    without price takes the price of the day before (``fill="previous_day"``) or the last known
    one (``fill="forward"``).
    """
    old = historical.select(
        F.to_date("date").alias("date"), "product_code", "product_name",
        (F.col("price") * 10 / 1000).alias("price"), F.lit("historical_source").alias("price_source"),
    )
    new = (
        current.where("price != 0").withColumnRenamed("product_code", "_code")
        .join(metadata.select("code", "product_code", "product_name"), F.col("_code") == F.col("code"), "left")
        .select(F.to_date("date").alias("date"), "product_code", "product_name", "price",
                F.lit("current_source").alias("price_source"))
    )
    # one row per day and product; equal rows need no separate distinct
    ranked = F.struct("price_source", "price", "product_name")
    one = old.unionByName(new).groupBy("date", "product_code").agg(F.min(ranked).alias("_best"))
    priced = one.select("date", "product_code", "_best.*").withColumnRenamed("price", "_price")
    products = priced.select("product_code", "product_name").distinct()
    grid = products.withColumn("date", F.explode(F.sequence(as_date(first_day), as_date(last_day))))
    by_product = Window.partitionBy("product_code").orderBy("date")
    if fill == "forward":
        filled = F.last("_price", ignorenulls=True).over(by_product)
    else:
        filled = F.coalesce(F.col("_price"), F.lag("_price").over(by_product))
    joined = grid.join(priced.drop("product_name"), ["date", "product_code"], "left")
    return joined.select(
        "date", *[c.alias(n) for n, c in calendar_columns(F.col("date")).items()],
        "product_code", "product_name", filled.alias("product_eod_price"), "price_source",
    )


def daily_price_range(eod: DataFrame, trades: DataFrame, since: str | Column | None = None) -> DataFrame:
    """Closing, opening, highest and lowest price per product and day.

    ``trades`` (date, product, price, volume_per_unit) are the purchases of the wanted source.
    A day without trades takes the higher and the lower of closing and opening price.
    """
    by_product = Window.partitionBy("product_code").orderBy("date")
    days = eod if since is None else eod.where(F.col("date") >= as_date(since))
    prices = days.select(
        "date", "day_of_month", "day_of_quarter", "day_of_year", "product_code",
        F.col("product_name").alias("product"), F.col("product_eod_price").alias("eod_price"),
        F.lag("product_eod_price").over(by_product).alias("sod_price"),
    )
    per_kg = F.col("price") / F.nullif(F.col("volume_per_unit"), F.lit(0.0))
    ranges = trades.groupBy(F.to_date("date").alias("date"), "product").agg(
        F.max(per_kg).alias("max_price_kg"), F.min(per_kg).alias("min_price_kg")
    )
    eod_p, sod_p = F.col("eod_price"), F.col("sod_price")
    known = eod_p.isNotNull() & sod_p.isNotNull()
    return prices.join(ranges, ["date", "product"], "left").withColumns({
        "max_price_kg": F.coalesce("max_price_kg", F.when(known, F.greatest(eod_p, sod_p))),
        "min_price_kg": F.coalesce("min_price_kg", F.when(known, F.least(eod_p, sod_p))),
    })


def period_bases(df: DataFrame, key: str, value: str, prefix: str = "") -> DataFrame:
    """First, last and previous values of ``value`` in the day's week, month, quarter, season and year.

    Needs the columns of ``calendar_labels``. All windows are partitioned at least by the key,
    so one shuffle by key serves them all; a partition holds one series of days.
    """
    v = F.col(value)
    day = Window.partitionBy(key).orderBy("date")

    def period(label: str | Column):
        ordered = Window.partitionBy(key, label).orderBy("date")
        return ordered, ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)

    week, whole_week = period("adj_woy")
    month, whole_month = period("month_identifier")
    quarter, whole_quarter = period("quarter")
    season, _ = period("season")
    year, _ = period(F.year("date"))
    p = prefix
    out = df.withColumns({
        f"{p}previous_day": F.lag(v, 1).over(day),
        f"{p}previous_week": F.lag(v, 7).over(day),
        f"{p}week_start": F.first(v).over(week),
        f"{p}week_end": F.last(v).over(whole_week),
        f"{p}month_start": F.first(v).over(month),
        f"{p}month_end": F.last(v).over(whole_month),
        f"{p}quarter_start": F.first(v).over(quarter),
        f"{p}quarter_end": F.last(v).over(whole_quarter),
        f"{p}season_start": F.first(v).over(season),
        f"{p}year_start": F.first(v).over(year),
    })
    out = out.withColumns({
        f"{p}_last_month_end": F.lag(f"{p}month_end").over(day),
        f"{p}_last_quarter_end": F.lag(f"{p}quarter_end").over(day),
    })
    return out.withColumns({
        f"{p}previous_month_end": F.first(f"{p}_last_month_end").over(month),
        f"{p}previous_quarter_end": F.first(f"{p}_last_quarter_end").over(quarter),
    }).drop(f"{p}_last_month_end", f"{p}_last_quarter_end")


def price_changes(labelled: DataFrame, key: str = "product") -> DataFrame:
    """Day, week, month, quarter, season and year changes of the closing price.

    ``labelled`` is the daily price range with ``calendar_labels``. A season or year whose
    first day has no price starts at its first priced day.
    """
    based = period_bases(labelled, key, "eod_price")
    same_month_day = Window.partitionBy(key, "day_of_month").orderBy("date")
    same_quarter_day = Window.partitionBy(key, "day_of_quarter").orderBy("date")
    whole = lambda label: Window.partitionBy(key, label).orderBy("date").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    price = F.col("eod_price")

    def first_priced(column: str, label) -> Column:
        start = F.first("eod_price", ignorenulls=True).over(whole(label))
        return F.when(F.col(column).isNull() & price.isNotNull(), start).otherwise(F.col(column))

    based = based.withColumns({
        "previous_month_price": F.lag("eod_price").over(same_month_day),
        "previous_quarter_price": F.lag("eod_price").over(same_quarter_day),
        "season_start": first_priced("season_start", "season"),
        "year_start": first_priced("year_start", F.year("date")),
    })
    renamed = based.withColumnsRenamed({
        c: f"{c}_price" for c in (
            "previous_day", "previous_week", "week_start", "week_end", "month_start", "month_end",
            "quarter_start", "quarter_end", "season_start", "year_start", "previous_month_end",
            "previous_quarter_end",
        )
    })
    against = lambda base: ratio_change(price, F.col(base))
    return renamed.withColumns({
        "dod_price_diff": price - F.col("sod_price"),
        "dod_price_change": against("sod_price"),
        "wtd_price_change": against("week_start_price"),
        "wow_price_change": against("previous_week_price"),
        "mtd_price_change": against("month_start_price"),
        "mom_price_change": against("previous_month_price"),
        "month_end_price_change": ratio_change(F.col("month_end_price"), F.col("previous_month_end_price")),
        "qtd_price_change": against("quarter_start_price"),
        "qoq_price_change": against("previous_quarter_price"),
        "quarter_end_price_change": ratio_change(F.col("quarter_end_price"), F.col("previous_quarter_end_price")),
        "std_price_change": against("season_start_price"),
        "ytd_price_change": against("year_start_price"),
    })


def moving_average(df: DataFrame, keys: list[str], order: str, value: str, name: str, rows: int = 5) -> DataFrame:
    """Mean of the last ``rows`` rows of the key. ``df`` has one row per key and period."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(-(rows - 1), Window.currentRow)
    return df.withColumn(name, F.avg(value).over(w))


