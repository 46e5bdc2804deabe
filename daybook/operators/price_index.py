"""Volume-weighted price index and its period report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.functions.dates import as_date, calendar_labels, season_label
from daybook.operators.prices import moving_average, period_bases, ratio_change


def yearly_volumes(trades: DataFrame) -> DataFrame:
    """Tonnes per product and year, with the five-year mean, effective on 1 October of the next year.

    ``trades``: trade_date, product, product_code, total_weight_kg.
    """
    per_year = (
        trades.where(F.col("trade_date").isNotNull())
        .groupBy(F.year("trade_date").alias("execution_year"), "product", "product_code")
        .agg(F.sum(F.col("total_weight_kg") / 1000).alias("total_volume_mt"))
        .withColumn("effective_date", F.make_date(F.col("execution_year") + 1, F.lit(10), F.lit(1)))
    )
    return moving_average(
        per_year, ["product"], "effective_date", "total_volume_mt", "five_yr_moving_avg_ex_vol_mt"
    )


def product_volumes(
    trades: DataFrame,
    prices: DataFrame,
    national: DataFrame,
    base_start: str | Column,
    last_day: str | Column,
    products: list[str] | None = None,
) -> DataFrame:
    """Grid of days and basket products with closing price, traded and national volumes.

    Volumes stand on their effective date only and are 0 on all other days. ``prices``: date,
    product_code, price_kg; ``national``: effective_date, product_code, volume.
    """
    basket = trades if products is None else trades.where(F.col("product").isin(products))
    volumes = yearly_volumes(basket)
    nat = moving_average(
        national, ["product_code"], "effective_date", "volume", "five_yr_moving_avg_nat_vol_mt"
    ).select(F.col("effective_date").alias("date"), "product_code", F.col("volume").alias("nat_vol_mt"),
             "five_yr_moving_avg_nat_vol_mt")
    grid = volumes.select("product", "product_code").distinct().withColumn(
        "date", F.explode(F.sequence(as_date(base_start), as_date(last_day)))
    )
    own = volumes.select(F.col("effective_date").alias("date"), "product_code", "product",
                         F.col("total_volume_mt").alias("ex_executed_vol_mt"), "five_yr_moving_avg_ex_vol_mt")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0)).alias(c)
    return (
        grid.join(prices.select("date", "product_code", "price_kg"), ["date", "product_code"], "left")
        .join(nat, ["date", "product_code"], "left")
        .join(own, ["date", "product_code", "product"], "left")
        .select(
            season_label(F.col("date"), None).alias("season"), "date", "product", "product_code", "price_kg",
            (F.col("price_kg") * 1000).alias("price_mt"), zero("ex_executed_vol_mt"),
            zero("five_yr_moving_avg_ex_vol_mt"), zero("nat_vol_mt"), zero("five_yr_moving_avg_nat_vol_mt"),
        )
    )


def seasonal_weights(volumes: DataFrame) -> DataFrame:
    """Weight of each product: half its share of traded and half of national volume, so far in the season.

    Season totals are summed to one row per day before the running sum, and joined back by day;
    their size is bounded by the number of days.
    """
    ex, nat = "five_yr_moving_avg_ex_vol_mt", "five_yr_moving_avg_nat_vol_mt"
    by_product = Window.partitionBy("season", "product").orderBy("date")
    by_season = Window.partitionBy("season").orderBy("date")
    totals = (
        volumes.groupBy("season", "date").agg(F.sum(ex).alias("_ex"), F.sum(nat).alias("_nat"))
        .select("date", F.sum("_ex").over(by_season).alias("season_ex_vol_mt"),
                F.sum("_nat").over(by_season).alias("season_nat_vol_mt"))
    )
    running = volumes.withColumns({
        "product_ex_vol_mt": F.sum(ex).over(by_product), "product_nat_vol_mt": F.sum(nat).over(by_product),
    })
    share = lambda part, whole: F.col(part) * 0.5 / F.nullif(F.col(whole), F.lit(0.0))
    return running.join(F.broadcast(totals), "date").withColumns({
        "exchange_weight": share("product_ex_vol_mt", "season_ex_vol_mt"),
        "national_weight": share("product_nat_vol_mt", "season_nat_vol_mt"),
    }).withColumn("product_weight", F.col("exchange_weight") + F.col("national_weight"))


def weighted_index(weights: DataFrame, base_start: str | Column, base_end: str | Column) -> DataFrame:
    """Daily index over the products priced that day, and a sub-index per product.

    Both are 100 on the first day of the base period. The daily means are one row per day and
    are joined back by day. They are sums of decimals (values to 8, weights to 12 digits), so they do not hang on the order of the rows.
    """
    priced = F.col("price_mt").isNotNull() & (F.col("price_mt") != 0)
    weight = F.when(priced, F.col("product_weight"))
    base = F.when(F.col("date").between(as_date(base_start), as_date(base_end)), "First Base Period")
    value, share = (F.col("price_mt") * weight).cast("decimal(28,8)"), weight.cast("decimal(28,12)")
    per_day = weights.groupBy("date").agg(
        (F.sum(value).cast("double") / F.nullif(F.sum(share).cast("double"), F.lit(0.0))).alias("index_price")
    )
    by_base = Window.partitionBy("_base").orderBy("date")
    daily = per_day.withColumn("_base", base).withColumn(
        "index", F.col("index_price") / F.nullif(F.first("index_price").over(by_base), F.lit(0.0)) * 100
    ).drop("_base")
    by_product = Window.partitionBy("product", "_base").orderBy("date")
    return (
        weights.withColumns({"product_weight": weight, "_base": base})
        .withColumn("sub_index", F.col("price_mt") / F.nullif(F.first("price_mt").over(by_product), F.lit(0.0)) * 100)
        .drop("_base").join(F.broadcast(daily), "date")
        .select("season", "date", "product", "product_code", "product_weight", "price_kg", "price_mt",
                "index_price", "index", "sub_index")
    )


REPORT_COLUMNS = [
    "points", "prev_day_point", "dod_change", "prev_week_point", "wow_change", "week_start", "week_end",
    "month_start", "month_end", "mtd_change", "previous_month_end", "mom_change", "quarter_start", "quarter_end",
    "qtd_change", "previous_quarter_end", "qoq_change", "season_start", "std_change", "year_start", "ytd_change",
]


def index_period_report(index: DataFrame) -> DataFrame:
    """Period bases and changes of the index ('Index') and of every product's sub-index."""
    products = index.select("date", "product_code", "product", "product_weight",
                            F.col("price_mt").alias("endofday_index_price_mt"), F.col("sub_index").alias("points"))
    whole = index.groupBy("date").agg(
        F.first("index_price").alias("endofday_index_price_mt"), F.first("index").alias("points")
    ).select("date", F.lit("Index").alias("product_code"), F.lit("Index").alias("product"),
             F.lit(None).cast("double").alias("product_weight"), "endofday_index_price_mt", "points")
    labelled = calendar_labels(products.unionByName(whole), "date", "product")
    labelled = labelled.withColumn("season", season_label(F.col("date"), None))
    based = period_bases(labelled, "product", "points").withColumnsRenamed(
        {"previous_day": "prev_day_point", "previous_week": "prev_week_point"}
    )
    against = lambda base: ratio_change(F.col("points"), F.col(base))
    changed = based.withColumns({
        "dod_change": against("prev_day_point"),
        "wow_change": against("prev_week_point"),
        "mtd_change": against("month_start"),
        "mom_change": ratio_change(F.col("month_end"), F.col("previous_month_end")),
        "qtd_change": against("quarter_start"),
        "qoq_change": ratio_change(F.col("quarter_end"), F.col("previous_quarter_end")),
        "std_change": against("season_start"),
        "ytd_change": against("year_start"),
    })
    return changed.select("date", "product_code", "product", "product_weight", "endofday_index_price_mt",
                          *REPORT_COLUMNS)
