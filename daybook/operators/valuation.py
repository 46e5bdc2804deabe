"""Price models from executed and open trades, adjusted for the cost of transport."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.functions.dates import as_date, fill_calendar, trading_date
from daybook.functions.recurrence import BLOCK, chained, last_before
from daybook.functions.skew import with_group_stats

# fixed values: market code prefix (upper case) and its weight
MARKET_WEIGHTS = {"FO": 0.05, "FU": 0.10, "INV": 0.10, "OP": 0.75}

BAND_TOLERANCE = 1e-9


def classify(code: Column, classes: dict[str, str]) -> Column:
    """The class whose marker occurs in the code, else the code itself."""
    chain = reduce(lambda acc, kv: acc.when(code.contains(kv[0]), kv[1]), classes.items(), F.when(F.lit(False), ""))
    return chain.otherwise(code)


def with_transport_cost(df: DataFrame, transport: DataFrame, product: str, destination: str, price: str) -> DataFrame:
    """Add the cost per kg for (product, destination) and the price adjusted by it (no entry: 0)."""
    costs = transport.select(
        F.col("product_label").alias("_product"), F.col("destination_region").alias("_destination"),
        "cost_adjustment_per_kg",
    )
    on = (F.col(product) == F.col("_product")) & (F.col(destination) == F.col("_destination"))
    joined = df.join(costs, on, "left").drop("_product", "_destination")
    adjusted = F.col(price) + F.coalesce("cost_adjustment_per_kg", F.lit(0.0))
    return joined.withColumn("adjusted_price", adjusted)


def within_band(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Rows whose value lies within mean +- sample sd of their group, ends included.

    A group of one row has sd 0 and stays. The ends are widened by a relative 1e-9 so that a
    value equal to an end does not hang on the order of summation.
    """
    stats = {"avg_price_per_kg": F.avg(value), "std_dev_price_per_kg": F.coalesce(F.stddev_samp(value), F.lit(0.0))}
    banded = with_group_stats(df, keys, stats).withColumns({
        "lower_band": F.col("avg_price_per_kg") - F.col("std_dev_price_per_kg"),
        "upper_band": F.col("avg_price_per_kg") + F.col("std_dev_price_per_kg"),
    })
    slack = F.abs("avg_price_per_kg") * BAND_TOLERANCE
    return banded.where(F.col(value).between(F.col("lower_band") - slack, F.col("upper_band") + slack))


def inventory_receipts(inventory: DataFrame, stores: DataFrame, classes: dict[str, str], prefix: str = "INV") -> DataFrame:
    """Store receipts as market rows: market code from the item, product class from its code.

    ``inventory``: entry_date, item_id, item_label, total_weight, price_per_ton, receipt_id,
    storage_id. Only items that contain one of the class markers take part.
    """
    known = reduce(lambda a, b: a | b, [F.col("item_id").contains(marker) for marker in classes])
    regions = stores.select(F.col("storage_id").alias("_storage"), F.col("region").alias("final_destination"))
    return (
        inventory.where(known)
        .join(regions, F.col("storage_id") == F.col("_storage"), "left")
        .select(
            F.to_date("entry_date").alias("record_date"),
            classify(F.col("item_id"), classes).alias("grouped_product_name"), "item_label", "item_id",
            F.concat(F.lit(prefix), F.col("item_id")).alias("market_code"), F.lit("Store Receipt").alias("asset_type"),
            F.col("receipt_id").alias("record_id"), F.col("total_weight").alias("volume_kg"),
            (F.col("price_per_ton") / 1000).alias("price_per_kg"), "final_destination",
        )
    )


def executed_trades(trades: DataFrame) -> DataFrame:
    """Distinct matched trades as market rows, with price per kg and volume in kg."""
    per_unit = F.nullif(F.col("computed_weight_per_unit"), F.lit(0.0))
    return trades.where(F.col("transaction_id").isNotNull()).select(
        F.col("adjusted_deal_time").alias("record_date"), "grouped_product_name",
        F.col("product_name").alias("item_label"), F.col("product_code").alias("item_id"),
        F.col("asset_code").alias("market_code"), "asset_type", F.col("transaction_id").alias("record_id"),
        (F.col("transaction_units") * F.col("computed_weight_per_unit")).alias("volume_kg"),
        (F.col("transaction_price") / per_unit).alias("price_per_kg"),
        F.coalesce("buyer_region_code", "asset_location").alias("final_destination"),
    )


def normalized_executed_prices(
    trades: DataFrame, inventory: DataFrame, stores: DataFrame, transport: DataFrame, classes: dict[str, str]
) -> DataFrame:
    """Executed trades and store receipts with adjusted prices, outliers per market and day removed."""
    rows = executed_trades(trades).unionByName(inventory_receipts(inventory, stores, classes)).distinct()
    adjusted = with_transport_cost(rows, transport, "grouped_product_name", "final_destination", "price_per_kg")
    valued = adjusted.withColumn("adjusted_value", F.col("volume_kg") * F.col("adjusted_price"))
    return within_band(valued, ["market_code", "record_date"], "adjusted_price")


def normalized_open_orders(
    trades: DataFrame, transport: DataFrame, timezone: str = "Africa/Lagos", cutoff_hour: int = 15
) -> DataFrame:
    """Distinct unmatched orders with trading date and adjusted price, outliers removed."""
    orders = trades.where(F.col("transaction_id").isNull()).select(
        "record_id", "trade_timestamp",
        trading_date(F.col("trade_timestamp"), timezone, cutoff_hour).alias("adjusted_trade_time"),
        "transaction_type", F.col("requested_price").alias("requested_price_per_unit"), "requested_units",
        (F.col("requested_price") / F.nullif(F.col("weight_per_unit"), F.lit(0.0))).alias("requested_price_per_kg"),
        (F.col("requested_units") * F.col("weight_per_unit")).alias("requested_volume_kg"),
        "asset_type", "asset_code", "product_code", "product_name", "grouped_product_name",
        F.coalesce("buyer_region_code", "asset_location").alias("destination_location"),
    ).distinct()
    adjusted = with_transport_cost(
        orders, transport, "grouped_product_name", "destination_location", "requested_price_per_kg"
    ).withColumnRenamed("adjusted_price", "adjusted_order_price")
    valued = adjusted.withColumn("adjusted_order_value", F.col("requested_volume_kg") * F.col("adjusted_order_price"))
    return within_band(valued, ["transaction_type", "asset_code", "adjusted_trade_time"], "adjusted_order_price")


def market_weight(code: Column, weights: dict[str, float] | None = None) -> Column:
    """Fixed weight by the prefix of the market code, upper and lower case alike."""
    table = MARKET_WEIGHTS if weights is None else weights
    upper = F.upper(code)
    return reduce(lambda acc, kv: acc.when(upper.startswith(kv[0]), kv[1]), table.items(), F.when(F.lit(False), 0.0))


def mean_market_prices(
    executed: DataFrame,
    open_orders: DataFrame,
    first_day: str | Column,
    last_day: str | Column,
    sell: str = "Vend",
    buy: str = "Purchase",
    weights: dict[str, float] | None = None,
) -> DataFrame:
    """Price per market and day: the volume-weighted executed price, else the open-order mid-point.

    The mid-point of best (lowest) sell and best (highest) buy needs both sides; 0 counts as
    no price. One row per market of the executed trades and day of the calendar.
    """
    markets = ["grouped_product_name", "product", "product_code", "market_code"]
    named = executed.withColumnsRenamed({"item_label": "product", "item_id": "product_code"})
    traded = named.groupBy(*markets, F.col("record_date").alias("date")).agg(
        F.sum("adjusted_value").alias("_value"), F.sum("volume_kg").alias("_volume")
    )
    # value and volume belong to the market as a whole, even if its rows carry several labels
    by_market = Window.partitionBy("market_code", "date")
    traded = traded.select(
        *markets, "date", F.sum("_value").over(by_market).alias("market_value"),
        F.sum("_volume").over(by_market).alias("market_volume"),
    )
    filled = fill_calendar(traded, markets, "date", as_date(first_day), as_date(last_day), ["market_value", "market_volume"])
    sells, buys = F.col("transaction_type") == sell, F.col("transaction_type") == buy
    price, volume = F.col("adjusted_order_price"), F.col("requested_volume_kg")
    both = open_orders.groupBy(F.col("asset_code").alias("market_code"), F.col("adjusted_trade_time").alias("date")).agg(
        F.max(F.when(buys, price)).alias("best_buy"), F.min(F.when(sells, price)).alias("best_sell"),
        F.sum(F.when(buys, volume)).alias("_buy"), F.sum(F.when(sells, volume)).alias("_sell"),
    ).where("best_buy IS NOT NULL AND best_sell IS NOT NULL")
    total = F.when(F.col("_buy").isNull() | F.col("_sell").isNull(),
                   F.coalesce("_buy", F.lit(0.0)) + F.coalesce("_sell", F.lit(0.0))).otherwise(
                       (F.col("_buy") + F.col("_sell")) / 2)
    mid = both.select(
        "market_code", "date", "best_buy", "best_sell",
        F.nullif((F.col("best_buy") + F.col("best_sell")) / 2, F.lit(0.0)).alias("mean_open_price"),
        F.nullif(total, F.lit(0.0)).alias("total_market_order_volume"),
    )
    return (
        filled.withColumn("market_price", F.col("market_value") / F.nullif(F.col("market_volume"), F.lit(0.0)))
        .join(mid, ["market_code", "date"], "left")
        .withColumns({
            "final_market_price": F.coalesce("market_price", "mean_open_price"),
            "final_market_volume": F.coalesce("market_volume", "total_market_order_volume"),
            "fixed_market_weight": market_weight(F.col("market_code"), weights),
        })
    )


def closing_price_chain(
    market_prices: DataFrame,
    start_prices: DataFrame | None = None,
    max_stale: int = 5,
    anchor_normalised: bool = True,
    block: int = BLOCK,
) -> DataFrame:
    """Closing price per product and day, chained over days without trade.

    A market with a price counts with it; one without price for at most ``max_stale`` days
    counts with yesterday's product price; after that its weight is 0. So each day is
    ``P = fixed + carried * P_yesterday`` with both parts summed per product and day, and these steps
    are composed in blocks of ``block`` days. ``start_prices`` (product_code, price)
    replace a missing market price on the first day. With ``anchor_normalised=False`` the first
    day is the plain weighted sum, not divided by the weights.
    """
    rows = market_prices.select(F.unix_date("date").alias("day"), "product_code", "market_code", "market_price", "final_market_price",
                                F.col("fixed_market_weight").alias("w"))
    rows = last_before(rows, ["product_code", "market_code"], "day", F.col("final_market_price").isNotNull(), block)
    rows = rows.withColumn("stale", F.coalesce(
        F.col("day") - F.col("last_marked"), F.col("day") - F.col("first_position") + 1
    )).withColumn("is_first", F.col("day") == F.col("first_position"))
    if start_prices is not None:
        start = start_prices.select(F.col("product_code").alias("_pc"), F.col("price").alias("_start"))
        rows = rows.join(start, F.col("product_code") == F.col("_pc"), "left").drop("_pc")
    else:
        rows = rows.withColumn("_start", F.lit(None).cast("double"))
    use_start = F.col("is_first") & F.col("market_price").isNull() & F.col("_start").isNotNull()
    rows = rows.withColumn("own", F.when(use_start, F.col("_start")).otherwise(F.col("final_market_price")))
    idle = ~F.col("is_first") & F.col("own").isNull()
    dead, carried = idle & (F.col("stale") > max_stale), idle & (F.col("stale") <= max_stale)
    weights = F.sum(F.when(dead, 0.0).otherwise(F.col("w")))
    per_day = rows.groupBy("product_code", "day").agg(
        F.sum(F.col("own") * F.col("w")).alias("own"),
        F.sum(F.when(carried, F.col("w"))).alias("carried"),
        F.max(dead).alias("dead"),
        F.when(F.coalesce(weights, F.lit(0.0)) == 0, 1.0).otherwise(weights).alias("total"),
        F.max("is_first").alias("is_first"),
    )
    divisor = F.col("total") if anchor_normalised else F.when(F.col("is_first"), 1.0).otherwise(F.col("total"))
    fixed, factor = F.coalesce("own", F.lit(0.0)) / divisor, F.coalesce("carried", F.lit(0.0)) / divisor
    # a day has a price if a market is priced or lapsed, or yesterday has one that a market carries on
    known = F.col("own").isNotNull() | F.col("dead")
    steps = per_day.select(
        "product_code", "day", F.when(known, fixed).alias("start"), F.when(known | F.col("carried").isNotNull(), fixed).alias("add"), factor.alias("factor")
    )
    priced = chained(steps, ["product_code"], "day", block)
    return priced.select(F.date_from_unix_date("day").alias("date"), "product_code", F.col("value").alias("product_acp"))


def asset_prices(
    product_price: DataFrame,
    assets: DataFrame,
    geo: DataFrame,
    transport: DataFrame,
    classes: dict[str, str],
    first_day: str | Column,
    last_day: str | Column,
    placeless: str = "Options",
) -> DataFrame:
    """Price of every asset and day: its product's closing price less the cost to its state.

    ``assets``: asset_code, asset_type, location. The product code is the asset code without
    its first letter; assets of type ``placeless`` have location ``n/a``.
    """
    known = reduce(lambda a, b: a | b, [F.col("asset_code").contains(marker) for marker in classes])
    located = assets.where(known).select(
        "asset_code", F.substring("asset_code", 2, 1_000_000).alias("product_code"),
        F.when(F.col("asset_type") == placeless, "n/a").otherwise(F.col("location")).alias("location"),
        classify(F.col("asset_code"), classes).alias("consolidated_product_name"),
    ).distinct()
    states = geo.select(F.col("name").alias("_place"), "state")
    costs = transport.select(F.col("product_label").alias("_product"), F.col("destination_region").alias("_state"),
                             "cost_adjustment_per_kg")
    described = (
        located.join(states, F.col("location") == F.col("_place"), "left")
        .join(costs, (F.col("consolidated_product_name") == F.col("_product")) & (F.col("state") == F.col("_state")), "left")
        .withColumn("logistics_differential", F.coalesce("cost_adjustment_per_kg", F.lit(0.0)))
        .select("asset_code", "product_code", "location", "consolidated_product_name", "state", "logistics_differential")
    )
    days = F.explode(F.sequence(as_date(first_day), as_date(last_day)))
    return (
        described.withColumn("date", days)
        .join(product_price.select("date", "product_code", "product_acp"), ["date", "product_code"], "left")
        .withColumn("asset_acp", F.col("product_acp") - F.col("logistics_differential"))
    )
