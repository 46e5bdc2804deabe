"""Price model: line items are trades, receipts and open orders; part types are products."""

from __future__ import annotations

from pyspark.sql import functions as F

from daybook.operators import valuation
from daybook.plans.registry import Tables, day_text, per_month, query, rounded, rounded_price, rounded_price_sql
from daybook.session import fresh_path

FIRST, LAST = "1995-01-01", "2001-12-31"

# fixed values: marker in a code and the product class
CLASSES = {
    "LARGE": "Large goods", "ECONOMY": "Economy goods", "SMALL": "Small goods", "MEDIUM": "Medium goods",
    "STANDARD": "Standard goods", "PROMO": "Promo goods",
}
SECONDS_IN_DAY = 86400

LINE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus", "l_shipdate", "p_type",
        "n_nationkey", "n_name"]


def placed_lines(t: Tables):
    """Line items with product type and supplier place, joined once and written: trades, receipts and costs of a query all read them."""
    if "_placed_lines" not in vars(t):
        line = t.lineitem.join(t.part.select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey")).join(
            t.supplier.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey")
        ).join(t.nation.select("n_nationkey", "n_name"), F.col("s_nationkey") == F.col("n_nationkey")).select(*LINE)
        path = fresh_path(t.spark, "placed-lines")
        line.write.parquet(path)
        t._placed_lines = t.spark.read.schema(line.schema).parquet(path)
    return t._placed_lines


def lines(t: Tables):
    """Line items with product type, supplier place and a row id of all their columns."""
    record = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").cast("int"))
    kind = F.element_at(F.array(*map(F.lit, ["Options", "Futures", "Forward"])), (F.col("l_linenumber") % 3 + 1).cast("int"))
    return placed_lines(t).withColumns({"record": record, "kind": kind})


def trades(t: Tables):
    """Returned lines above number 3 are open orders, unreturned lines are matched trades."""
    line = lines(t).where((F.col("l_returnflag") != "R") | (F.col("l_linenumber") > 3))
    matched = F.col("l_returnflag") != "R"
    label = F.concat(F.initcap("p_type"), F.lit(" goods"))
    asset = F.concat(F.substring("kind", 1, 2), F.col("p_type"))
    hour = F.make_dt_interval(F.lit(0), (F.col("l_orderkey") % 24).cast("int"))
    return line.select(
        F.when(matched, F.col("record")).alias("transaction_id"), F.to_date("l_shipdate").alias("adjusted_deal_time"),
        F.col("l_extendedprice").alias("transaction_price"), F.lit(1.0).alias("transaction_units"),
        F.col("l_quantity").alias("computed_weight_per_unit"), F.col("kind").alias("asset_type"),
        asset.alias("asset_code"), F.col("p_type").alias("product_code"), label.alias("product_name"),
        label.alias("grouped_product_name"), F.col("n_name").alias("asset_location"),
        F.when(F.col("l_linestatus") == "O", F.col("n_name")).alias("buyer_region_code"),
        F.col("record").alias("record_id"), (F.col("l_shipdate") + hour).alias("trade_timestamp"),
        F.when(F.col("l_linestatus") == "O", "Vend").otherwise("Purchase").alias("transaction_type"),
        F.col("l_extendedprice").alias("requested_price"), F.lit(1.0).alias("requested_units"),
        F.col("l_quantity").alias("weight_per_unit"),
    )


def inventory(t: Tables):
    """Returned lines with number 1 to 3 are store receipts, priced per 1,000."""
    return lines(t).where((F.col("l_returnflag") == "R") & (F.col("l_linenumber") <= 3)).select(
        F.col("l_shipdate").alias("entry_date"), F.col("p_type").alias("item_id"),
        F.concat(F.initcap("p_type"), F.lit(" goods")).alias("item_label"), F.col("l_quantity").alias("total_weight"),
        (F.col("l_extendedprice") * 1000 / F.col("l_quantity")).alias("price_per_ton"),
        F.col("record").alias("receipt_id"), F.col("l_suppkey").alias("storage_id"),
    )


def stores(t: Tables):
    return t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("storage_id"), F.col("n_name").alias("region")
    )


def transport(t: Tables):
    """Cost per product label and nation seen in the parts and lines; every sixth nation has none."""
    seen = lines(t).select("p_type", "n_nationkey", "n_name").distinct()
    return seen.where(F.col("n_nationkey") % 6 != 0).select(
        F.concat(F.initcap("p_type"), F.lit(" goods")).alias("product_label"), F.col("n_name").alias("destination_region"),
        ((F.col("n_nationkey") * 7 + F.length("p_type")) % 10).cast("double").alias("cost_adjustment_per_kg"),
    )


def executed(t: Tables):
    return valuation.normalized_executed_prices(trades(t), inventory(t), stores(t), transport(t), CLASSES)


def open_orders(t: Tables):
    return valuation.normalized_open_orders(trades(t), transport(t))


def market_prices(t: Tables):
    return valuation.mean_market_prices(executed(t), open_orders(t), FIRST, LAST)


def start_prices(t: Tables):
    """Mean list price of the product's parts, used where the first day has no market price."""
    return t.part.groupBy(F.col("p_type").alias("product_code")).agg(
        F.avg("p_retailprice").alias("price")
    )


EXECUTED_SQL = """
    WITH RECURSIVE base AS (
        SELECT l.*, p_type, n_nationkey, n_name,
               concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS INT)) AS record,
               CASE l_linenumber % 3 WHEN 0 THEN 'Options' WHEN 1 THEN 'Futures' ELSE 'Forward' END AS kind,
               upper(substr(p_type, 1, 1)) || lower(substr(p_type, 2)) || ' goods' AS label,
               CASE WHEN n_nationkey % 6 <> 0 THEN CAST((n_nationkey * 7 + length(p_type)) % 10 AS DOUBLE) ELSE 0 END AS cost
        FROM lineitem l JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
        JOIN nation ON s_nationkey = n_nationkey),
    combined AS (
        SELECT CAST(l_shipdate AS DATE) AS record_date, label, p_type AS item_id,
               substr(kind, 1, 2) || p_type AS market_code, kind AS asset_type, record, 1.0 * l_quantity AS volume_kg,
               l_extendedprice / l_quantity AS price_per_kg, n_name, cost
        FROM base WHERE l_returnflag <> 'R'
        UNION
        SELECT CAST(l_shipdate AS DATE), label, p_type, 'INV' || p_type, 'Store Receipt', record, l_quantity,
               (l_extendedprice * 1000 / l_quantity) / 1000, n_name, cost
        FROM base WHERE l_returnflag = 'R' AND l_linenumber <= 3),
    adjusted AS (
        SELECT *, price_per_kg + cost AS adjusted_price, volume_kg * (price_per_kg + cost) AS adjusted_value FROM combined),
    banded AS (
        SELECT *, avg(adjusted_price) OVER w AS mean, coalesce(stddev(adjusted_price) OVER w, 0) AS sd
        FROM adjusted WINDOW w AS (PARTITION BY market_code, record_date)),
    executed AS (
        SELECT * FROM banded WHERE adjusted_price BETWEEN mean - sd - abs(mean) * 1e-9 AND mean + sd + abs(mean) * 1e-9)
"""


@query(
    "normalized_executed_prices",
    EXECUTED_SQL
    + """
    SELECT CAST(record_date AS VARCHAR) AS record_date, market_code, asset_type, record, round(volume_kg, 2) AS volume_kg,
           round(adjusted_price, 8) AS adjusted_price, round(sd, 4) AS std_dev,
           adjusted_price BETWEEN mean - sd - 0.001 AND mean + sd + 0.001 AS in_band
    FROM executed
    """,
)
def normalized_executed_prices(t: Tables):
    return executed(t).select(
        day_text("record_date").alias("record_date"), "market_code", "asset_type", F.col("record_id").alias("record"),
        rounded("volume_kg", 2).alias("volume_kg"), rounded("adjusted_price", 8).alias("adjusted_price"),
        rounded("std_dev_price_per_kg", 4).alias("std_dev"),
        F.col("adjusted_price").between(F.col("lower_band") - 0.001, F.col("upper_band") + 0.001).alias("in_band"),
    )


OPEN_SQL = """
    orders_ AS (
        SELECT DISTINCT record, substr(kind, 1, 2) || p_type AS asset_code, cost,
               CASE WHEN l_linestatus = 'O' THEN 'Vend' ELSE 'Purchase' END AS side, l_quantity AS volume,
               l_extendedprice / l_quantity AS price,
               CAST(l_shipdate AS DATE) + CASE WHEN (l_orderkey % 24) + 1 >= 24 THEN 1
                                               WHEN (l_orderkey % 24) + 1 >= 15 THEN 1 ELSE 0 END AS day
        FROM base WHERE l_returnflag = 'R' AND l_linenumber > 3),
    open_banded AS (
        SELECT *, price + cost AS adjusted, avg(price + cost) OVER w AS mean, coalesce(stddev(price + cost) OVER w, 0) AS sd
        FROM orders_ WINDOW w AS (PARTITION BY side, asset_code, day)),
    open_ AS (SELECT * FROM open_banded
              WHERE adjusted BETWEEN mean - sd - abs(mean) * 1e-9 AND mean + sd + abs(mean) * 1e-9)
"""


@query(
    "normalized_open_orders",
    EXECUTED_SQL + "," + OPEN_SQL
    + """
    SELECT record, side AS transaction_type, asset_code, CAST(day AS VARCHAR) AS trading_day, round(volume, 2) AS volume,
           round(adjusted, 8) AS adjusted_order_price, round(volume * adjusted, 3) AS adjusted_order_value
    FROM open_
    """,
)
def normalized_open_orders(t: Tables):
    return open_orders(t).select(
        F.col("record_id").alias("record"), "transaction_type", "asset_code",
        day_text("adjusted_trade_time").alias("trading_day"), rounded("requested_volume_kg", 2).alias("volume"),
        rounded("adjusted_order_price", 8).alias("adjusted_order_price"),
        rounded("adjusted_order_value", 3).alias("adjusted_order_value"),
    )


MEAN_SQL = (
    EXECUTED_SQL + "," + OPEN_SQL
    + """,
    traded AS (
        SELECT record_date AS date, label, item_id, market_code, sum(adjusted_value) AS market_value,
               sum(volume_kg) AS market_volume, sum(adjusted_value) / sum(volume_kg) AS market_price
        FROM executed GROUP BY ALL),
    calendar AS (
        SELECT CAST(d AS DATE) AS date
        FROM generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-12-31', INTERVAL 1 DAY) AS g(d)),
    mid AS (
        SELECT day AS date, asset_code, max(adjusted) FILTER (side = 'Purchase') AS best_buy,
               min(adjusted) FILTER (side = 'Vend') AS best_sell, sum(volume) FILTER (side = 'Purchase') AS buy_volume,
               sum(volume) FILTER (side = 'Vend') AS sell_volume
        FROM open_ GROUP BY ALL),
    markets AS (
        SELECT c.date, m.item_id, m.market_code, t.market_price, t.market_volume, o.best_buy, o.best_sell,
               coalesce(t.market_price, nullif((o.best_buy + o.best_sell) / 2, 0)) AS final_price,
               coalesce(t.market_volume, nullif((o.buy_volume + o.sell_volume) / 2, 0)) AS final_volume,
               CASE WHEN upper(m.market_code) LIKE 'FO%' THEN 0.05::DOUBLE WHEN upper(m.market_code) LIKE 'FU%' THEN 0.10::DOUBLE
                    WHEN upper(m.market_code) LIKE 'INV%' THEN 0.10::DOUBLE WHEN upper(m.market_code) LIKE 'OP%' THEN 0.75::DOUBLE END AS w
        FROM calendar c CROSS JOIN (SELECT DISTINCT label, item_id, market_code FROM traded) m
        LEFT JOIN traded t ON t.date = c.date AND t.market_code = m.market_code
        LEFT JOIN mid o ON o.date = c.date AND o.asset_code = m.market_code
            AND o.best_buy IS NOT NULL AND o.best_sell IS NOT NULL)
"""
)


@query(
    "mean_market_prices",
    MEAN_SQL
    + """
    SELECT CAST(date AS VARCHAR) AS date, item_id AS product_code, market_code, round(best_buy, 8) AS best_buy,
           round(best_sell, 8) AS best_sell, round(final_price, 8) AS final_price, round(final_volume, 2) AS final_volume,
           w AS weight FROM markets
    """,
)
def mean_market_prices(t: Tables):
    return market_prices(t).select(
        day_text("date").alias("date"), "product_code", "market_code", rounded("best_buy", 8).alias("best_buy"),
        rounded("best_sell", 8).alias("best_sell"), rounded("final_market_price", 8).alias("final_price"),
        rounded("final_market_volume", 2).alias("final_volume"), F.col("fixed_market_weight").alias("weight"),
    )


CHAIN_SQL = (
    MEAN_SQL
    + """,
    known AS (SELECT DISTINCT item_id, market_code, date AS known_on FROM markets WHERE final_price IS NOT NULL),
    aged AS (
        SELECT m.*, m.date - coalesce(k.known_on, DATE '1994-12-31') AS age
        FROM markets m ASOF LEFT JOIN known k
        ON k.item_id = m.item_id AND k.market_code = m.market_code AND k.known_on <= m.date),
    steps AS MATERIALIZED (
        SELECT date, item_id, sum(final_price * w) AS fixed, sum(w) FILTER (final_price IS NULL AND age <= 5) AS carried,
               coalesce(nullif(sum(w) FILTER (final_price IS NOT NULL OR age <= 5), 0), 1) AS whole,
               bool_or(final_price IS NULL AND age > 5) AS lapsed
        FROM aged WHERE date > DATE '1995-01-01' GROUP BY ALL),
    closing AS (
        SELECT m.date, m.item_id,
               sum(w * CASE WHEN market_price IS NULL THEN coalesce(start_price, final_price) ELSE final_price END) / sum(w) AS acp
        FROM markets m LEFT JOIN (SELECT p_type, avg(p_retailprice) AS start_price FROM part GROUP BY p_type) ON p_type = m.item_id
        WHERE m.date = DATE '1995-01-01' GROUP BY ALL
        UNION ALL
        SELECT s.date, s.item_id, CASE WHEN lapsed OR fixed IS NOT NULL OR carried * acp IS NOT NULL
                                       THEN (coalesce(fixed, 0) + coalesce(carried * acp, 0)) / whole END
        FROM closing c JOIN steps s ON s.item_id = c.item_id AND s.date = c.date + 1)
"""
)


@query(
    "closing_price_chain",
    CHAIN_SQL + f"SELECT CAST(date AS VARCHAR) AS date, item_id AS product_code, {rounded_price_sql('acp')} AS product_acp FROM closing",
)
def closing_price_chain(t: Tables):
    chained = valuation.closing_price_chain(market_prices(t), start_prices(t))
    return chained.select(day_text("date").alias("date"), "product_code", rounded_price("product_acp").alias("product_acp"))


@query(
    "asset_prices",
    CHAIN_SQL
    + f""",
    assets AS (
        SELECT DISTINCT left(kind, 1) || p_type AS asset_code, p_type,
               CASE WHEN kind = 'Options' THEN 'n/a' ELSE n_name END AS location,
               CASE WHEN kind <> 'Options' AND n_nationkey % 6 <> 0
                    THEN CAST((n_nationkey * 7 + length(p_type)) % 10 AS DOUBLE) ELSE 0 END AS cost
        FROM base),
    priced AS (
        SELECT a.asset_code, a.location, c.date, k.acp - a.cost AS asset_acp
        FROM calendar c CROSS JOIN assets a LEFT JOIN closing k ON k.date = c.date AND k.item_id = a.p_type)
    SELECT asset_code, location, strftime(date, '%Y-%m') AS month, CAST(count(*) AS BIGINT) AS days,
           CAST(count(asset_acp) AS BIGINT) AS priced_days, {rounded_price_sql("arg_max(asset_acp, date)")} AS closing_acp,
           {rounded_price_sql("min(asset_acp)")} AS lowest_acp
    FROM priced GROUP BY ALL
    """,
)
def asset_prices(t: Tables):
    """Prices of all assets and days, reported per asset and month."""
    chained = valuation.closing_price_chain(market_prices(t), start_prices(t))
    assets = lines(t).select(F.concat(F.substring("kind", 1, 1), F.col("p_type")).alias("asset_code"),
                             F.col("kind").alias("asset_type"), F.col("n_name").alias("location"))
    geo = t.nation.select(F.col("n_name").alias("name"), F.col("n_name").alias("state"))
    priced = valuation.asset_prices(chained, assets, geo, transport(t), CLASSES, FIRST, LAST)
    return per_month(
        priced, ["asset_code", "location"], "date", F.count("*").alias("days"), F.count("asset_acp").alias("priced_days"),
        rounded_price(F.max_by("asset_acp", "date")).alias("closing_acp"), rounded_price(F.min("asset_acp")).alias("lowest_acp"),
    )
