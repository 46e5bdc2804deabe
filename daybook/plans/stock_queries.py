"""Portfolios and inventories made of line items.

Portfolio: the clients are customer nations, the products part types and the locations regions
of the suppliers; the lines of one order and part type are one transaction whose lists hold the
quantity per region. Inventory: supplier nations are the stores.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from daybook.operators import inventory, portfolio
from daybook.plans.registry import Tables, cents, day_text, per_month, query, rounded

SINCE, THROUGH, AS_OF = "1995-03-01", "2001-12-31", "2002-01-01"
SPECIAL = "Special"


def located_lines(t: Tables):
    places = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).join(
        t.region, F.col("n_regionkey") == F.col("r_regionkey")
    ).select("s_suppkey", "n_nationkey", "n_name", "r_name")
    return t.lineitem.join(t.part.select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey")).join(
        places, F.col("l_suppkey") == F.col("s_suppkey")
    )


def portfolio_log(t: Tables):
    """One transaction per order and part type; lists ordered by region, missing when empty."""
    buyers = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(
        t.nation, F.col("c_nationkey") == F.col("n_nationkey")
    ).select("o_orderkey", "o_orderdate", F.col("n_name").alias("client_id"), F.col("n_regionkey").alias("location_id"))
    per_region = located_lines(t).groupBy("l_orderkey", "p_type", "r_name").agg(
        F.sum("l_quantity").alias("all_q"),
        F.sum(F.when(F.col("l_returnflag") == "R", F.col("l_quantity"))).alias("returned_q"),
        F.sum(F.when(F.col("l_returnflag") == "A", F.col("l_quantity"))).alias("moved_q"),
    )

    def breakdown(column: str):
        entry = F.struct(F.col("r_name").alias("location_code"), F.col(column).cast("string").alias("volume"))
        entries = F.array_sort(F.collect_list(F.when(F.col(column).isNotNull(), entry)))
        return F.when(F.size(entries) > 0, F.to_json(entries))

    per_order = per_region.groupBy("l_orderkey", "p_type").agg(
        breakdown("moved_q").alias("location_breakdown"),
        breakdown("returned_q").alias("location_breakdown_before"),
        breakdown("all_q").alias("location_breakdown_after"),
        F.sum("moved_q").alias("units"),
        F.sum("returned_q").alias("total_units_before"), F.sum("all_q").alias("total_units_after"),
    )
    return per_order.join(buyers, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_orderkey").alias("transaction_id"), "client_id", F.col("p_type").alias("product_id"), "location_id",
        F.col("o_orderdate").alias("created"), "units", "total_units_before", "total_units_after",
        "location_breakdown", "location_breakdown_before", "location_breakdown_after",
    )


def portfolio_products(t: Tables):
    """Type, code and maturity per part type from its total size."""
    size = t.part.groupBy("p_type").agg(F.sum("p_size").alias("s"))
    maturity = F.when(F.col("s") % 3 != 0, F.date_add(F.lit("1998-01-01").cast("date"), (F.col("s") % 1200).cast("int")))
    return size.select(F.col("p_type").alias("id"), F.when(F.length("p_type") == 8, SPECIAL).otherwise("Plain").alias("product_type"),
                       F.concat(F.lit("P-"), F.col("p_type")).alias("product_code"), maturity.alias("maturity_date"))


def portfolio_locations(t: Tables):
    return t.region.select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("code"), F.lower("r_name").alias("name"),
                           F.concat(F.lit("Zone "), F.col("r_regionkey")).alias("state"))


def portfolio_clients(t: Tables):
    return t.nation.select(F.col("n_name").alias("id"), F.concat(F.lit("C-"), F.col("n_nationkey")).alias("client_id"))


def described(t: Tables):
    return portfolio.describe_log(portfolio_log(t), portfolio_products(t), portfolio_locations(t), SINCE, SPECIAL)


def transactions(t: Tables):
    return portfolio.moved_volume_per_location(portfolio.expand_location_breakdown(described(t)))


PORTFOLIO_SQL = """
    WITH places AS (
        SELECT s_suppkey, n_nationkey, n_name, r_name FROM supplier JOIN nation ON s_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey),
    products AS (
        SELECT p_type, CASE WHEN length(p_type) = 8 THEN 'Special' ELSE 'Plain' END AS product_type,
               CASE WHEN sum(p_size) % 3 <> 0 THEN DATE '1998-01-01' + CAST(sum(p_size) % 1200 AS INT) END AS maturity
        FROM part GROUP BY p_type),
    per_region AS (
        SELECT l_orderkey, p_type, r_name, sum(l_quantity) AS all_q,
               sum(l_quantity) FILTER (l_returnflag = 'R') AS returned_q, sum(l_quantity) FILTER (l_returnflag = 'A') AS moved_q
        FROM lineitem JOIN part ON l_partkey = p_partkey JOIN places ON l_suppkey = s_suppkey GROUP BY ALL),
    log_ AS (
        SELECT l_orderkey, r.p_type, product_type, maturity, b.n_name AS client, lr.r_name AS own_location, o_orderdate AS created,
               sum(all_q) AS total_after, sum(returned_q) AS total_before, sum(moved_q) AS units
        FROM per_region r JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
        JOIN nation b ON c_nationkey = b.n_nationkey JOIN region lr ON b.n_regionkey = lr.r_regionkey
        JOIN products p ON p.p_type = r.p_type
        WHERE o_orderdate >= DATE '1995-03-01' GROUP BY ALL),
    befores AS (SELECT l_orderkey, p_type, r_name, returned_q AS v, row_number() OVER (PARTITION BY l_orderkey, p_type ORDER BY r_name) - 1 AS pos
                FROM per_region WHERE returned_q IS NOT NULL),
    afters AS (SELECT l_orderkey, p_type, r_name, all_q AS v, row_number() OVER (PARTITION BY l_orderkey, p_type ORDER BY r_name) - 1 AS pos
               FROM per_region),
    expanded AS (
        SELECT g.*, a.pos, CASE WHEN product_type = 'Special' THEN total_before * 1000
                             WHEN total_before IS NULL AND a.pos = 0 THEN total_before ELSE b.v END AS volume_before,
               CASE WHEN product_type = 'Special' OR (total_before IS NULL AND a.pos = 0) THEN own_location ELSE b.r_name END AS loc_before,
               CASE WHEN product_type = 'Special' THEN total_after * 1000 ELSE a.v END AS volume_after,
               CASE WHEN product_type = 'Special' THEN own_location ELSE a.r_name END AS loc_after
        FROM log_ g JOIN afters a ON a.l_orderkey = g.l_orderkey AND a.p_type = g.p_type
        LEFT JOIN befores b ON b.l_orderkey = g.l_orderkey AND b.p_type = g.p_type AND b.pos = a.pos),
    moved AS (
        SELECT e.*, CASE WHEN product_type = 'Special' THEN units * 1000 ELSE coalesce(m.moved_q, units) END AS volume,
               CASE WHEN product_type = 'Special' THEN own_location ELSE coalesce(m.r_name, own_location) END AS actual_location
        FROM expanded e LEFT JOIN per_region m ON m.l_orderkey = e.l_orderkey AND m.p_type = e.p_type
            AND m.r_name = e.loc_after AND m.moved_q IS NOT NULL)
"""


@query(
    "expand_location_breakdown",
    PORTFOLIO_SQL
    + """
    SELECT l_orderkey AS transaction_id, client, p_type, CAST(pos AS BIGINT) AS position, volume_before, loc_before, volume_after, loc_after
    FROM expanded
    """,
)
def expand_location_breakdown(t: Tables):
    return portfolio.expand_location_breakdown(described(t)).select(
        "transaction_id", F.col("client_id").alias("client"), F.col("product_id").alias("p_type"),
        F.col("position").cast("long").alias("position"), F.col("total_volume_before").alias("volume_before"),
        F.col("location_code_before").alias("loc_before"), F.col("total_volume_after").alias("volume_after"),
        F.col("location_code_after").alias("loc_after"),
    )


@query(
    "moved_volume_per_location",
    PORTFOLIO_SQL
    + """
    SELECT l_orderkey AS transaction_id, p_type, CAST(pos AS BIGINT) AS position, loc_after, volume, actual_location FROM moved
    """,
)
def moved_volume_per_location(t: Tables):
    return transactions(t).select(
        "transaction_id", F.col("product_id").alias("p_type"), F.col("position").cast("long").alias("position"),
        F.col("location_code_after").alias("loc_after"), "volume", F.col("actual_location_code").alias("actual_location"),
    )


@query(
    "portfolio_daily_balance",
    PORTFOLIO_SQL
    + """,
    last_per_day AS (
        SELECT * FROM (
            SELECT *, CAST(created AS DATE) AS day,
                   row_number() OVER (PARTITION BY client, p_type, loc_after, CAST(created AS DATE)
                                      ORDER BY created DESC, l_orderkey DESC, pos DESC) AS rn
            FROM moved WHERE volume IS NOT NULL) WHERE rn = 1),
    spans AS (
        SELECT client, p_type, loc_after, maturity, CAST(min(created) AS DATE) AS start_date, CAST(max(created) AS DATE) AS end_date
        FROM moved GROUP BY ALL),
    calendar AS (SELECT CAST(d AS DATE) AS date
                 FROM generate_series(TIMESTAMP '1995-03-01', TIMESTAMP '2001-12-31', INTERVAL 1 DAY) AS g(d)),
    spine AS (
        SELECT s.*, c.date FROM spans s JOIN calendar c ON s.start_date <= c.date AND (
            maturity IS NULL OR (end_date <= maturity AND c.date <= maturity + INTERVAL 1 MONTH)
            OR (end_date > maturity AND c.date <= end_date + INTERVAL 1 MONTH))),
    numbered AS (
        SELECT s.client, s.p_type, s.loc_after, s.date, l.volume_after, l.created,
               count(l.volume) OVER (PARTITION BY s.client, s.p_type, s.loc_after ORDER BY s.date) AS grp
        FROM spine s LEFT JOIN last_per_day l ON l.client = s.client AND l.p_type = s.p_type
            AND l.loc_after = s.loc_after AND l.day = s.date),
    filled AS (
        SELECT client, p_type, loc_after, date, max(volume_after) OVER g AS balance, max(created) OVER g AS latest
        FROM numbered WINDOW g AS (PARTITION BY client, p_type, loc_after, grp))
    SELECT 'C-' || n_nationkey AS client, 'P-' || p_type AS product_code, lower(r_name) AS location,
           'Zone ' || r_regionkey AS state, strftime(date, '%Y-%m') AS month, CAST(count(*) AS BIGINT) AS days,
           round(sum(balance), 2) AS sum_balance, CAST(CAST(max(latest) AS DATE) AS VARCHAR) AS latest_trans
    FROM filled JOIN region ON r_name = loc_after LEFT JOIN nation ON n_name = filled.client GROUP BY ALL
    """,
)
def portfolio_daily_balance(t: Tables):
    """The dense table reported per client, product, location and month."""
    dense = portfolio.portfolio_daily_balance(transactions(t), portfolio_locations(t), THROUGH, portfolio_clients(t))
    return per_month(
        dense, [F.col("client_id").alias("client"), "product_code", "location", "state"], "portfolio_date",
        F.count("*").alias("days"), rounded(F.sum("total_portfolio_balance"), 2).alias("sum_balance"),
        day_text(F.max("latest_trans_at")).alias("latest_trans"),
    )


@query(
    "portfolio_incremental",
    PORTFOLIO_SQL
    + """
    SELECT '2001-12-31' AS portfolio_date, 'C-' || n_nationkey AS client, 'P-' || p_type AS product_code,
           lower(loc_after) AS location,
           volume_after AS balance, CAST(CAST(created AS DATE) AS VARCHAR) AS latest_trans
    FROM (SELECT *, row_number() OVER (PARTITION BY client, p_type, loc_after ORDER BY created DESC, l_orderkey DESC, pos DESC) AS rn
          FROM moved WHERE volume IS NOT NULL AND (
            maturity IS NULL OR (created <= maturity AND maturity + INTERVAL 1 MONTH >= DATE '2001-12-31')
            OR (created > maturity AND created + INTERVAL 1 MONTH >= DATE '2001-12-31'))) last_rows
    LEFT JOIN nation ON n_name = last_rows.client
    WHERE rn = 1
    """,
)
def portfolio_incremental(t: Tables):
    return latest_portfolio(portfolio.portfolio_incremental(transactions(t), portfolio_locations(t), AS_OF, portfolio_clients(t)))


def latest_portfolio(latest):
    return latest.select(
        day_text("portfolio_date").alias("portfolio_date"), F.col("client_id").alias("client"), "product_code", "location",
        F.col("total_portfolio_balance").alias("balance"), day_text("latest_trans_at").alias("latest_trans"),
    )


STOCK_TIES = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "units_after", "volume_after"]


def stock_tables(t: Tables):
    """Transactions, accounts, stores and products of the inventory."""
    line = located_lines(t)
    account = F.concat_ws("/", "n_nationkey", "p_type", "l_returnflag")
    moves = line.select(
        account.alias("store_inventory_account_id"), F.concat(F.lit("C"), F.col("l_suppkey")).alias("client_id"),
        F.col("l_shipdate").alias("created"), (F.col("l_discount") == 0).alias("is_deleted"),
        F.col("l_linenumber").alias("reserved_units_after"), F.col("l_quantity").alias("units_after"),
        (F.col("l_quantity") + F.col("l_linenumber")).alias("total_units_after"),
        F.col("l_tax").alias("reserved_volume_after"), F.col("l_extendedprice").alias("volume_after"),
        F.col("l_extendedprice").alias("total_volume_after"), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
    )
    accounts = line.select(account.alias("id"), F.col("n_nationkey").alias("store_id"), F.col("p_type").alias("product_id"),
                           F.col("l_returnflag").alias("quality_level")).distinct()
    stores = t.nation.select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))
    products = t.part.groupBy("p_type").agg(F.min("p_size").alias("smallest")).select(
        F.col("p_type").alias("id"), F.initcap("p_type").alias("name"), F.concat(F.lit("P-"), F.col("p_type")).alias("code"),
        F.lit("goods").alias("category_type"),
    )
    return moves, accounts, stores, products


STOCK_SQL = """
    WITH moves AS (
        SELECT l.*, n_nationkey, n_name, p_type, CAST(l_shipdate AS DATE) AS day
        FROM lineitem l JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
        JOIN nation ON s_nationkey = n_nationkey WHERE l_discount <> 0)
"""
STOCK_ORDER = "l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC"


@query(
    "inventory_daily_balance",
    STOCK_SQL
    + f""",
    last_per_day AS (
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY n_nationkey, p_type, l_returnflag, day ORDER BY {STOCK_ORDER}) AS rn
                       FROM moves) WHERE rn = 1),
    calendar AS (SELECT CAST(d AS DATE) AS date
                 FROM generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-12-31', INTERVAL 1 DAY) AS g(d)),
    spine AS (
        SELECT s.*, c.date FROM (SELECT n_nationkey, n_name, p_type, l_returnflag, min(day) AS first FROM moves GROUP BY ALL) s
        JOIN calendar c ON first <= c.date),
    numbered AS (
        SELECT s.n_name, s.p_type, s.l_returnflag, s.date, l.l_linenumber AS reserved, l.l_quantity AS units,
               l.l_tax AS reserved_volume, l.l_extendedprice AS volume, l.l_shipdate, l.l_suppkey,
               count(l.day) OVER (PARTITION BY s.n_nationkey, s.p_type, s.l_returnflag ORDER BY s.date) AS grp
        FROM spine s LEFT JOIN last_per_day l ON l.n_nationkey = s.n_nationkey AND l.p_type = s.p_type
            AND l.l_returnflag = s.l_returnflag AND l.day = s.date),
    filled AS (
        SELECT n_name, p_type, l_returnflag, date, max(reserved) OVER g AS reserved, max(units) OVER g AS units,
               max(reserved_volume) OVER g AS reserved_volume, max(volume) OVER g AS volume, max(l_suppkey) OVER g AS client
        FROM numbered WINDOW g AS (PARTITION BY n_name, p_type, l_returnflag, grp))
    SELECT n_name AS store_name, 'P-' || p_type AS product_code, l_returnflag AS quality_level, strftime(date, '%Y-%m') AS month,
           CAST(count(*) AS BIGINT) AS days, CAST(sum(reserved) AS BIGINT) AS reserved_units, sum(units) AS available_units,
           sum(units + reserved) AS total_units, round(sum(reserved_volume), 4) AS reserved_volume,
           CAST(sum(CAST(volume AS DECIMAL(18,2))) AS DOUBLE) AS volume, 'C' || arg_max(client, date) AS closing_client
    FROM filled GROUP BY ALL
    """,
)
def inventory_daily_balance(t: Tables):
    """The dense table reported per store, product, quality level and month."""
    dense = inventory.inventory_daily_balance(*stock_tables(t), through=THROUGH, tiebreak=STOCK_TIES)
    return per_month(
        dense, ["store_name", "product_code", "quality_level"], "inventory_date",
        F.count("*").alias("days"), F.sum("current_reserved_units").alias("reserved_units"),
        F.sum("current_available_units").alias("available_units"), F.sum("current_total_units").alias("total_units"),
        rounded(F.sum("current_reserved_volume"), 4).alias("reserved_volume"),
        cents("current_available_volume").alias("volume"), F.max_by("client_id", "inventory_date").alias("closing_client"),
    )


@query(
    "inventory_incremental",
    STOCK_SQL
    + f"""
    SELECT '2001-12-31' AS inventory_date, n_name AS store_name, 'P-' || p_type AS product_code, l_returnflag AS quality_level,
           'C' || l_suppkey AS client_id, l_linenumber AS reserved_units, l_quantity AS available_units,
           l_extendedprice AS available_volume, n_nationkey || '/' || p_type || '/' || l_returnflag AS account,
           CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS latest_trans
    FROM (SELECT *, row_number() OVER (PARTITION BY n_nationkey, p_type, l_returnflag ORDER BY {STOCK_ORDER}) AS rn FROM moves)
    WHERE rn = 1
    """,
)
def inventory_incremental(t: Tables):
    return latest_inventory(inventory.inventory_incremental(*stock_tables(t), as_of=AS_OF, tiebreak=STOCK_TIES))


def latest_inventory(latest):
    return latest.select(
        day_text("inventory_date").alias("inventory_date"), "store_name", "product_code", "quality_level", "client_id",
        F.col("current_reserved_units").alias("reserved_units"), F.col("current_available_units").alias("available_units"),
        F.col("current_available_volume").alias("available_volume"), F.col("store_inventory_account_id").alias("account"),
        day_text("latest_trans_at").alias("latest_trans"),
    )
