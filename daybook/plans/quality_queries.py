"""Data-quality rules over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from daybook.operators import profile as profiles
from daybook.operators import quality as q
from daybook.plans.registry import Tables, day_text, query, rounded
from daybook.session import fresh_path
from daybook.sources.tables import replace_partitions

RESULT_SQL = """
    SELECT '{rule}' AS rule, '{column}' AS "column", failing <= evaluated * (1 - {mostly}) + 1e-9 AS success, evaluated, failing,
           CASE WHEN evaluated > 0 THEN round(failing * 100.0::DOUBLE / evaluated, 4) ELSE 0.0::DOUBLE END AS percent
    FROM (SELECT CAST(coalesce(sum(n) FILTER (judged), 0) AS BIGINT) AS evaluated,
                 CAST(coalesce(sum(n) FILTER (judged AND bad), 0) AS BIGINT) AS failing
          FROM ({source}))
"""


def result_sql(rule: str, column: str, source: str, mostly: float = 1.0) -> str:
    """Result row of a rule; ``source`` gives n (rows), judged and bad."""
    return RESULT_SQL.format(rule=rule, column=column, source=source, mostly=mostly)


def union_sql(*parts: str) -> str:
    return " UNION ALL ".join(f"({p})" for p in parts)


def row_sql(rule: str, column: str, table: str, bad: str, judged: str = "", mostly: float = 1.0) -> str:
    judged = judged or f"{column} IS NOT NULL"
    return result_sql(rule, column, f"SELECT 1 AS n, {judged} AS judged, coalesce({bad}, TRUE) AS bad FROM {table}", mostly)


@query(
    "rule_not_null",
    union_sql(
        row_sql("not_null", "o_custkey", "orders", "o_custkey IS NULL", "TRUE"),
        row_sql("not_null", "o_totalprice", "orders", "o_totalprice IS NULL", "o_orderstatus = 'F'"),
        row_sql("not_null", "quality", "documents LEFT JOIN labels USING (doc_id)", "quality IS NULL", "TRUE", 0.2),
    ),
)
def rule_not_null(t: Tables):
    """Plain, with a row condition, and with a wanted share (documents without a label are null)."""
    plain = q.run_suite(t.orders, [q.not_null("o_custkey"), q.not_null("o_totalprice", F.col("o_orderstatus") == "F")])
    labelled = t.documents.select("doc_id").join(t.labels, "doc_id", "left")
    return plain.unionByName(q.run_suite(labelled, [q.not_null("quality", mostly=0.2)]))


def unique_sql(column: str, table: str) -> str:
    return result_sql("unique", column, f"""SELECT count(*) AS n, TRUE AS judged, count(*) > 1 AS bad FROM {table}
        WHERE {' AND '.join(c + ' IS NOT NULL' for c in column.split(','))} GROUP BY {column}""")


@query("rule_unique", union_sql(unique_sql("o_orderkey", "orders"), unique_sql("l_orderkey,l_linenumber", "lineitem"),
                                unique_sql("text", "documents")))
def rule_unique(t: Tables):
    return (
        q.run_suite(t.orders, [q.unique("o_orderkey")])
        .unionByName(q.run_suite(t.lineitem, [q.unique(["l_orderkey", "l_linenumber"])]))
        .unionByName(q.run_suite(t.documents, [q.unique("text")]))
    )


@query(
    "rule_unique_failing",
    """
    SELECT l_orderkey, l_linenumber, CAST(count(*) AS BIGINT) AS occurrences FROM lineitem
    GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
    """,
)
def rule_unique_failing(t: Tables):
    return q.failing_rows(t.lineitem, q.unique(["l_orderkey", "l_linenumber"]))


@query(
    "rule_relationships",
    union_sql(
        result_sql("relationships", "o_custkey", """SELECT 1 AS n, o_custkey IS NOT NULL AS judged,
            o_custkey NOT IN (SELECT c_custkey FROM customer) AS bad FROM orders"""),
        result_sql("relationships", "doc_id", """SELECT 1 AS n, doc_id IS NOT NULL AS judged,
            doc_id NOT IN (SELECT doc_id FROM labels) AS bad FROM documents"""),
    ),
)
def rule_relationships(t: Tables):
    return q.run_suite(t.orders, [q.relationships("o_custkey", t.customer, "c_custkey")]).unionByName(
        q.run_suite(t.documents, [q.relationships("doc_id", t.labels, "doc_id")])
    )


@query(
    "rule_relationships_failing",
    "SELECT doc_id, CAST(1 AS BIGINT) AS occurrences FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
)
def rule_relationships_failing(t: Tables):
    return q.failing_rows(t.documents, q.relationships("doc_id", t.labels, "doc_id"))


@query(
    "rule_in_set",
    union_sql(
        row_sql("in_set", "o_orderstatus", "orders", "o_orderstatus NOT IN ('O', 'F')", mostly=0.5),
        row_sql("in_set", "event_type", "events", "event_type NOT IN ('view', 'click', 'purchase', 'signup', 'error')"),
        row_sql("in_set", "lang", "documents", "lang NOT IN ('en', 'de', 'fr')"),
    ),
)
def rule_in_set(t: Tables):
    return (
        q.run_suite(t.orders, [q.in_set("o_orderstatus", ["O", "F"], mostly=0.5)])
        .unionByName(q.run_suite(t.events, [q.in_set("event_type", ["view", "click", "purchase", "signup", "error"])]))
        .unionByName(q.run_suite(t.documents, [q.in_set("lang", ["en", "de", "fr"])]))
    )


@query(
    "rule_distinct_values_in_set",
    result_sql("distinct_values_in_set", "c_mktsegment", """SELECT DISTINCT 1 AS n, TRUE AS judged,
        c_mktsegment NOT IN ('BUILDING', 'MACHINERY', 'FURNITURE') AS bad, c_mktsegment FROM customer
        WHERE c_acctbal > 0 AND c_mktsegment IS NOT NULL"""),
)
def rule_distinct_values_in_set(t: Tables):
    rule = q.distinct_values_in_set("c_mktsegment", ["BUILDING", "MACHINERY", "FURNITURE"], F.col("c_acctbal") > 0)
    return q.run_suite(t.customer, [rule])


@query(
    "rule_between",
    union_sql(
        row_sql("between", "l_quantity", "lineitem", "NOT (l_quantity > 1 AND l_quantity <= 50)"),
        row_sql("between", "l_discount", "lineitem", "NOT (l_discount >= 0 AND l_discount < 0.1)", mostly=0.9),
        row_sql("between", "l_shipdate", "lineitem",
                "NOT (l_shipdate >= TIMESTAMP '1996-01-01' AND l_shipdate < TIMESTAMP '2001-01-01')"),
    ),
)
def rule_between(t: Tables):
    stamp = lambda s: F.lit(s).cast("timestamp")
    return q.run_suite(t.lineitem, [
        q.between("l_quantity", 1, 50, strict_min=True),
        q.between("l_discount", 0, 0.1, strict_max=True, mostly=0.9),
        q.between("l_shipdate", stamp("1996-01-01"), stamp("2001-01-01"), strict_max=True),
    ])


@query(
    "rule_length_between",
    union_sql(
        row_sql("length_between", "text", "documents", "NOT (length(text) BETWEEN 100 AND 2000)"),
        row_sql("length_between", "url", "pages", "NOT (length(url) >= 30)"),
    ),
)
def rule_length_between(t: Tables):
    return q.run_suite(t.documents, [q.length_between("text", 100, 2000)]).unionByName(
        q.run_suite(t.pages, [q.length_between("url", 30)])
    )


EMAIL = "^[a-zA-Z0-9.!#$%&*+/=?^_`{|}~-]+@[a-zA-Z0-9-]+(?:\\.[a-zA-Z0-9-]+)*$"


@query(
    "rule_matches_regex",
    union_sql(
        row_sql("matches_regex", "c_name", "customer", "NOT regexp_matches(c_name, '^Customer#[0-9]{9}$')"),
        row_sql("matches_regex", "url", "pages", "NOT regexp_matches(url, '^https://[a-z.]+/[a-z]{2}/[0-9]+$')"),
        row_sql("matches_regex", "email",
                "(SELECT 'c' || c_custkey || CASE WHEN c_nationkey % 4 = 0 THEN ' at ' ELSE '@' END || lower(c_mktsegment) || '.com' AS email FROM customer)",
                f"NOT regexp_matches(email, '{EMAIL}')"),
    ),
)
def rule_matches_regex(t: Tables):
    at = F.when(F.col("c_nationkey") % 4 == 0, " at ").otherwise("@")
    mail = t.customer.withColumn("email", F.concat(F.lit("c"), "c_custkey", at, F.lower("c_mktsegment"), F.lit(".com")))
    return q.run_suite(mail, [q.matches_regex("c_name", "^Customer#[0-9]{9}$"), q.matches_regex("email", EMAIL)]).unionByName(
        q.run_suite(t.pages, [q.matches_regex("url", "^https://[a-z.]+/[a-z]{2}/[0-9]+$")])
    )


def table_sql(rule: str, column: str, table: str, success: str) -> str:
    return f"""SELECT '{rule}' AS rule, '{column}' AS "column", {success} AS success, CAST(count(*) AS BIGINT) AS evaluated,
        CAST(CASE WHEN {success} THEN 0 ELSE 1 END AS BIGINT) AS failing,
        CASE WHEN {success} THEN 0.0::DOUBLE ELSE round(100.0::DOUBLE / count(*), 4) END AS percent FROM {table}"""


@query("rule_row_count_between", union_sql(table_sql("row_count_between", "", "region", "count(*) BETWEEN 1 AND 50"),
                                           table_sql("row_count_between", "", "orders", "count(*) BETWEEN 1 AND 50")))
def rule_row_count_between(t: Tables):
    rule = [q.row_count_between(1, 50)]
    return q.run_suite(t.region, rule).unionByName(q.run_suite(t.orders, rule))


@query(
    "rule_recent_data",
    union_sql(
        table_sql("recent_data", "ts", "events", "max(ts) >= TIMESTAMP '2024-01-31' - INTERVAL 2 DAY"),
        table_sql("recent_data", "o_orderdate", "orders", "max(o_orderdate) >= TIMESTAMP '2024-01-31' - INTERVAL 1 MONTH"),
    ),
)
def rule_recent_data(t: Tables):
    return q.run_suite(t.events, [q.recent_data("ts", "day", 2, "2024-01-31")]).unionByName(
        q.run_suite(t.orders, [q.recent_data("o_orderdate", "month", 1, "2024-01-31")])
    )


@query(
    "rule_columns_match_set",
    """
    SELECT 'columns_match_set' AS rule, '' AS "column", success, CAST(1 AS BIGINT) AS evaluated,
           CAST(CASE WHEN success THEN 0 ELSE 1 END AS BIGINT) AS failing, CASE WHEN success THEN 0.0::DOUBLE ELSE 100.0::DOUBLE END AS percent
    FROM (VALUES (TRUE), (FALSE)) AS v(success)
    """,
)
def rule_columns_match_set(t: Tables):
    exact = ["r_name", "r_regionkey"]
    return q.run_suite(t.region, [q.columns_match_set(exact), q.columns_match_set([*exact, "r_comment"])])


@query(
    "rule_column_type",
    """
    SELECT 'column_type' AS rule, column_name AS "column",
           CASE column_name WHEN 'o_orderkey' THEN data_type IN ('BIGINT', 'INTEGER') WHEN 'o_totalprice' THEN data_type = 'DOUBLE'
                WHEN 'o_orderstatus' THEN data_type = 'VARCHAR' WHEN 'o_orderdate' THEN data_type LIKE 'TIMESTAMP%'
                ELSE data_type = 'BOOLEAN' END AS success, CAST(1 AS BIGINT) AS evaluated,
           CAST(CASE WHEN column_name = 'o_orderpriority' THEN 1 ELSE 0 END AS BIGINT) AS failing,
           CASE WHEN column_name = 'o_orderpriority' THEN 100.0::DOUBLE ELSE 0.0::DOUBLE END AS percent
    FROM information_schema.columns WHERE table_name = 'orders' AND column_name <> 'o_custkey'
    """,
)
def rule_column_type(t: Tables):
    declared = {"o_orderkey": "INTEGER", "o_totalprice": "FLOAT", "o_orderstatus": "TEXT", "o_orderdate": "TIMESTAMP",
                "o_orderpriority": "BOOLEAN"}
    return q.run_suite(t.orders, [q.column_type(c, kind) for c, kind in declared.items()])


@query(
    "rule_within_historical_range",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem
    CROSS JOIN (SELECT avg(o_totalprice) / 8 AS m, stddev(o_totalprice) / 8 AS s FROM orders WHERE o_totalprice < 200000)
    WHERE l_extendedprice > m + 3 * s OR l_extendedprice < m - 3 * s
    """,
)
def rule_within_historical_range(t: Tables):
    history = t.orders.where("o_totalprice < 200000").select((F.col("o_totalprice") / 8).alias("price"))
    rule = q.within_historical_range("l_extendedprice", history, "price")
    return q.failing_rows(t.lineitem, rule).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")


def daily_quantity(t: Tables):
    """Quantity per return flag and day: one row per day of a series."""
    return t.lineitem.groupBy("l_returnflag", F.to_date("l_shipdate").alias("date")).agg(F.sum("l_quantity").alias("quantity"))


DAILY_SQL = "(SELECT l_returnflag, CAST(l_shipdate AS DATE) AS date, sum(l_quantity) AS quantity FROM lineitem GROUP BY ALL)"


@query(
    "rule_reasonable_movement",
    f"""
    SELECT l_returnflag, CAST(date AS VARCHAR) AS date, quantity, previous_value, round(change_pct, 6) AS change_pct
    FROM (SELECT *, lag(quantity) OVER w AS previous_value,
                 abs(quantity - lag(quantity) OVER w) / nullif(lag(quantity) OVER w, 0) * 100 AS change_pct
          FROM {DAILY_SQL} WINDOW w AS (PARTITION BY l_returnflag ORDER BY date))
    WHERE change_pct > 50
    """,
)
def rule_reasonable_movement(t: Tables):
    failing = q.failing_rows(daily_quantity(t), q.reasonable_movement("quantity", "date", ["l_returnflag"], 50))
    return failing.select("l_returnflag", day_text("date").alias("date"), "quantity", "previous_value",
                          rounded("change_pct").alias("change_pct"))


@query(
    "rule_suspicious_volume",
    f"""
    SELECT l_returnflag, CAST(date AS VARCHAR) AS date, quantity, round(avg_volume, 6) AS avg_volume, round(vol_std, 6) AS vol_std
    FROM (SELECT *, avg(quantity) OVER w AS avg_volume, stddev(quantity) OVER w AS vol_std
          FROM {DAILY_SQL} WINDOW w AS (PARTITION BY l_returnflag ORDER BY date ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING))
    WHERE quantity > avg_volume + 3 * vol_std
    """,
)
def rule_suspicious_volume(t: Tables):
    failing = q.failing_rows(daily_quantity(t), q.suspicious_volume("quantity", "date", ["l_returnflag"], 30))
    return failing.select("l_returnflag", day_text("date").alias("date"), "quantity", rounded("avg_volume").alias("avg_volume"),
                          rounded("vol_std").alias("vol_std"))


LINE_ORDER = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"]


@query(
    "rule_reasonable_movement_in_order",
    """
    SELECT l_orderkey, l_linenumber, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS date, l_quantity, previous_value, round(change_pct, 6) AS change_pct
    FROM (SELECT *, lag(l_quantity) OVER w AS previous_value,
                 abs(l_quantity - lag(l_quantity) OVER w) / nullif(lag(l_quantity) OVER w, 0) * 100 AS change_pct
          FROM lineitem WINDOW w AS (ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity))
    WHERE change_pct > 1000
    """,
)
def rule_reasonable_movement_in_order(t: Tables):
    """All lines as one series, as no column splits them."""
    failing = q.failing_rows(t.lineitem, q.reasonable_movement("l_quantity", LINE_ORDER, max_pct=1000))
    return failing.select("l_orderkey", "l_linenumber", day_text("l_shipdate").alias("date"), "l_quantity", "previous_value",
                          rounded("change_pct").alias("change_pct"))


@query(
    "rule_suspicious_volume_in_order",
    """
    SELECT l_orderkey, l_linenumber, l_extendedprice, round(avg_volume, 4) AS avg_volume, round(vol_std, 4) AS vol_std
    FROM (SELECT *, avg(l_extendedprice) OVER w AS avg_volume, stddev(l_extendedprice) OVER w AS vol_std
          FROM lineitem WINDOW w AS (ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING))
    WHERE l_extendedprice > avg_volume + 3 * vol_std
    """,
)
def rule_suspicious_volume_in_order(t: Tables):
    failing = q.failing_rows(t.lineitem, q.suspicious_volume("l_extendedprice", LINE_ORDER, window=10))
    return failing.select("l_orderkey", "l_linenumber", "l_extendedprice", rounded("avg_volume", 4).alias("avg_volume"),
                          rounded("vol_std", 4).alias("vol_std"))


@query(
    "rule_balanced",
    """
    SELECT CAST(date AS VARCHAR) AS date, total_buy, total_sell, round(imbalance_pct, 6) AS imbalance_pct
    FROM (SELECT CAST(l_shipdate AS DATE) AS date, sum(l_quantity) FILTER (l_returnflag = 'A') AS total_buy,
                 sum(l_quantity) FILTER (l_returnflag = 'R') AS total_sell,
                 abs(total_buy - total_sell) / nullif(total_buy, 0) * 100 AS imbalance_pct
          FROM lineitem GROUP BY ALL)
    WHERE imbalance_pct > 1
    """,
)
def rule_balanced(t: Tables):
    side = lambda flag: F.when(F.col("l_returnflag") == flag, F.col("l_quantity"))
    lines = t.lineitem.withColumn("date", F.to_date("l_shipdate"))
    failing = q.failing_rows(lines, q.balanced(side("A"), side("R"), "date"))
    return failing.select(day_text("date").alias("date"), "total_buy", "total_sell", rounded("imbalance_pct").alias("imbalance_pct"))


@query(
    "rule_balanced_daily_volumes",
    """
    SELECT CAST(date AS VARCHAR) AS date, buy_volume, sell_volume, round(abs(buy_volume - sell_volume) / greatest(buy_volume, sell_volume), 6) AS gap
    FROM (SELECT CAST(l_shipdate AS DATE) AS date, sum(CASE WHEN l_linestatus = 'O' THEN l_quantity ELSE 0 END) AS buy_volume,
                 sum(CASE WHEN l_linestatus = 'F' THEN l_quantity ELSE 0 END) AS sell_volume
          FROM lineitem GROUP BY ALL)
    WHERE abs(buy_volume - sell_volume) / nullif(greatest(buy_volume, sell_volume), 0) > 0.1
    """,
)
def rule_balanced_daily_volumes(t: Tables):
    lines = t.lineitem.withColumn("date", F.to_date("l_shipdate"))
    failing = q.failing_rows(lines, q.balanced_daily_volumes("l_quantity", "l_quantity", "date", "l_linestatus", "O", "F"))
    return failing.select(day_text("date").alias("date"), "buy_volume", "sell_volume", rounded("gap").alias("gap"))


@query(
    "rule_no_duplicates",
    """
    SELECT o_custkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day, CAST(count(*) AS BIGINT) AS occurrence_count
    FROM orders GROUP BY ALL HAVING count(*) > 1
    """,
)
def rule_no_duplicates(t: Tables):
    failing = q.failing_rows(t.orders, q.no_duplicates("o_custkey", "o_orderdate"))
    return failing.select("o_custkey", day_text("o_orderdate").alias("day"), "occurrence_count")


@query(
    "rule_within_quartile_limits",
    """
    SELECT event_id, value FROM events CROSS JOIN
        (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events)
    WHERE NOT (value > q1 - 1.5 * (q3 - q1) AND value < q3 + 1.5 * (q3 - q1))
    """,
)
def rule_within_quartile_limits(t: Tables):
    return q.failing_rows(t.events, q.within_quartile_limits("value")).select("event_id", "value")


@query(
    "rule_within_quartile_limits_by",
    """
    SELECT event_id, e.event_type, value FROM events e JOIN
        (SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events GROUP BY event_type) s
        ON s.event_type = e.event_type
    WHERE NOT (value > q1 - 1.5 * (q3 - q1) AND value < q3 + 1.5 * (q3 - q1))
    """,
)
def rule_within_quartile_limits_by(t: Tables):
    return q.failing_rows(t.events, q.within_quartile_limits_by("value", "event_type")).select("event_id", "event_type", "value")


PHONE_SQL = """
    (SELECT c_custkey, CASE c_nationkey % 4 WHEN 0 THEN 'NG' WHEN 1 THEN 'US' WHEN 2 THEN 'UK' ELSE 'GB' END AS country,
            CASE c_nationkey % 4 WHEN 0 THEN '+234 80' WHEN 1 THEN '1502' WHEN 2 THEN '07' ELSE '+44 7' END
            || CAST(10000000 + c_custkey * 7919 + CAST(floor(c_acctbal) AS BIGINT) AS VARCHAR) AS phone FROM customer)
"""


@query(
    "rule_valid_phone",
    f"""
    SELECT c_custkey, country, phone FROM (SELECT *, replace(phone, ' ', '') AS p FROM {PHONE_SQL})
    WHERE NOT CASE country
        WHEN 'NG' THEN regexp_matches(p, '^(\\+234|234|0)?(70|80|81|90|91)[0-9]{{8}}$')
        WHEN 'US' THEN regexp_matches(p, '^(\\+1|1)?[2-9][0-9]{{2}}[2-9][0-9]{{6}}$')
        ELSE regexp_matches(p, '^(\\+44|44|0)?(7[1-57-9][0-9]{{8}}|[12][0-9]{{8,9}}|3[0-9]{{9}})$') END
    """,
)
def rule_valid_phone(t: Tables):
    """Customers get made-up numbers in four styles; those against the plan are listed."""
    kind = F.col("c_nationkey") % 4
    country = F.when(kind == 0, "NG").when(kind == 1, "US").when(kind == 2, "UK").otherwise("GB")
    start = F.when(kind == 0, "+234 80").when(kind == 1, "1502").when(kind == 2, "07").otherwise("+44 7")
    digits = (F.lit(10000000) + F.col("c_custkey") * 7919 + F.floor("c_acctbal")).cast("long").cast("string")
    rows = t.customer.select("c_custkey", country.alias("country"), F.concat(start, digits).alias("phone"))
    return q.failing_rows(rows, q.valid_phone("phone", "country"))


def order_rules(t: Tables):
    return [
        q.not_null("o_orderkey"), q.not_null("o_orderdate"), q.in_set("o_orderstatus", ["O", "F"], mostly=0.6),
        q.between("o_totalprice", 1000, 400000, mostly=0.75), q.matches_regex("o_orderpriority", "^[1-5]-"),
        q.length_between("o_orderpriority", 5, 10), q.row_count_between(1, None), q.column_type("o_orderkey", "INTEGER"),
        q.unique("o_orderkey"), q.unique("o_custkey"), q.relationships("o_custkey", t.customer, "c_custkey"),
        q.custom_rule("priority_of_cheap_orders", ["o_totalprice", "o_orderpriority"],
                      lambda price, priority: (price >= 50000) | (priority != "1-URGENT")),
    ]


SUITE_SQL = union_sql(
    row_sql("not_null", "o_orderkey", "orders", "o_orderkey IS NULL", "TRUE"),
    row_sql("not_null", "o_orderdate", "orders", "o_orderdate IS NULL", "TRUE"),
    row_sql("in_set", "o_orderstatus", "orders", "o_orderstatus NOT IN ('O', 'F')", mostly=0.6),
    row_sql("between", "o_totalprice", "orders", "o_totalprice NOT BETWEEN 1000 AND 400000", mostly=0.75),
    row_sql("matches_regex", "o_orderpriority", "orders", "NOT regexp_matches(o_orderpriority, '^[1-5]-')"),
    row_sql("length_between", "o_orderpriority", "orders", "length(o_orderpriority) NOT BETWEEN 5 AND 10"),
    table_sql("row_count_between", "", "orders", "count(*) >= 1"),
    """SELECT 'column_type' AS rule, 'o_orderkey' AS "column", TRUE AS success, CAST(1 AS BIGINT) AS evaluated,
       CAST(0 AS BIGINT) AS failing, 0.0::DOUBLE AS percent""",
    unique_sql("o_orderkey", "orders"), unique_sql("o_custkey", "orders"),
    result_sql("relationships", "o_custkey", """SELECT 1 AS n, o_custkey IS NOT NULL AS judged,
        o_custkey NOT IN (SELECT c_custkey FROM customer) AS bad FROM orders"""),
    result_sql("priority_of_cheap_orders", "o_totalprice,o_orderpriority", """SELECT 1 AS n,
        o_totalprice IS NOT NULL AND o_orderpriority IS NOT NULL AS judged,
        NOT (o_totalprice >= 50000 OR o_orderpriority <> '1-URGENT') AS bad FROM orders"""),
)


@query("run_suite", SUITE_SQL)
def run_suite(t: Tables):
    return q.run_suite(t.orders, order_rules(t))


RUN = q.Run("orders", "orders_suite", "2024-02-01 06:00:00", regex_columns=["o_orderpriority"])


@query(
    "suite_summary",
    f"""
    SELECT '2024-02-01:06:00:00' AS run_time, 'orders' AS data_asset_name, 'orders_suite' AS expectation_suite_name,
           round(count(*) FILTER (success) * 100.0::DOUBLE / count(*), 3) AS success_percent,
           CAST(count(*) AS BIGINT) AS evaluated, CAST(count(*) FILTER (success) AS BIGINT) AS successful,
           CAST(count(*) FILTER (NOT success) AS BIGINT) AS unsuccessful, bool_and(success) AS success,
           CAST(count(*) FILTER (rule = 'not_null') AS BIGINT) AS not_null,
           CAST(count(*) FILTER (rule = 'unique') AS BIGINT) AS "unique",
           CAST(count(*) FILTER (rule = 'unique' AND success) AS BIGINT) AS unique_true,
           CAST(count(*) FILTER (rule = 'matches_regex' AND "column" = 'o_orderpriority' AND success) AS BIGINT) AS priority_true
    FROM ({SUITE_SQL})
    """,
)
def suite_summary(t: Tables):
    """The summary appended to a history table and read back."""
    path = fresh_path(t.spark, "suite-history")
    q.store_run(q.run_suite(t.orders, order_rules(t)), RUN, path)
    return t.spark.read.parquet(path).select(
        "run_time", "data_asset_name", "expectation_suite_name", "success_percent",
        F.col("evaluated_expectations").alias("evaluated"), F.col("successful_expectations").alias("successful"),
        F.col("unsuccessful_expectations").alias("unsuccessful"), "success",
        F.col("expectation_not_null").alias("not_null"), F.col("expectation_unique").alias("unique"),
        F.col("expectation_unique_true").alias("unique_true"),
        F.col("expectation_o_orderpriority_true").alias("priority_true"),
    )


NUMERIC = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
TEXT = ["l_returnflag", "l_linestatus"]


def profile_sql() -> str:
    numbers = [
        f"""SELECT '{c}' AS "column", count(*) AS n_rows, count(*) - count({c}) AS n_nulls, count(DISTINCT {c}) AS n_distinct,
            NULL::VARCHAR AS min_text, NULL::VARCHAR AS max_text, CAST(min({c}) AS DOUBLE) AS "min", CAST(max({c}) AS DOUBLE) AS "max",
            round(avg({c}), 5) AS mean, round(stddev(CAST({c} AS DOUBLE)), 5) AS sd, round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 6) AS q1,
            round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 6) AS median, round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 6) AS q3 FROM lineitem"""
        for c in NUMERIC
    ]
    words = [
        f"""SELECT '{c}', count(*), count(*) - count({c}), count(DISTINCT {c}), min({c}), max({c}),
            NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM lineitem"""
        for c in TEXT
    ]
    return union_sql(*numbers, *words)


@query("profile", profile_sql())
def profile(t: Tables):
    p = profiles.profile(t.lineitem, NUMERIC + TEXT)
    return p.select("column", "n_rows", "n_nulls", "n_distinct", "min_text", "max_text", "min", "max",
                    rounded("mean", 5).alias("mean"), rounded("sd", 5).alias("sd"), *[rounded(c).alias(c) for c in ("q1", "median", "q3")])


def suggest_sql() -> str:
    parts = []
    for c in ["o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", "o_orderpriority"]:
        number = c in ("o_orderkey", "o_custkey", "o_totalprice")
        empty = "NULL::DOUBLE AS minimum, NULL::DOUBLE AS maximum"
        parts.append(f"""SELECT '{c}' AS "column", 'not_null' AS rule, {empty}, NULL::VARCHAR AS "values" FROM orders HAVING count(*) = count({c})""")
        parts.append(f"""SELECT '{c}', 'unique', {empty}, NULL FROM orders HAVING count(*) = count(DISTINCT {c})""")
        if number:
            parts.append(f"SELECT '{c}', 'between', CAST(min({c}) AS DOUBLE), CAST(max({c}) AS DOUBLE), NULL FROM orders")
        else:
            parts.append(f"""SELECT '{c}', 'in_set', {empty}, string_agg(v, ',' ORDER BY v)
                FROM (SELECT DISTINCT {c} AS v FROM orders) HAVING count(*) <= 10""")
    return union_sql(*parts)


@query("suggest_rules", suggest_sql())
def suggest_rules(t: Tables):
    return profiles.suggest_rules(t.orders, exclude=["o_orderdate"])


PART_COLUMNS = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", "o_orderpriority"]


def parts_sql() -> str:
    out = []
    for c in PART_COLUMNS:
        number = c in PART_COLUMNS[:3]
        extremes = (f"CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max, NULL AS min_text, NULL AS max_text" if number
                    else f"NULL::DOUBLE AS min, NULL::DOUBLE AS max, min({c}) AS min_text, max({c}) AS max_text")
        mean = f"round(avg({c}), 2)" if number else "NULL::DOUBLE"
        out.append(f"""SELECT '{c}' AS "column", count(*) AS n_rows, count(*) - count({c}) AS n_nulls, {extremes}, {mean} AS mean,
                       count(DISTINCT {c}) AS n_distinct, TRUE AS distinct_close, {'TRUE' if number else 'NULL::BOOLEAN'} AS quartiles_close FROM orders""")
    return union_sql(*out)


@query("profile_of_parts", parts_sql())
def profile_of_parts(t: Tables):
    """Sketches per month, stored, of which one month arrives twice; the estimates are held against the exact numbers."""
    orders = t.orders.select(F.date_format("o_orderdate", "yyyy-MM").alias("month"), *PART_COLUMNS)
    path = fresh_path(t.spark, "profile-parts")
    parts = profiles.profile_parts(orders, "month")
    for load in (parts, parts.where("month = '1997-03'")):
        replace_partitions(load, path, "month")
    merged = profiles.profile_of_parts(t.spark.read.schema(parts.schema).parquet(path))
    exact = orders.agg(*[F.count_distinct(c).alias(c) for c in PART_COLUMNS]).unpivot([], PART_COLUMNS, "_c", "_exact")
    # the share of rows up to an estimated quartile lies within 3 % of it; one row per column
    numbers = PART_COLUMNS[:3]
    estimates = {r["column"]: (r.q1, r.median, r.q3) for r in merged.collect()}
    ranks = [F.abs(F.avg((F.col(c) <= q).cast("int")) - share) <= 0.03 for c in numbers for q, share in zip(estimates[c], (0.25, 0.5, 0.75))]
    close = orders.agg(*[(ranks[3 * k] & ranks[3 * k + 1] & ranks[3 * k + 2]).alias(c) for k, c in enumerate(numbers)]).unpivot([], numbers, "_n", "_close")
    return merged.join(exact, F.col("column") == F.col("_c")).join(close, F.col("column") == F.col("_n"), "left").select(
        "column", "n_rows", "n_nulls", "min", "max", "min_text", "max_text", rounded("mean", 2).alias("mean"), F.col("_exact").alias("n_distinct"),
        (F.abs(F.col("n_distinct") - F.col("_exact")) <= F.greatest(0.06 * F.col("_exact"), F.lit(1))).alias("distinct_close"), F.col("_close").alias("quartiles_close"),
    )
