"""Daily balances of customers: every order is a transaction and its total the new balance."""

from __future__ import annotations

from pyspark.sql import functions as F

from daybook.operators import balances
from daybook.plans.registry import Tables, cents, day_text, per_month, query

THROUGH = "2001-08-31"
EXCLUDED = ["P"]
ACCOUNT = {
    "keys": ["o_custkey"],
    "ts": "o_orderdate",
    "values": {"account_balance": "o_totalprice"},
    "tiebreak": ["o_orderkey"],
    "status": "o_orderstatus",
    "excluded": EXCLUDED,
}


@query(
    "last_event_per_day",
    """
    SELECT o_custkey, CAST(day AS VARCHAR) AS day, o_orderkey, o_totalprice, o_orderpriority
    FROM (SELECT *, CAST(o_orderdate AS DATE) AS day,
                 row_number() OVER (PARTITION BY o_custkey, CAST(o_orderdate AS DATE)
                                    ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
          FROM orders WHERE o_orderstatus NOT IN ('P'))
    WHERE rn = 1
    """,
)
def last_event_per_day(t: Tables):
    last = balances.last_event_per_day(
        t.orders, ["o_custkey"], "o_orderdate", ["o_orderkey"], "o_orderstatus", EXCLUDED
    )
    return last.select("o_custkey", day_text("day").alias("day"), "o_orderkey", "o_totalprice", "o_orderpriority")


@query(
    "first_event_per_day",
    """
    SELECT user_id, CAST(day AS VARCHAR) AS day, event_id, event_type
    FROM (SELECT *, CAST(ts AS DATE) AS day,
                 row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) AS rn
          FROM events)
    WHERE rn = 1
    """,
)
def first_event_per_day(t: Tables):
    first = balances.first_event_per_day(t.events, ["user_id"], "ts", ["event_id"])
    return first.select("user_id", day_text("day").alias("day"), "event_id", "event_type")


_SPINE_SQL = """
    WITH per_day AS (
        SELECT * FROM (
            SELECT o_custkey, CAST(o_orderdate AS DATE) AS balance_date, o_totalprice, o_orderdate,
                   row_number() OVER (PARTITION BY o_custkey, CAST(o_orderdate AS DATE)
                                      ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
            FROM orders WHERE o_orderstatus NOT IN ('P'))
        WHERE rn = 1),
    calendar AS (
        SELECT CAST(d AS DATE) AS date
        FROM generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-08-31', INTERVAL 1 DAY) AS g(d)),
    starts AS (SELECT o_custkey, min(balance_date) AS start_date FROM per_day GROUP BY o_custkey),
    spine AS (SELECT s.o_custkey, c.date FROM starts s JOIN calendar c ON s.start_date <= c.date),
    numbered AS (
        SELECT s.o_custkey, s.date, p.o_totalprice, p.o_orderdate,
               count(p.o_orderdate) OVER (PARTITION BY s.o_custkey ORDER BY s.date) AS grp
        FROM spine s LEFT JOIN per_day p ON p.o_custkey = s.o_custkey AND p.balance_date = s.date),
    filled AS (
        SELECT o_custkey, date,
               max(o_totalprice) OVER (PARTITION BY o_custkey, grp) AS account_balance,
               max(o_orderdate) OVER (PARTITION BY o_custkey, grp) AS latest_trans_at
        FROM numbered)
"""


@query(
    "daily_balance",
    _SPINE_SQL
    + """
    SELECT o_custkey, strftime(date, '%Y-%m') AS month, CAST(count(*) AS BIGINT) AS days,
           CAST(sum(CAST(account_balance AS DECIMAL(18,2))) AS DOUBLE) AS sum_balance,
           arg_max(account_balance, date) AS closing_balance,
           CAST(max(CAST(latest_trans_at AS DATE)) AS VARCHAR) AS latest_trans
    FROM filled GROUP BY ALL
    """,
)
def daily_balance(t: Tables):
    """The dense table reported per customer and month (all its rows are used)."""
    dense = balances.daily_balance(t.orders, through=THROUGH, **ACCOUNT)
    return per_month(
        dense, ["o_custkey"], "date", F.count("*").alias("days"), cents("account_balance").alias("sum_balance"),
        F.max_by("account_balance", "date").alias("closing_balance"),
        day_text(F.max("latest_trans_at")).alias("latest_trans"),
    )


@query(
    "daily_balance_from_start",
    _SPINE_SQL
    + """
    SELECT CAST(date AS VARCHAR) AS date, CAST(count(*) AS BIGINT) AS clients,
           CAST(sum(CAST(account_balance AS DECIMAL(18,2))) AS DOUBLE) AS total_balance,
           CAST(min(CAST(latest_trans_at AS DATE)) AS VARCHAR) AS oldest_trans
    FROM filled WHERE date >= DATE '1997-01-01' GROUP BY date
    """,
)
def daily_balance_from_start(t: Tables):
    """Total balance per day with a calendar that starts after the first events."""
    dense = balances.daily_balance(t.orders, through=THROUGH, start="1997-01-01", **ACCOUNT)
    per_day = dense.groupBy("date").agg(
        F.count("*").alias("clients"),
        cents("account_balance").alias("total_balance"),
        day_text(F.min("latest_trans_at")).alias("oldest_trans"),
    )
    return per_day.withColumn("date", day_text("date"))


@query(
    "daily_balance_incremental",
    """
    SELECT '2001-08-31' AS date, o_custkey, o_totalprice AS account_balance,
           CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS latest_trans
    FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
          FROM orders WHERE o_orderstatus NOT IN ('P'))
    WHERE rn = 1
    """,
)
def daily_balance_incremental(t: Tables):
    latest = balances.daily_balance_incremental(t.orders, as_of="2001-09-01", **ACCOUNT)
    return latest.select(
        day_text("date").alias("date"), "o_custkey", "account_balance",
        day_text("latest_trans_at").alias("latest_trans"),
    )


@query(
    "balance_as_of",
    """
    SELECT o_custkey, o_totalprice AS account_balance,
           CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS latest_trans
    FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
          FROM orders WHERE o_orderstatus NOT IN ('P') AND CAST(o_orderdate AS DATE) <= DATE '1998-06-30')
    WHERE rn = 1
    """,
)
def balance_as_of(t: Tables):
    known = balances.balance_as_of(t.orders, day="1998-06-30", **ACCOUNT)
    return known.select("o_custkey", "account_balance", day_text("latest_trans_at").alias("latest_trans"))


@query(
    "balances_as_of",
    """
    WITH daily AS (
        SELECT o_custkey, CAST(o_orderdate AS DATE) AS day, arg_max(o_totalprice, o_orderkey) AS balance
        FROM orders WHERE o_orderstatus <> 'P' GROUP BY ALL),
    probes AS (SELECT DISTINCT o_custkey, CAST(o_orderdate AS DATE) - 1 AS day FROM orders)
    SELECT CAST(p.day AS VARCHAR) AS date, p.o_custkey, balance AS account_balance, CAST(d.day AS VARCHAR) AS latest_trans
    FROM probes p ASOF JOIN daily d ON d.o_custkey = p.o_custkey AND d.day <= p.day
    """,
)
def balances_as_of(t: Tables):
    """The balance of every customer on the day before each of its orders, in one pass."""
    probes = t.orders.select("o_custkey", F.date_sub("o_orderdate", 1).alias("date"))
    known = balances.balances_as_of(t.orders, probes, **ACCOUNT)
    return known.select(day_text("date").alias("date"), "o_custkey", "account_balance", day_text("latest_trans_at").alias("latest_trans"))
