"""Histories of customers by order year, and activity of users and event types."""

from __future__ import annotations

from pyspark.sql import functions as F

from daybook.operators import activity, history
from daybook.plans.registry import Tables, day_text, days_text, numbers_text, query

LAST_YEAR = 2001


def rated_orders(t: Tables):
    """Orders as rated events: the rating is the order total in units of 50,000, one decimal."""
    return t.orders.select(
        F.col("o_custkey").alias("actor_id"),
        F.year("o_orderdate").alias("year"),
        F.col("o_orderkey").alias("filmid"),
        F.col("o_orderpriority").alias("film"),
        F.floor(F.col("o_totalprice") / 5000).cast("long").alias("votes"),
        (F.floor(F.col("o_totalprice") / 5000) / 10).alias("rating"),
    )


def yearly(t: Tables):
    return history.period_summary(rated_orders(t), ["actor_id"], "year", "rating", LAST_YEAR)


_YEARLY_SQL = """
    WITH rated AS (
        SELECT o_custkey AS actor_id, CAST(year(o_orderdate) AS INT) AS year, o_orderkey AS filmid,
               o_orderpriority AS film, CAST(floor(o_totalprice / 5000) AS BIGINT) AS tenths
        FROM orders),
    means AS (
        SELECT actor_id, year, CAST((2 * sum(tenths) + count(*)) // (2 * count(*)) AS BIGINT) AS mean_tenths
        FROM rated GROUP BY ALL),
    spine AS (
        SELECT s.actor_id, CAST(y AS INT) AS year
        FROM (SELECT actor_id, min(year) AS first_year FROM rated GROUP BY actor_id) s
        JOIN generate_series(1990, 2001) AS g(y) ON s.first_year <= y),
    numbered AS (
        SELECT s.actor_id, s.year, m.mean_tenths, m.year AS active_year,
               count(m.year) OVER (PARTITION BY s.actor_id ORDER BY s.year) AS grp
        FROM spine s LEFT JOIN means m ON m.actor_id = s.actor_id AND m.year = s.year),
    held AS (
        SELECT actor_id, year, max(mean_tenths) OVER (PARTITION BY actor_id, grp) AS tenths,
               max(active_year) OVER (PARTITION BY actor_id, grp) AS active_year
        FROM numbered),
    actors AS (
        SELECT actor_id, year,
               CASE WHEN tenths > 80 THEN 'Star' WHEN tenths > 70 THEN 'Good'
                    WHEN tenths > 60 THEN 'Average' ELSE 'Bad' END AS quality_class,
               CAST(year - active_year AS INT) AS years_since_last_active, year = active_year AS is_active
        FROM held)
"""


@query(
    "cumulative_history",
    _YEARLY_SQL
    + """
    SELECT a.actor_id, a.year, a.quality_class, a.years_since_last_active, a.is_active,
           CAST(count(*) AS BIGINT) AS n_films,
           string_agg(r.year || ':' || r.filmid || ':' || r.film || ':' || r.tenths, ',' ORDER BY r.year, r.filmid)
               AS films
    FROM actors a JOIN rated r ON r.actor_id = a.actor_id AND r.year <= a.year
    GROUP BY ALL
    """,
)
def cumulative_history(t: Tables):
    grown = history.cumulative_history(
        rated_orders(t), ["actor_id"], "year", ["year", "film", "votes", "rating", "filmid"], "filmid",
        "rating", LAST_YEAR,
    )
    shown = F.transform("films", lambda x: F.concat_ws(":", x["year"], x["filmid"], x["film"], x["votes"]))
    return grown.select(
        "actor_id", "year", "quality_class", "years_since_last_active", "is_active",
        F.size("films").cast("long").alias("n_films"), F.array_join(shown, ",").alias("films"),
    )


_SCD_SQL = (
    _YEARLY_SQL
    + """,
    flagged AS (
        SELECT *, CASE WHEN quality_class <> lag(quality_class) OVER w THEN 1
                       WHEN is_active <> lag(is_active) OVER w THEN 1 ELSE 0 END AS changed
        FROM actors WHERE year <= {upto} WINDOW w AS (PARTITION BY actor_id ORDER BY year)),
    streaks AS (
        SELECT *, sum(changed) OVER (PARTITION BY actor_id ORDER BY year) AS streak_identifier FROM flagged)
    SELECT actor_id, quality_class, is_active, CAST(streak_identifier AS BIGINT) AS streak_identifier,
           min(year) AS start_date, max(year) AS end_date, {upto} AS current_year
    FROM streaks GROUP BY actor_id, quality_class, is_active, streak_identifier
    """
)


@query("scd2_backfill", _SCD_SQL.format(upto=2000))
def scd2_backfill(t: Tables):
    return history.scd2_backfill(yearly(t), ["actor_id"], "year", ["quality_class", "is_active"], 2000)


@query("scd2_incremental", _SCD_SQL.format(upto=2001))
def scd2_incremental(t: Tables):
    """History through 2000 advanced by the rows of 2001; must equal a backfill through 2001."""
    actors = yearly(t)
    tracked = ["quality_class", "is_active"]
    before = history.scd2_backfill(actors, ["actor_id"], "year", tracked, 2000)
    return history.scd2_incremental(before, actors, ["actor_id"], "year", tracked, 2001)


START, END = "2024-01-01", "2024-01-31"


def device_days(t: Tables):
    devices = t.events.select("event_type", F.upper("event_type").alias("browser_type"), "props")
    return activity.device_activity(t.events, devices, "user_id", "event_type", "browser_type", "ts", START, END)


_DATELIST_SQL = """
    WITH active AS (SELECT DISTINCT {keys}, CAST(ts AS DATE) AS day FROM events),
    calendar AS (SELECT CAST(d AS DATE) AS date
                 FROM generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-31', INTERVAL 1 DAY) AS g(d)),
    spine AS (SELECT {keys}, date FROM (SELECT {keys}, min(day) AS first FROM active GROUP BY ALL)
              JOIN calendar ON first <= date)
    SELECT {shown}, CAST(s.date AS VARCHAR) AS date,
           string_agg(CAST(a.day AS VARCHAR), ',' ORDER BY a.day) AS datelist
    FROM spine s JOIN active a ON {on} AND a.day <= s.date
    GROUP BY ALL
"""


@query(
    "activity_datelist_device",
    _DATELIST_SQL.format(
        keys="user_id, event_type",
        shown="s.user_id, s.event_type, upper(s.event_type) AS browser_type",
        on="a.user_id = s.user_id AND a.event_type = s.event_type",
    ),
)
def activity_datelist_device(t: Tables):
    return device_days(t).select(
        "user_id", "event_type", "browser_type", day_text("date").alias("date"),
        days_text("device_activity_datelist").alias("datelist"),
    )


@query(
    "activity_datelist_host",
    _DATELIST_SQL.format(keys="event_type", shown="s.event_type", on="a.event_type = s.event_type"),
)
def activity_datelist_host(t: Tables):
    dense = activity.activity_datelist(t.events, ["event_type"], "ts", START, END)
    return dense.select("event_type", day_text("date").alias("date"), days_text("activity_datelist").alias("datelist"))


@query(
    "datelist_to_bitmask",
    """
    SELECT user_id, event_type, CAST(sum(1 << (31 - age)) AS BIGINT) AS datelist_int,
           CAST(count(*) AS BIGINT) AS active_days
    FROM (SELECT DISTINCT user_id, event_type, CAST(date_diff('day', CAST(ts AS DATE), DATE '2024-01-31') AS BIGINT) AS age
          FROM events)
    WHERE age BETWEEN 0 AND 31
    GROUP BY user_id, event_type
    """,
)
def datelist_to_bitmask(t: Tables):
    last = device_days(t).where(F.col("date") == F.lit(END).cast("date"))
    mask = activity.datelist_to_bitmask(last, ["user_id", "event_type"], "device_activity_datelist", END)
    return mask.drop("datelist_bits")


@query(
    "monthly_activity_arrays",
    """
    WITH hits AS (SELECT DISTINCT event_type, user_id, ts, CAST(ts AS DATE) AS day FROM events
                  WHERE user_id IS NOT NULL AND ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-02-01'),
    spine AS (SELECT event_type, CAST(d AS DATE) AS day
              FROM (SELECT event_type, min(day) AS first FROM hits GROUP BY event_type)
              JOIN generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-31', INTERVAL 1 DAY) AS g(d) ON d >= first),
    per_day AS (SELECT s.event_type, s.day, count(h.user_id) AS n, count(DISTINCT h.user_id) AS u
                FROM spine s LEFT JOIN hits h ON h.event_type = s.event_type AND h.day = s.day GROUP BY ALL)
    SELECT '2024-01' AS month, 'Jan' AS month_name, event_type,
           string_agg(CAST(n AS VARCHAR), ',' ORDER BY day) AS hit_array,
           string_agg(CAST(u AS VARCHAR), ',' ORDER BY day) AS unique_visitors_array
    FROM per_day GROUP BY event_type
    """,
)
def monthly_activity_arrays(t: Tables):
    arrays = activity.monthly_activity_arrays(t.events, ["event_type"], "user_id", "ts", START)
    return arrays.select(
        "month", "month_name", "event_type", numbers_text("hit_array").alias("hit_array"),
        numbers_text("unique_visitors_array").alias("unique_visitors_array"),
    )
