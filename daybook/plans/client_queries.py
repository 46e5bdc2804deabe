"""Client features, segments and models over customers, orders, events and labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.functions.dates import age_months as months_between_days
from daybook.operators import attributes, clients, models, segments
from daybook.plans.registry import Tables, cents, query, rounded
from daybook.session import fresh_path
from daybook.sources.tables import full_refresh

AS_OF = "2001-09-01"
SHIFT_DAYS = 8400  # brings the events of 2024 into 2001


def client_dimension(t: Tables):
    nation = F.col("c_nationkey")
    kind = F.when(nation % 10 == 0, None).when(nation % 2 == 1, "Business").otherwise("Personal")
    return t.customer.select(
        F.col("c_custkey").alias("id"), F.concat(F.lit("C"), "c_custkey").alias("client_id"),
        F.col("c_mktsegment").alias("client_type"), kind.alias("user_type"),
        F.date_add(F.lit("1993-01-01").cast("date"), (F.col("c_custkey") * 37 % 700).cast("int")).alias("created"),
    )


def features(t: Tables):
    trades = t.orders.select(
        F.concat(F.lit("C"), "o_custkey").alias("client_id"), F.col("o_orderdate").alias("trade_timestamp"),
        F.col("o_orderkey").alias("record_id"), F.when(F.col("o_orderstatus") == "F", "Acquire").otherwise("Release").alias("transaction_type"),
        F.col("o_totalprice").alias("adjusted_order_value"),
        F.when(F.col("o_orderstatus") == "P", "Open").otherwise("Reconciled").alias("trade_status_summary"),
        F.when(F.col("o_orderpriority") == "5-LOW", "X9").when(F.col("o_orderpriority") == "1-URGENT", "X4").alias("system_name"),
    )
    loans = t.orders.where("o_orderstatus = 'P'").select(
        F.col("o_custkey").alias("client_id"), F.col("o_totalprice").alias("loan_value"),
        F.col("o_orderkey").alias("transaction_id"), F.col("o_orderdate").alias("deal_timestamp"),
    )
    kind = F.col("event_type")
    moves = t.events.select(
        F.col("user_id").alias("client_id"), (F.col("ts") - F.expr(f"INTERVAL {SHIFT_DAYS} DAYS")).alias("created"),
        F.col("value").alias("amount"),
        F.when(kind == "purchase", "Funding").when(kind.isin("error", "click"), "PayoutRequest").otherwise("Other").alias("transaction_origin"),
        F.when(kind == "click", "Pending").otherwise("Cleared Debit").alias("transaction_type"),
    )
    wallets = t.customer.select(
        F.concat(F.lit("C"), "c_custkey").alias("client_id"), F.col("c_acctbal").alias("available_balance"),
        F.lit(0.0).alias("cash_advance_balance"), F.lit("NXMARKET").alias("system_name"),
        F.when(F.col("c_nationkey") < 20, "USD").otherwise("EUR").alias("payment_currency"),
    )
    return clients.rfmt_features(client_dimension(t), trades, loans, moves, wallets, AS_OF)


def _months(end: str, start: str) -> str:
    a = f"age(CAST({end} AS TIMESTAMP), CAST({start} AS TIMESTAMP))"
    return f"CAST(extract(year FROM {a}) * 12 + extract(month FROM {a}) AS BIGINT)"


NOW = "TIMESTAMP '2001-09-01'"
FEATURE_SQL = f"""
    WITH dim AS (
        SELECT c_custkey, 'C' || c_custkey AS client_id, c_mktsegment AS client_type, c_nationkey, c_acctbal,
               CASE WHEN c_nationkey % 10 = 0 THEN NULL WHEN c_nationkey % 2 = 1 THEN 'Business' ELSE 'Personal' END AS user_type,
               DATE '1993-01-01' + CAST(c_custkey * 37 % 700 AS INT) AS created FROM customer),
    trades AS (
        SELECT o_custkey, count(*) AS trade_freq, count(*) FILTER (o_orderdate >= {NOW} - INTERVAL 90 DAY) AS last90days_trade_freq,
               count(*) FILTER (o_orderstatus = 'F') AS buy_trade_freq, count(*) FILTER (o_orderstatus = 'O') AS sell_trade_freq,
               CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS trade_value,
               {_months(NOW, 'max(o_orderdate)')} AS trade_recency_months, {_months(NOW, 'min(o_orderdate)')} AS trade_tenure_months
        FROM orders WHERE o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW' GROUP BY o_custkey),
    loans AS (
        SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS loan_value_collected, count(DISTINCT o_orderkey) AS loan_freq,
               {_months(NOW, 'min(o_orderdate)')} AS loan_tenure_months, {_months(NOW, 'max(o_orderdate)')} AS loan_recency_months
        FROM orders WHERE o_orderstatus = 'P' GROUP BY o_custkey),
    shifted AS (SELECT user_id, value, event_type, ts - INTERVAL {SHIFT_DAYS} DAY AS created FROM events WHERE event_type IN ('purchase', 'error')),
    moves AS (
        SELECT user_id,
               round(sum(value) FILTER (event_type = 'purchase'), 4) AS deposit_amount, count(*) FILTER (event_type = 'purchase') AS deposit_freq,
               count(*) FILTER (event_type = 'purchase' AND CAST(created AS DATE) >= DATE '2001-09-01' - 90) AS last90days_deposit_freq,
               {_months(NOW, "min(created) FILTER (event_type = 'purchase')")} AS deposit_tenure_months,
               {_months(NOW, "max(created) FILTER (event_type = 'purchase')")} AS deposit_recency_months,
               round(sum(value) FILTER (event_type = 'error'), 4) AS withdrawal_amount, count(*) FILTER (event_type = 'error') AS withdrawal_freq,
               count(*) FILTER (event_type = 'error' AND CAST(created AS DATE) >= DATE '2001-09-01' - 90) AS last90days_withdrawal_freq,
               {_months(NOW, "min(created) FILTER (event_type = 'error')")} AS withdrawal_tenure_months,
               {_months(NOW, "max(created) FILTER (event_type = 'error')")} AS withdrawal_recency_months
        FROM shifted GROUP BY user_id),
    features AS (
        SELECT client_id, client_type, user_type, {_months(NOW, 'created')} AS client_tenure_months,
               trade_freq, last90days_trade_freq, buy_trade_freq, sell_trade_freq, trade_recency_months, trade_tenure_months, trade_value,
               CASE WHEN c_nationkey < 20 THEN c_acctbal END AS available_balance, CASE WHEN c_nationkey < 20 THEN 0.0::DOUBLE END AS cash_advance_balance,
               deposit_freq, last90days_deposit_freq, deposit_recency_months, deposit_tenure_months, deposit_amount,
               withdrawal_freq, last90days_withdrawal_freq, withdrawal_recency_months, withdrawal_tenure_months, withdrawal_amount,
               loan_freq, loan_recency_months, loan_tenure_months, loan_value_collected
        FROM dim LEFT JOIN trades t ON t.o_custkey = dim.c_custkey LEFT JOIN moves m ON m.user_id = dim.c_custkey
        LEFT JOIN loans l ON l.o_custkey = dim.c_custkey)
"""
MONEY = {"trade_value": 2, "loan_value_collected": 2, "deposit_amount": 4, "withdrawal_amount": 4}


def shown_features(df):
    return df.select(*[rounded(c, MONEY[c]).alias(c) if c in MONEY else c for c in df.columns])


@query("rfmt_features", FEATURE_SQL + "SELECT * FROM features")
def rfmt_features(t: Tables):
    return shown_features(features(t))


@query(
    "age_months",
    f"""
    SELECT o_orderkey, {_months("TIMESTAMP '2001-02-28 12:00:00'", 'o_orderdate')} AS months_to_february,
           {_months("TIMESTAMP '1996-03-30'", 'o_orderdate')} AS months_to_march
    FROM orders
    """,
)
def age_months(t: Tables):
    at = lambda s: F.lit(s).cast("timestamp")
    return t.orders.select(
        "o_orderkey", months_between_days(at("2001-02-28 12:00:00"), F.col("o_orderdate")).alias("months_to_february"),
        months_between_days(at("1996-03-30"), F.col("o_orderdate")).alias("months_to_march"),
    )


def summary(t: Tables):
    """Purchase summaries with two rows for some clients and missing values."""
    per_client = t.orders.groupBy(F.col("o_custkey").alias("client_id")).agg(
        F.max("o_orderdate").alias("last"), F.count("*").alias("purchase_count"), cents("o_totalprice").alias("spent")
    )
    odd = F.col("purchase_count") % 7 == 0
    rows = per_client.select(
        F.lit(1).alias("version"), "client_id", F.when(~odd, F.col("last")).alias("last_purchase_date"), "purchase_count",
        F.when(~odd, F.col("spent")).alias("total_spent"), (F.col("client_id") % 60).alias("tenure"),
    )
    return rows.unionByName(rows.where("client_id % 3 = 0").withColumns({"version": F.lit(2), "total_spent": F.lit(-1.0)}))


@query(
    "rfmt_simple",
    """
    SELECT o_custkey AS client_id, CASE WHEN n % 7 <> 0 THEN CAST(date_diff('day', CAST(last AS DATE), DATE '2001-09-01') AS BIGINT) END AS recency,
           n AS frequency, CASE WHEN n % 7 <> 0 THEN spent ELSE 0.0::DOUBLE END AS monetary, o_custkey % 60 AS tenure
    FROM (SELECT o_custkey, max(o_orderdate) AS last, CAST(count(*) AS BIGINT) AS n,
                 CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS spent FROM orders GROUP BY o_custkey)
    """,
)
def rfmt_simple(t: Tables):
    simple = clients.rfmt_simple(summary(t), AS_OF, ["version"])
    return simple.withColumn("recency", F.col("recency").cast("long"))


OUTLIERS = ["C7", "C11"]


def matrix(t: Tables, user_type: str | None = "Business"):
    rows = features(t).withColumn("version", F.lit(1))
    doubled = rows.unionByName(rows.where("trade_freq % 2 = 0").withColumns({"version": F.lit(2), "trade_freq": F.lit(0).cast("long")}))
    return clients.prepare_matrix(doubled, user_type=user_type, outliers=OUTLIERS, order=["version"]).drop("version")


_FILLED = ", ".join(f"coalesce({c}, 0) AS {c}" for c in clients.RFMT_COLUMNS)
MATRIX_SQL = FEATURE_SQL + f""",
    matrix AS (SELECT client_id, client_type, user_type, {_FILLED} FROM features
               WHERE user_type = 'Business' AND client_id NOT IN ('C7', 'C11'))
"""


@query("prepare_matrix", MATRIX_SQL + "SELECT * FROM matrix")
def prepare_matrix(t: Tables):
    return shown_features(matrix(t))


SCALED = ["trade_value", "available_balance", "deposit_amount", "loan_freq"]
_LOGS = ", ".join(f"CASE WHEN {c} > 0 THEN ln({c}) ELSE 0 END AS {c}" for c in SCALED)
_SCALES = ", ".join(f"round(({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER (), 6) + 0.0 AS {c}" for c in SCALED)


@query("log_scale", MATRIX_SQL + f", logs AS (SELECT client_id, {_LOGS} FROM matrix) SELECT client_id, {_SCALES} FROM logs")
def log_scale(t: Tables):
    scaled = clients.log_scale(matrix(t).select("client_id", *SCALED), SCALED)
    return scaled.select("client_id", *[rounded(c).alias(c) for c in SCALED])


def clustered(t: Tables):
    """All clients of known type, in three clusters by fixed limits of the balance."""
    balance = F.col("available_balance")
    cluster = F.when(balance < 2000, 0).when(balance < 6000, 1).otherwise(2)
    return matrix(t, None).withColumn("cluster", cluster)


PROFILED = ["trade_value", "trade_freq", "available_balance", "loan_freq"]
CLUSTER_SQL = FEATURE_SQL + f""",
    clustered AS (
        SELECT *, CASE WHEN available_balance < 2000 THEN 0 WHEN available_balance < 6000 THEN 1 ELSE 2 END AS cluster
        FROM (SELECT client_id, client_type, user_type, {_FILLED} FROM features WHERE user_type IS NOT NULL AND client_id NOT IN ('C7', 'C11'))),
    long AS ({" UNION ALL ".join(f"SELECT client_id, cluster, user_type, client_type, '{c}' AS attribute, CAST({c} AS DOUBLE) AS value FROM clustered" for c in PROFILED)})
"""


@query(
    "cluster_profile",
    CLUSTER_SQL
    + """
    SELECT cluster, attribute, count(value) AS clients, round(avg(value), 4) AS mean, round(sum(value), 2) AS total,
           round(quantile_cont(value, 0.25), 4) AS q1, round(quantile_cont(value, 0.5), 4) AS q2, round(quantile_cont(value, 0.75), 4) AS q3
    FROM long GROUP BY ALL
    """,
)
def cluster_profile(t: Tables):
    p = segments.cluster_profile(clustered(t), "cluster", PROFILED)
    return p.select("cluster", "attribute", "clients", rounded("mean", 4).alias("mean"), rounded("total", 2).alias("total"),
                    *[rounded(c, 4).alias(c) for c in ("q1", "q2", "q3")])


@query("cluster_sizes", CLUSTER_SQL + "SELECT cluster, user_type, client_type, count(*) AS clients FROM clustered GROUP BY ALL")
def cluster_sizes(t: Tables):
    return segments.cluster_sizes(clustered(t), "cluster", ["user_type", "client_type"])


@query(
    "cluster_means_wide",
    CLUSTER_SQL
    + """
    SELECT attribute, round(avg(value) FILTER (cluster = 0), 4) AS c0, round(avg(value) FILTER (cluster = 1), 4) AS c1,
           round(avg(value) FILTER (cluster = 2), 4) AS c2 FROM long GROUP BY attribute
    """,
)
def cluster_means_wide(t: Tables):
    wide = segments.cluster_means_wide(clustered(t), "cluster", PROFILED, [0, 1, 2])
    return wide.select("attribute", *[rounded(F.col(str(i)), 4).alias(f"c{i}") for i in range(3)])


@query(
    "relative_importance",
    CLUSTER_SQL
    + """
    SELECT cluster, l.attribute, round(avg(value) / any_value(m) - 1, 6) AS importance
    FROM long l JOIN (SELECT attribute, avg(value) AS m FROM long GROUP BY attribute) p ON p.attribute = l.attribute
    GROUP BY cluster, l.attribute
    """,
)
def relative_importance(t: Tables):
    importance = segments.relative_importance(clustered(t), "cluster", PROFILED)
    return importance.withColumn("importance", rounded("importance"))


@query("melt_profile", CLUSTER_SQL + "SELECT client_id, cluster, attribute, round(value, 2) AS value FROM long")
def melt_profile(t: Tables):
    long = segments.melt_profile(clustered(t), ["client_id", "cluster"], PROFILED)
    return long.withColumn("value", rounded("value", 2))


@query(
    "label_segments",
    CLUSTER_SQL
    + """,
    ranked AS (SELECT cluster, row_number() OVER (ORDER BY avg(trade_value), cluster) AS r FROM clustered GROUP BY cluster)
    SELECT client_id, CASE r WHEN 1 THEN 'Low Value Individual' WHEN 2 THEN 'Mid Value Individual' ELSE 'High Value Individual' END AS segment
    FROM clustered JOIN ranked USING (cluster)
    """,
)
def label_segments(t: Tables):
    """Named clusters, exported as CSV and read back."""
    named = segments.label_segments(clustered(t), "cluster", "trade_value")
    path = fresh_path(t.spark, "segments")
    segments.export_segments(named, path, ["client_id", "segment"])
    return t.spark.read.option("header", "true").csv(path)


ALL_SCALED = ["client_tenure_months", "trade_freq", "trade_recency_months", "trade_value", "available_balance", "loan_freq",
              "loan_value_collected"]


def scaled_matrix(t: Tables):
    return clients.log_scale(matrix(t, None).select("client_id", "user_type", "client_type", *ALL_SCALED), ALL_SCALED)


@query("kmeans_segments")
def kmeans_segments(t: Tables):
    labelled, _ = segments.kmeans_segments(scaled_matrix(t), ALL_SCALED, 3)
    return labelled.groupBy("cluster").agg(F.count("*").alias("clients"))


@query("kmeans_centroids")
def kmeans_centroids(t: Tables):
    return segments.kmeans_segments(scaled_matrix(t), ALL_SCALED, 4)[1]


@query("elbow")
def elbow(t: Tables):
    return segments.elbow(scaled_matrix(t), ALL_SCALED)


#: Centroids on the diagonal, evenly spaced from -1 to 1, for 1 to 4 clusters.
DIAGONAL = {k: [0.0] if k == 1 else [2 * i / (k - 1) - 1 for i in range(k)] for k in range(1, 5)}
_SCALED_ALL = ", ".join(f"(l_{c} - avg(l_{c}) OVER ()) / stddev_pop(l_{c}) OVER () AS {c}" for c in SCALED)


def errors_sql() -> str:
    logs = ", ".join(f"CASE WHEN {c} > 0 THEN ln({c}) ELSE 0 END AS l_{c}" for c in SCALED)
    distance = lambda v: "(" + " + ".join(f"({c} - ({v!r}::DOUBLE)) * ({c} - ({v!r}::DOUBLE))" for c in SCALED) + ")"
    sums = " UNION ALL ".join(f"SELECT {k} AS k, round(sum(least({', '.join(map(distance, c))})), 4) AS sse FROM scaled" for k, c in DIAGONAL.items())
    return MATRIX_SQL + f", logs AS (SELECT {logs} FROM matrix), scaled AS (SELECT {_SCALED_ALL} FROM logs) {sums}"


@query("squared_errors", errors_sql())
def squared_errors(t: Tables):
    """Errors of given centroids, as the elbow sums them for fitted ones."""
    scaled = clients.log_scale(matrix(t).select("client_id", *SCALED), SCALED)
    found = segments.squared_errors(scaled, SCALED, {k: [[v] * len(SCALED) for v in c] for k, c in DIAGONAL.items()})
    return found.select("k", rounded("sse", 4).alias("sse"))


def demographics(t: Tables):
    """Demographics of customers with pages as company websites; some values are missing or unreadable."""
    key = F.col("c_custkey")
    day = F.date_add(F.lit("1980-01-01").cast("date"), (key * 13 % 7000).cast("int"))
    founded = F.when(key % 9 == 0, "unknown").when(key % 11 != 0, F.date_format(day, "dd/MM/yyyy"))
    code = F.when(key % 3 == 0, F.concat(F.lit("COMX"), "c_nationkey")).when(key % 3 == 1, F.concat(F.lit("X"), "c_nationkey"))
    return t.customer.join(t.pages.select("page_id", "url"), key == F.col("page_id"), "left").select(
        F.col("c_custkey").alias("client_id"), F.col("url").alias("company_website"), code.alias("used_referral_code"),
        founded.alias("date_of_incorporation"), F.when(key % 13 != 0, F.col("c_mktsegment")).alias("nature_of_business"),
        F.concat(F.lit("NATION_"), "c_nationkey").alias("country"), F.when(key % 17 != 0, F.col("c_acctbal")).alias("income"),
        F.date_add(F.lit("2020-01-01").cast("date"), (key * 37 % 2000).cast("int")).cast("timestamp").alias("created"),
    )


def cluster_labels(t: Tables):
    name = F.when(F.col("c_acctbal") < 2000, "Low Value Individual").when(F.col("c_acctbal") < 6000, "Mid Value Individual")
    return t.customer.select(F.col("c_custkey").alias("client_id"), name.otherwise("High Value Individual").alias("predicted_cluster"))


def described_clients(t: Tables):
    return attributes.client_attributes(cluster_labels(t), demographics(t), "2024-01-01")


DEMOGRAPHIC_SQL = r"""
    WITH demo AS (
        SELECT c_custkey AS client_id, url, c_nationkey, CASE WHEN c_custkey % 13 <> 0 THEN c_mktsegment END AS nature_of_business,
               'NATION_' || c_nationkey AS country, CASE WHEN c_custkey % 17 <> 0 THEN c_acctbal END AS income,
               CASE WHEN c_custkey % 3 = 0 THEN 'COMX' || c_nationkey WHEN c_custkey % 3 = 1 THEN 'X' || c_nationkey END AS code,
               CASE WHEN c_custkey % 9 <> 0 AND c_custkey % 11 <> 0 THEN DATE '1980-01-01' + CAST(c_custkey * 13 % 7000 AS INT) END AS founded,
               DATE '2020-01-01' + CAST(c_custkey * 37 % 2000 AS INT) AS created,
               CASE WHEN c_acctbal < 2000 THEN 'Low Value Individual' WHEN c_acctbal < 6000 THEN 'Mid Value Individual'
                    ELSE 'High Value Individual' END AS predicted_cluster
        FROM customer LEFT JOIN pages ON c_custkey = page_id),
    described AS (
        SELECT *, CASE WHEN coalesce(regexp_matches(url, '^(http[s]?://|www)[^\s]+[.]\w{2,}[/]?$'), FALSE) THEN 'has website'
                       ELSE 'does not have website' END AS has_website,
               CASE WHEN coalesce(code LIKE 'COMX%', FALSE) THEN 'referred' ELSE 'not referred' END AS is_referred,
               round(date_diff('day', founded, DATE '2024-01-01') * 86400 / 31557600.0::DOUBLE, 2) AS age
        FROM demo)
"""


@query(
    "client_attributes",
    DEMOGRAPHIC_SQL
    + """
    SELECT client_id, predicted_cluster, has_website, is_referred, age, year(created) AS created_year, month(created) AS created_month,
           isodow(created) - 1 AS created_dayofweek, day(created) AS created_dayofmonth FROM described
    """,
)
def client_attributes(t: Tables):
    return described_clients(t).select(
        "client_id", "predicted_cluster", "has_website", "is_referred", "age",
        *[F.col(c).cast("long").alias(c) for c in ("created_year", "created_month", "created_dayofweek", "created_dayofmonth")],
    )


def imputed(t: Tables):
    return attributes.impute(described_clients(t), ["nature_of_business", "used_referral_code"], ["age", "income"])


IMPUTE_SQL = DEMOGRAPHIC_SQL + """,
    modes AS (
        SELECT (SELECT nature_of_business FROM described WHERE nature_of_business IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS nature_mode,
               (SELECT code FROM described WHERE code IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS code_mode,
               (SELECT quantile_cont(age, 0.5) FROM described) AS age_median, (SELECT quantile_cont(income, 0.5) FROM described) AS income_median),
    imputed AS (
        SELECT client_id, country, has_website, created, predicted_cluster, coalesce(nature_of_business, nature_mode) AS nature_of_business,
               coalesce(code, code_mode) AS code, coalesce(age, age_median) AS age, coalesce(income, income_median) AS income
        FROM described CROSS JOIN modes)
"""


@query("impute", IMPUTE_SQL + """SELECT client_id, nature_of_business, code AS used_referral_code, round(age, 4) AS age,
    round(income, 4) AS income FROM imputed""")
def impute(t: Tables):
    return imputed(t).select("client_id", "nature_of_business", "used_referral_code", rounded("age", 4).alias("age"),
                             rounded("income", 4).alias("income"))


@query(
    "label_encode",
    IMPUTE_SQL
    + """
    SELECT client_id, dense_rank() OVER (ORDER BY nature_of_business) - 1 AS nature_of_business,
           dense_rank() OVER (ORDER BY code) - 1 AS used_referral_code, dense_rank() OVER (ORDER BY country) - 1 AS country
    FROM imputed
    """,
)
def label_encode(t: Tables):
    coded = attributes.label_encode(imputed(t), ["nature_of_business", "used_referral_code", "country"])
    return coded.select("client_id", "nature_of_business", "used_referral_code", "country")


@query(
    "time_split",
    DEMOGRAPHIC_SQL
    + """
    SELECT part, predicted_cluster, n AS rows, round(n / sum(n) OVER (PARTITION BY part), 8) AS share
    FROM (SELECT CASE WHEN created < DATE '2023-01-01' THEN 'training' ELSE 'testing' END AS part, predicted_cluster, count(*) AS n
          FROM described GROUP BY ALL)
    """,
)
def time_split(t: Tables):
    before, after = attributes.time_split(described_clients(t), "created", "2023-01-01")
    shares = [attributes.class_shares(d, "predicted_cluster").withColumn("part", F.lit(p))
              for d, p in ((before, "training"), (after, "testing"))]
    return shares[0].unionByName(shares[1]).withColumn("share", rounded("share", 8))


@query("hold_out")
def hold_out(t: Tables):
    """Sizes of the random split of the training rows."""
    before, _ = attributes.time_split(described_clients(t), "created", "2023-01-01")
    train, held = attributes.hold_out(before, "client_id")
    sizes = [d.agg(F.count("*").alias("rows")).withColumn("part", F.lit(p)) for d, p in ((train, "train"), (held, "held out"))]
    return sizes[0].unionByName(sizes[1])


MODEL_COLUMNS = ["age", "income", "nature_of_business", "country", "is_referred"]


def stored(df: DataFrame, name: str) -> DataFrame:
    """Written below the shared folder and read back."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def model_rows(t: Tables):
    """Coded rows before and from 2023 on. Filled and coded rows are built once and stored, as all codes and all models read them."""
    filled = stored(imputed(t).select("client_id", "created", "predicted_cluster", *MODEL_COLUMNS), "filled-rows")
    coded = attributes.label_encode(filled, ["nature_of_business", "country", "is_referred", "predicted_cluster"])
    return attributes.time_split(stored(coded.select(*filled.columns), "model-rows"), "created", "2023-01-01")


@query("train_classifiers")
def train_classifiers(t: Tables):
    """Accuracy and F1 of every model on plain and scaled features."""
    train, test = model_rows(t)
    return models.train_classifiers(train, test, MODEL_COLUMNS, "predicted_cluster")[0]


VOTERS_SQL = """
    WITH votes AS (
        SELECT o_orderkey, 'price' AS model, CASE WHEN o_totalprice < 150000 THEN 0 WHEN o_totalprice < 300000 THEN 1 ELSE 2 END AS prediction FROM orders
        UNION ALL SELECT o_orderkey, 'priority', CAST(substr(o_orderpriority, 1, 1) AS INT) // 2 FROM orders
        UNION ALL SELECT o_orderkey, 'status', CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END FROM orders)
"""


def votes(t: Tables):
    """Three rules that put every order into class 0, 1 or 2."""
    price = F.when(F.col("o_totalprice") < 150000, 0).when(F.col("o_totalprice") < 300000, 1).otherwise(2)
    priority = F.floor(F.substring("o_orderpriority", 1, 1).cast("int") / 2).cast("int")
    status = F.when(F.col("o_orderstatus") == "F", 0).when(F.col("o_orderstatus") == "O", 1).otherwise(2)
    entries = F.array(*[F.struct(F.lit(n).alias("model"), c.alias("prediction"))
                        for n, c in (("price", price), ("priority", priority), ("status", status))])
    return t.orders.select("o_orderkey", F.explode(entries).alias("v")).select("o_orderkey", "v.*")


@query(
    "vote_hard",
    VOTERS_SQL
    + """
    SELECT o_orderkey, prediction FROM (
        SELECT o_orderkey, prediction, row_number() OVER (PARTITION BY o_orderkey ORDER BY
               sum(CASE model WHEN 'price' THEN 2 WHEN 'priority' THEN 1 ELSE 1.5 END) DESC, prediction) AS rn
        FROM votes GROUP BY o_orderkey, prediction)
    WHERE rn = 1
    """,
)
def vote_hard(t: Tables):
    return models.hard_vote(votes(t), "o_orderkey", {"price": 2, "priority": 1, "status": 1.5})


@query(
    "vote_soft",
    VOTERS_SQL
    + """,
    p AS (
        SELECT o_orderkey, c AS prediction,
               sum(CASE model WHEN 'price' THEN 2 WHEN 'priority' THEN 1 ELSE 1.5 END * CASE WHEN v.prediction = c THEN 0.5::DOUBLE ELSE 0.25::DOUBLE END) / 4.5 AS probability
        FROM votes v CROSS JOIN (VALUES (0), (1), (2)) AS k(c) GROUP BY o_orderkey, c)
    SELECT o_orderkey, arg_min(prediction, -round(probability, 12) * 10 + prediction * 1e-9) AS prediction, round(max(probability), 6) AS probability
    FROM p GROUP BY o_orderkey
    """,
)
def vote_soft(t: Tables):
    """Every rule gives its class probability 0.5 and the other two 0.25."""
    sure = F.array(*[F.when(F.col("prediction") == c, 0.5).otherwise(0.25) for c in range(3)])
    soft = models.soft_vote(votes(t).withColumn("probabilities", sure).drop("prediction"), "o_orderkey",
                            {"price": 2, "priority": 1, "status": 1.5})
    return soft.withColumn("probability", rounded("probability"))


def judged(t: Tables):
    """Labelled documents: quality is the truth, a text of at least 300 characters the prediction."""
    return t.documents.join(t.labels, "doc_id").select("quality", (F.col("n_chars") >= 300).cast("int").alias("predicted"))


JUDGED_SQL = "WITH judged AS (SELECT quality, CASE WHEN n_chars >= 300 THEN 1 ELSE 0 END AS predicted FROM documents JOIN labels USING (doc_id))"


@query("confusion_matrix", JUDGED_SQL + "SELECT quality AS label, predicted AS prediction, count(*) AS rows FROM judged GROUP BY ALL")
def confusion_matrix(t: Tables):
    return models.confusion_matrix(judged(t), "quality", "predicted")


REPORT_SQL = JUDGED_SQL + """,
    report AS (
        SELECT c AS class, (SELECT count(*) FROM judged WHERE quality = c) AS support, (SELECT count(*) FROM judged WHERE predicted = c) AS predicted_rows,
               (SELECT count(*) FROM judged WHERE predicted = c AND quality = c) AS hits
        FROM (SELECT quality AS c FROM judged UNION SELECT predicted FROM judged)),
    scores AS (SELECT *, coalesce(hits / nullif(predicted_rows, 0), 0) AS precision_, coalesce(hits / nullif(support, 0), 0) AS recall_,
                      coalesce(2 * hits / nullif(predicted_rows + support, 0), 0) AS f1 FROM report)
"""


@query("class_report", REPORT_SQL + """SELECT class, support, round(precision_, 8) AS precision, round(recall_, 8) AS recall,
    round(f1, 8) AS f1 FROM scores""")
def class_report(t: Tables):
    report = models.class_report(judged(t), "quality", "predicted")
    return report.select("class", "support", *[rounded(c, 8).alias(c) for c in ("precision", "recall", "f1")])


@query("evaluate", REPORT_SQL + """SELECT CAST(sum(support) AS BIGINT) AS rows, round(sum(hits) / sum(support), 8) AS accuracy,
    round(sum(f1 * support) / sum(support), 8) AS weighted_f1 FROM scores""")
def evaluate(t: Tables):
    return models.summary_metrics(judged(t), "quality", "predicted").select(
        "rows", rounded("accuracy", 8).alias("accuracy"), rounded("weighted_f1", 8).alias("weighted_f1")
    )


@query("score_clients")
def score_clients(t: Tables):
    """A pipeline fitted on the early clients, saved, loaded, and used to replace the table of scored late clients."""
    train, new = attributes.time_split(described_clients(t), "created", "2023-01-01")
    pipeline = models.scoring_pipeline(["nature_of_business", "country", "is_referred"], ["age", "income"], "predicted_cluster")
    model_path, table = fresh_path(t.spark, "model"), fresh_path(t.spark, "scored")
    models.fit_save(train, pipeline, model_path)
    full_refresh(models.score_clients(model_path, new, "predicted_cluster").select("client_id", "predicted_cluster"), table)
    return t.spark.read.parquet(table)


SCORED = ["age", "income"]
CODED = ["nature_of_business", "country", "is_referred"]


def bayes_sql() -> str:
    """Training statistics of the early clients, and for each late one the class of the greatest density times share.

    The variances get 1e-9 of the greatest variance of a feature, as the model adds it.
    """
    features = [*SCORED, *CODED]
    codes = "".join(
        f", {c}_codes AS (SELECT {c}, row_number() OVER (ORDER BY {c}) - 1 AS code FROM early WHERE {c} IS NOT NULL GROUP BY {c})" for c in CODED
    )
    filled = ", ".join(f"coalesce({c}, (SELECT avg({c}) FROM early)) AS {c}" for c in SCORED)
    coded = ", ".join(f"coalesce({c}_codes.code, (SELECT count(*) FROM {c}_codes))::DOUBLE AS {c}" for c in CODED)
    joins = " ".join(f"LEFT JOIN {c}_codes ON d.{c} = {c}_codes.{c}" for c in CODED)
    scaled = ", ".join(f"({c} - (SELECT avg({c}) FROM filled WHERE is_early)) / (SELECT stddev_samp({c}) FROM filled WHERE is_early) AS {c}" for c in SCORED)
    return DEMOGRAPHIC_SQL + f""",
    early AS (SELECT * FROM described WHERE created < DATE '2023-01-01'){codes},
    filled AS (SELECT client_id, predicted_cluster, created < DATE '2023-01-01' AS is_early, {filled}, {coded} FROM described d {joins}),
    scaled AS (SELECT client_id, predicted_cluster, is_early, {scaled}, {', '.join(CODED)} FROM filled),
    cells AS (UNPIVOT scaled ON {', '.join(features)} INTO NAME feature VALUE v),
    smallest AS (SELECT 1e-9 * max(spread) AS epsilon FROM (SELECT avg(v * v) - avg(v) * avg(v) AS spread FROM cells WHERE is_early GROUP BY feature)),
    moments AS (SELECT predicted_cluster AS class, feature, avg(v) AS mean, avg(v * v) - avg(v) * avg(v) + any_value(epsilon) AS spread
                FROM cells, smallest WHERE is_early GROUP BY ALL),
    shares AS (SELECT predicted_cluster AS class, ln(count(*) / (SELECT count(*) FROM early)) AS share FROM early GROUP BY 1),
    densities AS (SELECT client_id, class, any_value(share) - sum(ln(spread) + (v - mean) * (v - mean) / spread) / 2 AS density
                  FROM cells JOIN moments USING (feature) JOIN shares USING (class) WHERE NOT is_early GROUP BY ALL)
    SELECT client_id, class AS predicted_cluster FROM (
        SELECT *, row_number() OVER (PARTITION BY client_id ORDER BY density DESC, class) AS place FROM densities) WHERE place = 1"""


@query("score_clients_bayes", bayes_sql())
def score_clients_bayes(t: Tables):
    """As ``score_clients``, with a model that SQL can follow: means of missing numbers, and a normal density per class and feature."""
    train, new = attributes.time_split(described_clients(t), "created", "2023-01-01")
    bayes = models.classifiers()["naive_bayes"]
    pipeline = models.scoring_pipeline(CODED, SCORED, "predicted_cluster", bayes, imputing="mean")
    model_path, table = fresh_path(t.spark, "model"), fresh_path(t.spark, "scored")
    models.fit_save(train, pipeline, model_path)
    full_refresh(models.score_clients(model_path, new, "predicted_cluster").select("client_id", "predicted_cluster"), table)
    return t.spark.read.parquet(table)
