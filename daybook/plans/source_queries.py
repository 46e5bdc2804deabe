"""Landing, decrypting, loading and upserting of the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from daybook.functions import crypto
from daybook.functions.skew import spread
from daybook.operators import balances
from daybook.plans.registry import Tables, day_text, query
from daybook.session import fresh_path
from daybook.sources import documents, landed, tables
from daybook.sources.buckets import BucketedTable

EVENT = ["event_id", "user_id", "event_type", "value", "props"]
KEY, IV = b"0123456789abcdef", b"fedcba9876543210"


@query(
    "read_landed_records",
    """
    SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id, event_type,
           CAST(value AS VARCHAR) AS value, props FROM events
    """,
)
def read_landed_records(t: Tables):
    """Events landed as envelopes of up to 500 records and read back."""
    path = fresh_path(t.spark, "landed")
    envelopes(t).write.text(path)
    return landed.read_landed_records(t.spark, path)


def envelopes(t: Tables):
    record = F.struct(*EVENT)
    pages = t.events.groupBy(F.floor(F.col("event_id") / 500).alias("page"))
    return pages.agg(F.to_json(F.struct(F.collect_list(record).alias("data"))).alias("value")).select("value")


@query("decrypt_columns", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def decrypt_columns(t: Tables):
    """Customer texts encrypted and decrypted; one segment is left plain and must survive."""
    plain = F.col("c_mktsegment") == "BUILDING"
    hidden = t.customer.select(
        "c_custkey", crypto.encrypted("c_name", KEY, IV).alias("c_name"),
        F.when(plain, F.col("c_mktsegment")).otherwise(crypto.encrypted("c_mktsegment", KEY, IV)).alias("c_mktsegment"),
    )
    return crypto.decrypt_columns(hidden, KEY, IV)


@query(
    "upsert",
    """
    SELECT c_custkey, c_nationkey, CASE WHEN c_acctbal < 0 OR c_nationkey >= 20 THEN 'UPDATED' ELSE c_mktsegment END AS segment
    FROM customer
    """,
)
def upsert(t: Tables):
    """Customers of nations below 20 are the target; debtors and the other nations arrive as updates, twice."""
    base = t.customer.select("c_custkey", "c_nationkey", F.col("c_mktsegment").alias("segment"))
    changed = (F.col("c_acctbal") < 0) | (F.col("c_nationkey") >= 20)
    updates = t.customer.where(changed).select("c_custkey", "c_nationkey", F.lit("UPDATED").alias("segment"))
    path, next_path = fresh_path(t.spark, "upsert-v1"), fresh_path(t.spark, "upsert-v2")
    tables.full_refresh(base.where("c_nationkey < 20"), path)
    older = updates.withColumn("segment", F.lit("OLDER"))
    tables.upsert_table(updates.unionByName(older), path, next_path, ["c_custkey"], ["segment"])
    return t.spark.read.parquet(next_path)


@query(
    "upsert_buckets",
    """
    SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 1000 = 7 THEN 'CHANGED' WHEN o_totalprice > 400000 THEN 'LARGE' ELSE o_orderstatus END AS status
    FROM orders
    """,
)
def upsert_buckets(t: Tables):
    """Orders in buckets; large ones arrive later, then a thousandth of all keys changes."""
    rows = t.orders.select("o_orderkey", "o_custkey", F.col("o_orderstatus").alias("status"), "o_totalprice")
    table = BucketedTable(t.spark, fresh_path(t.spark, "orders"), ["o_orderkey"], buckets=32)
    table.upsert(rows.where("o_totalprice <= 400000").drop("o_totalprice"))
    table.upsert(rows.where("o_totalprice > 400000").drop("o_totalprice").withColumn("status", F.lit("LARGE")))
    table.upsert(rows.where("o_orderkey % 1000 = 7").drop("o_totalprice").withColumn("status", F.lit("CHANGED")))
    return table.latest()


@query("full_refresh", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def full_refresh(t: Tables):
    """Loaded with all orders, then refreshed with the finished ones."""
    rows = t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    path = fresh_path(t.spark, "refresh")
    tables.full_refresh(rows.drop("o_orderstatus"), path)
    tables.full_refresh(rows.where("o_orderstatus = 'F'").drop("o_orderstatus"), path)
    return t.spark.read.parquet(path)


def _snapshot_sql(year: int) -> str:
    return f"""
    SELECT '{year}-12-31' AS date, o_custkey, o_totalprice AS account_balance
    FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
          FROM orders WHERE o_orderstatus NOT IN ('P') AND o_orderdate < DATE '{year + 1}-01-01') WHERE rn = 1"""


@query(
    "replace_partitions",
    """
    SELECT y || '-12-31' AS date, o_custkey, o_totalprice AS account_balance FROM (
        SELECT *, row_number() OVER (PARTITION BY y, o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
        FROM orders JOIN (SELECT DISTINCT year(o_orderdate) AS y FROM orders) ON year(o_orderdate) <= y
        WHERE o_orderstatus NOT IN ('P'))
    WHERE rn = 1
    """,
)
def replace_partitions(t: Tables):
    """Year-end balances of all years stored by date; the last year is loaded wrong first, then again twice."""
    path = fresh_path(t.spark, "snapshots")

    years = t.orders.agg(F.array_sort(F.collect_set(F.year("o_orderdate"))))
    asked = spread(t.orders.select("o_custkey").distinct(), ["o_custkey"]).withColumn("year", F.explode(years.scalar()))
    at = balances.balances_as_of(
        t.orders, asked.withColumn("date", F.make_date("year", F.lit(12), F.lit(31))), ["o_custkey"], "o_orderdate",
        {"account_balance": "o_totalprice"}, tiebreak=["o_orderkey"], status="o_orderstatus", excluded=["P"],
    ).select("date", "o_custkey", "account_balance")
    last = F.col("date") == F.make_date(F.element_at(years.scalar(), -1), F.lit(12), F.lit(31))
    tables.replace_partitions(at.withColumn("account_balance", F.when(last, 0.0).otherwise(F.col("account_balance"))), path, "date")
    for _ in range(2):
        tables.replace_partitions(at.where(last), path, "date")
    return t.spark.read.parquet(path).select(day_text("date").alias("date"), "o_custkey", "account_balance")


@query(
    "balance_from_snapshots",
    _snapshot_sql(1999),
)
def balance_from_snapshots(t: Tables):
    """Balances of one date read from a table partitioned by date."""
    path = fresh_path(t.spark, "snapshots")
    for year in (1998, 1999):
        known = balances.balance_as_of(
            t.orders, ["o_custkey"], "o_orderdate", {"account_balance": "o_totalprice"}, f"{year}-12-31",
            ["o_orderkey"], "o_orderstatus", ["P"],
        )
        tables.replace_partitions(known, path, "date")
    day = balances.balance_from_snapshots(t.spark.read.parquet(path), "1999-12-31")
    return day.select(day_text("date").alias("date"), "o_custkey", "account_balance")


def incoming(t: Tables):
    """Texts and pages as documents; ids give the times."""
    texts = t.documents.select(
        F.concat(F.lit("doc-"), "doc_id", F.lit(".txt")).alias("document_name"), F.col("doc_id").alias("id"),
        F.col("text").alias("content"))
    pages = t.pages.select(
        F.concat(F.lit("page-"), "page_id", F.when(F.col("page_id") % 10 == 0, ".bin").otherwise(".html")).alias("document_name"),
        (F.col("page_id") + 10_000_000).alias("id"), F.col("html").alias("content"))
    return texts.unionByName(pages).select(
        F.md5("content").alias("file_hash"), "document_name",
        F.timestamp_seconds(F.col("id") + 1_600_000_000).alias("creation_date"), F.col("content").cast("binary").alias("content"))


def new_documents(t: Tables):
    """All documents against the stored ones: those with a label."""
    stored = t.documents.join(t.labels.select("doc_id"), "doc_id", "left_semi").select(F.md5("text").alias("file_hash"))
    return documents.ingest_new_documents(incoming(t), stored)


_CLEAN = "html"
for _pattern in [r"(?is)<script[^>]*>.*?</script>", r"(?is)<style[^>]*>.*?</style>", r"(?s)<!--.*?-->", r"(?s)<[^>]*>"]:
    _CLEAN = f"regexp_replace({_CLEAN}, '{_pattern}', ' ', 'g')"
for _name, _plain in [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&amp;", "&")]:
    _CLEAN = f"replace({_CLEAN}, '{_name}', '{_plain}')"
_CLEAN = rf"trim(regexp_replace({_CLEAN}, '\s+', ' ', 'g'))"

DOCUMENT_SQL = f"""
    WITH incoming AS (
        SELECT md5(text) AS file_hash, 'doc-' || doc_id || '.txt' AS document_name, doc_id AS id, text AS document_text FROM documents
        UNION ALL
        SELECT md5(html), 'page-' || page_id || CASE WHEN page_id % 10 = 0 THEN '.bin' ELSE '.html' END, page_id + 10000000,
               CASE WHEN page_id % 10 = 0 THEN 'No Text In CV With Filename: page-' || page_id || '.bin' ELSE {_CLEAN} END
        FROM pages),
    new_ AS (
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY file_hash ORDER BY id, document_name) AS rn FROM incoming)
        WHERE rn = 1 AND file_hash NOT IN (SELECT md5(text) FROM documents JOIN labels USING (doc_id)))
"""


@query(
    "ingest_new_documents",
    DOCUMENT_SQL
    + """
    SELECT file_hash, document_name, strftime(make_timestamp((1600000000 + id) * 1000000), '%Y-%m-%d %H:%M:%S') AS creation_date,
           md5(document_text) AS text_hash, CAST(length(document_text) AS BIGINT) AS text_length FROM new_
    """,
)
def ingest_new_documents(t: Tables):
    """Appended to the stored table and read back; whole texts are compared by hash and length."""
    path = fresh_path(t.spark, "document-table")
    tables.write_table(new_documents(t), path)
    return t.spark.read.parquet(path).select(
        "file_hash", "document_name", F.date_format("creation_date", "yyyy-MM-dd HH:mm:ss").alias("creation_date"),
        F.md5("document_text").alias("text_hash"), F.length("document_text").cast("long").alias("text_length"),
    )


@query(
    "latest_rows",
    DOCUMENT_SQL
    + """
    SELECT document_name, strftime(make_timestamp((1600000000 + id) * 1000000), '%Y-%m-%d %H:%M:%S') AS creation_date
    FROM new_ ORDER BY id DESC LIMIT 5
    """,
)
def latest_rows(t: Tables):
    last = tables.latest_rows(new_documents(t), "creation_date", 5, ["document_name"])
    return last.select("document_name", F.date_format("creation_date", "yyyy-MM-dd HH:mm:ss").alias("creation_date"))


@query("csv_round_trip", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv_round_trip(t: Tables):
    """The customer table written as CSV and read with its schema."""
    path = fresh_path(t.spark, "csv")
    tables.write_table(t.customer, path, "csv", "overwrite")
    return tables.read_table(t.spark, path, "csv", t.customer.schema)
