"""Daily portfolio balances per client, product and location from a transaction log.

The log holds one row per transaction: transaction_id, client_id, product_id, location_id,
created, units, total_units_before, total_units_after and three JSON lists of
{volume, location_code}: location_breakdown, location_breakdown_before, location_breakdown_after.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.functions.dates import as_date, explode_days
from daybook.functions.latest import latest_row

BREAKDOWN = "array<struct<volume:string,location_code:string>>"
LISTS = ["location_breakdown", "location_breakdown_before", "location_breakdown_after"]
KEYS = ["client_id", "product_code", "location_code_after"]


def describe_log(log: DataFrame, products: DataFrame, locations: DataFrame, since: str | Column,
                 special_type: str) -> DataFrame:
    """Log rows from ``since`` with product type, code and maturity, the location code and parsed lists.

    ``products``: id, product_type, product_code, maturity_date; ``locations``: id, code, name,
    state. Rows of the special type without location are left out.
    """
    product = products.select(F.col("id").alias("_pid"), "product_type", "product_code",
                              F.to_date("maturity_date").alias("product_maturity_date"))
    location = locations.select(F.col("id").alias("_lid"), F.col("code").alias("location_code"))
    described = (
        log.where(F.col("created") >= as_date(since).cast("timestamp"))
        .join(product, F.col("product_id") == F.col("_pid"), "left")
        .join(location, F.col("location_id") == F.col("_lid"), "left")
        .drop("_pid", "_lid")
    )
    parsed = {c: F.from_json(c, BREAKDOWN) for c in LISTS}
    useless = (F.col("product_type") == special_type) & F.col("location_id").isNull()
    return described.where(~useless).withColumns({**parsed, "is_special": F.col("product_type") == special_type})


def expand_location_breakdown(described: DataFrame) -> DataFrame:
    """One row per transaction and list position, the before and after lists in step.

    The shorter list is padded with nulls; a missing list counts as one unplaced entry, which
    takes the transaction's total units and its own location. The special type always uses
    1,000 times its units and its own location. An empty list beside an empty list gives no row.
    """
    unplaced = F.array(F.struct(F.lit(None).cast("string").alias("volume"), F.lit(None).cast("string").alias("location_code")))

    def entries(column: str) -> Column:
        return F.coalesce(F.col(column), unplaced)

    steps = F.posexplode(F.arrays_zip(entries("location_breakdown_before").alias("before"),
                                      entries("location_breakdown_after").alias("after")))
    rows = described.select("*", steps.alias("position", "_step"))

    def side(name: str) -> dict[str, Column]:
        entry = F.col(f"_step.{name}")
        total = F.col(f"total_units_{name}").cast("double")
        missing = F.col(f"location_breakdown_{name}").isNull() & (F.col("position") == 0)
        return {
            f"total_volume_{name}": F.when(F.col("is_special"), total * 1000).when(missing, total)
            .otherwise(entry["volume"].cast("double")),
            f"location_code_{name}": F.when(F.col("is_special") | missing, F.col("location_code"))
            .otherwise(entry["location_code"]),
        }

    return rows.withColumns({**side("before"), **side("after")}).drop("_step")


def moved_volume_per_location(expanded: DataFrame) -> DataFrame:
    """Attach the moved volume at the after-location from the transaction's own breakdown list.

    The list is part of the same log row, so it is searched in place instead of being exploded
    and joined back. A location listed twice gives two rows, none gives the transaction's units.
    """
    moved = F.filter("location_breakdown", lambda x: x["location_code"] == F.col("location_code_after"))
    rows = expanded.withColumn("_moved", F.explode_outer(moved))
    units = F.col("units").cast("double")
    volume = F.col("_moved.volume").cast("double")
    return rows.withColumns({
        "volume": F.when(F.col("is_special"), units * 1000).otherwise(F.coalesce(volume, units)),
        "actual_location_code": F.when(F.col("is_special"), F.col("location_code"))
        .otherwise(F.coalesce("_moved.location_code", "location_code")),
    }).drop("_moved")


def portfolio_transactions(log: DataFrame, products: DataFrame, locations: DataFrame, since: str | Column,
                           special_type: str) -> DataFrame:
    """The log expanded to one row per transaction, location and moved volume."""
    described = describe_log(log, products, locations, since, special_type)
    return moved_volume_per_location(expand_location_breakdown(described))


def named(rows: DataFrame, locations: DataFrame, clients: DataFrame | None) -> DataFrame:
    if clients is not None:
        known = clients.select(F.col("id").alias("_id"), F.col("client_id").alias("_client"))
        rows = rows.join(known, F.col("client_id") == F.col("_id"), "left").withColumn("client_id", F.col("_client"))
    places = locations.select(F.col("code").alias("_code"), F.col("name").alias("location"), "state")
    return rows.join(places, F.col("location_code_after") == F.col("_code"), "left").select(
        "portfolio_date", "client_id", "product_code", "location", "state",
        F.round("total_volume_after", 4).alias("total_portfolio_balance"), "latest_trans_at",
    )


def portfolio_daily_balance(transactions: DataFrame, locations: DataFrame, through: str | Column,
                            clients: DataFrame | None = None) -> DataFrame:
    """Dense balance per client, product, location and day, up to the maturity horizon.

    Without maturity the series runs to ``through``; with the last transaction on or before
    maturity to one month after maturity; else to one month after the last transaction.
    With ``clients`` (id, client_id) the business id of the client is returned, null for an unknown one.
    """
    known = F.col("volume").isNotNull()
    last = F.struct("created", "transaction_id", "position")
    daily = transactions.groupBy(*KEYS, "product_maturity_date", F.to_date("created").alias("day")).agg(
        F.max_by(F.when(known, F.struct("total_volume_after", "created")), F.when(known, last)).alias("_last")
    )
    by_key = Window.partitionBy(*KEYS, "product_maturity_date")
    in_order = by_key.orderBy("day")
    first_day, last_day = F.min("day").over(by_key), F.max("day").over(by_key)
    maturity = F.col("product_maturity_date")
    horizon = (
        F.when(maturity.isNull(), as_date(through))
        .when(F.col("_end") <= maturity, F.add_months(maturity, 1))
        .otherwise(F.add_months(F.col("_end"), 1))
    )
    bounded = (
        daily.withColumns({"_first": first_day, "_end": last_day})
        .where(F.col("_last").isNotNull() | (F.col("day") == F.col("_first")))
        .withColumn("_until", F.least(as_date(through), horizon))
        .withColumn("_next", F.date_sub(F.lead("day").over(in_order), 1))
        .withColumn("_until", F.least(F.col("_until"), F.coalesce("_next", "_until")))
    )
    dense = explode_days(bounded, F.col("day"), F.col("_until"), "portfolio_date").select(
        "portfolio_date", *KEYS, "_last.total_volume_after", F.col("_last.created").alias("latest_trans_at")
    )
    return named(dense, locations, clients)


def portfolio_incremental(transactions: DataFrame, locations: DataFrame, as_of: str | Column,
                          clients: DataFrame | None = None) -> DataFrame:
    """Latest balance per client, product and location within the horizon, stamped the day before ``as_of``.

    ``clients`` as for the daily balance.
    """
    yesterday = F.date_sub(as_date(as_of), 1)
    maturity, created = F.col("product_maturity_date"), F.col("created")
    late = created > maturity.cast("timestamp")
    alive = (
        maturity.isNull()
        | (~late & (F.add_months(maturity, 1) >= yesterday))
        | (late & (F.add_months(F.to_date(created), 1) >= yesterday))
    )
    kept = transactions.where(alive & F.col("volume").isNotNull()).select(
        *KEYS, "total_volume_after", F.col("created").alias("latest_trans_at"), "transaction_id", "position"
    )
    latest = latest_row(kept, KEYS, ["latest_trans_at", "transaction_id", "position"])
    return named(latest.withColumn("portfolio_date", yesterday), locations, clients)
