"""Daily inventory levels per store, product and quality level."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.operators.balances import daily_balance, daily_balance_incremental

KEYS = ["store_id", "product_id", "quality_level"]

# output measure -> column of the transaction
MEASURES = {
    "current_reserved_units": "reserved_units_after",
    "current_available_units": "units_after",
    "current_total_units": "total_units_after",
    "current_reserved_volume": "reserved_volume_after",
    "current_available_volume": "volume_after",
    "current_total_volume": "total_volume_after",
}
CARRIED = {**MEASURES, "client_id": "client_id", "store_inventory_account_id": "store_inventory_account_id"}


def inventory_transactions(transactions: DataFrame, accounts: DataFrame) -> DataFrame:
    """Transactions that are not deleted, with store, product and quality of their account.

    Accounts are unique by id. The join is left to the optimizer, which broadcasts the accounts
    when their size allows and splits skewed accounts otherwise.
    """
    account = accounts.select(F.col("id").alias("_account"), *KEYS)
    kept = transactions.where(~F.col("is_deleted"))
    return kept.join(account, F.col("store_inventory_account_id") == F.col("_account"), "left").drop("_account")


def named(rows: DataFrame, stores: DataFrame, products: DataFrame) -> DataFrame:
    store = stores.select(F.col("id").alias("_store"), F.col("name").alias("store_name"))
    product = products.select(F.col("id").alias("_product"), F.col("name").alias("product_name"),
                              F.col("code").alias("product_code"), F.col("category_type").alias("product_category"))
    return (
        rows.join(store, F.col("store_id") == F.col("_store"), "left")
        .join(product, F.col("product_id") == F.col("_product"), "left")
        .select(F.col("date").alias("inventory_date"), "store_id", "store_name", "product_id", "product_name",
                "product_code", "product_category", "quality_level", "client_id", *MEASURES,
                "store_inventory_account_id", "latest_trans_at")
    )


def inventory_daily_balance(
    transactions: DataFrame, accounts: DataFrame, stores: DataFrame, products: DataFrame,
    through: str | Column, tiebreak: list[str], start: str | Column | None = None,
) -> DataFrame:
    """Dense daily levels: the six measures of the last transaction are carried forward."""
    rows = inventory_transactions(transactions, accounts)
    dense = daily_balance(rows, KEYS, "created", CARRIED, through, start, tiebreak)
    return named(dense, stores, products)


def inventory_incremental(
    transactions: DataFrame, accounts: DataFrame, stores: DataFrame, products: DataFrame,
    as_of: str | Column, tiebreak: list[str],
) -> DataFrame:
    """Latest levels of every store, product and quality, stamped with the day before ``as_of``."""
    rows = inventory_transactions(transactions, accounts)
    latest = daily_balance_incremental(rows, KEYS, "created", CARRIED, as_of, tiebreak)
    return named(latest, stores, products)
