"""Attributes of business clients: derived columns, imputation, encoding and splits."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.functions.quantiles import exact_quantiles, most_frequent
from daybook.functions.ranks import ordered_codes
from daybook.functions.skew import attach_per_key, hot_key_hashes

# fixed values: what counts as a web address and which referral codes are ours
WEBSITE = r"^(http[s]?://|www)[^\s]+[.]\w{2,}[/]?$"
REFERRAL_PREFIXES = ("COMX", "comx")
SECONDS_PER_YEAR = 60 * 60 * 24 * 365.25


def client_attributes(labels: DataFrame, demographics: DataFrame, as_of: str | date, key: str = "client_id",
                      date_format: str = "dd/MM/yyyy") -> DataFrame:
    """Labels with demographics and derived columns.

    Adds has_website, is_referred, company age in years (two digits) and year, month, weekday
    (Monday = 0) and day of the creation date.
    """
    joined = labels.join(demographics, key, "left")
    now = F.lit(str(as_of)).cast("timestamp")
    founded = F.try_to_timestamp("date_of_incorporation", F.lit(date_format))
    age = (F.unix_timestamp(now) - F.unix_timestamp(founded)) / SECONDS_PER_YEAR
    website = F.coalesce(F.col("company_website").rlike(WEBSITE), F.lit(False))
    code = F.col("used_referral_code")
    referred = F.coalesce(code.startswith(REFERRAL_PREFIXES[0]) | code.startswith(REFERRAL_PREFIXES[1]), F.lit(False))
    return joined.withColumns({
        "has_website": F.when(website, "has website").otherwise("does not have website"),
        "is_referred": F.when(referred, "referred").otherwise("not referred"),
        "age": F.round(age, 2),
        "created_year": F.year("created"), "created_month": F.month("created"),
        "created_dayofweek": F.weekday("created"), "created_dayofmonth": F.dayofmonth("created"),
    })


def impute(df: DataFrame, text: list[str], numbers: list[str]) -> DataFrame:
    """Missing text replaced by the column's mode, missing numbers by its median."""
    out, fills = df, {}
    if text:
        modes = most_frequent(_long(df, text, "string"), ["column"], "value")
        out = out.withColumn("_modes", _wide(modes, text, F.col("mode")).scalar())
        fills |= {c: F.coalesce(F.col(c), F.col("_modes")[c]) for c in text}
    if numbers:
        medians = exact_quantiles(_long(df, numbers, "double"), ["column"], "value", [0.5], few_keys=True)
        out = out.withColumn("_medians", _wide(medians, numbers, F.col("quantiles")[0]).scalar())
        fills |= {c: F.coalesce(F.col(c).cast("double"), F.col("_medians")[c]) for c in numbers}
    return out.withColumns(fills).drop("_modes", "_medians")


def _long(df: DataFrame, columns: list[str], kind: str) -> DataFrame:
    entries = [F.struct(F.lit(c).alias("column"), F.col(c).cast(kind).alias("value")) for c in columns]
    return df.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def _wide(rows: DataFrame, columns: list[str], value: Column) -> DataFrame:
    """One row with a struct of the value per column."""
    return rows.agg(F.struct(*[F.max(F.when(F.col("column") == c, value)).alias(c) for c in columns]))


def class_codes(df: DataFrame, columns: list[str]) -> DataFrame:
    """The code of every class: (column, value, code), numbered in sorted order from 0."""
    return ordered_codes(_long(df, columns, "string"), "column", "value")


def label_encode(df: DataFrame, columns: list[str], codes: DataFrame | None = None) -> DataFrame:
    """Columns replaced by their class codes, from ``codes`` (of training data) or their own.

    A value without code becomes null. A frequent class is spread over tasks in the join.
    """
    table = class_codes(df, columns) if codes is None else codes
    texts = df.withColumns({c: F.col(c).cast("string") for c in columns})
    out = texts
    for c in columns:
        mine = table.where(F.col("column") == c).select(F.col("value").alias(c), F.col("code").alias("_code"))
        coded = attach_per_key(out, mine, [c], hot=hot_key_hashes(texts, [c]))
        out = coded.withColumn(c, F.col("_code")).drop("_code")
    return out


def time_split(df: DataFrame, created: str, cutoff: str | date) -> tuple[DataFrame, DataFrame]:
    """Rows before the cutoff, and rows from it on."""
    limit = F.lit(str(cutoff)).cast("timestamp")
    return df.where(F.col(created) < limit), df.where(F.col(created) >= limit)


def hold_out(df: DataFrame, key: str, share: float = 0.33, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Random split by a hash of the key: the same rows in every run and on any partitioning."""
    bucket = F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(10_000))
    held = bucket < int(share * 10_000)
    return df.where(~held), df.where(held)


def class_shares(df: DataFrame, label: str) -> DataFrame:
    """Rows and share of each class."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("rows"))
    total: Column = counts.agg(F.sum("rows")).scalar()
    return counts.withColumn("share", F.col("rows") / total)
