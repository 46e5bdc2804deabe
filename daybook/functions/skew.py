"""Joins of a large table with one row per key, safe when few keys hold most rows, and rows dealt out before they multiply."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_HOT_KEYS = 500
TRACKED = 4096
SALTS = 64
PARTS = 256


def spread(df: DataFrame, keys: list[str], parts: int = PARTS) -> DataFrame:
    """``df`` dealt by ``keys`` into ``parts`` tasks, or as many as the session shuffles into if that is more.

    AQE merges small partitions by the size of what is shuffled; where each row then becomes many, a merged task would hold too much. A given number
    of partitions is not merged.
    """
    return df.repartition(max(parts, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))), *keys)


def hot_key_hashes(df: DataFrame, keys: list[str]) -> Column:
    """Hashes of the keys that hold a large share of the rows, as a scalar array.

    A frequent-items sketch finds them in one pass without a shuffle of rows. Any key above
    about 0.2 % of all rows is found, and there are never more than ``MAX_HOT_KEYS``.
    """
    top = F.call_function("approx_top_k", F.xxhash64(*keys), F.lit(MAX_HOT_KEYS), F.lit(TRACKED))
    return df.agg(F.transform(top, lambda e: e["item"])).scalar()


def attach_per_key(
    df: DataFrame, per_key: DataFrame, keys: list[str], salts: int = SALTS, hot: Column | None = None
) -> DataFrame:
    """Left join ``df`` with ``per_key`` (one row per key) on null-safe equal keys.

    Rows of hot keys are spread over ``salts`` buckets and the key's single row is repeated for
    each; all other keys stay in one bucket. Which keys are spread does not change the result,
    so ``hot`` may come from an earlier form of the rows.
    """
    hashes = hot_key_hashes(df, keys) if hot is None else hot
    buckets = F.when(F.array_contains(hashes, F.xxhash64(*keys)), salts).otherwise(1)
    rest = [c for c in df.columns if c not in keys]
    spread = F.xxhash64(*rest) if rest else F.lit(0)
    left = df.withColumn("_salt", F.pmod(spread, buckets).cast("int"))
    right = per_key.withColumn("_r_salt", F.explode(F.sequence(F.lit(0), buckets - 1))).select(
        *[F.col(k).alias(f"_r_{k}") for k in keys], "_r_salt", *[c for c in per_key.columns if c not in keys]
    )
    on = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys] + [F.col("_salt") == F.col("_r_salt")]
    return left.join(right, on, "left").drop("_salt", "_r_salt", *[f"_r_{k}" for k in keys])


def with_group_stats(df: DataFrame, keys: list[str], stats: dict[str, Column]) -> DataFrame:
    """Every row with the aggregates of its group.

    A window over the group would sort all its rows in one task; here the aggregates are
    combined before the shuffle and joined back with hot groups spread out.
    """
    per_key = df.groupBy(*keys).agg(*[agg.alias(name) for name, agg in stats.items()])
    return attach_per_key(df, per_key, keys)
