"""Exact duplicates through an extendible-hash index in the shared folder. DataFrame operations only.

1. Texts are grouped by (64-bit key, text). The grouping compares the bytes, so texts that collide on their
   key stay apart; equal texts of one task are combined before the shuffle, so a group with a third of all
   rows sends one row per task.
2. The directory: keys are counted per prefix. Starting from one bucket, a bucket with more than
   ``bucket_rows`` entries is split by the next bit of the key until it fits or the directory has doubled
   ``MAX_DEPTH`` times.
3. Owner tasks receive ranges of buckets, sort their entries by key, which puts the entries of one key next
   to each other (its chain), and write the index file of their range.
4. Every row looks its key up and follows the chain by the strong digest. Rows of a frequent text
   are many on one side of that join and one on the other; adaptive execution splits them.

Null text counts as empty. Null ids lose against any other; a text that only null ids have keeps a null id.
Rows that repeat both id and text are counted singly, and exactly one row of a group is kept. An empty table
gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import one_of_each, store

BUCKET_ROWS = 20_000
MAX_DEPTH = 16


def _keyed(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    df = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    return df.withColumn("key", F.xxhash64("text"))


def directory(entries: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Local depth and bucket of every prefix that occurs: at most 2^MAX_DEPTH rows."""
    rows = entries.count()
    depth = min(MAX_DEPTH, max(1, math.ceil(math.log2(max(1, rows / bucket_rows))) + 3))
    counts = entries.groupBy(F.shiftrightunsigned("key", 64 - depth).alias("prefix")).count()
    levels = counts.select("prefix", "count", F.explode(F.sequence(F.lit(0), F.lit(depth))).alias("depth")).withColumn(
        "bucket", F.expr(f"shiftright(prefix, {depth} - depth)")
    )
    sizes = levels.groupBy("depth", "bucket").agg(F.sum("count").alias("entries"))
    fitting = levels.join(sizes, ["depth", "bucket"]).where((F.col("entries") <= bucket_rows) | (F.col("depth") == depth))
    local = fitting.groupBy("prefix").agg(F.min("depth").alias("depth"))
    return local.select(
        "prefix", "depth", F.expr(f"shiftright(prefix, {depth} - depth)").alias("bucket"), F.lit(depth).alias("global_depth")
    )


def build_index(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """One entry per distinct text: bucket, depth, key, digest, id that stays, rows; files by bucket range."""
    chains = (
        _keyed(docs, id_column, text_column)
        .groupBy("key", "text")
        .agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .select("key", F.sha2("text", 256).alias("digest"), "keep_id", "group_size")
    )
    chains = store(chains, "exact-chains")
    pages = directory(chains, bucket_rows)
    pages = store(pages, "exact-directory")
    row = pages.select("global_depth").first()
    depth = row[0] if row else 1
    placed = chains.withColumn("prefix", F.shiftrightunsigned("key", 64 - depth)).join(F.broadcast(pages.drop("global_depth")), "prefix")
    owned = placed.repartitionByRange("bucket", "depth", "key").sortWithinPartitions("bucket", "key", "digest")
    return store(owned.select("bucket", "depth", "key", "digest", "keep_id", "group_size"), "exact-index")


def duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Per row: its id, the id of its group that stays, rows of the group, whether it stays, digest of the text."""
    index = build_index(docs, id_column, text_column, bucket_rows)
    rows = _keyed(docs, id_column, text_column).select("id", "key", F.sha2("text", 256).alias("digest"))
    rows = rows.groupBy("id", "key", "digest").agg(F.count(F.lit(1)).alias("copies"))
    found = rows.join(index, ["key", "digest"]).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return found.select(
        F.col("id").alias(id_column),
        "keep_id",
        "group_size",
        (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def deduplicate(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``docs`` with one row of each group of equal texts, that with the largest id; all columns stay."""
    verdicts = store(duplicates(docs, id_column, text_column, bucket_rows), "exact-verdicts")
    lost = verdicts.where(~F.col("kept")).select(F.col(id_column).alias("id"), F.col("text_sha256").alias("digest"))
    repeated = verdicts.where(F.col(id_column).eqNullSafe(F.col("keep_id")) & ~F.col("kept"))
    repeated = repeated.select(F.col(id_column).alias("id"), F.col("text_sha256").alias("digest")).distinct()
    keys = {"id": F.col(id_column), "digest": F.sha2(F.coalesce(F.col(text_column), F.lit("")), 256)}
    return one_of_each(docs, keys, lost, repeated)
