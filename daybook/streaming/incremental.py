"""The incremental loads as streaming jobs that process what has arrived and stop.

Every micro-batch writes under its batch id, so a batch that is replayed after a failure gives
the same table again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.functions.dates import as_date
from daybook.functions.latest import latest_row
from daybook.operators import inventory, portfolio
from daybook.operators.balances import keep_statuses
from daybook.sources.buckets import BucketedTable
from daybook.sources.folders import Folder
from daybook.sources.tables import replace_partitions, upsert


def read_files(spark: SparkSession, folder: str, schema: T.StructType, files_per_batch: int | None = None,
               glob: str = "*.parquet") -> DataFrame:
    """Stream of the Parquet files that arrive in a folder."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", str(files_per_batch))
    return reader.parquet(folder)


def run_available(stream: DataFrame, each_batch: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Process all available data in micro-batches, then stop; the checkpoint remembers how far."""
    query = (
        stream.writeStream.foreachBatch(each_batch).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()


class VersionedTable:
    """A table kept as one folder per micro-batch; batch ids of a checkpoint are consecutive.

    A batch reads the version before its own and writes its own, so nothing is read and
    overwritten at once and a replay starts from the same state. Versions that no replay can ask for
    are removed. A checkpoint that starts anew over a table it did not write is refused.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, version: int) -> str:
        return f"{self.root}/version={version}"

    def before(self, version: int, schema: T.StructType) -> DataFrame:
        found = self.versions()
        if found and found[-1] > version or version and version - 1 not in found:
            raise ValueError(f"{self.root} holds versions {found}, which do not belong before batch {version} of this checkpoint")
        if version == 0:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.path(version - 1))

    def write(self, df: DataFrame, version: int) -> None:
        df.write.mode("overwrite").parquet(self.path(version))
        for old in self.versions():
            if old < version - 1:
                Folder(self.spark, self.root).remove(f"version={old}")

    def merge(self, rows: DataFrame, version: int, combine: Callable[[DataFrame, DataFrame], DataFrame]) -> None:
        """The version that ``combine`` makes of the one before and the rows that arrived."""
        self.write(combine(self.before(version, rows.schema), rows), version)

    def versions(self) -> list[int]:
        """Numbers of the versions present."""
        names = Folder(self.spark, self.root).names()
        return sorted(int(n.removeprefix("version=")) for n in names if n.startswith("version="))

    def latest(self, schema: T.StructType | None = None) -> DataFrame:
        reader = self.spark.read.schema(schema) if schema is not None else self.spark.read
        return reader.parquet(self.path(self.versions()[-1]))


def stream_upsert(stream: DataFrame, table: VersionedTable | BucketedTable, keys: list[str], checkpoint: str,
                  order: list[str] | None = None) -> None:
    """Put arriving rows in place by key: the stream form of the upsert."""

    def each(batch: DataFrame, number: int) -> None:
        table.merge(batch, number, lambda old, new: upsert(old, new, keys, order))

    run_available(stream, each, checkpoint)


def stream_partitions(stream: DataFrame, path: str, partition: str, checkpoint: str) -> None:
    """Replace the partitions that arrive: the stream form of the rerun-safe load.

    One call is one load, however many micro-batches it takes. Each micro-batch puts its rows into a folder of the load under its batch id,
    so a replayed batch is stored once; when all that has arrived is stored, every partition that occurs is replaced by all
    rows the load has for it. A load that is interrupted goes on with the next call, and publishing it again gives the same
    table. The rows are kept beside the checkpoint until their load is published.
    """
    spark = stream.sparkSession
    folder = Folder(spark, f"{checkpoint.rstrip('/')}-loads")

    def publish(load: int) -> None:
        if folder.names(f"rows-{load}"):
            replace_partitions(spark.read.schema(stream.schema).parquet(f"{folder.root}/rows-{load}/*"), path, partition)
        folder.mark(f"published-{load}")
        folder.remove(f"rows-{load}")

    def each(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder.root}/rows-{load}/batch-{number}")

    done = folder.names()
    load = sum(name.startswith("published-") for name in done)
    if f"complete-{load}" in done:
        publish(load)
        load += 1
    run_available(stream, each, checkpoint)
    folder.mark(f"complete-{load}")
    publish(load)


def stream_latest_balances(
    stream: DataFrame,
    state: VersionedTable | BucketedTable,
    snapshots: str,
    keys: list[str],
    ts: str,
    values: dict[str, str],
    as_of: str | Column,
    checkpoint: str,
    tiebreak: list[str] | None = None,
    status: str | None = None,
    excluded: list[str] | None = None,
) -> None:
    """Daily snapshot of the latest balance per key from arriving events.

    The state holds the last event of every key; a late event never replaces a newer one. After
    each micro-batch the snapshot of the day before ``as_of`` is replaced. With a ``BucketedTable`` on the keys as state
    a micro-batch rewrites only the buckets of the keys that arrive.
    """
    ties = [f"_t{i}" for i in range(len(tiebreak or []))]

    def each(batch: DataFrame, number: int) -> None:
        arrived = keep_statuses(batch, status, excluded or []).select(
            *keys, F.col(ts).alias("latest_trans_at"), *[F.col(src).alias(out) for out, src in values.items()],
            *[F.col(t).alias(name) for t, name in zip(tiebreak or [], ties)],
        )
        state.merge(arrived, number, lambda old, new: latest_row(old.unionByName(new), keys, ["latest_trans_at", *ties]))
        now = state.latest(arrived.schema).drop(*ties)
        replace_partitions(now.withColumn("date", F.date_sub(as_date(as_of), 1)), snapshots, "date")

    run_available(stream, each, checkpoint)


def stream_monthly_activity(
    stream: DataFrame, events: VersionedTable, table: VersionedTable, key: list[str], user: str, ts: str,
    month: str, checkpoint: str,
) -> None:
    """Monthly activity arrays kept current: the month is computed anew from its events so far.

    Events are stored once per (key, user, time), and each batch replaces the month's rows by
    (month, key).
    """
    from daybook.operators.activity import monthly_activity_arrays

    def each(batch: DataFrame, number: int) -> None:
        first = F.trunc(as_date(month), "month")
        arrived = batch.where(F.trunc(ts, "month") == first).select(*key, user, ts)
        events.write(events.before(number, arrived.schema).unionByName(arrived).distinct(), number)
        so_far = batch.sparkSession.read.parquet(events.path(number))
        arrays = monthly_activity_arrays(so_far, key, user, ts, month)
        table.write(upsert(table.before(number, arrays.schema), arrays, ["month", *key]), number)

    run_available(stream, each, checkpoint)


def latest_unless_expired(keys: list[str], order: list[str], expires: str, today: Column) -> Callable[[DataFrame, DataFrame], DataFrame]:
    """How a state of last rows takes up new ones when rows expire on different days.

    Of each key the last row stays, and of the earlier ones those that expire later than all after them: each is the last row alive on some day to come.
    Rows that expired before ``today`` go. A key has one row per expiry day at most, reduced to those before rows are compared in order.
    """

    def combine(old: DataFrame, new: DataFrame) -> DataFrame:
        until = F.coalesce(F.col(expires), F.lit("9999-12-31").cast("date"))
        alive = old.unionByName(new).where(F.col(expires).isNull() | (F.col(expires) >= today))
        last = latest_row(alive, [*keys, expires], order)
        later = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order]).rowsBetween(Window.unboundedPreceding, -1)
        longest = last.withColumn("_longest", F.max(until).over(later))
        return longest.where(F.col("_longest").isNull() | (F.col("_longest") < until)).drop("_longest")

    return combine


def stream_portfolio(
    stream: DataFrame, state: BucketedTable, snapshots: str, locations: DataFrame, as_of: str | Column, checkpoint: str,
    clients: DataFrame | None = None,
) -> None:
    """The incremental portfolio from arriving transactions (rows of ``moved_volume_per_location``).

    The state, in buckets of ``portfolio.KEYS``, holds what can still be the last balance on a day from ``as_of`` on; rows leave it when their
    maturity horizon is over. Only the buckets of the keys that arrive are rewritten. When all that has arrived is taken up, the snapshot of the
    day before ``as_of`` is replaced; a call that was interrupted goes on with the next one. ``as_of`` must not go back.
    """
    keys, yesterday = portfolio.KEYS, F.date_sub(as_date(as_of), 1)
    order = ["latest_trans_at", "transaction_id", "position"]
    maturity, created = F.col("product_maturity_date"), F.col("created")
    late = created > maturity.cast("timestamp")
    expires = F.when(maturity.isNull(), None).when(late, F.add_months(F.to_date(created), 1)).otherwise(F.add_months(maturity, 1))

    def arrived(batch: DataFrame) -> DataFrame:
        known = F.col("volume").isNotNull() & (maturity.isNull() | created.isNotNull())
        return batch.where(known).select(
            *keys, "total_volume_after", created.alias("latest_trans_at"), "transaction_id", "position", expires.alias("expires")
        )

    def each(batch: DataFrame, number: int) -> None:
        state.merge(arrived(batch), number, latest_unless_expired(keys, order, "expires", yesterday))

    run_available(stream, each, checkpoint)
    schema = arrived(stream.sparkSession.createDataFrame([], stream.schema)).schema
    alive = state.latest(schema).where(F.col("expires").isNull() | (F.col("expires") >= yesterday))
    last = latest_row(alive, keys, order).withColumn("portfolio_date", yesterday)
    replace_partitions(portfolio.named(last, locations, clients), snapshots, "portfolio_date")


def stream_inventory(
    stream: DataFrame, state: BucketedTable, snapshots: str, accounts: DataFrame, stores: DataFrame, products: DataFrame,
    as_of: str | Column, tiebreak: list[str], checkpoint: str,
) -> None:
    """The incremental inventory from arriving transactions: last levels per store, product and quality, as ``stream_portfolio``."""
    keys, yesterday = inventory.KEYS, F.date_sub(as_date(as_of), 1)
    ties = [f"_t{i}" for i in range(len(tiebreak))]

    def arrived(batch: DataFrame) -> DataFrame:
        return inventory.inventory_transactions(batch, accounts).select(
            *keys, F.col("created").alias("latest_trans_at"), *[F.col(src).alias(out) for out, src in inventory.CARRIED.items()],
            *[F.col(t).alias(name) for t, name in zip(tiebreak, ties)],
        )

    def each(batch: DataFrame, number: int) -> None:
        state.merge(arrived(batch), number, lambda old, new: latest_row(old.unionByName(new), keys, ["latest_trans_at", *ties]))

    run_available(stream, each, checkpoint)
    schema = arrived(stream.sparkSession.createDataFrame([], stream.schema)).schema
    last = state.latest(schema).withColumn("date", yesterday)
    replace_partitions(inventory.named(last, stores, products), snapshots, "inventory_date")
