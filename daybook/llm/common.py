"""Shared helpers: written tables, bounded key bitmaps, and byte arrays of Arrow text columns."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.session import fresh_path

SLICE_BYTES = 1 << 18
BITMAP_BITS = 1 << 23


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back: cuts the lineage, survives lost executors."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def store_by(df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """Like ``store``, in files by hash of ``key``, so a join on it shuffles only the other side; each task writes a file per bucket it has rows of."""
    spark, path = df.sparkSession, fresh_path(df.sparkSession, name)
    table = f"stored_{path.rsplit('-', 1)[-1]}"
    df.write.format("parquet").bucketBy(buckets, key).option("path", path).option("compression", "zstd").saveAsTable(table)
    stored = spark.table(table)
    spark.sql(f"DROP TABLE {table}")  # forgets the name; the files have a path of their own and stay
    return stored


def _bitmap(hashed: DataFrame, bits: int) -> DataFrame:
    """(__w, __bits): a bitmap of the column ``__hash`` in at most ``bits / 64`` rows."""
    slots = hashed.select(F.pmod("__hash", F.lit(bits)).alias("__slot"))
    words_ = slots.select(F.expr("__slot div 64").alias("__w"), F.expr("shiftleft(1L, cast(__slot % 64 as int))").alias("__bit"))
    return words_.groupBy("__w").agg(F.bit_or("__bit").alias("__bits"))


def _marked(df: DataFrame, hashed: Column, bitmap: DataFrame, bits: int, how: str) -> DataFrame:
    """``df`` with ``__maybe``: whether the bitmap has the hash."""
    df = df.withColumn("__slot", F.pmod(hashed, F.lit(bits))).withColumn("__word", F.expr("__slot div 64"))
    df = df.join(F.broadcast(bitmap), F.col("__word") == F.col("__w"), how)
    return df.withColumn("__maybe", F.coalesce(F.expr("shiftright(__bits, cast(__slot % 64 as int)) & 1 = 1"), F.lit(False)))


def maybe_in(df: DataFrame, key: Column, keys: DataFrame, column: str, bits: int = BITMAP_BITS, inside: bool = True) -> DataFrame:
    """The rows of ``df`` whose ``key`` may be in ``keys[column]``; a few others stay, none is lost.

    With ``inside`` False the other rows: those whose key is surely not there. The keys become a bitmap of ``bits`` bits,
    held as at most ``bits / 64`` rows whatever the number of keys, so it can be broadcast. It only thins out what a join after
    it shuffles; when it fills up, more rows pass and that join does the work.
    """
    bitmap = _bitmap(keys.select(F.xxhash64(column).alias("__hash")), bits)
    marked = _marked(df, F.xxhash64(key), bitmap, bits, "inner" if inside else "left")
    return marked.where("__maybe" if inside else "not __maybe").select(*df.columns)


def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same batches; at the end, memory that allocators hold back is returned, as workers wait for later tasks."""
    import ctypes

    yield from batches
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # another C library
        pass


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary column and the offsets of its rows; null counts as empty."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = pc.fill_null(column, b"")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    return np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8), offsets


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) of consecutive rows of about ``limit`` bytes together.

    A row longer than the limit comes alone and whole.
    """
    data, offsets = flat(column)
    row, rows = 0, len(column)
    while row < rows:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        end = min(end, rows)
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of unsigned 64-bit numbers (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


ODD = np.uint64(0x9E3779B97F4A7C15)


def hashes_of(data: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int) -> np.ndarray:
    """64-bit hashes of the non-empty stretches from ``start`` to ``end``: sums of a random number for each byte at its place.

    A polynomial modulo 2^64 would not do: for any base it gives the Thue-Morse words and their complements one value.
    """
    if not len(start):
        return np.zeros(0, np.uint64)
    size = end - start
    first = np.cumsum(size) - size
    place = np.arange(int(size.sum())) - np.repeat(first, size)
    symbol = (place.astype(np.uint64) << np.uint64(8)) | data[np.repeat(start, size) + place]
    # one step of a counter-based generator, so the numbers of two places or bytes have nothing in common
    values = mix(symbol * ODD + mix(np.array([seed], np.uint64)))
    return mix(np.add.reduceat(values, first) + size.astype(np.uint64))


class Rolling:
    """Polynomial sums of a byte array modulo 2^64, to choose places in a text.

    Equal stretches have equal differences of sums; that different ones differ is likely, not sure, so nothing may be called equal by them.
    """

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.values = rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.base = int(rng.integers(1 << 40, 1 << 61)) * 2 + 1
        self.inverse = pow(self.base, -1, 1 << 64)
        self.powers = np.ones(1, np.uint64)
        self.inverses = np.ones(1, np.uint64)

    @staticmethod
    def _grow(table: np.ndarray, factor: int, size: int) -> np.ndarray:
        while len(table) < size:
            step = np.uint64(pow(factor, len(table), 1 << 64))
            table = np.concatenate([table, table * step])
        return table

    def sums(self, data: np.ndarray) -> np.ndarray:
        self.powers = self._grow(self.powers, self.base, len(data) + 1)
        self.inverses = self._grow(self.inverses, self.inverse, len(data) + 1)
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.values[data] * self.powers[: len(data)], out=out[1:])
        return out


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def words(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each maximal run of word bytes, and the first word of each row (with an end).

    Runs end where a row ends.
    """
    inside = is_word[data]
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    edges = offsets[:-1][offsets[:-1] < offsets[1:]]
    starts[edges] = inside[edges]
    last = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    ends[last] = inside[last]
    start = np.flatnonzero(starts)
    return start, np.flatnonzero(ends) + 1, np.searchsorted(start, offsets)


def without(df: DataFrame, keys: dict[str, Column], losers: DataFrame) -> DataFrame:
    """``df`` without the rows whose ``keys`` (null-safe) stand in ``losers``; all columns stay.

    Rows that a bitmap of the losers excludes are kept without being shuffled.
    """
    named = [f"__key_{k}" for k in keys]
    keyed = df.withColumns({f"__key_{k}": c for k, c in keys.items()})
    losers = losers.select(*[F.col(k).alias(f"__lost_{k}") for k in keys]).distinct()
    bitmap = _bitmap(losers.select(F.xxhash64(*[f"__lost_{k}" for k in keys]).alias("__hash")), BITMAP_BITS)
    marked = _marked(keyed, F.xxhash64(*named), bitmap, BITMAP_BITS, "left")
    same = [F.col(f"__key_{k}").eqNullSafe(F.col(f"__lost_{k}")) for k in keys]
    kept = marked.where("not __maybe").select(*df.columns)
    # an anti join would be moved below the bitmap
    checked = marked.where("__maybe").join(losers.withColumn("__lost", F.lit(True)), same, "left")
    return kept.unionAll(checked.where("__lost is null").select(*df.columns))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of the edges (a, b); a component is named by its least node.

    Large-star and small-star steps in turn: each edge is replaced by edges to the least neighbour until
    only stars are left. Every round is written to the shared folder.
    """

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())

    now = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    now = store(now, "edges")
    seen = state(now)
    while seen[0]:
        both = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        near = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = near.unionAll(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        now = store(small, "edges")
        before, seen = seen, state(now)
        if seen == before:
            break
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(roots)


def one_of_each(df: DataFrame, keys: dict[str, Column], lost: DataFrame, repeated: DataFrame) -> DataFrame:
    """``df`` without the rows in ``lost``, and with one row for each key in ``repeated`` (which must be among the lost)."""
    kept = without(df, keys, lost)
    if not repeated.take(1):
        return kept
    named = {f"__key_{k}": c for k, c in keys.items()}
    wanted = repeated.select(*[F.col(k).alias(f"__of_{k}") for k in keys]).distinct()
    same = [F.col(f"__key_{k}").eqNullSafe(F.col(f"__of_{k}")) for k in keys]
    again = df.withColumns(named).join(wanted, same, "left_semi").dropDuplicates(list(named))
    return kept.unionAll(again.select(*df.columns))
