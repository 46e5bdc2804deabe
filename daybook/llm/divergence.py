"""How the sources of a language differ in their words: distances between sources, and the terms each source overuses.

1. Document counts per language and term; the terms in at least ``MIN_DOCS`` documents of a language are kept.
2. The kept terms are sorted by ranges, and each range becomes minimal acyclic transducers whose outputs are the terms' places in the order of
   their UTF-8 bytes (ordinals).
3. The texts stream through the transducers of their language and are counted by source and ordinal. Counts of one task are added up before
   they are shuffled. The transducers are broadcast in rounds of at most ``ROUND_BYTES``; a vocabulary beyond that takes another pass
   over the texts for each further round, so what a task holds does not grow with the input.
4. Shares are exact whole numbers: counts become decimals before they are multiplied.
5. Distances between sources are added up in blocks of ``BLOCK`` consecutive ordinals, each a small table of sources by terms; a block gives
   one row per pair of sources, however many terms it has. The terms of a source are ranked with ordinals deciding ties, the best ``TOP`` of
   each task first.

Null texts, languages and sources count as ''. A source without terms takes part with counts of 0. Without kept terms all distances are 0.
Repeated rows count each; ids are not read. Very long texts are read whole, a few megabytes at a time. An empty table gives no rows. Other
columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from daybook.llm.common import LOWER, slices, store, tidy, words
from daybook.llm.transducer import Transducer, build

MIN_DOCS = 30
TOP = 50
SCALE = 1_000_000_000
ADDED = 5
SHARD_TERMS = 1 << 17
ROUND_BYTES = 64 << 20
BLOCK = 1024
HELD = 1 << 20

CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
IS_TERM = np.zeros(256, bool)
IS_TERM[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
ARRAYS = {"start": np.int32, "label": np.uint8, "target": np.int32, "output": np.int32, "final": bool}


def kept_terms(df: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, term) of the terms in at least ``min_docs`` documents of the language."""
    terms = F.array_distinct(F.split(F.translate("text", CAPITALS, SMALL), r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"))
    each = df.select("lang", F.explode(terms).alias("term")).where("term <> ''")
    return each.groupBy("lang", "term").count().where(F.col("count") >= min_docs).select("lang", "term")


def shards(terms: DataFrame, shard_terms: int = SHARD_TERMS) -> DataFrame:
    """Transducers over consecutive kept terms: lang, first term, number of terms, ordinal of the first, and the arrays."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def shard(lang: str, found: list[bytes]) -> pa.RecordBatch:
            parts = build(found)
            return pa.RecordBatch.from_pylist(
                [{"lang": lang, "first": found[0].decode(), "n": len(found)} | {k: parts[k].tobytes() for k in ARRAYS}], schema
            )

        lang, held = None, []
        for batch in batches:
            for now, term in zip(batch["lang"].to_pylist(), batch["term"].cast(pa.binary()).to_pylist()):
                if held and (now != lang or len(held) >= shard_terms):
                    yield shard(lang, held)
                    held = []
                lang = now
                held.append(term)
        if held:
            yield shard(lang, held)

    schema = pa.schema([("lang", pa.string()), ("first", pa.string()), ("n", pa.int64()), *((k, pa.binary()) for k in ARRAYS)])
    ranges = max(1, math.ceil(terms.count() / shard_terms))
    sorted_terms = terms.select("lang", "term").repartitionByRange(ranges, "lang", "term").sortWithinPartitions("lang", "term")
    ddl = "lang string, first string, n long, " + ", ".join(f"{k} binary" for k in ARRAYS)
    made = store(sorted_terms.mapInArrow(rows, ddl), "term-shards")
    before = Window.partitionBy("lang").orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    return made.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0)).cast("long"))


def _rounds(made: DataFrame, round_bytes: int) -> Iterator[dict[str, list[tuple]]]:
    """The transducers by language, as many at a time as a round holds; one at least."""
    held, size = {}, 0
    for row in made.orderBy("lang", "base").toLocalIterator():
        bytes_ = sum(len(row[k]) for k in ARRAYS)
        if held and size + bytes_ > round_bytes:
            yield held
            held, size = {}, 0
        held.setdefault(row.lang, []).append((row.base, {k: bytes(row[k]) for k in ARRAYS}))
        size += bytes_
    if held:
        yield held


def _loaded(held: dict[str, list[tuple]]) -> dict[str, list[Transducer]]:
    return {lang: [Transducer({k: np.frombuffer(a[k], t) for k, t in ARRAYS.items()}, base) for base, a in rows] for lang, rows in held.items()}


def _recount(df: DataFrame, held) -> DataFrame:
    """(lang, source, ord, n): occurrences of the terms of one round, with several rows for a term of a source."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found_in = _loaded(held.value)
        groups: dict[tuple, int] = {}
        keys, counts = [], []

        def add_up() -> tuple[np.ndarray, np.ndarray]:
            each, inverse = np.unique(np.concatenate(keys), return_inverse=True)
            return each, np.bincount(inverse, np.concatenate(counts)).astype(np.int64)

        def emit() -> Iterator[pa.RecordBatch]:
            each, n = add_up()
            names = list(groups)
            which = pa.array(each >> 40)
            for k in range(0, len(each), 1 << 16):
                part = slice(k, k + (1 << 16))
                at = which[part]
                yield pa.record_batch(
                    [pa.array([g[0] for g in names], pa.string()).take(at), pa.array([g[1] for g in names], pa.string()).take(at),
                     pa.array(each[part] & (1 << 40) - 1), pa.array(n[part])], ["lang", "source", "ord", "n"],
                )

        for batch in batches:
            group = np.array([groups.setdefault(g, len(groups)) for g in zip(batch["lang"].to_pylist(), batch["source"].to_pylist())], np.int64)
            langs = [g[0] for g in groups]
            for row, end, data, offsets in slices(batch["text"], 1 << 22):
                data = LOWER[data]
                start, stop, first = words(data, offsets, IS_TERM)
                of = np.repeat(group[row:end], np.diff(first))
                for lang, machines in found_in.items():
                    mine = np.isin(of, [k for k, name in enumerate(langs) if name == lang])
                    if not mine.any():
                        continue
                    a, b, g = start[mine], stop[mine], of[mine]
                    for machine in machines:
                        place = machine.places(data, a, b)
                        hit = place >= 0
                        each, n = np.unique(g[hit] << 40 | place[hit], return_counts=True)
                        keys.append(each)
                        counts.append(n)
                        a, b, g = a[~hit], b[~hit], g[~hit]
                if sum(map(len, keys)) > HELD:
                    each, n = add_up()
                    keys, counts = [each], [n]
                    if len(each) > HELD // 2:
                        yield from emit()
                        keys, counts = [], []
        if keys:
            yield from emit()

    return df.mapInArrow(lambda batches: tidy(rows(batches)), "lang string, source string, ord long, n long")


def share(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(10^9 (n + 5) / (total + 5 terms)), exact; null without terms."""
    top = F.lit(SCALE).cast("decimal(10,0)") * (n + ADDED).cast("decimal(20,0)")
    bottom = (total + ADDED * terms).cast("decimal(20,0)")
    return F.when(terms > 0, 1 + F.call_function("div", top, F.when(bottom > 0, bottom)))


def _distances(cells: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, a, b, value): the sum of differences of every two sources of a language, a before b."""
    here = cells.select("lang", F.expr(f"ord div {BLOCK}").alias("block"), "source", F.expr(f"cast(ord % {BLOCK} as int)").alias("at"), "p")
    last = F.expr(f"greatest(terms - 1, 0) div {BLOCK}")
    everywhere = groups.select(
        "lang", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("block"), "source",
        F.lit(None).cast("int").alias("at"), F.col("p0").alias("p"), "terms",
    )
    schema = "lang string, a string, b string, value long"

    def block(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        lang, number = key
        bare = pdf["at"].isna()
        rest = pdf[bare].sort_values("source")
        sources, terms = rest["source"].to_numpy(), int(rest["terms"].iloc[0])
        width = max(0, min(BLOCK, terms - int(number) * BLOCK))
        p = np.repeat(rest["p"].fillna(0).to_numpy(np.int64)[:, None], width, axis=1)
        some = pdf[~bare]
        place = {s: k for k, s in enumerate(sources)}
        p[some["source"].map(place).to_numpy(np.int64), some["at"].to_numpy(np.int64)] = some["p"].to_numpy(np.int64)
        sums = [np.abs(p[k + 1 :] - p[k]).sum(axis=1) for k in range(len(sources))]
        a, b = np.triu_indices(len(sources), 1)
        return pd.DataFrame({"lang": lang, "a": sources[a], "b": sources[b], "value": np.concatenate(sums) if sums else np.zeros(0, np.int64)})

    both = here.withColumn("terms", F.lit(None).cast("long")).unionByName(everywhere)
    return both.groupBy("lang", "block").applyInPandas(block, schema).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def _spelled(top: DataFrame, held) -> DataFrame:
    """``top`` with ``item``, the term at ``ord``, for the rows whose term is in this round."""
    schema = "lang string, source string, ord long, value long, rank int, item string"

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found_in = _loaded(held.value)
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                for machine in found_in.get(row["lang"], ()):
                    if machine.base <= row["ord"] < machine.base + len(machine):
                        out.append(row | {"item": machine.word(row["ord"]).decode()})
            yield pa.RecordBatch.from_pylist(out, pa.schema([*batch.schema, ("item", pa.string())]))

    return top.select("lang", "source", "ord", "value", "rank").mapInArrow(rows, schema)


def audit(
    docs: DataFrame, text_column: str = "text", lang_column: str = "lang", source_column: str = "source", min_docs: int = MIN_DOCS,
    top: int = TOP, shard_terms: int = SHARD_TERMS, round_bytes: int = ROUND_BYTES,
) -> DataFrame:
    """(lang, source, part, item, value, rank): distances to the other sources, and the terms used more than in the language."""
    df = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(n) for c, n in ((lang_column, "lang"), (source_column, "source"), (text_column, "text"))])
    spark = docs.sparkSession
    made = store(shards(store(kept_terms(df, min_docs), "terms"), shard_terms), "term-transducers")
    rounds = [spark.sparkContext.broadcast(held) for held in _rounds(made, round_bytes)]
    counted = None
    for held in rounds:
        found = _recount(df, held)
        counted = found if counted is None else counted.unionAll(found)
    if counted is None:
        counted = spark.createDataFrame([], "lang string, source string, ord long, n long")
    counts = store(counted.groupBy("lang", "source", "ord").agg(F.sum("n").alias("n")), "term-counts")

    sizes = made.groupBy("lang").agg(F.sum("n").alias("terms"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = df.select("lang", "source").distinct().join(sizes, "lang", "left").join(totals, ["lang", "source"], "left").na.fill(0, ["terms", "total"])
    groups = store(groups.withColumn("p0", share(F.lit(0).cast("long"), F.col("total"), F.col("terms"))), "term-groups")
    cells = counts.join(groups, ["lang", "source"]).select("lang", "source", "ord", share(F.col("n"), F.col("total"), F.col("terms")).alias("p"))

    distances = _distances(cells, groups)
    other = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
    pairs = distances.select("lang", other.alias("x"), "value").select("lang", "x.source", F.lit("pair").alias("part"), "x.item", "value")
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    pairs = pairs.withColumn("rank", F.row_number().over(order))

    whole = groups.groupBy("lang").agg(F.sum("total").alias("total"), F.max("terms").alias("terms"))
    expected = counts.groupBy("lang", "ord").agg(F.sum("n").alias("n")).join(whole, "lang")
    expected = expected.select("lang", "ord", share(F.col("n"), F.col("total"), F.col("terms")).alias("q"))
    over = cells.join(expected, ["lang", "ord"]).where("p > q").select("lang", "source", "ord", F.expr("p - q").alias("value"))
    best = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "ord")
    ranked = over.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    ranked = store(ranked, "term-ranks")
    for held in rounds:
        named = _spelled(ranked, held).select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank")
        pairs = pairs.unionAll(named)
    return pairs
