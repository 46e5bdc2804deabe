"""Removal of byte strings that occur more than once, over all documents.

A byte goes if a string of ``length`` bytes (200) that covers it also starts at another place, in the same or any other
document. Strings are judged on the input.

**Places to compare.** Every string of ``length`` bytes has an anchor: the place of the least hash among its substrings of ``GRAM``
bytes, the leftmost of equals. Equal strings have equal anchors at the same place in them. Strings that start one after another and
have the same anchor form a passage around it. Only an anchor whose hash occurs twice can belong to a repeated string. If all passages around equal
anchors are equal, they are repeated whole. The others are the collection whose strings have to be compared.

**Column-wise construction.** The passages of that collection are lined up by their anchors, so equal strings begin in the same column.
Going through the columns from right to left, one symbol of every passage is inserted per round: the
order of the passages by what follows (the row of the collection's transform) is refined by a stable distribution on the new
symbol, and the common prefix of each neighbouring pair is the least of the old ones between them plus one. A
string is repeated when it shares ``length`` bytes with a neighbour in the order of its column. Here the bytes are compared, not hashes;
that all passages around an anchor are equal is told by 64-bit BLAKE2 digests of them.
The passages lie in files in the shared folder, ordered by anchor, and are read in sequence in blocks of ``BLOCK`` passages or one anchor.

The rounds run over the columns of passages (at most ``2 * length - GRAM``), not over whole documents: one round per byte of the longest
document, each rewriting the whole transform, cannot be done for long texts. An anchor with more than ``MANY``
different passages is not put in one task: the strings of its passages are counted by a 128-bit hash, combined within tasks.

Null texts count as empty and rows with repeated id and text count as two documents, so their strings are repeated. Documents are cut at
no length; a task holds slices of a megabyte of text with overlaps.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import Rolling, flat, maybe_in, mix, store, tidy

LENGTH = 200
GRAM = 64
BLOCK = 4096
MANY = 1 << 15
SLICE = 1 << 18
PLACE_BITS = 20
KEY_BITS = 1 << 24
ROLLING = Rolling(5)


def passages(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(anchor hash, first string, number of strings - 1, place of the anchor in the passage) of each passage.

    ``data`` holds pieces of texts from ``starts`` to ``ends``, less than 2^20 bytes.
    """
    n = len(data)
    width = length - gram + 1
    valid = np.zeros(n + 1, np.int32)
    long = ends - starts >= length
    np.add.at(valid, starts[long], 1)
    np.add.at(valid, ends[long] - length + 1, -1)
    string = np.flatnonzero(np.cumsum(valid)[:n] > 0)
    if not len(string):
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none, none
    sums = ROLLING.sums(data)
    grams = mix((sums[gram:] - sums[:-gram]) * ROLLING.inverses[: n - gram + 1])
    low = np.uint64((1 << PLACE_BITS) - 1)
    least = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
    step = 1
    while 2 * step <= width:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    if step < width:
        least = np.minimum(least[: len(least) - (width - step)], least[width - step :])
    anchor = (least[string] & low).astype(np.int64)
    new = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (string[1:] != string[:-1] + 1)])
    first = string[new]
    last = string[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(string) - 1]])]
    anchor = anchor[new]
    return grams[anchor], first, last - first, anchor - first


def digests(data: bytes, first: np.ndarray, end: np.ndarray, shape: np.ndarray) -> np.ndarray:
    """64-bit BLAKE2 digests of the passages from ``first`` to ``end``, told apart by ``shape`` too."""
    out = [hashlib.blake2b(data[a:b], digest_size=8, salt=s.to_bytes(8, "little")).digest() for a, b, s in zip(first.tolist(), end.tolist(), shape.tolist())]
    return np.frombuffer(b"".join(out), np.int64)


def pieces(column: pa.Array, length: int, limit: int = SLICE) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, starts, ends, row of each piece, place of each piece in its row): slices that hold every string once."""
    data, offsets = flat(column)
    held: list[tuple[int, int, int]] = []
    size = 0

    def out():
        sizes = np.array([b - a for _, a, b in held], np.int64)
        ends = np.cumsum(sizes)
        raw = np.concatenate([data[offsets[r] + a : offsets[r] + b] for r, a, b in held])
        return raw, ends - sizes, ends, np.array([r for r, _, _ in held]), np.array([a for _, a, _ in held])

    for row in range(len(column)):
        total = int(offsets[row + 1] - offsets[row])
        at = 0
        while total - at >= length:
            take = min(total - at, max(limit - size, 2 * length))
            held.append((row, at, at + take))
            size += take
            if size >= limit:
                yield out()
                held, size = [], 0
            if at + take == total:
                break
            at += take - length + 1
    if held:
        yield out()


def _anchors(batches: Iterator[pa.RecordBatch], length: int, gram: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for data, starts, ends, _, _ in pieces(batch.column(0), length):
            anchor, first, run, place = passages(data, starts, ends, length, gram)
            passage = digests(data.tobytes(), first, first + run + length, place << 20 | run)
            yield pa.RecordBatch.from_arrays([pa.array(anchor.view(np.int64)), pa.array(passage)], names=["anchor", "passage"])


def packed_place(first: np.ndarray, run: np.ndarray, place: np.ndarray) -> np.ndarray:
    """First string (40 bits), strings after it and place of the anchor (10 bits each) in one number."""
    return first << 20 | run << 10 | place


def _places(batches: Iterator[pa.RecordBatch], length: int, gram: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for data, starts, ends, rows, at in pieces(batch.column(2), length):
            anchor, first, run, place = passages(data, starts, ends, length, gram)
            piece = np.searchsorted(starts, first, "right") - 1
            row = pa.array(rows[piece])
            where = packed_place(first - starts[piece] + at[piece], run, place)
            columns = [batch.column(0).take(row), batch.column(1).take(row), pa.array(anchor.view(np.int64)), pa.array(where)]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)


def _different(batches: Iterator[pa.RecordBatch], length: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Passages to compare, of rows (id, text key, text, [(place, anchor)])."""
    for batch in batches:
        ids, keys = batch.column(0), batch.column(1)
        rows: list[tuple] = []
        held = 0

        def out():
            index = pa.array([r[0] for r in rows], pa.int64())
            rest = [pa.array([r[k] for r in rows], f.type) for k, f in zip(range(1, 9), list(schema)[2:])]
            return pa.RecordBatch.from_arrays([ids.take(index).cast(schema[0].type), keys.take(index), *rest], schema=schema)

        for row in range(batch.num_rows):
            text = batch.column(2)[row].as_py().encode()
            for entry in batch.column(3)[row].as_py():
                first, run, place = entry["place"] >> 20, entry["place"] >> 10 & 1023, entry["place"] & 1023
                passage = text[first : first + run + length]
                digest = hashlib.blake2b(passage + run.to_bytes(2, "little") + place.to_bytes(2, "little"), digest_size=16).digest()
                rows.append((row, entry["place"], entry["anchor"], int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True), run, place, passage, 1))
                held += len(passage)
            if held > 4 << 20:
                yield out()
                rows, held = [], 0
        if rows:
            yield out()


def repeated_strings(texts: list[bytes], places: np.ndarray, length: int) -> np.ndarray:
    """Which strings of ``length`` bytes occur in two passages, lined up so that their anchors stand in one column.

    A row per passage, an entry per column: whether the string that begins there is repeated. The anchors are in column max(places).
    """
    count, anchor = len(texts), int(places.max())
    width = max(len(t) - int(p) for t, p in zip(texts, places)) + anchor
    table = np.full((width, count), 256, np.uint16)
    for i, (text, place) in enumerate(zip(texts, places)):
        begin = anchor - int(place)
        table[begin : begin + len(text), i] = np.frombuffer(text, np.uint8)
    repeated = np.zeros((count, max(1, width - length + 1)), bool)
    order = np.arange(count)
    common = np.zeros(count + 1, np.int64)  # with the one before in the order
    for column in range(width - 1, -1, -1):
        symbol = table[column, order]
        moved = np.argsort(symbol, kind="stable")
        sorted_ = symbol[moved]
        same = np.flatnonzero((sorted_[1:] == sorted_[:-1]) & (sorted_[1:] != 256))
        new = np.zeros(count + 1, np.int64)
        if len(same):
            bounds = np.empty(2 * len(same), np.int64)
            bounds[0::2] = moved[same] + 1
            bounds[1::2] = moved[same + 1] + 1
            new[same + 1] = np.minimum.reduceat(common, bounds)[::2] + 1
        order, common = order[moved], new
        if column <= width - length:
            hit = np.flatnonzero(common[:count] >= length)
            repeated[order[hit], column] = True
            repeated[order[hit - 1], column] = True
    return repeated


def _compared(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Rows (anchor, d1, d2, run, place, passage, copies), sorted by anchor; gives the repeated strings as bits."""
    held: list[tuple] = []

    def close():
        texts, places = [r[5] for r in held], np.array([r[4] for r in held])
        bits = repeated_strings(texts, places, length)
        anchor = int(places.max())
        out = []
        for row, flags in zip(held, bits):
            begin = anchor - row[4]
            own = flags[begin : begin + row[3] + 1] | (row[6] > 1)
            if own.any():
                out.append((row[0], row[1], row[2], np.packbits(own).tobytes()))
        columns = list(zip(*out)) or [[], [], [], []]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["anchor", "d1", "d2", "bits"])

    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns]):
            if len(held) >= BLOCK and row[0] != held[-1][0]:
                yield close()
                held = []
            held.append(row)
    if held:
        yield close()


def _string_hashes(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Hashes of all strings of passages (anchor, d1, d2, run, place, passage, copies), for anchors with very many."""
    for batch in batches:
        for anchor, d1, d2, run, _, passage, copies in zip(*[c.to_pylist() for c in batch.columns]):
            at = np.arange(run + 1)
            found = [hashlib.blake2b(passage[k : k + length], digest_size=16).digest() for k in range(run + 1)]
            pair = np.frombuffer(b"".join(found), np.int64).reshape(-1, 2)
            same = lambda v: pa.array(np.full(run + 1, v, np.int64))  # noqa: B023, E731
            yield pa.RecordBatch.from_arrays(
                [same(anchor), same(d1), same(d2), pa.array(at, pa.int64()), pa.array(pair[:, 0].copy()), pa.array(pair[:, 1].copy()), same(copies)],
                names=["anchor", "d1", "d2", "string", "h1", "h2", "copies"],
            )


def removed(size: int, whole: list[int], partly: list[tuple[int, bytes]], length: int) -> np.ndarray:
    """Which bytes of a text are covered by repeated strings."""
    edge = np.zeros(size + 1, np.int64)
    for place in whole:
        first, run = place >> 20, place >> 10 & 1023
        edge[first] += 1
        edge[first + run + length] -= 1
    for place, bits in partly:
        first = place >> 20
        for string in np.flatnonzero(np.unpackbits(np.frombuffer(bits, np.uint8))).tolist():
            edge[first + string] += 1
            edge[first + string + length] -= 1
    return np.cumsum(edge[:-1]) > 0


def _cut(batches: Iterator[pa.RecordBatch], length: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for row in range(batch.num_rows):
            text = (batch.column(1)[row].as_py() or "").encode()
            whole = batch.column(2)[row].as_py() or []
            partly = [(e["place"], e["bits"]) for e in batch.column(3)[row].as_py() or []]
            gone = removed(len(text), whole, partly, length)
            spans = int(np.count_nonzero(gone[1:] & ~gone[:-1])) + int(len(gone) > 0 and gone[0])
            rows.append((len(text), int(gone.sum()), spans, np.frombuffer(text, np.uint8)[~gone].tobytes()))
        columns = [batch.column(0), *[pa.array(c, f.type) for c, f in zip(zip(*rows), list(schema)[1:])]] if rows else None
        if columns:
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)


def remove_repeated(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", length: int = LENGTH, gram: int = GRAM, many: int = MANY) -> DataFrame:
    """Per document: id, its bytes, removed bytes, maximal removed runs, and the bytes that are left (``kept``)."""
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = docs.sparkSession
    texts = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))
    texts = texts.withColumn("text_key", F.xxhash64("id", "text")).select("id", "text_key", "text")
    kind = texts.schema["id"].dataType.simpleString()

    anchors = texts.select("text").mapInArrow(lambda b: tidy(_anchors(b, length, gram)), "anchor long, passage long")
    found = anchors.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), F.min("passage").alias("low"), F.max("passage").alias("high"))
    shared = store(found.where("n > 1").selectExpr("anchor", "low <> high as differ"), "repeat-anchors")

    shape = spark.createDataFrame([], f"id {kind}, text_key long, anchor long, place long").schema
    arrow = to_arrow_schema(shape)
    places = texts.mapInArrow(lambda b: tidy(_places(b, length, gram, arrow)), shape)
    hits = store(maybe_in(places, F.col("anchor"), shared, "anchor", KEY_BITS).join(shared, "anchor"), "repeat-places")

    # passages whose strings have to be compared
    differ = hits.where("differ").groupBy("text_key", "id").agg(F.collect_set(F.struct("place", "anchor")).alias("entries"))
    differ = store(differ.withColumnRenamed("id", "of"), "repeat-entries")
    open_texts = maybe_in(texts, F.col("text_key"), differ, "text_key")
    open_rows = open_texts.join(differ, "text_key").where(F.col("id").eqNullSafe(F.col("of"))).select("id", "text_key", "text", "entries")
    shape = spark.createDataFrame([], f"id {kind}, text_key long, place long, anchor long, d1 long, d2 long, run int, at int, passage binary, one int").schema
    arrow_of = to_arrow_schema(shape)
    passages_ = store(open_rows.mapInArrow(lambda b: tidy(_different(b, length, arrow_of)), shape), "repeat-passages")
    distinct = passages_.groupBy("anchor", "d1", "d2", "run", "at", "passage").agg(F.count(F.lit(1)).alias("copies"))
    distinct = store(distinct.select("anchor", "d1", "d2", "run", "at", "passage", "copies"), "repeat-distinct")
    crowded = store(distinct.groupBy("anchor").count().where(F.col("count") > many).select("anchor"), "repeat-crowded")
    usual = distinct.join(crowded, "anchor", "left_anti").select(*distinct.columns).repartition("anchor").sortWithinPartitions("anchor")
    strings = "anchor long, d1 long, d2 long, bits binary"
    bits = usual.mapInArrow(lambda b: tidy(_compared(b, length)), strings)
    if crowded.take(1):
        each = distinct.join(crowded, "anchor", "left_semi").select(*distinct.columns)
        each = each.mapInArrow(lambda b: tidy(_string_hashes(b, length)), "anchor long, d1 long, d2 long, string long, h1 long, h2 long, copies long")
        each = store(each, "repeat-strings")
        twice = each.groupBy("h1", "h2").agg(F.sum("copies").alias("n")).where("n > 1")
        flagged = each.join(twice, ["h1", "h2"]).groupBy("anchor", "d1", "d2").agg(F.collect_set("string").alias("strings"))
        eight = lambda k: F.aggregate(F.sequence(F.lit(0), F.lit(7)), F.lit(0), lambda acc, i: acc * 2 + F.array_contains("strings", (k * 8 + i).cast("long")).cast("int"))
        hexed = F.array_join(F.transform(F.sequence(F.lit(0), F.floor(F.array_max("strings") / 8).cast("int")), lambda k: F.lpad(F.hex(eight(k)), 2, "0")), "")
        bits = bits.unionAll(flagged.select("anchor", "d1", "d2", F.unhex(hexed).alias("bits")))
    bits = store(bits, "repeat-bits")
    partly = passages_.select("id", "text_key", "place", "anchor", "d1", "d2").join(bits, ["anchor", "d1", "d2"])
    partly = partly.groupBy("text_key", "id").agg(F.collect_set(F.struct("place", "bits")).alias("partly"))
    whole = hits.where("not differ").groupBy("text_key", "id").agg(F.collect_set("place").alias("whole"))
    spans = whole.select("text_key", "id", "whole", F.lit(None).cast("array<struct<place:bigint,bits:binary>>").alias("partly"))
    spans = spans.unionAll(partly.select("text_key", "id", F.lit(None).cast("array<bigint>").alias("whole"), "partly"))
    spans = spans.groupBy(F.col("text_key").alias("key"), F.col("id").alias("of")).agg(F.first("whole", True).alias("whole"), F.first("partly", True).alias("partly"))
    spans = store(spans, "repeat-spans")

    shape = spark.createDataFrame([], f"{id_column} {kind}, n_bytes long, n_removed long, n_spans long, kept binary").schema
    arrow_out = to_arrow_schema(shape)
    touched = maybe_in(texts, F.col("text_key"), spans, "key").select("id", "text_key", "text")
    touched = touched.join(spans, (F.col("text_key") == F.col("key")) & F.col("id").eqNullSafe(F.col("of")), "left").select("id", "text", "whole", "partly")
    rest = maybe_in(texts, F.col("text_key"), spans, "key", inside=False).select(
        F.col("id").alias(id_column), F.octet_length("text").cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"),
        F.lit(0).cast("long").alias("n_spans"), F.col("text").cast("binary").alias("kept"),
    )
    return rest.unionAll(touched.mapInArrow(lambda b: tidy(_cut(b, length, arrow_out)), shape))
