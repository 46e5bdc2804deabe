"""Scores of texts by a probabilistic suffix tree over words, with contexts of variable length.

1. Words of the training rows are counted and numbered by falling count, 0 is the end. Texts become numbers in chunks of about four megabytes; words that
   are not in the dictionary of frequent ones, which is broadcast, get theirs by a join on the word.
2. The tree is dealt out by its first edge: every token goes with the ``depth`` words before it to the group of the word just before it. So a group holds whole
   subtrees, with all occurrences of their contexts, and builds and uses them alone. Chunks send a group one compressed row. Words too rare for a context
   or a successor are sent without their number; what follows one is scored at the root, where it stands.
3. A candidate is a run of 1 to ``DEPTH`` words that occurs ``MIN_CONTEXT`` times; it ends where a text begins. Single successors are kept from ``MIN_PAIR``
   occurrences on: a distribution of fewer is its discount.
   A context's distribution is smoothed by the one of the context without its oldest word: P(w|s) = max(n - d, 0) / n(s) + b(s) P(w|shorter s),
   where b(s) is what the discounts and the successors that are not kept leave over, so the sum over all words is 1. At the root
   P(w) = (c + 1) / (N + V + 1); all unknown words are one.
4. A context stays in the tree if its successors diverge from those of the shorter context: the sum of n log2 (P(w|s) / P(w|shorter s)) reaches
   ``MIN_GAIN`` bits. Its suffixes stay with it.
5. Every token is scored in its longest context in the tree; sums by text leave the group, packed into one row for all texts of a bucket of chunks.

No share of the corpus bounds words, contexts or successors, so a larger corpus gets a finer tree. A caller may set such shares. What the driver holds is the
dictionary (at most one word over ``DICTIONARY_SHARE``) and the numbers where counts change (at most the square root of twice the tokens).

A null text is empty: it has the end symbol only. A row without id counts as the id '' when rows are held out. Repeated rows are counted and
scored each. Without training rows every probability is 1. Very long texts are read whole, a few megabytes at a time. An empty table gives no
rows. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from daybook.llm.common import LOWER, mix, slices, store, store_by, tidy, words

DEPTH = 3
DICTIONARY_SHARE = 5e-7
MIN_CONTEXT, MIN_PAIR = 4, 2
DISCOUNT = 0.75
MIN_GAIN = 16.0
END = 0
NONE = (1 << 32) - 1
SLICE = 1 << 22
HELD = 1 << 21
STEP = 1 << 19
BUCKETS = 64

IS_WORD = np.ones(256, bool)
IS_WORD[[0x20, *range(0x09, 0x0E)]] = False


def held_out(id_column: Column) -> Column:
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")) % 7 == 2


def _spelled(text: pa.Array) -> Iterator[tuple[int, int, np.ndarray, pa.Array]]:
    """First row, end row, the first word of each row (with an end), and all words of about four megabytes of rows."""
    for row, end, data, offsets in slices(text, SLICE):
        data = LOWER[data]
        start, stop, first = words(data, offsets, IS_WORD)
        edges = np.zeros(len(start) + 1, np.int32)
        np.cumsum(stop - start, out=edges[1:])
        yield row, end, first, pa.StringArray.from_buffers(len(start), pa.py_buffer(edges), pa.py_buffer(data[IS_WORD[data]]))


def _count_words(train: DataFrame) -> DataFrame:
    """(word, c) of the rows."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, _, found in _spelled(batch["text"]):
                counted = pc.value_counts(found)
                order = pc.sort_indices(counted.field("values"))  # in order they take less room
                yield pa.record_batch([counted.field("values").take(order), counted.field("counts").take(order)], ["word", "c"])

    return train.select("text").mapInArrow(lambda b: tidy(rows(b)), "word string, c long").groupBy("word").agg(F.sum("c").alias("c"))


def _numbered(counts: DataFrame) -> DataFrame:
    """(word, c, number), stored: numbers 1, 2, ... by falling count, without gaps."""
    ranked = store(counts.orderBy(F.col("c").desc(), "word").withColumn("at", F.monotonically_increasing_id()), "ranked")
    part, place = F.shiftright("at", 33), F.expr(f"at & {(1 << 33) - 1}")
    sizes = sorted(ranked.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect())
    before = np.cumsum([0, *(n for _, n in sizes)])[:-1]
    starts = counts.sparkSession.createDataFrame([(p, int(b)) for (p, _), b in zip(sizes, before)], "part long, before long")
    return ranked.withColumn("part", part).join(F.broadcast(starts), "part").select("word", "c", (F.col("before") + place + 1).alias("number"))


def _encode(df: DataFrame, dictionary) -> DataFrame:
    """Chunks of rows: their ``docs`` (id, held_out), the numbers of their words and ends, where each row ends, and the ``others``.

    The number of the k-th of the ``others``, words that are not in the dictionary, is -1 - k.
    """
    docs = T.ArrayType(T.StructType([df.schema["id"], df.schema["held_out"]]))
    schema = T.StructType().add("chunk", "long").add("docs", docs).add("ids", "binary").add("till", "binary").add("others", T.ArrayType(T.StringType()))
    kind = to_arrow_schema(schema)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, chunk = dictionary.value, TaskContext.get().partitionId() << 32
        for batch in batches:
            for row, end, first, found in _spelled(batch["text"]):
                index = pc.fill_null(pc.index_in(found, value_set=known), -2).to_numpy(zero_copy_only=False).astype(np.int64) + 1
                other = np.flatnonzero(index < 0)
                coded = found.take(pa.array(other)).dictionary_encode()
                order = pc.sort_indices(coded.dictionary)
                index[other] = -1 - np.argsort(order.to_numpy())[coded.indices.to_numpy()]
                ids = _squeeze([np.insert(index, first[1:], END)])
                till = first[1:] + np.arange(1, end - row + 1)
                struct = pa.StructArray.from_arrays([batch[c].slice(row, end - row).cast(f.type) for c, f in zip(("id", "held_out"), kind.field("docs").type.value_type)], ["id", "held_out"])
                columns = [[chunk], pa.ListArray.from_arrays([0, len(struct)], struct), [ids], [till.astype(np.int64).tobytes()], [coded.dictionary.take(order).to_pylist()]]
                yield pa.RecordBatch.from_arrays([(c if isinstance(c, pa.Array) else pa.array(c, f.type)).cast(f.type) for c, f in zip(columns, kind)], schema=kind)
                chunk += 1

    return df.select("id", "held_out", "text").mapInArrow(lambda b: tidy(rows(b)), schema)


def _squeeze(columns: list[np.ndarray]) -> bytes:
    """32-bit numbers, byte by byte as the high ones repeat."""
    planes = np.ascontiguousarray(np.stack(columns).astype(np.uint32).view(np.uint8).reshape(len(columns), -1, 4).transpose(0, 2, 1))
    return len(columns[0]).to_bytes(8, "little") + pa.Codec("zstd", 1).compress(planes.tobytes(), asbytes=True)


def _spread(blob: bytes | pa.Buffer, columns: int) -> np.ndarray:
    n = int.from_bytes(bytes(blob[:8]), "little")
    planes = np.frombuffer(pa.Codec("zstd").decompress(blob[8:], n * columns * 4, asbytes=True), np.uint8).reshape(columns, 4, n)
    return np.ascontiguousarray(planes.transpose(0, 2, 1)).view(np.uint32).reshape(columns, n)


class Counts:
    """The count of each word by its number: where a new count begins, and the counts."""

    def __init__(self, first: np.ndarray, value: np.ndarray, total: int, vocabulary: int):
        self.first, self.value, self.total, self.vocabulary = first, value, total, vocabulary

    def __call__(self, number: np.ndarray) -> np.ndarray:
        return self.value[np.searchsorted(self.first, number, "right") - 1]

    def like(self, number: np.ndarray) -> np.ndarray:
        """The first number with the same count."""
        return self.first[np.searchsorted(self.first, number, "right") - 1]

    def below(self, least: int) -> int:
        """The first number of a word that is not so frequent; the end counts as frequent."""
        rare = np.flatnonzero(self.value[1:] < least)
        return int(self.first[1 + rare[0]]) if len(rare) else NONE

    def root(self, number: np.ndarray) -> np.ndarray:
        return (self(number) + 1) / (self.total + self.vocabulary + 1)


def _bucket(chunk: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(chunk.astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)


def _windows(chunks: DataFrame, counts, depth: int, groups: int, buckets: int, least: tuple[int, int, int]) -> DataFrame:
    """(group, chunk, blob): the tokens of a chunk in a group, as the symbols before, the symbol, and its row with a bit that tells whether it trains.

    Tokens after a word that no context can have are in no group. Groups below 0, one for each bucket of chunks, get the numbers of tokens, of known ones, the base
    scores, and the scores of the tokens in no group, of the chunk's rows.
    """
    least_word, least_context, least_pair = least

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, held, ids, till, numbers in zip(*[batch[c] for c in ("chunk", "held", "ids", "till", "numbers")]):
                symbols = _spread(ids.as_py(), 1)[0].view(np.int32).astype(np.int64)
                till = np.frombuffer(till.as_buffer(), np.int64)
                other = symbols < 0
                if other.any():
                    table = np.full(-int(symbols.min()), counts.value.first[-1])
                    if numbers.is_valid:
                        pairs = numbers.values.to_numpy()
                        table[pairs >> 32] = pairs & NONE
                    symbols[other] = table[-1 - symbols[other]]
                size = np.diff(till, prepend=0)
                doc = np.repeat(np.arange(len(till)), size)
                place = np.arange(len(symbols)) - np.repeat(till - size, size)
                trains = ~held.values.to_numpy(zero_copy_only=False).astype(bool)
                base, c = np.log10(counts.value.root(symbols)), counts.value(symbols)
                leads = np.where((symbols == END) | (c >= max(least_word, least_context)), symbols, NONE)
                padded = np.concatenate([np.full(depth, END), leads])
                before = [np.where(place >= k - 1, padded[depth - k : len(padded) - k], NONE) for k in range(1, depth + 1)]
                for newer, older in zip(before, before[1:]):
                    older[newer == NONE] = NONE
                apart = before[0] == NONE
                sums = [size, *(np.add.reduceat(x, till - size) for x in ((c > 0).astype(np.int64), base, np.where(apart, base, 0)))]
                columns = np.stack([*before, np.where(c < least_pair, counts.value.like(symbols), symbols), doc << 1 | trains[doc]]).astype(np.uint32)
                group = (mix(before[0].astype(np.uint64)) % np.uint64(groups)).astype(np.int32 if groups > 1 << 15 else np.int16)
                order = np.argsort(before[0] << 32 | before[min(1, depth - 1)])  # in order they take half the room
                order = order[~apart[order]]
                order = order[np.argsort(group[order], kind="stable")]
                columns, group = columns[:, order], group[order]
                edges = np.flatnonzero(np.diff(group, prepend=groups)) if len(group) else np.zeros(0, np.int64)
                out = [(int(group[a]), chunk.as_py(), _squeeze(list(columns[:, a:b]))) for a, b in zip(edges, [*edges[1:], len(group)])]
                out.append((-1 - int(_bucket(np.array([chunk.as_py()]), buckets)[0]), chunk.as_py(), np.stack(sums).astype(np.float64).tobytes()))
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.binary()))], ["group", "chunk", "blob"])

    return chunks.mapInArrow(lambda b: tidy(rows(b)), "group long, chunk long, blob binary")


def _classes(high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different keys (``high`` and ``low`` 32 bits) in order, and the class of each key, in less room than ``np.unique`` takes."""
    keys = high.astype(np.int64)
    keys <<= 32
    keys |= low
    order = np.argsort(keys)
    keys = keys[order]
    new = np.ones(len(keys), bool)
    np.not_equal(keys[1:], keys[:-1], out=new[1:])
    keys, of = keys[new], np.empty(len(keys), np.int32)
    of[order] = np.cumsum(new, dtype=np.int32) - 1
    return keys, of


def _log10(before: np.ndarray, w: np.ndarray, trains: np.ndarray, counts: Counts, least: tuple[int, int, int], min_gain: float) -> np.ndarray:
    """Of each symbol after those before it (the latest first), in the tree that the training ones give."""
    least_word, least_context, least_pair = least
    leads, follows = counts.below(max(least_word, least_context)), w < counts.below(max(least_word, least_pair))
    node, levels, keys, shorter = np.zeros(len(w), np.int32), [], None, None
    while before:
        symbol = before.pop(0)
        on = (node >= 0) & (symbol < leads)
        each, of = _classes(node[on], symbol[on])
        size = np.bincount(of[trains[on]], minlength=len(each))
        held = size >= least_context
        node = np.full(len(w), -1, np.int32)
        node[on] = np.where(held, np.cumsum(held) - 1, -1).astype(np.int32)[of]
        del on, of, symbol
        parent, size = each[held] >> 32, size[held]
        at = (node >= 0) & follows
        each, of = _classes(node[at], w[at])
        n = np.bincount(of[trains[at]], minlength=len(each))
        held = n >= least_pair
        pair = np.full(len(w), -1, np.int32)
        pair[at] = np.where(held, np.cumsum(held) - 1, -1).astype(np.int32)[of]
        del at, of
        each, n = each[held], n[held]
        s, word = each >> 32, each & NONE
        rest = 1 - np.bincount(s, (n - DISCOUNT) / size[s], len(size))
        q = counts.root(word) if keys is None else shorter[np.searchsorted(keys, parent[s] << 32 | word)]
        p = (n - DISCOUNT) / size[s] + rest[s] * q
        gain = np.bincount(s, n * np.log2(p / q), len(size))
        stays = (gain >= min_gain) & (np.bincount(s, minlength=len(size)) > 0)
        levels.append((node, pair, parent, stays, rest, p))
        keys, shorter = each, p
    for (*_, above, _, _), (_, _, parent, stays, _, _) in zip(levels[-2::-1], levels[:0:-1]):
        above[parent[stays]] = True
    out = np.log10(counts.root(w))
    for node, pair, _, stays, rest, p in levels:
        on = np.flatnonzero(node >= 0)
        on = on[stays[node[on]]]
        hit = pair[on] >= 0
        out[on[~hit]] += np.log10(rest[node[on[~hit]]])
        out[on[hit]] = np.log10(p[pair[on[hit]]])
    return out


def _sums(windows: DataFrame, counts, depth: int, buckets: int, least: tuple[int, int, int], min_gain: float) -> DataFrame:
    """(chunk, doc, n_tokens, n_known, base, score) of each row of the chunks.

    A group adds one packed row for each bucket of chunks: the ``chunks``, ``at`` (which of these, and the row in it), and float64 ``sums`` for each place.
    """
    schema = "chunk long, doc long, n_tokens long, n_known long, base double, score double"
    packed = T.StructType().add("bucket", "long").add("chunks", T.ArrayType(T.LongType())).add("at", "binary").add("sums", "binary")

    def judge(group: pa.Table) -> pa.Table:
        chunk, blobs = group["chunk"].to_numpy(), [b.as_buffer() for b in group["blob"]]
        first = group["group"][0].as_py()
        if first < 0:
            whole = [np.arange(b.size // 32) for b in blobs]
            out = [(-1 - first, [c], _squeeze([np.zeros_like(x), x]), b.to_pybytes()) for c, x, b in zip(chunk.tolist(), whole, blobs)]
            return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), to_arrow_schema(packed))], schema=to_arrow_schema(packed))
        sizes = [int.from_bytes(bytes(b[:8]), "little") for b in blobs]
        *before, w, doc = (np.empty(sum(sizes), np.uint32) for _ in range(depth + 2))
        for b, n, end in zip(blobs, sizes, np.cumsum(sizes)):
            for to, column in zip((*before, w, doc), _spread(b, depth + 2)):
                to[end - n : end] = column
        order, own = np.argsort(before[0], kind="stable"), np.repeat(np.arange(len(sizes), dtype=np.uint32), sizes)
        for x in (*before, w, doc, own):
            x[:] = x[order]
        del order
        # the subtrees of the first words are judged some at a time, to hold less
        starts = np.flatnonzero(np.diff(before[0])) + 1
        cuts = starts[np.minimum(np.searchsorted(starts, np.arange(STEP, len(w), STEP)), len(starts) - 1)] if len(starts) else starts
        score, cuts = np.empty(len(w)), [0, *np.unique(cuts).tolist(), len(w)]
        for a, b in zip(cuts, cuts[1:]):
            score[a:b] = _log10([x[a:b] for x in before], w[a:b], doc[a:b] & 1 == 1, counts.value, least, min_gain)
        del before, w
        each, of = _classes(own, doc >> 1)
        score, of, doc = np.bincount(of, score), each >> 32, each & NONE
        bucket, out = _bucket(chunk, buckets), []
        for b in np.unique(bucket).tolist():
            on = np.flatnonzero(bucket[of] == b)
            chunks, which = np.unique(of[on], return_inverse=True)
            out.append((b, chunk[chunks].tolist(), _squeeze([which, doc[on]]), score[on].tobytes()))
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), to_arrow_schema(packed))], schema=to_arrow_schema(packed))

    def total(bucket: pa.Table) -> pa.Table:
        parts = [(np.asarray(c.as_py()), *_spread(at.as_py(), 2), np.frombuffer(x.as_buffer(), np.float64)) for c, at, x in zip(*[bucket[k] for k in ("chunks", "at", "sums")])]
        own = [(int(c[0]), x.reshape(4, -1)) for c, _, doc, x in parts if len(x) == 4 * len(doc)]
        size = [x.shape[1] for _, x in own]
        begin = {c: int(b) for (c, _), b in zip(own, np.cumsum([0, *size]))}
        tokens, known, base, score = np.concatenate([x for _, x in own], axis=1)
        for chunks, which, doc, x in parts:
            if len(x) == len(doc):
                score[np.array([begin[c] for c in chunks.tolist()])[which] + doc] += x
        of, doc = np.repeat([c for c, _ in own], size), np.concatenate([np.arange(n) for n in size])
        return pa.table([of, doc, tokens.astype(np.int64), known.astype(np.int64), base, score], [c.split()[0] for c in schema.split(", ")])

    # a list, as tidy gives memory back when it is read to the end
    parts = windows.groupBy("group").applyInArrow(lambda t: list(tidy(iter([judge(t)])))[0], packed)
    return parts.groupBy("bucket").applyInArrow(total, schema)


def score(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", depth: int = DEPTH, word_share: float = 0.0, context_share: float = 0.0,
    pair_share: float = 0.0, min_gain: float = MIN_GAIN, min_context: int = MIN_CONTEXT, min_pair: int = MIN_PAIR,
) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row; trained on the rows that are not held out.

    Words, contexts and successors below a share of all tokens are left out of the tree if shares are given.
    """
    spark = docs.sparkSession
    df = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"), held_out(F.col(id_column)).alias("held_out"))
    train = df.where("not held_out")
    words_ = _numbered(_count_words(train))
    ends = train.count()
    steps = words_.groupBy("c").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("c").desc()).toArrow()
    value, n = steps["c"].to_numpy(), steps["n"].to_numpy()
    distinct, total = int(n.sum()), int((value * n).sum()) + ends
    first = np.concatenate([[0, 1], 1 + np.cumsum(n)]).astype(np.int64)
    counts = Counts(first, np.concatenate([[ends], value, [0]]).astype(np.int64), total, distinct + (ends > 0))
    counts = spark.sparkContext.broadcast(counts)

    common = words_.where(F.col("c") >= math.ceil(DICTIONARY_SHARE * total)).orderBy("number").select("word").toArrow()
    known = common["word"].combine_chunks() if len(common) else pa.array([], pa.string())
    chunks = store_by(_encode(df, spark.sparkContext.broadcast(known)), "encoded", "chunk", int(spark.conf.get("spark.sql.shuffle.partitions")))
    others = chunks.select("chunk", F.posexplode("others").alias("k", "word")).join(words_.where(F.col("number") > len(known)), "word")
    numbers = others.groupBy("chunk").agg(F.collect_list(F.shiftleft(F.col("k").cast("long"), 32) + F.col("number")).alias("numbers"))
    whole = chunks.select("chunk", F.col("docs.held_out").alias("held"), "ids", "till").join(numbers, "chunk", "left")

    least = max(1, math.ceil(word_share * total)), max(min_context, math.ceil(context_share * total)), max(min_pair, math.ceil(pair_share * total))
    buckets = max(BUCKETS, total // (4 * HELD))
    windows = _windows(whole, counts, depth, 1 + total // HELD, buckets, least)
    sums = _sums(windows, counts, depth, buckets, least, min_gain)
    rows = chunks.select("chunk", F.posexplode("docs").alias("doc", "of"))
    return rows.join(sums, ["chunk", "doc"]).select(
        F.col("of.id").alias(id_column), "of.held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"),
        F.col("base").alias("base_score"), "score",
    )
