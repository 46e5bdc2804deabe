"""Benchmark passages in a corpus, found through an FM-index of every training shard.

The words of the benchmark items are numbered. A shard is a run of documents of about a megabyte inside one
task. Its words become numbers, 0 where a word occurs in no item; stretches too short for any window are left out,
which changes no answer, as no window can lie in them. Over what remains the task builds a suffix array (prefix
doubling), the Burrows-Wheeler transform, a wavelet tree for ranks and a sample of suffix positions. All test windows
are searched backwards at once; matches are walked to a sampled position, and the spans they cover are merged per document.

A window is ``window`` consecutive words of an item; an item with fewer words, but not none, is one window.
Words are runs of digits, letters a-z after lower-casing A-Z, and all bytes from 0x80 on.

Work per document depends on its length only: nothing is shuffled, and a lost task is simply run again. The
benchmark is the stated query set. It is searched in blocks of at most ``BLOCK_BYTES`` of text, each block broadcast
and passed over all documents; a result so far travels with its row from one block to the next.

Null or empty texts have no words; items without words are in no result. Rows repeated in the documents are reported each;
an item repeated in the benchmark counts once per distinct id. An empty benchmark leaves every document clean.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import LOWER, flat, hashes_of, slices, tidy, words

WINDOW = 10
BLOCK_BYTES = 8 << 20
SAMPLE = 8

IS_WORD = np.zeros(256, bool)
IS_WORD[48:58] = True
IS_WORD[97:123] = True
IS_WORD[128:] = True

SEED = 7


def hashed_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end of each word, and the first word of each row (with an end)."""
    data = LOWER[data]
    start, end, first = words(data, offsets, IS_WORD)
    return hashes_of(data, start, end, SEED), start, end, first


class Windows:
    """The distinct test windows of a block of items, as numbers of the block's words."""

    def __init__(self, item_ids: list, texts: list[str], window: int = WINDOW):
        column = pa.array(["" if t is None else t for t in texts], pa.string())
        hashes, _, _, first = hashed_words(*flat(column))
        self.vocabulary = np.unique(hashes)
        numbers = np.searchsorted(self.vocabulary, hashes).astype(np.int64) + 1
        items: dict[bytes, set[int]] = {}
        self.names = [str(i) for i in item_ids]
        for row in range(len(texts)):
            ids = numbers[first[row] : first[row + 1]]
            for at in range(max(1, len(ids) - window + 1) if len(ids) else 0):
                items.setdefault(ids[at : at + window].tobytes(), set()).add(row)
        patterns = [np.frombuffer(p, np.int64) for p in items]
        self.items = [sorted(s) for s in items.values()]
        self.lengths = np.array([len(p) for p in patterns], np.int64)
        self.patterns = np.zeros((len(patterns), window), np.int64)
        for row, p in enumerate(patterns):
            self.patterns[row, window - len(p) :] = p
        self.shortest = int(self.lengths.min()) if len(patterns) else 0

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.vocabulary, hashes)
        at[at == len(self.vocabulary)] = 0
        return np.where(self.vocabulary[at] == hashes, at + 1, 0) if len(self.vocabulary) else np.zeros(len(hashes), np.int64)


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Order of all suffixes by prefix doubling; zeros are ordered by their place, so each ends its suffixes."""
    size = len(text)
    zeros = text == 0
    key, width = np.where(zeros, np.cumsum(zeros), text + size), 0
    while True:
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        rank = np.empty(size, np.int64)
        rank[order] = np.cumsum(np.concatenate([[False], ordered[1:] != ordered[:-1]]))
        if rank[order[-1]] == size - 1:
            return order
        width = max(1, 2 * width)
        second = np.zeros(size, np.int64)
        second[: size - width] = rank[width:] + 1
        key = rank * (size + 1) + second


class FMIndex:
    """Backward search over numbers 0..top, with ranks from a wavelet tree stored level by level."""

    def __init__(self, text: np.ndarray, sample: int = SAMPLE):
        self.size = len(text)
        order = suffix_array(text)
        last = text[order - 1]
        self.bits = max(1, int(text.max()).bit_length())
        counts = np.bincount(text, minlength=(1 << self.bits) + 1)
        self.below = np.concatenate([[0], np.cumsum(counts)])
        self.levels, self.zeros = [], []
        symbols = last
        for level in range(self.bits - 1, -1, -1):
            bit = (symbols >> level) & 1
            self.levels.append(np.concatenate([[0], np.cumsum(bit)]))
            self.zeros.append(self.size - int(bit.sum()))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])
        sampled = (order % sample == 0) | (last == 0)  # zeros are not in the order of what follows them
        self.marks = np.concatenate([[0], np.cumsum(sampled)])
        self.sampled = sampled
        self.positions = order[sampled]
        self.last = last

    def rank(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before each row of the transform."""
        low = np.zeros(len(row), np.int64)
        high = row.copy()
        for i, ones in enumerate(self.levels):
            bit = (symbol >> (self.bits - 1 - i)) & 1
            one_low, one_high = ones[low], ones[high]
            low = np.where(bit == 1, self.zeros[i] + one_low, low - one_low)
            high = np.where(bit == 1, self.zeros[i] + one_high, high - one_high)
        return high - low

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows [from, to) of the suffixes that begin with each pattern (right-aligned in its row)."""
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.size, np.int64)
        width = patterns.shape[1]
        known = (patterns < (1 << self.bits)).all(axis=1)
        high[~known] = 0
        live = np.flatnonzero(known)
        for step in range(1, width + 1):
            live = live[(lengths[live] >= step) & (low[live] < high[live])]
            if not len(live):
                break
            symbol = patterns[live, width - step]
            low[live] = self.below[symbol] + self.rank(symbol, low[live])
            high[live] = self.below[symbol] + self.rank(symbol, high[live])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Position of the suffix of each row."""
        out, steps = np.zeros(len(rows), np.int64), 0
        where, rows = np.arange(len(rows)), rows.copy()
        while len(rows):
            done = self.sampled[rows]
            out[where[done]] = self.positions[self.marks[rows[done]]] + steps
            where, rows = where[~done], rows[~done]
            symbol = self.last[rows]
            rows = self.below[symbol] + self.rank(symbol, rows)
            steps += 1
        return out


def occurrences(numbers: np.ndarray, first: np.ndarray, windows: Windows) -> tuple[np.ndarray, np.ndarray]:
    """(window, first word) of every place in a shard where a window occurs; ``first``: first word of each document."""
    none = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if not len(windows.lengths) or not len(numbers):
        return none
    known = numbers > 0
    begins = known.copy()
    begins[1:] &= ~known[:-1]
    edges = first[:-1][first[:-1] < first[1:]]
    begins[edges] = known[edges]
    start = np.flatnonzero(begins)
    if not len(start):
        return none
    run = np.cumsum(begins) - 1
    length = np.bincount(run[known], minlength=len(start))
    keep = length >= windows.shortest
    place = np.flatnonzero(known)
    place = place[keep[run[place]]]
    if not len(place):
        return none
    fresh = np.concatenate([[True], run[place[1:]] != run[place[:-1]]])
    at = np.arange(len(place)) + np.cumsum(fresh)  # one 0 before each stretch
    text = np.zeros(len(place) + int(fresh.sum()) + 1, np.int64)
    text[at] = numbers[place]
    source = np.zeros(len(text), np.int64)
    source[at] = place
    index = FMIndex(text)
    low, high = index.search(windows.patterns, windows.lengths)
    count = high - low
    found = np.flatnonzero(count > 0)
    if not len(found):
        return none
    which = np.repeat(found, count[found])
    rows = np.arange(len(which)) - np.repeat(np.cumsum(count[found]) - count[found], count[found]) + low[which]
    return which, source[index.locate(rows)]


SCHEMA = "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"


def _search(batches: Iterator[pa.RecordBatch], block, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    windows: Windows = block.value
    for batch in batches:
        text = batch.column(batch.schema.get_field_index("__text"))
        spans, items, n_words = [], [], []
        for _, _, data, offsets in slices(text):
            hashes, _, _, first = hashed_words(data, offsets)
            which, place = occurrences(windows.numbers(hashes), first, windows)
            n_words += np.diff(first).tolist()
            row_of = np.searchsorted(first, place, "right") - 1
            by_row: dict[int, tuple[list, set]] = {}
            for w, p, row in zip(which.tolist(), place.tolist(), row_of.tolist()):
                entry = by_row.setdefault(row, ([], set()))
                entry[0].append((p - int(first[row]), p - int(first[row]) + int(windows.lengths[w])))
                entry[1].update(windows.items[w])
            for row in range(len(first) - 1):
                entry = by_row.get(row)
                spans.append(merged(entry[0]) if entry else [])
                items.append([windows.names[i] for i in entry[1]] if entry else [])
        so_far = batch.column(batch.schema.get_field_index("__spans")).to_pylist()
        names = batch.column(batch.schema.get_field_index("__items")).to_pylist()
        spans = [merged([(a, b) for a, b in zip(old[::2], old[1::2])] + new) if old and new else new or [(a, b) for a, b in zip(old[::2], old[1::2])] for old, new in zip((x or [] for x in so_far), spans)]
        names = [sorted({*(old or []), *new}) for old, new in zip(names, items)]
        columns = dict(zip(batch.schema.names, batch.columns))
        columns["__spans"] = pa.array([[x for s in row for x in s] for row in spans], pa.list_(pa.int64()))
        columns["__items"] = pa.array(names, pa.list_(pa.string()))
        columns["__words"] = pa.array(n_words, pa.int64())
        yield pa.RecordBatch.from_arrays([columns[f.name].cast(f.type) for f in schema], schema=schema)


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def blocks(benchmark: DataFrame, item_column: str, text_column: str, block_bytes: int) -> Iterator[tuple[list, list[str]]]:
    """Items in blocks of bounded size, fetched one block at a time."""
    ids, texts, size = [], [], 0
    for row in benchmark.select(item_column, text_column).where(F.col(text_column).isNotNull()).toLocalIterator():
        if ids and size + len(row[1]) > block_bytes:
            yield ids, texts
            ids, texts, size = [], [], 0
        ids.append(row[0])
        texts.append(row[1])
        size += len(row[1])
    yield ids, texts


def find_spans(
    docs: DataFrame, benchmark: DataFrame, text_column: str = "text", item_column: str = "item_id", item_text: str = "text",
    window: int = WINDOW, block_bytes: int = BLOCK_BYTES, finish=None, finished=None,
) -> DataFrame:
    """``docs`` with ``__words`` (number of words), ``__spans`` (hit words: from, to, from, to, ...) and ``__items``.

    ``finish``, if given, turns the last block's batches into rows of the schema ``finished`` in the same task.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = docs.sparkSession
    state = docs.withColumns({
        "__text": F.col(text_column).cast("string"), "__words": F.lit(0).cast("long"),
        "__spans": F.array().cast("array<long>"), "__items": F.array().cast("array<string>"),
    })
    schema = to_arrow_schema(state.schema)
    waiting = None
    for ids, texts in blocks(benchmark, item_column, item_text, block_bytes):
        if waiting is not None:
            state = state.mapInArrow(lambda batches, block=waiting: tidy(_search(batches, block, schema)), state.schema)
        waiting = spark.sparkContext.broadcast(Windows(ids, texts, window))
    if finish is not None:
        return state.mapInArrow(lambda batches: tidy(finish(_search(batches, waiting, schema))), finished)
    return state.mapInArrow(lambda batches: tidy(_search(batches, waiting, schema)), state.schema).drop("__text")


def contamination(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """Per document: number of words, words inside an occurrence of a window, and the items that occur."""
    found = find_spans(docs.select(F.col(id_column).alias("__id"), F.col(text_column).alias("text")), benchmark, "text", **options)
    hit = F.aggregate(
        F.sequence(F.lit(0), F.size("__spans") - 2, F.lit(2)), F.lit(0).cast("long"),
        lambda total, i: total + F.element_at("__spans", i + 2) - F.element_at("__spans", i + 1),
    )
    return found.select(
        F.col("__id").alias(id_column),
        F.col("__words").alias("n_words"),
        F.when(F.size("__spans") > 0, hit).otherwise(F.lit(0).cast("long")).alias("n_hit"),
        F.size("__items").cast("long").alias("n_items"),
        F.sha2(F.array_join("__items", ","), 256).alias("items_sha256"),
        (F.size("__spans") > 0).alias("contaminated"),
    )


def _cut(batches: Iterator[pa.RecordBatch], text_name: str, size_name: str | None, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Remove the bytes from the first to the last word of each span."""
    for batch in batches:
        sizes = batch.column(batch.schema.get_field_index(size_name)).to_pylist() if size_name else []
        texts = batch.column(batch.schema.get_field_index(text_name)).to_pylist()
        spans = batch.column(batch.schema.get_field_index("__spans")).to_pylist()
        for row, cut in enumerate(spans):
            if not cut:
                continue
            raw = texts[row].encode()
            data = np.frombuffer(raw, np.uint8)
            _, start, end, _ = hashed_words(data, np.array([0, len(data)]))
            parts, at = [], 0
            for a, b in zip(cut[::2], cut[1::2]):
                parts.append(raw[at : start[a]])
                at = int(end[b - 1])
            texts[row] = b"".join([*parts, raw[at:]]).decode()
            if size_name:
                sizes[row] = len(texts[row])
        columns = dict(zip(batch.schema.names, batch.columns))
        columns[text_name] = pa.array(texts, pa.string())
        if size_name:
            columns[size_name] = pa.array(sizes, schema.field(size_name).type)
        yield pa.RecordBatch.from_arrays([columns[f.name].cast(f.type) for f in schema], schema=schema)


def remove_spans(docs: DataFrame, benchmark: DataFrame, text_column: str = "text", size_column: str | None = None, **options) -> DataFrame:
    """``docs`` with the found passages cut out of the text; all other columns and rows stay as they are.

    ``size_column`` names a column that holds the length of the text, if there is one.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(docs.schema)
    return find_spans(docs, benchmark, text_column, finish=lambda batches: _cut(batches, text_column, size_column, schema), finished=docs.schema, **options)


__all__ = ["FMIndex", "Windows", "contamination", "find_spans", "occurrences", "remove_spans", "suffix_array"]
