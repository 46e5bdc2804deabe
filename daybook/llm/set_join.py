"""Exact Jaccard self-join of word-shingle sets, with skipping over lists and over related sets.

**Sets.** A document becomes the set of its distinct shingles (hashed to 64 bits, kept sorted). Documents with
equal sets form one class; only classes are joined.

**Index lists by position.** Similar sets of sizes x <= y differ in at most D(x) = x (100 - p) / p shingles. The
hash space is cut into blocks, more for larger sets (by power of two of the size; a set that may have a partner in the
next power is indexed there too). A difference spoils one block, so among the first D + 1 blocks of a set that are
not empty, one is the same in both sets. Its content, with its place, is the key of an index list. All blocks after these positions are
skipped, unread. A set with too few filled blocks lists all of them and its empty ones, which again leaves no pair
out. A key stands for several shingles, so a passage shared by many documents does not make long lists.

**Answers of related sets.** In each list the least set leads. Round one compares every set of a list with its leader
only, so a group of m near copies costs m comparisons. Sets linked to the leader take over its answers: they are in one
component. Round two compares only sets of lists with one leader that are still in different components, in blocks of bounded size, by a sketch
(one byte per hash cell; cells that differ are a lower bound of the difference). What passes is compared exactly.

Counting lists combines within tasks first; hot lists are split by adaptive joins or, in round two, by block pairs. Nothing is capped.

Null or empty texts have the empty set, linked with nothing. Documents with repeated ids and texts are
reported each. A null id takes part, and loses against any other id as name of a component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import LOWER, ODD, components, hashes_of, maybe_in, mix, slices, store, tidy, without, words

BLOCK = 1024
LIST_BITS = 1 << 24

IS_WORD = np.ones(256, bool)
IS_WORD[[32, 9, 10, 11, 12, 13]] = False
SEED = 11


def shingle_sets(text: pa.Array, width: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(first row, sorted distinct shingle hashes of each row) of slices of a column."""
    for row, _, data, offsets in slices(text):
        data = LOWER[data]
        start, end, first = words(data, offsets, IS_WORD)
        hashes = hashes_of(data, start, end, SEED)
        size = max(len(hashes) - width + 1, 0)
        joined = hashes[:size]
        for k in range(1, width):
            joined = mix(joined * ODD + hashes[k : k + size])
        sets = []
        for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
            if b - a >= width:
                sets.append(np.unique(joined[a : b - width + 1]))
            elif b > a:
                short = np.array([b - a], np.uint64)
                for k in range(a, b):
                    short = mix(short * ODD + hashes[k : k + 1])
                sets.append(short)
            else:
                sets.append(np.zeros(0, np.uint64))
        yield row, sets


def difference(size: int, percent: int) -> int:
    """Most shingles in which a set of this size differs from any set similar to it."""
    return size * (100 - percent) // percent


def block_keys(tokens: np.ndarray, percent: int) -> np.ndarray:
    """Keys of the index lists of a set."""
    size = len(tokens)
    allowed = difference(size, percent)
    if not allowed:
        return np.zeros(0, np.uint64)
    level = size.bit_length()
    out = []
    for k in (level, level + 1) if size * 100 // percent >= 1 << level else (level,):
        blocks = difference(1 << k, percent) + 3
        blocks += blocks // 64
        place = ((tokens >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)
        begin = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        filled = begin[: allowed + 1]
        content = np.add.reduceat(mix(tokens), begin)[: len(filled)]
        out.append(mix(content * ODD + np.uint64(k)))
        if len(begin) <= allowed:
            empty = np.setdiff1d(np.arange(blocks, dtype=np.uint64), place)
            out.append(mix(mix(empty + np.uint64(1)) * ODD ^ np.uint64(k)))
    return np.concatenate(out)


def sketch(tokens: np.ndarray) -> bytes:
    """One byte per cell of the hash space, as many cells as the next power of two above the size, 16 at least."""
    bits = max(4, len(tokens).bit_length())
    cell = (tokens >> np.uint64(64 - bits)).astype(np.int64)
    out = np.zeros(1 << bits, np.uint8)
    np.bitwise_xor.at(out, cell, ((tokens >> np.uint64(3)) & np.uint64(255)).astype(np.uint8))
    return out.tobytes()


def _identity(tokens: np.ndarray) -> tuple[int, int]:
    a = mix(np.array([tokens.sum(dtype=np.uint64), mix(tokens).sum(dtype=np.uint64)]) + np.uint64(len(tokens)))
    return int(a[0].view(np.int64)), int(mix(tokens ^ ODD).sum(dtype=np.uint64).view(np.int64))


def _index(batches: Iterator[pa.RecordBatch], width: int, percent: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, sets in shingle_sets(batch.column(2), width):
            identities = [_identity(tokens) for tokens in sets]
            keys = [block_keys(tokens, percent).view(np.int64) for tokens in sets]
            ends = np.concatenate([[0], np.cumsum([len(k) for k in keys])]).astype(np.int32)
            own = batch.slice(row, len(sets))
            columns = [
                own.column(0), own.column(1), pa.array([len(tokens) for tokens in sets], pa.int64()), pa.array([a for a, _ in identities], pa.int64()),
                pa.array([b for _, b in identities], pa.int64()), pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(keys))),
            ]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)


def _sketches(batches: Iterator[pa.RecordBatch], width: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, sets in shingle_sets(batch.column(1), width):
            columns = [batch.column(0).slice(row, len(sets)), [_identity(t)[0] for t in sets], [len(t) for t in sets], [sketch(t) for t in sets]]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _tokens(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, sets in shingle_sets(batch.column(0), width):
            columns = [pa.array([_identity(t)[0] for t in sets], pa.int64()), pa.array([t.tobytes() for t in sets], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["h", "tokens"])


def allowed_difference(a, b, percent: int):
    """Most differing shingles of two similar sets of sizes a and b."""
    return (a + b) * (100 - percent) // (100 + percent)


def folded(cells: np.ndarray, size: int) -> np.ndarray:
    """Sketches (rows) with fewer cells."""
    while cells.shape[-1] > size:
        cells = cells[..., 0::2] ^ cells[..., 1::2]
    return cells


def _near(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b, na, nb, sa, sb) whose sketches allow that they are similar."""
    for batch in batches:
        a, b, na, nb, sa, sb = batch.columns
        na, nb = na.to_numpy(), nb.to_numpy()
        limit = allowed_difference(na, nb, percent)
        keep = []
        for row, (x, y) in enumerate(zip(sa, sb)):
            x, y = np.frombuffer(x.as_buffer(), np.uint8), np.frombuffer(y.as_buffer(), np.uint8)
            size = min(len(x), len(y))
            keep.append(np.count_nonzero(folded(x, size) != folded(y, size)) <= limit[row])
        mask = pa.array(keep, pa.bool_())
        yield pa.RecordBatch.from_arrays([a.filter(mask), b.filter(mask)], names=["a", "b"])


def _exact(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b, ta, tb) that are similar."""
    for batch in batches:
        a, b, ta, tb = batch.columns
        keep = []
        for x, y in zip(ta, tb):
            x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            common = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(100 * common >= percent * (len(x) + len(y) - common))
        mask = pa.array(keep, pa.bool_())
        yield pa.RecordBatch.from_arrays([a.filter(mask), b.filter(mask)], names=["a", "b"])


def unlinked_pairs(ids: np.ndarray, parts: np.ndarray, sides: np.ndarray, sizes: np.ndarray, sketches: list[bytes], percent: int) -> list[tuple[int, int]]:
    """Pairs of sets in different components that may be similar; if there are two sides, only pairs across."""
    across = len(set(sides.tolist())) > 1
    order = np.argsort(sizes, kind="stable")
    ids, parts, sides, sizes = ids[order], parts[order], sides[order], sizes[order]
    cells = [np.frombuffer(sketches[i], np.uint8) for i in order]
    widths = np.array([len(c) for c in cells])
    tables = {w: np.stack([c for c in cells if len(c) == w]) for w in set(widths.tolist())}
    offset = {w: int(np.searchsorted(widths, w)) for w in tables}
    small = {w: folded(t, w // 2) for w, t in tables.items() if w // 2 in tables}
    out = []
    for i in range(len(ids)):
        last = int(np.searchsorted(sizes, sizes[i] * 100 // percent, "right"))
        width = int(widths[i])
        for w, table in ((width, tables[width]), (2 * width, small.get(2 * width))):
            if table is None:
                continue
            low, high = max(i + 1, offset[w]), min(last, offset[w] + len(table))
            if low >= high:
                continue
            wanted = parts[low:high] != parts[i]
            if across:
                wanted &= sides[low:high] != sides[i]
            j = np.flatnonzero(wanted) + low
            if len(j):
                differ = np.count_nonzero(table[j - offset[w]] != cells[i], axis=1)
                for k in j[differ <= allowed_difference(sizes[j], sizes[i], percent)].tolist():
                    out.append((int(ids[i]), int(ids[k])))
    return out


def _rings(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Rows (lead, low, high, side, h, part, n, sketch), sorted by the first three; one group at a time is compared."""
    held: list[tuple] = []
    key = None
    found: set[tuple[int, int]] = set()

    def close() -> None:
        if len(held) > 1:
            _, _, _, sides, ids, parts, sizes, cells = zip(*held)
            pairs = unlinked_pairs(np.array(ids), np.array(parts), np.array(sides), np.array(sizes), list(cells), percent)
            found.update((min(p), max(p)) for p in pairs)

    def out() -> pa.RecordBatch:
        pairs = sorted(found)
        found.clear()
        return pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)], names=["a", "b"])

    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns]):
            if row[:3] != key:
                close()
                held, key = [], row[:3]
                if len(found) > 100_000:
                    yield out()
            held.append(row)
    close()
    yield out()


def similar_sets(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", width: int = 3, percent: int = 90) -> DataFrame:
    """Per row of ``docs``: id, key of its text, size of its set, and the least id that links reach."""
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = docs.sparkSession
    texts = docs.select(F.col(id_column).alias("id"), F.xxhash64(text_column).alias("text_key"), F.col(text_column).cast("string").alias("text"))
    kind = texts.schema["id"].dataType.simpleString()
    shape = spark.createDataFrame([], f"id {kind}, text_key long, n long, h long, h2 long, keys array<long>").schema
    arrow = to_arrow_schema(shape)
    rows = store(texts.mapInArrow(lambda batches: tidy(_index(batches, width, percent, arrow)), shape), "set-rows")
    classes = store(rows.where("n > 0").groupBy("n", "h", "h2").agg(F.min("id").alias("rep")), "set-classes")

    entries = rows.select("h", F.explode("keys").alias("key"))
    lists = entries.groupBy("key").agg(F.min("h").alias("lead"), F.max("h").alias("top")).where("lead <> top").select("key", "lead")
    lists = store(lists, "set-lists")
    stars = maybe_in(entries, F.col("key"), lists, "key", LIST_BITS).join(lists, "key").where("h <> lead").select("lead", "h").distinct()
    stars = store(stars, "set-stars")

    active = stars.select("h").unionAll(stars.select(F.col("lead").alias("h"))).distinct()
    chosen = store(classes.join(active, "h").select(F.col("rep").alias("chosen"), F.col("h").alias("of")), "set-chosen")
    # not semi joins: they would be moved below the bitmap
    cells = spark.createDataFrame([], f"id {kind}, h long, n long, sketch binary").schema
    cells_arrow = to_arrow_schema(cells)
    needed = maybe_in(texts.select("id", "text"), F.col("id"), chosen, "chosen").mapInArrow(lambda batches: tidy(_sketches(batches, width, cells_arrow)), cells)
    sets = needed.join(chosen, F.col("id").eqNullSafe(F.col("chosen")) & (F.col("h") == F.col("of"))).select("h", "n", "sketch")
    sets = store(sets, "set-sketches")

    def verified(pairs: DataFrame) -> DataFrame:
        """The stored ``pairs`` that are similar; only their own sets are built in full and shuffled."""
        ends = pairs.select(F.col("a").alias("of")).unionAll(pairs.select(F.col("b").alias("of"))).distinct()
        own = store(chosen.join(ends, "of").select("chosen").distinct(), "set-wanted")
        whole = maybe_in(texts.select("id", "text"), F.col("id"), own, "chosen").join(own, F.col("id").eqNullSafe(F.col("chosen")))
        full = store(whole.select("text").mapInArrow(lambda batches: tidy(_tokens(batches, width)), "h long, tokens binary"), "set-tokens")
        a = full.select(F.col("h").alias("a"), F.col("tokens").alias("ta"))
        b = full.select(F.col("h").alias("b"), F.col("tokens").alias("tb"))
        both = pairs.join(a, "a").join(b, "b").select("a", "b", "ta", "tb")
        return both.mapInArrow(lambda batches: tidy(_exact(batches, percent)), "a long, b long").distinct()

    a = sets.select(F.col("h").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa"))
    b = sets.select(F.col("h").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))
    first = stars.select(F.col("lead").alias("a"), F.col("h").alias("b")).join(a, "a").join(b, "b")
    first = first.where((F.least("na", "nb") * 100) >= F.greatest("na", "nb") * percent).select("a", "b", "na", "nb", "sa", "sb")
    first = store(first.mapInArrow(lambda batches: tidy(_near(batches, percent)), "a long, b long").distinct(), "set-near")
    links = store(verified(first), "set-links")

    parts = store(components(links), "set-parts")
    members = stars.join(parts.withColumnRenamed("node", "h"), "h", "left").select("lead", "h", F.coalesce("component", "h").alias("part"))
    members = store(members, "set-members")
    groups = members.groupBy("lead").agg(F.count(F.lit(1)).alias("size"), F.min("part").alias("p"), F.max("part").alias("q")).where("p <> q")
    open_ = members.join(groups.select("lead", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks")), "lead")
    open_ = open_.withColumn("side", F.pmod(F.xxhash64("h"), F.col("blocks")).cast("int"))
    open_ = open_.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    open_ = open_.join(sets.select("h", "n", "sketch"), "h").select(
        "lead", F.least("side", "other").alias("low"), F.greatest("side", "other").alias("high"), "side", "h", "part", "n", "sketch"
    )
    open_ = open_.repartition("lead", "low", "high").sortWithinPartitions("lead", "low", "high")
    rings = store(open_.mapInArrow(lambda batches: tidy(_rings(batches, percent)), "a long, b long").distinct(), "set-rings")
    more = store(verified(rings), "set-links")

    whole = store(components(links.unionAll(more)), "set-components")
    reps = classes.groupBy("h").agg(F.min("rep").alias("rep"))
    names = whole.join(reps.withColumnRenamed("h", "node"), "node").groupBy("component").agg(F.min("rep").alias("least"))
    named = whole.join(names, "component").select(F.col("node").alias("h"), "least")
    of_class = classes.join(named, "h", "left").select("n", "h", "h2", F.coalesce("least", "rep").alias("component_id"))
    found = rows.select("id", "text_key", "n", "h", "h2").join(of_class, ["n", "h", "h2"], "left")
    return found.select("id", "text_key", "n", F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"))


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", width: int = 3, percent: int = 90) -> DataFrame:
    """One row per document: size of its shingle set and the least id of its component."""
    found = similar_sets(docs, id_column, text_column, width, percent)
    return found.select(F.col("id").alias(id_column), F.col("n").alias("n_shingles"), "component_id")


def drop_near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each component, that with the least id; all columns stay.

    Rows that repeat both id and text stay together.
    """
    found = store(similar_sets(docs, id_column, text_column, width, percent), "set-verdicts")
    lost = found.where(~F.col("id").eqNullSafe(F.col("component_id"))).select("id", F.col("text_key"))
    return without(docs, {"id": F.col(id_column), "text_key": F.xxhash64(text_column)}, lost)
