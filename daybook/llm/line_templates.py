"""Line dedup by a tree of line templates: variable fields are generalised, and templates recurring in many documents go.

1. **Tree.** A line is split at white space. Words with a digit are fields (``<*>``). Its leaf has the depth ``DEPTH + 1``: the number of words, then the
   first ``DEPTH`` words, a field standing for itself. Leaves that lines of fewer than ``MIN_DOCS`` documents reach hold no recurring
   template and are left at once; this keeps nearly all lines out of what follows.
2. **Generalisation.** Within a leaf, the words of a line become fields one after another, those first that the fewest lines have at their
   place, as long as at least ``MIN_CONSTANT`` of its words are left. So each line has a chain of templates, from itself to the most general.
   Only the order of the words' frequencies counts, not their size: in a larger corpus the values of a variable field are as variable as in
   a small one. Places and words are counted, not compared pairwise. Lines that are equal but for fields are counted as one.
3. **Recurrence.** A template that lines of at least ``MIN_DOCS`` documents have in their chains is recurring; all these lines are dropped.

Texts travel to the numbers of their lines compressed one by one; documents without such lines do not travel.

Lines end at line feeds. Lines without words are kept and never a template. Null texts have no lines and stay null. Rows that repeat
both id and text count as one document and are reported each. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import maybe_in, store, tidy

DEPTH = 3
MIN_DOCS = 10
MIN_CONSTANT = 0.6
FIELD = "<*>"


def zipped(df: DataFrame) -> DataFrame:
    """``df`` with its column ``text`` compressed in ``zip``: its size in 8 bytes, then zstd; null stays null."""
    from pyspark.sql.pandas.types import to_arrow_schema

    others = [c for c in df.columns if c != "text"]
    shape = df.select(*others).schema.add("zip", "binary")
    arrow = to_arrow_schema(shape)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd", 1)
        for batch in batches:
            texts = (None if t is None else t.as_buffer() for t in batch["text"].cast(pa.large_binary()))
            zips = [None if t is None else t.size.to_bytes(8, "little") + codec.compress(t, asbytes=True) for t in texts]
            columns = [*(batch[c] for c in others), pa.array(zips, pa.binary())]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return df.mapInArrow(lambda b: tidy(rows(b)), shape)


def unzipped(zips: pa.Array) -> Iterator[str | None]:
    codec = pa.Codec("zstd")
    for z in zips:
        z = z.as_buffer()
        yield None if z is None else codec.decompress(z[8:], int.from_bytes(z[:8], "little"), asbytes=True).decode()


def _leaves(batches: Iterator[pa.RecordBatch], depth: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """(row, text) to (row, line, leaf): the number and the leaf of each line with words."""
    from daybook.llm.html_text import hashed

    for batch in batches:
        rows, lines, leaves = [], [], []
        for row, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            for number, line in enumerate((text or "").split("\n")):
                words = line.split()
                if words:
                    rows.append(row)
                    lines.append(number)
                    leaves.append(hashed(len(words), *map(masked, words[:depth])))
        columns = [pa.array(rows, pa.int64()), pa.array(lines, pa.int32()), pa.array(leaves, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, schema=schema)


def masked(word: str) -> str:
    return FIELD if any(c.isdigit() for c in word) else word


def _masked(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """(row, zip, lines) to (row, line, leaf, masked) of the listed lines: their words, fields replaced, with single spaces."""
    for batch in batches:
        out: list[tuple] = []
        for row, text, wanted in zip(batch.column(0).to_pylist(), unzipped(batch.column(1)), batch.column(2).to_pylist()):
            lines = text.split("\n")
            for entry in wanted:
                out.append((row, entry["line"], entry["leaf"], " ".join(map(masked, lines[entry["line"]].split()))))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)


def recurring_lines(texts: DataFrame, depth: int = DEPTH, min_docs: int = MIN_DOCS, min_constant: float = MIN_CONSTANT) -> DataFrame:
    """(row, line, template) of the lines of recurring templates; ``texts`` has a unique ``row`` and the text."""
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = texts.sparkSession
    shape = spark.createDataFrame([], "row long, line int, leaf long").schema
    arrow = to_arrow_schema(shape)
    lines = store(texts.select("row", "text").mapInArrow(lambda b: tidy(_leaves(b, depth, arrow)), shape), "line-leaves")
    busy = lines.groupBy("leaf").agg(F.min("row").alias("low"), F.max("row").alias("high"), F.count(F.lit(1)).alias("n"))
    busy = store(busy.where((F.col("n") >= min_docs) & (F.col("low") < F.col("high"))).select("leaf"), "line-busy")
    reached = maybe_in(lines, F.col("leaf"), busy, "leaf").join(busy, "leaf")
    per_leaf = reached.select("leaf", "row").distinct().groupBy("leaf").count().where(F.col("count") >= min_docs).select("leaf")
    held = reached.join(per_leaf, "leaf").groupBy("row").agg(F.collect_set(F.struct("line", "leaf")).alias("lines"))
    held = store(held.withColumnRenamed("row", "of"), "line-held")
    shape = spark.createDataFrame([], "row long, line int, leaf long, masked string").schema
    arrow_masked = to_arrow_schema(shape)
    wanted = zipped(maybe_in(texts.select("row", "text"), F.col("row"), held, "of")).join(held, F.col("row") == F.col("of")).select("row", "zip", "lines")
    found = wanted.mapInArrow(lambda b: tidy(_masked(b, arrow_masked)), shape)
    found = store(found.withColumn("shape", F.xxhash64("masked")), "line-masked")
    shapes, rows = _shapes(found, min_docs)
    dropped = store(_recurring_shapes(shapes, rows, depth, min_docs, min_constant), "line-shapes-dropped")
    return found.select("row", "line", "leaf", "shape").join(dropped, ["leaf", "shape"]).select("row", "line", "template")


def _shapes(found: DataFrame, min_docs: int) -> tuple[DataFrame, DataFrame]:
    """The different masked lines with their documents, ``frequent`` from ``min_docs`` on, and (leaf, shape, row) of the others."""
    rows = store(found.select("leaf", "shape", "row").distinct(), "line-rows")
    counts = rows.groupBy("leaf", "shape").agg(F.count(F.lit(1)).alias("docs")).withColumn("frequent", F.col("docs") >= min_docs)
    shapes = store(found.select("leaf", "shape", "masked").distinct().join(counts, ["leaf", "shape"]), "line-shapes")
    return shapes, rows.join(shapes.where("not frequent").select("leaf", "shape"), ["leaf", "shape"], "left_semi")


def _places(shapes: DataFrame, depth: int, min_docs: int, min_constant: float) -> DataFrame:
    """Per masked line: its words by place with their support, the number of constant words of its leaf, and of all words.

    The support of a word at its place is the sum of the documents of the masked lines of the leaf that have it there. Words whose
    support is below ``min_docs`` are left out: no template with them recurs.
    """
    place = ["leaf", "place", "word"]
    all_words = F.split("masked", " ")
    plain = lambda words: F.size(F.filter(words, lambda w: w != FIELD))
    wide = shapes.where(plain(all_words) >= F.size(all_words) * min_constant)
    kept = ["leaf", "shape", "frequent", "docs", plain(F.slice(all_words, 1, depth)).alias("fixed"), F.size(all_words).alias("size")]
    later = wide.select(*kept, F.posexplode(all_words).alias("place", "word")).where((F.col("place") >= depth) | (F.col("place") == F.col("size") - 1))
    # the words of the leaf itself are those of all its lines
    open_ = (F.col("place") >= depth) & (F.col("word") != FIELD)
    support = later.where(open_).groupBy(*place).agg(F.sum("docs").alias("support")).where(F.col("support") >= min_docs)
    entry = F.when(F.col("support").isNotNull(), F.struct("support", "place", F.xxhash64("word").alias("word")))
    return later.join(support, place, "left").groupBy("leaf", "shape", "frequent", "docs", "fixed", "size").agg(F.collect_list(entry).alias("words"))


def _generalised(places: DataFrame, min_constant: float) -> DataFrame:
    """(leaf, shape, frequent, docs, floor, template): each masked line with its words of least support made fields, one support after another."""
    floors = F.array_distinct(F.concat(F.transform("words", lambda w: w["support"]), F.array(F.lit((1 << 63) - 1))))
    at = places.select("*", F.explode(floors).alias("floor"))
    at = at.withColumn("words", F.filter("words", lambda w: w["support"] >= F.col("floor"))).where(F.col("fixed") + F.size("words") >= F.col("size") * min_constant)
    words = F.array_sort(F.transform("words", lambda w: F.struct(w["place"].alias("place"), w["word"].alias("word"))))
    return at.select("leaf", "shape", "frequent", "docs", "floor", F.xxhash64("leaf", words).alias("template"))


def _recurring_shapes(shapes: DataFrame, rows: DataFrame, depth: int, min_docs: int, min_constant: float) -> DataFrame:
    """(leaf, shape, template) of the masked lines of which a generalisation recurs, with the most special one that does.

    All generalisations of a frequent masked line recur. Those of rarer ones are counted by document, ``rows`` being theirs, where the
    documents of their masked lines are enough together.
    """
    places = store(_places(shapes, depth, min_docs, min_constant), "line-places")
    chain = _generalised(places, min_constant)
    sums = chain.groupBy("template").agg(F.sum("docs").alias("n"), F.max("frequent").alias("sure")).where(F.col("n") >= min_docs)
    likely = store(chain.join(sums.select("template", "sure"), "template").drop("docs"), "line-likely")
    counted = likely.where("not sure").join(rows, ["leaf", "shape"]).select("template", "row").distinct().groupBy("template").count()
    recurring = likely.where("sure").select("template").distinct().unionAll(counted.where(F.col("count") >= min_docs).select("template"))
    least = likely.join(recurring, "template", "left_semi").groupBy("leaf", "shape").agg(F.min("floor").alias("floor"))
    held = F.transform(F.filter("words", lambda w: w["support"] >= F.col("floor")), lambda w: w["place"])
    named = least.join(places, ["leaf", "shape"]).select("leaf", "shape", held.alias("held"))
    word = lambda w, i: F.when((i < depth) | F.array_contains("held", i), w).otherwise(F.lit(FIELD))
    return named.join(shapes, ["leaf", "shape"]).select("leaf", "shape", F.array_join(F.transform(F.split("masked", " "), word), " ").alias("template"))


def _kept(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, lines, dropped = [], [], []
        before = unzipped(batch.column(1)) if batch.schema.names[1] == "zip" else batch.column(1).to_pylist()
        for text, gone in zip(before, batch.column(2).to_pylist()):
            whole = text.split("\n") if text else []
            gone = set(gone or ())
            lines.append(len(whole))
            dropped.append(len(gone))
            texts.append("\n".join(line for number, line in enumerate(whole) if number not in gone) if gone else text)
        columns = [batch.column(0), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64()), pa.array(texts, pa.string())]
        yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)


def drop_recurring_lines(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """Per document: id, its lines, the lines dropped, and the text that is left."""
    from pyspark.sql.pandas.types import to_arrow_schema

    texts = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    texts = texts.withColumn("row", F.xxhash64("id", "text"))
    found = store(recurring_lines(texts, **options), "line-recurring")
    gone = store(found.select("row", "line").distinct().groupBy(F.col("row").alias("of")).agg(F.collect_list("line").alias("gone")), "line-gone")
    touched = zipped(maybe_in(texts, F.col("row"), gone, "of")).join(gone, F.col("row") == F.col("of"), "left").select("id", "zip", "gone")
    rest = maybe_in(texts, F.col("row"), gone, "of", inside=False).select("id", "text", F.lit(None).cast("array<int>").alias("gone"))
    kind = texts.schema["id"].dataType.simpleString()
    shape = docs.sparkSession.createDataFrame([], f"`{id_column}` {kind}, n_lines long, n_dropped long, text string").schema
    arrow = to_arrow_schema(shape)
    kept = lambda df: df.mapInArrow(lambda b: tidy(_kept(b, arrow)), shape)
    return kept(rest).unionAll(kept(touched))
