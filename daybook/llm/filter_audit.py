"""How five quality filters interact: for every order of the filters, what each step keeps, removes and removes in vain.

1. Each text is read once into a row without text: its part, the letters of the row filters it fails, and a SHA-256 digest.
2. The duplicate prepass is a counting Bloom filter over the digests. Each task counts the slots of its rows and the counts are
   added up. A text of which one slot was counted once is unique for certain; the slots counted more often become a bitmap of at most
   ``MAX_SLOTS`` bits (32 MB), whatever the size of the input, so it can be broadcast.
3. Only the possible repeats are shuffled: their whole texts are grouped, and each group gives its least id. Equal texts of one task
   are combined before the shuffle, so a group with a third of all rows sends one row per task. When the bitmap fills up, more rows pass
   it and the grouping does the work; the answer is the same.
4. The least ids are joined back by id and digest, the labels by id. Rows are then counted per part, failed filters and labels: at most
   128 sums per part, from which the counts of all 120 orders and five steps are added up.

Null texts, sources and ids: a null text is empty, a null source is the part ''. A null id is no smaller than another and has no smaller one, so
such a row never fails filter E and makes no other fail it. Rows that repeat both id and text are counted singly and share E's result. A label row without
id labels nothing; of several rows with one id, any 1 counts. An empty table gives no rows. Texts may be of any length a row can hold.
Other columns are ignored.
"""

from __future__ import annotations

import math
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from daybook.llm.common import store

FILTERS = "ABCDE"
MIN_WORDS = 200
MIN_DISTINCT_PERCENT = 50
MAX_CAPITAL_PERCENT = 2
SYMBOLS = r"[#$%&*|]"
PROBES = 2
SLOTS_PER_ROW = 16
MAX_SLOTS = 1 << 28


def row_failures(text: Column) -> Column:
    """Letters of the filters A to D that a text fails, in that order; the text must not be null."""
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    n_words, n_distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    fails = {
        "A": n_words < MIN_WORDS,
        "B": 100 * n_distinct < MIN_DISTINCT_PERCENT * n_words,
        "C": 100 * capitals.cast("long") > MAX_CAPITAL_PERCENT * F.length(text),
        "D": text.rlike(SYMBOLS),
    }
    return F.concat(*[F.when(f, F.lit(k)).otherwise(F.lit("")) for k, f in fails.items()])


def _slots(digest: Column, slots: int) -> Column:
    return F.array(*[F.pmod(F.xxhash64(digest, F.lit(k)), F.lit(slots)) for k in range(PROBES)])


def repeated_slots(digests: DataFrame, slots: int) -> DataFrame:
    """(block, bits): the slots of the counting filter that were counted more than once, 4096 to a row of 64 numbers."""
    counted = digests.select(F.explode(F.array_distinct(_slots(F.col("digest"), slots))).alias("slot")).groupBy("slot").count()
    bit = F.expr("shiftleft(1L, cast(slot % 64 as int))")
    words = counted.where("count > 1").groupBy(F.expr("slot div 64").alias("word")).agg(F.bit_or(bit).alias("bits"))
    entry = F.struct(F.expr("cast(word % 64 as int)"), F.col("bits"))
    blocks = words.groupBy(F.expr("word div 64").alias("block")).agg(F.map_from_entries(F.collect_list(entry)).alias("set"))
    return blocks.select("block", F.expr("transform(sequence(0, 63), i -> coalesce(try_element_at(set, i), 0L))").alias("bits"))


def possible_repeats(df: DataFrame, bitmap: DataFrame, slots: int) -> DataFrame:
    """The rows of ``df`` all of whose slots were counted more than once: every text that occurs twice, and few others."""
    columns = df.columns
    for k in range(PROBES):
        df = df.withColumn("__slot", _slots(F.col("digest"), slots)[k])
        df = df.join(F.broadcast(bitmap), F.expr("__slot div 4096") == F.col("block"))
        df = df.where("shiftright(bits[cast(__slot div 64 % 64 as int)], cast(__slot % 64 as int)) & 1 = 1").select(*columns)
    return df


def failures(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source", max_slots: int = MAX_SLOTS
) -> DataFrame:
    """(id, part, fails, n): documents by the letters of the filters that they fail; ``n`` is to be added up.

    Every document counts with the letters A to D. One that fails E counts again: once less without that letter, once more with it.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    read = docs.select(
        F.col(id_column).alias("id"), F.coalesce(F.col(source_column), F.lit("")).alias("part"), text.alias("text")
    ).withColumn("digest", F.unhex(F.sha2("text", 256)))
    flags = store(read.select("id", "part", "digest", row_failures(F.col("text")).alias("fails")), "filter-flags")
    slots = min(max_slots, 1 << max(12, math.ceil(math.log2(max(1, SLOTS_PER_ROW * flags.count())))))
    bitmap = store(repeated_slots(flags, slots), "filter-slots")
    repeats = possible_repeats(read.select("id", "digest", "text"), bitmap, slots)
    # the digest is one value per text, so grouping by both is grouping by the text
    first = repeats.groupBy("text", "digest").agg(F.min("id").alias("first")).where("first is not null")
    first = store(first.select(F.col("digest").alias("of"), "first"), "filter-first")
    suspects = possible_repeats(flags.where("id is not null"), bitmap, slots)
    later = suspects.join(first, (F.col("id") == F.col("first")) & (F.col("digest") == F.col("of")), "left_anti")
    moved = later.select("id", "part", F.explode(F.array(
        F.struct("fails", F.lit(-1).alias("n")), F.struct(F.concat("fails", F.lit("E")).alias("fails"), F.lit(1).alias("n"))
    )).alias("m"))
    return flags.select("id", "part", "fails", F.lit(1).alias("n")).unionAll(moved.select("id", "part", "m.fails", "m.n"))


def audit(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source",
    max_slots: int = MAX_SLOTS,
) -> DataFrame:
    """One row per part, order of the filters and step; columns part, filter_order, step and seven counts."""
    marks = labels.where(F.col(id_column).isNotNull()).groupBy(F.col(id_column).alias("of")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic")
    )
    marked = failures(docs, id_column, text_column, source_column, max_slots).join(
        marks.where("good or toxic"), F.col("id") == F.col("of"), "left"
    )
    good, toxic = (F.sum(F.when(F.col(c), F.col("n")).otherwise(0)).alias(c) for c in ("good", "toxic"))
    cells = marked.groupBy("part", "fails").agg(F.sum("n").alias("n"), good, toxic)
    orders = F.array(*[F.lit("".join(p)) for p in permutations(FILTERS)])
    steps = (
        store(cells, "filter-cells")
        .withColumn("filter_order", F.explode(orders))
        .withColumn("step", F.explode(F.array(*[F.lit(k + 1) for k in range(len(FILTERS))])))
        .withColumn("letter", F.expr("substring(filter_order, step, 1)"))
        .withColumn("before", F.expr("substring(filter_order, 1, step - 1)"))
    )
    fails, alone = F.contains("fails", "letter"), F.col("fails") == F.col("letter")
    there = F.expr("translate(before, fails, '') = before")

    def total(condition: Column, value: str = "n") -> Column:
        return F.sum(F.when(condition, F.col(value)).otherwise(0)).cast("long")

    found = steps.groupBy("part", "filter_order", "step", "letter").agg(
        total(there & ~fails).alias("kept"),
        total(there & fails).alias("removed"),
        total(~there & fails).alias("redundant"),
        total(alone).alias("unique_fails"),
        total(there & fails, "good").alias("good_lost"),
        total(there & fails, "toxic").alias("toxic_lost"),
    )
    whole = F.sum("removed").over(Window.partitionBy("part", "letter")).alias("shapley")
    return found.select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", whole)
