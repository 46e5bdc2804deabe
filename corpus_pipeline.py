"""Cleaning and packing of a corpus: five stages, each over all rows that the one before kept.

1. ``toxicity``: documents whose score reaches the threshold go.
2. ``exact_dedup``: of equal texts the row with the largest id stays.
3. ``near_dedup``: of each component of documents linked by sets of 5-word shingles of Jaccard similarity 0.8 or more, the
   document with the least id stays.
4. ``decontaminate``: passages of benchmark items are cut out of the texts; the documents stay.
5. ``packing``: the texts are tokenised and packed into sequences.

All but the last return the columns of ``documents``. Each stage treats null, empty and repeated rows as its operator
states.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from daybook.llm import decontaminate as leaks
from daybook.llm import exact_dedup as copies
from daybook.llm import set_join, toxicity
from daybook.llm.common import store
from daybook.llm.queries import packed, query, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return copies.deduplicate(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return set_join.drop_near_duplicates(docs, width=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    size = "n_chars" if "n_chars" in docs.columns else None
    return leaks.remove_spans(docs, table(spark, sf_dir, "benchmark"), size_column=size)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packed(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("packing", pack),
]

#: A learned model, a transitive closure and a tokenizer: SQL cannot express them. Tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


query("pipeline", ORACLE_SQL)(run)
