"""From raw documents to packed training sequences, in five stages.

Each stage takes the documents that its predecessor kept and returns the same columns; the last returns the
pieces of packed sequences with their token ids. Between stages the rows are written as Parquet and read again, so a
lost executor repeats one stage's tasks at most. What a stage has written to the shared folder is deleted once the
next stage's rows are written.

Defined results: rows with a null id or text go through all stages like others (a null text is an empty one); of
rows with the same id and text one stays; an empty table gives an empty result; columns that stages don't know are kept,
whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stayline.llm import decontaminate, exact_dedup, jaccard_join, packing, toxicity
from stayline.llm.common import STAGED, discard, staged
from stayline.llm.queries import packing_model, table

#: No SQL: scores, near duplicates and packing can't be written in it.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model scores below its threshold; it learns from ``labels``."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with the same text up to white space, the one with the smallest id."""
    return exact_dedup.drop_exact_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links of Jaccard similarity connect, the one with the smallest id.

    Shingles of five words and a similarity of 0.8, as everywhere but in the operator's own query.
    """
    return jaccard_join.drop_near_duplicates(docs, rule=jaccard_join.Rule(shingle=5, percent=80))


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of token sequences that the documents are packed into, with their ids."""
    return packing.packed(docs, packing_model())


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("jaccard_join", drop_near_copies),
    ("decontaminate", drop_benchmark),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    before = len(STAGED)
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
        # The stage's rows, written last, stay; what led to them goes.
        rows = STAGED.pop()
        discard(spark, before)
        STAGED.append(rows)
    return STAGES[-1][1](spark, docs, sf_dir)
