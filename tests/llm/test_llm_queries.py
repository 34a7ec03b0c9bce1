"""The registered queries with SQL against it, the others for their columns; the pipeline against its stages."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))

from compare import connect, difference  # noqa: E402

import corpus_pipeline  # noqa: E402
from stayline.llm import queries  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_same_rows_as_sql(spark, name):
    assert difference(queries.QUERIES[name](spark, FOLDER), connect(FOLDER), queries.SQL[name]) is None


def test_all_operators_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


def test_pipeline(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    ids = {r[0] for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = corpus_pipeline.staged(stage(spark, docs, FOLDER))
        assert after.columns == docs.columns, name
        kept = {r[0] for r in after.select("doc_id").collect()}
        assert kept <= ids and len(kept) > 0.5 * len(ids), name
        docs, ids = after, kept
    packed = corpus_pipeline.run(spark, FOLDER).collect()
    assert {r.doc_id for r in packed} == ids
