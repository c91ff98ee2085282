"""The registered queries and the pipeline on the given tables."""

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tools")]

import __spark_entry__ as entry_points  # noqa: E402
import check_sql  # noqa: E402
import corpus_pipeline  # noqa: E402
from eventlake.llm import queries as Q  # noqa: E402
from eventlake.llm.common import stored  # noqa: E402


@pytest.mark.parametrize("name", sorted(Q.ORACLE))
def test_query_equals_its_sql(spark, sf, name):
    assert check_sql.compare(spark, check_sql.duck(sf), name, sf) is None


def test_all_are_registered():
    numbers = {int(name[2:].split("_")[0]) for name in Q.QUERIES}
    assert numbers == set(range(1, 14))
    assert set(Q.QUERIES) | {"pipeline"} <= set(entry_points.queries())


def test_pipeline_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    first, columns = docs.count(), docs.columns
    counts = [first]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, sf), f"test-{name}")
        assert docs.columns == columns
        counts.append(docs.count())
    assert counts == sorted(counts, reverse=True) and counts[-1] > 0
    pieces = corpus_pipeline.run(spark, sf)
    assert {r.doc_id for r in pieces.select("doc_id").collect()} == {r.doc_id for r in docs.select("doc_id").collect()}


def test_pipeline_of_nothing(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").filter("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf)
        assert docs.count() == 0
