"""Training-data queries against SQL, at the smallest scale."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from evigraph.llm import language_id, toxicity
from evigraph.llm.queries import ORACLES, QUERIES

from ..conftest import SF, same_as_sql


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, duck, name):
    same_as_sql(spark, duck, QUERIES[name], ORACLES[name])


def test_language_accuracy_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    found = QUERIES["op4_language_id"](spark, SF).filter("held_out").join(docs, "doc_id").collect()
    assert found and sum(r.lang == r.lang_pred for r in found) >= 0.95 * len(found)
    assert all(0 <= r.score <= 1 for r in found)


def test_toxicity_on_held_out_labels(spark):
    """Fitted on three quarters of the labelled documents, judged on the rest."""
    sf = SF.replace("sf0.001", "sf0.1")
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf}/labels.parquet").filter("toxic is not null")
    held = language_id.held_out(F.col("doc_id"))
    model = toxicity.fitted(labels.filter(~held).select("doc_id", F.col("toxic").alias("grade")), docs)
    found = toxicity.with_severity(docs.join(labels.filter(held).select("doc_id", "toxic").withColumnRenamed("toxic", "label"), "doc_id"), model).collect()
    assert len(found) > 500
    hits = sum(r.toxic and r.label == 1 for r in found)
    assert hits >= 0.8 * sum(r.label for r in found)
    assert sum(r.toxic and r.label == 0 for r in found) <= 0.02 * len(found)
