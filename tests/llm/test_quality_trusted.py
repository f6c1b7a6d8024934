"""All trusted documents count, however they are joined."""

import pytest
from pyspark.sql import functions as F

from corpusforge.llm import quality_llr

N = 60_000


@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_every_trusted_document_counts(spark, threshold):
    docs = spark.range(N).select(F.col("id").alias("doc_id"), F.format_string("w%d", "id").alias("text"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        # As all documents are trusted, both multinomials are one and the same.
        weights = quality_llr.fit(docs, docs.select("doc_id")).first().weights
        half = quality_llr.fit(docs, docs.select("doc_id").where("doc_id % 2 = 0")).first().weights
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(weights) == quality_llr.BUCKETS and max(map(abs, weights)) < 1e-12
    assert min(half) < -0.01 and max(half) > 0.01
