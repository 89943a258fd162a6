"""The queries that SQL can express, against DuckDB."""

import pytest

from check_oracle import compare, connect
from pyspark.sql import functions as F

from ratewise.llm import templates
from ratewise.llm.queries import LLM_ORACLES, LLM_QUERIES, ONE_VOTE_SQL


@pytest.mark.parametrize("name", list(LLM_ORACLES))
def test_query(spark, sf, name):
    got = LLM_QUERIES[name](spark, sf).toPandas()
    assert compare(got, connect(sf).execute(LLM_ORACLES[name]).df()) is None


def test_one_vote_a_leaf(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = templates.drop_recurring(docs, with_counts=True, depth=3, rounds=False)
    got = got.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))
    assert compare(got.toPandas(), connect(sf).execute(ONE_VOTE_SQL).df()) is None
