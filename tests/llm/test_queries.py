"""Registered queries against their SQL, and the pipeline's stages."""

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from waymark.llm.chat import OP2_SQL
from waymark.llm.queries import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"


def duck(sql):
    c = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        c.execute(f"create view {t} as select * from '{SMALL}/{t}.parquet'")
    r = c.execute(sql)
    return [d[0] for d in r.description], r.fetchall()


@pytest.mark.parametrize("name, sql", [*ORACLES.items(), ("op2_chat_windows", OP2_SQL)])
def test_query_matches_sql(spark, name, sql):
    names, want = duck(sql)
    got = [tuple(x) for x in QUERIES[name](spark, SMALL).select(*names).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_stages_keep_columns_and_shrink(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    n, columns = docs.count(), docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.columns == columns, name
        docs = spark.createDataFrame(out.toPandas(), out.schema)
        assert docs.count() <= n
        n = docs.count()
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)
    assert last.where("lossless").count() == n


def test_run(spark):
    out = corpus_pipeline.run(spark, SMALL)
    assert out.where(~F.col("lossless")).count() == 0 and out.count() > 0
