import os

import pytest
from pyspark.sql import functions as F

from corpusflow.operators import udf as U
from corpusflow.sources.upsert import bulk_upsert

SCHEMA = "k long, v array<float>, tag string"


def _files(root):
    return sorted(f for _, _, fs in os.walk(root) for f in fs if f.endswith(".parquet"))


def _rows(spark, path):
    return sorted(((r.k, list(r.v or []), r.tag) for r in spark.read.parquet(path).collect()), key=str)


def test_reruns_and_partial_sends_replace_by_key(spark, tmp_path):
    path = str(tmp_path / "index")
    rows = [(i * 7 - 500, [float(i), 1.0], "a") for i in range(300)] + [(None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    bulk_upsert(df, "k", path, rows=100)
    first = _files(path)
    bulk_upsert(df.repartition(5).unionByName(df), "k", path, rows=100)
    assert _files(path) == first
    assert _rows(spark, path) == sorted(((k, v or [], g) for k, v, g in rows), key=str)
    news = [(-500, [9.0, 9.0], "b"), (10 ** 12, [8.0], "b"), (None, [7.0], None)]
    bulk_upsert(spark.createDataFrame(news, SCHEMA), "k", path, rows=100)
    want = {r[0]: r for r in rows} | {r[0]: r for r in news}
    assert _rows(spark, path) == sorted(((k, v or [], g) for k, v, g in want.values()), key=str)


def test_other_keys_and_empty_tables(spark, tmp_path):
    path = str(tmp_path / "index")
    df = spark.createDataFrame([(f"key {i}", i) for i in range(200)], "k string, _b long")
    bulk_upsert(df, "k", path, bits=3)
    assert 1 < len(_files(path)) <= 8 and spark.read.parquet(path).distinct().count() == 200
    bulk_upsert(df.limit(0), "k", path, bits=3)
    assert spark.read.parquet(path).count() == 200


def test_a_failed_job_leaves_nothing(spark, tmp_path):
    path = str(tmp_path / "index")
    df = spark.range(400).select(F.col("id").alias("k"), F.array(F.lit(1.0).cast("float")).alias("v"), F.lit("a").alias("tag"))
    bulk_upsert(df, "k", path, rows=50)
    before = _rows(spark, path)
    bad = df.withColumn("tag", F.lit("b"))
    with pytest.raises(Exception, match="the index is down"):
        bulk_upsert(bad, "k", path, rows=50, client="tests.failing_index:make")
    assert _rows(spark, path) == before
    assert not os.path.exists(f"{path}/_staging") or not os.listdir(f"{path}/_staging")


def test_toxicity_takes_a_scorer(spark):
    df = spark.createDataFrame([(i, w) for i, w in enumerate(["bad", "good", "bad", "none", None])], "id long, text string")

    def scorer(texts):
        return [[] if t is None or t == "none" else [{"label": "toxic", "score": 1.0 if t == "bad" else 0.0}] for t in texts]

    r = U.evaluate_toxicity(df, "id", "text", scorer, "toxic").first()
    assert r.n == 3 and abs(r["mean"] - 2 / 3) < 1e-12 and abs(r["std"] - (2 / 9) ** 0.5) < 1e-12
    assert U.evaluate_toxicity(df.filter("text = 'bad'"), "id", "text", scorer, "toxic", n=1).first().n == 1
    assert U.evaluate_toxicity(df.limit(0), "id", "text", scorer, "toxic").first().n == 0
