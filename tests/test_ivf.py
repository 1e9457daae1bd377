import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusflow.operators import ivf
from corpusflow.operators import retrieval as H


def clusters(spark, n, dim=32, centres=200, parts=8):
    """``n`` vectors around seeded centres, made inside the tasks."""
    def make(batches):
        import pyarrow as pa

        mid = np.random.default_rng(0).standard_normal((centres, dim))
        for b in batches:
            ids = b.column("id").to_numpy()
            rng = np.random.default_rng(int(ids[0])) if len(ids) else None
            v = mid[ids % centres] + 0.7 * rng.standard_normal((len(ids), dim)) if len(ids) else np.zeros((0, dim))
            offs = pa.array(np.arange(0, (len(ids) + 1) * dim, dim), type=pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.ListArray.from_arrays(offs, pa.array(v.ravel()))], names=["item_id", "cv"])

    return spark.range(0, n, 1, parts).mapInArrow(make, "item_id long, cv array<double>")


def asked(corpus):
    return corpus.filter(F.col("item_id") % 20 == 0).select(F.col("item_id").alias("query_id"), F.col("cv").alias("qv"))


@pytest.mark.parametrize("n", [2_000, 40_000, 400_000])
def test_recall_holds_as_the_table_grows(spark, tmp_path, n):
    clusters(spark, n).write.parquet(str(tmp_path / "v"))
    corpus = spark.read.parquet(str(tmp_path / "v"))
    index = ivf.build(corpus)
    assert index.rows.count() == n
    hits, recall = ivf.search(asked(corpus), index, 5)
    assert recall >= 0.9
    # a fresh sample, told by brute force
    probe = asked(corpus).orderBy(F.xxhash64("query_id", F.lit(99))).limit(40)
    want = {(r.query_id, r.item_id) for r in H.knn(probe, corpus, 5).collect()}
    some = [q for q, _ in want]
    got = {(r.query_id, r.item_id) for r in hits.filter(F.col("query_id").isin(some)).select("query_id", "item_id").collect()}
    assert len(want & got) / len(want) >= 0.88
    probes, _ = ivf.measure(asked(corpus), index, 5, "dot", "query_id", 0.95, 0.9)
    if n > 2_000:
        assert probes < len(index.centroids) / 2  # a part of the cells is enough


def test_all_probes_are_exact_and_copies_spread(spark):
    rng = np.random.default_rng(4)
    v = rng.integers(-3, 4, (90, 4)).astype(float)
    v[30:60] = v[30]  # a third of all rows are copies
    corpus = spark.createDataFrame([(i, x.tolist(), i % 2) for i, x in enumerate(v)], "item_id long, cv array<double>, label int")
    corpus = corpus.unionByName(spark.createDataFrame([(900, None, 1)], "item_id long, cv array<double>, label int"))
    q = spark.createDataFrame([(i, v[i].tolist()) for i in range(0, 90, 9)] + [(99, None)], "query_id long, qv array<double>")
    index = ivf.build(corpus, cells=7)
    key = lambda df: {(r.query_id, r["rank"], r.item_id, r.label, round(r.score, 6)) for r in df.collect()}
    for metric in ("dot", "l2"):
        want = key(H.knn(q.filter("qv IS NOT NULL"), corpus.filter("cv IS NOT NULL"), 6, metric))
        for block in (3, 1000):
            hits, _ = ivf.search(q, index, 6, metric, probes=7, block=block)
            assert key(hits) == want


def test_empty_tables(spark):
    corpus = spark.createDataFrame([(1, [1.0, 2.0])], "item_id long, cv array<double>")
    q = spark.createDataFrame([(1, [1.0, 0.0])], "query_id long, qv array<double>")
    assert ivf.search(q.filter("false"), ivf.build(corpus), 3)[0].count() == 0
    assert ivf.search(q, ivf.build(corpus.filter("false")), 3)[0].count() == 0
    assert ivf.search(q, ivf.build(corpus), 3)[0].count() == 1


def test_probes_follow_the_places():
    assert ivf.probes_for(np.array([0, 0, 0, 9]), 0.75) == 1
    assert ivf.probes_for(np.array([0, 0, 0, 9]), 0.95) == 10
    assert ivf.probes_for(np.array([], dtype=int), 0.9) == 1
