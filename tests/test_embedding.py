import numpy as np

from corpusflow.functions.vectors import embed_with, hash_model, with_hash_embedding


def test_model_is_made_once_per_worker_and_gets_all_columns(spark):
    def make():
        made = np.random.default_rng().integers(1 << 40)

        def predict(a, b):
            return np.array([[len(x), len(y), made] for x, y in zip(a, b)], dtype=np.float64)

        return predict

    df = spark.createDataFrame([(i, "x" * i, None if i % 3 else "yy") for i in range(200)], "k int, a string, b string").coalesce(1)
    got = embed_with(df, ["a", "b"], "v", make, prefix="query: ", batch=16).collect()
    assert all(r.v[:2] == [7 + r.k, 0 if r.k % 3 else 2] for r in got)
    assert len({r.v[2] for r in got}) == 1


def test_default_model_equals_the_default_embedder(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    a = {r.doc_id: r.v for r in embed_with(docs, ["text"], "v", hash_model(32)).collect()}
    b = {r.doc_id: r.v for r in with_hash_embedding(docs, "text", "v", 32).collect()}
    assert a.keys() == b.keys() and all(np.allclose(a[i], b[i]) for i in a)
