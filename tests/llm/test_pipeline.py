import __spark_entry__
import corpus_pipeline
from corpusflow.llm import q_llm


def test_stages_on_odd_rows(spark, sf, odd_docs, no_docs):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "near duplicates", "benchmark decontamination", "mixing", "token ids"]
    for docs in (odd_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, sf)
            if name == "token ids":
                assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and out.count() == docs.count()
            else:
                assert out.dtypes == docs.dtypes
                assert out.count() <= 2 * docs.count()


def test_run_is_the_stages_in_turn(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    n = [docs.count()]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf).write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
        n.append(docs.count())
    assert n[1] < n[0] and n[2] < n[1] and n[3] <= n[2] and n[5] == n[4]
    assert sorted(map(tuple, docs.collect())) == sorted(map(tuple, corpus_pipeline.run(spark, sf).collect()))


def test_registered():
    queries, sql = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert set(q_llm.QUERIES) | {"pipeline"} <= set(queries) and set(q_llm.ORACLE_SQL) <= set(sql)
    assert sorted(int(k[2:].split("_")[0]) for k in q_llm.QUERIES) == list(range(1, 14))
