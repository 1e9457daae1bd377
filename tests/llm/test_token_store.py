import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from corpusflow.llm import token_store as T
from corpusflow.llm.q_llm import tokenizer_path


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(tokenizer_path())


def want(rows, tokenizer):
    out, start = [], 0
    for i, t in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [2]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return out


def test_round_trip_of_the_fixture(spark, sf, tokenizer):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = T.encode_table(docs, tokenizer_path(), shard_tokens=20_000)
    rows = sorted((r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect())
    assert sorted(tuple(r) for r in got.collect()) == want(rows, tokenizer)


def test_pieces_encode_like_whole_texts(tokenizer):
    rng = random.Random(4)
    parts = [" ", "  ", "\n", "\t ", " ", "'s", "don't", "x", "foo", "é", "漢字", "123", "<|endoftext|>", "!?", "--", "\r\n", " ", "A1b"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(0, 25))) for _ in range(3000)] + [None, ""]
    e = T.Encoder(tokenizer_path())
    for _ in range(2):  # the second time from the memo
        ids, n = e.column(pa.array(texts))
        got = [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])]
        assert got == [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_minimal_perfect_hash():
    for n in (0, 1, 2, 500, 20_000):
        keys = [f"k{i}" for i in range(n)]
        row = T._pack(0, 0, keys, [np.ones(n, dtype=np.int64)], [np.arange(n, dtype=np.uint32)], 4)
        shard = T.Shard(row)
        slots = shard.slots(T.key_hashes(keys))
        assert sorted(slots.tolist()) == list(range(n))
        for k in (0, n // 2, n - 1) if n else ():
            assert shard.get(f"k{k}").tolist() == [k]
        misses = [shard.get(f"other{i}") for i in range(300)]
        assert sum(x is not None for x in misses) <= 2  # up to the 16-bit fingerprint


def test_odd_rows_and_fetch(spark, odd_docs, no_docs, tokenizer, tmp_path):
    path = str(tmp_path / "store")
    T.write_store(odd_docs, path, tokenizer_path(), shard_tokens=1000)
    store = spark.read.parquet(path)
    got = [tuple(r) for r in T.read_documents(store).collect()]
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    assert sorted(str(g[0]) for g in got) == sorted(str(i) for i, _ in rows)
    got.sort(key=lambda g: g[1])
    ids = [g[0] for g in got]
    assert ids == [None, *sorted(i for i in ids if i is not None)]
    starts = np.cumsum([0] + [g[2] for g in got])
    assert [g[1] for g in got] == starts[:-1].tolist()
    crc = sorted((str(i), c) for i, _, _, c in got)
    assert crc == sorted((str(i), c) for i, _, _, c in want(rows, tokenizer))
    asked = spark.createDataFrame([(4,), (5,), (77,)], "doc_id long")
    found = sorted((r["doc_id"], len(r["ids"])) for r in T.fetch(store, asked).collect())
    sizes = {(i, n) for i, _, n, _ in got}
    assert [i for i, _ in found] == [4, 5, 5] and all(x in sizes for x in found)
    every = sorted((str(r["doc_id"]), len(r["ids"])) for r in T.fetch(store, odd_docs).collect())
    assert every == sorted((str(i), n) for i, _, n, _ in got)  # a null key too
    plan = T.locate(store, odd_docs)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert T.encode_table(no_docs, tokenizer_path()).count() == 0


def test_fetch_over_many_shards(spark, tmp_path):
    # key 50 fills shards of its own; keys between and beyond the stored ones are not there
    docs = spark.createDataFrame([(i, f"text {i} of some words") for i in range(0, 100, 2)] + [(50, f"again {j} and more") for j in range(40)],
                                 "doc_id long, text string")
    path = str(tmp_path / "many")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")  # a shard ends with a batch
    try:
        T.write_store(docs, path, tokenizer_path(), shard_tokens=20)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    store = spark.read.parquet(path)
    assert store.count() > 15 and store.filter("lo = 50 and hi = 50").count() > 1
    asked = spark.createDataFrame([(i,) for i in (-5, 0, 1, 50, 51, 98, 99, 500, 0)] + [(None,)], "doc_id long")
    got = [r["doc_id"] for r in T.fetch(store, asked).collect()]
    assert sorted(got) == [0, *[50] * 41, 98]
