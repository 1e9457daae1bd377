import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from corpusflow.llm import segment_bpe as S
from corpusflow.llm.q_llm import QUERIES, tokenizer_path

PATH = tokenizer_path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def bpe():
    return S.Bpe(PATH)


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def plain(bpe, symbols):
    """Merge the leftmost pair of the lowest rank until none is left."""
    out = list(symbols)
    while True:
        ranks = [(bpe.pairs.get(a * bpe.size + b, S.NONE), i) for i, (a, b) in enumerate(zip(out, out[1:]))]
        rank, i = min(ranks, default=(S.NONE, 0))
        if rank == S.NONE:
            return out
        out[i:i + 2] = [int(bpe.new[rank])]


def test_trees_merge_like_the_plain_rule(bpe):
    rnd = random.Random(3)
    words = ["".join(rnd.choice("aaeethinsrñé") for _ in range(rnd.randint(1, 90))).encode() for _ in range(400)]
    words += [b"a", b"ab", b"the", b"aaaa" * 16, b"x" * 64, b"y" * 65, bytes(range(256))]
    ids, n = S.forest(bpe, np.frombuffer(b"".join(words), dtype=np.uint8), np.cumsum([0, *map(len, words)]))
    got = np.split(ids, np.cumsum(n)[:-1])
    for w, g in zip(words, got):
        symbols = [*bpe.first[list(w[:-1])].tolist(), int(bpe.last[w[-1]])]
        assert g.tolist() == plain(bpe, symbols) == S.tree(bpe, symbols)


def test_ids_and_text_equal_the_library(library):
    rnd = random.Random(5)
    alphabet = "aaabbb\x1c\x00\xa0eethinS'sΣİé漢字  \n\t0123½!?ñ́e͸\U0001F600"
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 200))) for _ in range(500)]
    texts += ["a<|endoftext|>b <|startoftext|>", "<|endoftext|>", "<|endoftext", "", None, "the" * 3000, "I'll we'RE it's", " \n "]
    enc = S.Encoder(PATH)
    flat, offs = enc.encode(pa.array(texts))
    decoded = S.decode_ids(enc.bpe, flat, offs).to_pylist()
    for i, t in enumerate(texts):
        want = library.encode(t or "", add_special_tokens=False).ids
        assert flat[offs[i]:offs[i + 1]].tolist() == want, t
        assert decoded[i] == library.decode(want, skip_special_tokens=False)


def test_the_memo_changes_nothing(monkeypatch):
    texts = pa.array([f"word{i % 7} other{i}" for i in range(50)])
    want = S.Encoder(PATH).encode(texts)
    monkeypatch.setattr(S, "MEMO_STRETCHES", 3)
    enc = S.Encoder(PATH)
    parts = [enc.encode(texts.slice(i, 5)) for i in range(0, 50, 5)]
    assert np.concatenate([p[0] for p in parts]).tolist() == want[0].tolist()


def test_query_on_the_fixture(spark, sf, library):
    got = {r.doc_id: r for r in QUERIES["op11_segment_bpe"](spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = library.encode(d.text or "", add_special_tokens=False).ids
        r = got[d.doc_id]
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_odd_rows_and_decoding(odd_docs, no_docs, rows_of, library):
    docs = odd_docs.withColumnRenamed("label", "IDS")  # an output column replaces one of its name
    out = S.encode(docs, PATH, decoded="decoded")
    assert [c.lower() for c in out.columns].count("ids") == 1 and "text" in out.columns
    rows = out.collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r.ids == library.encode(r.text or "", add_special_tokens=False).ids
    back = S.decode(out.select("ids", "decoded", "doc_id"), PATH, text="again")
    assert all(r.again == r.decoded for r in back.collect())
    assert S.encode(no_docs, PATH).count() == 0


def test_decoding_skips_what_is_not_there(spark, bpe):
    df = spark.createDataFrame([(1, [320, None, 5]), (2, None), (3, []), (4, [10**6, -3, 49407])], "k int, ids array<int>")
    got = {r.k: r.decoded for r in S.decode(df, PATH).collect()}
    strings = bytes(bpe.token_bytes).decode()
    assert got[2] == got[3] == "" and got[4] == "<|endoftext|>" and got[1].count(" ") == 1 and strings
