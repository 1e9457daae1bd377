import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusflow.llm import arrays as A

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aB1 é\n\t.漢", max_size=30)), max_size=8)


@settings(max_examples=60, deadline=None)
@given(TEXTS)
def test_words_are_the_regex_words(texts):
    buf, offs = A.text_bytes(pa.array(texts, type=pa.string()))
    starts, ends, doc = A.runs(A.NOT_SPACE[buf], offs)
    got = [(int(d), buf[a:b].tobytes().decode()) for a, b, d in zip(starts, ends, doc)]
    want = [(i, w) for i, t in enumerate(texts) for w in re.findall(r"[^\x20\x09-\x0D]+", t or "")]
    assert got == want
    h = A.span_hashes(buf, starts, ends, lower=True)
    lower = [w.translate({c: c + 32 for c in range(65, 91)}) for _, w in want]
    assert len(set(zip(h.tolist(), lower))) == len(set(lower)) == len(set(h.tolist()))


def test_slices_and_sliced_arrays():
    rb = pa.RecordBatch.from_arrays([pa.array(["ab", None, "c" * 50, "", "dd"])], names=["t"]).slice(1, 4)
    parts = list(A.slices(rb, "t", limit=10))
    assert [x for p in parts for x in p.column("t").to_pylist()] == [None, "c" * 50, "", "dd"]
    buf, offs = A.text_bytes(rb.column("t"))
    assert buf.tobytes() == b"c" * 50 + b"dd" and offs.tolist() == [0, 0, 50, 50, 52]
    assert len(list(A.slices(rb, "t", rows=1))) == 4


def test_windows_and_cover():
    h = A.hash_words(["a", "b", "a", "b"])
    w = A.window_hashes(h, 2)
    assert w[0] == w[2] != w[1]
    assert A.covered(np.array([0, 3]), 2, 6).tolist() == [True, True, False, True, True, False]
    assert A.fresh(["A", "_a"], "a") == "__a"


def test_hash_table_finds_what_was_added():
    rng = np.random.default_rng(0)
    table, want = A.HashTable(4), {}
    for _ in range(30):
        h = rng.integers(0, 3000, 200).astype(np.uint64) << np.uint64(40)  # many share a place
        rows = table.find(h)
        assert rows.tolist() == [want.get(int(x), -1) for x in h]
        new = np.unique(h[rows < 0])
        want |= dict(zip(new.tolist(), table.add(new).tolist()))
    assert sorted(want.values()) == list(range(table.n))
