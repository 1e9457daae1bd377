"""Every query with an oracle equals DuckDB on the same tables (order-insensitive, floats rounded)."""

import pytest

from corpusflow.queries.registry import load_all
from corpusflow.testing import sorted_rows

REG = load_all()
WITH_SQL = sorted(n for n, q in REG.items() if q.sql)
ROWS_ONLY = sorted(n for n, q in REG.items() if not q.sql)


@pytest.mark.parametrize("name", WITH_SQL)
def test_matches_oracle(spark, sf, duck, name):
    q = REG[name]
    df = q.fn(spark, sf)
    s_cols, s_rows = sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    res = duck.execute(q.sql)
    d_cols, d_rows = sorted_rows([c[0] for c in res.description], res.fetchall())
    assert s_cols == d_cols
    assert len(s_rows) == len(d_rows)
    assert s_rows == d_rows


#: against brute force or invariants in test_invariants.py
CHECKED_ELSEWHERE = {"mmr_search", "approx_knn", "rouge_l", "rouge_lsum", "chunk_recursive", "chunk_by_separator"}


@pytest.mark.parametrize("name", ROWS_ONLY)
def test_rows_only_runs(spark, sf, name):
    assert name in CHECKED_ELSEWHERE  # SQL can't state it: its result has a test of its own
    assert REG[name].fn(spark, sf).count() > 0
