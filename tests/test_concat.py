"""Appended datasets, message dates inside conversations, and places of a common subsequence."""

import random

from pyspark.sql import functions as F

from corpusflow.operators import chatstats as cs
from corpusflow.operators.preferences import _lcs_places
from corpusflow.operators.windows import concat_datasets


def test_columns_meet_by_name_and_missing_ones_are_null(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x")], "id int, lang string")
    b = spark.createDataFrame([("y", 2, True)], "note string, id int, ok boolean")
    empty = a.filter("false")
    got = concat_datasets({"a": a, "b": b, "none": empty})
    assert got.columns == ["id", "lang", "dataset", "note", "ok"]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, [
        (1, "x", "a", None, None), (1, "x", "a", None, None), (2, None, "b", "y", True)]))


def test_one_scan_for_each_table(spark, sf):
    from corpusflow.queries.registry import load_all

    plan = load_all()["concat_datasets"].fn(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 4 and "Join" not in plan


def test_messages_older_than_the_bound_go(spark):
    rows = [(1, i, f"2024-01-{d:02d} 10:00:00", "u", "s") for i, d in enumerate((1, 5, 9, 20))] + [(2, 9, "2024-01-02 00:00:00", "v", "s")]
    flat = spark.createDataFrame(rows, "conv int, message_id int, created string, user_id string, session_id string")
    flat = flat.withColumn("created_at", F.to_timestamp("created")).drop("created")
    bound = F.lit("2024-01-09 10:00:00").cast("timestamp")
    nested = cs.nest_messages(flat, "conv", "message_id")
    got = cs.message_level_stats(nested, min_date=bound)
    want = cs.facet_stats(flat, min_date=bound)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert got.filter("distinct = '_id' and span = 'month'").first()["count"] == 2


def _table_places(a, b):
    m = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            m[i][j] = m[i - 1][j - 1] + 1 if x == y else max(m[i - 1][j], m[i][j - 1])
    i, j, out = len(a), len(b), set()
    while i and j:
        if a[i - 1] == b[j - 1]:
            out.add(i - 1)
            i, j = i - 1, j - 1
        elif m[i - 1][j] >= m[i][j - 1]:
            i -= 1
        else:
            j -= 1
    return out


def test_places_equal_the_whole_table():
    rng = random.Random(5)
    for _ in range(400):
        a, b = ([rng.randrange(4) for _ in range(rng.randrange(0, 25))] for _ in "ab")
        assert _lcs_places(a, b) == _table_places(a, b)


def test_long_lines_need_bits_only():
    rng = random.Random(6)
    a = [rng.randrange(50) for _ in range(6000)]
    assert _lcs_places(a, a[1000:]) == set(range(1000, 6000))
