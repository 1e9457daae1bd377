import os

from corpusflow.operators import chatstats as S

SCHEMA = "at string, n long, month string"


def _files(root):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, fs in os.walk(root) for f in fs if f.endswith(".parquet")}


def test_only_touched_periods_are_read_and_written(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(f"2024-{m:02d}-{d:02d}", m * 100 + d, f"2024-{m:02d}") for m in range(1, 7) for d in (1, 2)] + [("none", 1, None)]
    assert S.merge_into(path, spark.createDataFrame(rows, SCHEMA), ["at"], "month").count() == len(rows)
    before = _files(path)
    news = [("2024-06-02", 7, "2024-06"), ("2024-06-03", 8, "2024-06"), ("2024-07-01", 9, "2024-07"), ("none", 2, None)]
    want = {r[0]: r for r in rows} | {r[0]: r for r in news}
    for _ in range(2):  # a rerun gives the same table
        got = S.merge_into(path, spark.createDataFrame(news, SCHEMA), ["at"], "month")
        assert sorted(map(tuple, got.collect()), key=str) == sorted(want.values(), key=str)
    after = _files(path)
    assert all(after.get(f) == t for f, t in before.items() if "month=2024-06" not in f and "DEFAULT" not in f)


def test_the_scan_is_pruned(spark, tmp_path):
    path = str(tmp_path / "t")
    S.merge_into(path, spark.createDataFrame([("a", 1, "2024-01"), ("b", 2, "2024-02")], SCHEMA), ["at"], "month")
    old = S.touched(spark.read.schema(SCHEMA).parquet(path), "month", ["2024-02"])
    plan = old._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "2024-02" in plan.split("PartitionFilters:")[1].split("]")[0]
    assert old.inputFiles() and [r.at for r in old.collect()] == ["b"]
