"""Message-tree cases (append, sibling, path) on small hand-made threads."""

from pyspark.sql import functions as F

from corpusflow.operators import trees as R


def _linear(spark):
    rows = [(1, 0, "system", "pre"), (1, 1, "user", "a"), (1, 2, "assistant", "b"), (1, 3, "user", "c"),
            (2, 0, "user", "x"), (2, 1, "assistant", "y")]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def test_from_linear_adds_root_only_when_missing(spark):
    tr = {r.id: r for r in R.from_linear(_linear(spark)).collect()}
    assert "1-root" not in tr and "2-root" in tr
    assert tr["1-3"].ancestors == ["1-0", "1-1", "1-2"]
    assert tr["2-1"].ancestors == ["2-root", "2-0"]
    assert tr["1-0"].children == ["1-1"] and tr["1-3"].children == []


def test_append_links_parent_and_child(spark):
    tree = R.from_linear(_linear(spark))
    new = spark.createDataFrame([(1, "1-1b", "user", "alt", "1-0"), (1, "bad", "user", "z", "nope")],
                                "conv_id long, id string, role string, text string, parent_id string")
    out = {r.id: r for r in R.append(tree, new).collect()}
    assert out["1-1b"].ancestors == ["1-0"] and out["1-1b"].error is None
    assert out["1-0"].children == ["1-1", "1-1b"]
    assert out["bad"].error == "parent not found"


def test_sibling_copies_ancestors_and_rejects_root_or_missing(spark):
    tree = R.from_linear(_linear(spark))
    new = spark.createDataFrame([(1, "s1", "1-2"), (1, "s2", "1-0"), (1, "s3", "zz")], "conv_id long, id string, sibling_id string")
    out = {r.id: r for r in R.add_sibling(tree, new).collect()}
    assert out["s1"].ancestors == ["1-0", "1-1"] and out["s1"].error is None
    assert "root" in out["s2"].error
    assert "doesn't exist" in out["s3"].error


def test_path_and_retry_path(spark):
    tree = R.from_linear(_linear(spark))
    t = spark.createDataFrame([(1, "1-3"), (1, "missing")], "conv_id long, id string")
    p = {r.target: r for r in R.path(tree, t).collect()}
    assert p["1-3"].path == ["1-0", "1-1", "1-2", "1-3"]
    assert p["missing"].error == "Message not found"
    rp = {r.target: r.path for r in R.path(tree, t.filter(F.col("id") == "1-3"), drop_last=True).collect()}
    assert rp["1-3"] == ["1-0", "1-1", "1-2"]


def test_append_root_duplicate_and_missing_parent(spark):
    tree = R.from_linear(_linear(spark))
    new = spark.createDataFrame(
        [(3, "3-0", "user", "first", None), (1, "1-2", "user", "again", "1-1"), (1, "orphan", "user", "x", None)],
        "conv_id long, id string, role string, text string, parent_id string")
    out = {r.id: r for r in R.append(tree, new).collect()}
    assert out["3-0"].ancestors == [] and out["3-0"].error is None
    assert out["orphan"].error == "parent id required"
    assert any(r.id == "1-2" and r.error == "message already exists" for r in R.append(tree, new).collect())


def test_sibling_links_under_parent(spark):
    tree = R.from_linear(_linear(spark))
    new = spark.createDataFrame([(1, "1-2s", "assistant", "alt", "1-2")], "conv_id long, id string, role string, text string, sibling_id string")
    out = {r.id: r for r in R.add_sibling_tree(tree, new).collect()}
    assert out["1-2s"].ancestors == out["1-2"].ancestors == ["1-0", "1-1"]
    assert out["1-1"].children == ["1-2", "1-2s"]


def test_path_reports_missing_ancestor(spark):
    rows = [(1, "a", [], ["b"]), (1, "b", ["a"], []), (1, "c", ["a", "gone"], [])]
    tree = spark.createDataFrame(rows, "conv_id long, id string, ancestors array<string>, children array<string>")
    t = spark.createDataFrame([(1, "b"), (1, "c")], "conv_id long, id string")
    p = {r.target: r for r in R.path(tree, t).collect()}
    assert p["b"].path == ["a", "b"] and p["b"].error is None
    assert p["c"].error == "Ancestor not found" and p["c"].path is None


def test_message_id_format(spark):
    import uuid

    from corpusflow.operators.text import is_message_id

    df = spark.createDataFrame([(str(uuid.uuid4()),), ("1-2-3-4",), ("",)], "id string")
    got = [r.ok for r in df.select(is_message_id("id").alias("ok")).collect()]
    assert got == [True, False, False]


def _legacy(spark):
    rows = [(5, "a", 0), (5, "b", 1), (5, "c", 2)]
    return spark.createDataFrame(rows, "conv_id long, id string, turn long")


def test_legacy_append_only_after_last(spark):
    new = spark.createDataFrame([(5, "d", "user", "x", "c"), (5, "e", "user", "y", "a")],
                                "conv_id long, id string, role string, text string, parent_id string")
    out = {r.id: r for r in R.legacy_append(_legacy(spark), new).collect()}
    assert out["d"].error is None and out["d"].turn == 3
    assert "legacy" in out["e"].error and out["e"].turn is None


def test_legacy_append_needs_its_parent_and_takes_one(spark):
    new = spark.createDataFrame([(5, "d", "user", "x", None), (5, "e", "user", "y", "c"), (5, "f", "user", "z", "c"), (6, "g", "user", "w", None)],
                                "conv_id long, id string, role string, text string, parent_id string")
    out = {r.id: r for r in R.legacy_append(_legacy(spark), new).collect()}
    assert "legacy" in out["d"].error  # no parent on a thread with messages
    assert out["e"].error is None and out["e"].turn == 3 and "legacy" in out["f"].error
    assert out["g"].error is None and out["g"].turn == 0  # an empty thread


def test_legacy_path_is_a_slice(spark):
    t = spark.createDataFrame([(5, "b"), (5, "a"), (5, "c"), (5, "zz")], "conv_id long, id string")
    p = {r.target: r for r in R.legacy_path(_legacy(spark), t).collect()}
    assert p["b"].path == ["a", "b"] and p["a"].path == ["a"] and p["c"].path == ["a", "b", "c"]
    assert p["zz"].error == "Message not found"


NEW = "conv_id long, id string, role string, text string, parent_id string"


def test_append_settles_chains_inside_a_batch(spark):
    tree = R.from_linear(_linear(spark))
    ids = [f"n{i:02d}" for i in range(20)]
    chain = [(1, i, "user", "x", p) for i, p in zip(ids, ["1-3", *ids])]
    loop = [(1, "p", "user", "x", "q"), (1, "q", "user", "x", "p"), (1, "under", "user", "x", "q")]
    lost = [(1, "l1", "user", "x", "nope"), (1, "l2", "user", "x", "l1"), (1, "1-2", "user", "x", "1-1"), (1, "l3", "user", "x", "l2")]
    fresh = [(9, "r", "system", "x", None), (9, "s", "user", "x", "r"), (9, "t", "user", "x", "s"), (9, "r2", "user", "x", None), (9, "u", "user", "x", "r2")]
    out = R.append(tree, spark.createDataFrame(chain[::-1] + loop + lost + fresh, NEW)).collect()
    got = {r.id: r for r in out if not (r.id == "1-2" and r.error)}
    for k, i in enumerate(ids):
        assert got[i].ancestors == ["1-0", "1-1", "1-2", "1-3", *ids[:k]] and got[i].children == ids[k + 1:k + 2] and got[i].error is None
    assert got["1-3"].children == ["n00"]
    assert {i: got[i].error for i in ("p", "q", "under", "l1", "l2", "l3")} == dict.fromkeys(("p", "q", "under", "l1", "l2", "l3"), "parent not found")
    assert got["t"].ancestors == ["r", "s"] and got["r"].children == ["s"]
    assert got["r2"].error == "parent id required" and got["u"].error == "parent not found"
    assert [r.error for r in out if r.id == "1-2" and r.error] == ["message already exists"]
    assert len(out) == 7 + 20 + 3 + 4 + 5


def test_append_takes_one_of_equal_new_ids(spark):
    new = spark.createDataFrame([(1, "d", "user", "x", "1-0"), (1, "d", "user", "y", "1-1"), (1, "e", "user", "z", "d")], NEW)
    out = [r for r in R.append(R.from_linear(_linear(spark)), new).collect() if r.id in "de"]
    assert sorted((r.id, r.text, r.error) for r in out) == [("d", "x", None), ("d", "y", "message already exists"), ("e", "z", None)]


def test_retry_of_answers_and_edited_messages(spark):
    tree = R.from_linear(_linear(spark))
    t = spark.createDataFrame([(1, "1-2", None), (1, "1-3", "new"), (1, "1-1", ""), (1, "1-0", "new"), (2, "gone", "x")], "conv_id long, id string, new_prompt string")
    got = {r.target: (r.write_to, r.path, r.error) for r in R.retry(tree, t).collect()}
    assert got["1-2"] == ("1-2-retry", ["1-0", "1-1"], None)
    assert got["1-3"] == ("1-3-edit-answer", ["1-0", "1-1", "1-2", "1-3-edit"], None)
    assert got["1-1"][2] == got["1-0"][2] == "nothing to retry" and got["gone"] == (None, None, "Message not found")
