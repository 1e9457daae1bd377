"""What bounds the streams and ROUGE on large tables: timers and list entries per key, join slots, files per batch."""

import datetime as dt
import random
from collections import Counter
from types import SimpleNamespace

import pandas as pd
import pytest
from pyspark.sql import functions as F

from corpusflow.operators import preferences as P
from corpusflow.queries import q_stream
from corpusflow.streaming import ops as Q
from corpusflow.streaming import runner
from corpusflow.streaming import stateful as S

T0 = dt.datetime(2024, 1, 1)


class State:
    """A value or list state that counts its calls."""

    def __init__(self):
        self.rows, self.calls = [], 0

    def exists(self):
        return bool(self.rows)

    def get(self):
        self.calls += 1
        return iter(list(self.rows)) if self.listed else self.rows[0]

    def update(self, row):
        self.rows = [row]

    def put(self, rows):
        self.rows = list(rows)

    def appendValue(self, row):
        self.rows.append(row)

    def appendList(self, rows):
        self.rows += rows

    def clear(self):
        self.rows = []


class Handle:
    def __init__(self):
        self.states, self.timers, self.set = {}, set(), 0

    def _state(self, name, listed):
        self.states[name] = s = State()
        s.listed = listed
        return s

    def getListState(self, name, schema):
        return self._state(name, True)

    def getValueState(self, name, schema):
        return self._state(name, False)

    def registerTimer(self, ms):
        self.set += 1
        self.timers.add(ms)

    def deleteTimer(self, ms):
        self.timers.remove(ms)


def test_a_session_key_has_one_timer_and_reads_its_list_once_a_batch():
    day = 86_400 * S.MICROS
    life, handle, out = S.FixedLife(14 * day), Handle(), []
    life.init(handle)
    logins, at = [(i * day // 100, i % 7) for i in range(3000)], 0
    for end in (1000, 2000, 3000, None):
        if end:
            batch = logins[end - 1000:end]
            list(life.handleInputRows(("s",), iter([pd.DataFrame(batch, columns=["at_us", "who"])]), None))
        assert len(handle.timers) <= 1 and len(handle.states["waiting"].rows) <= 2
        at = logins[end - 500][0] // 1000 if end else 10**12
        values = SimpleNamespace(getCurrentWatermarkInMs=lambda: at)
        reads = handle.states["waiting"].calls
        for ms in sorted(m for m in handle.timers if m <= at):
            handle.timers.remove(ms)
            out += list(life.handleExpiredTimer(("s",), values, None))
        assert handle.states["waiting"].calls <= reads + 1
    got = pd.concat(out)
    assert handle.set < 12 and not handle.timers and list(got["login_us"]) == [us for us, _ in logins] and list(got["who"]) == [w for _, w in logins]
    assert list(got["end_us"]) == [us for us, _ in logins[1:]] + [logins[-1][0] + 14 * day] and list(got["reason"]) == ["replaced"] * 2999 + ["expired"]


def test_flags_meet_only_events_of_nearby_slots(spark, tmp_path):
    rnd = random.Random(5)
    rows = [(rnd.choice("ab"), i, rnd.choice(["flag", "gen"]), T0 + dt.timedelta(seconds=rnd.choice([0, 29, 30, 31, 60, 90, 500]) + rnd.randrange(60) / 4))
            for i in range(300)]
    ends = [("end", -i, k, T0 + dt.timedelta(days=9 + i)) for i in (1, 2) for k in ("flag", "gen")]
    schema = "c string, id long, kind string, ts timestamp"
    for i, part in enumerate((rows[:150], rows[150:], ends[:2], ends[2:])):
        spark.createDataFrame(part, schema).coalesce(1).write.parquet(str(tmp_path / "src" / f"f{i}"))
    s = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "src" / "*"))
    x = S.active_aborts(s.filter("kind = 'gen'"), s.filter("kind = 'flag'"), "c", "id", "ts")
    assert "_slot" in x._jdf.queryExecution().analyzed().toString()  # a key of the join besides the conversation
    out, _ = runner.run_to_sink(x)
    got = {r.id: r.aborted_at for r in runner.read_sink(spark, out, "c string").collect() if r.c != "end"}
    flags = [(c, t) for c, _, k, t in rows if k == "flag"]
    want = {i: max((t for c2, t in flags if c2 == c and t <= at < t + dt.timedelta(seconds=30)), default=None) for c, i, k, at in rows if k == "gen"}
    assert got == want


def test_many_files_do_not_make_as_many_batches(spark):
    cores = spark.sparkContext.defaultParallelism
    assert runner.files_a_batch(spark, runner.LEAST_FILES) == 1 and runner.files_a_batch(spark, 10_000) == cores
    df = spark.range(400).select(F.col("id").alias("doc_id"), (F.col("id") % 3).cast("string").alias("shard"),
                                 F.transform(F.sequence(F.lit(1), (F.col("id") % 5 + 1).cast("int")), lambda x: x + F.col("id").cast("int")).alias("ids"))
    sdf = runner.stream_of(df, "packs", "doc_id", 24)
    out, _ = runner.run_to_sink(Q.pack_stream(sdf, "shard", ["doc_id"], "ids", 16, eos=2))
    rows = runner.read_sink(spark, out, "shard string").collect()
    assert runner.LEAST_BATCHES <= len(list((tmp_of(out)).glob("batch=*"))) <= 24 // 3 + 2
    got = {(r.shard, r.chunk): list(r.input_ids) for r in rows}
    want = {}
    for s in range(3):
        flat = [x for i in range(s, 400, 3) for x in [*(k + i for k in range(1, i % 5 + 2)), 2]]
        want |= {(str(s), k): flat[k * 16:(k + 1) * 16] for k in range(len(flat) // 16)}
    assert got == want


def tmp_of(path):
    from pathlib import Path

    return Path(path.removeprefix("file:"))


class Stop(Exception):
    pass


def test_files_of_message_updates_follow_their_number(spark, tmp_path, monkeypatch):
    spark.createDataFrame([(0, 0, "user", "q"), (0, 1, "assistant", "a " * 3_000_000)], "conv_id long, turn long, role string, text string").write.parquet(
        str(tmp_path / "conversations.parquet"))

    def stream_of(df, name, order, files, flush_rows=None):
        raise Stop(files)

    monkeypatch.setattr(q_stream, "stream_of", stream_of)
    with pytest.raises(Stop) as e:
        q_stream.q_s_assembly(spark, str(tmp_path))
    assert e.value.args[0] >= 6  # the table itself is a few kB


def test_a_whole_message_is_one_entry_at_most():
    handle = Handle()
    a = S.Assembly(1000)
    a.init(handle)
    frame = lambda rows: iter([pd.DataFrame(rows, columns=["seq", "token", "kind", "at_ms"])])
    assert list(a.handleInputRows(("m",), frame([(i, f"w{i}", "token", 5) for i in range(50, 100)]), None)) == []
    assert len(handle.states["tokens"].rows) == 1
    (got,) = a.handleInputRows(("m",), frame([(i, f"w{i}", "token", 6) for i in range(50)] + [(100, "", "end", 7)]), None)
    assert got["text"][0] == " ".join(f"w{i}" for i in range(100)) and got["complete"][0] and not handle.states["tokens"].rows


def test_models_are_scored_in_one_pass(spark):
    rnd = random.Random(2)
    text = lambda: rnd.choice([None, "", "!", " ".join(rnd.choice(["a", "b", "c", "dd"]) for _ in range(rnd.randrange(1, 12)))])
    rows = [(i, text(), text(), text()) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, a string, b string, ref string").repartition(3)

    def score(p, r, n):
        (p, r) = (Counter(zip(*[(x or "").replace("!", "").split()[k:] for k in range(n)])) for x in (p, r))
        ov, np_, nr = sum((p & r).values()), sum(p.values()), sum(r.values())
        pr, rc = ov / np_ if np_ else 0.0, ov / nr if nr else 0.0
        return pr, rc, 2 * pr * rc / (pr + rc) if pr + rc else 0.0

    for n in (1, 2, 3):
        got = P.rouge_n(df, "id", {"x": "a", "y": "b"}, "ref", n)
        assert got.columns == ["id", "model", "precision", "recall", "f1"]
        assert str(got._jdf.queryExecution().optimizedPlan()).count("ArrowEvalPython") == 1
        have = {(r.id, r.model): (r.precision, r.recall, r.f1) for r in got.collect()}
        want = {(i, m): score(p, r, n) for i, a, b, r in rows for m, p in (("x", a), ("y", b))}
        assert have.keys() == want.keys() and all(have[k] == pytest.approx(want[k]) for k in want)


def test_ngram_numbers_that_do_not_fit_are_made_anew(monkeypatch):
    import pyarrow as pa

    rnd = random.Random(4)
    lists = [pa.array([[rnd.choice("abcde") for _ in range(rnd.randrange(30))] for _ in range(40)]) for _ in range(3)]
    want = P._overlaps(lists, 3)
    monkeypatch.setattr(P, "_MANY", 30)
    got = P._overlaps(lists, 3)
    assert all((x == y).all() for a, b in zip(want, got) for x, y in zip(a, b)) and sum(want[0][0]) > 0
