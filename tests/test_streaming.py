import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusflow.streaming import ops as Q
from corpusflow.streaming import stateful as S
from corpusflow.streaming.runner import read_sink, run_to_sink

T0 = dt.datetime(2024, 1, 1)
DAY = 86_400


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


class Feed:
    """A folder that a stream reads, and that gets files between runs; state and sink outlive a run."""

    def __init__(self, spark, path, schema):
        self.spark, self.path, self.schema, self.n = spark, path, schema, 0
        (path / "src").mkdir()

    def put(self, rows):
        self.spark.createDataFrame(rows, self.schema).coalesce(1).write.parquet(str(self.path / "src" / f"f{self.n:03d}"))
        self.n += 1

    def stream(self):
        return self.spark.readStream.schema(self.schema).option("maxFilesPerTrigger", 1).parquet(str(self.path / "src" / "*"))

    def run(self, sdf, **kw):
        run_to_sink(sdf, out=str(self.path / "out"), ckpt=str(self.path / "ckpt"), **kw)

    def rows(self, schema):
        return read_sink(self.spark, str(self.path / "out"), schema).collect()


def test_sessions_end_after_two_weeks_or_at_the_next_login(spark, tmp_path):
    rnd = random.Random(1)
    logins = [(f"s{rnd.randrange(4)}", rnd.randrange(9), at(i * 1.7 * DAY + rnd.randrange(500))) for i in range(40)]
    feed = Feed(spark, tmp_path, "session string, user long, ts timestamp")
    late = logins[:]
    for i in range(0, 36, 4):  # out of order by a few minutes at most
        late[i], late[i + 1] = (late[i + 1][0], late[i + 1][1], late[i][2] + dt.timedelta(seconds=200)), late[i]
    run = lambda: feed.run(S.session_expiry(feed.stream(), "session", "user", "ts"), stateful=True)
    for i in range(0, 20, 5):
        feed.put(late[i:i + 5])
    run()
    first = len(feed.rows("session string"))
    for i in range(20, 40, 5):  # the stream starts again with its state
        feed.put(late[i:i + 5])
    feed.put([(None, 1, late[-1][2]), ("s0", None, late[-1][2])])  # ignored
    feed.put([("end", 0, at(400 * DAY))])
    feed.put([("end", 0, at(401 * DAY))])
    run()
    want = set()
    for s in {x[0] for x in late}:
        mine = sorted((t, u) for k, u, t in late if k == s)
        for (t, u), nxt in zip(mine, [*[m[0] for m in mine[1:]], None]):
            end = t + dt.timedelta(days=14)
            want.add((s, u, t, min(end, nxt or end), "replaced" if nxt and nxt < end else "expired"))
    got = [tuple(r)[:5] for r in feed.rows("session string")]
    assert 0 < first < len(got) and {g for g in got if g[0] != "end"} == want and len([g for g in got if g[0] != "end"]) == len(want)


def test_cooldowns_wait_in_the_stream(spark, tmp_path):
    feed = Feed(spark, tmp_path, "endpoint string, ts timestamp, util double")
    signals = [("e", 0, 90.0), ("e", 30, 90.0), ("e", 60, 90.0), ("e", 120, 5.0), ("e", 400, 5.0), ("e", 420, 90.0), ("e", 460, 90.0), ("f", 0, 40.0)]
    run = lambda: feed.run(S.scale_actions(Q.scale_signal(feed.stream(), "endpoint", "ts", "util", 50.0, "10 seconds"), "endpoint"), stateful=True)
    feed.put([(e, at(t), u) for e, t, u in signals[:3]])
    run()
    feed.put([(e, at(t), u) for e, t, u in signals[3:]])
    feed.put([("end", at(9 * DAY), 0.0)])
    feed.put([("end", at(10 * DAY), 0.0)])
    run()
    got = {(r.endpoint, int((r.window_start - T0).total_seconds())): r.action for r in feed.rows("endpoint string") if r.endpoint != "end"}
    assert got == {("e", 0): "scale_out", ("e", 30): "hold", ("e", 60): "scale_out", ("e", 120): "hold", ("e", 400): "scale_in",
                   ("e", 420): "hold", ("e", 460): "scale_out", ("f", 0): "hold"}


def test_messages_come_out_once(spark, tmp_path):
    feed = Feed(spark, tmp_path, "m string, seq int, token string, kind string, ts timestamp")
    row = lambda m, seq, token, kind="token", t=0: (m, seq, token, kind, at(t))
    run = lambda: feed.run(S.assemble(feed.stream(), "m", "ts", idle_s=60), stateful=True)
    feed.put([row("a", 2, "c"), row("a", 0, "a"), row("a", 4, "", "end"), row("b", 0, "x"), row("b", -1, "started", "status")])
    feed.put([row("c", 0, "lost", t=5)])
    run()
    assert feed.rows("m string") == []
    feed.put([row("a", 1, "b", t=3), row("a", 3, "", t=4)])
    feed.put([row("b", 1, "", "end", t=6)])
    feed.put([row("z", 0, "", "end", t=DAY)])
    feed.put([row("z2", 0, "", "end", t=2 * DAY)])
    run()
    got = sorted((r.m, r.text, r.n_status, r.complete) for r in feed.rows("m string"))
    assert got == [("a", "a b c", 0, True), ("b", "x", 1, True), ("c", "lost", 0, False), ("z", "", 0, True), ("z2", "", 0, True)]


def test_latest_flag_within_its_life(spark, tmp_path):
    feed = Feed(spark, tmp_path, "c string, id long, kind string, ts timestamp")
    rows = [("a", 1, "flag", 0), ("a", 2, "flag", 20), ("a", 3, "gen", 25), ("a", 4, "gen", 30), ("a", 5, "gen", 49), ("a", 6, "gen", 50),
            ("b", 7, "gen", 25), ("b", 8, "flag", 26), ("b", 9, "gen", 26)]
    for part in (rows[5:], rows[:5]):  # the earlier rows come late, inside the watermark
        feed.put([(c, i, k, at(t)) for c, i, k, t in part])
    for d in (100, 101):
        feed.put([("end", -d, "flag", at(d * DAY)), ("end", -d - 9, "gen", at(d * DAY))])
    s = feed.stream()
    feed.run(S.active_aborts(s.filter("kind = 'gen'"), s.filter("kind = 'flag'"), "c", "id", "ts"))
    got = {r.id: r.aborted_at and int((r.aborted_at - T0).total_seconds()) for r in feed.rows("c string") if r.c != "end"}
    assert got == {3: 20, 4: 20, 5: 20, 6: None, 7: None, 9: 26}


def test_advantages_equal_the_batch_rules(spark, tmp_path):
    rng = np.random.default_rng(3)
    batches = [[(("p", "q", "r")[rng.integers(0, 2 + (b > 1))], b * 100 + i, float(rng.normal())) for i in range(rng.integers(3, 12))] for b in range(5)]
    run = S.batch_advantages(str(tmp_path / "state"), "prompt", "id", "reward", buffer=6, min_count=4)
    frame = lambda rows: spark.createDataFrame(rows, "prompt string, id long, reward double")
    got = {}
    for b, rows in enumerate(batches):
        for _ in range(2):  # a retried batch gives the same rows
            got |= {r.id: r.advantage for r in run(frame(rows), b).collect()}
    buffers, want = {}, {}
    for rows in batches:
        every = np.array([x for _, _, x in rows])
        for p in {r[0] for r in rows}:
            mine = [x for k, _, x in rows if k == p]
            buffers[p] = (buffers.get(p, []) + mine)[-6:]
            base = every if len(buffers[p]) < 4 else np.array(buffers[p])
            want |= {i: (x - base.mean()) / (base.std() + 1e-6) for k, i, x in rows if k == p}
    assert got.keys() == want.keys() and all(got[i] == pytest.approx(want[i], abs=1e-9) for i in want)


def test_counts_leave_the_state(spark, tmp_path):
    feed = Feed(spark, tmp_path, "chain long, kind string, n long, ts timestamp")
    feed.put([(1, "prompt", 3, at(0)), (1, "prompt", 4, at(0)), (2, "prompt", 5, at(1))])
    feed.put([(2, "generation", 6, at(1)), (9, "prompt", 0, at(DAY))])
    feed.put([(10, "prompt", 0, at(2 * DAY))])
    _, progress = run_to_sink(Q.token_counters(feed.stream(), "chain", "kind", "n", "ts"), out=str(tmp_path / "out"), ckpt=str(tmp_path / "ckpt"))
    got = {(r.chain, r.kind): r.tokens for r in feed.rows("chain long") if r.chain < 9}
    assert got == {(1, "prompt"): 7, (2, "prompt"): 5, (2, "generation"): 6}
    assert progress["stateOperators"][0]["numRowsTotal"] <= 2
