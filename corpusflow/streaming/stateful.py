"""Stateful stream operators with values, lists and event-time timers per key (``transformWithStateInPandas``).

State lives in Spark's RocksDB store (see ``runner.run_to_sink``), so it survives restarts and lost executors.
Rows of a key that may come out of order wait in a list until the watermark has passed them; a timer at
a row's time wakes the key.  Results therefore don't depend on how the input is cut into batches.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from corpusflow.streaming.ops import WATERMARK

MICROS = 1_000_000


class FixedLife(StatefulProcessor):
    """Sessions that end a fixed time after login, or when the same session logs in again.

    A key has one timer, at the earliest time that anything is due: its list is read once a batch, not once a login.
    An entry of the list holds many logins, as the store reads a key's list again for each entry added.
    """

    def __init__(self, life_us: int):
        self.life = life_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "us array<long>, who array<long>")
        self.live = handle.getValueState("live", "us long, who long")
        self.due = handle.getValueState("due", "ms long")

    def _wake(self, us: int) -> None:
        """Set the key's timer just after ``us``, unless it is set for an earlier time."""
        ms, known = us // 1000 + 1, self.due.get()[0] if self.due.exists() else None
        if known is not None and known <= ms:
            return
        if known is not None:
            self.handle.deleteTimer(known)
        self.handle.registerTimer(ms)
        self.due.update((ms,))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        first = None
        for pdf in rows:
            us = pdf["at_us"].tolist()
            if us:
                self.waiting.appendValue((us, pdf["who"].tolist()))
                first = min(us) if first is None else min(first, min(us))
        if first is not None:
            self._wake(first)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs() * 1000
        self.due.clear()
        logins = sorted(r for us, who in self.waiting.get() for r in zip(us, who))
        later = [r for r in logins if r[0] >= now]
        self.waiting.put([tuple(map(list, zip(*later)))]) if later else self.waiting.clear()
        live = tuple(self.live.get()) if self.live.exists() else None
        ended = []
        for login in (r for r in logins if r[0] < now):
            if live:
                ended.append((*live, min(live[0] + self.life, login[0]), live[0] + self.life <= login[0]))
            live = login
        if live and live[0] + self.life <= now:
            ended.append((*live, live[0] + self.life, True))
            live = None
        if live:
            self.live.update(live)
        else:
            self.live.clear()
        due = [r[0] for r in later[:1]] + ([live[0] + self.life] if live else [])
        if due:
            self._wake(min(due))
        if ended:
            us, who, end, expired = zip(*ended)
            yield pd.DataFrame({"key": [key[0]] * len(ended), "who": who, "login_us": us, "end_us": end,
                                "reason": ["expired" if e else "replaced" for e in expired]})

    def close(self) -> None:
        pass


def session_expiry(sdf: DataFrame, session: str, user: str, ts: str, life_s: int = 14 * 86_400, watermark: str = WATERMARK) -> DataFrame:
    """A removal row per session: (session, user, login, removed_at, reason).

    A session lives ``life_s`` seconds from its login; a login with the same session before that replaces it.
    Rows without a session or user are ignored.
    """
    x = (sdf.withWatermark(ts, watermark).filter(F.col(session).isNotNull() & F.col(user).isNotNull())
         .select(F.col(session).alias("key"), F.col(user).cast("long").alias("who"), ts, F.unix_micros(F.col(ts).cast("timestamp")).alias("at_us")))
    kind = x.schema["key"].dataType.simpleString()
    out = x.groupBy("key").transformWithStateInPandas(FixedLife(life_s * MICROS), f"key {kind}, who long, login_us long, end_us long, reason string",
                                                      "Append", "EventTime")
    return out.select(F.col("key").alias(session), F.col("who").alias(user), F.timestamp_micros("login_us").alias("login"),
                      F.timestamp_micros("end_us").alias("removed_at"), "reason")


class Cooldown(StatefulProcessor):
    """Actions from signals that come in time order: after an action the next waits, by its kind."""

    def __init__(self, out_s: int, in_s: int):
        self.wait = {"scale_out": out_s * MICROS, "scale_in": in_s * MICROS}

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "us long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(rows)).sort_values("at_us")
        last = self.last.get()[0] if self.last.exists() else None
        actions = []
        for us, signal in zip(pdf["at_us"], pdf["signal"]):
            act = signal in self.wait and (last is None or us - last >= self.wait[signal])
            last = int(us) if act else last
            actions.append(signal if act else "hold")
        if last is not None:
            self.last.update((last,))
        yield pd.DataFrame({"key": [key[0]] * len(pdf), "start_us": pdf["at_us"].to_numpy(), "avg_util": pdf["avg_util"].to_numpy(),
                            "signal": pdf["signal"].to_numpy(), "action": actions})

    def close(self) -> None:
        pass


def scale_actions(signals: DataFrame, endpoint: str, out_s: int = 60, in_s: int = 300) -> DataFrame:
    """Scaling actions from a stream of closed windows (``ops.scale_signal`` in append mode).

    After an action the next scale-out waits ``out_s`` seconds, the next scale-in ``in_s``.  Windows of an endpoint
    close in time order, so the state is the time of its last action.
    """
    x = signals.select(F.col(endpoint).alias("key"), F.unix_micros("w.start").alias("at_us"), "w", "avg_util", "signal")
    kind = x.schema["key"].dataType.simpleString()
    out = x.groupBy("key").transformWithStateInPandas(Cooldown(out_s, in_s), f"key {kind}, start_us long, avg_util double, signal string, action string",
                                                      "Append", "None")
    return out.select(F.col("key").alias(endpoint), F.timestamp_micros("start_us").alias("window_start"), "avg_util", "signal", "action")


class Assembly(StatefulProcessor):
    """Updates of a message, kept until its end marker and all tokens are there, or until it was idle too long."""

    def __init__(self, idle_ms: int):
        self.idle = idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.tokens = handle.getListState("tokens", "seq array<int>, token array<string>")  # an entry per batch
        self.seen = handle.getValueState("seen", "n int, status int, want int, last long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        n, status, want, last = self.seen.get() if self.seen.exists() else (0, 0, -1, 0)
        first = not last
        new = []
        for pdf in rows:
            for seq, token, kind, ms in zip(pdf["seq"], pdf["token"], pdf["kind"], pdf["at_ms"]):
                if kind == "token":
                    n += 1
                    if token:
                        new.append((int(seq), token))
                elif kind == "status":
                    status += 1
                elif kind == "end":
                    want = int(seq)
                last = max(last, int(ms))
        if n == want:
            yield self._message(key, status, True, new)
            return
        if new:
            self.tokens.appendValue(tuple(map(list, zip(*new))))
        self.seen.update((n, status, want, last))
        if first:
            self.handle.registerTimer(last + self.idle)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.seen.exists():
            _, status, _, last = self.seen.get()
            if last + self.idle > timerValues.getCurrentWatermarkInMs():  # updates came since the timer was set
                self.handle.registerTimer(last + self.idle)
            else:
                yield self._message(key, status, False)

    def _message(self, key, status: int, complete: bool, new: list | None = None) -> pd.DataFrame:
        kept = [r for seq, token in self.tokens.get() for r in zip(seq, token)]
        text = " ".join(t for _, t in sorted(kept + (new or [])))
        self.tokens.clear()
        self.seen.clear()
        return pd.DataFrame({"key": [key[0]], "text": [text], "n_status": [status], "complete": [complete]})

    def close(self) -> None:
        pass


def assemble(sdf: DataFrame, message: str, ts: str, idle_s: int = 600, watermark: str = WATERMARK) -> DataFrame:
    """One row per message, written once: (message, text, n_status, complete).

    Updates are rows (``seq``, ``token``, ``kind``): tokens (empty ones dropped from the text), status updates, and an
    end marker whose ``seq`` is the number of token updates.  A message without its end or some tokens comes out
    incomplete once the watermark is ``idle_s`` seconds past its last update.
    """
    x = sdf.withWatermark(ts, watermark).select(F.col(message).alias("key"), "seq", "token", "kind", ts, F.unix_millis(F.col(ts)).alias("at_ms"))
    kind = x.schema["key"].dataType.simpleString()
    out = x.groupBy("key").transformWithStateInPandas(Assembly(idle_s * 1000), f"key {kind}, text string, n_status int, complete boolean",
                                                      "Append", "EventTime")
    return out.withColumnRenamed("key", message)


def active_aborts(events: DataFrame, flags: DataFrame, conversation: str, event: str, ts: str, life_s: int = 30,
                  watermark: str = WATERMARK) -> DataFrame:
    """Each generation event with the latest abort flag of its conversation that is at most ``life_s`` seconds old, or null.

    A stream-stream join on an interval of event time (watermarks on both sides bound its state), then the latest
    flag per event; an event comes out once the watermark has passed it.  Time is cut into slots of ``life_s`` seconds:
    an event meets only the flags of its slot and the one before, and a conversation is spread over tasks.
    """
    life = int(life_s) * MICROS
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    slot = us - F.pmod(us, F.lit(life))
    e = events.withWatermark(ts, watermark).select(conversation, event, ts, slot.alias("_slot"))
    f = flags.withWatermark(ts, watermark).select(F.col(conversation).alias("_c"), F.col(ts).alias("_flag"),
                                                  F.explode(F.array(slot, slot + F.lit(life))).alias("_s"))
    near = (F.col(conversation) == F.col("_c")) & (F.col("_slot") == F.col("_s")) & (F.col("_flag") <= F.col(ts)) & (F.col("_flag") > F.col(ts) - F.expr(f"INTERVAL {int(life_s)} SECONDS"))
    return e.join(f, near, "leftOuter").groupBy(ts, event, conversation).agg(F.max("_flag").alias("aborted_at"))


def batch_advantages(state: str, prompt: str, order: str, reward: str, buffer: int = 16, min_count: int = 16, eps: float = 1e-6):
    """``foreachBatch`` function of (batch, batch id): advantages of a micro-batch, by the batch rules.

    A prompt's buffer is its last ``buffer`` rewards, this batch included; below ``min_count`` the whole batch's mean
    and deviation count.  Buffers are versions under ``state``, one per batch id: a batch reads its predecessor's and
    writes its own, so a retried batch gives the same rows.  Only the last ``buffer`` rows of a prompt reach its group.
    """
    from pyspark.sql import Window

    def run(batch: DataFrame, batch_id: int) -> DataFrame:
        spark = batch.sparkSession
        rows = batch.select(prompt, F.lit(batch_id).cast("long").alias("_b"), order, reward)
        known = rows if batch_id == 0 else rows.unionByName(spark.read.parquet(f"{state}/v={batch_id - 1}"))
        w = Window.partitionBy(prompt).orderBy(F.desc("_b"), F.desc(order))
        own = f"{state}/v={batch_id}"
        known.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= buffer).drop("_r").write.mode("overwrite").parquet(own)
        stats = spark.read.parquet(own).groupBy(prompt).agg(F.count(F.lit(1)).alias("_n"), F.avg(reward).alias("_m"), F.stddev_pop(reward).alias("_s"))
        whole = rows.agg(F.avg(reward).alias("_bm"), F.stddev_pop(reward).alias("_bs"))
        small = F.col("_n") < min_count
        mean, std = F.when(small, F.col("_bm")).otherwise(F.col("_m")), F.when(small, F.col("_bs")).otherwise(F.col("_s"))
        return (batch.join(stats, prompt).crossJoin(F.broadcast(whole)).withColumn("advantage", (F.col(reward) - mean) / (std + F.lit(eps)))
                .drop("_n", "_m", "_s", "_bm", "_bs"))

    return run
