"""Group Q: streams run to completion (availableNow, file source) and read back; compared with the batch answer."""

from functools import reduce

from pyspark.sql import functions as F

from corpusflow.operators.chatstats import merge_stats
from corpusflow.functions.text import tokens
from corpusflow.queries.common import day, r6, t
from corpusflow.queries.registry import register
from corpusflow.queries.sqlparts_text import tokens as stok
from corpusflow.sources.readers import scratch_path
from corpusflow.streaming import ops as Q
from corpusflow.streaming import stateful as S
from corpusflow.streaming.runner import LEAST_FILES, epoch_stream, file_count, file_stream, latest_per_key, read_sink, run_to_sink, stream_of

G = "Q"
SHARD_DOCS = 50_000  # documents of a buffer
UPDATES_A_FILE = 500_000  # message updates of a stream file
KEYWORDS = ["License", "license", "password", "@"]


@register("stream_keyword_filter", G, sql="SELECT doc_id FROM documents WHERE " + " OR ".join(f"contains(text, '{k}')" for k in KEYWORDS))
def q_s_filter(spark, d):
    s = file_stream(spark, d, "documents", "doc_id", zoned=False)
    out, _ = run_to_sink(Q.stream_filter(s, "text", KEYWORDS).select("doc_id"))
    return read_sink(spark, out, "doc_id bigint").drop("_batch")


@register("stream_rate_limit", G, sql="""
SELECT user_id, event_id, greatest(count(*) OVER u, count(*) OVER i) AS n, greatest(count(*) OVER u, count(*) OVER i) > 2 AS over_limit FROM events
WINDOW u AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL '59999999 microseconds' PRECEDING AND CURRENT ROW),
       i AS (PARTITION BY json_extract_string(props, '$.k') ORDER BY ts RANGE BETWEEN INTERVAL '59999999 microseconds' PRECEDING AND CURRENT ROW)
""")
def q_s_rate(spark, d):
    # exact per-event answer: each message against the last 60 s of its user and of its address (props.k); the larger counts
    s = file_stream(spark, d, "events", "ts")
    who = F.array(F.concat(F.lit("u"), F.col("user_id").cast("string")), F.concat(F.lit("i"), F.get_json_object("props", "$.k")))
    out, _ = run_to_sink(Q.rate_limit(s.select("ts", "event_id", F.explode(who).alias("who")), "who", "ts", "event_id", 60, 2))
    seen = read_sink(spark, out, "who string, event_id bigint, n bigint, over_limit boolean")
    user = F.max(F.when(F.substring("who", 1, 1) == "u", F.expr("substring(who, 2)"))).cast("bigint")
    return seen.groupBy("event_id").agg(user.alias("user_id"), F.max("n").alias("n")).withColumn("over_limit", F.col("n") > 2)


@register("stream_activity", G, sql="\nUNION ALL\n".join(
    f"SELECT '{s}' AS span, strftime(date_trunc('{s}', ts), '%Y-%m-%d') AS at, count(*) AS n FROM events GROUP BY 2" for s in ("day", "week", "month")))
def q_s_activity(spark, d):
    s = file_stream(spark, d, "events", "ts")
    out, _ = run_to_sink(Q.tumbling_counts(s, "ts"), mode="update")
    r = latest_per_key(read_sink(spark, out, "w struct<start: timestamp, end: timestamp>, n bigint"), ["w"])
    days = r.select(F.col("w.start").alias("start"), "n")
    # weeks and months follow from the (few) days
    spans = [days.select(F.lit(s).alias("span"), day(F.date_trunc(s, F.col("start"))).alias("at"), "n") for s in ("day", "week", "month")]
    fresh = reduce(lambda a, b: a.unionByName(b), spans).groupBy("span", "at").agg(F.sum("n").alias("n"))
    # into the stored table, here the days known before the stream ran: the stream's rows replace them
    early = t(spark, d, "events").filter(F.col("ts") < F.lit("2024-01-03 00:00:00").cast("timestamp_ntz"))
    stored = early.groupBy(F.lit("day").alias("span"), day("ts").alias("at")).agg(F.count(F.lit(1)).alias("n"))
    return merge_stats(stored, fresh, ["span", "at"])


@register("stream_distinct_actors", G, sql="SELECT strftime(ts, '%Y-%m-%d') AS day, count(DISTINCT user_id) AS users FROM events GROUP BY 1")
def q_s_distinct(spark, d):
    s = file_stream(spark, d, "events", "ts")
    out, _ = run_to_sink(Q.distinct_actors(s, "ts", "user_id"))
    firsts = read_sink(spark, out, "day string, user_id bigint")
    return firsts.groupBy("day").agg(F.count(F.lit(1)).alias("users"))


LOGIN = "signup"
_US = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def _flush(spark, d, *kinds):
    """Marker rows one year after the last event (session -1), one per event type: they move the watermark past everything."""
    ev = t(spark, d, "events", zoned=True)
    return (ev.agg(F.max("ts").alias("m"), F.max("event_id").alias("i"))
            .select((F.col("i") + 1).alias("event_id"), (F.col("m") + F.expr("INTERVAL 365 DAYS")).alias("ts"),
                    F.lit(-1).cast("bigint").alias("user_id"), F.explode(F.array(*[F.lit(k) for k in kinds])).alias("event_type"),
                    F.lit(0.0).alias("value"), F.lit('{"k": -1}').alias("props")))


@register("stream_session_expiry", G, sql=f"""
WITH s AS (SELECT json_extract_string(props, '$.k') AS session_id, user_id, ts, lead(ts) OVER (PARTITION BY json_extract_string(props, '$.k') ORDER BY ts, user_id) AS nxt
           FROM events WHERE event_type = '{LOGIN}')
SELECT session_id, user_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS login,
       strftime(least(coalesce(nxt, ts + INTERVAL 14 DAYS), ts + INTERVAL 14 DAYS), '%Y-%m-%d %H:%M:%S.%f') AS removed_at,
       CASE WHEN nxt < ts + INTERVAL 14 DAYS THEN 'replaced' ELSE 'expired' END AS reason
FROM s
""")
def q_s_sessions(spark, d):
    s = file_stream(spark, d, "events", "ts", flush_rows=_flush(spark, d, LOGIN)).filter(F.col("event_type") == LOGIN)
    s = s.select(F.get_json_object("props", "$.k").alias("session_id"), "user_id", "ts")
    out, _ = run_to_sink(S.session_expiry(s, "session_id", "user_id", "ts"), stateful=True)
    r = read_sink(spark, out, "session_id string, user_id bigint, login timestamp, removed_at timestamp, reason string").filter(F.col("user_id") >= 0)
    return r.select("session_id", "user_id", F.date_format("login", _US).alias("login"), F.date_format("removed_at", _US).alias("removed_at"), "reason")


@register("stream_abort_ttl", G, sql="""
WITH e AS (SELECT json_extract_string(props, '$.k') AS conversation, event_id, event_type, ts FROM events)
SELECT g.conversation, g.event_id, strftime(max(f.ts), '%Y-%m-%d %H:%M:%S.%f') AS aborted_at
FROM e g LEFT JOIN e f ON f.event_type = 'error' AND f.conversation = g.conversation AND f.ts <= g.ts AND f.ts > g.ts - INTERVAL 30 SECONDS
WHERE g.event_type <> 'error' GROUP BY 1, 2
""")
def q_s_abort(spark, d):
    # flags are the error events, every other event asks whether its conversation has an active one
    s = file_stream(spark, d, "events", "ts", flush_rows=_flush(spark, d, "error", "view"))
    s = s.withColumn("conversation", F.get_json_object("props", "$.k"))
    asked, flags = s.filter(F.col("event_type") != "error"), s.filter(F.col("event_type") == "error")
    out, _ = run_to_sink(S.active_aborts(asked, flags, "conversation", "event_id", "ts"))
    r = read_sink(spark, out, "conversation string, event_id bigint, aborted_at timestamp").filter(F.col("conversation") != "-1")
    return r.select("conversation", "event_id", F.date_format("aborted_at", _US).alias("aborted_at"))


def _chain_time(c):
    """The fixture's conversations have no time: one second per conversation."""
    return F.timestamp_seconds(F.col(c) + 1_704_067_200)


@register("stream_message_assembly", G, sql="""
SELECT CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS message_id,
       array_to_string(list_filter(string_split(text, ' '), lambda w: w <> ''), ' ') AS text, 1 AS n_status, TRUE AS complete
FROM conversations WHERE role = 'assistant'
""")
def q_s_assembly(spark, d):
    c = t(spark, d, "conversations").filter(F.col("role") == "assistant")
    base = c.select(F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("message_id"), "conv_id",
                    _chain_time("conv_id").alias("ts"), F.split("text", " ", -1).alias("words"))
    toks = base.select("message_id", "conv_id", "ts", F.posexplode("words").alias("seq", "token"), F.lit("token").alias("kind"))
    started = base.select("message_id", "conv_id", "ts", F.lit(-1).alias("seq"), F.lit("started").alias("token"), F.lit("status").alias("kind"))
    ended = base.select("message_id", "conv_id", "ts", F.size("words").alias("seq"), F.lit("").alias("token"), F.lit("end").alias("kind"))
    rows = toks.unionByName(started).unionByName(ended)
    # updates of a message arrive in several files, out of order, up to 40 seconds late
    rows = rows.withColumn("arrives", F.col("conv_id") + F.pmod(F.xxhash64("message_id", "seq"), F.lit(40))).drop("conv_id")
    # files follow the number of updates, many times that of the messages
    n = base.agg(F.sum(F.size("words") + 2).alias("n")).first()["n"] or 0
    s = stream_of(rows, "updates", "arrives", max(LEAST_FILES, -(-n // UPDATES_A_FILE)))
    out, _ = run_to_sink(S.assemble(s, "message_id", "ts"), stateful=True)
    return read_sink(spark, out, "message_id string, text string, n_status int, complete boolean").drop("_batch")


@register("stream_packing", G, sql=f"""
WITH n AS (SELECT greatest(8, CAST(ceil(count(*) / {SHARD_DOCS}.0) AS BIGINT)) AS shards FROM documents),
s AS (SELECT lang || '/' || CAST(doc_id % shards AS VARCHAR) AS shard, sum(len({stok('text')}) + 1) // 256 AS k FROM documents, n GROUP BY 1)
SELECT shard, CAST(chunk AS BIGINT) AS chunk, CAST(256 AS INTEGER) AS n FROM s, LATERAL (SELECT unnest(range(CAST(k AS BIGINT))) AS chunk)
""")
def q_s_pack(spark, d):
    # a language is spread over shards, each with a buffer of its own; their number follows the table
    docs = t(spark, d, "documents")
    shards = max(8, -(-docs.count() // SHARD_DOCS))
    shard = F.concat_ws("/", "lang", (F.col("doc_id") % shards).cast("string"))
    src = stream_of(docs.select("doc_id", shard.alias("shard"), "text"), "docs", "doc_id", file_count(spark, f"{d.rstrip('/')}/documents.parquet"))
    # a file is one scan task: its documents are dealt out before they are cut into tokens
    sdf = src.repartition(spark.sparkContext.defaultParallelism).select("doc_id", "shard", F.transform(tokens("text"), lambda x: F.length(x)).alias("ids"))
    out, _ = run_to_sink(Q.pack_stream(sdf, "shard", ["doc_id"], "ids", 256, eos=2))
    return read_sink(spark, out, "shard string, chunk bigint, input_ids array<int>").select("shard", "chunk", F.size("input_ids").alias("n"))


BUFFER, MIN_COUNT = 16, 16


@register("stream_prompt_advantage", G, sql=f"""
WITH r AS (SELECT event_type AS prompt, strftime(date_trunc('week', ts), '%Y-%m-%d') AS epoch, event_id, value AS reward FROM events),
e AS (SELECT DISTINCT prompt, epoch FROM r),
b AS (SELECT e.prompt, e.epoch, r.reward, row_number() OVER (PARTITION BY e.prompt, e.epoch ORDER BY r.epoch DESC, r.event_id DESC) AS back
      FROM e JOIN r ON r.prompt = e.prompt AND r.epoch <= e.epoch),
s AS (SELECT prompt, epoch, count(*) AS n, avg(reward) AS m, stddev_pop(reward) AS sd FROM b WHERE back <= {BUFFER} GROUP BY 1, 2),
w AS (SELECT epoch, avg(reward) AS bm, stddev_pop(reward) AS bsd FROM r GROUP BY 1)
SELECT prompt, epoch, event_id, round((reward - CASE WHEN n < {MIN_COUNT} THEN bm ELSE m END) / (CASE WHEN n < {MIN_COUNT} THEN bsd ELSE sd END + 1e-6), 6) AS advantage
FROM r JOIN s USING (prompt, epoch) JOIN w USING (epoch)
""")
def q_s_adv(spark, d):
    ev = t(spark, d, "events", zoned=True)
    rewards = ev.select(F.col("event_type").alias("prompt"), "event_id", F.col("value").alias("reward"), day(F.date_trunc("week", F.col("ts"))).alias("epoch"))
    run = S.batch_advantages(scratch_path(spark, "reward-buffers"), "prompt", "event_id", "reward", BUFFER, MIN_COUNT)
    out, _ = run_to_sink(epoch_stream(rewards, "rewards", "epoch"), per_batch=run)
    r = read_sink(spark, out, "prompt string, event_id bigint, epoch string, advantage double")
    return r.select("prompt", F.col("epoch").cast("string").alias("epoch"), "event_id", r6("advantage").alias("advantage"))


@register("stream_token_counters", G, sql=f"""
SELECT conv_id, CASE role WHEN 'user' THEN 'prompt' WHEN 'assistant' THEN 'generation' ELSE 'embedding' END AS kind,
       CAST(sum(len({stok('text')})) AS BIGINT) AS tokens FROM conversations GROUP BY 1, 2
""")
def q_s_tokens(spark, d):
    c = t(spark, d, "conversations")
    last = c.agg((F.max("conv_id") + 86_400).alias("conv_id")).select(
        "conv_id", F.lit(0).cast("bigint").alias("turn"), F.lit("marker").alias("role"), F.lit("").alias("text"))
    s = file_stream(spark, d, "conversations", "conv_id", zoned=False, flush_rows=last)
    kind = F.when(F.col("role") == "user", "prompt").when(F.col("role") == "assistant", "generation").when(F.col("role") == "marker", "marker").otherwise("embedding")
    s = s.select("conv_id", kind.alias("kind"), F.size(tokens("text")).alias("n"), _chain_time("conv_id").alias("ts"))
    out, _ = run_to_sink(Q.token_counters(s, "conv_id", "kind", "n", "ts"))
    r = read_sink(spark, out, "conv_id bigint, kind string, tokens bigint").filter(F.col("kind") != "marker")
    return r.select("conv_id", "kind", F.col("tokens").cast("bigint").alias("tokens"))


@register("stream_scale_signal", G, sql="""
WITH RECURSIVE w AS MATERIALIZED (
  SELECT event_type AS endpoint, time_bucket(INTERVAL '1 minute', ts) AS t, round(avg(value), 6) AS avg_util,
         CASE WHEN avg(value) > 50 THEN 'scale_out' WHEN avg(value) < 25 THEN 'scale_in' ELSE 'hold' END AS signal,
         row_number() OVER (PARTITION BY event_type ORDER BY time_bucket(INTERVAL '1 minute', ts)) AS i FROM events GROUP BY 1, 2),
a(endpoint, i, last, action) AS (
  SELECT DISTINCT endpoint, CAST(0 AS BIGINT), TIMESTAMP '1970-01-01 00:00:00', 'hold' FROM w
  UNION ALL
  SELECT w.endpoint, w.i, CASE WHEN ok THEN t ELSE last END, CASE WHEN ok THEN signal ELSE 'hold' END
  FROM (SELECT w.*, a.last, CASE signal WHEN 'scale_out' THEN t >= last + INTERVAL 60 SECONDS WHEN 'scale_in' THEN t >= last + INTERVAL 300 SECONDS ELSE FALSE END AS ok
        FROM a JOIN w ON w.endpoint = a.endpoint AND w.i = a.i + 1) w)
SELECT endpoint, strftime(t, '%Y-%m-%d %H:%M:%S') AS window_start, avg_util, signal, action FROM w JOIN a USING (endpoint, i)
""")
def q_s_scale(spark, d):
    # two stateful steps in one stream: closed windows, then actions with waits of 60 and 300 seconds
    s = file_stream(spark, d, "events", "ts", flush_rows=_flush(spark, d, "marker"))
    out, _ = run_to_sink(S.scale_actions(Q.scale_signal(s, "event_type", "ts", "value", 50.0, "1 minute"), "event_type"), stateful=True)
    r = read_sink(spark, out, "event_type string, window_start timestamp, avg_util double, signal string, action string").filter(F.col("event_type") != "marker")
    return r.select(F.col("event_type").alias("endpoint"), F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"),
                    r6("avg_util").alias("avg_util"), "signal", "action")


@register("stream_new_only", G, sql="""
SELECT DISTINCT user_id, event_type FROM events
EXCEPT SELECT user_id, event_type FROM events WHERE ts < TIMESTAMP '2024-01-03 00:00:00'
""")
def q_s_new(spark, d):
    ev = t(spark, d, "events")
    stored = ev.filter(F.col("ts") < F.lit("2024-01-03 00:00:00").cast("timestamp_ntz")).select("user_id", "event_type").distinct()
    target = scratch_path(spark, "stored-items")
    stored.withColumn("from_batch", F.lit(-1).cast("bigint")).write.mode("overwrite").parquet(f"{target}/stored")
    s = file_stream(spark, d, "events", "ts").select("user_id", "event_type")

    def insert_new(batch, batch_id):
        # items already stored, by earlier batches too, are skipped; duplicates inside the batch collapse.  The new
        # ones join the store under their batch id, so a retried batch replaces its own
        have = spark.read.parquet(f"{target}/*").filter(F.col("from_batch") != batch_id)
        new = batch.dropDuplicates(["user_id", "event_type"]).join(have, ["user_id", "event_type"], "left_anti")
        new.withColumn("from_batch", F.lit(batch_id).cast("bigint")).write.mode("overwrite").parquet(f"{target}/items-{batch_id}")
        return spark.read.parquet(f"{target}/items-{batch_id}").drop("from_batch")

    out, _ = run_to_sink(s, per_batch=insert_new)
    return read_sink(spark, out, "user_id bigint, event_type string").drop("_batch")
