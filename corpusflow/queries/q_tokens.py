"""Group F (and N5): tokenisation, packing and sequence shaping over ``documents``."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusflow.functions.text import seeded_int, tokens, word_count
from corpusflow.operators import tokens as T
from corpusflow.queries.common import t
from corpusflow.queries.registry import register
from corpusflow.queries.sqlparts import PAIRS
from corpusflow.queries.sqlparts_text import sint, tokens as stok, words as swords
from corpusflow.sources.derived import preference_pairs

G = "F"
VOCAB = 2000


def _vocab(spark, d):
    return T.build_vocab(t(spark, d, "documents"), "text", VOCAB)


def _tok(spark, d, df=None, col="text"):
    df = df if df is not None else t(spark, d, "documents").select("doc_id", "text")
    return T.tokenize(df, col, _vocab(spark, d))


def _ids_str(c):
    return F.array_join(F.transform(F.col(c) if isinstance(c, str) else c, lambda x: x.cast("string")), " ")


VOC_SQL = f"""voc AS (SELECT token, CAST(row_number() OVER (ORDER BY n DESC, token) + 2 AS INTEGER) AS id, n FROM
  (SELECT token, count(*) AS n FROM (SELECT unnest({stok('text')}) AS token FROM documents) GROUP BY token ORDER BY n DESC, token LIMIT {VOCAB}))"""


def tok_sql(src="documents", key="doc_id", text="text", name="tk"):
    return f"""{name}_x AS (SELECT {key}, unnest({stok(text)}) AS token, generate_subscripts({stok(text)}, 1) AS p FROM {src}),
{name} AS (SELECT s.{key}, coalesce(x.ids, []) AS ids FROM {src} s LEFT JOIN
  (SELECT {key}, list(coalesce(v.id, 1) ORDER BY p) AS ids FROM {name}_x LEFT JOIN voc v USING (token) GROUP BY {key}) x USING ({key}))"""


def ids_sql(x):
    return f"array_to_string(list_transform({x}, lambda v: CAST(v AS VARCHAR)), ' ')"


@register("tokenize", G, sql=f"WITH {VOC_SQL}, {tok_sql()} SELECT doc_id, {ids_sql('ids')} AS input_ids, len(ids) AS mask_sum FROM tk")
def q_tokenize(spark, d):
    x = _tok(spark, d)
    return x.select("doc_id", _ids_str("input_ids").alias("input_ids"), F.size("attention_mask").cast("bigint").alias("mask_sum"))


@register("build_vocabulary", G, sql=f"WITH {VOC_SQL} SELECT token, id, n AS count FROM voc")
def q_vocab(spark, d):
    return _vocab(spark, d).select("token", "id", "count")


@register("pad_or_truncate", G, sql=f"""
WITH {VOC_SQL}, {tok_sql()}
SELECT doc_id, {ids_sql("list_concat(ids[1:64], list_transform(range(greatest(64 - len(ids[1:64]), 0)), lambda i: 0))")} AS input_ids,
       {ids_sql("list_concat(list_transform(ids[1:64], lambda i: 1), list_transform(range(greatest(64 - len(ids[1:64]), 0)), lambda i: 0))")} AS attention_mask FROM tk
""")
def q_pad(spark, d):
    x = _tok(spark, d)
    return x.select("doc_id", _ids_str(T.pad("input_ids", 64)).alias("input_ids"), _ids_str(T.pad_mask("input_ids", 64)).alias("attention_mask"))


def _lp_sql(arr, n, v):
    return f"list_concat(list_transform(range(greatest({n} - len({arr}), 0)), lambda i: {v}), {arr})[1:{n}]"


@register("prompt_label_pair", G, sql=f"""
WITH {VOC_SQL},
src AS (SELECT doc_id, 'text : ' || text || ' Label : ' AS p, CASE WHEN quality = 1 THEN 'good' ELSE 'bad' END AS l FROM documents JOIN labels USING (doc_id)),
{tok_sql('src', 'doc_id', 'p', 'tp')}, {tok_sql('src', 'doc_id', 'l', 'tl')},
j AS (SELECT doc_id, tp.ids AS p, list_concat(tl.ids, [0]) AS lab FROM tp JOIN tl USING (doc_id))
SELECT doc_id, {ids_sql(_lp_sql('list_concat(p, lab)', 64, 0))} AS input_ids,
       {ids_sql(_lp_sql('list_transform(list_concat(p, lab), lambda z: 1)', 64, 0))} AS attention_mask,
       {ids_sql(_lp_sql('list_concat(list_transform(p, lambda z: -100), lab)', 64, -100))} AS labels FROM j
""")
def q_prompt_label(spark, d):
    src = (t(spark, d, "documents").join(t(spark, d, "labels"), "doc_id")
           .select("doc_id", F.concat(F.lit("text : "), "text", F.lit(" Label : ")).alias("p"),
                   F.when(F.col("quality") == 1, "good").otherwise("bad").alias("l")))
    voc = _vocab(spark, d)
    x = T.tokenize(T.tokenize(src, "p", voc, "pid"), "l", voc, "lid")
    ids, mask, labels = T.supervised_pair(F.col("pid"), F.col("lid"), 64)
    return x.select("doc_id", _ids_str(ids).alias("input_ids"), _ids_str(mask).alias("attention_mask"), _ids_str(labels).alias("labels"))


@register("left_pad_eval", G, sql=f"""
WITH {VOC_SQL}, {tok_sql()}
SELECT doc_id, {ids_sql(_lp_sql('ids', 64, 0))} AS input_ids, {ids_sql(_lp_sql('list_transform(ids, lambda z: 1)', 64, 0))} AS attention_mask FROM tk
""")
def q_left_pad(spark, d):
    x = _tok(spark, d)
    return x.select("doc_id", _ids_str(T.left_pad(F.col("input_ids"), 64, 0)).alias("input_ids"),
                    _ids_str(T.left_pad(F.col("attention_mask"), 64, 0)).alias("attention_mask"))


@register("masked_lm_labels", G, sql=f"""
WITH {VOC_SQL}, {tok_sql()},
m AS (SELECT doc_id, least(len(ids), 128) AS L, list_transform(range(1, 21), lambda i: CASE WHEN i * 7 < least(len(ids), 128) THEN i * 7 ELSE 0 END) AS pos, ids FROM tk),
c AS (SELECT doc_id, L, pos[1:coalesce(list_position(pos, 0) - 1, 20)] AS pc, ids FROM m),
c2 AS (SELECT doc_id, L, pc, list_transform(pc, lambda p: ids[p + 1]) AS mc FROM c)
SELECT doc_id, {ids_sql("list_transform(range(L), lambda i: CASE WHEN list_contains(pc, i) THEN mc[list_position(pc, i)] ELSE -1 END)")} AS labels FROM c2
""")
def q_mlm(spark, d):
    x = _tok(spark, d).withColumn("L", F.least(F.size("input_ids"), F.lit(128)))
    pos = F.transform(F.sequence(F.lit(1), F.lit(20)), lambda i: F.when(i * 7 < F.col("L"), i * 7).otherwise(F.lit(0)))
    x = x.withColumn("pos", pos)
    mids = F.transform("pos", lambda p: F.when(p > 0, F.col("input_ids")[p]).otherwise(F.lit(0)))
    return x.select("doc_id", _ids_str(T.mlm_labels(F.col("L"), F.col("pos"), mids, 20)).alias("labels"))


@register("overflow_chunks", G, sql=f"""
WITH {VOC_SQL}, {tok_sql()}
SELECT doc_id, w, {ids_sql('ids[w * 128 + 1:(w + 1) * 128]')} AS window FROM tk, LATERAL (SELECT unnest(range(len(ids) // 128)) AS w) WHERE len(ids) >= 128
""")
def q_overflow(spark, d):
    x = T.fixed_windows(_tok(spark, d), "input_ids", 128)
    return x.select("doc_id", F.col("w").cast("bigint").alias("w"), _ids_str("window").alias("window"))


def _pack_sql(n, ids_expr="ids", batch=None):
    b = f"(row_number() OVER (ORDER BY doc_id) - 1) // {batch}" if batch else "0"
    return f"""bt AS (SELECT doc_id, {ids_expr} AS ids, {b} AS batch FROM tk),
off AS (SELECT doc_id, batch, ids, coalesce(sum(len(ids)) OVER (PARTITION BY batch ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS o FROM bt),
g AS (SELECT batch, o + generate_subscripts(ids, 1) - 1 AS g, unnest(ids) AS id FROM off),
tot AS (SELECT batch, sum(len(ids)) AS n FROM bt GROUP BY batch)
SELECT CAST(g.batch AS BIGINT) AS batch, CAST(g // {n} AS BIGINT) AS chunk, string_agg(CAST(id AS VARCHAR), ' ' ORDER BY g) AS input_ids FROM g JOIN tot USING (batch)
WHERE g // {n} < tot.n // {n} GROUP BY g.batch, g // {n}"""


def _pack_out(p, within=True):
    cols = ["batch"] if within else [F.lit(0).cast("bigint").alias("batch")]
    return p.select(*cols, F.col("chunk").cast("bigint").alias("chunk"), _ids_str("input_ids").alias("input_ids"))


@register("pack_tokens_carry", G, sql=f"WITH {VOC_SQL}, {tok_sql()}, {_pack_sql(256)}")
def q_pack(spark, d):
    return _pack_out(T.pack(_tok(spark, d), ["doc_id"], "input_ids", 256), within=False)


@register("pack_tokens_batch", G, sql=f"WITH {VOC_SQL}, {tok_sql()}, {_pack_sql(256, batch=100)}")
def q_pack_batch(spark, d):
    from corpusflow.plans.dense_index import with_index

    x = with_index(_tok(spark, d), ["doc_id"], "_i").withColumn("batch", F.floor(F.col("_i") / 100).cast("bigint"))
    return _pack_out(T.pack(x, ["doc_id"], "input_ids", 256, within=["batch"]))


@register("pack_tokens_eos", G, sql=f"WITH {VOC_SQL}, {tok_sql()}, {_pack_sql(256, 'list_concat(ids, [2])')}")
def q_pack_eos(spark, d):
    return _pack_out(T.pack_eos(_tok(spark, d), ["doc_id"], "input_ids", 256), within=False)


@register("pack_tokens_eos_dropping", G, sql=f"""
WITH RECURSIVE {VOC_SQL}, {tok_sql()},
b AS MATERIALIZED (SELECT row_number() OVER (ORDER BY doc_id) AS i, list_concat(ids, [2]) AS ids, len(ids) + 1 AS n FROM tk),
r(i, pos, chunk) AS (SELECT CAST(1 AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS BIGINT) UNION ALL
  SELECT r.i + 1, CASE WHEN pos + n >= 256 THEN 0 ELSE pos + n END, chunk + CASE WHEN pos + n >= 256 THEN 1 ELSE 0 END FROM r JOIN b ON b.i = r.i)
SELECT CAST(0 AS BIGINT) AS batch, chunk, string_agg(array_to_string(ids[1:256 - pos], ' '), ' ' ORDER BY r.i) AS input_ids
FROM r JOIN b ON b.i = r.i GROUP BY chunk HAVING sum(least(n, 256 - pos)) = 256
""")
def q_pack_eos_dropping(spark, d):
    # wrap=False: what the document that fills a chunk has left is dropped
    return _pack_out(T.pack_eos(_tok(spark, d), ["doc_id"], "input_ids", 256, wrap=False), within=False)


@register("random_crop", G, sql=f"""
WITH {VOC_SQL}, {tok_sql()},
s AS (SELECT doc_id, ids, CASE WHEN len(ids) > 64 THEN {sint(5, 'doc_id')} % (len(ids) - 64) ELSE 0 END AS start FROM tk)
SELECT doc_id, start, {ids_sql('ids[start + 1:start + 64]')} AS input_ids FROM s
""")
def q_crop(spark, d):
    x = _tok(spark, d)
    start, ids = T.random_crop(F.col("input_ids"), 64, 5, F.col("doc_id"))
    return x.select("doc_id", start.cast("bigint").alias("start"), _ids_str(ids).alias("input_ids"))


@register("first_n_tokens_random", G, sql=f"""
SELECT doc_id, array_to_string({stok('text')}[1:2 + {sint(9, 'doc_id')} % 6], ' ') AS prefix FROM documents
""")
def q_prefix(spark, d):
    docs = t(spark, d, "documents")
    n = (F.lit(2) + F.pmod(seeded_int(9, F.col("doc_id")), F.lit(6))).cast("int")
    return docs.select("doc_id", F.array_join(F.slice(tokens("text"), 1, n), " ").alias("prefix"))


@register("token_budget_counters", G, sql=f"""
SELECT conv_id, CAST(coalesce(sum(len({stok('text')})) FILTER (WHERE role = 'user'), 0) AS BIGINT) AS prompt,
       CAST(coalesce(sum(len({stok('text')})) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS generation,
       CAST(coalesce(sum(len({stok('text')})) FILTER (WHERE role = 'system'), 0) AS BIGINT) AS embedding,
       CAST(sum(len({stok('text')})) AS BIGINT) AS total
FROM conversations GROUP BY conv_id
""")
def q_budget(spark, d):
    c = t(spark, d, "conversations")
    kind = F.when(F.col("role") == "user", "prompt").when(F.col("role") == "assistant", "generation").otherwise("embedding")
    p = (c.select("conv_id", kind.alias("kind"), F.size(tokens("text")).alias("n"))
         .groupBy("conv_id").pivot("kind", ["prompt", "generation", "embedding"]).agg(F.sum("n")))
    p = p.fillna(0, ["prompt", "generation", "embedding"])
    return p.select("conv_id", *[F.col(k).cast("bigint").alias(k) for k in ("prompt", "generation", "embedding")],
                    (F.col("prompt") + F.col("generation") + F.col("embedding")).cast("bigint").alias("total"))


@register("estimate_tokens", G, sql=f"SELECT doc_id, CAST(ceil(len({swords('text')}) * 1.3) AS BIGINT) AS est_tokens FROM documents")
def q_estimate(spark, d):
    return t(spark, d, "documents").select("doc_id", F.ceil(word_count("text") * 1.3).cast("bigint").alias("est_tokens"))


@register("collate_batches", G, sql="""
SELECT batch, string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY doc_id) AS doc_ids FROM
 (SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // 16 AS batch FROM documents) GROUP BY batch HAVING count(*) = 16
""")
def q_collate(spark, d):
    b = T.collate(t(spark, d, "documents").select("doc_id"), ["doc_id"], 16, ["doc_id"], drop_last=True)
    return b.select(F.col("batch").cast("bigint").alias("batch"), F.array_join(F.transform("doc_id", lambda x: x.cast("string")), ",").alias("doc_ids"))


def _pairs_tok(spark, d):
    p = preference_pairs(t(spark, d, "conversations"))
    p = p.select("conv_id", F.concat(F.lit("Question: "), "question", F.lit("\n\nAnswer: "), "response_j").alias("tj"),
                 F.concat(F.lit("Question: "), "question", F.lit("\n\nAnswer: "), "response_k").alias("tk"))
    voc = _vocab(spark, d)
    return T.tokenize(T.tokenize(p, "tj", voc, "ids_j"), "tk", voc, "ids_k")


PAIR_TOK_SQL = f"""src AS (SELECT conv_id, 'Question: ' || question || chr(10) || chr(10) || 'Answer: ' || response_j AS tj,
                      'Question: ' || question || chr(10) || chr(10) || 'Answer: ' || response_k AS tk FROM pairs),
{tok_sql('src', 'conv_id', 'tj', 'xj')}, {tok_sql('src', 'conv_id', 'tk', 'xk')}"""


@register("tokenize_pair", "N", sql=f"""
WITH {VOC_SQL}, {PAIRS}, {PAIR_TOK_SQL}
SELECT conv_id, len(xj.ids) AS n_j, len(xk.ids) AS n_k FROM xj JOIN xk USING (conv_id) WHERE len(xj.ids) <= 512 AND len(xk.ids) <= 512
""")
def q_tok_pair(spark, d):
    from corpusflow.operators.select import filter_tokens

    x = filter_tokens(_pairs_tok(spark, d), ["ids_j", "ids_k"], 512, inclusive=True)
    return x.select("conv_id", F.size("ids_j").cast("bigint").alias("n_j"), F.size("ids_k").cast("bigint").alias("n_k"))


@register("pad_pair_batch", G, sql=f"""
WITH {VOC_SQL}, {PAIRS}, {PAIR_TOK_SQL},
b AS (SELECT conv_id, len(xj.ids) AS n_j, len(xk.ids) AS n_k, (row_number() OVER (ORDER BY conv_id) - 1) // 4 AS batch FROM xj JOIN xk USING (conv_id)),
p AS (SELECT conv_id, batch, n_j, n_k, max(greatest(n_j, n_k)) OVER (PARTITION BY batch) AS padded_len FROM b),
a AS (SELECT p.*, list_concat(xj.ids, list_transform(range(padded_len - n_j), lambda i: 0)) AS j, list_concat(xk.ids, list_transform(range(padded_len - n_k), lambda i: 0)) AS k
      FROM p JOIN xj USING (conv_id) JOIN xk USING (conv_id))
SELECT conv_id, batch, n_j, n_k, padded_len, {ids_sql('j')} AS input_ids_j, {ids_sql('k')} AS input_ids_k FROM a
""")
def q_pad_pairs(spark, d):
    from pyspark.sql import Window

    from corpusflow.plans.dense_index import with_index

    x = with_index(_pairs_tok(spark, d), ["conv_id"], "_i").withColumn("batch", F.floor(F.col("_i") / 4).cast("bigint"))
    x = x.select("conv_id", "batch", "ids_j", "ids_k", F.size("ids_j").cast("bigint").alias("n_j"), F.size("ids_k").cast("bigint").alias("n_k"))
    # a batch holds 4 pairs: the window is bounded by construction
    x = x.withColumn("padded_len", F.max(F.greatest("n_j", "n_k")).over(Window.partitionBy("batch")))
    return x.select("conv_id", "batch", "n_j", "n_k", "padded_len",
                    *[_ids_str(T.pad(f"ids_{s}", F.col("padded_len").cast("int"))).alias(f"input_ids_{s}") for s in "jk"])
