"""Groups N and O: preference data and evaluation."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from corpusflow.functions.text import words
from corpusflow.operators import preferences as P
from corpusflow.operators import udf as U
from corpusflow.operators.joins import adjacent_pairs, attach_scalar
from corpusflow.queries.common import r6, t
from corpusflow.queries.registry import register
from corpusflow.queries.sqlparts import PAIRS
from corpusflow.queries.sqlparts_text import words as swords
from corpusflow.sources.derived import preference_pairs, qa_pairs

N, O = "N", "O"


def _ranked(spark, d):
    """Assistant turns of a thread, ranking = position (1 = best), n = number of answers."""
    a = t(spark, d, "conversations").filter(F.col("role") == "assistant")
    w = Window.partitionBy("conv_id").orderBy("turn")
    return a.withColumn("ranking", F.row_number().over(w)).withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("conv_id")))


RANKED_SQL = """ranked AS (SELECT conv_id, turn, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS ranking,
                              count(*) OVER (PARTITION BY conv_id) AS n FROM conversations WHERE role = 'assistant')"""


@register("parse_human_answers", N, sql="""
WITH a AS (SELECT conv_id, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS r FROM conversations WHERE role = 'assistant'),
q AS (SELECT conv_id, arg_min(text, turn) AS prompt FROM conversations WHERE role = 'user' GROUP BY conv_id)
SELECT a.conv_id, q.prompt, CAST(r - 1 AS INTEGER) AS pos, text AS response, CAST(r AS INTEGER) AS ranking FROM a JOIN q USING (conv_id)
""")
def q_parse_answers(spark, d):
    c = t(spark, d, "conversations")
    q = c.filter(F.col("role") == "user").groupBy("conv_id").agg(F.min_by("text", "turn").alias("prompt"))
    a = (c.filter(F.col("role") == "assistant").groupBy("conv_id")
         .agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda x: x["text"]).alias("responses")))
    # labelling-tool output rendered as JSON (both key styles occur), then parsed back
    answer = F.map_from_entries(F.transform("responses", lambda x, i: F.struct(
        F.when(i % 2 == 0, F.concat(F.lit("response_"), (i + 1).cast("string"), F.lit("_ranking")))
        .otherwise(F.concat(F.lit("ranking_"), (i + 1).cast("string"))), i + 1)))
    doc = F.to_json(F.struct(F.struct(F.struct(F.col("prompt"), F.col("responses")).alias("taskObject")).alias("inputContent"),
                             F.array(F.struct(answer.alias("answerContent"))).alias("humanAnswers")))
    js = q.join(a, "conv_id").select("conv_id", doc.alias("json"))
    return P.parse_rankings(js, "json", "conv_id")


@register("ranking_to_reward", N, sql=f"WITH {RANKED_SQL} SELECT conv_id, turn, abs(ranking - n) AS reward FROM ranked")
def q_rank_reward(spark, d):
    r = _ranked(spark, d)
    return r.select("conv_id", "turn", P.rank_to_reward(F.col("ranking"), F.col("n")).cast("bigint").alias("reward"))


@register("preferred_rejected_text", N, sql=f"""
WITH {RANKED_SQL}, g AS (SELECT conv_id, list(text ORDER BY turn) AS resp, count(*) AS n FROM ranked GROUP BY conv_id)
SELECT conv_id, CASE WHEN n = 2 THEN resp[1] END AS text_j, CASE WHEN n = 2 THEN resp[2] END AS text_k,
       CASE WHEN n <> 2 THEN 'expected two responses ranked 0 and 1' END AS error FROM g
""")
def q_pref_text(spark, d):
    r = _ranked(spark, d)
    g = r.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "text", (F.col("ranking") - 1).alias("rk")))).alias("a"))
    j, k, err = P.to_pairs(F.transform("a", lambda x: x["text"]), F.transform("a", lambda x: x["rk"]))
    return g.select("conv_id", j.alias("text_j"), k.alias("text_k"), err.alias("error"))


@register("chosen_rejected", N, sql=f"""
WITH {PAIRS}
SELECT conv_id, 'Question: ' || question || chr(10) || chr(10) || 'Answer: ' AS prompt, response_j AS chosen, response_k AS rejected FROM pairs
""")
def q_dpo(spark, d):
    p = preference_pairs(t(spark, d, "conversations"))
    return p.select("conv_id", F.concat(F.lit("Question: "), "question", F.lit("\n\nAnswer: ")).alias("prompt"),
                    F.col("response_j").alias("chosen"), F.col("response_k").alias("rejected"))


@register("nway_pairwise_expand", N, sql=f"""
WITH {RANKED_SQL}
SELECT conv_id, turn AS turn_a, lead(turn) OVER (PARTITION BY conv_id ORDER BY ranking) AS turn_b, 1 AS label FROM ranked
QUALIFY lead(turn) OVER (PARTITION BY conv_id ORDER BY ranking) IS NOT NULL
""")
def q_nway(spark, d):
    # ranked answers as consecutive preference pairs (n - 1 rows): the same order without n(n-1)/2 rows
    r = _ranked(spark, d).select("conv_id", "ranking", "turn")
    p = adjacent_pairs(r, "conv_id", "ranking", ["turn"])
    return p.select("conv_id", F.col("turn_a"), F.col("turn_b"), F.lit(1).alias("label"))


@register("reward_with_baseline", N, sql="""
SELECT doc_id, round(quality - (SELECT avg(quality) FROM labels), 6) AS reward FROM labels
""")
def q_baseline(spark, d):
    lab = t(spark, d, "labels")
    base = lab.agg(F.avg("quality").alias("baseline"))
    return attach_scalar(lab, base).select("doc_id", r6(F.col("quality") - F.col("baseline")).alias("reward"))


@register("reward_from_logits", N, sql="""
SELECT doc_id, CAST(1 - 2 * toxic AS DOUBLE) AS nothate_logit,
       round(exp(1 - 2 * toxic) / (exp(2 * toxic - 1) + exp(1 - 2 * toxic)), 6) AS nothate_prob FROM labels
""")
def q_logits(spark, d):
    lab = t(spark, d, "labels")
    s = F.array(F.struct(F.lit("hate").alias("label"), (2 * F.col("toxic") - 1).cast("double").alias("score")),
                F.struct(F.lit("nothate").alias("label"), (1 - 2 * F.col("toxic")).cast("double").alias("score")))
    x = lab.select("doc_id", s.alias("scores"))
    return x.select("doc_id", P.class_score(F.col("scores"), "nothate").alias("nothate_logit"),
                    r6(P.softmax_score(F.col("scores"), "nothate")).alias("nothate_prob"))


@register("answer_match_reward", N, sql=f"""
WITH q AS (SELECT conv_id, turn, {swords('text')}[1] AS expected FROM conversations WHERE role = 'user'),
r AS (SELECT conv_id, turn - 1 AS turn, text AS response FROM conversations WHERE role = 'assistant')
SELECT conv_id, round(avg(CASE WHEN contains(response, expected) THEN 1.0 ELSE 0.0 END), 6) AS reward
FROM q JOIN r USING (conv_id, turn) GROUP BY conv_id
""")
def q_answer_match(spark, d):
    # each expected answer (the question's first word) against the answer to that question
    pairs = qa_pairs(t(spark, d, "conversations"))
    hit = F.when(F.col("answer").contains(words("question")[0]), 1.0).otherwise(0.0)
    return pairs.groupBy("conv_id").agg(r6(F.avg(hit)).alias("reward"))


@register("compressibility_reward", N, sql="""
SELECT page_id, round(octet_length(encode(html)) / 1000.0, 6) AS size_kb, round(-octet_length(encode(html)) / 1000.0, 6) AS reward FROM pages
""")
def q_compress(spark, d):
    p = t(spark, d, "pages")
    kb = F.length(F.encode("html", "UTF-8")) / 1000.0
    return p.select("page_id", r6(kb).alias("size_kb"), r6(-kb).alias("reward"))


# --- O: evaluation.  Model outputs: prediction A = first half of the words, B = last half, reference = whole text


def _outputs(spark, d):
    docs = t(spark, d, "documents").select("doc_id", "text", words("text").alias("w"))
    half = F.floor(F.size("w") / 2).cast("int")
    return docs.select("doc_id", F.col("text").alias("ref"), F.array_join(F.slice("w", 1, half), " ").alias("pred_a"),
                       F.array_join(F.slice("w", half + 1, F.size("w") - half), " ").alias("pred_b"))


OUT_SQL = f"""w AS (SELECT doc_id, text, {swords('text')} AS w FROM documents),
o AS (SELECT doc_id, text AS ref, array_to_string(w[1:len(w) // 2], ' ') AS pred_a, array_to_string(w[len(w) // 2 + 1:len(w)], ' ') AS pred_b FROM w)"""


def _rouge_sql(pred, n, name):
    tok = lambda x: f"regexp_extract_all(lower({x}), '[a-z0-9]+')"
    gram = lambda x: f"CASE WHEN len({x}) >= {n} THEN list_transform(range(len({x}) - {n} + 1), lambda i: array_to_string({x}[i + 1:i + {n}], ' ')) ELSE [] END"
    return f"""{name}_t AS (SELECT doc_id, {tok(pred)} AS pt, {tok('ref')} AS rt FROM o),
{name}_g AS (SELECT doc_id, {gram('pt')} AS pg, {gram('rt')} AS rg FROM {name}_t),
{name}_pc AS (SELECT doc_id, g, count(*) AS c FROM (SELECT doc_id, unnest(pg) AS g FROM {name}_g) GROUP BY ALL),
{name}_rc AS (SELECT doc_id, g, count(*) AS c FROM (SELECT doc_id, unnest(rg) AS g FROM {name}_g) GROUP BY ALL),
{name}_ov AS (SELECT doc_id, sum(least(p.c, r.c)) AS ov FROM {name}_pc p JOIN {name}_rc r USING (doc_id, g) GROUP BY doc_id),
{name} AS (SELECT doc_id, CASE WHEN len(pg) > 0 THEN coalesce(ov, 0) / len(pg) ELSE 0.0 END AS p, CASE WHEN len(rg) > 0 THEN coalesce(ov, 0) / len(rg) ELSE 0.0 END AS r
           FROM {name}_g LEFT JOIN {name}_ov USING (doc_id)),
{name}_f AS (SELECT doc_id, p, r, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0.0 END AS f FROM {name})"""


@register("rouge_n", O, sql=f"""
WITH {OUT_SQL}, {_rouge_sql('pred_a', 1, 'r1')}, {_rouge_sql('pred_a', 2, 'r2')}
SELECT doc_id, round(r1_f.p, 6) AS rouge1_precision, round(r1_f.r, 6) AS rouge1_recall, round(r1_f.f, 6) AS rouge1_f1, round(r2_f.f, 6) AS rouge2_f1
FROM r1_f JOIN r2_f USING (doc_id)
""")
def q_rouge_n(spark, d):
    o = _outputs(spark, d)
    return P.rouge_wide(o, "doc_id", "pred_a", "ref").select(
        "doc_id", r6("precision_1").alias("rouge1_precision"), r6("recall_1").alias("rouge1_recall"),
        r6("f1_1").alias("rouge1_f1"), r6("f1_2").alias("rouge2_f1"))


@register("rouge_l", O)
def q_rouge_l(spark, d):
    o = _outputs(spark, d)
    return P.rouge_l(o, "doc_id", "pred_a", "ref").select("doc_id", "lcs", r6("f1").alias("rougeL_f1"))


@register("rouge_lsum", O)
def q_rouge_lsum(spark, d):
    # conversations: each answer against its question, turn by turn (texts of a few lines)
    p = qa_pairs(t(spark, d, "conversations")).withColumn("id", F.concat_ws("-", "conv_id", "turn"))
    s = P.rouge_lsum(p, "id", "answer", "question")
    return s.select("id", "hits", r6("f1").alias("rougeLsum_f1"))


def _model_scores(spark, d):
    o = _outputs(spark, d)
    models = {"model_a": "pred_a", "model_b": "pred_b"}
    return P.rouge_n(o, "doc_id", models, "ref", 1).select("doc_id", "model", F.col("f1").alias("rouge1"))


MODEL_SQL = f"""{OUT_SQL}, {_rouge_sql('pred_a', 1, 'ra')}, {_rouge_sql('pred_b', 1, 'rb')},
ms AS (SELECT doc_id, 'model_a' AS model, f AS rouge1 FROM ra_f UNION ALL SELECT doc_id, 'model_b', f FROM rb_f)"""


@register("rouge_aggregate", O, sql=f"WITH {MODEL_SQL} SELECT model, round(avg(rouge1), 6) AS rouge1 FROM ms GROUP BY model")
def q_rouge_agg(spark, d):
    return _model_scores(spark, d).groupBy("model").agg(r6(F.avg("rouge1")).alias("rouge1"))


@register("metric_improvement", O, sql=f"""
WITH {MODEL_SQL}, m AS (SELECT model, avg(rouge1) AS v FROM ms GROUP BY model)
SELECT 'rouge1' AS metric, round(100 * ((SELECT v FROM m WHERE model = 'model_b') - (SELECT v FROM m WHERE model = 'model_a')), 6) AS improvement_pct
""")
def q_improvement(spark, d):
    m = _model_scores(spark, d).groupBy("model").agg(F.avg("rouge1").alias("rouge1"))
    long = m.unpivot(["model"], ["rouge1"], "metric", "v")
    a = long.filter(F.col("model") == "model_a").select("metric", F.col("v").alias("a"))
    b = long.filter(F.col("model") == "model_b").select("metric", F.col("v").alias("b"))
    return a.join(b, "metric").select("metric", r6(100 * (F.col("b") - F.col("a"))).alias("improvement_pct"))


@register("relative_improvement", O, sql="""
WITH s AS (SELECT quality, avg(toxic) AS m, stddev_pop(toxic) AS sd FROM labels GROUP BY quality),
b AS (SELECT * FROM s WHERE quality = 0), a AS (SELECT * FROM s WHERE quality = 1)
SELECT 'mean' AS stat, round(CASE WHEN b.m <> 0 THEN (b.m - a.m) / b.m END, 6) AS rel FROM a, b
UNION ALL SELECT 'std', round(CASE WHEN b.sd <> 0 THEN (b.sd - a.sd) / b.sd END, 6) FROM a, b
""")
def q_rel(spark, d):
    s = t(spark, d, "labels").groupBy("quality").agg(F.avg("toxic").alias("m"), F.stddev_pop("toxic").alias("sd"))
    b = s.filter(F.col("quality") == 0).select(F.col("m").alias("bm"), F.col("sd").alias("bs"))
    a = s.filter(F.col("quality") == 1).select(F.col("m").alias("am"), F.col("sd").alias("as_"))
    x = attach_scalar(a, b)
    rel = lambda bef, aft: F.when(F.col(bef) != 0, (F.col(bef) - F.col(aft)) / F.col(bef))
    return x.select(F.explode(F.array(F.struct(F.lit("mean").alias("stat"), r6(rel("bm", "am")).alias("rel")),
                                      F.struct(F.lit("std").alias("stat"), r6(rel("bs", "as_")).alias("rel")))).alias("r")).select("r.*")


@register("pairwise_accuracy", O, sql="SELECT round(avg(CASE WHEN quality >= toxic THEN 1.0 ELSE 0.0 END), 6) AS accuracy, count(*) AS n FROM labels")
def q_pair_acc(spark, d):
    lab = t(spark, d, "labels")
    return lab.agg(r6(F.avg((F.col("quality") >= F.col("toxic")).cast("double"))).alias("accuracy"), F.count(F.lit(1)).alias("n"))


@register("pairwise_log_loss", O, sql="""
SELECT round(avg(greatest(-(quality - toxic), 0) + ln(1 + exp(-abs(quality - toxic)))), 6) AS loss FROM labels
""")
def q_pair_loss(spark, d):
    lab = t(spark, d, "labels")
    return lab.agg(r6(F.avg(P.softplus_neg((F.col("quality") - F.col("toxic")).cast("double")))).alias("loss"))


@register("toxicity_evaluate", O, sql=f"""
WITH w AS (SELECT doc_id, {swords('lower(text)')} AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) > 0 THEN CAST(len(list_filter(w, lambda x: list_contains({U.LEXICON!r}, trim(x, '.,!?;:')))) AS DOUBLE) / len(w)
             ELSE 0.0 END AS toxicity FROM w),
x AS (SELECT 'all' AS part, toxicity FROM s
      UNION ALL (SELECT 'sample', toxicity FROM s ORDER BY md5('8|' || CAST(doc_id AS VARCHAR)), doc_id LIMIT 100))
SELECT part, count(*) AS n, round(avg(toxicity), 9) AS mean_toxicity, round(stddev_pop(toxicity), 9) AS std_toxicity FROM x GROUP BY part
""")
def q_toxicity(spark, d):
    docs = t(spark, d, "documents")
    both = [U.evaluate_toxicity(docs, "doc_id", "text", n=n).withColumn("part", F.lit(part)) for part, n in (("all", None), ("sample", 100))]
    return both[0].unionByName(both[1]).select("part", "n", F.round("mean", 9).alias("mean_toxicity"), F.round("std", 9).alias("std_toxicity"))


@register("before_after_table", O, sql=f"""
WITH {MODEL_SQL}
SELECT a.doc_id, round(a.rouge1, 6) AS before, round(b.rouge1, 6) AS after, round(b.rouge1 - a.rouge1, 6) AS diff
FROM (SELECT * FROM ms WHERE model = 'model_a') a JOIN (SELECT * FROM ms WHERE model = 'model_b') b USING (doc_id)
""")
def q_before_after(spark, d):
    s = _model_scores(spark, d)
    a = s.filter(F.col("model") == "model_a").select("doc_id", F.col("rouge1").alias("a"))
    b = s.filter(F.col("model") == "model_b").select("doc_id", F.col("rouge1").alias("b"))
    return a.join(b, "doc_id").select("doc_id", r6("a").alias("before"), r6("b").alias("after"), r6(F.col("b") - F.col("a")).alias("diff"))


@register("quality_gate", O, sql=f"""
WITH {MODEL_SQL}
SELECT 'rouge1' AS metric, round(avg(rouge1), 6) AS value, avg(rouge1) >= 0.4 AS passed FROM ms WHERE model = 'model_a'
""")
def q_gate(spark, d):
    s = _model_scores(spark, d).filter(F.col("model") == "model_a")
    return s.agg(F.avg("rouge1").alias("v")).select(F.lit("rouge1").alias("metric"), r6("v").alias("value"), (F.col("v") >= 0.4).alias("passed"))


@register("write_metrics_report", "B", sql=f"""
WITH {MODEL_SQL}
SELECT '{{"metrics":{{"rouge1":{{"value":' || CAST(round(avg(rouge1), 4) AS VARCHAR) || '}}}}}}' AS report FROM ms WHERE model = 'model_a'
""")
def q_report(spark, d):
    s = _model_scores(spark, d).filter(F.col("model") == "model_a").agg(F.round(F.avg("rouge1"), 4).alias("value"))
    return s.select(F.to_json(F.struct(F.struct(F.struct("value").alias("rouge1")).alias("metrics"))).alias("report"))


@register("group_collect_arrays", "J", sql=f"""
WITH {RANKED_SQL}, q AS (SELECT conv_id, arg_min(text, turn) AS prompt FROM conversations WHERE role = 'user' GROUP BY conv_id)
SELECT conv_id, prompt, string_agg(text, ' ||| ' ORDER BY ranking) AS responses, string_agg(CAST(ranking AS VARCHAR), ',' ORDER BY ranking) AS rankings
FROM ranked JOIN q USING (conv_id) GROUP BY conv_id, prompt
""")
def q_collect_arrays(spark, d):
    # responses and rankings collected as arrays of structs, in matching order (no comma join / split round trip)
    r = _ranked(spark, d)
    q = t(spark, d, "conversations").filter(F.col("role") == "user").groupBy("conv_id").agg(F.min_by("text", "turn").alias("prompt"))
    g = r.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("ranking", "text"))).alias("items"))
    j = g.join(q, "conv_id")
    return j.select("conv_id", "prompt", F.array_join(F.transform("items", lambda x: x["text"]), " ||| ").alias("responses"),
                    F.array_join(F.transform("items", lambda x: x["ranking"].cast("string")), ",").alias("rankings"))
