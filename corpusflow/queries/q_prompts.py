"""Group D: prompt and template construction."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusflow.operators import prompts as P
from corpusflow.operators.joins import attach_scalar
from corpusflow.queries.common import t
from corpusflow.queries.registry import register
from corpusflow.queries.sqlparts import PAIRS, QA, THREADS, lit, strip
from corpusflow.sources.derived import preference_pairs, qa_pairs

G = "D"


def _sys_context(conv):
    return conv.filter(F.col("role") == "system").groupBy("conv_id").agg(F.min_by("text", "turn").alias("context"))


SYS_SQL = "sys AS (SELECT conv_id, arg_min(text, turn) AS context FROM conversations WHERE role = 'system' GROUP BY conv_id)"


@register("wrap_instruction", G, sql=f"SELECT doc_id, {lit(P.SUMMARIZE_PREFIX)} || text || {lit(P.SUMMARIZE_SUFFIX)} AS instruction FROM documents")
def q_wrap(spark, d):
    return t(spark, d, "documents").select("doc_id", P.wrap("text").alias("instruction"))


@register("dolly_prompt", G, sql=f"""
WITH {QA}, {SYS_SQL}
SELECT conv_id, turn, concat_ws({lit(chr(10) * 2)}, {lit('### Instruction' + chr(10))} || question,
  CASE WHEN coalesce(length(context), 0) > 0 THEN {lit('### Context' + chr(10))} || context END,
  {lit('### Answer' + chr(10))} || answer) || '</s>' AS text
FROM qa LEFT JOIN sys USING (conv_id)
""")
def q_dolly(spark, d):
    conv = t(spark, d, "conversations")
    j = qa_pairs(conv).join(_sys_context(conv), "conv_id", "left")
    return j.select("conv_id", "turn", P.dolly_prompt(F.col("question"), F.col("context"), F.col("answer")).alias("text"))


@register("inst_context_prompt", G, sql=f"""
WITH {QA}, {SYS_SQL}
SELECT conv_id, turn, {lit(P.INST_HEADER + '### Question:' + chr(10))} || question || {lit(chr(10) * 2 + '### Context:' + chr(10))}
  || CASE WHEN coalesce(length(context), 0) > 0 THEN 'Here is some context: ' || context ELSE '' END
  || {lit(chr(10) * 2 + '### Response:' + chr(10))} || answer || {lit(chr(10) * 2 + '</s>' + chr(10))} AS text
FROM qa LEFT JOIN sys USING (conv_id)
""")
def q_inst(spark, d):
    conv = t(spark, d, "conversations")
    j = qa_pairs(conv).join(_sys_context(conv), "conv_id", "left")
    return j.select("conv_id", "turn", P.inst_context_prompt(F.col("question"), F.col("context"), F.col("answer")).alias("text"))


@register("qa_prompt", G, sql=f"""
WITH {QA}
SELECT conv_id, turn, 'Question: ' || question || {lit(chr(10) * 2 + 'Answer: ')} AS query,
       'Question: ' || question || {lit(chr(10) * 2 + 'Answer: ')} || answer AS text FROM qa
""")
def q_qa(spark, d):
    qa = qa_pairs(t(spark, d, "conversations"))
    return qa.select("conv_id", "turn", P.qa_prompt(F.col("question")).alias("query"),
                     P.qa_prompt(F.col("question"), F.col("answer")).alias("text"))


@register("label_prompt", G, sql="""
SELECT doc_id, 'text : ' || text || ' Label : ' AS input, CAST(quality AS VARCHAR) AS target FROM documents JOIN labels USING (doc_id)
""")
def q_label_prompt(spark, d):
    j = t(spark, d, "documents").join(t(spark, d, "labels"), "doc_id")
    return j.select("doc_id", P.label_prompt(F.col("text"), "text").alias("input"), F.col("quality").cast("string").alias("target"))


TEMPLATE = "Read the passage from {source} and answer.\n\n{context}\n\nQuestion: what language is this ({lang})?"


@register("fill_template", G, sql=f"""
SELECT doc_id, replace(replace(replace({lit(TEMPLATE)}, '{{source}}', source), '{{context}}', text), '{{lang}}', lang) AS prompt FROM documents
""")
def q_fill(spark, d):
    docs = t(spark, d, "documents")
    return docs.select("doc_id", P.fill_template(TEMPLATE, {"source": F.col("source"), "context": F.col("text"), "lang": F.col("lang")}).alias("prompt"))


SHOTS = 3


@register("few_shot_prompt", G, sql=f"""
WITH {QA},
shots AS (SELECT string_agg('Question: ' || question || {lit(chr(10))} || 'Answer: ' || answer || {lit(chr(10) + '###' + chr(10))}, '' ORDER BY conv_id, turn) AS s
          FROM (SELECT * FROM qa ORDER BY conv_id, turn LIMIT {SHOTS}))
SELECT conv_id, turn, s || 'Question: ' || question || {lit(chr(10))} || 'Answer:' AS prompt FROM qa, shots
""")
def q_few_shot(spark, d):
    qa = qa_pairs(t(spark, d, "conversations"))
    # the k shots: a top-k (bounded), folded to one string in order, broadcast to every question
    shots = (qa.orderBy("conv_id", "turn").limit(SHOTS)
             .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("conv_id", "turn", "question", "answer"))),
                                           lambda x: F.concat(F.lit("Question: "), x["question"], F.lit("\nAnswer: "), x["answer"], F.lit("\n###\n"))), "").alias("s")))
    return attach_scalar(qa, shots).select("conv_id", "turn", F.concat("s", F.lit("Question: "), "question", F.lit("\nAnswer:")).alias("prompt"))


_FOLD = f"""f AS (SELECT conv_id, CASE WHEN len(m) >= 2 AND m[1].role = 'system'
  THEN list_concat([{{'turn': m[2].turn, 'role': m[2].role, 'text': {lit(P.BEGIN_SYS)} || m[1].text || {lit(P.END_SYS)} || m[2].text}}], m[3:])
  ELSE m END AS m FROM th),
e AS (SELECT conv_id, m, CASE WHEN len(m) = 0 THEN 'empty conversation'
  WHEN list_bool_or(list_transform(range(len(m)), lambda i: CASE WHEN i % 2 = 0 THEN m[i + 1].role <> 'user' ELSE m[i + 1].role <> 'assistant' END))
  THEN 'roles must alternate user/assistant after an optional system turn'
  WHEN m[-1].role <> 'user' THEN 'last message must be from user, got ' || m[-1].role END AS error FROM f)"""


@register("chat_prompt_llama", G, sql=f"""
WITH {THREADS}, {_FOLD}
SELECT conv_id, CASE WHEN error IS NULL THEN
  array_to_string(list_transform(range(0, (len(m) - 1) // 2), lambda k: '<s>[INST] ' || {strip('m[2 * k + 1].text')} || ' [/INST] ' || {strip('m[2 * k + 2].text')} || '</s>'), '')
  || '<s>[INST] ' || {strip('m[-1].text')} || ' [/INST] ' END AS prompt FROM e
""")
def q_llama(spark, d):
    th = P.threads(t(spark, d, "conversations"))
    return th.select("conv_id", P.render_llama_chat(F.col("msgs")).alias("prompt"))


@register("validate_turn_order", G, sql=f"""
WITH {THREADS}, {_FOLD}
SELECT conv_id, error FROM e WHERE error IS NOT NULL
""")
def q_turn_order(spark, d):
    th = P.threads(t(spark, d, "conversations"))
    return th.select("conv_id", P.turn_order_error(F.col("msgs")).alias("error")).filter(F.col("error").isNotNull())


@register("chat_history_prompt", G, sql=f"""
WITH {THREADS},
u AS (SELECT conv_id, list_transform(list_filter(m, lambda x: x.role = 'user'), lambda x: x.text) AS q,
             list_transform(list_filter(m, lambda x: x.role = 'assistant'), lambda x: x.text) AS r FROM th)
SELECT conv_id, CASE WHEN len(q) > 0 THEN '<s>[INST] ' || q[1] || ' [/INST]' ||
  array_to_string(list_transform(range(0, least(len(r), len(q) - 1)), lambda i: {lit(chr(10))} || r[i + 1] || {lit(chr(10) + ' </s><s>[INST] ' + chr(10))} || q[i + 2] || {lit(chr(10) + ' [/INST]')}), '') END AS prompt
FROM u
""")
def q_history(spark, d):
    th = P.threads(t(spark, d, "conversations"))
    return th.select("conv_id", P.chat_history(F.col("msgs")).alias("prompt"))


CHAT_TEMPLATE = {"user": ("<|user|>\n", "</s>\n"), "assistant": ("<|assistant|>\n", "</s>\n")}


@register("apply_chat_template", G, sql=f"""
WITH {PAIRS}
SELECT conv_id,
  {lit('<|user|>' + chr(10))} || question || {lit('</s>' + chr(10) + '<|assistant|>' + chr(10))} || response_j || {lit('</s>' + chr(10))} AS chosen,
  {lit('<|user|>' + chr(10))} || question || {lit('</s>' + chr(10) + '<|assistant|>' + chr(10))} || response_k || {lit('</s>' + chr(10))} AS rejected
FROM pairs
""")
def q_chat_template(spark, d):
    p = preference_pairs(t(spark, d, "conversations"))
    msg = lambda role, c: F.struct(F.lit(role).alias("role"), F.col(c).alias("content"))
    return p.select("conv_id",
                    P.render_messages(F.array(msg("user", "question"), msg("assistant", "response_j")), CHAT_TEMPLATE).alias("chosen"),
                    P.render_messages(F.array(msg("user", "question"), msg("assistant", "response_k")), CHAT_TEMPLATE).alias("rejected"))


def _guard_sql():
    role = "User"
    task = (f"Task: Check if there is unsafe content in '{role}' messages in conversations "
            "according our safety policy with the below categories.")
    policy = "<BEGIN UNSAFE CONTENT CATEGORIES>\n" + "\n".join(P.GUARD_CATEGORIES) + "\n<END UNSAFE CONTENT CATEGORIES>"
    fmt = (f"Provide your safety assessment for '{role}' in the above conversation:\n"
           "- First line must read 'safe' or 'unsafe'.\n"
           "- If unsafe, a second line must include a comma-separated list of violated categories.")
    return (f"SELECT conv_id, {lit(chr(10) + task + chr(10) * 2 + policy + chr(10) * 3 + '<BEGIN CONVERSATION>' + chr(10) + role + ': ')} || q "
            f"|| {lit(chr(10) + '<END CONVERSATION>' + chr(10) * 3 + fmt + chr(10) * 2)} AS prompt "
            "FROM (SELECT conv_id, arg_min(text, turn) AS q FROM conversations WHERE role = 'user' GROUP BY conv_id)")


@register("guard_prompt", G, sql=_guard_sql())
def q_guard(spark, d):
    q = t(spark, d, "conversations").filter(F.col("role") == "user").groupBy("conv_id").agg(F.min_by("text", "turn").alias("q"))
    return q.select("conv_id", P.guard_prompt(F.col("q")).alias("prompt"))


RUN_DATE = "January 30, 2024"


@register("web_context_prompt", G, sql=f"""
WITH {THREADS},
u AS (SELECT conv_id, list_transform(list_filter(m, lambda x: x.role = 'user'), lambda x: x.text) AS q,
             coalesce(list_transform(list_filter(m, lambda x: x.role = 'assistant'), lambda x: x.text)[-1], '') AS ctx FROM th)
SELECT conv_id, 'I searched the web using the query: ' || coalesce(q[-1], '') || {lit('. ' + chr(10) + 'Today is ' + RUN_DATE + ' and here are the results:' + chr(10) + '=====================' + chr(10))}
  || ctx || {lit(chr(10) + '=====================' + chr(10))}
  || CASE WHEN len(q) - 1 > 0 THEN {lit('Previous questions: ' + chr(10) + '- ')} || array_to_string(q[1:len(q) - 1], {lit(chr(10) + '- ')}) ELSE '' END
  || {lit(chr(10) + 'Answer the question: ')} || coalesce(q[-1], '') AS content
FROM u
""")
def q_web_prompt(spark, d):
    th = P.threads(t(spark, d, "conversations"))
    users = F.transform(F.filter("msgs", lambda m: m["role"] == "user"), lambda m: m["text"])
    ctx = F.coalesce(F.try_element_at(F.transform(F.filter("msgs", lambda m: m["role"] == "assistant"), lambda m: m["text"]), F.lit(-1)), F.lit(""))
    return th.select("conv_id", P.web_prompt(F.col("msgs"), F.coalesce(F.try_element_at(users, F.lit(-1)), F.lit("")), ctx, RUN_DATE).alias("content"))


ALLOW, BLOCK = ["example.com"], ["ads-track.example.org"]


@register("query_rewrite_prompt", G, sql=f"""
WITH {THREADS},
u AS (SELECT conv_id, list_transform(list_filter(m, lambda x: x.role = 'user'), lambda x: x.text) AS q FROM th)
SELECT conv_id, CASE WHEN len(q) - 1 > 0 THEN {lit('Previous questions: ' + chr(10))} || array_to_string(list_transform(q[1:len(q) - 1], lambda x: '- ' || x), {lit(chr(10))}) ELSE '' END
  || {lit(chr(10) * 2 + 'Current Question: ')} || q[-1] AS prompt,
  trim('{P.query_modifier(ALLOW, BLOCK)}' || ' ' || q[-1], ' ') AS search
FROM u WHERE len(q) > 0
""")
def q_rewrite(spark, d):
    th = P.threads(t(spark, d, "conversations"))
    users = F.transform(F.filter("msgs", lambda m: m["role"] == "user"), lambda m: m["text"])
    th = th.filter(F.size(users) > 0)
    # the generated query is a model plug-in; the deterministic default echoes the last question
    return th.select("conv_id", P.search_query_prompt(F.col("msgs")).alias("prompt"),
                     F.trim(F.concat(F.lit(P.query_modifier(ALLOW, BLOCK) + " "), F.try_element_at(users, F.lit(-1)))).alias("search"))


@register("truncate_last_words", G, sql="""
SELECT doc_id, array_to_string(list_slice(string_split(text, ' '), greatest(len(string_split(text, ' ')) - 50, 0) + 1, len(string_split(text, ' '))), ' ') AS prompt
FROM documents
""")
def q_last_words(spark, d):
    return t(spark, d, "documents").select("doc_id", P.keep_last_words("text", 50).alias("prompt"))


STOPS = [".", "</s>"]


@register("strip_stop_suffix", G, sql=f"""
WITH a AS (SELECT doc_id, regexp_replace(text, '[\\t\\n\\x0B\\f\\r ]+$', '') AS s FROM documents),
b AS (SELECT doc_id, CASE WHEN suffix(s, '.') THEN s[1:length(s) - 1] ELSE s END AS s FROM a)
SELECT doc_id, CASE WHEN suffix(s, '</s>') THEN s[1:length(s) - 4] ELSE s END AS text FROM b
""")
def q_strip_stops(spark, d):
    return t(spark, d, "documents").select("doc_id", P.strip_stops("text", STOPS).alias("text"))


CAPTIONS = ["a photo of a {}", "a rendering of a {}", "a cropped photo of the {}", "the photo of a {}", "a close-up photo of a {}"]
REPEATS = 3


@register("caption_templates", G, sql=f"""
SELECT p_partkey, r AS rep,
  replace(list_extract([{', '.join(repr(c) for c in CAPTIONS)}], CAST(('0x' || substr(md5('13|' || CAST(p_partkey AS VARCHAR) || '-' || CAST(r AS VARCHAR)), 1, 8)) AS BIGINT) % {len(CAPTIONS)} + 1), '{{}}', p_name) AS caption
FROM part, range({REPEATS}) t(r)
""")
def q_captions(spark, d):
    # each item is repeated a fixed number of times (a bounded fan-out, not a join)
    part = t(spark, d, "part").select("p_partkey", "p_name")
    x = part.select("*", F.explode(F.sequence(F.lit(0), F.lit(REPEATS - 1))).alias("rep")).withColumn("rep", F.col("rep").cast("bigint"))
    key = F.concat_ws("-", F.col("p_partkey").cast("string"), F.col("rep").cast("string"))
    return x.select("p_partkey", "rep", F.replace(P.pick_template(CAPTIONS, key), F.lit("{}"), F.col("p_name")).alias("caption"))


ACTIVITIES = ["riding a bike", "playing chess", "washing the dishes", "reading a book", "flying a kite", "baking bread"]
NUMBER_WORDS = ["one", "two", "three", "four", "five", "six", "seven", "eight", "nine", "ten"]


@register("prompt_grammar", G, sql=f"""
WITH n AS (SELECT DISTINCT p_name AS noun FROM part)
SELECT noun, list_extract([{', '.join(repr(a) for a in ACTIVITIES)}], CAST(('0x' || substr(md5('21|' || noun), 1, 8)) AS BIGINT) % {len(ACTIVITIES)} + 1) AS activity,
  CASE WHEN lower(noun[1]) IN ('a', 'e', 'i', 'o', 'u') THEN 'an' ELSE 'a' END || ' ' || noun || ' ' ||
  list_extract([{', '.join(repr(a) for a in ACTIVITIES)}], CAST(('0x' || substr(md5('21|' || noun), 1, 8)) AS BIGINT) % {len(ACTIVITIES)} + 1) AS prompt,
  list_extract([{', '.join(repr(w) for w in NUMBER_WORDS)}], CAST(('0x' || substr(md5('22|' || noun), 1, 8)) AS BIGINT) % 10 + 1) || ' ' || noun AS counting_prompt,
  'How many ' || noun || ' are there in this image?|What animal is in this image?' AS questions,
  list_extract([{', '.join(repr(w) for w in NUMBER_WORDS)}], CAST(('0x' || substr(md5('22|' || noun), 1, 8)) AS BIGINT) % 10 + 1) || '|' || noun AS answers
FROM n
""")
def q_grammar(spark, d):
    from corpusflow.functions.text import seeded_int

    nouns = t(spark, d, "part").select(F.col("p_name").alias("noun")).distinct()
    # one activity per noun by a seeded hash (the grammar's random choice), not a noun x activity product
    acts = F.array(*[F.lit(a) for a in ACTIVITIES])
    nums = F.array(*[F.lit(w) for w in NUMBER_WORDS])
    act = F.element_at(acts, (F.pmod(seeded_int(21, F.col("noun")), F.lit(len(ACTIVITIES))) + 1).cast("int"))
    num = F.element_at(nums, (F.pmod(seeded_int(22, F.col("noun")), F.lit(10)) + 1).cast("int"))
    return nouns.select("noun", act.alias("activity"), F.concat_ws(" ", P.article(F.col("noun")), "noun", act).alias("prompt"),
                        F.concat_ws(" ", num, "noun").alias("counting_prompt"),
                        F.concat(F.lit("How many "), "noun", F.lit(" are there in this image?|What animal is in this image?")).alias("questions"),
                        F.concat_ws("|", num, "noun").alias("answers"))
