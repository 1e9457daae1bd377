"""Group R: message trees over ``conversations`` (id = conv-turn; threads without a system turn get a root)."""

from pyspark.sql import functions as F

from corpusflow.operators import trees as R
from corpusflow.queries.common import t
from corpusflow.queries.registry import register

G = "R"

TREE_SQL = """m AS (SELECT conv_id, turn, role, text, CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS id FROM conversations),
f AS (SELECT conv_id, arg_min(role, turn) AS fr FROM conversations GROUP BY conv_id),
a AS (SELECT * FROM m UNION ALL SELECT conv_id, -1, 'system', '', CAST(conv_id AS VARCHAR) || '-root' FROM f WHERE fr <> 'system'),
tree AS (SELECT conv_id, turn, role, text, id,
  coalesce(list(id) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), []) AS ancestors,
  CASE WHEN lead(id) OVER (PARTITION BY conv_id ORDER BY turn) IS NULL THEN [] ELSE [lead(id) OVER (PARTITION BY conv_id ORDER BY turn)] END AS children FROM a)"""


def _tree(spark, d):
    return R.from_linear(t(spark, d, "conversations"))


def _s(c):
    return F.array_join(c, ",")


@register("tree_from_linear", G, sql=f"""
WITH {TREE_SQL} SELECT conv_id, id, array_to_string(ancestors, ',') AS ancestors, array_to_string(children, ',') AS children FROM tree
""")
def q_from_linear(spark, d):
    tr = _tree(spark, d)
    return tr.select("conv_id", "id", _s("ancestors").alias("ancestors"), _s("children").alias("children"))


#: threads with these numbers count as legacy ones, without links
LEGACY = 5


@register("tree_append", G, sql=f"""
WITH {TREE_SQL},
lin AS (SELECT * FROM tree WHERE conv_id % {LEGACY} <> 0),
c AS (SELECT conv_id, CAST(conv_id AS VARCHAR) AS c FROM conversations WHERE turn = 1 AND conv_id % {LEGACY} <> 0),
b AS (SELECT c.conv_id, c, list_concat(t.ancestors, [t.id]) AS anc FROM c JOIN lin t ON t.conv_id = c.conv_id AND t.id = c || '-0'),
rows AS (
  SELECT t.conv_id, t.id, t.ancestors, CASE WHEN b.c IS NOT NULL THEN list_concat(t.children, [c || '-1b']) ELSE t.children END AS children, NULL AS error
  FROM lin t LEFT JOIN b ON b.conv_id = t.conv_id AND t.id = c || '-0'
  UNION ALL SELECT conv_id, c || '-1b', anc, [c || '-1c'], NULL FROM b
  UNION ALL SELECT conv_id, c || '-1c', list_concat(anc, [c || '-1b']), [c || '-1d'], NULL FROM b
  UNION ALL SELECT conv_id, c || '-1d', list_concat(anc, [c || '-1b', c || '-1c']), [], NULL FROM b
  UNION ALL SELECT conv_id, c || '-x', NULL, [], 'parent not found' FROM c
  UNION ALL SELECT conv_id, c || '-x2', NULL, [], 'parent not found' FROM c
  UNION ALL SELECT conv_id, c || '-1', NULL, [], 'message already exists' FROM c
  UNION ALL SELECT conv_id, c || '-z', NULL, [], 'parent id required' FROM c
  UNION ALL SELECT conv_id, CAST(conv_id AS VARCHAR) || k, NULL, [], CASE WHEN k = '-no' THEN 'This is a legacy conversation, you can only append to the last message' END
  FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id % {LEGACY} = 0), (SELECT unnest(['-new', '-no']) AS k))
SELECT conv_id, id, array_to_string(ancestors, ',') AS ancestors, array_to_string(children, ',') AS children, error FROM rows
""")
def q_append(spark, d):
    conv = t(spark, d, "conversations")
    c = F.col("conv_id").cast("string")
    one = conv.filter((F.col("turn") == 1) & (F.col("conv_id") % LEGACY != 0)).select("conv_id", "role", "text", c.alias("c"))

    def message(id_, parent):
        return F.struct(F.concat("c", F.lit(id_)).alias("id"), (F.lit(None).cast("string") if parent is None else F.concat("c", F.lit(parent))).alias("parent_id"))

    # a branch of three messages that hang on each other, a missing parent and a message under it, a known id, no parent
    batch = [("-1b", "-0"), ("-1c", "-1b"), ("-1d", "-1c"), ("-x", "-missing"), ("-x2", "-x"), ("-1", "-0"), ("-z", None)]
    new = one.select("conv_id", "role", "text", F.explode(F.array(*[message(*m) for m in batch])).alias("m")).select("conv_id", "m.id", "role", "text", "m.parent_id")
    out = R.append(_tree(spark, d).filter(F.col("conv_id") % LEGACY != 0), new).select("conv_id", "id", "ancestors", "children", "error")
    # legacy threads: after the last message, or nowhere
    thread = conv.filter(F.col("conv_id") % LEGACY == 0).select("conv_id", "turn", F.concat_ws("-", c, F.col("turn").cast("string")).alias("id"))
    ends = thread.groupBy("conv_id").agg(F.max_by("id", "turn").alias("last"))
    late = ends.select("conv_id", F.lit("user").alias("role"), F.lit("").alias("text"), F.explode(F.array(
        F.struct(F.concat(c, F.lit("-new")).alias("id"), F.col("last").alias("parent_id")), F.struct(F.concat(c, F.lit("-no")).alias("id"), F.lit("elsewhere").alias("parent_id")))).alias("m"))
    old = R.legacy_append(thread, late.select("conv_id", "m.id", "role", "text", "m.parent_id"))
    none = F.array().cast("array<string>")
    out = out.unionByName(old.select("conv_id", "id", F.lit(None).cast("array<string>").alias("ancestors"), none.alias("children"), "error"))
    return out.select("conv_id", "id", _s("ancestors").alias("ancestors"), _s("children").alias("children"), "error")


@register("tree_sibling", G, sql=f"""
WITH {TREE_SQL},
new AS (SELECT conv_id, CAST(conv_id AS VARCHAR) || '-2s' AS id, CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS sibling_id FROM conversations WHERE turn IN (0, 2))
SELECT n.conv_id, n.id || '-' || n.sibling_id AS id,
  CASE WHEN t.id IS NOT NULL AND len(t.ancestors) > 0 THEN array_to_string(t.ancestors, ',') END AS ancestors,
  CASE WHEN t.id IS NULL THEN 'The sibling message doesn''t exist' WHEN len(t.ancestors) = 0 THEN 'The sibling message is the root message, therefore we can''t add a sibling' END AS error
FROM new n LEFT JOIN tree t ON t.conv_id = n.conv_id AND t.id = n.sibling_id
""")
def q_sibling(spark, d):
    c = t(spark, d, "conversations").filter(F.col("turn").isin(0, 2))
    sid = F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    new = c.select("conv_id", F.concat_ws("-", F.concat(F.col("conv_id").cast("string"), F.lit("-2s")), sid).alias("id"), sid.alias("sibling_id"))
    s = R.add_sibling(_tree(spark, d), new)
    return s.select("conv_id", "id", _s("ancestors").alias("ancestors"), "error")


@register("tree_path", G, sql=f"""
WITH {TREE_SQL}, last AS (SELECT conv_id, arg_max(id, turn) AS id FROM tree GROUP BY conv_id)
SELECT l.conv_id, l.id AS target, array_to_string(list_concat(t.ancestors, [t.id]), ',') AS path FROM last l JOIN tree t USING (conv_id, id)
""")
def q_path(spark, d):
    tr = _tree(spark, d)
    last = tr.groupBy("conv_id").agg(F.max_by("id", "turn").alias("id"))
    return R.path(tr, last).select("conv_id", "target", _s("path").alias("path"))


@register("tree_retry_prompt", G, sql=f"""
WITH {TREE_SQL}, last AS (SELECT conv_id, role, arg_max(id, turn) AS id FROM tree GROUP BY conv_id, role),
j AS (SELECT l.*, t.ancestors AS a FROM last l JOIN tree t USING (conv_id, id))
SELECT conv_id, id AS target, CASE WHEN len(a) = 0 OR role = 'system' THEN NULL WHEN role = 'user' THEN id || '-edit-answer' ELSE id || '-retry' END AS write_to,
       CASE WHEN len(a) = 0 OR role = 'system' THEN NULL ELSE array_to_string(CASE WHEN role = 'user' THEN list_concat(a, [id || '-edit']) ELSE a END, ',') END AS path,
       CASE WHEN role = 'system' THEN 'nothing to retry' WHEN len(a) = 0 THEN 'The sibling message is the root message, therefore we can''t add a sibling' END AS error FROM j
UNION ALL SELECT DISTINCT conv_id, 'gone', NULL, NULL, 'Message not found' FROM tree
""")
def q_retry(spark, d):
    tr = _tree(spark, d)
    # each thread's last message of each role: answers are tried again, user messages edited
    last = tr.groupBy("conv_id", "role").agg(F.max_by("id", "turn").alias("id")).select("conv_id", "id", F.lit("another prompt").alias("new_prompt"))
    gone = tr.select("conv_id", F.lit("gone").alias("id"), F.lit(None).cast("string").alias("new_prompt")).distinct()
    return R.retry(tr, last.unionByName(gone)).select("conv_id", "target", "write_to", _s("path").alias("path"), "error")


@register("conversation_hash", G, sql="""
SELECT conv_id, sha256('[' || string_agg('{"from":' || CAST(to_json(role) AS VARCHAR) || ',"id":"' || CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR)
  || '","content":' || CAST(to_json(text) AS VARCHAR) || CASE WHEN turn % 3 = 1 THEN ',"webSearchId":"w' || CAST(turn AS VARCHAR) || '"' ELSE '' END || '}', ',' ORDER BY turn) || ']') AS hash
FROM conversations GROUP BY conv_id
""")
def q_hash(spark, d):
    # every third turn came with a web search
    search = F.when(F.col("turn") % 3 == 1, F.concat(F.lit("w"), F.col("turn").cast("string")))
    return R.conversation_hash(t(spark, d, "conversations").withColumn("web_search_id", search))
