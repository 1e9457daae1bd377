"""Message trees (group R): a conversation's messages with ``ancestors`` (full root path) and ``children``.

Tree rows: (conv_id, id, role, text, ancestors array<string>, children array<string>).
Updates are joins keyed by (conv_id, id); errors come out as rows with an ``error`` text
instead of exceptions.  Threads are small groups; the corpus is spread by conv_id.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# fixed values: the chat store's error texts
NO_SIBLING = "The sibling message doesn't exist"
ROOT_SIBLING = "The sibling message is the root message, therefore we can't add a sibling"


def _empty():
    return F.array().cast("array<string>")


def from_linear(conv: DataFrame, preprompt: str = "") -> DataFrame:
    """Linear threads to trees.  A thread whose first turn is a system turn already has its root;
    others get a system root holding the preprompt.  Ancestors = root + earlier turns, children = next turn.
    """
    msgs = conv.select("conv_id", "turn", "role", "text",
                       F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("id"))
    first = msgs.groupBy("conv_id").agg(F.min_by("role", "turn").alias("first_role"))
    need_root = first.filter(F.col("first_role") != "system").select("conv_id")
    roots = need_root.select("conv_id", F.lit(-1).cast("bigint").alias("turn"), F.lit("system").alias("role"), F.lit(preprompt).alias("text"),
                             F.concat(F.col("conv_id").cast("string"), F.lit("-root")).alias("id"))
    allm = msgs.unionByName(roots)
    w = Window.partitionBy("conv_id").orderBy("turn")
    return (allm.withColumn("ancestors", F.collect_list("id").over(w.rowsBetween(Window.unboundedPreceding, -1)))
            .withColumn("_next", F.lead("id").over(w))
            .withColumn("children", F.when(F.col("_next").isNull(), _empty()).otherwise(F.array("_next")))
            .drop("_next"))


def _chained(start: DataFrame) -> DataFrame:
    """Ancestors of new messages whose parents are new, too, by pointer jumping.

    ``start``: (conv_id, id, ptr, chain, error).  A message without ``ptr`` is settled: ``chain`` holds its ancestors, or
    ``error`` says why it has none.  Otherwise ``chain`` holds the ancestors from ``ptr`` on.  Each round a message takes over
    its pointer's chain and pointer, so a chain of n messages settles in about log2(n) rounds.  A chain longer than its
    conversation's new messages runs in a circle; those messages, and any under a refused one, have no parent.
    """
    cur = start.join(start.groupBy("conv_id").agg(F.count(F.lit(1)).alias("_n")), "conv_id").checkpoint()
    while not cur.filter(F.col("ptr").isNotNull()).isEmpty():
        up = cur.select("conv_id", F.col("id").alias("ptr"), F.col("ptr").alias("_up"), F.col("chain").alias("_uc"), F.col("error").alias("_ue"))
        j = cur.filter(F.col("ptr").isNotNull()).join(up, ["conv_id", "ptr"], "left")
        lost = F.col("_ue").isNotNull() | (F.size("chain") > F.col("_n"))
        moved = j.select("conv_id", "id", F.when(~lost, F.col("_up")).alias("ptr"), F.when(~lost, F.concat("_uc", "chain")).alias("chain"),
                         F.when(lost, F.lit("parent not found")).alias("error"), "_n")
        cur = cur.filter(F.col("ptr").isNull()).unionByName(moved).checkpoint()
    return cur.select("conv_id", "id", F.col("chain").alias("ancestors"), "error")


def append(tree: DataFrame, new: DataFrame) -> DataFrame:
    """Add messages under a parent: ancestors = parent's ancestors + parent; the parent's children get the id.

    ``new``: (conv_id, id, role, text, parent_id).  A parent may be in the tree or among the new messages.  A message with
    no parent becomes the root of an empty conversation.  Errors come back as rows: missing parent (or one that was
    itself refused), parent required (conversation not empty, or another new root comes first by id), id already present
    (of equal new ids the first by parent is taken).
    """
    par = tree.select("conv_id", F.col("id").alias("parent_id"), F.col("ancestors").alias("_pa"))
    have = tree.groupBy("conv_id").agg(F.count(F.lit(1)).alias("_n"))
    ids = tree.select("conv_id", "id", F.lit(True).alias("_dup"))
    again = F.row_number().over(Window.partitionBy("conv_id", "id").orderBy("parent_id")) > 1
    root = F.row_number().over(Window.partitionBy("conv_id", F.col("parent_id").isNull()).orderBy("_again", "id"))
    j = (new.withColumn("_again", again).withColumn("_root", root)
         .join(par, ["conv_id", "parent_id"], "left").join(have, "conv_id", "left").join(ids, ["conv_id", "id"], "left"))
    err = (F.when(F.col("_dup") | F.col("_again"), F.lit("message already exists"))
           .when(F.col("parent_id").isNull() & ((F.coalesce("_n", F.lit(0)) > 0) | (F.col("_root") > 1)), F.lit("parent id required")))
    j = j.withColumn("error", err).drop("_n", "_dup", "_again", "_root").checkpoint()
    taken = j.filter(F.col("error").isNull())
    batch = taken.select("conv_id", F.col("id").alias("parent_id"), F.lit(True).alias("_here"))
    k = taken.join(batch, ["conv_id", "parent_id"], "left")
    in_tree = F.col("parent_id").isNull() | F.col("_pa").isNotNull()
    start = k.select("conv_id", "id", F.when(~in_tree & F.col("_here"), F.col("parent_id")).alias("ptr"),
                     F.when(F.col("parent_id").isNull(), _empty()).when(F.col("_pa").isNotNull(), F.concat("_pa", F.array("parent_id")))
                     .when(F.col("_here"), F.array("parent_id")).alias("chain"),
                     F.when(~in_tree & F.col("_here").isNull(), F.lit("parent not found")).alias("error"))
    found = _chained(start)
    ok = found.filter(F.col("error").isNull() & (F.size("ancestors") > 0)).select("conv_id", "id", F.element_at("ancestors", -1).alias("_p"))
    kids = ok.groupBy("conv_id", F.col("_p").alias("id")).agg(F.array_sort(F.collect_list("id")).alias("_new"))
    refused = j.filter(F.col("error").isNotNull()).select("conv_id", "id", "role", "text", F.lit(None).cast("array<string>").alias("ancestors"), "error")
    added = taken.select("conv_id", "id", "role", "text").join(found, ["conv_id", "id"])
    old = tree.select("conv_id", "id", "role", "text", "ancestors", "children", F.lit(None).cast("string").alias("error"))
    rows = old.unionByName(added.withColumn("children", _empty())).join(kids, ["conv_id", "id"], "left")
    rows = rows.withColumn("children", F.concat("children", F.coalesce("_new", _empty()))).drop("_new")
    return rows.select("conv_id", "id", "role", "text", "ancestors", "children", "error").unionByName(
        refused.withColumn("children", _empty()))


def retry(tree: DataFrame, targets: DataFrame) -> DataFrame:
    """Where a retried answer goes and what its prompt is: (conv_id, target, write_to, path, error).

    ``targets``: (conv_id, id, new_prompt).  A user message with a new prompt is edited: a sibling ``<id>-edit`` holds
    the prompt, the answer goes under it, the path ends with it.  An assistant message is answered again beside
    the old answer: the path ends before it.  Roots have no siblings, and a user message needs a new prompt.
    """
    t = targets.join(tree.select("conv_id", "id", "role", "ancestors"), ["conv_id", "id"], "left")
    edit = F.col("role") == "user"
    err = (F.when(F.col("ancestors").isNull(), F.lit("Message not found"))
           .when(~F.col("role").isin("user", "assistant") | (edit & (F.coalesce(F.length("new_prompt"), F.lit(0)) == 0)), F.lit("nothing to retry"))
           .when(F.size("ancestors") == 0, F.lit(ROOT_SIBLING)))
    edited = F.concat("id", F.lit("-edit"))
    goes = F.when(edit, F.concat(edited, F.lit("-answer"))).otherwise(F.concat("id", F.lit("-retry")))
    path_ = F.when(edit, F.concat("ancestors", F.array(edited))).otherwise(F.col("ancestors"))
    return t.select("conv_id", F.col("id").alias("target"), F.when(err.isNull(), goes).alias("write_to"), F.when(err.isNull(), path_).alias("path"),
                    err.alias("error"))


def add_sibling(tree: DataFrame, new: DataFrame) -> DataFrame:
    """New alternative next to ``sibling_id``: same ancestors; errors for a missing or root sibling."""
    sib = tree.select("conv_id", F.col("id").alias("sibling_id"), F.col("ancestors").alias("_sa"))
    j = new.join(sib, ["conv_id", "sibling_id"], "left")
    err = (F.when(F.col("_sa").isNull(), F.lit(NO_SIBLING))
           .when(F.size("_sa") == 0, F.lit(ROOT_SIBLING)))
    return j.select("conv_id", "id", F.when(err.isNull(), F.col("_sa")).alias("ancestors"), err.alias("error"))


def add_sibling_tree(tree: DataFrame, new: DataFrame) -> DataFrame:
    """Add alternatives next to ``sibling_id`` and link them under the sibling's parent (its last ancestor).

    ``new``: (conv_id, id, role, text, sibling_id).  Same ancestors as the sibling, since
    ancestors(sibling) = ancestors(parent) + [parent]; errors as in :func:`add_sibling`.
    """
    checked = add_sibling(tree, new.select("conv_id", "id", "sibling_id"))
    good = (checked.filter(F.col("error").isNull()).select("conv_id", "id", F.element_at("ancestors", -1).alias("parent_id"))
            .join(new.select("conv_id", "id", "role", "text"), ["conv_id", "id"]))
    bad = (checked.filter(F.col("error").isNotNull()).join(new.select("conv_id", "id", "role", "text"), ["conv_id", "id"])
           .select("conv_id", "id", "role", "text", F.lit(None).cast("array<string>").alias("ancestors"), _empty().alias("children"), "error"))
    return append(tree, good).unionByName(bad)


def path(tree: DataFrame, targets: DataFrame, drop_last: bool = False) -> DataFrame:
    """Root-to-message path of each target (conv_id, id): ids in order; ``drop_last`` gives the retry prompt path.

    Every ancestor must exist in the tree (checked by an exploded anti-join, not a per-row lookup).
    """
    t = targets.join(tree.select("conv_id", "id", "ancestors"), ["conv_id", "id"], "left")
    anc = t.filter(F.col("ancestors").isNotNull()).select("conv_id", F.col("id").alias("_t"), F.explode("ancestors").alias("id"))
    missing = (anc.join(tree.select("conv_id", "id"), ["conv_id", "id"], "left_anti")
               .select("conv_id", F.col("_t").alias("id"), F.lit(True).alias("_miss")).distinct())
    t = t.join(missing, ["conv_id", "id"], "left")
    p = F.concat(F.coalesce("ancestors", _empty()), F.array("id"))
    if drop_last:
        p = F.slice(p, 1, F.greatest(F.size(p) - 1, F.lit(0)))
    err = (F.when(F.col("ancestors").isNull(), F.lit("Message not found"))
           .when(F.col("_miss").isNotNull(), F.lit("Ancestor not found")))
    return t.select("conv_id", F.col("id").alias("target"), F.when(err.isNull(), p).alias("path"), err.alias("error"))


def conversation_hash(conv: DataFrame) -> DataFrame:
    """SHA-256 of the JSON of each conversation's immutable part: from, id, content, webSearchId (left out if missing)."""
    mid = F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    one = F.struct(F.col("role").alias("from"), mid.alias("id"), F.col("text").alias("content"), F.col("web_search_id").alias("webSearchId"))
    g = conv.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", one.alias("m")))).alias("_m"))
    return g.select("conv_id", F.sha2(F.to_json(F.transform("_m", lambda x: x["m"])).cast("binary"), 256).alias("hash"))


# --- legacy conversations: a flat thread without tree links (no root message id)


def legacy_append(thread: DataFrame, new: DataFrame) -> DataFrame:
    """Append to a legacy (linear) thread: only after its last message, without links.

    ``thread``: (conv_id, id, turn, ...); ``new``: (conv_id, id, role, text, parent_id).
    Returns the new rows with their turn, or an error when the parent is not the last message (a missing
    parent is not, unless the thread is empty).  Appends of a thread are taken one after another, by id:
    the first valid one is accepted and is the last message from then on, so its turn is taken.
    """
    last = thread.groupBy("conv_id").agg(F.max_by("id", "turn").alias("_last"), F.max("turn").alias("_t"))
    j = new.join(last, "conv_id", "left").withColumn(
        "_ok", F.when(F.col("_last").isNull(), F.col("parent_id").isNull()).otherwise(F.col("parent_id").eqNullSafe(F.col("_last"))))
    first = F.row_number().over(Window.partitionBy("conv_id", "_ok").orderBy("id")) == 1
    ok = F.col("_ok") & first
    err = F.when(~ok, F.lit("This is a legacy conversation, you can only append to the last message"))  # fixed value
    return j.select("conv_id", "id", "role", "text", F.when(ok, F.coalesce(F.col("_t"), F.lit(-1)) + 1).alias("turn"), err.alias("error"))


def legacy_path(thread: DataFrame, targets: DataFrame) -> DataFrame:
    """Path to a message of a legacy thread: the thread sliced up to and including that message."""
    t = targets.join(thread.select("conv_id", "id", F.col("turn").alias("_t")), ["conv_id", "id"], "left")
    upto = (t.filter(F.col("_t").isNotNull())
            .join(thread.select("conv_id", F.col("id").alias("_m"), "turn"), "conv_id")
            .filter(F.col("turn") <= F.col("_t"))
            .groupBy("conv_id", "id").agg(F.array_sort(F.collect_list(F.struct("turn", "_m"))).alias("_p")))
    return (t.join(upto, ["conv_id", "id"], "left")
            .select("conv_id", F.col("id").alias("target"), F.transform("_p", lambda x: x["_m"]).alias("path"),
                    F.when(F.col("_t").isNull(), F.lit("Message not found")).alias("error")))
