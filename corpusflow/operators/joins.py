"""Join operators (group I): lookups, existence checks, pair expansion, guarded cross products.

Join strategy is left to Catalyst/AQE: a side is broadcast when its estimated
size is under ``spark.sql.autoBroadcastJoinThreshold`` (a size check on plan
statistics), otherwise the join is sort-merge and AQE may still switch or split
skewed partitions at run time.  Explicit ``broadcast`` hints are only placed on
inputs whose size is bounded by construction (parameters, per-span bounds).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def consented_anonymous(settings: DataFrame, chats: DataFrame, model: str) -> DataFrame:
    """Consenting anonymous settings (session, no user) joined to that session's anonymous chats of one model."""
    s = settings.filter(F.col("consent") & F.col("session_id").isNotNull() & F.col("user_id").isNull()).select("session_id")
    c = chats.filter((F.col("model") == model) & F.col("user_id").isNull())
    return c.join(s, "session_id", "inner")


def consented_users(settings: DataFrame, chats: DataFrame, model: str) -> DataFrame:
    """Consenting users joined to their chats of one model, appended to the anonymous branch."""
    s = settings.filter(F.col("consent") & F.col("user_id").isNotNull()).select("user_id").distinct()
    users = chats.filter(F.col("model") == model).join(s, "user_id", "inner")
    anon = consented_anonymous(settings, chats, model)
    return (users.select(F.col("user_id").cast("string").alias("owner"), "message_id", F.lit("user").alias("branch"))
            .unionByName(anon.select(F.col("session_id").alias("owner"), "message_id", F.lit("session").alias("branch"))))


def semi_join_ids(df: DataFrame, ids: DataFrame, key: str, ids_key: str | None = None) -> DataFrame:
    """Rows of ``df`` whose key appears in ``ids`` (EXISTS)."""
    ids_key = ids_key or key
    return df.join(ids.select(F.col(ids_key).alias(key)), key, "left_semi")


def left_lookup(df: DataFrame, lookup: DataFrame, left_key: str, right_key: str, attrs: Sequence[str]) -> DataFrame:
    """Attach attributes of the matching lookup row; null when none."""
    r = lookup.select(F.col(right_key).alias("_lk"), *attrs)
    return df.join(r, df[left_key] == r["_lk"], "left").drop("_lk")


def insert_new(target: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``new`` with no row of the same key in ``target``, one per key."""
    return new.dropDuplicates(list(keys)).join(target.select(*keys), list(keys), "left_anti")


def migrate_owner(rows: DataFrame, logins: DataFrame) -> DataFrame:
    """Anonymous rows of a session that logged in get that user id; their session id is cleared."""
    l = logins.select(F.col("session_id").alias("_sid"), F.col("user_id").alias("_uid"))
    j = rows.join(l, (rows["session_id"] == l["_sid"]) & rows["user_id"].isNull(), "left")
    return j.select(*[c for c in rows.columns if c not in ("user_id", "session_id")],
                    F.coalesce(F.col("user_id"), F.col("_uid")).alias("user_id"),
                    F.when(F.col("_uid").isNotNull(), F.lit(None).cast("string")).otherwise(F.col("session_id")).alias("session_id"))


def default_settings_for(logins: DataFrame, settings: DataFrame) -> DataFrame:
    """Users that logged in and have no settings row yet (defaults to create)."""
    return logins.select("user_id").distinct().join(settings.select("user_id"), "user_id", "left_anti")


def remove_everywhere(entities: DataFrame, holders: DataFrame, removed: DataFrame, key: str, array_col: str) -> tuple[DataFrame, DataFrame]:
    """Delete entities and strip their ids from every holder array.

    The removed ids are joined to the holders exploded by element, so the id list
    is never collected; holders with no removed element pass through unchanged.
    """
    kept = entities.join(removed.select(key), key, "left_anti")
    ex = holders.select("*", F.posexplode(array_col).alias("_pos", "_el"))
    rid = removed.select(F.col(key).alias("_el"), F.lit(True).alias("_gone"))
    cols = [c for c in holders.columns if c != array_col]
    stripped = (ex.join(rid, "_el", "left").filter(F.col("_gone").isNull())
                .groupBy(*cols).agg(F.array_sort(F.collect_list(F.struct("_pos", "_el"))).alias("_a"))
                .select(*cols, F.transform("_a", lambda x: x["_el"]).alias(array_col)))
    empty = holders.filter(F.size(array_col) == 0)
    # holders whose every element was removed keep an empty array
    all_gone = (holders.join(stripped.select(*cols), cols, "left_anti").filter(F.size(array_col) > 0)
                .select(*cols, F.array().cast(holders.schema[array_col].dataType).alias(array_col)))
    return kept, stripped.unionByName(empty).unionByName(all_gone)


def adjacent_pairs(df: DataFrame, group: str, pos: str, cols: Sequence[str]) -> DataFrame:
    """Preference pairs of consecutive ranks inside a group: (rank i, rank i + 1).

    This is the linear form of the reference's all-pairs expansion: the same total order
    in n - 1 rows instead of n(n-1)/2, built with ``lead`` over the group (no self-join).
    """
    from pyspark.sql import Window

    w = Window.partitionBy(group).orderBy(pos)
    nxt = [F.lead(F.col(c)).over(w).alias(f"{c}_b") for c in cols]
    out = df.select(F.col(group), F.col(pos).alias("pos_a"), F.lead(F.col(pos)).over(w).alias("pos_b"),
                    *[F.col(c).alias(f"{c}_a") for c in cols], *nxt)
    return out.filter(F.col("pos_b").isNotNull())


def guard_rows(small: DataFrame, max_rows: int, what: str = "broadcast side") -> DataFrame:
    """Pass ``small`` through, failing at run time if it holds more than ``max_rows`` rows.

    The count is a global aggregate (partial per task, one row out) joined back as a
    one-row broadcast, so the check itself never funnels data into one task.
    """
    n = small.agg(F.count(F.lit(1)).alias("_guard_n"))
    return (small.crossJoin(F.broadcast(n))
            .filter(F.when(F.col("_guard_n") <= max_rows, F.lit(True))
                    .otherwise(F.raise_error(F.lit(f"{what} holds more than {max_rows} rows"))))
            .drop("_guard_n"))


def attach_scalar(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row frame (a scalar result) to every row; fails if it holds more rows."""
    return df.crossJoin(F.broadcast(guard_rows(one_row, 1, "scalar side")))
