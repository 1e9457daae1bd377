"""Sources (group A): readers with explicit schemas, plus the scratch folder that jobs write through.

Scratch data lives under the session's checkpoint folder (the cluster's shared
``spark.checkpoint.dir``), never on a machine-local path of a cluster node.
"""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.session import ensure_checkpoint_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/scratch/{name}-{uuid.uuid4().hex}"


def read_parquet_splits(spark: SparkSession, root: str, splits=None) -> DataFrame:
    """``root/split=<name>/*.parquet`` as one frame with a ``split`` column; a split filter prunes folders."""
    df = spark.read.parquet(root)
    if splits:
        df = df.filter(F.col("split").isin(list(splits)))
    return df


def read_csv(spark: SparkSession, path: str, schema: str, multiline: bool = False) -> DataFrame:
    """Header CSV.  ``multiline`` for quoted fields with newlines (dialogues): then a file is one task."""
    return spark.read.schema(schema).option("header", True).option("multiLine", multiline).option("escape", '"').csv(path)


def read_jsonl(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    r = spark.read
    if schema:
        r = r.schema(schema)
    return r.json(path)


def read_tokens(spark: SparkSession, paths: list[str], last_only: bool = False) -> DataFrame:
    """Pre-tokenised JSON lines (``input_ids``, ``attention_mask``); optionally only the last of the sorted paths."""
    use = sorted(paths)[-1:] if last_only else paths
    return spark.read.schema("input_ids array<int>, attention_mask array<int>").json(use)


def flatten_nested(df: DataFrame, outer: str, inner: str, keep, max_rows: int | None = None, order=None) -> DataFrame:
    """One row per inner element of a nested document (``outer[].inner[]``), filtered, optionally capped."""
    x = df.select(F.inline(outer)).select("*", F.inline(inner)).filter(keep)
    if max_rows is not None:
        x = x.orderBy(*order).limit(max_rows)
    return x


def json_normalize(df: DataFrame, col: str, schema: str, prefix: str = "") -> DataFrame:
    j = df.withColumn("_j", F.from_json(F.col(col), schema))
    fields = [f.name for f in j.schema["_j"].dataType.fields]
    return j.select(*[c for c in df.columns if c != col], *[F.col(f"_j.{f}").alias(prefix + f) for f in fields])


#: fixed values: the chat store's collections
COLLECTIONS = ("conversations", "conversationStats", "assistants", "reports", "sharedConversations", "abortedGenerations",
               "settings", "users", "sessions", "messageEvents", "files")


def load_collections(spark: SparkSession, root: str, names=COLLECTIONS) -> dict[str, DataFrame]:
    """The store's collections, a Parquet folder each below ``root``."""
    return {n: spark.read.parquet(f"{root}/{n}") for n in names}


def read_documents(spark: SparkSession, glob: str) -> DataFrame:
    """Whole text files, one row each, with their path."""
    return spark.read.text(glob, wholetext=True).select(F.input_file_name().alias("path"), F.col("value").alias("text"))


def rows_to_documents(df: DataFrame, cols=None) -> DataFrame:
    """Each row becomes a document of ``col: value`` lines."""
    cols = cols or df.columns
    text = F.concat_ws("\n", *[F.concat(F.lit(f"{c}: "), F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in cols])
    return df.withColumn("page_content", text)


def page_numbers(docs: DataFrame, source: str, order: str, out: str = "page") -> DataFrame:
    """1-based page number inside each source file, through the range-partitioned index (a file that
    holds a third of all pages still spans many tasks), plus ``n_pages`` of the file."""
    from corpusflow.plans.dense_index import with_index

    ix = with_index(docs, [order], "_i", within=[source]).withColumn(out, (F.col("_i") + 1).cast("int")).drop("_i")
    counts = docs.groupBy(source).agg(F.count(F.lit(1)).alias("n_pages"))
    return ix.join(counts, source)


def load_pages(pages: DataFrame, meta: DataFrame, source: str, page: str, drop_last: int = 3) -> DataFrame:
    """Attach per-file metadata (join on the file) and drop each file's last ``drop_last`` pages.

    ``pages`` carries ``page`` (1-based) and ``n_pages`` (see :func:`page_numbers`): no per-file sort.
    """
    x = pages.filter(F.col(page) <= F.col("n_pages") - drop_last)
    return x.join(meta, source, "left")


# fixed values: media types by file extension
MEDIA_TYPES = {"html": "text/html", "htm": "text/html", "txt": "text/plain", "jpg": "image/jpeg", "png": "image/png",
               "mp3": "audio/mpeg", "wav": "audio/wav", "mp4": "video/mp4"}


def media_type(path_col) -> "F.Column":
    ext = F.lower(F.regexp_extract(path_col, r"\.([A-Za-z0-9]+)(?:[?#].*)?$", 1))
    expr = None
    for e, m in MEDIA_TYPES.items():
        expr = F.when(ext == e, m) if expr is None else expr.when(ext == e, m)
    return expr.otherwise("application/octet-stream")


def read_media(spark: SparkSession, path: str) -> DataFrame:
    """Files of a folder: name, path, media type, base64 content."""
    b = spark.read.format("binaryFile").load(path)
    return b.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("name"), "path", media_type(F.col("path")).alias("media_type"),
                    F.base64("content").alias("content_b64"))


def shard_by_rank(df: DataFrame, order, n: int, rank: int, drop_last: bool = True) -> DataFrame:
    """Rank r of n gets every n-th row (by dense index); the remainder is dropped so all ranks get equal counts."""
    from corpusflow.plans.dense_index import total_rows, with_index

    ix = with_index(df, order, "_i").crossJoin(F.broadcast(total_rows(df)))
    cond = F.pmod("_i", F.lit(n)) == rank
    if drop_last:
        cond = cond & (F.col("_i") < F.floor(F.col("_total") / n) * n)
    return ix.filter(cond).drop("_i", "_total")
