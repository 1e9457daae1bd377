"""Exact and approximate vector retrieval (group H).

Plan of an exact search: the query set goes in passes of ``PASS_QUERIES``; in a pass every corpus task
multiplies its Arrow batches with the queries, ``BLOCK_QUERIES`` at a time, and keeps k rows per query.
The corpus is never sorted globally and never leaves its partition except for those k
rows per task, which a window merges. Where a second pass is needed the corpus vectors are written
once, so that what makes them (an embedder) runs once.
Metadata filters are plain predicates on the corpus, pushed into the scan.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from corpusflow.functions.vectors import dot
from corpusflow.sources.readers import scratch_path

BLOCK_QUERIES = 2_000  # query vectors multiplied at a time
BLOCK_ROWS = 1_024     # with so many corpus vectors
PASS_QUERIES = 32_000  # query vectors broadcast for one pass over the corpus


def query_passes(queries: DataFrame, size: int):
    """The query set as lists of at most about ``size`` rows (the set is collected a pass at a time)."""
    rows = queries.limit(size + 1).collect()
    if len(rows) <= size:
        if rows:
            yield rows
        return
    passes = -(-queries.count() // size)
    for b in range(passes):
        rows = queries.filter(F.pmod(F.xxhash64(*queries.columns), F.lit(passes)) == b).collect()
        if rows:
            yield rows


def corpus_once(corpus: DataFrame, queries: int, size: int) -> DataFrame:
    """The corpus as written vectors if there may be more passes than one, else as it is."""
    if queries < size:
        return corpus
    path = scratch_path(corpus.sparkSession, "vectors")
    corpus.write.parquet(path)
    return corpus.sparkSession.read.parquet(path)


def ascending(metric: str) -> bool:
    return metric in ("l2", "ip_distance")


def matrix(col):
    """An Arrow column of equally long vectors as a float64 matrix (no Python lists)."""
    import numpy as np

    flat = col.flatten().to_numpy(zero_copy_only=False)
    return np.asarray(flat, dtype=np.float64).reshape(len(col), -1)


class TopRows:
    """The k best rows per query among those of one task; a query's k-th best so far bars worse rows."""

    def __init__(self, n_queries: int, k: int, keep: list[str], cid: str):
        import numpy as np

        self.k, self.keep, self.cid = k, keep, cid
        self.bar = np.full(n_queries, np.inf)
        self.parts: list = []
        self.rows, self.room = 0, 4 * n_queries * k + 100_000

    def add(self, batch, rows, queries, score, order) -> None:
        """Scores of ``queries`` (numbers) with the batch's ``rows`` (numbers); smaller ``order`` is better."""
        import numpy as np
        import pyarrow as pa

        bar = self.bar[queries]
        if order.shape[1] > self.k:  # within the k best of these rows, ties included
            bar = np.minimum(bar, np.partition(order, self.k - 1, axis=1)[:, self.k - 1])
            self.bar[queries] = bar
        qi, ci = np.nonzero(order <= bar[:, None])
        if not len(qi):
            return
        at = pa.array(rows[ci])
        self.parts.append(pa.table([*[batch.column(n).take(at) for n in self.keep], pa.array(queries[qi]), pa.array(score[qi, ci]),
                                    pa.array(order[qi, ci])], names=[*self.keep, "_q", "score", "_o"]))
        self.rows += len(qi)
        if self.rows > self.room:
            self._cut()

    def _cut(self):
        import numpy as np
        import pyarrow as pa

        kept = pa.concat_tables(self.parts).sort_by([("_q", "ascending"), ("_o", "ascending"), (self.cid, "ascending")])
        number = kept["_q"].to_numpy()
        place = np.arange(len(number)) - np.searchsorted(number, number)
        last = np.flatnonzero(place == self.k - 1)
        self.bar[number[last]] = np.minimum(self.bar[number[last]], kept["_o"].to_numpy()[last])
        kept = kept.filter(pa.array(place < self.k))
        self.parts, self.rows = [kept], len(kept)

    def batches(self):
        if self.parts:
            self._cut()
            yield from self.parts[0].drop_columns(["_o"]).to_batches()


def score_rows(q, c, metric: str):
    """Scores of all queries with all rows, and their order (smaller is better, at 9 decimals)."""
    import numpy as np

    score = q @ c.T
    if metric == "ip_distance":
        score = 1.0 - score
    elif metric == "l2":
        score = np.maximum((q * q).sum(1)[:, None] - 2 * score + (c * c).sum(1)[None, :], 0.0)
    return score, np.round(score if ascending(metric) else -score, 9)


def _task_top_k(batches, queries: list, keep: list[str], metric: str, cid: str, k: int):
    """Arrow batches of (keep, cv) -> the k best rows per query of this task, with ``_q`` and ``score``."""
    import numpy as np

    q = np.array(queries, dtype=np.float64)
    best = TopRows(len(q), k, keep, cid)
    for batch in batches:
        if not batch.num_rows:
            continue
        c = matrix(batch.column("cv"))
        for a in range(0, len(c), BLOCK_ROWS):
            rows = np.arange(a, min(a + BLOCK_ROWS, len(c)))
            for b in range(0, len(q), BLOCK_QUERIES):
                asked = np.arange(b, min(b + BLOCK_QUERIES, len(q)))
                best.add(batch, rows, asked, *score_rows(q[asked], c[rows], metric))
    yield from best.batches()


def rank_hits(found: DataFrame, k: int, metric: str, qid: str, cid: str) -> DataFrame:
    # scores are ranked at 9 decimals so float summation noise cannot reorder exact ties; ids break ties
    order = F.round("score", 9).asc() if ascending(metric) else F.round("score", 9).desc()
    w = Window.partitionBy(qid).orderBy(order, F.col(cid))
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def knn(queries: DataFrame, corpus: DataFrame, k: int, metric: str = "dot", qid: str = "query_id", cid: str = "item_id",
        where: Mapping[str, object] | None = None, block: int = PASS_QUERIES) -> DataFrame:
    """Top-k corpus rows per query; ``where`` filters corpus metadata first (pre-filter: k rows whenever k exist).

    The queries go in passes of ``block``; a task multiplies its Arrow batches with them and keeps its k best rows
    per query, so no row per pair is made, and at most tasks x queries x k rows are shuffled for the merge.
    """
    if metric not in ("dot", "ip_distance", "l2"):
        raise ValueError(metric)
    if where:
        for c, v in where.items():
            corpus = corpus.filter(F.col(c) == v)
    if "cv" not in corpus.columns or "qv" not in queries.columns:
        raise ValueError("queries need a column qv, the corpus a column cv")
    spark = corpus.sparkSession
    keep = [c for c in corpus.columns if c != "cv"]
    qcols = [c for c in queries.columns if c != "qv"]
    schema = StructType([*[corpus.schema[c] for c in keep], StructField("_q", LongType()), StructField("score", DoubleType())])
    parts: list[DataFrame] = []
    for n, rows in enumerate(query_passes(queries, block)):
        if n == 0:
            corpus = corpus_once(corpus, len(rows), block)
        shared = spark.sparkContext.broadcast([list(r["qv"]) for r in rows])  # a pass: bounded

        def best(batches, shared=shared):
            return _task_top_k(batches, shared.value, keep, metric, cid, k)

        parts.append(_named(corpus.select(*keep, "cv").mapInArrow(best, schema), rows, queries, qcols))
    if not parts:
        return rank_hits(spark.createDataFrame([], StructType([*schema.fields[:-2], *[queries.schema[c] for c in qcols], schema.fields[-1]])),
                         k, metric, qid, cid)
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    return rank_hits(found.select(*keep, *qcols, "score"), k, metric, qid, cid)


def _named(found: DataFrame, rows: list, queries: DataFrame, qcols: list[str]) -> DataFrame:
    """Query columns in place of the query's number within its pass."""
    names = found.sparkSession.createDataFrame([(i, *[r[c] for c in qcols]) for i, r in enumerate(rows)],
                                               StructType([StructField("_q", LongType()), *[queries.schema[c] for c in qcols]]))
    return found.join(F.broadcast(names), "_q").drop("_q")


def product_summary(queries: DataFrame, corpus: DataFrame, qid: str = "query_id", block: int = PASS_QUERIES) -> DataFrame:
    """(qid, n_positive, max_dot) over the product of the query set and the corpus: per-task partial results, then merged."""
    found = None
    for n, rows in enumerate(query_passes(queries, block)):
        if n == 0:
            corpus = corpus_once(corpus, len(rows), block)
        shared = corpus.sparkSession.sparkContext.broadcast([list(r["qv"]) for r in rows])  # a pass: bounded

        def partial(batches, shared=shared):
            import numpy as np
            import pyarrow as pa

            q = np.array(shared.value, dtype=np.float64)
            n, top = np.zeros(len(q), dtype=np.int64), np.full(len(q), -np.inf)
            for batch in batches:
                c = matrix(batch.column("cv")) if batch.num_rows else ()
                for a in range(0, len(c), BLOCK_ROWS):
                    for b in range(0, len(q), BLOCK_QUERIES):
                        s = q[b:b + BLOCK_QUERIES] @ c[a:a + BLOCK_ROWS].T
                        n[b:b + BLOCK_QUERIES] += (s > 0).sum(1)
                        top[b:b + BLOCK_QUERIES] = np.maximum(top[b:b + BLOCK_QUERIES], s.max(1))
            seen = np.flatnonzero(np.isfinite(top))
            yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(n[seen]), pa.array(top[seen])], names=["_q", "n", "top"])

        part = _named(corpus.select("cv").mapInArrow(partial, "_q long, n long, top double"), rows, queries, [qid])
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = corpus.sparkSession.createDataFrame([], StructType([queries.schema[qid], StructField("n", LongType()), StructField("top", DoubleType())]))
    return found.groupBy(qid).agg(F.sum("n").alias("n_positive"), F.max("top").alias("max_dot"))


def knn_within(queries: DataFrame, corpus: DataFrame, on: str, k: int, qid: str = "query_id", cid: str = "item_id") -> DataFrame:
    """Top-k by dot product among the corpus rows that have the query's value of ``on`` (an equi-join on it)."""
    j = corpus.join(queries, on).withColumn("score", dot("qv", "cv")).drop("qv", "cv")
    w = Window.partitionBy(qid).orderBy(F.round("score", 9).desc(), F.col(cid))
    return j.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def knn_post(queries: DataFrame, corpus: DataFrame, k: int, fetch_k: int, where: Mapping[str, object], metric: str = "dot",
             qid: str = "query_id", cid: str = "item_id") -> DataFrame:
    """Fetch ``fetch_k`` nearest, then filter on metadata, then keep k (may return fewer than k)."""
    hits = knn(queries, corpus, fetch_k, metric, qid, cid)
    for c, v in where.items():
        hits = hits.filter(F.col(c) == v)
    # scores are ranked at 9 decimals so float summation noise cannot reorder exact ties; ids break ties
    order = F.round("score", 9).asc() if ascending(metric) else F.round("score", 9).desc()
    w = Window.partitionBy(qid).orderBy(order, F.col(cid))
    return hits.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def attach_vectors(hits: DataFrame, queries: DataFrame, corpus: DataFrame, qid: str = "query_id", cid: str = "item_id") -> DataFrame:
    """Bring the vectors back to the (bounded) top hits: both joins are on ids of k rows per query."""
    return hits.join(queries.select(qid, "qv"), qid).join(corpus.select(cid, "cv"), cid)


def mmr(candidates: DataFrame, k: int, lam: float = 0.5, qid: str = "query_id", cid: str = "item_id",
        qvec: str = "qv", cvec: str = "cv") -> DataFrame:
    """Maximal marginal relevance over each query's ``fetch_k`` candidates (bounded group) in ``applyInPandas``."""
    import numpy as np
    import pandas as pd

    def pick(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(cid).reset_index(drop=True)
        q = np.asarray(pdf[qvec].iloc[0], dtype=np.float64)
        c = np.stack([np.asarray(v, dtype=np.float64) for v in pdf[cvec]])
        qn = q / (np.linalg.norm(q) or 1.0)
        cn = c / np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
        rel = cn @ qn
        chosen: list[int] = []
        left = list(range(len(pdf)))
        while left and len(chosen) < k:
            if chosen:
                red = (cn[left] @ cn[chosen].T).max(axis=1)
            else:
                red = np.zeros(len(left))
            score = lam * rel[left] - (1 - lam) * red
            best = left[int(np.argmax(score))]
            chosen.append(best)
            left.remove(best)
        return pd.DataFrame({qid: pdf[qid].iloc[0], cid: pdf[cid].iloc[chosen].to_numpy(), "rank": np.arange(1, len(chosen) + 1)})

    qt = candidates.schema[qid].dataType.simpleString()
    ct = candidates.schema[cid].dataType.simpleString()
    return candidates.select(qid, cid, qvec, cvec).groupBy(qid).applyInPandas(pick, f"{qid} {qt}, {cid} {ct}, rank int")


def recall(approx: DataFrame, exact: DataFrame, qid: str = "query_id", cid: str = "item_id") -> DataFrame:
    hit = exact.select(qid, cid).join(approx.select(qid, cid), [qid, cid], "left_semi")
    return hit.agg(F.count(F.lit(1)).alias("hits")).crossJoin(exact.agg(F.count(F.lit(1)).alias("total"))) \
        .withColumn("recall", F.col("hits") / F.col("total"))


def rerank(hits: DataFrame, scores: DataFrame, n: int, batch: int = 5, qid: str = "query_id") -> DataFrame:
    """Second stage: hits in batches of ``batch`` by rank; a parsed score per (query, batch, choice); top n by score."""
    h = hits.withColumn("batch", F.floor((F.col("rank") - 1) / batch)).withColumn("choice", (F.col("rank") - 1) % batch + 1)
    j = h.join(scores, [qid, "batch", "choice"])
    w = Window.partitionBy(qid).orderBy(F.col("relevance").desc(), F.col("rank"))
    return j.withColumn("rerank", F.row_number().over(w)).filter(F.col("rerank") <= n)


def stuff_prompt(hits: DataFrame, qid: str, rank: str, text: str, template: str) -> DataFrame:
    """Join each query's chunk texts in rank order into the ``{context}`` slot (bounded k per query)."""
    ctx = (hits.groupBy(qid).agg(F.array_sort(F.collect_list(F.struct(F.col(rank).alias("r"), F.col(text).alias("t")))).alias("_h"))
           .select(qid, F.array_join(F.transform("_h", lambda x: x["t"]), "\n\n").alias("context")))
    return ctx.withColumn("prompt", F.replace(F.lit(template), F.lit("{context}"), F.col("context")))


def lead_sentence(text: Column | str) -> Column:
    """Default extractive summariser: the first sentence."""
    c = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract(c, r"^[^.!?]*[.!?]?", 0)


def index_stats(df: DataFrame, vec: str, by: str | None = None) -> DataFrame:
    g = df.rollup(by) if by else df.groupBy()
    return g.agg(F.count(F.lit(1)).alias("n"), F.max(F.size(vec)).alias("dim"))
