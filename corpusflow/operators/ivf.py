"""Approximate vector search with an inverted file: trained centroids, cell lists, several cells probed per query.

Build. The number of cells follows the square root of the corpus, up to ``MAX_CELLS`` (their centroids are
broadcast: 8 bytes a component). K-means trains them on a seeded sample of ``TRAIN_ROWS`` rows per cell at most, which is all
the driver ever holds of the corpus; every row is then assigned to its nearest centroid and written once,
sorted by cell, so that a batch holds runs of one cell. A cell with a third of all rows spans many tasks,
as the row's id ends the range key.

Probes. For a seeded sample of at most ``SAMPLE`` queries the exact neighbours are searched; a neighbour is found
just when its cell is probed, so its cell's place in the query's order of cells says how many probes it needs.
The number of probes is the smallest that reaches ``target`` on one half of the sample; the recall that is
returned is measured on the other half, and where that misses ``floor`` the whole sample sets the probes.

Search. Queries go in passes of bounded size. A task multiplies a cell's run of rows with the queries that
probe the cell and keeps k rows per query; a window merges the tasks' rows. Scores are exact.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

from corpusflow.operators import retrieval as H
from corpusflow.sources.readers import scratch_path

MAX_CELLS = 16_384
TRAIN_ROWS = 48
ITERATIONS = 8
SAMPLE = 400
TARGET, FLOOR = 0.95, 0.9


@dataclass(frozen=True)
class Index:
    rows: DataFrame          # the corpus' columns and ``cell``, sorted by cell
    centroids: np.ndarray    # cells x dim
    cid: str


def nearest_cell(c: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    half = (centroids * centroids).sum(1) / 2
    return np.concatenate([(c[a:a + 4096] @ centroids.T - half).argmax(1) for a in range(0, len(c), 4096)]) if len(c) else np.zeros(0, dtype=int)


def train(sample: np.ndarray, cells: int, seed: int = 7, iterations: int = ITERATIONS) -> np.ndarray:
    """Centroids by k-means on the sample; a cell that loses all its rows starts again at a random one."""
    rng = np.random.default_rng(seed)
    out = sample[rng.choice(len(sample), size=min(cells, len(sample)), replace=False)].copy()
    for _ in range(iterations):
        cell = nearest_cell(sample, out)
        order = np.argsort(cell, kind="stable")
        used, first = np.unique(cell[order], return_index=True)
        counts = np.diff(np.append(first, len(cell)))
        fresh = sample[rng.integers(0, len(sample), size=len(out))]
        fresh[used] = np.add.reduceat(sample[order], first, axis=0) / counts[:, None]
        out = fresh
    return out


def build(corpus: DataFrame, cid: str = "item_id", cells: int | None = None, seed: int = 7) -> Index:
    """Index of a corpus with the columns ``cid``, ``cv`` and any others; rows without a vector are not indexed."""
    spark = corpus.sparkSession
    corpus = corpus.filter(F.col("cv").isNotNull() & (F.size("cv") > 0))
    n = corpus.count()
    cells = cells or max(1, min(MAX_CELLS, round(n ** 0.5)))
    # a seeded share by hash of the id, a little above the number wanted, then the smallest hashes
    want = cells * TRAIN_ROWS
    mark = F.pmod(F.xxhash64(F.col(cid), F.lit(seed)), F.lit(1 << 30))
    share = corpus if n <= want else corpus.filter(mark < int((1 << 30) * min(1.0, 1.2 * want / n)))
    sample = [r.cv for r in share.select("cv", mark.alias("m")).orderBy("m", "cv").limit(want).select("cv").collect()]
    if not sample:
        return Index(corpus.withColumn("cell", F.lit(0)), np.zeros((0, 0)), cid)
    centroids = train(np.array(sample, dtype=np.float64), cells, seed)
    shared = spark.sparkContext.broadcast(centroids)  # at most MAX_CELLS
    schema = StructType([*corpus.schema.fields, StructField("cell", IntegerType())])

    def assign(batches):
        import pyarrow as pa

        for b in batches:
            cell = nearest_cell(H.matrix(b.column("cv")), shared.value) if b.num_rows else []
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell, type=pa.int32())], names=schema.names)

    path = scratch_path(spark, "ivf-lists")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (corpus.mapInArrow(assign, schema).repartitionByRange(parts, "cell", cid).sortWithinPartitions("cell", cid).write.parquet(path))
    return Index(spark.read.parquet(path), centroids, cid)


def cell_order(q: np.ndarray, centroids: np.ndarray, metric: str) -> np.ndarray:
    """Cells of each query, the most promising first."""
    score = q @ centroids.T
    if metric == "l2":
        score = score - (centroids * centroids).sum(1) / 2
    return np.argsort(-score, axis=1, kind="stable")


def probes_for(places: np.ndarray, target: float) -> int:
    """Smallest number of probes with which ``target`` of the places (0 is the first cell) are found."""
    if not len(places):
        return 1
    return int(np.sort(places)[max(0, int(np.ceil(target * len(places))) - 1)]) + 1


def measure(queries: DataFrame, index: Index, k: int, metric: str, qid: str, target: float, floor: float,
            sample: int = SAMPLE, seed: int = 11) -> tuple[int, float]:
    """Number of probes, and the recall it has on sampled queries that did not set it."""
    mark = F.xxhash64(F.col(qid), F.lit(seed))
    asked = queries.orderBy(mark, qid).limit(sample).select(qid, "qv")
    hits = H.knn(asked, index.rows.select(index.cid, "cell", "cv"), k, metric, qid, index.cid).select(qid, "cell", mark.alias("m")).collect()
    rows = {r[qid]: r.qv for r in asked.collect()}
    if not hits:
        return 1, 1.0
    ids = sorted({(h.m, h[qid]) for h in hits})
    number = {i: n for n, (_, i) in enumerate(ids)}
    order = cell_order(np.array([rows[i] for _, i in ids], dtype=np.float64), index.centroids, metric)
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.broadcast_to(np.arange(order.shape[1]), order.shape), axis=1)
    who = np.array([number[h[qid]] for h in hits])
    places = place[who, [h.cell for h in hits]]
    fit = who % 2 == 0
    probes = probes_for(places[fit], target)
    test = places[~fit] if (~fit).any() else places
    if (test < probes).mean() < floor:
        probes, test = max(probes, probes_for(places, target)), places
    return probes, float((test < probes).mean())


def search(queries: DataFrame, index: Index, k: int, metric: str = "dot", qid: str = "query_id", target: float = TARGET,
           floor: float = FLOOR, probes: int | None = None, block: int = H.PASS_QUERIES) -> tuple[DataFrame, float]:
    """Top-k rows per query (the index' columns without vector and cell, the query's, ``score``, ``rank``), and the recall measured."""
    spark, cid = queries.sparkSession, index.cid
    queries = queries.filter(F.col("qv").isNotNull())
    recall = float("nan")
    if probes is None:
        probes, recall = measure(queries, index, k, metric, qid, target, floor)
    keep = [c for c in index.rows.columns if c not in ("cv", "cell")]
    qcols = [c for c in queries.columns if c != "qv"]
    schema = StructType([*[index.rows.schema[c] for c in keep], StructField("_q", LongType()), StructField("score", DoubleType())])
    found = None
    for rows in H.query_passes(queries, block) if len(index.centroids) else ():
        q = np.array([r["qv"] for r in rows], dtype=np.float64)
        probed = cell_order(q, index.centroids, metric)[:, :probes]
        order = np.argsort(probed.ravel(), kind="stable")
        cell, who = probed.ravel()[order], order // probed.shape[1]
        shared = spark.sparkContext.broadcast((q, cell, who))  # a pass of queries and their probes

        def best(batches, shared=shared):
            q, cell, who = shared.value
            top = H.TopRows(len(q), k, keep, cid)
            for b in batches:
                if not b.num_rows:
                    continue
                c, mine = H.matrix(b.column("cv")), b.column("cell").to_numpy()
                edge = np.flatnonzero(np.concatenate(([True], mine[1:] != mine[:-1])))
                for a, e in zip(edge, [*edge[1:], len(mine)]):
                    asked = who[np.searchsorted(cell, mine[a]):np.searchsorted(cell, mine[a], "right")]
                    for x in range(a, e, H.BLOCK_ROWS):
                        at = np.arange(x, min(x + H.BLOCK_ROWS, e))
                        for y in range(0, len(asked), H.BLOCK_QUERIES):
                            some = asked[y:y + H.BLOCK_QUERIES]
                            top.add(b, at, some, *H.score_rows(q[some], c[at], metric))
            yield from top.batches()

        lists = index.rows
        if len(np.unique(cell)) * 4 < len(index.centroids):  # few cells: the scan skips the others' row groups
            lists = lists.filter(F.col("cell").isin([int(x) for x in np.unique(cell)]))
        part = H._named(lists.select(*keep, "cell", "cv").mapInArrow(best, schema), rows, queries, qcols)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = spark.createDataFrame([], StructType([*schema.fields[:-2], *[queries.schema[c] for c in qcols], schema.fields[-1]]))
    return H.rank_hits(found.select(*keep, *qcols, "score"), k, metric, qid, cid), recall
