"""Ranked lexical search: the ``k`` highest-scoring documents for each item, term at a time with limited accumulators.

Terms are runs of ASCII letters, digits and non-ASCII characters, A-Z lower-cased. A term weighs
``floor(1000 * ln((2N + 2) / (2 df + 1)))``; a document adds ``w * ((10**9 tf) div (1000 tf + 20 m))`` with
``m = 50 + (50 n N) div L``. All but the logarithm is integer arithmetic.

Plan. Two scans of the documents, no text shuffled. The first counts, for the items' terms alone, in how
many documents each stands (summed per task, then per term), with N and L. In the second each task takes its
documents in blocks, makes a block's postings of the items' terms, and per item goes through the terms
from the rarest on. A term's bound is its weight times its largest part within the block; as soon as the
bounds of the remaining terms together stay below the k-th best score known (of the block's partial scores
or of the task's earlier blocks), no accumulator is made any more: a new document could not reach the
first k. Survivors go on to be updated exactly. A task keeps k documents per item; these are merged per item
in two steps, first within buckets of documents.

Items are worked in blocks of ``BLOCK_TERMS`` distinct terms per item, summed; only a block's terms go through the
driver and are broadcast. Each block has scans of its own.

Terms are compared by 64-bit hashes; with 10**10 distinct words in the corpus and a block of a million terms
the expected number of false matches is below 0.001.

Defined cases: a null, empty or wordless text is no document (it isn't counted and never found) and an item
with no terms has no rows; each row of the item table is an item of its own, also with a repeated or null id;
repeated document rows are found repeatedly; equal scores go by ascending document id, null last. An empty
table on either side gives no rows. A very long text is worked whole: memory follows the longest text.
Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.llm import arrays as A
from corpusflow.plans.dense_index import with_index
from corpusflow.sources.readers import scratch_path

K = 50
BLOCK_TERMS = 1_000_000
#: documents and bytes of text worked as one block
BLOCK_DOCS = 8192
BLOCK_BYTES = 16 << 20
#: buckets of the first merge
BUCKETS = 32
NO_ID = np.iinfo(np.int64).max


def word_hashes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row number of each term of a column of text."""
    buf, offs = A.text_bytes(col)
    starts, ends, doc = A.runs(A.ALNUM[buf], offs)
    return A.span_hashes(buf, starts, ends, lower=True), doc


def item_terms(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """One row per item with terms: number ``item`` (dense), ``item_id``, ``terms`` (hashes of its distinct terms)."""
    kind = items.schema[item_id].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for rb in A.slices(batch, "text"):
                h, doc = word_hashes(rb.column("text"))
                order = np.lexsort((h, doc))
                h, doc = h[order], doc[order]
                first = np.ones(len(h), dtype=bool)
                first[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
                n = np.bincount(doc[first], minlength=rb.num_rows)
                terms = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(n))), type=pa.int32()),
                                                 pa.array(h[first].view(np.int64)))
                yield pa.RecordBatch.from_arrays([rb.column("item_id"), terms], names=["item_id", "terms"]).filter(
                    pa.array(n > 0))

    part = items.select(F.col(item_id).alias("item_id"), F.col(text).cast("string").alias("text"))
    found = part.mapInArrow(run, f"item_id {kind}, terms array<long>")
    return with_index(found, ["item_id", F.xxhash64("terms")], "before", weight=F.size("terms")).drop("before_end")


def _positions(h: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of the hashes are known (sorted), and the places of those."""
    at = np.searchsorted(known, h)
    at[at == len(known)] = 0
    hit = known[at] == h
    return hit, at[hit]


def term_counts(docs: DataFrame, known: np.ndarray) -> tuple[np.ndarray, int, int]:
    """Documents with each known term, documents with any term, terms of all documents."""
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def run(batches):
        known = shared.value
        df, n_docs, n_terms = np.zeros(len(known), dtype=np.int64), 0, 0
        for batch in batches:
            for rb in A.slices(batch, "text"):
                h, doc = word_hashes(rb.column("text"))
                n_docs += len(np.unique(doc))
                n_terms += len(h)
                hit, at = _positions(h, known)
                df += np.bincount(np.unique(at * rb.num_rows + doc[hit]) // rb.num_rows, minlength=len(known))
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate((some, [-1, -2])), type=pa.int64()),
             pa.array(np.concatenate((df[some], [n_docs, n_terms])), type=pa.int64())], names=["term", "n"])

    rows = docs.select("text").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    df, total = np.zeros(len(known), dtype=np.int64), {-1: 0, -2: 0}
    for r in rows:  # at most a row per term of the block
        if r.term < 0:
            total[r.term] = r.n
        else:
            df[r.term] = r.n
    return df, total[-1], total[-2]


class Block:
    """Postings of a block of documents, by term."""

    def __init__(self, parts: list[tuple], weight: np.ndarray, n_docs: int, n_terms: int):
        ids, lens, terms, docs, base = [], [], [], [], 0
        for i, n, t, d in parts:
            ids.append(i)
            lens.append(n)
            terms.append(t)
            docs.append(d + base)
            base += len(i)
        self.ids, n = np.concatenate(ids), np.concatenate(lens)
        if 50 * n_docs * int(n.max(initial=0)) >= 1 << 63:
            m = np.array([50 + 50 * x * n_docs // n_terms for x in n.tolist()], dtype=np.int64)
        else:
            m = 50 + (50 * n * n_docs) // max(1, n_terms)
        key, tf = np.unique(np.concatenate(terms) * base + np.concatenate(docs), return_counts=True)
        term, self.docs = np.divmod(key, base)
        self.adds = weight[term] * ((10**9 * tf) // (1000 * tf + 20 * m[self.docs]))
        first = np.ones(len(term), dtype=bool)
        first[1:] = term[1:] != term[:-1]
        at = np.flatnonzero(first)
        self.size = base
        self.start, self.stop = np.zeros(len(weight), dtype=np.int64), np.zeros(len(weight), dtype=np.int64)
        self.bound = np.zeros(len(weight), dtype=np.int64)
        self.start[term[at]], self.stop[term[at]] = at, np.append(at[1:], len(term))
        if len(at):
            self.bound[term[at]] = np.maximum.reduceat(self.adds, at)

    def postings(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        part = slice(self.start[term], self.stop[term])
        return self.docs[part], self.adds[part]


def _kth(scores: np.ndarray, k: int) -> int:
    return int(np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) >= k else 0


def best_of(block: Block, terms: np.ndarray, k: int, least: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Documents of a block that can be among the first ``k``, with exact scores.

    ``terms`` are ordered from the rarest on; ``least`` is a score that k documents elsewhere have reached.
    """
    terms = terms[block.bound[terms] > 0]
    left = np.append(np.cumsum(block.bound[terms][::-1])[::-1], 0)
    acc, bar, j = np.zeros(block.size, dtype=np.int64), least, 0
    while j < len(terms) and left[j] >= bar:
        docs, adds = block.postings(terms[j])
        acc[docs] += adds
        j += 1
        top = int(acc.max())
        if top > bar and left[j] < top:  # only then can the k-th partial score end the making of accumulators
            bar = max(bar, _kth(acc[acc > 0], k))
    alive = np.flatnonzero(acc)
    score = acc[alive]
    for t in terms[j:] if len(alive) else ():
        docs, adds = block.postings(t)
        if len(alive) < len(docs):
            at = np.searchsorted(docs, alive)
            at[at == len(docs)] = 0
            score += np.where(docs[at] == alive, adds[at], 0)
        else:
            at = np.searchsorted(alive, docs)
            at[at == len(alive)] = 0
            hit = alive[at] == docs
            score[at[hit]] += adds[hit]
    good = score >= max(bar, 1)
    return block.ids[alive[good]], score[good]


def _blocks(batches, known: np.ndarray) -> Iterator[list[tuple]]:
    parts, docs, size = [], 0, 0
    for batch in batches:
        for rb in A.slices(batch, "text"):
            h, doc = word_hashes(rb.column("text"))
            hit, at = _positions(h, known)
            ids = np.asarray(rb.column("doc_id").fill_null(NO_ID), dtype=np.int64)
            parts.append((ids, np.bincount(doc, minlength=rb.num_rows), at, doc[hit]))
            docs += rb.num_rows
            size += rb.column("text").nbytes
            if docs >= BLOCK_DOCS or size >= BLOCK_BYTES:
                yield parts
                parts, docs, size = [], 0, 0
    if parts:
        yield parts


def _search(docs: DataFrame, terms: list[np.ndarray], k: int) -> DataFrame:
    """``item`` (place in ``terms``), ``doc_id``, ``score``: a task's k best documents per item."""
    known = np.unique(np.concatenate(terms))
    df, n_docs, n_terms = term_counts(docs, known)
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) if d else 0 for d in df.tolist()], dtype=np.int64)
    lists = []
    for t in terms:
        at = np.searchsorted(known, t)
        lists.append(at[np.lexsort((at, df[at]))])
    shared = docs.sparkSession.sparkContext.broadcast((known, weight, lists))

    def run(batches):
        known, weight, lists = shared.value
        best = [(np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)) for _ in lists]
        for parts in _blocks(batches, known):
            block = Block(parts, weight, n_docs, n_terms)
            for i, terms in enumerate(lists):
                ids, score = best[i]
                new_ids, new = best_of(block, terms, k, int(score[-1]) if len(score) == k else 0)
                if len(new):
                    ids, score = np.concatenate((ids, new_ids)), np.concatenate((score, new))
                    order = np.lexsort((ids, -score))[:k]
                    best[i] = ids[order], score[order]
        ids = np.concatenate([b[0] for b in best])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(len(best)), [len(b[0]) for b in best]), type=pa.int64()),
             pa.array(ids, mask=ids == NO_ID), pa.array(np.concatenate([b[1] for b in best]), type=pa.int64())],
            names=["item", "doc_id", "score"])

    return docs.mapInArrow(run, "item long, doc_id long, score long")


def _first(found: DataFrame, k: int, *group: str) -> DataFrame:
    w = Window.partitionBy(*group).orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
           item_text: str = "text", k: int = K, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id``, ``score``: each item's ``k`` best documents. Document ids are integers."""
    spark = docs.sparkSession
    part = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    path = scratch_path(spark, "search-items")
    item_terms(items, item_id, item_text).withColumn("block", F.expr(f"before div {int(block_terms)}")).write.parquet(path)
    table = spark.read.parquet(path)
    kind = items.schema[item_id].dataType
    out = spark.createDataFrame([], "rank int, doc_id long, score long").select(F.lit(None).cast(kind).alias("item_id"), "*")
    blocks = table.agg(F.max("block")).first()[0]
    for b in range(0 if blocks is None else blocks + 1):
        rows = table.filter(F.col("block") == b).orderBy("before").collect()  # bounded by block_terms and one item
        if not rows:
            continue
        found = _search(part, [np.array(r.terms, dtype=np.int64).view(np.uint64) for r in rows], k)
        found = _first(found.withColumn("bucket", F.pmod(F.xxhash64("doc_id"), F.lit(BUCKETS))), k, "item", "bucket")
        found = _first(found.drop("rank"), k, "item")
        names = spark.createDataFrame([(i, r.item_id) for i, r in enumerate(rows)], f"item long, item_id {kind.simpleString()}")
        out = out.unionByName(found.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))
    return out
