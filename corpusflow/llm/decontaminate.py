"""Benchmark decontamination with a generalised suffix automaton of the test items.

Method. The words of all test items (lower-cased A-Z, letters and digits) go into one generalised
suffix automaton, built item by item. A document's words are streamed through it; the state and the
current matching length tell the longest run of words that ends here and stands in some item. A run
counts when it is as long as an item's limit: ``span_words``, or the share ``item_coverage`` of the
item's words if that is less (so an item of fewer words counts as a whole). The states that stand for
such runs carry the ids of their items.

Plan. One scan of the documents without a shuffle. The items are a stated query set: they are split
into blocks of about ``block_words`` words; each block's automaton is built on the driver, one after the
other, flattened into sorted arrays (under 100 bytes a word of the items) and broadcast. A document's words
are cut and hashed once and meet the blocks in turn. Words and word pairs that
no item has end a match, so only stretches of known pairs are streamed; that skips no match.

Defined cases: null or empty text has no words and no hits; items without words match nothing; a
null item id counts as the empty string; items that share an id count once; without items nothing is
hit; very long texts are read whole, one at a time; repeated rows are judged each, an empty table gives no rows. Extra columns are kept; names that clash with the new columns get no new column of that name, as
the caller picks ``prefix``.
"""

from __future__ import annotations

import math
from array import array
from bisect import bisect_left

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from corpusflow.llm import arrays as A

SPAN_WORDS = 10
ITEM_COVERAGE = 1.0
DROP_SHARE = 0.5
BLOCK_WORDS = 200_000


def words(col: pa.Array):
    """Bytes, word starts, word ends, document numbers and word hashes of a column of texts."""
    buf, offs = A.text_bytes(col)
    starts, ends, doc = A.runs(A.ALNUM[buf], offs)
    return buf, offs, starts, ends, doc, A.span_hashes(buf, starts, ends, lower=True)


class _Grown:
    """States, transitions and suffix links while items are added."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.len = [-1], [0]

    def add(self, seq: list[int]) -> None:
        last = 0
        for c in seq:
            last = self._extend(last, c)

    def _clone(self, p: int, q: int, c: int) -> int:
        s = len(self.next)
        self.next.append(dict(self.next[q]))
        self.len.append(self.len[p] + 1)
        self.link.append(self.link[q])
        while p != -1 and self.next[p].get(c) == q:
            self.next[p][c] = s
            p = self.link[p]
        self.link[q] = s
        return s

    def _extend(self, last: int, c: int) -> int:
        if c in self.next[last]:  # an earlier item has this run
            q = self.next[last][c]
            return q if self.len[q] == self.len[last] + 1 else self._clone(last, q, c)
        s, p = len(self.next), last
        self.next.append({})
        self.len.append(self.len[last] + 1)
        self.link.append(0)
        while p != -1 and c not in self.next[p]:
            self.next[p][c] = s
            p = self.link[p]
        if p != -1:
            q = self.next[p][c]
            self.link[s] = q if self.len[q] == self.len[p] + 1 else self._clone(p, q, c)
        return s


class Automaton:
    """Generalised suffix automaton over word numbers, with marks on the runs that count, in flat arrays.

    A transition is its state times the number of words plus the word, in ascending order beside its target. The marks
    of a state are pairs of a least run length and an item; ``up`` leads to the nearest marked state above.
    """

    def __init__(self, items: list[tuple[str, np.ndarray]], span_words: int, item_coverage: float):
        self.vocab = np.unique(np.concatenate([h for _, h in items])) if items else np.zeros(0, dtype=np.uint64)
        self.names = sorted({i for i, _ in items})
        number = {i: n for n, i in enumerate(self.names)}
        numbered = [(number[i], np.searchsorted(self.vocab, h).tolist()) for i, h in items if len(h)]
        self.least = min((self._limit(s, span_words, item_coverage) for _, s in numbered), default=0)
        grown = _Grown()
        for _, seq in numbered:
            grown.add(seq)
        marks = set()
        for item, seq in numbered:
            k, v = self._limit(seq, span_words, item_coverage), 0
            for n, c in enumerate(seq, 1):
                v = grown.next[v][c]
                if n >= k:
                    s = v
                    while grown.len[grown.link[s]] >= k:
                        s = grown.link[s]
                    marks.add((s, k, item))
        size, n_states = len(self.vocab), len(grown.next)
        self.pairs = np.unique(np.fromiter((a * size + b for _, seq in numbered for a, b in zip(seq, seq[1:])), dtype=np.int64))
        self.link, self.len = array("i", grown.link), array("i", grown.len)
        key = np.fromiter((s * size + c for s, to in enumerate(grown.next) for c in to), dtype=np.int64)
        to = np.fromiter((q for to in grown.next for q in to.values()), dtype=np.int32)
        order = np.argsort(key)
        self.keys, self.to = array("q", key[order].tobytes()), array("i", to[order].tobytes())
        rows = sorted(marks)
        self.mark_k, self.mark_item = array("i", [k for _, k, _ in rows]), array("i", [i for _, _, i in rows])
        self.mark_at = array("i", np.searchsorted([s for s, _, _ in rows], np.arange(n_states + 1)).astype(np.int32).tobytes())
        # the nearest marked state above each state on its suffix links
        self.up = array("i", [-1]) * n_states
        for s in np.argsort(self.len, kind="stable").tolist()[1:]:
            p = self.link[s]
            self.up[s] = p if self.mark_at[p] < self.mark_at[p + 1] else self.up[p]

    @staticmethod
    def _limit(seq, span_words: int, item_coverage: float) -> int:
        return max(1, min(span_words, math.ceil(item_coverage * len(seq))))

    def stretches(self, h: np.ndarray, doc: np.ndarray):
        """(first word, word numbers) of each stretch that could hold a run that counts."""
        if not len(h) or not self.least:
            return
        size = len(self.vocab)
        i = np.minimum(np.searchsorted(self.vocab, h), size - 1)
        known = self.vocab[i] == h
        if len(self.pairs):
            pair = i[:-1] * size + i[1:]
            at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
            joined = known[:-1] & known[1:] & (doc[:-1] == doc[1:]) & (self.pairs[at] == pair)
        else:
            joined = np.zeros(len(h) - 1, dtype=bool)
        first = np.flatnonzero(known & ~np.concatenate(([False], joined)))
        last = np.flatnonzero(known & ~np.concatenate((joined, [False]))) + 1
        for a, b in zip(first.tolist(), last.tolist()):
            if b - a >= self.least:
                yield a, i[a:b].tolist()

    def _after(self, state: int, c: int) -> int:
        """The state behind a word, or -1."""
        key = state * len(self.vocab) + c
        at = bisect_left(self.keys, key)
        return self.to[at] if at < len(self.keys) and self.keys[at] == key else -1

    def stream(self, seq: list[int]):
        """(word, run length, item id) for each run that counts and ends at a word; and the longest match."""
        link, length, up, mark_at = self.link, self.len, self.up, self.mark_at
        v = n = longest = 0
        found = []
        for at, c in enumerate(seq):
            q = self._after(v, c)
            while v and q < 0:
                v = link[v]
                n = length[v]
                q = self._after(v, c)
            v, n = (q, n + 1) if q >= 0 else (0, 0)
            longest = max(longest, n)
            s = v if mark_at[v] < mark_at[v + 1] else up[v]
            while s > 0:
                for m in range(mark_at[s], mark_at[s + 1]):
                    if self.mark_k[m] <= n:
                        found.append((at, self.mark_k[m], self.names[self.mark_item[m]]))
                s = up[s]
        return found, longest


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def matches(auto: Automaton, doc: np.ndarray, h: np.ndarray) -> dict[int, tuple[list, set, int]]:
    """Per document with a hit: word spans, item ids, longest match."""
    start = {}
    first = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1]))) if len(doc) else []
    for f in first:
        start[int(doc[f])] = int(f)
    out: dict[int, tuple[list, set, int]] = {}
    for a, seq in auto.stretches(h, doc):
        found, longest = auto.stream(seq)
        if found:
            d = int(doc[a])
            spans, ids, most = out.get(d, ([], set(), 0))
            off = a - start[d]
            spans += _merged([(off + at - k + 1, off + at + 1) for at, k, _ in found])
            ids.update(i for _, _, i in found)
            out[d] = (_merged(spans), ids, max(most, longest))
    return out


def item_blocks(items: DataFrame, item_id: str, text: str, block_words: int):
    """Lists of (id, word hashes), a block at a time; a block has about ``block_words`` words."""
    n_words = F.regexp_count(F.col("text"), F.lit(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"))
    part = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("id"),
                        F.lower(F.col(text).cast("string")).alias("low"), F.col(text).cast("string").alias("text"))
    total = part.withColumn("text", F.col("low")).agg(F.sum(n_words)).first()[0] or 0
    n = max(1, math.ceil(total / block_words))
    for b in range(n):
        rows = part.filter(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == b).select("id", "text").collect()
        ids = [r["id"] for r in rows]
        _, _, _, _, doc, h = words(pa.array([r["text"] for r in rows], type=pa.string()))
        cut = np.searchsorted(doc, np.arange(len(ids) + 1))
        yield [(ids[i], h[cut[i]:cut[i + 1]]) for i in range(len(ids))]


NEW = [StructField("n_words", LongType()), StructField("spans", ArrayType(ArrayType(LongType()))),
       StructField("items", ArrayType(StringType())), StructField("longest", LongType())]


def find_spans(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
               span_words: int = SPAN_WORDS, item_coverage: float = ITEM_COVERAGE, block_words: int = BLOCK_WORDS,
               prefix: str = "", keep_text: bool = True) -> DataFrame:
    """Every input column (but the text, unless ``keep_text``), then, with ``prefix``, n_words, spans (word from, to),
    items and the longest match."""
    t, names = text, [prefix + f.name for f in NEW]
    fields = [f for f in docs.schema.fields if keep_text or f.name != t]
    schema = StructType([*fields, *(StructField(n, f.dataType) for n, f in zip(names, NEW))])
    context = docs.sparkSession.sparkContext
    # one by one, so that the driver grows one automaton at a time; each is bounded by block_words
    shared = [context.broadcast(Automaton(block, span_words, item_coverage))
              for block in item_blocks(items, item_id, item_text, block_words)]

    def run(batches):
        for batch in batches:
            for rb in A.slices(batch, t):
                _, _, _, _, doc, h = words(rb.column(t))
                n = rb.num_rows
                spans, ids, most = [[] for _ in range(n)], [[] for _ in range(n)], [0] * n
                for one in shared:
                    for d, (s, i, m) in matches(one.value, doc, h).items():
                        spans[d] = _merged([*spans[d], *s])
                        ids[d] = sorted(i.union(ids[d]))
                        most[d] = max(most[d], m)
                new = [pa.array(np.bincount(doc, minlength=n).astype(np.int64)),
                       pa.array([[list(x) for x in s] for s in spans], type=pa.list_(pa.list_(pa.int64()))),
                       pa.array(ids, type=pa.list_(pa.string())), pa.array(most, type=pa.int64())]
                yield pa.RecordBatch.from_arrays([*(rb.column(f.name) for f in fields), *new], names=schema.names)

    return docs.mapInArrow(A.released(run), schema)


def contamination_table(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """One row per document: id, n_words, n_hit, n_items, items_sha256, contaminated, longest match, hit share."""
    part = docs.select(F.col(id_col), F.col(text).cast("string").alias("text"))
    found = find_spans(part, items, "text", keep_text=False, **how)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + s[1] - s[0])
    return found.select(
        id_col, "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"), F.col("longest").alias("longest_match"),
        F.when(F.col("n_words") > 0, n_hit / F.col("n_words")).otherwise(F.lit(0.0)).alias("hit_share"))


def remove_spans(docs: DataFrame, items: DataFrame, text: str = "text", drop_share: float = DROP_SHARE, **how) -> DataFrame:
    """The documents (input's columns) with matching spans cut from ``text``; a cut leaves a line break.

    A document with more than ``drop_share`` of its words in such spans goes.
    """
    prefix = "_"
    while any(c.lower() == prefix + f.name for c in docs.columns for f in NEW):
        prefix += "_"
    found = find_spans(docs, items, text, prefix=prefix, **how)
    spans, n = F.col(f"{prefix}spans"), F.col(f"{prefix}n_words")
    hit = F.aggregate(spans, F.lit(0).cast("long"), lambda acc, s: acc + s[1] - s[0])
    return _cut(found.filter(hit <= F.lit(drop_share) * n), docs.columns, text, f"{prefix}spans")


def _cut(found: DataFrame, names: list[str], text: str, spans: str) -> DataFrame:
    t = text
    fields = [found.schema[n] for n in names]

    def run(batches):
        for rb in batches:
            new = rb.column(t)
            hit = np.flatnonzero(pa.compute.list_value_length(rb.column(spans)).to_numpy(zero_copy_only=False))
            if len(hit):
                out = new.to_pylist()
                for d in hit.tolist():
                    buf, _, starts, ends, _, _ = words(new.slice(d, 1))
                    raw, at, parts = buf.tobytes(), 0, []
                    for a, b in rb.column(spans)[d].as_py():
                        parts.append(raw[at:starts[a]])
                        at = int(ends[b - 1])
                    out[d] = b"\n".join([*parts, raw[at:]]).decode()
                new = pa.array(out, type=new.type)
            yield pa.RecordBatch.from_arrays([new if n == t else rb.column(n) for n in names], names=names)

    return found.select(*names, spans).mapInArrow(A.released(run), StructType(fields))
