"""Quality rules by n-gram perplexity: a modified Kneser-Ney model over the bytes of words.

Model. Each word is a sequence BEGIN, bytes, END; every byte and END is predicted from up to three
symbols before it (order 4, never over a word's edge). Spark counts the n-grams of *all* documents
together (a document may mix languages); lower orders use continuation counts; the three discounts
come from the counts of counts of each order. Probabilities and back-off weights are computed as
DataFrames and kept as sorted arrays of exact keys: an n-gram's bytes are its number, a perfect hash. Orders 1 to 3
and all contexts have at most 2^24 keys whatever the corpus, so these arrays may be broadcast. Of order 4
the most frequent n-grams are broadcast, ``limit`` of them at most; the others, if there are any, stay a
table. A missing n-gram is then backed off in the scan, and the difference for those in the table
is joined on the n-gram and added per text. As each n-gram there stands for less than a ``limit / 2``-th
of all symbols, that join has no hot key.

Verdict. A document's perplexity is ``exp(-mean log p)`` over its symbols. Per language, the
quartiles of log perplexity over the distinct texts that pass the base rules give the band
``[q1 - k * spread, q3 + k * spread]``; documents outside are rejected. Exact copies count once
there (near copies each count), and the spread is at least ``LEAST_SPREAD``.

Defined cases: a null text has no words; a null language is its own language; no words gives a null
perplexity and fails the base rule; a table without rows gives no rows. Extra columns are ignored
by ``quality_table`` and kept by ``quality_filter``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StructField, StructType

from corpusflow.llm import arrays as A
from corpusflow.session import ensure_checkpoint_dir

BEGIN, END = 0x20, 0x0A
ORDER = 4
VOCAB = 256
LIMIT = 1 << 22
BAND = 3.0
LEAST_SPREAD = 0.02  # below the 0.024 to 0.05 of the fixture's languages
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
FLUSH = 1 << 21

_SYMBOLS = np.zeros(256, dtype=bool)
_SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True


def _grams(buf, offs):
    """The longest n-gram that predicts each symbol, and the symbol's document."""
    keep = A.NOT_SPACE[buf]
    starts, ends, doc = A.runs(keep, offs)
    if not len(starts):
        return np.zeros(0, dtype=np.uint32), np.zeros(0, dtype=np.int64)
    size = ends - starts + 2
    stop = np.cumsum(size)
    begin = stop - size
    out = np.zeros(stop[-1], dtype=np.uint32)
    inner = np.ones(stop[-1], dtype=bool)
    inner[begin] = inner[stop - 1] = False
    out[inner] = buf[keep]
    out[begin], out[stop - 1] = BEGIN, END
    g = out.copy()
    for back in range(1, ORDER):
        g[back:] |= out[:-back] << np.uint32(8 * back)
    for depth in range(1, ORDER - 1):  # near the word's begin the n-gram is shorter
        at = begin + depth
        g[at[at < stop]] &= np.uint32((1 << 8 * (depth + 1)) - 1)
    predicted = np.ones(stop[-1], dtype=bool)
    predicted[begin] = False
    return g[predicted], np.repeat(doc, size)[predicted]


def _sums(keys: list, counts: list) -> tuple[np.ndarray, np.ndarray]:
    k, c = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(k, kind="stable")
    k, c = k[order], c[order]
    first = np.flatnonzero(np.r_[True, k[1:] != k[:-1]]) if len(k) else np.zeros(0, dtype=np.int64)
    return k[first], np.add.reduceat(c, first) if len(k) else c


def ngram_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(g, n): each n-gram, four bytes in a number, and its count over all documents; summed per task before the shuffle."""
    t = text

    def run(batches):
        keys, counts, held = [], [], 0

        def out():
            k, c = _sums(keys, counts)
            return pa.RecordBatch.from_arrays([pa.array(k.astype(np.int64)), pa.array(c)], names=["g", "n"])

        for batch in batches:
            for rb in A.slices(batch, t):
                g, _ = _grams(*A.text_bytes(rb.column(t)))
                if not len(g):
                    continue
                g.sort()
                first = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
                keys.append(g[first])
                counts.append(np.diff(np.r_[first, len(g)]))
                held += len(first)
                if held > FLUSH:
                    k, c = _sums(keys, counts)
                    keys, counts, held = [k], [c], len(k)
                    if held > FLUSH // 2:
                        yield out()
                        keys, counts, held = [], [], 0
        if keys:
            yield out()

    part = docs.select(F.col(t).cast("string").alias(t))
    return part.mapInArrow(A.released(run), "g long, n long").groupBy("g").agg(F.sum("n").alias("n"))


def _arrays(df: DataFrame, key: str, value: str) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys and log values of a table of bounded size."""
    arr = df.select(F.col(key).alias("x"), F.col(value).cast("float").alias("v")).toArrow()
    x, v = arr["x"].to_numpy(), arr["v"].to_numpy()
    order = np.argsort(x)
    return x[order].astype(np.uint32), _log(v[order])


def _log(p: np.ndarray) -> np.ndarray:
    return np.log(np.maximum(p.astype(np.float32), np.float32(1e-12))).astype(np.float32)


def _frequent(probs: DataFrame, limit: int) -> int:
    """Smallest power of two such that at most ``limit`` n-grams are that frequent."""
    levels = {r["e"]: r["n"] for r in probs.groupBy(F.floor(F.log2(F.col("n") + F.lit(0.5))).alias("e")).agg(F.count(F.lit(1)).alias("n")).collect()}
    least, held = max(levels, default=0) + 1, 0
    while least > 0 and held + levels.get(least - 1, 0) <= limit:
        least -= 1
        held += levels.get(least, 0)
    return 1 << least


def kneser_ney(counts: DataFrame, limit: int = LIMIT) -> tuple[dict, DataFrame | None]:
    """Arrays of the model from the counts, and the table (g, p) of the n-grams of order 4 beyond ``limit``, if any."""
    raw = counts.withColumn("k", F.when(F.shiftright("g", 8) == BEGIN, 2).when(F.shiftright("g", 16) == BEGIN, 3)
                            .otherwise(ORDER))
    types = {ORDER: raw.filter(F.col("k") == ORDER).select("g", "n")}
    for k in range(ORDER - 1, 0, -1):
        cont = types[k + 1].groupBy(F.col("g").bitwiseAND(F.lit((1 << 8 * k) - 1)).alias("g")).agg(
            F.count(F.lit(1)).alias("n"))
        types[k] = cont if k == 1 else cont.unionByName(raw.filter(F.col("k") == k).select("g", "n"))
    model, lower = {}, None
    for k in range(1, ORDER + 1):
        c = types[k].agg(*[F.count(F.when(F.col("n") == i, 1)).alias(f"c{i}") for i in range(1, 5)]).first()
        y = c[0] / max(1, c[0] + 2 * c[1])
        d = [min(i, max(0.0, i - (i + 1) * y * c[i] / c[i - 1])) if c[i - 1] and c[i] else i / 2 for i in (1, 2, 3)]
        off = F.when(F.col("n") == 1, d[0]).when(F.col("n") == 2, d[1]).otherwise(d[2])
        t = types[k].select("g", "n", off.alias("d"), F.shiftright("g", 8).alias("h"))
        ctx = t.groupBy("h").agg(F.sum("n").alias("total"), (F.sum("d") / F.sum("n")).alias("gamma"))
        t = t.join(ctx, "h")
        own = (F.col("n") - F.col("d")) / F.col("total")
        if k == 1:
            probs = t.select("g", "n", (own + F.col("gamma") / VOCAB).alias("p"))
        else:
            low = lower.select(F.col("g").alias("s"), F.col("p").alias("q"))
            t = t.withColumn("s", F.col("g").bitwiseAND(F.lit((1 << 8 * (k - 1)) - 1)))
            probs = t.join(low, "s").select("g", "n", (own + F.col("gamma") * F.col("q")).alias("p"))
        probs = probs.checkpoint()
        least = _frequent(probs, limit) if k == ORDER else 1
        model[f"p{k}"] = _arrays(probs.filter(F.col("n") >= least), "g", "p")
        model[f"b{k}"] = _arrays(ctx, "h", "gamma")
        lower = probs
    return model, lower.filter(F.col("n") < least).select("g", "p") if least > 1 else None


def fit(docs: DataFrame, text: str = "text", limit: int = LIMIT) -> tuple[dict, DataFrame | None]:
    """Model of all documents."""
    ensure_checkpoint_dir(docs.sparkSession)
    return kneser_ney(ngram_counts(docs, text).checkpoint(), limit)


def log_probs(keys: np.ndarray, model: dict) -> np.ndarray:
    """log p of distinct n-grams: the longest suffix that the model has, times the back-off weights above it."""
    order = np.where(keys >> np.uint32(8) == BEGIN, 2, np.where(keys >> np.uint32(16) == BEGIN, 3, ORDER))
    logp, open_ = np.zeros(len(keys)), np.ones(len(keys), dtype=bool)

    def look(name, grams):
        have, val = model[name]
        i = np.minimum(np.searchsorted(have, grams), max(len(have) - 1, 0))
        return (have[i] == grams, val[i]) if len(have) else (np.zeros(len(grams), dtype=bool), np.zeros(len(grams)))

    for k in range(ORDER, 0, -1):
        at = np.flatnonzero(open_ & (order >= k))
        s = keys[at] & np.uint32((1 << 8 * k) - 1)
        hit, val = look(f"p{k}", s)
        logp[at[hit]] += val[hit]
        open_[at[hit]] = False
        miss = at[~hit]
        known, weight = look(f"b{k}", s[~hit] >> np.uint32(8))
        logp[miss[known]] += weight[known]
    logp[open_] += np.log(1 / VOCAB)
    return logp


def rule_arrays(buf: np.ndarray, offs: np.ndarray) -> dict[str, np.ndarray]:
    """Base counts of each document: words, code points in words, symbols, repeated lines, words in repeated 3-word windows."""
    n = len(offs) - 1
    keep = A.NOT_SPACE[buf]
    starts, ends, doc = A.runs(keep, offs)
    n_words = np.bincount(doc, minlength=n)

    def per_doc(mask):
        total = np.concatenate(([0], np.cumsum(mask)))
        return total[offs[1:]] - total[offs[:-1]]

    out = {"n_words": n_words, "word_chars": per_doc(keep & ((buf & 0xC0) != 0x80)), "n_symbols": per_doc(_SYMBOLS[buf])}
    # lines that hold a word, and how many of them are distinct
    ls, le, ld = A.runs(buf != 0x0A, offs)
    i = np.searchsorted(starts, ls)
    full = (i < len(starts)) & (starts[np.minimum(i, len(starts) - 1)] < le) if len(starts) else np.zeros(len(ls), bool)
    ls, le, ld = ls[full], le[full], ld[full]
    own = np.unique(A.span_hashes(buf, ls, le) ^ A.mix(ld), return_index=True)[1]
    out["n_dup_lines"] = np.bincount(ld, minlength=n) - np.bincount(ld[own], minlength=n)
    h = A.window_hashes(A.span_hashes(buf, starts, ends), 3)
    whole = np.flatnonzero(A.whole_windows(doc, 3))
    _, which, count = np.unique(h[whole] ^ A.mix(doc[whole]), return_inverse=True, return_counts=True)
    again = A.covered(whole[count[which] > 1], 3, len(starts))
    out["n_repeat_words"] = np.bincount(doc[again], minlength=n)
    return out


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _differences(docs: DataFrame, shared, tail: DataFrame, text: str) -> DataFrame:
    """(h, more): per distinct text's sha256, what the n-grams in ``tail`` add to its sum of log p."""
    t = text
    texts = docs.select(F.col(t).cast("string").alias(t)).filter(F.col(t).isNotNull()).withColumn("h", F.sha2(F.col(t).cast("binary"), 256))

    def missing(batches):
        have = shared.value["p4"][0]
        for batch in batches:
            for rb in A.slices(batch, t):
                g, doc = _grams(*A.text_bytes(rb.column(t)))
                full = (g >> np.uint32(16) != BEGIN) & (g >> np.uint32(8) != BEGIN)
                i = np.minimum(np.searchsorted(have, g), max(len(have) - 1, 0))
                full &= have[i] != g if len(have) else True
                key, n = np.unique(doc[full].astype(np.int64) << 32 | g[full], return_counts=True)
                yield pa.RecordBatch.from_arrays([rb.column("h").take(pa.array(key >> 32)), pa.array(key & 0xFFFFFFFF), pa.array(n)],
                                                 names=["h", "g", "n"])

    def weigh(batches):
        for b in batches:
            g, p, n = (b.column(c).to_numpy() for c in ("g", "p", "n"))
            more = n * (_log(p) - log_probs(g.astype(np.uint32), shared.value))
            yield pa.RecordBatch.from_arrays([b.column("h"), pa.array(more.astype(np.float64))], names=["h", "more"])

    some = texts.dropDuplicates(["h"]).mapInArrow(A.released(missing), "h string, g long, n long")
    return some.join(tail, "g").select("h", "g", "n", "p").mapInArrow(A.released(weigh), "h string, more double").groupBy("h").agg(F.sum("more").alias("more"))


def measure(docs: DataFrame, model: tuple[dict, DataFrame | None], text: str = "text", prefix: str = "") -> DataFrame:
    """Every input column, and per document the base counts, ``base_failed`` and ``log_ppl``, with ``prefix``."""
    arrays, tail = model
    shared = docs.sparkSession.sparkContext.broadcast(arrays)  # LIMIT n-grams of order 4, 2^24 keys at most in each other array
    t = text
    cols = [f"{prefix}{c}" for c in (*MEASURES, "base_failed", "log_sum", "symbols")]
    schema = StructType([*docs.schema.fields, *(StructField(c, LongType()) for c in cols[:5]),
                         StructField(cols[5], BooleanType()), StructField(cols[6], DoubleType()), StructField(cols[7], LongType())])

    def run(batches):
        m = shared.value
        for batch in batches:
            for rb in A.slices(batch, t):
                buf, offs = A.text_bytes(rb.column(t))
                got = rule_arrays(buf, offs)
                g, doc = _grams(buf, offs)
                own = np.unique(g)
                lp = log_probs(own, m)[np.searchsorted(own, g)]
                symbols = np.bincount(doc, minlength=rb.num_rows)
                total = np.bincount(doc, weights=lp, minlength=rb.num_rows).astype(np.float64)
                nw = got["n_words"]
                failed = (nw < MIN_WORDS) | (100 * got["n_repeat_words"] > MAX_REPEAT_PERCENT * nw)
                new = [pa.array(got[c].astype(np.int64)) for c in MEASURES]
                new += [pa.array(failed), pa.array(total), pa.array(symbols.astype(np.int64))]
                yield pa.RecordBatch.from_arrays([*rb.columns, *new], names=[*rb.schema.names, *cols])

    out, total = docs.mapInArrow(A.released(run), schema), F.col(cols[6])
    h, more = f"{prefix}h", f"{prefix}more"
    if tail is not None:
        add = _differences(docs, shared, tail, t).select(F.col("h").alias(h), F.col("more").alias(more))
        out = out.join(add, F.sha2(F.col(t).cast("string").cast("binary"), 256) == F.col(h), "left")
        total = total + F.coalesce(more, F.lit(0.0))
    log_ppl = F.when(F.col(cols[7]) > 0, F.round(-total / F.col(cols[7]), 3)).alias(f"{prefix}log_ppl")
    return out.select(*docs.columns, *cols[:6], log_ppl)


def bands(measured: DataFrame, lang: str = "lang", k: float = BAND, text_hash: str = "text_hash") -> DataFrame:
    """(lang, low, high) of log perplexity, from the quartiles of distinct texts that pass the base rules.

    log perplexity has three decimals, so the exact percentiles need a bounded number of counters.
    """
    once = (measured.filter(~F.col("base_failed") & F.col("log_ppl").isNotNull())
            .select(F.col(lang).alias("lang"), text_hash, "log_ppl").dropDuplicates(["lang", text_hash]))
    q = once.groupBy("lang").agg(F.percentile("log_ppl", F.array(F.lit(0.25), F.lit(0.75))).alias("q"))
    spread = F.greatest(F.col("q")[1] - F.col("q")[0], F.lit(LEAST_SPREAD))
    return q.select("lang", (F.col("q")[0] - k * spread).alias("low"), (F.col("q")[1] + k * spread).alias("high"))


def _judge(measured: DataFrame, limits: DataFrame, lang: str) -> DataFrame:
    # one row per language
    return (measured.join(limits.select(F.col("lang").alias("_lang"), "low", "high"),
                          F.col(lang).eqNullSafe(F.col("_lang")), "left").drop("_lang")
            .withColumn("kept", F.coalesce(~F.col("base_failed") & F.col("log_ppl").between(F.col("low"), F.col("high")),
                                           F.lit(False))))


def quality_table(docs: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang",
                  limit: int = LIMIT, k: float = BAND) -> DataFrame:
    """One row per document: its id, the base counts, ``base_failed``, ``kept``, ``perplexity``, ``low``, ``high``."""
    part = docs.select(F.col(id_col).alias("doc_id"), F.col(text).cast("string").alias("text"),
                       F.col(lang).cast("string").alias("lang")).withColumn("text_hash", F.xxhash64("text"))
    measured = measure(part, fit(part, limit=limit)).drop("text").checkpoint()
    judged = _judge(measured, bands(measured, k=k), "lang")
    return judged.select("doc_id", *MEASURES, "base_failed", "kept", F.exp("log_ppl").alias("perplexity"),
                         F.exp("low").alias("low"), F.exp("high").alias("high"))


def quality_filter(docs: DataFrame, text: str = "text", lang: str = "lang", limit: int = LIMIT,
                   k: float = BAND) -> DataFrame:
    """The documents that ``quality_table`` keeps, with the input's columns.

    Texts are not written in between: the bands come from a narrow table, and the documents are
    measured again as they are filtered.
    """
    part = docs.select(F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang"))
    part = part.withColumn("text_hash", F.xxhash64("text"))
    model = fit(part, limit=limit)
    limits = bands(measure(part, model).drop("text").checkpoint(), k=k).collect()  # a row per language
    prefix = "_q_"
    while any(c.lower().startswith(prefix) for c in docs.columns):
        prefix = "_" + prefix
    m = measure(docs, model, text, prefix)
    lp, ok = F.col(f"{prefix}log_ppl"), F.lit(False)
    for r in limits:
        ok = ok | (F.col(lang).cast("string").eqNullSafe(F.lit(r["lang"])) & lp.between(r["low"], r["high"]))
    return m.filter(~F.col(f"{prefix}base_failed") & F.coalesce(ok, F.lit(False))).select(*docs.columns)
