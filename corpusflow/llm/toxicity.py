"""Toxicity by a subsequence string kernel, Nyström landmarks and a linear support vector machine.

Kernel. A unit is a lower-cased word (longer ones in overlapping windows of ``WINDOW`` bytes; a run of
one-letter words also counts as one unit, for spelled-out insults). Its features are all subsequences of
three bytes, edge marks included, with gaps of up to two bytes each; every skipped byte halves the
weight. So a word with inserted characters still shares most features with the plain one. The kernel is
the product of two units' (hashed) feature vectors, divided by the norms their lengths give.

Model. From the labelled texts of training rows Spark counts, per word, the groups of toxic and of other
texts that have it. Words that stand mostly in toxic texts are positive, others negative examples. If
no word has ``EVIDENCE`` (few toxic texts, or copies of few), every word that leans to toxic texts is positive and
weighs by its evidence; else only words with ``EVIDENCE`` are. ``landmarks`` of both kinds span the
Nyström space, in which a linear SVM (squared hinge) is fitted; clean words with the largest margins join
the examples and it is fitted again. Its weights fold back into one vector over the hashed features. A logistic link on a text's largest unit margin, the number of units near the SVM's
margin and the text's length gives the score.

Bounds. At most ``max_texts`` labelled rows (smallest hashes of their ids) train the model, at most
``max_words`` words of each kind are fetched. Every text is scored whole, in one scan without a shuffle.

Defined cases: null or empty text has no units and gets the score the link gives such a text; without
labelled rows of both kinds every score is the share of toxic rows (0 without any); null labels don't
train; repeated rows count as often as they stand; an empty table gives no rows. Extra columns are
ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.llm import arrays as A
from corpusflow.session import ensure_checkpoint_dir

BITS = 15
DECAY = 0.5
GAP = 3  # largest step between two bytes of a subsequence
WINDOW = 32
LANDMARKS = 1024
MINING = 2  # rounds in which the words of clean texts with the largest margins join the negative examples
MAX_TEXTS = 10_000
MAX_WORDS = 3000
THRESHOLD = 0.7
EVIDENCE = 20.0
LEAST_BYTES = 3
FLOOR = -3.0  # least margin, and that of a text without units
HIT = 0.75  # margin of a unit that counts
SEED = 7
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

_STEPS = [(a, b, DECAY ** (a + b - 2)) for a in range(1, GAP + 1) for b in range(1, GAP + 1)]
_NORM2 = np.array([sum(max(0, n - a - b) * w * w for a, b, w in _STEPS) for n in range(WINDOW + 3)])


def _marked(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all units with an edge mark at both ends, the unit of each byte, and the marked lengths."""
    size = ends - starts + 2
    stop = np.cumsum(size)
    out = np.zeros(int(stop[-1]) if len(stop) else 0, dtype=np.uint8)
    unit = np.repeat(np.arange(len(starts)), size)
    place = np.arange(len(out)) - np.repeat(stop - size, size)
    inner = (place > 0) & (place < np.repeat(size - 1, size))
    out[inner] = A.LOWER[buf[(np.repeat(starts, size) + place - 1)[inner]]]
    return out, unit, size


def _subsequences(out: np.ndarray, unit: np.ndarray):
    """(unit, feature, weight) arrays, one triple of arrays for each pair of steps."""
    x = out.astype(np.uint32)
    for a, b, w in _STEPS:
        n = len(x) - a - b
        if n <= 0:
            continue
        own = np.flatnonzero(unit[:n] == unit[a + b:])
        f = (x[own] << np.uint32(16)) | (x[own + a] << np.uint32(8)) | x[own + a + b]
        f = (f * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)
        yield unit[own], f.astype(np.int64), w


def vectors(units: list[bytes]) -> np.ndarray:
    """Normed feature vectors, one row per unit (a dense matrix: for landmarks and training words)."""
    ends = np.cumsum([len(u) for u in units]).astype(np.int64)
    starts = ends - np.array([len(u) for u in units], dtype=np.int64)
    out, unit, size = _marked(np.frombuffer(b"".join(units), dtype=np.uint8), starts, ends)
    m = np.zeros((len(units), 1 << BITS), dtype=np.float32)
    for u, f, w in _subsequences(out, unit):
        np.add.at(m, (u, f), np.float32(w))
    return m / np.sqrt(np.maximum(_NORM2[size], 1e-9))[:, None].astype(np.float32)


def units_of(col: pa.Array):
    """Bytes, starts, ends and document numbers of all units of a column of texts."""
    buf, offs = A.text_bytes(col)
    starts, ends, doc = A.runs(A.NOT_SPACE[buf], offs)
    # runs of three or more one-letter words of a document, without the spaces between them, stand behind the text
    more_buf, more_s, more_e, more_d = [], [], [], []
    letter = np.flatnonzero(ends - starts == 1)
    step = WINDOW // 2  # windows overlap by half
    for run in np.split(letter, np.flatnonzero((np.diff(letter) != 1) | (np.diff(doc[letter]) != 0)) + 1):
        for lo in range(0, max(1, len(run) - step), step) if len(run) >= 3 else ():
            part = run[lo:lo + WINDOW]
            at = len(buf) + sum(map(len, more_buf))
            more_buf.append(buf[starts[part]])
            more_s.append(at)
            more_e.append(at + len(part))
            more_d.append(doc[part[0]])
    long = np.flatnonzero(ends - starts > WINDOW)
    if len(long):
        for i in long.tolist():
            for a in range(int(starts[i]), int(ends[i]) - WINDOW // 2, WINDOW // 2):
                more_s.append(a)
                more_e.append(min(a + WINDOW, int(ends[i])))
                more_d.append(doc[i])
        ok = ends - starts <= WINDOW
        starts, ends, doc = starts[ok], ends[ok], doc[ok]
    if more_s:
        buf = np.concatenate([buf, *more_buf])
        starts, ends, doc = (np.concatenate([x, np.array(y, dtype=np.int64)]) for x, y in
                             ((starts, more_s), (ends, more_e), (doc, more_d)))
    return buf, starts, ends, doc


def unit_margins(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, weights: np.ndarray, bias: float) -> np.ndarray:
    """Margin of each unit (of ``WINDOW`` bytes at most); shorter than ``LEAST_BYTES`` it has too few features to judge."""
    marked, unit, size = _marked(buf, starts, ends)
    margin = np.zeros(len(starts))
    for u, f, w in _subsequences(marked, unit):
        margin += np.bincount(u, weights=weights[f] * w, minlength=len(starts))
    margin = margin / np.sqrt(np.maximum(_NORM2[size], 1e-9)) + bias
    return np.where(ends - starts >= LEAST_BYTES, margin, FLOOR)


def text_features(col: pa.Array, weights: np.ndarray, bias: float) -> np.ndarray:
    """Per text: largest unit margin, log of the number of units above ``HIT``, log of the number of units."""
    buf, starts, ends, doc = units_of(col)
    n = len(col)
    out = np.zeros((n, 3))
    out[:, 0] = FLOOR
    if not len(starts):
        return out
    _, first, which = np.unique(A.span_hashes(buf, starts, ends, lower=True), return_index=True, return_inverse=True)
    margin = unit_margins(buf, starts[first], ends[first], weights, bias)[which]
    top = np.full(n, FLOOR)
    np.maximum.at(top, doc, np.maximum(margin, FLOOR))
    out[:, 0] = top
    out[:, 1] = np.log1p(np.bincount(doc[margin > HIT], minlength=n))
    out[:, 2] = np.log1p(np.bincount(doc, minlength=n))
    return out


def _svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = 1e-5, steps: int = 50) -> tuple[np.ndarray, float]:
    """Linear SVM (squared hinge) by Newton steps: a ridge solution on the examples inside the margin."""
    x1 = np.column_stack([x, np.ones(len(x))])
    ridge = penalty * np.eye(x1.shape[1])
    ridge[-1, -1] = 1e-9
    w, active = np.zeros(x1.shape[1]), np.zeros(len(x), dtype=bool)
    for _ in range(steps):
        now = y * (x1 @ w) < 1
        if (now == active).all():
            break
        active = now
        xa, c = x1[active], weight[active]
        w = np.linalg.solve((xa * c[:, None]).T @ xa + ridge, xa.T @ (c * y[active]))
    return w[:-1], float(w[-1])


def _logistic(x: np.ndarray, y: np.ndarray, steps: int = 50) -> np.ndarray:
    """Logistic regression with a small ridge, by Newton steps; the last weight is the bias."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hess = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(x.shape[1])
        step = np.linalg.solve(hess, x.T @ (y - p) - 1e-2 * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _largest(words: DataFrame, weights: np.ndarray, bias: float, n: int) -> list:
    """The ``n`` (w, q) with the largest margins."""
    def run(batches):
        for batch in batches:
            buf, offs = A.text_bytes(batch.column("w"))
            if batch.num_rows:
                m = unit_margins(buf, offs[:-1], offs[1:], weights, bias)
                yield pa.RecordBatch.from_arrays([batch.column("w"), batch.column("q"), pa.array(np.round(m, 9))], names=["w", "q", "m"])

    return words.mapInArrow(run, "w string, q long, m double").orderBy(F.desc("m"), "w").limit(n).collect()


def fit(train: DataFrame, landmarks: int = LANDMARKS, max_words: int = MAX_WORDS) -> dict:
    """Model from a bounded table (text, toxic): hashed feature weights, bias and the link's weights."""
    ensure_checkpoint_dir(train.sparkSession)
    t = train.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.col("toxic").cast("int").alias("y"))
    words = F.filter(F.split(F.translate("text", _UPPER, _UPPER.lower()), r"[\x20\x09-\x0D]+"), lambda x: x != "")
    t = t.filter("y is not null").withColumn("ws", words).checkpoint()  # the bounded table, its words cut once
    n, pos = t.agg(F.count(F.lit(1)), F.coalesce(F.sum("y"), F.lit(0))).first()
    share = pos / n if n else 0.0
    empty = {"weights": np.zeros(1 << BITS), "bias": 0.0, "link": np.zeros(4), "share": share}
    if not n or pos in (0, n):
        return empty
    # a word counts once for each group of texts with one smallest word-pair hash: most copies, near ones too, count once
    pair = F.transform("ws", lambda w, i: F.xxhash64(w, F.get("ws", i + 1)))
    t = t.withColumn("group", F.array_min(pair))
    word = (t.select("y", "group", F.explode(F.array_distinct("ws")).alias("w")).filter(F.octet_length("w").between(LEAST_BYTES, WINDOW)).distinct())
    count = word.groupBy("w").agg(F.sum("y").alias("p"), F.sum(1 - F.col("y")).alias("q")).checkpoint()
    groups = t.filter("group IS NOT NULL").select("y", "group").distinct().groupBy("y").count().collect()
    pos, neg = (sum(r["count"] for r in groups if r["y"] == y) for y in (1, 0))
    n = pos + neg
    ratio = (F.col("p") + 0.5) / (pos + 1.0) / ((F.col("q") + 0.5) / (n - pos + 1.0))
    # half the likelihood-ratio statistic: past EVIDENCE not one word in a billion gets there by chance
    good = (count.withColumn("s", F.round(F.col("p") * F.log(ratio), 6))
            .filter((F.col("p") >= 1) & (ratio > 1) & ((F.col("s") >= EVIDENCE) | (ratio > 2)))
            .orderBy(F.desc("s"), "w").limit(max_words).collect())
    good = [r for r in good if r["s"] >= EVIDENCE] or good
    clean = count.filter((F.col("q") >= 1) & (ratio <= 2)).select("w", "q")
    bad = clean.withColumn("s", F.xxhash64("w")).orderBy("s", "w").limit(max_words // 2).collect()
    bad += clean.orderBy(F.desc("q"), "w").limit(max_words // 2).collect()
    if not good or not bad:
        return empty
    half = landmarks // 2
    spread = [np.unique(np.linspace(0, len(x) - 1, min(half, len(x))).astype(int)) for x in (good, bad)]
    marks = vectors([x[i]["w"].encode() for x, at in zip((good, bad), spread) for i in at])
    value, vector = np.linalg.eigh((marks @ marks.T).astype(np.float64))
    keep = value > 1e-6 * value.max()
    root = vector[:, keep] / np.sqrt(value[keep])

    def mapped(words: list[str]) -> np.ndarray:
        """Nyström coordinates."""
        parts = [vectors([w.encode() for w in words[i:i + 250]]) @ marks.T for i in range(0, len(words), 250)]
        return np.concatenate(parts).astype(np.float64) @ root

    z_good = mapped([r["w"] for r in good])
    p = np.array([r["p"] * min(1.0, r["s"] / EVIDENCE) ** 4 for r in good])  # its root is the weight
    z_bad, q, taken = mapped([r["w"] for r in bad]), np.array([float(r["q"]) for r in bad]), {r["w"] for r in bad}
    for left in range(MINING, -1, -1):
        weight = np.concatenate([np.sqrt(p) / np.sqrt(p).sum(), np.sqrt(q) / np.sqrt(q).sum()])
        y = np.concatenate([np.ones(len(p)), -np.ones(len(q))])
        w, bias = _svm(np.concatenate([z_good, z_bad]), y, weight)
        weights = (marks.T @ (root @ w).astype(np.float32)).astype(np.float64)
        if left:
            hard = [r for r in _largest(clean, weights, bias, max_words // 2) if r["w"] not in taken]
            if not hard:
                break
            taken |= {r["w"] for r in hard}
            z_bad = np.concatenate([z_bad, mapped([r["w"] for r in hard])])
            q = np.concatenate([q, [float(r["q"]) for r in hard]])

    def link_rows(batches):
        for batch in batches:
            for rb in A.slices(batch, "text"):
                f = text_features(rb.column("text"), weights, bias)
                yield pa.RecordBatch.from_arrays([*(pa.array(f[:, j]) for j in range(3)), rb.column("y")],
                                                 names=["a", "b", "c", "y"])

    got = t.select("text", "y").mapInArrow(link_rows, "a double, b double, c double, y int").orderBy("a", "b", "c", "y").toArrow()
    x = np.column_stack([got[c].to_numpy() for c in "abc"])
    return {"weights": weights, "bias": bias, "link": _logistic(x, got["y"].to_numpy().astype(float)), "share": share}


def score(docs: DataFrame, model: dict, id_col: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(id, score, predicted) of every text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2**BITS weights
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        m = shared.value
        for batch in batches:
            for rb in A.slices(batch, "text"):
                if m["link"].any():
                    x = text_features(rb.column("text"), m["weights"], m["bias"])
                    s = 1 / (1 + np.exp(-np.clip(x @ m["link"][:3] + m["link"][3], -30, 30)))
                else:
                    s = np.full(rb.num_rows, float(m["share"]))
                s = np.round(s, 9)
                yield pa.RecordBatch.from_arrays([rb.column("id"), pa.array(s), pa.array((s >= threshold).astype(np.int32))],
                                                 names=["id", "score", "predicted"])

    part = docs.select(F.col(id_col).alias("id"), F.col(text).cast("string").alias("text"))
    return part.mapInArrow(run, f"id {kind}, score double, predicted int").withColumnRenamed("id", id_col)


def held_out(id_col: str = "doc_id", folds: int = 3, fold: int = 1):
    """Whether a row is never trained on: crc32 of its id as text, modulo ``folds``."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % folds == fold


def toxicity_table(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text",
                   max_texts: int = MAX_TEXTS, **how) -> DataFrame:
    """One row per document: id, held_out, score, predicted; labels of held-out rows are never used."""
    known = labels.select(F.col(id_col), F.col("toxic")).filter(~held_out(id_col) & F.col("toxic").isNotNull())
    known = known.orderBy(F.xxhash64(F.lit(SEED), id_col), id_col, "toxic").limit(max_texts)
    # at most max_texts rows of an id and a label: broadcast, so that texts are not shuffled
    train = docs.select(id_col, text).join(F.broadcast(known), id_col).select(F.col(text).alias("text"), "toxic")
    out = score(docs, fit(train, **how), id_col, text)
    return out.select(id_col, held_out(id_col).alias("held_out"), "score", "predicted")
