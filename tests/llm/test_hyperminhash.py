import collections
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusflow.llm import hyperminhash as H


def brute(rows):
    """id -> (set size, smallest id reachable), over all pairs."""
    sets = []
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
        sets.append(frozenset(zip(*[w[k:] for k in range(5)])) if len(w) >= 5 else frozenset([tuple(w)] if w else []))
    top = list(range(len(rows)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    having = collections.defaultdict(list)
    for n, s in enumerate(sets):
        for x in s:
            having[x].append(n)
    both = collections.Counter((a, b) for v in having.values() for k, b in enumerate(v) for a in v[:k])
    for (a, b), n in both.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            top[find(a)] = find(b)
    least = {}
    for n, (i, _) in enumerate(rows):
        if sets[n] and i is not None:
            least[find(n)] = min(i, least.get(find(n), i))
    return [(i, len(sets[n]), least.get(find(n)) if sets[n] else i) for n, (i, _) in enumerate(rows)]


def _check(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in H.near_duplicates(docs).collect()]
    assert sorted(map(str, got)) == sorted(map(str, brute(rows)))


def test_fixture_matches_brute_force(spark, sf):
    _check(spark, [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()])


def test_planted_chains_and_copies(spark):
    rng = random.Random(5)
    rows, n = [], 0
    for size in (3, 5, 6, 12, 40, 150, 400, 900):
        words = [f"w{rng.randrange(10**6)}" for _ in range(size)]
        for _ in range(8):  # each version edits the one before it a little
            rows.append((n, " ".join(words)))
            rows.append((n + 5000, " ".join(words).upper()))
            n += 1
            for _ in range(max(1, size // 60)):
                words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    shared = " ".join(f"p{i}" for i in range(60))  # a passage that many texts share
    rows += [(9000 + i, " ".join(f"x{rng.randrange(10**6)}" for _ in range(150)) + " " + shared) for i in range(60)]
    rng.shuffle(rows)
    _check(spark, rows)


def test_odd_rows(spark, odd_docs, no_docs, rows_of):
    rows = [tuple(r) for r in odd_docs.select("doc_id", "text").collect()]
    got = H.near_duplicates(odd_docs)
    assert sorted(str((r[0], r[1], r[2])) for r in got.collect()) == sorted(map(str, brute(rows)))
    kept = H.drop_near_duplicates(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = sorted((r["doc_id"] for r in kept.collect()))
    # 5 stands for both rows 5, 6, the null id and 12; texts without words stay
    assert ids == [1, 2, 3, 4, 5, 7, 9, 10, 11]
    assert H.near_duplicates(no_docs).count() == 0 and H.drop_near_duplicates(no_docs).count() == 0
    assert rows_of(H.drop_near_duplicates(kept)) == rows_of(kept)


def test_registers_and_estimate():
    values = np.array([1, 2**63, 2**64 - 1, 2**40 + 12345, 3], dtype=np.uint64)
    zeros = [64 - int(v).bit_length() for v in values]
    assert (H.compress(values) >> 10).tolist() == zeros
    rng = np.random.default_rng(1)
    for j in (0.2, 0.5, 0.8):
        n = 4000
        common = rng.integers(0, 2**63, int(n * j)).astype(np.uint64)
        a, b = (np.concatenate([common, rng.integers(0, 2**63, int(n * (1 - j) / 2)).astype(np.uint64)]) for _ in "ab")
        regs = [H.registers(x * np.uint64(2), np.zeros(len(x), dtype=np.int64), 1, 336) for x in (a, b)]
        assert H.jaccard_estimate(*regs)[0] == pytest.approx(j, abs=0.12)


@pytest.mark.parametrize("common, total", [(3, 4), (6, 8), (15, 20), (30, 40), (41, 51), (75, 100)])
def test_small_sets_share_a_band(common, total):
    rng, n, own = np.random.default_rng(total), 500, (total - common) // 2
    x = rng.integers(0, 2**63, (n, total)).astype(np.uint64) * np.uint64(2)
    sides = x[:, :common + own], np.concatenate([x[:, :common], x[:, common + own:]], axis=1)
    a, b = (H.band_keys(H.registers(s.ravel(), np.repeat(np.arange(n), s.shape[1]), n, 336), H.BANDS, H.ROWS) for s in sides)
    same = (a == b).sum(axis=1)
    assert same.min() > 0
    assert same.mean() == pytest.approx(H.BANDS * (common / total) ** H.ROWS, rel=0.1)
    assert same.std() < 4  # as of independent bands


def test_components_of_long_paths(spark):
    edges = [(i, i + 1) for i in range(200)] + [(500, 700), (700, 600)]
    got = dict((r["node"], r["label"]) for r in H.components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {i: 0 for i in range(1, 201)} | {700: 500, 600: 500}


def test_short_texts_are_one_shingle():
    sh, sd = H.shingle_sets(pa.array(["a b", "A  b", "b a", "a b c d", "", None, "a b c d e f"]))
    assert sd.tolist() == [0, 1, 2, 3, 6, 6]
    assert sh[0] == sh[1] != sh[2]


def test_a_large_group_with_strays_is_linear(spark):
    # a bucket of 20,000 members: one label but for three, one of them near the group; another of two large labels
    rng = np.random.default_rng(2)
    words = H.SET_BITS // 64
    base = rng.integers(0, 1 << 62, words)
    rows = [(1, n, -5 if n < 19_997 else n) for n in range(20_000)] + [(2, n, -7 if n < 700 else -8) for n in range(1400)]
    lab = spark.createDataFrame(rows, "key long, node long, label long").withColumn("m", F.when(F.col("key") == 1, 20_000).otherwise(1400).cast("long"))
    far = rng.integers(0, 1 << 62, words)
    tables = spark.createDataFrame([(n, 500, [int(x) for x in (far if n in (19_998, 19_999) else base)]) for n in range(20_000)],
                                   "node long, n long, bits array<long>")
    block = H._blocks(lab, tables).checkpoint()
    pairs = H.block_pairs(block).groupBy("key").count().collect()
    n = {r["key"]: r["count"] for r in pairs}
    blocks = {r["key"]: r["count"] for r in block.groupBy("key").count().collect()}
    assert blocks[1] <= 82 and n[1] <= 2 * blocks[1]  # all pairs of blocks would be over 3,000
    assert n[2] == 9  # three blocks of each label
    got = {tuple(sorted(r)) for r in H._candidates(lab, tables, 75).collect()}
    want = {(n, 19_997) for n in range(19_997)} | {(19_998, 19_999)} | {(a, b) for a in range(700) for b in range(700, 1400)}
    assert got == want
