"""MinHash near-duplicates with HyperMinHash registers, banding and verification on full shingle sets.

Method. A document's shingles (distinct ``width``-word windows, lower-cased) are hashed to 64 bits.
Each of ``bands * rows`` registers has a hash function of its own over all shingles; the smallest value is
kept compressed, as its leading-zero count and ``MANTISSA`` bits after the leading one (16 bits).
So registers are independent however few shingles a set has (dealing the shingles over the registers
would leave most of them empty in small sets). ``rows`` registers make a band key; documents with an equal
band key are candidates. Candidates with large sets must also pass the Jaccard estimate from their
registers, corrected for accidental collisions; then every link is verified on the full sets.

Plan. Documents with equal sets are one node (a node's id is a 64-bit fingerprint of its set), so a
group of copies costs one row. Nobody lists all pairs of a group:

1. a bucket's centre is the member that meets most others in all its buckets; a node verifies only the
   centre it met most often, and the verified links are contracted to labels;
2. members of one bucket with different labels are compared in blocks by bit tables of their sets, an
   exact bound; pairs that it leaves room for a link become rows and are verified. A label with as many members
   as a block has blocks of its own, which never meet each other, so a large group with a few strays is linear;
3. the labels are joined over those links.

A group of near copies is mostly one label after step 1, and what is left of it mostly falls to the bound
of step 2, which leaves out no link between candidates. With the defaults a pair at
Jaccard 0.75 shares no band with probability 2e-5, one at 0.8 with 4e-8, for sets of any size. Sets are shuffled only for
nodes that have a candidate: a bit table of fixed size (a bound whatever the corpus) tells the second
scan which ones; an exact join follows.

Defined cases: null or empty text and text without words have no set, are linked with nothing and form
their own component; repeated rows fall into one node; rows that share an id are still linked by
their texts; a null id counts after all others; an empty table gives no rows; a very long text is read whole,
one at a time. Extra columns are ignored by ``near_duplicates`` and
kept by ``drop_near_duplicates``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from corpusflow.llm import arrays as A
from corpusflow.session import ensure_checkpoint_dir

WIDTH = 5
PERCENT = 75
BANDS = 56
ROWS = 6
MANTISSA = 10
ESTIMATE_SLACK = 0.25  # over 7 standard errors of the estimate
ESTIMATE_LEAST = 256  # smaller sets are verified at once
TABLE_BITS = 26
SET_BITS = 2048  # bits of the table that bounds what two sets have in common
BLOCK = 256
SPREAD = 64
LINKS_PER_TASK = 200_000
SLICE_ROWS = 2000


def compress(value: np.ndarray) -> np.ndarray:
    """Leading-zero count (6 bits) and the ``MANTISSA`` bits behind the leading one."""
    v = value.copy()
    zeros = np.zeros(v.shape, dtype=np.uint16)
    for step in (32, 16, 8, 4, 2, 1):
        low = v < np.uint64(1 << (64 - step))
        v[low] <<= np.uint64(step)
        zeros[low] += np.uint16(step)
    mantissa = (v << np.uint64(1)) >> np.uint64(64 - MANTISSA)
    return (zeros << np.uint16(MANTISSA)) | mantissa.astype(np.uint16)


def shingle_sets(col: pa.Array, width: int = WIDTH):
    """Distinct shingle hashes and their document numbers, in document order."""
    buf, offs = A.text_bytes(col)
    starts, ends, doc = A.runs(A.NOT_SPACE[buf], offs)
    h = A.span_hashes(buf, starts, ends, lower=True)
    sh, sd = A.window_hashes(h, width), doc[:max(len(doc) - width + 1, 0)]
    whole = A.whole_windows(doc, width)
    sh, sd = sh[whole], sd[whole]
    n_words = np.bincount(doc, minlength=len(col))
    first = np.cumsum(n_words) - n_words
    extra, at = [], []
    for n in range(1, width):  # a document of fewer words is one shingle
        d = np.flatnonzero(n_words == n)
        if len(d):
            acc = np.full(len(d), n, dtype=np.uint64)
            for j in range(n):
                acc = A.mix(acc * np.uint64(A._BASE) + h[first[d] + j])
            extra.append(acc)
            at.append(d)
    if extra:
        sh, sd = np.concatenate([sh, *extra]), np.concatenate([sd, *at])
        order = np.argsort(sd, kind="stable")
        sh, sd = sh[order], sd[order]
    own = np.sort(np.unique(sh + A.mix(sd), return_index=True)[1])
    return sh[own], sd[own]


def nodes_of(sh: np.ndarray, sd: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Set size and 64-bit set fingerprint of each document."""
    size = np.bincount(sd, minlength=n_docs)
    total = np.concatenate(([0], np.cumsum(A.mix(sh)))).astype(np.uint64)
    end = np.cumsum(size)
    return size, A.mix((total[end] - total[end - size]) ^ A.mix(size))


def registers(sh: np.ndarray, sd: np.ndarray, n_docs: int, m: int) -> np.ndarray:
    """Compressed registers, documents x m, of shingles in document order: the least value under each of m hash functions."""
    least = np.full((m, n_docs), 2**64 - 1, dtype=np.uint64)
    first = np.flatnonzero(np.diff(sd, prepend=-1))
    if len(first):
        docs, x = sd[first], A.mix(sh ^ np.uint64(0x5851F42D4C957F2D))
        seeds = A.mix(np.arange(1, 2 * m + 1, dtype=np.uint64)).reshape(2, m)
        for j, (flip, factor) in enumerate(zip(seeds[0], seeds[1] | np.uint64(1))):
            least[j, docs] = np.minimum.reduceat((x ^ flip) * factor, first)
    return compress(np.ascontiguousarray(least.T))


def band_keys(regs: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per document and band; a band's registers stand ``bands`` apart."""
    acc = np.broadcast_to(np.arange(bands, dtype=np.uint64), (regs.shape[0], bands)).copy()
    for r in range(rows):
        acc = acc * np.uint64(A._BASE) + regs[:, r * bands:(r + 1) * bands]
    return A.mix(acc)


def jaccard_estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal registers, corrected for those that are equal by accident."""
    accident = 0.169919 * 2.0 ** -MANTISSA
    same = (a == b).mean(axis=1)
    return np.maximum(0.0, (same - accident) / (1 - accident))


def _lists(values: np.ndarray, sizes: np.ndarray, kind=pa.int64()) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.view(np.int64), type=kind))


def set_bits(sh: np.ndarray, sd: np.ndarray, n_docs: int) -> pa.Array:
    """``SET_BITS`` bits per set, a bit for each shingle's hash, as lists of 64-bit numbers."""
    table = np.zeros((n_docs, SET_BITS), dtype=np.uint8)
    table[sd, (sh % np.uint64(SET_BITS)).astype(np.int64)] = 1
    words = np.packbits(table, axis=1).view(np.uint64)
    return _lists(words.ravel(), np.full(n_docs, SET_BITS // 64))


def signatures(docs: DataFrame, width: int = WIDTH, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(id, n_shingles, node, keys) of (id, text); node and keys are null without a set."""

    def run(batches):
        for batch in batches:
            for rb in A.slices(batch, "text", rows=SLICE_ROWS):
                n = rb.num_rows
                sh, sd = shingle_sets(rb.column("text"), width)
                size, node = nodes_of(sh, sd, n)
                keys = band_keys(registers(sh, sd, n, bands * rows), bands, rows)
                full = size > 0
                yield pa.RecordBatch.from_arrays(
                    [rb.column("id"), pa.array(size.astype(np.int64)), pa.array(node.view(np.int64), mask=~full),
                     _lists(keys[full].ravel(), np.where(full, bands, 0))], names=["id", "n_shingles", "node", "keys"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(A.released(run), f"id {kind}, n_shingles long, node long, keys array<long>")


def _bit_table(nodes: DataFrame) -> np.ndarray:
    """A bit for the low ``TABLE_BITS`` bits of each node: 8 MB, whatever the number of nodes."""
    at = F.pmod("node", F.lit(1 << TABLE_BITS)) + 1  # the bitmap functions count from 1
    rows = (nodes.groupBy(F.bitmap_bucket_number(at).alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits")).collect())
    table = np.zeros(1 << (TABLE_BITS - 3), dtype=np.uint8)
    for r in rows:
        part = np.frombuffer(r["bits"], dtype=np.uint8)
        table[(r["bucket"] - 1) * len(part):][:len(part)] = part
    return table


def sets_of(docs: DataFrame, nodes: DataFrame, width: int, bands: int, rows: int) -> DataFrame:
    """(node, n, shingles, bits, regs) of the wanted nodes: a scan that the bit table thins out, then the exact join."""
    table = docs.sparkSession.sparkContext.broadcast(_bit_table(nodes))

    def run(batches):
        bits, seen = table.value, np.zeros(0, dtype=np.uint64)
        for batch in batches:
            for rb in A.slices(batch, "text", rows=SLICE_ROWS):
                sh, sd = shingle_sets(rb.column("text"), width)
                size, node = nodes_of(sh, sd, rb.num_rows)
                low = node & np.uint64((1 << TABLE_BITS) - 1)
                hit = (bits[low >> np.uint64(3)] >> (low & np.uint64(7)).astype(np.uint8)) & 1
                first = np.zeros(rb.num_rows, dtype=bool)
                first[np.unique(node, return_index=True)[1]] = True
                take = (hit == 1) & (size > 0) & first & ~np.isin(node, seen)
                if not take.any():
                    continue
                seen = np.concatenate([seen, node[take]])
                mine = take[sd]
                number = np.cumsum(take) - 1
                regs = registers(sh[mine], number[sd[mine]], int(take.sum()), bands * rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node[take].view(np.int64)), pa.array(size[take].astype(np.int64)),
                     _lists(sh[mine], size[take]), set_bits(sh[mine], number[sd[mine]], int(take.sum())),
                     pa.array([r.tobytes() for r in regs], type=pa.binary())],
                    names=["node", "n", "shingles", "bits", "regs"])

    found = docs.select("text").mapInArrow(A.released(run), "node long, n long, shingles array<long>, bits array<long>, regs binary")
    return found.join(nodes, "node", "left_semi").dropDuplicates(["node"])


def verified(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The (a, b) pairs that pass the size bound, the register estimate and the comparison of the full sets."""
    least = percent / 100 - ESTIMATE_SLACK

    def likely(batches):
        for batch in batches:
            big = np.minimum(batch.column("na").to_numpy(), batch.column("nb").to_numpy()) >= ESTIMATE_LEAST
            keep = np.ones(batch.num_rows, dtype=bool)
            at = np.flatnonzero(big)
            if len(at):
                a, b = (np.frombuffer(b"".join(batch.column(c).take(pa.array(at)).to_pylist()), dtype=np.uint16)
                        .reshape(len(at), -1) for c in ("ra", "rb"))
                keep[at] = jaccard_estimate(a, b) >= least
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    def side(x, cols):
        return sets.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"), *[c.alias(n + x) for n, c in cols.items()])

    regs, full = {"r": F.col("regs")}, {"s": F.col("shingles")}
    near = F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent
    some = (pairs.join(side("a", regs), "a").join(side("b", regs), "b").filter(near)
            .select("a", "b", "na", "nb", "ra", "rb").mapInArrow(likely, "a long, b long"))
    both = F.size(F.array_intersect("sa", "sb")).cast("long")
    return (some.join(side("a", full), "a").join(side("b", full), "b")
            .filter(both * 100 >= (F.col("na") + F.col("nb") - both) * percent).select("a", "b"))


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every node with a link to a smaller one, directly or not; label is the component's smallest node.

    Each round hooks a node to its smallest neighbour (a forest, as that is smaller), flattens the
    forest by pointer jumping, and maps the links to the roots; about log(n) rounds of log(n) jumps.
    The number of tasks follows the number of links, so that small graphs don't pay for empty tasks.
    """
    def tidy(df):
        return df.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()

    links, labels = tidy(links).checkpoint(), None
    left = links.count()
    tasks = 1 + left // LINKS_PER_TASK
    links = links.coalesce(tasks)
    while left:
        parent = links.groupBy("a").agg(F.min("b").alias("p")).coalesce(tasks).checkpoint()
        while True:
            up = parent.select(F.col("a").alias("p"), F.col("p").alias("pp"))
            jumped = parent.join(up, "p", "left").select(
                "a", F.coalesce("pp", "p").alias("p"), F.col("pp").isNotNull().alias("moved")).coalesce(tasks).checkpoint()
            parent = jumped.select("a", "p")
            if jumped.filter("moved").isEmpty():
                break
        root = parent.select(F.col("a").alias("node"), F.col("p").alias("label"))
        if labels is None:
            labels = root
        else:
            on = root.select(F.col("node").alias("label"), F.col("label").alias("top"))
            labels = labels.join(on, "label", "left").select("node", F.coalesce("top", "label").alias("label"))
            labels = labels.unionByName(root).coalesce(tasks).checkpoint()
        for c in ("a", "b"):
            to = parent.select(F.col("a").alias(c), F.col("p").alias("q"))
            links = links.join(to, c, "left").withColumn(c, F.coalesce("q", c)).drop("q")
        links = tidy(links).coalesce(tasks).checkpoint()
        left = links.count()
    return labels if labels is not None else links.select(F.col("a").alias("node"), F.col("b").alias("label"))


def classes(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(id, n_shingles, node, label) of (id, text): equal labels are one group; null node and label without a set."""
    ensure_checkpoint_dir(docs.sparkSession)
    sig = signatures(docs, width, bands, rows).checkpoint()
    one = sig.filter("node is not null").select("node", "keys").dropDuplicates(["node"])
    band = one.select("node", F.explode("keys").alias("key"))
    shared = band.groupBy("key").agg(F.count(F.lit(1)).alias("m")).filter("m > 1")
    # a node's weight: how many it meets in its (at most ``bands``) buckets
    weight = F.sum("m").over(Window.partitionBy("node"))
    member = band.join(shared, "key").select("key", "node", weight.alias("w")).checkpoint()
    # 1. each member verifies one bucket centre, the heaviest node of a bucket: the one that it met most often
    centre = member.groupBy("key").agg(F.max(F.struct("w", "node")).alias("c")).select("key", F.col("c.node").alias("centre"))
    met = (member.select("key", "node").join(centre, "key").filter("node <> centre")
           .groupBy("node", "centre").agg(F.count(F.lit(1)).alias("times")))
    first = (met.groupBy("node").agg(F.max(F.struct("times", "centre")).alias("m"))
             .select(F.col("node").alias("a"), F.col("m.centre").alias("b")))
    sets = sets_of(docs, member.select("node").distinct(), width, bands, rows).checkpoint()
    links = verified(first, sets, percent).checkpoint()
    labels = components(links)
    # 2. members of a bucket that do not have one label yet
    lab = member.select("key", "node").join(labels, "node", "left").select("key", "node", F.coalesce("label", "node").alias("label"))
    mixed = lab.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count(F.lit(1)).alias("m"))
    lab = lab.join(mixed.filter("lo <> hi").select("key", "m"), "key").checkpoint()
    more = verified(_candidates(lab, sets.select("node", "n", "bits"), percent).distinct(), sets, percent)
    # 3. join the labels over the links found last
    everything = components(links.unionByName(more))
    return (sig.select("id", "n_shingles", "node").join(everything, "node", "left")
            .select("id", "n_shingles", "node", F.coalesce("label", "node").alias("label")))


def _blocks(lab: DataFrame, tables: DataFrame) -> DataFrame:
    """A bucket's members in blocks of about ``BLOCK``: labels of that many members have blocks of their own (``own``
    is the label), the members of smaller ones share blocks (``own`` is null)."""
    size = lab.groupBy("key", "label").agg(F.count(F.lit(1)).alias("c"))
    rest = size.groupBy("key").agg(F.sum(F.when(F.col("c") < BLOCK, F.col("c")).otherwise(0)).alias("rest"))
    large = F.col("c") >= BLOCK
    number = F.pmod(F.xxhash64("node"), F.ceil(F.when(large, F.col("c")).otherwise(F.col("rest")) / BLOCK))
    placed = (lab.join(size.join(rest, "key"), ["key", "label"])
              .select("key", "node", "label", "m", F.when(large, F.col("label")).alias("own"), number.alias("part")))
    # salts: a bucket is split over tasks, one for every ``SPREAD`` blocks
    return (placed.join(tables, "node").groupBy("key", "own", "part")
            .agg(F.max(F.ceil(F.col("m") / (BLOCK * SPREAD))).alias("salts"), *[F.collect_list(c).alias(c) for c in ("node", "n", "label", "bits")]))


def block_pairs(block: DataFrame) -> DataFrame:
    """Pairs of one bucket's blocks that can hold two labels: blocks of small labels with all blocks, and blocks of one
    label with those of another. Blocks of one label never meet, so a bucket of one label and a few others is linear."""
    cols = ("own", "part", "node", "n", "label", "bits")

    def left(df):
        salt = F.pmod(F.xxhash64("own", "part"), F.col("salts"))
        return df.select("key", salt.alias("salt"), *[F.col(c).alias(c + "a") for c in cols])

    def right(df):
        every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("salts") - 1))
        return df.select("key", every.alias("salt"), *[F.col(c).alias(c + "b") for c in cols])

    shared, single = block.filter("own IS NULL"), block.filter("own IS NOT NULL")
    some = left(block).join(right(shared), ["key", "salt"]).filter("owna IS NOT NULL OR parta <= partb")
    several = single.groupBy("key").agg(F.min("own").alias("lo"), F.max("own").alias("hi")).filter("lo < hi").select("key")
    single = single.join(several, "key", "left_semi")
    return some.unionByName(left(single).join(right(single), ["key", "salt"]).filter("owna < ownb"))


def _candidates(lab: DataFrame, tables: DataFrame, percent: int) -> DataFrame:
    """(a, b) of one bucket with different labels whose bit tables leave room for a link.

    A bit of one set that the other lacks is a shingle that it lacks, so the common shingles are at most
    the size less those bits. A pair of blocks is compared as two matrices, and only what passes becomes a row.
    """
    def compare(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                side = []
                for x in "ab":
                    node, n, label = (batch.column(c + x)[i].values.to_numpy() for c in ("node", "n", "label"))
                    bits = batch.column("bits" + x)[i].values.flatten().to_numpy().view(np.uint64).reshape(len(node), -1)
                    side.append((node, n, label, np.unpackbits(bits.view(np.uint8), axis=1).astype(np.float32)))
                (na_, n_a, la, x), (nb_, n_b, lb, y) = side
                both = (x @ y.T).astype(np.int64)
                most = np.minimum((n_a - x.sum(1).astype(np.int64))[:, None] + both, (n_b - y.sum(1).astype(np.int64))[None, :] + both)
                ok = most * 100 >= (n_a[:, None] + n_b[None, :] - most) * percent
                ok &= la[:, None] < lb[None, :] if batch.column("same")[i].as_py() else la[:, None] != lb[None, :]
                p, q = np.nonzero(ok)
                yield pa.RecordBatch.from_arrays([pa.array(na_[p]), pa.array(nb_[q])], names=["a", "b"])

    same = F.col("owna").isNull() & F.col("ownb").isNull() & (F.col("parta") == F.col("partb"))
    return block_pairs(_blocks(lab, tables).checkpoint()).withColumn("same", same).mapInArrow(compare, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """One row per document: its id, ``n_shingles``, ``component_id`` (the group's smallest id) and ``kept``."""
    part = docs.select(F.col(id_col).alias("id"), F.col(text).cast("string").alias("text"))
    found = classes(part, **how).checkpoint()
    least = found.filter("label is not null").groupBy("label").agg(F.min("id").alias("component_id"))
    out = found.join(least, "label", "left").withColumn(
        "component_id", F.when(F.col("label").isNull(), F.col("id")).otherwise(F.col("component_id")))
    return out.select(F.col("id").alias(id_col), "n_shingles", "component_id",
                      F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """The documents without their near-duplicates: of each group one row with the smallest id stays (input's columns).

    Documents without a set stay. Where rows share that id and text, any one of them stays.
    """
    names = docs.columns
    key, node, flag, rank = (A.fresh(names, c) for c in ("_key", "_node", "_wins", "_rank"))
    part = docs.select(F.col(id_col).alias("id"), F.col(text).cast("string").alias("text"))
    win = (classes(part, **how).filter("label is not null").groupBy("label")
           .agg(F.min(F.struct(F.col("id").isNull(), "id", "node")).alias("w"))
           .select(F.xxhash64("w.id", "w.node").alias(key), F.lit(True).alias(flag)).distinct())
    marked = with_node(docs, node, text, how.get("width", WIDTH)).withColumn(key, F.xxhash64(id_col, node))
    same = Window.partitionBy(key, id_col, node).orderBy(key)
    return (marked.join(win, key, "left").withColumn(rank, F.row_number().over(same))
            .filter(F.col(node).isNull() | (F.col(flag) & (F.col(rank) == 1))).select(*names))


def with_node(docs: DataFrame, name: str, text: str = "text", width: int = WIDTH) -> DataFrame:
    """Every input column, and the document's node as ``name`` (null without a set)."""
    t = text

    def run(batches):
        for batch in batches:
            for rb in A.slices(batch, t, rows=SLICE_ROWS):
                sh, sd = shingle_sets(rb.column(t), width)
                size, node = nodes_of(sh, sd, rb.num_rows)
                yield pa.RecordBatch.from_arrays([*rb.columns, pa.array(node.view(np.int64), mask=size == 0)],
                                                 names=[*rb.schema.names, name])

    return docs.mapInArrow(A.released(run), StructType([*docs.schema.fields, StructField(name, LongType())]))
