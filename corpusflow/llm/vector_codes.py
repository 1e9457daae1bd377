"""Vector compression: each of four parts of a vector becomes the index of an entry in that part's codebook.

Components become integers, ``floor(1024 * x)``. A codebook starts as its part of the 256 smallest ids; a
round assigns every part to the nearest entry (squared Euclidean distance, ties to the lower index) and moves
each entry to the floor of its parts' mean; unused entries stay. All arithmetic is on integers, so results do
not depend on how the rows are partitioned.

Plan. Parts are sorted along a Hilbert curve through their part's space (range partitions, so a vector that
a third of all rows repeat still spans many tasks, as the row number ends the sort key) and written once
as flat blocks: up to ``BLOCK`` parts with the smallest and largest value per component (a box) and the sums.
A round is one scan of the blocks: for every box the distances of the entries to its nearest and farthest
point give a short list, the entries that may be nearest to some point in it. One entry takes the whole
block by its sums; else a small kernel measures the block's parts against the list. A task adds up its parts
per entry, Spark the tasks' sums; the codebooks (at most 4 x 256 entries) go through the driver and back in a
broadcast. After the last scan the four codes of a row meet by its row number.

Kernels use float64 products where all values stay below 2**53, so that they are exact, else int64.

Defined cases: rows whose vector is null or holds null or non-finite components go. The vector of the
smallest kept id (among equal ids the smallest vector) sets the length; rows of another length, and empty
vectors, stay with null code and error. A length that 4 does not divide is filled up with zeros at the end. A
null id comes last. Repeated rows and ids are each coded. With fewer than 256 rows the codebooks are shorter. An
empty table gives no rows. Components beyond the range in which distances fit 64 bits (``2**17`` for parts of up
to 64 components) count as its ends. Only the columns named are carried along.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.llm import arrays as A
from corpusflow.sources.readers import scratch_path

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
BLOCK = 64
#: labels up to which their totals are broadcast
BROADCAST_LABELS = 100_000
_EXACT = 1 << 53


def limit(width: int) -> int:
    """Largest integer component for which distances of parts of ``width`` components fit 63 bits."""
    return 1 << ((62 - max(0, width - 1).bit_length()) // 2 - 1)


def integers(flat: np.ndarray, width: int) -> np.ndarray:
    top = limit(width)
    return np.clip(np.floor(flat.astype(np.float64) * SCALE), -top, top).astype(np.int64)


def parts_of(vectors: np.ndarray) -> np.ndarray:
    """``n x 4 x width`` integer parts of the rows of a float matrix."""
    n, d = vectors.shape
    width = -(-d // PARTS)
    full = np.zeros((n, PARTS * width), dtype=np.float64)
    full[:, :d] = vectors
    return integers(full, width).reshape(n, PARTS, width)


def hilbert_keys(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Place of each point on a Hilbert curve through the box from ``low`` to ``high``, as an int64.

    At most 63 components count, with as many bits each as fit 63 bits in all (Skilling's transform).
    """
    n, d = points.shape[0], min(points.shape[1], 63)
    bits = max(1, min(16, 63 // d))
    span = np.maximum(high - low, 1)[:d]
    x = np.clip((points[:, :d] - low[:d]) * ((1 << bits) - 1) // span, 0, (1 << bits) - 1).T.copy()
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(d):
            up = (x[i] & q) != 0
            t = np.where(up, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(up, x[0] ^ p, x[0] ^ t)
            x[i] ^= t
        q >>= 1
    for i in range(1, d):
        x[i] ^= x[i - 1]
    t, q = np.zeros(n, dtype=np.int64), 1 << (bits - 1)
    while q > 1:
        t = np.where((x[d - 1] & q) != 0, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    key = np.zeros(n, dtype=np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(d):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def short_lists(low: np.ndarray, high: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Per box (rows of ``low`` and ``high``), which entries may be nearest to a point in it."""
    near, far = np.zeros((len(low), len(book)), dtype=np.int64), np.zeros((len(low), len(book)), dtype=np.int64)
    for j in range(book.shape[1]):
        below, above = low[:, j, None] - book[None, :, j], book[None, :, j] - high[:, j, None]
        near += np.maximum(np.maximum(below, above), 0) ** 2
        far += np.maximum(np.abs(below), np.abs(above)) ** 2
    return near <= far.min(axis=1, keepdims=True)


def nearest(points: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest row of ``book`` (the first of equals) and squared distance, for each point; exact."""
    top = max(int(np.abs(points).max(initial=0)), int(np.abs(book).max(initial=0)))
    if 4 * top * top * book.shape[1] < _EXACT:
        p, c = points.astype(np.float64), book.astype(np.float64)
        d = (c * c).sum(axis=1) - 2 * (p @ c.T)  # without the points' own squares, which change no order
        at = d.argmin(axis=1)
        return at, (d[np.arange(len(p)), at] + (p * p).sum(axis=1)).astype(np.int64)
    best, at = np.full(len(points), np.iinfo(np.int64).max), np.zeros(len(points), dtype=np.int64)
    for k, c in enumerate(book):
        d = ((points - c) ** 2).sum(axis=1)
        less = d < best
        best[less], at[less] = d[less], k
    return at, best


def assign(points: np.ndarray, low: np.ndarray, high: np.ndarray, ends: np.ndarray, book: np.ndarray,
           whole: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Entry and squared distance of each point; blocks are the runs between ``ends``.

    With ``whole`` a block whose list has one entry is not measured (distance -1).
    """
    code, dist = np.zeros(len(points), dtype=np.int64), np.full(len(points), -1, dtype=np.int64)
    for a in range(0, len(low), 64):
        lists = short_lists(low[a:a + 64], high[a:a + 64], book)
        for b, keep in enumerate(lists, a):
            some = np.flatnonzero(keep)
            rows = slice(ends[b], ends[b + 1])
            if whole and len(some) == 1:
                code[rows] = some[0]
            else:
                at, dist[rows] = nearest(points[rows], book[some])
                code[rows] = some[at]
    return code, dist


def _kept(df: DataFrame, vector: str) -> DataFrame:
    """Rows with a vector of finite components."""
    v = F.col(vector)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return df.filter(v.isNotNull() & F.coalesce(fine, F.lit(False)))


def _matrix(col: pa.Array, dim: int) -> np.ndarray:
    flat = col.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(col), dim)


def _narrow(values: np.ndarray) -> tuple[int, bytes]:
    top = int(np.abs(values).max(initial=0))
    width = 2 if top < 1 << 15 else 4 if top < 1 << 31 else 8
    return width, values.astype(f"<i{width}").tobytes()


def _write_blocks(rows: DataFrame, width: int, low: np.ndarray, high: np.ndarray, carry: list[str], path: str) -> None:
    """Parts of all rows in Hilbert order, as blocks, a Parquet row each.

    ``rows``: ``row`` (number), ``vec``, and the columns to carry, which go with part 0.
    """
    names, kinds = carry, [rows.schema[c].dataType.simpleString() for c in carry]
    more = "".join(f", {c} {k}" for c, k in zip(names, kinds))

    def cut(batches):
        for rb in batches:
            if not rb.num_rows:
                continue
            points = parts_of(_matrix(rb.column("vec"), len(rb.column("vec")[0])))
            for p in range(PARTS):
                key = hilbert_keys(points[:, p], low[p], high[p])
                data = np.ascontiguousarray(points[:, p].astype("<i4" if limit(width) < 1 << 31 else "<i8"))
                raw = pa.FixedSizeBinaryArray.from_buffers(pa.binary(data.itemsize * width), len(data), [None, pa.py_buffer(data)])
                own = [rb.column(c) if p == 0 else pa.nulls(rb.num_rows, rb.column(c).type) for c in names]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(rb.num_rows, p, dtype=np.int32)), pa.array(key), rb.column("row"), raw.cast(pa.binary()), *own],
                    names=["part", "key", "row", "vec", *names])

    def pack(batches):
        for rb in batches:
            part, n = rb.column("part").to_numpy(), rb.num_rows
            if not n:
                continue
            raw = b"".join(rb.column("vec").to_pylist())
            points = np.frombuffer(raw, dtype=f"<i{len(raw) // (n * width)}").reshape(n, width).astype(np.int64)
            edge = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
            starts = np.concatenate([np.arange(a, b, BLOCK) for a, b in zip(edge, [*edge[1:], n])])
            out: dict[str, list] = {c: [] for c in ["part", "n", "size", "low", "high", "sums", "data", "rows"]}
            for a, b in zip(starts, [*starts[1:], n]):
                block = points[a:b]
                size, data = _narrow(block)
                for c, v in zip(out, [int(part[a]), b - a, size, block.min(axis=0), block.max(axis=0), block.sum(axis=0), data,
                                      rb.column("row")[a:b].to_numpy().astype("<i8").tobytes()]):
                    out[c].append(v)
            offs = pa.array([*starts, n], type=pa.int32())
            cols = [pa.array(out["part"], type=pa.int32()), pa.array(out["n"], type=pa.int32()), pa.array(out["size"], type=pa.int32()),
                    *[pa.array(out[c], type=pa.list_(pa.int64())) for c in ["low", "high", "sums"]],
                    pa.array(out["data"], type=pa.binary()), pa.array(out["rows"], type=pa.binary())]
            own = []
            for c in names:  # carried columns once, with part 0
                first = np.flatnonzero(part != 0)
                stop = int(first[0]) if len(first) else n
                own.append(pa.ListArray.from_arrays(pa.array(np.minimum(offs.to_numpy(), stop), type=pa.int32()),
                                                    rb.column(c).slice(0, stop)))
            yield pa.RecordBatch.from_arrays([*cols, *own], names=[*out, *names])

    flat = rows.mapInArrow(cut, "part int, key long, row long, vec binary" + more)
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["part", "key", "row"]
    flat.repartitionByRange(n, *order).sortWithinPartitions(*order).mapInArrow(
        pack, "part int, n int, size int, low array<long>, high array<long>, sums array<long>, data binary, rows binary"
        + "".join(f", {c} array<{k}>" for c, k in zip(names, kinds))).write.parquet(path)


def _unpack(rb: pa.RecordBatch, width: int):
    """Per part of a batch of blocks: part, the blocks' places, points, boxes, block ends, sums."""
    part = rb.column("part").to_numpy()
    data, size = rb.column("data").to_pylist(), rb.column("size").to_pylist()
    mats = {c: rb.column(c).flatten().to_numpy().reshape(-1, width) for c in ("low", "high", "sums") if c in rb.schema.names}
    for p in np.unique(part).tolist():
        at = np.flatnonzero(part == p)
        blocks = [np.frombuffer(data[i], dtype=f"<i{size[i]}").reshape(-1, width).astype(np.int64) for i in at]
        ends = np.concatenate(([0], np.cumsum([len(b) for b in blocks])))
        yield p, at, np.concatenate(blocks), ends, {c: m[at] for c, m in mats.items()}


def _group_sums(code: np.ndarray, values: np.ndarray, entries: int) -> tuple[np.ndarray, np.ndarray]:
    total, count = np.zeros((entries, values.shape[1]), dtype=np.int64), np.bincount(code, minlength=entries)
    if len(code):
        order = np.argsort(code, kind="stable")
        used = np.flatnonzero(count)
        starts = (np.cumsum(count) - count)[used]
        total[used] = np.add.reduceat(values[order], starts, axis=0)
    return total, count


def _round(blocks: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one round: ``4 x entries x width``."""
    _, entries, width = books.shape
    shared = blocks.sparkSession.sparkContext.broadcast(books)

    def run(batches):
        books = shared.value
        total, count = np.zeros(books.shape, dtype=np.int64), np.zeros(books.shape[:2], dtype=np.int64)
        for rb in batches:
            for p, at, points, ends, box in _unpack(rb, width):
                code, dist = assign(points, box["low"], box["high"], ends, books[p], whole=True)
                one = dist[ends[:-1]] < 0  # blocks that one entry takes: their sums are stored
                t, c = _group_sums(code[ends[:-1]][one], box["sums"][one], entries)
                c = np.bincount(code[ends[:-1]][one], weights=np.diff(ends)[one], minlength=entries).astype(np.int64)
                rest = np.repeat(~one, np.diff(ends))
                t2, c2 = _group_sums(code[rest], points[rest], entries)
                total[p] += t + t2
                count[p] += c + c2
        p, e = np.nonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(p, type=pa.int32()), pa.array(e, type=pa.int32()), pa.array(count[p, e]),
             pa.array(list(total[p, e]), type=pa.list_(pa.int64()))], names=["part", "entry", "n", "sums"])

    found = blocks.select("part", "size", "low", "high", "sums", "data").mapInArrow(run, "part int, entry int, n long, sums array<long>")
    sums = found.groupBy("part", "entry").agg(F.sum("n").alias("n"), *[F.sum(F.col("sums")[j]).alias(f"s{j}") for j in range(width)])
    out = books.copy()
    for r in sums.collect():  # at most 4 x 256 rows
        out[r.part, r.entry] = [s // r.n for s in r[3:]]
    return out


def _codes(blocks: DataFrame, books: np.ndarray, carry: list[str]) -> DataFrame:
    """``row``, ``part``, ``code``, ``dist`` and, with part 0, the carried columns."""
    width = books.shape[2]
    shared = blocks.sparkSession.sparkContext.broadcast(books)
    kinds = [blocks.schema[c].dataType.elementType.simpleString() for c in carry]

    def run(batches):
        books = shared.value
        for rb in batches:
            rows = rb.column("rows").to_pylist()
            for p, at, points, ends, box in _unpack(rb, width):
                code, dist = assign(points, box["low"], box["high"], ends, books[p])
                n = len(points)
                own = [rb.column(c).take(pa.array(at)).flatten() if p == 0 else pa.nulls(n, rb.column(c).type.value_type)
                       for c in carry]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.frombuffer(b"".join(rows[i] for i in at), dtype="<i8")), pa.array(np.full(n, p), type=pa.int32()),
                     pa.array(code, type=pa.int32()), pa.array(dist), *own], names=["row", "part", "code", "dist", *carry])

    return blocks.select("part", "size", "low", "high", "data", "rows", *carry).mapInArrow(
        run, "row long, part int, code int, dist long" + "".join(f", {c} {k}" for c, k in zip(carry, kinds)))


def codebook_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress(df: DataFrame, vector: str = "embedding", vec_id: str = "vec_id", carry: tuple[str, ...] = ("label",),
             entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """Codes of all vectors (``vec_id``, the carried columns, ``code``, ``error``) and the codebooks (4 x entries x width)."""
    spark = df.sparkSession
    keep = [vec_id, *[c for c in carry if c != vec_id]]
    inner = [f"c{i}" for i in range(len(keep))]
    part = df.select(F.col(vector).alias("vec"), *[F.col(c).alias(i) for c, i in zip(keep, inner)])
    part = _kept(part.withColumn("vec", F.col("vec").cast("array<double>")), "vec")
    head = part.orderBy(F.col("c0").asc_nulls_last(), "vec").limit(1).collect()
    dim = len(head[0].vec) if head else 0
    none = [F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error")]
    names = [F.col(i).alias(c) for c, i in zip(keep, inner)]
    if not dim:
        return part.select(*names, *none), np.zeros((PARTS, 0, 0), dtype=np.int64)
    same = part.filter(F.size("vec") == dim)
    first = same.orderBy(F.col("c0").asc_nulls_last(), "vec").limit(entries).collect()  # bounded by entries
    books = np.ascontiguousarray(parts_of(np.array([r.vec for r in first])).transpose(1, 0, 2))
    width = books.shape[2]
    # the box of the first entries scales the curve; points beyond it go to its border, which costs no exactness
    path = scratch_path(spark, "vector-blocks")
    rows = same.withColumn("row", F.monotonically_increasing_id())  # fixed by the blocks, which are written once
    _write_blocks(rows, width, books.min(axis=1), books.max(axis=1), inner, path)
    blocks = spark.read.parquet(path)
    for _ in range(rounds):
        books = _round(blocks, books)
    coded = _codes(blocks, books, inner)
    code = F.concat(*[F.max(F.when(F.col("part") == p, F.lpad(F.lower(F.hex("code")), 2, "0"))) for p in range(PARTS)])
    out = coded.groupBy("row").agg(*[F.max(i).alias(i) for i in inner], code.alias("code"), F.sum("dist").alias("error"))
    other = part.filter(F.size("vec") != dim).select(*names, *none)
    return out.select(*names, "code", "error").unionByName(other), books


def with_label_error(coded: DataFrame, label: str, error: str = "error", out: str = "label_error") -> DataFrame:
    """``error`` summed over equal values of ``label`` (nulls are one value), on every row."""
    key = A.fresh(coded.columns, "_label")
    sums = coded.groupBy(F.col(label).alias(key)).agg(F.sum(error).alias(out))
    if sums.count() <= BROADCAST_LABELS:
        sums = F.broadcast(sums)
    return coded.join(sums, F.col(label).eqNullSafe(F.col(key)), "left").drop(key)
