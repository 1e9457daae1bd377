"""Token ids in binary shards, with a minimal perfect hash index from document keys to offsets.

Format. A store is a Parquet folder; each row is one shard of about ``SHARD_TOKENS`` ids. ``payload``
holds the ids of its documents in ascending key order, little-endian, 16 or 32 bits wide (``width``).
The index is a minimal perfect hash over the shard's keys: levels of bits, where a key stands at the
first level at which no other key shares its place; its rank among all set bits is its slot. ``prints``
has a 16-bit fingerprint per slot, ``offsets`` and ``lengths`` the place of the document's ids.
``lo`` and ``hi`` are the shard's least and greatest key; ``keys`` lists all in payload order and no lookup
reads it. A key that occurs more than once has an ordinal inside its shard.

Plan. Documents are range-partitioned by (key, hash of the text) and sorted inside partitions, so
shards are in global order and a key with very many rows spans partitions; texts are shuffled once,
encoded and packed in the same task. The rows that are read back carry offsets inside their shard;
prefix sums over one number per shard make them global. A lookup counts, in one sorted order of wanted keys and
shard bounds, the shards before each key, joins on the shard's number, and then reads each key's slot.

Encoding. A cut before a space that follows a non-space, or before a stop that follows a letter, never
falls inside a token of a byte-level BPE with the usual pre-tokenizer, so each distinct piece between such
cuts is encoded once per task.

Defined cases: a null text is empty and gives the end id alone; an empty table gives an empty store; a
null key comes first and is found by a null; repeated rows are all written; ties in the key are ordered by the
text's hash; a very long text is a document of one shard. Extra columns are ignored. A key that the store lacks is
not found, but for one in 65,536 that share a fingerprint with another.
"""

from __future__ import annotations

import os
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.llm import arrays as A
from corpusflow.plans.dense_index import with_index
from corpusflow.sources.readers import scratch_path

END_ID = 2
SHARD_TOKENS = 2_000_000
MEMO_PIECES = 1_000_000
JOINED_BYTES = 1 << 16
FETCH_KEYS = 100_000
GAMMA = 2.0
_SPACE = ~A.NOT_SPACE
_STOP, _LETTER = np.zeros(256, dtype=bool), np.zeros(256, dtype=bool)
_STOP[[ord(c) for c in ",.;:!?"]] = True
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_PRINT = 0xA0761D6478BD642F
_MASK = (1 << 64) - 1


class Encoder:
    """Ids of whole columns of text; each distinct piece is encoded once while the memo lasts."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task's core only
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.id_bytes = np.zeros(max(vocab.values()) + 1, dtype=np.int64)
        for token, i in vocab.items():
            self.id_bytes[i] = len(token)  # the byte-level alphabet has one character for each byte
        self._clear()

    def _clear(self):
        self.known = A.HashTable(1 << 16)
        self.at = self.n = np.zeros(0, dtype=np.int64)
        self.flat = np.zeros(0, dtype=np.uint32)

    def _encode(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of the pieces, and where the ids of each begin and how many they are."""
        size = ends - starts
        at, n = np.zeros(len(size), dtype=np.int64), np.zeros(len(size), dtype=np.int64)
        # pieces that begin with a space and end without one are encoded in one go, and their ids told apart by
        # the bytes that ids stand for
        plain = (size > 1) & (buf[starts] == 0x20) & ~_SPACE[buf[np.minimum(starts + 1, len(buf) - 1)]] & ~_SPACE[buf[ends - 1]]
        p, out = np.flatnonzero(plain), []
        if len(p):
            stop = np.cumsum(size[p])
            raw = buf[np.arange(int(stop[-1])) + np.repeat(starts[p] - (stop - size[p]), size[p])].tobytes()
            cuts = np.append(stop[np.flatnonzero(np.diff(stop // JOINED_BYTES))], stop[-1]).tolist()
            texts = [raw[a:b].decode() for a, b in zip([0, *cuts], cuts)]
            out = [np.array(e.ids, dtype=np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            done = np.cumsum(self.id_bytes[np.concatenate(out)])
            last = np.searchsorted(done, stop)
            if last[-1] != len(done) - 1 or (done[last] != stop).any():
                raise ValueError("this tokenizer does not keep pieces apart at spaces")
            n[p] = np.diff(last, prepend=-1)
            at[p] = last + 1 - n[p]
        rest = np.flatnonzero(~plain)
        if len(rest):
            base = sum(map(len, out))
            texts = [buf[a:b].tobytes().decode() for a, b in zip(starts[rest].tolist(), ends[rest].tolist())]
            single = [np.array(e.ids, dtype=np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            n[rest] = [len(x) for x in single]
            at[rest] = base + np.cumsum(n[rest]) - n[rest]
            out += single
        return np.concatenate(out), at, n

    def column(self, col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids (no end ids) and the number of ids of each text."""
        buf, offs = A.text_bytes(col)
        n_docs = len(col)
        if not len(buf):
            return np.zeros(0, dtype=np.uint32), np.zeros(n_docs, dtype=np.int64)
        cut = np.zeros(len(buf), dtype=bool)
        cut[1:] = (buf[1:] == 0x20) & ~_SPACE[buf[:-1]] | _STOP[buf[1:]] & _LETTER[buf[:-1]]
        cut[offs[:-1][offs[:-1] < offs[1:]]] = True
        starts = np.flatnonzero(cut)
        ends = np.append(starts[1:], len(buf))
        doc = np.searchsorted(offs, starts, "right") - 1
        h = A.span_hashes(buf, starts, ends)
        if self.known.n > MEMO_PIECES:
            self._clear()
        slot = self.known.find(h)
        new = np.flatnonzero(slot < 0)
        if len(new):
            own, first, which = np.unique(h[new], return_index=True, return_inverse=True)
            first = new[first]
            ids, place, sizes = self._encode(buf, starts[first], ends[first])
            self.at, self.n = np.concatenate([self.at, place + len(self.flat)]), np.concatenate([self.n, sizes])
            self.flat = np.concatenate([self.flat, ids])
            slot[new] = self.known.add(own)[which]
        n, at = self.n[slot], self.at[slot]
        before = np.cumsum(n) - n
        ids = self.flat[np.arange(int(n.sum())) + np.repeat(at - before, n)]
        return ids, np.bincount(doc, weights=n, minlength=n_docs).astype(np.int64)


def key_hashes(keys: list) -> np.ndarray:
    """Hash of each (key, ordinal among equal keys before it)."""
    h = A.hash_words(["\0" if k is None else str(k) for k in keys])
    seen: dict = {}
    turn = np.empty(len(keys), dtype=np.uint64)
    for i, k in enumerate(keys):
        turn[i] = seen[k] = seen.get(k, -1) + 1
    return A.mix(h + turn * np.uint64(A._BASE))


def build_hash(h: np.ndarray) -> list[np.ndarray]:
    """Levels of bits: at each level the places that exactly one of the keys left has."""
    levels = []
    while len(h):
        if len(levels) > 60:
            raise ValueError("two keys of a shard have one 64-bit hash")
        place = _place(h, len(levels), max(64, int(GAMMA * len(h))))
        alone = np.bincount(place, minlength=max(64, int(GAMMA * len(h)))) == 1
        levels.append(alone)
        h = h[~alone[place]]
    return levels


def _place(h: np.ndarray, level: int, size: int) -> np.ndarray:
    return (A.mix(h + np.uint64((level + 1) * _PRINT & _MASK)) % np.uint64(size)).astype(np.int64)


class Shard:
    """One shard with its index opened."""

    def __init__(self, row: dict):
        self.row = row
        sizes = row["level_sizes"]
        bits = np.unpackbits(np.frombuffer(row["levels"], dtype=np.uint8), count=sum(sizes)).astype(bool)
        self.levels = np.split(bits, np.cumsum(sizes)[:-1]) if sizes else []
        rank = np.cumsum(bits) - 1
        self.ranks = np.split(rank, np.cumsum(sizes)[:-1]) if sizes else []
        self.prints = np.frombuffer(row["prints"], dtype="<u2")
        self.offsets = np.frombuffer(row["offsets"], dtype="<u8").astype(np.int64)
        self.lengths = np.frombuffer(row["lengths"], dtype="<u8").astype(np.int64)
        self.ids = np.frombuffer(row["payload"], dtype=f"<u{row['width']}")

    def slots(self, h: np.ndarray) -> np.ndarray:
        """Slot of each key hash; -1 where the index has no such key (up to the fingerprint)."""
        slot, left = np.full(len(h), -1, dtype=np.int64), np.arange(len(h))
        for level, (bits, rank) in enumerate(zip(self.levels, self.ranks)):
            place = _place(h[left], level, len(bits))
            hit = bits[place]
            slot[left[hit]] = rank[place[hit]]
            left = left[~hit]
        found = slot >= 0
        slot[found] = np.where(self.prints[slot[found]] == _fingerprint(h[found]), slot[found], -1)
        return slot

    def get(self, key, ordinal: int = 0) -> np.ndarray | None:
        """The ids of a document, or nothing."""
        h = A.mix(A.hash_words(["\0" if key is None else str(key)]) + np.uint64(ordinal * A._BASE & _MASK))
        s = int(self.slots(h)[0])
        return None if s < 0 else self.ids[self.offsets[s]:self.offsets[s] + self.lengths[s]]


def _fingerprint(h: np.ndarray) -> np.ndarray:
    return (A.mix(h ^ np.uint64(_PRINT)) >> np.uint64(48)).astype(np.uint16)


def _pack(part: int, seq: int, keys: list, lengths: list, ids: list, width: int) -> dict:
    h = key_hashes(keys)
    levels = build_hash(h)
    size = np.concatenate(lengths) if lengths else np.zeros(0, dtype=np.int64)
    flat = np.concatenate(ids) if ids else np.zeros(0, dtype=np.uint32)
    row = {"part": part, "seq": seq, "n_docs": len(keys), "n_tokens": len(flat), "width": width,
           "lo": keys[0] if keys else None, "hi": keys[-1] if keys else None, "keys": keys,
           "payload": flat.astype(f"<u{width}").tobytes(), "level_sizes": [len(x) for x in levels],
           "levels": np.packbits(np.concatenate(levels)).tobytes() if levels else b"",
           "prints": np.zeros(len(keys), dtype="<u2").tobytes(), "offsets": b"", "lengths": b""}
    bits = np.concatenate(levels) if levels else np.zeros(0, dtype=bool)
    rank, base = np.cumsum(bits) - 1, 0
    slot, left = np.zeros(len(keys), dtype=np.int64), np.arange(len(keys))
    for level, alone in enumerate(levels):
        place = _place(h[left], level, len(alone))
        hit = alone[place]
        slot[left[hit]] = rank[base + place[hit]]
        left, base = left[~hit], base + len(alone)
    start = np.cumsum(size) - size
    for name, value, kind in (("prints", _fingerprint(h), "<u2"), ("offsets", start, "<u8"), ("lengths", size, "<u8")):
        out = np.zeros(len(keys), dtype=kind)
        out[slot] = value
        row[name] = out.tobytes()
    return row


def _schema(kind: str) -> str:
    return (f"part int, seq int, n_docs long, n_tokens long, width int, lo {kind}, hi {kind}, keys array<{kind}>, payload binary, "
            "level_sizes array<int>, levels binary, prints binary, offsets binary, lengths binary")


def write_store(docs: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text: str = "text",
                end_id: int = END_ID, shard_tokens: int = SHARD_TOKENS) -> None:
    """Encode all documents in ascending key order and write the shards below ``path``."""
    kind = docs.schema[id_col].dataType.simpleString()
    part = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    keys = [F.col("id"), F.xxhash64("text")]
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = part.repartitionByRange(n, *keys).sortWithinPartitions(*keys)

    def run(batches):
        encoder = Encoder(tokenizer)
        width = 2 if max(len(encoder.id_bytes) - 1, end_id) < 1 << 16 else 4
        number, seq, keys_, sizes, ids, held, schema = TaskContext.get().partitionId(), 0, [], [], [], 0, None

        def shard():
            row = _pack(number, seq, keys_, sizes, ids, width)
            return pa.RecordBatch.from_arrays(
                [pa.array([row[f.name]], type=f.type) for f in schema], schema=schema)

        for batch in batches:
            schema = schema or pa.schema([
                ("part", pa.int32()), ("seq", pa.int32()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()),
                ("width", pa.int32()), ("lo", batch.schema.field("id").type),
                ("hi", batch.schema.field("id").type), ("keys", pa.list_(batch.schema.field("id").type)), ("payload", pa.binary()),
                ("level_sizes", pa.list_(pa.int32())), ("levels", pa.binary()), ("prints", pa.binary()),
                ("offsets", pa.binary()), ("lengths", pa.binary())])
            for rb in A.slices(batch, "text"):
                got, size = encoder.column(rb.column("text"))
                ends = np.cumsum(size)
                full = np.insert(got, ends, end_id)  # the end id behind each document's ids
                keys_ += rb.column("id").to_pylist()
                sizes.append(size + 1)
                ids.append(full)
                held += len(full)
                if held >= shard_tokens:
                    yield shard()
                    seq, keys_, sizes, ids, held = seq + 1, [], [], [], 0
        if keys_:
            yield shard()

    ranged.mapInArrow(A.released(run), _schema(kind)).write.option("compression", "zstd").parquet(path)


def read_documents(store: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, start, n_tokens, ids_crc32) of each document, looked up in the shards through their index.

    ``start`` counts the ids of all documents before it.
    """
    kind = store.schema["keys"].dataType.elementType.simpleString()
    names = ["part", "seq", "id", "off", "n_tokens", "ids_crc32"]

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                shard = Shard(row)
                slot = shard.slots(key_hashes(row["keys"]))
                if (slot < 0).any():
                    raise ValueError(f"shard {row['part']}/{row['seq']}: the index misses a key")
                off, n = shard.offsets[slot], shard.lengths[slot]
                ids = shard.ids.astype("<u4")
                crc = [zlib.crc32(ids[a:a + m]) for a, m in zip(off.tolist(), n.tolist())]
                m = len(slot)
                key_type = batch.schema.field("keys").type.value_type
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(m, row["part"]), pa.int32()), pa.array(np.full(m, row["seq"]), pa.int32()),
                     pa.array(row["keys"], type=key_type), pa.array(off), pa.array(n), pa.array(crc, pa.int64())], names=names)

    found = store.mapInArrow(A.released(run), f"part int, seq int, id {kind}, off long, n_tokens long, ids_crc32 long")
    base = with_index(store.select("part", "seq", F.col("n_tokens").alias("all")), ["part", "seq"], "base", weight="all")
    return found.join(base.select("part", "seq", "base"), ["part", "seq"]).select(
        F.col("id").alias(id_col), (F.col("base") + F.col("off")).alias("start"), "n_tokens", "ids_crc32")


def _shards_before(want: DataFrame, bound: DataFrame, inclusive: bool, name: str) -> DataFrame:
    """The wanted ids with the number of shards whose ``bound`` lies before (``inclusive``: or at) the id."""
    marks = bound.select(F.col("id"), F.lit(0 if inclusive else 2).alias("turn"), "ord")
    both = marks.unionByName(want.select("id", F.lit(1).alias("turn"), F.lit(None).cast("long").alias("ord")))
    order = [F.col("id").asc_nulls_first(), "turn", "ord"]
    return with_index(both, order, name, weight=(F.col("turn") != 1).cast("long")).filter("turn = 1").select("id", name)


def locate(store: DataFrame, keys: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(part, seq, id) of each distinct wanted key and the shards whose key range holds it; joins by equality only."""
    spans = with_index(store.select("part", "seq", "lo", "hi"), ["part", "seq"], "ord")
    want = keys.select(F.col(id_col).alias("id")).distinct()
    # a key that fills several shards lies in all of them
    first = _shards_before(want, spans.select(F.col("hi").alias("id"), "ord"), False, "first")
    after = _shards_before(want, spans.select(F.col("lo").alias("id"), "ord"), True, "after")
    hit = first.withColumnRenamed("id", "id_").join(after, F.col("id_").eqNullSafe(F.col("id"))).filter("first < after")
    hit = hit.select("id", F.explode(F.sequence("first", F.col("after") - 1)).alias("ord"))
    return hit.join(spans.select("part", "seq", "ord"), "ord").select("part", "seq", "id")


def fetch(store: DataFrame, keys: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, ids) of the wanted keys, a null among them; a key with several documents gives a row for each.

    Of a shard only the index and the ids of the wanted slots are opened, for at most about ``FETCH_KEYS`` keys at a time.
    """
    hit = locate(store, keys, id_col).checkpoint()
    many = hit.groupBy("part", "seq").agg(F.count(F.lit(1)).alias("n"))
    want = (hit.join(many, ["part", "seq"]).withColumn("piece", F.pmod(F.xxhash64("id"), F.ceil(F.col("n") / FETCH_KEYS)))
            .groupBy("part", "seq", "piece").agg(F.collect_list(F.struct("id")).alias("want")))
    kind = store.schema["keys"].dataType.elementType.simpleString()

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in batch.schema.names if c != "payload"}
                row["payload"] = batch.column("payload")[i].as_buffer()  # in place
                shard, ids, got = Shard(row), [], []
                for k in (w["id"] for w in row["want"]):
                    n = 0
                    while (x := shard.get(k, n)) is not None:
                        ids.append(k)
                        got.append(x.astype(np.int64).tolist())
                        n += 1
                key_type = batch.schema.field("want").type.value_type.field("id").type
                yield pa.RecordBatch.from_arrays([pa.array(ids, type=key_type), pa.array(got, pa.list_(pa.int64()))],
                                                 names=[id_col, "ids"])

    need = store.select("part", "seq", "width", "payload", "level_sizes", "levels", "prints", "offsets", "lengths")
    return need.join(want, ["part", "seq"]).mapInArrow(A.released(run), f"{id_col} {kind}, ids array<long>")


def encode_table(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text: str = "text", path: str | None = None,
                 **how) -> DataFrame:
    """Write a store (below the shared folder unless ``path`` is given) and read its documents back."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, "tokens")
    write_store(docs, path, tokenizer, id_col, text, **how)
    return read_documents(spark.read.parquet(path), id_col)
