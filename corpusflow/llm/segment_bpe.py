"""BPE encoding and decoding with a segment tree over the ranks of adjacent pairs.

A piece of text (a word) is a row of symbols. Leaf ``i`` of its tree holds the rank of the pair that
starts at symbol ``i``, joined with ``i``; an inner node the smaller of its children. So the root is the
leftmost pair of the lowest rank. Merging it changes three leaves (the pair, the symbol it swallows, the
pair before it), each set by a point update up the tree, until the root holds no mergeable pair.
:func:`forest` walks the trees of many short pieces in step, with one array operation per level for all
of them; :func:`tree` is the same for one long piece.

Tokenizer files: BPE over bytes written as printable characters, an end-of-word suffix on a piece's last
symbol, normalisation NFC and lower case, pieces cut by :data:`PIECE`; special tokens are found in the raw
text and are ids of their own. Decoding joins the tokens' strings by a space, as such files, which have
no decoder, ask for.

Plan: one ``mapInArrow`` over the documents, no shuffle. A task encodes each distinct stretch between white
space of a slice of text once; a memo of about ``MEMO_STRETCHES`` of them spans its slices and only saves time.

Defined cases: a null or empty text has no ids and an empty decoded text; repeated rows are each encoded;
an empty table gives an empty table. Texts are encoded whole: memory follows the longest text, and a piece
of n bytes takes O(n log n) time. Extra columns are carried along; an output column replaces an input
column of the same name. Code points that Python's Unicode data does not have are normalised and cut by the
tokenizers library.
"""

from __future__ import annotations

import json
import re
import unicodedata

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from corpusflow.llm import arrays as A

#: fixed values: the tokenizer file's pattern of pieces
PIECE = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"
MEMO_STRETCHES = 700_000
#: pieces of up to so many bytes are merged in step
SHORT = 64
#: tree cells worked at a time
CELLS = 1 << 20
SLICE_BYTES = 4 << 20
NONE = 1 << 62


def byte_symbols() -> list[str]:
    """The character that stands for each byte: itself if printable in Latin-1, else the next one from 256."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, n = {b: chr(b) for b in shown}, 256
    for b in range(256):
        if b not in out:
            out[b], n = chr(n), n + 1
    return [out[b] for b in range(256)]


class Bpe:
    """Vocabulary, pair ranks and special tokens of a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, vocab = spec["model"], spec["model"]["vocab"]
        self.path = path
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.size = 1 + max([*vocab.values(), *self.special.values()])
        suffix = model.get("end_of_word_suffix") or ""
        chars = byte_symbols()
        self.first = np.array([vocab[c] for c in chars], dtype=np.int64)
        self.last = np.array([vocab[c + suffix] for c in chars], dtype=np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in pairs] + [NONE], dtype=np.int64)
        new = np.array([vocab[a + b] for a, b in pairs] + [0], dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.new = keys[order], order, new
        self.pairs = dict(zip(keys[:-1].tolist(), range(len(pairs))))
        # token strings, each with the space that joins it to the next
        strings = [""] * self.size
        for t, i in (vocab | self.special).items():
            strings[i] = t
        raw = [s.encode() + b" " for s in strings]
        self.token_bytes = np.frombuffer(b"".join(raw), dtype=np.uint8)
        self.token_size = np.array([len(r) for r in raw], dtype=np.int64)
        self.token_start = np.cumsum(self.token_size) - self.token_size

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids; ``NONE`` for a pair that never merges."""
        key = a * self.size + b
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.ranks[at], NONE)


def _width(n: int) -> int:
    return 1 << max(0, n - 1).bit_length()


def tree(bpe: Bpe, symbols: list[int]) -> list[int]:
    """Ids of one piece."""
    n, pairs, size, new = len(symbols), bpe.pairs, bpe.size, bpe.new
    if n < 2:
        return list(symbols)
    sym, w = list(symbols), _width(n)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))

    def leaf(i: int) -> int:
        j = after[i]
        r = pairs.get(sym[i] * size + sym[j]) if j < n else None
        return NONE if r is None else r * w + i

    node = [NONE] * (2 * w)
    node[w:w + n] = [leaf(i) for i in range(n)]
    for k in range(w - 1, 0, -1):
        node[k] = min(node[2 * k], node[2 * k + 1])

    def update(i: int, value: int) -> None:
        k = w + i
        node[k] = value
        while k > 1:
            k >>= 1
            value = min(node[2 * k], node[2 * k + 1])
            if node[k] == value:
                break
            node[k] = value

    while node[1] != NONE:
        rank, i = divmod(node[1], w)
        j = after[i]
        sym[i], sym[j] = int(new[rank]), -1
        after[i] = after[j]
        if after[j] < n:
            before[after[j]] = i
        update(j, NONE)
        update(i, leaf(i))
        if before[i] >= 0:
            update(before[i], leaf(before[i]))
    return [s for s in sym if s >= 0]


def forest(bpe: Bpe, flat: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of many pieces, given their bytes in a row: all ids, and how many each piece has."""
    size = np.diff(offs)
    count = np.zeros(len(size), dtype=np.int64)
    done: list[tuple[np.ndarray, np.ndarray]] = []  # pieces, their ids in a row
    widths = 1 << np.ceil(np.log2(np.maximum(size, 1))).astype(np.int64)
    for w in np.unique(widths[size > 0]).tolist():
        which = np.flatnonzero((widths == w) & (size > 0))
        step = max(1, CELLS // w) if w <= SHORT else 1
        for k in range(0, len(which), step):
            part = which[k:k + step]
            if w > SHORT:
                raw = flat[offs[part[0]]:offs[part[0] + 1]]
                ids = np.array(tree(bpe, [*bpe.first[raw[:-1]].tolist(), int(bpe.last[raw[-1]])]), dtype=np.int64)
                count[part] = len(ids)
            else:
                sym = _in_step(bpe, flat, offs[part], size[part], w)
                kept = sym >= 0
                ids = sym[kept]
                count[part] = kept.sum(axis=1)
            done.append((part, ids))
    starts = np.cumsum(count) - count
    out = np.zeros(int(count.sum()), dtype=np.int64)
    for part, ids in done:
        n = count[part]
        out[np.repeat(starts[part] - (np.cumsum(n) - n), n) + np.arange(len(ids))] = ids
    return out, count


def _in_step(bpe: Bpe, flat: np.ndarray, starts: np.ndarray, size: np.ndarray, w: int) -> np.ndarray:
    """Symbols of pieces of at most ``w`` bytes after all merges, -1 where one was swallowed.

    All arrays are flat: symbol ``i`` of piece ``r`` is at ``r * w + i``, node ``k`` of its tree at ``r * 2w + k``.
    """
    rows, col = len(starts), np.arange(w)
    raw = flat[np.minimum(starts[:, None] + col, len(flat) - 1)]
    sym = np.where(col < size[:, None], bpe.first[raw], -1).ravel()
    ends = np.arange(rows) * w + size
    sym[ends - 1] = bpe.last[raw[np.arange(rows), size - 1]]
    if w == 1:
        return sym.reshape(rows, w)
    cell = np.arange(rows * w)
    after, before = cell + 1, cell - 1
    before[::w] = -1
    node = np.full((rows, 2 * w), NONE, dtype=np.int64)
    c = np.flatnonzero(cell + 1 < np.repeat(ends, w))
    rank = bpe.rank(sym[c], sym[c + 1])
    leaves = np.full(rows * w, NONE, dtype=np.int64)
    leaves[c] = np.where(rank == NONE, NONE, rank * w + c % w)
    node[:, w:] = leaves.reshape(rows, w)
    k = w
    while k > 1:
        node[:, k // 2:k] = np.minimum(node[:, k:2 * k:2], node[:, k + 1:2 * k:2])
        k //= 2
    node = node.ravel()

    def update(at: np.ndarray, value: np.ndarray) -> None:
        r = at // w * (2 * w)
        k = at % w + w
        node[r + k] = value
        for _ in range(w.bit_length() - 1):
            pair = r + (k & -2)
            k = k >> 1
            node[r + k] = np.minimum(node[pair], node[pair + 1])

    def leaf(at: np.ndarray) -> np.ndarray:
        j = after[at]
        ok = np.flatnonzero(j < ends[at // w])
        out = np.full(len(at), NONE, dtype=np.int64)
        rank = bpe.rank(sym[at[ok]], sym[j[ok]])
        out[ok] = np.where(rank == NONE, NONE, rank * w + at[ok] % w)
        return out

    live = np.flatnonzero(node[1::2 * w] != NONE)
    while len(live):
        rank, i = np.divmod(node[live * (2 * w) + 1], w)
        i += live * w
        j = after[i]
        sym[i], sym[j] = bpe.new[rank], -1
        then = after[j]
        after[i] = then
        more = then < ends[live]
        before[then[more]] = i[more]
        update(j, np.full(len(j), NONE, dtype=np.int64))
        update(i, leaf(i))
        left = before[i]
        left = left[left >= 0]
        update(left, leaf(left))
        live = live[node[live * (2 * w) + 1] != NONE]
    return sym.reshape(rows, w)


class Encoder:
    """Ids of whole texts. Texts are cut at ASCII white space, which no piece and no special token holds; a
    stretch between is encoded once while it is in the memo, a table of ids with a place for each stretch."""

    def __init__(self, path: str):
        self.bpe = Bpe(path)
        self.piece, self.line_or_piece = regex.compile(PIECE), regex.compile(PIECE + r"|\n")
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(self.bpe.special, key=len, reverse=True))) + ")")
        self.known: set[str] = set()
        self.library = None
        self._forget()

    def _forget(self) -> None:
        self.memo: dict[str, int] = {}
        self.ids = np.zeros(0, dtype=np.int32)
        self.ends = np.zeros(1, dtype=np.int64)

    def _pieces(self, text: str) -> list[str]:
        """Pieces of a stretch of text, special tokens among them."""
        out: list[str] = []
        for k, part in enumerate(self.special.split(text)):
            if k % 2:
                out.append(part)
            elif any(unicodedata.category(c) == "Cn" for c in part):
                out += self._library_cut(part)
            else:
                out += self.piece.findall(normal(part))
        return out

    def _library_cut(self, text: str) -> list[str]:
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_file(self.bpe.path)
            back = {c: b for b, c in enumerate(byte_symbols())}
            self.from_symbols = lambda s: bytes(back[c] for c in s).decode()
        t = self.library
        return [self.from_symbols(p) for p, _ in t.pre_tokenizer.pre_tokenize_str(t.normalizer.normalize_str(text))]

    def _cut(self, stretches: list[str]) -> list[str]:
        """Pieces of all stretches in a row, a line break after each stretch but the last."""
        joined = "\n".join(stretches)
        new = set(joined) - self.known
        odd = {c for c in new if unicodedata.category(c) == "Cn"}
        self.known |= new - odd
        if not odd and not self.special.search(joined):
            return self.line_or_piece.findall(normal(joined))
        return [p for k, s in enumerate(stretches) for p in (["\n"] if k else []) + self._pieces(s)]

    def _learn(self, stretches: list[str]) -> None:
        """Put new stretches into the table: their distinct pieces go through the trees together."""
        cut = self._cut(stretches)
        place = {p: k for k, p in enumerate(set(cut) - self.bpe.special.keys() - {"\n"})}
        raw = [p.encode() for p in place]
        ids, n = forest(self.bpe, np.frombuffer(b"".join(raw), dtype=np.uint8), np.cumsum([0, *map(len, raw)]))
        # a special token is a piece of one id, a line break one of none
        place |= {t: len(raw) + k for k, t in enumerate([*self.bpe.special, "\n"])}
        ids = np.concatenate((ids, np.fromiter(self.bpe.special.values(), dtype=np.int64)))
        n = np.concatenate((n, np.ones(len(self.bpe.special), dtype=np.int64), [0]))
        at = np.fromiter(map(place.__getitem__, cut), dtype=np.int64, count=len(cut))
        flat, ends = take(ids, np.concatenate(([0], np.cumsum(n))), at)
        ends = np.append(ends[np.flatnonzero(at == len(n) - 1)], ends[-1])
        self.memo.update(zip(stretches, range(len(self.memo), len(self.memo) + len(stretches))))
        self.ends = np.concatenate((self.ends, ends + len(self.ids)))
        self.ids = np.concatenate((self.ids, flat.astype(np.int32)))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and the ``n + 1`` offsets of the texts."""
        buf, offs = A.text_bytes(texts)
        keep = A.NOT_SPACE[buf]
        starts, ends, doc = A.runs(keep, offs)
        at = np.concatenate(([0], np.cumsum(ends - starts)))
        words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(at), pa.py_buffer(buf[keep])).dictionary_encode()
        distinct = words.dictionary.to_pylist()
        if len(self.memo) > MEMO_STRETCHES:
            self._forget()
        new = [w for w in distinct if w not in self.memo]
        if new:
            self._learn(new)
        rows = np.fromiter(map(self.memo.__getitem__, distinct), dtype=np.int64, count=len(distinct))
        flat, ends = take(self.ids, self.ends, rows[words.indices.to_numpy()])
        return flat, ends[np.concatenate(([0], np.cumsum(np.bincount(doc, minlength=len(texts)))))]


def normal(text: str) -> str:
    """NFC, then each character in lower case by itself (a sigma is never a final one)."""
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


def take(flat: np.ndarray, ends: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a ragged table in the given order: values in a row, and the ``n + 1`` offsets."""
    size = ends[rows + 1] - ends[rows]
    out = np.concatenate(([0], np.cumsum(size)))
    return flat[np.arange(out[-1]) + np.repeat(ends[rows] - out[:-1], size)], out


def decode_ids(bpe: Bpe, ids: np.ndarray, offs: np.ndarray) -> pa.Array:
    """Texts of rows of ids: token strings joined by a space. Ids outside the vocabulary have no string."""
    fine = (ids >= 0) & (ids < bpe.size)
    if not fine.all():
        offs = np.concatenate(([0], np.cumsum(fine)))[offs]
        ids = ids[fine]
    size = bpe.token_size[ids]
    # a row's last token ends without the space
    full = np.flatnonzero(np.diff(offs))
    size[offs[full + 1] - 1] -= 1
    ends = np.concatenate(([0], np.cumsum(size)))
    at = np.arange(ends[-1]) + np.repeat(bpe.token_start[ids] - ends[:-1], size)
    data = bpe.token_bytes[at]
    return pa.LargeStringArray.from_buffers(len(offs) - 1, pa.py_buffer(ends[offs].astype(np.int64)), pa.py_buffer(data))


def _with(rb: pa.RecordBatch, new: dict[str, pa.Array]) -> pa.RecordBatch:
    cols = {n: rb.column(n) for n in rb.schema.names if n.lower() not in {k.lower() for k in new}} | new
    return pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))


def _schema(docs: DataFrame, new: dict) -> StructType:
    taken = {n.lower() for n in new}
    return StructType([f for f in docs.schema.fields if f.name.lower() not in taken]
                      + [StructField(n, t, False) for n, t in new.items()])


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str | None = None) -> DataFrame:
    """``docs`` with the token ids of ``text`` and, if ``decoded`` names a column, the text they decode to."""
    new = {ids: ArrayType(IntegerType(), False)} | ({decoded: StringType()} if decoded else {})

    def run(batches):
        enc = Encoder(path)
        for batch in batches:
            for rb in A.slices(batch, text, SLICE_BYTES):
                flat, offs = enc.encode(rb.column(text))
                cols = {ids: pa.ListArray.from_arrays(pa.array(offs, type=pa.int32()), pa.array(flat, type=pa.int32()))}
                if decoded:
                    cols[decoded] = decode_ids(enc.bpe, flat, offs).cast(pa.string())
                yield _with(rb, cols)

    return docs.mapInArrow(run, _schema(docs, new))


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``df`` with the text of its rows of ids; a null row, and a null in one, is as if not there."""

    def run(batches):
        bpe = Bpe(path)
        for rb in batches:
            col = rb.column(ids)
            offs = np.concatenate(([0], np.cumsum(pa.compute.fill_null(pa.compute.list_value_length(col), 0).to_numpy())))
            flat = pa.compute.fill_null(col.flatten(), -1).to_numpy(zero_copy_only=False).astype(np.int64)
            yield _with(rb, {text: decode_ids(bpe, flat, offs).cast(pa.string())})

    return df.mapInArrow(run, _schema(df, {text: StringType()}))
