"""Chunking (group G).

Fixed and sliding windows are ``sequence`` + ``substring`` expressions exploded per
row: no Python, whole texts, one task per input split.  Recursive splitting on a
separator list is per-text logic that SQL cannot state, so it runs in an Arrow-batched
``mapInPandas`` over the same partitions (no shuffle, bounded per-row work).
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def chunk_fixed(df: DataFrame, col: str, n: int, max_chunks: int | None = None, out: str = "chunk") -> DataFrame:
    """Pieces of at most n characters; empty text gives no rows; keeps ``pos`` (0-based) and all columns."""
    if n < 1:
        raise ValueError("chunk size must be at least 1")
    starts = F.sequence(F.lit(1), F.greatest(F.length(col), F.lit(1)), F.lit(n))
    ex = df.filter(F.length(col) > 0).select("*", F.posexplode(starts).alias("pos", "_start"))
    if max_chunks is not None:
        ex = ex.filter(F.col("pos") < max_chunks)
    return ex.withColumn(out, F.substring(F.col(col), F.col("_start"), n)).drop("_start")


def chunk_sliding(df: DataFrame, col: str, size: int, overlap: int, out: str = "chunk") -> DataFrame:
    """Windows of ``size`` characters every ``size - overlap`` characters."""
    stride = size - overlap
    if stride < 1:
        raise ValueError("overlap must be smaller than size")
    starts = F.sequence(F.lit(0), F.greatest(F.length(col) - overlap, F.lit(1)) - 1, F.lit(stride))
    ex = df.filter(F.length(col) > 0).select("*", F.posexplode(starts).alias("pos", "_start"))
    return ex.withColumn(out, F.substring(F.col(col), F.col("_start") + 1, size)).drop("_start")


def chunk_summary(chunks: DataFrame, source: str, doc: str) -> DataFrame:
    return chunks.groupBy(source).agg(F.countDistinct(doc).alias("pages"), F.count(F.lit(1)).alias("chunks"))


def cut_spans(text: str, size: int, seps: Sequence[str]) -> list[tuple[int, int]]:
    """Spans of the text between separators: a span longer than ``size`` is cut at each separator in turn
    until it fits; the empty separator cuts between any two characters."""
    spans = [(0, len(text))]
    for sep in seps:
        finer: list[tuple[int, int]] = []
        for start, end in spans:
            if end - start <= size:
                finer.append((start, end))
            elif sep == "":
                finer.extend((i, i + 1) for i in range(start, end))
            else:
                edges = [m.start() for m in re.finditer(re.escape(sep), text[start:end])]
                starts = [start, *(start + e + len(sep) for e in edges)]
                finer.extend(zip(starts, [*(start + e for e in edges), end]))
        spans = [(a, b) for a, b in finer if b > a]
    return spans


def chunk_spans(text: str, size: int, overlap: int, seps: Sequence[str]) -> list[tuple[int, int]]:
    """Chunks as spans of the text: as many cut spans in a row as ``size`` holds (one that no separator could
    shorten stands alone), the next chunk starting at the earliest span within ``overlap`` of this one's end
    that leaves room for a new span."""
    if not 0 <= overlap < size:
        raise ValueError("overlap must be less than the chunk size")
    spans = cut_spans(text, size, seps)
    starts, ends = [a for a, _ in spans], [b for _, b in spans]
    out, first = [], 0
    while first < len(spans):
        last = max(first, bisect_right(ends, starts[first] + size) - 1)
        out.append((starts[first], ends[last]))
        if last + 1 == len(spans):
            break
        room = max(ends[last] - overlap, ends[last + 1] - size)
        first = min(max(first + 1, bisect_left(starts, room)), last + 1)
    return out


def chunk_text(text: str, size: int, overlap: int, seps: Sequence[str]) -> list[str]:
    """The chunks without white space at their ends; blank ones go."""
    chunks = (text[a:b].strip() for a, b in chunk_spans(text, size, overlap, seps))
    return [c for c in chunks if c]


def chunk_recursive(df: DataFrame, key: str, col: str, size: int, overlap: int,
                    seps: Sequence[str] = ("\n\n", "\n", " ", "")) -> DataFrame:
    """Recursive character chunking: (key, pos, chunk) rows, whole texts, per-partition Arrow batches."""
    import pandas as pd

    seps = list(seps)

    def run(batches):
        for pdf in batches:
            keys, poss, chunks = [], [], []
            for k, text in zip(pdf[key], pdf[col]):
                if text is None:
                    continue
                for i, c in enumerate(chunk_text(text, size, overlap, seps)):
                    keys.append(k)
                    poss.append(i)
                    chunks.append(c)
            yield pd.DataFrame({key: keys, "pos": poss, "chunk": chunks})

    kt = df.schema[key].dataType.simpleString()
    return df.select(key, col).mapInPandas(run, f"{key} {kt}, pos int, chunk string")


def chunk_by_separator(df: DataFrame, key: str, col: str, sep: str, size: int, overlap: int) -> DataFrame:
    return chunk_recursive(df, key, col, size, overlap, seps=[sep])
