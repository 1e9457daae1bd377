"""Column expressions for text: tokens, words, hashing buckets, keyword tests.

Patterns use only constructs that Java regex and RE2 read the same way
(``\\p{L}``, ``\\p{N}``, explicit space lists; no look-around, no back-references),
so the DuckDB oracles can run the same pattern.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: default tokenizer = runs of letters/digits, or one other non-space character
SPACE_CLASS = r"\t\n\x0B\f\r "
TOKEN_PATTERN = r"[\p{L}\p{N}]+|[^\p{L}\p{N}" + SPACE_CLASS + "]"
WORD_SPLIT = "[" + SPACE_CLASS + "]+"


def col_(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokens(text: Column | str) -> Column:
    """Default word/punctuation tokens of a text (array<string>)."""
    return F.regexp_extract_all(col_(text), F.lit(TOKEN_PATTERN), 0)


def words(text: Column | str) -> Column:
    """Whitespace-separated words, empty pieces removed."""
    return F.filter(F.split(col_(text), WORD_SPLIT, -1), lambda w: w != "")


def word_count(text: Column | str) -> Column:
    return F.size(words(text))


def seeded_unit(seed: int | str, key: Column | str) -> Column:
    """Deterministic number in [0, 1) from md5(seed|key): same in DuckDB, stable under repartition."""
    h = F.md5(F.concat(F.lit(f"{seed}|"), col_(key).cast("string")))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def seeded_int(seed: int | str, key: Column | str) -> Column:
    """Deterministic non-negative integer (32 bits) from md5(seed|key)."""
    h = F.md5(F.concat(F.lit(f"{seed}|"), col_(key).cast("string")))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint")


def contains_any(text: Column | str, keywords: Sequence[str]) -> Column:
    """Case-sensitive substring test against a keyword list."""
    c = col_(text)
    return reduce(lambda a, b: a | b, [c.contains(k) for k in keywords])


def nonempty(c: Column | str) -> Column:
    """Truthiness of a text: null and '' are both false."""
    return F.coalesce(F.length(col_(c)), F.lit(0)) > 0
