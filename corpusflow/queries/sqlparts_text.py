"""DuckDB spellings of corpusflow.functions.text (same patterns, same hash buckets)."""

from corpusflow.functions.text import TOKEN_PATTERN, WORD_SPLIT


def tokens(x: str) -> str:
    return f"regexp_extract_all({x}, '{TOKEN_PATTERN}')"


def words(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, '{WORD_SPLIT}'), lambda w: w <> '')"


def unit(seed, key: str) -> str:
    return f"(CAST(('0x' || substr(md5('{seed}|' || CAST({key} AS VARCHAR)), 1, 8)) AS BIGINT) / 4294967296.0)"


def sint(seed, key: str) -> str:
    return f"CAST(('0x' || substr(md5('{seed}|' || CAST({key} AS VARCHAR)), 1, 8)) AS BIGINT)"


def hash_embed(x: str, dim: int = 32) -> str:
    """DuckDB twin of corpusflow.functions.vectors.hash_embed."""
    b = f"list_transform({tokens(f'lower({x})')}, lambda tk: CAST(('0x' || substr(md5(tk), 1, 8)) AS BIGINT) % {dim})"
    c = f"list_transform(range({dim}), lambda i: CAST(len(list_filter({b}, lambda bb: bb = i)) AS DOUBLE))"
    return f"list_transform({c}, lambda v: CASE WHEN sqrt(list_sum(list_transform({c}, lambda z: z * z))) > 0 THEN v / sqrt(list_sum(list_transform({c}, lambda z: z * z))) ELSE 0.0 END)"
