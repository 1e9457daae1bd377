"""Text cleaning and scalar extraction (group E), as column expressions.

HTML is handled by regular expressions that Java and RE2 read alike: script, style
and comment blocks are removed first (the fixture hides ``</p>`` inside scripts),
then paragraph bodies are extracted, tags stripped and common entities decoded.
A real DOM parser can replace :func:`html_paragraphs` through ``mapInPandas``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.functions.text import col_

DROP_BLOCKS = r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->"
# fixed values: HTML entities decoded after tag stripping (ampersand last)
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")]
# fixed values: characters counted as emoji by the title marker (JS \p{Emoji} also matches # * and digits)
EMOJI_CLASS = r"[#*0-9\x{00A9}\x{00AE}\x{203C}-\x{3299}\x{1F000}-\x{1FAFF}]"
TITLE_MARK = "\U0001F4AC "


def decode_entities(c: Column) -> Column:
    for a, b in ENTITIES:
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def paragraph_texts(html: Column | str) -> Column:
    """Array of the text of each ``<p>`` element (tags stripped, entities decoded)."""
    clean = F.regexp_replace(col_(html), DROP_BLOCKS, "")
    ps = F.regexp_extract_all(clean, F.lit(r"(?is)<p\b[^>]*>(.*?)</p>"), 1)
    return F.transform(ps, lambda p: decode_entities(F.regexp_replace(p, "<[^>]*>", "")))


def html_paragraphs(html: Column | str, mode: str = "reference") -> Column:
    """Paragraph texts joined by a space; null when the page has no paragraph.

    ``mode='reference'`` deletes double spaces and line breaks (words may fuse, as in the
    reference); ``mode='collapse'`` turns runs of whitespace into one space instead.
    """
    ps = paragraph_texts(html)
    joined = F.array_join(ps, " ")
    if mode == "reference":
        out = F.regexp_replace(joined, r" {2}|\r\n|\n|\r", "")
    else:
        out = F.trim(F.regexp_replace(joined, r"[\t\n\x0B\f\r ]+", " "))
    return F.when(F.size(ps) > 0, out)


def extract_links(df: DataFrame, html: str, key: str, prefix: str = "/url?q=", exclude: str = "google.com/") -> DataFrame:
    """Distinct hrefs starting with ``prefix`` (not containing ``exclude``), cut at ``&sa=``, first-seen order kept."""
    hrefs = F.regexp_extract_all(col_(html), F.lit(r"(?i)<a\b[^>]*\bhref=\"([^\"]*)\""), 1)
    ex = df.select(key, F.posexplode(hrefs).alias("pos", "href"))
    ex = ex.filter(F.col("href").startswith(prefix) & ~F.col("href").contains(exclude))
    link = F.substring_index(F.substring(F.col("href"), len(prefix) + 1, 1 << 30), "&sa=", 1)
    return ex.select(key, "pos", link.alias("link")).groupBy(key, "link").agg(F.min("pos").cast("bigint").alias("first_pos"))


def extract_tag(c: Column | str, tag: str, all_: bool = False) -> Column:
    """Text inside ``<tag>``: the last match, or all matches; null when absent."""
    found = F.regexp_extract_all(col_(c), F.lit(f"(?is)<{tag}\\b[^>]*>(.*?)</{tag}>"), 1)
    if all_:
        return F.when(F.size(found) > 0, found)
    return F.try_element_at(found, F.lit(-1))


def parse_choices(df: DataFrame, col: str, n_choices: int, key: str) -> DataFrame:
    """Lines ``Doc: n, Relevance: r``: keep lines with exactly one comma and n <= number of choices."""
    ex = df.select(key, F.posexplode(F.split(F.col(col), "\n", -1)).alias("line_no", "line"))
    parts = F.split("line", ",", -1)
    ex = ex.filter(F.size(parts) == 2)
    doc = F.trim(F.element_at(F.split(parts[0], ":", -1), -1)).try_cast("int")
    rel = F.trim(F.element_at(F.split(parts[1], ":", -1), -1)).try_cast("double")
    return ex.select(key, F.col("line_no").cast("bigint").alias("line_no"), doc.alias("doc"), rel.alias("relevance")).filter(F.col("doc") <= n_choices)


def parse_verdict(df: DataFrame, col: str, key: str) -> DataFrame:
    """First line safe/unsafe; second line comma-separated categories (one row each)."""
    lines = F.split(F.col(col), "\n", -1)
    verdict = F.trim(lines[0])
    cats = F.when(F.size(lines) > 1, F.split(lines[1], ",", -1)).otherwise(F.array().cast("array<string>"))
    return df.select(key, verdict.alias("verdict"), F.explode_outer(cats).alias("category")).withColumn("category", F.trim("category"))


def strip_echo(gen: Column | str, prompt: Column | str) -> Column:
    return F.replace(col_(gen), col_(prompt), F.lit(""))


def fallback_title(first_message: Column | str) -> Column:
    """First five whitespace-separated pieces of the first user message."""
    return F.array_join(F.slice(F.split(col_(first_message), r"\s+", -1), 1, 5), " ")


def mark_title(c: Column | str) -> Column:
    """Prefix a speech-bubble mark when the first three characters hold no emoji."""
    c = col_(c)
    return F.when(F.substring(c, 1, 3).rlike(EMOJI_CLASS), c).otherwise(F.concat(F.lit(TITLE_MARK), c))


def word_counts(df: DataFrame, text: str, by: str) -> DataFrame:
    """Words per group and the grand total (rollup row with a null key)."""
    from corpusflow.functions.text import word_count

    return df.rollup(by).agg(F.sum(word_count(text)).cast("bigint").alias("words"))


def doc_stats(df: DataFrame, text: str) -> DataFrame:
    """Integer average character length and count."""
    return df.agg(F.count(F.lit(1)).alias("n"), F.floor(F.sum(F.length(text)) / F.count(F.lit(1))).cast("bigint").alias("avg_chars"))


def is_message_id(c: Column | str) -> Column:
    return F.size(F.split(col_(c), "-", -1)) == 5


# fixed values: units of the serving log and their factor to milliseconds
LOG_UNITS = {"s": 1000.0, "ms": 1.0, "us": 0.001, "µs": 0.001}
LOG_FIELDS = ["total_time", "validation_time", "queue_time", "inference_time", "time_per_token"]


def log_field_ms(line: Column, field: str) -> Column:
    num = F.regexp_extract(line, f'{field}="([0-9.]+)([a-zµ]+)"', 1).try_cast("double")
    unit = F.regexp_extract(line, f'{field}="([0-9.]+)([a-zµ]+)"', 2)
    factor = None
    for u, f in LOG_UNITS.items():
        factor = F.when(unit == u, F.lit(f)) if factor is None else factor.when(unit == u, F.lit(f))
    return num * factor


def parse_serving_log(df: DataFrame, col: str) -> DataFrame:
    """Timing fields in ms and time to first token = validation + queue + one token."""
    line = F.col(col)
    out = df.select("*", *[log_field_ms(line, f).alias(f"{f}_ms") for f in LOG_FIELDS])
    return out.withColumn("ttft_ms", F.col("validation_time_ms") + F.col("queue_time_ms") + F.col("time_per_token_ms"))


def generation_cost(ms: Column, price_per_hour: float) -> Column:
    return ms * F.lit(price_per_hour) / F.lit(3.6e6)


def order_hits(df: DataFrame, snippets: str, per: str, key: str) -> DataFrame:
    """Hits of a query ordered by text length, longest first; missing snippets become ''."""
    text = F.coalesce(F.array_join(F.col(snippets), "\n"), F.lit(""))
    w = Window.partitionBy(per).orderBy(F.length(text).desc(), F.col(key))
    return df.withColumn("text", text).withColumn("rank", F.row_number().over(w))
