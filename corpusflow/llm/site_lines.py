"""Site-relative line removal: a line on too many of a host's pages is boilerplate.

Method. Per host, the number of pages that hold a line is divided by the host's number of pages; lines
whose share exceeds ``max_share`` (and that stand on ``min_pages`` pages at least, so a small site
keeps its text) are dropped from all pages of that host.

Plan. Lines go into the shuffle as 64-bit hashes, once per page and summed per task first, so a hot
host or line costs a few rows per task. A host's dropped lines are at most (its mean distinct lines per
page) / ``max_share``, so they are held in one array per host, which the pages meet by an equi-join on
host and salt. A host has a salt for every ``SALT_PAGES`` of its pages, so what a task reads does not grow
with a host; only the ``HOT_HOSTS`` largest hosts are looked up for that (a broadcast of as many rows), as any
other host holds less than that part of all pages. Lines are then dropped inside the row.

Defined cases: null or empty text has no lines; pages without a host keep all lines; a line that a page
repeats counts once for the page; repeated rows are pages of their own; an empty table gives no rows.
Extra columns are kept by ``drop_site_lines``; columns with the names of its outputs are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from corpusflow.llm import arrays as A

MAX_SHARE = 0.3
MIN_PAGES = 3
SALT_PAGES = 4096
HOT_HOSTS = 65_536

#: markup without text, and the tags at which a line ends
HIDDEN = r"(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->"
BREAKS = (r"(?i)\n|</?(?:p|div|li|ul|ol|h[1-6]|br|article|footer|nav|header|section|table|tr|td|th|title|head|body|html|"
          r"main|aside|blockquote|pre)(?:\s[^>]*)?/?>")
TAG = r"<[^>]*>"
SPACES = r"[ \t\r\n]+"


def html_lines(html: Column) -> Column:
    """Text lines of a page: cut at block tags, other markup removed, spaces collapsed, empty lines left out."""
    pieces = F.split(F.regexp_replace(F.coalesce(html, F.lit("")), HIDDEN, ""), BREAKS, -1)
    clean = F.transform(pieces, lambda x: F.trim(F.regexp_replace(F.regexp_replace(x, TAG, ""), SPACES, " ")))
    return F.filter(clean, lambda x: x != "")


def host_of(url: Column) -> Column:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    return F.translate(F.coalesce(F.regexp_extract(rest, r"^[^/?#]*", 0), F.lit("")), upper, lower)


def boilerplate(pages: DataFrame, max_share: float = MAX_SHARE, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, bad): hashes of the lines to drop, from (host, lines)."""
    with_host = pages.filter("host <> ''")
    line = with_host.select("host", F.explode(F.transform(F.array_distinct("lines"), lambda x: F.xxhash64(x))).alias("line"))
    count = line.groupBy("host", "line").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_pages)
    total = with_host.groupBy("host").agg(F.count(F.lit(1)).alias("total"))
    return (count.join(total, "host").filter(F.col("n") > F.lit(max_share) * F.col("total"))
            .groupBy("host").agg(F.collect_list("line").alias("bad")))


def salts_of(pages: DataFrame, salt_pages: int = SALT_PAGES) -> DataFrame:
    """(host, salts) of hosts with more than ``salt_pages`` pages, the ``HOT_HOSTS`` largest of them at most."""
    total = pages.filter("host <> ''").groupBy("host").agg(F.count(F.lit(1)).alias("total")).filter(F.col("total") > salt_pages)
    return total.orderBy(F.desc("total"), "host").limit(HOT_HOSTS).select("host", F.ceil(F.col("total") / salt_pages).alias("salts"))


def drop_site_lines(pages: DataFrame, host: Column, lines: Column, max_share: float = MAX_SHARE,
                    min_pages: int = MIN_PAGES, salt_pages: int = SALT_PAGES) -> DataFrame:
    """Every input column, and ``host``, ``n_lines``, ``n_dropped`` and ``text`` (the lines that stay)."""
    own = [c for c in pages.columns if c.lower() not in ("host", "n_lines", "n_dropped", "text")]
    at, all_, kept = (A.fresh(own, c) for c in ("salt", "lines", "stay"))
    known = A.fresh(own, "bad")
    part = pages.select(*own, F.coalesce(host, F.lit("")).alias("host"), F.coalesce(lines, F.array().cast("array<string>")).alias(all_))
    plain = [c for c in own if not isinstance(part.schema[c].dataType, MapType)]
    many = A.fresh(own, "salts")
    hot = F.broadcast(salts_of(part.select("host"), salt_pages).withColumnRenamed("salts", many))  # at most HOT_HOSTS rows
    n = F.coalesce(F.col(many), F.lit(1).cast("bigint"))
    bad = boilerplate(part.select("host", F.col(all_).alias("lines")), max_share, min_pages).withColumnRenamed("bad", known)
    bad = bad.join(hot, "host", "left").withColumn(at, F.explode(F.sequence(F.lit(0).cast("bigint"), n - 1))).drop(many)
    # pages without a host meet no lines: their salt is their own hash
    own_hash = F.xxhash64(*plain, all_)
    part = part.join(hot, "host", "left").withColumn(at, F.when(F.col("host") == "", own_hash).otherwise(F.pmod(own_hash, n))).drop(many)
    out = part.join(bad, ["host", at], "left")
    bad = F.coalesce(known, F.array().cast("array<bigint>"))
    stay = F.filter(all_, lambda x: ~F.array_contains(bad, F.xxhash64(x)))
    return (out.withColumn(kept, stay)
            .select(*own, "host", F.size(all_).cast("long").alias("n_lines"),
                    (F.size(all_) - F.size(kept)).cast("long").alias("n_dropped"),
                    F.array_join(kept, "\n").alias("text")))
