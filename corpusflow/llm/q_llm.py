"""Registered queries of the operators in this package, with DuckDB SQL where SQL can state the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.llm import (
    decontaminate, hyperminhash, lexical_search, license_templates, mixing, perplexity, segment_bpe, site_lines, surrogates,
    token_store, toxicity, url_filter, vector_codes,
)
from corpusflow.sources.readers import scratch_path


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with detected entities replaced by surrogates."""
    out = surrogates.replace_pii(_read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "text", "n_entities", "entity_types")


def labelled_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The small labelled URL table: urls of pages whose number has a label; 1 where its quality is 0."""
    labels = _read(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), (F.col("quality") == 0).alias("label"))
    return _read(spark, sf_dir, "pages").select("page_id", "url").join(labels, "page_id").select("url", "label")


def op2_url_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url judged by the rules, else by the regression on host and path n-grams."""
    pages = _read(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge(pages, labelled_urls(spark, sf_dir)).select("page_id", "host", "path", "rule", "verdict", "score")


def op3_suffix_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages in all documents: runs of ten item words, or a whole shorter item."""
    found = decontaminate.contamination_table(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op4_budget_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed by source to 150 % of their words; weights 3, 1, 2 in turn."""
    return mixing.mix_table(_read(spark, sf_dir, "documents"))


def op5_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents: five-word shingles, Jaccard 0.75 or more."""
    return hyperminhash.near_duplicates(_read(spark, sf_dir, "documents"))


def op6_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token ids in shards with a perfect hash index, read back."""
    return token_store.encode_table(_read(spark, sf_dir, "documents"), tokenizer_path())


def op7_string_kernel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of all documents; trained on labels outside the held-out third."""
    return toxicity.toxicity_table(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op8_perplexity_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality rules and Kneser-Ney perplexity bands over all documents."""
    return perplexity.quality_table(_read(spark, sf_dir, "documents"))


def op9_license_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and accepted templates in all documents."""
    return license_templates.scan(_read(spark, sf_dir, "documents")).drop("places")


def op10_site_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages without the lines that stand on more than 30 % of their host's pages."""
    pages = _read(spark, sf_dir, "pages").select("page_id", "url", "html")
    out = site_lines.drop_site_lines(pages, site_lines.host_of(F.col("url")), site_lines.html_lines(F.col("html")))
    return out.select("page_id", "host", "n_lines", "n_dropped", "text")


def op11_segment_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token ids by segment-tree BPE, and decoded again."""
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    coded = segment_bpe.encode(docs, tokenizer_path("word_bpe_49k.json"), decoded="decoded")
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_term_at_a_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents for each benchmark item."""
    return lexical_search.search(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op13_hilbert_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings as four one-byte codes, with the error per vector and label."""
    coded, books = vector_codes.compress(_read(spark, sf_dir, "embeddings"))
    path = scratch_path(spark, "vector-codes")
    coded.write.parquet(path)
    out = vector_codes.with_label_error(spark.read.parquet(path), "label")
    return out.select("vec_id", "code", "error", "label_error", F.lit(vector_codes.codebook_digest(books)).alias("codebooks_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_surrogates": op1_surrogates,
    "op2_url_regression": op2_url_regression,
    "op3_suffix_automaton": op3_suffix_automaton,
    "op4_budget_fit": op4_budget_fit,
    "op5_hyperminhash": op5_hyperminhash,
    "op6_token_store": op6_token_store,
    "op7_string_kernel": op7_string_kernel,
    "op8_perplexity_rules": op8_perplexity_rules,
    "op9_license_templates": op9_license_templates,
    "op10_site_lines": op10_site_lines,
    "op11_segment_bpe": op11_segment_bpe,
    "op12_term_at_a_time": op12_term_at_a_time,
    "op13_hilbert_codes": op13_hilbert_codes,
}

_ASCII_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all(" + _ASCII_LOWER + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP3_SQL = f"""
WITH i AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_WORDS.format("coalesce(text, '')")} AS w FROM benchmark),
ik AS (SELECT item, w, least(10, len(w)) AS k FROM i WHERE len(w) > 0),
iw AS (SELECT DISTINCT k, array_to_string(w[p:p + k - 1], ' ') AS win, item
       FROM (SELECT *, unnest(range(1, CAST(len(w) - k + 2 AS BIGINT))) AS p FROM ik)),
d AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
ks AS (SELECT DISTINCT k FROM iw),
dw AS (SELECT doc_id, k, p, array_to_string(w[p:p + k - 1], ' ') AS win
       FROM (SELECT doc_id, w, k, unnest(range(1, CAST(len(w) - k + 2 AS BIGINT))) AS p FROM d, ks WHERE len(w) >= k)),
m AS (SELECT DISTINCT dw.doc_id, dw.k, dw.p, iw.item FROM dw JOIN iw USING (k, win)),
hit AS (SELECT doc_id, count(DISTINCT x) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(p, p + k)) AS x FROM m) GROUP BY 1),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS s FROM (SELECT DISTINCT doc_id, item FROM m) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(s, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)
"""

_HOST = _ASCII_LOWER.format(r"CASE WHEN instr(url, '://') > 0 THEN regexp_extract(substr(url, instr(url, '://') + 3), '^[^/?#]*') ELSE '' END")


def _sql(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


OP10_SQL = f"""
WITH p AS (SELECT row_number() OVER () AS r, page_id, {_HOST} AS host,
  list_filter(list_transform(string_split_regex(regexp_replace(coalesce(html, ''), {_sql(site_lines.HIDDEN)}, '', 'g'), {_sql(site_lines.BREAKS)}),
    lambda x: trim(regexp_replace(regexp_replace(x, {_sql(site_lines.TAG)}, '', 'g'), {_sql(site_lines.SPACES)}, ' ', 'g'))), lambda x: x <> '') AS lines
  FROM pages),
l AS (SELECT r, page_id, host, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM p),
c AS (SELECT host, line, count(DISTINCT r) AS n FROM l WHERE host <> '' GROUP BY 1, 2),
t AS (SELECT host, count(*) AS total FROM p WHERE host <> '' GROUP BY 1),
bad AS (SELECT host, line FROM c JOIN t USING (host) WHERE n >= {site_lines.MIN_PAGES} AND n > {site_lines.MAX_SHARE} * total),
s AS (SELECT r, count(*) FILTER (WHERE bad.line IS NOT NULL) AS n_dropped,
             string_agg(l.line, chr(10) ORDER BY i) FILTER (WHERE bad.line IS NULL) AS text
      FROM l LEFT JOIN bad ON l.host = bad.host AND l.line = bad.line GROUP BY 1)
SELECT page_id, p.host, CAST(len(lines) AS BIGINT) AS n_lines, CAST(coalesce(n_dropped, 0) AS BIGINT) AS n_dropped, coalesce(text, '') AS text
FROM p LEFT JOIN s USING (r)
"""

def _template_regex(parts: list) -> str:
    """A template over words that each stand between two spaces of their own, as a regular expression."""
    out = ""
    for p in parts:
        if isinstance(p, str):
            out += f" {p} "
        elif p[0] == "optional":
            out += f"(?:{_template_regex(p[1])})?"
        else:
            out += f"(?: [^ ]+ ){{{p[1]},{p[2]}}}"
    return out


_METHOD_LABELS = ", ".join(
    f"CASE WHEN regexp_matches(s, {_sql(_template_regex(license_templates.parse(m)))}) THEN {_sql(label)} END"
    for label, m in license_templates.TEMPLATES)
_PHRASE_ROWS = ", ".join(f"({_sql(p.split()[0])}, {_sql(' '.join(p.split()[1:]))}, {len(p.split())}, {_sql(label)})"
                         for p, label in license_templates.PHRASES)

OP9_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
s AS (SELECT r, doc_id, w, coalesce(' ' || array_to_string(w, '  ') || ' ', '') AS s FROM d),
x AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
n AS (SELECT r, i, word, lead(word) OVER o AS w2, lead(word, 2) OVER o AS w3, lead(word, 3) OVER o AS w4 FROM x WINDOW o AS (PARTITION BY r ORDER BY i)),
p(first, rest, k, label) AS (VALUES {_PHRASE_ROWS}),
b AS (SELECT r, i - 1 AS pos, label FROM n JOIN p ON word = first
      AND rest = CASE k WHEN 2 THEN w2 WHEN 3 THEN w2 || ' ' || w3 ELSE w2 || ' ' || w3 || ' ' || w4 END),
g AS (SELECT r, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word, list(DISTINCT label) AS labels FROM b GROUP BY r),
m AS (SELECT r, doc_id, w, list_filter([{_METHOD_LABELS}], lambda x: x IS NOT NULL) AS own FROM s)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
       CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
       coalesce(array_to_string(list_sort(labels), ','), '') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(labels, []), own))), ',') AS labels,
       CAST(CASE WHEN len(own) > 0 THEN 1 WHEN n_base > 0 THEN 0.5 ELSE 0 END AS DOUBLE) AS score
FROM m LEFT JOIN g USING (r)
"""

_TERMS = r"regexp_extract_all(" + _ASCII_LOWER + r", '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

OP12_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS.format("coalesce(text, '')")} AS w FROM documents),
s AS (SELECT CAST(count(*) AS BIGINT) AS big_n, CAST(sum(len(w)) AS BIGINT) AS big_l FROM d WHERE len(w) > 0),
m AS (SELECT r, doc_id, 50 + (50 * CAST(len(w) AS BIGINT) * big_n) // big_l AS m FROM d, s WHERE len(w) > 0),
i AS (SELECT q, item_id, unnest(list_distinct(w)) AS term
      FROM (SELECT row_number() OVER () AS q, item_id, {_TERMS.format("coalesce(text, '')")} AS w FROM benchmark)),
p AS (SELECT r, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT r, unnest(w) AS term FROM d)
      WHERE term IN (SELECT term FROM i) GROUP BY 1, 2),
t AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(big_n) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w FROM p, s GROUP BY 1),
c AS (SELECT q, item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS score
      FROM i JOIN t USING (term) JOIN p USING (term) JOIN m USING (r) GROUP BY ALL),
k AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id) AS rank FROM c WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, CAST(score AS BIGINT) AS score FROM k WHERE rank <= 50
"""

ORACLE_SQL: dict[str, str] = {
    "op12_term_at_a_time": OP12_SQL,
    "op9_license_templates": OP9_SQL,
    "op10_site_lines": OP10_SQL,
    "op3_suffix_automaton": OP3_SQL,
}
