"""Headline-query benchmark: runs each query to completion (noop sink) and prints one JSON line.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_QUERIES (comma list, optional)
"""

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from corpusflow.queries.registry import load_all  # noqa: E402
from corpusflow.session import build_session  # noqa: E402
from corpusflow.sources.tables import TEXT_PARTITIONS  # noqa: E402

HEADLINE = [
    "facet_stats", "incremental_stats", "revenue_totals", "many_items_on_one_day", "multi_table_join",
    "filter_token_length", "train_val_test_split", "dense_row_index", "chat_prompt_llama", "extract_paragraph_text",
    "tokenize", "pack_tokens_carry", "chunk_fixed", "chunk_recursive", "embed_documents", "dot_product_search",
    "retrieval_qa_table", "per_prompt_advantage", "rouge_n", "tree_append", "stream_activity",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = build_session(f"local[{cpus}]", shuffle_partitions=cpus)
    spark.conf.set(TEXT_PARTITIONS, str(cpus))  # the fixture's text tables are one row group each
    reg = load_all()
    # warm the JVM (code generation, JIT) and the Python workers once, on the smallest tables
    warm_dir = os.path.join(os.path.dirname(sf_dir), "sf0.001")
    warm_dir = warm_dir if os.path.isdir(warm_dir) else sf_dir
    for w in ("head_n", "map_batches", "embed_documents", "facet_stats"):
        reg[w].fn(spark, warm_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        t0 = time.perf_counter()
        reg[name].fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else None, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
