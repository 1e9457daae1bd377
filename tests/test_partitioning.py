"""Results do not depend on the number of shuffle partitions."""

import pytest

from corpusflow.queries.registry import load_all
from corpusflow.testing import sorted_rows

REG = load_all()


@pytest.mark.parametrize("name", ["facet_stats", "pack_tokens_carry", "rouge_n", "per_prompt_advantage", "every_nth"])
def test_same_result_with_1_and_7_shuffle_partitions(spark, sf, name):
    out = []
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("1", "7"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            df = REG[name].fn(spark, sf)
            out.append(sorted_rows(df.columns, [tuple(r) for r in df.collect()]))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert out[0] == out[1]
