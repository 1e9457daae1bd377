import json

import pytest

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, n_words long, kept boolean, "
          "label string, node long, size long, copies long, spans string")


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty, blank and very long texts, ties, repeated rows, columns with clashing names."""
    long = " ".join(f"word{i % 997}" for i in range(60_000))
    plain = " ".join(f"tok{i}" for i in range(80))
    texts = [(1, None), (2, ""), (3, " \n\t "), (4, long), (5, plain), (5, plain), (6, plain), (None, plain), (7, "one"),
             (8, "one"), (9, "a" * 5000), (10, "éàü 漢字 Привет"), (11, "#*$ %&| <> !"), (12, plain + " tail")]
    rows = [(i, t, None if n % 3 == 0 else "en", None if n % 4 == 0 else f"s{n % 2}", None, n, True, None, 1, 2, 3, "x")
            for n, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.filter("false")


@pytest.fixture(scope="session")
def rows_of():
    """Rows of a frame in a comparable order."""
    return lambda df: sorted(json.dumps(r.asDict(True), sort_keys=True, default=str) for r in df.collect())
