"""UDF, batch-inference and map surface (group P).

Models are plug-ins: a callable applied to Arrow batches, created once per task.
Defaults are deterministic so results can be checked.
"""

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def map_batches(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str, drop: list[str] = ()) -> DataFrame:
    """Apply ``fn`` to Arrow batches of rows (``spark.sql.execution.arrow.maxRecordsPerBatch`` rows each)."""
    src = df.drop(*drop) if drop else df

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            yield fn(pdf)

    return src.mapInPandas(run, schema)


# fixed values: default lexicon scorer vocabulary
LEXICON = ["hate", "kill", "stupid", "idiot", "ugly", "dumb", "trash", "loser"]


def lexicon_scores(texts: pd.Series) -> list[list[dict]]:
    """Default classifier: share of lexicon words, as (hate, nothate) scores."""
    out = []
    for t in texts:
        w = (t or "").lower().split()
        rate = sum(1 for x in w if x.strip(".,!?;:") in LEXICON) / len(w) if w else 0.0
        out.append([{"label": "hate", "score": rate}, {"label": "nothate", "score": 1.0 - rate}])
    return out


def batch_score(df: DataFrame, col: str, fn: Callable[[pd.Series], list] = lexicon_scores, out: str = "scores",
                batch: int = 16) -> DataFrame:
    """Classifier over the column in mini-batches of ``batch`` rows; all class scores per row."""

    @F.pandas_udf("array<struct<label: string, score: double>>")
    def score(it: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in it:
            res = []
            for i in range(0, len(s), batch):
                res.extend(fn(s.iloc[i:i + batch]))
            yield pd.Series(res)

    return df.withColumn(out, score(F.col(col)))


def evaluate_toxicity(df: DataFrame, key: str, col: str, fn: Callable[[pd.Series], list] = lexicon_scores, label: str = "hate",
                      n: int | None = None, seed: int = 8) -> DataFrame:
    """(n, mean, std) of a scorer's ``label`` score over the texts, or over exactly ``n`` of them drawn by key and seed.

    Rows that the scorer gives no such label (a null or empty answer) count in no statistic.
    """
    from corpusflow.operators.select import shuffle_take

    rows = df.select(key, col)
    scored = batch_score(rows if n is None else shuffle_take(rows, key, n, seed), col, fn, "_scores")
    score = F.get(F.filter("_scores", lambda s: s["label"] == label), F.lit(0))["score"]
    return scored.select(score.alias("_s")).agg(F.count("_s").alias("n"), F.avg("_s").alias("mean"), F.stddev_pop("_s").alias("std"))


def echo_model(prompt: str) -> str:
    """Default generator: echoes the last line of the prompt."""
    return prompt.rstrip().split("\n")[-1]


def batch_generate(df: DataFrame, key: str, col: str, fn: Callable[[str], str] = echo_model, retries: int = 3,
                   backoff: float = 0.05) -> DataFrame:
    """Generate per row with retry and back-off; failures become an error column, never a failed job."""
    kt = df.schema[key].dataType.simpleString()

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            outs, errs = [], []
            for p in pdf[col]:
                out, err = None, None
                for attempt in range(retries):
                    try:
                        out = fn(p)
                        err = None
                        break
                    except Exception as e:  # model client errors: retry, then report
                        err = f"{type(e).__name__}: {e}"
                        time.sleep(backoff * (2 ** attempt))
                outs.append(out)
                errs.append(err)
            yield pd.DataFrame({key: pdf[key], "generated": outs, "error": errs})

    return df.select(key, col).mapInPandas(run, f"{key} {kt}, generated string, error string")


def map_files(df: DataFrame, key: str, content: str, fn: Callable[[bytes], str]) -> DataFrame:
    """Run a model over file bytes (binaryFile rows or any binary column)."""
    kt = df.schema[key].dataType.simpleString()

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            yield pd.DataFrame({key: pdf[key], "text": [fn(b) for b in pdf[content]]})

    return df.select(key, content).mapInPandas(run, f"{key} {kt}, text string")


def vector_means(df: DataFrame, by: str, vec: str) -> DataFrame:
    """(by, n, mean): a user aggregate in two steps, so that a hot group is no one task's.

    Rows without a vector don't count. Each Arrow batch gives one partial sum per group (vectors added with NumPy); Spark adds the partial sums.
    """
    import numpy as np
    import pyarrow as pa

    from corpusflow.operators.retrieval import matrix

    kind = df.schema[by].dataType.simpleString()

    def partial(batches):
        for b in batches:
            keys = b.column(by).dictionary_encode()
            code = keys.indices.fill_null(len(keys.dictionary)).to_numpy(zero_copy_only=False)
            rows = matrix(b.column(vec)) if b.num_rows else ()
            for c in np.unique(code):
                part = rows[code == c]
                key = keys.dictionary[int(c)].as_py() if c < len(keys.dictionary) else None
                yield pa.RecordBatch.from_arrays([pa.array([key], type=b.column(by).type), pa.array([len(part)]),
                                                  pa.array([part.sum(axis=0)], type=pa.list_(pa.float64()))], names=[by, "n", "s"])

    sums = df.filter(F.col(vec).isNotNull()).select(by, vec).mapInArrow(partial, f"{by} {kind}, n long, s array<double>")
    each = sums.select(by, "n", F.posexplode("s").alias("i", "x")).groupBy(by, "i").agg(F.sum("x").alias("x"), F.sum("n").alias("n"))
    # as many rows per group as a vector has numbers
    return (each.groupBy(by).agg(F.max("n").alias("n"), F.array_sort(F.collect_list(F.struct("i", "x"))).alias("v"))
            .select(by, "n", F.transform("v", lambda e: e["x"] / F.col("n")).alias("mean")))


def group_apply(df: DataFrame, by: str, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """User aggregate over a group (``applyInPandas``): only for bounded groups; prefer SQL aggregates."""
    return df.groupBy(by).applyInPandas(fn, schema)
