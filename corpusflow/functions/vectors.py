"""Vector math as array expressions (JVM side, no Python), and a hashing-trick embedder."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.functions.text import TOKEN_PATTERN, col_, tokens


def dot(a: Column | str, b: Column | str) -> Column:
    """Dot product in double precision, summed in index order."""
    return F.aggregate(F.zip_with(col_(a), col_(b), lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda acc, v: acc + v)


def sq_l2(a: Column | str, b: Column | str) -> Column:
    """Squared Euclidean distance (what a flat L2 index reports)."""
    return F.aggregate(F.zip_with(col_(a), col_(b), lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double"))),
                       F.lit(0.0), lambda acc, v: acc + v)


def norm(a: Column | str) -> Column:
    return F.sqrt(F.aggregate(col_(a), F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))


def l2_normalize(a: Column | str) -> Column:
    """Column form (the norm is re-evaluated per element: use :func:`with_normalized` on wide vectors)."""
    n = norm(a)
    return F.transform(col_(a), lambda x: F.when(n > 0, x.cast("double") / n).otherwise(F.lit(0.0)))


def token_bucket(tok: Column, dim: int) -> Column:
    return F.pmod(F.conv(F.substring(F.md5(tok), 1, 8), 16, 10).cast("bigint"), F.lit(dim))


def _bucket_vectors(dim: int):
    import hashlib

    import numpy as np
    import pandas as pd

    def embed(tok_lists: pd.Series) -> pd.Series:
        out = []
        for toks in tok_lists:
            counts = np.zeros(dim)
            for tk in toks:
                counts[int(hashlib.md5(tk.encode("utf-8")).hexdigest()[:8], 16) % dim] += 1.0
            n = float(np.sqrt(sum(float(v) * float(v) for v in counts)))
            out.append(counts / n if n > 0 else counts)
        return pd.Series(out)

    return F.pandas_udf(embed, "array<double>")


def with_hash_embedding(df: DataFrame, text: Column | str, out: str, dim: int = 32) -> DataFrame:
    """Deterministic default embedder: lower-cased tokens hashed (md5) into ``dim`` buckets, L2-normalised.

    Tokens are cut in the JVM; the per-row bucket histogram runs in an Arrow-batched pandas UDF
    (a small helper: md5 + bincount per row), no shuffle.  Same rule as the SQL form in the oracle.
    """
    return df.withColumn(out, _bucket_vectors(dim)(tokens(F.lower(col_(text)))))


def hash_model(dim: int = 32):
    """Model maker of the default embedder for :func:`embed_with`; the texts of a row's columns are read as one."""

    def make():
        import hashlib

        import numpy as np
        import regex

        token, seen = regex.compile(TOKEN_PATTERN), {}

        def predict(*columns):
            out = np.zeros((len(columns[0]), dim))
            for i, texts in enumerate(zip(*columns)):
                for t in token.findall(" ".join(texts).lower()):
                    if t not in seen:
                        if len(seen) > 200_000:
                            seen.clear()
                        seen[t] = int(hashlib.md5(t.encode("utf-8")).hexdigest()[:8], 16) % dim
                    out[i, seen[t]] += 1.0
            n = np.sqrt((out * out).sum(axis=1, keepdims=True))
            return out / np.where(n > 0, n, 1.0)

        return predict

    return make


def embed_with(df: DataFrame, columns: Sequence[str], out: str, make_model, prefix: str = "", batch: int = 64) -> DataFrame:
    """``out`` = the model's vector of one or several text columns of a row.

    ``make_model()`` is called once per Python worker and gives a function of as many arrays as there are columns (a
    batch each) to an n x dim array.  ``prefix`` stands before the first column's text, as models ask for that tell
    queries from passages; null texts are empty.
    """
    import inspect

    from pyspark.ml.functions import predict_batch_udf
    from pyspark.sql.types import ArrayType, DoubleType

    n = len(columns)

    def make():
        model = make_model()

        def predict(*arrays):
            return model(*arrays)

        # Spark hands over columns by the number of parameters that it sees
        predict.__signature__ = inspect.Signature([inspect.Parameter(f"c{i}", inspect.Parameter.POSITIONAL_ONLY) for i in range(n)])
        return predict

    run = predict_batch_udf(make, return_type=ArrayType(DoubleType()), batch_size=batch)
    texts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    return df.withColumn(out, run(F.concat(F.lit(prefix), texts[0]), *texts[1:]))


def with_normalized(df: DataFrame, vec: str, out: str) -> DataFrame:
    """``out`` = ``vec`` scaled to unit length (zero vector stays zero); the norm is computed once per row."""
    n = df.withColumn("_hn", norm(vec))
    return n.withColumn(out, F.transform(F.col(vec), lambda x: F.when(F.col("_hn") > 0, x.cast("double") / F.col("_hn")).otherwise(F.lit(0.0)))).drop("_hn")


def vec_str(a: Column | str, places: int = 6) -> Column:
    """Vector as text (rounded) for comparisons."""
    return F.array_join(F.transform(col_(a), lambda x: F.format_number(F.round(x, places), places)), ",")
