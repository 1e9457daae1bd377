"""List queries whose Spark column types differ from the DuckDB oracle's (same names, different families)."""

import sys

import duckdb

sys.path.insert(0, ".")
from corpusflow.queries.registry import load_all  # noqa: E402
from corpusflow.session import build_session  # noqa: E402
from corpusflow.sources.tables import TABLES  # noqa: E402

SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
                 "smallint": "SMALLINT", "tinyint": "TINYINT", "float": "FLOAT", "date": "DATE", "timestamp": "TIMESTAMP"}


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    skip = {a for a in sys.argv[2:]}
    reg = load_all()
    spark = build_session("local[4]")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    for name, q in sorted(reg.items()):
        if not q.sql or name.startswith("stream_") or name in skip:
            continue
        st = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in q.fn(spark, sf_dir).schema.fields}
        rel = con.sql(q.sql)
        dt = {c: str(ty) for c, ty in zip(rel.columns, rel.types)}
        diff = {c: (st.get(c), dt.get(c)) for c in set(st) | set(dt) if st.get(c) != dt.get(c)}
        if diff:
            print(name, diff, flush=True)


if __name__ == "__main__":
    main()
