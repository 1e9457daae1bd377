from pyspark.sql import functions as F

from corpusflow.llm import q_llm
from corpusflow.llm import site_lines as S


def test_oracle_sql(spark, sf, duck):
    got = q_llm.op10_site_lines(spark, sf).toPandas().sort_values("page_id").reset_index(drop=True)
    want = duck.sql(q_llm.ORACLE_SQL["op10_site_lines"]).df()[list(got.columns)].sort_values("page_id").reset_index(drop=True)
    assert got.equals(want.astype(got.dtypes.to_dict()))


def test_html_lines(spark):
    html = "<html><style>p{}</style><BODY class='x'><p>One <b>two</b>\n three</p><!-- no --><script>var a='<p>';</script><br/>  <li>&copy;</li>"
    df = spark.createDataFrame([(html,), (None,), ("plain",)], "h string").select(S.html_lines(F.col("h")).alias("x"))
    assert [r["x"] for r in df.collect()] == [["One two", "three", "&copy;"], [], ["plain"]]


def test_shares_and_odd_rows(spark):
    rows = [(i, "a.com", f"menu\nmenu\nbody {i}\nrare", None) for i in range(10)] + [
        (20, "b.com", "menu\nother", 1), (21, "b.com", "menu", 2), (22, None, "menu", 3), (23, "", "menu", 4), (24, "a.com", None, 5),
        (25, "a.com", "", 6), (26, "c.com", "x" * 100_000 + "\nmenu", 7), (None, "a.com", "menu\nrare x", 8), (30, "a.com", "menu", 9), (30, "a.com", "menu", 9)]
    pages = spark.createDataFrame(rows, "page_id long, site string, body string, n_lines int")
    lines = F.filter(F.split("body", "\n"), lambda x: x != "")
    got = S.drop_site_lines(pages, F.col("site"), lines)
    assert got.columns == ["page_id", "site", "body", "host", "n_lines", "n_dropped", "text"] and got.count() == len(rows)
    by = {r["page_id"]: r for r in got.collect()}
    assert by[3]["text"] == "body 3" and (by[3]["n_lines"], by[3]["n_dropped"]) == (4, 3)  # rare stands on most pages, too
    assert by[20]["text"] == "menu\nother" and by[22]["text"] == "menu" and by[23]["text"] == "menu"
    assert by[24]["n_lines"] == 0 and by[25]["text"] == "" and by[None]["text"] == "rare x" and by[30]["text"] == ""
    assert len(by[26]["text"]) == 100_005
    high = {r["page_id"]: r["text"] for r in S.drop_site_lines(pages, F.col("site"), lines, max_share=0.8).collect()}
    assert high[3] == "body 3\nrare"
    assert S.drop_site_lines(pages.filter("false"), F.col("site"), lines).count() == 0


def test_names_of_work_columns_survive(spark):
    rows = [(i, "a.com", f"menu\nbody {i}", "l", "b", "s", "t") for i in range(10)]
    pages = spark.createDataFrame(rows, "page_id long, site string, body string, lines string, bad string, salt string, Stay string")
    got = S.drop_site_lines(pages, F.col("site"), F.split("body", "\n"))
    assert got.columns == [*pages.columns, "host", "n_lines", "n_dropped", "text"]
    assert all((r["lines"], r["bad"], r["salt"], r["Stay"], r["text"]) == ("l", "b", "s", "t", f"body {r['page_id']}") for r in got.collect())


def test_salts_follow_the_pages_of_a_host(spark):
    rows = [(i, "a.com" if i % 3 else "", f"menu\nbody {i}") for i in range(900)] + [(1000 + i, "b.com", f"menu\nb {i}") for i in range(10)]
    pages = spark.createDataFrame(rows, "page_id long, site string, body string")
    hot = {r["host"]: r["salts"] for r in S.salts_of(pages.withColumnRenamed("site", "host"), 50).collect()}
    assert hot == {"a.com": 12}
    few, many = (S.drop_site_lines(pages, F.col("site"), F.split("body", "\n"), salt_pages=n).orderBy("page_id").collect() for n in (10 ** 9, 50))
    assert few == many and len(many) == len(rows)
    assert {r["text"] for r in many if r["host"] == "a.com"} == {f"body {i}" for i in range(900) if i % 3}
