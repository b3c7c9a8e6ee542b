"""The mix against its SQL twin, the budgets, weighted order, and odd inputs."""

import duckdb
import pytest
from pyspark.sql import functions as F

from spotweave.llm import source_mixing as m

COLUMNS = ["doc_id", "size", "source_size", "target", "epochs", "taken"]


def both(spark, df, tmp_path):
    df.select("doc_id", "text", "source").write.mode("overwrite").parquet(str(tmp_path / "d"))
    got = sorted(map(tuple, m.mix(df).select(*COLUMNS).collect()), key=str)
    want = duckdb.sql(m.SQL.format(documents=f"'{tmp_path}/d/*.parquet'")).fetchall()
    return [(*r[:3], round(r[3], 6), *r[4:]) for r in got], sorted([(*r[:3], round(r[3], 6), *r[4:]) for r in want], key=str)


def test_table_matches_sql_and_budgets(spark, sf, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got, want = both(spark, docs, tmp_path)
    assert got == sorted(want, key=str) and len(got) == 1000
    per = m.mix(docs).join(docs.select("doc_id", "source"), "doc_id").groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("g"), F.sum("size").alias("s"))
    rows = per.collect()
    assert all(abs(r["t"] - r["g"]) <= 0.5 and r["g"] <= 3 * r["s"] + 1e-6 for r in rows)
    assert abs(sum(r["g"] for r in rows) - sum(r["s"] for r in rows)) < 1e-3


def test_caps_reshare_until_none_is_above(spark):
    rows = [(i, "w " * n, s) for i, (s, n) in enumerate([("a", 100), ("b", 5), ("c", 1), ("d", 300), (None, 50)])]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r["doc_id"]: r["target"] for r in m.mix(df).collect()}
    cap = {0: 300, 1: 15, 2: 3, 3: 900, 4: 150}
    weight = {0: 1, 1: 2, 2: 3, 3: 1, 4: 2}
    want, open_ = {}, set(cap)
    while True:
        level = (456 - sum(want.values())) / sum(weight[i] for i in open_)
        over = {i for i in open_ if level * weight[i] > cap[i]}
        if not over:
            break
        want |= {i: cap[i] for i in over}
        open_ -= over
    want |= {i: level * weight[i] for i in open_}
    assert {i: round(t, 6) for i, t in got.items()} == {i: round(t, 6) for i, t in want.items()}


def test_partitions_do_not_change_the_mix(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = []
    for n in ("1", "13"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        got.append(sorted(map(tuple, m.mix(docs).select(*COLUMNS).collect())))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert got[0] == got[1]


def test_quality_raises_the_chance_of_an_early_place(spark):
    rows = [(i, "a b c d " * 5 if i % 2 else "# # # # " * 5, "x") for i in range(400)] + [(1000, "w " * 2000, "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    taken = m.mix(df, weights=(1, 3)).filter("size = 20").groupBy((F.col("doc_id") % 2).alias("clean")).agg(
        F.sum("taken").alias("t")).collect()
    by = {r["clean"]: r["t"] for r in taken}
    assert by[1] > 0 and by[1] >= by[0]


@pytest.mark.parametrize("case", ("odd", "empty"))
def test_odd_rows(spark, tmp_path, case):
    rows = [(1, None, "a"), (2, "", "a"), (3, "x y z", None), (3, "x y z", None), (None, "x # y", "b"), (5, "q " * 50_000, "b")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "1 as size", "2 as taken", "3 as SOURCE")
    if case == "empty":
        df = df.limit(0)
        assert m.mix(df).collect() == [] and m.mixed_documents(df).collect() == []
        return
    plain = df.toDF("doc_id", "text", "source", "s", "t", "u").select("doc_id", "text", "source")
    got, want = both(spark, plain, tmp_path)
    assert got == sorted(want, key=str)
    out = m.mixed_documents(df)
    assert out.columns == df.columns
    assert sum(len((r[1] or "").split()) for r in out.collect()) >= sum(r[5] for r in got)
