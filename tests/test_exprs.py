"""Expressions and scans against Python's own rules on values where shortcuts go wrong."""

import fnmatch
import re

import pytest
from pyspark.sql import functions as F

from spotweave.functions import exprs as e
from spotweave.operators import contracts, design, qc
from spotweave.sources import readers


def test_natural_key_orders_digit_runs_of_any_length(spark):
    words = ["a" + "1" * 21, "a" + "1" * 20 + "2", "a2", "a10", "a010", "a9b", "b1", "ab", "a", "1" * 30]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    got = [r["w"] for r in df.orderBy(e.natural_key(F.col("w")), "w").collect()]
    want = sorted(words, key=lambda w: ([(0, int(x), "") if x.isdigit() else (1, 0, x) for x in re.findall(r"\d+|\D+", w)], w))
    assert got == want


def test_resolution_tokens(spark):
    values = [0.6, 1.0, -0.5, 1e-7, 2.25, 0.0, 10.0, 123456.0, 1234567.0, 0.0001, 0.00001, 0.30000000000000004, 99999.96, 100000.0]
    df = spark.createDataFrame([(x,) for x in values], "x double")
    got = [r["t"] for r in df.select(e.resolution_token(F.col("x")).alias("t")).collect()]
    assert got == [f"{x:.6g}".replace(".", "p").replace("-", "m") for x in values]


@pytest.mark.parametrize("glob", ("a*/[0-9].tsv", "[!ab]?.t*", "x[]]y", "no[end", "a.b+c", "[a^]z", "[!]]q"))
def test_globs(spark, glob):
    names = ["a1/3.tsv", "ab.tsv", "c1.txt", "x]y", "no[end", "a.b+c", "aXb+c", "^z", "az", "bz", "]q", "qq", "nox"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = {r["n"] for r in df.filter(F.col("n").rlike(e.glob_to_regex(glob))).collect()}
    assert got == {n for n in names if fnmatch.fnmatchcase(n, glob)}


def test_histogram_counts_every_value(spark):
    df = spark.createDataFrame([("g", x) for x in (-1.0, 0.0, 0.5, 3.0, 3.1, None, float("nan"))], "g string, x double")
    got = {r["bin"]: r["n"] for r in qc.histogram(df, ["g"], F.col("x"), 0.0, 3.0, 30).collect()}
    assert got == {-1: 1, 0: 1, 5: 1, 29: 1, 30: 1}


def test_media_types_of_compressed_tables(spark):
    rows = [(f"results/m/{n}", 3, b"abc") for n in ("a.tsv.gz", "b.csv.gz", "c.json", "d.gz", "e.TSV.GZ", "f")]
    df = spark.createDataFrame([(p, n, bytearray(c)) for p, n, c in rows], "path string, length long, content binary")
    got = {r["path"][10:]: r["media_type"] for r in readers.artifact_inventory(df, 2).collect()}
    assert got == {"a.tsv.gz": "text/tab-separated-values", "b.csv.gz": "text/csv", "c.json": "application/json", "d.gz": "application/gzip",
                   "e.TSV.GZ": "text/tab-separated-values", "f": "application/octet-stream"}


def test_forbidden_text_lists_all_hits(spark):
    df = spark.range(500).select(F.lit("p").alias("path"), F.col("id").alias("line_number"), F.lit("see /home/x/y").alias("line"))
    assert contracts.forbidden_text(df).count() == 500 and contracts.forbidden_text(df, limit=7).count() == 7


def test_integration_needs_a_complete_batch_only(spark):
    def status(*batches):
        rows = [(f"s{i}", b) for i, b in enumerate(batches)]
        return design.integration_eligibility(spark.createDataFrame(rows, "sample_id string, technical_batch string"))

    assert status("a", "a") == "not_requested" and status("a", "b") == "not_requested" and status("a", "") == "not_eligible"
