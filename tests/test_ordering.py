"""Ordering helpers against plain Python on one hot and some small groups; quantiles match numpy."""

import numpy as np
from pyspark.sql import functions as F

from spotweave.functions import ordering as o, stats


def frame(spark, n=400):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(n):
        g = "hot" if i % 3 else f"g{i % 4}"
        rows.append((g, i, float(rng.integers(0, 30))))
    return spark.createDataFrame(rows, "g string, id long, x double")


def by_group(df):
    groups = {}
    for r in df.collect():
        groups.setdefault(r["g"], []).append(r)
    return groups


def test_rank_of_a_hot_group(spark):
    df = frame(spark)
    got = {(r["g"], r["id"]): r["r"] for r in o.row_rank(df, ["g"], [F.col("x").desc(), F.col("id").asc()], "r").collect()}
    for g, part in by_group(df).items():
        for k, r in enumerate(sorted(part, key=lambda r: (-r["x"], r["id"]))):
            assert got[g, r["id"]] == k + 1


def test_running_sum_of_a_hot_group(spark):
    df = frame(spark)
    got = {(r["g"], r["id"]): r["s"] for r in o.running_sum(df, ["g"], [F.col("id").asc()], F.col("x"), "s").collect()}
    for g, part in by_group(df).items():
        total = 0.0
        for r in sorted(part, key=lambda r: r["id"]):
            total += r["x"]
            assert got[g, r["id"]] == total


def test_average_rank_of_ties(spark):
    df = spark.createDataFrame([("a", 1, 5.0), ("a", 2, 5.0), ("a", 3, 7.0), ("a", 4, None)], "g string, id long, x double")
    got = {r["id"]: r["k"] for r in o.average_rank(df, ["g"], "x", "k").collect()}
    assert got == {1: 1.5, 2: 1.5, 3: 3.0, 4: None}


def test_quantiles_match_numpy(spark):
    df = frame(spark)
    probs = {"q01": 0.01, "q25": 0.25, "med": 0.5, "q9": 0.9}
    a = {r["g"]: r for r in o.exact_quantiles(df, ["g"], "x", probs).collect()}
    pdf = df.toPandas()
    for g, part in pdf.groupby("g"):
        want = np.quantile(part["x"], list(probs.values()))
        assert np.allclose([a[g][k] for k in probs], want)


def test_previous_row_of_a_hot_group(spark):
    df = frame(spark)
    got = {(r["g"], r["id"]): r["px"] for r in o.previous_row(df, ["g"], ["id"], {"x": "px"}).collect()}
    for g, part in by_group(df).items():
        part.sort(key=lambda r: r["id"])
        assert [got[g, r["id"]] for r in part] == [None, *[r["x"] for r in part[:-1]]]


def test_benjamini_hochberg_hand_values(spark):
    df = spark.createDataFrame([(1, "g", 0.01), (2, "g", 0.04), (3, "g", None), (4, "g", 0.03)], "id int, g string, p double")
    got = {r["id"]: r["q"] for r in o.benjamini_hochberg(df, ["g"], "p", ["id"], "q").collect()}
    assert got[3] is None
    assert np.allclose([got[1], got[2], got[4]], [0.03, 0.04, 0.04])


def test_distribution_counts_missing_and_zero(spark):
    df = spark.createDataFrame([("s", 0.0), ("s", 2.0), ("s", None), ("s", 4.0)], "g string, x double")
    r = stats.distribution(df, ["g"], "x").first()
    assert (r["n"], r["n_missing"], r["min"], r["median"], r["mean"], r["max"], r["n_zero"]) == (3, 1, 0.0, 2.0, 2.0, 4.0, 1)


def test_agreement_is_label_invariant(spark):
    base = [("a", "x"), ("a", "x"), ("b", "y"), ("b", "y"), ("c", "y")]
    swap = {"a": "q", "b": "r", "c": "s"}
    one = stats.agreement(spark.createDataFrame(base, "a string, b string"), [], "a", "b").first()
    two = stats.agreement(spark.createDataFrame([(swap[a], b) for a, b in base], "a string, b string"), [], "a", "b").first()
    assert abs(one["adjusted_rand_index"] - two["adjusted_rand_index"]) < 1e-12
    same = stats.agreement(spark.createDataFrame([("a", "a"), ("b", "b")], "a string, b string"), [], "a", "b").first()
    assert same["adjusted_rand_index"] == 1.0 and abs(same["normalized_mutual_information"] - 1.0) < 1e-12
