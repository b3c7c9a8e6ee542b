"""Variable genes, PCA, replicated fits and enrichment: invariants and planted effects."""

import hashlib
import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from spotweave.functions.digests import md5_heads
from spotweave.operators import cohort, enrichment as en, glm, pca


def triplets(spark, n=80, genes=12, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.poisson(1.5, (n, genes))
    x[:, 0] += (np.arange(n) % 2) * 12
    x[:, 1] += (np.arange(n) % 2) * 8
    rows = [("s", f"b{i:03d}", f"g{j:02d}", int(x[i, j])) for i in range(n) for j in range(genes) if x[i, j]]
    counts = spark.createDataFrame(rows, "sample_id string, barcode string, gene_id string, count long")
    spots = spark.createDataFrame([("s", f"b{i:03d}") for i in range(n)], "sample_id string, barcode string")
    return x, counts, spots


def test_moments_count_zeros(spark):
    x, counts, spots = triplets(spark)
    got = {r["gene_id"]: r for r in pca.gene_moments(counts, spots).collect()}
    for j in range(x.shape[1]):
        assert abs(got[f"g{j:02d}"]["mean"] - x[:, j].mean()) < 1e-9
        assert abs(got[f"g{j:02d}"]["variance"] - x[:, j].var(ddof=1)) < 1e-9


def test_variable_genes_prefer_planted(spark):
    # Two genes with the usual mean but counts in every second spot only.
    rng = np.random.default_rng(8)
    x = rng.poisson(rng.uniform(0.5, 4.0, 120), (200, 120))
    for j in (0, 1):
        x[:, j] = rng.poisson(4, 200) * (np.arange(200) % 2)
    rows = [("s", f"b{i:03d}", f"g{j:02d}", int(x[i, j])) for i in range(200) for j in range(120) if x[i, j]]
    counts = spark.createDataFrame(rows, "sample_id string, barcode string, gene_id string, count long")
    spots = counts.select("sample_id", "barcode").distinct()
    hv = pca.highly_variable(counts, spots, n_top=2)
    assert {r["gene_id"] for r in hv.filter("highly_variable").collect()} == {"g00", "g01"}


def test_pca_matches_dense(spark):
    x, counts, spots = triplets(spark)
    values = counts.withColumn("v", F.log1p(F.col("count").cast("double")))
    scores, loadings, var = pca.principal_components(values, spots, 4, "v")
    z = np.log1p(x.astype(float))
    z = np.clip((z - z.mean(axis=0)) / z.std(axis=0, ddof=1), -10, 10)
    z -= z.mean(axis=0)
    w = np.sort(np.linalg.eigvalsh(z.T @ z / (len(z) - 1)))[::-1]
    v = [r["variance"] for r in var.orderBy("pc_index").collect()]
    assert np.allclose(v, w[:4])
    L = np.array([r["loadings"] for r in loadings.orderBy("gene_id").collect()])
    assert np.allclose(L.T @ L, np.eye(4), atol=1e-8)
    assert (L[np.abs(L).argmax(axis=0), range(4)] > 0).all()
    S = np.array([r["pc"] for r in scores.orderBy("barcode").collect()])
    assert np.allclose(S, z @ L, atol=1e-4)
    assert np.allclose(S.var(axis=0, ddof=1), v, atol=1e-3)


def test_normalised_genes_keep_the_totals_of_all(spark):
    _, counts, _ = triplets(spark)
    genes = spark.createDataFrame([("g01",), ("g05",)], "gene_id string")
    got = cohort.normalise(counts, genes=genes)
    want = cohort.normalise(counts).filter("gene_id in ('g01', 'g05')").select(got.columns)
    assert got.count() and sorted(got.collect()) == sorted(want.collect())


def test_zeros_may_be_left_out_of_fits_and_size_factors(spark):
    counts, units = replicated(spark, genes=12, units=3)
    counts = counts.withColumn("count", F.when((F.col("gene_id") == "g03") & (F.col("biological_unit_id") < "u1"), 0).otherwise(F.col("count")).cast("long"))
    sparse = counts.filter("count > 0")
    key = ["contrast_id", "gene_id"]
    a, b = (glm.fit_replicated(x, units).toPandas().set_index(key).sort_index()["log2_fold_change"] for x in (counts, sparse))
    assert len(a) == 84 and np.allclose(a, b.loc[a.index], atol=1e-9)
    lone = counts.filter("biological_unit_id <> 'u00'")
    f = [{r["biological_unit_id"]: r["size_factor"] for r in glm.size_factors(x, units=units).collect()} for x in (lone, lone.filter("count > 0"))]
    assert len(f[0]) == 11 and all(abs(f[0][u] - f[1][u]) < 1e-12 for u in f[0])


def test_the_replicated_query_tests_every_gene_of_the_documented_minimum(spark):
    import duckdb

    from spotweave.plans import catalog
    from spotweave.plans.queries_models import UNIT_SQL
    from spotweave.plans.registry import with_views

    con, sf = duckdb.connect(), "/root/testdata/sf0.01"  # regions of the smallest tables have too few spots
    for t in ("lineitem", "orders", "part", "nation"):
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    want = con.execute(with_views(UNIT_SQL + "select roi_label_canonical, gene_id from c group by 1, 2 having sum(c) >= 10")).fetchall()
    got = catalog.QUERIES["m27_replicated_effects"](spark, sf).toPandas()
    assert len(want) > 100 and len(got) == 7 * len(want)
    assert set(zip(got["roi_label_canonical"], got["gene_id"])) == set(want)


def test_a_cell_without_counts_has_a_finite_estimate():
    cell = np.arange(16) % 4
    x = np.column_stack([np.ones(16), cell % 2, cell // 2, (cell % 2) * (cell // 2)])
    y = np.array([np.where(cell == 3, 0, 6 + np.arange(16) % 3), np.where(cell == 0, 0, 4), np.full(16, 5)], float)
    both = [glm._fit_means(y, np.ones(16), x, np.full(3, 0.5), rounds=n)[0] for n in (20, 80)]
    assert np.allclose(*both, atol=1e-6) and np.abs(both[0]).max() < 8
    alone = glm._fit_means(y[:1], np.ones(16), x, np.full(1, 0.5))[0]
    assert np.allclose(alone, both[1][:1], atol=1e-9)


def test_log_gamma_and_trigamma():
    xs = np.array([1e-3, 0.5, 1.0, 3.7, 25.0, 4e5])
    assert np.allclose(glm._lgamma(xs), [math.lgamma(v) for v in xs], rtol=1e-10, atol=1e-10)
    assert abs(glm.trigamma(1.0) - math.pi ** 2 / 6) < 1e-8


def replicated(spark, genes=80, units=4, seed=4):
    rng = np.random.default_rng(seed)
    base = rng.uniform(60, 300, genes)
    rows, unit_rows = [], []
    for ci, cell in enumerate(("g0_t0", "g0_t1", "g1_t0", "g1_t1")):
        g, t = cell[1] == "1", cell[4] == "1"
        for k in range(units):
            unit = f"u{ci}{k}"
            unit_rows.append(("R", unit, cell, ""))
            depth = rng.uniform(0.7, 1.4)
            for j in range(genes):
                mu = base[j] * depth * (2 if g and j < 10 else 1) * (2 if t and 10 <= j < 20 else 1) * (
                    4 if g and t and 20 <= j < 30 else 1)
                rows.append(("R", unit, f"g{j:02d}", int(rng.negative_binomial(30, 30 / (30 + mu)))))
    schema = "roi_label_canonical string, biological_unit_id string, gene_id string, count long"
    return (spark.createDataFrame(rows, schema), spark.createDataFrame(
        unit_rows, "roi_label_canonical string, biological_unit_id string, design_cell string, model_batch string"))


def test_planted_effects_are_recovered(spark):
    counts, units = replicated(spark)
    out = glm.fit_replicated(counts, units).toPandas()
    assert len(out) == 80 * 7

    def lfc(contrast, lo, hi):
        part = out[out["contrast_id"] == contrast].set_index("gene_id")
        return part.loc[[f"g{j:02d}" for j in range(lo, hi)]]

    for contrast, lo, hi, effect in (("genotype_simple_in_reference_treatment", 0, 10, 1.0),
                                     ("treatment_simple_in_reference_genotype", 10, 20, 1.0),
                                     ("genotype_by_treatment_interaction", 20, 30, 2.0)):
        hit, rest = lfc(contrast, lo, hi), lfc(contrast, 40, 80)
        assert abs(hit["log2_fold_change"].median() - rest["log2_fold_change"].median() - effect) < 0.35
        assert (hit["fdr_bh"] < 0.05).mean() >= 0.8
        assert (rest["fdr_bh"] < 0.05).mean() <= 0.1
    assert out["p_value"].between(0, 1).all() and (out["fdr_bh"] >= out["p_value"] - 1e-12).all()


def test_size_factors_follow_depth(spark):
    rows = [("R", f"u{u}", f"g{g}", (g + 1) * 10 * (u + 1)) for u in range(3) for g in range(9)]
    df = spark.createDataFrame(rows, "roi_label_canonical string, biological_unit_id string, gene_id string, count long")
    for kind in ("poscounts", "ratio"):
        f = [r["size_factor"] for r in glm.size_factors(df, kind).orderBy("biological_unit_id").collect()]
        assert np.allclose(np.array(f) / f[0], [1, 2, 3]) and abs(np.prod(f) - 1) < 1e-9


def ranking(spark, n=60):
    rows = [("R", "c", f"s{i:02d}", float(n - i) - n / 2, i + 1) for i in range(n)]
    return spark.createDataFrame(rows, "roi_label_canonical string, contrast_id string, gene_symbol string, "
                                       "original_effect double, rank long")


def test_enrichment_score_brute_force_and_null(spark):
    r = ranking(spark)
    sets = {"top": [f"s{i:02d}" for i in range(8)], "bottom": [f"s{i:02d}" for i in range(52, 60)],
            "mixed": [f"s{i:02d}" for i in range(2, 60, 6)], "tiny": ["s00"]}
    gs = spark.createDataFrame([("lib", t, g) for t, gg in sets.items() for g in gg], "library_id string, term string, gene string")
    out = {x["term"]: x for x in en.enrichment(r, gs, permutations=60, seed=1).collect()}
    assert set(out) == {"top", "bottom", "mixed"}
    score = np.array([30.0 - i for i in range(60)])
    for term in out:
        hit = np.array([f"s{i:02d}" in sets[term] for i in range(60)])
        w = np.abs(score) * hit
        run = np.cumsum(w / w.sum() - (~hit) / (~hit).sum())
        want = run.max() if run.max() >= -run.min() else run.min()
        assert abs(out[term]["es"] - want) < 1e-9
        assert 0 <= out[term]["nominal_permutation_p_value"] <= 1 and 0 <= out[term]["fdr_q_value"] <= 1
    assert out["top"]["nes"] > 1 and out["bottom"]["nes"] < -1
    assert out["top"]["nominal_permutation_p_value"] < 0.05 < out["mixed"]["nominal_permutation_p_value"]
    assert out["top"]["leading_edge_genes"].split(";")[0] == "s00"
    again = {x["term"]: x["nes"] for x in en.enrichment(r, gs, permutations=60, seed=1).collect()}
    assert all(abs(again[t] - out[t]["nes"]) < 1e-12 for t in out)


def test_first_places_sort_few_rows_and_short_permutations_are_ordered_whole(spark):
    r = ranking(spark, 3000)
    goal = spark.createDataFrame([("R", "c", 5, 3000)], "roi_label_canonical string, contrast_id string, _need long, _of long")
    want = {(p, k): x for p in range(1, 9) for k, x in enumerate(sorted(
        range(1, 3001), key=lambda x: (hashlib.md5(f"7:R:c:{p}:{x}".encode()).hexdigest(), x))[:5], 1)}
    for spare in (8.0, 0.0):  # without spare places about half of the permutations fall short
        rows = en.first_places(r, goal, 8, 7, spare).collect()
        assert {(x["perm"], x["_pick"]): x["rank"] for x in rows} == want and len(rows) == len(want)


def test_leading_digits_of_md5_match_the_digests():
    for prefix in ("", "0:R:c:", "0:3-MEDIUM:treatment_simple_in_alternative_genotype:", "é" * 70):
        for n in (1, 3):  # the padding falls into either block
            first, last = [f"{prefix}{p}:".encode() for p in range(10, 13)], [str(10 ** n + i).encode() for i in range(4)]
            want = [[int(hashlib.md5(a + b).hexdigest()[:8], 16) for b in last] for a in first]
            assert md5_heads(first, last).tolist() == want


def test_ranking_dedup_and_ties(spark):
    rows = [("A", "g1", 0.5, 50, 4), ("A", "g2", 0.9, 20, 4), ("B", "g3", 0.5, 30, 3), ("C", "g4", 0.7, 5, 4),
            ("D", "g5", 0.1, 40, 1), (" ", "g6", 0.3, 40, 4), ("E", "g7", None, 40, 4)]
    df = spark.createDataFrame([("R", "c", *x) for x in rows],
                               "roi_label_canonical string, contrast_id string, gene_symbol string, gene_id string, "
                               "effect_log2_cpm_plus1_difference double, combined_raw_counts_four_sections long, "
                               "n_nonzero_design_cells int")
    got = [(r["gene_symbol"], r["gene_id"], r["rank"]) for r in en.prepare_ranking(df).orderBy("rank").collect()]
    assert got == [("A", "g1", 1), ("B", "g3", 2)]
