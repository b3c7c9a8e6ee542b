"""Registered queries against their SQL twins on the smallest tables, and scan round trips."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tools.oracle_check import compare, duck

# One light query per family; tools/oracle_check.py compares all of them.
LIGHT = ("s05_inspect_positions", "s12_gmt_scan", "v12_gene_universe", "v21_forbidden_text", "p06_eligibility_reasons",
         "p15_identifier_split", "p17_stable_seed", "p22_natural_key", "j03_raw_with_positions", "j08_join_audit",
         "a01_spot_qc", "a06_group_summaries", "a12_roi_stage_counts", "a27_qc_score", "w01_barcode_rank",
         "w12_threshold_warnings", "u04_difference", "m05_nearest_neighbors", "m09_normalized_mutual_information",
         "t01_resource_monitor")


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


@pytest.mark.parametrize("name", LIGHT)
def test_query_matches_sql(spark, sf, con, name):
    ok, text, _, _ = compare(spark, con, name, sf)
    assert ok, text


def test_every_query_is_callable_and_every_twin_has_a_query():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 188 and all(callable(f) for f in q.values())


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "log2_fc_cp10k_roi_vs_rest" in df.columns


def test_partition_count_does_not_change_results(spark, sf):
    from spotweave.plans import catalog
    got = []
    for n in ("1", "16"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        got.append(sorted(map(tuple, catalog.QUERIES["a14_roi_effects"](spark, sf).collect())))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert got[0] == got[1]


def test_positions_with_and_without_header(spark, tmp_path):
    from spotweave.sources.readers import read_positions
    for sample, head in (("S1", "barcode,in_tissue,array_row,array_col,pxl_row_in_fullres,pxl_col_in_fullres\n"), ("S2", "")):
        os.makedirs(tmp_path / sample)
        (tmp_path / sample / "tissue_positions.csv").write_text(head + "AC-1,1,0,2,10.5,20\nGT-1,,1,3,11,21\n")
    got = sorted((r["sample_id"], r["barcode"], r["in_tissue"], r["pxl_row_in_fullres"])
                 for r in read_positions(spark, str(tmp_path)).collect())
    assert got == [("S1", "AC-1", 1, 10.5), ("S1", "GT-1", None, 11.0), ("S2", "AC-1", 1, 10.5), ("S2", "GT-1", None, 11.0)]


def test_eligibility_states_by_hand(spark):
    from spotweave.operators.eligibility import assess_eligibility
    core = ["A" * 16, "C" * 16, "G" * 16, "T" * 16, "AC" * 8, "GT" * 8]
    rows = [("s", core[0] + "-1", 1, True, 9, 3, 1.0, 1.0), ("s", core[1] + "-1", 0, True, 9, 3, 1.0, 1.0),
            ("s", core[2] + "-1", None, True, 9, 3, 1.0, 1.0), ("s", core[3] + "-1", 1, True, 0, 0, 1.0, 1.0),
            ("s", core[4] + "-1", 1, True, 9, 3, 500.0, 1.0), ("s", core[5] + "-1", 0, False, 0, 0, 1.0, 1.0)]
    m = spark.createDataFrame(rows, "sample_id string, barcode string, in_tissue int, in_primary_matrix boolean, "
                                    "total_counts long, n_genes_by_counts long, pxl_col double, pxl_row double")
    roi = spark.createDataFrame([("s", c + "-2", lab) for c, lab in zip(core[:5], ("Cortex", "Noise", "Cortex", "Cortex", "Cortex"))],
                                "sample_id string, roi_barcode string, roi_label string")
    image = spark.createDataFrame([("s", 1.0, 100, 100)], "sample_id string, scale double, width int, height int")
    got = {r["barcode"][:2]: (r["eligibility_state"], r["recommended_keep"], r["reason_codes"])
           for r in assess_eligibility(m, roi, image).collect()}
    assert got["AA"] == ("keep", True, "")
    assert got["CC"] == ("exclude", False, "UPSTREAM_OFF_TISSUE;ROI_LABEL_EXCLUDED")
    assert got["GG"] == ("not_evaluable", None, "ELIGIBILITY_SOURCE_UNAVAILABLE")
    assert got["TT"] == ("exclude", False, "ZERO_TOTAL_COUNTS;ZERO_DETECTED_GENES")
    assert got["AC"] == ("review", None, "COORDINATE_OUT_OF_IMAGE_BOUNDS")
    assert got["GT"][0] == "exclude"


def test_roi_pseudobulk_and_effects_by_hand(spark):
    from spotweave.operators import roi
    x = [[10, 0, 0], [10, 0, 1], [0, 10, 0], [0, 10, 1], [5, 5, 0], [5, 5, 0]]
    lab = ["HT", "HT", "DG", "DG", "Noise", "Uncategorized"]
    spots = spark.createDataFrame([("s", f"b{i}", lab[i], lab[i], "identity", True, True, sum(x[i])) for i in range(6)],
                                  "sample_id string, barcode string, roi_label_source string, roi_label_canonical string, "
                                  "roi_alias_status string, recommended_keep boolean, min_genes_keep boolean, total_counts long")
    counts = spark.createDataFrame([("s", f"b{i}", f"g{j}", x[i][j]) for i in range(6) for j in range(3) if x[i][j]],
                                   "sample_id string, barcode string, gene_id string, count long")
    genes = spark.createDataFrame([(f"g{j}", f"G{j}") for j in range(4)], "gene_id string, gene_symbol string")
    exc = ("Noise", "Uncategorized")
    pb = {(r["roi_label_canonical"], r["gene_id"]): (r["sum_raw_counts"], r["detected_spots"], r["n_spots"])
          for r in roi.pseudobulk(counts, spots, genes, exc).collect()}
    assert len(pb) == 8 and pb[("HT", "g0")] == (20, 2, 2) and pb[("DG", "g0")] == (0, 0, 2) and pb[("HT", "g3")] == (0, 0, 2)
    e = {(r["roi_label_canonical"], r["gene_id"]): r for r in roi.roi_effects(counts, spots, exc, 2, 1, 0.0).collect()}
    a, b = (1e4 + 10 / 11 * 1e4) / 2, 0.0
    import math
    assert abs(e[("HT", "g0")]["log2_fc_cp10k_roi_vs_rest"] - math.log2((a + 1) / (b + 1))) < 1e-9
    assert e[("HT", "g0")]["effect_rank_descending"] == 1 and e[("HT", "g1")]["effect_rank_descending"] == 3


def test_stream_drops_rows_behind_the_watermark(spark, tmp_path):
    from spotweave.streaming import monitor
    schema = "step string, ts timestamp, event_id long, cpu_percent double, rss_gib double, vms_gib double, project_gib double, free_gib double"

    def batch(i, rows):
        df = spark.createDataFrame([("a", t, k, c, 1.0, 1.0, 1.0, 50.0) for k, (t, c) in enumerate(rows)],
                                   "step string, ts string, event_id long, cpu_percent double, rss_gib double, vms_gib double, "
                                   "project_gib double, free_gib double").withColumn("ts", F.to_timestamp("ts"))
        df.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    batch(0, [("2024-01-01 00:00:10", 10.0), ("2024-01-01 01:00:00", 90.0)])
    peaks = monitor.windowed_peaks(monitor.read_samples(spark, str(tmp_path / "in"), schema, 1))
    monitor.write_peaks(peaks, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    batch(1, [("2024-01-01 00:00:20", 99.0), ("2024-01-01 03:00:00", 1.0)])
    peaks = monitor.windowed_peaks(monitor.read_samples(spark, str(tmp_path / "in"), schema, 1))
    monitor.write_peaks(peaks, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    got = sorted((str(r["window_start"])[11:16], r["peak_cpu_percent"], r["warning_codes"])
                 for r in spark.read.schema(peaks.schema).parquet(str(tmp_path / "out")).collect())
    assert got == [("00:00", 10.0, ""), ("01:00", 90.0, "CPU_CAPACITY_ABOVE_WARNING")]


def test_design_eligibility_needs_no_region_gene_grid(spark, sf, monkeypatch):
    from spotweave.operators import roi

    def grid(*args, **kwargs):
        raise AssertionError("the grid of all genes was made")

    monkeypatch.setattr(roi, "pseudobulk", grid)
    assert entry.queries()["a18_roi_design_eligibility"](spark, sf).count() == 3


def test_the_region_gene_grid_is_never_shuffled(spark, sf):
    import re

    from spotweave.plans import queries_aggs as qa
    plan = qa.canonical4(spark, sf)._jdf.queryExecution().executedPlan().toString()
    # One shuffle by region and gene: the partial sums of the triplets.
    assert len(re.findall(r"Exchange hashpartitioning\(sample_id#\d+, roi_label_\w+#\d+, gene_id#\d+", plan)) == 1


def test_canonical_pseudobulk_computes_its_source_once(spark):
    from pyspark.sql import functions as F

    from spotweave.operators import factorial as fx
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(x):
        read.add(1)
        return x

    pb = spark.createDataFrame(
        [("Q0", "A", s, f"G{i}", f"g{i}", 5, i, 1) for s in ("a", "b") for i in range(10)],
        "sample_id string, roi_label_canonical string, roi_label_source string, gene_id string, gene_symbol string, n_spots long, "
        "sum_raw_counts long, detected_spots long").withColumn("gene_symbol", seen.asNondeterministic()("gene_symbol"))
    got = fx.canonical_pseudobulk(pb).collect()
    assert read.value == 20
    assert len(got) == 10 and all(r["n_spots"] == 10 and r["sum_raw_counts"] == 2 * int(r["gene_id"][1:]) for r in got)
