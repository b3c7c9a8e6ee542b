"""Metric switches, condition modes, identifiers and module globs: planted cases and raised errors."""

import pytest

from spotweave.operators import design, qc, reporting
from spotweave.operators.contracts import ContractError
from spotweave.sources import readers as r


def test_switched_off_metrics_are_typed_nulls_with_a_reason(spark):
    spots = spark.createDataFrame([("S", "a", 1), ("S", "b", 0)], "sample_id string, barcode string, in_tissue int")
    counts = spark.createDataFrame([("S", "a", "G", 3)], "sample_id string, barcode string, gene_id string, count long")
    genes = spark.createDataFrame([("G", "MT-X")], "gene_id string, gene_symbol string")
    off = qc.spot_qc(spots, counts, genes, tissue_enabled=False, detected_enabled=False)
    assert dict(off.dtypes)["in_tissue"] == "int" and dict(off.dtypes)["n_genes_by_counts"] == "bigint"
    assert [(x["in_tissue"], x["n_genes_by_counts"], x["total_counts"]) for x in off.orderBy("barcode").collect()] == [(None, None, 3), (None, None, 0)]
    got = {x["metric"]: (x["status"], x["reason"]) for x in qc.metric_status(spots, genes, detected_enabled=False).collect()}
    assert got == {"in_tissue": ("computed", "source_present"), "total_counts": ("computed", "source_present"),
                   "detected_genes": ("disabled", "switched_off"), "mitochondrial_fraction": ("computed", "source_present")}
    with pytest.raises(ContractError, match="TISSUE_LABELS_INCOMPLETE"):
        qc.metric_status(spots.withColumn("in_tissue", spots["in_tissue"] * 2), genes)


def test_condition_mode_is_explicit_counted_or_raised(spark):
    def sheet(*counts):
        cells = [("G0", "T0"), ("G0", "T1"), ("G1", "T0"), ("G1", "T1")]
        return spark.createDataFrame([(g, t) for (g, t), n in zip(cells, counts) for _ in range(n)], "genotype string, treatment string")

    levels = ("G0", "G1", "T0", "T1")
    assert design.resolve_condition_mode(sheet(1, 1, 1, 1), levels=levels) == "descriptive"
    assert design.resolve_condition_mode(sheet(3, 4, 3, 5), levels=levels) == "replicated"
    assert design.resolve_condition_mode(sheet(1, 2, 1, 1), "replicated") == "replicated"
    assert design.resolve_condition_mode(sheet(1, 2, 1, 1), levels=levels, requested=False) == "descriptive"
    for bad in (dict(levels=levels), dict(levels=("G0", "", "T0", "T1")), dict()):
        with pytest.raises(ContractError, match="DESIGN_NOT_ELIGIBLE"):
            design.resolve_condition_mode(sheet(1, 2, 1, 1), **bad)
    with pytest.raises(ContractError, match="CONDITION_MODE_UNKNOWN"):
        design.resolve_condition_mode(sheet(1, 1, 1, 1), "both")


def test_identifiers_and_cluster_columns(spark, tmp_path):
    df = spark.createDataFrame([("S1", "S1::AC-1", "x"), ("S1", "S10::AC-1", "x"), ("S1", None, "y"), ("a.c", "abc::T", "z")],
                               "sample_id string, spot_id string, expression_cluster string")
    assert [(x["barcode"], x["identifier_valid"]) for x in r.parsed_identifiers(df).collect()] == [
        ("AC-1", True), (None, False), (None, False), (None, False)]
    path = str(tmp_path / "c")
    spots = spark.createDataFrame([("p", "S1", "b", True)], "source_identifier string, sample_id string, barcode string, identifier_valid boolean")
    spark.createDataFrame([("p", 1), ("q", 2)], "source_identifier string, leiden int").write.parquet(path)
    got = sorted((x["source_identifier"], x["reference_cluster"], x["identifier_valid"]) for x in r.read_cluster_parquet(spark, path, spots).collect())
    assert got == [("p", "1", True), ("q", "2", False)]
    with pytest.raises(ContractError, match="CLUSTER_IDENTIFIER_DUPLICATE"):
        r.read_cluster_parquet(spark, path, spots.union(spots))
    wide = str(tmp_path / "w")
    spark.createDataFrame([("p", 1, 2)], "source_identifier string, a int, b int").write.parquet(wide)
    with pytest.raises(ContractError, match="CLUSTER_COLUMNS"):
        r.read_cluster_parquet(spark, wide, spots)


def test_globs_stay_in_their_module(spark):
    df = spark.createDataFrame([("qc", "results/qc/a.tsv"), ("qc", "results/qc/b.tsv"), ("svg", "results/qc/a.tsv"), ("qc", "results/qc/a.png")],
                               "module string, path string")
    assert [x["path"] for x in reporting.matching_artifacts(df, "qc", "*.tsv").orderBy("path").collect()] == ["results/qc/a.tsv", "results/qc/b.tsv"]
    assert [x["path"] for x in reporting.matching_artifacts(df, "qc", "*.tsv", 1).collect()] == ["results/qc/a.tsv"]
