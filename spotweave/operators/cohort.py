"""Cohort assembly: union of sections, analysis gate, gene filter, normalisation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from spotweave.functions.exprs import gate_reasons, gene_filter_reason, log1p_cp
from spotweave.operators.contracts import duplicate_keys, enforce

KEY = ["sample_id", "barcode"]


def cohort_union(parts: list[DataFrame], allow_missing: bool = False) -> DataFrame:
    """Stack per-section tables by column name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), parts)


def with_observation_id(spots: DataFrame, check: bool = True) -> DataFrame:
    """``sample::barcode`` ids, unique over the cohort."""
    out = spots.withColumn("observation_id", F.concat_ws("::", *KEY))
    if check:
        enforce(duplicate_keys(out, ["observation_id"]), "OBSERVATION_ID_DUPLICATE")
    return out


def analysis_gate(spots: DataFrame, min_genes: int = 200) -> DataFrame:
    """P10: the only step that decides which spots are analysed."""
    gate = gate_reasons(F.lit(""), F.col("recommended_keep"), F.col("total_counts"),
                        F.col("n_genes_by_counts"), min_genes)
    both = gate_reasons(F.col("reason_codes"), F.col("recommended_keep"), F.col("total_counts"),
                        F.col("n_genes_by_counts"), min_genes)
    return spots.withColumn("_g", gate).withColumn(
        "primary_filter_reason", F.coalesce(F.get("_g", F.lit(0)), F.lit("KEEP"))).withColumn(
        "analysis_reason_codes", F.array_join(both, ";")).withColumn(
        "analysis_keep", F.size("_g") == 0).drop("_g")


def spots_per_gene(counts: DataFrame, genes: DataFrame, min_spots: int = 3) -> DataFrame:
    """Spots with a non-zero count per gene; unseen genes have 0."""
    n = counts.filter("count > 0").groupBy("gene_id").agg(F.count(F.lit(1)).alias("n_spots"))
    out = genes.join(n, "gene_id", "left").fillna(0, ["n_spots"])
    return out.withColumn("primary_filter_reason", gene_filter_reason(F.col("n_spots"), min_spots))


def filter_counts(gated: DataFrame) -> DataFrame:
    """Input, kept and dropped spots per sample."""
    p = F.col("primary_filter_reason")
    return gated.groupBy("sample_id").agg(
        F.count(F.lit(1)).alias("n_input"), F.count_if("analysis_keep").alias("n_kept"),
        F.count_if(F.col("total_counts") == 0).alias("n_zero_total"),
        F.count_if(p == "BELOW_MIN_GENES").alias("n_below_min_genes"),
        F.count_if(p == "UPSTREAM_NOT_RECOMMENDED").alias("n_upstream_not_recommended"))


def restrict(counts: DataFrame, kept_spots: DataFrame, kept_genes: DataFrame | None = None) -> DataFrame:
    """Triplets of kept spots and genes by semi joins, before any wide stage."""
    out = counts.join(kept_spots.select(*KEY), KEY, "left_semi")
    return out if kept_genes is None else out.join(kept_genes.select("gene_id"), "gene_id", "left_semi")


def normalise(counts: DataFrame, target: float = 1e4, genes: DataFrame | None = None) -> DataFrame:
    """``log1p_cp`` next to the raw count; the total is over the spot's own triplets.

    With ``genes`` only their triplets are returned; totals are over all.
    """
    totals = counts.groupBy(*KEY).agg(F.sum("count").alias("_total"))
    kept = counts if genes is None else counts.join(genes.select("gene_id"), "gene_id", "left_semi")
    return kept.join(totals, KEY).withColumn(
        "log1p_cp", log1p_cp(F.col("count"), F.col("_total"), target)).drop("_total")
