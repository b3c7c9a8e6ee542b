"""Flagship: spot QC, eligibility, analysis gate, region effects and the strongest genes per region."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from spotweave.functions.runtime import durable
from spotweave.operators import cohort, roi
from spotweave.plans import standin as v
from spotweave.plans.queries_exprs import eligibility


def flagship(spark: SparkSession, sf_dir: str, top: int = 5) -> DataFrame:
    table = durable(cohort.analysis_gate(eligibility(spark, sf_dir).filter("in_primary_matrix"), min_genes=2))
    spots = table.withColumn("roi_label_source", F.col("roi_label")).withColumn(
        "min_genes_keep", F.col("n_genes_by_counts") >= 2).drop("roi_label")
    labelled = roi.apply_aliases(spots, v.aliases(spark))
    effects = roi.roi_effects(v.counts(spark, sf_dir), labelled, v.EXCLUDED_LABELS, min_roi_spots=2, min_detected=1,
                              min_fraction=0.0)
    return effects.filter(F.col("effect_rank_descending") <= top).select(
        "contrast_id", "gene_id", "n_roi_spots", "n_rest_spots", "roi_sum_raw_counts", "rest_sum_raw_counts",
        "log2_fc_cp10k_roi_vs_rest", "effect_rank_descending")
