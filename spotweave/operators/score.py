"""Six-component QC evidence score."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from spotweave.functions.exprs import threshold_class
from spotweave.functions.runtime import literal_table
from spotweave.operators.contracts import enforce

# Component order, weight and whether a FAIL blocks; points per status.
COMPONENTS = (
    ("in_tissue", 20.0, True),
    ("total_counts", 10.0, False),
    ("detected_genes", 10.0, False),
    ("mitochondrial_fraction", 20.0, False),
    ("image_alignment", 20.0, True),
    ("spatial_artifacts", 20.0, True),
)
POINTS = {"PASS": 100.0, "WARN": 50.0, "FAIL": 0.0}
MINIMUM_COVERAGE = 0.60


def in_tissue_component(area: DataFrame, primary: DataFrame) -> DataFrame:
    """Label completeness of the capture area and of the primary spots.

    ``area`` is A03; ``primary`` has sample_id, n_spots, distribution_n, distribution_missing.
    """
    t = area.join(primary, "sample_id", "left")
    whole = ((F.col("n_labeled") == F.col("n_positions")) & (F.col("distribution_n") == F.col("n_spots"))
             & (F.col("distribution_missing") == 0) & (F.col("n_positions") >= F.col("n_spots")))
    status = (F.when((F.col("n_positions") <= 0) | (F.col("n_labeled") == 0), "NA")
              .when(F.coalesce(whole, F.lit(False)), "PASS").otherwise("FAIL"))
    return t.select("sample_id", F.lit("in_tissue").alias("component"), status.alias("status"),
                    (F.col("n_labeled") / F.nullif("n_positions", F.lit(0))).alias("observed_value"))


def numeric_components(medians: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Class of the per-spot median of every numeric component.

    ``medians``: sample_id, component, value; ``thresholds``: component, warn, passed, higher_is_better.
    """
    return medians.join(thresholds, "component", "left").select(
        "sample_id", "component", threshold_class(
            F.col("value"), F.col("warn"), F.col("passed"), F.col("higher_is_better")).alias("status"),
        F.col("value").alias("observed_value"))


def manual_components(evidence: DataFrame, reviews: DataFrame) -> DataFrame:
    """PENDING where evidence exists, then the review decision; a review cannot replace evidence.

    ``evidence``: sample_id, component, available.
    """
    r = reviews.select("sample_id", "component", "decision")
    t = evidence.join(r, ["sample_id", "component"], "left")
    enforce(t.filter(~F.col("available") & F.col("decision").isin("PASS", "WARN", "FAIL")).select(
        "sample_id", "component"), "REVIEW_WITHOUT_EVIDENCE")
    status = F.when(~F.col("available"), "NA").otherwise(F.coalesce("decision", F.lit("PENDING")))
    return t.select("sample_id", "component", status.alias("status"),
                    F.lit(None).cast("double").alias("observed_value"))


def score_components(statuses: DataFrame) -> DataFrame:
    """Weights, points and inclusion of every component row."""
    dim = literal_table(statuses.sparkSession, [(i, *c) for i, c in enumerate(COMPONENTS)],
                        "ord int, component string, weight double, hard_blocker boolean")
    points = F.when(F.col("status") == "PASS", POINTS["PASS"]).when(
        F.col("status") == "WARN", POINTS["WARN"]).when(F.col("status") == "FAIL", POINTS["FAIL"])
    return statuses.join(dim, "component").withColumn("points", points).withColumn(
        "included_in_score", F.col("points").isNotNull()).withColumn(
        "weighted_points", F.col("weight") * F.col("points") / 100)


def score_samples(components: DataFrame, minimum_coverage: float = MINIMUM_COVERAGE) -> DataFrame:
    """Coverage, score and overall state per sample (at most six rows each)."""
    inc = F.col("included_in_score")

    def names(cond):
        hit = F.collect_list(F.when(cond, F.struct("ord", "component")))
        return F.array_join(F.transform(F.array_sort(hit), lambda s: s["component"]), ",")

    t = components.groupBy("sample_id").agg(
        F.sum("weight").alias("total_weight"),
        F.coalesce(F.sum(F.when(inc, F.col("weight"))), F.lit(0.0)).alias("covered_weight"),
        F.coalesce(F.sum("weighted_points"), F.lit(0.0)).alias("_points"),
        F.count_if(inc).alias("evidence_components"), F.count(F.lit(1)).alias("total_components"),
        names(F.col("hard_blocker") & (F.col("status") == "FAIL")).alias("hard_blocker_components"),
        names(F.col("status") == "PENDING").alias("pending_components"),
        names(~inc).alias("missing_components"))
    cover = F.col("covered_weight") / F.col("total_weight")
    t = t.withColumn("_cover", cover).withColumn("_score", F.when(
        (F.col("covered_weight") > 0) & (cover >= minimum_coverage),
        F.col("_points") / F.col("covered_weight") * 100))
    final = (F.col("missing_components") == "") & (F.col("_cover") == 1.0)
    state = (F.when(F.col("hard_blocker_components") != "", "HARD_BLOCKED")
             .when(F.col("_cover") < minimum_coverage, "INSUFFICIENT_EVIDENCE")
             .when(~final, "PROVISIONAL").otherwise("FINAL"))
    return t.select(
        "sample_id", F.when(final, F.bround("_score", 2)).alias("qc_score"),
        F.when(~final, F.bround("_score", 2)).alias("provisional_score"),
        F.bround("_cover", 4).alias("coverage"), "covered_weight", "total_weight", "evidence_components",
        "total_components", state.alias("overall_state"), final.alias("is_final"),
        (F.col("hard_blocker_components") != "").alias("hard_blocked"),
        "hard_blocker_components", "pending_components", "missing_components")
