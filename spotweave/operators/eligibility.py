"""Barcode reconciliation and tissue eligibility."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from spotweave.functions.exprs import (
    ELIGIBILITY_REASONS, ELIGIBILITY_STATES, barcode_core_loose, blank_to_null, bounds_status,
    eligibility_flags, label_excluded, reason_text, recommended_keep, state_from_reasons)
from spotweave.functions.runtime import durable, literal_table
from spotweave.operators.contracts import enforce

KEY = ["sample_id", "barcode"]


def attach_positions(spots: DataFrame, positions: DataFrame) -> DataFrame:
    """Every matrix barcode must have a place; the place columns are attached."""
    enforce(spots.select(*KEY).join(positions.select(*KEY), KEY, "left_anti"), "POSITION_MISSING")
    return spots.join(positions, KEY)


def primary_flag(positions: DataFrame, matrix_barcodes: DataFrame) -> DataFrame:
    """Whether each place is in the filtered matrix."""
    seen = matrix_barcodes.select(*KEY).distinct().withColumn("_seen", F.lit(True))
    return positions.join(seen, KEY, "left").withColumn(
        "in_primary_matrix", F.col("_seen").isNotNull()).drop("_seen")


def match_roi(roi: DataFrame, positions: DataFrame, by_core: bool = True, orphans: str = "error"
              ) -> DataFrame:
    """Exact barcode first, then a unique 10x core; returns every ROI row with its method.

    A core that fits several places, or two ROI rows on one place, is an error.
    """
    places = positions.select(*KEY)
    # A loose core is the upper-cased barcode stem; exact matches keep their own row.
    exact = roi.join(places.withColumn("roi_barcode", F.col("barcode")), ["sample_id", "roi_barcode"], "left")
    done = exact.filter(F.col("barcode").isNotNull()).withColumn("barcode_match_method", F.lit("exact"))
    rest = exact.filter(F.col("barcode").isNull()).drop("barcode")
    if by_core:
        cores = places.withColumn("_core", barcode_core_loose(F.col("barcode"))).filter("_core is not null")
        per_core = cores.groupBy("sample_id", "_core").agg(
            F.min("barcode").alias("barcode"), F.count(F.lit(1)).alias("_n"))
        rest = rest.withColumn("_core", barcode_core_loose(F.col("roi_barcode"))).join(
            per_core, ["sample_id", "_core"], "left")
        method = F.when(F.col("barcode").isNotNull(), "10x_suffix_normalized").otherwise("unmatched")
        rest = rest.withColumn("barcode_match_method", method).drop("_core")
    else:
        rest = rest.withColumn("barcode", F.lit(None).cast("string")).withColumn(
            "barcode_match_method", F.lit("unmatched")).withColumn("_n", F.lit(1).cast("long"))
    # Held once: three checks and the caller read it.
    out = durable(done.withColumn("_n", F.lit(1).cast("long")).unionByName(rest))
    enforce(out.filter("_n > 1").select("sample_id", "roi_barcode"), "ROI_BARCODE_MATCH_AMBIGUOUS")
    enforce(out.filter("barcode is not null").groupBy(*KEY).agg(F.count(F.lit(1)).alias("n")).filter("n > 1"),
            "ROI_BARCODE_MATCH_AMBIGUOUS")
    if orphans == "error":
        enforce(out.filter("barcode is null").select("sample_id", "roi_barcode"), "ROI_ORPHAN_BARCODE")
    return out.drop("_n")


def match_summary(matched: DataFrame) -> DataFrame:
    """Rows, matches by method, orphans and coverage per sample."""
    m = F.col("barcode_match_method")
    hit = F.col("barcode").isNotNull()
    return matched.groupBy("sample_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(hit).alias("n_matched"),
        F.count_if(~hit).alias("n_orphan"), F.count_if(m == "exact").alias("n_exact"),
        F.count_if(m == "10x_suffix_normalized").alias("n_suffix_normalized"),
        F.avg(hit.cast("int")).alias("roi_to_position_coverage"))


def decision_table(metrics: DataFrame, matched: DataFrame | None, images: DataFrame | None,
                   excluded=()) -> DataFrame:
    """Places with metrics, manual label and image-bound status, one row each."""
    t = metrics
    if matched is not None:
        m = matched.filter(F.col("barcode").isNotNull()).select(
            *KEY, F.trim("roi_label").alias("roi_label"), "barcode_match_method",
            F.lit(True).alias("roi_member"))
        t = t.join(m, KEY, "left").withColumn("roi_member", F.coalesce("roi_member", F.lit(False)))
        t = t.withColumn("roi_label", blank_to_null(F.col("roi_label"))).withColumn(
            "roi_label_excluded", F.coalesce(label_excluded(F.col("roi_label"), excluded), F.lit(False)))
    else:
        t = t.withColumn("roi_member", F.lit(False)).withColumn(
            "roi_label", F.lit(None).cast("string")).withColumn("roi_label_excluded", F.lit(False))
    if images is not None:
        t = t.join(images, "sample_id", "left").withColumn("bounds_status", bounds_status(
            F.col("pxl_col"), F.col("pxl_row"), F.col("scale"), F.col("width"), F.col("height")))
        return t.drop("scale", "width", "height")
    return t.withColumn("bounds_status", F.lit("not_available"))


def assess_eligibility(metrics: DataFrame, roi: DataFrame | None, images: DataFrame | None = None,
                       excluded=("Noise",), bounds_action: str = "review", orphans: str = "error"
                       ) -> DataFrame:
    """Reasons, state and recommendation of every place; nothing is dropped."""
    # The spot table is small next to the triplets behind it: held once for matching and joining.
    metrics = durable(metrics)
    matched = None if roi is None else match_roi(roi, metrics, orphans=orphans)
    t = decision_table(metrics, matched, images, excluded)
    t = t.withColumn("reason_codes", reason_text(eligibility_flags(roi is not None, bounds_action)))
    t = t.withColumn("eligibility_state", state_from_reasons(F.col("reason_codes")))
    return t.withColumn("recommended_keep", recommended_keep(F.col("eligibility_state")))


def state_counts(table: DataFrame) -> DataFrame:
    """Places and primary spots per state, with zero rows for unseen states."""
    states = literal_table(table.sparkSession, [(s,) for s in ELIGIBILITY_STATES], "code string")
    n = table.groupBy(F.col("eligibility_state").alias("code")).agg(
        F.count(F.lit(1)).alias("n_positions"), F.count_if("in_primary_matrix").alias("n_primary"))
    return states.join(n, "code", "left").fillna(0).withColumn("kind", F.lit("state"))


def reason_counts(table: DataFrame) -> DataFrame:
    """Places and primary spots per reason code over the fixed code list."""
    codes = literal_table(table.sparkSession, [(s,) for s in ELIGIBILITY_REASONS], "code string")
    n = table.select("in_primary_matrix", F.explode(F.split("reason_codes", ";")).alias("code")).groupBy(
        "code").agg(F.count(F.lit(1)).alias("n_positions"), F.count_if("in_primary_matrix").alias("n_primary"))
    return codes.join(n, "code", "left").fillna(0).withColumn("kind", F.lit("reason"))
