"""Two-by-two factorial effects on region pseudobulk, descriptive (one section per cell)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from spotweave.functions.ordering import row_rank
from spotweave.functions.runtime import durable, literal_table
from spotweave.operators.contracts import enforce, functional_dependency, varying_within
from spotweave.operators.design import DESIGN_CELLS

ROI = ["sample_id", "roi_label_canonical"]

# Contrast id, formula, weights on (g0_t0, g0_t1, g1_t0, g1_t1) and model
# coefficients on (intercept, genotype, treatment, interaction).
CONTRASTS = (
    ("treatment_simple_in_reference_genotype", "g0_t1 - g0_t0",
     (-1.0, 1.0, 0.0, 0.0), (0.0, 0.0, 1.0, 0.0)),
    ("treatment_simple_in_alternative_genotype", "g1_t1 - g1_t0",
     (0.0, 0.0, -1.0, 1.0), (0.0, 0.0, 1.0, 1.0)),
    ("genotype_simple_in_reference_treatment", "g1_t0 - g0_t0",
     (-1.0, 0.0, 1.0, 0.0), (0.0, 1.0, 0.0, 0.0)),
    ("genotype_simple_in_alternative_treatment", "g1_t1 - g0_t1",
     (0.0, -1.0, 0.0, 1.0), (0.0, 1.0, 0.0, 1.0)),
    ("treatment_main_average", "0.5 * ((g0_t1 - g0_t0) + (g1_t1 - g1_t0))",
     (-0.5, 0.5, -0.5, 0.5), (0.0, 0.0, 1.0, 0.5)),
    ("genotype_main_average", "0.5 * ((g1_t0 - g0_t0) + (g1_t1 - g0_t1))",
     (-0.5, -0.5, 0.5, 0.5), (0.0, 1.0, 0.0, 0.5)),
    ("genotype_by_treatment_interaction", "(g1_t1 - g1_t0) - (g0_t1 - g0_t0)",
     (1.0, -1.0, -1.0, 1.0), (0.0, 0.0, 0.0, 1.0)),
)


def contrast_manifest(spark) -> DataFrame:
    """Contrast ids, formulas, cell weights and model coefficients."""
    return literal_table(spark, [(i, f, list(w), list(c)) for i, f, w, c in CONTRASTS],
                         "contrast_id string, contrast_formula string, cell_weights array<double>, "
                         "coefficients array<double>")


def canonical_pseudobulk(pb: DataFrame, check: bool = True) -> DataFrame:
    """Merge source labels per canonical region; spots are summed over distinct sources."""
    if check:
        pb = durable(pb)  # three contracts and the result read it
        enforce(functional_dependency(pb, ["gene_id"], ["gene_symbol"]), "GENE_SYMBOL_AMBIGUOUS")
        enforce(varying_within(pb, [*ROI, "roi_label_source"], "n_spots"), "N_SPOTS_NOT_CONSTANT")
        enforce(pb.filter("detected_spots > n_spots or sum_raw_counts < 0"), "RAW_COUNT_CONTRACT")
    spots = pb.select(*ROI, "roi_label_source", "n_spots").distinct().groupBy(*ROI).agg(
        F.sum("n_spots").alias("n_spots"))
    sums = pb.groupBy(*ROI, "gene_id").agg(
        F.min("gene_symbol").alias("gene_symbol"), F.sum("sum_raw_counts").alias("sum_raw_counts"),
        F.sum("detected_spots").alias("detected_spots"))
    # Sections times labels: rows are never dealt by region, here and below.
    return sums.join(F.broadcast(spots), ROI)


def normalised_pseudobulk(canonical: DataFrame, check: bool = True) -> DataFrame:
    """Library size, CPM, log2(CPM+1) and detection fraction."""
    lib = canonical.groupBy(*ROI).agg(F.sum("sum_raw_counts").alias("library_size_raw_counts"))
    if check:
        enforce(lib.filter("library_size_raw_counts <= 0"), "LIBRARY_SIZE_NOT_POSITIVE")
    t = canonical.join(F.broadcast(lib), ROI).withColumn(
        "cpm", F.col("sum_raw_counts") / F.col("library_size_raw_counts") * 1e6)
    return t.withColumn("log2_cpm_plus1", F.log2(F.col("cpm") + 1)).withColumn(
        "detection_fraction", F.col("detected_spots") / F.col("n_spots"))


def roi_design_eligibility(canonical: DataFrame, samples: DataFrame, min_spots: int = 50) -> DataFrame:
    """Present, missing and low-spot sections per region, with reasons.

    The expected sections are the rows of the sample sheet.
    """
    have = canonical.select(*ROI, "n_spots").distinct()
    expected = samples.agg(F.array_sort(F.collect_set("sample_id")).alias("_all"), F.lit(0).alias("_k"))
    low = F.when(F.col("n_spots") < min_spots, F.col("sample_id"))
    per = have.groupBy("roi_label_canonical").agg(
        F.array_sort(F.collect_set("sample_id")).alias("_have"), F.array_sort(F.collect_set(low)).alias("_low"),
        F.min("n_spots").alias("minimum_n_spots_across_design_cells"), F.lit(0).alias("_k"))
    t = per.join(expected, "_k")
    missing, extra = F.array_except("_all", "_have"), F.array_except("_have", "_all")

    def reason(name, items):
        return F.when(F.size(items) > 0, F.concat(F.lit(f"{name}:"), F.array_join(items, ",")))

    reasons = F.array_compact(F.array(
        reason("missing_design_samples", missing), reason("unexpected_samples", extra),
        reason("insufficient_roi_spots", F.col("_low"))))
    ok = F.size(reasons) == 0
    return t.select(
        "roi_label_canonical", F.size("_have").alias("n_samples_present"),
        F.array_join("_have", ";").alias("samples_present"), "minimum_n_spots_across_design_cells",
        F.array_join("_low", ";").alias("low_spot_samples"), ok.alias("complete_2x2_design"),
        F.when(ok, "eligible_descriptive_only").otherwise("excluded_incomplete_design").alias("eligibility_status"),
        F.when(ok, "complete_four_design_cells").otherwise(F.array_join(reasons, ";")).alias("reason_codes"))


def factorial_effects(normalised: DataFrame, samples: DataFrame, eligible: DataFrame) -> DataFrame:
    """Seven contrasts of log2(CPM+1) per region and gene; no p-values.

    The four cells become four columns in one aggregation; contrasts are literals.
    """
    cell = samples.select("sample_id", "design_cell")
    rois = eligible.filter("complete_2x2_design").select("roi_label_canonical")
    t = normalised.join(F.broadcast(cell), "sample_id").join(F.broadcast(rois), "roi_label_canonical", "left_semi")
    by = ["roi_label_canonical", "gene_id"]

    def at(c, column):
        return F.max(F.when(F.col("design_cell") == c, F.col(column)))

    wide = t.groupBy(*by).agg(
        F.min("gene_symbol").alias("gene_symbol"),
        *[at(c, "log2_cpm_plus1").alias(f"_{c}") for c in DESIGN_CELLS],
        F.sum("sum_raw_counts").alias("combined_raw_counts_four_sections"),
        F.count_if(F.col("sum_raw_counts") > 0).alias("n_nonzero_design_cells"),
        F.min("detection_fraction").alias("minimum_detection_fraction_four_sections"),
        F.count(F.lit(1)).alias("_n"))
    wide = durable(wide)
    enforce(wide.filter("_n <> 4").select(*by), "INCOMPLETE_GENE_BY_CELL")
    items = []
    for cid, formula, weights, _ in CONTRASTS:
        effect = sum((F.col(f"_{c}") * w for c, w in zip(DESIGN_CELLS, weights) if w), F.lit(0.0))
        items.append(F.struct(F.lit(cid).alias("contrast_id"), F.lit(formula).alias("contrast_formula"),
                              F.round(effect, 12).alias("effect_log2_cpm_plus1_difference")))
    return wide.select(
        *by, "gene_symbol", F.explode(F.array(*items)).alias("e"), "combined_raw_counts_four_sections",
        "n_nonzero_design_cells", "minimum_detection_fraction_four_sections").select(
        *by, "gene_symbol", "e.*", "combined_raw_counts_four_sections", "n_nonzero_design_cells",
        "minimum_detection_fraction_four_sections",
        F.lit("descriptive_only_no_biological_replicates").alias("inference_status"),
        F.lit(None).cast("double").alias("p_value"), F.lit(None).cast("double").alias("fdr_bh"),
        F.lit(True).alias("exploratory_only"))


def rank_effects(effects: DataFrame, value: str = "effect_log2_cpm_plus1_difference") -> DataFrame:
    """Signed and absolute rank per region and contrast; ties by gene id, NULLs last."""
    by = ["roi_label_canonical", "contrast_id"]
    t = row_rank(effects, by, [F.col(value).desc_nulls_last(), F.col("gene_id").asc()],
                 "effect_rank_signed_descending")
    return row_rank(t, by, [F.abs(F.col(value)).desc_nulls_last(), F.col("gene_id").asc()],
                    "effect_rank_absolute_descending")
