"""Region pseudobulk and region-versus-rest effects."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from spotweave.functions.ordering import row_rank
from spotweave.functions.runtime import durable

KEY = ["sample_id", "barcode"]
ROI = ["sample_id", "roi_label_canonical"]
# Rows of the region x gene grid to a task.
GRID_ROWS = 500_000


def apply_aliases(spots: DataFrame, aliases: DataFrame, unmapped: str = "unmapped_identity") -> DataFrame:
    """Canonical label, status and notes; labels without an alias keep themselves."""
    a = aliases.select(
        F.col("source_label").alias("roi_label_source"), F.col("canonical_label").alias("_canon"),
        F.col("status").alias("_status"), F.col("notes").alias("_notes"))
    # One row per label; rows are never dealt by label.
    return spots.join(F.broadcast(a), "roi_label_source", "left").withColumn(
        "roi_label_canonical", F.coalesce("_canon", "roi_label_source")).withColumn(
        "roi_alias_status", F.coalesce("_status", F.lit(unmapped))).withColumn(
        "roi_alias_notes", F.coalesce("_notes", F.lit(""))).withColumn(
        "roi_alias_applied", F.col("_canon").isNotNull()).drop("_canon", "_status", "_notes")


def attach_roi_reference(spots: DataFrame, labels: DataFrame) -> DataFrame:
    """Exact (sample, barcode) labels on spots; unlabelled spots keep NULL."""
    return spots.join(labels.select(*KEY, "roi_label_source"), KEY, "left")


def roi_coverage(labelled: DataFrame, excluded=()) -> DataFrame:
    """Labelled, missing and excluded spots per sample; exclusion is case-sensitive."""
    lab = F.col("roi_label_source")
    exc = F.coalesce(lab.isin(*excluded), F.lit(False)) if excluded else F.lit(False)
    return labelled.groupBy("sample_id").agg(
        F.count(F.lit(1)).alias("n_spots"), F.count(lab).alias("n_labelled"),
        F.count_if(lab.isNull()).alias("n_missing"), F.count_if(exc).alias("n_excluded"),
        F.count_if(lab.isNotNull() & ~exc).alias("n_evaluable"))


def roi_stage_counts(spots: DataFrame, excluded=(), min_roi_spots: int = 50) -> DataFrame:
    """Spots per stage and contrast status for every canonical region.

    ``spots`` has roi_label_source / _canonical / roi_alias_status, recommended_keep,
    min_genes_keep. The rest of a region is the section's included analysis spots
    minus its own, from one small per-region table.
    """
    rec = F.coalesce(F.col("recommended_keep"), F.lit(False))
    ok = rec & F.col("min_genes_keep")
    per = spots.filter(F.col("roi_label_canonical").isNotNull()).groupBy(*ROI).agg(
        F.array_join(F.array_sort(F.collect_set("roi_label_source")), "|").alias("roi_label_source"),
        F.array_join(F.array_sort(F.collect_set("roi_alias_status")), "|").alias("roi_alias_status"),
        F.count(F.lit(1)).alias("n_primary_spots"), F.count_if(rec).alias("n_recommended_keep_spots"),
        F.count_if(F.col("min_genes_keep")).alias("n_min_genes_keep_spots"),
        F.count_if(ok).alias("_n_ok"))
    inc = ~F.col("roi_label_canonical").isin(*excluded) if excluded else F.lit(True)
    per = per.withColumn("included_in_roi_analysis", inc).withColumn(
        "n_analysis_spots", F.when(inc, F.col("_n_ok")).otherwise(F.lit(0)).cast("long"))
    total = per.groupBy("sample_id").agg(F.sum("n_analysis_spots").alias("_all"))
    rest = F.when(inc, F.col("_all") - F.col("n_analysis_spots")).otherwise(F.lit(0)).cast("long")
    out = per.join(total, "sample_id").withColumn("n_rest_spots", rest)
    status = (F.when(~F.col("included_in_roi_analysis"), "excluded_label")
              .when(F.col("n_analysis_spots") < min_roi_spots, "skipped_insufficient_roi_spots")
              .when(F.col("n_rest_spots") < min_roi_spots, "skipped_insufficient_rest_spots")
              .otherwise("completed"))
    return out.withColumn("contrast_status", status).withColumn(
        "contrast_eligible", F.col("contrast_status") == "completed").drop("_n_ok", "_all")


def analysis_spots(spots: DataFrame, excluded=()) -> DataFrame:
    """Spots that enter region analysis, with their section-wide total counts."""
    ok = F.coalesce(F.col("recommended_keep"), F.lit(False)) & F.col("min_genes_keep")
    inc = ~F.col("roi_label_canonical").isin(*excluded) if excluded else F.lit(True)
    return spots.filter(ok & F.col("roi_label_canonical").isNotNull() & inc)


def roi_gene_sums(counts: DataFrame, spots: DataFrame, target: float = 1e4) -> DataFrame:
    """Per region and gene with any count: sum, CP10k sum and detected spots.

    Spots carry ``total_counts``; sums combine map-side, so a hot gene or region
    costs one row per task.
    """
    lab = spots.select(*KEY, "roi_label_canonical", "total_counts")
    return counts.join(lab, KEY).groupBy(*ROI, "gene_id").agg(
        F.sum("count").alias("sum_raw_counts"),
        F.sum(F.col("count") * F.lit(float(target)) / F.col("total_counts")).alias("sum_cp10k"),
        F.count_if(F.col("count") > 0).alias("detected_spots"))


def gene_grid(regions: DataFrame, genes: DataFrame, buckets: int = 64) -> DataFrame:
    """Every region with every gene, by an equi join on gene buckets.

    The grid is the result the report asks for; buckets spread it over tasks.
    """
    g = genes.withColumn("_b", F.pmod(F.xxhash64("gene_id"), F.lit(buckets)).cast("int"))
    r = regions.withColumn("_b", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))
    return r.join(g, "_b").drop("_b")


def pseudobulk(counts: DataFrame, spots: DataFrame, genes: DataFrame, excluded=()) -> DataFrame:
    """Sum, mean, detected spots and fraction for every gene of every analysed region."""
    use = durable(analysis_spots(spots, excluded).select(
        *KEY, "roi_label_canonical", "roi_label_source", "total_counts"))
    regions = durable(use.groupBy(*ROI).agg(
        F.count(F.lit(1)).alias("n_spots"),
        F.array_join(F.array_sort(F.collect_set("roi_label_source")), "|").alias("roi_label_source")
    ).withColumn("_r", F.row_number().over(W.orderBy(*ROI))))  # sections times labels
    genes = genes.select("gene_id", "gene_symbol")
    tasks = max(int(genes.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-genes.count() * regions.count() // GRID_ROWS))
    sums = roi_gene_sums(counts, use).join(regions.select(*ROI, "_r"), ROI).repartition(tasks, "gene_id")
    # The sums of a gene stand beside it, so the grid is made where they are and never shuffled or sorted.
    per = sums.groupBy("gene_id").agg(F.map_from_entries(F.collect_list(F.struct(
        "_r", F.struct("sum_raw_counts", "detected_spots")))).alias("_s"))
    out = genes.repartition(tasks, "gene_id").join(per, "gene_id", "left").crossJoin(F.broadcast(regions))  # as above
    for c in ("sum_raw_counts", "detected_spots"):
        out = out.withColumn(c, F.coalesce(F.try_element_at("_s", "_r")[c], F.lit(0).cast("long")))
    out = out.drop("_s", "_r")
    return out.withColumn("mean_raw_counts", F.col("sum_raw_counts") / F.col("n_spots")).withColumn(
        "detection_fraction", F.col("detected_spots") / F.col("n_spots"))


def roi_effects(counts: DataFrame, spots: DataFrame, excluded=(), min_roi_spots: int = 50,
                min_detected: int = 10, min_fraction: float = 0.05, pseudocount: float = 1.0
                ) -> DataFrame:
    """Region against the rest of the included regions of its section.

    The rest is section total minus region, so triplets are read once. A gene
    with counts somewhere in the section but none in the region is a zero row.
    """
    # Spots are far fewer than triplets: held once for the stages and the join.
    spots = durable(spots.select(*KEY, "roi_label_source", "roi_label_canonical", "roi_alias_status",
                                 "recommended_keep", "min_genes_keep", "total_counts"))
    use = analysis_spots(spots, excluded)
    stage = roi_stage_counts(spots, excluded, min_roi_spots).filter("contrast_eligible").select(
        *ROI, F.col("n_analysis_spots").alias("n_roi_spots"), "n_rest_spots")
    sums = durable(roi_gene_sums(counts, use))
    section = sums.groupBy("sample_id", "gene_id").agg(
        F.sum("sum_raw_counts").alias("_t_sum"), F.sum("sum_cp10k").alias("_t_cp"),
        F.sum("detected_spots").alias("_t_det"))
    pairs = section.join(stage, "sample_id").join(sums, [*ROI, "gene_id"], "left")
    zero = F.lit(0).cast("long")
    p = (pairs.withColumn("roi_sum_raw_counts", F.coalesce("sum_raw_counts", zero))
         .withColumn("roi_detected_spots", F.coalesce("detected_spots", zero))
         .withColumn("_cp", F.coalesce("sum_cp10k", F.lit(0.0))))
    p = p.withColumn("rest_sum_raw_counts", F.col("_t_sum") - F.col("roi_sum_raw_counts")).withColumn(
        "rest_detected_spots", F.col("_t_det") - F.col("roi_detected_spots"))
    # A gene seen only inside the region leaves an exact 0, not a rounding remainder.
    rest_cp = F.when(F.col("rest_detected_spots") == 0, 0.0).otherwise(F.col("_t_cp") - F.col("_cp"))
    for side, cp in (("roi", F.col("_cp")), ("rest", rest_cp)):
        n = F.col(f"n_{side}_spots")
        p = p.withColumn(f"{side}_mean_raw_counts", F.col(f"{side}_sum_raw_counts") / n).withColumn(
            f"{side}_mean_cp10k", cp / n).withColumn(
            f"{side}_detection_fraction", F.col(f"{side}_detected_spots") / n)
    keep = (F.col("roi_detected_spots") + F.col("rest_detected_spots") >= min_detected) & (
        (F.col("roi_detection_fraction") >= min_fraction) | (F.col("rest_detection_fraction") >= min_fraction))
    e = p.filter(keep).withColumn(
        "detection_fraction_difference", F.col("roi_detection_fraction") - F.col("rest_detection_fraction")
    ).withColumn("log2_fc_cp10k_roi_vs_rest", F.log2(
        (F.col("roi_mean_cp10k") + pseudocount) / (F.col("rest_mean_cp10k") + pseudocount)))
    e = e.withColumn("contrast_id", F.concat(
        "sample_id", F.lit("__"), "roi_label_canonical", F.lit("_vs_rest"))).withColumn(
        "exploratory_only", F.lit(True))
    # Equal effects must tie exactly, whatever order the sums were added in.
    e = e.withColumn("log2_fc_cp10k_roi_vs_rest", F.round("log2_fc_cp10k_roi_vs_rest", 12))
    ranked = row_rank(e, ROI, [F.col("log2_fc_cp10k_roi_vs_rest").desc(), F.col("gene_id").asc()],
                      "effect_rank_descending")
    return ranked.drop("_t_sum", "_t_cp", "_t_det", "_cp", "sum_raw_counts", "sum_cp10k", "detected_spots")


def alias_use(spots: DataFrame) -> DataFrame:
    """Spots per source, canonical label, status and notes, and whether the label changed."""
    by = ["roi_label_source", "roi_label_canonical", "roi_alias_status", "roi_alias_notes"]
    return spots.groupBy(*by).agg(F.count(F.lit(1)).alias("n_spots")).withColumn(
        "label_changed", F.col("roi_label_source") != F.col("roi_label_canonical"))
