"""Spot and background quality control. QC annotates; it never filters."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from spotweave.functions.exprs import mitochondrial
from spotweave.functions.ordering import exact_quantiles, row_rank
from spotweave.functions.runtime import durable
from spotweave.functions.stats import distribution
from spotweave.operators.contracts import enforce

KEY = ["sample_id", "barcode"]


def count_metrics(counts: DataFrame, genes: DataFrame | None = None, prefixes=("MT-",)) -> DataFrame:
    """Total, detected genes and stored entries per barcode; mitochondrial total with ``genes``.

    Only the mitochondrial ids join the triplets, and the sum is combined map-side.
    """
    if genes is not None:
        mt = genes.filter(mitochondrial(F.col("gene_symbol"), prefixes)).select(
            "gene_id", F.lit(True).alias("_mt"))
        counts = counts.join(mt, "gene_id", "left")
        extra = [F.sum(F.when(F.col("_mt"), F.col("count")).otherwise(0)).alias("total_counts_mt")]
    else:
        extra = []
    return counts.groupBy(*KEY).agg(
        F.sum("count").alias("total_counts"),
        F.count_if(F.col("count") > 0).alias("n_genes_by_counts"),
        F.count(F.lit(1)).alias("nnz"), *extra)


def spot_qc(spots: DataFrame, counts: DataFrame, genes: DataFrame, prefixes=("MT-",),
            total_enabled: bool = True, mito_enabled: bool = True, tissue_enabled: bool = True,
            detected_enabled: bool = True) -> DataFrame:
    """Totals per place; places without counts stay with 0.

    A disabled metric, or the mitochondrial share without matching features, is
    a typed NULL column.
    """
    m = count_metrics(counts, genes, prefixes)
    out = spots.join(m, KEY, "left").withColumn("in_primary_matrix", F.col("nnz").isNotNull())
    zero = F.lit(0).cast("long")
    for c in ("total_counts", "n_genes_by_counts", "total_counts_mt"):
        out = out.withColumn(c, F.coalesce(F.col(c), zero))
    out = out.withColumn("pct_counts_mt", F.when(
        F.col("total_counts") > 0, F.col("total_counts_mt") * 100.0 / F.col("total_counts")))
    off = ([] if mito_enabled else ["total_counts_mt", "pct_counts_mt"]) + (
        [] if total_enabled else ["total_counts"]) + ([] if detected_enabled else ["n_genes_by_counts"])
    if not tissue_enabled and "in_tissue" in out.columns:
        off.append("in_tissue")
    for c in off:
        out = out.withColumn(c, F.lit(None).cast(out.schema[c].dataType))
    return out.drop("nnz")


def metric_status(spots: DataFrame, genes: DataFrame, prefixes=("MT-",), tissue_enabled: bool = True, total_enabled: bool = True,
                  detected_enabled: bool = True, mito_enabled: bool = True) -> DataFrame:
    """Metric, requested, status and reason of the four switches of ``spot_qc``.

    A requested metric is not available without its source: a tissue column, or a gene that
    matches a mitochondrial prefix. Raises TISSUE_LABELS_INCOMPLETE where the column has gaps
    or values other than 0 and 1.
    """
    tissue = "in_tissue" in spots.columns
    if tissue_enabled and tissue:
        bad = spots.filter(F.col("in_tissue").isNull() | ~F.col("in_tissue").isin(0, 1))
        enforce(bad.select(*KEY), "TISSUE_LABELS_INCOMPLETE")
    found = genes.agg(F.count_if(mitochondrial(F.col("gene_symbol"), prefixes)).alias("n"))

    def entry(metric: str, requested: bool, have, lack: str):
        on = F.lit(have) if isinstance(have, bool) else have
        status = F.when(~F.lit(requested), "disabled").when(on, "computed").otherwise("not_available")
        reason = F.when(~F.lit(requested), "switched_off").when(on, "source_present").otherwise(lack)
        return F.struct(F.lit(metric).alias("metric"), F.lit(requested).alias("requested"), status.alias("status"), reason.alias("reason"))

    return found.select(F.explode(F.array(
        entry("in_tissue", tissue_enabled, tissue, "no_tissue_column"), entry("total_counts", total_enabled, True, ""),
        entry("detected_genes", detected_enabled, True, ""),
        entry("mitochondrial_fraction", mito_enabled, F.col("n") > 0, "no_mitochondrial_features"))).alias("e")).select("e.*")


def capture_area(positions: DataFrame) -> DataFrame:
    """Places, labelled, in and out of tissue, share in tissue of the labelled."""
    n_in, n_lab = F.count_if(F.col("in_tissue") == 1), F.count("in_tissue")
    return positions.groupBy("sample_id").agg(
        F.count(F.lit(1)).alias("n_positions"), n_lab.alias("n_labeled"), n_in.alias("n_in_tissue"),
        F.count_if(F.col("in_tissue") == 0).alias("n_out_of_tissue"),
        (n_in / F.nullif(n_lab, F.lit(0))).alias("fraction_in_tissue"))


BACKGROUND_QUANTILES = {"q01": 0.01, "q25": 0.25, "median": 0.5, "q75": 0.75, "q99": 0.99}


def background_distribution(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """Distribution with zero counts and outer quantiles."""
    return distribution(df, by, value, BACKGROUND_QUANTILES)


def raw_with_positions(positions: DataFrame, raw_metrics: DataFrame) -> DataFrame:
    """Every place with its raw totals; absent barcodes become 0 and are flagged.

    Call after the orphan contract (V20) holds.
    """
    m = raw_metrics.select(*KEY, F.col("total_counts").alias("raw_total_counts"),
                           F.col("n_genes_by_counts").alias("raw_n_genes_by_counts"))
    out = positions.join(m, KEY, "left").withColumn(
        "raw_barcode_present", F.col("raw_total_counts").isNotNull())
    zero = F.lit(0).cast("long")
    return out.withColumn("raw_total_counts", F.coalesce("raw_total_counts", zero)).withColumn(
        "raw_n_genes_by_counts", F.coalesce("raw_n_genes_by_counts", zero))


def tissue_groups(df: DataFrame) -> DataFrame:
    """Each place under ``all_positions`` and under its own tissue group."""
    own = F.when(F.col("in_tissue") == 1, "in_tissue").when(
        F.col("in_tissue") == 0, "out_of_tissue").otherwise("unlabeled")
    return df.withColumn("position_group", F.explode(F.array(F.lit("all_positions"), own)))


def group_summaries(table: DataFrame, value: str = "raw_total_counts") -> DataFrame:
    """Overlapping tissue groups with raw coverage and distribution."""
    # Held once: coverage and distribution both read it.
    g = tissue_groups(durable(table.select("sample_id", "in_tissue", "raw_barcode_present", value)))
    by = ["sample_id", "position_group"]
    cover = g.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_positions"),
        F.count_if("raw_barcode_present").alias("n_raw_barcode_present"),
        F.avg(F.col("raw_barcode_present").cast("int")).alias("raw_barcode_coverage"))
    return cover.join(background_distribution(g, by, value), by)


def join_integrity(table: DataFrame) -> DataFrame:
    """Counters of the raw join per sample."""
    present = F.col("raw_barcode_present")
    return table.groupBy("sample_id").agg(
        F.count_if(present).alias("n_matched_positions"),
        F.count_if(~present).alias("n_zero_filled_positions"),
        F.count_if(present & (F.col("raw_total_counts") == 0)).alias("n_explicit_zero_raw_barcodes"),
        F.avg(present.cast("int")).alias("position_raw_coverage"))


def barcode_rank_curve(table: DataFrame, value: str = "raw_total_counts") -> DataFrame:
    """Places ranked by raw counts, with log10 rank and log1p counts."""
    ranked = row_rank(table, ["sample_id"], [F.col(value).desc(), F.col("barcode").asc()], "barcode_rank")
    return ranked.withColumn("log10_rank", F.log10("barcode_rank")).withColumn(
        "log1p_counts", F.log1p(F.col(value)))


def histogram(df: DataFrame, by: list[str], value, lo: float, hi: float, bins: int) -> DataFrame:
    """Fixed-bin counts; the last bin includes its upper edge.

    Values below the range are bin -1, those above it bin ``bins``; NULL and NaN aren't counted.
    """
    x = value
    width = (hi - lo) / bins
    inside = F.least(F.floor((x - lo) / width), F.lit(bins - 1))
    index = F.when(x < lo, -1).when(x > hi, bins).otherwise(inside).cast("int")
    return df.filter(x.isNotNull() & ~F.isnan(x)).groupBy(*by, index.alias("bin")).agg(
        F.count(F.lit(1)).alias("n")).withColumn("bin_left", F.lit(lo) + F.col("bin") * width)


def hexbin(df: DataFrame, by: list[str], x, y, xlim: tuple[float, float], ylim: tuple[float, float],
           gridsize: int) -> DataFrame:
    """Counts on a hexagonal grid: the nearer of two offset rectangular lattices."""
    nx, ny = gridsize, int(gridsize / 3 ** 0.5)
    sx, sy = (xlim[1] - xlim[0]) / nx, (ylim[1] - ylim[0]) / ny
    ux, uy = (x - xlim[0]) / sx, (y - ylim[0]) / sy
    t = df.withColumn("_ux", ux).withColumn("_uy", uy)
    i1, j1 = F.rint("_ux"), F.rint("_uy")
    i2, j2 = F.floor("_ux"), F.floor("_uy")
    d1 = F.pow(F.col("_ux") - i1, F.lit(2)) + 3.0 * F.pow(F.col("_uy") - j1, F.lit(2))
    d2 = F.pow(F.col("_ux") - i2 - 0.5, F.lit(2)) + 3.0 * F.pow(F.col("_uy") - j2 - 0.5, F.lit(2))
    first = d1 < d2
    cx = F.when(first, i1.cast("double")).otherwise(i2 + 0.5)
    cy = F.when(first, j1.cast("double")).otherwise(j2 + 0.5)
    return t.groupBy(*by, (cx * sx + xlim[0]).alias("hex_x"), (cy * sy + ylim[0]).alias("hex_y")).agg(
        F.count(F.lit(1)).alias("n"))


def color_limits(df: DataFrame, by: list[str], value: str, lower: float = 0.01, upper: float = 0.99
                 ) -> DataFrame:
    """Quantile limits of the positives and how many fall outside."""
    pos = df.filter(F.col(value) > 0)
    lim = exact_quantiles(pos, by, value, {"vmin": lower, "vmax": upper})
    tiny = 2.2250738585072014e-308
    flat = F.col("vmin") == F.col("vmax")
    lim = lim.select(*by, F.when(flat, F.greatest(F.col("vmin") * 0.8, F.lit(tiny)))
                     .otherwise(F.col("vmin")).alias("vmin"),
                     F.when(flat, F.col("vmax") * 1.2).otherwise(F.col("vmax")).alias("vmax"))
    return pos.join(lim, by).groupBy(*by).agg(
        F.first("vmin").alias("vmin"), F.first("vmax").alias("vmax"),
        F.count_if(F.col(value) < F.col("vmin")).alias("n_below"),
        F.count_if(F.col(value) > F.col("vmax")).alias("n_above"))


def alignment_record(table: DataFrame) -> DataFrame:
    """Tissue and image-bound counts per sample; needs ``bounds_status``."""
    return table.groupBy("sample_id").agg(
        F.count_if(F.col("in_tissue") == 1).alias("n_in_tissue"),
        F.count_if(F.col("in_tissue") == 0).alias("n_off_tissue"),
        F.count_if(F.col("bounds_status") == "outside").alias("n_outside_image"),
        F.count(F.lit(1)).alias("n_positions"))


def image_scale_pair(artifacts: DataFrame, preference: list[str]) -> DataFrame:
    """Per sample the first role, in preference order, with an image and a positive scale.

    ``artifacts`` has sample_id, role, image_path, scale.
    """
    order = F.create_map(*[x for i, p in enumerate(preference) for x in (F.lit(p), F.lit(i))])
    ok = artifacts.withColumn("_rank", F.try_element_at(order, F.col("role"))).filter(
        F.col("_rank").isNotNull() & F.col("image_path").isNotNull() & (F.col("scale") > 0))
    best = ok.groupBy("sample_id").agg(F.min_by(F.struct("role", "image_path", "scale"), "_rank").alias("p"))
    all_samples = artifacts.select("sample_id").distinct()
    return all_samples.join(best, "sample_id", "left").select(
        "sample_id", "p.role", "p.image_path", "p.scale",
        F.when(F.col("p").isNull(), "not_available").otherwise("available").alias("status"))
