"""Scans: tables, matrices, positions, labels, gene sets, reviews, JSON summaries.

All scans read whole folders (one file or sub-folder per sample) in one job.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F, types as T

from spotweave.functions.exprs import barcode_core_strict, mitochondrial, parse_boolean
from spotweave.functions.runtime import durable
from spotweave.operators.contracts import (
    ContractError, checksum_mismatch, duplicate_keys, enforce, require_columns)

# Fixed value: the sample identifier pattern.
SAMPLE_ID_PATTERN = "^[A-Za-z0-9][A-Za-z0-9._-]*$"


def text_schema(columns) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def read_text_table(spark: SparkSession, path: str, sep: str = "\t", columns=None) -> DataFrame:
    """Delimited text as strings with empty fields kept as empty strings."""
    reader = spark.read.option("sep", sep).option("header", True).option("recursiveFileLookup", True)
    df = reader.schema(text_schema(columns)).csv(path) if columns else reader.csv(path)
    return df.fillna("")


def read_sample_sheet(spark: SparkSession, path: str) -> DataFrame:
    """Sample sheet with an open set of extra columns."""
    df = read_text_table(spark, path)
    require_columns(df, ["sample_id"], "sample sheet")
    enforce(df.filter(~F.col("sample_id").rlike(SAMPLE_ID_PATTERN)).select("sample_id"),
            "SAMPLE_ID_INVALID")
    enforce(duplicate_keys(df, ["sample_id"]), "SAMPLE_ID_DUPLICATE")
    if df.isEmpty():
        raise ContractError("SAMPLE_SHEET_EMPTY", path)
    return df


def _sample_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines with the sample folder (``S1`` or ``sample_id=S1``) and a key of their order.

    The files of a folder follow each other by name; a split of a file is read by one task from top to bottom.
    """
    lines = spark.read.option("recursiveFileLookup", True).text(path)
    file = F.col("_metadata.file_path")
    return lines.select(
        # A pattern tried at every place of a long path, once a line, took most of a scan's time.
        F.substring_index(F.substring_index(F.substring_index(file, "/", -2), "/", 1), "=", -1).alias("sample_id"),
        F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"), F.col("value"))


SPLIT = ["sample_id", "file", "block"]


def _first_lines(lines: DataFrame) -> DataFrame:
    """The first of the given lines of each sample: numbers only are aggregated, and one row per split is ordered."""
    starts = lines.groupBy(*SPLIT).agg(F.min("seq").alias("seq"))
    first = durable(starts.groupBy("sample_id").agg(F.min(F.struct("file", "block", "seq")).alias("k")).select("sample_id", "k.*"))
    return durable(lines.join(first, [*SPLIT, "seq"]))


def _numbered(spark: SparkSession, path: str) -> DataFrame:
    """Line numbers (1-based) within each sample: the lines of the splits before, and the place in the own one."""
    lines = _sample_lines(spark, path)
    splits = lines.groupBy(*SPLIT).agg(F.min("seq").alias("_start"), F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy("sample_id").orderBy("file", "block").rowsBetween(W.unboundedPreceding, -1)  # one row per split
    splits = durable(splits.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n"))
    return lines.join(splits, SPLIT).withColumn("idx", F.col("_before") + F.col("seq") - F.col("_start") + 1).drop(
        "file", "block", "seq", "_start", "_before")


def mtx_dimensions(spark: SparkSession, matrix_path: str) -> DataFrame:
    """n_features, n_barcodes, nnz from the size line (first line without ``%``)."""
    body = _sample_lines(spark, matrix_path).filter(~F.col("value").startswith("%"))
    first = _first_lines(body)
    parts = F.split(F.trim("value"), r"\s+")
    return first.select("sample_id", *[
        parts[i].cast("long").alias(n) for i, n in enumerate(("n_features", "n_barcodes", "nnz"))])


def read_features(spark: SparkSession, path: str) -> DataFrame:
    parts = F.split("value", "\t")
    return _numbered(spark, path).select(
        "sample_id", F.col("idx").alias("row"), parts[0].alias("gene_id"),
        F.coalesce(F.get(parts, F.lit(1)), parts[0]).alias("gene_symbol"),
        F.coalesce(F.get(parts, F.lit(2)), F.lit("Gene Expression")).alias("feature_type"))


def read_10x_count_matrix(spark: SparkSession, matrix_path: str, features_path: str,
                          barcodes_path: str) -> DataFrame:
    """Gene-expression triplets of all samples from MTX text.

    Contracts, in one pass over the text: as many entries as the size line says, counts finite,
    not negative and whole. Stored zeros are dropped; barcodes and gene ids are unique.
    """
    body = _sample_lines(spark, matrix_path).filter(~F.col("value").startswith("%"))
    parts = F.split(F.trim("value"), r"\s+")
    heads = _first_lines(body).select("sample_id", F.struct("file", "block", "seq", "value").alias("head"))
    entries = body.join(heads, "sample_id").filter(F.struct("file", "block", "seq") != F.struct("head.file", "head.block", "head.seq"))
    x = parts[2].try_cast("double")
    bad = x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")) | (x < 0) | (x != F.floor(x))
    seen = entries.groupBy("sample_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(bad).alias("n_bad"))
    nnz = F.split(F.trim("head.value"), r"\s+")[2].try_cast("long")
    checked = heads.select("sample_id", nnz.alias("nnz")).join(seen, "sample_id", "left").fillna(0, ["n", "n_bad"])
    checked = checked.filter("n_bad > 0 or nnz is null or nnz <> n").select("sample_id", "nnz", "n", "n_bad").limit(5).collect()
    if any(r["n_bad"] for r in checked):
        raise ContractError("RAW_COUNT_CONTRACT", str([r.asDict() for r in checked]))
    if checked:
        raise ContractError("MTX_SIZE_MISMATCH", str([r.asDict() for r in checked]))
    entries = entries.select("sample_id", parts[0].cast("long").alias("row"), parts[1].cast("long").alias("col"),
                             x.cast("long").alias("count")).filter("count <> 0")
    features = read_features(spark, features_path).filter("feature_type = 'Gene Expression'")
    enforce(duplicate_keys(features, ["sample_id", "gene_id"]), "GENE_ID_DUPLICATE")
    barcodes = _numbered(spark, barcodes_path).select(
        "sample_id", F.col("idx").alias("col"), F.trim("value").alias("barcode"))
    enforce(duplicate_keys(barcodes, ["sample_id", "barcode"]), "BARCODE_DUPLICATE")
    return (
        entries.join(features, ["sample_id", "row"]).join(barcodes, ["sample_id", "col"])
        .select("sample_id", "barcode", "gene_id", "gene_symbol", "count")
    )


# Canonical position columns in file order.
POSITION_COLUMNS = (
    "barcode",
    "in_tissue",
    "array_row",
    "array_col",
    "pxl_row_in_fullres",
    "pxl_col_in_fullres",
)


def read_positions(spark: SparkSession, path: str) -> DataFrame:
    """Headered or legacy position files; the sample is the folder name.

    A header names the columns of its file, in any order; without one they stand in file
    order. A field that is neither empty nor a number is an error.
    """
    lines = _sample_lines(spark, path).filter(F.trim("value") != "")
    fields = F.transform(F.split("value", ","), lambda x: F.trim(F.regexp_replace(x, r'^\s*"|"\s*$', "")))
    is_head = F.array_contains(fields, "barcode")
    heads = durable(lines.filter(is_head).groupBy("sample_id").agg(F.min_by(fields, F.struct("file", "block", "seq")).alias("head")))
    rows = lines.filter(~is_head).select("sample_id", fields.alias("fields")).join(heads, "sample_id", "left")
    names = F.coalesce("head", F.array(*[F.lit(c) for c in POSITION_COLUMNS]))
    found = rows.select("sample_id", *[F.get("fields", F.array_position(names, c).cast("int") - 1).alias(c) for c in POSITION_COLUMNS])
    absent = heads.filter(F.size(F.array_except(F.array(*[F.lit(c) for c in POSITION_COLUMNS]), "head")) > 0)
    enforce(absent.select("sample_id", F.array_join("head", ",").alias("header")), "POSITION_COLUMNS_MISSING")
    kinds = {c: "int" if i < 4 else "double" for i, c in enumerate(POSITION_COLUMNS) if i}

    def number(c: str):
        x = F.nullif(F.col(c), F.lit("")).try_cast("double")
        return F.when(x == F.floor(x), x.try_cast("int")) if kinds[c] == "int" else x

    junk = F.lit(False)
    for c in kinds:
        junk = junk | ((F.coalesce(F.col(c), F.lit("")) != "") & number(c).isNull())
    enforce(found.filter(junk), "POSITION_NOT_NUMERIC")
    typed = found.select("sample_id", "barcode", *[number(c).alias(c) for c in kinds])
    enforce(duplicate_keys(typed, ["sample_id", "barcode"]), "POSITION_BARCODE_DUPLICATE")
    return typed


def inspect_positions(positions: DataFrame, columns=("in_tissue", "array_row", "array_col",
                                                     "pxl_row", "pxl_col")) -> DataFrame:
    """Rows, repeated barcodes, tissue counts and missing values per sample."""
    repeats = positions.groupBy("sample_id", "barcode").agg(F.count(F.lit(1)).alias("c")).groupBy(
        "sample_id").agg(F.sum(F.col("c") - 1).alias("n_duplicate_barcodes"))
    main = positions.groupBy("sample_id").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(F.col("in_tissue") == 1).alias("n_in_tissue"),
        F.count_if(F.col("in_tissue") == 0).alias("n_off_tissue"),
        *[F.count_if(F.col(c).isNull()).alias(f"missing_{c}") for c in columns])
    return main.join(repeats, "sample_id")


def feature_summary(features: DataFrame, by=()) -> DataFrame:
    """S06."""
    return features.groupBy(*by, "feature_type").agg(F.count(F.lit(1)).alias("n_features"))


def mitochondrial_feature_count(features: DataFrame, prefixes=("MT-",), case_sensitive=False
                                ) -> DataFrame:
    """S07."""
    return features.agg(F.count_if(
        mitochondrial(F.col("gene_symbol"), prefixes, case_sensitive)).alias("n_mitochondrial"))


#: What a capability or metric rests on, in words for a reader, and the evidence that shows it.
CAPABILITY_GROUNDS = {
    ("capability", "raw_counts_matrix"): ("raw barcode matrix", ("raw_matrix",)),
    ("capability", "filtered_counts_matrix"): ("filtered barcode matrix", ("filtered_matrix",)),
    ("capability", "array_coordinates"): ("complete array coordinates", ("positions",)),
    ("capability", "pixel_coordinates"): ("complete pixel coordinates", ("positions",)),
    ("capability", "in_tissue_labels"): ("complete tissue labels", ("positions",)),
    ("capability", "histology_image"): ("histology image", ("images",)),
    ("capability", "registered_histology"): ("registered image, pixel coordinates and scale factors", ("images", "positions", "scalefactors")),
    ("capability", "upstream_metrics"): ("upstream summary metrics", ("metrics_summary",)),
    ("capability", "molecule_level_data"): ("molecule file", ("molecule_info",)),
    ("capability", "mitochondrial_features"): ("mitochondrial feature names", ("features",)),
    ("capability", "raw_reads"): ("read files", ("reads",)),
    ("qc_metric", "in_tissue"): ("complete tissue labels", ("positions",)),
    ("qc_metric", "total_counts"): ("count matrix", ("raw_matrix", "filtered_matrix")),
    ("qc_metric", "detected_genes"): ("count matrix", ("raw_matrix", "filtered_matrix")),
    ("qc_metric", "mitochondrial_fraction"): ("count matrix and mitochondrial feature names", ("raw_matrix", "filtered_matrix", "features")),
    ("qc_metric", "image_alignment"): ("registered image, pixel coordinates and scale factors", ("images", "positions")),
    ("qc_metric", "spatial_artifacts"): ("count matrix, array coordinates and registered image",
                                         ("raw_matrix", "filtered_matrix", "positions", "images")),
}
# How a metric is judged where that is not automatic.
METRIC_MODES = {"image_alignment": "visual_review", "spatial_artifacts": "hybrid"}


def explained_capabilities(evidence: DataFrame) -> DataFrame:
    """S08 with its grounds: ``capabilities`` and mode, reason and evidence of every entry.

    ``paths`` (map from kind of evidence to paths) is optional in the evidence; a capability
    has no mode. Evidence is the sorted distinct paths of what the entry rests on.
    """
    paths = F.col("paths") if "paths" in evidence.columns else F.lit(None).cast("map<string,array<string>>")
    none = F.array().cast("array<string>")
    grounds = F.explode(F.array(*[F.struct(
        F.lit(k).alias("kind"), F.lit(n).alias("name"), F.lit(text).alias("grounds"),
        F.lit("automatic" if n not in METRIC_MODES else METRIC_MODES[n]).alias("mode"),
        F.array_join(F.array_sort(F.array_distinct(F.array_compact(F.concat(*[
            F.coalesce(F.try_element_at(paths, F.lit(s)), none) for s in sources])))), ";").alias("evidence"))
        for (k, n), (text, sources) in CAPABILITY_GROUNDS.items()])).alias("g")
    known = evidence.select("sample_id", grounds).select("sample_id", "g.*")
    reason = F.when(F.col("status") == "available", F.concat(F.lit("present: "), "grounds")).when(
        F.col("status") == "partial", "present: count matrix, array coordinates; absent: registered image").otherwise(
        F.concat(F.lit("absent or incomplete: "), "grounds"))
    return capabilities(evidence).join(known, ["sample_id", "kind", "name"]).select(
        "sample_id", "kind", "name", "status", F.when(F.col("kind") == "qc_metric", F.col("mode")).alias("mode"), reason.alias("reason"), "evidence")


def capabilities(evidence: DataFrame) -> DataFrame:
    """Eleven capabilities and six metric statuses from one evidence row per sample.

    Evidence columns: n_raw_counts, n_filtered_counts, n_positions, missing_array,
    missing_pixel, missing_in_tissue, n_images, registered_image, scalefactors_valid,
    metrics_summary, molecule_info, n_mitochondrial, n_read_files.
    """
    has_places = F.col("n_positions") > 0
    array = has_places & (F.col("missing_array") == 0)
    pixel = has_places & (F.col("missing_pixel") == 0)
    tissue = has_places & (F.col("missing_in_tissue") == 0)
    counts = (F.col("n_raw_counts") > 0) | (F.col("n_filtered_counts") > 0)
    histology = F.col("registered_image") & pixel & F.col("scalefactors_valid")
    mito = F.col("n_mitochondrial") > 0
    yes_no = {
        ("capability", "raw_counts_matrix"): F.col("n_raw_counts") > 0,
        ("capability", "filtered_counts_matrix"): F.col("n_filtered_counts") > 0,
        ("capability", "array_coordinates"): array,
        ("capability", "pixel_coordinates"): pixel,
        ("capability", "in_tissue_labels"): tissue,
        ("capability", "histology_image"): F.col("n_images") > 0,
        ("capability", "registered_histology"): histology,
        ("capability", "upstream_metrics"): F.col("metrics_summary"),
        ("capability", "molecule_level_data"): F.col("molecule_info"),
        ("capability", "mitochondrial_features"): mito,
        ("capability", "raw_reads"): F.col("n_read_files") > 0,
        ("qc_metric", "in_tissue"): tissue,
        ("qc_metric", "total_counts"): counts,
        ("qc_metric", "detected_genes"): counts,
        ("qc_metric", "mitochondrial_fraction"): counts & mito,
        ("qc_metric", "image_alignment"): histology,
    }
    entries = [
        F.struct(F.lit(k).alias("kind"), F.lit(n).alias("name"),
                 F.when(c, "available").otherwise("not_available").alias("status"))
        for (k, n), c in yes_no.items()]
    artifact = F.when(counts & array & histology, "available").when(
        counts & array, "partial").otherwise("not_available")
    entries.append(F.struct(F.lit("qc_metric").alias("kind"),
                            F.lit("spatial_artifacts").alias("name"), artifact.alias("status")))
    return evidence.select("sample_id", F.explode(F.array(*entries)).alias("e")).select(
        "sample_id", "e.kind", "e.name", "e.status")


def read_roi(spark: SparkSession, path: str, barcode_column: str = "Barcode",
             label_column: str | None = None) -> DataFrame:
    """One barcode and one label column; the label column may be inferred."""
    df = read_text_table(spark, path, sep=",")
    if barcode_column not in df.columns:
        raise ContractError("ROI_REQUIRED_COLUMN_MISSING", f"no barcode column {barcode_column!r}")
    others = [c for c in df.columns if c != barcode_column]
    if label_column is None:
        if len(others) != 1:
            raise ContractError("ROI_REQUIRED_COLUMN_MISSING", f"label column not inferable from {others}")
        label_column = others[0]
    if label_column not in df.columns:
        raise ContractError("ROI_REQUIRED_COLUMN_MISSING", f"no label column {label_column!r}")
    out = df.select(F.trim(barcode_column).alias("roi_barcode"), F.trim(label_column).alias("roi_label"))
    enforce(duplicate_keys(out, ["roi_barcode"]), "ROI_DUPLICATE_BARCODE")
    return out


def read_aliases(spark: SparkSession, path: str, allow_empty: bool = True) -> DataFrame:
    """Unique, non-empty source labels; status and notes are optional."""
    df = read_text_table(spark, path)
    require_columns(df, ["source_label", "canonical_label"], "ROI alias table")
    for name, default in (("status", "unspecified"), ("notes", "")):
        if name not in df.columns:
            df = df.withColumn(name, F.lit(default))
    df = df.withColumn("status", F.when(F.col("status") == "", "unspecified").otherwise(F.col("status")))
    if not allow_empty and df.isEmpty():
        raise ContractError("ROI_ALIAS_EMPTY", path)
    enforce(df.filter("trim(source_label) = '' or trim(canonical_label) = ''"), "ROI_ALIAS_BLANK")
    enforce(duplicate_keys(df, ["source_label"]), "ROI_ALIAS_DUPLICATE")
    return df


def alias_audit(aliases: DataFrame) -> DataFrame:
    """Labels per status and whether the status asks for review."""
    return aliases.groupBy("status").agg(F.count(F.lit(1)).alias("n_labels")).withColumn(
        "review_required", F.lower("status").contains("review"))


def review_required(aliases: DataFrame) -> DataFrame:
    """The alias rows whose status asks for review."""
    return aliases.filter(F.lower("status").contains("review"))


def read_gmt(spark: SparkSession, path: str, library_id: str) -> DataFrame:
    """Term, description and ordered distinct genes per line."""
    lines = spark.read.option("recursiveFileLookup", True).text(path)
    f = F.split(F.regexp_replace("value", "\r$", ""), "\t")
    genes = F.array_distinct(F.filter(
        F.transform(F.slice(f, F.lit(3), F.greatest(F.size(f) - 2, F.lit(0))), lambda g: F.trim(g)),
        lambda g: g != ""))
    sets = lines.select(F.lit(library_id).alias("library_id"), F.trim(f[0]).alias("term"),
                        F.trim(F.get(f, F.lit(1))).alias("description"), F.size(f).alias("_n"),
                        genes.alias("genes"))
    enforce(sets.filter("_n < 3 or term = '' or size(genes) = 0").select("term"), "GMT_MALFORMED")
    enforce(duplicate_keys(sets, ["term"]), "GMT_TERM_DUPLICATE")
    return sets.drop("_n")


def file_checksums(spark: SparkSession, path: str) -> DataFrame:
    """SHA-256 of every file below a folder, computed next to the data."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select(
        F.regexp_extract("path", "([^/]+)$", 1).alias("file_name"), "length",
        F.sha2("content", 256).alias("observed_sha256"))


def verify_manifest(manifest: DataFrame, checksums: DataFrame) -> DataFrame:
    """Enabled libraries whose file matches its declared SHA-256."""
    require_columns(manifest, ["library_id", "enabled", "gmt_path", "sha256"], "gene-set manifest")
    enforce(duplicate_keys(manifest, ["library_id"]), "LIBRARY_ID_DUPLICATE")
    enabled = manifest.filter(F.coalesce(parse_boolean(F.col("enabled"), ("yes", "y")), F.lit(False)))
    if enabled.isEmpty():
        raise ContractError("NO_ENABLED_LIBRARY", "gene-set manifest")
    named = enabled.withColumn("file_name", F.regexp_extract("gmt_path", "([^/]+)$", 1))
    enforce(checksum_mismatch(named, checksums, ["file_name"]).select(
        "library_id", "sha256", "observed_sha256"), "GMT_SHA256_MISMATCH")
    return named.join(checksums, "file_name").withColumn("verified", F.lit(True))


# Review table columns, decisions and the ones that complete a review.
REVIEW_COLUMNS = ("sample_id", "component", "decision", "evidence", "reviewer", "reviewed_at", "notes")
REVIEW_DECISIONS = ("PASS", "WARN", "FAIL", "PENDING", "NA")
COMPLETED_DECISIONS = ("PASS", "WARN", "FAIL")


def check_reviews(reviews: DataFrame, samples: DataFrame, components) -> DataFrame:
    """Trimmed, upper-cased reviews after all key, decision and evidence checks."""
    if tuple(reviews.columns) != REVIEW_COLUMNS:
        raise ContractError("REVIEW_COLUMNS", f"expected exactly {REVIEW_COLUMNS}")
    r = reviews.select(
        F.trim("sample_id").alias("sample_id"), F.trim("component").alias("component"),
        F.upper(F.trim("decision")).alias("decision"), *REVIEW_COLUMNS[3:])
    enforce(r.filter("sample_id = '' or component = '' or decision = ''"), "REVIEW_BLANK")
    enforce(r.join(samples, "sample_id", "left_anti").select("sample_id"), "REVIEW_UNKNOWN_SAMPLE")
    enforce(r.filter(~F.col("component").isin(*components)).select("component"),
            "REVIEW_UNKNOWN_COMPONENT")
    enforce(r.filter(~F.col("decision").isin(*REVIEW_DECISIONS)).select("decision"),
            "REVIEW_UNKNOWN_DECISION")
    done = r.filter(F.col("decision").isin(*COMPLETED_DECISIONS))
    blank = reduce(lambda a, b: a | b, [F.trim(c) == "" for c in ("evidence", "reviewer", "reviewed_at")])
    enforce(done.filter(blank).select("sample_id", "component"), "REVIEW_INCOMPLETE")
    enforce(done.filter(F.try_to_timestamp("reviewed_at").isNull()).select("sample_id", "reviewed_at"),
            "REVIEW_TIME_INVALID")
    enforce(duplicate_keys(r, ["sample_id", "component"]), "REVIEW_DUPLICATE")
    return r


def check_profile(thresholds: DataFrame) -> DataFrame:
    """(component, warn, passed, higher_is_better) rows; both limits set or both NULL, in order.

    Returns the offending rows.
    """
    w, p = F.col("warn"), F.col("passed")
    half = w.isNull() != p.isNull()
    order = F.when(F.col("higher_is_better"), (w < 0) | (p < w)).otherwise(
        (p < 0) | (w < p) | (w > 1))
    return thresholds.filter(half | F.coalesce(order, F.lit(False)))


def incompatible_assays(sample_assays: DataFrame, allowed: DataFrame) -> DataFrame:
    """Samples whose assay the calibrated profile does not list."""
    return sample_assays.join(allowed.select("assay").distinct(), "assay", "left_anti")


RESOURCE_SCHEMA = (
    "command array<string>, status string, exit_code int, started_utc string, finished_utc string, "
    "wall_seconds double, logical_cpu_count int, final_project_size_gib double, "
    "warnings array<struct<code:string>>, "
    "peaks struct<cpu_percent_machine_capacity:double, rss_gib:double, vms_gib:double, "
    "project_size_gib:double, filesystem_used_percent:double, io_read_gib_observed:double, "
    "io_write_gib_observed:double>")


def discover_resource_summaries(spark: SparkSession, path: str) -> DataFrame:
    """JSON files below a folder that have the resource-summary keys, once per path."""
    found = (
        spark.read.schema(RESOURCE_SCHEMA).option("recursiveFileLookup", True)
        .option("multiLine", True).option("pathGlobFilter", "*.json").json(path)
        .withColumn("resource_summary_path", F.col("_metadata.file_path"))
        .filter("peaks is not null and wall_seconds is not null and started_utc is not null")
    )
    return found.dropDuplicates(["resource_summary_path"])


def wide_to_long(df: DataFrame, key: list[str], metrics: dict[str, str]) -> DataFrame:
    """Wide metric columns to (key, metric, value) rows."""
    require_columns(df, [*key, *metrics], "reference metrics")
    items = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(c).cast("double").alias("value"))
                      for c, m in metrics.items()])
    return df.select(*key, F.explode(items).alias("_m")).select(*key, "_m.metric", "_m.value")


def read_cluster_csv(spark: SparkSession, path: str) -> DataFrame:
    """Cluster labels of another pipeline: Barcode, sampleid, clusters; the barcode core decides validity."""
    df = read_text_table(spark, path, sep=",")
    require_columns(df, ["Barcode", "sampleid", "clusters"], "reference clusters")
    core = barcode_core_strict(F.col("Barcode"))
    return df.select(
        F.col("Barcode").alias("source_identifier"), F.col("sampleid").alias("sample_id"), F.col("clusters").alias("reference_cluster"),
        F.col("Barcode").alias("barcode"), core.alias("barcode_core"), core.isNotNull().alias("identifier_valid"))


def read_cluster_parquet(spark: SparkSession, path: str, spots: DataFrame, identifier: str = "source_identifier") -> DataFrame:
    """Cluster labels of another pipeline: one label column beside the identifier.

    Sample, barcode and validity come from ``spots`` by identifier; a label without a spot is
    invalid. Raises CLUSTER_IDENTIFIER_DUPLICATE where an identifier stands twice on either side.
    """
    df = spark.read.parquet(path)
    require_columns(df, [identifier], "reference clusters")
    labels = [c for c in df.columns if c != identifier]
    if len(labels) != 1:
        raise ContractError("CLUSTER_COLUMNS", f"one label column is needed, found {sorted(labels)}")
    found = df.select(F.col(identifier).cast("string").alias("source_identifier"), F.col(labels[0]).cast("string").alias("reference_cluster"))
    known = spots.select("source_identifier", "sample_id", "barcode", "identifier_valid")
    for side in (found, known):
        enforce(duplicate_keys(side, ["source_identifier"]), "CLUSTER_IDENTIFIER_DUPLICATE")
    return found.join(known, "source_identifier", "left").withColumn("identifier_valid", F.coalesce("identifier_valid", F.lit(False)))


def parsed_identifiers(df: DataFrame, identifier: str = "spot_id", label: str = "expression_cluster") -> DataFrame:
    """Spot identifiers ``sample::barcode`` taken apart; one without its sample's prefix is invalid and has no barcode."""
    require_columns(df, [identifier, "sample_id", label], "current spots")
    prefix = F.concat("sample_id", F.lit("::"))
    ok = F.coalesce(F.col(identifier).startswith(prefix), F.lit(False))
    return df.select(
        "sample_id", F.when(ok, F.expr(f"substr({identifier}, length(sample_id) + 3)")).alias("barcode"), F.col(label).alias("label"),
        F.col(identifier).alias("source_identifier"), ok.alias("identifier_valid"))


def label_with_validity(df: DataFrame, label: str) -> DataFrame:
    """Labels keyed by sample and barcode with a validity flag."""
    ok = (F.coalesce(F.trim("sample_id") != "", F.lit(False))
          & F.coalesce(F.trim("barcode") != "", F.lit(False)))
    return df.select(
        "sample_id", "barcode", F.col(label).alias("label"),
        F.concat_ws("::", "sample_id", "barcode").alias("source_identifier"),
        ok.alias("identifier_valid"))


# Eligibility columns an analysis may read.
ELIGIBILITY_COLUMNS = (
    "barcode",
    "sample_id",
    "in_primary_matrix",
    "eligibility_state",
    "recommended_keep",
    "reason_codes",
)


def scan_eligibility(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """Declared columns only, and the names of ignored ones."""
    require_columns(df, ["barcode", "in_primary_matrix", "recommended_keep", "eligibility_state"])
    kept = [c for c in ELIGIBILITY_COLUMNS if c in df.columns]
    return df.select(*kept), sorted(set(df.columns) - set(kept))


def attach_sample_metadata(spots: DataFrame, metadata: DataFrame) -> DataFrame:
    """M:1 sample columns on spots; Spark broadcasts the sheet when it is small."""
    clash = sorted((set(metadata.columns) & set(spots.columns)) - {"sample_id"})
    if clash:
        raise ContractError("METADATA_RESERVED_COLUMN", str(clash))
    return spots.join(metadata, "sample_id", "left")


# Media types by extension.
MEDIA_TYPES = {
    "json": "application/json",
    "tsv": "text/tab-separated-values",
    "csv": "text/csv",
    "txt": "text/plain",
    "md": "text/markdown",
    "html": "text/html",
    "png": "image/png",
    "pdf": "application/pdf",
    "gz": "application/gzip",
}


def artifact_inventory(files: DataFrame, hash_limit: int) -> DataFrame:
    """One row per path with size, media type and a checksum up to a size limit.

    ``files`` has path, length, content (as the ``binaryFile`` source gives).
    """
    plain = F.regexp_replace(F.lower("path"), r"(?<=\.[a-z0-9]{1,8})\.gz$", "")  # the type of what is compressed
    ext = F.regexp_extract(plain, r"\.([^./]+)$", 1)
    media = F.create_map(*[F.lit(x) for kv in MEDIA_TYPES.items() for x in kv])
    return files.dropDuplicates(["path"]).select(
        "path", F.col("length").alias("size_bytes"),
        F.regexp_extract("path", "^results/([^/]+)/", 1).alias("module"),
        F.when(F.col("length") <= hash_limit, F.sha2("content", 256)).alias("sha256"),
        F.coalesce(F.try_element_at(media, ext), F.lit("application/octet-stream")).alias("media_type"))
