"""Validation contracts: each returns its violations; ``enforce`` raises a coded error.

A contract never looks at more than a handful of example rows on the driver.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from spotweave.functions.exprs import parse_boolean

EXAMPLES = 5


class ContractError(ValueError):
    """A broken data contract with a stable code."""

    def __init__(self, code: str, detail: str):
        super().__init__(f"{code}: {detail}")
        self.code = code


def enforce(violations: DataFrame, code: str, detail: str = "") -> None:
    """Raise with up to five examples when there is any violation."""
    examples = [r.asDict() for r in violations.limit(EXAMPLES).collect()]
    if examples:
        raise ContractError(code, f"{detail} examples={examples}".strip())


def require_columns(df: DataFrame, columns: Iterable[str], label: str = "table") -> None:
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ContractError("REQUIRED_COLUMN_MISSING", f"{label} lacks {missing}")


def duplicate_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """Repeated or blank keys with their row count."""
    blank = reduce(lambda a, b: a | b, [
        F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == "") for c in key])
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows")).filter(
        (F.col("n_rows") > 1) | blank)


def key_set_difference(left: DataFrame, right: DataFrame, key: list[str]) -> DataFrame:
    """Keys on one side only, with the side."""
    a, b = left.select(*key).distinct(), right.select(*key).distinct()
    return a.join(b, key, "left_anti").withColumn("side", F.lit("missing")).unionByName(
        b.join(a, key, "left_anti").withColumn("side", F.lit("extra")))


def bad_counts(df: DataFrame, column: str, tolerance: float = 1e-6) -> DataFrame:
    """Not finite, negative, or not an integer."""
    c = F.col(column).cast("double")
    infinite = c.isin(float("inf"), float("-inf"))
    return df.filter(c.isNull() | F.isnan(c) | infinite | (c < 0)
                     | (F.abs(c - F.rint(c)) > tolerance))


def drop_zeros(counts: DataFrame, column: str = "count") -> DataFrame:
    """V04."""
    return counts.filter(F.col(column) != 0)


def unparsed_booleans(df: DataFrame, column: str, allow_blank: bool) -> DataFrame:
    """Text that is neither boolean nor, where allowed, blank."""
    text = F.trim(F.coalesce(F.col(column), F.lit("")))
    bad = parse_boolean(text).isNull()
    return df.filter(bad & (text != "") if allow_blank else bad)


def checksum_mismatch(expected: DataFrame, observed: DataFrame, key: list[str]) -> DataFrame:
    """Rows whose ``sha256`` differs from ``observed_sha256`` (or is absent)."""
    return expected.join(observed, key, "left").filter(
        ~F.lower("sha256").eqNullSafe(F.lower("observed_sha256")))


def unparsed_numbers(df: DataFrame, column: str, binary: bool = False) -> DataFrame:
    """Non-blank text that is no number, or outside 0/1 when ``binary``."""
    text = F.trim(F.coalesce(F.col(column).cast("string"), F.lit("")))
    number = text.try_cast("double")
    bad = number.isNull() | (~number.isin(0.0, 1.0) if binary else F.lit(False))
    return df.filter((text != "") & bad)


def unexpected_samples(df: DataFrame, declared: DataFrame) -> DataFrame:
    """Observed sample ids that were not declared, or declared and never seen."""
    return key_set_difference(declared.select("sample_id"), df.select("sample_id"), ["sample_id"])


def functional_dependency(df: DataFrame, lhs: list[str], rhs: list[str]) -> DataFrame:
    """Left values that map to more than one right value (NULL counts as a value).

    Two partial aggregations; no group is ever collected.
    """
    pairs = df.select(*lhs, *rhs).distinct()
    return pairs.groupBy(*lhs).agg(F.count(F.lit(1)).alias("n_values")).filter("n_values > 1")


def varying_within(df: DataFrame, by: list[str], column: str) -> DataFrame:
    """Groups where the column takes more than one non-NULL value."""
    return functional_dependency(df.filter(F.col(column).isNotNull()), by, [column])


def one_to_one(df: DataFrame, left: str, right: str) -> DataFrame:
    """One row, whether both columns are complete and determine each other."""
    complete = df.agg(F.coalesce(F.bool_and(
        F.col(left).isNotNull() & F.col(right).isNotNull()), F.lit(False)).alias("complete"))
    n_forward = functional_dependency(df, [left], [right]).agg(F.count(F.lit(1)).alias("n_forward"))
    n_back = functional_dependency(df, [right], [left]).agg(F.count(F.lit(1)).alias("n_back"))
    parts = [x.withColumn("_k", F.lit(0)) for x in (complete, n_forward, n_back)]
    return reduce(lambda a, b: a.join(b, "_k"), parts).select(
        (F.col("complete") & (F.col("n_forward") == 0) & (F.col("n_back") == 0)).alias("one_to_one"))


def inconsistent_genes(genes: DataFrame) -> DataFrame:
    """Gene ids missing from a sample or carrying two symbols.

    ``genes`` has one row per (sample_id, gene_id, gene_symbol).
    """
    per_gene = genes.groupBy("gene_id").agg(
        F.count_distinct("sample_id").alias("n_samples"),
        F.min("gene_symbol").alias("first_symbol"), F.max("gene_symbol").alias("last_symbol"))
    n = genes.select("sample_id").distinct().agg(F.count(F.lit(1)).alias("n_all"))
    keyed = per_gene.withColumn("_k", F.lit(0)).join(n.withColumn("_k", F.lit(0)), "_k").drop("_k")
    return keyed.filter((F.col("n_samples") != F.col("n_all"))
                        | ~F.col("first_symbol").eqNullSafe(F.col("last_symbol"))).drop("n_all")


def duplicate_coordinates(spots: DataFrame) -> DataFrame:
    """V13."""
    return duplicate_keys(spots, ["sample_id", "array_row", "array_col"])


def coordinate_system(spots: DataFrame) -> DataFrame:
    """Pixel pair where complete, else array pair, else none; a half-filled pair is an error."""
    per = spots.groupBy("sample_id").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count(c).alias(f"n_{c}") for c in ("pxl_row", "pxl_col", "array_row", "array_col")])

    def state(a, b):
        return (F.when((F.col(a) == F.col("n")) & (F.col(b) == F.col("n")), "complete")
                .when((F.col(a) == 0) & (F.col(b) == 0), "absent").otherwise("partial"))

    pixel, array = state("n_pxl_row", "n_pxl_col"), state("n_array_row", "n_array_col")
    return per.select(
        "sample_id", "n",
        F.when((pixel == "partial") | (array == "partial"), "COORDINATE_PAIR_INCOMPLETE")
        .when(pixel == "complete", "pixel").when(array == "complete", "array")
        .otherwise("not_available").alias("coordinate_system"))


def genes_exceed_counts(df: DataFrame) -> DataFrame:
    """V15."""
    return df.filter(F.col("n_genes_by_counts") > F.col("total_counts"))


def keep_disagrees_with_state(df: DataFrame) -> DataFrame:
    """V16."""
    expected = F.when(F.col("eligibility_state") == "keep", True).when(
        F.col("eligibility_state") == "exclude", False)
    return df.filter(~F.col("recommended_keep").eqNullSafe(expected))


def totals_disagree(declared: DataFrame, recomputed: DataFrame, key: list[str],
                    columns: list[str]) -> DataFrame:
    """Declared totals that differ from totals recomputed from the triplets."""
    other = recomputed.select(*key, *[F.col(c).alias(f"_r_{c}") for c in columns])
    differs = reduce(lambda a, b: a | b, [
        ~F.col(c).eqNullSafe(F.coalesce(F.col(f"_r_{c}"), F.lit(0))) for c in columns])
    return declared.join(other, key, "left").filter(differs).drop(*[f"_r_{c}" for c in columns])


def conservation(df: DataFrame, category: str) -> DataFrame:
    """Per sample, rows against the sum of category counts."""
    by = df.groupBy("sample_id", category).agg(F.count(F.lit(1)).alias("n"))
    summed = by.filter(F.col(category).isNotNull()).groupBy("sample_id").agg(
        F.sum("n").alias("n_categorised"))
    total = by.groupBy("sample_id").agg(F.sum("n").alias("n_rows"))
    return total.join(summed, "sample_id", "left").withColumn(
        "conserved", F.col("n_rows") == F.coalesce("n_categorised", F.lit(0)))


def not_descriptive(effects: DataFrame) -> DataFrame:
    """Rows that claim inference in a descriptive table."""
    return effects.filter(
        ~F.coalesce(F.col("exploratory_only"), F.lit(False))
        | F.col("p_value").isNotNull() | F.col("fdr_bh").isNotNull())


def raw_orphans(raw_barcodes: DataFrame, positions: DataFrame) -> DataFrame:
    """Raw barcode without a place; primary or in-tissue place without a raw barcode."""
    key = ["sample_id", "barcode"]
    raw = raw_barcodes.select(*key).distinct()
    lost = raw.join(positions.select(*key), key, "left_anti").withColumn(
        "code", F.lit("RAW_BARCODE_WITHOUT_POSITION"))
    absent = positions.filter(F.col("in_primary_matrix") | (F.col("in_tissue") == 1)).join(
        raw, key, "left_anti")
    code = F.when(F.col("in_primary_matrix"), "PRIMARY_POSITION_ABSENT_RAW").otherwise(
        "IN_TISSUE_POSITION_ABSENT_RAW")
    return lost.unionByName(absent.select(*key, code.alias("code")))


# Labels and patterns of local paths in shareable text.
FORBIDDEN_TEXT = (
    ("file URL", r"(?i)\bfile://"),
    ("Windows drive path", r"(?<![A-Za-z0-9])[A-Za-z]:[\\/]"),
    ("UNC path", r"\\{2,}[^\\\s]+\\{1,}[^\\\s]+"),
    ("common POSIX local path",
     r"(?i)/(?:home|users|private|mnt|tmp|var/tmp|root|workspace|data|srv|opt)/"),
)


def forbidden_text(lines: DataFrame, values: Iterable[str] = (), limit: int | None = None
                   ) -> DataFrame:
    """Line-level hits of local paths and forbidden literals.

    ``lines`` has path, line_number, line. ``limit`` cuts a report; all hits by default.
    """
    hits = [F.when(F.col("line").rlike(p), F.lit(name)) for name, p in FORBIDDEN_TEXT]
    hits += [F.when(F.col("line").contains(v), F.lit(f"forbidden value '{v}'")) for v in values]
    labels = F.array_sort(F.array_distinct(F.array_compact(F.array(*hits))))
    found = lines.withColumn("labels", labels).filter(F.size("labels") > 0).select(
        "path", "line_number", F.array_join("labels", ", ").alias("labels"))
    return found if limit is None else found.orderBy("path", "line_number").limit(limit)
