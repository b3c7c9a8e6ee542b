"""Comparison with external references: join audit, agreement and metric differences."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from spotweave.functions.exprs import difference_class, safe_ratio
from spotweave.functions.stats import agreement, distribution, stacked
from spotweave.operators.contracts import duplicate_keys, enforce

KEY = ["sample_id", "barcode"]
COHORT = "__all__"


def with_join_keys(side: DataFrame) -> DataFrame:
    """Validity and collision flags of one side's rows.

    ``side`` has sample_id, barcode, source_identifier, identifier_valid. The
    collision test is a counted key table joined back, not a window.
    """
    ok = (F.col("identifier_valid") & F.coalesce(F.trim("sample_id") != "", F.lit(False))
          & F.coalesce(F.trim("barcode") != "", F.lit(False)))
    t = side.withColumn("identifier_valid", ok)
    repeated = t.filter("identifier_valid").groupBy(*KEY).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    return t.join(repeated, KEY, "left").withColumn(
        "key_collision", F.col("identifier_valid") & F.col("_n").isNotNull()).drop("_n")


def clean_keys(side: DataFrame) -> DataFrame:
    return with_join_keys(side).filter("identifier_valid and not key_collision")


def spot_join_audit(current: DataFrame, reference: DataFrame) -> DataFrame:
    """One row per key of the union of clean sides plus every unjoinable row."""
    cur, ref = with_join_keys(current), with_join_keys(reference)

    def clean(t, name):
        return t.filter("identifier_valid and not key_collision").select(
            *KEY, F.col("source_identifier").alias(name))

    both = clean(cur, "current_identifier").join(clean(ref, "reference_identifier"), KEY, "full")
    c, r = F.col("current_identifier").isNotNull(), F.col("reference_identifier").isNotNull()
    reason = F.when(c & r, "MATCHED").when(c, "CURRENT_ONLY").otherwise("REFERENCE_ONLY")
    joined = both.select(
        *KEY, F.coalesce("current_identifier", F.lit("")).alias("current_identifier"),
        F.coalesce("reference_identifier", F.lit("")).alias("reference_identifier"),
        c.alias("in_current"), r.alias("in_reference"),
        F.when(c & r, "matched").otherwise("unmatched").alias("join_status"), reason.alias("reason_code"),
        F.when(c & r, "pass").otherwise("method_difference").alias("evidence_class"))

    def failures(t, side):
        bad = t.filter("not identifier_valid or key_collision")
        code = F.when(~F.col("identifier_valid"), f"{side}_INVALID_IDENTIFIER").otherwise(
            f"{side}_KEY_COLLISION")
        own = F.col("source_identifier")
        return bad.select(
            *KEY, (own if side == "CURRENT" else F.lit("")).alias("current_identifier"),
            (own if side == "REFERENCE" else F.lit("")).alias("reference_identifier"),
            F.lit(side == "CURRENT").alias("in_current"), F.lit(side == "REFERENCE").alias("in_reference"),
            F.lit("unjoinable").alias("join_status"), code.alias("reason_code"),
            F.lit("integrity_failure").alias("evidence_class"))

    return joined.unionByName(failures(cur, "CURRENT")).unionByName(failures(ref, "REFERENCE"))


def join_summary(audit: DataFrame) -> DataFrame:
    """Denominators, coverage both ways and status per sample and for the cohort."""
    code = F.col("reason_code")

    def n(name):
        return F.count_if(code == name)

    names = ["CURRENT_INVALID_IDENTIFIER", "REFERENCE_INVALID_IDENTIFIER", "CURRENT_KEY_COLLISION",
             "REFERENCE_KEY_COLLISION"]
    t = audit.withColumn("sample_id", F.coalesce("sample_id", F.lit(""))).rollup("sample_id").agg(
        F.count_if("in_current").alias("current_total_denominator"),
        F.count_if("in_reference").alias("reference_total_denominator"), n("MATCHED").alias("matched"),
        n("CURRENT_ONLY").alias("current_only"), n("REFERENCE_ONLY").alias("reference_only"),
        n(names[0]).alias("current_invalid_identifier"), n(names[1]).alias("reference_invalid_identifier"),
        n(names[2]).alias("current_collision_rows"), n(names[3]).alias("reference_collision_rows"))
    flags = ["current_invalid_identifier", "reference_invalid_identifier", "current_collision_rows",
             "reference_collision_rows"]
    bad = F.array_compact(F.array(*[F.when(F.col(f) > 0, F.lit(x)) for f, x in zip(flags, names)]))
    diff = F.array_compact(F.array(F.when(F.col("current_only") > 0, F.lit("CURRENT_ONLY")),
                                   F.when(F.col("reference_only") > 0, F.lit("REFERENCE_ONLY"))))
    return t.select(
        F.when(F.col("sample_id").isNull(), "cohort").otherwise("sample").alias("scope"),
        F.coalesce("sample_id", F.lit(COHORT)).alias("sample_id"), *t.columns[1:],
        safe_ratio(F.col("matched"), F.col("current_total_denominator")).alias("current_coverage"),
        safe_ratio(F.col("matched"), F.col("reference_total_denominator")).alias("reference_coverage"),
        F.when(F.size(bad) > 0, "fail").otherwise("pass").alias("integrity_status"),
        F.array_join(bad, ";").alias("integrity_reason_codes"),
        F.array_join(diff, ";").alias("method_difference_reason_codes"))


def label_join(current: DataFrame, reference: DataFrame) -> DataFrame:
    """Labels of both sides on clean keys, NULL labels dropped."""
    c = clean_keys(current).select(*KEY, F.col("label").alias("current_label"))
    r = clean_keys(reference).select(*KEY, F.col("label").alias("reference_label"))
    return c.join(r, KEY).dropna(subset=["current_label", "reference_label"])


def cluster_agreement(current: DataFrame, reference: DataFrame) -> DataFrame:
    """ARI and NMI of two labellings, not computable below two matched spots."""
    a = agreement(label_join(current, reference), [], "current_label", "reference_label", minimum=2)
    return a.withColumn("comparison_status", F.when(
        F.col("n_matched") < 2, "not_computable").otherwise("descriptive_method_comparison"))


def metric_rows(spots: DataFrame) -> DataFrame:
    """Five long metrics per sample."""
    t = distribution(stacked(spots, ["sample_id"], ["n_genes_by_counts", "total_counts"]),
                     ["sample_id", "metric"], "value", {"median": 0.5})
    short = F.when(F.col("metric") == "total_counts", "total_counts").otherwise("detected_genes")
    pairs = t.withColumn("_s", short).select("sample_id", F.explode(F.array(
        F.struct(F.concat(F.lit("mean_"), "_s").alias("metric"), F.col("mean").alias("value")),
        F.struct(F.concat(F.lit("median_"), "_s").alias("metric"), F.col("median").alias("value")))).alias("m")).select(
        "sample_id", "m.*")
    n = t.filter("metric = 'total_counts'").select(
        "sample_id", F.lit("n_spots").alias("metric"), (F.col("n") + F.col("n_missing")).cast("double").alias("value"))
    return pairs.unionByName(n)


def compare_metrics(current: DataFrame, reference: DataFrame) -> DataFrame:
    """Full outer join of long metrics with differences and their class."""
    key = ["sample_id", "metric"]
    enforce(duplicate_keys(current, key), "METRIC_KEY_DUPLICATE")
    enforce(duplicate_keys(reference, key), "METRIC_KEY_DUPLICATE")
    j = current.select(*key, F.col("value").alias("value_current")).join(
        reference.select(*key, F.col("value").alias("value_reference")), key, "full")
    gap = F.col("value_current") - F.col("value_reference")
    return j.withColumn("current_minus_reference", gap).withColumn("absolute_difference", F.abs(gap)).withColumn(
        "relative_difference_vs_reference", safe_ratio(gap, F.col("value_reference"))).withColumn(
        "comparison_status", difference_class(F.col("value_current"), F.col("value_reference")))
