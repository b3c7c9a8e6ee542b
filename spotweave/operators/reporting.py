"""Run evidence: resource summaries, warnings and module completion."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from spotweave.functions.exprs import glob_to_regex, step_id
from spotweave.functions.ordering import previous_row, top_n
from spotweave.operators.contracts import duplicate_keys, enforce

FIELDS = ("cpu_percent", "rss_gib", "vms_gib", "project_gib")

# Warning codes with the field, direction and default limit.
WARNING_RULES = (
    ("CPU_CAPACITY_ABOVE_WARNING", "cpu_percent", "above", 80.0),
    ("PROJECT_SIZE_ABOVE_WARNING", "project_gib", "above", 100.0),
    ("PROJECT_SIZE_ABOVE_CRITICAL", "project_gib", "above", 200.0),
    ("FILESYSTEM_FREE_BELOW_WARNING", "free_gib", "below", 20.0),
)


def step_table(summaries: DataFrame) -> DataFrame:
    """One row per resource summary file."""
    p = F.col("peaks")
    return summaries.select(
        step_id(F.col("resource_summary_path")).alias("step_id"), "resource_summary_path", "status", "exit_code",
        "started_utc", "finished_utc", "wall_seconds",
        p["cpu_percent_machine_capacity"].alias("peak_cpu_percent_machine_capacity"),
        p["rss_gib"].alias("peak_rss_gib"), p["vms_gib"].alias("peak_vms_gib"),
        p["project_size_gib"].alias("peak_project_size_gib"), "final_project_size_gib",
        p["filesystem_used_percent"].alias("peak_filesystem_used_percent"),
        F.size(F.coalesce("warnings", F.array())).alias("n_warnings"), "logical_cpu_count")


def ordered_steps(steps: DataFrame) -> DataFrame:
    """Report order, unknown start last."""
    return steps.orderBy(F.col("started_utc").asc_nulls_last(), F.col("step_id").asc())


def resource_overview(steps: DataFrame) -> DataFrame:
    """Counts, maxima and the summed (not elapsed) wall time."""
    return steps.agg(
        F.count(F.lit(1)).alias("n_steps"), F.count_if(F.col("status") == "success").alias("n_success"),
        F.count_if(~F.col("status").eqNullSafe("success")).alias("n_non_success"),
        F.count_if(F.col("n_warnings") > 0).alias("n_steps_with_warnings"),
        F.max("peak_cpu_percent_machine_capacity").alias("max_peak_cpu"),
        F.max("peak_rss_gib").alias("max_peak_rss_gib"),
        F.max("peak_project_size_gib").alias("max_peak_project_size_gib"),
        F.sum("wall_seconds").alias("total_sequential_wall_seconds"))


def step_peaks(samples: DataFrame, fields=FIELDS) -> DataFrame:
    """Peak of every field over a step's snapshots."""
    return samples.groupBy("step").agg(
        F.count(F.lit(1)).alias("n_samples"), *[F.max(f).alias(f"peak_{f}") for f in fields])


def cpu_from_counters(samples: DataFrame, cores: int) -> DataFrame:
    """Share of the machine between snapshots from cumulative CPU seconds.

    ``samples``: step, ts (seconds), seq, cpu_seconds.
    """
    t = previous_row(samples, ["step"], ["ts", "seq"], {"cpu_seconds": "_cpu", "ts": "_ts"})
    used = F.greatest(F.col("cpu_seconds") - F.col("_cpu"), F.lit(0.0))
    wall = F.greatest(F.col("ts") - F.col("_ts"), F.lit(1e-9))
    return t.withColumn("cpu_percent", F.coalesce(100.0 * used / (wall * cores), F.lit(0.0))).drop("_cpu", "_ts")


def threshold_warnings(samples: DataFrame, rules=WARNING_RULES) -> DataFrame:
    """First crossing and peak per step and warning code, in one aggregation."""
    items = []
    for code, field, side, limit in rules:
        over = F.col(field) > limit if side == "above" else F.col(field) < limit
        items.append(F.when(over, F.struct(
            F.lit(code).alias("code"), F.lit(float(limit)).alias("threshold"), F.col(field).alias("value"))))
    hits = samples.select("step", "ts", F.explode(F.array_compact(F.array(*items))).alias("w"))
    return hits.groupBy("step", F.col("w.code").alias("code"), F.col("w.threshold").alias("threshold")).agg(
        F.min("ts").alias("first_ts"), F.max("w.value").alias("peak_observed"))


# Summary states that replace a plain completion.
REPORTED_STATES = (
    "completed_no_eligible_results",
    "completed_with_model_failures",
    "completed_with_failures",
)


def matching_artifacts(artifacts: DataFrame, module: str, pattern: str, max_items: int | None = None) -> DataFrame:
    """Artifacts (module, path) of one module whose path matches a glob, the first ones by path if bounded."""
    hits = artifacts.filter((F.col("module") == module) & F.col("path").rlike(glob_to_regex(pattern)))
    return hits if max_items is None else top_n(hits, ["module"], [F.col("path").asc()], max_items, "_rank").drop("_rank")


def module_completion(modules: DataFrame, sidecars: DataFrame, summaries: DataFrame,
                      qc_states: DataFrame) -> DataFrame:
    """Completion status per module, strongest evidence first.

    ``modules``: module, selected; ``sidecars``: module, report_status, status_detail (one per
    module); ``summaries``: module, summary_status; ``qc_states``: overall_state per sample.
    """
    enforce(duplicate_keys(sidecars.select("module"), ["module"]), "MODULE_SIDECAR_DUPLICATE")
    qc = qc_states.agg(
        (F.count_if(F.col("overall_state") == "HARD_BLOCKED") > 0).alias("_blocked"),
        (F.count_if(F.col("overall_state") != "FINAL") > 0).alias("_open"), F.lit("qc").alias("module"))
    t = (modules.join(sidecars, "module", "left").join(summaries, "module", "left")
         .join(qc, "module", "left"))
    status = (
        F.when(~F.col("selected"), "not_requested")
        .when(F.col("module") == "report", "pending_reader_html")
        .when(F.col("report_status").isNotNull(), F.col("report_status"))
        .when(F.col("_blocked"), "completed_with_qc_flags").when(F.col("_open"), "review_required")
        .when(F.col("summary_status").isin(*REPORTED_STATES), F.col("summary_status"))
        .otherwise("completed"))
    told = F.col("selected") & (F.col("module") != "report") & F.col("report_status").isNotNull()
    return t.select("module", status.alias("status"),
                    F.when(told, F.coalesce("status_detail", F.lit(""))).otherwise("").alias("status_detail"))
