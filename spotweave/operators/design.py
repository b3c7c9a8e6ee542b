"""Sample-design audits: cells, units, batches, claims and confounding."""

from __future__ import annotations


from pyspark.sql import DataFrame, functions as F

from spotweave.functions.exprs import design_cell
from spotweave.functions.runtime import literal_table
from spotweave.operators.contracts import ContractError, duplicate_keys, enforce, functional_dependency

# Design cells and the candidate column names of units and batches.
DESIGN_CELLS = ("g0_t0", "g0_t1", "g1_t0", "g1_t1")
REPLICATE_COLUMNS = ("biological_replicate", "replicate_id", "animal_id")
BATCH_COLUMNS = ("batch", "batch_id", "technical_batch")


def assign_design_cells(samples: DataFrame, g_ref: str, g_alt: str, t_ref: str, t_alt: str) -> DataFrame:
    """Design cell of every sample; an off-design sample or an empty cell is an error."""
    levels = [g_ref, g_alt, t_ref, t_alt]
    if any(not str(x or "").strip() for x in levels) or g_ref == g_alt or t_ref == t_alt:
        raise ContractError("DESIGN_NOT_ELIGIBLE", f"levels {levels}")
    out = samples.withColumn("design_cell", design_cell(
        F.col("genotype"), F.col("treatment"), g_ref, g_alt, t_ref, t_alt))
    enforce(out.filter(F.col("design_cell").isNull()).select("sample_id", "genotype", "treatment"),
            "DESIGN_NOT_ELIGIBLE", "factor combination outside the 2x2 design")
    cells = literal_table(samples.sparkSession, [(c,) for c in DESIGN_CELLS], "design_cell string")
    enforce(cells.join(out, "design_cell", "left_anti"), "DESIGN_NOT_ELIGIBLE", "empty cell")
    return out


def with_cell_counts(samples: DataFrame, unit: str = "animal_id") -> DataFrame:
    """Samples and distinct units of its (genotype, treatment) cell on every row."""
    cell = ["genotype", "treatment"]
    n = samples.groupBy(*cell).agg(
        F.count(F.lit(1)).alias("n_samples_in_design_cell"),
        F.count_distinct(F.when(F.trim(unit) != "", F.col(unit))).alias("n_biological_units_in_design_cell"))
    return samples.join(n, cell)


def audit_samples(samples: DataFrame, unit: str = "animal_id", batch: str | None = "technical_batch"
                  ) -> DataFrame:
    """Replicate and batch status of every sample row with its cell counts."""
    enforce(duplicate_keys(samples, ["sample_id"]), "SAMPLE_ID_DUPLICATE")
    enforce(functional_dependency(samples, ["condition"], ["genotype", "treatment"]), "CONDITION_AMBIGUOUS")
    out = with_cell_counts(samples, unit)
    per_unit = samples.filter(F.trim(unit) != "").groupBy(unit).agg(
        F.count_distinct("genotype", "treatment").alias("_cells"), F.count(F.lit(1)).alias("_rows"))
    out = out.join(per_unit, unit, "left")
    status = (F.when(F.coalesce(F.trim(unit), F.lit("")) == "", "unknown_missing")
              .when(F.col("_cells") > 1, "invalid_unit_crosses_design_cells")
              .when(F.col("_rows") > 1, "unsupported_multiple_sections_per_unit").otherwise("provided"))
    out = out.withColumn("biological_replicate_status", status).drop("_cells", "_rows")
    known = F.lit("unknown_not_provided") if batch is None else F.when(
        F.coalesce(F.trim(batch), F.lit("")) != "", "provided").otherwise("unknown_missing")
    return out.withColumn("technical_batch_status", known)


def design_summary(audited: DataFrame, min_units: int = 3) -> DataFrame:
    """One row: completeness of the 2x2, limitations and the allowed claim."""
    crosses = F.count_if(F.col("biological_replicate_status") == "invalid_unit_crosses_design_cells") > 0
    several = F.count_if(
        F.col("biological_replicate_status") == "unsupported_multiple_sections_per_unit") > 0
    missing = F.count_if(F.col("biological_replicate_status") == "unknown_missing") > 0
    one = audited.agg(
        F.count(F.lit(1)).alias("n_samples"), F.count_distinct("genotype").alias("n_genotypes"),
        F.count_distinct("treatment").alias("n_treatments"), F.count_distinct("condition").alias("n_conditions"),
        F.count_distinct("genotype", "treatment").alias("_cells"),
        F.min("n_samples_in_design_cell").alias("minimum_samples_per_cell"),
        F.min("n_biological_units_in_design_cell").alias("minimum_units_per_cell"),
        crosses.alias("_crosses"), several.alias("_several"), missing.alias("_missing"),
        (F.count_if(F.col("technical_batch_status") != "provided") > 0).alias("_no_batch"))
    full = (F.col("n_genotypes") == 2) & (F.col("n_treatments") == 2) & (F.col("_cells") == 4)
    few = F.col("minimum_units_per_cell") < min_units
    ok = full & ~few & ~F.col("_crosses") & ~F.col("_several") & ~F.col("_missing")
    limits = F.array_compact(F.array(
        F.when(~full, F.lit("design_is_not_a_complete_two_by_two_factorial")),
        F.when(few, F.lit("insufficient_independent_biological_units_in_at_least_one_design_cell")),
        F.when(F.col("_missing"), F.lit("biological_replicate_identity_not_fully_documented")),
        F.when(F.col("_crosses"), F.lit("biological_unit_spans_multiple_design_cells")),
        F.when(F.col("_several"), F.lit("multiple_sections_per_biological_unit_unsupported")),
        F.when(F.col("_no_batch"), F.lit("technical_batch_not_fully_documented"))))
    return one.select(
        "n_samples", "n_genotypes", "n_treatments", "n_conditions", "minimum_samples_per_cell",
        "minimum_units_per_cell", full.alias("complete_two_by_two_factorial"),
        ok.alias("condition_level_inference_supported"),
        F.when(ok, "inferential_condition_comparison").otherwise(
            "exploratory_effect_size_and_direction_only").alias("allowed_current_claim"),
        F.array_join(limits, ";").alias("limitations"))


def condition_mode(samples: DataFrame, unit: str = "animal_id", min_units: int = 3) -> DataFrame:
    """Descriptive for one unit per cell, replicated for enough units everywhere, else an error code.

    ``samples`` carries ``design_cell``.
    """
    per = samples.groupBy("design_cell").agg(F.count_distinct(unit).alias("n"))
    one = per.agg(F.count(F.lit(1)).alias("_cells"), F.min("n").alias("_lo"), F.max("n").alias("_hi"))
    full = F.col("_cells") == len(DESIGN_CELLS)
    return one.select(
        F.when(full & (F.col("_hi") == 1), "descriptive").when(full & (F.col("_lo") >= min_units), "replicated")
        .otherwise("DESIGN_NOT_ELIGIBLE").alias("condition_mode"),
        F.col("_lo").alias("minimum_units"), F.col("_hi").alias("maximum_units"))


def resolve_condition_mode(samples: DataFrame, mode: str = "auto", requested: bool = True, min_samples: int = 3,
                           levels: tuple | None = None) -> str:
    """The mode an analysis runs in.

    An explicit mode is taken as it is. ``auto`` counts the samples of the four cells: one
    each is descriptive, ``min_samples`` or more each is replicated. Anything else, and a
    sheet without the columns or levels, raises DESIGN_NOT_ELIGIBLE where the condition
    analysis is requested, and is descriptive where it is not.
    """
    if mode in ("descriptive", "replicated"):
        return mode
    if mode != "auto":
        raise ContractError("CONDITION_MODE_UNKNOWN", mode)
    known = {"genotype", "treatment"} <= set(samples.columns) and bool(levels) and all(str(x or "").strip() for x in levels)
    if not known:
        if requested:
            raise ContractError("DESIGN_NOT_ELIGIBLE", "genotype and treatment columns and their levels are needed")
        return "descriptive"
    g0, g1, t0, t1 = map(str, levels)
    counts = list(samples.agg(*[F.count_if((F.col("genotype") == g) & (F.col("treatment") == t)).alias(f"{g}|{t}")
                                for g in (g0, g1) for t in (t0, t1)]).first())
    if counts == [1, 1, 1, 1]:
        return "descriptive"
    if min(counts) >= min_samples:
        return "replicated"
    if requested:
        raise ContractError("DESIGN_NOT_ELIGIBLE", f"samples per cell: {counts}")
    return "descriptive"


def check_biological_units(samples: DataFrame, unit: str = "animal_id", batch: str | None = None,
                           min_units: int = 3) -> DataFrame:
    """Gate of the replicated fit; returns samples with ``biological_unit_id`` and ``model_batch``."""
    if unit not in samples.columns or (batch and batch not in samples.columns):
        raise ContractError("DESIGN_NOT_ELIGIBLE", f"{unit} or {batch} is absent")
    out = samples.withColumn("biological_unit_id", F.trim(unit)).withColumn(
        "model_batch", F.trim(batch) if batch else F.lit(""))
    enforce(out.filter("coalesce(biological_unit_id, '') = ''").select("sample_id"), "DESIGN_NOT_ELIGIBLE",
            "unit identity missing")
    enforce(functional_dependency(out, ["biological_unit_id"], ["design_cell"]), "DESIGN_NOT_ELIGIBLE",
            "unit spans cells")
    enforce(duplicate_keys(out.select("biological_unit_id"), ["biological_unit_id"]), "DESIGN_NOT_ELIGIBLE",
            "several sections per unit")
    if batch:
        enforce(out.filter("coalesce(model_batch, '') = ''").select("sample_id"), "DESIGN_NOT_ELIGIBLE",
                "batch missing")
    per = out.groupBy("design_cell").agg(F.count_distinct("biological_unit_id").alias("n"))
    cells = literal_table(samples.sparkSession, [(c,) for c in DESIGN_CELLS], "design_cell string")
    enforce(cells.join(per, "design_cell", "left").filter(F.coalesce("n", F.lit(0)) < min_units),
            "INSUFFICIENT_BIOLOGICAL_REPLICATION")
    return out


def design_rows(units: DataFrame) -> DataFrame:
    """Model columns of every unit: intercept, factors, interaction, batch dummies.

    Batch levels after the first become dummies; the level list is as short as
    the sample sheet.
    """
    levels = [r[0] for r in units.select("model_batch").distinct().orderBy("model_batch").collect() if r[0]]
    g = F.col("design_cell").isin("g1_t0", "g1_t1").cast("double")
    t = F.col("design_cell").isin("g0_t1", "g1_t1").cast("double")
    cols = [F.lit(1.0).alias("Intercept"), g.alias("genotype_alternative"), t.alias("treatment_alternative"),
            (g * t).alias("genotype_by_treatment")]
    cols += [(F.col("model_batch") == b).cast("double").alias(f"batch_level_{i}")
             for i, b in enumerate(levels[1:], start=1)]
    return units.select("biological_unit_id", "sample_id", "design_cell", "model_batch", *cols)


def design_columns(rows: DataFrame) -> list[str]:
    return [c for c in rows.columns if c not in ("biological_unit_id", "sample_id", "design_cell", "model_batch")]


def design_rank(rows: DataFrame) -> DataFrame:
    """Units, columns, rank and residual degrees of freedom.

    Only the small cross-product matrix of the columns reaches the driver.
    """
    import numpy as np

    names = design_columns(rows)
    cross = rows.agg(F.count(F.lit(1)).alias("n"), *[
        F.sum(F.col(a) * F.col(b)).alias(f"{a}|{b}") for a in names for b in names]).first()
    gram = np.array([[cross[f"{a}|{b}"] or 0.0 for b in names] for a in names])
    rank = int(np.linalg.matrix_rank(gram))
    n = int(cross["n"])
    return literal_table(rows.sparkSession, [(n, len(names), rank, n - rank)],
                         "n_units long, n_design_columns long, design_rank long, residual_df long")


def coded_column(df: DataFrame, names) -> str | None:
    """First listed column that exists and has no blank."""
    have = [c for c in names if c in df.columns]
    if not have:
        return None
    blanks = df.agg(*[F.count_if(F.coalesce(F.trim(c), F.lit("")) == "").alias(c) for c in have]).first()
    return next((c for c in have if not blanks[c]), None)


def confounding_audit(spots: DataFrame) -> DataFrame:
    """Per sample: spots, condition and cell sizes, unit and batch columns, integration status."""
    from spotweave.operators.contracts import one_to_one

    meta = [c for c in ("genotype", "treatment", "condition", *REPLICATE_COLUMNS, *BATCH_COLUMNS)
            if c in spots.columns]
    n_by = spots.groupBy("sample_id", *meta).agg(F.count(F.lit(1)).alias("n_spots"))
    enforce(duplicate_keys(n_by.select("sample_id"), ["sample_id"]), "SAMPLE_METADATA_NOT_CONSTANT")
    total = n_by.agg(F.sum("n_spots")).first()[0]
    unit, batch = coded_column(n_by, REPLICATE_COLUMNS), coded_column(n_by, BATCH_COLUMNS)
    status, aliases = integration_eligibility(n_by), False
    if batch:
        # A batch of one level, or of one sample each, can't be told from the samples.
        aliases = bool(one_to_one(n_by, "sample_id", batch).first()[0])
        if aliases or n_by.agg(F.count_distinct(batch)).first()[0] < 2:
            status = "not_eligible"
    cond_n = n_by.groupBy("condition").agg(F.count(F.lit(1)).alias("n_samples_in_condition"))
    cell_n = n_by.groupBy("genotype", "treatment").agg(
        F.count(F.lit(1)).alias("n_samples_in_genotype_treatment_cell"))
    confounded = one_to_one(n_by, "condition", "sample_id").first()[0]
    single = cond_n.agg(F.max("n_samples_in_condition")).first()[0] == 1
    empty = F.lit("")
    return n_by.join(cond_n, "condition").join(cell_n, ["genotype", "treatment"]).select(
        "sample_id", "genotype", "treatment", "condition", "n_spots",
        (F.col("n_spots") / F.lit(total)).alias("spot_fraction"),
        F.concat_ws("|", "genotype", "treatment").alias("genotype_treatment_cell"),
        "n_samples_in_genotype_treatment_cell", "n_samples_in_condition",
        F.lit(single).alias("condition_cell_n_equals_one"),
        F.lit(confounded).alias("condition_confounded_with_sample_id"),
        F.lit(unit or "").alias("biological_replicate_column"),
        (F.col(unit) if unit else empty).alias("biological_replicate_value"),
        F.lit("provided" if unit else "unknown_not_provided").alias("biological_replicate_status"),
        F.lit(batch or "").alias("technical_batch_column"),
        (F.col(batch) if batch else empty).alias("technical_batch_value"),
        F.lit("provided" if batch else "unknown_or_incomplete").alias("technical_batch_status"),
        F.lit(aliases).alias("batch_aliases_sample_id"), F.lit(False).alias("sample_id_as_batch_allowed"),
        F.lit(status).alias("integration_status"))


def integration_eligibility(samples: DataFrame) -> str:
    """Not eligible without a complete batch column. Levels and aliases are A26's matter."""
    return "not_eligible" if coded_column(samples, BATCH_COLUMNS) is None else "not_requested"
