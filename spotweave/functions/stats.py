"""Distribution records, correlation, variance shares and partition agreement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from spotweave.functions.ordering import average_rank, quantiles_of_counts, value_counts

QUARTILES = {"q25": 0.25, "median": 0.5, "q75": 0.75}


def distribution(df: DataFrame, by: list[str], value: str,
                 probs: dict[str, float] | None = None) -> DataFrame:
    """N, n_missing, min, quantiles, mean, max, zeros of one column per group.

    Everything comes from one held table of value counts, so the input is read once.
    """
    probs = QUARTILES if probs is None else probs
    counts = value_counts(df, by, value)
    x, n = F.col("_q_value").cast("double"), F.col("_q_n")
    known = F.sum(F.when(x.isNotNull(), n).otherwise(0))
    zeros = F.sum(F.when(x == 0, n).otherwise(0))
    basic = counts.groupBy(*by).agg(
        known.alias("n"), F.sum(F.when(x.isNull(), n).otherwise(0)).alias("n_missing"),
        F.min(x).alias("min"), (F.sum(x * n) / F.nullif(known, F.lit(0))).alias("mean"), F.max(x).alias("max"),
        zeros.alias("n_zero"), (zeros / F.nullif(known, F.lit(0))).alias("zero_fraction"))
    return basic.join(quantiles_of_counts(counts, by, probs), by, "left")


def stacked(df: DataFrame, by: list[str], metrics: list[str]) -> DataFrame:
    """Several numeric columns as (by, metric, value) rows, for one pass over all of them."""
    items = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics])
    return df.select(*by, F.explode(items).alias("_m")).select(*by, "_m.metric", "_m.value")


def correlation(x: Column, y: Column) -> Column:
    """Pearson r, NULL when either side is constant, clipped to [-1, 1]."""
    n = F.count(F.lit(1)).cast("double")
    sx, sy = F.stddev_pop(x), F.stddev_pop(y)
    varied = (F.max(x) > F.min(x)) & (F.max(y) > F.min(y)) & (n >= 3)
    r = F.try_divide(F.covar_pop(x, y), sx * sy)
    return F.when(varied, F.greatest(F.least(r, F.lit(1.0)), F.lit(-1.0)))


def spearman(df: DataFrame, by: list[str], x: str, y: str, out: str) -> DataFrame:
    """Correlation of average ranks over rows where both sides are present."""
    both = df.select(*by, x, y).filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    ranked = average_rank(average_rank(both, by, x, "_rx"), by, y, "_ry")
    return ranked.groupBy(*by).agg(correlation(F.col("_rx"), F.col("_ry")).alias(out))


def eta_squared(df: DataFrame, by: list[str], level: str, value: str) -> DataFrame:
    """Between-level share of the total sum of squares.

    One pass of per-level moments; shifted by the level means so that the total
    is within plus between.
    """
    known = df.filter(F.col(level).isNotNull())
    levels = known.groupBy(*by, level).agg(
        F.count(value).alias("_n"), F.avg(value).alias("_m"),
        (F.var_pop(value) * F.count(value)).alias("_w"))
    total = levels.groupBy(*by).agg(
        F.sum("_n").alias("n_spots_complete"),
        (F.sum(F.col("_n") * F.col("_m")) / F.sum("_n")).alias("_g"),
        F.sum("_w").alias("_within"), F.count(F.lit(1)).alias("n_categories"))
    between = levels.join(total, by).groupBy(*by).agg(
        F.sum(F.col("_n") * F.pow(F.col("_m") - F.col("_g"), F.lit(2))).alias("_between"))
    joined = total.join(between, by)
    ss = F.col("_within") + F.col("_between")
    evaluable = (F.col("n_spots_complete") >= 3) & (F.col("n_categories") >= 2) & (ss > 0)
    reason = (
        F.when(F.col("n_spots_complete") < 3, "fewer_than_three_complete_spots")
        .when(F.col("n_categories") < 2, "fewer_than_two_categories")
        .when(ss <= 0, "constant_pc").otherwise("")
    )
    return joined.select(
        *by, "n_categories", "n_spots_complete",
        F.when(evaluable, F.least(F.col("_between") / ss, F.lit(1.0))).alias("eta_squared"),
        F.when(evaluable, "computed").otherwise("not_evaluable").alias("status"),
        reason.alias("reason"))


def agreement(df: DataFrame, by: list[str], a: str, b: str, minimum: int = 1) -> DataFrame:
    """Adjusted Rand index and arithmetic-mean NMI from the contingency table.

    The rows are counted once per label pair; the margins come from that small
    table, so the cost does not depend on how many rows share one label.
    """
    pairs = df.filter(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(*by, a, b).agg(
        F.count(F.lit(1)).alias("_c"))

    def choose2(c):
        return c * (c - 1) / 2

    rows = pairs.groupBy(*by, a).agg(F.sum("_c").alias("_ca"))
    cols = pairs.groupBy(*by, b).agg(F.sum("_c").alias("_cb"))

    def entropy_term(c):
        return F.sum(c * F.log(c.cast("double")))

    rs = rows.groupBy(*by).agg(
        F.sum("_ca").alias("n"), F.count(F.lit(1)).alias("n_labels_a"),
        F.sum(choose2(F.col("_ca"))).alias("_sa"), entropy_term(F.col("_ca")).alias("_ea"))
    cs = cols.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_labels_b"),
        F.sum(choose2(F.col("_cb"))).alias("_sb"), entropy_term(F.col("_cb")).alias("_eb"))
    ps = pairs.groupBy(*by).agg(
        F.sum(choose2(F.col("_c"))).alias("_sp"), entropy_term(F.col("_c")).alias("_ep"))
    if by:
        j = rs.join(cs, by).join(ps, by)
    else:
        key = F.lit(0)
        j = (rs.withColumn("_k", key).join(cs.withColumn("_k", key), "_k")
             .join(ps.withColumn("_k", key), "_k").drop("_k"))
    n = F.col("n").cast("double")
    expected = F.col("_sa") * F.col("_sb") / choose2(n)
    top, bottom = F.col("_sp") - expected, (F.col("_sa") + F.col("_sb")) / 2 - expected
    ari = F.when(n < 2, 1.0).when((F.col("_sp") == F.col("_sa")) & (F.col("_sp") == F.col("_sb")),
                                  1.0).otherwise(top / F.nullif(bottom, F.lit(0.0)))
    # Entropies in nats: H = ln n - sum c ln c / n; MI = H(a) + H(b) - H(a, b).
    ha, hb = F.log(n) - F.col("_ea") / n, F.log(n) - F.col("_eb") / n
    hab = F.log(n) - F.col("_ep") / n
    single = (F.col("n_labels_a") == 1) & (F.col("n_labels_b") == 1)
    either = (F.col("n_labels_a") == 1) | (F.col("n_labels_b") == 1)
    nmi = F.when(single, 1.0).when(either, 0.0).otherwise(
        F.greatest((ha + hb - hab) / ((ha + hb) / 2), F.lit(0.0)))
    enough = F.col("n") >= minimum
    return j.select(
        *by, F.col("n").alias("n_matched"), "n_labels_a", "n_labels_b",
        F.when(enough, ari).alias("adjusted_rand_index"),
        F.when(enough, nmi).alias("normalized_mutual_information"))
