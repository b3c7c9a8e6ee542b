"""Ranks, running sums and exact quantiles that survive one very large group.

Rows are range-partitioned along the order, so a group of any size is spread over many
tasks; results are local ones plus one offset per partition and group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from spotweave.functions.runtime import durable, numbered_partitions


def running_sum(df: DataFrame, by: list[str], order: Sequence[Column], value: Column, out: str) -> DataFrame:
    """Add the running sum of ``value`` within ``by`` along a total ``order``."""
    keys = [F.col(c) for c in by] + list(order)
    tagged = numbered_partitions(df.withColumn("_rs_value", value).repartitionByRange(*keys), "_rs_part")
    # One row per (partition, group): at most partitions + groups rows.
    totals = tagged.groupBy("_rs_part", *by).agg(F.sum("_rs_value").alias("_rs_total"))
    before = W.partitionBy(*by).orderBy("_rs_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.withColumn(
        "_rs_offset", F.coalesce(F.sum("_rs_total").over(before), F.lit(0))
    ).drop("_rs_total")
    local = W.partitionBy("_rs_part", *by).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    return (
        tagged.withColumn("_rs_local", F.sum("_rs_value").over(local))
        .join(offsets, ["_rs_part", *by])
        .withColumn(out, F.col("_rs_local") + F.col("_rs_offset"))
        .drop("_rs_part", "_rs_value", "_rs_local", "_rs_offset")
    )


def row_rank(df: DataFrame, by: list[str], order: Sequence[Column], out: str) -> DataFrame:
    """``row_number`` along a total order (1-based long)."""
    return running_sum(df, by, order, F.lit(1).cast("long"), out)


def average_rank(df: DataFrame, by: list[str], value: str, out: str) -> DataFrame:
    """Ties share their mean rank. Ties are counted before any ordering."""
    counts = durable(df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(
        F.count(F.lit(1)).alias("_ar_n")))
    ranks = running_sum(counts, by, [F.col(value).asc()], F.col("_ar_n"), "_ar_cum")
    ranks = ranks.select(
        *by, value, (F.col("_ar_cum") - (F.col("_ar_n") - 1) / F.lit(2.0)).alias(out))
    return df.join(ranks, [*by, value], "left")


def value_counts(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """Rows per distinct value (NULL included), held once: a repeated value is one row."""
    return durable(df.groupBy(*by, F.col(value).alias("_q_value")).agg(F.count(F.lit(1)).alias("_q_n")))


def exact_quantiles(df: DataFrame, by: list[str], value: str, probs: dict[str, float]) -> DataFrame:
    """Linear-interpolated quantiles per group, one output column per name."""
    return quantiles_of_counts(value_counts(df, by, value), by, probs)


def quantiles_of_counts(counts: DataFrame, by: list[str], probs: dict[str, float]) -> DataFrame:
    """Quantiles from held value counts: a value shared by a third of all rows is one row here."""
    counts = counts.filter("_q_value is not null")
    key = by or ["_q_all"]
    keyed = counts if by else counts.withColumn("_q_all", F.lit(0))
    totals = keyed.groupBy(*key).agg(F.sum("_q_n").alias("_q_total"))
    cum = running_sum(keyed, key, [F.col("_q_value").asc()], F.col("_q_n"), "_q_cum")
    cum = cum.join(totals, key)
    aggs = []
    for name, p in probs.items():
        pos = (F.col("_q_total") - 1) * F.lit(float(p))
        low = F.max(F.when((F.col("_q_cum") - F.col("_q_n") <= F.floor(pos))
                           & (F.floor(pos) < F.col("_q_cum")), F.col("_q_value")))
        high = F.max(F.when((F.col("_q_cum") - F.col("_q_n") <= F.ceil(pos))
                            & (F.ceil(pos) < F.col("_q_cum")), F.col("_q_value")))
        frac = F.max(pos - F.floor(pos))
        aggs.append((low + (high - low) * frac).cast("double").alias(name))
    result = cum.groupBy(*key).agg(*aggs)
    return result if by else result.drop("_q_all")


def top_n(df: DataFrame, by: list[str], order: Sequence[Column], n: int, out: str) -> DataFrame:
    """First ``n`` rows per group; Spark keeps only n rows per group before the shuffle."""
    ranked = df.withColumn(out, F.row_number().over(W.partitionBy(*by).orderBy(*order)))
    return ranked.filter(F.col(out) <= n).withColumn(out, F.col(out).cast("long"))


def benjamini_hochberg(df: DataFrame, by: list[str], p: str, key: list[str], q: str) -> DataFrame:
    """Step-up q-values per group; NULL p stays NULL and does not count.

    Sorted by descending p, q is the running minimum of p * n / rank. Equal p
    values are counted first, so only distinct p values are ordered.
    """
    counts = value_counts(df, by, p).filter("_q_value is not null")
    ranked = running_sum(counts, by, [F.col("_q_value").asc()], F.col("_q_n"), "_bh_rank")
    totals = counts.groupBy(*by).agg(F.sum("_q_n").alias("_bh_n"))
    ranked = ranked.join(totals, by).withColumn(
        "_bh_raw", F.col("_q_value") * F.col("_bh_n") / F.col("_bh_rank"))
    ranked = _running_min(ranked, by, F.col("_q_value").desc(), "_bh_raw", q)
    ranked = ranked.withColumn(q, F.least(F.col(q), F.lit(1.0)))
    return df.join(ranked.select(*by, F.col("_q_value").alias(p), q), [*by, p], "left")


def _running_min(df: DataFrame, by: list[str], order: Column, value: str, out: str) -> DataFrame:
    keys = [F.col(c) for c in by] + [order]
    tagged = numbered_partitions(df.repartitionByRange(*keys), "_rm_part")
    mins = tagged.groupBy("_rm_part", *by).agg(F.min(value).alias("_rm_min"))
    before = W.partitionBy(*by).orderBy("_rm_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = mins.withColumn("_rm_before", F.min("_rm_min").over(before)).drop("_rm_min")
    local = W.partitionBy("_rm_part", *by).orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    return (
        tagged.withColumn("_rm_local", F.min(value).over(local))
        .join(offsets, ["_rm_part", *by])
        .withColumn(out, F.least("_rm_local", "_rm_before"))
        .drop("_rm_part", "_rm_local", "_rm_before")
    )


def previous_row(df: DataFrame, by: list[str], order: list[str], columns: dict[str, str]) -> DataFrame:
    """Values of the previous row of the group along ascending ``order`` columns.

    ``columns`` maps source to output names. Rows are range-partitioned; only the last
    row of every partition crosses to the next one.
    """
    names = list(columns)
    keys = [F.col(c) for c in (*by, *order)]
    tagged = numbered_partitions(df.repartitionByRange(*keys), "_pr_part")
    lasts = tagged.groupBy("_pr_part", *by).agg(
        F.max_by(F.struct(*names), F.struct(*order)).alias("_pr_last"))
    lasts = lasts.withColumn("_pr_before", F.lag("_pr_last").over(
        W.partitionBy(*by).orderBy("_pr_part"))).drop("_pr_last")
    w = W.partitionBy("_pr_part", *by).orderBy(*order)
    local = tagged.withColumn("_pr_local", F.lag(F.struct(*names)).over(w))
    out = local.join(lasts, ["_pr_part", *by]).withColumn(
        "_pr", F.coalesce("_pr_local", "_pr_before"))
    return out.select(*df.columns, *[F.col("_pr")[c].alias(columns[c]) for c in names])
