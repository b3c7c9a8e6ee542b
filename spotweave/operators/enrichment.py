"""Preranked gene-set enrichment: ranking, running-sum scores, permutation null and FDR."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window as W, functions as F

from spotweave.functions.digests import md5_heads
from spotweave.functions.exprs import fingerprint
from spotweave.functions.ordering import row_rank, running_sum
from spotweave.functions.runtime import durable

RANKING = ["roi_label_canonical", "contrast_id"]


def set_membership(df: DataFrame, gene_sets: DataFrame, column: str) -> DataFrame:
    """Rows joined to every set that lists their gene; ``gene_sets`` has one gene per row."""
    g = gene_sets.select("library_id", "term", F.col("gene").alias(column)).distinct()
    return df.join(g, column)


def gated(effects: DataFrame, min_counts: float = 10, min_cells: int = 2) -> DataFrame:
    """Rows with the gates of a ranking: symbol present, effect known, enough counts and cells."""
    sym = F.trim("gene_symbol")
    value = F.col("effect_log2_cpm_plus1_difference")
    return effects.withColumn("gene_symbol", sym).withColumn(
        "_sym", F.coalesce(sym != "", F.lit(False))).withColumn(
        "_eff", F.coalesce(~F.isnan(value) & ~value.isin(float("inf"), float("-inf")), F.lit(False))
    ).withColumn("_cnt", F.coalesce(F.col("combined_raw_counts_four_sections") >= min_counts, F.lit(False))
                 ).withColumn("_cel", F.coalesce(F.col("n_nonzero_design_cells") >= min_cells, F.lit(False)))


def dedupe_symbols(eligible: DataFrame) -> DataFrame:
    """Best row per ranking and symbol: counts, then absolute effect, then gene id.

    ``max_by`` keeps one row per symbol map-side; no symbol group is ever sorted.
    """
    e = F.col("effect_log2_cpm_plus1_difference")
    order = F.struct((-F.col("combined_raw_counts_four_sections")).alias("a"), (-F.abs(e)).alias("b"),
                     F.col("gene_id").alias("c"), (-e).alias("d"))
    keep = F.struct("gene_id", "effect_log2_cpm_plus1_difference", "combined_raw_counts_four_sections",
                    "n_nonzero_design_cells")
    best = eligible.groupBy(*RANKING, "gene_symbol").agg(F.min_by(keep, order).alias("k"))
    return best.select(*RANKING, "gene_symbol", "k.*")


def prepare_ranking(effects: DataFrame, min_counts: float = 10, min_cells: int = 2) -> DataFrame:
    """Strict order by effect, symbol, gene id; ``rank`` breaks exact ties.

    The original effect is kept; the order itself carries the tie-break.
    """
    ok = gated(effects, min_counts, min_cells).filter("_sym and _eff and _cnt and _cel")
    best = dedupe_symbols(ok).withColumnRenamed("effect_log2_cpm_plus1_difference", "original_effect")
    return row_rank(best, RANKING, [F.col("original_effect").desc(), F.col("gene_symbol").asc(),
                                    F.col("gene_id").asc()], "rank")


def ranking_audit(effects: DataFrame, ranking: DataFrame, gene_sets: DataFrame, min_counts: float = 10,
                  min_cells: int = 2) -> DataFrame:
    """Gate failures, duplicates, ties and overlap with the sets per ranking."""
    g = gated(effects, min_counts, min_cells)
    ok = F.col("_sym") & F.col("_eff") & F.col("_cnt") & F.col("_cel")
    base = g.groupBy(*RANKING).agg(
        F.count(F.lit(1)).alias("n_input_rows"), F.count_if(~F.col("_sym")).alias("n_missing_or_blank_gene_symbol"),
        F.count_if(~F.col("_eff")).alias("n_nonfinite_effect"),
        F.count_if(~F.col("_cnt")).alias("n_fail_combined_raw_counts"),
        F.count_if(~F.col("_cel")).alias("n_fail_nonzero_design_cells"),
        F.count_if(ok).alias("n_eligible_rows_before_symbol_deduplication"))
    dup = g.filter(ok).groupBy(*RANKING, "gene_symbol").agg(F.count(F.lit(1)).alias("c")).groupBy(*RANKING).agg(
        F.count_if(F.col("c") > 1).alias("n_duplicate_symbol_groups"),
        F.sum(F.when(F.col("c") > 1, F.col("c")).otherwise(0)).alias("n_rows_in_duplicate_symbol_groups"),
        F.count(F.lit(1)).alias("n_ranked_genes"))
    tie = ranking.groupBy(*RANKING, "original_effect").agg(F.count(F.lit(1)).alias("c")).groupBy(*RANKING).agg(
        F.count_if(F.col("c") > 1).alias("n_exact_score_tie_groups"),
        F.sum(F.when(F.col("c") > 1, F.col("c")).otherwise(0)).alias("n_rows_in_exact_score_ties"))
    listed = gene_sets.select(F.col("gene").alias("gene_symbol")).distinct()
    hit = ranking.join(listed, "gene_symbol", "left_semi").groupBy(*RANKING).agg(
        F.count(F.lit(1)).alias("n_ranked_genes_in_library"))
    out = base.join(dup, RANKING, "left").join(tie, RANKING, "left").join(hit, RANKING, "left").fillna(0)
    return out.withColumn("n_duplicate_symbol_rows_removed", F.col(
        "n_eligible_rows_before_symbol_deduplication") - F.col("n_ranked_genes"))


def hits_of(ranking: DataFrame, gene_sets: DataFrame, min_size: int = 5, max_size: int = 500) -> DataFrame:
    """Set members at their rank, for sets whose overlap with the ranking is within the size gate."""
    n = ranking.groupBy(*RANKING).agg(F.count(F.lit(1)).alias("n_ranked"))
    hits = set_membership(ranking.select(*RANKING, "rank", F.col("original_effect").alias("score"), "gene_symbol"),
                          gene_sets, "gene_symbol")
    by = [*RANKING, "library_id", "term"]
    size = hits.groupBy(*by).agg(F.count(F.lit(1)).alias("set_size")).filter(
        F.col("set_size").between(min_size, max_size))
    return hits.join(size, by).join(n, RANKING)


def enrichment_score(hits: DataFrame, by: list[str]) -> DataFrame:
    """Running-sum score from the hits alone.

    Between hits the sum only falls, so its extremes sit just at or just before a
    hit; at most ``max_size`` rows per set are ordered, never the whole ranking.
    """
    w = W.partitionBy(*by).orderBy("rank")
    upto = w.rowsBetween(W.unboundedPreceding, 0)
    full = W.partitionBy(*by)
    h = hits.withColumn("_w", F.abs("score")).withColumn("_cum", F.sum("_w").over(upto)).withColumn(
        "_tot", F.sum("_w").over(full)).withColumn("_i", F.row_number().over(w))
    miss = (F.col("rank") - F.col("_i")) / F.nullif((F.col("n_ranked") - F.col("set_size")).cast("double"), F.lit(0.0))
    # A set of zero weights counts every hit alike.
    at = F.when(F.col("_tot") > 0, F.col("_cum") / F.col("_tot")).otherwise(F.col("_i") / F.col("set_size"))
    before = F.when(F.col("_tot") > 0, (F.col("_cum") - F.col("_w")) / F.col("_tot")).otherwise(
        (F.col("_i") - 1) / F.col("set_size"))
    miss = F.coalesce(miss, F.lit(0.0))
    # Rounding makes mirrored extremes tie the same way everywhere; the positive one wins.
    h = h.withColumn("_hi", F.round(at - miss, 12)).withColumn("_lo", F.round(before - miss, 12))
    t = h.groupBy(*by).agg(
        F.max("_hi").alias("_max"), F.min("_lo").alias("_min"),
        F.max_by("rank", F.struct("_hi", (-F.col("rank")).alias("r"))).alias("_peak"),
        F.min_by("rank", F.struct("_lo", (-F.col("rank")).alias("r"))).alias("_dip"),
        F.first("n_ranked").alias("n_ranked"), F.first("set_size").alias("set_size"))
    up = F.col("_max") >= -F.col("_min")
    return t.select(*by, "n_ranked", "set_size", F.when(up, F.col("_max")).otherwise(F.col("_min")).alias("es"),
                    F.when(up, F.col("_peak")).otherwise(F.col("_dip")).alias("edge_rank"))


def leading_edge(hits: DataFrame, scores: DataFrame, by: list[str]) -> DataFrame:
    """Members up to the peak (or from the dip on), in rank order; tag and gene counts."""
    j = hits.join(scores.select(*by, "es", "edge_rank"), by)
    inside = F.when(F.col("es") >= 0, F.col("rank") <= F.col("edge_rank")).otherwise(
        F.col("rank") >= F.col("edge_rank"))
    led = F.collect_list(F.when(inside, F.struct("rank", "gene_symbol")))
    span = F.when(F.first("es") >= 0, F.first("edge_rank")).otherwise(
        F.first("n_ranked") - F.first("edge_rank") + 1)
    return j.groupBy(*by).agg(
        F.count_if(inside).alias("n_leading_edge"), span.alias("n_genes_to_edge"),
        F.array_join(F.transform(F.array_sort(led), lambda s: s["gene_symbol"]), ";").alias("leading_edge_genes"))


def null_scores(hits: DataFrame, ranking: DataFrame, permutations: int, seed: int, max_size: int = 500) -> DataFrame:
    """Scores of random sets, one per ranking, set size and permutation, shared by all terms of that size.

    A permutation sorts the ranking's places by md5(seed:ranking:permutation:rank); a random
    set of m members is the first m of them.
    """
    sizes = durable(hits.select(*RANKING, "set_size", "n_ranked").distinct().withColumn("size_key", F.col("set_size")))
    largest = sizes.groupBy(*RANKING).agg(F.least(F.max("set_size"), F.lit(max_size)).alias("_need"), F.max("n_ranked").alias("_of"))
    at = first_places(ranking, largest, permutations, seed).join(sizes, RANKING).filter(F.col("_pick") <= F.col("set_size"))
    by = [*RANKING, "size_key", "perm"]
    return enrichment_score(at, by).select(*by, F.col("es").alias("null_es"))


# Places below the bound beyond those needed, in standard deviations: a permutation that falls short is ordered whole.
SPARE = 8.0
# Places hashed at once, for all permutations.
KEY_COLUMNS = 1024


def first_places(ranking: DataFrame, largest: DataFrame, permutations: int, seed: int, spare: float = SPARE) -> DataFrame:
    """The first ``_need`` of ``_of`` places of every permutation of a ranking, in the order of their md5 keys.

    Keys are evenly spread, so only places whose key lies below a bound that leaves a few
    more than needed are sorted; the others are dropped where they are made. Permutations with
    too few places below their bound are counted and ordered whole, so the result is exact.
    """
    spark = ranking.sparkSession
    room = F.col("_need") + F.lit(spare) * F.sqrt("_need") + F.lit(spare * spare)
    share = F.least(room / F.col("_of"), F.lit(1.0))
    # Leading 32 bits that a key must stay below; 2^32 keeps every place.
    goal = durable(largest.withColumn("_bound", F.floor(share * F.lit(float(1 << 32))).cast("long")))
    # Each place is hashed for every permutation: work, not bytes, so the rows are dealt to all cores.
    tasks = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    p = ranking.select(*RANKING, "rank", F.col("original_effect").alias("score")).join(F.broadcast(goal), RANKING)
    key = F.md5(F.concat_ws(":", F.lit(seed), *RANKING, "perm", "rank"))

    def below(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from places_below(batch, permutations, seed)

    # Rows of a ranking side by side, so that a batch is few tables of keys.
    drawn = p.repartition(tasks).sortWithinPartitions(*RANKING, "rank").mapInArrow(below, p.drop("_of", "_bound").withColumn("perm", F.lit(1)).schema).withColumn("_key", key)
    group = [*RANKING, "perm"]
    w = W.partitionBy(*group).orderBy("_key", "rank")

    def picked(rows: DataFrame) -> DataFrame:
        return rows.select(*group, "rank", "score", "_need", "_key").withColumn("_pick", F.row_number().over(w)).filter("_pick <= _need")

    found = durable(picked(drawn).drop("_key"))
    every = goal.withColumn("perm", F.explode(F.sequence(F.lit(1), F.lit(permutations))))
    have = found.groupBy(*group).agg(F.count(F.lit(1)).alias("_have"))
    short = durable(every.join(have, group, "left").filter(F.coalesce("_have", F.lit(0)) < F.least("_need", "_of")).select(*group))
    if short.isEmpty():
        return found
    whole = picked(p.join(short, RANKING).withColumn("_key", key)).drop("_key")
    return found.join(short, group, "left_anti").unionByName(whole)


def places_below(batch: pa.RecordBatch, permutations: int, seed: int) -> Iterator[pa.RecordBatch]:
    """The rows of ``batch`` under every permutation whose key begins below the row's ``_bound``, with ``perm``.

    A key is md5 of seed, ranking, permutation and rank; it is made for all permutations and
    ranks of equally many digits at once.
    """
    names = [c for c in batch.schema.names if c not in ("_of", "_bound")]
    kinds = pa.schema([batch.schema.field(c) for c in names] + [pa.field("perm", pa.int32(), False)])
    table = pa.table(batch).append_column("_digits", pc.utf8_length(pc.cast(batch.column("rank"), pa.string())))
    turns = [[p for p in range(1, permutations + 1) if len(str(p)) == n] for n in range(1, len(str(permutations)) + 1)]
    for kind in table.group_by([*RANKING, "_digits"]).aggregate([("_bound", "min")]).to_pylist():
        own = pc.equal(table["_digits"], kind["_digits"])
        for c in RANKING:
            own = pc.and_(own, pc.equal(table[c], kind[c]) if kind[c] is not None else pc.is_null(table[c]))
        whole = table.filter(own)
        head = ":".join([str(seed), *[kind[c] for c in RANKING if kind[c] is not None]])
        for part, group in ((whole.slice(at, KEY_COLUMNS), g) for at in range(0, len(whole), KEY_COLUMNS) for g in turns):
            last = [str(r).encode() for r in part["rank"].to_pylist()]
            heads = md5_heads([f"{head}:{p}:".encode() for p in group], last)
            perm, row = np.nonzero(heads < np.uint64(kind["_bound_min"]))
            got = part.select(names).take(pa.array(row)).append_column("perm", pa.array(np.array(group, np.int32)[perm]))
            yield from got.cast(kinds).to_batches()


def _share_at_least(observed: DataFrame, pool: DataFrame, by: list[str], out: str) -> DataFrame:
    """Per observed value the number of pool values at least as large, by one running count; pool rows stand for ``n`` values.

    Observed rows sort after pool rows of the same value, so ties count.
    """
    rows = pool.groupBy(*by, "v").agg(F.sum("n").alias("n")).select(
        *by, "v", F.lit(0).alias("_obs"), F.lit("").alias("_id"), "n").unionByName(
        observed.select(*by, "v", F.lit(1).alias("_obs"), F.col("_id"), F.lit(0).cast("long").alias("n")))
    order = [F.col("v").desc(), F.col("_obs").asc(), F.col("_id").asc()]
    return running_sum(rows, by, order, F.col("n"), out).filter("_obs = 1").select(*by, "_id", out)


def enrichment(ranking: DataFrame, gene_sets: DataFrame, permutations: int = 100, seed: int = 0,
               min_size: int = 5, max_size: int = 500) -> DataFrame:
    """ES, NES, nominal p, FDR, FWER and leading edge per ranking, library and term."""
    by = [*RANKING, "library_id", "term"]
    scope = [*RANKING, "library_id"]
    hits = durable(hits_of(ranking, gene_sets, min_size, max_size))
    obs = durable(enrichment_score(hits, by))
    shared = durable(null_scores(hits, ranking, permutations, seed, max_size))
    # Terms of one size share their null: it stays one array per ranking and size, and a null value weighs as many terms.
    size = [*RANKING, "size_key"]
    per = durable(shared.groupBy(*size).agg(
        F.avg(F.when(F.col("null_es") >= 0, F.col("null_es"))).alias("_pos"),
        F.avg(F.when(F.col("null_es") < 0, -F.col("null_es"))).alias("_neg"), F.collect_list("null_es").alias("_null")))
    t = obs.withColumn("size_key", F.col("set_size")).join(per, size)
    same = F.filter("_null", lambda x: (x >= 0) == (F.col("es") >= 0))
    t = t.withColumn("_n", F.size(same)).withColumn("_ge", F.size(F.filter(same, lambda x: F.abs(x) >= F.abs(F.col("es")))))
    scale = F.when(F.col("es") >= 0, F.col("_pos")).otherwise(F.col("_neg"))
    t = durable(t.withColumn("nes", F.col("es") / F.nullif(scale, F.lit(0.0))).withColumn(
        "nominal_permutation_p_value", F.when(F.col("_n") > 0, F.col("_ge") / F.col("_n"))).drop("_null", "size_key"))
    terms = obs.groupBy(*scope, F.col("set_size").alias("size_key")).agg(F.count(F.lit(1)).alias("n"))
    nn = shared.join(per.drop("_null"), size).join(terms, size).withColumn(
        "_sign", F.when(F.col("null_es") >= 0, 1).otherwise(-1)).withColumn(
        "null_nes", F.col("null_es") / F.nullif(F.when(F.col("null_es") >= 0, F.col("_pos")).otherwise(
            F.col("_neg")), F.lit(0.0))).filter("null_nes is not null")
    key = [*scope, "_sign"]
    nn = durable(nn.select(*key, "perm", F.abs("null_nes").alias("v"), "n"))
    tagged = t.filter("nes is not null").withColumn("_sign", F.when(F.col("es") >= 0, 1).otherwise(-1))
    o = tagged.select(*key, F.abs("nes").alias("v"), F.col("term").alias("_id"))
    one = F.lit(1).cast("long").alias("n")
    null_ge = _share_at_least(o, nn.select(*key, "v", "n"), key, "_null_ge")
    obs_ge = _share_at_least(o, o.select(*key, "v", one), key, "_obs_ge")
    n_null = nn.groupBy(*key).agg(F.sum("n").alias("_n_null"))
    n_obs = o.groupBy(*key).agg(F.count(F.lit(1)).alias("_n_obs"))
    extreme = nn.groupBy(*key, "perm").agg(F.max("v").alias("v"))
    fwer = _share_at_least(o, extreme.select(*key, "v", one), key, "_max_ge")
    tagged = tagged.withColumn("_id", F.col("term"))
    for extra in (null_ge, obs_ge, fwer):
        tagged = tagged.join(extra, [*key, "_id"], "left")
    tagged = tagged.join(n_null, key, "left").join(n_obs, key)
    fdr = (F.coalesce("_null_ge", F.lit(0)) / F.col("_n_null")) / (F.col("_obs_ge") / F.col("_n_obs"))
    out = tagged.withColumn("fdr_q_value", F.least(fdr, F.lit(1.0))).withColumn(
        "fwer_p_value", F.coalesce("_max_ge", F.lit(0)) / F.lit(float(permutations)))
    edge = leading_edge(hits, obs, by)
    return out.join(edge, by).select(
        *by, "es", "nes", "nominal_permutation_p_value", "fdr_q_value", "fwer_p_value", "set_size", "n_ranked",
        (F.col("n_leading_edge") / F.col("set_size")).alias("tag_fraction"),
        (F.col("n_genes_to_edge") / F.col("n_ranked")).alias("gene_fraction"), "leading_edge_genes",
        F.lit(permutations).alias("n_permutations"), F.lit(seed).alias("seed"),
        F.lit("pathway_ranking_permutation_only_no_condition_inference").alias("inference_status"))


def ranking_fingerprints(ranking: DataFrame) -> DataFrame:
    """Order-free content hash per ranking: exact sums of row hashes, no row is collected.

    Rows are hashed with their rank; two 31-bit halves are summed as integers.
    """
    h = F.sha2(F.concat_ws("\t", F.col("rank").cast("string"), "gene_symbol", "gene_id",
                           F.format_string("%.12f", F.col("original_effect"))), 256)
    return ranking.withColumn("_h", h).groupBy(*RANKING).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(F.conv(F.substring("_h", 1 + 7 * i, 7), 16, 10).cast("long")).alias(f"s{i}") for i in range(4)]
    ).select(*RANKING, F.sha2(F.concat_ws(":", "n", "s0", "s1", "s2", "s3"), 256).alias("ranking_sha256"))


def task_grid(rankings: DataFrame, libraries: DataFrame, completed: DataFrame, min_size: int = 5,
              max_size: int = 500, permutations: int = 100, seed: int = 0) -> DataFrame:
    """Every ranking x library task with its fingerprint and whether a finished result is reused.

    ``rankings`` carries ranking_sha256; ``libraries`` library_id and observed_sha256 (a handful);
    ``completed`` the fingerprints of finished tasks, with the ranking's and library's names where equal rankings are tasks of their own.
    """
    libs = libraries.agg(F.collect_set(F.struct("library_id", "observed_sha256")).alias("_l")).first()[0]
    listed = F.array(*[F.struct(F.lit(x["library_id"]).alias("library_id"),
                                F.lit(x["observed_sha256"]).alias("gmt_sha256")) for x in sorted(libs)])
    t = rankings.withColumn("_l", F.explode(listed)).select(*RANKING, "ranking_sha256", "_l.*")
    payload = F.struct(
        "gmt_sha256", "library_id", F.lit(max_size).alias("max_size"), F.lit(min_size).alias("min_size"),
        F.lit(permutations).alias("permutations"), "ranking_sha256", F.lit(seed).alias("seed"))
    t = t.withColumn("run_fingerprint", fingerprint(payload))
    known = [c for c in ("run_fingerprint", *RANKING, "library_id") if c in completed.columns]
    done = completed.select(*known).distinct().withColumn("_done", F.lit(True))
    return t.join(done, known, "left").withColumn(
        "execution_status", F.when(F.col("_done"), "completed_reused_checkpoint").otherwise("pending")).drop("_done")


def _stored(df: DataFrame, path: str) -> None:
    """One folder per task (fingerprint, ranking and library); those of the tasks in ``df`` are replaced, others stay."""
    task = F.sha2(F.concat_ws("\t", "run_fingerprint", *RANKING, "library_id"), 256)
    df.withColumn("task", task).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("task").parquet(path)


STATUS_SCHEMA = ("roi_label_canonical string, contrast_id string, library_id string, run_fingerprint string, task_status string, "
                 "failure_reason string, n_terms long, task string")


def finished_tasks(spark, folder: str) -> DataFrame:
    """The tasks whose results ``folder`` holds; failed ones are not finished."""
    path = f"{folder}/status"
    found = spark.read.schema(STATUS_SCHEMA).parquet(path) if _exists(spark, path) else spark.createDataFrame([], STATUS_SCHEMA)
    return found.filter("task_status <> 'failed'").select("run_fingerprint", *RANKING, "library_id")


def _exists(spark, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def run_tasks(ranking: DataFrame, gene_sets: DataFrame, grid: DataFrame, folder: str, permutations: int = 100, seed: int = 0,
              min_size: int = 5, max_size: int = 500) -> DataFrame:
    """Computes the pending tasks of a grid, stores results and status of each under its name and fingerprint, and returns the status.

    A ranking with a missing or non-finite effect or a rank that stands twice fails; its tasks
    leave a status row with the reason and no results, and do not stop the others. Finished
    tasks are neither read nor written again.
    """
    todo = durable(grid.filter("execution_status = 'pending'").select(*RANKING, "library_id", "run_fingerprint"))
    ours = ranking.join(todo.select(*RANKING).distinct(), RANKING, "left_semi")
    effect = F.col("original_effect")
    broken = ours.groupBy(*RANKING).agg(
        F.count_if(effect.isNull() | F.isnan(effect) | (F.abs(effect) == float("inf"))).alias("_odd"), F.count(F.lit(1)).alias("_n"),
        F.count_distinct("rank").alias("_ranks"))
    reason = F.when(F.col("_odd") > 0, "RANKING_NOT_FINITE").when(F.col("_ranks") < F.col("_n"), "RANKING_RANK_DUPLICATE")
    state = durable(todo.join(broken.select(*RANKING, reason.alias("failure_reason"), F.lit(True).alias("_have")), RANKING, "left").withColumn(
        "failure_reason", F.when(F.col("_have").isNull(), "RANKING_ABSENT").otherwise(F.col("failure_reason"))).drop("_have"))
    good = state.filter("failure_reason is null").drop("failure_reason")
    found = enrichment(ours.join(good.select(*RANKING).distinct(), RANKING, "left_semi"),
                       gene_sets.join(good.select("library_id").distinct(), "library_id", "left_semi"), permutations, seed, min_size, max_size)
    _stored(found.join(good, [*RANKING, "library_id"]), f"{folder}/results")
    spark, task = grid.sparkSession, ["run_fingerprint", *RANKING, "library_id"]
    kept = spark.read.parquet(f"{folder}/results").select(*task) if _any_result(spark, folder) else todo.limit(0)
    n = kept.groupBy(*task).agg(F.count(F.lit(1)).alias("n_terms"))
    status = state.join(n, task, "left").select(
        *RANKING, "library_id", "run_fingerprint",
        F.when(F.col("failure_reason").isNotNull(), "failed").when(F.col("n_terms") > 0, "completed").otherwise(
            "completed_no_eligible_results").alias("task_status"), "failure_reason",
        F.when(F.col("failure_reason").isNull(), F.coalesce("n_terms", F.lit(0).cast("long"))).alias("n_terms"))
    _stored(durable(status), f"{folder}/status")
    return spark.read.schema(STATUS_SCHEMA).parquet(f"{folder}/status").drop("task").join(grid.select(*task), task, "left_semi")


def _any_result(spark, folder: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/results")
    return any(x.isDirectory() for x in target.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(target))


def task_results(spark, folder: str) -> DataFrame:
    """The stored results of all finished tasks."""
    return spark.read.parquet(f"{folder}/results").drop("task")
