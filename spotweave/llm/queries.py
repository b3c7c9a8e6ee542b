"""The registered queries of the operators and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from spotweave.llm.common import table
from spotweave.llm.license_scan import scan_licenses
from spotweave.llm import (
    decontamination, hard_negatives, lexical_packing, masked_lm, phrase_mining, quality_crf, role_repair, run_dedup, source_mixing,
    token_files, unit_dedup)
from spotweave.llm.simhash_dedup import as_hex, near_duplicates

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


@query("op1_quality_rules")
def _(spark, d):
    docs = table(spark, d, "documents")
    return quality_crf.assess(docs, quality_crf.train(docs, table(spark, d, "labels"))).drop("line_labels")


@query("op2_simhash_near_dedup")
def _(spark, d):
    found = near_duplicates(table(spark, d, "documents"))
    return found.select("doc_id", as_hex(found["fp"]).alias("fingerprint"), "component_id")


@query("op3_license_scans")
def _(spark, d):
    return scan_licenses(table(spark, d, "documents"))


@query("op4_lm_scoring")
def _(spark, d):
    docs = table(spark, d, "documents")
    return masked_lm.score(docs, masked_lm.train(docs))


@query("op5_source_mixing", source_mixing.SQL.format(documents="documents"))
def _(spark, d):
    return source_mixing.mix(table(spark, d, "documents"))


@query("op6_token_id_output")
def _(spark, d):
    return token_files.encoded(table(spark, d, "documents"))


@query("op7_chat_formatting")
def _(spark, d):
    return role_repair.summary(role_repair.repair(table(spark, d, "conversations")))


@query("op8_substring_dedup")
def _(spark, d):
    return unit_dedup.repeats(table(spark, d, "documents"))


@query("op9_benchmark_decontamination", decontamination.SQL)
def _(spark, d):
    return decontamination.contained_items(table(spark, d, "documents"), table(spark, d, "benchmark"))


@query("op10_line_dedup", run_dedup.SQL)
def _(spark, d):
    return run_dedup.repeated_runs(table(spark, d, "documents"))


@query("op11_hard_negatives", hard_negatives.SQL)
def _(spark, d):
    return hard_negatives.mine(table(spark, d, "embeddings"), label=hard_negatives.shifted_labels())


@query("op12_phrase_mining", phrase_mining.SQL)
def _(spark, d):
    return phrase_mining.mine(table(spark, d, "documents"))


@query("op13_lexical_packing")
def _(spark, d):
    return lexical_packing.pack(table(spark, d, "documents"))
