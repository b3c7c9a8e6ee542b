"""Documents to token files: quality rules, near-dedup, decontamination, mixing, token ids."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from spotweave.functions.runtime import own_checkpoint_dir
from spotweave.llm import decontamination, quality_crf, simhash_dedup, source_mixing, token_files
from spotweave.llm.common import recorded, removed, table, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that pass the counting rules and whose content lines hold half of their words."""
    return quality_crf.retained(docs, table(spark, sf_dir, "labels"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the smallest doc_id of each component of linked fingerprints."""
    return simhash_dedup.deduplicated(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents in which no benchmark item is contained."""
    return decontamination.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Document rows of the mix: each as often as its source's target takes it."""
    return source_mixing.mixed_documents(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes the token files and returns doc_id, start, n_tokens and ids_crc32 as read back from them."""
    return token_files.encoded(docs)


_left: list[str] = []  # shared folders of the stage before


def _stage(function: Callable, first: bool = False, last: bool = False) -> Callable:
    """A stage that removes the working tables of the one before, whose result is written when this one begins."""
    @functools.wraps(function)
    def started(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        own_checkpoint_dir(spark)
        if first:
            _left.clear()  # of a pipeline that was not finished: not ours to remove
        removed(spark, _left)
        with recorded([] if last else _left):
            return function(spark, docs, sf_dir)

    return started


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", _stage(quality_rules, first=True)),
    ("simhash_near_dedup", _stage(simhash_near_dedup)),
    ("benchmark_decontamination", _stage(benchmark_decontamination)),
    ("source_mixing", _stage(mixing)),
    ("token_id_output", _stage(token_ids, last=True)),
]

#: The trained field, XXH64 and the tokenizer have no SQL; tests/llm compares with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written and read again."""
    own_checkpoint_dir(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
