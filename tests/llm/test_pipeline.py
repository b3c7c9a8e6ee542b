"""The pipeline against a brute-force version of its stages, and on odd inputs."""

import math

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from spotweave.llm import quality_crf, source_mixing, token_files
from tests.llm.test_decontamination import grams
from tests.llm.test_simhash_dedup import brute as near, brute_print
from tests.llm.test_token_files import brute as token_rows


def test_stages_match_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    field = quality_crf.train(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    rows = [tuple(r) for r in docs.select("doc_id", "text", "source").collect()]
    judged = quality_crf.judge([t.encode() for _, t, _ in rows], [len(t) for _, t, _ in rows], field, quality_crf.MIN_CONTENT_SHARE)
    rows = [r for r, j in zip(rows, judged) if j[6]]
    first = {d: c for d, _, c in near([(d, brute_print(t)) for d, t, _ in rows])}
    rows = [r for r in rows if first[r[0]] == r[0]]
    items = [grams(r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    rows = [r for r in rows if not any(g and len(g & grams(r[1], k)[0]) >= 0.8 * len(g) - 1e-9 for g, k in items)]
    left = spark.createDataFrame(rows, "doc_id long, text string, source string")
    taken = {r["doc_id"]: math.ceil(r["taken"] / r["size"]) for r in source_mixing.mix(left).collect() if r["taken"]}
    mixed = [(d, t) for d, t, _ in rows for _ in range(taken.get(d, 0))]
    want = [r[:4] for r in token_rows(Tokenizer.from_file(token_files.default_tokenizer()), mixed)]
    got = sorted(map(tuple, corpus_pipeline.run(spark, sf).collect()), key=lambda r: r[1])
    assert got == want and 20 < len(rows) < len(first) and 0 < len(first) < docs.count()


def test_stages_keep_the_columns_and_extra_ones(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").selectExpr("*", "1 as row", "2 as _row", "3 as TEXT", "4 as size")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns, name
        assert out.schema.simpleString() == docs.schema.simpleString(), name
        docs = corpus_pipeline.written(out.toDF(*[f"c{i}" for i in range(len(out.columns))]), "test").toDF(*docs.columns)
        assert docs.count() > 0, name


@pytest.mark.parametrize("rows", ([], [(None, None, None, None, None), (1, None, "en", None, 0), (1, "", None, "a", 0)]))
def test_odd_tables(spark, sf, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.written(stage(spark, docs, sf), "test")
    assert docs.count() == 0 and np.array_equal(docs.columns, ["doc_id", "start", "n_tokens", "ids_crc32"])
