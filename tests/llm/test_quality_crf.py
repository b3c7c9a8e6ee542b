"""Counting rules and decoding against brute force, training, held-out accuracy, odd inputs."""

import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from spotweave.llm import quality_crf as m

WORD = re.compile("[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    lines = text.split("\n")
    dup = sum(bool(WORD.findall(x)) and x in lines[:i] for i, x in enumerate(lines))
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    inside = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in (i, i + 1, i + 2)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(inside),
            len(words) < 50 or 100 * len(inside) > 50 * len(words))


def test_counts_match_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = dict(docs.select("doc_id", "text").collect())
    rows = m.assess(docs, m.prior()).collect()
    assert len(rows) == len(texts)
    for r in rows:
        if len(texts[r["doc_id"]]) < 9000:  # brute force counts each window anew
            assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == brute(texts[r["doc_id"]])
        assert not (r["base_failed"] and r["kept"]) and len(r["line_labels"]) == r["n_lines"]


def test_viterbi_is_the_best_of_all_sequences():
    rng = random.Random(2)
    for _ in range(60):
        field = m.Field(np.zeros(1), np.array([[rng.gauss(0, 1) for _ in range(2)] for _ in range(2)]), np.array([rng.gauss(0, 1), rng.gauss(0, 1)]))
        e = [rng.gauss(0, 1) for _ in range(rng.randrange(1, 8))]

        def score(y):
            return field.start[y[0]] + sum(a * b for a, b in zip(e, y)) + sum(field.step[a, b] for a, b in zip(y, y[1:]))

        best = max(itertools.product((0, 1), repeat=len(e)), key=score)
        assert abs(score(m.viterbi(e, field)) - score(best)) < 1e-9
    assert m.viterbi([], m.prior()) == []


def test_gradient_fits_and_nothing_gives_the_prior():
    good, bad = m.buckets(m.line_values([b"Some words in a plain sentence, as one reads."] * 5)), m.buckets(m.line_values([b"X | Y | Z ##"] * 5))
    field = m.fit([(good, 1), (bad, 0)] * 10)
    assert m.viterbi(field.emit[good].sum(axis=1).tolist(), field) == [1] * 5
    assert m.viterbi(field.emit[bad].sum(axis=1).tolist(), field) == [0] * 5
    assert (m.fit([]).emit == m.prior().emit).all()


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    train = labels.filter(F.col("doc_id") % 2 == 0)
    got = m.assess(docs, m.train(docs, train)).join(labels.filter(F.col("doc_id") % 2 == 1), "doc_id").filter("n_words >= 50").collect()
    clean, junk = [r["kept"] for r in got if r["quality"] == 1], [r["kept"] for r in got if r["quality"] == 0]
    assert len(clean) > 50 and sum(clean) / len(clean) > 0.97 and sum(junk) / len(junk) < 0.1


def test_odd_rows(spark):
    long = "a plain sentence of words goes on here. " * 3000
    rows = [(1, None), (2, ""), (None, " \n \n"), (4, "x\nx\n"), (4, "x\nx\n"), (5, long)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as kept", "2 as TEXT")
    got = sorted(((r["doc_id"] or 0, r["n_words"], r["n_dup_lines"], r["kept"]) for r in m.assess(df, m.prior()).collect()))
    assert got == [(0, 0, 0, False), (1, 0, 0, False), (2, 0, 0, False), (4, 2, 1, False), (4, 2, 1, False), (5, 24000, 0, False)]
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert m.assess(df.limit(0), m.train(df, none)).collect() == []
    odd = spark.createDataFrame([(None, 1), (5, None), (5, 1), (5, 1)], "doc_id long, quality int")
    out = m.retained(df, odd)
    assert out.columns == df.columns and out.count() == 0
