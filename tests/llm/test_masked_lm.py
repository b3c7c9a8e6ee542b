"""Masked pseudo-likelihood: gradients, scores by hand, held-out preference for real order, odd inputs."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from spotweave.llm import masked_lm as m


@pytest.fixture(scope="module")
def trained(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    return m.train(docs.filter("doc_id % 10 <> 0"), every=2)


def small():
    words = m.Vocabulary(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.arange(16) % m.CLASSES, np.zeros(16), np.zeros(m.CLASSES), 16)
    return words, m.Net(words.pad, words.weights)


def test_gradients_match_differences():
    _, net = small()
    rng = np.random.default_rng(0)
    net = m.Net(16, np.zeros(m.CLASSES), net.flat)
    context, kinds = rng.integers(0, 17, (40, 4)), rng.integers(0, 16, 40)
    _, ((rows, g), gh, go, gb) = net.gradients(context, kinds)
    for w, at, value in ((net.table, (rows[3], 5), g[3, 5]), (net.hidden, (7,), gh[7]), (net.out, (4, 9), go[4, 9]), (net.bias, (2,), gb[2])):
        keep, e = w[at], 1e-2
        w[at] = keep + e
        up = net.gradients(context, kinds)[0]
        w[at] = keep - e
        down = net.gradients(context, kinds)[0]
        w[at] = keep
        assert abs((up - down) / (2 * e) - value) < 2e-4


def test_scores_by_hand(trained):
    text = b"The quick, brown the of THE fox"
    v, net = trained.words, m.Net(trained.words.pad, trained.words.weights, trained.flat)
    ids = v.lookup(m.word_hashes(text)).tolist()
    line = [v.pad] * 2 + ids + [v.pad] * 2
    want = 0.0
    for i, x in enumerate(ids):
        near = [line[i], line[i + 1], line[i + 3], line[i + 4]]
        z = net.hidden + sum(net.table[n + k * (v.pad + 1)] for k, n in enumerate(near))
        s = np.tanh(z) @ net.out + net.bias
        want += float(s[v.kinds[x]]) - math.log(np.exp(s.astype(float)).sum()) + v.shares[x]
    n, got = m.text_scores(trained, [b"", text, b"other words"])
    assert n == [0, 7, 2] and got[0] == 0 and abs(got[1] - want) < 1e-3


def test_probabilities_sum_to_one(trained):
    v = trained.words
    per_class = np.bincount(v.kinds, np.exp(v.shares), m.CLASSES)
    assert np.allclose(per_class[np.unique(v.kinds)], 1)


def test_real_order_beats_shuffled_order_on_held_out_texts(spark, trained):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").filter("doc_id % 10 = 0 and n_chars > 1500").collect()
    rng = random.Random(0)
    true = [r["text"].encode() for r in docs]
    mixed = []
    for t in true:
        w = m.alnum(t).split(b" ")
        rng.shuffle(w)
        mixed.append(b" ".join(w))
    a, b = m.text_scores(trained, true)[1], m.text_scores(trained, mixed)[1]
    assert len(a) > 20 and sum(x > y for x, y in zip(a, b)) / len(a) > 0.8
    start = m.Model(trained.words, m.Net(trained.words.pad, trained.words.weights).flat)
    assert sum(a) > sum(m.text_scores(start, true)[1])


def test_partitions_do_not_change_the_model(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    a, b = m.train(docs.repartition(3), rounds=1), m.train(docs.repartition(7), rounds=1)
    assert (a.words.hashes == b.words.hashes).all() and np.allclose(a.flat, b.flat, atol=1e-5)


def test_averaging_in_a_tree(spark, monkeypatch):
    monkeypatch.setattr(m, "FAN_IN", 3)
    rng = np.random.default_rng(2)
    nets = [(s, float(s % 4 + 1), rng.normal(size=200)) for s in range(20)]
    rows = [(s, k, n, bytearray((c * n).tobytes())) for s, n, w in nets for k, c in enumerate(np.array_split(w, m.SLOTS))]
    df = spark.createDataFrame(rows, "shard long, slot int, n double, w binary")
    want = sum(n * w for _, n, w in nets) / sum(n for _, n, _ in nets)
    assert np.allclose(m.averaged(df, 20), want)


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (None, "a b c"), (4, "a b c"), (4, "a b c"), (5, "q " * 60_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as n_words", "2 as TEXT")
    got = m.score(df, m.train(df)).collect()
    by = {r["doc_id"]: (r["n_words"], r["mean_log_likelihood"]) for r in got}
    assert len(got) == 6 and by[1] == (0, None) and by[2] == (0, None) and by[5][0] == 60_000 and by[4] == by[None] and by[4][1] < 0
    assert m.score(df.limit(0), m.train(df.limit(0))).collect() == []


def test_every_place_is_trained_on(spark):
    rows = [(i, " ".join(f"w{j % 7}" for j in range(i))) for i in range(1, 41)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    words, total = m.build_vocabulary(m.count_words(docs))
    parts = m.train_shards(m.masked_windows(docs, words, 3, m.EVERY), words, m.Net(words.pad, words.weights), 0.1, m.EVERY)
    assert total == 820 and parts.filter("slot = 0").agg(F.sum("n")).first()[0] == 820


def test_default_model_beats_shuffled_order_on_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = m.train(docs.filter("doc_id % 10 <> 0"))
    rng = random.Random(0)
    true = [r["text"].encode() for r in docs.filter("doc_id % 10 = 0 and n_chars > 1500").collect()]
    mixed = [b" ".join(rng.sample(w, len(w))) for w in (m.alnum(t).split(b" ") for t in true)]
    a, b = m.text_scores(model, true)[1], m.text_scores(model, mixed)[1]
    assert len(a) > 20 and sum(x > y for x, y in zip(a, b)) / len(a) > 0.8


def test_words_outside_the_vocabulary_have_their_own_share(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice(["the", "of", f"w{min(rng.randrange(60), rng.randrange(60))}"]) for _ in range(30))) for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = m.train(docs, size=2)
    v = model.words
    n = {r["h"]: r["n"] for r in model.counts.collect()}
    texts = [(1, rows[0][1]), (1, rows[0][1]), (2, "never1 seen1 here1 the"), (None, "w0 w0 w59 of")]
    got = sorted(((r["doc_id"] or 0, r["log_likelihood"]) for r in m.score(spark.createDataFrame(texts, "doc_id long, text string").repartition(3), model).collect()))
    want = []
    for doc_id, t in texts:
        h = m.word_hashes(t.encode())
        ids = v.lookup(h)
        rare = [(int(a), int(b)) for a, b in zip(h.view(np.int64), ids) if b >= len(v.hashes)]
        own = sum(math.log(n.get(a, 1)) - math.log(v.masses[b - len(v.hashes)]) for a, b in rare)
        want.append((doc_id or 0, m.text_scores(model, [t.encode()])[1][0] + own))
    assert all(a[0] == b[0] and abs(a[1] - b[1]) < 2e-3 for a, b in zip(got, sorted(want), strict=True))
    per_bucket = np.ones(v.buckets)
    for h, k in n.items():
        b = int(v.lookup(np.array([h]).view(np.uint64))[0]) - len(v.hashes)
        if b >= 0:
            per_bucket[b] += k
    assert np.allclose(per_bucket, v.masses)  # the shares of a bucket's words and of the unknown sum to one


def test_unseen_strings_score_below_prose(spark, trained):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").filter("doc_id % 10 = 0 and n_chars > 1500").select("doc_id", "text")
    junk = spark.createDataFrame([(-1, " ".join(f"zq{i}x{i * 7919 % 1009}" for i in range(400)))], "doc_id long, text string")
    got = {r["doc_id"]: r["mean_log_likelihood"] for r in m.score(docs.unionByName(junk), trained).collect()}
    low = got.pop(-1)
    assert sum(x > low for x in got.values()) / len(got) > 0.9


def test_a_task_shuffles_one_network(spark):
    rows = [(i, " ".join(f"w{j % 7}" for j in range(i))) for i in range(1, 81)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    words, total = m.build_vocabulary(m.count_words(docs))
    windows = m.masked_windows(docs, words, 40, m.EVERY).coalesce(1).cache()
    net = m.Net(words.pad, words.weights)
    parts = m.train_shards(windows, words, net, 0.1, m.EVERY).withColumn("task", F.spark_partition_id()).collect()
    assert sum(r["n"] for r in parts if r["slot"] == 0) == total
    assert len(parts) == m.SLOTS * len({r["task"] for r in parts}) < m.SLOTS * windows.select("shard").distinct().count()
