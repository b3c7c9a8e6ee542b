"""Packing: ids equal the tokenizer's, every id once, no padding, neighbours by BM25 brute force, odd inputs."""

import collections
import math
import random
import zlib

import numpy as np
from tokenizers import Tokenizer

from spotweave.llm import lexical_packing as m, queries


def encoded(texts):
    t = Tokenizer.from_file(m.default_tokenizer())
    return [[*x.ids, 2] for x in t.encode_batch(["" if x is None else x for x in texts], add_special_tokens=False)]


def checked(rows, ids, window):
    """Every document's ids once, sequences gapless and of a power of two, whole windows but for a shard's end."""
    sequences, docs = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append(r)
        docs[r["doc_id"]].append(r)
    for members in sequences.values():
        at = 0
        for r in sorted(members, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= window and at & (at - 1) == 0
    assert set(docs) == set(ids)
    for d, members in docs.items():
        at = 0
        for r in sorted(members, key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids[d]) and r["length"] > 0
            assert r["ids_crc32"] == zlib.crc32(np.array(ids[d][at:at + r["length"]], "<u4").tobytes())
            at += r["length"]
        assert at == len(ids[d])
    return sequences


def test_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    ids = {r["doc_id"]: x for r, x in zip(docs, encoded([r["text"] for r in docs]))}
    rows = queries.QUERIES["op13_lexical_packing"](spark, sf).collect()
    sequences = checked(rows, ids, 4096)
    full = sum(sum(r["length"] for r in s) == 4096 for s in sequences.values())
    assert full >= sum(map(len, ids.values())) // 4096 - 1
    again = queries.QUERIES["op13_lexical_packing"](spark, sf).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_segments_equal_the_tokenizer():
    rng = random.Random(4)
    letters = ["a", "B", "é", "é", " ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", " ", "'s", "'LL", "7", "42", "!", "?!", "<|endoftext|>", "<|start",
               "Σ", "ΑΣ", "ß", "İ", "日本", "🙂", "́", "\x00", "-", "_", "n't", "‍", "﻿"]
    letters += ["'tis", "don't", "word,", "(Word", "\"quote\"", "straße", "Été.", "'"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(30))) for _ in range(3000)]
    encoder = m.SegmentEncoder(m.default_tokenizer(), memory=500)
    assert encoder.by_segment
    assert encoder.by_word
    got = [x.tolist() + [2] for k in range(0, 3000, 40) for x in encoder.batch([t.encode() for t in texts[k:k + 40]])]
    assert got == encoded(texts)
    assert len(encoder.known) < 1000


def test_neighbours_are_ranked_by_bm25(spark):
    rng = random.Random(8)
    topics = [[f"{a}{b}" for b in ("red", "blue", "stone", "river", "cloud", "metal")] for a in ("x", "y", "z", "q")]
    ids = []
    vocabulary = {}
    for i in range(60):
        words = [rng.choice(topics[i % 4] + ["the", "and"]) for _ in range(rng.randrange(5, 40))]
        ids.append(np.array([*(vocabulary.setdefault(w, len(vocabulary)) for w in words), 2], np.uint16))
    n, mean = len(ids), sum(map(len, ids)) / len(ids)
    df = np.zeros(len(vocabulary) + 3, np.int64)
    for x in ids:
        df[np.unique(x[:-1])] += 1
    weights = m.Weights(m.inverse_frequencies(df, n), mean)
    got = list(m.pack_shard(ids, weights, 128))

    left = {d: (0, len(x)) for d, x in enumerate(ids)}
    want = []
    for seed in range(n):
        if seed not in left:
            continue
        seq, room = [(seed, *left[seed])], 128 - left.pop(seed)[1]
        asked = set(ids[seed][:-1].tolist())

        def score(d):
            tf = collections.Counter(ids[d][:-1].tolist())
            return sum(max(0, math.log((n - df[t] + .5) / (df[t] + .5))) * tf[t] * 2.2 / (tf[t] + 1.2 * (.25 + .75 * len(ids[d]) / mean))
                       for t in sorted(asked) if tf[t])

        for d in sorted(left, key=lambda d: (-round(score(d), 9), d)):
            if not room:
                break
            at, size = left.pop(d)
            take = min(size, room)
            seq.append((d, at, take))
            room -= take
            if take < size:
                left[d] = (at + take, size - take)
        want += [seq] if not room else list(m.powers_of_two(seq))
    assert got == want
    first = [d % 4 for d, _, _ in got[0]]
    assert first.count(first[0]) == len(first)  # the first window holds one topic


def test_small_shards_long_texts_and_common_signatures(spark):
    rng = random.Random(6)
    texts = [" ".join(rng.choice(["storm", "lamp", "grün", "44", "ok!"]) for _ in range(rng.choice([0, 3, 50, 900]))) for _ in range(120)]
    texts += ["same words every time"] * 80 + ["long " * 9000]
    ids = dict(enumerate(encoded(texts)))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6)
    rows = m.pack(df, window=256, shard_tokens=3000, with_ids=True).collect()
    checked(rows, ids, 256)
    assert all(r["ids"] == ids[r["doc_id"]][r["start"]:r["start"] + r["length"]] for r in rows)
    assert len({r["sequence_id"] >> 24 for r in rows}) > 5


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "c"), (5, " \n")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as row", "2 as ids", "'x' as TEXT")
    got = m.pack(df).collect()
    assert sum(r["length"] for r in got) == 1 + 1 + 3 + 3 + 2 + 1
    assert sorted((r["doc_id"] or 0, r["doc_tokens"]) for r in got if r["start"] == 0) == [(0, 2), (1, 1), (2, 1), (3, 3), (3, 3), (5, 1)]
    assert m.pack(df.limit(0)).collect() == []
