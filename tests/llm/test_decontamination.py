"""Containment search against brute force over all pairs, blocks, and odd inputs."""

import random
import re

import pytest

from spotweave.llm import decontamination as m

TOKEN = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def grams(text, k=5):
    w = TOKEN.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    k = min(k, len(w))
    return {" ".join(w[i:i + k]) for i in range(len(w) - k + 1)} if w else set(), k


def brute(docs, items):
    out = []
    for item_id, t in items:
        g, k = grams(t)
        for doc_id, text in docs:
            hits = len(g & grams(text, k)[0]) if g and grams(text, k)[1] == k else 0
            if g and hits >= 0.8 * len(g) - 1e-9:
                out.append((doc_id, item_id, len(g), hits, hits / len(g)))
    return sorted(out, key=str)


def cases():
    rng = random.Random(1)
    vocab = [f"w{i}" for i in range(300)]
    items = [(i, " ".join(rng.choices(vocab, k=rng.choice((2, 4, 5, 6, 9, 30, 80))))) for i in range(60)]
    docs = []
    for i in range(300):
        w = rng.choices(vocab, k=rng.randrange(200))
        if i % 2:
            part = rng.choice(items)[1].split()
            for _ in range(rng.randrange(4)):
                part[rng.randrange(len(part))] = "zz"
            at = rng.randrange(len(w) + 1)
            w[at:at] = [x.upper() + ("," if rng.random() < 0.3 else "") for x in part]
        docs.append((i, " ".join(w)))
    return docs, items


@pytest.mark.parametrize("block", (5000, 7))
def test_matches_brute_force(spark, block):
    docs, items = cases()
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = brute(docs, items)
    assert sorted(map(tuple, m.contained_items(d, b, block_items=block).collect()), key=str) == want and len(want) > 40
    left = {r["doc_id"] for r in m.decontaminated(d, b, block_items=block).collect()}
    assert left == {i for i, _ in docs} - {r[0] for r in want}


def test_table_matches_brute_force(spark, sf):
    d, b = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    want = brute(d.select("doc_id", "text").collect(), b.select("item_id", "text").collect())
    assert sorted(map(tuple, m.contained_items(d, b).collect()), key=str) == want


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (None, "a b c d e f", "x"), (4, "A, b. c d e f", "x"),
                                  (4, "A, b. c d e f", "x"), (5, "p " * 100_000 + "a b c d e f", "x")],
                                 "doc_id long, text string, source string").selectExpr("*", "1 as TEXT", "2 as item_id")
    items = spark.createDataFrame([(1, "a b c d e f", 1), (1, "a b c d e f", 1), (2, None, 1), (3, " ", 1), (None, "c d", 1)],
                                  "item_id long, text string, doc_id int")
    got = sorted(((r["doc_id"], r["item_id"], r["n_hits"]) for r in m.contained_items(docs, items).collect()), key=str)
    assert got == sorted([(d, i, n) for d in (None, 4, 4, 5) for i, n in ((1, 2), (1, 2), (None, 1))], key=str)
    left = m.decontaminated(docs, items)
    assert left.columns == docs.columns and [r["doc_id"] for r in left.orderBy("doc_id").collect()] == [1, 2]
    assert m.contained_items(docs.limit(0), items).collect() == [] and m.contained_items(docs, items.limit(0)).collect() == []
