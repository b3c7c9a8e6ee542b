"""SimHash near-dedup against all pairs on a small table; tiles, trees and odd inputs."""

import random

import numpy as np
import pytest
import xxhash

from spotweave.llm.simhash_dedup import BKTree, as_hex, deduplicated, fingerprint, near_duplicates


def brute_print(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    grams = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def brute(prints, radius=3):
    rows = list(prints)
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] ^ rows[j][1]).bit_count() <= radius:
                parent[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        low[find(i)] = min(low.get(find(i), d), d)
    return sorted((d, f"{fp:016x}", low[find(i)]) for i, (d, fp) in enumerate(rows))


def collected(df):
    return sorted(map(tuple, df.select("doc_id", as_hex(df["fp"]), "component_id").collect()))


def test_table_matches_all_pairs(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    want = brute([(d, brute_print(t)) for d, t in docs.select("doc_id", "text").collect()])
    assert collected(near_duplicates(docs)) == want


@pytest.mark.parametrize("blocks", (4, 6))
def test_hot_shards_in_tiles_match_all_pairs(spark, monkeypatch, blocks):
    import spotweave.llm.simhash_dedup as m
    rng = random.Random(5)
    centre = [rng.getrandbits(64) for _ in range(3)]
    prints = []
    for i in range(400):
        x = centre[i % 3]
        for _ in range(rng.randrange(9)):
            x ^= 1 << rng.randrange(64)
        prints.append((i, x if i % 5 else rng.getrandbits(64)))
    signed = [(d, int(np.array([x], np.uint64).view(np.int64)[0])) for d, x in prints]
    df = spark.createDataFrame(signed, "doc_id long, fp long")
    monkeypatch.setattr(m, "fingerprints", lambda _: df)
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert collected(m.near_duplicates(docs, blocks=blocks, tile_rows=30)) == brute(prints)


def test_tree_finds_all_within_the_radius_and_visits_fewer():
    rng = np.random.default_rng(3)
    points = np.unique(np.concatenate([rng.integers(0, 1 << 63, 300).astype(np.uint64),
                                       np.uint64(1) << rng.integers(0, 63, 40).astype(np.uint64)]))
    tree = BKTree(points.tolist())
    got = {(n, int(q)) for n, near in tree.search(points, 3) for q in near}
    want = {(i, j) for i in range(len(points)) for j in range(len(points)) if (int(points[i]) ^ int(points[j])).bit_count() <= 3}
    assert got == want


def test_long_text_in_pieces(monkeypatch):
    import spotweave.llm.simhash_dedup as m
    monkeypatch.setattr(m, "_CHUNK", 7)
    text = " ".join(f"w{i % 23}X" for i in range(200))
    assert fingerprint(text.encode()) == brute_print(text)
    for t in ("", " ", "One", "one TWO", "one two three", "É two three four"):
        assert fingerprint(t.encode()) == brute_print(t)


def test_odd_rows(spark):
    df = spark.createDataFrame([(7, None, 1), (3, "", 1), (9, "a b c d", 1), (9, "a b c d", 1), (None, "A b C d", 1), (None, "zz", 1)],
                               "doc_id long, text string, fp int").selectExpr("*", "1 as TEXT")
    got = sorted(((r["doc_id"] or -1), r["component_id"]) for r in near_duplicates(df).collect() if r["component_id"] is not None)
    assert got == [(-1, 9), (3, 3), (7, 3), (9, 9), (9, 9)]
    assert near_duplicates(df.limit(0)).collect() == []
    left = deduplicated(df)
    assert left.columns == df.columns and sorted(str(r[0]) for r in left.collect()) == ["3", "9", "None"]
    assert deduplicated(df.limit(0)).collect() == []
