"""Collocations against SQL and brute force, the relations, exact wide numbers, odd inputs."""

import collections
import random
import re

import duckdb
import numpy as np

from spotweave.llm import phrase_mining as m, queries


def brute(rows, least=10, longest=3, first=2000, cover=50):
    f, n = collections.Counter(), collections.Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", re.sub("[A-Z]", lambda x: x[0].lower(), text or "")):
            ws = re.findall("[^ \t]+", piece)
            n[lang] += len(ws)
            f.update((lang, tuple(ws[i:i + k])) for k in range(1, longest + 1) for i in range(len(ws) - k + 1))
    out = []
    c = {k: v for k, v in f.items() if v >= least and len(k[1]) > 1}
    outer = collections.Counter()
    for (lang, ws), a in c.items():
        for i in range(len(ws)):
            for j in range(i + 2, len(ws) + 1):
                if j - i < len(ws):
                    outer[lang, ws[i:j]] = max(outer[lang, ws[i:j]], a)
    for (lang, ws), a in c.items():
        if 100 * outer[lang, ws] >= cover * a:
            continue
        score, k = min((1000000 * a * a // (f[lang, ws[:k]] * f[lang, ws[k:]]), k) for k in range(1, len(ws)))
        out.append((lang, -score, -a, " ".join(ws).encode(), f[lang, ws[:k]], f[lang, ws[k:]]))
    ranks = collections.Counter()
    found = []
    for lang, score, a, phrase, left, right in sorted(out):
        ranks[lang] += 1
        if ranks[lang] <= first:
            found.append((lang, ranks[lang], phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(found)


def test_table_against_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf}/documents.parquet'")
    want = sorted(con.execute(queries.ORACLES["op12_phrase_mining"]).fetchall())
    assert sorted(map(tuple, queries.QUERIES["op12_phrase_mining"](spark, sf).collect())) == want and want


def test_random_words_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(m, "BLOCK_CODES", 300)
    monkeypatch.setattr(m, "GROUP_ROWS", 60)
    rng = random.Random(7)
    words = ["a", "B", "été", "dd", "e-e", "f", "Zz", "x1"]
    rows = [("".join(rng.choice(words) + rng.choice([" ", " ", "  ", "\t", ", ", ".", "\r\n", " ? "]) for _ in range(rng.randrange(60))),
             rng.choice(["en", "de", None])) for _ in range(300)]
    df = spark.createDataFrame(rows, "text string, lang string").repartition(5)
    for longest in (3, 4):
        got = m.mine(df, least=4, longest=longest, first=50)
        assert sorted(map(tuple, got.collect())) == brute(rows, 4, longest, 50)


def test_a_full_bitmap_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(m, "BITMAP_BITS", 6)
    rng = random.Random(2)
    rows = [(" ".join(rng.choice("abcdefghijklmnop") for _ in range(40)), "en") for _ in range(200)]
    got = m.mine(spark.createDataFrame(rows, "text string, lang string"))
    assert sorted(map(tuple, got.collect())) == brute(rows)


def test_chains_hold_frequent_neighbours_only():
    codes = np.array([0, 1, 2, 3, 0, 1, 2, 5, 6, 0])
    begins = np.array([0, 1, 0, 0, 0, 1, 0, 1, 0, 0], bool)
    assert m.chains(codes, begins, 2).tolist() == [1, 2, 0, 1, 2, 0, 5, 6, 0]
    of, members, counts = m.grouped(codes, 6, 2, np.array([False] + [True] * 6))
    assert sorted(zip(members[0].tolist(), members[1].tolist(), counts.tolist())) == [(1, 2, 2), (2, 3, 1), (2, 5, 1), (5, 6, 1)]
    assert of[1] == of[5] and of[0] == of[3] == of[8] == -1


def test_products_beyond_64_bits(spark):
    big = 3_000_000_000_000
    df = spark.createDataFrame([(big, big + 7, big + 11)], "a long, l long, r long")
    assert df.select(m._cut_score(df.a, df.l, df.r)).first()[0] == 1_000_000 * big * big // ((big + 7) * (big + 11))


def test_odd_rows(spark):
    rows = [(None, "en"), ("", "en"), ("New York new york. NEW\tYORK", None), ("new york " * 20, None), ("new york " * 20, None), (".,;:!?", "de"),
            ("one two three " * 5_000, "en"), ("X" * 100_000 + " y", "en")]
    df = spark.createDataFrame(rows, "text string, lang string").selectExpr("*", "1 as h0", "2 as n", "'q' as LANG2", "3 as rank")
    got = sorted(map(tuple, m.mine(df).collect()))
    assert got == brute(rows) and got
    assert m.mine(df.limit(0)).collect() == [] and m.mine(df.filter("text = ''")).collect() == []


def test_relations_are_written_in_row_groups_of_few_blocks(spark, monkeypatch):
    import pyarrow.parquet as pq

    monkeypatch.setattr(m, "BLOCK_CODES", 2000)
    monkeypatch.setattr(m, "ROW_GROUP_BYTES", 1 << 16)
    rows = [(" ".join(f"w{i}x{j}" for j in range(1000)), "en") for i in range(90)]
    docs = spark.createDataFrame(rows, "text string, lang string").coalesce(1)
    relation = m.relation_written(m.occurrences(docs, 0))
    files = [pq.ParquetFile(f.replace("file://", "")).metadata for f in relation.inputFiles()]
    assert sum(x.num_rows for x in files) == relation.count() > 40
    assert max(x.row_group(i).num_rows for x in files for i in range(x.num_row_groups)) <= 10
