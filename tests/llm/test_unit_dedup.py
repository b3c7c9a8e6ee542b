"""Line hashing against a dictionary in rank order, planted passages, and odd inputs."""

import random
import re

import pytest

from spotweave.llm import unit_dedup as m


def brute(rows, kind, min_words):
    sep = {"sentence": r"\n|(?<=[.!?])[ \t]+", "line": "\n", "paragraph": r"\n[ \t]*\n\s*"}[kind]
    first, out = {}, []
    for doc_id, text in sorted(rows):
        run, pos = [], 0
        cuts = [x.span() for x in re.finditer(sep, text)]
        for a, b in zip([0, *[e for _, e in cuts]], [*[s for s, _ in cuts], len(text)]):
            plain = " ".join(text[a:b].lower().split())
            if not plain:
                continue
            if plain in first:
                run.append((a, b, len(plain.split()), first[plain]))
            else:
                first[plain] = (doc_id, a)
                if run:
                    out.append((doc_id, run))
                    run = []
        if run:
            out.append((doc_id, run))
    return sorted((d, r[0][0], r[-1][1], len(r), sum(x[2] for x in r), *r[0][3]) for d, r in out if sum(x[2] for x in r) >= min_words)


@pytest.mark.parametrize("kind", ("sentence", "line", "paragraph"))
def test_table_matches_brute_force(spark, sf, kind):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    want = brute([tuple(r) for r in docs.select("doc_id", "text").collect()], kind, m.MIN_WORDS)
    assert sorted(map(tuple, m.repeats(docs, kind).collect())) == want
    assert kind == "paragraph" or want


def test_planted_passage_goes_and_clean_documents_stay(spark):
    rng = random.Random(4)

    def prose(n):
        return ". ".join(" ".join(f"w{rng.randrange(10**6)}" for _ in range(9)) for _ in range(n)) + "."

    passage = prose(7)
    rows = [(i, prose(3)[:-1] + " " + passage + " " + prose(2) if i % 3 == 0 else prose(6)) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = m.repeats(df).collect()
    assert {r["doc_id"] for r in got} == {i for i in range(1, 60) if i % 3 == 0} and {r["kept_doc_id"] for r in got} == {0}
    left = dict(m.deduplicated(df).select("doc_id", "text").collect())
    inner = passage.split(". ")[3]
    assert [i for i, t in left.items() if inner in t] == [0]
    assert all(left[i] == t for i, t in rows if i % 3 or i == 0)


def test_odd_rows(spark):
    line = "one two three four five six seven eight nine"
    rows = [(1, None), (2, ""), (None, line), (4, f"{line}\n\nÄ"), (4, f"{line}\n\nÄ"), (5, line.upper() + "  \n" + line), (6, "x. " * 50_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as row", "2 as start", "3 as TEXT")
    got = sorted(((r["doc_id"] or 0, r["start"], r["end"], r["kept_doc_id"]) for r in m.repeats(df, min_words=8).collect()))
    assert got[:3] == [(0, 0, 44, 4), (4, 0, 47, 4), (5, 0, 91, 4)] and got[3][0] == 6 and len(got) == 4
    out = m.deduplicated(df, min_words=8)
    assert out.columns == df.columns
    assert sorted(str(r[1]) for r in out.filter("doc_id < 6 or doc_id is null").collect()) == sorted(["None", "", "", "", "", f"{line}\n\nÄ"])
    assert m.repeats(df.limit(0)).collect() == [] and m.deduplicated(df.limit(0)).collect() == []


def test_defaults_remove_every_repeated_unit(spark):
    line = "one two three four five six seven eight nine"
    rows = [(1, None), (2, ""), (None, line), (4, f"{line}\n\nÄ"), (4, f"{line}\n\nÄ"), (5, line.upper() + "  \n" + line), (6, "x. " * 50_000), (7, "New. Ä\nq"), (8, "Q")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r["doc_id"] or 0, r["start"], r["end"], r["n_words"], r["kept_doc_id"]) for r in m.repeats(df).collect()))
    assert got == [(0, 0, 44, 9, 4), (4, 0, 47, 10, 4), (5, 0, 91, 18, 4), (6, 3, 149_999, 49_999, 6), (7, 5, 6, 1, 4), (8, 0, 1, 1, 7)]
    left = sorted((str(r[1]) for r in m.deduplicated(df).filter("doc_id <> 6 or doc_id is null").collect()))
    assert left == sorted(["None", "", "", f"{line}\n\nÄ", "", "", "New. \nq", ""])
