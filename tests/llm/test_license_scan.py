"""License scans against brute force, suppression by hand, odd inputs."""

import re

from spotweave.llm import license_rules
from spotweave.llm.license_scan import detect, required_words, scan_licenses, scan_text, suppress

TOKEN = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(text):
    words = TOKEN.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    places = [(label, i) for phrase, label in license_rules.BASE for i in range(len(words))
              if words[i:i + len(phrase.split())] == phrase.split()]
    return (len(words), len(places), min((i for _, i in places), default=None), max((i for _, i in places), default=None),
            ",".join(sorted({x for x, _ in places})))


def test_base_columns_match_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = dict(docs.select("doc_id", "text").collect())
    got = scan_licenses(docs).collect()
    assert len(got) == len(texts)
    for r in got:
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == brute(texts[r["doc_id"]])
        assert set(r["base_labels"].split(",")) <= set(r["labels"].split(",")) | {""} and 0 <= r["score"] <= 1


def test_hundreds_of_rules_each_gated_by_words_its_matches_hold():
    rules = license_rules.rules()
    assert len(rules) > 300 and len(set(rules)) == len(rules)
    for label, _, pattern in rules:
        assert required_words(pattern), pattern
    assert required_words("share ?alike (?:version |v)?2(?: 0)? x") == {b"x"}
    assert required_words("apache (?:software )?license 2(?: 0)?") == {b"apache", b"license", b"2"}


def test_prefilter_loses_nothing():
    text = b"licensed under the apache license version 2 0 and gnu general public license v3 mit license cc by sa 4 0"
    found = {(i, a, b) for i, a, b in detect(text, text.split(b" "))}
    rules = license_rules.rules()
    want = set()
    padded = b" " + text + b" "
    for i, (_, _, p) in enumerate(rules):
        for m in re.finditer(b"(?<= )(?:" + p.encode() + b")(?= )", padded):
            a = padded.count(b" ", 0, m.start()) - 1
            want.add((i, a, a + m.group().count(b" ") + 1))
    assert found == want and found


def test_containment_suppression():
    got = scan_text(b"Licensed under the Apache License, Version 2.0")
    kinds = [(d["label"], d["kind"]) for d in got["detections"]]
    assert kinds == [("apache-2.0", "grant"), ("apache", "base")]
    many = suppress([(i, a, b) for i, a, b in detect(b"mit license " * 500 + b"x", (b"mit license " * 500 + b"x").split())])
    assert scan_text(b"mit license " * 500)["n_base"] == 500 and len(many) == 1000


def test_odd_rows(spark):
    rows = [(1, None, "x"), (2, "", "x"), (None, "MIT License", "x"), (4, "MIT License", "x"), (4, "MIT License", "x"),
            (5, "é" * 200_000 + " CC-BY", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, labels string").selectExpr("*", "1 as TEXT", "2 as n_words")
    got = sorted(((r["doc_id"] or 0, r["n_words"], r["labels"], r["first_word"]) for r in scan_licenses(df).collect()))
    assert got == [(0, 2, "mit", 0), (1, 0, "", None), (2, 0, "", None), (4, 2, "mit", 0), (4, 2, "mit", 0), (5, 3, "cc-by", 1)]
    assert scan_licenses(df.limit(0)).collect() == []
