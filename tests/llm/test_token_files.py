"""Token files: exact round trip against the tokenizer, random access, dictionary guard, odd inputs."""

import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from spotweave.llm import token_files as m


@pytest.fixture(scope="module")
def model():
    return Tokenizer.from_file(m.default_tokenizer())


def brute(model, rows):
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = model.encode(text or "", add_special_tokens=False).ids + [0]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        start += len(ids)
    return out


def test_round_trip_and_random_access(spark, sf, model, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    want = brute(model, [tuple(r) for r in docs.select("doc_id", "text").collect()])
    folder = m.write_ids(docs.repartition(5), str(tmp_path / "ids"))
    got = sorted(map(tuple, m.read_ids(spark, folder).collect()), key=lambda r: r[1])
    assert got == want
    for r in (want[0], want[77], want[-1]):
        assert m.read_document(spark, folder, r[0]) == [r[4]]
    assert m.read_document(spark, folder, 10**9) == []


def test_small_shards_and_wide_ids(spark, sf, model, tmp_path, monkeypatch):
    monkeypatch.setattr(m, "SHARD_DOCS", 3)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    folder = m.write_ids(docs, str(tmp_path / "ids"), width=4)
    got = sorted(map(tuple, m.read_ids(spark, folder).collect()), key=lambda r: r[1])
    assert got == brute(model, [tuple(r) for r in docs.select("doc_id", "text").collect()])


def test_another_dictionary_is_refused(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"word{i} more text") for i in range(50)], "doc_id long, text string")
    a, b = m.write_ids(docs, str(tmp_path / "a")), m.write_ids(docs.limit(9), str(tmp_path / "b"))
    data, digest = m.open_dictionary(spark, b)
    row = spark.read.parquet(f"{a}/shards").first().asDict()
    with pytest.raises(ValueError, match="ANOTHER_DICTIONARY"):
        m._decoder(data, digest)(row, 0)


def test_long_texts_are_cut_where_no_token_joins(model):
    text = "Hello wörld  it's\n\n fine \n x y,z " * 40 + "abc" * 100
    assert "".join(m.pieces(text, 50)) == text and len(m.pieces(text, 50)) > 10
    ids = [i for p in m.pieces(text, 50) for i in model.encode(p, add_special_tokens=False).ids]
    assert ids == model.encode(text, add_special_tokens=False).ids


@given(st.lists(st.text(alphabet=" \n\t\u00a0\u3000ab'sé1.!<|endoftext|>\x1f", max_size=25), max_size=6))
@settings(max_examples=300, deadline=None)
def test_words_from_memory_give_the_ids_of_the_whole_text(texts):
    e = m.encoder(m.default_tokenizer())
    assert e.by_word
    texts = [*texts, "plain words and more words", "x", "", " lead", "tail ", "<|endoftext|> a <|endoftext|>"]
    want = [np.array(e.model.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert e.encode(texts) == want


def test_the_memory_is_bounded(monkeypatch, model):
    monkeypatch.setattr(m, "MEMORY_WORDS", 50)
    monkeypatch.setattr(m, "MEMORY_SEGMENTS", 40)
    monkeypatch.setattr(m, "_ENCODE_BYTES", 30)
    e = m.Encoder(m.default_tokenizer())
    for i in range(20):
        text = " ".join(f"word{i} other{j}" for j in range(30))
        assert e.encode([text])[0] == np.array(model.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    assert len(e.words) <= 50 and len(e.known) <= 40


def test_odd_rows(spark, model, tmp_path):
    rows = [(1, None), (2, ""), (None, "n"), (4, "same"), (4, "same"), (4, "other"), (5, "long <|endoftext|> " * 30_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as TEXT", "2 as ids")
    got = sorted(map(tuple, m.read_ids(spark, m.write_ids(df, str(tmp_path / "x"))).collect()), key=lambda r: r[1])
    assert got == brute(model, rows)
    assert m.read_ids(spark, m.write_ids(df.limit(0), str(tmp_path / "y"))).collect() == []
