"""Substring dedup by line hashing: units are hashed, digests grouped over all documents, later occurrences removed.

A unit is a line, a paragraph, or (the default) a sentence of a line, so that a passage
pasted into another line is still found. Units are normalised, grouped by 128-bit digest,
and the occurrence of the lowest rank (doc_id, then place) stays. Removed units that stand
next to each other are one span with its original character offsets. Every span goes, however
short; ``min_words`` is an option for callers who want to leave short ones alone.

Only digests and offsets are shuffled. A digest's minimum is found with partial aggregation;
the join back has one row per repeated digest on one side, so Spark can split a very common
unit's rows over tasks.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window as W, functions as F

from spotweave.llm.common import map_batches, packed, pick, unpacked, written

MIN_WORDS = 1  # no bound; n_words lets a reader filter
SEPARATORS = {"sentence": re.compile(r"\n|(?<=[.!?])[ \t]+"), "line": re.compile(r"\n"), "paragraph": re.compile(r"\n[ \t]*\n\s*")}


def units(text: str, kind: str) -> list[tuple[int, int, str]]:
    """(start, end, normalised unit) of every unit with a word: lower case, white space runs as one space."""
    out, at = [], 0
    for m in [*SEPARATORS[kind].finditer(text), None]:
        end = m.start() if m else len(text)
        if plain := " ".join(text[at:end].lower().split()):
            out.append((at, end, plain))
        at = m.end() if m else end
    return out


def unit_rows(rows: DataFrame, kind: str) -> DataFrame:
    """(row, doc_id, tie, pos, start, end, words, h1, h2) of every unit of (row, doc_id, text)."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        where, place, start, end, words, digests = [], [], [], [], [], []
        texts = batch.column("text").to_pylist()
        ties = np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            if not text:
                continue
            ties[i] = np.uint64(xxhash.xxh3_64_intdigest(text)).astype(np.int64)
            for pos, (a, b, plain) in enumerate(units(text, kind)):
                where.append(i)
                place.append(pos)
                start.append(a)
                end.append(b)
                words.append(plain.count(" ") + 1)
                digests.append(xxhash.xxh3_128_digest(plain))
        if not where:
            return None
        h = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
        take = pa.array(where)
        ints = [pa.array(x, pa.int32()) for x in (place, start, end, words)]
        return pa.RecordBatch.from_arrays(
            [batch.column("row").take(take), batch.column("doc_id").take(take), pa.array(ties).take(take), *ints,
             pa.array(h[:, 0]), pa.array(h[:, 1])], ["row", "doc_id", "tie", "pos", "start", "end", "words", "h1", "h2"])

    return map_batches(rows, run, "row long, doc_id long, tie long, pos int, start int, end int, words int, h1 long, h2 long")


def numbered(rows: DataFrame) -> DataFrame:
    return rows.withColumn("row", F.monotonically_increasing_id())


def spans(rows: DataFrame, kind: str, min_words: int) -> DataFrame:
    """Removed spans of numbered rows: row, doc_id, start, end, n_units, n_words, kept_doc_id, kept_start."""
    held = written(unit_rows(rows, kind), "units")
    rank = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "tie", "row", "pos", "start")
    first = held.groupBy("h1", "h2").agg(F.min(rank).alias("kept"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    later = held.join(first, ["h1", "h2"]).filter((F.col("row") != F.col("kept.row")) | (F.col("pos") != F.col("kept.pos")))
    # One window group is the repeated units of one document.
    run = F.col("pos") - F.row_number().over(W.partitionBy("row").orderBy("pos"))
    later = later.select("row", "doc_id", "pos", "start", "end", "words", "kept").withColumn("run", run)
    return later.groupBy("row", "doc_id", "run").agg(
        F.min("start").cast("long").alias("start"), F.max("end").cast("long").alias("end"), F.count(F.lit(1)).alias("n_units"),
        F.sum("words").alias("n_words"), F.min_by("kept", "pos").alias("kept")).filter(F.col("n_words") >= min_words).select(
        "row", "doc_id", "start", "end", "n_units", "n_words", F.col("kept.doc_id").alias("kept_doc_id"),
        F.col("kept.start").cast("long").alias("kept_start"))


def repeats(documents: DataFrame, kind: str = "sentence", min_words: int = MIN_WORDS) -> DataFrame:
    """One row per removed span of a document row, with the place that stays of its first unit.

    Ranks: doc_id ascending, null ids last, then the text's hash, then the row, then the place
    in the text; so of repeated rows one stays whole. Null and empty texts and units without a
    word have no units. Other columns are ignored; an empty table gives no rows. Texts are
    read whole, offsets count characters.
    """
    return spans(numbered(pick(documents, doc_id="long", text="string")), kind, min_words).drop("row")


def cut(text: str | None, removed: list[tuple[int, int]]) -> str | None:
    """The text without its removed spans; what stands between units stays."""
    if text is None:
        return None
    parts, at = [], 0
    for a, b in sorted(removed):
        parts.append(text[at:a])
        at = b
    return "".join(parts) + text[at:]


def deduplicated(documents: DataFrame, kind: str = "sentence", min_words: int = MIN_WORDS) -> DataFrame:
    """The document rows with removed spans cut from ``text``; odd cases as in ``repeats``."""
    held = written(numbered(packed(documents, doc_id="long", text="string")), "units")
    gone = spans(held.select("row", "doc_id", "text"), kind, min_words).groupBy("row").agg(
        F.collect_list(F.struct("start", "end")).alias("gone"))

    def cleaned(texts: pd.Series, removed: pd.Series) -> pd.Series:
        return pd.Series([t if r is None else cut(t, [(x["start"], x["end"]) for x in r]) for t, r in zip(texts, removed)], dtype=object)

    return unpacked(held.join(gone, "row", "left"), documents, text=F.pandas_udf(cleaned, "string")("text", "gone"))
