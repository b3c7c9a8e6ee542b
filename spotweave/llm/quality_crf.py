"""Quality rules: a linear-chain conditional random field labels lines, Viterbi decodes them.

Each line of a document is content or boilerplate. A line shows one bucket of each feature
group; the field adds their weights and those of neighbouring labels, is trained here by
gradient ascent on a bounded sample of labelled documents, and the share of words in
content lines decides retention. Plain counting rules come first.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from spotweave.llm.common import SPACES, packed, pick, raw, small_batches, unpacked

#: The labelled sample the field is fitted on: so many documents of either label, of at most so many lines, by smallest hash of the id.
SAMPLE_DOCS, SAMPLE_LINES = 300, 120
MIN_WORDS, MAX_REPEAT_PERCENT, MIN_CONTENT_SHARE = 50, 50, 0.5
ITERATIONS, RATE, PULL = 120, 0.5, 0.02

_SYMBOLS = b"#*$%&|<>"
_UPPER, _LOWER, _DIGITS = bytes(range(65, 91)), bytes(range(97, 123)), bytes(range(48, 58))
_SIGNS = (b"http", b"www.", b"copyright", b"cookie", b"privacy policy", b"all rights reserved", b"click here", b"subscribe",
          b"log in", b"sign up", b"share this", b"read more")

#: Feature groups as (name, upper bounds of all buckets but the last), and the weight towards content each bucket starts from.
GROUPS = (
    ("words", (0, 2, 5, 15), (0.0, -0.3, 0.0, 0.2, 0.3)),
    ("symbols", (0.0, 0.02, 0.08), (0.3, 0.0, -1.0, -2.0)),
    ("capitals", (0.1, 0.3, 0.7), (0.3, 0.2, -0.3, -1.5)),
    ("digits", (0.0, 0.05, 0.2), (0.1, 0.0, -0.3, -1.0)),
    ("shouts", (0.0, 0.02), (0.1, 0.0, -1.0)),
    ("length", (2.5, 9.0, 14.0), (-0.3, 0.2, 0.0, -0.5)),
    ("repeated", (0,), (0.1, -0.5)),
    ("sentence", (0,), (-0.1, 0.2)),
    ("signs", (0,), (0.0, -0.5)),
)
_OFFSETS = np.cumsum([0, *[len(w) for _, _, w in GROUPS]])
_BOUNDS = [np.array(b, float) for _, b, _ in GROUPS]


@dataclass
class Field:
    """``emit[f]``: weight of bucket f towards content; ``step[a, b]``: of label b after label a; ``start[b]``."""

    emit: np.ndarray
    step: np.ndarray
    start: np.ndarray


def prior() -> Field:
    return Field(np.concatenate([w for _, _, w in GROUPS]).astype(float), np.array([[0.5, 0.0], [0.0, 0.5]]), np.zeros(2))


def line_values(lines: list[bytes]) -> list[tuple]:
    """The raw value of each feature group of each line."""
    seen: set[bytes] = set()
    out = []
    for line in lines:
        words = len(line.split())
        solid = line.translate(None, SPACES)
        n = len(solid) or 1
        upper, lower = len(solid) - len(solid.translate(None, _UPPER)), len(solid) - len(solid.translate(None, _LOWER))
        low = line.lower()
        out.append((words, (len(solid) - len(solid.translate(None, _SYMBOLS))) / n, upper / max(1, upper + lower),
                    (len(solid) - len(solid.translate(None, _DIGITS))) / n, solid.count(b"!") / n, len(solid) / max(1, words),
                    words > 0 and line in seen, solid[-1:] in (b".", b"!", b"?"), any(s in low for s in _SIGNS)))
        seen.add(line)
    return out


def buckets(values: list[tuple]) -> np.ndarray:
    """(lines, groups): the index of each line's bucket of each group among all buckets."""
    if not values:
        return np.zeros((0, len(GROUPS)), np.int64)
    x = np.array(values, float)
    return np.stack([np.searchsorted(b, x[:, g], side="left") + _OFFSETS[g] for g, b in enumerate(_BOUNDS)], axis=1)


def viterbi(content: list[float], field: Field) -> list[int]:
    """The best label sequence for the lines' weights towards content; a tie goes to content."""
    (s00, s01), (s10, s11) = field.step.tolist()
    v0, v1 = field.start.tolist()
    back: list[tuple[int, int]] = []
    for i, e in enumerate(content):
        if i:
            a, b = v0 + s00, v1 + s10
            c, d = v0 + s01, v1 + s11
            back.append((int(b >= a), int(d >= c)))
            v0, v1 = max(a, b), max(c, d)
        v1 += e
    label = int(v1 >= v0)
    out = [label] if content else []
    for pair in reversed(back):
        label = pair[label]
        out.append(label)
    return out[::-1]


def fit(docs: list[tuple[np.ndarray, int]], iterations: int = ITERATIONS) -> Field:
    """Maximum a posteriori weights, pulled towards ``prior``; forward-backward over all sequences at once.

    The label of a document stands for the label of its lines. Without documents it is the prior.
    """
    field, base = prior(), prior()
    docs = [d for d in docs if len(d[0])]
    if not docs:
        return field
    n, most = len(docs), max(len(x) for x, _ in docs)
    at = np.zeros((n, most, len(GROUPS)), np.int64)
    there = np.zeros((n, most), bool)
    for i, (x, _) in enumerate(docs):
        at[i, :len(x)], there[i, :len(x)] = x, True
    y = np.array([label for _, label in docs])
    size = there.sum()
    total = [np.full(p.shape, 1e-8) for p in (field.emit, field.step, field.start)]

    def squash(a: np.ndarray, axis: int) -> np.ndarray:
        top = a.max(axis=axis, keepdims=True)
        return (top + np.log(np.exp(a - top).sum(axis=axis, keepdims=True))).squeeze(axis)

    for _ in range(iterations):
        e = np.zeros((n, most, 2))
        e[:, :, 1] = field.emit[at].sum(axis=2)
        forward = np.empty((n, most, 2))
        forward[:, 0] = field.start + e[:, 0]
        for t in range(1, most):
            go = squash(forward[:, t - 1, :, None] + field.step, 1) + e[:, t]
            forward[:, t] = np.where(there[:, t, None], go, forward[:, t - 1])
        backward = np.zeros((n, most, 2))
        for t in range(most - 2, -1, -1):
            go = squash(field.step + (e[:, t + 1] + backward[:, t + 1])[:, None, :], 2)
            backward[:, t] = np.where(there[:, t + 1, None], go, 0.0)
        norm = squash(forward[:, -1], 1)
        p = np.exp(forward + backward - norm[:, None, None]) * there[:, :, None]
        pair = np.exp(forward[:, :-1, :, None] + field.step + (e[:, 1:] + backward[:, 1:])[:, :, None, :]
                      - norm[:, None, None, None]) * there[:, 1:, None, None]
        diff = (y[:, None] - p[:, :, 1]) * there
        g_emit = np.bincount(at.reshape(-1), np.repeat(diff.reshape(-1), len(GROUPS)), len(field.emit))
        g_step = -pair.sum(axis=(0, 1))
        follows = there[:, 1:].sum(axis=1)
        g_step[0, 0] += follows[y == 0].sum()
        g_step[1, 1] += follows[y == 1].sum()
        g_start = np.array([(y == 0).sum(), (y == 1).sum()]) - p[:, 0].sum(axis=0)
        for k, (w, b, g) in enumerate(((field.emit, base.emit, g_emit), (field.step, base.step, g_step), (field.start, base.start, g_start))):
            g = g / size - PULL * (w - b)
            total[k] += g * g
            w += RATE * g / np.sqrt(total[k])
    return field


def labelled_lines(documents: DataFrame, labels: DataFrame, sample_docs: int, sample_lines: int) -> list[tuple[np.ndarray, int]]:
    """Line buckets and label of the bounded sample; ids and lines of its documents only reach the driver."""
    known = pick(labels, doc_id="long", quality="int").filter("quality in (0, 1) and doc_id is not null").groupBy("doc_id").agg(
        F.max("quality").alias("quality"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    ids = known.filter("quality = 0").orderBy(*order).limit(sample_docs).unionByName(
        known.filter("quality = 1").orderBy(*order).limit(sample_docs))
    docs = pick(documents, doc_id="long", text="string").join(F.broadcast(ids), "doc_id")  # 2 * sample_docs ids at most
    small_batches(documents.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text, label in zip(batch.column("doc_id").to_pylist(), raw(batch, "text"), batch.column("quality").to_pylist()):
                lines = text.split(b"\n")
                if len(lines) <= sample_lines:
                    rows.append((doc_id, label, buckets(line_values(lines)).astype(np.int16).tobytes()))
            if rows:
                d, q, x = zip(*rows)
                yield pa.RecordBatch.from_arrays([pa.array(d, pa.int64()), pa.array(q, pa.int32()), pa.array(x, pa.binary())],
                                                 ["doc_id", "quality", "lines"])

    # An id may stand in the table any number of times; one row each is kept.
    found = docs.mapInArrow(run, "doc_id long, quality int, lines binary").groupBy("doc_id").agg(
        F.min(F.struct("lines", "quality")).alias("m")).collect()
    return [(np.frombuffer(bytes(r["m"]["lines"]), np.int16).reshape(-1, len(GROUPS)).astype(np.int64), r["m"]["quality"])
            for r in sorted(found, key=lambda r: r["doc_id"])]


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a 3-word window found twice or more."""
    if len(words) < 4:
        return 0
    windows = list(zip(words, words[1:], words[2:]))
    counts = Counter(windows)
    if len(counts) == len(windows):
        return 0
    covered, end = 0, 0
    for i, w in enumerate(windows):
        if counts[w] > 1:
            covered += i + 3 - max(i, end)
            end = i + 3
    return covered


def judge(texts: list[bytes], chars: list[int], field: Field, min_share: float) -> list[tuple]:
    """Per text: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, n_lines, content_lines, share, labels."""
    per_doc = [t.split(b"\n") for t in texts]
    values = [v for lines in per_doc for v in line_values(lines)]
    weights = field.emit[buckets(values)].sum(axis=1).tolist() if values else []
    out, at = [], 0
    for text, n_chars, lines in zip(texts, chars, per_doc):
        own = values[at:at + len(lines)]
        labels = viterbi(weights[at:at + len(lines)], field)
        at += len(lines)
        words = text.split()
        n_repeat = repeated_words(words)
        content = sum(v[0] for v, y in zip(own, labels) if y)
        share = content / len(words) if words else 0.0
        failed = len(words) < MIN_WORDS or 100 * n_repeat > MAX_REPEAT_PERCENT * len(words)
        out.append((len(words), n_chars - (len(text) - len(text.translate(None, SPACES))),
                    len(text) - len(text.translate(None, _SYMBOLS)), sum(v[6] for v in own), n_repeat, failed,
                    not failed and share >= min_share, len(lines), sum(labels), share, "".join(map(str, labels))))
    return out


SCHEMA = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, "
          "n_lines long, n_content_lines long, content_share double, line_labels string")
_TYPES = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.int64()] * 2 + [pa.float64(), pa.string()]
_NAMES = [c.split()[0] for c in SCHEMA.split(", ")]


def assess(documents: DataFrame, field: Field, min_share: float = MIN_CONTENT_SHARE) -> DataFrame:
    """One row per document row: the counts, the line labels (1 content, 0 boilerplate) and the verdict.

    A null text is empty: one line, no word, failed. Lines split at \\n, an empty one is a line.
    Repeated rows and null ids are judged as any; other columns are ignored; an empty table
    gives no rows. Texts are read whole.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                rows = judge(raw(batch, "text"), [n or 0 for n in batch.column("chars").to_pylist()], field, min_share)
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), _TYPES)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", *_NAMES])

    docs = pick(documents, doc_id="long", text="string").withColumn("chars", F.length("text").cast("long"))
    small_batches(documents.sparkSession)
    return docs.mapInArrow(run, "doc_id long, " + SCHEMA)


def train(documents: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_lines: int = SAMPLE_LINES) -> Field:
    return fit(labelled_lines(documents, labels, sample_docs, sample_lines))


def retained(documents: DataFrame, labels: DataFrame, min_share: float = MIN_CONTENT_SHARE) -> DataFrame:
    """The document rows that pass the counting rules and the field, all columns kept."""
    field = train(documents, labels)

    def keep(texts: pd.Series) -> pd.Series:
        raws = [(t or "").encode() for t in texts]
        return pd.Series([r[6] for r in judge(raws, [0] * len(raws), field, min_share)], dtype=bool)

    small_batches(documents.sparkSession)
    return unpacked(packed(documents, text="string").filter(F.pandas_udf(keep, "boolean")("text")), documents)
