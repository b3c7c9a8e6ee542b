"""License scans: ordered signature rules, a keyword prefilter, priority and containment suppression.

One pass over the texts, no shuffle. A document is first reduced to words; only rules all
of whose required words stand in it run their regex. Detections are intervals of words;
of two that overlap by containment the one of better priority stays.
"""

from __future__ import annotations

import bisect
import functools
import itertools
import re

import pyarrow as pa
from pyspark.sql import DataFrame

from spotweave.llm import license_rules
from spotweave.llm.common import alnum, map_batches, pick, raw

SCHEMA = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
          "score double, detections array<struct<label: string, kind: string, first_word: long, end_word: long>>")


def required_words(pattern: str) -> frozenset[bytes]:
    """Literal words that every match of a pattern holds: those outside any group, class or repeat."""
    def reduced(m: re.Match) -> str:
        # An optional group goes; where it may join the next word to itself, that word isn't literal.
        parts = m.group(1).split("|")
        return "" if m.group(2) and (all(p.endswith(" ") for p in parts) or all(p.startswith(" ") for p in parts)) else "\x00"

    flat = pattern.replace(" ?", "\x00")
    while (less := re.sub(r"\((?:\?:)?([^()]*)\)(\?)?", reduced, flat)) != flat:
        flat = less
    return frozenset(w.encode() for w in flat.split(" ") if re.fullmatch(r"[a-z0-9]+", w))


@functools.cache
def compiled() -> tuple[list[tuple], dict[bytes, list[int]]]:
    """Rules as (label, kind, priority, confidence, words, regex), and the rules by their rarest-looking required word.

    A rule without a required word would have to run on every document; there is none, and one is an error.
    """
    out, by_word = [], {}
    for i, (label, kind, pattern) in enumerate(license_rules.rules()):
        words = required_words(pattern)
        if not words:
            raise ValueError(f"RULE_WITHOUT_KEYWORD: {pattern}")
        priority, confidence = license_rules.KINDS[kind]
        out.append((label, kind, priority, confidence, words, re.compile(b"(?<= )(?:" + pattern.encode() + b")(?= )")))
        by_word.setdefault(max(words, key=lambda w: (len(w), w)), []).append(i)
    return out, by_word


def detect(joined: bytes, words: list[bytes]) -> list[tuple[int, int, int]]:
    """(rule, first word, end word) of every match of every gated rule."""
    rules, by_word = compiled()
    present = by_word.keys() & words if len(words) < len(by_word) else by_word.keys() & set(words)
    if not present:
        return []
    gate = set(words)
    text = b" " + joined + b" "
    found = []
    for i in sorted(i for w in present for i in by_word[w]):
        if rules[i][4] <= gate:
            first, at = -1, 0
            for m in rules[i][5].finditer(text):
                first, at = first + text.count(b" ", at, m.start()), m.start()
                found.append((i, first, first + m.group().count(b" ") + 1))
    return found


def suppress(found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Priority classes in order; a detection inside an accepted one of its own or a better class goes.

    Base detections neither suppress nor are suppressed: all their places count.
    """
    rules, _ = compiled()
    kept = [x for x in found if rules[x[0]][1] == "base"]
    better: list[tuple[int, int, int]] = []
    rest = sorted((x for x in found if rules[x[0]][1] != "base"), key=lambda x: (rules[x[0]][2], x[1], -x[2], x[0]))
    for _, same in itertools.groupby(rest, key=lambda x: rules[x[0]][2]):
        better.sort(key=lambda x: x[1])
        starts, reach, end = [x[1] for x in better], list(itertools.accumulate((x[2] for x in better), max)), -1
        for x in same:
            k = bisect.bisect_right(starts, x[1])
            if x[2] > end and not (k and reach[k - 1] >= x[2]):
                better.append(x)
                end = x[2]
    return sorted(kept + better, key=lambda x: (x[1], x[2], x[0]))


def scan_text(text: bytes) -> dict:
    rules, _ = compiled()
    joined = alnum(text)
    words = joined.split(b" ") if joined else []
    found = suppress(detect(joined, words)) if words else []
    base = [(rules[i][0], a) for i, a, _ in found if rules[i][1] == "base"]
    miss = 1.0
    for label, confidence in {(rules[i][0], rules[i][3]) for i, _, _ in found}:
        miss *= 1.0 - confidence
    return {"n_words": len(words), "n_base": len(base), "first_word": min((a for _, a in base), default=None),
            "last_word": max((a for _, a in base), default=None), "base_labels": ",".join(sorted({x for x, _ in base})),
            "labels": ",".join(sorted({rules[i][0] for i, _, _ in found})), "score": round(1.0 - miss, 6),
            "detections": [{"label": rules[i][0], "kind": rules[i][1], "first_word": a, "end_word": b} for i, a, b in found]}


def scan_licenses(documents: DataFrame) -> DataFrame:
    """One row per document row, with its detections after suppression.

    Whole texts. A null or empty text has no words, no detections, empty labels and score 0;
    first_word and last_word are null where no base phrase stands. A null doc_id stays null,
    repeated rows are scanned each, other columns are ignored.
    """
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [scan_text(t) for t in raw(batch, "text")]
        rows = [{"doc_id": d, **r} for d, r in zip(batch.column("doc_id").to_pylist(), rows)]
        return pa.RecordBatch.from_pylist(rows, schema=_arrow())

    return map_batches(pick(documents, doc_id="long", text="string"), run, SCHEMA)


def _arrow() -> pa.Schema:
    long, text = pa.int64(), pa.string()
    return pa.schema([("doc_id", long), ("n_words", long), ("n_base", long), ("first_word", long), ("last_word", long),
                      ("base_labels", text), ("labels", text), ("score", pa.float64()),
                      ("detections", pa.list_(pa.struct([("label", text), ("kind", text), ("first_word", long), ("end_word", long)])))])
