"""Packing by lexical retrieval: a BM25 index of each shard returns unused neighbours that fill a seed's window.

Terms are token ids, so document frequencies (of all documents) are one array of the
vocabulary's size. A document's signature is its heaviest term. Signatures are dealt to shards
of about ``SHARD_TOKENS`` tokens: rare ones together, a common one over as many shards as it
needs, by hash of the row; so neighbours mostly share a shard, and a group of copies of any size does not
make a shard larger. Ids are shuffled once, by shard.

Within a shard whole windows of long documents come first. Then each document in turn is a
seed; the others are ranked by their BM25 score for its terms and fill the window until one
is cut at its end; the rest of that one stays unused. Only the end of a shard is shorter
than a window: it is cut at powers of two, so nothing is padded.
"""

from __future__ import annotations

import functools
import gc
import itertools
import json
import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from spotweave.llm.common import mixed, pick, raw, small_batches, written
from spotweave.llm.token_files import pieces, tokenizer

WINDOW, END_ID, SHARD_TOKENS = 4096, 2, 1 << 20
SATURATION, LENGTH_SHARE = 1.2, 0.75
MEMORY_SEGMENTS, _ENCODE_BYTES, _ENCODE_SEGMENTS = 600_000, 128 << 10, 8192
_SIGNS = "".join(c for c in map(chr, range(0x21, 0x7F)) if not c.isalnum())
_ASCII_WORD = re.compile(rb"([!-&(-/:;=-@\[-`{-~]*)([A-Za-z]+)([!-/:-@\[-`{-~]*)")
_SPLIT = r"[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_SEQUENCES = 1 << 24  # sequence ids of a shard


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


class SegmentEncoder:
    """A tokenizer with a memory of what stands between ASCII white space.

    A tokenizer that turns white space runs into one space, splits there and drops it gives a
    text the ids of its segments one after another. A new segment of letters between ASCII
    signs has the ids of its parts: such a tokenizer splits there too. New words are encoded
    together and told apart by their end tokens; other new segments with a special token
    between them. The older half of a full memory goes. Other tokenizers encode texts whole.
    """

    def __init__(self, path: str, memory: int = MEMORY_SEGMENTS):
        self.model, self.memory = tokenizer(path), memory
        self.known: dict[bytes, bytes] = {}
        self.words: dict[bytes, bytes] = {}
        self.signs: dict[bytes, bytes] = {}
        spec = json.loads(self.model.to_str())
        added = spec.get("added_tokens") or []
        first = ((spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
        steps = (spec.get("normalizer") or {}).get("normalizers") or []
        self.by_segment = (first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert") is True
                           and any(x.get("type") == "Replace" and x.get("pattern") == {"Regex": "\\s+"} and x.get("content") == " " for x in steps)
                           and bool(added) and all(x["special"] and not x["normalized"] and not x["lstrip"] and not x["rstrip"] and not x["single_word"]
                                                   and not any(c.isspace() for c in x["content"]) for x in added))
        self.special = [x["content"] for x in added]
        self.mark = added[0]["id"] if added else -1
        suffix = spec["model"].get("end_of_word_suffix")
        self.by_word = bool(suffix) and _SPLIT in (first.get("pattern") or {}).get("Regex", "")
        self.ends = np.array([bool(suffix) and (self.model.id_to_token(i) or "").endswith(suffix) for i in range(self.model.get_vocab_size())])

    def ids(self, text: str) -> np.ndarray:
        found = self.model.encode_batch_fast(pieces(text), add_special_tokens=False)
        return np.concatenate([np.array(x.ids, "<u4") for x in found]) if found else np.zeros(0, "<u4")

    def learn(self, segments: list[bytes]) -> None:
        """Put the ids of every segment into ``known``."""
        parts, others = [], []
        match, add = _ASCII_WORD.fullmatch if self.by_word else lambda _: None, parts.append
        for segment in segments:
            # A quote before a letter may be one of the tokenizer's endings, signs around a word a special token.
            if found := match(segment):
                add((segment, found[1], found[2].lower(), found[3]))
                continue
            text = segment.decode("utf-8", "replace")
            tail = text.rstrip(_SIGNS)
            word = tail.lstrip(_SIGNS)
            head = tail[:len(tail) - len(word)]
            if self.by_word and word.isalpha() and "'" not in head and "<" not in head and _plain(word):
                add((segment, head.encode(), word.encode(), text[len(tail):].encode()))
            else:
                others.append((segment, text))
        words, signs = self.words, self.signs
        self.learn_words(sorted({x[2] for x in parts} - words.keys()))
        for sign in {x[1] for x in parts} | {x[3] for x in parts}:
            if sign not in signs:
                signs[sign] = self.ids(sign.decode()).tobytes()
        self.known.update([(x, signs[h] + words[w] + signs[t]) for x, h, w, t in parts])
        self.learn_segments(others)
        forget(words, self.memory)
        forget(signs, self.memory // 10)

    def learn_words(self, words: list[bytes]) -> None:
        """Ids of words of letters: each is one pre-token, whose last token alone ends a word."""
        for at in range(0, len(words), _ENCODE_SEGMENTS):
            some = words[at:at + _ENCODE_SEGMENTS]
            ids = np.array(self.model.encode_batch_fast([b" ".join(some).decode()], add_special_tokens=False)[0].ids, "<u4")
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) != len(some):
                self.words.update((w, self.ids(w.decode()).tobytes()) for w in some)
                continue
            data, ends = ids.tobytes(), (4 * ends).tolist()
            self.words.update((w, data[a:b]) for w, a, b in zip(some, [0, *ends[:-1]], ends))

    def learn_segments(self, segments: list[tuple[bytes, str]]) -> None:
        at = 0
        while at < len(segments):
            some, size = [], 0
            while at < len(segments) and size < _ENCODE_BYTES and len(some) < _ENCODE_SEGMENTS:
                segment, text = segments[at]
                if any(x in text for x in self.special):
                    self.known[segment] = self.ids(text).tobytes()
                else:
                    some.append((segment, text))
                    size += len(text)
                at += 1
            if some:
                ids = np.array(self.model.encode_batch_fast([self.special[0].join(x[1] for x in some)], add_special_tokens=False)[0].ids, "<u4")
                ends = np.append(np.flatnonzero(ids == self.mark), len(ids))
                data = ids.tobytes()
                for (segment, _), a, b in zip(some, np.append(0, ends[:-1] + 1).tolist(), ends.tolist()):
                    self.known[segment] = data[4 * a:4 * b]

    def batch(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids of each whole text; what the batch has of new segments is learnt together."""
        if not self.by_segment:
            return [self.ids(t.decode("utf-8", "replace")) for t in texts]
        collecting = gc.isenabled()
        gc.disable()  # strings and bytes hold no cycles
        try:
            out, at = [], 0
            while at < len(texts):  # as many texts as the memory surely holds
                stop, size = at, 0
                split = []
                while stop < len(texts) and (stop == at or size + len(texts[stop]) // 2 < self.memory):
                    size += len(texts[stop]) // 2
                    split.append(texts[stop].split())
                    stop += 1
                forget(self.known, self.memory)
                self.learn(sorted(set().union(*split) - self.known.keys()))
                out += [np.frombuffer(b"".join(map(self.known.__getitem__, x)), "<u4") for x in split]
                at = stop
            return out
        finally:
            if collecting:
                gc.enable()


def _plain(word: str) -> bool:
    """Whether lower-casing and composing leave a word of letters one."""
    return word.isascii() or (unicodedata.is_normalized("NFC", word) and len(word.lower()) == len(word) and word.lower().isalpha())


def forget(known: dict, limit: int) -> None:
    """Drops the older half of a memory beyond its limit."""
    if len(known) > limit:
        for x in list(itertools.islice(known, len(known) // 2)):
            del known[x]


@functools.cache
def segment_encoder(path: str) -> SegmentEncoder:
    return SegmentEncoder(path)


def tokenised(docs: DataFrame, path: str, width: int, end_id: int) -> DataFrame:
    """(row, doc_id, n, ids) of (row, doc_id, text): ids of ``width`` bytes, the end id last."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.array([end_id], f"<u{width}").tobytes()
        for batch in batches:
            texts = raw(batch, "text")
            ids = [x.astype(f"<u{width}").tobytes() + end for x in segment_encoder(path).batch(texts)]
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("doc_id"), pa.array([len(x) // width for x in ids], pa.int64()),
                                              pa.array(ids, pa.binary())], ["row", "doc_id", "n", "ids"])

    small_batches(docs.sparkSession)
    return docs.mapInArrow(run, "row long, doc_id long, n long, ids binary")


def _ids(batch: pa.RecordBatch, width: int) -> list[np.ndarray]:
    return [np.frombuffer(x, f"<u{width}") for x in batch.column("ids").to_pylist()]


def document_frequencies(tokens: DataFrame, size: int, width: int) -> np.ndarray:
    """In how many documents each id stands: one number per id of the vocabulary."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(size, np.int64)
        for batch in batches:
            for x in _ids(batch, width):
                seen[x[:-1]] += 1  # once for each id of the text
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[at])], ["term", "df"])

    rows = tokens.select("ids").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect()
    out = np.zeros(size, np.int64)
    for r in rows:
        out[r["term"]] = r["df"]
    return out


def inverse_frequencies(df: np.ndarray, documents: int) -> np.ndarray:
    """BM25's inverse document frequency; a term of more than half of the documents weighs nothing."""
    return np.maximum(0.0, np.log((documents - df + 0.5) / (df + 0.5)))


class Weights:
    """BM25 weights of a document's terms."""

    def __init__(self, idf: np.ndarray, mean_length: float):
        self.idf, self.mean = idf, max(mean_length, 1.0)

    def of(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        terms, tf = np.unique(ids[:-1], return_counts=True)
        idf = self.idf[terms]
        kept = idf > 0
        terms, tf = terms[kept].astype(np.int64), tf[kept].astype(np.float64)
        norm = SATURATION * (1 - LENGTH_SHARE + LENGTH_SHARE * len(ids) / self.mean)
        return terms, idf[kept] * tf * (SATURATION + 1) / (tf + norm)

    def signature(self, ids: np.ndarray) -> int:
        """The heaviest term, the smallest id if equal; the end of the table if there is none."""
        terms, w = self.of(ids)
        return int(terms[np.argmax(w)]) if len(terms) else len(self.idf)


def shard_table(sizes: np.ndarray, shard_tokens: int) -> tuple[np.ndarray, np.ndarray]:
    """First shard and number of shards of every signature, from its tokens."""
    first, count = np.zeros(len(sizes), np.int64), np.ones(len(sizes), np.int64)
    shard, held = 0, 0
    for s in np.flatnonzero(sizes).tolist():
        size = int(sizes[s])
        if size >= shard_tokens:
            if held:
                shard, held = shard + 1, 0
            first[s], count[s] = shard, -(-size // shard_tokens)
            shard += int(count[s])
            continue
        if held + size > shard_tokens:
            shard, held = shard + 1, 0
        first[s] = shard
        held += size
    return first, count


def pack_shard(ids: list[np.ndarray], weights: Weights, window: int) -> Iterator[list[tuple[int, int, int]]]:
    """Sequences of (document, start, length) that hold every id of the shard's documents once."""
    n = len(ids)
    start, left = np.zeros(n, np.int64), np.array([len(x) for x in ids], np.int64)
    for d in np.flatnonzero(left >= window).tolist():
        while left[d] >= window:
            yield [(d, int(start[d]), window)]
            start[d] += window
            left[d] -= window
    # The inverted index: postings sorted by term, then document.
    found = [weights.of(x) for x in ids]
    sizes = np.array([len(t) for t, _ in found])
    terms, doc = np.concatenate([t for t, _ in found]), np.repeat(np.arange(n), sizes)
    value = np.concatenate([w for _, w in found])
    order = np.argsort(terms, kind="stable")
    terms, doc, value = terms[order], doc[order], value[order]
    for seed in range(n):
        if not left[seed]:
            continue
        sequence = [(seed, int(start[seed]), int(left[seed]))]
        room = window - int(left[seed])
        left[seed] = 0
        asked = found[seed][0]
        low, high = np.searchsorted(terms, asked), np.searchsorted(terms, asked, side="right")
        size = high - low
        ends = np.cumsum(size)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(low - (ends - size), size)
        score = np.bincount(doc[at], value[at], minlength=n)
        unused = np.flatnonzero(left)
        near = unused[np.argsort(-score[unused], kind="stable")]
        whole = int(np.searchsorted(np.cumsum(left[near]), room, side="right"))
        for d in near[:whole].tolist():
            sequence.append((d, int(start[d]), int(left[d])))
            room -= int(left[d])
            left[d] = 0
        if room and whole < len(near):
            d = int(near[whole])
            sequence.append((d, int(start[d]), room))
            start[d] += room
            left[d] -= room
            room = 0
        if not room:
            yield sequence
        else:
            yield from powers_of_two(sequence)


def powers_of_two(sequence: list[tuple[int, int, int]]) -> Iterator[list[tuple[int, int, int]]]:
    """The pieces of a short sequence cut into sequences whose lengths are falling powers of two."""
    total = sum(x[2] for x in sequence)
    rest = list(reversed(sequence))
    while total:
        room = 1 << total.bit_length() - 1
        total -= room
        out = []
        while room:
            d, start, length = rest.pop()
            take = min(length, room)
            out.append((d, start, take))
            room -= take
            if take < length:
                rest.append((d, start + take, length - take))
        yield out


def pack(documents: DataFrame, tokenizer_path: str | None = None, window: int = WINDOW, end_id: int = END_ID,
         shard_tokens: int = SHARD_TOKENS, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and, if wanted, ids.

    Every id of every document, its end id included, is in exactly one piece; a sequence holds
    ``window`` ids (a power of two) or a smaller power of two, and its pieces lie from offset 0 without gaps. A null
    text is empty: its end id alone. A very long text fills windows of its own. Repeated rows
    and rows of null id are documents each. Ties go to the row read first. Other columns are
    ignored; an empty table gives no rows.
    """
    path = tokenizer_path or default_tokenizer()
    size = max(tokenizer(path).get_vocab_size(), end_id + 1)
    width = 2 if size <= 1 << 16 else 4
    spark: SparkSession = documents.sparkSession
    docs = pick(documents, doc_id="long", text="string").withColumn("row", F.monotonically_increasing_id())
    tokens = written(tokenised(docs, path, width, end_id), "packing")
    n, total = tokens.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    weights = Weights(inverse_frequencies(document_frequencies(tokens, size, width), n), total / max(n, 1))
    shared = spark.sparkContext.broadcast(weights)  # one number per id of the vocabulary

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(size + 1, np.int64)
        for batch in batches:
            for x in _ids(batch, width):
                seen[shared.value.signature(x)] += len(x)
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[at])], ["signature", "n"])

    sizes = np.zeros(size + 1, np.int64)
    for r in tokens.select("ids").mapInArrow(signed, "signature long, n long").groupBy("signature").agg(F.sum("n").alias("n")).collect():
        sizes[r["signature"]] = r["n"]  # at most one row per id of the vocabulary
    shards = spark.sparkContext.broadcast(shard_table(sizes, shard_tokens))

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, count = shards.value
        for batch in batches:
            signature = np.array([shared.value.signature(x) for x in _ids(batch, width)], np.int64)
            spread = (mixed(batch.column("row").to_numpy().astype(np.uint64)) % count[signature].astype(np.uint64)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(first[signature] + spread), *[batch.column(n) for n in ("row", "doc_id", "ids")]],
                                             ["shard", "row", "doc_id", "ids"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((s, d, x) for b in batches for s, d, x in zip(b.column("shard").to_pylist(), b.column("doc_id").to_pylist(), _ids(b, width)))
        for shard, members in itertools.groupby(rows, key=lambda x: x[0]):
            members = list(members)
            ids, out = [x[2] for x in members], []
            for k, sequence in enumerate(pack_shard(ids, shared.value, window)):
                offset = 0
                for d, start, length in sequence:
                    piece = ids[d][start:start + length].astype("<u4")
                    out.append((members[d][1], start, length, zlib.crc32(piece), len(ids[d]), shard * _SEQUENCES + k, offset, *[piece] * with_ids))
                    offset += length
                if len(out) >= 10_000:
                    yield _pieces(out)
                    out = []
            if out:
                yield _pieces(out)

    # A batch of few rows stays small where texts are long.
    small_batches(spark)
    placed = tokens.select("row", "doc_id", "ids").mapInArrow(dealt, "shard long, row long, doc_id long, ids binary")
    return placed.repartition("shard").sortWithinPartitions("shard", "row").mapInArrow(run, SCHEMA + ", ids array<long>" * with_ids)


def _pieces(out: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*out))
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in columns[:7]], *[pa.array(list(c), pa.list_(pa.int64())) for c in columns[7:]]],
                                      [*names, *["ids"] * (len(columns) - 7)])
