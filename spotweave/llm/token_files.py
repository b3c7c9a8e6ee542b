"""Token-id files: one zstandard dictionary, one frame per document, an offset index.

Format. A folder holds ``dictionary`` (one row: bytes, their sha256, id width, end id) and
``shards``, Parquet rows of the columns below. ``payload`` is the zstandard frames of the
shard's documents one after another, ``offsets`` their ends; a frame holds the ids as
little-endian unsigned integers of ``width`` bytes. Shards are in ascending doc_id order by
(part, seq), so one document is read by its id range, its offset and the dictionary, without
the others. Parquet rows hold the bytes since Spark's committer then deals with retried and
lost tasks on any store.
"""

from __future__ import annotations

import functools
import gc
import hashlib
import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from spotweave.llm.common import map_batches, pick, scratch, small_batches

END_ID = 0
MAGIC = "spotweave-ids-1"
SHARD_BYTES, SHARD_DOCS = 256 << 10, 4096
#: The dictionary's training sample: a piece of at most so many characters of so many documents, by smallest hash of the id.
DICT_BYTES, DICT_DOCS, DICT_CHARS = 64 << 10, 400, 20_000
#: Words, and words with what follows them up to a space, whose ids a worker remembers.
MEMORY_WORDS, MEMORY_SEGMENTS = 500_000, 300_000
_SIGNS = "".join(c for c in map(chr, range(0x21, 0x7F)) if not c.isalnum())
_ENCODE_BYTES, _PIECE = 256 << 10, 1 << 20
SHARD_SCHEMA = ("magic string, dictionary string, width int, part int, seq int, first_id long, last_id long, n_ids long, "
                "doc_ids array<long>, lengths array<long>, offsets array<long>, payload binary")
_ARROW = pa.schema([("magic", pa.string()), ("dictionary", pa.string()), ("width", pa.int32()), ("part", pa.int32()),
                    ("seq", pa.int32()), ("first_id", pa.int64()), ("last_id", pa.int64()), ("n_ids", pa.int64()),
                    ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("offsets", pa.list_(pa.int64())),
                    ("payload", pa.binary())])


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


@functools.cache
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


def pieces(text: str, limit: int = _PIECE) -> list[str]:
    """A long text cut before a space or line end that follows a letter: byte-level BPE never joins over such a place."""
    if len(text) <= limit:
        return [text]
    out, at = [], 0
    while len(text) - at > limit:
        cut = at + limit
        while cut < len(text) and not (text[cut] in " \n" and text[cut - 1].isalpha()):
            cut += 1
        out.append(text[at:cut])
        at = cut
    return [*out, text[at:]]


class Encoder:
    """The tokenizer with a memory of words.

    Byte-level BPE starts a new pre-token before every white space that follows something
    else, and between a word and the signs after it; so a text in which no white space stands
    before a space has the ids of its first word and of each " word" one after another. Words
    not seen yet are encoded together, and told apart by the byte lengths of their tokens. Any other text, and any other kind of
    tokenizer, is encoded as a whole. The memory is bounded and lives as long as the worker.
    """

    def __init__(self, path: str):
        self.model = tokenizer(path)
        self.words: dict[str, bytes] = {}
        self.signs: dict[str, bytes] = {}
        self.known: dict[str, bytes] = {}
        spec = json.loads(self.model.to_str())
        pre = spec.get("pre_tokenizer") or {}
        self.by_word = (spec["model"]["type"] == "BPE" and not spec.get("normalizer") and pre.get("type") == "ByteLevel"
                        and not pre.get("add_prefix_space") and pre.get("use_regex", True)
                        and not any(t["lstrip"] or t["rstrip"] or " " in t["content"] for t in spec.get("added_tokens", [])))
        added = {t["id"]: len(t["content"].encode()) for t in spec.get("added_tokens", [])}
        tokens = [self.model.id_to_token(i) or "" for i in range(self.model.get_vocab_size())]
        self.lengths = np.array([added.get(i, len(t)) for i, t in enumerate(tokens)], np.int64)

    def whole(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers, a batch of bounded size at a time."""
        out, batch, size = [], [], 0
        for k, t in enumerate(texts):
            batch.append(pieces(t))
            size += len(t)
            if size >= _ENCODE_BYTES or k == len(texts) - 1:
                found = iter(self.model.encode_batch_fast([p for b in batch for p in b], add_special_tokens=False))
                out += [b"".join(np.array(next(found).ids, "<u4").tobytes() for _ in b) for b in batch]
                batch, size = [], 0
        return out

    def learn(self, words: list[str]) -> None:
        """Ids of " word" for words that end in no white space."""
        at = 0
        while at < len(words):
            stop, size = at, 0
            while stop < len(words) and size < _ENCODE_BYTES:
                size += len(words[stop]) + 1
                stop += 1
            some = words[at:stop]
            ids = np.array(self.model.encode_batch_fast([" " + " ".join(some)], add_special_tokens=False)[0].ids, "<u4")
            bounds = np.searchsorted(np.cumsum(self.lengths[ids]), np.cumsum([len(w.encode()) + 1 for w in some])) + 1
            data = ids.tobytes()
            for w, a, b in zip(some, [0, *(4 * bounds[:-1]).tolist()], (4 * bounds).tolist()):
                self.words[w] = data[a:b]
            at = stop

    def add_segments(self, found: set[str]) -> set[str]:
        """Put the ids of each " segment" into ``known``; returns those that end in white space, which have none.

        A word of letters with ASCII signs after it is looked up without them.
        """
        segments = list(found)
        cores = [s.rstrip(_SIGNS) for s in segments]
        plain = [c.isalpha() for c in cores]
        odd = {s for s, ok in zip(segments, plain) if not ok}
        unsafe = {s for s in odd if not s or s[-1].isspace()}
        odd -= unsafe
        new = ({c for c, ok in zip(cores, plain) if ok} | odd) - self.words.keys()
        self.learn(sorted(new))
        words, signs = self.words, self.signs
        tails = {s[len(c):] for s, c, ok in zip(segments, cores, plain) if ok} - signs.keys()
        signs.update(zip(tails, self.whole(list(tails))))
        self.known.update((s, words[c] + signs[s[len(c):]]) for s, c, ok in zip(segments, cores, plain) if ok)
        self.known.update((s, words[s]) for s in odd)
        if len(words) > MEMORY_WORDS:
            for w in new:
                del words[w]
        if len(signs) > MEMORY_WORDS // 10:
            signs.clear()
        return unsafe

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.by_word:
            return self.whole(texts)
        parts = [t.split(" ") for t in texts]
        found: set[str] = set()
        for p in parts:
            found.update(p[1:])
        found -= self.known.keys()
        unsafe = self.add_segments(found)
        joined = [(not p[0] or not p[0][-1].isspace()) and (p[0] or len(p) == 1) and (not unsafe or unsafe.isdisjoint(p[1:])) for p in parts]
        heads = iter(self.whole([p[0] if ok else t for p, ok, t in zip(parts, joined, texts)]))
        known = self.known
        out = [b"".join([next(heads), *[known[x] for x in p[1:]]]) if ok else next(heads) for p, ok in zip(parts, joined)]
        if len(known) > MEMORY_SEGMENTS:
            for x in found - unsafe:
                del known[x]
        return out


@functools.cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


def encode(path: str, texts: list[str]) -> Iterator[np.ndarray]:
    """Ids of each whole text, the end id last."""
    end = np.array([END_ID], "<u4").tobytes()
    collecting = gc.isenabled()
    gc.disable()  # strings and bytes hold no cycles; scans for some cost more than the encoding
    try:
        found = encoder(path).encode(texts)
    finally:
        if collecting:
            gc.enable()
    for ids in found:
        yield np.frombuffer(ids + end, "<u4")


def train_dictionary(documents: DataFrame, path: str, width: int) -> bytes:
    """A dictionary of the serialized ids of a bounded sample; raw content where the trainer finds too little."""
    # Only ids below a threshold that about twice the sample meets have their texts read and ordered.
    share = min(1.0, 2 * DICT_DOCS / max(1, documents.count()))
    hashed = F.xxhash64("doc_id")
    docs = documents.filter(F.pmod(hashed, F.lit(1 << 30)) <= int(share * (1 << 30)))
    start = 1 + F.pmod(hashed, F.greatest(F.lit(1), F.length("text") - DICT_CHARS + 1))
    docs = docs.select("doc_id", F.substring("text", start, F.lit(DICT_CHARS)).alias("text"))
    sample = docs.orderBy(hashed, "doc_id", F.xxhash64("text")).limit(DICT_DOCS)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = [x.astype(f"<u{width}").tobytes() for x in encode(path, batch.column("text").to_pylist())]
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.binary())], ["ids"])

    samples = sorted(bytes(r["ids"]) for r in map_batches(sample.select("text"), run, "ids binary").collect())
    try:
        return zstandard.train_dictionary(min(DICT_BYTES, sum(map(len, samples)) // 8), samples).as_bytes()
    except (zstandard.ZstdError, ValueError, MemoryError):
        return b"".join(samples)[-DICT_BYTES:] or bytes(8)


def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict:
    return zstandard.ZstdCompressionDict(data)


def write_ids(documents: DataFrame, folder: str, tokenizer_path: str | None = None, width: int | None = None) -> str:
    """Encode and write every document; returns the folder.

    A null text is empty: its ids are the end id alone. Documents of equal id stand in text
    order; null ids come first. Repeated rows are written each, other columns are ignored, an
    empty table gives a folder with a dictionary and no shard. ``width`` defaults to 2 bytes
    where the vocabulary allows.
    """
    path = tokenizer_path or default_tokenizer()
    width = width or (2 if tokenizer(path).get_vocab_size() <= 1 << 16 else 4)
    spark = documents.sparkSession
    docs = pick(documents, doc_id="long", text="string").withColumn("text", F.coalesce("text", F.lit("")))
    data = train_dictionary(docs, path, width)
    digest = hashlib.sha256(data).hexdigest()
    spark.createDataFrame([(bytearray(data), digest, width, END_ID)], "data binary, sha256 string, width int, end_id int").write.parquet(
        f"{folder}/dictionary")
    small_batches(spark)
    shared = spark.sparkContext.broadcast(data)  # DICT_BYTES at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3, dict_data=_dictionary(shared.value))
        part, seq = TaskContext.get().partitionId(), 0
        ids, lengths, ends, frames, size = [], [], [], [], 0

        def shard() -> pa.RecordBatch:
            row = {"magic": MAGIC, "dictionary": digest, "width": width, "part": part, "seq": seq, "first_id": ids[0],
                   "last_id": ids[-1], "n_ids": sum(lengths), "doc_ids": ids, "lengths": lengths, "offsets": ends,
                   "payload": b"".join(frames)}
            return pa.RecordBatch.from_pylist([row], schema=_ARROW)

        for batch in batches:
            for doc_id, x in zip(batch.column("doc_id").to_pylist(), encode(path, batch.column("text").to_pylist())):
                frame = press.compress(x.astype(f"<u{width}").tobytes())
                size += len(frame)
                ids.append(doc_id)
                lengths.append(len(x))
                ends.append(size)
                frames.append(frame)
                if size >= SHARD_BYTES or len(ids) >= SHARD_DOCS:
                    yield shard()
                    seq, size = seq + 1, 0
                    ids, lengths, ends, frames = [], [], [], []
        if ids:
            yield shard()

    in_order = docs.repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions("doc_id", "text")
    in_order.mapInArrow(run, SHARD_SCHEMA).write.parquet(f"{folder}/shards")
    return folder


def open_dictionary(spark: SparkSession, folder: str) -> tuple[bytes, str]:
    row = spark.read.parquet(f"{folder}/dictionary").first()
    data = bytes(row["data"])
    if hashlib.sha256(data).hexdigest() != row["sha256"]:
        raise ValueError("DICTIONARY_DAMAGED")
    return data, row["sha256"]


def _decoder(data: bytes, digest: str):
    unpress = zstandard.ZstdDecompressor(dict_data=_dictionary(data))

    def decode(row: dict, i: int) -> np.ndarray:
        if row["magic"] != MAGIC or row["dictionary"] != digest:
            raise ValueError("SHARD_OF_ANOTHER_DICTIONARY")
        frame = row["payload"][row["offsets"][i - 1] if i else 0:row["offsets"][i]]
        return np.frombuffer(unpress.decompress(frame), f"<u{row['width']}").astype("<u4")

    return decode


def read_ids(spark: SparkSession, folder: str, with_ids: bool = True) -> DataFrame:
    """Per document, decoded from the files: doc_id, start, n_tokens, ids_crc32 and, if wanted, ids."""
    data, digest = open_dictionary(spark, folder)
    shared = spark.sparkContext.broadcast(data)
    shards = spark.read.schema(SHARD_SCHEMA).parquet(f"{folder}/shards")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = _decoder(shared.value, digest)
        for batch in batches:
            for k in range(batch.num_rows):
                row, local, out = batch.slice(k, 1).to_pylist()[0], 0, []
                for i, doc_id in enumerate(row["doc_ids"]):
                    ids = decode(row, i)
                    if len(ids) != row["lengths"][i]:
                        raise ValueError("SHARD_DAMAGED")
                    out.append((row["part"], row["seq"], doc_id, local, len(ids), zlib.crc32(ids), *[ids] * with_ids))
                    local += len(ids)
                columns = list(zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int32()), *[pa.array(c, pa.int64()) for c in columns[2:6]],
                     *[pa.array(list(c), pa.list_(pa.int64())) for c in columns[6:]]],
                    ["part", "seq", "doc_id", "local", "n_tokens", "ids_crc32", *["ids"] * with_ids])

    small_batches(spark)
    rows = shards.mapInArrow(run, "part int, seq int, doc_id long, local long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids)
    # Starts: sums over shards within a part, and over parts. Only index columns are read for them.
    index = shards.select("part", "seq", "n_ids")
    earlier = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = index.groupBy("part").agg(F.sum("n_ids").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("part_start"))
    within = W.partitionBy("part").orderBy("seq").rowsBetween(W.unboundedPreceding, -1)
    starts = index.withColumn("shard_start", F.coalesce(F.sum("n_ids").over(within), F.lit(0))).join(parts, "part").select(
        "part", "seq", (F.col("part_start") + F.col("shard_start")).alias("shard_start"))
    return rows.join(starts, ["part", "seq"]).select(
        "doc_id", (F.col("shard_start") + F.col("local")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * with_ids)


def read_document(spark: SparkSession, folder: str, doc_id: int) -> list[list[int]]:
    """Ids of the documents of one id: reads the shards whose id range holds it, and decodes only its frames."""
    decode = _decoder(*open_dictionary(spark, folder))
    shards = spark.read.schema(SHARD_SCHEMA).parquet(f"{folder}/shards")
    found = shards.filter((F.col("first_id") <= doc_id) & (F.col("last_id") >= doc_id)).orderBy("part", "seq").collect()
    return [decode(r, i).tolist() for r in found for i, d in enumerate(r["doc_ids"]) if d == doc_id]


def encoded(documents: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    """Write the documents to a new folder below the shared one and read starts, lengths and checksums back from it."""
    spark = documents.sparkSession
    return read_ids(spark, write_ids(documents, scratch(spark, "ids"), tokenizer_path), with_ids=False)
