"""Phrase collocation mining by relations (SETM): occurrence relations are persisted, extended and counted.

A relation's row is a block of occurrences in (piece, position) order: a table of the block's
words and one code per occurrence, 0 where two neighbours don't join. So the merge join of a
relation with itself by piece and adjacent position stays inside the block, and its first
group count too; Spark sums the blocks' counts by key. Frequent groups come back as a
bitmap of fixed size, which may keep a rare group (its exact count drops it later) and never
loses a frequent one; the relation so semi-joined is persisted and is what the next length extends.

A word is a 64-bit hash of its language and itself. The table of all words proves that no two
share one (another seed is taken otherwise), so keys of k hashes are exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from spotweave.llm.common import pick, scratch, small_batches, written

LEAST, LONGEST, FIRST, COVER = 10, 3, 2000, 50
BLOCK_CODES, BITMAP_BITS, GROUP_ROWS = 1 << 18, 26, 100_000
ROW_GROUP_BYTES = 1 << 23
_SLOT = 13  # 64-bit words of a piece of the bitmap, as a power of two
_UPPER = bytes(range(0x41, 0x5B))
_TABLE = bytes.maketrans(_UPPER + b".,;:!?\x0b\x0c\r\t", _UPPER.lower() + b"\n" * 9 + b" ")
RELATION = "langs array<string>, words array<string>, hashes array<long>, counts array<long>, codes binary"


class Codes(dict):
    """Code of a word, given at its first occurrence."""

    def __init__(self, words: list[bytes]):
        super().__init__({b"\n": 0})
        self.words = words

    def __missing__(self, word: bytes) -> int:
        self.words.append(word)
        self[word] = code = len(self.words) - 1
        return code


class Block:
    """Occurrences of whole texts."""

    def __init__(self):
        self.words: list[bytes] = [b"\n"]
        self.langs: list[str | None] = [None]
        self.of: dict[str, Codes] = {}
        self.codes: list[np.ndarray] = []
        self.size = 0

    def add(self, lang: str, text: bytes) -> None:
        codes = self.of.setdefault(lang, Codes(self.words))
        codes.setdefault(b"", -1)
        found = (b"\n" + text).translate(_TABLE).replace(b"\n", b" \n ").split(b" ")
        at = np.fromiter(map(codes.__getitem__, found), np.int64, len(found))
        self.langs += [lang] * (len(self.words) - len(self.langs))
        at = at[at >= 0]
        self.codes.append(at[(at > 0) | np.append(True, at[:-1] > 0)])  # one 0 between pieces
        self.size += len(self.codes[-1])

    def batch(self, seed: int) -> pa.RecordBatch:
        codes = np.append(np.concatenate(self.codes), 0)
        counts = np.bincount(codes, minlength=len(self.words))[1:]
        seeds = {lang: xxhash.xxh3_64_intdigest(lang, seed) for lang in self.of}
        hashes = np.array([xxhash.xxh3_64_intdigest(w, seeds[x]) for w, x in zip(self.words[1:], self.langs[1:])], np.uint64)
        return relation_block(self.langs[1:], [w.decode("utf-8", "replace") for w in self.words[1:]], hashes.view(np.int64), counts, codes)


def relation_block(langs, words, hashes, counts, codes) -> pa.RecordBatch:
    columns = [pa.array([langs], pa.list_(pa.string())), pa.array([words], pa.list_(pa.string())),
               *[pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x, pa.int64())) for x in (hashes, counts)],
               pa.array([codes.astype("<u4").tobytes()], pa.binary())]
    return pa.RecordBatch.from_arrays(columns, ["langs", "words", "hashes", "counts", "codes"])


def occurrences(docs: DataFrame, seed: int) -> DataFrame:
    """The relation of all words: blocks of about BLOCK_CODES occurrences, each text whole in one."""
    size = BLOCK_CODES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = Block()
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist()):
                block.add(lang, text)
                if block.size >= size:
                    yield block.batch(seed)
                    block = Block()
        if block.size:
            yield block.batch(seed)

    small_batches(docs.sparkSession)
    return docs.mapInArrow(run, RELATION)


def word_counts(relation: DataFrame) -> DataFrame:
    """(h0, lang, word, n) of all words."""
    entry = F.explode(F.arrays_zip("hashes", "langs", "words", "counts")).alias("e")
    return relation.select(entry).groupBy(F.col("e.hashes").alias("h0"), F.col("e.langs").alias("lang"), F.col("e.words").alias("word")).agg(
        F.sum("e.counts").alias("n"))


def _key_bits(keys: list[np.ndarray], width: int) -> np.ndarray:
    """Bit of a key of hashes in a bitmap of 2^width bits."""
    h = np.zeros(len(keys[0]), np.uint64)
    for k in keys:
        h = (h ^ k.view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return (h >> np.uint64(64 - width)).astype(np.int64)


def bitmap(frequent: DataFrame, length: int) -> np.ndarray:
    """Bits of the frequent keys h0.. in 64-bit words: 2^BITMAP_BITS bits whatever the number of keys."""
    names, width = [f"h{k}" for k in range(length)], BITMAP_BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                at = _key_bits([batch.column(n).to_numpy() for n in names], width)
                bits = np.left_shift(np.uint64(1), (at & 63).astype(np.uint64)).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(at >> 6), pa.array(bits)], ["at", "bits"])

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots: dict[int, np.ndarray] = {}
        for batch in batches:
            at, bits = batch.column("at").to_numpy(), batch.column("bits").to_numpy().view(np.uint64)
            for slot in np.unique(at >> _SLOT).tolist():
                mine = at >> _SLOT == slot
                slots.setdefault(slot, np.zeros(1 << _SLOT, np.uint64))[at[mine] & (1 << _SLOT) - 1] = bits[mine]
        if slots:
            yield pa.RecordBatch.from_arrays([pa.array(list(slots), pa.int64()), pa.array([x.tobytes() for x in slots.values()], pa.binary())], ["slot", "bits"])

    words = frequent.select(*names).mapInArrow(run, "at long, bits long").groupBy("at").agg(F.bit_or("bits").alias("bits"))
    parts = words.repartition(F.shiftright("at", _SLOT)).mapInArrow(gathered, "slot long, bits binary").collect()
    bits = np.zeros(1 << max(width - 6, _SLOT), np.uint64)
    for r in parts:
        bits[r["slot"] << _SLOT:r["slot"] + 1 << _SLOT] = np.frombuffer(r["bits"], np.uint64)
    return bits[:1 << width - 6]


def _holds(bits: np.ndarray, keys: list[np.ndarray]) -> np.ndarray:
    at = _key_bits(keys, 5 + len(bits).bit_length())
    return (bits[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1


def grouped(codes: np.ndarray, n_words: int, length: int, allowed: np.ndarray, of_places: bool = True):
    """Merge join by adjacent position: (group of every place or -1, if wanted; codes of the groups; their counts).

    A place begins a phrase of ``length`` words when none of them is a break and all are allowed.
    """
    m = len(codes) - length + 1
    whole = np.ones(max(m, 0), bool)
    for k in range(length):
        whole &= allowed[codes[k:k + m]]
    places = np.flatnonzero(whole)
    key, members = codes[places], [codes[places]]
    for k in range(1, length):
        if k > 1:
            key = np.unique(key, return_inverse=True)[1]
        members.append(codes[places + k])
        key = key * (n_words + 1) + members[-1]
    if not of_places:
        _, first, counts = np.unique(key, return_index=True, return_counts=True)
        return None, [x[first] for x in members], counts
    _, first, inverse, counts = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
    of = np.full(len(codes), -1)
    of[places] = inverse
    return of, [x[first] for x in members], counts


def chains(codes: np.ndarray, begins: np.ndarray, length: int) -> np.ndarray:
    """The codes of every run of neighbouring places that begin a phrase, a break after each run."""
    at = np.flatnonzero(begins)
    if not len(at):
        return np.zeros(0, np.int64)
    new = np.append(True, np.diff(at) > 1)
    first, size = at[new], np.diff(np.append(np.flatnonzero(new), len(at))) + length
    ends = np.cumsum(size)
    take = np.arange(ends[-1]) - np.repeat(ends - size, size) + np.repeat(first, size)
    out = codes[np.minimum(take, len(codes) - 1)]
    out[ends - 1] = 0
    return out


def _blocks(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.column("hashes")[i].values.to_numpy(), np.frombuffer(batch.column("codes")[i].as_py(), "<u4").astype(np.int64)


def extended(relation: DataFrame, length: int, words: np.ndarray) -> DataFrame:
    """(h0.., n): each block's phrases of ``length`` words with its count."""
    shared = relation.sparkSession.sparkContext.broadcast(words)  # 2^BITMAP_BITS bits
    names = [f"h{k}" for k in range(length)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for hashes, codes in _blocks(batches):
            allowed = np.append(False, _holds(shared.value, [hashes]))
            _, members, counts = grouped(codes, len(hashes), length, allowed, of_places=False)
            for i in range(0, len(counts), 1 << 16):
                yield pa.RecordBatch.from_arrays([*[pa.array(hashes[x[i:i + (1 << 16)] - 1]) for x in members], pa.array(counts[i:i + (1 << 16)])], [*names, "n"])

    return relation.mapInArrow(run, ", ".join(f"{n} long" for n in [*names, "n"]))


def semi_joined(relation: DataFrame, length: int, words: np.ndarray, phrases: np.ndarray) -> DataFrame:
    """The relation of the places whose phrase of ``length`` words is frequent."""
    shared = relation.sparkSession.sparkContext.broadcast((words, phrases))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for hashes, codes in _blocks(batches):
            of, members, _ = grouped(codes, len(hashes), length, np.append(False, _holds(shared.value[0], [hashes])))
            frequent = np.append(_holds(shared.value[1], [hashes[x - 1] for x in members]), False)  # -1 is no group
            kept = chains(codes, frequent[of], length)
            used = np.unique(kept)
            if len(used) > 1:
                kept = np.searchsorted(used, kept)
                yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, len(used) - 1], pa.int32()), pa.array(hashes[used[1:] - 1])),
                                                  pa.array([kept.astype("<u4").tobytes()], pa.binary())], ["hashes", "codes"])

    return relation.select("hashes", "codes").mapInArrow(run, "hashes array<long>, codes binary")


@contextmanager
def large_rows(spark: SparkSession) -> Iterator[None]:
    """Arrow batches of a few blocks; the setting is put back."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "4")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def relation_written(relation: DataFrame) -> DataFrame:
    """Written in row groups of a few blocks: a row is megabytes, and Parquet holds at least 100 in a group, which a reader decodes at once."""
    path = scratch(relation.sparkSession, "phrases")
    sizes = {"parquet.block.size": ROW_GROUP_BYTES, "parquet.block.size.row.check.min": 1, "parquet.block.size.row.check.max": 2,
             "parquet.page.size.row.check.min": 1, "parquet.page.size.row.check.max": 2}
    relation.write.options(**sizes).parquet(path)
    return relation.sparkSession.read.schema(relation.schema).parquet(path)


def distinct_hashes(words: DataFrame) -> bool:
    return not words.groupBy("h0").count().filter("count > 1").limit(1).count()


def frequent_phrases(documents: DataFrame, least: int = LEAST, longest: int = LONGEST) -> tuple[DataFrame, list[DataFrame]]:
    """All words (h0, lang, word, n), and for each length from 2 the phrases (h0.., n) of ``least`` occurrences or more."""
    docs = pick(documents, text="string", lang="string").filter("text is not null").withColumn("lang", F.coalesce("lang", F.lit("und")))
    seed = 0
    while True:
        relation = relation_written(occurrences(docs, seed))
        words = written(word_counts(relation), "phrases")
        if distinct_hashes(words):
            break
        seed += 1
    spark = documents.sparkSession
    known = bitmap(words.filter(F.col("n") >= least), 1)
    found = []
    relation = relation.select("hashes", "codes")
    for length in range(2, longest + 1):
        names = [f"h{k}" for k in range(length)]
        with large_rows(spark):
            counted = extended(relation, length, known).groupBy(*names).agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
            found.append(written(counted, "phrases"))
        if length < longest:
            phrases = bitmap(found[-1], length)
            with large_rows(spark):
                relation = relation_written(semi_joined(relation, length, known, phrases))
    return words, found


def _cut_score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 a a / (l r)) in whole numbers of 38 digits."""
    a, left, right = (x.cast("decimal(18,0)") for x in (a, left, right))
    wide = "decimal(38,0)"
    return F.call_function("div", (a * a).cast(wide) * F.lit(1_000_000).cast("decimal(7,0)"), (left * right).cast(wide))


def scored(words: DataFrame, phrases: list[DataFrame]) -> DataFrame:
    """Phrases of every length: lang, phrase, a, l, r, score of the lowest-scoring cut, and the keys of what they cover."""
    known = [words.select("h0", "n"), *phrases]
    parts = []
    for length, found in enumerate(phrases, 2):
        names = [f"h{k}" for k in range(length)]
        out = found.withColumnRenamed("n", "a")
        for k in range(1, length):
            for side, cut in (("l", names[:k]), ("r", names[k:])):
                part = known[len(cut) - 1].select(*[F.col(f"h{i}").alias(n) for i, n in enumerate(cut)], F.col("n").alias(f"{side}{k}"))
                out = out.join(part, cut)
        for i, n in enumerate(names):
            text = words.select(F.col("h0").alias(n), F.col("word").alias(f"w{i}"), *([F.col("lang")] if not i else []))
            out = out.join(text, n)
        cuts = [F.struct(_cut_score(F.col("a"), F.col(f"l{k}"), F.col(f"r{k}")).alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"),
                         F.col(f"r{k}").alias("r")) for k in range(1, length)]
        best = F.array_min(F.array(*cuts))
        parts.append(out.withColumn("cut", best).select(
            "lang", F.concat_ws(" ", *[f"w{i}" for i in range(length)]).alias("phrase"), "a", "cut.l", "cut.r", "cut.score", F.array(*names).alias("key")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def not_covered(candidates: DataFrame, phrases: list[DataFrame], cover: int) -> DataFrame:
    """Leaves out candidates inside a longer phrase that has at least ``cover`` percent of their occurrences."""
    for length, found in enumerate(phrases[1:], 3):
        inner = [F.array(*[f"h{k}" for k in range(i, i + size)]) for size in range(2, length) for i in range(length - size + 1)]
        top = found.select("n", F.explode(F.array(*[F.struct(x.alias("key")) for x in inner])).alias("e")).groupBy(F.col("e.key").alias("key")).agg(
            F.max("n").alias("outer"))
        candidates = candidates.join(top, "key", "left").filter(F.col("outer").isNull() | (F.col("outer") * 100 < F.col("a") * cover)).drop("outer")
    return candidates


def first_of_each(candidates: DataFrame, first: int) -> DataFrame:
    """Each language's first rows by score, occurrences and phrase: salted groups of about GROUP_ROWS rows keep theirs until one is left."""
    order = [F.col("score").desc(), F.col("a").desc(), "phrase"]
    salts = max(1, candidates.count() // GROUP_ROWS)
    while salts > 1:
        group = W.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(salts))).orderBy(*order)
        candidates = candidates.withColumn("rank", F.row_number().over(group)).filter(F.col("rank") <= first).drop("rank")
        salts //= max(2, GROUP_ROWS // first)
    return candidates.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= first)


def mine(documents: DataFrame, least: int = LEAST, longest: int = LONGEST, first: int = FIRST, cover: int = COVER) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's best collocations of 2 to ``longest`` words.

    A-Z are lower-cased, pieces end at ``. , ; : ! ?`` and line ends, words at spaces and tabs.
    ``a`` counts the phrase, overlaps included, ``l`` and ``r`` its two parts at the cut of the
    lowest score, ``n`` all words of the language. A null language is ``und``; a null or empty
    text has no words, a very long one is one block. Repeated rows count each; ties go by
    phrase in byte order. Other columns are ignored, an empty table gives no rows.
    """
    words, phrases = frequent_phrases(documents, least, longest)
    kept = words.filter(F.col("n") >= least)
    candidates = written(not_covered(scored(kept, phrases), phrases, cover).drop("key"), "phrases")
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    return first_of_each(candidates, first).join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


_AZ = "abcdefghijklmnopqrstuvwxyz"
SQL = rf"""
with p0 as (select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(translate(text, '{_AZ.upper()}', '{_AZ}'), '[.,;:!?\x0A-\x0D]')) as piece
    from documents where text is not null),
p1 as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as ws from p0),
o as (select lang, 1 as k, unnest(ws) as phrase from p1
    union all select lang, 2, unnest(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) from p1
    union all select lang, 3, unnest(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) from p1),
f as (select lang, k, phrase, count(*)::hugeint as n from o group by all),
t as (select lang, sum(n)::bigint as total from f where k = 1 group by lang),
c as (select *, string_split(phrase, ' ') as ws from f where k > 1 and n >= 10),
cuts as (select lang, c.k, phrase, ws, n as a, unnest(range(1, c.k)) as cut from c),
parts as (select *, array_to_string(ws[1:cut], ' ') as lp, array_to_string(ws[cut + 1:k], ' ') as rp from cuts),
s as (select p.*, x.n as l, y.n as r, (1000000::hugeint * p.a * p.a) // (x.n * y.n) as score from parts p
    join f x on x.lang = p.lang and x.phrase = p.lp and x.k = p.cut join f y on y.lang = p.lang and y.phrase = p.rp and y.k = p.k - p.cut),
b as (select * from s qualify row_number() over (partition by lang, phrase order by score, cut) = 1),
outer_ as (select lang, phrase, max(n) as most from (select lang, n, ws[1] || ' ' || ws[2] as phrase from c where k = 3
    union all select lang, n, ws[2] || ' ' || ws[3] from c where k = 3) group by all),
left_ as (select b.* from b left join outer_ o on o.lang = b.lang and o.phrase = b.phrase and b.k = 2 where o.most is null or 100 * o.most < 50 * b.a),
r as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from left_)
select lang, rank::bigint as rank, phrase, a::bigint as a, l::bigint as l, r::bigint as r, total as n, score::bigint as score
from r join t using (lang) where rank <= 2000
"""
