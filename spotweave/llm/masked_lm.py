"""LM scoring: masked pseudo-likelihood of a bidirectional window network trained in numpy.

Each word is hidden in turn and predicted from ``SIDE`` words on both sides; the sum of the
log-probabilities scores the document. The network adds a learned vector per neighbour and
place, squashes, and gives probabilities of word classes; a word's share in its class comes
from counts over all documents. Words outside the vocabulary come as hash buckets into the
network; their share in the bucket comes from the table of all counts, which stays in Spark
and is joined to the words of the documents. What a bucket has beyond its counted words, one
occurrence, is the share of words never counted.

Everything the model learns comes from the whole corpus: word counts of all documents, and
masked windows around every place of every document. Windows are dealt by document
into as many shards as the corpus needs, each shard trains a copy of the network in one
stream, and the copies are averaged, weighted by windows, in a tree; ``ROUNDS`` times. Only
the vocabulary's counts and one network reach the driver; both sizes are parameters.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from spotweave.llm.common import alnum, pick, raw, shingle_hashes, small_batches, written

SIDE, WIDTH, CLASSES, SINGLES = 2, 32, 64, 48
VOCABULARY, BUCKETS = 2048, 128
EVERY, SHARD_WINDOWS, ROUNDS = 1, 500_000, 2
RATE, BATCH, FAN_IN, SLOTS = 0.1, 2048, 64, 64
_COUNT_AT, _CHUNK, _UNIT, _GRAIN = 1 << 21, 1 << 15, 1 << 30, 1 << 16
_PLACES = [-2, -1, 1, 2]


def word_hashes(text: bytes) -> np.ndarray:
    return shingle_hashes(alnum(text), 1)[0]


@dataclass
class Vocabulary:
    """Ids: frequent words, then hash buckets of all others, then the pad. Classes by falling count."""

    hashes: np.ndarray  # ascending, of the frequent words
    ids: np.ndarray
    kinds: np.ndarray  # class of every id
    shares: np.ndarray  # log P(id | class)
    weights: np.ndarray  # log P(class)
    buckets: int
    masses: np.ndarray | None = None  # occurrences in every bucket, and one for words never counted
    _table: dict = field(default_factory=dict)

    @property
    def pad(self) -> int:
        return len(self.kinds)

    def lookup(self, h: np.ndarray) -> np.ndarray:
        out = (len(self.hashes) + h % np.uint64(self.buckets)).astype(np.int64)
        if len(self.hashes):
            if not self._table:
                flag = np.zeros(1 << 16, bool)
                flag[(self.hashes >> np.uint64(48)).astype(np.int64)] = True
                self._table["flag"] = flag
            maybe = np.flatnonzero(self._table["flag"][(h >> np.uint64(48)).astype(np.int64)])
            at = np.minimum(np.searchsorted(self.hashes, h[maybe]), len(self.hashes) - 1)
            sure = self.hashes[at] == h[maybe]
            out[maybe[sure]] = self.ids[at[sure]]
        return out


def count_words(docs: DataFrame) -> DataFrame:
    """(h, n): how often each word hash occurs in all texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def flush() -> pa.RecordBatch:
            h, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], ["h", "n"])

        for batch in batches:
            for text in raw(batch, "text"):
                held.append(word_hashes(text))
                size += len(held[-1])
            if size >= _COUNT_AT:
                yield flush()
                held, size = [], 0
        if size:
            yield flush()

    return docs.select("text").mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))


def build_vocabulary(counts: DataFrame, size: int = VOCABULARY, buckets: int = BUCKETS) -> tuple[Vocabulary, int]:
    """The vocabulary and the number of words; size + buckets rows reach the driver."""
    top = counts.orderBy(F.col("n").desc(), "h").limit(size).collect()
    # Bits 0-31 of the unsigned hash decide the bucket where buckets is a power of two.
    spread = {r["b"]: r["n"] for r in counts.groupBy(F.col("h").bitwiseAND(F.lit(buckets - 1)).alias("b")).agg(F.sum("n").alias("n")).collect()}
    h = np.array([r["h"] for r in top], np.int64).view(np.uint64)
    n = np.array([r["n"] for r in top], np.float64)
    rest = np.array([spread.get(b, 0) for b in range(buckets)], np.float64)
    if len(h):
        rest -= np.bincount((h % np.uint64(buckets)).astype(np.int64), n, buckets)
    mass = np.concatenate([n, rest]) + 1.0  # nothing has probability zero
    order = np.argsort(-mass, kind="stable")
    kinds = np.zeros(len(mass), np.int64)
    singles = order[:SINGLES]
    kinds[singles] = np.arange(len(singles))
    others = order[SINGLES:]
    if len(others):
        run = np.cumsum(mass[others])
        kinds[others] = SINGLES + np.minimum(((run - mass[others]) / run[-1] * (CLASSES - SINGLES)).astype(np.int64), CLASSES - SINGLES - 1)
    per_class = np.bincount(kinds, mass, CLASSES)
    up = np.argsort(h)
    weights = np.log(np.maximum(per_class, 1e-9) / per_class.sum())
    return Vocabulary(h[up], up.astype(np.int64), kinds, np.log(mass / per_class[kinds]), weights, buckets, rest + 1.0), int(sum(spread.values()))


class Net:
    """One vector per place and id, a hidden layer, class scores. ``flat`` is all weights in a row."""

    def __init__(self, ids: int, bias: np.ndarray, flat: np.ndarray | None = None, seed: int = 1):
        self.shapes = [(len(_PLACES) * (ids + 1), WIDTH), (WIDTH,), (WIDTH, CLASSES), (CLASSES,)]
        if flat is None:
            rng = np.random.default_rng(seed)
            flat = np.concatenate([rng.normal(0, 0.1, self.shapes[0]).ravel(), np.zeros(WIDTH), rng.normal(0, 0.1, self.shapes[2]).ravel(), bias])
        self.flat = flat.astype(np.float32)
        cuts = np.cumsum([math.prod(s) for s in self.shapes])[:-1]
        self.table, self.hidden, self.out, self.bias = (x.reshape(s) for x, s in zip(np.split(self.flat, cuts), self.shapes))
        self.rows = np.arange(len(_PLACES)) * (ids + 1)

    def scores(self, context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hidden values and scores of the classes, shifted by row so that none exceeds 0."""
        h = self.table.take(context[:, 0] + self.rows[0], axis=0)
        for k in range(1, len(_PLACES)):
            h += self.table.take(context[:, k] + self.rows[k], axis=0)
        h += self.hidden
        np.tanh(h, out=h)
        s = h @ self.out
        reach = np.abs(self.out).sum(axis=0)  # hidden values are 1 at most
        top = (self.bias + reach).max()
        if top - (self.bias - reach).min() < 60:
            s += self.bias - top
        else:
            s += self.bias
            s -= s.max(axis=1, keepdims=True)
        return h, s

    def forward(self, context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hidden values and log-probabilities of the classes, for rows of neighbour ids."""
        h, s = self.scores(context)
        s -= np.log(np.exp(s) @ np.ones(s.shape[1], s.dtype))[:, None]
        return h, s

    def chosen(self, context: np.ndarray, kinds: np.ndarray) -> np.ndarray:
        """Log-probability of one class per row."""
        s = self.scores(context)[1]
        got = s[np.arange(len(kinds)), kinds]
        return got - np.log(np.exp(s, out=s) @ np.ones(s.shape[1], s.dtype))

    def gradients(self, context: np.ndarray, kinds: np.ndarray) -> tuple[float, list]:
        """Mean loss, and gradients: (rows, values) of the table, then the other weights."""
        h, s = self.scores(context)
        n = len(kinds)
        own = s[np.arange(n), kinds]
        d = np.exp(s, out=s)
        total = d @ np.ones(d.shape[1], d.dtype)
        loss = -float((own - np.log(total)).mean())
        total *= n
        d /= total[:, None]
        d[np.arange(n), kinds] -= d.dtype.type(1 / n)
        dz = d @ self.out.T
        dz *= 1 - h * h
        at = (context + self.rows).T.reshape(-1)
        if len(self.table) <= 1 << 16:
            at = at.astype(np.uint16)  # sorted by digits
        order = np.argsort(at, kind="stable")
        at = at[order]
        first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        values = np.add.reduceat(dz.take(order % n, axis=0), first, axis=0)
        return loss, [(at[first].astype(np.int64), values), dz.sum(axis=0), h.T @ d, d.sum(axis=0)]

    def learn(self, context: np.ndarray, kinds: np.ndarray, seen: list[np.ndarray], rate: float) -> float:
        """One Adagrad step; ``seen`` holds the sums of squares."""
        loss, ((rows, g), *rest) = self.gradients(context, kinds)
        a = seen[0].take(rows, axis=0)
        a += g * g
        seen[0][rows] = a
        g *= rate
        g /= np.sqrt(a, out=a)
        self.table[rows] -= g
        for w, g, a in zip((self.hidden, self.out, self.bias), rest, seen[1:]):
            a += g * g
            w -= rate * g / np.sqrt(a)
        return loss

    def fresh(self) -> list[np.ndarray]:
        return [np.full(s, 1e-6, np.float32) for s in self.shapes]


def padded(ids: np.ndarray, pad: int) -> np.ndarray:
    side = np.full(SIDE, pad, np.int64)
    return np.concatenate([side, ids, side])


def masked_windows(docs: DataFrame, words: Vocabulary, shards: int, every: int) -> DataFrame:
    """(shard, key, ids): the ids of a piece of a document and ``SIDE`` more at both ends; its first and each further ``every``-th place is hidden."""
    shared = docs.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = shared.value
        for batch in batches:
            shard, key, found = [], [], []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), raw(batch, "text")):
                h = word_hashes(text)
                if not len(h):
                    continue
                ids = padded(v.lookup(h), v.pad)
                own = int(np.bitwise_xor.reduce(h * np.uint64(0x9E3779B97F4A7C15)))
                step = SHARD_WINDOWS // 8 * every
                for at in range(own % every, len(h), step):  # a very long text goes to many shards
                    k = hash((doc_id, own, at)) & (1 << 62) - 1
                    shard.append(k % shards)
                    key.append(k)
                    found.append(ids[at:min(at + step, len(h)) + 2 * SIDE].astype("<u2").tobytes())
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(shard, pa.int64()), pa.array(key, pa.int64()), pa.array(found, pa.binary())],
                                                 ["shard", "key", "ids"])

    return docs.mapInArrow(run, "shard long, key long, ids binary")


def _parts(flat: np.ndarray, shard: int, n: float) -> pa.RecordBatch:
    cuts = np.array_split(flat, SLOTS)
    return pa.RecordBatch.from_arrays([pa.array([shard] * SLOTS, pa.int64()), pa.array(range(SLOTS), pa.int32()), pa.array([float(n)] * SLOTS),
                                       pa.array([c.tobytes() for c in cuts], pa.binary())], ["shard", "slot", "n", "w"])


def train_shards(windows: DataFrame, words: Vocabulary, net: Net, rate: float, every: int) -> DataFrame:
    """(shard, slot, n, w): each shard's network after one stream over its windows, times its windows, in pieces.

    A task adds up the networks of its shards and names the sum by the first, so that one network a task is shuffled. What it
    adds are whole parts of 1 / ``_GRAIN``, so that the order of adding doesn't matter.
    """
    shared = windows.sparkSession.sparkContext.broadcast((words, net.flat))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, flat = shared.value
        offsets = np.array([*_PLACES, 0]) + SIDE
        shard, own, seen, held, n, waiting = None, None, None, [], 0, 0
        first, count, total = None, 0, np.zeros(len(flat))

        def step(x: np.ndarray) -> None:
            own.learn(x[:-1].T, v.kinds[x[-1]], seen, rate)

        def drain(all_of_it: bool) -> None:
            nonlocal held
            x = np.concatenate(held, axis=1) if held else np.zeros((len(_PLACES) + 1, 0), np.int64)
            size = x.shape[1]
            stop = size if all_of_it else size // BATCH * BATCH
            for a in range(0, stop, BATCH):
                step(x[:, a:min(a + BATCH, stop)])
            held = [x[:, stop:]] if stop < size else []

        def finish() -> None:
            nonlocal count, total
            drain(True)
            count += n
            total += np.round(own.flat.astype(np.float64) * (n * _GRAIN)) / _GRAIN

        for batch in batches:
            for s, w in zip(batch.column("shard").to_pylist(), batch.column("ids").to_pylist()):
                if s != shard:
                    if shard is not None:
                        finish()
                    first = s if first is None else first
                    shard, own, n, held = s, Net(v.pad, v.weights, flat.copy()), 0, []
                    seen = own.fresh()
                ids = np.frombuffer(w, "<u2").astype(np.int64)
                x = ids[np.arange(0, len(ids) - 2 * SIDE, every) + offsets[:, None]]
                held.append(x)
                n += x.shape[1]
                waiting += x.shape[1]
                if waiting >= _CHUNK:  # a batch of long texts is not held whole
                    drain(False)
                    waiting = 0
            if shard is not None:
                drain(False)
        if shard is not None:
            finish()
            yield _parts(total, first, count)

    dealt = windows.repartition("shard").sortWithinPartitions("shard", "key")
    return dealt.mapInArrow(run, "shard long, slot int, n double, w binary")


def averaged(parts: DataFrame, shards: int) -> np.ndarray | None:
    """The weighted mean of all shards' networks: sums of at most FAN_IN pieces per group, level by level."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, n, total = None, 0.0, None

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([key[1]], pa.int64()), pa.array([key[0]], pa.int32()), pa.array([n]),
                                               pa.array([total.tobytes()], pa.binary())], ["shard", "slot", "n", "w"])

        for batch in batches:
            for slot, up, m, w in zip(*(batch.column(c).to_pylist() for c in ("slot", "up", "n", "w"))):
                x = np.frombuffer(w, np.float64)
                if (slot, up) != key:
                    if key:
                        yield out()
                    key, n, total = (slot, up), 0.0, np.zeros(len(x))
                n, total = n + m, total + x
        if key:
            yield out()

    while True:
        shards = -(-shards // FAN_IN)
        parts = parts.withColumn("up", F.floor(F.col("shard") / FAN_IN)).repartition("slot", "up").sortWithinPartitions(
            "slot", "up", "shard").mapInArrow(run, "shard long, slot int, n double, w binary")
        if shards <= 1:
            break
    rows = sorted(parts.collect(), key=lambda r: r["slot"])  # one network
    return np.concatenate([np.frombuffer(bytes(r["w"]), np.float64) / r["n"] for r in rows]) if rows else None


@dataclass
class Model:
    words: Vocabulary
    flat: np.ndarray
    counts: DataFrame | None = None  # (h, n) of all words; without it words outside the vocabulary are unknown


def train(documents: DataFrame, size: int = VOCABULARY, every: int = EVERY, rounds: int = ROUNDS, rate: float = RATE) -> Model:
    """Counts and windows of all documents, then ``rounds`` of shard training and averaging. Without words: the starting weights."""
    small_batches(documents.sparkSession)
    docs = pick(documents, doc_id="long", text="string")
    counts = written(count_words(docs), "lm")
    words, total = build_vocabulary(counts, size)
    net = Net(words.pad, words.weights)
    shards = max(1, math.ceil(total / every / SHARD_WINDOWS))
    windows = written(masked_windows(docs, words, shards, every), "lm")
    for r in range(rounds):
        flat = averaged(train_shards(windows, words, net, rate / (1 + r), every), shards)
        if flat is not None:
            net = Net(words.pad, words.weights, flat)
    return Model(words, net.flat, counts)


def text_scores(model: Model, texts: list[bytes]) -> tuple[list[int], list[float]]:
    """Words of each text and the sum of their conditional log-probabilities, a word outside the vocabulary as its bucket."""
    sizes, sums = id_scores(model, [model.words.lookup(word_hashes(t)) for t in texts])
    return sizes.tolist(), sums.tolist()


def id_scores(model: Model, ids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """``text_scores`` from the ids of the texts' words, all texts of a batch at once."""
    v, net = model.words, Net(model.words.pad, model.words.weights, model.flat)
    sizes = np.array([len(x) for x in ids])
    sums = np.zeros(len(ids))
    if sizes.sum():
        # Texts follow each other with pads between, so no window reaches into another text.
        line = np.concatenate([padded(x, v.pad) for x in ids])
        owner = np.repeat(np.arange(len(ids)), sizes)
        places = np.arange(sizes.sum()) + SIDE * (2 * owner + 1)
        offsets = np.array(_PLACES)
        for a in range(0, len(places), _CHUNK):
            p = places[a:a + _CHUNK]
            hidden = line[p]
            got = np.concatenate([net.chosen(line[p[b:b + BATCH] + offsets[:, None]].T, v.kinds[hidden[b:b + BATCH]]) for b in range(0, len(p), BATCH)])
            got = got.astype(np.float64) + v.shares[hidden]
            sums += np.bincount(owner[a:a + _CHUNK], got, len(ids))
    return sizes, sums


def score(documents: DataFrame, model: Model) -> DataFrame:
    """(doc_id, n_words, log_likelihood, mean_log_likelihood) of every document row.

    Words are runs of letters and digits, A-Z lower. A null or empty text has no words, sum 0
    and a null mean. Repeated rows are scored each; a null doc_id stays null; other columns
    are ignored; an empty table gives no rows. Texts are read whole.
    """
    small_batches(documents.sparkSession)
    shared = documents.sparkSession.sparkContext.broadcast(Model(model.words, model.flat))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = shared.value.words
        spread = np.log(v.masses)
        for batch in batches:
            if not batch.num_rows:
                continue
            hashes = [word_hashes(t) for t in raw(batch, "text")]
            ids = [v.lookup(h) for h in hashes]
            n, sums = id_scores(shared.value, ids)
            rare, times = [], []
            for i, (h, x) in enumerate(zip(hashes, ids)):
                own = x >= len(v.hashes)
                sums[i] -= spread[x[own] - len(v.hashes)].sum()
                found, many = np.unique(h[own], return_counts=True)
                rare.append(found.view(np.int64))
                times.append(many)
            cuts = pa.array(np.concatenate([[0], np.cumsum([len(x) for x in rare])]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(sums),
                 pa.ListArray.from_arrays(cuts, pa.array(np.concatenate(rare), pa.int64())),
                 pa.ListArray.from_arrays(cuts, pa.array(np.concatenate(times), pa.int32()))],
                ["row", "doc_id", "n_words", "total", "rare", "times"])

    rows = pick(documents, doc_id="long", text="string").withColumn("row", F.monotonically_increasing_id())
    held = written(rows.mapInArrow(
        run, "row long, doc_id long, n_words long, total double, rare array<long>, times array<int>"), "lm")
    found = held.select("row", "doc_id", "n_words", "total")
    if model.counts is None:
        total = F.col("total")
    else:
        # log n of a word counted once, or never, is 0. Whole numbers, so that the order of adding doesn't matter.
        counted = model.counts.filter("n > 1").select("h", F.round(F.log("n") * _UNIT).cast("long").alias("log_n"))
        words = held.select("row", F.inline(F.arrays_zip(F.col("rare").alias("h"), F.col("times").alias("k"))))
        own = words.join(counted, "h").groupBy("row").agg(F.sum(F.col("k") * F.col("log_n")).alias("own"))
        found = found.join(own, "row", "left")
        total = F.col("total") + F.coalesce("own", F.lit(0)) / _UNIT
    return found.select("doc_id", "n_words", F.round(total, 3).alias("log_likelihood"),
                        F.when(F.col("n_words") > 0, F.round(total / F.col("n_words"), 5)).alias("mean_log_likelihood"))
