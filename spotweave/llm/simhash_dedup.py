"""SimHash near-dedup: 64-bit fingerprints, shard trees keyed by Hamming distance, components.

Fingerprints within ``radius`` bits agree on at least ``blocks - radius`` of ``blocks`` bit
blocks, so every linked pair meets in a shard keyed by such a choice of blocks: no pair is
lost and no shard sees another's rows. In a shard a BK-tree (children keyed by their integer
Hamming distance to the parent) is searched by all members, following only edges within
the radius. A tree can't be sent to all executors, as all trees together hold the
fingerprints of all documents; it goes, by shuffle, to the tasks of its own shard only.
Shards above ``tile_rows`` members are split into tiles and every pair of tiles is searched.
A task returns a star per local component, never all pairs.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from spotweave.llm.common import map_batches, packed, pick, raw, small_batches, unpacked, written
from spotweave.operators.components import connected_components

SEED, BITS, SHINGLE = 42, 64, 3
TILE_ROWS = 20_000
_CHUNK = 1 << 16


def fingerprint(text: bytes) -> int:
    """Bits set in over half of the hashes of all 3-word shingles, repeats included; 0 without words."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= SHINGLE:
        return xxhash.xxh64_intdigest(joined, SEED)
    gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 0x20)
    starts = [0, *(gaps[:len(gaps) - SHINGLE + 1] + 1).tolist()]
    ends = [*gaps[SHINGLE - 1:].tolist(), len(joined)]
    counts = np.zeros(BITS, np.int64)
    n = len(starts)
    for at in range(0, n, _CHUNK):  # a very long text is counted in pieces
        h = np.fromiter((xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in zip(
            starts[at:at + _CHUNK], ends[at:at + _CHUNK])), "<u8")
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(rows: DataFrame) -> DataFrame:
    """The rows with ``fp``, the fingerprint of ``text`` as a signed long, in place of the text."""
    kept = [c for c in rows.columns if c != "text"]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        fp = np.array([fingerprint(t) for t in raw(batch, "text")], np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(fp)], [*kept, "fp"])

    return map_batches(rows, run, ", ".join(f"{n} {t}" for n, t in rows.dtypes if n != "text") + ", fp long")


class BKTree:
    """Children of a node keyed by their integer Hamming distance to it."""

    def __init__(self, points: list[int]):
        self.points = points
        self.children: list[dict[int, int]] = [{} for _ in points]
        for i in range(1, len(points)):
            at = 0
            while True:
                d = (points[i] ^ points[at]).bit_count()
                if (down := self.children[at].get(d)) is None:
                    self.children[at][d] = i
                    break
                at = down

    def search(self, queries: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray]]:
        """(node, indexes of the queries within the radius), for all queries at once."""
        stack = [(0, np.arange(len(queries)))] if self.points else []
        while stack:
            node, who = stack.pop()
            d = np.bitwise_count(queries[who] ^ np.uint64(self.points[node])).astype(np.int64)
            if len(near := who[d <= radius]):
                yield node, near
            for edge, child in self.children[node].items():
                if len(down := who[np.abs(d - edge) <= radius]):
                    stack.append((child, down))


def stars(points: np.ndarray, queries: np.ndarray | None, radius: int) -> list[tuple[int, int]]:
    """Edges that join each local component to one member. ``queries`` None: the points themselves."""
    own = queries is None
    if own and len(points) <= 8:  # the usual shard: few members, compared in place
        p = points.tolist()
        return [(p[j], p[i]) for i in range(len(p)) for j in range(i + 1, len(p)) if (p[i] ^ p[j]).bit_count() <= radius]
    everyone = points if own else np.concatenate([points, queries])
    label = np.arange(len(everyone))
    base = 0 if own else len(points)
    for node, near in BKTree(points.tolist()).search(points if own else queries, radius):
        found = label[near + base]
        for other in np.unique(found[found != label[node]]):
            label[label == other] = label[node]
    out = np.flatnonzero(label != np.arange(len(everyone)))
    return list(zip(everyone[out].tolist(), everyone[label[out]].tolist()))


def _block(fp: Column, i: int, blocks: int) -> Column:
    low, high = i * BITS // blocks, (i + 1) * BITS // blocks
    return F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << (high - low)) - 1))


def shard_rows(distinct: DataFrame, radius: int, blocks: int, tile_rows: int) -> DataFrame:
    """(shard, key, a, b, tile, fp): every fingerprint in each of its shards, in each pair of tiles it is part of."""
    choices = list(itertools.combinations(range(blocks), blocks - radius))
    key = F.array(*[F.struct(F.lit(s).alias("shard"), F.xxhash64(*[_block(F.col("fp"), i, blocks) for i in c]).alias("key"))
                    for s, c in enumerate(choices)])
    rows = distinct.select("fp", F.inline(key))
    hot = rows.groupBy("shard", "key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > tile_rows)
    tiles = hot.select("shard", "key", F.ceil(F.col("n") / tile_rows).cast("int").alias("tiles"))
    rows = rows.join(tiles, ["shard", "key"], "left").withColumn(
        "tile", F.when(F.col("tiles").isNotNull(), F.pmod(F.xxhash64("fp"), F.col("tiles"))).otherwise(0).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("tiles"), F.lit(1)) - 1))
    return rows.select("shard", "key", "tile", "fp", other.alias("other")).select(
        "shard", "key", F.least("tile", "other").alias("a"), F.greatest("tile", "other").alias("b"), "tile", "fp")


def shard_links(rows: DataFrame, radius: int) -> DataFrame:
    """(src, dst) links found in the shards, a star per local component."""
    group = ["shard", "key", "a", "b"]
    small_batches(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []  # of the group that may go on in the next batch
        last = None

        def close(part: np.ndarray) -> list[tuple[int, int]]:
            a, b, tile, fp = part[:, 2], part[:, 3], part[:, 4], part[:, 5].view(np.uint64)
            if len(part) < 2:
                return []
            if a[0] == b[0]:
                return stars(np.unique(fp), None, radius)
            first = tile == a[0]
            return stars(np.unique(fp[first]), np.unique(fp[~first]), radius)

        for batch in itertools.chain(batches, [None]):
            links: list[tuple[int, int]] = []
            if batch is None:
                links = close(np.concatenate(held)) if held else []
            elif batch.num_rows:
                x = np.stack([batch.column(n).cast(pa.int64()).to_numpy() for n in (*group, "tile", "fp")], axis=1)
                cut = np.flatnonzero((x[1:, :4] != x[:-1, :4]).any(axis=1)) + 1
                bounds = [0, *cut.tolist(), len(x)]
                if held and (x[0, :4] != last).any():
                    links += close(np.concatenate(held))
                    held = []
                for p, q in zip(bounds[:-1], bounds[1:]):
                    if q == len(x):
                        held.append(x[p:q])
                    elif p == 0 and held:
                        links += close(np.concatenate([*held, x[p:q]]))
                        held = []
                    elif q - p > 1:
                        links += close(x[p:q])
                last = x[-1, :4]
            if links:
                pairs = np.array(links, np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["src", "dst"])

    dealt = rows.repartition(*group).sortWithinPartitions(*group)
    return dealt.mapInArrow(run, "src long, dst long").distinct()


def component_names(prints: DataFrame, radius: int, blocks: int | None, tile_rows: int) -> DataFrame:
    """(fp, component, component_id) of every fingerprint of (doc_id, fp): the component and its smallest doc_id."""
    distinct = written(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash")
    if blocks is None:
        n = distinct.count()
        blocks = radius + 1 + (n > 1 << 24) + (n > 1 << 30)
    links = written(shard_links(shard_rows(distinct.select("fp"), radius, blocks, tile_rows), radius), "simhash")
    if links.isEmpty():
        return distinct.select("fp", F.col("fp").alias("component"), F.col("first_id").alias("component_id"))
    ends = links.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
    groups = connected_components(ends, links).select(F.col("id").alias("fp"), "component")
    placed = distinct.join(groups, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    names = placed.groupBy("component").agg(F.min("first_id").alias("component_id"))
    return placed.join(names, "component").select("fp", "component", "component_id")


def near_duplicates(documents: DataFrame, radius: int = 3, blocks: int | None = None,
                    tile_rows: int = TILE_ROWS) -> DataFrame:
    """(doc_id, fp, component_id): component_id is the smallest doc_id reachable over links.

    Null and empty texts have fingerprint 0 and are linked like any other. Repeated rows
    stay rows, and share a component. A null doc_id never names a component unless no other
    id is in it. Other columns are ignored; an empty table gives no rows. ``blocks`` only sets
    the shards' size, never the result: radius + 1 up to 2**24 different fingerprints, then more.
    """
    held = written(fingerprints(pick(documents, doc_id="long", text="string")), "simhash")
    named = component_names(held, radius, blocks, tile_rows)
    return held.join(named, "fp").select("doc_id", "fp", "component_id")


def deduplicated(documents: DataFrame, radius: int = 3, blocks: int | None = None, tile_rows: int = TILE_ROWS) -> DataFrame:
    """One document row of each component, that of the smallest doc_id (null last); all columns kept.

    Of repeated rows one stays. Odd cases as in ``near_duplicates``.
    """
    rows = packed(documents, doc_id="long", text="string").withColumn("row", F.monotonically_increasing_id())
    held = written(rows, "simhash")  # the row numbers are read back, never made twice
    prints = written(fingerprints(held.select("row", "doc_id", "text")), "simhash")
    named = component_names(prints, radius, blocks, tile_rows)
    rank = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row")
    best = prints.groupBy("fp").agg(F.min(rank).alias("best")).join(named, "fp").groupBy("component").agg(
        F.min("best").alias("best")).select(F.col("best.row").alias("row"))
    return unpacked(held.join(best, "row", "left_semi"), documents)


def as_hex(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
