"""Hard-negative mining with anchor spanning-tree bounds.

Anchors are a stated query set; they go out in blocks of at most ``BLOCK`` to a pass over all
rows. The anchors of a block are joined by a minimum spanning tree. A tile of rows is scored
exactly at the root; along an edge of length e a row of norm v scores within e * v of its
parent score, so bounds go down the tree (an exact score starts them again), and only rows
whose bounds meet an anchor's window are scored again. The window of the first pass is open
above the worst of the nearest positives so far, that of the second lies between the two
shares of a positive's score, its lower end raised by the negatives found so far.

A task holds one tile and, per anchor, a list of fixed length, so copies of one vector cost
nothing more. Bounds prune where anchors lie near each other; scores are whole numbers, so
the result does not depend on what was pruned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from spotweave.llm.common import pick, scratch, small_batches, written

BLOCK, TILE, TASK_ROWS = 2048, 4096, 16_384
POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90  # percent of the positive's score
SCALE, LIMIT = 256, 1 << 22  # components beyond the limit take no part
ROW_SCHEMA = "row long, vec_id long, label long, q binary, norm double, signs long"
RESULT_SCHEMA = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def quantised(rows: DataFrame) -> DataFrame:
    """The rows that take part: q is floor(256 x) as little-endian 32-bit integers, signs those of its first 16 components."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("embedding")
            offsets = np.asarray(vectors.offsets)
            flat = vectors.values
            values = flat.to_numpy(zero_copy_only=False).astype(np.float64)
            with np.errstate(invalid="ignore", over="ignore"):
                q = np.floor(values * SCALE)
            good = np.isfinite(values) & (np.abs(q) < LIMIT)
            bad = np.concatenate([[0], np.cumsum(~good)])
            keep = np.flatnonzero((bad[offsets[1:]] == bad[offsets[:-1]]) & np.asarray(vectors.is_valid()))
            q = np.where(good, q, 0).astype("<i4")
            squares = np.concatenate([[0.0], np.cumsum(q.astype(np.float64) ** 2)])
            out = [q[offsets[i]:offsets[i + 1]].tobytes() for i in keep]
            norms = np.sqrt(np.array([float(squares[offsets[i + 1]] - squares[offsets[i]]) for i in keep]))
            signs = [int.from_bytes(np.packbits(q[offsets[i]:min(offsets[i] + 16, offsets[i + 1])] > 0).tobytes(), "big") for i in keep]
            take = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([*[batch.column(n).take(take) for n in ("row", "vec_id", "label")], pa.array(out, pa.binary()),
                                              pa.array(norms, pa.float64()), pa.array(signs, pa.int64())],
                                             ["row", "vec_id", "label", "q", "norm", "signs"])

    small_batches(rows.sparkSession)
    return rows.mapInArrow(run, ROW_SCHEMA)


def matrix(q: list[bytes], dims: int) -> np.ndarray:
    """Rows of components; a shorter vector ends in zeros."""
    if dims and all(len(x) == 4 * dims for x in q):
        return np.frombuffer(b"".join(q), "<i4").reshape(len(q), dims).astype(np.float64)
    out = np.zeros((len(q), dims))
    for i, x in enumerate(q):
        out[i, :len(x) // 4] = np.frombuffer(x, "<i4")
    return out


def spanning_tree(points: np.ndarray) -> list[tuple[int, int, float]]:
    """(node, parent, edge length) of a minimum spanning tree in an order that puts parents first; the root's parent is -1."""
    n = len(points)
    best, parent = np.full(n, np.inf), np.full(n, -1)
    open_ = np.ones(n, bool)
    best[0] = 0.0
    out = []
    for _ in range(n):
        node = int(np.argmin(np.where(open_, best, np.inf)))
        out.append((node, int(parent[node]), float(best[node]) if parent[node] >= 0 else 0.0))
        open_[node] = False
        away = np.sqrt(((points - points[node]) ** 2).sum(axis=1))
        nearer = open_ & (away < best)
        best[nearer], parent[nearer] = away[nearer], node
    return out


def bounded_scores(tile: np.ndarray, norms: np.ndarray, anchors: np.ndarray, tree: list[tuple[int, int, float]], windows):
    """Yields (anchor, places, scores) of the tile's rows that may lie in the anchor's window.

    ``windows(anchor)`` gives the lowest and the highest wanted score, or None. A row left out
    lies outside for certain; the slack covers the rounding of lengths.
    """
    exact = all(np.abs(x).max(initial=0) < 1 << 20 for x in (tile, anchors)) and tile.shape[1] < 1 << 12
    whole = tile if exact else tile.astype(np.int64)
    points = anchors if exact else anchors.astype(np.int64)
    held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    children = np.bincount([p for _, p, _ in tree if p >= 0], minlength=len(anchors))
    for node, parent, edge in tree:
        if parent < 0:
            score = whole @ points[node]
            low = high = score.astype(np.float64)
            window = windows(node)
            at = np.flatnonzero((score >= window[0]) & (score <= window[1])) if window else np.zeros(0, np.int64)
            found = score[at]
        else:
            low, high = held[parent]
            reach = edge * norms * (1 + 1e-6) + 1e-3
            low, high = low - reach, high + reach
            children[parent] -= 1
            if not children[parent]:
                del held[parent]
            window = windows(node)
            at = np.flatnonzero((high >= window[0]) & (low <= window[1])) if window else np.zeros(0, np.int64)
            found = (whole if len(at) == len(whole) else whole[at]) @ points[node]
            low[at] = high[at] = found
        if children[node]:
            held[node] = (low, high)
        if len(at):
            yield node, at, found.astype(np.int64)


class Best:
    """The first ``size`` of the rows seen: higher score, then smaller vec_id, then smaller row."""

    def __init__(self, size: int):
        self.size = size
        self.kept = np.zeros((0, 3), np.int64)  # score, vec_id, row

    def add(self, score: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        if len(score) > self.size:  # rows below the size-th highest score can't stay
            least = np.partition(score, len(score) - self.size)[len(score) - self.size]
            at = np.flatnonzero(score >= least)
            score, ids, rows = score[at], ids[at], rows[at]
        both = np.concatenate([self.kept, np.stack([score, ids, rows], axis=1)])
        self.kept = both[np.lexsort((both[:, 2], both[:, 1], -both[:, 0]))[:self.size]]

    @property
    def least(self) -> float:
        return float(self.kept[-1, 0]) if len(self.kept) == self.size else -np.inf


def _tiles(batches: Iterator[pa.RecordBatch], dims: int):
    held: list[list] = [[], [], [], [], []]
    for batch in batches:
        for store, name in zip(held, ("row", "vec_id", "label", "q", "norm")):
            store += batch.column(name).to_pylist()
        while len(held[0]) >= TILE:
            yield *map(np.array, (x[:TILE] for x in held[:3])), matrix(held[3][:TILE], dims), np.array(held[4][:TILE])
            held = [x[TILE:] for x in held]
    if held[0]:
        yield *map(np.array, held[:3]), matrix(held[3], dims), np.array(held[4])


def nearest_positives(rows: DataFrame, block, dims: int, size: int) -> DataFrame:
    """Per task and anchor of the block its best other rows of the same label: anchor, score, vec_id, row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, label, points, tree = block.value
        best = [Best(size) for _ in row]
        for r, ids, labels, tile, norms in _tiles(batches, dims):
            for a, at, score in bounded_scores(tile, norms, points, tree, lambda a: (best[a].least, np.inf)):
                at, score = (x[(labels[at] == label[a]) & (r[at] != row[a]) & (score >= best[a].least)] for x in (at, score))
                if len(at):
                    best[a].add(score, ids[at], r[at])
        for a, b in enumerate(best):
            if len(b.kept):
                yield pa.RecordBatch.from_arrays([pa.array([a] * len(b.kept), pa.int32()), *[pa.array(b.kept[:, k]) for k in range(3)]],
                                                 ["anchor", "score", "vec_id", "row"])

    return rows.mapInArrow(run, "anchor int, score long, vec_id long, row long")


def window_negatives(rows: DataFrame, block, dims: int, size: int, low: int, high: int) -> DataFrame:
    """Per task, anchor and positive its best rows of another label within the positive's window."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        label, points, tree, positives = block.value
        # Whole scores between the two shares of a positive's score: rounded up, rounded down.
        spans = [[(-(-low * s // 100), high * s // 100) for s in p] for p in positives]
        best = [[Best(size) for _ in p] for p in positives]

        def window(a: int):
            ends = [(max(lo, b.least), hi) for (lo, hi), b in zip(spans[a], best[a]) if lo <= hi]
            return (min(e[0] for e in ends), max(e[1] for e in ends)) if ends else None

        for r, ids, labels, tile, norms in _tiles(batches, dims):
            for a, at, score in bounded_scores(tile, norms, points, tree, window):
                at, score = (x[labels[at] != label[a]] for x in (at, score))
                for (lo, hi), b in zip(spans[a], best[a]):
                    ok = np.flatnonzero((score >= max(lo, b.least)) & (score <= hi))
                    if len(ok):
                        b.add(score[ok], ids[at[ok]], r[at[ok]])
        for a, p in enumerate(best):
            for k, b in enumerate(p):
                if len(b.kept):
                    n = len(b.kept)
                    yield pa.RecordBatch.from_arrays([pa.array([a] * n, pa.int32()), pa.array([k] * n, pa.int32()),
                                                      *[pa.array(b.kept[:, j]) for j in range(3)]], ["anchor", "positive", "score", "vec_id", "row"])

    return rows.mapInArrow(run, "anchor int, positive int, score long, vec_id long, row long")


def placed(anchors: DataFrame) -> DataFrame:
    """Gapless places from 0: anchors of one label and like signs stand together, so a block's tree has short edges."""
    order = ["label", "signs", "row"]
    dealt = written(anchors.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("at")), "anchors")
    earlier = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)  # one row per partition
    offsets = dealt.groupBy("part").count().select("part", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("offset"))
    return dealt.join(offsets, "part").withColumn("place", F.col("offset") + F.col("at")).drop("part", "at", "offset")


def _first(found: DataFrame, size: int, *keys: str) -> DataFrame:
    order = W.partitionBy(*keys).orderBy(F.col("score").desc(), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= size)


def mine(embeddings: DataFrame, anchors: Column | None = None, label: Column | None = None, positives: int = POSITIVES,
         negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score of every anchor and positive.

    ``anchors`` says which rows are anchors (default: vec_id divisible by 100), ``label`` what
    a row's label is (default: its own). Rows with a null vec_id, label or vector take no part,
    nor do rows with a null, non-finite or beyond 2^22 / 256 sized component. Vectors of unequal length
    are compared as if the shorter one ended in zeros. Repeated rows are rows of their own:
    each may be anchor, positive and negative. Ties go to the smaller vec_id, then to the row
    read first. Without anchors, or in an empty table, there are no rows. Other columns are ignored.
    """
    spark = embeddings.sparkSession
    plain = pick(embeddings, vec_id="long", embedding="array<double>", label="long")
    plain = plain.filter(F.col("vec_id").isNotNull()).withColumn("label", F.col("label") if label is None else label)
    plain = plain.filter("label is not null and embedding is not null").withColumn("row", F.monotonically_increasing_id())
    held = written(quantised(plain), "vectors")
    size = held.agg(F.count(F.lit(1)), F.max(F.length("q")), F.max("norm")).first()
    n, dims = size[0], (size[1] or 0) // 4
    chosen = held.filter(F.col("vec_id") % 100 == 0 if anchors is None else anchors)
    dealt = placed(chosen.select("row", "vec_id", "label", "q", "signs"))
    last = dealt.agg(F.max("place")).first()[0]
    folder = scratch(spark, "negatives")
    spark.createDataFrame([], RESULT_SCHEMA).write.parquet(folder)
    rows = held.coalesce(max(1, -(-n // TASK_ROWS)))
    small_batches(spark)
    for first in range(0, -1 if last is None else last + 1, BLOCK):
        members = dealt.filter(F.col("place").between(first, first + BLOCK - 1)).orderBy("place").collect()
        points = matrix([bytes(r["q"]) for r in members], dims)
        tree = spanning_tree(points)
        row, labels = [r["row"] for r in members], [r["label"] for r in members]
        shared = spark.sparkContext.broadcast((row, labels, points, tree))  # BLOCK anchors at most
        found = _first(nearest_positives(rows, shared, dims, positives), positives, "anchor").orderBy("anchor", "rank").collect()
        near: list[list] = [[] for _ in members]
        for r in found:
            near[r["anchor"]].append(r)
        named = [(a, k, members[a]["vec_id"], p["vec_id"], p["score"]) for a, ps in enumerate(near) for k, p in enumerate(ps)]
        names = spark.createDataFrame(named, "anchor int, positive int, anchor_id long, positive_id long, positive_score long")
        second = spark.sparkContext.broadcast((labels, points, tree, [[p["score"] for p in ps] for ps in near]))
        best = _first(window_negatives(rows, second, dims, negatives, low, high), negatives, "anchor", "positive")
        best.join(names, ["anchor", "positive"]).select(
            "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), "positive_score",
            F.col("score").alias("negative_score")).write.mode("append").parquet(folder)
    return spark.read.schema(RESULT_SCHEMA).parquet(folder)


def shifted_labels() -> Column:
    """Label noise: where vec_id is divisible by 7 the label is the next of ten."""
    return F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))


SQL = """
with v0 as (select row_number() over () as r, vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * x::double)) as q from embeddings
    where vec_id is not null and label is not null and embedding is not null
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x) or abs(floor(256 * x::double)) >= 4194304)) = 0),
s as (select a.r as ar, a.vec_id as anchor_id, b.r as br, b.vec_id, a.label = b.label as same, list_inner_product(a.q, b.q)::bigint as score
    from v0 a join v0 b on a.vec_id % 100 = 0 and a.r <> b.r),
p as (select * from s where same qualify row_number() over (partition by ar order by score desc, vec_id, br) <= 5),
n as (select p.ar, p.anchor_id, p.br as pr, p.vec_id as positive_id, p.score as positive_score, s.vec_id as negative_id, s.score as negative_score,
    row_number() over (partition by p.ar, p.br order by s.score desc, s.vec_id, s.br) as rank
    from p join s on s.ar = p.ar and not s.same and 30 * p.score <= 100 * s.score and 100 * s.score <= 90 * p.score)
select anchor_id, positive_id, rank::int as rank, negative_id, positive_score, negative_score from n where rank <= 10
"""
