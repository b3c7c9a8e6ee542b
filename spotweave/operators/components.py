"""Connected components by repeated contraction, with reliable checkpoints."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from spotweave.functions.runtime import durable


# Edges that a task holds and contracts at once.
BLOCK_EDGES = 200_000


def connected_components(vertices: DataFrame, edges: DataFrame, max_rounds: int = 60, block_edges: int = BLOCK_EDGES) -> DataFrame:
    """(id, component) with the smallest member id as component name.

    Edges are ranged by id and contracted in blocks inside tasks first, where most edges end
    on lattices and other graphs whose neighbours have near ids; every block names its groups
    by their smallest id. What is left is a graph of groups that share a vertex: one more block
    if it is no larger than that, else rounds of ``_joined_groups``.
    """
    kind = edges.schema["src"].dataType.simpleString()
    e = durable(edges.filter("src <> dst").select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")))

    def contracted(batches: Iterator[pa.RecordBatch], out: str = "part") -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= block_edges:
                yield from block_groups(pa.Table.from_batches(held), ["id", out]).to_batches()
                held, size = [], 0
        if size:
            yield from block_groups(pa.Table.from_batches(held), ["id", out]).to_batches()

    # In order, so that a block is a stretch of ids and few groups meet another block.
    found = e.repartitionByRange("src").sortWithinPartitions("src").mapInArrow(contracted, f"id {kind}, part {kind}")
    own = durable(found.groupBy("id").agg(F.sort_array(F.collect_set("part")).alias("parts")))
    links = durable(own.filter(F.size("parts") > 1).select(
        F.col("parts")[0].alias("src"), F.explode(F.slice("parts", 2, F.size("parts"))).alias("dst")).distinct())
    if links.count() < block_edges:  # one block more
        names = links.coalesce(1).mapInArrow(lambda x: contracted(x, "component"), f"id {kind}, component {kind}")
    else:
        names = _joined_groups(links, max_rounds)
    own = own.select("id", F.col("parts")[0].alias("part")).join(names.withColumnRenamed("id", "part"), "part", "left").select(
        "id", F.coalesce("component", "part").alias("component"))
    # A vertex without edges is its own component.
    return durable(vertices.select("id").join(own, "id", "left").select("id", F.coalesce("component", "id").alias("component")))


def block_groups(edges: pa.Table, names: list[str]) -> pa.Table:
    """Every end of the edges with the smallest id it is connected to by them."""
    n = edges.num_rows
    ends = pa.chunked_array([*edges["src"].chunks, *edges["dst"].chunks]).combine_chunks().dictionary_encode()
    order = pc.sort_indices(ends.dictionary).to_numpy()
    ids = ends.dictionary.take(pa.array(order))
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    a, b = np.split(place[ends.indices.to_numpy()], [n])
    root = np.arange(len(order))
    while len(a):
        np.minimum.at(root, np.maximum(root[a], root[b]), np.minimum(root[a], root[b]))
        while (up := root[root]).tobytes() != root.tobytes():
            root = up
        apart = root[a] != root[b]
        a, b = a[apart], b[apart]
    return pa.table([ids, ids.take(pa.array(root))], names)


def _joined_groups(edges: DataFrame, max_rounds: int) -> DataFrame:
    """(id, component) of the ends of ``edges``, with the smallest id as component.

    Ids are numbered first, so that rounds shuffle pairs of longs, each edge once. Each round
    every vertex joins the neighbour with the lowest random priority, chains are followed two
    steps further, and the graph is contracted to distinct edges between the survivors. Random
    priorities shrink long lattices by a constant factor per round; the per-round maps shrink
    with the graph and are composed at the end.
    """
    ends = edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
    ids = durable(ends.withColumn("_n", F.monotonically_increasing_id()))

    def moved(pairs: DataFrame, to: DataFrame, key: str, number: str) -> DataFrame:
        """Distinct pairs (smaller, larger) of the numbers that ``to`` gives both ends."""
        a = to.select(F.col(key).alias("src"), F.col(number).alias("_a"))
        b = to.select(F.col(key).alias("dst"), F.col(number).alias("_b"))
        return pairs.join(a, "src").join(b, "dst").filter("_a <> _b").select(
            F.least("_a", "_b").alias("src"), F.greatest("_a", "_b").alias("dst")).distinct()

    current = moved(edges, ids, "id", "_n")
    maps: list[DataFrame] = []
    for turn in range(max_rounds):
        current = durable(current)
        if current.isEmpty():
            break
        both = current.select(F.explode(F.array(
            F.struct("src", "dst"), F.struct(F.col("dst").alias("src"), F.col("src").alias("dst")))).alias("e")).select("e.*")
        rank = F.xxhash64("dst", F.lit(turn))
        best = both.groupBy("src").agg(F.min(rank).alias("_r"), F.min_by("dst", rank).alias("_d"))
        # Equal priorities stay apart in this round.
        lower = F.col("_r") < F.xxhash64("src", F.lit(turn))
        step = durable(best.select(F.col("src").alias("id"), F.when(lower, F.col("_d")).otherwise(F.col("src")).alias("parent")))
        up, to = step.select(F.col("id").alias("parent"), F.col("parent").alias("_up")), step
        for _ in range(2):
            to = to.join(up, "parent").select("id", F.col("_up").alias("parent"))
        to = durable(to)
        maps.append(to)
        current = moved(current, to, "id", "parent")
    else:
        raise RuntimeError("COMPONENTS_NOT_CONVERGED")
    final = None
    for level in reversed(maps):
        if final is None:
            final = level
        else:
            up = final.select(F.col("id").alias("parent"), F.col("parent").alias("_up"))
            final = level.join(up, "parent", "left").select("id", F.coalesce("_up", "parent").alias("parent"))
    if final is None:
        return ids.select("id", F.col("id").alias("component"))
    root = durable(ids.join(final.select(F.col("id").alias("_n"), F.col("parent").alias("_root")), "_n").select("id", "_root"))
    name = root.groupBy("_root").agg(F.min("id").alias("component"))
    return durable(root.join(name, "_root").select("id", "component"))


def component_sizes(components: DataFrame, minimum: int = 1) -> DataFrame:
    """Size and retained flag of every vertex."""
    n = components.groupBy("component").agg(F.count(F.lit(1)).alias("component_size"))
    return components.join(n, "component").withColumn("retained", F.col("component_size") >= minimum)
