"""Lattice graph: hexagonal neighbours, row weights, joint graph, graph QC and continuity."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from spotweave.functions.ordering import exact_quantiles
from spotweave.operators.components import connected_components
from spotweave.operators.contracts import duplicate_coordinates, enforce

# Fixed values: (row, column) offsets of the six neighbours on the capture lattice.
HEX_OFFSETS = ((0, -2), (0, 2), (-1, -1), (-1, 1), (1, -1), (1, 1))


def hex_edges(spots: DataFrame, by=("sample_id",), check: bool = False, label: str | None = None) -> DataFrame:
    """Directed edges between lattice neighbours inside one section (both directions).

    Three shifted copies, one per axis, meet their neighbours in one equi join on section,
    row and column, and every pair is turned round after it; a section of any size spreads
    over its coordinates. ``by`` may add a label so that edges stay inside one region. With
    ``label`` (a column) both ends' labels go along as in ``label_edges``, without its joins.
    """
    by, ends = list(by), ["observation_id", *([label] if label else [])]
    if check:
        enforce(duplicate_coordinates(spots), "COORDINATE_DUPLICATE")
    ahead = [(r, c) for r, c in HEX_OFFSETS if (r, c) > (0, 0)]
    offsets = F.array(*[F.struct(F.lit(r).alias("dr"), F.lit(c).alias("dc")) for r, c in ahead])

    def named(side: str) -> list:
        return [F.col(c).alias(n) for c, n in zip(ends, (side, f"{side}_label"))]

    a = spots.select(*by, *named("src"), "array_row", "array_col", F.explode(offsets).alias("o"))
    a = a.withColumn("array_row", F.col("array_row") + F.col("o.dr")).withColumn("array_col", F.col("array_col") + F.col("o.dc")).drop("o")
    b = spots.select(*by, *named("dst"), "array_row", "array_col")
    out = [f"{side}{end}" for end in ("", "_label")[:len(ends)] for side in ("src", "dst")]
    turned = [F.col({"src": "dst", "dst": "src"}[c[:3]] + c[3:]).alias(c) for c in out]
    both = F.array(F.struct(*out), F.struct(*turned))
    return a.join(b, [*by, "array_row", "array_col"]).select(*by, F.explode(both).alias("e")).select(*by, "e.*")


def label_edges(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """Labels of both endpoints; ``labels`` has id, label."""
    a = labels.select(F.col("id").alias("src"), F.col("label").alias("src_label"))
    b = labels.select(F.col("id").alias("dst"), F.col("label").alias("dst_label"))
    return edges.select("src", "dst").join(a, "src").join(b, "dst")


def degrees(edges: DataFrame) -> DataFrame:
    return edges.groupBy("src").agg(F.count(F.lit(1)).alias("degree")).withColumnRenamed("src", "id")


def row_weights(edges: DataFrame) -> DataFrame:
    """Weight over row sum (1 / degree without weights)."""
    e = edges if "weight" in edges.columns else edges.withColumn("weight", F.lit(1.0))
    total = e.groupBy("src").agg(F.sum("weight").alias("_sum"))
    return e.join(total, "src").withColumn("weight", F.col("weight") / F.col("_sum")).drop("_sum")


def joint_graph(expression: DataFrame, spatial: DataFrame, alpha: float = 0.3) -> DataFrame:
    """The symmetric part of (1 - alpha) expression + alpha row-weighted lattice."""
    e = expression.select("src", "dst", (F.col("weight") * (1 - alpha)).alias("weight"))
    s = row_weights(spatial).select("src", "dst", (F.col("weight") * alpha).alias("weight"))
    both = e.unionByName(s)
    back = both.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")
    return both.unionByName(back).filter("src <> dst").groupBy("src", "dst").agg(
        (F.sum("weight") * 0.5).alias("weight")).filter("weight <> 0")


def neighbour_fraction(edges: DataFrame, spots: DataFrame) -> DataFrame:
    """Degree and same-sample share of neighbours per spot; isolated spots have NULL.

    ``spots`` has id, sample_id.
    """
    lab = spots.select("id", F.col("sample_id").alias("label"))
    per = label_edges(edges, lab).groupBy(F.col("src").alias("id")).agg(
        F.count(F.lit(1)).alias("graph_degree"),
        F.avg((F.col("src_label") == F.col("dst_label")).cast("int")).alias("same_sample_neighbour_fraction"))
    return spots.join(per, "id", "left").fillna(0, ["graph_degree"])


def neighbour_summary(table: DataFrame) -> DataFrame:
    """Mean degree, mean and median share per sample."""
    mean = table.groupBy("sample_id").agg(
        F.count(F.lit(1)).alias("n_spots"), F.avg("graph_degree").alias("mean_graph_degree"),
        F.avg("same_sample_neighbour_fraction").alias("mean_same_sample_neighbour_fraction"))
    med = exact_quantiles(table, ["sample_id"], "same_sample_neighbour_fraction",
                          {"median_same_sample_neighbour_fraction": 0.5})
    return mean.join(med, "sample_id", "left")


def scoped(df: DataFrame) -> DataFrame:
    """Every row under its sample and under the cohort scope."""
    return df.withColumn("scope_id", F.explode(F.array(F.col("sample_id"), F.lit("__all__"))))


def graph_qc(spots: DataFrame, edges: DataFrame, components: DataFrame) -> DataFrame:
    """Edges, degrees and components per sample and for the cohort.

    ``spots``: id, sample_id; ``components``: id, component.
    """
    t = spots.join(degrees(edges), "id", "left").fillna(0, ["degree"])
    t = t.join(components.select("id", "component"), "id")
    s = scoped(t)
    base = s.groupBy("scope_id").agg(
        F.count(F.lit(1)).alias("n_spots"), (F.sum("degree") / 2).cast("long").alias("n_undirected_edges"),
        F.avg("degree").alias("mean_degree"), F.min("degree").alias("min_degree"),
        F.max("degree").alias("max_degree"), F.count_if(F.col("degree") == 0).alias("n_isolated_spots"))
    med = exact_quantiles(s, ["scope_id"], "degree", {"median_degree": 0.5})
    size = t.groupBy("sample_id", "component").agg(F.count(F.lit(1)).alias("size"))
    comp = scoped(size).groupBy("scope_id").agg(
        F.count(F.lit(1)).alias("n_components"), F.max("size").alias("largest_component_spots"))
    cross = label_edges(edges, spots.select("id", F.col("sample_id").alias("label"))).agg(
        (F.count_if(F.col("src_label") != F.col("dst_label")) / 2).cast("long").alias("_cross")).withColumn(
        "scope_id", F.lit("__all__"))
    out = base.join(med, "scope_id").join(comp, "scope_id").join(cross, "scope_id", "left")
    return out.select(
        F.when(F.col("scope_id") == "__all__", "cohort").otherwise("sample").alias("scope"),
        F.col("scope_id").alias("sample_id"), "n_spots", "n_undirected_edges", "mean_degree", "median_degree",
        "min_degree", "max_degree", "n_components", "n_isolated_spots", "largest_component_spots",
        (F.col("largest_component_spots") / F.col("n_spots")).alias("largest_component_fraction"),
        F.coalesce("_cross", F.lit(0)).alias("cross_sample_undirected_edges"))


def label_continuity(spots: DataFrame, edges: DataFrame, labels: DataFrame) -> DataFrame:
    """Same-label edge share per scope, and per label components and isolated spots.

    Edges never leave a section, so a label's components in the cohort are the sum
    over sections and one labelled subgraph serves every scope.
    """
    lab = labels.select("id", "label")
    both = label_edges(edges, lab)
    same = both.filter("src_label = dst_label").select("src", "dst")
    home = spots.select("id", "sample_id").join(lab, "id")
    e = both.join(spots.select(F.col("id").alias("src"), "sample_id"), "src")
    summary = scoped(e).groupBy("scope_id").agg(
        (F.count(F.lit(1)) / 2).cast("long").alias("n_spatial_edges"),
        (F.count_if(F.col("src_label") == F.col("dst_label")) / 2).cast("long").alias("n_same_label_spatial_edges"))
    n = scoped(home).groupBy("scope_id").agg(F.count(F.lit(1)).alias("n_spots"))
    none = F.lit(None).cast("long")
    top = n.join(summary, "scope_id", "left").fillna(0, ["n_spatial_edges", "n_same_label_spatial_edges"]).select(
        F.lit("labeling_summary").alias("record_type"), "scope_id", F.lit("__all__").alias("label"), "n_spots",
        "n_spatial_edges", "n_same_label_spatial_edges",
        (F.col("n_same_label_spatial_edges") / F.nullif("n_spatial_edges", F.lit(0))).alias(
            "same_label_spatial_edge_fraction"),
        none.alias("n_label_components"), none.alias("n_label_isolated_spots"),
        none.alias("largest_label_component_spots"))
    comp = connected_components(home.select("id"), same)
    deg = degrees(same)
    t = home.join(comp, "id").join(deg, "id", "left").fillna(0, ["degree"])
    size = t.groupBy("sample_id", "label", "component").agg(
        F.count(F.lit(1)).alias("size"), F.sum("degree").alias("deg"),
        F.count_if(F.col("degree") == 0).alias("iso"))
    per = scoped(size).groupBy("scope_id", "label").agg(
        F.sum("size").alias("n_spots"), (F.sum("deg") / 2).cast("long").alias("n_spatial_edges"),
        F.count(F.lit(1)).alias("n_label_components"), F.sum("iso").alias("n_label_isolated_spots"),
        F.max("size").alias("largest_label_component_spots"))
    low = per.select(
        F.lit("label_component").alias("record_type"), "scope_id", "label", "n_spots", "n_spatial_edges",
        F.col("n_spatial_edges").alias("n_same_label_spatial_edges"),
        F.when(F.col("n_spatial_edges") > 0, 1.0).alias("same_label_spatial_edge_fraction"),
        "n_label_components", "n_label_isolated_spots", "largest_label_component_spots")
    return top.unionByName(low).withColumn(
        "largest_label_component_fraction", F.col("largest_label_component_spots") / F.col("n_spots"))
