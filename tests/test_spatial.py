"""Lattice, components, Moran and Geary, permutations: hand values and brute force."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from spotweave.operators import autocorr as ac, communities as cm, lattice as la, neighbors as nb, quick_communities as qc
from spotweave.operators.components import component_sizes, connected_components


def lattice(spark, coords, sample="s", roi="r", total=100):
    rows = [(sample, roi, f"{sample}::{i:03d}", r, c, total) for i, (r, c) in enumerate(coords)]
    return spark.createDataFrame(rows, "sample_id string, roi string, observation_id string, array_row int, array_col int, "
                                       "total_counts long")


def test_hexagon_and_isolated_spot(spark):
    hexa = [(2, 4), (2, 2), (2, 6), (1, 3), (1, 5), (3, 3), (3, 5), (20, 20)]
    s = lattice(spark, hexa)
    e = la.hex_edges(s)
    assert e.count() == 24
    ids = s.select(F.col("observation_id").alias("id"))
    sizes = sorted(r["component_size"] for r in component_sizes(connected_components(ids, e)).collect())
    assert sizes == [1] + [7] * 7


def test_edges_carry_the_labels_that_joins_would_find(spark):
    s = lattice(spark, [(2, 4), (2, 2), (2, 6), (1, 3), (3, 5), (20, 20)]).withColumn("kind", F.when(F.col("array_col") > 3, F.col("array_col").cast("string")))
    got = la.hex_edges(s, label="kind").select("src", "dst", "src_label", "dst_label")
    want = la.label_edges(la.hex_edges(s), s.select(F.col("observation_id").alias("id"), F.col("kind").alias("label"))).select(got.columns)
    assert got.count() == want.count() == 12 and got.exceptAll(want).isEmpty()


def test_no_edge_crosses_sections(spark):
    a, b = lattice(spark, [(0, 0), (0, 2)]), lattice(spark, [(0, 0), (0, 2)], sample="t")
    e = la.hex_edges(a.union(b)).collect()
    assert len(e) == 4 and all(r["src"][0] == r["dst"][0] for r in e)


def test_components_of_long_paths(spark):
    n = 300
    edges = spark.createDataFrame([(f"{i:04d}", f"{i + 1:04d}") for i in range(n) if i != 150], "src string, dst string")
    ids = spark.createDataFrame([(f"{i:04d}",) for i in range(n + 1)], "id string")
    got = {r["id"]: r["component"] for r in connected_components(ids, edges).collect()}
    assert {got[f"{i:04d}"] for i in range(151)} == {"0000"}
    assert {got[f"{i:04d}"] for i in range(151, n + 1)} == {"0151"}


def test_components_compute_their_edges_once_and_keep_lone_vertices(spark):
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(x):
        read.add(1)
        return x

    seen = seen.asNondeterministic()
    edges = spark.createDataFrame([(f"{i:03d}", f"{i + 1:03d}") for i in range(40)], "src string, dst string").select(seen("src").alias("src"), "dst")
    ids = spark.createDataFrame([(f"{i:03d}",) for i in range(45)], "id string")
    got = {r["id"]: r["component"] for r in connected_components(ids, edges).collect()}
    assert read.value == 40
    assert got == {f"{i:03d}": f"{i if i > 40 else 0:03d}" for i in range(45)}


def test_components_end_near_edges_in_tasks_and_join_blocks(spark):
    path = spark.createDataFrame([(i, i + 1) for i in range(30_000)], "src long, dst long")
    got = connected_components(path.select(F.col("src").alias("id")), path, max_rounds=12)
    assert [tuple(r) for r in got.groupBy("component").count().collect()] == [(0, 30_000)]
    mixed = path.orderBy(F.xxhash64("src"))
    got = connected_components(path.select(F.col("src").alias("id")), mixed, max_rounds=0, block_edges=1000)
    assert got.select("component").distinct().count() == 1  # thirty blocks in order leave fewer links than a block
    rng = np.random.default_rng(3)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 400, (260, 2))]
    root = list(range(400))
    for _ in range(400):
        for a, b in pairs:
            root[a] = root[b] = min(root[a], root[b])
    edges, ids = spark.createDataFrame(pairs, "src long, dst long"), spark.createDataFrame([(i,) for i in range(400)], "id long")
    for size in (1, 50, 200_000):
        found = connected_components(ids, edges, block_edges=size).collect()
        assert {r["id"]: r["component"] for r in found} == dict(enumerate(root)) and len(found) == 400


def test_gate_and_values_of_held_counts_are_those_of_the_triplets(spark):
    s = lattice(spark, [(0, 2 * i) for i in range(8)] + [(9, 9)])
    c = spark.createDataFrame([(f"s::{i:03d}", g, i + k) for i in range(9) for k, g in enumerate("ab")], "observation_id string, gene_id string, count long")
    _, nodes, _ = ac.roi_graph(s, 3)
    held = ac.retained_counts(c, nodes)
    assert held.count() == 15
    for t in (ac.gene_gate, lambda x, n: ac.expression_values(x, n, ac.gene_gate(x, n, 2))):
        assert sorted(t(held, nodes).collect()) == sorted(t(c, nodes).collect())


def _dense_moran(x, comp, w):
    y = x.astype(float).copy()
    for c in set(comp):
        y[comp == c] -= y[comp == c].mean()
    s0, n = w.sum(), len(y)
    moran = n / s0 * (y @ w @ y) / (y @ y)
    sq = (w * (y[:, None] - y[None, :]) ** 2).sum()
    return moran, (n - 1) / (2 * s0) * sq / (y @ y)


def region(spark):
    rng = np.random.default_rng(3)
    coords = [(r, 2 * c + r % 2) for r in range(6) for c in range(5)] + [(40 + r, 2 * c + r % 2) for r in range(4) for c in range(5)]
    s = lattice(spark, coords)
    counts = []
    for g in range(4):
        for i in range(len(coords)):
            lam = 1 + (coords[i][0] % 40) if g == 0 else 2
            k = int(rng.poisson(lam))
            if k:
                counts.append((f"s::{i:03d}", f"g{g}", k))
    c = spark.createDataFrame(counts, "observation_id string, gene_id string, count long")
    return s, c, coords


def scored(spark):
    s, c, coords = region(spark)
    _, nodes, kept = ac.roi_graph(s, 10)
    gate = ac.gene_gate(c, nodes, 5, 0.1)
    values = ac.expression_values(c, nodes, gate)
    return s, c, coords, nodes, kept, values, ac.moran_geary(values, nodes, kept, gate)


def test_moran_and_geary_match_dense_definition(spark):
    s, c, coords, nodes, kept, values, eff = scored(spark)
    ids = [f"s::{i:03d}" for i in range(len(coords))]
    pos = {x: i for i, x in enumerate(ids)}
    w = np.zeros((len(ids), len(ids)))
    for r in kept.collect():
        w[pos[r["src"]], pos[r["dst"]]] = 1
    w /= np.maximum(w.sum(axis=1, keepdims=True), 1)
    comp = np.array([0 if i < 30 else 1 for i in range(len(ids))])
    got = {r["gene_id"]: r for r in eff.collect()}
    assert len(got) == 4
    pdf = c.toPandas()
    for g, r in got.items():
        x = np.zeros(len(ids))
        for _, row in pdf[pdf["gene_id"] == g].iterrows():
            x[pos[row["observation_id"]]] = np.log1p(row["count"] * 1e4 / 100)
        m, q = _dense_moran(x, comp, w)
        assert abs(r["moran_I"] - m) < 1e-9 and abs(r["geary_C"] - q) < 1e-9
    # Only g0 has a planted gradient.
    assert max(got, key=lambda g: got[g]["moran_I"]) == "g0"


def test_two_spots_hand_values(spark):
    s = lattice(spark, [(0, 0), (0, 2)])
    c = spark.createDataFrame([("s::000", "g", 5)], "observation_id string, gene_id string, count long")
    _, nodes, kept = ac.roi_graph(s, 1)
    gate = ac.gene_gate(c, nodes, 1, 0.0)
    r = ac.moran_geary(ac.expression_values(c, nodes, gate), nodes, kept, gate).first()
    assert abs(r["moran_I"] + 1) < 1e-12 and abs(r["geary_C"] - 1) < 1e-12


def test_permutation_pvalues_do_not_depend_on_partitions(spark):
    _, _, _, nodes, kept, values, eff = scored(spark)
    cand = ac.screen_candidates(eff, 2)
    got = []
    for n in ("2", "9"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        got.append({r["gene_id"]: r for r in ac.permutation_pvalues(cand, values, nodes, kept, 99).collect()})
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    want = {r["gene_id"]: r for r in eff.collect()}
    for g, r in got[0].items():
        assert r == got[1][g] and 0 < r["moran_p_permutation_one_sided"] <= 1 and r["moran_q_candidate_bh"] is None
        assert abs(r["observed_moran"] - want[g]["moran_I"]) < 1e-8 and abs(r["observed_geary"] - want[g]["geary_C"]) < 1e-8
    assert got[0]["g0"]["moran_p_permutation_one_sided"] <= 0.05


def test_blocks_and_joins_of_permutations_agree(spark):
    _, _, _, nodes, kept, values, eff = scored(spark)
    cand = ac.screen_candidates(eff, 2)
    got = [sorted(ac.permutation_pvalues(cand, values, nodes, kept, 99, block_spots=n).collect()) for n in (ac.BLOCK_SPOTS, 1)]
    assert got[0] == got[1] and got[0]


def test_nearest_neighbours_tiles_match_brute_force(spark):
    rng = np.random.default_rng(1)
    x = np.vstack([rng.normal(0, 1, (80, 5)), rng.normal(6, 0.3, (40, 5)), np.zeros((5, 5))])
    df = spark.createDataFrame(pd.DataFrame({"id": range(len(x)), "vector": [list(map(float, v)) for v in x]}))
    want = set()
    for i in range(len(x)):
        d = np.round(np.sqrt(((x - x[i]) ** 2).sum(axis=1)), 9)
        d[i] = np.inf
        want |= {(i, j) for j in np.lexsort((range(len(x)), d))[:6]}
    for tile, pivots in ((4096, None), (16, 9)):
        got = {(r["src"], r["dst"]) for r in nb.nearest_neighbors(df, 6, tile_rows=tile, pivots=pivots).collect()}
        assert got == want


def test_neighbours_of_sparse_points_beside_dense_ones_and_copies_far_from_zero(spark):
    rng = np.random.default_rng(5)
    dense = rng.normal(0, 0.05, (600, 2))
    x = np.vstack([dense, rng.uniform(-6, 6, (200, 2)), dense[:20], np.full((300, 2), 3.0)]) + 1000
    df = spark.createDataFrame(pd.DataFrame({"id": [f"p{i}" for i in range(len(x))], "vector": [list(map(float, v)) for v in x]}))
    names = np.array([f"p{i}" for i in range(len(x))])
    want = set()
    for i in range(len(x)):
        d = np.round(np.sqrt(((x - x[i]) ** 2).sum(axis=1)), 9)
        d[i] = np.inf
        want |= {(names[i], names[j]) for j in np.lexsort((names, d))[:6]}
    for tile, pivots in ((None, None), (64, 40)):
        assert {(r["src"], r["dst"]) for r in nb.nearest_neighbors(df, 6, tile_rows=tile, pivots=pivots).collect()} == want


def test_fuzzy_weights_are_symmetric_and_bounded(spark):
    rng = np.random.default_rng(2)
    df = spark.createDataFrame(pd.DataFrame({"id": range(60), "vector": [list(map(float, v)) for v in rng.normal(size=(60, 4))]}))
    w = {(r["src"], r["dst"]): r["weight"] for r in nb.fuzzy_connectivities(nb.nearest_neighbors(df, 5), 6).collect()}
    assert all(0 < v <= 1 + 1e-12 for v in w.values())
    assert all(abs(w[(b, a)] - v) < 1e-9 for (a, b), v in w.items())
    assert {a for (a, _), v in w.items() if v > 1 - 1e-9} == set(range(60))


def test_communities_find_planted_blocks_and_are_seeded(spark):
    rows = []
    for b in range(3):
        ids = [f"{b}{i}" for i in range(6)]
        rows += [(x, y, 1.0) for x in ids for y in ids if x != y]
    rows += [("05", "10", 0.1), ("10", "05", 0.1), ("15", "20", 0.1), ("20", "15", 0.1)]
    e = spark.createDataFrame(rows, "src string, dst string, weight double")
    ids = e.select(F.col("src").alias("id")).distinct()
    labels = cm.communities(ids, e, [(1.0, 0), (1.0, 1)])
    got = {}
    for r in labels.collect():
        got.setdefault(r["seed"], {})[r["id"]] = r["community"]
    for seed in (0, 1):
        assert len({got[seed][f"{b}{i}"] for b in range(3) for i in range(6)}) == 3
        assert all(len({got[seed][f"{b}{i}"] for i in range(6)}) == 1 for b in range(3))
    q = cm.modularity(labels, e).first()["modularity"]
    assert q > 0.6
    again = {(r["seed"], r["id"]): r["community"] for r in cm.communities(ids, e, [(1.0, 0), (1.0, 1)]).collect()}
    assert all(again[(s, i)] == c for s, m in got.items() for i, c in m.items())


def test_refinement_reaches_a_fixed_point_of_connected_communities(spark):
    rng = np.random.default_rng(11)
    rows = {}
    for _ in range(260):  # four noisy blocks
        x, y = rng.integers(0, 40, 2)
        if x != y and (x // 10 == y // 10 or rng.random() < 0.25):
            rows[min(x, y), max(x, y)] = float(rng.uniform(0.2, 1))
    e = spark.createDataFrame([(str(a), str(b), w) for (x, y), w in rows.items() for a, b in ((x, y), (y, x))], "src string, dst string, weight double")
    ids = spark.createDataFrame([(str(i),) for i in range(41)], "id string")  # 40 has no edge
    labels = cm.communities(ids, e, [(1.0, 0)])
    found = {r["id"]: r["community"] for r in labels.collect()}
    assert len(found) == 41 and found["40"] == "40"
    assert all(c == min(i for i in found if found[i] == c) for c in found.values())
    assert [tuple(r)[2:] for r in cm.fixed_points(labels, e).collect()] == [(41, 0, 0)]
    total = 2 * sum(rows.values())
    degree = {str(i): sum(w for k, w in rows.items() if i in k) for i in range(41)}

    def quality(of):
        tot = {}
        for i, c in of.items():
            tot[c] = tot.get(c, 0) + degree[i]
        return sum(2 * w for (x, y), w in rows.items() if of[str(x)] == of[str(y)]) / total - sum(t * t for t in tot.values()) / total ** 2

    # Plain local moving from single nodes, one node at a time.
    of = {i: i for i in found}
    while True:
        best = max(((quality({**of, i: c}), i, c) for i in of for c in set(of.values())), key=lambda x: x[0])
        if best[0] <= quality(of) + 1e-12:
            break
        of[best[1]] = best[2]
    assert quality(found) >= quality(of) - 1e-9
    assert abs(cm.modularity(labels.withColumn("run", F.lit(0)), e).first()["modularity"] - quality(found)) < 1e-9


def test_visits_of_clustered_points_grow_below_the_square(spark):
    def pairs(n):
        rng = np.random.default_rng(n)
        plane = rng.normal(size=(2, 5))
        v = (rng.integers(0, 4, (n, 2)) * 10 + rng.uniform(0, 5, (n, 2))) @ plane  # 16 clusters
        df = spark.createDataFrame(pd.DataFrame({"id": range(n), "vector": [list(map(float, x)) for x in v]}))
        homes, visits, size = nb.cell_visits(df, 5)
        assert homes.count() == n == size.sum()
        return sum(int(size[r["cell"]]) for r in visits.select("cell").collect())

    few, many = pairs(1000), pairs(8000)
    assert np.log(many / few) / np.log(8) < 1.75 and many < 0.1 * 8000 ** 2


def test_quick_communities_do_not_depend_on_blocks(spark):
    groups = [[f"{b}n{i}" for i in range(5)] for b in range(8, 12)]
    rows = [(x, y, 1.0) for ids in groups for x in ids for y in ids if x != y]
    rows += [(x, y, 0.1) for a, b in zip(groups, groups[1:]) for x, y in ((a[0], b[1]), (b[1], a[0]))]
    e = spark.createDataFrame(rows, "src string, dst string, weight double")
    ids = spark.createDataFrame([(x,) for ids in [*groups, ["alone"]] for x in ids], "id string")
    got = [sorted(map(tuple, qc.quick_communities(ids, e, [(1.0, 3), (0.5, 4)], max_sweeps=2, max_levels=2, block_edges=n).collect())) for n in (30, 1000)]
    assert got[0] == got[1] and len(got[0]) == 2 * 21
    for seed in (3, 4):
        label = {r[3]: r[4] for r in got[0] if r[2] == seed}
        members = {}
        for x, c in label.items():
            members.setdefault(c, []).append(x)
        assert all(c == min(ids) for c, ids in members.items()) and members["alone"] == ["alone"]
        assert any(len({label[x] for x in ids}) == 1 for ids in groups)


def test_the_communities_query_is_the_whole_grid_at_fixed_points(spark, sf):
    from spotweave.plans import queries_models as qm

    labels = qm.expression_communities(spark, sf)
    n = qm.points(spark, sf).count()
    assert {(r[0], r[1]): r[2] for r in labels.groupBy("resolution", "seed").count().collect()} == {(r, s): n for r in (0.4, 0.6, 0.8) for s in (0, 1, 2)}
    assert {tuple(r)[2:] for r in cm.fixed_points(labels, qm.expression_graph(spark, sf)).collect()} == {(n, 0, 0)}


def test_communities_in_blocks_reach_a_fixed_point_too(spark):
    groups = [[f"{b}n{i}" for i in range(6)] for b in range(8, 13)]
    rows = [(x, y, 1.0) for ids in groups for x in ids for y in ids if x != y]
    rows += [(x, y, 0.1) for a, b in zip(groups, groups[1:]) for x, y in ((a[0], b[1]), (b[1], a[0]))]
    e = spark.createDataFrame(rows, "src string, dst string, weight double")
    ids = spark.createDataFrame([(x,) for x in [*sum(groups, []), "alone"]], "id string")
    labels = cm.communities(ids, e, [(1.0, 3)], block_edges=60)  # three blocks
    assert [tuple(r)[2:] for r in cm.fixed_points(labels, e).collect()] == [(31, 0, 0)]
    found = {r["id"]: r["community"] for r in labels.collect()}
    assert found == {**{x: min(g) for g in groups for x in g}, "alone": "alone"}


def test_shuffled_orders_are_those_of_whole_digests(monkeypatch):
    import hashlib

    ids = np.array(sorted(f"S{i % 3}::{'x' * (i % 4)}{i}".encode() for i in range(300)), dtype=object)
    want = [sorted(range(300), key=lambda i: (hashlib.md5(f"1729:{p}:".encode() + ids[i]).digest(), i)) for p in (1, 12, 199)]
    assert [x.tolist() for x in ac.shuffled_orders(ids, [1, 12, 199], 1729)] == want
    heads = ac.md5_heads
    monkeypatch.setattr(ac, "md5_heads", lambda first, last: heads(first, last) >> np.uint32(27))  # most share their head
    assert [x.tolist() for x in ac.shuffled_orders(ids, [1, 12, 199], 1729)] == want
