"""Hard negatives against SQL and brute force; bounds lose nothing; odd inputs."""

import math
import random

import duckdb
import numpy as np

from spotweave.llm import hard_negatives as m, queries

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, shift=True):
    kept = []
    for v, e, lab in rows:
        if v is None or lab is None or e is None or any(x is None or not math.isfinite(x) for x in e):
            continue
        kept.append((v, [math.floor(256 * x) for x in e], (lab + 1) % 10 if shift and v % 7 == 0 else lab))
    out = []
    for i, (a, q, lab) in enumerate(kept):
        if a % 100:
            continue
        scored = sorted(((-sum(x * y for x, y in zip(q, r)), v, k, other) for k, (v, r, other) in enumerate(kept) if k != i))
        for s, p, _, _ in [x for x in scored if x[3] == lab][:5]:
            near = [(-t, v) for t, v, _, other in scored if other != lab and 30 * -s <= 100 * -t <= 90 * -s][:10]
            out += [(a, p, k + 1, v, -s, t) for k, (t, v) in enumerate(near)]
    return sorted(out)


def test_table_against_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{sf}/embeddings.parquet'")
    want = sorted(con.execute(queries.ORACLES["op11_hard_negatives"]).fetchall())
    assert sorted(map(tuple, queries.QUERIES["op11_hard_negatives"](spark, sf).collect())) == want and want


def test_clustered_rows_in_small_blocks_and_tiles(spark, monkeypatch):
    monkeypatch.setattr(m, "BLOCK", 4)
    monkeypatch.setattr(m, "TASK_ROWS", 100)
    rng = random.Random(3)
    centres = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(5)]
    rows = []
    for v in range(1500):
        c = rng.randrange(5)
        rows.append((v, [x + rng.choice([0, 0.03, 0.1]) * rng.gauss(0, 1) for x in centres[c]], rng.randrange(3) if rng.random() < 0.4 else c))
    rows += [(1500 + k, centres[0], 7) for k in range(300)]  # copies of one vector
    got = m.mine(spark.createDataFrame(rows, SCHEMA).repartition(5), label=m.shifted_labels())
    assert sorted(map(tuple, got.collect())) == brute(rows)


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(5)
    centres = rng.normal(0, 200, (4, 16))
    tile = np.round(centres[rng.integers(0, 4, 500)] + rng.normal(0, 5, (500, 16)))
    anchors = np.round(centres[rng.integers(0, 4, 60)] + rng.normal(0, 2, (60, 16)))
    tree = m.spanning_tree(anchors)
    assert sorted(t[0] for t in tree) == list(range(60)) and all(p == -1 or p in [t[0] for t in tree[:i]] for i, (_, p, _) in enumerate(tree))
    scores = tile @ anchors.T
    seen = 0
    for a, at, got in m.bounded_scores(tile, np.linalg.norm(tile, axis=1), anchors, tree, lambda a: (100_000, 300_000)):
        inside = np.flatnonzero((scores[:, a] >= 100_000) & (scores[:, a] <= 300_000))
        assert set(inside) <= set(at) and (got == scores[at, a]).all()
        seen += len(at)
    assert seen < 0.7 * scores.size


def test_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(100, [1.0, 0.5], 1), (100, [1.0, 0.5], 1), (None, [1.0, 1.0], 1), (3, None, 1), (4, [1.0, None], 2), (5, [inf, 1.0], 2), (6, [nan, 1.0], 2),
            (8, [1.0, 0.25], None), (9, [0.5, 0.5], 2), (9, [0.5, 0.5], 2), (10, [0.7], 2), (11, [], 1), (12, [2.0, 0.1, 9.0], 1), (200, [-1.0, 0.0], 3)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as row", "2 as q", "'x' as LABEL")
    got = sorted(map(tuple, m.mine(df).collect()))
    assert got == brute(rows, shift=False) and got
    assert m.mine(df.limit(0)).collect() == [] and m.mine(df.filter("vec_id < 50")).collect() == []
    big = spark.createDataFrame([(0, [3e4, 1.0], 1), (1, [3e4, 2.0], 1), (2, [1e300, 1.0], 2), (3, [1.2e4, 0.0], 2)], SCHEMA)
    assert [r["negative_id"] for r in m.mine(big).collect()] == []
    near = spark.createDataFrame([(0, [1e4, 1.0], 1), (1, [1e4, 2.0], 1), (3, [5e3, 0.0], 2)], SCHEMA)
    assert [tuple(r) for r in m.mine(near).collect()] == [(0, 1, 1, 3, 2560000 ** 2 + 256 * 512, 2560000 * 1280000)]
