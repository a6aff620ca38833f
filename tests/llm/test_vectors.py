import numpy as np
import pytest

from panelkit.llm import vectors
from panelkit.llm.graph import union_find


def brute(rows, cosine=0.9):
    ok = {}
    for k, (i, e) in enumerate(rows):
        if e is not None and len(e) and all(x is not None and np.isfinite(x) for x in e) and any(e):
            ok[k] = np.array(e, float) / np.linalg.norm(np.array(e, float))
    links = {k: set() for k in range(len(rows))}
    for a in ok:
        for b in ok:
            if a < b and len(ok[a]) == len(ok[b]) and ok[a] @ ok[b] >= cosine:
                links[a].add(b)
                links[b].add(a)
    root = union_find([(a, b) for a in links for b in links[a]])
    least = {}
    for k, (i, _) in enumerate(rows):
        g = root.get(k, k)
        least[g] = min(least.get(g, i), i)
    return sorted((i, len(links[k]), least[root.get(k, k)]) for k, (i, _) in enumerate(rows))


def _rows(seed=0, n=400, dim=12):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n // 4, dim))
    x = np.concatenate([base, base[: n // 4] + 0.15 * rng.normal(size=base.shape), base + 0.45 * rng.normal(size=base.shape), np.tile(base[:1], (n // 4, 1))])
    return [(i, [float(np.float32(v)) for v in e]) for i, e in enumerate(x)]


def _run(spark, rows):
    frame = spark.createDataFrame([(i, e, "x", 1, 2) for i, e in rows], "vec_id long, embedding array<float>, node string, cell int, links int")
    out = vectors.near_duplicates(frame).collect()
    assert all(r.kept == (r.vec_id == r.component_id) for r in out if r.vec_id is not None)
    return sorted((r.vec_id, r.n_links, r.component_id) for r in out)


def test_links_equal_brute_force(spark):
    rows = _rows()
    assert _run(spark, rows) == brute(rows)


@pytest.mark.parametrize("cell,block", [(20, 7), (60, 1000)])
def test_many_cells_and_blocks(spark, monkeypatch, cell, block):
    monkeypatch.setattr(vectors, "CELL_NODES", cell)
    monkeypatch.setattr(vectors, "BLOCK", block)
    rows = _rows(seed=3, dim=5)
    assert _run(spark, rows) == brute(rows)


def test_edge_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, None), (2, [0.0, 0.0]), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [1.0, None]), (6, []), (7, [1.0, 0.0]), (7, [1.0, 0.0]),
            (8, [1.0, 0.0, 0.0]), (9, [2.0, 0.1]), (10, [-0.0, 5.0]), (11, [0.0, 5.0]), (12, [-1.0, 0.0])]
    assert _run(spark, rows) == brute(rows)
    with_null = _run_nullable(spark, [(None, [1.0, 0.0]), (3, [1.0, 0.0]), (None, None)])
    assert (3, 1, 3) in with_null and (None, 1, 3) in with_null and (None, 0, None) in with_null
    assert _run(spark, []) == []


def _run_nullable(spark, rows):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    return [(r.vec_id, r.n_links, r.component_id) for r in vectors.near_duplicates(frame).collect()]


def test_far_cells_are_not_visited(spark):
    """On clustered vectors a node stays in its own cell."""
    rng = np.random.default_rng(1)
    centres = np.eye(8)
    x = np.concatenate([c + 0.02 * rng.normal(size=(50, 8)) for c in centres])
    frame = spark.createDataFrame([(bytes([i // 256, i % 256]), [float(v) for v in e], 1) for i, e in enumerate(x)], "node binary, embedding array<double>, copies bigint")
    pivots = {8: (list(range(8)), centres)}
    placed = vectors.nearest_pivot(frame, pivots).cache()
    radius = {r.cell: r.angle for r in placed.groupBy("cell").agg({"angle": "max"}).withColumnRenamed("max(angle)", "angle").collect()}
    assert vectors.visits(placed, pivots, radius, float(np.arccos(0.9))).count() == len(x)
