import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelkit.operators import neighbors as N

NAN, INF = math.nan, math.inf


def brute(train, query, k, p, exclude_self=False):
    good = lambda x: x is not None and len(x) > 0 and all(v is not None and math.isfinite(v) for v in x)
    out = {}
    for qi, qx, ql in query:
        if not good(qx):
            continue
        found = []
        for ti, tx, tl in train:
            if not good(tx) or (exclude_self and ti == qi):
                continue
            d = sum(abs(a - b) ** p for a, b in zip(qx, tx)) + sum(0 if a == b else 1 if None in (a, b) else 2 for a, b in zip(ql, tl))
            found.append((round(d ** (1 / p), 9), ti))
        out[qi] = sorted(found)[:k]
    return out


def frames(spark, train, query):
    schema = "id long, x array<double>, levels array<string>"
    return spark.createDataFrame(train, schema).withColumn("label", F.col("id") % 2), spark.createDataFrame(query, schema)


def collected(df):
    out = {}
    for r in df.collect():
        out.setdefault((r.p, r.id), []).append((r["rank"], round(r.distance, 9), r.neighbor))
    return {k: [(d, n) for _, d, n in sorted(v)] for k, v in out.items()}


def clustered(seed, n, clusters, d=3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(clusters, d)) * 50
    return [centres[i % clusters] + rng.normal(size=d) for i in range(n)]


@pytest.mark.parametrize("block_rows", [8, 4096])
def test_rows_without_distance_leave_others_alone(spark, block_rows):
    rng = np.random.default_rng(2)
    level = lambda: [None if rng.random() < 0.2 else str(rng.choice(list("ab")))]
    bad = [None, [], [1.0, None], [NAN, 0.0], [INF, 1.0], [1.0, -INF]]
    train = [(i, rng.integers(0, 6, 2).astype(float).tolist(), level()) for i in range(60)] + [(100 + i, x, level()) for i, x in enumerate(bad)]
    query = [(1000 + i, (rng.integers(0, 48, 2) / 8).tolist(), level()) for i in range(15)] + [(2000 + i, x, level()) for i, x in enumerate(bad)] + train[:5]
    t, q = frames(spark, train, query)
    got = collected(N.knn_neighbors(t, q, 4, (1, 2), block_rows=block_rows, exclude_self=True))
    for p in (1, 2):
        want = brute(train, query, 4, p, exclude_self=True)
        assert {i for pp, i in got if pp == p} == set(want)
        assert all(got[p, i] == v for i, v in want.items())


def test_few_cells_are_visited_on_clusters_and_results_stay_exact(spark):
    points = clustered(1, 1200, 30)
    train = [(i, x.tolist(), []) for i, x in enumerate(points)]
    query = [(5000 + i, x.tolist(), []) for i, x in enumerate(clustered(1, 90, 30))]
    t, q = frames(spark, train, query)
    tally = []
    got = collected(N.knn_neighbors(t, q, 5, (2,), block_rows=20, tally=tally))
    want = brute(train, query, 5, 2)
    assert all(got[2, i] == v for i, v in want.items())
    assert tally[0] == 90 and sum(tally) <= 90 * 6  # of 60 cells


def test_groups_with_null_keys_and_fewer_rows_than_k(spark):
    rows = pd.DataFrame({"id": range(40), "g": [None, 1.0] * 20})
    df = spark.createDataFrame([(int(i), None if pd.isna(g) else int(g), [float(i), 0.0], "a") for i, g in rows.values], "id long, g int, x array<double>, label string")
    small = df.where("id < 39")
    got = N.knn_neighbors(df, small, 25, by=["g"], block_rows=8).toPandas()
    assert got.groupby("id").size().eq(20).all() and set(got[got.g.isna()].neighbor % 2) == {0}


def test_bounds_hold_for_levels_and_manhattan(spark):
    rng = np.random.default_rng(7)
    row = lambda i: (i, (rng.integers(-16, 16, 2) / 8).tolist(),  # sums are exact, so ties are ties
                      [str(rng.choice(list("abcd"))), None if rng.random() < 0.1 else "z"])
    train, query = [row(i) for i in range(200)], [row(1000 + i) for i in range(30)]
    t, q = frames(spark, train, query)
    got = collected(N.knn_neighbors(t, q, 7, (1, 2), block_rows=16))
    for p in (1, 2):
        assert all(got[p, i] == v for i, v in brute(train, query, 7, p).items())
