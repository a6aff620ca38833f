"""Findings of the third round."""

import re

import numpy as np
from pyspark.sql import functions as F

from panelkit.operators import clustering as C
from panelkit.operators import neighbors as N


def test_products_find_the_nearest_though_they_are_inexact(spark):
    rng = np.random.default_rng(3)
    x = 1e6 + np.repeat(rng.normal(size=(40, 5)), 2, axis=0) * np.repeat([1e-3, 1.0], 40)[:, None]  # far from zero, close together, each twice
    df = spark.createDataFrame([(i, v.tolist(), i % 3) for i, v in enumerate(x)], "id long, x array<double>, label int")
    squares, off = N.products(x)(x)
    true = ((x[:, None] - x[None]) ** 2).sum(2)
    assert (np.abs(squares - true) <= off[:, None]).all()
    d = np.sqrt(true)
    np.fill_diagonal(d, np.inf)
    for block in (16, 4096):
        got = N.knn_neighbors(df, df, 3, block_rows=block, exclude_self=True).orderBy("id", "rank").toPandas()
        want = [sorted(range(80), key=lambda j, i=i: (d[i, j], j))[:3] for i in range(80)]
        assert got.neighbor.tolist() == sum(want, [])
        assert got.distance.tolist() == [d[i, j] for i, js in enumerate(want) for j in js]


def test_silhouette_of_blocks_that_meet_once(spark, monkeypatch):
    sent = []
    monkeypatch.setattr(C, "cogroups", lambda t, q, *a: sent.append((t.count(), q.count())) or N.cogroups(t, q, *a))
    rng = np.random.default_rng(4)
    x = rng.normal(size=(96, 4))
    x[::8] = x[0]  # copies
    df = spark.createDataFrame([(i, v.tolist(), i % 3) for i, v in enumerate(x)], "id long, x array<double>, cluster int")
    got = C.silhouette_points(df, block_rows=12).agg(F.avg("silhouette")).first()[0]
    d, label = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2)), np.arange(96) % 3
    a = np.array([d[i][label == label[i]].sum() / 31 for i in range(96)])
    b = np.array([min(d[i][label == c].mean() for c in range(3) if c != label[i]) for i in range(96)])
    assert sent[0][0] + sent[0][1] <= 96 * 10  # 8 blocks: before, each row went out 16 times
    assert np.isclose(got, ((b - a) / np.maximum(a, b)).mean(), rtol=1e-12)


def test_large_groups_are_cut_before_a_task_sorts_them(spark):
    from panelkit.operators import sampling as S

    key = F.when(F.col("id") % 5 == 0, F.lit(7)).otherwise(F.col("id"))  # one key holds a fifth of the rows
    df = spark.range(0, 60_000, 1, 8).select(F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("g"), key.alias("k"), "id")
    df = df.unionByName(spark.range(40).select(F.lit(9).cast("long").alias("g"), F.col("id").alias("k"), "id"))
    got = S.sample_per_group(df, ["g"], ["k"], 1_200, ties=["id"])
    rows = df.withColumn("m", F.md5(F.concat_ws("|", F.lit("42"), F.col("k").cast("string")).cast("binary"))).toPandas()
    assert S.DEFAULTS.seed == 42
    want = rows.sort_values(["m", "k", "id"]).groupby("g", dropna=False).head(1_200)
    out = got.toPandas()
    assert sorted(out.id) == sorted(want.id) and len(out) == 3 * 1_200 + 40 and out.g.isna().sum() == 1_200
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window") >= 2 and "__cut" in plan
    assert S.sample_per_group(df, [], ["k"], 1_200, ties=["id"]).count() == 1_200


def test_reverse_running_values_grow_row_by_row(spark):
    from panelkit.operators import hypothesis as H
    from panelkit.operators.scan import Running, running

    rng = np.random.default_rng(5)
    p = rng.random(300).round(2)
    df = spark.createDataFrame([(i, int(i % 2), float(v)) for i, v in enumerate(p)], "id long, g int, p double")
    few = H.fdr_bh(df, "p", 0.3, ["g"], ["id"])
    back = running(df, ["p", "id"], {"low": Running("p", "min", reverse=True), "after": Running("p", reverse=True, inclusive=False)}, by=["g"], parts=5)
    for plan in (few, back):
        assert not re.search(r"(currentrow\$\(\)|1),unboundedfollowing", plan._jdf.queryExecution().optimizedPlan().toString().replace(" ", "").lower())
    got = back.toPandas().set_index("id")
    for g in (0, 1):
        ids = sorted((i for i in range(300) if i % 2 == g), key=lambda i: (p[i], i))
        assert np.allclose(got.after[ids], [p[ids[k + 1:]].sum() for k in range(150)][:149] + [np.nan], equal_nan=True) and (got.low[ids] == p[ids]).all()
        raw = p[ids] * 150 / np.arange(1, 151)
        want = np.minimum(np.minimum.accumulate(raw[::-1])[::-1], 1)
        assert np.allclose(few.toPandas().set_index("id").p_adj_fdr[ids], want)
