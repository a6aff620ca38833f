from datetime import date

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelkit.operators import panel as P
from panelkit.operators import profile as PR
from panelkit.operators import sampling
from panelkit.operators.charts import box_stats
from panelkit.operators import scan
from panelkit.operators.scan import Running, attach_by_value, avg_rank, exact_quantiles, running, value_ranks


@pytest.fixture(scope="module")
def skewed(spark):
    """Half of all rows in one group, a third of all rows on one value."""
    rng = np.random.default_rng(3)
    n = 3000
    pdf = pd.DataFrame({"id": range(n), "g": rng.choice(["hot", "b", "c", None], n, p=[0.5, 0.3, 0.1, 0.1]),
                        "v": np.where(rng.random(n) < 0.34, 7.0, rng.integers(-50, 50, n)).astype(float)})
    return pdf, spark.createDataFrame(pdf, "id long, g string, v double").repartition(7)


def test_running_sum_min_last_both_directions(spark, skewed):
    pdf, df = skewed
    got = running(df, ["v", "id"], {
        "s": Running("v"), "m": Running("v", "min", reverse=True), "p": Running("v", "last", inclusive=False),
        "b": Running("v", inclusive=False)}, by=["g"], parts=5).toPandas().sort_values(["g", "v", "id"], na_position="first")
    want = pdf.sort_values(["g", "v", "id"], na_position="first")
    grouped = want.groupby("g", dropna=False)["v"]
    assert np.allclose(got["s"], grouped.cumsum())
    assert np.allclose(got["m"], grouped.transform(lambda s: s[::-1].cummin()[::-1]))
    assert got["p"].fillna(-999).tolist() == grouped.shift(1).fillna(-999).tolist()
    assert np.allclose(got["b"].fillna(0), grouped.cumsum() - want["v"])


def test_running_without_groups_is_partition_independent(spark, skewed):
    pdf, df = skewed
    want = pdf.sort_values(["v", "id"])["v"].cumsum().tolist()
    for parts in (1, 3, 16):
        got = running(df, ["v", "id"], {"s": Running("v")}, parts=parts).toPandas().sort_values(["v", "id"])
        assert np.allclose(got["s"], want)


def test_ranks_match_pandas(spark, skewed):
    pdf, df = skewed
    got = avg_rank(df, "v").toPandas().set_index("id")["avg_rank"].sort_index()
    assert np.allclose(got, pdf.set_index("id")["v"].rank())
    known = pdf.dropna(subset=["g"])
    got = avg_rank(df.dropna(subset=["g"]), "v", ["g"]).toPandas().set_index("id")["avg_rank"].sort_index()
    assert np.allclose(got, known.set_index("id").groupby("g")["v"].rank().sort_index())


def test_attach_by_value_keeps_every_row_whatever_is_hot(spark, skewed):
    pdf, df = skewed
    table = df.groupBy("v").agg(F.count("*").alias("n"))
    for hot in (1, 3, 1000):
        got = attach_by_value(df, table, ["v"], hot_values=hot)
        assert got.count() == len(pdf)
        assert got.where("v = 7").select("n").distinct().count() == 1


def test_exact_quantiles_match_pandas(spark, skewed):
    pdf, df = skewed
    got = exact_quantiles(df, ["v"], [0, 0.1, 0.25, 0.5, 0.9, 1]).toPandas().set_index("prob")["value"].sort_index()
    assert np.allclose(got, pdf["v"].quantile([0, 0.1, 0.25, 0.5, 0.9, 1]))
    by = exact_quantiles(df.dropna(subset=["g"]), ["v"], [0.3], ["g"]).toPandas().set_index("g")["value"].sort_index()
    assert np.allclose(by, pdf.groupby("g")["v"].quantile(0.3))
    one = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (5.0,), (None,)], "x double")
    assert exact_quantiles(one, ["x"], [0.25]).first()["value"] == 1.75


def test_value_ranks_extra_sums(spark):
    df = spark.createDataFrame([(1.0, 1), (1.0, 0), (2.0, 1)], "v double, y int")
    got = {r["v"]: (r["n"], r["before"], r["avg_rank"], r["hits"]) for r in value_ranks(df, "v", hits=F.col("y")).collect()}
    assert got == {1.0: (2, 0, 1.5, 1), 2.0: (1, 2, 3.0, 1)}


def _months(n, start=2018):
    return [date(start + (i // 12), i % 12 + 1, 1) for i in range(n)]


@pytest.fixture(scope="module")
def gap(spark):
    data = [("a", d, float(i)) for i, d in enumerate(_months(6)) if i != 2] + [("b", d, 10.0 * i) for i, d in enumerate(_months(6))]
    return spark.createDataFrame(data, "k string, fecha date, monto_asinh double")


def test_positional_and_calendar_lags_differ_at_a_gap(gap):
    pos = {(r.k, r.fecha.month): r.lag1 for r in P.add_lag(gap, "monto_asinh", ["k"]).collect()}
    cal = {(r.k, r.fecha.month): r.lag1 for r in P.calendar_lag(gap, "monto_asinh", ["k"]).collect()}
    assert pos[("a", 4)] == 1.0 and cal[("a", 4)] is None
    assert pos[("a", 5)] == cal[("a", 5)] == 3.0
    assert pos[("b", 1)] is None and cal[("b", 1)] is None


def test_rolling_needs_a_full_window(spark):
    df = spark.createDataFrame([(date(2020, m, 1), None if m == 4 else float(m * m)) for m in range(1, 9)], "fecha date, x double")
    out = P.rolling(P.rolling(df, "x", [], "mean"), "x", [], "std").toPandas().sort_values("fecha")
    s = out["x"].rolling(3)
    assert np.allclose(out["roll3_mean"], s.mean(), equal_nan=True)
    assert np.allclose(out["roll3_std"].astype(float), s.std(), equal_nan=True)
    late = P.rolling(df, "x", [], "mean", exclude_current=True).toPandas().sort_values("fecha")
    assert np.allclose(late["roll3_mean"].astype(float), s.mean().shift(1), equal_nan=True)


def test_panel_sums_drop_null_keys_and_zero_fill(spark):
    df = spark.createDataFrame([(date(2020, 1, 1), "a", 1.0), (date(2020, 1, 1), None, 5.0), (date(2020, 2, 1), "a", None)],
                               "fecha date, k string, monto double")
    got = {(r.fecha.month, r.k): r.monto for r in P.monthly_panel(df, ["k"]).collect()}
    assert got == {(1, "a"): 1.0, (2, "a"): 0.0}
    assert P.monthly_panel(df, ["k"], keep_null_keys=True).count() == 3


def test_time_index_counts_from_the_first_month(gap):
    got = {(r.k, r.fecha.month): r.t for r in P.time_index(gap).collect()}
    assert got[("a", 1)] == 0 and got[("b", 6)] == 5


def test_model_panel_keeps_time_index_of_dropped_rows(spark):
    df = spark.createDataFrame([(d, "x", "AMLO", float(i + 1)) for i, d in enumerate(_months(4))], "fecha date, subtema string, sexenio string, monto double")
    assert sorted(r.t for r in P.model_panel(df).collect()) == [1, 2, 3]


def test_split_and_fallback(spark):
    df = spark.createDataFrame([(d,) for d in _months(10, 2021)], "fecha date")
    train, test = P.temporal_split(df, date(2021, 4, 1))
    assert (train.count(), test.count()) == (3, 7)
    train, test = P.temporal_split(df, date(2030, 1, 1))
    assert (train.count(), test.count()) == (8, 2)
    train, test = P.temporal_split(df, date(2000, 1, 1))
    assert (train.count(), test.count()) == (8, 2)


def test_levels(spark):
    a, b = spark.createDataFrame([("x", 1), ("y", 2), ("y", 3)], "l string, i int"), spark.createDataFrame([("x", 9)], "l string, i int")
    assert [r.i for r in P.known_levels(a, b, "l").collect()] == [1]
    assert [r.l for r in P.unseen_levels(a, b, "l").collect()] == ["y"]


def test_folds_expand(spark):
    df = spark.createDataFrame([(i,) for i in range(23)], "i int")
    got = P.time_series_folds(df, ["i"], folds=5).toPandas().sort_values("i")
    assert got["fold"].tolist() == [0] * 8 + [f for f in range(1, 6) for _ in range(3)]


def test_profiles(spark):
    pdf = pd.DataFrame({"a": [1.0, 2.0, 3.0, 5.0, None], "s": ["x", "y", "x", None, "y"]})
    df = spark.createDataFrame(pdf, "a double, s string").replace(float("nan"), None)
    d = PR.describe_all(df).toPandas().set_index("column")
    want = pdf["a"].describe()
    assert np.allclose([d.loc["a", c] for c in ("count", "mean", "std", "min", "q25", "q50", "q75", "max")], want)
    assert (d.loc["s", "unique"], d.loc["s", "top"], d.loc["s", "freq"], d.loc["s", "count"]) == (2, "x", 2, 4)
    assert {r["column"]: r.n_null for r in PR.profile_nulls(df).collect()} == {"a": 1, "s": 1}
    assert PR.profile_types(df) == {"double": ["a"], "string": ["s"]}
    assert [tuple(r) for r in PR.value_counts(df, "s").collect()] == [("x", 2), ("y", 2)]
    assert {(r["column"], r.value, r["count"]) for r in PR.distinct_profile(df, ["s"]).collect()} == {("s", "x", 2), ("s", "y", 2)}


def test_star_schema(spark):
    df = spark.createDataFrame([("k1", "n1", 1.0), ("k1", "n2", 2.0), ("k2", "n3", 3.0)], "k string, n string, m double")
    parts = PR.decompose(df, {"dim": ["k", "n"]}, ["m"])
    assert parts["dim"].count() == 3 and parts["fact"].columns == ["k", "m"]
    assert [r.k for r in PR.check_key(df, ["k"], ["n"]).collect()] == ["k1"]


def test_top_k_breaks_ties_by_name(spark):
    df = spark.createDataFrame([("g", "b", 1.0), ("g", "a", 1.0), ("g", "c", 0.5)], "g string, sector string, monto double")
    got = [(r.sector, r["rank"]) for r in PR.top_k_per_group(df, ["g"], "sector", k=2).orderBy("rank").collect()]
    assert got == [("a", 1), ("b", 2)]


def test_box_statistics(spark, skewed):
    pdf, df = skewed
    got = box_stats(df, "g", "v").toPandas().set_index("g")
    for g, s in pdf.dropna(subset=["g"]).groupby("g")["v"]:
        q1, q3 = s.quantile([0.25, 0.75])
        low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        inside = s[(s >= low) & (s <= high)]
        assert np.allclose(got.loc[g, ["q1", "median", "q3", "whisker_low", "whisker_high"]].astype(float),
                           [q1, s.median(), q3, inside.min(), inside.max()])
        assert got.loc[g, "n_outliers"] == len(s) - len(inside)


def test_samples_do_not_depend_on_partitioning(spark, skewed):
    _, df = skewed
    pick = lambda d: sorted(r.id for r in sampling.sample_per_group(d, ["g"], ["id"], 20).collect())
    assert pick(df) == pick(df.repartition(3)) and len(pick(df)) == 80
    cap = lambda d: sorted(r.id for r in sampling.sample_cap(d, ["id"], 50).collect())
    assert cap(df) == cap(df.coalesce(1)) and len(cap(df)) == 50
    assert cap(df) != sorted(r.id for r in sampling.sample_cap(df, ["id"], 50, seed=7).collect())


def test_panel_plans_hold_no_python_and_no_single_task_window(spark):
    from panelkit.plans import QUERIES

    for name in ("lag1", "panel_features", "calendar_lag", "unigrams", "normalize_text"):
        plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "ArrowEval" not in plan, name
        assert "SinglePartition" not in plan, name
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_brackets_hold_quantiles_of_large_and_small_groups(spark, monkeypatch):
    rng = np.random.default_rng(8)
    parts = {"big": np.round(rng.normal(size=30_000), 2), "hot": np.where(rng.random(9_000) < 0.5, 1.5, rng.exponential(size=9_000)), "few": rng.normal(size=7), "one": np.array([3.0])}
    pdf = pd.DataFrame([(g, float(v)) for g, values in parts.items() for v in values], columns=["g", "v"])
    df = spark.createDataFrame(pdf).repartition(6).withColumn("w", -F.col("v"))
    probs = [0, 0.001, 0.25, 0.5, 0.75, 0.999, 1]
    monkeypatch.setattr(scan, "_sorted_quantiles", None)  # no bracket fails
    got = exact_quantiles(df, ["v", "w"], probs, ["g"]).toPandas()
    assert len(got) == 4 * 2 * 7
    for r in got.itertuples():
        want = np.quantile(parts[r.g] * (1 if r.column == "v" else -1), r.prob)
        assert np.isclose(r.value, want, rtol=1e-12, atol=1e-12), r
    monkeypatch.setattr(scan, "WINDOW_VALUES", 3)
    monkeypatch.setattr(scan, "FEW_GROUPS", 1)
    again = exact_quantiles(df, ["v", "w"], probs, ["g"]).toPandas()
    key = ["g", "column", "prob"]
    pd.testing.assert_frame_equal(got.sort_values(key, ignore_index=True), again.sort_values(key, ignore_index=True)[got.columns])
    nothing = exact_quantiles(df.where("v > 1e9"), ["v"], [0.5])
    assert nothing.count() == 0
