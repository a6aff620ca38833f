"""Cases that earlier versions got wrong: nulls, tails, dates, files, empty tables, worker imports."""

import math
import os
import subprocess
import sys
from itertools import combinations
from pathlib import Path

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from panelkit.functions import dates as D
from panelkit.functions import tails as T
from panelkit.operators import clustering as C
from panelkit.operators import hypothesis as H
from panelkit.operators import linear as L
from panelkit.sources import tables as S


def test_exact_rank_sum():
    def brute(u, n1, n2):
        low = min(u, n1 * n2 - u)
        stats = [sum(s) - n1 * (n1 - 1) // 2 for s in combinations(range(n1 + n2), n1)]
        return min(1.0, 2 * sum(x <= low for x in stats) / len(stats))

    assert all(math.isclose(T.rank_sum_exact(u, a, b), brute(u, a, b)) for a in range(1, 6) for b in range(1, 7) for u in range(a * b + 1))
    assert math.isclose(T.rank_sum_exact(0, 8, 1000), 2 / math.comb(1008, 8))
    # Partitions of at most 5 into at most 8 parts: 1 + 1 + 2 + 3 + 5 + 7.
    assert math.isclose(T.rank_sum_exact(5, 8, 5000), 2 * 19 / math.comb(5008, 8)) and math.isclose(T.rank_sum_exact(5, 1000, 8), 2 * 19 / math.comb(1008, 8))


def test_rank_sum_methods(spark):
    df = spark.createDataFrame([(0.0, 8.0, 1000.0, 0.0), (4000.0, 8.0, 1e9, 0.0)], "u double, a double, b double, t double")
    exact, auto = (df.select(T.rank_sum_pvalue("u", "a", "b", "t", method=m).alias("p")).collect() for m in ("exact", "auto"))
    normal = df.select(T.rank_sum_pvalue("u", "a", "b", "t", method="asymptotic").alias("p")).first().p
    assert exact[0].p == auto[0].p == T.rank_sum_exact(0, 8, 1000) and normal > 1e-7 > exact[0].p > 0 and 0 < auto[1].p < 1e-5


def test_tails_of_large_parameters():
    assert math.isclose(T.gamma_upper(1e8, 1e8), 0.4999867, abs_tol=1e-7) and math.isclose(T.gamma_upper(1e10, 1e10), 0.4999987, abs_tol=1e-7)
    assert math.isclose(T.t_sf2(1, 1e12), math.erfc(math.sqrt(0.5)), rel_tol=1e-9)
    assert math.isclose(T.gamma_upper(0.5, 3.2), math.erfc(math.sqrt(3.2)), rel_tol=1e-12)
    assert math.isclose(T.gamma_upper(999_999.9, 1_001_000), T.gamma_upper(1_000_000.1, 1_001_000.2), rel_tol=1e-4)
    assert math.isclose(T.f_sf(2.0, 2, 1e9), math.exp(-2.0), rel_tol=1e-6) and math.isclose(T.chi2_sf(7.0, 2), math.exp(-3.5), rel_tol=1e-12)
    assert math.isclose(T.beta_inc(3, 4, 0.3), 1 - T.beta_inc(4, 3, 0.7), rel_tol=1e-12)
    assert math.isclose(T.log_beta(2e4, 3e4), math.lgamma(2e4) + math.lgamma(3e4) - math.lgamma(5e4), rel_tol=1e-10)


@pytest.mark.parametrize("wide", [False, True])
def test_least_squares_leaves_incomplete_rows_out(spark, monkeypatch, wide):
    if wide:
        monkeypatch.setattr(L, "WIDE", 1)
    rng = np.random.default_rng(0)
    x, z = rng.normal(size=60), rng.normal(size=60)
    good = [(float(2 * a + 3 * b - 0.25), float(a), float(b), "pq"[i % 2]) for i, (a, b) in enumerate(zip(x, z))]
    bad = [(1e6, None, 1.0, "p"), (None, 5.0, 5.0, "q"), (1e6, 1.0, float("nan"), "p"), (1e6, 1.0, 1.0, None)]
    for parts in (1, 4):
        df = spark.createDataFrame(good + bad, "y double, x double, z double, f string").repartition(parts)
        model = L.ols(df, "y", L.fit_design(df, ["x", "z"], ["f"]))
        assert model.n == 60 and np.allclose(model.coef, [-0.25, 0.0, 2.0, 3.0], atol=1e-8)
    assert dict(L.fit_diagnostics(df.withColumn("i", F.monotonically_increasing_id()), model, ["i"]).collect())["n"] == 60


def test_dates_of_mixed_form(spark):
    iso = [f"2019-0{m}-13" for m in range(1, 8)]
    read = lambda texts: [str(r.fecha) for r in D.resolve_date(spark.createDataFrame([(t,) for t in texts], "fecha string")).collect()]
    assert len(read(iso + ["25/12/2018", "26/12/2018", "27/12/2018"])) == 10
    assert read(["2019-02-13 00:00:00", "2019-03-01T10:11:12"]) == ["2019-02-01", "2019-03-01"]
    assert read(["1/2/2019", "01/02/2019"]) == ["2019-01-01"] * 2
    assert read(["13/2/2019", "1/2/2019"]) == ["2019-02-01"] * 2
    with pytest.raises(Exception, match="can be read"):
        read(["soon", "later"])


def test_csv_line_breaks_quotes_and_encodings(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text('ciclo,mes,nota,monto\n2019,Enero,"dos\nlíneas, ""y"" comas",1.5\n2020,Mayo,ñ,2\n', encoding="utf-8")
    (tmp_path / "in" / "b.csv").write_text("ciclo,mes,nota,monto\n2021,Junio,año,3\n", encoding="latin-1")
    rows = sorted(map(tuple, S.read_facts(spark, str(tmp_path / "in")).collect()))
    assert rows == [(2019, "Enero", 'dos\nlíneas, "y" comas', 1.5), (2020, "Mayo", "ñ", 2.0), (2021, "Junio", "año", 3.0)]
    (tmp_path / "bad.csv").write_text("a,b\n1,2\n1,2,3\n")
    with pytest.raises(Exception):
        S.read_facts(spark, str(tmp_path / "bad.csv"), encodings=["UTF-8"]).collect()


def test_slices_of_one_slug_stay_apart(spark, tmp_path):
    df = spark.createDataFrame([("A b", 1), ("a-b", 2), ("c", 3), ("c", 4)], "k string, v int")
    S.write_slices(df, "k", str(tmp_path / "s"))
    folders = [p.name for p in (tmp_path / "s").iterdir() if p.is_dir()]
    assert len(folders) == 3 and "slice=c" in folders
    assert spark.read.option("header", True).csv(str(tmp_path / "s")).count() == 4


def test_empty_analysis_of_variance(spark):
    empty = H.anova_two_way(spark.createDataFrame([], "y double, a string, b string"), "y", "a", "b")
    full = H.anova_two_way(spark.createDataFrame([(float(i), "xy"[i % 2], "pq"[i // 2 % 2]) for i in range(12)], "y double, a string, b string"), "y", "a", "b")
    assert empty.count() == 0 and sorted(empty.columns) == sorted(full.columns)


def test_few_columns_are_not_rotated(spark):
    df = spark.createDataFrame([([1.0, 2.0],), ([3.0, 5.0],)], "x array<double>").withColumn("features", array_to_vector("x"))
    assert [(r.pc1, r.pc2, r.explained) for r in C.pca_2d(df).collect()] == [(1.0, 2.0, 1.0), (3.0, 5.0, 1.0)]
    one = spark.createDataFrame([([1.0],)], "x array<double>").withColumn("features", array_to_vector("x"))
    assert C.pca_2d(one).select("pc1", "pc2").first() == (1.0, None)


def test_linear_silhouette_equals_pairs(spark):
    rng = np.random.default_rng(3)
    x, c = rng.normal(size=(60, 3)), np.append(rng.integers(0, 4, 59), 9)
    d2 = ((x[:, None] - x[None]) ** 2).sum(axis=2)
    want = []
    for i in range(60):
        means = {k: d2[i][c == k].sum() / ((c == k).sum() - (k == c[i])) for k in set(c) if (c == k).sum() - (k == c[i])}
        b = min(v for k, v in means.items() if k != c[i])
        want.append((b - means[c[i]]) / max(b, means[c[i]]) if c[i] in means else 0.0)
    df = spark.createDataFrame([(list(map(float, e)), int(k)) for e, k in zip(x, c)], "x array<double>, cluster int")
    assert np.isclose(C.silhouette_linear(df).first()[0], np.mean(want))


def test_workers_load_the_package_from_any_folder(tmp_path):
    repo = Path(__file__).resolve().parents[1]
    code = (f"import sys; sys.path.insert(0, {str(repo)!r})\nimport __spark_entry__ as e\nfrom panelkit.session import local_session\n"
            "s = local_session(2)\nq = e.queries()\n"
            "for n in ('knn_neighbors', 'fdr_bh'):\n    assert q[n](s, '/root/testdata/sf0.001').count() > 0\nprint('fine')")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert done.stdout.strip().endswith("fine"), done.stderr[-2000:]


def test_month_ranges_reach_the_scan(spark, tmp_path):
    from datetime import date

    spark.range(800).select(F.expr("timestamp_ntz'2019-01-01 12:00:00' + make_dt_interval(int(id))").alias("ts"), "id").write.parquet(str(tmp_path / "t"))
    raw = spark.read.parquet(str(tmp_path / "t"))
    ranges = [("a", date(2019, 2, 1), date(2019, 3, 1)), ("b", date(2019, 12, 15), date(2020, 1, 31)), ("c", date(2020, 12, 2), date(2021, 2, 1))]
    kept = D.months_in_ranges(raw, "ts", ranges)
    want = raw.where(D.in_ranges(F.trunc("ts", "month"), ranges))
    assert kept.exceptAll(want).isEmpty() and want.exceptAll(kept).isEmpty() and kept.count() == 28 + 31 + 31 + 31 + 28
    assert "GreaterThanOrEqual(ts" in kept._jdf.queryExecution().executedPlan().toString()


def test_t_quantiles_and_intervals_by_level(spark):
    from panelkit.functions.tails import t_quantile
    from panelkit.operators import linear as L

    assert math.isclose(t_quantile(0.975, 1), math.tan(math.pi * 0.475), rel_tol=1e-12)
    for p in (0.6, 0.9, 0.995):
        assert math.isclose(t_quantile(p, 2), (2 * p - 1) * math.sqrt(2 / (1 - (2 * p - 1) ** 2)), rel_tol=1e-12)
    assert math.isclose(t_quantile(0.975, math.inf), 1.959963984540054, rel_tol=1e-12) and math.isclose(t_quantile(0.975, 1e7), 1.95996422, rel_tol=1e-8)
    assert t_quantile(0.5, 5) < 1e-12 and t_quantile(0.975, 0) is None
    df = spark.createDataFrame([(float(x), 2.0 * x + (-1) ** x) for x in range(8)], "x double, y double")
    model = L.ols(df, "y", L.fit_design(df, ["x"]), cov=None)
    for kwargs, q in (({}, 1.96), ({"level": 0.95}, t_quantile(0.975, 6)), ({"level": 0.95, "t": False}, t_quantile(0.975, math.inf))):
        for r in L.coef_table(spark, model, p_value=False, **kwargs).collect():
            assert math.isclose(r.ci95_high - r.ci95_low, 2 * q * r.std_err, rel_tol=1e-12)
    two = df.limit(2)
    assert {r.ci95_low for r in L.coef_table(spark, L.ols(two, "y", L.fit_design(two, ["x"]), cov=None), p_value=False, level=0.9).collect()} == {None}


def test_more_levels_than_columns_fail(spark, monkeypatch):
    from panelkit.operators import linear as L

    monkeypatch.setattr(L, "MOST_LEVELS", 3)
    df = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", None)], "f string, g string")
    with pytest.raises(ValueError, match="more than 3 levels"):
        L.fit_design(df, [], ["f", "g"])
    assert L.fit_design(df, [], ["f"]).factors == (("f", ("a", "b", "c")),)


def test_false_discovery_by_windows_and_by_ranges(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [("ab"[i % 2], i, None if i % 9 == 0 else float(rng.integers(1, 20)) / 40) for i in range(60)]
    df = spark.createDataFrame(rows, "g string, k int, p double")
    one = {tuple(r) for r in H.fdr_bh(df, "p", 0.3, ["g"], ["k"]).select("g", "k", "p_adj_fdr", "rejected").collect()}
    monkeypatch.setattr(H, "FEW_TESTS", 0)
    assert {tuple(r) for r in H.fdr_bh(df, "p", 0.3, ["g"], ["k"]).select("g", "k", "p_adj_fdr", "rejected").collect()} == one


def test_limit_law_of_the_rank_sum():
    worst = {}
    for n1 in range(1, 9):
        for n2 in (250, 1000):
            us = [0, 1, 5, *range(n2 // 3, n1 * n2 // 2 + 1, max(1, n1 * n2 // 60))]
            worst[n1, n2] = max(abs(T.rank_sum_limit(u, n1, n2) - T.rank_sum_exact(u, n1, n2)) for u in us)
    assert worst[1, 250] < 1e-12 and max(v for (_, n), v in worst.items() if n == 1000) < 2e-5
    assert all(worst[k, 1000] < worst[k, 250] / 8 for k in range(2, 9))  # falls with the square of the size
    small = [T._rank_sum(u, 8, 31_000, 0, "auto", 1_000_000) for u in (100, 100_000)]
    large = [T._rank_sum(u, 8, 31_500, 0, "auto", 1_000_000) for u in (100, 100_000 * 31_500 / 31_000)]
    assert math.isclose(small[1], large[1], rel_tol=1e-5) and small[0] > 0 and large[0] > 0


def test_absorbed_factor_equals_indicators(spark, monkeypatch):
    from panelkit.operators import scan

    rng = np.random.default_rng(6)
    level = np.concatenate([rng.integers(0, 9, 200), [50, 51]])  # two levels of a single row
    x, small = rng.normal(size=202) + level / 5, rng.choice(list("pq"), 202)
    y = 3 * x + level + 2.0 * (small == "q") + rng.normal(size=202) * (1 + np.abs(x))
    rows = [(int(a), float(b), str(c), float(v), float(a) * 2) for a, b, c, v in zip(level, x, small, y)] + [(None, 1.0, "p", 1.0, 1.0), (3, None, "p", 1.0, 1.0)]
    df = spark.createDataFrame(rows, "g int, x double, s string, y double, fixed double")
    design = L.fit_design(df, ["x", "fixed"], ["s"])
    big = np.column_stack([small == "q", x, *[level == v for v in np.unique(level)]]).astype(float)
    inv = np.linalg.inv(big.T @ big)
    coef = inv @ big.T @ y
    e, h = y - big @ coef, np.einsum("ij,jk,ik->i", big, inv, big)
    keep = h < 1 - 1e-9
    cov = inv @ (big[keep].T * (e[keep] / (1 - h[keep])) ** 2) @ big[keep] @ inv
    for few in (10_000, 0):
        monkeypatch.setattr(scan, "FEW_GROUPS", few)
        m = L.ols_absorbed(df, "y", design, "g")
        assert m.names == ("C(s)[T.q]", "x", "fixed") and np.isnan(m.coef[2]) and np.allclose(m.coef[:2], coef[:2])
        assert np.allclose(np.diag(m.cov)[:2], np.diag(cov)[:2]) and (m.n, m.levels, m.df_resid) == (202, 11, 189)
        assert math.isclose(m.rss, float(e @ e)) and math.isclose(m.tss, float(((y - y.mean()) ** 2).sum()))
        assert np.allclose([r.effect for r in m.effects.orderBy("level").collect()], coef[2:])
    table = {r.term: r for r in L.absorbed_table(spark, m).collect()}
    assert table["fixed"].coef is None and table["x"].low < table["x"].coef < table["x"].high


def test_absorbed_factor_of_very_many_levels(spark):
    df = spark.range(300_000).selectExpr("id % 100000 AS g", "cast(id % 7 + id % 100000 AS double) AS x", "cast(2 * (id % 7 + id % 100000) + id % 100000 AS double) AS y")
    m = L.ols_absorbed(df, "y", L.Design(("x",)), "g")
    assert m.levels == 100_000 and math.isclose(m.coef[0], 2, rel_tol=1e-9) and m.rss < 1e-6
    assert m.effects.where("abs(effect - level) > 1e-6").isEmpty()
