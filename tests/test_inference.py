from datetime import date
from itertools import product

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelkit.functions import tails as T
from panelkit.operators import hypothesis as H
from panelkit.operators import linear as L
from panelkit.operators.correlation import corr_matrix


@pytest.fixture(scope="module")
def math3(spark):
    return spark._jvm.org.apache.commons.math3


def test_tails_match_an_independent_library(math3):
    dist = math3.distribution
    for df in (1.0, 2.5, 7.0, 40.0, 1e4):
        for t in (-9.0, -1.3, 0.01, 0.7, 2.1, 30.0):
            want = 2 * dist.TDistribution(None, df).cumulativeProbability(-abs(t))
            assert np.isclose(T.t_sf2(t, df), want, rtol=1e-9, atol=1e-14)
    for d1, d2 in product((1.0, 3.0, 12.0), (2.0, 9.0, 480.0)):
        for f in (0.01, 0.9, 3.7, 45.0):
            want = 1 - dist.FDistribution(None, d1, d2).cumulativeProbability(f)
            assert np.isclose(T.f_sf(f, d1, d2), want, rtol=1e-8, atol=1e-12)
    for k in (1.0, 2.0, 5.0, 60.0):
        for x in (0.1, 2.0, 9.0, 80.0):
            want = 1 - dist.ChiSquaredDistribution(None, k).cumulativeProbability(x)
            assert np.isclose(T.chi2_sf(x, k), want, rtol=1e-8, atol=1e-12)
    assert np.isclose(T.norm_sf2(1.959963984540054), 0.05)
    assert 0 < T.t_sf2(60.0, 80) < 1e-60


def test_exact_rank_sum_by_enumeration():
    from itertools import combinations

    for n1, n2 in ((1, 1), (2, 3), (3, 5), (4, 4), (5, 2)):
        us = [sum(c) - n1 * (n1 + 1) / 2 for c in combinations(range(1, n1 + n2 + 1), n1)]
        for u in set(us):
            high = max(u, n1 * n2 - u)
            want = min(1.0, 2 * sum(x >= high for x in us) / len(us))
            assert np.isclose(T.rank_sum_exact(u, n1, n2), want)


def _two(spark, x, y):
    return spark.createDataFrame([("a", float(v)) for v in x] + [("b", float(v)) for v in y], "g string, v double")


def test_welch_and_hedges_closed_forms(spark):
    x, y = [1.0, 2.0, 3.0, 4.0], [2.0, 3.0, 4.0, 5.0]
    r = H.welch_t(_two(spark, x, y), "v", "g", "a", "b").first()
    assert np.isclose(r.df, 6) and np.isclose(r.t_stat, -1 / np.sqrt(2 * np.var(x, ddof=1) / 4))
    assert np.isclose(r.p_value, T.t_sf2(r.t_stat, 6))
    assert np.isclose(r.hedges_g, -1 / np.std(x, ddof=1) * (1 - 3 / (4 * 8 - 9)))


def test_hedges_edge_rules(spark):
    g = lambda x, y: H.hedges_g(_two(spark, x, y), "v", "g", "a", "b").first().hedges_g
    assert g([1], [1, 2]) is None
    assert g([3, 3], [5, 5]) == 0.0
    assert g([1, 2, 4], [1, 2, 3]) is not None
    assert H.welch_t(_two(spark, [1], [1, 2]), "v", "g", "a", "b").count() == 0


def _brute_u(x, y):
    return sum((a > b) + 0.5 * (a == b) for a in x for b in y)


def test_mann_whitney_brute_force_ties_and_symmetry(spark):
    rng = np.random.default_rng(0)
    x, y = rng.integers(0, 12, 30), rng.integers(2, 14, 25)
    ab = H.mann_whitney(_two(spark, x, y), "v", "g", "a", "b").first()
    ba = H.mann_whitney(_two(spark, x, y), "v", "g", "b", "a").first()
    assert ab.u_stat == _brute_u(x, y) and ab.u_stat + ba.u_stat == 30 * 25
    assert np.isclose(ab.p_value, ba.p_value) and 0 < ab.p_value < 1
    z = (ab.u_stat - 375) / np.sqrt(750 * 56 / 12)
    assert np.isclose(ab.effect_r, z / np.sqrt(55))
    small = H.mann_whitney(_two(spark, [1.0, 2.5], [2.0, 3.0, 4.0]), "v", "g", "a", "b").first()
    assert np.isclose(small.p_value, T.rank_sum_exact(small.u_stat, 2, 3))


def test_mann_whitney_per_group_matches_single_runs(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"by": rng.choice(list("pq"), 200), "g": rng.choice(["a", "b"], 200), "v": rng.integers(0, 30, 200).astype(float)})
    df = spark.createDataFrame(pdf)
    got = {r.by: r.u_stat for r in H.mann_whitney(df, "v", "g", "a", "b", ["by"]).collect()}
    for by, part in pdf.groupby("by"):
        assert got[by] == _brute_u(part.v[part.g == "a"], part.v[part.g == "b"])


def test_kruskal_of_two_groups_equals_squared_z(spark):
    rng = np.random.default_rng(2)
    x, y = rng.integers(0, 9, 20), rng.integers(1, 10, 22)
    df = _two(spark, x, y)
    k = H.kruskal(df, "v", "g").first()
    r = pd.Series([*x, *y]).rank()
    ties = (pd.Series([*x, *y]).value_counts() ** 3 - pd.Series([*x, *y]).value_counts()).sum()
    n, u = 42, H.mann_whitney(df, "v", "g", "a", "b").first().u_stat
    var = 20 * 22 / 12 * ((n + 1) - ties / (n * (n - 1)))
    assert np.isclose(k.h_stat, (u - 220) ** 2 / var)
    assert np.isclose(k.epsilon_sq, (k.h_stat - 1) / 41) and np.isclose(k.p_value, T.chi2_sf(k.h_stat, 1))
    assert r.iloc[:20].sum() - 210 == u
    single = spark.createDataFrame([("s", "a", 1.0), ("s", "a", 2.0), ("t", "a", 1.0), ("t", "b", 3.0)], "e string, g string, v double")
    assert [x.e for x in H.kruskal(single, "v", "g", ["e"]).collect()] == ["t"]


def _bh(p):
    p, m = np.asarray(p), len(p)
    order = np.argsort(p)
    adj = np.minimum.accumulate((p[order] * m / np.arange(1, m + 1))[::-1])[::-1]
    out = np.empty(m)
    out[order] = np.minimum(adj, 1)
    return out


def test_fdr(spark):
    p = [0.01, 0.04, 0.04, 0.2, 1.0, 0.03]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(p)] + [(9, None)], "k int, p double")
    got = H.fdr_bh(df, "p", key=["k"]).toPandas().sort_values("k")
    assert np.allclose(got["p_adj_fdr"][:6], _bh(p)) and pd.isna(got["p_adj_fdr"].iloc[6])
    assert got["rejected"][:6].tolist() == [v <= 0.05 for v in _bh(p)]
    assert H.fdr_bh(df.limit(0), "p", key=["k"]).count() == 0


def test_no_testable_group_gives_an_empty_table(spark):
    df = spark.createDataFrame([("s", "a", 1.0), ("s", "b", 2.0)], "k string, g string, v double")
    out = H.welch_by_group(df, "v", "g", "a", "b", "k")
    assert out.count() == 0 and "p_adj_fdr" in out.columns


def _rss(y, cols):
    x = np.column_stack(cols)
    return float(np.sum((y - x @ np.linalg.lstsq(x, y, rcond=None)[0]) ** 2)), np.linalg.matrix_rank(x)


def _anova_reference(pdf):
    one = [np.ones(len(pdf))]
    a = [(pdf.a == v).to_numpy(float) for v in sorted(pdf.a.unique())[1:]]
    b = [(pdf.b == v).to_numpy(float) for v in sorted(pdf.b.unique())[1:]]
    y = pdf.y.to_numpy()
    ra, rb, rab, full = _rss(y, one + a), _rss(y, one + b), _rss(y, one + a + b), _rss(y, one + a + b + [p * q for p in a for q in b])
    return {"C(a)": (rb[0] - rab[0], rab[1] - rb[1]), "C(b)": (ra[0] - rab[0], rab[1] - ra[1]),
            "C(a):C(b)": (rab[0] - full[0], full[1] - rab[1]), "Residual": (full[0], len(pdf) - full[1])}


@pytest.mark.parametrize("case", ["balanced", "unbalanced", "empty_cell", "wide_a"])
def test_anova_type_two(spark, case):
    rng = np.random.default_rng(11)
    levels = ("x", "y") if case != "wide_a" else tuple("pqrst")
    cells = [(a, b) for a in levels for b in ("u", "v", "w")]
    if case == "empty_cell":
        cells = cells[:-1]
    size = (lambda: 5) if case == "balanced" else (lambda: int(rng.integers(2, 9)))
    data = [(a, b, float(rng.normal(hash_ + 0.5 * i, 1))) for i, (a, b) in enumerate(cells) for hash_ in [len(a + b) * (a == "x")] for _ in range(size())]
    pdf = pd.DataFrame(data, columns=["a", "b", "y"])
    got = {r.term: r for r in H.anova_two_way(spark.createDataFrame(pdf), "y", "a", "b").collect()}
    want = _anova_reference(pdf)
    for term, (ss, df) in want.items():
        assert np.isclose(got[term].sum_sq, ss, atol=1e-8), term
        assert got[term].df == df, term
    ms = want["Residual"][0] / want["Residual"][1]
    for term in ("C(a)", "C(b)"):
        ss, df = want[term]
        assert np.isclose(got[term].F, ss / df / ms)
        assert np.isclose(got[term]["PR(>F)"], T.f_sf(ss / df / ms, df, want["Residual"][1]))
        assert np.isclose(got[term].eta_sq_partial, ss / (ss + want["Residual"][0]))
    if case == "balanced":
        total = ((pdf.y - pdf.y.mean()) ** 2).sum()
        assert np.isclose(sum(r.sum_sq for r in got.values()), total)


@pytest.fixture(scope="module")
def reg(spark):
    rng = np.random.default_rng(8)
    n = 120
    pdf = pd.DataFrame({"d": pd.date_range("2010-01-01", periods=n, freq="MS").date, "x1": rng.normal(100, 0.3, n), "x2": rng.normal(size=n),
                        "e": rng.choice(["A", "B"], n), "c": rng.choice(["r", "s", "t"], n)})
    pdf["y"] = 2 + 0.5 * pdf.x1 - pdf.x2 + (pdf.e == "B") * (1 + (pdf.c == "s")) + rng.normal(size=n) * (1 + pdf.x2.abs())
    df = spark.createDataFrame(pdf)
    design = L.fit_design(df, ["x1", "x2"], ["e", "c"], [("e", "c")])
    x = np.column_stack([np.ones(n), pdf.e == "B", pdf.c == "s", pdf.c == "t", (pdf.e == "B") & (pdf.c == "s"),
                         (pdf.e == "B") & (pdf.c == "t"), pdf.x1, pdf.x2]).astype(float)
    return pdf, df, design, x


def test_design_names_and_columns(spark, reg):
    pdf, df, design, x = reg
    assert design.names == ["Intercept", "C(e)[T.B]", "C(c)[T.s]", "C(c)[T.t]", "C(e)[T.B]:C(c)[T.s]", "C(e)[T.B]:C(c)[T.t]", "x1", "x2"]
    got = L.design_matrix(df, design, ["d"]).toPandas().sort_values("d").drop(columns="d").to_numpy()
    assert np.allclose(got, x)


def test_ols_hc3_matches_dense_algebra(spark, reg):
    pdf, df, design, x = reg
    y = pdf.y.to_numpy()
    m = L.ols(df, "y", design)
    inv = np.linalg.inv(x.T @ x)
    b = inv @ x.T @ y
    e, h = y - x @ b, np.einsum("ij,jk,ik->i", x, inv, x)
    cov = inv @ (x.T * (e / (1 - h)) ** 2) @ x @ inv
    assert np.allclose(m.coef, b, rtol=1e-6) and np.allclose(np.sqrt(np.diag(m.cov)), np.sqrt(np.diag(cov)), rtol=1e-6)
    assert m.df_resid == 112 and np.isclose(m.rss, e @ e)
    table = {r.term: r for r in L.coef_table(spark, m).collect()}
    r = table["x2"]
    assert np.isclose(r.ci95_high - r.coef, 1.96 * r.std_err) and np.isclose(r.p_value, T.t_sf2(r.t_value, 112))
    plain = L.ols(df, "y", design, cov=None)
    assert np.allclose(np.diag(plain.cov), np.diag(inv) * (e @ e) / 112, rtol=1e-6)
    fit = L.fit_metrics(spark, m).first()
    tss = ((y - y.mean()) ** 2).sum()
    assert np.isclose(fit.r2, 1 - e @ e / tss) and np.isclose(fit.r2_adj, 1 - (e @ e / 112) / (tss / 119))


def test_wide_and_narrow_cross_products_agree(spark, reg, monkeypatch):
    _, df, design, x = reg
    cols = [c for _, c in design.terms()]
    narrow = L.gram(df, cols, F.col("y"))
    monkeypatch.setattr(L, "WIDE", 2)
    wide = L.gram(df, cols, F.col("y"))
    assert narrow.n == wide.n == 120 and np.allclose(narrow.xtx, wide.xtx) and np.allclose(narrow.xty, wide.xty)
    assert np.allclose(narrow.xtx, x.T @ x)


def test_diagnostics(spark, reg):
    pdf, df, design, x = reg
    m = L.ols(df, "y", design)
    got = {r.measure: r.value for r in L.fit_diagnostics(df, m, ["d"]).collect()}
    y = pdf.y.to_numpy()
    e = y - x @ np.linalg.lstsq(x, y, rcond=None)[0]
    n, s2 = 120, e @ e / 120
    skew, kurt = np.mean(e**3) / s2**1.5, np.mean(e**4) / s2**2
    ll = -n / 2 * (np.log(2 * np.pi) + np.log(s2) + 1)
    want = {"log_likelihood": ll, "aic": -2 * ll + 16, "bic": -2 * ll + 8 * np.log(n), "skew": skew, "kurtosis": kurt,
            "jarque_bera": n / 6 * (skew**2 + (kurt - 3) ** 2 / 4), "durbin_watson": np.sum(np.diff(e) ** 2) / (e @ e),
            "condition_number": np.linalg.cond(x)}
    for k, v in want.items():
        assert np.isclose(got[k], v, rtol=1e-5), k
    b, v = m.coef[1:], m.cov[1:, 1:]
    assert np.isclose(got["f_robust"], b @ np.linalg.inv(v) @ b / 7) and got["df_model"] == 7
    assert got["omnibus"] > 0 and 0 <= got["omnibus_p"] <= 1


def test_exact_line_and_unseen_level(spark):
    df = spark.createDataFrame([(float(i), 3 + 2.0 * i) for i in range(12)], "x double, y double")
    m = L.ols(df, "y", L.fit_design(df, ["x"]))
    assert np.allclose(m.coef, [3, 2]) and m.rss < 1e-15
    out = L.regression_metrics(L.predict(df, m), "y", "y_pred", back_transform=False).first()
    assert np.isclose(out.r2, 1) and out.rmse < 1e-9
    flat = df.withColumn("y", F.lit(4.0)).withColumn("p", F.lit(4.0))
    assert L.regression_metrics(flat, "y", "p").first().r2 is None


def test_fits_per_group_equal_single_fits(spark, reg):
    pdf, df, _, _ = reg
    got = {r.c: r.coef for r in L.fit_by(df, "y", ["x1", "x2"], ["c"]).collect()}
    for c, part in pdf.groupby("c"):
        x = np.column_stack([np.ones(len(part)), part.x1, part.x2])
        assert np.allclose(got[c], np.linalg.lstsq(x, part.y, rcond=None)[0], rtol=1e-6)


def test_correlations_match_pandas(spark, reg):
    pdf, df, _, _ = reg
    cols = ["x1", "x2", "y", "k"]
    pdf, df = pdf.assign(k=pdf.x2.round()), df.withColumn("k", F.rint("x2"))
    for method in ("pearson", "spearman"):
        want = pdf[cols].corr(method=method)
        got = corr_matrix(df, cols, method).collect()
        assert len(got) == 16
        for r in got:
            assert np.isclose(r.r, want.loc[r.a, r.b]), (method, r.a, r.b)


def test_global_table(spark):
    df = spark.createDataFrame([(date(2020, i % 12 + 1, 1), "a" if i < 6 else "b", float(i), float(np.arcsinh(i))) for i in range(12)],
                               "fecha date, era string, monto double, monto_asinh double")
    got = {r.test: r for r in H.global_tests(df, "era", "a", "b").collect()}
    assert set(got) == {"Welch_t_asinh", "MannWhitney_monto"} and got["MannWhitney_monto"].statistic == 0
