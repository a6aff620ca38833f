"""Hypothesis tests, correlations and the linear model."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelkit.operators import hypothesis as H
from panelkit.operators import linear as L
from panelkit.operators.correlation import corr_matrix
from panelkit.operators.panel import known_levels, model_panel, monthly_panel, temporal_split
from panelkit.plans.ols_sql import ols_ctes
from panelkit.plans.registry import FACTS_SQL, facts, panel_sql, query, r, rounded
from panelkit.session import materialize
from panelkit.sources.adapters import ERA_A, ERA_B, LINEITEM_HOLDOUT, table

ERA_KEYS = ["sexenio", "subtema"]
PANEL_SQL = f"""{FACTS_SQL}, panel AS (SELECT fecha, sexenio, subtema, sum(monto) AS monto, asinh(sum(monto)) AS v FROM facts GROUP BY ALL)"""


def _panel(spark, d):
    return monthly_panel(facts(spark, d), ERA_KEYS)


@query("anova_cells", f"""WITH {PANEL_SQL} SELECT sexenio, subtema, count(v) AS n, {r('avg(v)')} AS mean, {r('var_pop(v) * count(v)')} AS m2
  FROM panel GROUP BY 1, 2""")
def anova_cells(spark, d):
    return rounded(H.anova_cells(_panel(spark, d), "monto_asinh", "sexenio", "subtema"))


ANOVA_SQL = f"""WITH {PANEL_SQL},
  cells AS (SELECT sexenio, subtema, count(*) AS n, avg(v) AS m, var_pop(v) * count(*) AS m2, sum(v) AS s FROM panel GROUP BY ALL),
  tot AS (SELECT sum(n) AS n, sum(m2) AS rss_full, sum(s) / sum(n) AS g, count(*) AS cells, count(DISTINCT sexenio) AS ka,
          count(DISTINCT subtema) AS kb FROM cells),
  cb AS (SELECT subtema, sum(n) AS nb, sum(s) / sum(n) AS mb FROM cells GROUP BY 1),
  ca AS (SELECT sexenio, sum(n) AS na, sum(s) / sum(n) AS ma FROM cells GROUP BY 1),
  one AS (SELECT sum(c.n * (1 - c.n / b.nb)) AS s, sum(c.n * (c.m - b.mb)) AS r FROM cells c JOIN cb b USING (subtema) WHERE sexenio = 'after'),
  parts AS (SELECT (SELECT sum(nb * (mb - g) ** 2) FROM cb, tot) AS ss_b, (SELECT sum(na * (ma - g) ** 2) FROM ca, tot) AS ss_a,
            (SELECT sum(n_ * (m - g) ** 2) FROM (SELECT cells.n AS n_, m, g FROM cells, tot)) AS ss_c, (SELECT r * r / s FROM one) AS gain),
  t AS (SELECT 'C(sexenio)' AS term, gain AS ss, ka - 1 AS df FROM parts, tot
    UNION ALL SELECT 'C(subtema)', ss_b + gain - ss_a, kb - 1 FROM parts, tot
    UNION ALL SELECT 'C(sexenio):C(subtema)', ss_c - ss_b - gain, cells - ka - kb + 1 FROM parts, tot)
  SELECT term, {r('ss')} AS sum_sq, df::DOUBLE AS df, {r('(ss / df) / (rss_full / (n - cells))', 4)} AS "F", {r('ss / (ss + rss_full)')} AS eta_sq_partial
  FROM t, tot UNION ALL SELECT 'Residual', {r('rss_full')}, (n - cells)::DOUBLE, NULL, NULL FROM tot"""


@query("anova_two_way", ANOVA_SQL)
def anova_two_way(spark, d):
    out = H.anova_two_way(_panel(spark, d), "monto_asinh", "sexenio", "subtema", p_value=False)
    return rounded(out.withColumn("F", F.round("F", 4)))


def _welch_sql(source: str, y: str, by: str) -> str:
    a, b = "FILTER (sexenio = 'before')", "FILTER (sexenio = 'after')"
    key, group = (f"{by}, ", f"GROUP BY {by}") if by else ("", "")
    return f"""m AS (SELECT {key}count({y}) {a} AS n_a, avg({y}) {a} AS m_a, var_samp({y}) {a} AS v_a,
      count({y}) {b} AS n_b, avg({y}) {b} AS m_b, var_samp({y}) {b} AS v_b FROM {source} {group}),
    w AS (SELECT {key}n_a, n_b, (m_a - m_b) / sqrt(v_a / n_a + v_b / n_b) AS t_stat,
      (v_a / n_a + v_b / n_b) ** 2 / ((v_a / n_a) ** 2 / (n_a - 1) + (v_b / n_b) ** 2 / (n_b - 1)) AS df,
      (m_a - m_b) / sqrt(((n_a - 1) * v_a + (n_b - 1) * v_b) / (n_a + n_b - 2)) * (1 - 3.0::DOUBLE / (4 * (n_a + n_b) - 9)) AS g
      FROM m WHERE n_a > 1 AND n_b > 1)"""


@query("welch_global", f"""WITH {FACTS_SQL}, {panel_sql('sexenio')}, {_welch_sql('panel', 'monto_asinh', '')}
  SELECT n_a, n_b, {r('t_stat')} AS t_stat, {r('df')} AS df, {r('g')} AS hedges_g FROM w""")
def welch_global(spark, d):
    total = monthly_panel(facts(spark, d), ["sexenio"])
    return rounded(H.welch_t(total, "monto_asinh", "sexenio", ERA_A, ERA_B, p_value=False))


def t_tail_sql(t: str, df: str, steps: int = 2000) -> str:
    """Two-sided tail of the t distribution: with t = sqrt(df) tan(x) it is a share of the integral of cos(x)^(df - 1), here by Simpson's rule."""
    first = f"atan(abs({t}) / sqrt({df}))"
    x = f"({first} + (pi() / 2 - {first}) * i / {steps})"
    weight = f"CASE WHEN i IN (0, {steps}) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END"
    whole = f"(sqrt(pi()) / 2 * exp(lgamma({df} / 2) - lgamma(({df} + 1) / 2)))"
    return f"(SELECT sum({weight} * pow(greatest(cos{x}, 0), {df} - 1)) FROM range({steps + 1}) s(i)) * (pi() / 2 - {first}) / {3 * steps} / {whole}"


@query("welch_by_group", f"""WITH {PANEL_SQL}, {_welch_sql('panel', 'v', 'subtema')},
  p AS (SELECT *, {t_tail_sql('t_stat', 'df')} AS p FROM w), k AS (SELECT *, row_number() OVER (ORDER BY p, subtema) AS i, count(*) OVER () AS m FROM p),
  a AS (SELECT *, least(1.0, min(p * m / i) OVER (ORDER BY i DESC)) AS adj FROM k)
  SELECT subtema, n_a, n_b, {r('t_stat')} AS t_stat, {r('df')} AS df, {r('g')} AS hedges_g, {r('p')} AS p_value, {r('adj')} AS p_adj_fdr, adj <= 0.05 AS rejected FROM a""")
def welch_by_group(spark, d):
    return rounded(H.welch_by_group(_panel(spark, d), "monto_asinh", "sexenio", ERA_A, ERA_B, "subtema"))


@query("hedges_g", f"""WITH t AS (SELECT CASE WHEN c_custkey % 97 = 0 THEN -c_custkey ELSE c_nationkey END AS nation,
    CASE WHEN c_mktsegment = 'BUILDING' THEN 'before' ELSE 'after' END AS sexenio, c_acctbal FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')),
  m AS (SELECT nation, count(c_acctbal) FILTER (sexenio = 'before') AS n_a, avg(c_acctbal) FILTER (sexenio = 'before') AS m_a, var_samp(c_acctbal) FILTER (sexenio = 'before') AS v_a,
    count(c_acctbal) FILTER (sexenio = 'after') AS n_b, avg(c_acctbal) FILTER (sexenio = 'after') AS m_b, var_samp(c_acctbal) FILTER (sexenio = 'after') AS v_b FROM t GROUP BY 1)
  SELECT nation, n_a, n_b, CASE WHEN n_a < 2 OR n_b < 2 THEN NULL WHEN v_a = 0 AND v_b = 0 THEN 0
    ELSE {r('(m_a - m_b) / sqrt(((n_a - 1) * v_a + (n_b - 1) * v_b) / (n_a + n_b - 2)) * (1 - 3.0::DOUBLE / (4 * (n_a + n_b) - 9))')} END AS hedges_g FROM m""")
def hedges_g(spark, d):
    # Some customers are a nation of their own: groups with one value or none on a side, which have no effect size.
    nation = F.when(F.col("c_custkey") % 97 == 0, -F.col("c_custkey")).otherwise(F.col("c_nationkey")).cast("long")
    rows = table(spark, d, "customer").withColumn("nation", nation)
    return rounded(H.hedges_g(rows, "c_acctbal", "c_mktsegment", "BUILDING", "MACHINERY", ["nation"]))


def _ranks_sql(source: str, y: str, by: str) -> str:
    part = f"PARTITION BY {by} " if by else ""
    same = f"PARTITION BY {by}, {y}" if by else f"PARTITION BY {y}"
    return (f"rk AS (SELECT *, rank() OVER ({part}ORDER BY {y}) + (count(*) OVER ({same}) - 1) / 2.0::DOUBLE AS rk, "
            f"count(*) OVER ({same}) AS c FROM {source})")


@query("mann_whitney", f"""WITH t AS (SELECT l_returnflag AS flag, l_linestatus AS side, l_quantity AS q FROM lineitem), {_ranks_sql('t', 'q', 'flag')},
  u AS (SELECT flag, count(*) FILTER (side = 'F') AS n_a, count(*) FILTER (side = 'O') AS n_b, sum(rk) FILTER (side = 'F') AS r1 FROM rk GROUP BY 1)
  SELECT flag, n_a, n_b, r1 - n_a * (n_a + 1) / 2.0::DOUBLE AS u_stat,
    {r('(r1 - n_a * (n_a + 1) / 2.0::DOUBLE - n_a::DOUBLE * n_b / 2) / sqrt(n_a::DOUBLE * n_b * (n_a + n_b + 1) / 12) / sqrt(n_a + n_b)')} AS effect_r FROM u""")
def mann_whitney(spark, d):
    rows = table(spark, d, "lineitem").select(F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("side"),
                                              F.col("l_quantity").alias("q"))
    return rounded(H.mann_whitney(rows, "q", "side", "F", "O", ["flag"], p_value=False))


@query("kruskal", f"""WITH t AS (SELECT l_linestatus AS status, l_returnflag AS grp, l_quantity AS q FROM lineitem), {_ranks_sql('t', 'q', 'status')},
  g AS (SELECT status, grp, count(*) AS n, sum(rk) AS s FROM rk GROUP BY 1, 2),
  h AS (SELECT status, count(*) AS k, sum(n)::BIGINT AS n, sum(s * s / n) AS x FROM g GROUP BY 1),
  tie AS (SELECT status, sum(c::DOUBLE * c * c - c) AS t3 FROM (SELECT DISTINCT status, q, c FROM rk) GROUP BY 1),
  o AS (SELECT status, k, n, (12 * x / (n::DOUBLE * (n + 1)) - 3 * (n + 1)) / (1 - t3 / (n::DOUBLE * n * n - n)) AS h_stat FROM h JOIN tie USING (status))
  SELECT status, k, n, {r('h_stat', 4)} AS h_stat, {r('(h_stat - (k - 1)) / (n - 1)')} AS epsilon_sq FROM o""")
def kruskal(spark, d):
    rows = table(spark, d, "lineitem").select(F.col("l_linestatus").alias("status"), F.col("l_returnflag").alias("grp"),
                                              F.col("l_quantity").alias("q"))
    out = H.kruskal(rows, "q", "grp", ["status"], p_value=False)
    return rounded(out.withColumn("h_stat", F.round("h_stat", 4)))


@query("fdr_bh", """WITH t AS (SELECT l_returnflag AS flag, l_suppkey, avg(l_discount) / 0.2 AS p FROM lineitem GROUP BY 1, 2),
  k AS (SELECT *, row_number() OVER (PARTITION BY flag ORDER BY p, l_suppkey) AS i, count(*) OVER (PARTITION BY flag) AS m FROM t),
  a AS (SELECT flag, l_suppkey, p, least(1.0, min(p * m / i) OVER (PARTITION BY flag ORDER BY i DESC)) AS adj FROM k)
  SELECT flag, l_suppkey, round(p, 6) AS p, round(adj, 6) AS p_adj_fdr, adj <= 0.3 AS rejected FROM a""")
def fdr_bh(spark, d):
    tests = table(spark, d, "lineitem").groupBy(F.col("l_returnflag").alias("flag"), "l_suppkey").agg(
        (F.avg("l_discount") / 0.2).alias("p"))
    return rounded(H.fdr_bh(tests, "p", alpha=0.3, by=["flag"], key=["l_suppkey"]))


@query("global_tests", f"""WITH {FACTS_SQL}, {panel_sql('sexenio')}, {_welch_sql('panel', 'monto_asinh', '')}, {_ranks_sql('panel', 'monto', '')},
  u AS (SELECT count(*) FILTER (sexenio = 'before') AS a, count(*) FILTER (sexenio = 'after') AS b, sum(rk) FILTER (sexenio = 'before') AS r1 FROM rk),
  v AS (SELECT a, b, r1 - a * (a + 1) / 2.0::DOUBLE AS u FROM u)
  SELECT 'Welch_t_asinh' AS test, {r('t_stat')} AS statistic, {r('g')} AS effect_size FROM w
  UNION ALL SELECT 'MannWhitney_monto', u, {r('(u - a * b / 2.0::DOUBLE) / sqrt(a * b * (a + b + 1) / 12.0::DOUBLE) / sqrt(a + b)')} FROM v""")
def global_tests(spark, d):
    total = materialize(monthly_panel(facts(spark, d), ["sexenio"]))
    return rounded(H.global_tests(total, "sexenio", ERA_A, ERA_B, p_value=False))


CORR_COLS = ["monto_asinh", "t", "sin12", "cos12", "lag1", "sexenio_bin"]
MODEL_SQL = f"""{PANEL_SQL}, t0 AS (SELECT min(12 * year(fecha) + month(fecha)) AS t0 FROM panel),
  lagged AS (SELECT fecha, sexenio, subtema, v AS monto_asinh, (12 * year(fecha) + month(fecha) - t0)::DOUBLE AS t,
    sin(2*pi()*month(fecha)/12) AS sin12, cos(2*pi()*month(fecha)/12) AS cos12,
    lag(v) OVER (PARTITION BY subtema ORDER BY fecha) AS lag1, (sexenio = 'after')::INT AS sexenio_bin FROM panel, t0),
  model AS (SELECT * FROM lagged WHERE lag1 IS NOT NULL)"""


def _corr_sql(source: str) -> str:
    return " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, {r(f'corr({a}, {b})')} AS r FROM {source}" for a in CORR_COLS for b in CORR_COLS)


def _model(spark, d):
    return model_panel(facts(spark, d), positive=ERA_B)


@query("corr_pearson", f"WITH {MODEL_SQL} {_corr_sql('model')}")
def corr_pearson(spark, d):
    return rounded(corr_matrix(_model(spark, d), CORR_COLS, "pearson"))


# sin12/cos12 take the same value in different months up to rounding noise, so ranks use the rounded columns.
_RANKED = ", ".join(f"rank() OVER (ORDER BY round({c}, 9)) + (count(*) OVER (PARTITION BY round({c}, 9)) - 1) / 2.0::DOUBLE AS {c}" for c in CORR_COLS)


@query("corr_spearman", f"WITH {MODEL_SQL}, ranked AS (SELECT {_RANKED} FROM model) {_corr_sql('ranked')}")
def corr_spearman(spark, d):
    rows = _model(spark, d).select(*[F.round(c, 9).alias(c) for c in CORR_COLS])
    return rounded(corr_matrix(rows, CORR_COLS, "spearman"))


@query("corr_spearman_rows", """WITH k AS (SELECT rank() OVER (ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_quantity) - 1) / 2.0::DOUBLE AS q,
    rank() OVER (ORDER BY l_extendedprice) + (count(*) OVER (PARTITION BY l_extendedprice) - 1) / 2.0::DOUBLE AS e,
    rank() OVER (ORDER BY l_discount) + (count(*) OVER (PARTITION BY l_discount) - 1) / 2.0::DOUBLE AS d FROM lineitem),
  o AS (SELECT 'l_quantity' AS a, 'l_extendedprice' AS b, corr(q, e) AS r FROM k UNION ALL SELECT 'l_quantity', 'l_discount', corr(q, d) FROM k
    UNION ALL SELECT 'l_extendedprice', 'l_discount', corr(e, d) FROM k)
  SELECT a, b, round(r, 6) AS r FROM o UNION ALL SELECT b, a, round(r, 6) FROM o
  UNION ALL SELECT c, c, 1.0::DOUBLE FROM (VALUES ('l_quantity'), ('l_extendedprice'), ('l_discount')) t(c)""")
def corr_spearman_rows(spark, d):
    cols = ["l_quantity", "l_extendedprice", "l_discount"]
    return rounded(corr_matrix(table(spark, d, "lineitem"), cols, "spearman"))


FACTORS, INTERACTIONS, NUMERIC = ["sexenio", "subtema"], [("sexenio", "subtema")], ["t", "sin12", "cos12", "lag1"]
DUMMIES = {"Intercept": "1.0", "C(sexenio)[T.before]": "(sexenio = 'before')::DOUBLE", "C(subtema)[T.N]": "(subtema = 'N')::DOUBLE",
           "C(subtema)[T.R]": "(subtema = 'R')::DOUBLE",
           "C(sexenio)[T.before]:C(subtema)[T.N]": "(sexenio = 'before' AND subtema = 'N')::DOUBLE",
           "C(sexenio)[T.before]:C(subtema)[T.R]": "(sexenio = 'before' AND subtema = 'R')::DOUBLE",
           **{c: c for c in NUMERIC}}
TRAIN_SQL = f"{MODEL_SQL}, train AS (SELECT * FROM model WHERE fecha < DATE '2000-07-01')"
_CTES, _FIT = ols_ctes("train", "monto_asinh", list(DUMMIES.values())[1:])
OLS_SQL = f"{TRAIN_SQL}, {', '.join(_CTES)}"


def _split(spark, d):
    train, test = temporal_split(materialize(_model(spark, d)), LINEITEM_HOLDOUT)
    return train, known_levels(test, train, "subtema")


def _fit(train):
    return L.ols(train, "monto_asinh", L.fit_design(train, NUMERIC, FACTORS, INTERACTIONS))


@query("design_matrix", f"""WITH {TRAIN_SQL} SELECT fecha, subtema AS grp, {', '.join(f'{r(sql)} AS "{n}"' for n, sql in DUMMIES.items())} FROM train""")
def design_matrix(spark, d):
    train, _ = _split(spark, d)
    design = L.fit_design(train, NUMERIC, FACTORS, INTERACTIONS)
    out = L.design_matrix(train.withColumn("grp", F.col("subtema")), design, ["fecha", "grp"])
    return rounded(out)


def _coef_sql(j: int, name: str) -> str:
    se = f"sqrt(sum((w{j} * e / (1 - h)) ** 2))"
    b = f"any_value(b{j})"
    return (f"SELECT '{name}' AS term, {r(b)} AS coef, {r(se)} AS std_err, {r(f'{b} / {se}', 4)} AS t_value, "
            f"{r(f'{b} - 1.96 * {se}')} AS ci95_low, {r(f'{b} + 1.96 * {se}')} AS ci95_high FROM fitted")


@query("ols_coef", f"WITH {OLS_SQL} {' UNION ALL '.join(_coef_sql(j, n) for j, n in enumerate(DUMMIES))}")
def ols_coef(spark, d):
    train, _ = _split(spark, d)
    out = L.coef_table(spark, _fit(train), p_value=False)
    return rounded(out.withColumn("t_value", F.round("t_value", 4)))


@query("ols_simple", f"""SELECT l_returnflag AS flag, {r('regr_slope(l_extendedprice, l_quantity)', 4)} AS slope,
  {r('regr_intercept(l_extendedprice, l_quantity)', 4)} AS intercept, {r('regr_r2(l_extendedprice, l_quantity)')} AS r2,
  count(*) AS n FROM lineitem GROUP BY 1""")
def ols_simple(spark, d):
    out = L.simple_ols(table(spark, d, "lineitem").withColumnRenamed("l_returnflag", "flag"), "l_extendedprice", "l_quantity", ["flag"])
    return rounded(out.withColumns({c: F.round(c, 4) for c in ("slope", "intercept")}))


_P = len(DUMMIES)
_MEASURES = {
    "n": "n", "df_model": f"{_P - 1}", "df_resid": f"n - {_P}", "r2": "1 - rss / tss", "r2_adj": f"1 - (rss / tss) * (n - 1) / (n - {_P})",
    "log_likelihood": "ll", "aic": f"-2 * ll + 2 * {_P}", "bic": f"-2 * ll + ln(n) * {_P}", "skew": "sk", "kurtosis": "ku",
    "jarque_bera": "jb", "jarque_bera_p": "exp(-jb / 2)", "omnibus": "om", "omnibus_p": "exp(-om / 2)", "durbin_watson": "dw"}
# Normal scores of skewness and kurtosis; a chi-squared variable with two degrees of freedom has the tail exp(-x / 2).
_NORMAL = """q1 AS (SELECT *, n / 6.0::DOUBLE * (sk ** 2 + (ku - 3) ** 2 / 4) AS jb, sk * sqrt((n + 1) * (n + 3) / (6 * (n - 2))) AS y,
    sqrt(2 * (3 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9)) - 1)) - 1 AS w2,
    (ku - 3 * (n - 1) / (n + 1)) / sqrt(24 * n * (n - 2) * (n - 3) / ((n + 1) ** 2 * (n + 3) * (n + 5))) AS x,
    6 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * sqrt(6 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3))) AS third FROM m),
  q2 AS (SELECT *, 6 + 8 / third * (2 / third + sqrt(1 + 4 / third ** 2)) AS a FROM q1),
  q3 AS (SELECT *, (asinh(y / sqrt(2 / (w2 - 1))) / sqrt(ln(sqrt(w2)))) ** 2 + (((1 - 2 / (9 * a)) - cbrt((1 - 2 / a) / (1 + x * sqrt(2 / (a - 4))))) / sqrt(2 / (9 * a))) ** 2 AS om FROM q2)"""
DIAG_SQL = f"""WITH {OLS_SQL}, o AS (SELECT e, monto_asinh AS y, e - lag(e) OVER (ORDER BY fecha, subtema) AS de FROM fitted),
  m AS (SELECT count(*)::DOUBLE AS n, sum(e * e) AS rss, var_pop(y) * count(*) AS tss, avg(e ** 3) / avg(e ** 2) ** 1.5 AS sk,
    avg(e ** 4) / avg(e ** 2) ** 2 AS ku, sum(de * de) / sum(e * e) AS dw FROM o),
  {_NORMAL}, z AS (SELECT *, -n / 2 * (ln(2 * pi()) + ln(rss / n) + 1) AS ll FROM q3)
  {' UNION ALL '.join(f"SELECT '{k}' AS measure, {r(f'({v})::DOUBLE', 5)} AS value FROM z" for k, v in _MEASURES.items())}"""


@query("ols_diagnostics", DIAG_SQL)
def ols_diagnostics(spark, d):
    train, _ = _split(spark, d)
    out = L.fit_diagnostics(train, _fit(train), ["fecha", "subtema"])
    return rounded(out.where(F.col("measure").isin(list(_MEASURES))), 5)


@query("ols_diagnostics_all")
def ols_diagnostics_all(spark, d):
    # Also the robust F test and the condition number, which need matrices.
    train, _ = _split(spark, d)
    return rounded(L.fit_diagnostics(train, _fit(train), ["fecha", "subtema"]), 5)


_QUANTILE = 8  # Newton steps for the t quantile


def t_quantile_sql(p: float, df: str) -> str:
    """CTEs q0, q1, ... (df, q): steps from the normal quantile of 0.975 toward the t quantile of ``p``."""
    density = "exp(lgamma((df + 1) / 2) - lgamma(df / 2)) / sqrt(pi() * df) * pow(1 + q * q / df, -(df + 1) / 2)"
    steps = [f"q0 AS MATERIALIZED (SELECT ({df})::DOUBLE AS df, 1.96::DOUBLE AS q)"]
    steps += [f"q{i} AS MATERIALIZED (SELECT df, q + ({t_tail_sql('q', 'df')} / 2 - {1 - p}) / ({density}) AS q FROM q{i - 1})" for i in range(1, _QUANTILE + 1)]
    return ", ".join(steps)


@query("ols_intervals", f"""WITH {OLS_SQL}, {t_quantile_sql(0.95, f'(SELECT count(*) - {len(DUMMIES)} FROM train)')}
  {' UNION ALL '.join(f"SELECT '{n}' AS term, {r(f'any_value(b{j}) - (SELECT q FROM q{_QUANTILE}) * sqrt(sum((w{j} * e / (1 - h)) ** 2))', 5)} AS low, "
                      f"{r(f'any_value(b{j}) + (SELECT q FROM q{_QUANTILE}) * sqrt(sum((w{j} * e / (1 - h)) ** 2))', 5)} AS high FROM fitted" for j, n in enumerate(DUMMIES))}""")
def ols_intervals(spark, d):
    train, _ = _split(spark, d)
    out = L.coef_table(spark, _fit(train), p_value=False, level=0.9)
    return rounded(out.select("term", F.col("ci95_low").alias("low"), F.col("ci95_high").alias("high")), 5)


ABSORBED_SQL = """WITH g AS (SELECT l_partkey, l_extendedprice / 1000 AS y, l_quantity AS x, l_discount AS z FROM lineitem),
  w AS (SELECT l_partkey, count(*) OVER p AS n, y - avg(y) OVER p AS y, x - avg(x) OVER p AS x, z - avg(z) OVER p AS z FROM g WINDOW p AS (PARTITION BY l_partkey)),
  s AS (SELECT sum(x * x) AS xx, sum(x * z) AS xz, sum(z * z) AS zz, sum(x * y) AS xy, sum(z * y) AS zy FROM w),
  b AS (SELECT *, xx * zz - xz * xz AS det, (zz * xy - xz * zy) / (xx * zz - xz * xz) AS bx, (xx * zy - xz * xy) / (xx * zz - xz * xz) AS bz FROM s),
  r AS (SELECT x, z, CASE WHEN n > 1 THEN (y - bx * x - bz * z) / (1 - 1.0::DOUBLE / n - (zz * x * x - 2 * xz * x * z + xx * z * z) / det) END AS u FROM w, b),
  m AS (SELECT sum(x * x * u * u) AS mxx, sum(x * z * u * u) AS mxz, sum(z * z * u * u) AS mzz FROM r)"""


@query("ols_absorbed", f"""{ABSORBED_SQL}
  SELECT 'l_quantity' AS term, {r('bx')} AS coef, {r('sqrt(zz * zz * mxx - 2 * zz * xz * mxz + xz * xz * mzz) / det')} AS std_err FROM b, m
  UNION ALL SELECT 'l_discount', {r('bz')}, {r('sqrt(xz * xz * mxx - 2 * xz * xx * mxz + xx * xx * mzz) / det')} FROM b, m""")
def ols_absorbed(spark, d):
    return rounded(L.absorbed_table(spark, _absorbed(spark, d)).drop("low", "high"))


@query("ols_absorbed_effects", f"""{ABSORBED_SQL}, a AS (SELECT l_partkey, count(*) AS n, avg(y) AS y, avg(x) AS x, avg(z) AS z FROM g GROUP BY 1)
  SELECT l_partkey AS level, n, {r('y - bx * x - bz * z')} AS effect FROM a, b""")
def ols_absorbed_effects(spark, d):
    return rounded(_absorbed(spark, d).effects)


def _absorbed(spark, d):
    rows = table(spark, d, "lineitem").select("l_partkey", (F.col("l_extendedprice") / 1000).alias("y"), "l_quantity", "l_discount")
    return L.ols_absorbed(rows, "y", L.Design(("l_quantity", "l_discount")), "l_partkey")


PRED_SQL = f"""WITH {OLS_SQL}, test AS (SELECT * FROM model WHERE fecha >= DATE '2000-07-01'),
  coef AS (SELECT {', '.join(f'any_value(b{j}) AS b{j}' for j in range(_P))} FROM fitted),
  pred AS (SELECT fecha, sexenio, subtema, monto_asinh, {' + '.join(f'b{j} * {x}' for j, x in enumerate(DUMMIES.values()))} AS y_pred FROM test, coef)"""


@query("pred_vs_actual", f"""{PRED_SQL} SELECT fecha, sexenio, subtema, {r('monto_asinh')} AS monto_asinh, {r('y_pred')} AS y_pred,
  {r('monto_asinh - y_pred')} AS resid FROM pred""")
def pred_vs_actual(spark, d):
    train, test = _split(spark, d)
    out = L.residuals(L.predict(test, _fit(train)), "monto_asinh")
    return rounded(out.select("fecha", "sexenio", "subtema", "monto_asinh", "y_pred", "resid"))


@query("regression_metrics", f"""{PRED_SQL} SELECT count(*) AS n, {r('1 - sum((monto_asinh - y_pred) ** 2) / (var_pop(monto_asinh) * count(*))')} AS r2,
  {r('avg(abs(monto_asinh - y_pred))')} AS mae, {r('sqrt(avg((monto_asinh - y_pred) ** 2))')} AS rmse FROM pred""")
def regression_metrics(spark, d):
    train, test = _split(spark, d)
    return rounded(L.regression_metrics(L.predict(test, _fit(train)), "monto_asinh", "y_pred", back_transform=False))


@query("regression_metrics_by", f"""SELECT o_orderstatus, count(*) AS n, {r('1 - sum((ln(o_totalprice) - 12) ** 2) / (var_pop(ln(o_totalprice)) * count(*))')} AS r2,
  {r('avg(abs(ln(o_totalprice) - 12))')} AS mae, {r('sqrt(avg((ln(o_totalprice) - 12) ** 2))')} AS rmse,
  {r('avg(abs((o_totalprice - 1 / o_totalprice) / 2 - (exp(12) - exp(-12)) / 2))', 2)} AS mae_raw,
  {r('sqrt(avg(((o_totalprice - 1 / o_totalprice) / 2 - (exp(12) - exp(-12)) / 2) ** 2))', 2)} AS rmse_raw
  FROM orders GROUP BY 1""")
def regression_metrics_by(spark, d):
    rows = table(spark, d, "orders").select("o_orderstatus", F.log("o_totalprice").alias("truth"), F.lit(12.0).alias("guess"))
    out = L.regression_metrics(rows, "truth", "guess", ["o_orderstatus"])
    return rounded(out.withColumns({c: F.round(c, 2) for c in ("mae_raw", "rmse_raw")}))
