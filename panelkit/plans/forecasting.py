"""Forecast features, fits, recursive predictions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from panelkit.operators import forecast as FC
from panelkit.operators.panel import monthly_panel
from panelkit.plans.ols_sql import ols_ctes
from panelkit.plans.registry import FACTS_SQL, ORDER_FACTS_SQL, facts, order_facts, query, r, rounded
from panelkit.sources.adapters import LINEITEM_HOLDOUT

KEYS = ["subtema"]
# Illustrative coefficients for the recursion alone: intercept, t, sin12, cos12, lag1, lag12.
GIVEN = [0.4, 0.001, 0.05, -0.03, 0.55, 0.4]

SERIES_SQL = """series AS (SELECT fecha, subtema, sum(monto) AS monto, asinh(sum(monto)) AS y, 12 * year(fecha) + month(fecha) AS mi
  FROM facts GROUP BY ALL)"""
FEATURES_SQL = f"""{SERIES_SQL}, feat AS (SELECT a.fecha, a.subtema, a.y, a.mi, (a.mi - min(a.mi) OVER (PARTITION BY a.subtema))::DOUBLE AS t,
    sin(2*pi()*month(a.fecha)/12) AS sin12, cos(2*pi()*month(a.fecha)/12) AS cos12, b.y AS lag1, c.y AS lag12
  FROM series a LEFT JOIN series b ON a.subtema = b.subtema AND a.mi = b.mi + 1 LEFT JOIN series c ON a.subtema = c.subtema AND a.mi = c.mi + 12),
  usable AS (SELECT * FROM feat WHERE lag1 IS NOT NULL AND lag12 IS NOT NULL)"""


def _series(spark, d, source=facts):
    return monthly_panel(source(spark, d), KEYS)


@query("forecast_features", f"""WITH {FACTS_SQL}, {FEATURES_SQL} SELECT fecha, subtema, t::INT AS t, {r('sin12')} AS sin12, {r('cos12')} AS cos12,
  {r('lag1')} AS lag1, {r('lag12')} AS lag12, {r('y')} AS y FROM usable""")
def forecast_features(spark, d):
    rows = FC.forecast_features(_series(spark, d), KEYS)
    return rounded(rows.select("fecha", "subtema", *FC.FEATURES, "y"))


_CTES, _ = ols_ctes("train", "y", list(FC.FEATURES), "subtema")
FIT_SQL = f"""{FACTS_SQL}, {FEATURES_SQL}, train AS (SELECT * FROM usable WHERE fecha < DATE '2000-07-01'), {', '.join(_CTES)},
  coef AS (SELECT subtema, count(*) AS n, {', '.join(f'any_value(b{j}) AS b{j}' for j in range(6))} FROM fitted GROUP BY 1)"""


@query("forecast_fit", f"WITH {FIT_SQL} SELECT subtema, n, {', '.join(f'{r(f'b{j}', 5)} AS b{j}' for j in range(6))} FROM coef")
def forecast_fit(spark, d):
    features = FC.forecast_features(_series(spark, d), KEYS)
    model = FC.fit_forecaster(features.where(F.col("fecha") < F.lit(LINEITEM_HOLDOUT)), KEYS)
    return rounded(model.select("subtema", "n", *[F.col("coef")[j].alias(f"b{j}") for j in range(6)]), 5)


def _step(prefix: str, b: list[str]) -> str:
    """Next value from the previous 12, newest last, in list ``h``."""
    m = f"({prefix}.mi + 1)"
    return (f"({b[0]} + {b[1]} * ({m} - t0) + {b[2]} * sin(2*pi()*{m}/12) + {b[3]} * cos(2*pi()*{m}/12) "
            f"+ {b[4]} * {prefix}.h[12] + {b[5]} * {prefix}.h[1])")


def _history_sql(last: str) -> str:
    """Last month and newest-last list of 12 values per series, from a table ``last`` (subtema, l)."""
    return (f"SELECT s.subtema, l AS mi, any_value(t0) AS t0, list(y ORDER BY s.mi) AS h FROM series s JOIN {last} USING (subtema) "
            f"JOIN (SELECT subtema, min(mi) AS t0 FROM series GROUP BY 1) USING (subtema) WHERE s.mi BETWEEN l - 11 AND l GROUP BY 1, 2")


_G = [f"({g})" for g in GIVEN]


@query("dynamic_predict", f"""WITH RECURSIVE {FACTS_SQL}, {SERIES_SQL}, last AS (SELECT subtema, max(mi) AS l FROM series WHERE fecha < DATE '2000-07-01' GROUP BY 1),
  start AS ({_history_sql('last')}),
  walk AS (SELECT subtema, mi, t0::DOUBLE AS t0, h, NULL::DOUBLE AS yhat FROM start UNION ALL
    SELECT subtema, mi + 1, t0, list_append(h[2:12], {_step('walk', _G)}), {_step('walk', _G)} FROM walk WHERE mi < 12 * 2001 + 10)
  SELECT subtema, make_date(((mi - 1) // 12)::INT, ((mi - 1) % 12 + 1)::INT, 1) AS fecha, {r('yhat')} AS yhat_asinh FROM walk WHERE yhat IS NOT NULL""")
def dynamic_predict(spark, d):
    panel = _series(spark, d).withColumnRenamed("monto_asinh", "y")
    model = panel.select(*KEYS).distinct().withColumn("coef", F.array(*[F.lit(g) for g in GIVEN]))
    last = panel.where(F.col("fecha") < F.lit(LINEITEM_HOLDOUT)).groupBy(*KEYS).agg(F.max("fecha").alias("__last"))
    months = F.explode(F.expr("sequence(date'2000-07-01', date'2001-10-01', interval 1 month)")).alias("fecha")
    wanted = last.select(*KEYS, months)
    return rounded(FC.dynamic_predict(panel, model, last, wanted, KEYS).drop("yhat"))


@query("future_months", """WITH l AS (SELECT o_orderstatus AS subtema, date_trunc('month', max(o_orderdate))::DATE AS last FROM orders GROUP BY 1)
  SELECT subtema, (last + to_months(i::INT))::DATE AS fecha FROM l, range(1, 13) t(i)""")
def future_months(spark, d):
    last = order_facts(spark, d).groupBy("subtema").agg(F.max("fecha").alias("last"))
    return last.select("subtema", F.explode(FC.future_months(F.col("last"))).alias("fecha"))


@query("union_forecast", f"""WITH {ORDER_FACTS_SQL}, s AS (SELECT fecha, sum(monto) AS monto FROM facts GROUP BY 1), m AS (SELECT max(fecha) AS last FROM s)
  SELECT fecha, {r('monto', 2)} AS monto, CASE WHEN fecha < DATE '2000-01-01' THEN 'train' ELSE 'test' END AS split FROM s
  UNION ALL SELECT (last + to_months(i::INT))::DATE, NULL, 'forecast' FROM m, range(1, 13) t(i)""")
def union_forecast(spark, d):
    from panelkit.functions.dates import split_label

    observed = monthly_panel(order_facts(spark, d)).select("fecha", F.round("monto", 2).alias("monto"))
    last = observed.agg(F.max("fecha").alias("last"))
    ahead = last.select(F.explode(FC.future_months(F.col("last"))).alias("fecha"))
    both = observed.unionByName(ahead, allowMissingColumns=True)
    return both.withColumn("split", split_label("fecha", date(2000, 1, 1), last.scalar()))


_B = [f"b{j}" for j in range(6)]
TABLE_SQL = f"""WITH RECURSIVE {FIT_SQL}, lt AS (SELECT subtema, max(mi) AS l FROM train GROUP BY 1), ls AS (SELECT subtema, max(mi) AS l FROM series GROUP BY 1),
  starts AS (SELECT 'test' AS kind, * FROM ({_history_sql('lt')}) UNION ALL SELECT 'forecast', * FROM ({_history_sql('ls')})),
  walk AS (SELECT kind, subtema, mi, t0::DOUBLE AS t0, h, NULL::DOUBLE AS yhat, 0 AS i FROM starts UNION ALL
    SELECT kind, walk.subtema, mi + 1, t0, list_append(h[2:12], {_step('walk', _B)}), {_step('walk', _B)}, i + 1 FROM walk JOIN coef USING (subtema)
    JOIN ls USING (subtema) WHERE (kind = 'test' AND mi < l) OR (kind = 'forecast' AND i < 12)),
  chain AS (SELECT subtema, make_date(((mi - 1) // 12)::INT, ((mi - 1) % 12 + 1)::INT, 1) AS fecha, yhat FROM walk WHERE yhat IS NOT NULL),
  fit AS (SELECT u.subtema, fecha, b0 + b1 * t + b2 * sin12 + b3 * cos12 + b4 * lag1 + b5 * lag12 AS yhat FROM train u JOIN coef USING (subtema)
    UNION ALL SELECT subtema, fecha, yhat FROM chain),
  o AS (SELECT coalesce(s.subtema, f.subtema) AS subtema, coalesce(s.fecha, f.fecha) AS fecha, s.y, s.monto, f.yhat, s.mi FROM series s
    FULL JOIN fit f ON s.subtema = f.subtema AND s.fecha = f.fecha)
  SELECT subtema, fecha, {r('y')} AS y_true_asinh, {r('monto', 4)} AS y_true, {r('yhat', 5)} AS yhat_asinh, {r('(exp(yhat) - exp(-yhat)) / 2000', 1)} AS yhat_thousands,
    CASE WHEN fecha < DATE '2000-07-01' THEN 'train' WHEN mi IS NOT NULL THEN 'test' ELSE 'forecast' END AS split FROM o"""


@query("forecast_table", TABLE_SQL)
def forecast_table(spark, d):
    panel = _series(spark, d)
    out = FC.forecast_table(panel, KEYS, holdout_start=LINEITEM_HOLDOUT)
    return out.select("subtema", "fecha", F.round("y_true_asinh", 6).alias("y_true_asinh"), F.round("y_true", 4).alias("y_true"),
                      F.round("yhat_asinh", 5).alias("yhat_asinh"), (F.round(F.col("yhat") / 1000, 1) + 0.0).alias("yhat_thousands"), "split")
