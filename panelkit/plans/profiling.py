"""Table profiles, grouped statistics, star schema and chart tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelkit.config import DEFAULTS
from panelkit.functions.dates import month_start
from panelkit.operators import charts, profile
from panelkit.operators.panel import monthly_panel
from panelkit.plans.preparation import RANGES_SQL
from panelkit.plans.registry import FACTS_SQL, FEATURES_SQL, ORDER_FACTS_SQL, facts, order_facts, query, r, rounded
from panelkit.sources.adapters import LINEITEM_CUTOFF, LINEITEM_FIRST_YEARS, lineitem_facts, table


@query("profile_shape", "SELECT count(*) AS n_rows, 11::INT AS n_cols FROM lineitem")
def profile_shape(spark, d):
    return profile.profile_shape(table(spark, d, "lineitem"))


_NULLS = " UNION ALL ".join(f"SELECT '{c}' AS c, count(*) - count({c}) AS n FROM t" for c in ("doc_id", "text", "lang", "source", "n_chars", "quality", "toxic"))


@query("profile_nulls", f"""WITH t AS (SELECT d.*, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
  SELECT c AS "column", n AS n_null FROM ({_NULLS}) WHERE n > 0""")
def profile_nulls(spark, d):
    docs = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    return profile.profile_nulls(docs)


def _describe_sql(cols: dict[str, str], source: str, digits: int) -> str:
    parts = [f"""SELECT '{n}' AS "column", count({c}) AS count, {r(f'avg({c})', digits)} AS mean, {r(f'stddev_samp({c})', digits)} AS std,
      {r(f'min({c})::DOUBLE', digits)} AS min, {r(f'quantile_cont({c}::DOUBLE, 0.25)', digits)} AS q25,
      {r(f'quantile_cont({c}::DOUBLE, 0.5)', digits)} AS q50, {r(f'quantile_cont({c}::DOUBLE, 0.75)', digits)} AS q75,
      {r(f'max({c})::DOUBLE', digits)} AS max FROM {source}""" for n, c in cols.items()]
    return " UNION ALL ".join(parts)


@query("describe_numeric", _describe_sql({c: c for c in ("o_orderkey", "o_custkey", "o_totalprice")}, "orders", 2))
def describe_numeric(spark, d):
    return profile.describe_numeric(table(spark, d, "orders"))


@query("describe_all", f"""WITH {ORDER_FACTS_SQL}, n AS ({_describe_sql({'ciclo': 'ciclo', 'monto': 'monto'}, 'facts', 4)}),
  s AS (SELECT 'mes' AS c, mes AS v FROM facts UNION ALL SELECT 'subtema', subtema FROM facts UNION ALL SELECT 'sector', sector FROM facts),
  k AS (SELECT c, v, count(*) AS n FROM s GROUP BY ALL),
  b AS (SELECT c, v, n, row_number() OVER (PARTITION BY c ORDER BY n DESC, v) AS i, sum(n) OVER (PARTITION BY c) AS total,
        count(*) OVER (PARTITION BY c) AS u FROM k)
  SELECT "column", count, mean, std, min, q25, q50, q75, max, NULL::BIGINT AS "unique", NULL::VARCHAR AS top, NULL::BIGINT AS freq FROM n
  UNION ALL SELECT c, total::BIGINT, NULL, NULL, NULL, NULL, NULL, NULL, NULL, u, v, n FROM b WHERE i = 1""")
def describe_all(spark, d):
    return rounded(profile.describe_all(order_facts(spark, d), ["ciclo", "mes", "monto", "subtema", "sector"]), 4)


@query("value_counts", "SELECT l_returnflag, count(*) AS count FROM lineitem GROUP BY 1")
def value_counts(spark, d):
    return profile.value_counts(table(spark, d, "lineitem"), "l_returnflag")


@query("value_counts_top", "SELECT p_brand, count(*) AS count FROM part GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def value_counts_top(spark, d):
    return profile.value_counts(table(spark, d, "part"), "p_brand", top=10)


@query("value_share", f"""SELECT o_orderpriority, o_orderstatus, count(*) AS count,
  {r('count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY o_orderpriority)', 4)} AS share FROM orders GROUP BY 1, 2""")
def value_share(spark, d):
    return rounded(profile.value_share(table(spark, d, "orders"), "o_orderstatus", "o_orderpriority"), 4)


@query("distinct_profile", """SELECT "column", value, count(*) AS count FROM (
  SELECT 'p_brand' AS "column", p_brand AS value FROM part UNION ALL SELECT 'p_type', p_type FROM part
  UNION ALL SELECT 'p_name', p_name FROM part UNION ALL SELECT 'p_size', p_size::VARCHAR FROM part) GROUP BY ALL""")
def distinct_profile(spark, d):
    return profile.distinct_profile(table(spark, d, "part"), ["p_brand", "p_type", "p_name", "p_size"])


_STATS_SQL = f"""{r('sum(monto)', 4)} AS sum, {r('avg(monto)', 4)} AS mean, {r('stddev_samp(monto)', 4)} AS std,
  {r('min(monto)', 4)} AS min, {r('max(monto)', 4)} AS max, count(monto) AS count"""


@query("group_stats", f"WITH {FACTS_SQL} SELECT subtema, {_STATS_SQL} FROM facts GROUP BY 1")
def group_stats(spark, d):
    return rounded(profile.group_stats(lineitem_facts(spark, d), "subtema"), 4)


@query("group_stats_top", f"""WITH {ORDER_FACTS_SQL} SELECT ciclo, sector, {r('sum(monto)', 2)} AS sum, {r('avg(monto)', 2)} AS mean,
  {r('stddev_samp(monto)', 2)} AS std FROM facts GROUP BY ALL ORDER BY sum DESC LIMIT 10""")
def group_stats_top(spark, d):
    return rounded(profile.group_stats(order_facts(spark, d), ["ciclo", "sector"], stats=("sum", "mean", "std"), top=10), 2)


@query("yearly_stats", f"WITH {FACTS_SQL} SELECT ciclo, {r('sum(monto)', 4)} AS sum, {r('avg(monto)', 4)} AS mean FROM facts GROUP BY 1")
def yearly_stats(spark, d):
    return rounded(profile.group_stats(lineitem_facts(spark, d), "ciclo", stats=("sum", "mean")), 4)


@query("date_span", f"WITH {FACTS_SQL} SELECT min(fecha) AS first, max(fecha) AS last FROM facts")
def date_span(spark, d):
    return profile.date_span(facts(spark, d))


@query("crosstab", "SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS F, count(*) FILTER (o_orderstatus = 'O') AS O, "
       "count(*) FILTER (o_orderstatus = 'P') AS P FROM orders GROUP BY 1")
def crosstab(spark, d):
    return profile.crosstab(table(spark, d, "orders"), "o_orderpriority", "o_orderstatus", ["F", "O", "P"])


@query("crosstab_long", "SELECT o_orderpriority, o_orderstatus, count(*) AS count FROM orders GROUP BY 1, 2")
def crosstab_long(spark, d):
    return profile.crosstab(table(spark, d, "orders"), "o_orderpriority", "o_orderstatus")


@query("star_dims", """SELECT 'tiempo' AS entity, count(*) AS members FROM (SELECT DISTINCT year(o_orderdate), month(o_orderdate) FROM orders)
  UNION ALL SELECT 'concepto', count(*) FROM (SELECT DISTINCT o_orderstatus FROM orders)
  UNION ALL SELECT 'sector', count(*) FROM (SELECT DISTINCT o_orderpriority FROM orders)
  UNION ALL SELECT 'fact', count(*) FROM orders""")
def star_dims(spark, d):
    parts = profile.decompose(order_facts(spark, d), {
        "tiempo": (["ciclo", "mes"], ["mes_num", "fecha"]), "concepto": ["subtema"], "sector": ["sector"]}, ["monto"])
    out = None
    for name, part in parts.items():
        row = part.agg(F.lit(name).alias("entity"), F.count(F.lit(1)).alias("members"))
        out = row if out is None else out.unionByName(row)
    return out


@query("key_violations", """SELECT p_name, count(*) AS n_variants FROM (SELECT DISTINCT p_name, p_brand, p_type FROM part) GROUP BY 1
  HAVING count(*) > 1""")
def key_violations(spark, d):
    return profile.check_key(table(spark, d, "part"), ["p_name"], ["p_brand", "p_type"])


@query("cluster_profiles", f"""WITH {FEATURES_SQL} SELECT subtema AS cluster, {r('avg(monto_asinh)')} AS monto_asinh, {r('avg(lag1)')} AS lag1,
  {r('avg(roll3_mean)')} AS roll3_mean, {r('avg(roll3_std)')} AS roll3_std, {r('avg(sin12)')} AS sin12, {r('avg(cos12)')} AS cos12
  FROM features GROUP BY 1""")
def cluster_profiles(spark, d):
    from panelkit.operators.panel import panel_features

    rows = panel_features(facts(spark, d), cutoff=LINEITEM_CUTOFF).withColumnRenamed("subtema", "cluster")
    return rounded(profile.cluster_profiles(rows, ["monto_asinh", "lag1", "roll3_mean", "roll3_std", "sin12", "cos12"]))


@query("cluster_timeseries", f"""WITH {FACTS_SQL}, p AS (SELECT fecha, subtema, sector, asinh(sum(monto)) AS monto_asinh FROM facts GROUP BY ALL)
  SELECT fecha, subtema AS cluster, {r('avg(monto_asinh)')} AS monto_asinh FROM p GROUP BY ALL""")
def cluster_timeseries(spark, d):
    panel = monthly_panel(facts(spark, d), ["subtema", "sector"]).withColumnRenamed("subtema", "cluster")
    return rounded(profile.cluster_timeseries(panel, "monto_asinh"))


FIRST_YEAR_SQL = f"""{FACTS_SQL}, fy AS (SELECT * EXCLUDE (sexenio), {RANGES_SQL} AS sexenio FROM facts WHERE {RANGES_SQL} IS NOT NULL),
  y AS (SELECT *, (floor(date_diff('day', CASE WHEN sexenio = 'before (1995)' THEN DATE '1995-01-01' ELSE DATE '1998-06-01' END,
    fecha) / 30) + 1)::INT AS mes_relativo FROM fy)"""


def _first_year(spark, d):
    return charts.first_year(facts(spark, d, LINEITEM_FIRST_YEARS), LINEITEM_FIRST_YEARS)


@query("chart_line_first_year", f"""WITH {FIRST_YEAR_SQL} SELECT mes_relativo, subtema, sexenio, {r('sum(monto)', 4)} AS monto FROM y GROUP BY ALL""")
def chart_line_first_year(spark, d):
    return rounded(charts.line_by_month(_first_year(spark, d)), 4)


@query("chart_bar_era", f"WITH {FIRST_YEAR_SQL} SELECT sexenio, {r('sum(monto)', 4)} AS monto FROM y GROUP BY 1")
def chart_bar_era(spark, d):
    return rounded(charts.bar_by_era(_first_year(spark, d)), 4)


@query("chart_box", f"""WITH {FIRST_YEAR_SQL}, q AS (SELECT sexenio, quantile_cont(monto::DOUBLE, 0.25) AS q1, quantile_cont(monto::DOUBLE, 0.5) AS median,
    quantile_cont(monto::DOUBLE, 0.75) AS q3 FROM y GROUP BY 1),
  f AS (SELECT y.sexenio, q1, median, q3, monto, monto BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside FROM y JOIN q USING (sexenio))
  SELECT sexenio, {r('q1', 4)} AS q1, {r('median', 4)} AS median, {r('q3', 4)} AS q3, {r('min(monto) FILTER (inside)', 4)} AS whisker_low,
    {r('max(monto) FILTER (inside)', 4)} AS whisker_high, count(*) FILTER (NOT inside) AS n_outliers FROM f GROUP BY sexenio, q1, median, q3""")
def chart_box(spark, d):
    return rounded(charts.box_stats(_first_year(spark, d)), 4)


@query("chart_pie", f"""WITH {FIRST_YEAR_SQL} SELECT sexenio, subtema, count(*) AS count,
  {r('count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY sexenio)', 4)} AS share FROM y GROUP BY 1, 2""")
def chart_pie(spark, d):
    return rounded(charts.pie_by_era(_first_year(spark, d)), 4)


_FIRST_YEAR_SQL = " UNION ALL ".join(
    f"SELECT '{name}' AS sexenio, l.* FROM lineitem l WHERE date_trunc('month', l_shipdate) BETWEEN DATE '{low}' AND DATE '{high}'" for name, low, high in LINEITEM_FIRST_YEARS)
_LOWS_SQL = " ".join(f"WHEN '{name}' THEN DATE '{low}'" for name, low, _ in LINEITEM_FIRST_YEARS)


@query("chart_scatter", f"""WITH f AS ({_FIRST_YEAR_SQL}) SELECT sexenio,
    (date_diff('day', CASE sexenio {_LOWS_SQL} END, date_trunc('month', l_shipdate)::DATE) // 30 + 1)::INT AS mes_relativo,
    l_orderkey, l_linenumber, l_extendedprice AS monto FROM f
  QUALIFY row_number() OVER (PARTITION BY sexenio ORDER BY md5('{DEFAULTS.seed}|' || l_orderkey || '|' || l_linenumber || '|' || l_partkey),
    l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) <= {DEFAULTS.scatter_cap}""")
def chart_scatter(spark, d):
    from panelkit.operators.sampling import sample_per_group

    rows = charts.first_year(table(spark, d, "lineitem").withColumn("fecha", month_start("l_shipdate")), LINEITEM_FIRST_YEARS)
    sample = sample_per_group(rows, ["sexenio"], ["l_orderkey", "l_linenumber", "l_partkey"], ties=["l_suppkey", "l_extendedprice", "l_shipdate"])
    return sample.select("sexenio", "mes_relativo", "l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("monto"))


@query("top_sectors", f"""WITH {ORDER_FACTS_SQL}, s AS (SELECT ciclo, sector, sum(monto) AS sum FROM facts GROUP BY ALL)
  SELECT ciclo, sector, {r('sum', 2)} AS sum, row_number() OVER (PARTITION BY ciclo ORDER BY sum DESC, sector)::INT AS rank
  FROM s QUALIFY row_number() OVER (PARTITION BY ciclo ORDER BY sum DESC, sector) <= 3""")
def top_sectors(spark, d):
    return rounded(profile.top_k_per_group(order_facts(spark, d), ["ciclo"], "sector", k=3), 2)
