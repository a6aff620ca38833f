"""Cleaning, dates, panels, windows, splits and samples."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.config import DEFAULTS
from panelkit.functions import dates as D
from panelkit.functions.scalars import asinh, number, sinh
from panelkit.operators import panel as P
from panelkit.operators import sampling
from panelkit.operators.scan import avg_rank
from panelkit.plans.registry import (AMOUNT_SQL, FACTS_SQL, FEATURES_SQL, MONTHS_SQL, ORDER_FACTS_SQL, facts,
                                     order_facts, panel_sql, query, r, rounded)
from panelkit.session import checkpoint_dir
from panelkit.sources.adapters import LINEITEM_CUTOFF, LINEITEM_FIRST_YEARS, LINEITEM_HOLDOUT, lineitem_facts, table
from panelkit.sources.tables import read_facts, write_slices, write_table

KEYS = ["subtema", "sector"]


@query("scan_facts", f"""SELECT year(l_shipdate)::INT AS ciclo, {MONTHS_SQL}[month(l_shipdate)] AS mes,
  l_returnflag AS subtema, l_linestatus AS sector, {r(AMOUNT_SQL, 4)} AS monto FROM lineitem""")
def scan_facts(spark, d):
    return rounded(lineitem_facts(spark, d), 4)


CSV_TYPES = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType())])


@query("scan_csv", "SELECT conv_id, turn, role, md5(CASE WHEN conv_id % 2 = 0 THEN text || chr(65533) ELSE text END) AS text FROM conversations")
def scan_csv(spark, d):
    # A table with quotes, commas and line breaks goes through CSV files in the shared folder: one file for all rows that need
    # UTF-8, some of which hold a true replacement character, and Latin-1 files for the others.
    path = f"{checkpoint_dir(spark)}/scan-csv-{uuid.uuid4().hex}"
    text = F.when(F.col("conv_id") % 2 == 0, F.concat("text", F.lit("\ufffd"))).otherwise(F.col("text"))
    rows = table(spark, d, "conversations").select("conv_id", "turn", "role", text.alias("text"))
    narrow = F.coalesce(F.col("text").rlike(r"\A[\x00-\xFF]*\z"), F.lit(True))
    write_table(rows.where(~narrow), f"{path}/wide", single_file=True)
    write_table(rows.where(narrow), f"{path}/narrow", encoding="ISO-8859-1")
    return read_facts(spark, [f"{path}/wide", f"{path}/narrow"], CSV_TYPES).select("conv_id", "turn", "role", F.md5(F.col("text").cast("binary")).alias("text"))


@query("scan_csv_inferred", "SELECT p_partkey, p_name, p_brand, p_type, p_size::BIGINT AS p_size, p_retailprice FROM part")
def scan_csv_inferred(spark, d):
    path = f"{checkpoint_dir(spark)}/scan-csv-{uuid.uuid4().hex}"
    write_table(table(spark, d, "part"), path)
    return read_facts(spark, path, infer=True)


@query("slice_export", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, lower(c_mktsegment) AS slice FROM customer")
def slice_export(spark, d):
    path = f"{checkpoint_dir(spark)}/slices-{uuid.uuid4().hex}"
    write_slices(table(spark, d, "customer"), "c_mktsegment", path, fmt="parquet", rows_per_file=100)
    return spark.read.parquet(path)


@query("month_number", f"""SELECT {MONTHS_SQL}[month(l_shipdate)] AS mes, month(l_shipdate)::INT AS mes_num,
  count(*) AS n FROM lineitem GROUP BY ALL""")
def month_number(spark, d):
    named = lineitem_facts(spark, d).withColumn("mes_num", D.month_number("mes", on_unmapped="raise"))
    return named.groupBy("mes", "mes_num").agg(F.count(F.lit(1)).alias("n"))


@query("month_date", f"""WITH {FACTS_SQL} SELECT ciclo, mes, fecha, count(*) AS n FROM facts GROUP BY ALL""")
def month_date(spark, d):
    dated = lineitem_facts(spark, d).withColumn("fecha", D.month_date("ciclo", D.month_number("mes")))
    return dated.groupBy("ciclo", "mes", "fecha").agg(F.count(F.lit(1)).alias("n"))


@query("month_date_lenient", """SELECT make_date(1990 + p_size::INT, (p_partkey % 15)::INT, 1) AS fecha, count(*) AS n
  FROM part WHERE p_partkey % 15 BETWEEN 1 AND 12 GROUP BY 1""")
def month_date_lenient(spark, d):
    # Month numbers 0, 13 and 14 occur and must be dropped, not raised.
    parts = table(spark, d, "part").select((F.col("p_size") + 1990).alias("y"), (F.col("p_partkey") % 15).alias("m"))
    dated = parts.select(D.month_date("y", "m", strict=False).alias("fecha")).where(F.col("fecha").isNotNull())
    return dated.groupBy("fecha").agg(F.count(F.lit(1)).alias("n"))


@query("month_start", "SELECT date_trunc('month', ts)::DATE AS fecha, count(*) AS n FROM events GROUP BY 1")
def month_start(spark, d):
    return table(spark, d, "events").groupBy(D.month_start("ts").alias("fecha")).agg(F.count(F.lit(1)).alias("n"))


@query("resolve_date", """SELECT date_trunc('month', o_orderdate)::DATE AS fecha, count(*) AS n FROM orders GROUP BY 1""")
def resolve_date(spark, d):
    # Day-first texts, padded or not, among ISO dates with and without a time.
    form = lambda p: F.date_format("o_orderdate", p)
    kind = F.col("o_orderkey") % 6
    mixed = F.when(kind == 0, form("yyyy-MM-dd")).when(kind == 1, form("yyyy-MM-dd HH:mm:ss")).when(kind == 2, form("d/M/yyyy")).otherwise(form("dd/MM/yyyy"))
    text = table(spark, d, "orders").select(mixed.alias("fecha"))
    return D.resolve_date(text).groupBy("fecha").agg(F.count(F.lit(1)).alias("n"))


@query("coerce_numeric", """WITH t AS (SELECT event_type, try_cast(CASE WHEN event_type = 'error' THEN 'n/d'
    WHEN user_id % 7 = 0 THEN 'nan' ELSE value::VARCHAR END AS DOUBLE) AS v FROM events)
  SELECT event_type, count(*) AS n, round(sum(v), 2) AS total FROM t WHERE v IS NOT NULL AND NOT isnan(v) GROUP BY 1""")
def coerce_numeric(spark, d):
    text = F.when(F.col("event_type") == "error", "n/d").when(F.col("user_id") % 7 == 0, "nan").otherwise(
        F.col("value").cast("string"))
    rows = P.coerce_numeric(table(spark, d, "events").select("event_type", text.alias("monto")))
    return rows.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("monto"), 2).alias("total"))


@query("date_range_filter", """SELECT l_returnflag, count(*) AS n, min(l_shipdate)::DATE AS first, max(l_shipdate)::DATE AS last
  FROM lineitem WHERE l_shipdate BETWEEN TIMESTAMP '1996-12-01' AND TIMESTAMP '2000-09-30' GROUP BY 1""")
def date_range_filter(spark, d):
    kept = D.between_dates(table(spark, d, "lineitem"), "l_shipdate", date(1996, 12, 1), date(2000, 9, 30))
    return kept.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.min(F.to_date("l_shipdate")).alias("first"),
                                            F.max(F.to_date("l_shipdate")).alias("last"))


@query("clean_facts", f"""WITH {FACTS_SQL} SELECT fecha, mes_num, subtema, count(*) AS n, {r('sum(monto)', 4)} AS total
  FROM facts WHERE fecha BETWEEN DATE '1996-12-01' AND DATE '2000-09-30' GROUP BY ALL""")
def clean_facts(spark, d):
    kept = P.clean_facts(lineitem_facts(spark, d), date(1996, 12, 1), date(2000, 9, 30))
    return rounded(kept.groupBy("fecha", "mes_num", "subtema").agg(
        F.count(F.lit(1)).alias("n"), F.sum("monto").alias("total")), 4)


@query("label_era", f"WITH {FACTS_SQL} SELECT sexenio, fecha, count(*) AS n FROM facts GROUP BY ALL")
def label_era(spark, d):
    return facts(spark, d).groupBy("sexenio", "fecha").agg(F.count(F.lit(1)).alias("n"))


RANGES_SQL = """CASE WHEN fecha BETWEEN DATE '1995-01-01' AND DATE '1995-12-31' THEN 'before (1995)'
  WHEN fecha BETWEEN DATE '1998-06-01' AND DATE '1999-05-31' THEN 'after (1998-99)' END"""


@query("label_ranges", f"""WITH {FACTS_SQL} SELECT {RANGES_SQL} AS sexenio, count(*) AS n FROM facts
  WHERE {RANGES_SQL} IS NOT NULL GROUP BY 1""")
def label_ranges(spark, d):
    label = D.label_ranges("fecha", LINEITEM_FIRST_YEARS)
    labelled = facts(spark, d, LINEITEM_FIRST_YEARS).where(D.in_ranges("fecha", LINEITEM_FIRST_YEARS)).withColumn("sexenio", label)
    return labelled.groupBy("sexenio").agg(F.count(F.lit(1)).alias("n"))


@query("relative_month", f"""WITH {FACTS_SQL}, t AS (SELECT fecha, {RANGES_SQL} AS sexenio FROM facts)
  SELECT sexenio, fecha, (floor(date_diff('day', CASE WHEN sexenio = 'before (1995)' THEN DATE '1995-01-01'
    ELSE DATE '1998-06-01' END, fecha) / 30) + 1)::INT AS mes_relativo, count(*) AS n FROM t WHERE sexenio IS NOT NULL GROUP BY ALL""")
def relative_month(spark, d):
    from panelkit.operators.charts import first_year

    rows = first_year(facts(spark, d, LINEITEM_FIRST_YEARS), LINEITEM_FIRST_YEARS)
    return rows.groupBy("sexenio", "fecha", "mes_relativo").agg(F.count(F.lit(1)).alias("n"))


@query("temporal_split", f"""WITH {FEATURES_SQL} SELECT CASE WHEN fecha < DATE '2000-07-01' THEN 'train' ELSE 'test' END AS part,
  count(*) AS n, min(fecha) AS first, max(fecha) AS last FROM features GROUP BY 1""")
def temporal_split(spark, d):
    rows = P.panel_features(facts(spark, d), KEYS, cutoff=LINEITEM_CUTOFF)
    sides = zip(("train", "test"), P.temporal_split(rows, LINEITEM_HOLDOUT))
    a, b = (s.agg(F.lit(n).alias("part"), F.count(F.lit(1)).alias("n"), F.min("fecha").alias("first"),
                  F.max("fecha").alias("last")) for n, s in sides)
    return a.unionByName(b)


@query("temporal_split_fallback", """WITH p AS (SELECT o_orderdate::DATE AS fecha, row_number() OVER (ORDER BY o_orderdate) - 1 AS i,
    count(*) OVER () AS n FROM orders), c AS (SELECT fecha AS cut FROM p WHERE i = floor(0.8 * n))
  SELECT CASE WHEN fecha < cut THEN 'train' ELSE 'test' END AS part, count(*) AS n FROM p, c GROUP BY 1""")
def temporal_split_fallback(spark, d):
    rows = table(spark, d, "orders").select(F.to_date("o_orderdate").alias("fecha"))
    a, b = (s.agg(F.lit(n).alias("part"), F.count(F.lit(1)).alias("n"))
            for n, s in zip(("train", "test"), P.temporal_split(rows, date(2022, 1, 1))))
    return a.unionByName(b)


@query("split_label", f"""WITH {FACTS_SQL}, m AS (SELECT max(fecha) AS last FROM facts WHERE fecha < DATE '2001-06-01')
  SELECT CASE WHEN fecha < DATE '2000-07-01' THEN 'train' WHEN fecha <= last THEN 'test' ELSE 'forecast' END AS split,
         count(*) AS n FROM facts, m GROUP BY 1""")
def split_label(spark, d):
    rows = facts(spark, d)
    last = rows.where(F.col("fecha") < F.lit(date(2001, 6, 1))).agg(F.max("fecha")).scalar()
    return rows.groupBy(D.split_label("fecha", LINEITEM_HOLDOUT, last).alias("split")).agg(F.count(F.lit(1)).alias("n"))


LEVEL_CUT = "2001-06-01"


@query("known_levels", f"""SELECT l_returnflag AS flag, count(*) AS n FROM lineitem WHERE l_shipdate < TIMESTAMP '{LEVEL_CUT}'
    AND l_partkey IN (SELECT l_partkey FROM lineitem WHERE l_shipdate >= TIMESTAMP '{LEVEL_CUT}') GROUP BY 1""")
def known_levels(spark, d):
    # The whole table, cut once: levels of the last months among the earlier rows.
    rows = table(spark, d, "lineitem")
    early, late = rows.where(F.col("l_shipdate") >= LEVEL_CUT), rows.where(F.col("l_shipdate") < LEVEL_CUT)
    return P.known_levels(late, early, "l_partkey").groupBy(F.col("l_returnflag").alias("flag")).agg(F.count(F.lit(1)).alias("n"))


@query("unseen_levels", f"""SELECT DISTINCT l_partkey FROM lineitem WHERE l_shipdate < TIMESTAMP '{LEVEL_CUT}'
    AND l_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_shipdate >= TIMESTAMP '{LEVEL_CUT}')""")
def unseen_levels(spark, d):
    rows = table(spark, d, "lineitem")
    return P.unseen_levels(rows.where(F.col("l_shipdate") < LEVEL_CUT), rows.where(F.col("l_shipdate") >= LEVEL_CUT), "l_partkey")


@query("monthly_panel", f"""WITH {FACTS_SQL}, {panel_sql('subtema, sector')}
  SELECT fecha, subtema, sector, {r('monto', 4)} AS monto, {r('monto_asinh')} AS monto_asinh FROM panel""")
def monthly_panel(spark, d):
    panel = P.monthly_panel(facts(spark, d), KEYS)
    return panel.withColumn("monto", F.round("monto", 4)).withColumn("monto_asinh", F.round("monto_asinh", 6))


@query("monthly_panel_orders", f"""WITH {ORDER_FACTS_SQL}, {panel_sql('subtema, sector')}
  SELECT fecha, subtema, sector, {r('monto', 2)} AS monto, {r('monto_asinh')} AS monto_asinh FROM panel""")
def monthly_panel_orders(spark, d):
    panel = P.monthly_panel(order_facts(spark, d), KEYS)
    return panel.withColumn("monto", F.round("monto", 2)).withColumn("monto_asinh", F.round("monto_asinh", 6))


@query("monthly_total", f"""WITH {FACTS_SQL}, {panel_sql('sexenio')} SELECT fecha, sexenio, {r('monto', 4)} AS monto,
  {r('monto_asinh')} AS monto_asinh FROM panel""")
def monthly_total(spark, d):
    panel = P.monthly_panel(facts(spark, d), ["sexenio"])
    return panel.withColumn("monto", F.round("monto", 4)).withColumn("monto_asinh", F.round("monto_asinh", 6))


@query("lag1", f"""WITH {FACTS_SQL}, {panel_sql('subtema')} SELECT fecha, subtema, {r('monto_asinh')} AS monto_asinh,
  {r('lag(monto_asinh) OVER (PARTITION BY subtema ORDER BY fecha)')} AS lag1 FROM panel""")
def lag1(spark, d):
    panel = P.monthly_panel(facts(spark, d), ["subtema"])
    return rounded(P.add_lag(panel, "monto_asinh", ["subtema"]).drop("monto"))


@query("calendar_lag", f"""WITH {ORDER_FACTS_SQL}, base AS (SELECT * FROM facts UNION ALL SELECT * REPLACE ('gap' AS subtema) FROM facts WHERE subtema = 'P' AND mes_num <> 4),
  panel AS (SELECT fecha, subtema, asinh(sum(monto)) AS v FROM base GROUP BY ALL)
  SELECT a.fecha, a.subtema, {r('b.v')} AS lag1, {r('c.v')} AS lag12 FROM panel a
  LEFT JOIN panel b ON a.subtema = b.subtema AND b.fecha = (a.fecha - INTERVAL 1 MONTH)::DATE
  LEFT JOIN panel c ON a.subtema = c.subtema AND c.fecha = (a.fecha - INTERVAL 12 MONTH)::DATE""")
def calendar_lag(spark, d):
    # All series, and one once more without its Aprils, so that positional and calendar lags differ.
    rows = order_facts(spark, d)
    gap = rows.where((F.col("subtema") == "P") & (F.col("mes_num") != 4)).withColumn("subtema", F.lit("gap"))
    rows = rows.unionByName(gap)
    panel = P.monthly_panel(rows, ["subtema"])
    for k in (1, 12):
        panel = P.calendar_lag(panel, "monto_asinh", ["subtema"], k=k)
    return rounded(panel.select("fecha", "subtema", "lag1", "lag12"))


def _rolling_sql(fn: str) -> str:
    w = "OVER (PARTITION BY subtema, sector ORDER BY fecha ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN count(monto_asinh) {w} = 3 THEN {fn}(monto_asinh) {w} END"


@query("rolling_mean", f"""WITH {FACTS_SQL}, {panel_sql('subtema, sector')}
  SELECT fecha, subtema, sector, {r(_rolling_sql('avg'))} AS roll3_mean FROM panel""")
def rolling_mean(spark, d):
    panel = P.monthly_panel(facts(spark, d), KEYS)
    return rounded(P.rolling(panel, "monto_asinh", KEYS, "mean").select("fecha", *KEYS, "roll3_mean"))


@query("rolling_std", f"""WITH {FACTS_SQL}, {panel_sql('subtema, sector')}
  SELECT fecha, subtema, sector, {r(_rolling_sql('stddev_samp'))} AS roll3_std FROM panel""")
def rolling_std(spark, d):
    panel = P.monthly_panel(facts(spark, d), KEYS)
    return rounded(P.rolling(panel, "monto_asinh", KEYS, "std").select("fecha", *KEYS, "roll3_std"))


@query("time_index", f"""WITH {FACTS_SQL}, m AS (SELECT min(12 * year(fecha) + month(fecha)) AS t0 FROM facts)
  SELECT fecha, (12 * year(fecha) + month(fecha) - t0)::INT AS t, count(*) AS n FROM facts, m GROUP BY ALL""")
def time_index(spark, d):
    return P.time_index(facts(spark, d)).groupBy("fecha", "t").agg(F.count(F.lit(1)).alias("n"))


@query("seasonality", f"""WITH {FACTS_SQL} SELECT fecha, month(fecha)::INT AS mes, {r('sin(2*pi()*month(fecha)/12)')} AS sin12,
  {r('cos(2*pi()*month(fecha)/12)')} AS cos12 FROM facts GROUP BY ALL""")
def seasonality(spark, d):
    months = facts(spark, d).select("fecha").distinct()
    return rounded(P.add_seasonality(months))


@query("avg_rank", f"""WITH t AS (SELECT c_mktsegment AS segment, {r('c_acctbal', -2)} AS bal FROM customer),
  k AS (SELECT segment, bal, rank() OVER (PARTITION BY segment ORDER BY bal) AS lo, count(*) OVER (PARTITION BY segment, bal) AS c FROM t)
  SELECT segment, bal, lo + (c - 1) / 2.0::DOUBLE AS avg_rank FROM k""")
def avg_rank_query(spark, d):
    rows = table(spark, d, "customer").select(F.col("c_mktsegment").alias("segment"), F.round("c_acctbal", -2).alias("bal"))
    return avg_rank(rows, "bal", ["segment"])


_FEATURE_COLS = "fecha, subtema, sector, sexenio, mes"


@query("panel_features", f"""WITH {FEATURES_SQL} SELECT {_FEATURE_COLS}, {r('monto', 4)} AS monto, {r('monto_asinh')} AS monto_asinh,
  {r('sin12')} AS sin12, {r('cos12')} AS cos12, {r('lag1')} AS lag1, {r('roll3_mean')} AS roll3_mean, {r('roll3_std')} AS roll3_std
  FROM features""")
def panel_features(spark, d):
    rows = P.panel_features(facts(spark, d), KEYS, cutoff=LINEITEM_CUTOFF, before="before", after="after")
    return rounded(rows.withColumn("monto", F.round("monto", 4)))


@query("quantile_cutoff", """WITH p AS (SELECT date_trunc('month', l_shipdate)::DATE AS fecha FROM lineitem),
  o AS (SELECT fecha, row_number() OVER (ORDER BY fecha) - 1 AS i, count(*) OVER () AS n FROM p)
  SELECT fecha AS cutoff FROM o WHERE i = floor(0.8 * n)""")
def quantile_cutoff(spark, d):
    return P.quantile_cutoff(facts(spark, d))


@query("ts_folds", f"""WITH {FEATURES_SQL}, o AS (SELECT fecha, subtema, sector,
    row_number() OVER (ORDER BY fecha, subtema, sector) - 1 AS i, count(*) OVER () AS n FROM features)
  SELECT fecha, subtema, sector, CASE WHEN i < n - 5 * (n // 6) THEN 0 ELSE (i - (n - 5 * (n // 6))) // (n // 6) + 1 END::INT AS fold FROM o""")
def ts_folds(spark, d):
    rows = P.panel_features(facts(spark, d), KEYS, cutoff=LINEITEM_CUTOFF).select("fecha", *KEYS)
    return P.time_series_folds(rows, ["fecha", *KEYS])


@query("asinh", f"SELECT l_returnflag AS flag, {r('sum(asinh(' + AMOUNT_SQL + '))', 4)} AS total FROM lineitem GROUP BY 1")
def asinh_query(spark, d):
    return rounded(lineitem_facts(spark, d).groupBy(F.col("subtema").alias("flag")).agg(F.sum(asinh("monto")).alias("total")), 4)


@query("asinh_roundtrip", f"""WITH {FACTS_SQL}, {panel_sql('subtema')} SELECT fecha, subtema, {r('monto', 4)} AS monto, true AS same FROM panel""")
def asinh_roundtrip(spark, d):
    panel = P.monthly_panel(facts(spark, d), ["subtema"])
    back = F.abs(sinh("monto_asinh") - F.col("monto")) <= 1e-9 * F.abs("monto")
    return panel.select("fecha", "subtema", F.round("monto", 4).alias("monto"), back.alias("same"))


SAMPLE_KEY, SAMPLE_TIES = ["l_orderkey", "l_linenumber", "l_partkey"], ["l_suppkey", "l_extendedprice", "l_shipdate"]
SAMPLE_SQL = f"md5('{DEFAULTS.seed}|' || {" || '|' || ".join(SAMPLE_KEY)}), {', '.join(SAMPLE_KEY + SAMPLE_TIES)}"


@query("stratified_sample", f"""SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag, l_extendedprice FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_returnflag ORDER BY {SAMPLE_SQL}) <= {DEFAULTS.scatter_cap}""")
def stratified_sample(spark, d):
    sample = sampling.sample_per_group(table(spark, d, "lineitem"), ["l_returnflag"], SAMPLE_KEY, ties=SAMPLE_TIES)
    return sample.select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_extendedprice")


@query("sample_cap", f"SELECT * FROM lineitem ORDER BY {SAMPLE_SQL} LIMIT {DEFAULTS.sample_rows}")
def sample_cap(spark, d):
    return sampling.sample_cap(table(spark, d, "lineitem"), SAMPLE_KEY, ties=SAMPLE_TIES)


@query("sample_sizes", """SELECT l_returnflag, least(count(*), 1200) AS n FROM lineitem GROUP BY 1
  UNION ALL SELECT 'all', least(count(*), 20000) FROM lineitem""")
def sample_sizes(spark, d):
    # Sizes of both samples over the whole table, counting distinct rows that also occur in it.
    key = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"]
    rows = table(spark, d, "lineitem").select(*key, "l_returnflag")
    strata = sampling.sample_per_group(rows, ["l_returnflag"], key).distinct().join(rows.distinct(), rows.columns, "left_semi")
    flat = sampling.sample_cap(rows, key).distinct().join(rows.distinct(), rows.columns, "left_semi")
    return strata.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n")).unionByName(
        flat.agg(F.lit("all").alias("l_returnflag"), F.count(F.lit(1)).alias("n")))


@query("head_preview", f"""WITH {FACTS_SQL}, {panel_sql('sexenio, subtema')} SELECT fecha, subtema, {r('monto', 4)} AS monto
  FROM panel ORDER BY fecha, subtema LIMIT 6""")
def head_preview(spark, d):
    panel = P.monthly_panel(facts(spark, d), ["sexenio", "subtema"]).select("fecha", "subtema", "monto")
    return rounded(sampling.preview(panel, ["fecha", "subtema"]), 4)


@query("number_cast", "SELECT source, count(try_cast(replace(source, 'src', '') AS DOUBLE)) AS n FROM documents GROUP BY 1")
def number_cast(spark, d):
    value = number(F.replace("source", F.lit("src"), F.lit("")))
    return table(spark, d, "documents").groupBy("source").agg(F.count(value).alias("n"))
