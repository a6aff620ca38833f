"""Registered queries and the SQL each is checked against."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.config import MONTHS_ES
from panelkit.operators.panel import prepare_facts
from panelkit.sources.adapters import ERA_A, ERA_B, LINEITEM_CUTOFF, lineitem_facts, orders_facts

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def add(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return add


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round all double columns, so that the last bits of a sum do not depend on the order of its terms."""
    return df.select(*[F.round(F.col(f"`{n}`"), digits).alias(n) if t == "double" else F.col(f"`{n}`")
                       for n, t in df.dtypes])


def facts(spark: SparkSession, sf_dir: str, ranges: Sequence | None = None) -> DataFrame:
    return prepare_facts(lineitem_facts(spark, sf_dir, ranges), cutoff=LINEITEM_CUTOFF, before=ERA_A, after=ERA_B)


def order_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare_facts(orders_facts(spark, sf_dir), cutoff=LINEITEM_CUTOFF, before=ERA_A, after=ERA_B)


def r(expr: str, digits: int = 6) -> str:
    """SQL rounding without negative zero."""
    return f"(CASE WHEN abs({expr}) < {0.5 * 10 ** -digits:.10f} THEN 0::DOUBLE ELSE round(({expr})::DOUBLE, {digits}) END)"


MONTHS_SQL = str(list(MONTHS_ES))
AMOUNT_SQL = "(CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END) * l_extendedprice * (1 - l_discount)"
FACTS_SQL = f"""facts AS (
  SELECT year(l_shipdate)::INT AS ciclo, month(l_shipdate)::INT AS mes_num,
         {MONTHS_SQL}[month(l_shipdate)] AS mes, date_trunc('month', l_shipdate)::DATE AS fecha,
         l_returnflag AS subtema, l_linestatus AS sector, {AMOUNT_SQL} AS monto,
         CASE WHEN l_shipdate < DATE '1998-06-01' THEN 'before' ELSE 'after' END AS sexenio
  FROM lineitem)"""
ORDER_FACTS_SQL = f"""facts AS (
  SELECT year(o_orderdate)::INT AS ciclo, month(o_orderdate)::INT AS mes_num,
         {MONTHS_SQL}[month(o_orderdate)] AS mes, date_trunc('month', o_orderdate)::DATE AS fecha,
         o_orderstatus AS subtema, o_orderpriority AS sector, o_totalprice AS monto,
         CASE WHEN o_orderdate < DATE '1998-06-01' THEN 'before' ELSE 'after' END AS sexenio
  FROM orders)"""


def panel_sql(keys: str, name: str = "panel") -> str:
    """CTE of the monthly panel; ``keys`` is a comma list, maybe empty."""
    cols = f"fecha, {keys}" if keys else "fecha"
    return (f"{name} AS (SELECT {cols}, coalesce(sum(monto), 0) AS monto, asinh(coalesce(sum(monto), 0)) AS monto_asinh, "
            f"any_value(sexenio) AS era FROM facts GROUP BY {cols})")


FEATURES_SQL = f"""{FACTS_SQL}, {panel_sql('subtema, sector')}, featured AS (
  SELECT fecha, subtema, sector, monto, monto_asinh, era AS sexenio, month(fecha)::INT AS mes,
         sin(2*pi()*month(fecha)/12) AS sin12, cos(2*pi()*month(fecha)/12) AS cos12,
         lag(monto_asinh) OVER w AS lag1,
         CASE WHEN count(monto_asinh) OVER w3 = 3 THEN avg(monto_asinh) OVER w3 END AS roll3_mean,
         CASE WHEN count(monto_asinh) OVER w3 = 3 THEN stddev_samp(monto_asinh) OVER w3 END AS roll3_std
  FROM panel
  WINDOW w AS (PARTITION BY subtema, sector ORDER BY fecha),
         w3 AS (PARTITION BY subtema, sector ORDER BY fecha ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)),
features AS (SELECT * FROM featured WHERE lag1 IS NOT NULL AND roll3_mean IS NOT NULL AND roll3_std IS NOT NULL)"""
