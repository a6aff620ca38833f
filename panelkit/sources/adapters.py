"""Projections that present the benchmark tables as fact tables and corpora."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.functions.dates import month_name, months_in_ranges

LINEITEM_CUTOFF = date(1998, 6, 1)
LINEITEM_HOLDOUT = date(2000, 7, 1)
LINEITEM_FIRST_YEARS = (
    ("before (1995)", date(1995, 1, 1), date(1995, 12, 31)),
    ("after (1998-99)", date(1998, 6, 1), date(1999, 5, 31)),
)
ERA_A, ERA_B = "before", "after"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def lineitem_facts(spark: SparkSession, sf_dir: str, ranges: Sequence | None = None) -> DataFrame:
    """Year, Spanish month name, two categories and a signed amount per line item; ``ranges`` keeps their months only."""
    sign = F.when(F.col("l_returnflag") == "R", -1).otherwise(1)
    rows = table(spark, sf_dir, "lineitem")
    rows = months_in_ranges(rows, "l_shipdate", ranges) if ranges else rows
    return rows.select(
        F.year("l_shipdate").alias("ciclo"),
        month_name(F.month("l_shipdate")).alias("mes"),
        F.col("l_returnflag").alias("subtema"),
        F.col("l_linestatus").alias("sector"),
        (sign * F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("monto"),
    )


def orders_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.year("o_orderdate").alias("ciclo"),
        month_name(F.month("o_orderdate")).alias("mes"),
        F.col("o_orderstatus").alias("subtema"),
        F.col("o_orderpriority").alias("sector"),
        F.col("o_totalprice").alias("monto"),
    )
