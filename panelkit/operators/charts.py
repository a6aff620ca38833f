"""Tables behind the charts; drawing is left to the caller."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.config import DEFAULTS
from panelkit.functions.dates import in_ranges, label_ranges, range_start, relative_month
from panelkit.operators.profile import QUARTILES, group_stats, value_share
from panelkit.operators.scan import attach_by_group, exact_quantiles


def first_year(df: DataFrame, ranges: Sequence = DEFAULTS.first_year_ranges, date: str = "fecha") -> DataFrame:
    """Rows inside one of the ranges, with the range label and the month number inside it."""
    labelled = df.where(in_ranges(date, ranges)).withColumn("sexenio", label_ranges(date, ranges))
    return labelled.withColumn("mes_relativo", relative_month(date, range_start("sexenio", ranges)))


def line_by_month(df: DataFrame, category: str = "subtema", measure: str = "monto") -> DataFrame:
    return group_stats(df, ["mes_relativo", category, "sexenio"], measure, ("sum",)).withColumnRenamed("sum", measure)


def bar_by_era(df: DataFrame, measure: str = "monto") -> DataFrame:
    return group_stats(df, ["sexenio"], measure, ("sum",)).withColumnRenamed("sum", measure)


def box_stats(df: DataFrame, by: str = "sexenio", measure: str = "monto", reach: float = 1.5) -> DataFrame:
    """Quartiles, whiskers at the last value within ``reach`` interquartile ranges, and the number of outliers."""
    rows = df.where(F.col(by).isNotNull() & F.col(measure).isNotNull()).select(by, F.col(measure).cast("double").alias(measure))
    named = dict(zip(QUARTILES, ("q1", "median", "q3")))
    quart = exact_quantiles(rows, [measure], QUARTILES, [by]).groupBy(by).agg(
        *[F.max(F.when(F.col("prob") == p, F.col("value"))).alias(n) for p, n in named.items()])
    sized = quart.join(rows.groupBy(by).agg(F.count(F.lit(1)).alias("__rows")), by)
    span = (F.col("q3") - F.col("q1")) * reach
    inside = F.col(measure).between(F.col("q1") - span, F.col("q3") + span)
    return attach_by_group(rows, sized, [by], "__rows").groupBy(by, "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col(measure))).alias("whisker_low"),
        F.max(F.when(inside, F.col(measure))).alias("whisker_high"),
        F.sum((~inside).cast("long")).alias("n_outliers"))


def pie_by_era(df: DataFrame, category: str = "subtema") -> DataFrame:
    return value_share(df, category, "sexenio")
