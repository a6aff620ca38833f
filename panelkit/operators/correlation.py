"""Correlation matrices in long form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.operators.scan import attach_by_value, value_ranks
from panelkit.session import materialize

FEW_VALUES = 10_000  # of a column whose ranks are broadcast


def _long(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    row = df.agg(*[F.corr(a, b).alias(f"r{k}") for k, (a, b) in enumerate(pairs)])
    cells = []
    for k, (a, b) in enumerate(pairs):
        for x, y in {(a, b), (b, a)}:
            cells.append(F.struct(F.lit(x).alias("a"), F.lit(y).alias("b"), F.col(f"r{k}").alias("r")))
    return row.select(F.inline(F.array(*cells)))


def corr_matrix(df: DataFrame, columns: Sequence[str], method: str = "pearson") -> DataFrame:
    """Pearson or Spearman (average ranks) coefficient of every ordered column pair, over complete rows."""
    complete = df.select(*columns).dropna()
    if method == "pearson":
        return _long(complete, columns)
    # All columns are ranked together, as (column, value): one ranking job however many columns there are. The ranks then come
    # back to the rows one column after the other: rows are never taken apart and put together again.
    rows = materialize(complete.select(*[F.col(c).cast("double").alias(c) for c in columns]))
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in columns])
    long = rows.select(F.inline(cells))
    table = materialize(value_ranks(long, "value", ["column"]).select("column", "value", "n", "avg_rank"))
    sizes = {r["column"]: r["values"] for r in table.groupBy("column").agg(F.count(F.lit(1)).alias("values")).collect()}
    for k, c in enumerate(columns):
        own = table.where(F.col("column") == c).select(F.col("value").alias(c), "n", F.col("avg_rank").alias(f"__rank{k}"))
        if sizes.get(c, 0) <= FEW_VALUES:
            rows = rows.join(F.broadcast(own), c).drop("n")
        else:
            rows = attach_by_value(rows, own, [c]).drop("n")
    return _long(rows.select(*[F.col(f"__rank{k}").alias(c) for k, c in enumerate(columns)]), columns)
