"""Repeatable samples: rows are ordered by a digest of their key, which any engine can compute, so partitioning does not matter."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelkit.config import DEFAULTS

DIGITS = 3  # of 16 values each
LARGE_GROUPS = 10_000  # whose cuts are broadcast; a further group has at most a 10,000th of the rows


def _draw(key: Sequence[str], seed: int):
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in key]).cast("binary"))


def sample_per_group(df: DataFrame, by: Sequence[str], key: Sequence[str], n: int = DEFAULTS.scatter_cap,
                     seed: int = DEFAULTS.seed, ties: Sequence[str] = ()) -> DataFrame:
    """Up to ``n`` rows of every group; ``ties`` orders rows of one key.

    A window alone would sort a whole group in one task. Rows of large groups are counted by the first digits of their digest
    before, and only those up to the digits of the ``n``-th row go on: first to the best ``n`` of each task, then to one task
    per group. ``df`` is read twice, so that it must give the same rows each time.
    """
    by = list(by)
    drawn = df.withColumn("__md5", _draw(key, seed)).withColumn("__digits", F.substring("__md5", 1, DIGITS))
    counts = drawn.groupBy(*by, "__digits").agg(F.count(F.lit(1)).alias("__n"))
    upto = counts.withColumn("__upto", F.sum("__n").over(W.partitionBy(*by).orderBy("__digits")))
    cuts = upto.groupBy(*[F.col(b).alias(f"__k_{b}") for b in by]).agg(
        F.sum("__n").alias("__size"), F.min(F.when(F.col("__upto") >= n, F.col("__digits"))).alias("__cut"))
    cuts = cuts.where(F.col("__cut").isNotNull()).orderBy(F.desc("__size")).limit(LARGE_GROUPS).drop("__size")
    same = F.lit(True)
    for b in by:
        same = same & F.col(b).eqNullSafe(F.col(f"__k_{b}"))
    few = drawn.join(F.broadcast(cuts), same, "left").where(F.col("__cut").isNull() | (F.col("__digits") <= F.col("__cut")))
    few = few.withColumn("__task", F.when(F.col("__cut").isNotNull(), F.spark_partition_id()).otherwise(-1))
    for group in ([*by, "__task"], by):  # rows of one key share their digest, however many they are
        order = W.partitionBy(*group).orderBy("__md5", *key, *ties)
        few = few.withColumn("__draw", F.row_number().over(order)).where(F.col("__draw") <= n)
    return few.select(*df.columns)


def sample_cap(df: DataFrame, key: Sequence[str], max_n: int = DEFAULTS.sample_rows,
               seed: int = DEFAULTS.seed, ties: Sequence[str] = ()) -> DataFrame:
    """At most ``max_n`` rows without replacement; ``ties`` orders rows of one key."""
    return df.orderBy(_draw(key, seed), *key, *ties).limit(max_n)


def preview(df: DataFrame, order: Sequence[str], n: int = 6) -> DataFrame:
    return df.orderBy(*order).limit(n)
