"""Table profiles: shape, nulls, describe, frequencies, grouped statistics, star-schema decomposition."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.config import DEFAULTS
from panelkit.operators.scan import attach_by_value, exact_quantiles
from panelkit.session import materialize

QUARTILES = (0.25, 0.5, 0.75)


def profile_shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_cols", F.lit(len(df.columns)))


def profile_types(df: DataFrame) -> dict[str, list[str]]:
    """Column names per type, from the schema."""
    out = defaultdict(list)
    for name, dtype in df.dtypes:
        out[dtype].append(name)
    return dict(sorted(out.items()))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def _stack(df: DataFrame, columns: Sequence[str], dtype: str, keep: Sequence[str] = ()) -> DataFrame:
    cells = [F.struct(F.lit(c).alias("column"), F.col(c).cast(dtype).alias("value")) for c in columns]
    return df.select(*keep, F.explode(F.array(*cells)).alias("cell")).select(*keep, "cell.column", "cell.value")


def profile_nulls(df: DataFrame) -> DataFrame:
    """Null count of every column that has any, in one pass."""
    counts = df.agg(*[F.sum(F.col(c).isNull().cast("long")).alias(c) for c in df.columns])
    return _stack(counts, df.columns, "long").withColumnRenamed("value", "n_null").where(F.col("n_null") > 0)


def describe_numeric(df: DataFrame, columns: Sequence[str] | None = None, digits: int | None = 2,
                     approximate: bool = False) -> DataFrame:
    """Count, mean, sample deviation, extremes and quartiles; one row per column.

    Quartiles are exact, which shuffles the distinct values of every column. ``approximate`` takes them from a
    sketch in the same pass instead.
    """
    columns = list(columns or numeric_columns(df))
    measures = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    one = df.agg(*[fn(F.col(c).cast("double")).alias(f"{c}__{m}") for c in columns for m, fn in measures.items()])
    cells = [F.struct(F.lit(c).alias("column"), *[F.col(f"{c}__{m}").alias(m) for m in measures]) for c in columns]
    basic = one.select(F.inline(F.array(*cells)))
    named = {0.25: "q25", 0.5: "q50", 0.75: "q75"}
    if approximate:
        sketch = df.agg(*[F.percentile_approx(F.col(c).cast("double"), list(QUARTILES)).alias(c) for c in columns])
        quart = sketch.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), *[
            F.col(c)[i].alias(n) for i, n in enumerate(named.values())]) for c in columns])))
    else:
        quart = exact_quantiles(df, columns, QUARTILES).groupBy("column").agg(
            *[F.max(F.when(F.col("prob") == p, F.col("value"))).alias(n) for p, n in named.items()])
    out = basic.join(quart, "column", "left")
    shown = ["mean", "std", "min", "q25", "q50", "q75", "max"]
    value = (lambda c: F.round(c, digits)) if digits is not None else F.col
    return out.select("column", "count", *[value(c).alias(c) for c in shown])


def value_counts(df: DataFrame, column: str, top: int | None = None) -> DataFrame:
    """Rows per value, most frequent first, ties by value; nulls are left out."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    ordered = counts.orderBy(F.desc("count"), column)
    return ordered.limit(top) if top else ordered


def distinct_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct values with counts of many columns, from one shuffle."""
    long = _stack(df, columns, "string").where(F.col("value").isNotNull())
    return long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("count")).orderBy("column", "value")


def describe_all(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Numeric describe plus unique count, most frequent value and its frequency for text columns."""
    columns = list(columns or df.columns)
    numeric = [c for c in columns if c in numeric_columns(df)]
    text = [c for c in columns if c not in numeric]
    out = describe_numeric(df, numeric, digits=None) if numeric else None
    if text:
        counts = _stack(df, text, "string").where(F.col("value").isNotNull()).groupBy("column", "value").agg(
            F.count(F.lit(1)).alias("n"))
        best = F.min_by("value", F.struct(-F.col("n"), F.col("value")))
        freq = counts.groupBy("column").agg(F.sum("n").alias("count"), F.count(F.lit(1)).alias("unique"),
                                            best.alias("top"), F.max("n").alias("freq"))
        out = freq if out is None else out.unionByName(freq, allowMissingColumns=True)
    return out


def value_share(df: DataFrame, column: str, by: str) -> DataFrame:
    """Share of each value among its group's rows, in percent."""
    counts = materialize(df.dropna(subset=[column, by]).groupBy(by, column).agg(F.count(F.lit(1)).alias("count")))
    totals = counts.groupBy(by).agg(F.sum("count").alias("__rows"), F.count(F.lit(1)).alias("__values"))
    shares = attach_by_value(counts, totals, [by], "__values")
    return shares.select(by, column, "count", (F.col("count") / F.col("__rows") * 100).alias("share"))


_STATS = {"sum": lambda c: F.coalesce(F.sum(c), F.lit(0.0)), "mean": F.avg, "std": F.stddev_samp,
          "min": F.min, "max": F.max, "count": F.count}


def group_stats(df: DataFrame, by: Sequence[str] | str, measure: str = "monto",
                stats: Sequence[str] = ("sum", "mean", "std", "min", "max", "count"),
                top: int | None = None) -> DataFrame:
    """Statistics of a measure per group; ``top`` keeps the groups with the largest sum."""
    by = [by] if isinstance(by, str) else list(by)
    out = df.dropna(subset=by).groupBy(*by).agg(*[_STATS[s](measure).alias(s) for s in stats])
    return out.orderBy(F.desc("sum"), *by).limit(top) if top else out


def date_span(df: DataFrame, date: str = "fecha") -> DataFrame:
    return df.agg(F.min(date).alias("first"), F.max(date).alias("last"))


def crosstab(df: DataFrame, a: str, b: str, levels: Sequence | None = None) -> DataFrame:
    """Counts of value pairs: long form, or wide with one column per level when ``levels`` are given."""
    rows = df.dropna(subset=[a, b])
    if levels is None:
        return rows.groupBy(a, b).agg(F.count(F.lit(1)).alias("count"))
    return rows.groupBy(a).pivot(b, list(levels)).count().fillna(0)


def decompose(df: DataFrame, dims: Mapping[str, Sequence[str]], measures: Sequence[str]) -> dict[str, DataFrame]:
    """Star schema: one table of distinct members per dimension and a fact table that keeps keys and measures.

    The first column of a dimension is its key, unless the name maps to a ``(keys, attributes)`` pair.
    """
    out, keys = {}, []
    for name, spec in dims.items():
        key, attrs = spec if isinstance(spec[0], (tuple, list)) else ([spec[0]], list(spec[1:]))
        out[name] = df.select(*key, *attrs).distinct()
        keys += [k for k in key if k not in keys]
    out["fact"] = df.select(*keys, *measures)
    return out


def check_key(df: DataFrame, key: Sequence[str], attributes: Sequence[str]) -> DataFrame:
    """Keys that occur with more than one combination of attribute values."""
    members = df.select(*key, F.struct(*attributes).alias("__attrs")).distinct()
    counted = members.groupBy(*key).agg(F.count(F.lit(1)).alias("n_variants"))
    return counted.where(F.col("n_variants") > 1)


def cluster_profiles(df: DataFrame, columns: Sequence[str], cluster: str = "cluster") -> DataFrame:
    return df.groupBy(cluster).agg(*[F.avg(c).alias(c) for c in columns])


def cluster_timeseries(df: DataFrame, column: str, date: str = "fecha", cluster: str = "cluster") -> DataFrame:
    return df.groupBy(date, cluster).agg(F.avg(column).alias(column))


def top_k_per_group(df: DataFrame, by: Sequence[str], item: str, measure: str = "monto",
                    k: int = DEFAULTS.top_sectors) -> DataFrame:
    """Items with the largest sum in every group, ties by item name."""
    by = list(by)
    sums = group_stats(df, [*by, item], measure, stats=("sum",))
    order = W.partitionBy(*by).orderBy(F.desc("sum"), item)
    return sums.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
