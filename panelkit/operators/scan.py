"""Running aggregates, ranks and exact quantiles over a total order, without ever sorting one group in one task.

A plain window with few or no partition keys sends a whole group to one task. Here rows are range-partitioned on
(keys, order), each part gets its own running value, and a table with one row per (keys, part) carries the value of
all earlier parts. That table has at most (number of key groups + number of parts) rows.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelkit.functions.scalars import col
from panelkit.session import materialize

PART = "__part"
HOT_VALUES = 1_000
ACCURACY = 2_000  # of the sketch that brackets a quantile: ranks are off by a 2000th of the rows at most
FEW_GROUPS = 10_000  # whose table is broadcast
WINDOW_VALUES = 1_000_000  # of one bracket that are sorted in one task


@dataclass(frozen=True)
class Running:
    """One running value: ``how`` is sum, min, max or last; ``reverse`` runs from the end."""

    expr: Column | str
    how: str = "sum"
    reverse: bool = False
    inclusive: bool = True


_AGG = {"sum": F.sum, "min": F.min, "max": F.max}


def running(df: DataFrame, order: Sequence[str], aggs: Mapping[str, Running], by: Sequence[str] = (),
            parts: int | None = None) -> DataFrame:
    """Add running values of ``aggs`` in ``order`` inside every ``by`` group.

    ``order`` must tell all rows of a group apart: equal rows would stay in one part.
    """
    by, order = list(by), list(order)
    # Without a fixed number, adaptive execution merges neighbouring small ranges; their order is kept.
    ranges = df.repartitionByRange(parts, *by, *order) if parts else df.repartitionByRange(*by, *order)
    ranged = materialize(ranges.withColumn(PART, F.spark_partition_id()))

    first = W.unboundedPreceding
    totals, outer_cols, combined = [], {}, {}

    for name, agg in aggs.items():
        value, total, before = col(agg.expr), f"__total_{name}", f"__before_{name}"
        # A frame that reaches to the end is summed anew for each row; in the opposite order it grows by one row at a time.
        turn = F.desc if agg.reverse else F.asc
        inner = W.partitionBy(*by, PART).orderBy(*map(turn, order))
        across = (W.partitionBy(*by) if by else W.partitionBy(F.lit(0))).orderBy(turn(PART))
        frame = (first, W.currentRow if agg.inclusive else -1)
        outside = (first, -1)
        if agg.how == "last":
            if agg.reverse:
                raise ValueError("'last' runs forward only")
            totals.append(F.max_by(value, F.struct(*order)).alias(total))
            within = F.last(value).over(inner.rowsBetween(*frame))
            outer_cols[before] = F.last(total).over(across.rowsBetween(*outside))
            combined[name] = (before, lambda o, i: F.coalesce(i, o), within)
        else:
            fn = _AGG[agg.how]
            totals.append(fn(value).alias(total))
            within = fn(value).over(inner.rowsBetween(*frame))
            outer_cols[before] = fn(total).over(across.rowsBetween(*outside))
            if agg.how == "sum":
                combined[name] = (before, _add, within)
            else:
                combined[name] = (before, F.least if agg.how == "min" else F.greatest, within)

    offsets = ranged.groupBy(*by, PART).agg(*totals)
    offsets = offsets.select(*[F.col(k).alias(f"__k_{k}") for k in by], F.col(PART).alias("__k_part"),
                             *[c.alias(n) for n, c in outer_cols.items()])
    inner_values = ranged.select("*", *[w.alias(f"__in_{n}") for n, (_, _, w) in combined.items()])
    on = F.col(PART) == F.col("__k_part")
    for k in by:
        on = on & F.col(k).eqNullSafe(F.col(f"__k_{k}"))
    if not by:
        offsets = F.broadcast(offsets)  # one row per part
    joined = inner_values.join(offsets, on, "left")
    keep = [c for c in df.columns if c not in aggs]
    return joined.select(*keep, *[f(F.col(b), F.col(f"__in_{n}")).alias(n) for n, (b, f, _) in combined.items()])


def _add(outside: Column, inside: Column) -> Column:
    return F.when(outside.isNull(), inside).when(inside.isNull(), outside).otherwise(outside + inside)


def value_ranks(df: DataFrame, value: str, by: Sequence[str] = (), **sums: Column) -> DataFrame:
    """One row per distinct value: its count ``n``, extra ``sums``, rows ``before`` it and its average rank."""
    by = list(by)
    counts = (
        df.where(F.col(value).isNotNull())
        .groupBy(*by, value)
        .agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(k) for k, c in sums.items()])
    )
    ranked = running(counts, [value], {"upto": Running("n")}, by=by)
    return ranked.withColumn("before", F.col("upto") - F.col("n")).withColumn(
        "avg_rank", F.col("before") + (F.col("n") + 1) / 2).drop("upto")


def attach_by_value(rows: DataFrame, table: DataFrame, on: Sequence[str], weight: str = "n",
                    hot_values: int = HOT_VALUES) -> DataFrame:
    """Join a per-value table back to its rows without sending a frequent value to one task.

    Values that hold at least ``1/hot_values`` of all rows come by broadcast: at most ``hot_values`` of them exist.
    The rest comes by a shuffled join, in which rows that already have their value are spread by task number.
    """
    on = list(on)
    table = materialize(table)
    payload = [c for c in table.columns if c not in on]
    total = table.agg(F.sum(weight)).scalar()
    is_hot = F.col(weight) * hot_values >= total
    hot = F.broadcast(table.where(is_hot).select(*on, *[F.col(c).alias(f"__hot_{c}") for c in payload]))
    cold = table.where(~is_hot).select(*on, F.lit(0).alias("__spread"), *[F.col(c).alias(f"__cold_{c}") for c in payload])
    spread = F.when(F.col(f"__hot_{weight}").isNull(), 0).otherwise(F.spark_partition_id() + 1)
    both = rows.join(hot, on, "left").withColumn("__spread", spread).join(cold, [*on, "__spread"], "left")
    found = both.where(F.coalesce(f"__hot_{weight}", f"__cold_{weight}").isNotNull())
    return found.select(*rows.columns, *[F.coalesce(f"__hot_{c}", f"__cold_{c}").alias(c) for c in payload])


def avg_rank(df: DataFrame, value: str, by: Sequence[str] = (), out: str = "avg_rank") -> DataFrame:
    """Average rank of every row's value inside its group; rows without a value are dropped."""
    by = list(by)
    table = value_ranks(df, value, by).select(*by, value, "n", F.col("avg_rank").alias(out))
    return attach_by_value(df, table, [*by, value]).drop("n")


def attach_by_group(rows: DataFrame, table: DataFrame, by: Sequence[str], weight: str) -> DataFrame:
    """Join a table with one row per group back to its rows: broadcast while the groups are few, else hot groups apart."""
    table = materialize(table)
    if table.count() > FEW_GROUPS:
        return attach_by_value(rows, table, by, weight)
    return rows.join(F.broadcast(table), list(by))


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Exact quantiles with linear interpolation: one row per (group, column, prob).

    The built-in exact percentile keeps every distinct value of a group in one buffer, and a sort moves every cell. Here a
    mergeable sketch brackets each quantile first: its rank error has a proven bound, so that the wanted ranks lie between two
    of its values. Further passes count the cells below the bracket and take only the few inside it, by value. Should a
    bracket not hold its ranks, all cells of this call are sorted.
    """
    by, columns, probs = list(by), list(columns), [float(p) for p in probs]
    keyed = df.dropna(subset=by).select(*by, *[F.col(c).cast("double").alias(f"__c{k}") for k, c in enumerate(columns)]) if by else df.select(
        *[F.col(c).cast("double").alias(f"__c{k}") for k, c in enumerate(columns)])
    reach = 2 / ACCURACY
    ends = [x for p in probs for x in (max(0.0, p - reach), min(1.0, p + reach))]
    sketch = [F.percentile_approx(f"__c{k}", F.array(*[F.lit(x) for x in ends]), F.lit(ACCURACY)).alias(f"__s{k}") for k in range(len(columns))]
    sizes = [F.count(f"__c{k}").alias(f"__n{k}") for k in range(len(columns))]
    found = keyed.groupBy(*by).agg(*sketch, *sizes, F.count(F.lit(1)).alias("__rows"))
    brackets = {(k, j): (F.col(f"__s{k}")[2 * j], F.col(f"__s{k}")[2 * j + 1]) for k in range(len(columns)) for j in range(len(probs))}
    if by:
        bracketed = attach_by_group(keyed, found, by, "__rows")
    else:
        row = found.first()
        bracketed = keyed.withColumns({name: F.lit(row[name]).cast(kind) for name, kind in found.dtypes})
    many = lambda kj: F.col(f"__n{kj[0]}") > 2 * ACCURACY  # noqa: E731  else all cells are few
    least = {kj: F.when(many(kj), lo).otherwise(F.lit(-math.inf)) if probs[kj[1]] > reach else F.lit(-math.inf) for kj, (lo, _) in brackets.items()}
    most = {kj: F.when(many(kj), hi).otherwise(F.lit(math.nan)) if probs[kj[1]] < 1 - reach else F.lit(math.nan)  # NaN is the greatest value
            for kj, (_, hi) in brackets.items()}
    value = lambda kj: F.col(f"__c{kj[0]}")

    label = lambda kj: (F.lit(columns[kj[0]]).alias("column"), F.lit(probs[kj[1]]).alias("prob"))
    below = bracketed.groupBy(*by).agg(*[F.sum((value(kj) < least[kj]).cast("long")).alias(f"__b{kj[0]}_{kj[1]}") for kj in brackets],
                                       *[F.first(f"__n{k}").alias(f"__n{k}") for k in range(len(columns))])
    below = below.select(*by, F.inline(F.array(*[F.struct(*label(kj), F.coalesce(f"__b{kj[0]}_{kj[1]}", F.lit(0)).alias("below"),
                                                          F.col(f"__n{kj[0]}").alias("size")) for kj in brackets])))
    cells = F.array(*[F.when(value(kj).between(least[kj], most[kj]), F.struct(*label(kj), value(kj).alias("value"))) for kj in brackets])
    inside = bracketed.select(*by, F.explode(F.filter(cells, lambda c: c.isNotNull())).alias("cell")).groupBy(
        *by, "cell.column", "cell.prob", "cell.value").agg(F.count(F.lit(1)).alias("n"))
    inside = materialize(inside.select(*by, "column", "prob", "value", "n"))
    group = [*by, "column", "prob"]
    widest = inside.groupBy(*group).agg(F.count(F.lit(1)).alias("values")).agg(F.max("values")).first()[0] or 0
    if widest <= WINDOW_VALUES:
        upto = inside.withColumn("upto", F.sum("n").over(W.partitionBy(*group).orderBy("value")))
    else:
        upto = running(inside.withColumn("rows", F.col("n")), ["value"], {"upto": Running("rows")}, by=group)
    at = (F.col("size") - 1) * F.col("prob")
    low, high = F.floor(at), F.ceil(at)
    ranked = upto.alias("u").join(below.alias("b"), _same("u", "b", group)).select("u.*", "below", "size")
    before = F.col("below") + F.col("upto") - F.col("n")
    covers = lambda place: (before <= place) & (place < before + F.col("n"))
    out = materialize(ranked.groupBy(*group).agg(
        F.max(F.when(covers(low), F.col("value"))).alias("lo"), F.max(F.when(covers(high), F.col("value"))).alias("hi"), F.first(at - low).alias("part")))
    if not out.where("lo IS NULL OR hi IS NULL").isEmpty():
        return _sorted_quantiles(df.dropna(subset=by) if by else df, columns, probs, by)
    return out.select(*group, (F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("part")).alias("value"))


def _same(left: str, right: str, names: Sequence[str]) -> Column:
    on = F.lit(True)
    for c in names:
        on = on & F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return on


def _sorted_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """``exact_quantiles`` by the ranks of all distinct values."""
    by = list(by)
    long = df.select(*by, F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns])).alias("cell"))
    long = long.select(*by, "cell.column", "cell.value")
    ranked = value_ranks(long, "value", [*by, "column"])
    return quantiles_of_ranks(ranked, "value", probs, [*by, "column"], few_groups=not by)


def quantiles_of_ranks(ranked: DataFrame, value: str, probs: Sequence[float], by: Sequence[str],
                       few_groups: bool = False) -> DataFrame:
    """Exact quantiles from a table of ``value_ranks``. ``few_groups`` promises a fixed number of groups."""
    by = list(by)
    sizes = ranked.groupBy(*by).agg(F.sum("n").alias("__size"), F.count(F.lit(1)).alias("__values"))
    if few_groups:
        sized = ranked.join(F.broadcast(sizes), by)
    else:
        sized = attach_by_value(ranked, sizes, by, "__values")
    probe = sized.select(
        *by, value, "before", "n", F.explode(F.array(*[
            F.struct(F.lit(float(p)).alias("prob"), ((F.col("__size") - 1) * float(p)).alias("position"))
            for p in probs])).alias("q"))
    low, high = F.floor("q.position"), F.ceil("q.position")
    covers = lambda at: (F.col("before") <= at) & (at < F.col("before") + F.col("n"))
    found = probe.where(covers(low) | covers(high)).groupBy(*by, F.col("q.prob").alias("prob")).agg(
        F.max(F.when(covers(low), F.col(value))).alias("lo"),
        F.max(F.when(covers(high), F.col(value))).alias("hi"),
        F.first(F.col("q.position") - low).alias("part"))
    return found.select(*by, "prob", (F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("part")).alias("value"))
