"""Grouped hypothesis tests: one aggregation to sufficient statistics, then closed-form columns."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelkit.config import DEFAULTS
from panelkit.functions.scalars import ratio
from panelkit.functions.tails import chi2_pvalue, f_pvalue, rank_sum_pvalue, t_pvalue
from panelkit.operators.linear import MOST_LEVELS, gram
from panelkit.operators.scan import Running, attach_by_value, running, value_ranks
from panelkit.session import materialize


FEW_TESTS = 100_000


def two_sample_moments(df: DataFrame, y: str, group: str, a, b, by: Sequence[str] = ()) -> DataFrame:
    """Count, mean and sample variance of both sides, one row per ``by`` group."""
    out = []
    for tag, level in (("a", a), ("b", b)):
        side = F.when(F.col(group) == F.lit(level), F.col(y))
        out += [F.count(side).alias(f"n_{tag}"), F.avg(side).alias(f"mean_{tag}"),
                F.var_samp(side).alias(f"var_{tag}")]
    rows = df.where(F.col(group).isin(a, b)).dropna(subset=list(by)) if by else df.where(F.col(group).isin(a, b))
    return rows.groupBy(*by).agg(*out)


def _hedges() -> Column:
    n_a, n_b = F.col("n_a").cast("double"), F.col("n_b").cast("double")
    v_a, v_b = F.col("var_a"), F.col("var_b")
    pooled = F.sqrt(ratio((n_a - 1) * v_a + (n_b - 1) * v_b, n_a + n_b - 2))
    spread = 4 * (n_a + n_b) - 9
    shrink = F.when(spread == 0, F.lit(1.0)).otherwise(1 - ratio(F.lit(3.0), spread))
    return (
        F.when((n_a < 2) | (n_b < 2), F.lit(None).cast("double"))
        .when((v_a == 0) & (v_b == 0), F.lit(0.0))
        .otherwise(ratio(F.col("mean_a") - F.col("mean_b"), pooled) * shrink)
    )


def hedges_g(df: DataFrame, y: str, group: str, a, b, by: Sequence[str] = ()) -> DataFrame:
    """Standardised mean difference with small-sample factor: null below two values a side, 0 without any spread."""
    stats = two_sample_moments(df, y, group, a, b, by)
    return stats.select(*by, "n_a", "n_b", _hedges().alias("hedges_g"))


def welch_t(df: DataFrame, y: str, group: str, a, b, by: Sequence[str] = (), p_value: bool = True) -> DataFrame:
    """Two-sided unequal-variance t-test with effect size. Groups with fewer than two values a side are left out."""
    stats = two_sample_moments(df, y, group, a, b, by).where((F.col("n_a") > 1) & (F.col("n_b") > 1))
    e_a, e_b = F.col("var_a") / F.col("n_a"), F.col("var_b") / F.col("n_b")
    freedom = ratio((e_a + e_b) * (e_a + e_b), e_a * e_a / (F.col("n_a") - 1) + e_b * e_b / (F.col("n_b") - 1))
    out = stats.select(*by, ratio(F.col("mean_a") - F.col("mean_b"), F.sqrt(e_a + e_b)).alias("t_stat"),
                       freedom.alias("df"), _hedges().alias("hedges_g"), "n_a", "n_b")
    return out.withColumn("p_value", t_pvalue("t_stat", "df")) if p_value else out


def fdr_bh(df: DataFrame, p: str = "p_value", alpha: float = DEFAULTS.fdr_alpha, by: Sequence[str] = (),
           key: Sequence[str] = ()) -> DataFrame:
    """Benjamini-Hochberg adjusted p-values and rejections. ``key`` names the columns that tell tests apart.

    Rows without a p-value keep null results and do not count as tests. Up to ``FEW_TESTS`` tests are ordered by windows, more
    of them in ranges.
    """
    by = list(by)
    df = materialize(df)  # one row per test; what computes them runs once
    tested = df.where(F.col(p).isNotNull())
    order = [p, *[k for k in key if k not in by]]
    if df.count() <= FEW_TESTS:
        group = W.partitionBy(*by) if by else W.partitionBy(F.lit(0))
        placed = tested.withColumns({"__m": F.count(F.lit(1)).over(group), "__rank": F.row_number().over(group.orderBy(*order))})
        low = F.min(F.col(p) * F.col("__m") / F.col("__rank")).over(group.orderBy(F.desc("__rank")).rowsBetween(W.unboundedPreceding, W.currentRow))
        done = placed.withColumn("p_adj_fdr", F.least(low, F.lit(1.0))).drop("__m", "__rank")
        done = done.withColumn("rejected", F.col("p_adj_fdr") <= alpha)
        return done.unionByName(df.where(F.col(p).isNull()), allowMissingColumns=True)
    tests = tested.groupBy(*by).agg(F.count(F.lit(1)).alias("__m"))
    placed = running(tested.withColumn("__one", F.lit(1)), order, {"__rank": Running("__one")}, by=by).drop("__one")
    if by:
        placed = attach_by_value(placed, tests, by, "__m")
    else:
        placed = placed.withColumn("__m", tests.scalar())
    raw = placed.withColumn("__raw", F.col(p) * F.col("__m") / F.col("__rank")).drop("__m")
    adjusted = running(raw, ["__rank"], {"__low": Running("__raw", "min", reverse=True)}, by=by)
    done = adjusted.withColumn("p_adj_fdr", F.least(F.col("__low"), F.lit(1.0))).drop("__raw", "__rank", "__low")
    done = done.withColumn("rejected", F.col("p_adj_fdr") <= alpha)
    return done.unionByName(df.where(F.col(p).isNull()), allowMissingColumns=True)


def welch_by_group(df: DataFrame, y: str, group: str, a, b, by: str, alpha: float = DEFAULTS.fdr_alpha) -> DataFrame:
    """Welch test, effect size and false-discovery control per group; an empty table when no group is testable."""
    tests = welch_t(df, y, group, a, b, [by])
    return fdr_bh(tests, "p_value", alpha, key=[by]).orderBy("p_value", by)


def mann_whitney(df: DataFrame, y: str, group: str, a, b, by: Sequence[str] = (), p_value: bool = True) -> DataFrame:
    """Rank-sum test: U of side ``a``, its two-sided p-value and the effect size ``z / sqrt(N)``.

    The z of the effect size carries neither tie nor continuity correction, the p-value carries both.
    """
    rows = df.where(F.col(group).isin(a, b))
    table = value_ranks(rows, y, by, side_a=(F.col(group) == F.lit(a)).cast("long"))
    n = F.col("n").cast("double")
    stats = table.groupBy(*by).agg(
        F.sum("side_a").alias("n_a"), F.sum(F.col("n") - F.col("side_a")).alias("n_b"),
        F.sum(F.col("side_a") * F.col("avg_rank")).alias("__r"), F.sum(n * n * n - n).alias("__tie"))
    n_a, n_b = F.col("n_a").cast("double"), F.col("n_b").cast("double")
    stats = stats.withColumn("u_stat", F.col("__r") - n_a * (n_a + 1) / 2)
    z = ratio(F.col("u_stat") - n_a * n_b / 2, F.sqrt(n_a * n_b * (n_a + n_b + 1) / 12))
    stats = stats.withColumn("effect_r", ratio(z, F.sqrt(n_a + n_b)))
    if p_value:
        stats = stats.withColumn("p_value", rank_sum_pvalue("u_stat", "n_a", "n_b", "__tie"))
    return stats.drop("__r", "__tie")


def kruskal(df: DataFrame, y: str, group: str, by: Sequence[str] = (), p_value: bool = True) -> DataFrame:
    """Kruskal-Wallis H with tie correction and epsilon squared; needs two groups."""
    by = list(by)
    cells = df.dropna(subset=[y, group, *by]).groupBy(*by, y, group).agg(F.count(F.lit(1)).alias("cell"))
    placed = running(cells, [y, group], {"__upto": Running("cell")}, by=by)
    tied = W.partitionBy(*by, y)  # at most one row per group
    placed = placed.select("*", F.sum("cell").over(tied).cast("double").alias("__n"),
                           F.min(F.col("__upto") - F.col("cell")).over(tied).alias("__before"))
    rank, cell = F.col("__before") + (F.col("__n") + 1) / 2, F.col("cell")
    groups = placed.groupBy(*by, group).agg(
        F.sum(cell).alias("n_g"), F.sum(cell * rank).alias("r_g"), F.sum(cell * (F.col("__n") * F.col("__n") - 1)).alias("t_g"))
    stats = groups.groupBy(*by).agg(
        F.count(F.lit(1)).alias("k"), F.sum("n_g").alias("n"), F.sum(F.col("r_g") * F.col("r_g") / F.col("n_g")).alias("__s"),
        F.sum("t_g").alias("__tie"))
    size = F.col("n").cast("double")
    raw = ratio(12 * F.col("__s"), size * (size + 1)) - 3 * (size + 1)
    stats = stats.where(F.col("k") >= 2).withColumn(
        "h_stat", ratio(raw, 1 - ratio(F.col("__tie"), size * size * size - size)))
    stats = stats.withColumn("epsilon_sq", ratio(F.col("h_stat") - (F.col("k") - 1), size - 1))
    if p_value:
        stats = stats.withColumn("p_value", chi2_pvalue("h_stat", F.col("k") - 1))
    return stats.drop("__s", "__tie")


def anova_cells(df: DataFrame, y: str, a: str, b: str) -> DataFrame:
    """Count, mean and squared deviation of every factor combination."""
    rows = df.dropna(subset=[y, a, b])
    return rows.groupBy(a, b).agg(F.count(y).alias("n"), F.avg(y).alias("mean"),
                                  (F.var_pop(y) * F.count(y)).alias("m2"))


def anova_two_way(df: DataFrame, y: str, a: str, b: str, p_value: bool = True) -> DataFrame:
    """Two-way analysis of variance with interaction, type II sums of squares and partial eta squared.

    Everything follows from the cell table. The factor with fewer levels is swept out of the other one, so the
    system solved here has one row per level of the smaller factor, of which there may be ``MOST_LEVELS``; the larger one may have
    any number. Empty cells lower the degrees of freedom.
    """
    spark = df.sparkSession
    cells = materialize(anova_cells(df, y, a, b))
    centre = cells.agg(F.sum(F.col("n") * F.col("mean")) / F.sum("n")).scalar()
    centred = cells.withColumn("__s", F.col("n") * (F.col("mean") - centre))
    # Grouping levels of (a, b): 0 cells, 1 margin of a, 2 margin of b, 3 everything.
    margins = materialize(centred.cube(a, b).agg(F.sum("__s").alias("s"), F.sum("n").alias("n"), F.sum("m2").alias("m2"), F.grouping_id().alias("level")))
    found = margins.groupBy("level").agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("n"), F.sum("m2").alias("m2"),
                                         F.sum(F.col("s") * F.col("s") / F.col("n")).alias("ss"))
    by_level = {r["level"]: r for r in found.collect()}
    if not by_level.get(0):
        return spark.createDataFrame([], "term string, sum_sq double, df double, F double, eta_sq_partial double" + ", `PR(>F)` double" * p_value)
    n, residual, n_cells = by_level[0]["n"], by_level[0]["m2"], by_level[0]["k"]
    k_a, k_b = by_level[1]["k"], by_level[2]["k"]
    if min(k_a, k_b) > MOST_LEVELS:
        raise ValueError(f"both factors have more than {MOST_LEVELS} levels; those of the smaller one are columns")
    ss_a, ss_b, ss_cells = by_level[1]["ss"], by_level[2]["ss"], by_level[0]["ss"]
    small, large, level = (a, b, 1) if k_a <= k_b else (b, a, 2)
    own = margins.where(F.col("level") == level).orderBy(small).select(small, "n", "s").collect()
    # Rows: one per level of the larger factor, holding the counts of the smaller factor's levels.
    here = lambda lv: F.coalesce(F.sum(F.when(F.col(small) == F.lit(lv), F.col("n"))), F.lit(0)).cast("double")
    wide = centred.groupBy(large).agg(F.sum("n").alias("n"), F.sum("__s").alias("s"),
                                      *[here(r[0]).alias(f"n{i}") for i, r in enumerate(own)])
    share = [F.col(f"n{i}") / F.sqrt("n") for i in range(len(own))]
    cross = gram(wide, share, F.col("s") / F.sqrt("n"))
    swept = np.diag([float(r["n"]) for r in own]) - cross.xtx
    rest = np.array([r["s"] for r in own]) - cross.xty
    rank = int(np.linalg.matrix_rank(swept, tol=1e-8 * n, hermitian=True))
    both = (ss_b if large == b else ss_a) + float(rest @ np.linalg.pinv(swept, rcond=1e-10, hermitian=True) @ rest)
    rank_both = (k_b if large == b else k_a) + rank
    rows = [
        (f"C({a})", both - ss_b, rank_both - k_b),
        (f"C({b})", both - ss_a, rank_both - k_a),
        (f"C({a}):C({b})", ss_cells - both, n_cells - rank_both),
    ]
    left = (residual, n - n_cells)
    table = spark.createDataFrame(
        [(t, float(s), float(d), float(left[0]), float(left[1])) for t, s, d in rows]
        + [("Residual", float(left[0]), float(left[1]), None, None)],
        "term string, sum_sq double, df double, ss_res double, df_res double")
    table = table.withColumn("F", ratio(ratio("sum_sq", "df"), ratio("ss_res", "df_res")))
    eta = F.when(F.col("sum_sq") + F.col("ss_res") > 0, ratio("sum_sq", F.col("sum_sq") + F.col("ss_res")))
    table = table.withColumn("eta_sq_partial", eta)
    if p_value:
        table = table.withColumn("PR(>F)", f_pvalue("F", "df", "df_res"))
    return table.drop("ss_res", "df_res")


def global_tests(df: DataFrame, group: str, a, b, measure: str = "monto", p_value: bool = True) -> DataFrame:
    """Summary of the mean and the rank test between two eras."""
    t = welch_t(df, f"{measure}_asinh", group, a, b, p_value=p_value)
    u = mann_whitney(df, measure, group, a, b, p_value=p_value)
    p = ["p_value"] if p_value else []
    first = t.select(F.lit("Welch_t_asinh").alias("test"), F.col("t_stat").alias("statistic"), *p,
                     F.col("hedges_g").alias("effect_size"))
    second = u.select(F.lit(f"MannWhitney_{measure}").alias("test"), F.col("u_stat").alias("statistic"), *p,
                      F.col("effect_r").alias("effect_size"))
    return first.unionByName(second)
