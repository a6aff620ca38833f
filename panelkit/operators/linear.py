"""Treatment-coded designs, least squares with robust errors, and error metrics.

A fit is one aggregation to cross products on the executors and one small solve on the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.config import DEFAULTS
from panelkit.functions.scalars import ratio, sinh
from panelkit.functions.tails import chi2_sf, f_sf, t_quantile, t_sf2
from panelkit.operators.scan import Running, attach_by_group, running
from panelkit.session import materialize

WIDE = 40
MOST_LEVELS = 2_000


@dataclass(frozen=True)
class Gram:
    n: int
    xtx: np.ndarray
    xty: np.ndarray
    yty: float


def gram(df: DataFrame, xs: Sequence[Column], y: Column, complete: bool = False) -> Gram:
    """Cross products of the columns ``xs`` and ``y`` over all complete rows: one with a null or NaN in any of them is left out.

    ``complete`` says that the caller has left such rows out; a null that a column then computes adds nothing to its sums.
    """
    p = len(xs)
    cells = [*xs, y]
    full = np.zeros((p + 1, p + 1))
    named = df.select(*[c.cast("double").alias(f"v{i}") for i, c in enumerate(cells)])
    if not complete:
        named = named.dropna()
    if p <= WIDE:
        pairs = [(i, j) for i in range(p + 1) for j in range(i, p + 1)]
        row = named.agg(F.count(F.lit(1)), *[F.sum(F.col(f"v{i}") * F.col(f"v{j}")) for i, j in pairs]).first()
        n = row[0]
        for (i, j), v in zip(pairs, row[1:]):
            full[i, j] = full[j, i] = v if v is not None else 0.0
    else:
        packed = named.select(F.array(*named.columns).alias("v"))

        def partial(batches):
            total, seen = np.zeros((p + 1, p + 1)), 0
            for frame in batches:
                if len(frame):
                    block = np.nan_to_num(np.stack(frame["v"].to_numpy()).astype(float))
                    total += block.T @ block
                    seen += len(block)
            if seen:
                i, j = np.triu_indices(p + 1)
                yield pd.DataFrame({"i": i, "j": j, "v": total[i, j], "n": seen})

        sums = packed.mapInPandas(partial, "i int, j int, v double, n long").groupBy("i", "j").agg(
            F.sum("v").alias("v"), F.sum("n").alias("n")).collect()
        n = sums[0]["n"] if sums else 0
        for r in sums:
            full[r["i"], r["j"]] = full[r["j"], r["i"]] = r["v"]
    return Gram(n, full[:p, :p], full[:p, p], float(full[p, p]))


@dataclass(frozen=True)
class Design:
    """Numeric columns, treatment-coded factors and their pairwise interactions, in formula order."""

    numeric: tuple[str, ...]
    factors: tuple[tuple[str, tuple[str, ...]], ...] = ()
    interactions: tuple[tuple[str, str], ...] = ()
    intercept: bool = True

    def terms(self) -> list[tuple[str, Column]]:
        levels = dict(self.factors)
        dummy = lambda f, lv: (F.col(f) == F.lit(lv)).cast("double")
        name = lambda f, lv: f"C({f})[T.{lv}]"
        out = [("Intercept", F.lit(1.0))] if self.intercept else []
        for f, lvs in self.factors:
            out += [(name(f, lv), dummy(f, lv)) for lv in lvs[1:]]
        for f, g in self.interactions:
            out += [(f"{name(f, x)}:{name(g, z)}", dummy(f, x) * dummy(g, z))
                    for z, x in product(levels[g][1:], levels[f][1:])]
        return out + [(c, F.col(c).cast("double")) for c in self.numeric]

    @property
    def names(self) -> list[str]:
        return [n for n, _ in self.terms()]


def fit_design(df: DataFrame, numeric: Sequence[str], factors: Sequence[str] = (),
               interactions: Sequence[tuple[str, str]] = (), intercept: bool = True) -> Design:
    """Design whose factor levels come from ``df`` in one pass; the first level in text order is the reference.

    Every level is a column of the plan and of the cross products, so there may be ``MOST_LEVELS`` at most.
    """
    found: dict[str, list[str]] = {f: [] for f in factors}
    if factors:
        cells = F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.col(f).cast("string").alias("level")) for f in factors])).alias("c")
        rows = df.select(cells).select("c.*").where("level IS NOT NULL").distinct().limit(MOST_LEVELS + 1).collect()
        if len(rows) > MOST_LEVELS:
            raise ValueError(f"the factors {', '.join(factors)} have more than {MOST_LEVELS} levels, each of which is a column")
        for r in rows:
            found[r["f"]].append(r["level"])
    return Design(tuple(numeric), tuple((f, tuple(sorted(found[f]))) for f in factors), tuple(interactions), intercept)


def design_matrix(df: DataFrame, design: Design, keep: Sequence[str] = ()) -> DataFrame:
    return df.select(*keep, *[c.alias(n) for n, c in design.terms()])


@dataclass(frozen=True)
class LinearModel:
    design: Design
    target: str
    coef: np.ndarray
    inverse: np.ndarray
    n: int
    rank: int
    rss: float
    tss: float
    xtx: np.ndarray = field(repr=False, default=None)
    cov: np.ndarray | None = field(repr=False, default=None)

    @property
    def df_resid(self) -> int:
        return self.n - self.rank

    @property
    def r2(self) -> float | None:
        return 1 - self.rss / self.tss if self.tss > 0 else None

    @property
    def r2_adj(self) -> float | None:
        if self.r2 is None or self.df_resid == 0:
            return None
        return 1 - (1 - self.r2) * (self.n - 1) / self.df_resid

    def predict(self) -> Column:
        return sum((c * F.lit(float(b)) for (_, c), b in zip(self.design.terms(), self.coef)), F.lit(0.0))


def complete_rows(df: DataFrame, target: str, design: Design) -> DataFrame:
    return df.dropna(subset=[target, *design.numeric, *[f for f, _ in design.factors]])


def ols(df: DataFrame, target: str, design: Design, cov: str | None = "HC3") -> LinearModel:
    """Least squares over complete rows; ``cov='HC3'`` adds the heteroskedasticity-robust covariance in a second pass."""
    used = [target, *design.numeric, *[f for f, _ in design.factors]]
    df = materialize(complete_rows(df, target, design).select(*dict.fromkeys(used)))  # for up to three passes
    xs = [c for _, c in design.terms()]
    y, p = F.col(target).cast("double"), len(xs)
    move, shift = np.eye(p), 0.0
    if design.intercept:
        # Columns are centred before they are multiplied: a lag that hardly varies would drown in the intercept.
        means = df.agg(*[F.avg(c) for c in xs[1:]], F.avg(y)).first()
        shift, centre = means[-1] or 0.0, [m or 0.0 for m in means[:-1]]
        move[0, 1:] = [-m for m in centre]
        g = gram(df, [xs[0], *[c - F.lit(float(m)) for c, m in zip(xs[1:], centre)]], y - F.lit(float(shift)), complete=True)
    else:
        g = gram(df, xs, y, complete=True)
    scale = np.sqrt(np.where(np.diag(g.xtx) > 0, np.diag(g.xtx), 1.0))
    unit = g.xtx / np.outer(scale, scale)
    solved = np.linalg.pinv(unit, hermitian=True) / np.outer(scale, scale)
    coef = solved @ g.xty
    rss = max(g.yty - float(coef @ g.xty), 0.0)
    coef, inverse, back = move @ coef, move @ solved @ move.T, np.linalg.inv(move)
    if design.intercept:
        coef[0] += shift
    rank, raw = int(np.linalg.matrix_rank(unit, hermitian=True)), back.T @ g.xtx @ back
    model = LinearModel(design, target, coef, inverse, g.n, rank, rss, g.yty, raw)
    # The residual sum comes from the residuals: as a difference of totals it would lose most digits of a good fit.
    scored = df.select(*[c.alias(f"x{i}") for i, c in enumerate(xs)], (y - model.predict()).alias("e"))
    if cov != "HC3":
        rss = scored.agg(F.sum(F.col("e") * F.col("e"))).first()[0] or 0.0
        spread = rss / model.df_resid if model.df_resid else float("nan")
        return replace(model, rss=rss, cov=inverse * spread)
    lever = sum((F.col(f"x{i}") * F.col(f"x{j}") * F.lit(float(inverse[i, j]) * (1 if i == j else 2))
                 for i in range(p) for j in range(i, p)), F.lit(0.0))
    scaled = scored.withColumn("w", ratio("e", 1 - lever))
    meat = gram(scaled, [F.col(f"x{i}") * F.col("w") for i in range(p)], F.col("e"), complete=True)
    return replace(model, rss=meat.yty, cov=inverse @ meat.xtx @ inverse)


@dataclass(frozen=True)
class AbsorbedModel:
    """Least squares with one effect per level of a large factor, which is swept out instead of being coded."""

    names: tuple[str, ...]
    coef: np.ndarray  # NaN where a column does not vary inside any level
    cov: np.ndarray
    n: int
    levels: int
    df_resid: int
    rss: float
    tss: float
    effects: DataFrame = field(repr=False)  # level, n, effect


def ols_absorbed(df: DataFrame, target: str, design: Design, absorb: str) -> AbsorbedModel:
    """``ols`` with robust errors (HC3) and a further factor ``absorb`` of any number of levels.

    Coefficients, residuals and their robust covariance are those of the fit with one indicator per level: target and columns
    are taken as deviations from their level's means, and a row's leverage grows by one over its level's rows. Level means are
    grouped sums that are joined back; no list of levels is made. A level of a single row has no residual and adds nothing to
    the covariance. The effects, one row per level, stay a table.
    """
    terms = replace(design, intercept=False).terms()
    names, p = tuple(n for n, _ in terms), len(terms)
    cells = {"__y": F.col(target).cast("double"), **{f"__x{i}": c for i, (_, c) in enumerate(terms)}}
    rows = materialize(complete_rows(df, target, design).where(F.col(absorb).isNotNull()).select(F.col(absorb).alias("level"), *[c.alias(k) for k, c in cells.items()]))
    means = materialize(rows.groupBy("level").agg(F.count(F.lit(1)).alias("__n"), *[F.avg(k).alias(f"__m{k}") for k in cells]))
    within = materialize(attach_by_group(rows, means, ["level"], "__n").select("__n", *[(F.col(k) - F.col(f"__m{k}")).alias(k) for k in cells]))
    xs = [F.col(f"__x{i}") for i in range(p)]
    g = gram(within, xs, F.col("__y"), complete=True)
    spread = np.diag(g.xtx).copy()
    total = rows.agg(*[(F.var_pop(k) * F.count(k)).alias(k) for k in cells]).first()
    fixed = spread <= 1e-12 * np.array([total[f"__x{i}"] or 0.0 for i in range(p)])  # a column that the levels determine
    scale = np.where(fixed, 1.0, np.sqrt(np.where(spread > 0, spread, 1.0)))
    unit = g.xtx / np.outer(scale, scale)
    unit[fixed, :] = unit[:, fixed] = 0.0
    inverse = np.linalg.pinv(unit, hermitian=True) / np.outer(scale, scale)
    coef, rank = inverse @ g.xty, int(np.linalg.matrix_rank(unit, hermitian=True))
    residual = F.col("__y") - sum((x * F.lit(float(b)) for x, b in zip(xs, coef)), F.lit(0.0))
    lever = 1 / F.col("__n") + sum((xs[i] * xs[j] * F.lit(float(inverse[i, j]) * (1 if i == j else 2)) for i in range(p) for j in range(i, p)), F.lit(0.0))
    weighted = within.withColumn("__e", residual).withColumn("__w", F.when(F.col("__n") > 1, ratio("__e", 1 - lever)))
    meat = gram(weighted, [x * F.col("__w") for x in xs], F.col("__e"), complete=True)
    levels = means.count()
    effect = F.col("__m__y") - sum((F.col(f"__m__x{i}") * F.lit(float(b)) for i, b in enumerate(coef)), F.lit(0.0))
    effects = means.select("level", F.col("__n").alias("n"), effect.alias("effect"))
    return AbsorbedModel(names, np.where(fixed, np.nan, coef), inverse @ meat.xtx @ inverse, g.n, levels, g.n - levels - rank, meat.yty, total["__y"] or 0.0, effects)


def absorbed_table(spark, model: AbsorbedModel, level: float = 0.95) -> DataFrame:
    """Coefficient, error and t interval per term; null for a column that the levels determine."""
    q, rows = t_quantile((1 + level) / 2, model.df_resid), []
    for name, b, v in zip(model.names, model.coef, np.diag(model.cov)):
        se = float(np.sqrt(max(v, 0.0)))
        known = np.isfinite(b)
        rows.append((name, float(b) if known else None, se if known else None, *((float(b - q * se), float(b + q * se)) if known and q else (None, None))))
    return spark.createDataFrame(rows, "term string, coef double, std_err double, low double, high double")


def coef_table(spark, model: LinearModel, factor: float = DEFAULTS.interval_factor, p_value: bool = True, level: float | None = None,
               t: bool = True) -> DataFrame:
    """Coefficient, error, t-value and interval per term, in formula order of the names.

    The interval is ``factor`` errors wide on either side. With a ``level`` it covers that share instead: by the t distribution
    with the residual degrees of freedom, or by the normal one if ``t`` is false; without degrees of freedom it is null.
    """
    if level is not None:
        factor = t_quantile((1 + level) / 2, model.df_resid if t else float("inf"))
    rows = []
    for name, b, v in zip(model.design.names, model.coef, np.diag(model.cov)):
        se = float(np.sqrt(max(v, 0.0)))
        t_value = float(b / se) if se > 0 else None
        p = t_sf2(t_value, model.df_resid) if p_value and t_value is not None else None
        ends = (None, None) if factor is None else (float(b - factor * se), float(b + factor * se))
        rows.append((name, float(b), se, t_value, p, *ends))
    out = spark.createDataFrame(rows, "term string, coef double, std_err double, t_value double, p_value double, "
                                      "ci95_low double, ci95_high double")
    return out if p_value else out.drop("p_value")


def predict(df: DataFrame, model: LinearModel, out: str = "y_pred") -> DataFrame:
    return df.withColumn(out, model.predict())


def residuals(df: DataFrame, target: str, predicted: str = "y_pred", out: str = "resid") -> DataFrame:
    return df.withColumn(out, F.col(target) - F.col(predicted))


def regression_metrics(df: DataFrame, truth: str, predicted: str, by: Sequence[str] = (),
                       back_transform: bool = True) -> DataFrame:
    """R2, MAE and RMSE over rows that have a prediction; with ``back_transform`` also after sinh of both columns."""
    rows = df.where(F.col(predicted).isNotNull() & F.col(truth).isNotNull())
    err = F.col(truth) - F.col(predicted)
    total = F.var_pop(truth) * F.count(truth)
    cols = [F.count(F.lit(1)).alias("n"), F.when(total > 0, 1 - ratio(F.sum(err * err), total)).alias("r2"),
            F.avg(F.abs(err)).alias("mae"), F.sqrt(F.avg(err * err)).alias("rmse")]
    if back_transform:
        raw = sinh(truth) - sinh(predicted)
        cols += [F.avg(F.abs(raw)).alias("mae_raw"), F.sqrt(F.avg(raw * raw)).alias("rmse_raw")]
    return rows.groupBy(*by).agg(*cols)


def fit_metrics(spark, model: LinearModel) -> DataFrame:
    return spark.createDataFrame([(model.n, model.df_resid, model.r2, model.r2_adj)],
                                 "n long, df_resid long, r2 double, r2_adj double")


def fit_diagnostics(df: DataFrame, model: LinearModel, order: Sequence[str]) -> DataFrame:
    """Numbers of a regression summary, one row per measure. ``order`` fixes the row order of Durbin-Watson."""
    spark, n, p = df.sparkSession, model.n, len(model.coef)
    e = residuals(predict(complete_rows(df, model.target, model.design), model), model.target, out="__e").select(*order, "__e")
    chained = running(e, order, {"__prev": Running("__e", "last", inclusive=False)})
    step = F.col("__e") - F.col("__prev")
    row = chained.agg(F.avg("__e").alias("mean"), F.var_pop("__e").alias("var"), F.skewness("__e").alias("skew"),
                      (F.kurtosis("__e") + 3).alias("kurt"), ratio(F.sum(step * step), F.sum(F.col("__e") * F.col("__e"))).alias("dw")).first()
    skew, kurt = row["skew"], row["kurt"]
    loglike = -n / 2 * (np.log(2 * np.pi) + np.log(model.rss / n) + 1) if model.rss > 0 else None
    rank = n - model.df_resid
    start = 1 if model.design.intercept else 0
    b, v = model.coef[start:], model.cov[start:, start:]
    q = int(np.linalg.matrix_rank(v, hermitian=True)) if len(b) else 0
    f_value = float(b @ np.linalg.pinv(v, hermitian=True) @ b) / q if q else None
    omnibus = _omnibus(skew, kurt, n) if skew is not None and n >= 8 else None
    jb = n / 6 * (skew**2 + (kurt - 3) ** 2 / 4) if skew is not None else None
    eig = np.linalg.eigvalsh(model.xtx)
    values = {
        "n": n, "df_model": rank - start, "df_resid": model.df_resid, "r2": model.r2, "r2_adj": model.r2_adj,
        "f_robust": f_value, "f_p_value": f_sf(f_value, q, model.df_resid) if f_value is not None else None,
        "log_likelihood": loglike, "aic": None if loglike is None else -2 * loglike + 2 * rank,
        "bic": None if loglike is None else -2 * loglike + np.log(n) * rank,
        "omnibus": omnibus, "omnibus_p": None if omnibus is None else chi2_sf(omnibus, 2),
        "skew": skew, "kurtosis": kurt, "jarque_bera": jb, "jarque_bera_p": None if jb is None else chi2_sf(jb, 2),
        "durbin_watson": row["dw"], "condition_number": float(np.sqrt(eig[-1] / eig[0])) if eig[0] > 0 else None,
    }
    return spark.createDataFrame([(k, None if x is None else float(x)) for k, x in values.items()],
                                 "measure string, value double")


def _omnibus(skew: float, kurt: float, n: int) -> float:
    """D'Agostino-Pearson statistic: sum of the squared normal scores of skewness and kurtosis."""
    y = skew * np.sqrt((n + 1) * (n + 3) / (6 * (n - 2)))
    beta2 = 3 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9))
    w2 = np.sqrt(2 * (beta2 - 1)) - 1
    z_skew = np.arcsinh(y / np.sqrt(2 / (w2 - 1))) / np.sqrt(np.log(np.sqrt(w2)))
    mean = 3 * (n - 1) / (n + 1)
    var = 24 * n * (n - 2) * (n - 3) / ((n + 1) ** 2 * (n + 3) * (n + 5))
    x = (kurt - mean) / np.sqrt(var)
    third = 6 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * np.sqrt(6 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3)))
    a = 6 + 8 / third * (2 / third + np.sqrt(1 + 4 / third**2))
    inner = (1 - 2 / a) / (1 + x * np.sqrt(2 / (a - 4)))
    z_kurt = ((1 - 2 / (9 * a)) - np.cbrt(inner)) / np.sqrt(2 / (9 * a))
    return float(z_skew**2 + z_kurt**2)


def fit_by(df: DataFrame, target: str, xs: Sequence[str], by: Sequence[str]) -> DataFrame:
    """One least-squares fit with intercept per group: coefficients as an array (intercept first).

    All groups are fitted by one aggregation; the small solves run on the executors, one row per group.
    """
    p, y = len(xs), F.col(target).cast("double")
    cols = [F.col(x).cast("double") for x in xs]
    stats = [F.covar_pop(cols[i], cols[j]) for i in range(p) for j in range(i, p)] + [F.covar_pop(c, y) for c in cols]
    stats += [F.avg(c) for c in cols] + [F.avg(y)]
    packed = df.dropna(subset=[target, *xs]).groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.array(*stats).alias("__s"))

    @F.pandas_udf("array<double>")
    def solve(rows: pd.Series) -> pd.Series:
        if not len(rows):
            return pd.Series([], dtype=object)
        i, j = np.triu_indices(p)
        size, r = len(i), np.stack([np.asarray(v, dtype=float) for v in rows])
        cov = np.zeros((len(r), p, p))
        cov[:, i, j] = cov[:, j, i] = r[:, :size]
        spread = np.einsum("nii->ni", cov)
        scale = np.sqrt(np.where(spread > 0, spread, 1.0))
        unit = cov / (scale[:, :, None] * scale[:, None, :])
        slopes = np.einsum("nij,nj->ni", np.linalg.pinv(unit, hermitian=True), r[:, size:size + p] / scale) / scale
        level = r[:, -1] - np.einsum("ni,ni->n", slopes, r[:, size + p:-1])
        return pd.Series(np.column_stack([level, slopes]).tolist())

    return packed.select(*by, "n", solve("__s").alias("coef"))


def simple_ols(df: DataFrame, y: str, x: str, by: Sequence[str] = ()) -> DataFrame:
    """Slope, intercept and R2 of one regressor."""
    return df.groupBy(*by).agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"),
                               F.regr_r2(y, x).alias("r2"), F.regr_count(y, x).alias("n"))


