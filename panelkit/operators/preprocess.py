"""Imputation, scaling and category coding, fitted on one table and applied to another."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.operators.profile import _stack
from panelkit.operators.scan import exact_quantiles


def fit_medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Exact medians over the non-null values. Columns without nulls need none and are skipped."""
    missing = df.agg(*[F.sum(F.col(c).isNull().cast("int")).alias(c) for c in columns]).first()
    wanted = [c for c in columns if missing[c]]
    if not wanted:
        return {}
    return {r["column"]: r["value"] for r in exact_quantiles(df, wanted, [0.5]).collect()}


def fit_modes(df: DataFrame, columns: Sequence[str]) -> dict[str, str]:
    """Most frequent value per text column, ties to the smallest."""
    if not columns:
        return {}
    counts = _stack(df, columns, "string").where(F.col("value").isNotNull()).groupBy("column", "value").agg(
        F.count(F.lit(1)).alias("n"))
    best = counts.groupBy("column").agg(F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("mode"))
    return {r["column"]: r["mode"] for r in best.collect()}


def impute_median(df: DataFrame, columns: Sequence[str], fitted: dict | None = None) -> DataFrame:
    medians = fit_medians(df, columns) if fitted is None else fitted
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(m)) for c, m in medians.items()})


def impute_mode(df: DataFrame, columns: Sequence[str], fitted: dict | None = None) -> DataFrame:
    modes = fit_modes(df, columns) if fitted is None else fitted
    return df.withColumns({c: F.coalesce(c, F.lit(m)) for c, m in modes.items()})


def fit_scales(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    row = df.agg(*[F.avg(c).alias(f"m_{c}") for c in columns], *[F.stddev_pop(c).alias(f"s_{c}") for c in columns]).first()
    return {c: (row[f"m_{c}"], row[f"s_{c}"]) for c in columns}


def scaled(c: str, mean: float, std: float) -> Column:
    """Centred column over its population deviation; a constant column is only centred."""
    return (F.col(c) - F.lit(mean)) / F.lit(std if std else 1.0)


def standardize(df: DataFrame, columns: Sequence[str], fitted: dict | None = None) -> DataFrame:
    scales = fit_scales(df, columns) if fitted is None else fitted
    return df.withColumns({c: scaled(c, *scales[c]) for c in columns})


def one_hot_stages(columns: Sequence[str]) -> list:
    """Stages that code a level as its own 0/1 slot and an unseen level as all zeros."""
    index = StringIndexer(inputCols=list(columns), outputCols=[f"{c}__ix" for c in columns], handleInvalid="keep",
                          stringOrderType="alphabetAsc")
    code = OneHotEncoder(inputCols=[f"{c}__ix" for c in columns], outputCols=[f"{c}__hot" for c in columns],
                         dropLast=True)
    return [index, code]


@dataclass
class Preprocessor:
    """Median and mode imputation, population scaling and one-hot coding, fitted on train."""

    numeric: Sequence[str]
    categorical: Sequence[str] = ()

    def fit(self, df: DataFrame) -> "Preprocessor":
        self.medians = fit_medians(df, self.numeric)
        filled = impute_median(df, self.numeric, self.medians)
        self.scales = fit_scales(filled, self.numeric)
        self.modes = fit_modes(df, self.categorical)
        stages = one_hot_stages(self.categorical) if self.categorical else []
        names = [f"{c}__hot" for c in self.categorical]
        assemble = VectorAssembler(inputCols=[f"{c}__z" for c in self.numeric] + names, outputCol="features")
        self.coder = Pipeline(stages=[*stages, assemble]).fit(self._scaled(df))
        return self

    def _scaled(self, df: DataFrame) -> DataFrame:
        out = impute_mode(impute_median(df, self.numeric, self.medians), self.categorical, self.modes)
        return out.withColumns({f"{c}__z": scaled(c, *self.scales[c]) for c in self.numeric})

    def transform(self, df: DataFrame) -> DataFrame:
        """Input columns plus the vector column ``features``."""
        return self.coder.transform(self._scaled(df)).select(*df.columns, "features")

    def parts(self, df: DataFrame) -> DataFrame:
        """Input columns plus scaled numbers ``x`` (array) and category levels ``levels`` (array).

        The distance kernels compare levels directly instead of expanding them to 0/1 slots. Levels unknown to
        train are null.
        """
        out = impute_mode(impute_median(df, self.numeric, self.medians), self.categorical, self.modes)
        xs = F.array(*[scaled(c, *self.scales[c]) for c in self.numeric])
        known = self.coder.stages[0].labelsArray if self.categorical else []
        levels = [F.when(F.col(c).isin(list(ls)), F.col(c)) for c, ls in zip(self.categorical, known)]
        return out.withColumns({"x": xs, "levels": F.array(*levels).cast("array<string>")}).select(*df.columns, "x", "levels")
