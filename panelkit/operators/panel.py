"""Cleaning, monthly panels, lags, rolling windows and splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelkit.config import DEFAULTS
from panelkit.functions.dates import label_era, month_date, month_index, month_number, seasonality
from panelkit.functions.scalars import asinh, number
from panelkit.operators.scan import Running, running
from panelkit.session import materialize
from panelkit.sources.tables import require_columns


def drop_incomplete(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(columns))


def coerce_numeric(df: DataFrame, column: str = "monto") -> DataFrame:
    """The column as double; rows that hold no number are dropped."""
    return df.withColumn(column, number(column)).where(F.col(column).isNotNull())


def _computed_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column by exploding a one-element array.

    As a plain column the optimizer would paste its whole derivation into every later filter on the date or on a
    label made from it, and compute it anew each time.
    """
    return df.select(*[c for c in df.columns if c != name], F.explode(F.array(value)).alias(name))


def clean_facts(df: DataFrame, low=DEFAULTS.clean_from, high=DEFAULTS.clean_to) -> DataFrame:
    """Strict cleaning: month number and date of every row, then a closed date range.

    An unknown month fails the job. The check covers rows outside the range as well, hence no filter comes first.
    """
    require_columns(df, ["ciclo", "mes"])
    numbered = df.withColumn("mes_num", month_number("mes", on_unmapped="raise"))
    dated = _computed_once(numbered, "fecha", month_date("ciclo", "mes_num"))
    return dated.where(F.col("fecha").between(F.lit(low), F.lit(high)))


def prepare_facts(df: DataFrame, required: Sequence[str] = (), year: str = "ciclo", month: str = "mes",
                  measure: str = "monto", cutoff=DEFAULTS.era_cutoff, before=DEFAULTS.era_before,
                  after=DEFAULTS.era_after, years: tuple[int, int] | None = None) -> DataFrame:
    """Lenient preparation: month date and numeric measure, rows lacking one dropped, era label added.

    ``years`` bounds the year column before anything is derived, so that the scan can skip files and partitions.
    """
    require_columns(df, [year, month, measure, *required])
    if years:
        df = df.where(F.col(year).between(*years))
    number_of = F.col("mes_num") if "mes_num" in df.columns else month_number(month)
    dated = _computed_once(df.withColumn("mes_num", number_of), "fecha", month_date(year, "mes_num", strict=False))
    return coerce_numeric(dated.where(F.col("fecha").isNotNull()), measure).withColumn(
        "sexenio", label_era("fecha", cutoff, before, after))


def monthly_panel(df: DataFrame, keys: Sequence[str] = (), date: str = "fecha", measure: str = "monto",
                  keep_null_keys: bool = False) -> DataFrame:
    """Sum of the measure per month and key combination, with its asinh. Rows with a null key are left out."""
    if keys and not keep_null_keys:
        df = df.dropna(subset=list(keys))
    total = F.coalesce(F.sum(measure), F.lit(0.0))
    return df.groupBy(date, *keys).agg(total.alias(measure)).withColumn(f"{measure}_asinh", asinh(measure))


def _series(keys: Sequence[str]):
    """Window partition of one series. Lags work on panels: a series has one row per month, however many facts."""
    return W.partitionBy(*keys) if keys else W.partitionBy(F.lit(0))


def add_lag(df: DataFrame, column: str, keys: Sequence[str], order: Sequence[str] = ("fecha",), k: int = 1,
            out: str | None = None) -> DataFrame:
    """Value of the ``k``-th previous row of the series, whatever its month."""
    return df.withColumn(out or f"lag{k}", F.lag(column, k).over(_series(keys).orderBy(*order)))


def calendar_lag(df: DataFrame, column: str, keys: Sequence[str], date: str = "fecha", k: int = 1,
                 out: str | None = None) -> DataFrame:
    """Value ``k`` months earlier, null when the series has no such month."""
    frame = _series(keys).orderBy(month_index(date)).rangeBetween(-k, -k)
    return df.withColumn(out or f"lag{k}", F.max(column).over(frame))


def rolling(df: DataFrame, column: str, keys: Sequence[str], how: str = "mean", order: Sequence[str] = ("fecha",),
            window: int = DEFAULTS.rolling_window, exclude_current: bool = False, out: str | None = None) -> DataFrame:
    """Mean or sample deviation of the last ``window`` rows, null until that many values exist."""
    first, last = (-window, -1) if exclude_current else (1 - window, 0)
    frame = _series(keys).orderBy(*order).rowsBetween(first, last)
    value = {"mean": F.avg, "std": F.stddev_samp}[how](column).over(frame)
    return df.withColumn(out or f"roll{window}_{how}", F.when(F.count(column).over(frame) == window, value))


def time_index(df: DataFrame, date: str = "fecha", keys: Sequence[str] = (), out: str = "t") -> DataFrame:
    """Months since the first month of the table, or of the series when ``keys`` are given."""
    first = F.min(month_index(date)).over(_series(keys)) if keys else df.agg(F.min(month_index(date))).scalar()
    return df.withColumn(out, month_index(date) - first)


def add_seasonality(df: DataFrame, date: str = "fecha", period: int = 12) -> DataFrame:
    sine, cosine = seasonality(date, period)
    return df.withColumn("mes", F.month(date)).withColumn("sin12", sine).withColumn("cos12", cosine)


def panel_features(df: DataFrame, keys: Sequence[str] = ("subtema", "sector"), date: str = "fecha",
                   measure: str = "monto", cutoff=DEFAULTS.era_cutoff, before=DEFAULTS.era_before,
                   after=DEFAULTS.era_after, exclude_current: bool = False) -> DataFrame:
    """Panel with era, season, lag and rolling features; rows without a full window are dropped."""
    value = f"{measure}_asinh"
    panel = monthly_panel(df, keys, date, measure).withColumn("sexenio", label_era(date, cutoff, before, after))
    panel = add_seasonality(panel, date)
    panel = add_lag(panel, value, keys, (date,), 1, "lag1")
    for how in ("mean", "std"):
        panel = rolling(panel, value, keys, how, (date,), exclude_current=exclude_current, out=f"roll3_{how}")
    return drop_incomplete(panel, ["lag1", "roll3_mean", "roll3_std"])


def model_panel(df: DataFrame, keys: Sequence[str] = ("subtema",), date: str = "fecha", measure: str = "monto",
                era: str = "sexenio", positive=DEFAULTS.era_after) -> DataFrame:
    """Panel with season, trend, lag and a 0/1 era column; the trend counts from the first panel month."""
    value = f"{measure}_asinh"
    panel = materialize(monthly_panel(df, [era, *keys], date, measure))  # the first month is a second pass
    panel = time_index(add_seasonality(panel, date), date)
    panel = add_lag(panel, value, keys, (date,), 1, "lag1")
    return drop_incomplete(panel.withColumn(f"{era}_bin", (F.col(era) == F.lit(positive)).cast("int")), ["lag1"])


def known_levels(test: DataFrame, train: DataFrame, column: str) -> DataFrame:
    """Test rows whose level occurs in train."""
    return test.join(train.select(column).distinct(), column, "left_semi")


def unseen_levels(test: DataFrame, train: DataFrame, column: str) -> DataFrame:
    """Levels of test that train lacks."""
    return test.select(column).distinct().join(train.select(column).distinct(), column, "left_anti")


def quantile_cutoff(df: DataFrame, date: str = "fecha", share: float = DEFAULTS.fallback_share,
                    out: str = "cutoff") -> DataFrame:
    """Date at row position ``int(share * n)`` in date order, from the counts per date."""
    counts = df.where(F.col(date).isNotNull()).groupBy(date).agg(F.count(F.lit(1)).alias("n"))
    placed = running(counts, [date], {"upto": Running("n")})
    position = F.floor(placed.agg(F.sum("n")).scalar() * F.lit(share))
    return placed.where(F.col("upto") > position).agg(F.min(date).alias(out))


def split_cutoff(df: DataFrame, boundary, date: str = "fecha", share: float = DEFAULTS.fallback_share):
    """The boundary if rows lie on both sides of it, otherwise the date at the given share of rows."""
    low, high = df.agg(F.min(date), F.max(date)).first()
    as_date = lambda v: v.date() if hasattr(v, "date") else v
    if low is not None and as_date(low) < boundary <= as_date(high):
        return boundary
    return quantile_cutoff(df, date, share).first()[0]


def temporal_split(df: DataFrame, boundary=DEFAULTS.holdout_start, date: str = "fecha",
                   share: float = DEFAULTS.fallback_share) -> tuple[DataFrame, DataFrame]:
    """Rows before and from the boundary, with an 80/20 fallback when one side would be empty."""
    cut = F.lit(split_cutoff(df, boundary, date, share))
    return df.where(F.col(date) < cut), df.where(F.col(date) >= cut)


def fold_of(position: Column, size: Column, folds: int) -> Column:
    """Test fold of a row position in expanding-window validation, 0 for rows that are only ever trained on."""
    test_size = F.floor(size / (folds + 1))
    start = size - folds * test_size
    return F.when(position < start, 0).otherwise(F.floor((position - start) / F.nullif(test_size, F.lit(0))) + 1).cast("int")


def time_series_folds(df: DataFrame, order: Sequence[str], folds: int = DEFAULTS.folds, out: str = "fold") -> DataFrame:
    """Expanding-window folds: fold ``f`` tests the rows marked ``f`` and trains on all rows marked lower.

    ``order`` must identify a row; the default use is date first, then the series keys.
    """
    placed = running(df.withColumn("__one", F.lit(1)), order, {"__upto": Running("__one")}).drop("__one")
    size = placed.agg(F.max("__upto")).scalar()
    return placed.withColumn(out, fold_of(F.col("__upto") - 1, size, folds)).drop("__upto")
