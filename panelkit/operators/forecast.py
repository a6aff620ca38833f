"""Monthly forecasts for one or many series: calendar features, regression, recursive prediction."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.config import DEFAULTS
from panelkit.functions.dates import month_index, split_label
from panelkit.functions.scalars import sinh
from panelkit.operators.linear import fit_by
from panelkit.operators.panel import add_seasonality, calendar_lag, time_index
from panelkit.session import materialize

FEATURES = ("t", "sin12", "cos12", "lag1", "lag12")
LAGS = 12


def forecast_features(panel: DataFrame, keys: Sequence[str] = (), date: str = "fecha", value: str = "monto_asinh",
                      drop: bool = True) -> DataFrame:
    """Trend, season and calendar lags of every series; ``drop`` removes months without both lags."""
    out = panel.withColumnRenamed(value, "y") if value != "y" else panel
    out = add_seasonality(time_index(out, date, keys), date)
    for k in (1, LAGS):
        out = calendar_lag(out, "y", keys, date, k)
    return out.dropna(subset=["lag1", "lag12"]) if drop else out


def fit_forecaster(features: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """One regression per series: coefficient array, intercept first, in the order of ``FEATURES``."""
    return fit_by(features, "y", FEATURES, keys)


def future_months(last: Column, horizon: int = DEFAULTS.horizon) -> Column:
    """Array of the month starts after ``last``."""
    return F.transform(F.sequence(F.lit(1), F.lit(horizon)), lambda i: F.add_months(last, i))


def _step_features(month: Column, first: Column) -> list[Column]:
    angle = F.month(month) * F.lit(2 * 3.141592653589793 / 12)
    t = (month_index(month) - first).cast("double")
    return [F.lit(1.0), t, F.sin(angle), F.cos(angle)]


def _predict_chain(months: Column, history: Column, coef: Column, first: Column) -> Column:
    """Predictions for consecutive months, each fed back as a lag of later ones.

    ``history`` holds the 12 months before the first one, oldest first, with nulls for gaps; ``months`` holds
    structs (month, wanted). A month that is not wanted, or lacks a lag, gets null and feeds null.
    """
    start = F.struct(history.alias("window"), F.array().cast("array<double>").alias("out"))

    def step(state: Column, m: Column) -> Column:
        window = state["window"]
        xs = [*_step_features(m["month"], first), F.element_at(window, -1), F.element_at(window, 1)]
        dot = sum((F.element_at(coef, i + 1) * x for i, x in enumerate(xs)), F.lit(0.0))
        y = F.when(m["wanted"], dot)
        return F.struct(F.concat(F.slice(window, 2, LAGS - 1), F.array(y)).alias("window"),
                        F.concat(state["out"], F.array(y)).alias("out"))

    return F.aggregate(months, start, step, lambda s: s["out"])


def _history(panel: DataFrame, upto: DataFrame, keys: Sequence[str], date: str, value: str) -> DataFrame:
    """Per series: the last 12 months up to ``upto.__last``, oldest first, and the first month of the series."""
    joined = panel.join(upto, list(keys)) if keys else panel.withColumn("__last", upto.scalar())
    back = month_index("__last") - month_index(date)
    slot = F.when(back.between(0, LAGS - 1), F.struct((LAGS - back).alias("slot"), F.col(value).alias("v")))
    per = joined.groupBy(*keys, "__last").agg(
        F.min(month_index(date)).alias("__first"), F.map_from_entries(F.collect_list(slot)).alias("__map"))
    return per.withColumn("__window", F.transform(F.sequence(F.lit(1), F.lit(LAGS)), lambda i: F.col("__map")[i])).drop("__map")


def dynamic_predict(panel: DataFrame, model: DataFrame, last_known: DataFrame, wanted: DataFrame,
                    keys: Sequence[str] = (), date: str = "fecha", value: str = "y") -> DataFrame:
    """Recursive predictions of the ``wanted`` months (keys, date) of every series.

    ``last_known`` gives, per series, the last month (``__last``) whose observed values may be used. Predicted
    values replace later observations. A month without both lags stays null and is not fed back. Series run in
    parallel; a series' own steps are sequential by nature and hold one short array.
    """
    keys = list(keys)
    hist = _history(panel, last_known, keys, date, value)
    asked = wanted.groupBy(*keys).agg(F.max(date).alias("__end"), F.collect_set(date).alias("__dates"))
    if keys:
        ready = hist.join(asked, keys).join(model.select(*keys, "coef"), keys)
    else:
        # Single-row tables side by side, through scalar subqueries.
        ready = hist.withColumns({
            "__end": asked.select("__end").scalar(), "__dates": asked.select("__dates").scalar(),
            "coef": model.select("coef").scalar()})
    steps = month_index("__end") - month_index("__last")
    months = F.when(steps > 0, F.transform(F.sequence(F.lit(1), F.greatest(steps, F.lit(1))), lambda i: F.struct(
        F.add_months("__last", i).alias("month"), F.array_contains("__dates", F.add_months("__last", i)).alias("wanted"))))
    chain = ready.withColumn("__months", months).where(F.col("__months").isNotNull())
    out = chain.withColumn("__yhat", _predict_chain(F.col("__months"), F.col("__window"), F.col("coef"), F.col("__first")))
    cells = out.select(*keys, F.explode(F.arrays_zip("__months", "__yhat")).alias("c"))
    picked = cells.where("c.__months.wanted").select(
        *keys, F.col("c.__months.month").alias(date), F.col("c.__yhat").alias("yhat_asinh"))
    return picked.withColumn("yhat", sinh("yhat_asinh"))


def fitted_values(features: DataFrame, model: DataFrame, keys: Sequence[str] = (), date: str = "fecha") -> DataFrame:
    """One-step predictions from observed lags."""
    rows = features.join(model.select(*keys, "coef"), list(keys)) if keys else features.withColumn(
        "coef", model.select("coef").scalar())
    xs = [F.lit(1.0), *[F.col(c).cast("double") for c in FEATURES]]
    dot = sum((F.element_at("coef", i + 1) * x for i, x in enumerate(xs)), F.lit(0.0))
    return rows.select(*keys, date, dot.alias("yhat_asinh"), sinh(dot).alias("yhat"))


def forecast_table(panel: DataFrame, keys: Sequence[str] = (), holdout_start=DEFAULTS.holdout_start,
                   horizon: int = DEFAULTS.horizon, history: str = "all", date: str = "fecha",
                   measure: str = "monto", model: DataFrame | None = None) -> DataFrame:
    """Observed months with fitted (train) and recursive (test) predictions, followed by the forecast months.

    ``history='all'`` starts the forecast from all observed months. ``history='train'`` lets it see the training
    months only, which leaves every forecast month after a test period without a usable lag, hence null.
    """
    keys = list(keys)
    start = F.lit(holdout_start)
    observed = materialize(panel.withColumnRenamed(f"{measure}_asinh", "y"))
    features = materialize(forecast_features(observed, keys, date, "y"))
    train, test = features.where(F.col(date) < start), features.where(F.col(date) >= start)
    model = materialize(fit_forecaster(train, keys)) if model is None else model
    last_train = train.groupBy(*keys).agg(F.max(date).alias("__last"))
    last_seen = observed.groupBy(*keys).agg(F.max(date).alias("__last"))

    in_train = fitted_values(train, model, keys, date)
    in_test = dynamic_predict(observed, model, last_train, test.select(*keys, date), keys, date)
    ahead = last_seen.select(*keys, F.explode(future_months(F.col("__last"), horizon)).alias(date))
    known = last_seen if history == "all" else last_train
    future = dynamic_predict(observed, model, known, ahead, keys, date)

    truth = observed.select(*keys, date, F.col("y").alias("y_true_asinh"), F.col(measure).alias("y_true"))
    predicted = in_train.unionByName(in_test).unionByName(future)
    rows = truth.join(predicted, [*keys, date], "full")
    if keys:
        rows = rows.join(last_seen, keys)
        last = F.col("__last")
    else:
        last = last_seen.scalar()
    return rows.withColumn("split", split_label(date, holdout_start, last)).drop("__last").select(
        *keys, date, "y_true_asinh", "y_true", "yhat_asinh", "yhat", "split")
