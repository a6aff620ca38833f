"""Classification metrics, from counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.functions.scalars import ratio
from panelkit.operators.scan import Running, running, value_ranks


def confusion_counts(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    return df.dropna(subset=[truth, predicted]).groupBy(
        F.col(truth).alias("truth"), F.col(predicted).alias("predicted")).agg(F.count(F.lit(1)).alias("count"))


def confusion_matrix(df: DataFrame, truth: str, predicted: str, labels: Sequence) -> DataFrame:
    """Counts for every pair of the given labels, zeros included, with the label positions."""
    spark, dtype = df.sparkSession, df.select(truth).schema[0].dataType.simpleString()
    grid = spark.createDataFrame([(i, j, a, b) for i, a in enumerate(labels) for j, b in enumerate(labels)],
                                 f"row int, col int, truth {dtype}, predicted {dtype}")
    counts = confusion_counts(df, truth, predicted)
    return grid.join(counts, ["truth", "predicted"], "left").select(
        "row", "col", "truth", "predicted", F.coalesce("count", F.lit(0)).alias("count"))


def class_counts(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Support, predicted count and hits per class, over every class seen on either side."""
    cells = confusion_counts(df, truth, predicted)
    halves = F.explode(F.array(
        F.struct(F.col("truth").alias("label"), F.col("count").alias("support"), F.lit(0).cast("long").alias("predicted"),
                 F.when(F.col("truth") == F.col("predicted"), F.col("count")).otherwise(0).alias("hits")),
        F.struct(F.col("predicted").alias("label"), F.lit(0).cast("long").alias("support"),
                 F.col("count").alias("predicted"), F.lit(0).cast("long").alias("hits"))))
    return cells.select(halves.alias("h")).select("h.*").groupBy("label").agg(
        *[F.sum(c).alias(c) for c in ("support", "predicted", "hits")])


def _or_zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0.0))


def classification_report(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Precision, recall, F1 and support per class, with macro and weighted averages. 0/0 counts as 0."""
    per = class_counts(df, truth, predicted).select(
        F.col("label").cast("string").alias("label"), _or_zero(ratio("hits", "predicted")).alias("precision"),
        _or_zero(ratio("hits", "support")).alias("recall"),
        _or_zero(ratio(2 * F.col("hits"), F.col("support") + F.col("predicted"))).alias("f1"), "support")
    measures = ("precision", "recall", "f1")
    macro = per.agg(F.lit("macro avg").alias("label"), *[F.avg(m).alias(m) for m in measures], F.sum("support").alias("support"))
    weighted = per.agg(F.lit("weighted avg").alias("label"),
                       *[ratio(F.sum(F.col(m) * F.col("support")), F.sum("support")).alias(m) for m in measures],
                       F.sum("support").alias("support"))
    return per.unionByName(macro).unionByName(weighted)


def classification_metrics(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Accuracy, balanced accuracy (mean recall over classes present in the truth) and F1 per class, long form."""
    per = class_counts(df, truth, predicted)
    recall = ratio("hits", "support")
    overall = per.agg(ratio(F.sum("hits"), F.sum("support")).alias("accuracy"), F.avg(recall).alias("balanced_accuracy"))
    first = overall.select(F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value"))
                                              for m in ("accuracy", "balanced_accuracy")])))
    f1 = _or_zero(ratio(2 * F.col("hits"), F.col("support") + F.col("predicted")))
    return first.unionByName(per.select(F.concat(F.lit("f1_"), F.col("label").cast("string")).alias("metric"), f1.alias("value")))


def roc_curve(df: DataFrame, truth: str, score: str, drop_collinear: bool = True) -> DataFrame:
    """One point per distinct score after the starting point (0, 0).

    ``drop_collinear`` leaves out inner points whose two neighbouring steps are equal.
    """
    rows = df.where(F.col(truth).isNotNull() & F.col(score).isNotNull())
    points = rows.groupBy(score).agg(F.sum(F.col(truth).cast("long")).alias("__pos"),
                                     F.sum(1 - F.col(truth).cast("long")).alias("__neg"))
    upto = running(points, [score], {"tp": Running("__pos", reverse=True), "fp": Running("__neg", reverse=True)})
    sums = upto.agg(F.max("tp").alias("p"), F.max("fp").alias("n")).first()
    pos, neg = sums["p"] or 0, sums["n"] or 0
    if drop_collinear:
        step = running(upto, [score], {
            "__np": Running("__pos", "last", inclusive=False), "__nn": Running("__neg", "last", inclusive=False)})
        turn = (F.col("__pos") != F.col("__np")) | (F.col("__neg") != F.col("__nn"))
        highest = (F.col("tp") == F.col("__pos")) & (F.col("fp") == F.col("__neg"))
        upto = step.where(F.col("__np").isNull() | highest | turn)
    rates = upto.select(F.col(score).alias("threshold"), ratio("fp", F.lit(neg)).alias("fpr"), ratio("tp", F.lit(pos)).alias("tpr"))
    start = df.sparkSession.createDataFrame([(float("inf"), 0.0 if neg else None, 0.0 if pos else None)],
                                            "threshold double, fpr double, tpr double")
    return start.unionByName(rates)


def roc_auc(df: DataFrame, truth: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Area under the curve from average ranks, null when only one class occurs."""
    rows = df.where(F.col(truth).isNotNull())
    table = value_ranks(rows, score, by, pos=F.col(truth).cast("long"))
    stats = table.groupBy(*by).agg(F.sum("pos").alias("__p"), F.sum(F.col("n") - F.col("pos")).alias("__n"),
                                   F.sum(F.col("pos") * F.col("avg_rank")).alias("__r"))
    p = F.col("__p").cast("double")
    return stats.select(*by, ratio(F.col("__r") - p * (p + 1) / 2, p * F.col("__n")).alias("auc"))
