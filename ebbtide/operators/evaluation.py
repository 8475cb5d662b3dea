"""Exact evaluation of scored rows.

Everything comes from two small aggregates: rows per (label, prediction) and rows per distinct
score. Curves and areas order distinct scores, never rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.operators.ordering import digits_of, running_totals
from ebbtide.session import written


def _grouping(by) -> list[str]:
    return [by] if isinstance(by, str) else list(by or [])


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction", by=None) -> DataFrame:
    """Rows ``(label, prediction, n)``, all four cells present per group; unlabelled rows are left out."""
    by = _grouping(by)
    cells = [
        F.struct(
            F.lit(y).alias("label"),
            F.lit(p).alias("prediction"),
            F.count_if((F.col(label) == y) & (F.col(prediction) == p)).alias("n"),
        )
        for y in (0, 1)
        for p in (0, 1)
    ]
    return df.groupBy(*by).agg(F.array(*cells).alias("cells")).select(*by, F.inline("cells"))


def _cells(df: DataFrame, label: str, prediction: str, by: list[str]) -> DataFrame:
    def n(y: int, p: int) -> Column:
        return F.count_if((F.col(label) == y) & (F.col(prediction) == p))

    return df.groupBy(*by).agg(n(1, 1).alias("tp"), n(0, 1).alias("fp"), n(1, 0).alias("fn"), n(0, 0).alias("tn"))


def _ratio(num: Column, den: Column) -> Column:
    """0 where the measure is undefined."""
    return F.when(den > 0, num / den).otherwise(0.0)


def _f1(p: Column, r: Column) -> Column:
    return _ratio(2 * p * r, p + r)


def _class_measures():
    """Precision, recall and support of class 1 and class 0 from the four cells."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return {
        1: (_ratio(tp, tp + fp), _ratio(tp, tp + fn), tp + fn),
        0: (_ratio(tn, tn + fn), _ratio(tn, tn + fp), tn + fp),
    }


def _threshold_columns() -> dict[str, Column]:
    measures = _class_measures()
    total = F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")
    p1, r1, _ = measures[1]

    def weighted(pick) -> Column:
        parts = [pick(p, r) * s for p, r, s in measures.values()]
        return _ratio(parts[0] + parts[1], total)

    return {
        "accuracy": _ratio(F.col("tp") + F.col("tn"), total),
        "precision": p1,
        "recall": r1,
        "f1_score": _f1(p1, r1),
        "weighted_precision": weighted(lambda p, r: p),
        "weighted_recall": weighted(lambda p, r: r),
        "weighted_f1": weighted(_f1),
    }


def threshold_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction", by=None) -> DataFrame:
    """accuracy; precision, recall, f1 of the churn class; the same weighted by class size."""
    by = _grouping(by)
    cells = _cells(df, label, prediction, by)
    return cells.select(*by, *[c.alias(n) for n, c in _threshold_columns().items()])


def classification_report(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """precision, recall, f1 and support per class, then macro and weighted averages."""
    rows = []
    measures = _class_measures()
    for value in (0, 1):
        p, r, s = measures[value]
        rows.append((str(value), p, r, _f1(p, r), s))
    total = rows[0][4] + rows[1][4]
    rows.append(("macro avg", *[(rows[0][i] + rows[1][i]) / 2 for i in (1, 2, 3)], total))
    weighted = [_ratio(rows[0][i] * rows[0][4] + rows[1][i] * rows[1][4], total) for i in (1, 2, 3)]
    rows.append(("weighted avg", *weighted, total))
    names = ("class", "precision", "recall", "f1_score", "support")
    structs = [
        F.struct(*[(F.lit(v) if isinstance(v, str) else v).alias(n) for n, v in zip(names, row)]) for row in rows
    ]
    return _cells(df, label, prediction, []).select(F.inline(F.array(*structs)))


def score_counts(df: DataFrame, label: str = "label", score: str = "score", by=None) -> DataFrame:
    """Positives and negatives per distinct score."""
    by = _grouping(by)
    return (
        df.where(F.col(label).isNotNull() & F.col(score).isNotNull())
        .groupBy(*by, F.col(score).alias("score"))
        .agg(F.count(F.when(F.col(label) == 1, 1)).alias("pos"), F.count(F.when(F.col(label) == 0, 1)).alias("neg"))
    )


def _cumulated(counts: DataFrame, by: list[str]) -> DataFrame:
    return running_totals(counts, "score", ["pos", "neg"], by, descending=True).withColumns(
        {"tp": F.col("pos_before") + F.col("pos"), "fp": F.col("neg_before") + F.col("neg")}
    )


def roc_points(df: DataFrame, label: str = "label", score: str = "score", by=None) -> DataFrame:
    """False and true positive rate at every distinct score taken as threshold."""
    by = _grouping(by)
    return _cumulated(score_counts(df, label, score, by), by).select(
        *by,
        F.col("score").alias("threshold"),
        F.try_divide("fp", "neg_total").alias("fpr"),
        F.try_divide("tp", "pos_total").alias("tpr"),
    )


def pr_points(df: DataFrame, label: str = "label", score: str = "score", by=None) -> DataFrame:
    """Precision and recall at every distinct score taken as threshold."""
    by = _grouping(by)
    return _cumulated(score_counts(df, label, score, by), by).select(
        *by,
        F.col("score").alias("threshold"),
        (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
        F.try_divide("tp", "pos_total").alias("recall"),
    )


def _area_columns() -> dict[str, Column]:
    """Both curve areas as aggregates over the rows of ``_cumulated``."""
    precision = F.try_divide("tp", F.col("tp") + F.col("fp"))
    precision_before = F.try_divide("pos_before", F.col("pos_before") + F.col("neg_before"))
    concordant = F.sum(F.col("neg") * (F.col("pos_before") + F.col("pos") / 2))
    # Twice the trapezoid sum, halved below.
    under_pr = F.sum(F.col("pos") * (precision + F.coalesce(precision_before, precision)))
    # As doubles: the number of pairs outgrows a bigint long before the number of rows does.
    positives, negatives = F.max("pos_total").cast("double"), F.max("neg_total").cast("double")
    return {
        "roc_auc": F.when(negatives > 0, F.try_divide(concordant, positives * negatives)),
        "pr_auc": F.try_divide(under_pr, positives * 2),
    }


def roc_auc(df: DataFrame, label: str = "label", score: str = "score", by=None) -> DataFrame:
    """``roc_auc`` alone, without joining totals back to scores.

    A (positive, negative) pair ranked right lies within one score (counting half), within one
    stretch of the score order, or across stretches. Each level adds its pairs and hands on sums.
    """
    by = _grouping(by)
    high, low = digits_of(F.col("score").cast("double"))
    steps = score_counts(df, label, score, by).select(
        (F.struct(*by) if by else F.lit(0)).alias("_group"),
        high.alias("_high"),
        low.alias("_low"),
        "score",
        "pos",
        "neg",
        (F.col("pos").cast("double") * F.col("neg") / 2).alias("pairs"),
    )
    levels = (["_group", "_high", "_low"], "score"), (["_group", "_high"], "_low"), (["_group"], "_high")
    for keys, order in levels:
        ahead = Window.partitionBy(*keys).orderBy(F.col(order).desc()).rowsBetween(Window.unboundedPreceding, -1)
        positives_ahead = F.coalesce(F.sum("pos").over(ahead), F.lit(0)).cast("double")
        steps = (
            steps.withColumn("pairs", F.col("pairs") + F.col("neg") * positives_ahead)
            .groupBy(*keys)
            .agg(F.sum("pairs").alias("pairs"), F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
        )
    area = F.try_divide("pairs", F.col("pos").cast("double") * F.col("neg")).alias("roc_auc")
    return steps.select(*[F.col(f"_group.{c}").alias(c) for c in by], area)


def areas(df: DataFrame, label: str = "label", score: str = "score", by=None, stored: bool = False) -> DataFrame:
    """``roc_auc`` (ties count half) and ``pr_auc`` (trapezoids); null where a class is absent.

    ``stored`` as in ``metrics``.
    """
    by = _grouping(by)
    counts = score_counts(df, label, score, by)
    points = _cumulated(written(counts, "scores") if stored else counts, by)
    return points.groupBy(*by).agg(*[c.alias(n) for n, c in _area_columns().items()])


def metrics(df: DataFrame, label: str = "label", score: str = "score", prediction: str = "prediction", by=None,
            stored: bool = False) -> DataFrame:
    """All measures of a scored table, one row per group, from a single pass over its rows.

    All come from the same rows per score, which several steps read. With ``stored`` these are written at once, for
    scores that cost much: whether Spark shares a shuffle between steps depends on the plan below it.
    """
    by = _grouping(by)

    # No count_if, whose condition Spark names anew in each step, and columns in the order of their first use below:
    # else the steps share no shuffle.
    def n(y: int, predicted: Column) -> Column:
        return F.count(F.when((F.col(label) == y) & predicted, 1))

    yes, no = (F.coalesce(F.col(prediction) == p, F.lit(False)) for p in (1, 0))
    sides = {"1": yes, "0": no, "_other": ~yes & ~no}
    tally = df.groupBy(*by, F.col(score).alias("score")).agg(
        *[n(y, predicted).alias(f"_{y}{side}") for y in (1, 0) for side, predicted in sides.items()]
    )
    if stored:
        tally = written(tally, "scores")

    # A row without a score counts nothing on the curves; it stays for the other measures.
    def ranked(y: int) -> Column:
        return F.when(F.col("score").isNotNull(), sum(F.col(f"_{y}{side}") for side in sides)).otherwise(0)

    def total(cell: str) -> Column:
        return F.coalesce(F.sum(cell), F.lit(0))

    cells = {"tp": "_11", "fp": "_01", "fn": "_10", "tn": "_00"}
    summed = (
        _cumulated(tally.withColumns({"pos": ranked(1), "neg": ranked(0)}), by)
        .groupBy(*by)
        .agg(*[c.alias(m) for m, c in _area_columns().items()], *[total(of).alias(c) for c, of in cells.items()])
    )
    return summed.select(*by, *[c.alias(m) for m, c in _threshold_columns().items()], "roc_auc", "pr_auc")


MEASURES = (
    "accuracy",
    "precision",
    "recall",
    "f1_score",
    "weighted_precision",
    "weighted_recall",
    "weighted_f1",
    "roc_auc",
    "pr_auc",
)


def long_metrics(wide: DataFrame, keys) -> DataFrame:
    """Metric rows ``(keys, metric, value)``."""
    present = [m for m in MEASURES if m in wide.columns]
    return wide.unpivot(list(keys), present, "metric", "value")


def fold_summary(scores: DataFrame) -> DataFrame:
    """Mean and population deviation over folds of rows ``(fold, metric, value)``."""
    return scores.groupBy("metric").agg(
        F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"), F.count(F.lit(1)).alias("folds")
    )


def split_gap(df: DataFrame, label: str = "label", score: str = "score", prediction: str = "prediction") -> DataFrame:
    """Train and test measures side by side with their difference, from a ``split`` column."""
    long = long_metrics(metrics(df, label, score, prediction, by="split"), ["split"])

    def of(split: str) -> Column:
        return F.max(F.when(F.col("split") == split, F.col("value")))

    return long.groupBy("metric").agg(
        of("train").alias("train"), of("test").alias("test"), (of("train") - of("test")).alias("gap")
    )
