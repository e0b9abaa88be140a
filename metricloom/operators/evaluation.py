"""Classifier and regression evaluation from exact score groups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from metricloom.functions.scalars import half_even, ratio_or_zero, safe_ratio
from metricloom.operators.ordered import ROWS_PER_TASK, running_before
from metricloom.operators.profile import union_all
from metricloom.operators.relational import pivot_metric, tagged_union


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weight n / (k * n_c) per class and the negative/positive ratio."""
    counts = df.where(F.col(label).isNotNull()).groupBy(F.col(label).alias("label")).agg(
        F.count(F.lit(1)).alias("n")
    )
    total = counts.agg(
        F.struct(
            F.sum("n").alias("n"),
            F.count(F.lit(1)).alias("k"),
            F.coalesce(F.sum(F.when(F.col("label") == 0, F.col("n"))), F.lit(0)).alias("neg"),
            F.coalesce(F.sum(F.when(F.col("label") == 1, F.col("n"))), F.lit(0)).alias("pos"),
        )
    ).scalar()
    return counts.select(
        "label", "n",
        half_even(total["n"] / (total["k"] * F.col("n")), 6).alias("balanced_weight"),
        half_even(total["neg"] / F.greatest(total["pos"], F.lit(1)), 6).alias("pos_ratio"),
    )


def with_prediction(df: DataFrame, score: str, threshold: float = 0.5, out: str = "prediction") -> DataFrame:
    """1 where the score reaches the threshold."""
    return df.withColumn(out, (F.col(score) >= threshold).cast("int"))


def confusion_matrix(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """All four cells, empty ones included, from one aggregate."""
    cells = [
        F.struct(
            F.lit(a).alias("actual"), F.lit(p).alias("predicted"),
            F.count_if((F.col(label) == a) & (F.col(prediction) == p)).alias("n"),
        )
        for a in (0, 1)
        for p in (0, 1)
    ]
    return df.agg(F.array(*cells).alias("m")).select(F.inline("m"))


def _cells(label: Column, prediction: Column) -> dict[str, Column]:
    return {
        "tn": F.count_if((label == 0) & (prediction == 0)),
        "fp": F.count_if((label == 0) & (prediction == 1)),
        "fn": F.count_if((label == 1) & (prediction == 0)),
        "tp": F.count_if((label == 1) & (prediction == 1)),
    }


def _f1(tp: Column, fp: Column, fn: Column) -> Column:
    return ratio_or_zero(2 * tp, 2 * tp + fp + fn)


def classification_report(df: DataFrame, label: str, prediction: str, digits: int = 4) -> DataFrame:
    """Precision, recall, F1 and support per class, plus accuracy, macro and weighted means."""
    counts = df.agg(*[c.alias(n) for n, c in _cells(F.col(label), F.col(prediction)).items()])
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    n = tn + fp + fn + tp

    def line(name, precision, recall, f1, support):
        return F.struct(
            F.lit(name).alias("row"),
            *[
                half_even(v, digits).alias(k)
                for k, v in (("precision", precision), ("recall", recall), ("f1", f1))
            ],
            support.cast("long").alias("support"),
        )

    zero = [ratio_or_zero(tn, tn + fn), ratio_or_zero(tn, tn + fp), _f1(tn, fn, fp)]
    one = [ratio_or_zero(tp, tp + fp), ratio_or_zero(tp, tp + fn), _f1(tp, fp, fn)]
    accuracy = ratio_or_zero(tp + tn, n)
    macro = [(a + b) / 2 for a, b in zip(zero, one)]
    weighted = [ratio_or_zero(a * (tn + fp) + b * (tp + fn), n) for a, b in zip(zero, one)]
    rows = F.array(
        line("0", *zero, tn + fp),
        line("1", *one, tp + fn),
        line("accuracy", accuracy, accuracy, accuracy, n),
        line("macro avg", *macro, n),
        line("weighted avg", *weighted, n),
    )
    return counts.select(F.inline(rows))


# --- curves -----------------------------------------------------------------------------


def score_groups(
    df: DataFrame, score: str, label: str, group: Sequence[str] = (),
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Per distinct score, highest first: its positives and negatives and those above it.

    Rows are combined to distinct scores before anything is ordered, and the ordered
    totals are cut into blocks when there are many scores.
    """
    group = list(group)
    grouped = (
        df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
        .groupBy(*group, F.col(score).alias("score"))
        .agg(
            F.count_if(F.col(label) == 1).alias("pos"),
            F.count_if(F.col(label) != 1).alias("neg"),
        )
        .withColumn("__down", -F.col("score"))
    )
    return running_before(
        grouped, group, "__down",
        {"tp_above": F.col("pos"), "fp_above": F.col("neg")},
        unique_order=True, at_most=df.count(), rows_per_task=rows_per_task,
    ).drop("__down")


def _totals(df: DataFrame, label: str) -> Column:
    return df.agg(
        F.struct(
            F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) != 1).alias("n")
        )
    ).scalar()


def roc_curve(df: DataFrame, score: str, label: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """False and true positive rate at each distinct score."""
    groups = score_groups(df, score, label, rows_per_task=rows_per_task)
    total = _totals(df.where(F.col(score).isNotNull() & F.col(label).isNotNull()), label)
    return groups.select(
        F.col("score").alias("threshold"),
        safe_ratio(F.col("fp_above") + F.col("neg"), F.nullif(total["n"], F.lit(0))).alias("fpr"),
        safe_ratio(F.col("tp_above") + F.col("pos"), F.nullif(total["p"], F.lit(0))).alias("tpr"),
    )


def pr_curve(df: DataFrame, score: str, label: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Precision and recall at each distinct score."""
    groups = score_groups(df, score, label, rows_per_task=rows_per_task)
    total = _totals(df.where(F.col(score).isNotNull() & F.col(label).isNotNull()), label)
    tp = F.col("tp_above") + F.col("pos")
    return groups.select(
        F.col("score").alias("threshold"),
        safe_ratio(tp, tp + F.col("fp_above") + F.col("neg")).alias("precision"),
        safe_ratio(tp, F.nullif(total["p"], F.lit(0))).alias("recall"),
    )


def _area_parts() -> dict[str, Column]:
    """Sums over score groups from which both areas follow."""
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    tp = F.col("tp_above") + F.col("pos")
    precision = tp / (tp + F.col("fp_above") + F.col("neg"))
    return {
        "__p": F.sum("pos"),
        "__n": F.sum("neg"),
        "__roc": F.sum(neg * (F.col("tp_above") + pos / 2)),
        "__ap": F.sum(pos * precision),
    }


def _areas(groups: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    sums = groups.groupBy(*group).agg(*[c.alias(n) for n, c in _area_parts().items()])
    p, n = F.col("__p").cast("double"), F.col("__n").cast("double")
    return sums.select(
        *group,
        safe_ratio(F.col("__roc"), F.nullif(p * n, F.lit(0.0))).alias("roc_auc"),
        safe_ratio(F.col("__ap"), F.nullif(p, F.lit(0.0))).alias("pr_auc"),
    )


def roc_auc(df: DataFrame, score: str, label: str, digits: int = 6, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Area under the ROC curve; tied scores count one half."""
    areas = _areas(score_groups(df, score, label, rows_per_task=rows_per_task))
    return areas.select(half_even(F.col("roc_auc"), digits).alias("roc_auc"))


def average_precision(df: DataFrame, score: str, label: str, digits: int = 6, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Step sum of precision over recall (not the trapezoid)."""
    areas = _areas(score_groups(df, score, label, rows_per_task=rows_per_task))
    return areas.select(half_even(F.col("pr_auc"), digits).alias("average_precision"))


def _threshold_ratios() -> dict[str, Column]:
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    return {
        "accuracy": ratio_or_zero(tp + tn, tn + fp + fn + tp),
        "precision": ratio_or_zero(tp, tp + fp),
        "recall": ratio_or_zero(tp, tp + fn),
        "f1": _f1(tp, fp, fn),
    }


def threshold_metrics(
    df: DataFrame, label: str, prediction: str, group: Sequence[str] = (), digits: int = 4
) -> DataFrame:
    """Accuracy, precision, recall and F1 alone: one aggregate, no ordering of scores."""
    cells = df.groupBy(*group).agg(
        *[c.alias(n) for n, c in _cells(F.col(label), F.col(prediction)).items()]
    )
    return cells.select(
        *group, *[half_even(v, digits).alias(n) for n, v in _threshold_ratios().items()]
    )


def classifier_metrics(
    df: DataFrame,
    score: str,
    label: str,
    prediction: str,
    group: Sequence[str] = (),
    digits: int = 4,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Accuracy, precision, recall, F1, ROC-AUC and PR-AUC, optionally per model."""
    group = list(group)
    cells = df.groupBy(*group).agg(
        *[c.alias(n) for n, c in _cells(F.col(label), F.col(prediction)).items()]
    )
    areas = _areas(score_groups(df, score, label, group, rows_per_task), group)
    if group:
        both = cells.join(areas, group)
    else:
        pair = areas.select(F.struct("roc_auc", "pr_auc").alias("a")).scalar()
        both = cells.withColumns({"roc_auc": pair["roc_auc"], "pr_auc": pair["pr_auc"]})
    metrics = {**_threshold_ratios(), "roc_auc": F.col("roc_auc"), "pr_auc": F.col("pr_auc")}
    return both.select(*group, *[half_even(v, digits).alias(n) for n, v in metrics.items()])


def regression_metrics(df: DataFrame, actual: str, predicted: str, group: Sequence[str] = (), digits: int = 4) -> DataFrame:
    """Root mean squared and mean absolute error."""
    error = F.col(actual).cast("double") - F.col(predicted).cast("double")
    return df.groupBy(*group).agg(
        half_even(F.sqrt(F.avg(error * error)), digits).alias("rmse"),
        half_even(F.avg(F.abs(error)), digits).alias("mae"),
    )


# --- comparisons ------------------------------------------------------------------------


def model_comparison(rows: Mapping[str, DataFrame]) -> DataFrame:
    """One row per model, named."""
    return union_all([t.select(F.lit(name).alias("model"), "*") for name, t in rows.items()])


def leakage_gap(temporal: DataFrame, random: DataFrame, metric: str = "f1") -> DataFrame:
    """How much a random split flatters each model, relative to the random score (in %)."""
    stacked = tagged_union({"temporal": temporal, "random": random})
    wide = pivot_metric(stacked, "model", "split", metric, ["temporal", "random"])
    gap = safe_ratio((F.col("random") - F.col("temporal")) * 100, F.nullif(F.col("random"), F.lit(0.0)))
    return wide.select(
        "model",
        half_even(F.col("temporal"), 4).alias("temporal"),
        half_even(F.col("random"), 4).alias("random"),
        half_even(gap, 2).alias("gap_pct"),
    )
