"""From a change log to compared risk models."""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark import StorageLevel
from pyspark.sql import DataFrame, functions as F

from metricloom.functions.scalars import half_even
from metricloom.operators import cleaning, evaluation, features, history, labels, learners, profile, splits, trees
from metricloom.operators.features import MODEL_FEATURES
from metricloom.operators.history import CHANGE_FEATURES
from metricloom.operators.profile import union_all
from metricloom.operators.relational import tagged_union
from metricloom.session import side_by_side, written_once

LABEL = "is_buggy"
CHURN = "churn_log"
#: The last columns that the dataset's descriptive table covers.
DERIVED = ["churn", "LA_ratio", "LD_ratio"]


def build_dataset(changes: DataFrame, lines: DataFrame, as_of: datetime) -> DataFrame:
    """Change features, labels, cleaning, derived columns and their log forms.

    Features without variation are dropped before anything is derived from them.
    """
    commits = history.change_features(changes, as_of)
    labelled = labels.label_changes(changes, lines, commits)
    first = cleaning.dedup_keep_first(labelled, "hash", ["repo", "commit_seq"])
    mature = cleaning.maturity_filter(first, "committer_date", as_of)
    filled = written_once(cleaning.ensure_features(mature, CHANGE_FEATURES), "features")
    varied = cleaning.drop_constant_columns(filled, CHANGE_FEATURES, "deviation")
    derived = features.size_ratios(features.churn(varied))
    return features.log1p_bank(derived).withColumn(LABEL, cleaning.clamp_label(F.col(LABEL)))


def dataset_summary(data: DataFrame) -> DataFrame:
    """Labelled and all changes per repository, and the share of the first."""
    return profile.group_balance(data, "repo", LABEL)


def dataset_statistics(data: DataFrame) -> DataFrame:
    """Count, mean, deviation, quartiles and skew of the features and derived columns."""
    cols = [c for c in [*CHANGE_FEATURES, *DERIVED] if c in data.columns]
    return profile.describe_with_skew(data, cols)


@dataclass
class Comparison:
    """Models fitted on one split: their six numbers, and what tuning and trees tell."""

    metrics: DataFrame
    settings: DataFrame | None
    importances: DataFrame


def _local(df: DataFrame) -> DataFrame:
    """A result table of a few rows, computed now."""
    return df.sparkSession.createDataFrame(df.collect(), df.schema)


def fit_and_compare(
    train: DataFrame,
    test: DataFrame,
    columns: Sequence[str],
    settings: Mapping[str, Mapping],
    label: str = "label",
    key: str = "id",
    tune: Mapping | None = None,
) -> Comparison:
    """The logistic baseline and the given tree models on one split, one row each.

    With ``tune`` (arguments of ``learners.random_search``) the settings of the tree models
    come from a search on the training rows. Train and test are read many times, so the columns
    in use are written once. The models are fitted and
    judged side by side: one that is boosted keeps a single core busy.
    """
    used = list(dict.fromkeys([*columns, key, label]))
    train, test = written_once(train.select(*used), "train"), written_once(test.select(*used), "test")
    neg, pos = learners.class_counts(train, label)
    if pos == 0 or neg == 0:
        raise ValueError("the training rows hold only one class")
    spark, bins = train.sparkSession, trees.find_bins(train, columns) if settings and tune is None else None

    def judged(kind: str) -> tuple:
        table = None
        if kind not in settings:
            model = learners.LogisticBaseline(columns, label).fit(train)
        elif tune is None:
            model = learners.TreeClassifier(kind, columns, label, key, **settings[kind]).fit(train, bins)
        else:
            model, _, table = learners.random_search(train, kind, columns, key, label, **tune)
        scored = learners.scores(model, test, [], label).persist(StorageLevel.MEMORY_AND_DISK)
        row = _local(evaluation.classifier_metrics(scored, "score", "label", "prediction"))
        scored.unpersist()
        return row, table, model.model.importance(learners.IMPORTANCE[kind]) if kind in settings else []

    found = side_by_side(spark, {k: functools.partial(judged, k) for k in ("logistic", *settings)})
    searched = [table for _, table, _ in found.values() if table is not None]
    weights = [(name, f, float(v)) for name, (_, _, shares) in found.items() for f, v in shares]
    importances = spark.createDataFrame(weights, "model string, feature string, importance double")
    return Comparison(
        evaluation.model_comparison({name: row for name, (row, _, _) in found.items()}),
        union_all(searched) if searched else None, importances,
    )


def compare_models(
    train: DataFrame, test: DataFrame, columns: Sequence[str], settings: Mapping[str, Mapping],
    label: str = "label", key: str = "id",
) -> DataFrame:
    """The six numbers of each model on one split."""
    return fit_and_compare(train, test, columns, settings, label, key).metrics


def compare_regressors(data: DataFrame, columns: Sequence[str], target: str = CHURN, key: str = "hash") -> DataFrame:
    """Ridge and a forest, fitted on three quarters of the rows and judged on the rest."""
    marked = splits.random_split(data, key).persist(StorageLevel.MEMORY_AND_DISK)
    train, test = marked.where(~F.col("is_test")), marked.where(F.col("is_test"))
    models = {
        "ridge": learners.RidgeRegression(columns, target),
        "forest": learners.ForestRegression(columns, target, key),
    }
    rows = {
        name: _local(evaluation.regression_metrics(model.fit(train).transform(test), target, "prediction"))
        for name, model in models.items()
    }
    marked.unpersist()
    return evaluation.model_comparison(rows)


@dataclass
class RiskStudy:
    """All results of the study, each a table."""

    data: DataFrame
    comparisons: dict[str, Comparison] = field(default_factory=dict)

    def metrics(self) -> DataFrame:
        return tagged_union({name: c.metrics for name, c in self.comparisons.items()})

    def settings(self) -> DataFrame:
        """Every tried setting with its mean area, per split; ``best`` marks the chosen one."""
        return tagged_union({n: c.settings for n, c in self.comparisons.items() if c.settings is not None})

    def importances(self) -> DataFrame:
        return tagged_union({name: c.importances for name, c in self.comparisons.items()})

    def leakage(self) -> DataFrame:
        """How much the random split flatters each fitted model."""
        return evaluation.leakage_gap(self.comparisons["temporal"].metrics, self.comparisons["random"].metrics)

    def as_one_table(self) -> DataFrame:
        """(part, split, model, item, value): everything stacked, values to four digits."""
        value = half_even(F.col("value").cast("double"), 4).alias("value")
        numbers = ["accuracy", "precision", "recall", "f1", "roc_auc", "pr_auc"]
        metrics = self.metrics().unpivot(["split", "model"], numbers, "item", "value")
        gap = self.leakage().unpivot(["model"], ["gap_pct"], "item", "value")
        parts = [
            metrics.select(F.lit("metrics").alias("part"), "split", "model", "item", value),
            gap.select(F.lit("leakage").alias("part"), F.lit("both").alias("split"), "model", "item", value),
            self.importances().select(
                F.lit("importance").alias("part"), "split", "model", F.col("feature").alias("item"),
                F.col("importance").alias("value"),
            ),
        ]
        if any(c.settings is not None for c in self.comparisons.values()):
            tried = self.settings()
            parts.append(
                tried.select(
                    F.when(F.col("best"), "best settings").otherwise("settings").alias("part"), "split",
                    F.col("kind").alias("model"), F.concat("settings", F.lit(" folds "), F.col("folds")).alias("item"),
                    F.col("roc_auc").alias("value"),
                )
            )
        return union_all(parts)


def risk_study(
    changes: DataFrame, lines: DataFrame, as_of: datetime, settings: Mapping[str, Mapping], tune: Mapping | None = None
) -> RiskStudy:
    """Model comparison under the temporal and the random split, tuned or with given settings.

    The dataset feeds many training passes, so it is written once to the shared folder.
    """
    data = written_once(build_dataset(changes, lines, as_of), "dataset")
    columns = [c for c in MODEL_FEATURES if c in data.columns]
    out = RiskStudy(data)

    def compared(train: DataFrame, test: DataFrame) -> Comparison:
        return fit_and_compare(train, test, columns, settings, LABEL, "hash", tune)

    def mixed() -> Comparison:
        marked = splits.stratified_split(data, "hash", LABEL)
        return compared(marked.where(~F.col("is_test")), marked.where(F.col("is_test")))

    out.comparisons |= side_by_side(
        data.sparkSession,
        {"temporal": lambda: compared(*splits.temporal_split(data, "commit_seq", "hash")), "random": mixed},
    )
    return out


def risk_table(
    changes: DataFrame, lines: DataFrame, as_of: datetime, settings: Mapping[str, Mapping]
) -> DataFrame:
    """The six numbers of each model under both splits."""
    return risk_study(changes, lines, as_of, settings).metrics()
