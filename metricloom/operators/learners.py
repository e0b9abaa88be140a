"""Classifiers and regressors, their importances, tuning and batch scoring.

Linear models are ``pyspark.ml`` estimators; forests and boosting are grown by
``operators.trees`` over features that are cut into bins once.
"""

from __future__ import annotations

import itertools
import math
import random
from collections.abc import Mapping, Sequence

from pyspark import StorageLevel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from metricloom.functions.scalars import half_even
from metricloom.operators import evaluation, trees
from metricloom.operators.linear_models import assemble
from metricloom.operators.splits import SEED, stratified_folds
from metricloom.operators.trees import Growth, Trial
from metricloom.session import written_once

# Default settings of the compared models.
FOREST_TREES = 300
BOOST_ROUNDS = 300
BOOST_RATE = 0.05
BOOST_DEPTH = 6
BOOST_ROWS = 0.8
BOOST_COLUMNS = 0.8
LEAVES = 63
REGRESSION_TREES = 200
RIDGE_ALPHA = 1.0
INVERSE_PENALTY = 1.0
# Regression forest of the statistics package behind the dashboard (its
# documented defaults): trees, least rows of a node that is split, share of the features.
PLAIN_TREES = 500
PLAIN_SPLIT = 6
# What the two boosting libraries ask of a leaf by default.
DEPTHWISE_LEAF = {"l2": 1.0, "min_weight": 1.0}
LEAFWISE_LEAF = {"min_leaf": 20, "min_weight": 1e-3}

# The searched settings.
SEARCH_SPACES = {
    "forest": {
        "trees": [200, 300, 500],
        "depth": [None, 8, 15, 25],
        "min_leaf": [1, 2, 5],
        "columns": ["sqrt", "log2"],
    },
    "boosted": {
        "rounds": [200, 300, 500],
        "depth": [4, 6, 8],
        "rate": [0.01, 0.05, 0.1],
        "rows": [0.6, 0.8, 1.0],
        "columns": [0.6, 0.8, 1.0],
    },
    "boosted_leafwise": {
        "rounds": [200, 300, 500],
        "leaves": [31, 63, 127],
        "rate": [0.01, 0.05, 0.1],
        "rows": [0.6, 0.8, 1.0],
        "columns": [0.6, 0.8, 1.0],
    },
}
SEARCH_DRAWS = 20
SEARCH_FOLDS = 5
#: Rows times fits of a search that are dealt to its groups at once.
SEARCH_WORK = 20_000_000
#: After each of the first folds, settings are dropped whose mean area so far is this much
#: below the best mean.
RACE_MARGIN = 0.02


def class_counts(train: DataFrame, label: str = "label") -> tuple[int, int]:
    row = train.agg(
        F.count_if(F.col(label) == 0).alias("neg"), F.count_if(F.col(label) == 1).alias("pos")
    ).first()
    return row["neg"], row["pos"]


def balanced_weight(neg: int, pos: int, label: str = "label") -> Column:
    """n / (2 * n_c) as a column."""
    n = neg + pos
    return F.when(F.col(label) == 1, F.lit(n / (2.0 * max(pos, 1)))).otherwise(
        F.lit(n / (2.0 * max(neg, 1)))
    )


def _ready(df: DataFrame, features: Sequence[str], label: str, weight: Column | None = None) -> DataFrame:
    out = assemble(df.withColumn("label", F.col(label).cast("double")), features)
    return out.withColumn("weight", weight) if weight is not None else out


def tried_columns(columns: str | int, width: int) -> int | None:
    """How many of ``width`` features a node tries; ``None`` stands for all."""
    if isinstance(columns, int):
        return columns
    return {
        "all": None,
        "sqrt": max(1, int(math.sqrt(width))),
        "log2": max(1, int(math.log2(width))),
        "onethird": max(1, width // 3),
    }[columns]


def _depth(depth: int | None) -> int | None:
    if depth is not None and depth < 1:
        raise ValueError(f"a tree has a level of splits at least, not {depth}")
    return depth


def forest_trial(width, trees=FOREST_TREES, depth=None, min_leaf=1, columns="sqrt") -> Trial:
    """A forest whose trees weigh the classes of their own draws."""
    how = Growth(depth=_depth(depth), min_leaf=min_leaf, columns=tried_columns(columns, width))
    return Trial(how, trees)


def boosted_trial(
    width, rounds=BOOST_ROUNDS, depth=BOOST_DEPTH, rate=BOOST_RATE, rows=BOOST_ROWS, columns=BOOST_COLUMNS
) -> Trial:
    """Boosting with trees of a given depth."""
    return Trial(Growth(depth=_depth(depth), **DEPTHWISE_LEAF), rounds, rate, rows, columns)


def leafwise_trial(width, rounds=BOOST_ROUNDS, leaves=LEAVES, rate=BOOST_RATE, rows=1.0, columns=1.0) -> Trial:
    """Boosting with best-first trees of a number of leaves."""
    return Trial(Growth(leaves=leaves, **LEAFWISE_LEAF), rounds, rate, rows, columns)


BUILDERS = {
    "forest": forest_trial,
    "boosted": boosted_trial,
    "boosted_leafwise": leafwise_trial,
}


class Scaler:
    """Population z-scores; the moments (two numbers per column) come from the rows of ``fit``."""

    def __init__(self, cols: Sequence[str]):
        self.cols = list(cols)
        self.scaled = [f"{c}_std" for c in self.cols]

    def fit(self, train: DataFrame) -> "Scaler":
        row = train.agg(
            *[F.avg(c).alias(f"m_{c}") for c in self.cols],
            *[F.stddev_pop(c).alias(f"s_{c}") for c in self.cols],
        ).first()
        self.moments = {c: (row[f"m_{c}"], row[f"s_{c}"] or 1.0) for c in self.cols}
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns(
            {f"{c}_std": (F.col(c) - F.lit(m)) / F.lit(sd) for c, (m, sd) in self.moments.items()}
        )


def _fit_cached(estimator, ready: DataFrame):
    """Training reads its matrix many times: keep it (spilling to disk) while it runs."""
    matrix = ready.select("features", "label", *[c for c in ("weight",) if c in ready.columns])
    matrix = matrix.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return estimator.fit(matrix)
    finally:
        matrix.unpersist()


class LogisticBaseline:
    """L2-penalised logistic regression on population z-scores with balanced weights.

    The scaler is fitted on the training rows only. Spark minimises the weighted mean of
    the loss, so the penalty C becomes 1 / (C * sum of weights), and balanced weights sum
    to the number of rows.
    """

    def __init__(self, features: Sequence[str], label: str = "label"):
        self.label, self.scaler = label, Scaler(features)

    def fit(self, train: DataFrame) -> "LogisticBaseline":
        neg, pos = class_counts(train, self.label)
        scaled = self.scaler.fit(train).transform(train)
        ready = _ready(scaled, self.scaler.scaled, self.label, balanced_weight(neg, pos, self.label))
        self.model = _fit_cached(
            LogisticRegression(
                maxIter=1000, tol=1e-8, regParam=1.0 / (INVERSE_PENALTY * (neg + pos)),
                elasticNetParam=0.0, standardization=False, weightCol="weight",
            ),
            ready,
        )
        return self

    def scored(self, df: DataFrame) -> DataFrame:
        out = self.model.transform(_ready(self.scaler.transform(df), self.scaler.scaled, self.label))
        return out.select(
            *[F.col(f"`{c}`") for c in df.columns],
            vector_to_array("probability")[1].alias("score"), F.col("prediction").cast("int").alias("prediction"),
        )


class TreeClassifier:
    """A forest or boosted classifier with the class weighting of its kind.

    A forest balances the classes of every tree's own draw, a boosted model weighs positives
    by the ratio of the classes. ``key`` names a row in the draws. All rows take part.
    """

    def __init__(self, kind: str, features: Sequence[str], label: str = "label", key: str = "id", seed: int = SEED, **settings):
        self.kind, self.features, self.label, self.key, self.seed = kind, list(features), label, key, seed
        self.trial = BUILDERS[kind](len(self.features), **settings)

    def fit(self, train: DataFrame, bins: trees.Bins | None = None) -> "TreeClassifier":
        rows = train.select(*self.features, self.key, F.col(self.label).cast("double").alias("__label"))
        trial, shared = self.trial, {"seed": self.seed, "bins": bins}
        if trial.rate is None:
            self.model = trees.fit_forest(
                rows, self.features, "__label", self.key, trial.how, trial.trees, balanced=True, **shared
            )
        else:
            neg, pos = class_counts(train, self.label)
            self.model = trees.fit_boosted(
                rows, self.features, "__label", self.key, trial.how, trial.trees, trial.rate,
                trial.row_share, trial.column_share, positive_weight=neg / max(pos, 1), **shared,
            )
        return self

    def scored(self, df: DataFrame) -> DataFrame:
        return self.model.scored(df).withColumn("prediction", (F.col("score") > 0.5).cast("int"))


def scores(model, df: DataFrame, keep: Sequence[str], label: str = "label") -> DataFrame:
    """Row id, label, probability of the positive class and predicted class."""
    taken = [c for c in ("score", "prediction") if c in df.columns and c not in (*keep, label)]
    return model.scored(df.drop(*taken)).select(
        *keep, F.col(label).cast("int").alias("label"), "score", "prediction"
    )


# --- regression -------------------------------------------------------------------------


class RidgeRegression:
    """Ridge on population z-scores.

    Spark divides the squared error by 2n and scales the penalty by the deviation of the
    target, so alpha becomes alpha * std(y) / n.
    """

    def __init__(self, features: Sequence[str], target: str, alpha: float = RIDGE_ALPHA):
        self.target, self.alpha, self.scaler = target, alpha, Scaler(features)

    def fit(self, train: DataFrame) -> "RidgeRegression":
        row = train.agg(F.stddev_pop(self.target).alias("s"), F.count(self.target).alias("n")).first()
        ready = _ready(self.scaler.fit(train).transform(train), self.scaler.scaled, self.target)
        self.model = _fit_cached(
            LinearRegression(
                solver="normal", standardization=False, elasticNetParam=0.0,
                regParam=self.alpha * row["s"] / row["n"],
            ),
            ready,
        )
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        return self.model.transform(_ready(self.scaler.transform(df), self.scaler.scaled, self.target))


class ForestRegression:
    """Forest of regression trees; ``columns="onethird"`` draws a third of the features per
    split, ``"all"`` tries every one. All rows take part."""

    def __init__(
        self, features: Sequence[str], target: str, key: str = "id", trees=REGRESSION_TREES, depth=None,
        columns="all", min_leaf=1, min_split=2, seed=SEED,
    ):
        self.features, self.target, self.key, self.n_trees, self.seed = list(features), target, key, trees, seed
        self.how = Growth(
            depth=_depth(depth), min_leaf=min_leaf, min_split=min_split,
            columns=tried_columns(columns, len(self.features)),
        )

    @classmethod
    def plain(cls, features: Sequence[str], target: str, key: str = "id") -> "ForestRegression":
        """With the default settings of the statistics package behind the dashboard."""
        return cls(features, target, key, trees=PLAIN_TREES, columns="onethird", min_split=PLAIN_SPLIT)

    def fit(self, train: DataFrame) -> "ForestRegression":
        rows = train.select(*self.features, self.key, F.col(self.target).cast("double").alias("__target"))
        self.model = trees.fit_forest(
            rows, self.features, "__target", self.key, self.how, self.n_trees, seed=self.seed
        )
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        return self.model.scored(df.drop("prediction"), "prediction")


# --- importances ------------------------------------------------------------------------


def feature_importance(model: trees.Ensemble, kind: str = "impurity") -> DataFrame:
    """Share of the impurity decrease (or of the mean gain of a split) per feature, highest first."""
    return SparkSession.active().createDataFrame(
        model.importance(kind), "feature string, importance double"
    ).orderBy(F.desc("importance"), "feature")


def split_counts(model: trees.Ensemble) -> DataFrame:
    """How many splits use each feature, most used first."""
    counts = [(f, int(n)) for f, n in model.importance("splits")]
    return SparkSession.active().createDataFrame(counts, "feature string, importance long").orderBy(
        F.desc("importance"), "feature"
    )


#: The importance that each kind of model reports by default.
IMPORTANCE = {"forest": "impurity", "boosted": "gain", "boosted_leafwise": "splits"}


# --- tuning -----------------------------------------------------------------------------


def draw_settings(kind: str, draws: int = SEARCH_DRAWS, seed: int = SEED, space: Mapping | None = None) -> list[dict]:
    """Distinct random picks from the full grid of a model kind."""
    space = space or SEARCH_SPACES[kind]
    grid = [dict(zip(space, values)) for values in itertools.product(*space.values())]
    return random.Random(seed).sample(grid, min(draws, len(grid)))


def random_search(
    train: DataFrame,
    kind: str,
    features: Sequence[str],
    key: str,
    label: str = "label",
    draws: int = SEARCH_DRAWS,
    folds: int = SEARCH_FOLDS,
    seed: int = SEED,
    space: Mapping | None = None,
    rows: int | None = None,
    margin: float | None = RACE_MARGIN,
):
    """Random search by stratified cross-validation on ROC-AUC, refitted on all of ``train``.

    Returns (best model, best settings, table of settings with their mean score). Features
    are binned once; the fits of all settings and folds share one binned table of all rows (or
    of about ``rows``, if a caller asks for fewer), whose folds are a column. They run as groups of a job,
    or, if the rows are too many for a task, one after the other.
    After each of the first two folds, settings more than ``margin`` below the best mean so
    far are dropped (``None``: never); their mean and the folds they saw stay in the table.
    The best is chosen among those that saw every fold, ties to the one drawn first.
    """
    picks = draw_settings(kind, draws, seed, space)
    trials = [BUILDERS[kind](len(features), **p) for p in picks]
    bins = trees.find_bins(train, features)
    n = train.count()
    sample = train if rows is None else trees.bounded(train, key, n, rows, seed)
    dealt = stratified_folds(sample.select(*features, key, label), key, label, folds, seed)
    table = trees.packed(dealt, bins, [key, label, "fold"]).select(
        F.xxhash64(key).alias("row"), "bins", F.col(label).cast("double").alias("target"), "fold"
    )
    table = written_once(table, "search")
    stages = [[0], [1], list(range(2, folds))] if margin is not None and folds > 2 else [list(range(folds))]
    areas: dict[int, list[float]] = {t: [] for t in range(len(picks))}
    alive = list(areas)
    for stage in stages:
        wanted = [(t, f) for t in alive for f in stage]
        for t, _, area in _areas(table, bins, trials, wanted, n if rows is None else min(n, rows), seed):
            areas[t].append(area)
        means = {t: _mean(areas[t]) for t in alive}
        if margin is not None:
            alive = [t for t in alive if means[t] >= max(means.values()) - margin]
    best = max(alive, key=lambda t: (means[t], -t))
    out = [(kind, str(p), _mean(areas[t]), len(areas[t]), t == best) for t, p in enumerate(picks)]
    report = train.sparkSession.createDataFrame(
        out, "kind string, settings string, roc_auc double, folds int, best boolean"
    ).withColumn("roc_auc", half_even(F.col("roc_auc"), 4))
    model = TreeClassifier(kind, features, label, key, seed, **picks[best]).fit(train, bins)
    return model, picks[best], report


def _areas(table: DataFrame, bins: trees.Bins, trials: Sequence[Trial], wanted, n: int, seed: int) -> list[tuple]:
    """(trial, fold, area) of the wanted fits over a table of ``n`` rows, in their order."""
    if n > trees.TASK_ROWS:
        return [(t, f, trees.fold_area(table, bins, trials[t], t, f, seed, _area)) for t, f in sorted(wanted)]
    at_once, found = max(1, SEARCH_WORK // max(n, 1)), []
    for first in range(0, len(wanted), at_once):
        some = trees.fold_scores(table, len(bins.features), trials, wanted[first : first + at_once], seed)
        found.extend(tuple(r) for r in some.collect())
    return sorted(found)


def _area(scored: DataFrame) -> float:
    row = evaluation.roc_auc(scored, "score", "target", digits=12).first()
    return math.nan if row is None or row["roc_auc"] is None else float(row["roc_auc"])


def _mean(areas: Sequence[float]) -> float:
    """Folds with one class only have no area and do not count."""
    known = [a for a in areas if a == a]
    return sum(known) / len(known) if known else 0.0


def score_batch(model, rows: DataFrame, keep: Sequence[str], out: str = "estimate") -> DataFrame:
    """Predictions for new rows, 2 decimals."""
    return model.transform(rows).select(*keep, half_even(F.col("prediction"), 2).alias(out))
