"""Row-wise derived features and scaling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from metricloom.functions.scalars import floor_at

# Heavy-tailed columns that get a log form.
LOG_COLUMNS = ["LA", "LD", "LT", "NF", "NS", "ND", "NUC", "EXP", "NDEV", "SEXP", "AGE", "REXP"]
DERIVED_COLUMNS = ["churn", "LA_ratio", "LD_ratio"]
# Model inputs.
MODEL_FEATURES = [
    "NS_log", "ND_log", "NF_log", "Entropy",
    "LA_log", "LD_log", "LT_log", "FIX",
    "NDEV_log", "AGE_log", "NUC_log",
    "EXP_log", "REXP_log", "SEXP_log",
    "LA_ratio_log", "LD_ratio_log",
]


def _or_default(df: DataFrame, name: str, bound: float) -> Column:
    """The column clipped from below, or the bound itself when the column was dropped."""
    return floor_at(F.col(name), bound) if name in df.columns else F.lit(float(bound))


def churn(df: DataFrame, added: str = "LA", deleted: str = "LD") -> DataFrame:
    """Lines added plus lines deleted."""
    return df.withColumn("churn", _or_default(df, added, 0) + _or_default(df, deleted, 0))


def size_ratios(df: DataFrame, added: str = "LA", deleted: str = "LD", size: str = "LT") -> DataFrame:
    """Lines added and deleted relative to the size of the touched files (at least 1)."""
    base = _or_default(df, size, 1)
    return df.withColumns(
        {
            f"{added}_ratio": _or_default(df, added, 0) / base,
            f"{deleted}_ratio": _or_default(df, deleted, 0) / base,
        }
    )


def log1p_bank(df: DataFrame, cols: Sequence[str] = (*LOG_COLUMNS, *DERIVED_COLUMNS)) -> DataFrame:
    """``<c>_log`` = log(1 + max(c, 0)) for each listed column that exists."""
    return df.withColumns(
        {f"{c}_log": F.log1p(floor_at(F.col(c), 0)) for c in cols if c in df.columns}
    )


def _moments(df: DataFrame, cols: Sequence[str], spread) -> Column:
    """Mean and deviation of every column as one scalar subquery."""
    packed = [
        F.struct(F.avg(c).alias("mean"), spread(c).alias("std")).alias(c) for c in cols
    ]
    return df.agg(F.struct(*packed).alias("m")).scalar()


def zscore(df: DataFrame, cols: Sequence[str], suffix: str = "_z") -> DataFrame:
    """(x - mean) / sample deviation; a column without spread stays as it is."""
    stats = _moments(df, cols, F.stddev_samp)

    def score(c: str) -> Column:
        mean, std = stats[c]["mean"], stats[c]["std"]
        return F.when(std > 0, (F.col(c) - mean) / F.nullif(std, F.lit(0.0))).otherwise(F.col(c))

    return df.withColumns({f"{c}{suffix}": score(c) for c in cols})


def standardize(
    train: DataFrame, target: DataFrame, cols: Sequence[str], suffix: str = "_std"
) -> DataFrame:
    """Population z-scores with moments learned on ``train`` only, applied to ``target``."""
    stats = _moments(train, cols, F.stddev_pop)

    def score(c: str) -> Column:
        scale = F.coalesce(F.nullif(stats[c]["std"], F.lit(0.0)), F.lit(1.0))
        return (F.col(c) - stats[c]["mean"]) / scale

    return target.withColumns({f"{c}{suffix}": score(c) for c in cols})
