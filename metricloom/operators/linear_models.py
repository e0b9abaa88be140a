"""Least squares and logistic regression with inference."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, functions as F

from metricloom.functions.distributions import normal_upper_tail
from metricloom.functions.scalars import half_even
from metricloom.operators.cleaning import drop_incomplete
from metricloom.operators.correlation import pearson_matrix
from metricloom.operators.profile import union_all
from metricloom.session import written_once


def assemble(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(cols), outputCol=out).transform(df)


def design(df: DataFrame, y: str, xs: Sequence[str], extra: Sequence[str] = ()) -> DataFrame:
    """Complete rows only, as label and feature vector."""
    rows = drop_incomplete(df, [y, *xs]).select(
        *extra, F.col(y).cast("double").alias("label"), *[F.col(x).cast("double").alias(x) for x in xs]
    )
    return assemble(rows, xs).select(*extra, "label", "features")


def fit_ols(df: DataFrame, y: str, xs: Sequence[str]):
    """Normal equations: one pass that sums a (p+1) x (p+1) matrix."""
    return LinearRegression(solver="normal", standardization=False).fit(design(df, y, xs))


def _coefficient_rows(spark, names, columns: dict[str, list[float]]) -> DataFrame:
    rows = [
        (name, *[float(values[i]) for values in columns.values()]) for i, name in enumerate(names)
    ]
    schema = "term string, " + ", ".join(f"{c} double" for c in columns)
    return spark.createDataFrame(rows, schema)


def ols_summary(df: DataFrame, y: str, xs: Sequence[str]) -> DataFrame:
    """Coefficient, standard error, t and p per term."""
    model = fit_ols(df, y, xs)
    s = model.summary
    return _coefficient_rows(
        df.sparkSession,
        [*xs, "const"],
        {
            "coefficient": [*model.coefficients.toArray(), model.intercept],
            "std_error": s.coefficientStandardErrors,
            "t": s.tValues,
            "p": s.pValues,
        },
    )


def ols_fit_quality(df: DataFrame, y: str, xs: Sequence[str], name: str = "model", digits: int = 4) -> DataFrame:
    """R squared, adjusted R squared, RMSE (divided by n) and MAE."""
    s = fit_ols(df, y, xs).summary
    row = (
        name, int(s.numInstances), float(s.r2), float(s.r2adj),
        float(s.rootMeanSquaredError), float(s.meanAbsoluteError),
    )
    table = df.sparkSession.createDataFrame(
        [row], "model string, n long, r2 double, r2_adj double, rmse double, mae double"
    )
    return table.select(
        "model", "n", *[half_even(F.col(c), digits).alias(c) for c in ("r2", "r2_adj", "rmse", "mae")]
    )


def nested_models(df: DataFrame, y: str, base: Sequence[str], added: Sequence[str]) -> DataFrame:
    """Fit without and with the added predictors, both on the rows complete for all of them."""
    df = drop_incomplete(df, [y, *base, *added])
    return union_all(
        [
            ols_fit_quality(df, y, base, "base").select("model", "n", "r2", "r2_adj"),
            ols_fit_quality(df, y, [*base, *added], "extended").select("model", "n", "r2", "r2_adj"),
        ]
    )


def _inflation(r: np.ndarray) -> list[float]:
    """Diagonal of the inverse, infinite for the rows that depend on others."""
    if not np.isfinite(r).all():
        return [float("nan")] * len(r)
    if np.linalg.matrix_rank(r) == len(r):
        return [float(v) for v in np.diag(np.linalg.inv(r))]
    values = []
    for i in range(len(r)):
        others = np.delete(np.arange(len(r)), i)
        fit, *_ = np.linalg.lstsq(r[np.ix_(others, others)], r[others, i], rcond=None)
        left = 1.0 - float(r[others, i] @ fit)
        values.append(1.0 / left if left > 1e-10 else float("inf"))
    return values


def vif(df: DataFrame, xs: Sequence[str], constant: bool = False) -> DataFrame:
    """Variance inflation: the diagonal of the inverse correlation matrix.

    Only the matrix of the predictors reaches the driver. With ``constant`` the intercept
    is listed too: n / SSR of the constant regressed on the predictors. A predictor that
    the others determine has infinite inflation.
    """
    rows = drop_incomplete(df, xs)
    matrix = pearson_matrix(rows, xs, "listwise", digits=None).collect()
    place = {x: i for i, x in enumerate(xs)}
    r = np.eye(len(xs))
    for cell in matrix:
        value = cell["r"]
        r[place[cell["x"]], place[cell["y"]]] = np.nan if value is None else value
    values = _inflation(r)
    names = list(xs)
    if constant:
        moments = rows.agg(
            F.struct(*[F.avg(x).alias(x) for x in xs]).alias("mean"),
            F.struct(*[F.stddev_pop(x).alias(x) for x in xs]).alias("std"),
        ).first()
        z = np.array([moments["mean"][x] / moments["std"][x] for x in xs])
        names.append("const")
        regular = np.isfinite(r).all() and np.linalg.matrix_rank(r) == len(xs)
        values.append(1.0 + float(z @ np.linalg.solve(r, z)) if regular else float("inf"))
    return df.sparkSession.createDataFrame(list(zip(names, values)), "variable string, vif double")


def residuals(df: DataFrame, y: str, xs: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Fitted value and residual per complete row."""
    model = fit_ols(df, y, xs)
    return model.transform(design(df, y, xs, keep)).select(
        *keep, F.col("label").alias("actual"), F.col("prediction").alias("fitted"),
        (F.col("label") - F.col("prediction")).alias("residual"),
    )


#: A fit ends when a step would raise the log-likelihood by less than half of this.
LEAST_RISE = 1e-14
#: Information below this share of the empty model's, in some direction: no finite maximum there.
SINGULAR = 1e-10
LOGIT_STEPS = 50


@dataclass(frozen=True)
class LogitFit:
    """Estimates per term, the constant last; NaN unless ``state`` is "converged" or "not converged"."""

    terms: list[str]
    coefficients: np.ndarray
    errors: np.ndarray
    log_likelihood: float
    n: int
    steps: int
    state: str


def _newton_sums(rows: DataFrame, beta: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Log-likelihood, score and information at ``beta``, from one aggregate over all rows."""
    x = [*[F.col(f"x{i}") for i in range(len(beta) - 1)], F.lit(1.0)]
    eta = reduce(lambda total, pair: total + F.lit(float(pair[0])) * pair[1], zip(beta, x), F.lit(0.0))
    p, y = F.col("p"), F.col("y")
    scored = rows.withColumn("eta", eta).withColumn("p", F.lit(1.0) / (F.exp(-F.col("eta")) + 1.0))
    cells = [(i, j) for i in range(len(x)) for j in range(i, len(x))]
    softplus = F.greatest("eta", F.lit(0.0)) + F.log1p(F.exp(-F.abs("eta")))
    sums = scored.agg(
        F.sum(y * F.col("eta") - softplus),
        *[F.sum(v * (y - p)) for v in x],
        *[F.sum(x[i] * x[j] * p * (F.lit(1.0) - p)) for i, j in cells],
    ).first()
    information = np.empty((len(x), len(x)))
    for (i, j), value in zip(cells, sums[1 + len(x) :]):
        information[i, j] = information[j, i] = value
    return float(sums[0]), np.array(sums[1 : 1 + len(x)]), information


def fit_logit(df: DataFrame, y: str, xs: Sequence[str]) -> LogitFit:
    """Unpenalised maximum likelihood by Newton's method on the complete rows.

    Each step is one aggregate of (p+1)(p+2)/2 + p + 2 sums; only these reach the driver. Predictors are
    standardised for the steps and the estimates turned back; a step that lowers the
    likelihood is halved. ``state`` tells how it ended: "converged", "not converged", "no
    rows", "one class" (labels all alike), "collinear" (predictors that determine each
    other, a constant one included) or "separated" (the likelihood rises without end along
    some direction). Labels are shares from 0 to 1, others are refused.
    """
    rows = drop_incomplete(df, [y, *xs]).select(
        F.col(y).cast("double").alias("y"), *[F.col(x).cast("double").alias(f"x{i}") for i, x in enumerate(xs)]
    )
    rows = written_once(rows, "logit")
    places = range(len(xs))
    n, share, low, high, *moments = rows.agg(
        F.count(F.lit(1)), F.avg("y"), F.min("y"), F.max("y"),
        *[F.avg(f"x{i}") for i in places], *[F.stddev_pop(f"x{i}") for i in places],
    ).first()
    terms, none = [*xs, "const"], np.full(len(xs) + 1, np.nan)
    if n == 0 or low == high and low in (0.0, 1.0):
        return LogitFit(terms, none, none, 0.0, n, 0, "one class" if n else "no rows")
    if low < 0 or high > 1:
        raise ValueError(f"labels must lie between 0 and 1, found {low} to {high}")
    mean, std = np.array(moments[: len(xs)]), np.array(moments[len(xs) :])
    if (std <= 1e-14 * np.abs(mean)).any():
        return LogitFit(terms, none, none, 0.0, n, 0, "collinear")
    scaled = rows.select(
        "y", *[((F.col(f"x{i}") - float(mean[i])) / float(std[i])).alias(f"x{i}") for i in places]
    )
    beta, floor = np.zeros(len(terms)), SINGULAR * share * (1.0 - share) * n
    beta[-1] = math.log(share / (1.0 - share))
    before, state = None, "not converged"
    for step in range(1, LOGIT_STEPS + 1):
        value, score, information = _newton_sums(scaled, beta)
        if before is not None and value < before[0] - 1e-9 * abs(before[0]):
            beta = (beta + before[1]) / 2
            continue
        if np.linalg.eigvalsh(information)[0] < floor:
            state = "collinear" if before is None else "separated"
            return LogitFit(terms, none, none, value, n, step, state)
        before = value, beta
        move = np.linalg.solve(information, score)
        beta = beta + move
        if score @ move <= LEAST_RISE:
            state = "converged"
            break
    back = np.diag([*(1.0 / std), 1.0])
    back[-1, :-1] = -mean / std
    errors = np.sqrt(np.diag(back @ np.linalg.inv(information) @ back.T))
    return LogitFit(terms, back @ beta, errors, value, n, step, state)


def logit_summary(df: DataFrame, y: str, xs: Sequence[str]) -> DataFrame:
    """Coefficient, standard error, z and p per term, and how the fit ended (see ``fit_logit``)."""
    fit = fit_logit(df, y, xs)
    rows = []
    for term, b, error in zip(fit.terms, fit.coefficients, fit.errors):
        known = bool(np.isfinite(b))
        z = float(b / error) if known else None
        p = 2.0 * normal_upper_tail(abs(z)) if known else None
        rows.append((term, float(b) if known else None, float(error) if known else None, z, p, fit.state))
    return df.sparkSession.createDataFrame(
        rows, "term string, coefficient double, std_error double, z double, p double, state string"
    )


def odds_ratios(df: DataFrame, y: str, xs: Sequence[str]) -> DataFrame:
    """Coefficient, its exponential and p, 4 decimals; missing where the fit has none."""
    return logit_summary(df, y, xs).select(
        "term",
        half_even(F.col("coefficient"), 4).alias("coefficient"),
        half_even(F.exp("coefficient"), 4).alias("odds_ratio"),
        half_even(F.col("p"), 4).alias("p"),
    )
