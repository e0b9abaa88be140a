"""Correlation matrices, notable pairs and pair summaries."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations, combinations_with_replacement

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from metricloom.functions.distributions import t_two_sided
from metricloom.functions.scalars import half_even, safe_ratio
from metricloom.operators.ordered import ROWS_PER_TASK, running_before
from metricloom.operators.profile import union_all, value_counts
from metricloom.session import written_once


_NOISE = 1e-12


def pearson(x: Column, y: Column) -> Column:
    """Correlation over the rows where both are present; missing for a constant column.

    Written with moments because the built-in one fails on a constant column.
    """
    both = x.isNotNull() & y.isNotNull()
    spread = F.stddev_pop(F.when(both, x)) * F.stddev_pop(F.when(both, y))
    return F.try_divide(F.covar_pop(x, y), F.nullif(spread, F.lit(0.0)))


def _matrix(data: DataFrame, cols: Sequence[str], digits: int | None) -> DataFrame:
    """Pairwise-complete correlations from two scans.

    The first finds the centres. The second sums powers and products of the centred
    values, which keeps the sums accurate, and equal sums are computed once: for columns
    without missing values that is one per column and one per pair.
    """
    first = data.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count(c).alias(f"n_{i}") for i, c in enumerate(cols)],
        *[F.avg(c).alias(f"m_{i}") for i, c in enumerate(cols)],
    ).first()
    centred = {c: F.col(c) - F.lit(first[f"m_{i}"] or 0.0) for i, c in enumerate(cols)}
    whole = {c for i, c in enumerate(cols) if first[f"n_{i}"] == first["n"]}

    def where_present(value: Column, other: str) -> Column:
        return value if other in whole else F.when(F.col(other).isNotNull(), value)

    sums = []
    for a, b in combinations_with_replacement(cols, 2):
        x, y = where_present(centred[a], b), where_present(centred[b], a)
        sums.append(
            F.struct(
                F.lit(a).alias("a"), F.lit(b).alias("b"),
                F.count(x if a not in whole else y).cast("double").alias("n"),
                F.sum(x).alias("sx"), F.sum(y).alias("sy"),
                F.sum(x * x).alias("sxx"), F.sum(y * y).alias("syy"), F.sum(x * y).alias("sxy"),
            )
        )
    moments = data.agg(F.array(*sums).alias("m")).select(F.inline("m"))
    n = F.nullif(F.col("n"), F.lit(0.0))
    vx = F.col("sxx") - F.col("sx") * F.col("sx") / n
    vy = F.col("syy") - F.col("sy") * F.col("sy") / n
    vxy = F.col("sxy") - F.col("sx") * F.col("sy") / n
    # What is left of a constant column is rounding noise of its squares.
    varied = (vx > F.col("sxx") * _NOISE) & (vy > F.col("syy") * _NOISE)
    r = F.when(varied, F.try_divide(vxy, F.sqrt(vx) * F.sqrt(vy)))
    bounded = F.when(r.isNotNull(), F.greatest(F.least(r, F.lit(1.0)), F.lit(-1.0)))
    cell = bounded if digits is None else half_even(bounded, digits)
    one = F.struct(F.col("a").alias("x"), F.col("b").alias("y"))
    other = F.struct(F.col("b").alias("x"), F.col("a").alias("y"))
    both = F.when(F.col("a") == F.col("b"), F.array(one)).otherwise(F.array(one, other))
    return moments.select(F.explode(both).alias("p"), cell.alias("r")).select("p.x", "p.y", "r")


def _doubles(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(c).cast("double").alias(c) for c in cols])


def pearson_matrix(
    df: DataFrame, cols: Sequence[str], complete: str = "pairwise", digits: int | None = 3
) -> DataFrame:
    """``pairwise`` uses for each pair the rows where both are present, ``listwise`` only
    rows where all are."""
    data = _doubles(df, cols)
    return _matrix(data.dropna() if complete == "listwise" else data, cols, digits)


def average_ranks(
    df: DataFrame, cols: Sequence[str], suffix: str = "__rank", rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Add the average rank of each column, computed from its distinct values.

    One table of (column, value, count) is ordered for all columns together, in blocks of
    rows; the ranks come back by an equi-join per column, which turns into a broadcast at
    run time when the column has few distinct values, and is split by the skew-join rule
    when one value is very frequent.
    """
    counts = written_once(value_counts(df, cols), "counts")
    ranked = running_before(
        counts, ["variable"], "value", {"__start": F.col("n")},
        unique_order=True, at_most=counts.count(), rows_per_task=rows_per_task,
    )
    rank = F.col("__start") + (F.col("n") + 1) / F.lit(2.0)
    ranks = written_once(ranked.select("variable", "value", rank.alias("rank")), "ranks")
    for c in cols:
        own = ranks.where(F.col("variable") == c).select(
            F.col("value").alias("__value"), F.col("rank").alias(f"{c}{suffix}")
        )
        df = df.join(own, F.col(c).cast("double") == F.col("__value"), "left").drop("__value")
    return df


def _spearman_listwise(data: DataFrame, cols, digits, rows_per_task) -> DataFrame:
    ranked = average_ranks(data.dropna(subset=list(cols)).select(*cols), cols, "__rank", rows_per_task)
    return _matrix(ranked.select(*[F.col(f"{c}__rank").alias(c) for c in cols]), cols, digits)


def spearman_matrix(
    df: DataFrame,
    cols: Sequence[str],
    complete: str = "listwise",
    digits: int | None = 3,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Pearson correlation of average ranks.

    ``pairwise`` ranks anew for every pair that involves missing values; columns without
    any share one set of ranks.
    """
    data = _doubles(df, cols)
    if complete == "listwise":
        return _spearman_listwise(data, cols, digits, rows_per_task)
    holes = data.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols]).first()
    whole = [c for c in cols if holes[c] == 0]
    parts = [_spearman_listwise(data, whole, digits, rows_per_task)] if whole else []
    for a, b in combinations(cols, 2):
        if a not in whole or b not in whole:
            pair = _spearman_listwise(data, [a, b], digits, rows_per_task)
            parts.append(pair.where("x <> y"))
    partial = [c for c in cols if c not in whole]
    if partial:
        parts.append(_matrix(data, partial, digits).where("x = y"))
    return union_all(parts)


def notable_pairs(
    df: DataFrame, cols: Sequence[str], order: str = "name", complete: str = "pairwise"
) -> DataFrame:
    """Pairs whose rounded |r| reaches 0.7 (strong) or 0.4 (moderate).

    The pair is written in name order, or in the order of ``cols`` with ``order="column"``.
    """
    matrix = pearson_matrix(df, cols, complete)
    rank = {c: i for i, c in enumerate(cols)}
    if order == "name":
        one_side = F.col("x") < F.col("y")
    else:
        place = F.create_map(*[F.lit(v) for c in cols for v in (c, rank[c])])
        one_side = place[F.col("x")] < place[F.col("y")]
    size = F.abs("r")
    return matrix.where(one_side & (size >= 0.4)).select(
        "x", "y", "r", F.when(size >= 0.7, "strong").otherwise("moderate").alias("strength")
    )


@F.pandas_udf(T.DoubleType())
def _t_p(t: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series([t_two_sided(a, b) for a, b in zip(t.astype(object), df.astype(object))])


def correlation_p(r: Column, n: Column) -> Column:
    """Two-sided p of a correlation, for aggregated rows (one per pair)."""
    free = (n - 2).cast("double")
    t = r * F.sqrt(free / F.nullif(F.lit(1.0) - r * r, F.lit(0.0)))
    return F.when(n > 2, F.coalesce(_t_p(t, free), F.lit(0.0)))


def stars_by_p(p: Column) -> Column:
    return F.when(p < 0.001, "***").when(p < 0.01, "**").when(p < 0.05, "*").otherwise("")


def stars_by_size(r: Column) -> Column:
    size = F.abs(r)
    return F.when(size >= 0.8, "***").when(size >= 0.5, "**").when(size >= 0.3, "*").otherwise("")


def _pair_moments(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    entries = []
    for a, b in pairs:
        x, y = F.col(a).cast("double"), F.col(b).cast("double")
        both = x.isNotNull() & y.isNotNull()
        sxx = F.regr_sxx(y, x)
        slope = F.try_divide(F.regr_sxy(y, x), F.nullif(sxx, F.lit(0.0)))
        x_mean, y_mean = F.avg(F.when(both, x)), F.avg(F.when(both, y))
        entries.append(
            F.struct(
                F.lit(a).alias("x"), F.lit(b).alias("y"),
                F.count_if(both).alias("n"),
                pearson(x, y).alias("r"),
                slope.alias("slope"),
                (y_mean - slope * x_mean).alias("intercept"),
                sxx.alias("sxx"), F.regr_syy(y, x).alias("syy"),
                x_mean.alias("x_mean"),
            )
        )
    return df.agg(F.array(*entries).alias("m")).select(F.inline("m"))


def pair_lines(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Correlation, size stars, least-squares line and the standard error of its mean."""
    m = _pair_moments(df, pairs)
    residual = F.greatest(F.col("syy") * (F.lit(1.0) - F.col("r") * F.col("r")), F.lit(0.0))
    se = F.sqrt(safe_ratio(residual, F.nullif(F.col("n") - 2, F.lit(0))))
    return m.select(
        "x", "y", "n",
        half_even(F.col("r"), 3).alias("r"),
        stars_by_size(F.col("r")).alias("stars_by_size"),
        half_even(F.col("slope"), 6).alias("slope"),
        half_even(F.col("intercept"), 4).alias("intercept"),
        half_even(se, 4).alias("residual_se"),
        half_even(F.col("x_mean"), 4).alias("x_mean"),
    )


def pair_summary(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Pearson r with p and stars, Spearman rho and the fitted line for chosen pairs."""
    m = _pair_moments(df, pairs)
    rhos = union_all(
        [
            _spearman_listwise(_doubles(df, [a, b]), [a, b], 3, ROWS_PER_TASK)
            .where((F.col("x") == a) & (F.col("y") == b))
            .withColumnRenamed("r", "rho")
            for a, b in pairs
        ]
    )
    p = correlation_p(F.col("r"), F.col("n"))
    return (
        m.withColumn("p", p)
        .join(rhos, ["x", "y"])
        .select(
            "x", "y", "n",
            half_even(F.col("r"), 3).alias("r"),
            F.col("p"),
            stars_by_p(F.col("p")).alias("stars"),
            stars_by_size(F.col("r")).alias("stars_by_size"),
            "rho",
            half_even(F.col("slope"), 6).alias("slope"),
            half_even(F.col("intercept"), 4).alias("intercept"),
        )
    )
