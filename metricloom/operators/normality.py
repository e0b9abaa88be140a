"""Normality tests, quantile-quantile data and the effect of a log transform."""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from metricloom.functions.distributions import (
    ks_two_sided,
    lilliefors_p,
    normal_cdf,
    normal_ppf,
    with_shapiro,
)
from metricloom.functions.scalars import half_even
from metricloom.operators.ordered import ROWS_PER_TASK, running_before
from metricloom.operators.profile import summarize_columns, value_counts

_CHUNK = 100_000
_ALPHA = 0.05
#: Ranks at either end, and copies of a value, whose normal scores are added up one by one.
_EDGE, _COPIES = 1_024, 16


def _ranked_counts(df: DataFrame, cols: Sequence[str], rows_per_task: int) -> DataFrame:
    """(variable, value, n, start, size, mean, spread) of each distinct value."""
    stats = summarize_columns(
        df, cols,
        {
            "size": F.count, "mean": F.avg,
            "spread": lambda c: F.var_pop(c) * F.count(c),
        },
    )
    return running_before(
        value_counts(df, cols), ["variable"], "value", {"start": F.col("n")},
        unique_order=True, at_most=df.count(), rows_per_task=rows_per_task,
    ).join(stats, "variable")


def shapiro_wilk(
    df: DataFrame, cols: Sequence[str], log: bool = False, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """W and p per column, on all present values.

    The weights are closed in rank and number of values, so W needs sums over ranks only:
    a tie is one stretch of ranks from its (value, count) pair, and the sum over a long
    stretch is closed too. Nothing is sorted globally, gathered or laid out row by row.
    ``p_valid`` says whether the number of values is in the range that the p-value was
    fitted for (3 to 5,000); W itself has no such range.
    """
    data = df
    if log:
        data = df.withColumns({c: F.log1p(F.col(c).cast("double")) for c in cols})
    ranked = _ranked_counts(data, cols, rows_per_task)
    points = _score_sums(_stretches(ranked)).withColumn("centred", F.col("value") - F.col("mean"))
    n, i = F.col("size"), F.col("until")
    ends = {"x1": i == 1, "x2": i == 2, "y2": i == n - 1, "y1": i == n}
    sums = points.groupBy("variable").agg(
        F.any_value("size").alias("n"), F.any_value("spread").alias("spread"),
        F.sum("squares").alias("square"), F.sum(F.col("scores") * F.col("centred")).alias("product"),
        *[F.max(F.when(test, F.col("centred"))).alias(name) for name, test in ends.items()],
    )
    names = df.sparkSession.createDataFrame([(c,) for c in cols], "variable string")
    out = names.join(with_shapiro(sums), "variable", "left")
    return out.select(
        "variable", F.coalesce("n", F.lit(0)).alias("n"), "w", "p",
        F.coalesce(F.col("n").between(3, 5_000), F.lit(False)).alias("p_valid"),
    )


def _stretches(ranked: DataFrame) -> DataFrame:
    """Each value's ranks as stretches ``since < rank <= until``.

    Single ranks, but for the copies of a frequent value that lie ``_EDGE`` ranks or more
    from both ends: those are one stretch.
    """
    start, last = F.col("start"), F.col("start") + F.col("n")
    edge = F.lit(_EDGE).cast("long")
    high = F.greatest(F.col("size") - edge, edge)

    def singles(since, until):
        ranks = F.when(since < until, F.sequence(since + 1, until)).otherwise(F.array().cast("array<bigint>"))
        return F.transform(ranks, lambda i: F.struct((i - 1).alias("since"), i.alias("until")))

    low_end, high_end = F.greatest(start, edge), F.least(last, high)
    middle = F.when(low_end < high_end, F.array(F.struct(low_end.alias("since"), high_end.alias("until")))).otherwise(
        F.array().cast("array<struct<since:bigint,until:bigint>>")
    )
    parts = F.when(F.col("n") <= _COPIES, singles(start, last)).otherwise(
        F.concat(singles(start, F.least(last, edge)), middle, singles(F.greatest(start, high), last))
    )
    return ranked.withColumn("__part", F.explode(parts)).select(
        *ranked.columns, "__part.since", "__part.until"
    )


def _score_sums(stretches: DataFrame) -> DataFrame:
    """``scores`` and ``squares``: sums of the normal scores of a stretch, and of their squares.

    A longer stretch is summed by the Euler-Maclaurin formula at midpoints: the integral
    between its borders, which is closed, less 1/24 of the first derivative and plus 7/5760
    of the third one. What is left out falls with the fifth power of the distance from the
    ends: below 1e-18 from ``_EDGE`` ranks on.
    """
    step = F.lit(1.0) / (F.col("size") + 0.25)

    one, h = F.col("__one"), F.col("__h")
    borders = stretches.withColumns({"__h": step, "__one": F.col("until") - F.col("since") == 1}).withColumns(
        {
            "__pa": F.when(one, (F.col("until") - 0.375) * h).otherwise((F.col("since") + 0.125) * h),
            "__pb": F.when(~one, (F.col("until") + 0.125) * h),
        }
    )
    placed = borders.withColumns({"__za": normal_ppf(F.col("__pa")), "__zb": normal_ppf(F.col("__pb"))})

    def slope(z):  # first derivative of a score by its rank
        return h * math.sqrt(2 * math.pi) * F.exp(z * z / 2)

    za, zb, ga, gb = (F.col(c) for c in ("__za", "__zb", "__ga", "__gb"))
    sloped = placed.withColumns({"__ga": slope(za), "__gb": slope(zb)})

    def scores(z, g):  # sum of the scores up to a border
        return F.lit(-1.0) / g - g / 24 + F.lit(7 / 5760) * (1 + 2 * z * z) * g * g * g

    def squares(z, g, at):
        return at / h - z / g - z * g / 12 + F.lit(7 / 5760) * (8 * z + 4 * z * z * z) * g * g * g

    return sloped.select(
        *stretches.columns,
        F.when(one, za).otherwise(scores(zb, gb) - scores(za, ga)).alias("scores"),
        F.when(one, za * za).otherwise(squares(zb, gb, F.col("__pb")) - squares(za, ga, F.col("__pa"))).alias("squares"),
    )


def ks_statistic(df: DataFrame, cols: Sequence[str], rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """D of the standardised column against N(0, 1), from distinct values and counts."""
    stats = F.broadcast(
        summarize_columns(
            df, cols, {"mean": F.avg, "std": F.stddev_samp, "size": F.count}
        )
    )
    ranked = running_before(
        value_counts(df, cols), ["variable"], "value", {"start": F.col("n")},
        unique_order=True, at_most=df.count(), rows_per_task=rows_per_task,
    ).join(stats, "variable")
    z = F.when(
        F.col("std") > 0, (F.col("value") - F.col("mean")) / F.nullif(F.col("std"), F.lit(0.0))
    ).otherwise(F.col("value"))
    phi = normal_cdf(z)
    above = (F.col("start") + F.col("n")) / F.col("size") - phi
    below = phi - F.col("start") / F.col("size")
    return ranked.groupBy("variable").agg(
        F.any_value("size").alias("n"), F.max(F.greatest(above, below)).alias("d")
    )


@F.pandas_udf(T.DoubleType())
def _ks_p(d: pd.Series, n: pd.Series) -> pd.Series:
    return pd.Series([ks_two_sided(float(a), int(b)) for a, b in zip(d, n)])


def ks_normal(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """D with the p-value that treats mean and deviation as known."""
    return ks_statistic(df, cols).withColumn("p", _ks_p("d", "n"))


def lilliefors(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """D with the p-value that allows for estimated mean and deviation."""
    return ks_statistic(df, cols).withColumn("p", lilliefors_p(F.col("d"), F.col("n")))


def normality_table(df: DataFrame, cols: Sequence[str], corrected: bool = False) -> DataFrame:
    """Both tests side by side; normal only if both p exceed 0.05."""
    sw = shapiro_wilk(df, cols).select("variable", "w", F.col("p").alias("sw_p"))
    ks = (lilliefors if corrected else ks_normal)(df, cols)
    ks = ks.select("variable", "d", F.col("p").alias("ks_p"))
    return sw.join(ks, "variable").select(
        "variable",
        half_even(F.col("w"), 4).alias("w"), "sw_p",
        half_even(F.col("d"), 4).alias("d"), "ks_p",
        ((F.col("sw_p") > _ALPHA) & (F.col("ks_p") > _ALPHA)).alias("normal"),
    )


def log1p_effect(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Does log(1 + x) raise the Shapiro-Wilk p-value?"""
    before = shapiro_wilk(df, cols).select("variable", F.col("p").alias("p_before"))
    after = shapiro_wilk(df, cols, log=True).select("variable", F.col("p").alias("p_after"))
    return before.join(after, "variable").withColumn("improved", F.col("p_after") > F.col("p_before"))


def qq_points(
    df: DataFrame,
    cols: Sequence[str],
    plotting: str = "filliben",
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Ordered values with their normal quantiles, one point per row of data.

    ``filliben``: medians of uniform order statistics; ``hazen``: (i - 0.5)/n. Tied values
    are numbered from their (value, count) pair, so the rows are never sorted globally.
    """
    sized = F.broadcast(summarize_columns(df, cols, {"size": F.count}))
    ranked = running_before(
        value_counts(df, cols), ["variable"], "value", {"start": F.col("n")},
        unique_order=True, at_most=df.count(), rows_per_task=rows_per_task,
    ).join(sized, "variable")
    one_each = _number_ties(ranked)
    p = plotting_position(F.col("i"), F.col("size"), plotting)
    return one_each.select("variable", "i", "value", p.alias("p")).withColumn(
        "theoretical", normal_ppf(F.col("p"))
    )


def _number_ties(ranked: DataFrame) -> DataFrame:
    """One row per data row. A very frequent value is first cut into ranges of positions
    that are spread over the tasks, so no task writes out all its copies."""
    last = F.col("start") + F.col("n")
    columns = ["variable", "value", "size"]
    rare = ranked.where(F.col("n") <= _CHUNK).select(
        *columns, F.explode(F.sequence(F.col("start") + 1, last)).alias("i")
    )
    ranges = (
        ranked.where(F.col("n") > _CHUNK)
        .select(
            *columns, last.alias("last"),
            F.explode(F.sequence(F.col("start") + 1, last, F.lit(_CHUNK))).alias("first"),
        )
        .repartition("variable", "first")
    )
    until = F.least(F.col("last"), F.col("first") + (_CHUNK - 1))
    frequent = ranges.select(*columns, F.explode(F.sequence(F.col("first"), until)).alias("i"))
    return rare.unionByName(frequent)


def plotting_position(i: Column, n: Column, kind: str) -> Column:
    if kind == "hazen":
        return (i - 0.5) / n
    edge = F.pow(F.lit(0.5), F.lit(1.0) / n)
    return F.when(i == n, edge).when(i == 1, F.lit(1.0) - edge).otherwise((i - 0.3175) / (n + 0.365))


def qq_line(points: DataFrame) -> DataFrame:
    """Least-squares line through the points and its r squared."""
    x, y = "theoretical", "value"
    sxx, syy, sxy = F.regr_sxx(y, x), F.regr_syy(y, x), F.regr_sxy(y, x)
    slope = F.try_divide(sxy, F.nullif(sxx, F.lit(0.0)))
    return points.groupBy("variable").agg(
        F.count(F.lit(1)).alias("n"),
        slope.alias("slope"),
        (F.avg(y) - slope * F.avg(x)).alias("intercept"),
        F.try_divide(sxy * sxy, F.nullif(sxx * syy, F.lit(0.0))).alias("r2"),
    )
