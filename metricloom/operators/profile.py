"""Column profiles: centre, spread, quantiles, fences, histograms, densities, balance."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from metricloom.functions.scalars import half_even, safe_ratio
from metricloom.operators.ordered import ROWS_PER_TASK, running_before
from metricloom.session import written_once

#: Ranks around a quantile, as a share, whose values are told apart; wider if that proves too narrow.
_BRACKET = 2e-3
_WIDER = 8
_ACCURACY = 2_000


# --- shapes -----------------------------------------------------------------------------


def long_values(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Wide to long: one row per (variable, value), missing values included."""
    wide = df.select(*keep, *[F.col(c).cast("double").alias(c) for c in cols])
    return wide.unpivot(list(keep), list(cols), "variable", "value")


def summarize_columns(
    df: DataFrame, cols: Sequence[str], stats: Mapping[str, Callable[[Column], Column]]
) -> DataFrame:
    """Any one-column statistics over all columns in a single scan.

    The aggregate produces one row, which is then laid out as one row per variable,
    so the data itself is never unpivoted.
    """
    packed = [
        F.struct(
            F.lit(c).alias("variable"),
            *[fn(F.col(c).cast("double")).alias(name) for name, fn in stats.items()],
        )
        for c in cols
    ]
    return df.agg(F.array(*packed).alias("__all")).select(F.inline("__all"))


def value_counts(df: DataFrame, cols: Sequence[str], order: str | None = None) -> DataFrame:
    """Distinct values with their counts; optionally where each value is first seen."""
    keep = [order] if order else []
    extra = [F.min(order).alias("first_seen")] if order else []
    return (
        long_values(df, cols, keep)
        .where(F.col("value").isNotNull())
        .groupBy("variable", "value")
        .agg(F.count(F.lit(1)).alias("n"), *extra)
    )


# --- exact quantiles --------------------------------------------------------------------


def _brackets(
    df: DataFrame, cols: Sequence[str], probs: Sequence[float], width: float
) -> tuple[dict[str, int], dict[str, list[tuple[float, float]]]]:
    """Values per column, and value ranges that should hold the asked quantiles.

    One scan with mergeable sketches; the answer is a fixed number of scalars.
    """
    asked = sorted({q for p in probs for q in (max(p - width, 0.0), min(p + width, 1.0))})
    row = df.agg(
        *[F.count(c).alias(f"n_{i}") for i, c in enumerate(cols)],
        *[F.percentile_approx(F.col(c), asked, _ACCURACY).alias(f"q_{i}") for i, c in enumerate(cols)],
    ).first()
    sizes = {c: row[f"n_{i}"] for i, c in enumerate(cols)}
    ranges = {}
    for i, c in enumerate(cols):
        if not sizes[c]:
            continue
        at = dict(zip(asked, row[f"q_{i}"]))
        found = sorted(
            (
                float("-inf") if p - width <= 0 else at[p - width],
                float("inf") if p + width >= 1 else at[p + width],
            )
            for p in probs
        )
        merged = [found[0]]
        for low, high in found[1:]:
            if low <= merged[-1][1]:
                merged[-1] = (merged[-1][0], max(high, merged[-1][1]))
            else:
                merged.append((low, high))
        ranges[c] = merged
    return sizes, ranges


def _snap(value: Column, ranges: Sequence[tuple[float, float]]) -> Column:
    """Keep values inside the ranges; move each gap onto one point of the gap.

    Ranks inside the ranges stay exact while the rest of the column collapses in the
    map-side combine, so a continuous column is not shuffled whole.
    """
    chain = F.when(value < F.lit(ranges[0][0]), F.lit(float("-inf")))
    for i, (low, high) in enumerate(ranges):
        chain = chain.when(value <= F.lit(high), value)
        if i + 1 < len(ranges):
            nxt = ranges[i + 1][0]
            chain = chain.when(value < F.lit(nxt), F.lit((high + nxt) / 2))
    return F.when(value.isNull(), F.lit(None).cast("double")).otherwise(
        chain.otherwise(F.lit(float("inf")))
    )


def _ranked_picks(df, sizes, ranges, probs, rows_per_task) -> list:
    """Per column, the values at the ranks around each quantile, counted over all rows."""
    snapped = df.select(*[_snap(F.col(c), ranges[c]).alias(c) for c in ranges])
    counts = written_once(value_counts(snapped, list(ranges)), "counts")
    ranked = running_before(
        counts, ["variable"], "value", {"start": F.col("n")},
        unique_order=True, at_most=counts.count(), rows_per_task=rows_per_task,
    )
    totals = df.sparkSession.createDataFrame([(c, sizes[c]) for c in ranges], "variable string, __n long")
    ranked = ranked.join(F.broadcast(totals), "variable")
    picks = []
    for name, p in probs.items():
        position = (F.col("__n") - 1) * F.lit(float(p))
        for side, rank in (("lo", F.floor(position)), ("hi", F.ceil(position))):
            here = (F.col("start") <= rank) & (F.col("start") + F.col("n") > rank)
            picks.append(F.max(F.when(here, F.col("value"))).alias(f"{name}__{side}"))
    return ranked.groupBy("variable").agg(*picks).collect()


def quantile_table(
    df: DataFrame,
    cols: Sequence[str],
    probs: Mapping[str, float],
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Exact quantiles by linear interpolation: ``variable, n, <one column per prob>``.

    A sketch brackets each quantile; one pass counts all rows, telling values apart only
    inside the brackets, so ranks are exact. A quantile whose rank turns out to lie outside
    its bracket is searched again in a wider one, in the end among all values. The columns
    are stored once; the result (columns x probs numbers) is computed at once.
    """
    data = written_once(df.select(*[F.col(c).cast("double").alias(c) for c in cols]), "values")
    width, found, wanted = _BRACKET, {}, list(cols)
    while wanted:
        sizes, ranges = _brackets(data, wanted, list(probs.values()), width)
        for row in _ranked_picks(data, sizes, ranges, probs, rows_per_task) if ranges else []:
            c = row["variable"]
            picked = [row[f"{name}__{side}"] for name in probs for side in ("lo", "hi")]
            if all(any(low <= v <= high for low, high in ranges[c]) for v in picked):
                values = []
                for name, p in probs.items():
                    position = (sizes[c] - 1) * float(p)
                    low, high = row[f"{name}__lo"], row[f"{name}__hi"]
                    values.append(low + (high - low) * (position - math.floor(position)))
                found[c] = (c, sizes[c], *values)
        wanted = [c for c in ranges if c not in found]
        width *= _WIDER
    schema = ", ".join(["variable string", "n long", *[f"`{name}` double" for name in probs]])
    return df.sparkSession.createDataFrame([found[c] for c in cols if c in found], schema)


def quantile_values(df, cols, probs, rows_per_task=ROWS_PER_TASK) -> dict[str, dict[str, float]]:
    """The same as plain numbers (columns x probs of them), usable as literals in filters."""
    rows = quantile_table(df, cols, probs, rows_per_task).collect()
    return {r["variable"]: {name: r[name] for name in probs} for r in rows}


def approximate_quantiles(df, cols, probs: Mapping[str, float], accuracy: int = 10_000) -> DataFrame:
    """One-scan sketch quantiles for when an error of 1/accuracy in rank is good enough."""
    names = list(probs)
    table = summarize_columns(
        df, cols,
        {"q": lambda c: F.percentile_approx(c, [float(probs[n]) for n in names], accuracy)},
    )
    return table.select("variable", *[F.col("q")[i].alias(n) for i, n in enumerate(names)])


def named(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row per column name."""
    return df.sparkSession.createDataFrame([(c,) for c in cols], "variable string")


# --- centre and spread ------------------------------------------------------------------


def central_tendency(df: DataFrame, cols: Sequence[str], first_seen_by: str | None = None) -> DataFrame:
    """Mean, median and mode, 3 decimals.

    Equal mode counts go to the smallest value, or, with ``first_seen_by``, to the value
    that appears first in that order.
    """
    counts = value_counts(df, cols, first_seen_by)
    tie = F.col("first_seen") if first_seen_by else F.col("value")
    modes = counts.groupBy("variable").agg(
        F.min_by("value", F.struct(-F.col("n"), tie)).alias("mode"),
        (F.sum(F.col("value") * F.col("n")) / F.sum("n")).alias("mean"),
    )
    medians = quantile_table(df, cols, {"median": 0.5}).drop("n")
    # A column without values stays, with missing results.
    return named(df, cols).join(modes, "variable", "left").join(medians, "variable", "left").select(
        "variable",
        *[half_even(F.col(c), 3).alias(c) for c in ("mean", "median", "mode")],
    )


def skew_class(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Compare mean and median: strong (> 1.5), mild (> 1.1) or symmetric."""
    means = summarize_columns(df, cols, {"mean": F.avg})
    medians = quantile_table(df, cols, {"median": 0.5}).drop("n")
    ratio = F.when(F.col("median") == 0, F.lit(float("inf"))).otherwise(
        safe_ratio(F.col("mean"), F.col("median"))
    )
    label = (
        F.when(ratio.isNull(), None)
        .when(ratio > 1.5, "strong right skew")
        .when(ratio > 1.1, "mild right skew")
        .otherwise("symmetric")
    )
    return means.join(medians, "variable", "left").select(
        "variable", half_even(ratio, 4).alias("ratio"), label.alias("skew_class")
    )


def _dispersion_raw(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    raw = summarize_columns(
        df, cols,
        {
            "range": lambda c: F.max(c) - F.min(c),
            "variance": F.var_samp,
            "std_dev": F.stddev_samp,
            "mean": F.avg,
        },
    )
    cv = safe_ratio(F.col("std_dev") * 100, F.nullif(F.col("mean"), F.lit(0.0)))
    return raw.withColumn("cv_pct", cv)


def dispersion(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Range, sample variance, sample deviation (3 decimals), variation in % (2 decimals)."""
    return _dispersion_raw(df, cols).select(
        "variable",
        *[half_even(F.col(c), 3).alias(c) for c in ("range", "variance", "std_dev")],
        half_even(F.col("cv_pct"), 2).alias("cv_pct"),
    )


def cv_class(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Class of the coefficient of variation; a missing one counts as low."""
    cv = F.col("cv_pct")
    label = (
        F.when(cv > 150, "extreme").when(cv > 80, "high").when(cv > 30, "moderate").otherwise("low")
    )
    return _dispersion_raw(df, cols).select(
        "variable", half_even(cv, 1).alias("cv_pct"), label.alias("cv_class")
    )


PERCENTILES = {
    "p5": 0.05, "p10": 0.10, "q1": 0.25, "median": 0.50, "q3": 0.75, "p90": 0.90, "p95": 0.95,
}


def percentiles(df: DataFrame, cols: Sequence[str], *, exact: bool = True) -> DataFrame:
    """Seven percentiles and the interquartile range, 3 decimals."""
    table = (
        quantile_table(df, cols, PERCENTILES) if exact
        else approximate_quantiles(df, cols, PERCENTILES)
    )
    # A column without values stays, with missing results.
    return named(df, cols).join(table, "variable", "left").select(
        "variable",
        *[half_even(F.col(c), 3).alias(c) for c in PERCENTILES],
        half_even(F.col("q3") - F.col("q1"), 3).alias("iqr"),
    )


# --- outliers ---------------------------------------------------------------------------


def fence_values(df: DataFrame, cols: Sequence[str]) -> dict[str, dict[str, float]]:
    """Quartiles and fences as plain numbers, four per column."""
    quartiles = quantile_values(df, cols, {"q1": 0.25, "q3": 0.75})
    fences = {}
    for c in cols:
        q = quartiles.get(c)
        if q is None:
            fences[c] = {"q1": None, "q3": None, "iqr": None, "lower": None, "upper": None}
            continue
        iqr = q["q3"] - q["q1"]
        fences[c] = {
            **q, "iqr": iqr, "lower": q["q1"] - 1.5 * iqr, "upper": q["q3"] + 1.5 * iqr,
        }
    return fences


def _literal(value) -> Column:
    return F.lit(value).cast("double")


def _one_row_per_column(df: DataFrame, cols: Sequence[str], entry) -> DataFrame:
    """A single aggregate whose entry for each column may use literals of that column."""
    packed = [
        F.struct(F.lit(c).alias("variable"), *entry(c, F.col(c).cast("double"))) for c in cols
    ]
    return df.agg(F.array(*packed).alias("__all")).select(F.inline("__all"))


def outlier_fences(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Fences at 1.5 interquartile ranges, with counts and share of rows beyond them.

    Counts use the unrounded fences; the share is over all rows, missing ones included.
    """
    fences = fence_values(df, cols)

    def entry(c, value):
        f = fences[c]
        low = F.count_if(value < _literal(f["lower"]))
        high = F.count_if(value > _literal(f["upper"]))
        return [
            *[half_even(F.any_value(_literal(f[k])), 2).alias(k)
              for k in ("q1", "q3", "iqr", "lower", "upper")],
            low.alias("n_low"),
            high.alias("n_high"),
            half_even(safe_ratio((low + high) * 100, F.count(F.lit(1))), 1).alias("pct_outliers"),
        ]

    return _one_row_per_column(df, cols, entry)


def box_summary(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Five-number box data: whiskers are the extreme data inside the fences."""
    quartiles = quantile_values(df, cols, {"q1": 0.25, "median": 0.5, "q3": 0.75})

    def entry(c, value):
        q = quartiles.get(c) or {"q1": None, "median": None, "q3": None}
        spread = None if q["q1"] is None else 1.5 * (q["q3"] - q["q1"])
        lower = _literal(None if spread is None else q["q1"] - spread)
        upper = _literal(None if spread is None else q["q3"] + spread)
        inside = (value >= lower) & (value <= upper)
        outside = F.count_if((value < lower) | (value > upper))
        share = half_even(safe_ratio(outside * 100, F.count(F.lit(1))), 1)
        return [
            *[half_even(F.any_value(_literal(q[k])), 3).alias(k) for k in ("q1", "median", "q3")],
            half_even(F.avg(value), 3).alias("mean"),
            F.min(F.when(inside, value)).alias("whisker_low"),
            F.max(F.when(inside, value)).alias("whisker_high"),
            outside.alias("n_outliers"),
            F.format_string("%d out. (%.1f%%)", outside, share).alias("label"),
        ]

    return _one_row_per_column(df, cols, entry)


def top_extremes(
    df: DataFrame, value: str, show: Sequence[str], tie: Sequence[str], k: int = 10
) -> DataFrame:
    """The k largest rows above the upper fence as printed, that is, rounded to 2 decimals."""
    fences = fence_values(df, [value])[value]
    if fences["upper"] is None:
        return df.select(*show).limit(0)
    bound = round_literal(fences["upper"], 2)
    return (
        df.where(F.col(value) > F.lit(bound))
        .select(*dict.fromkeys([*show, *tie]))
        .orderBy(F.col(value).desc(), *tie)
        .limit(k)
        .select(*show)
    )


def round_literal(value: float, digits: int) -> float:
    """The rule of :func:`half_even` for one number."""
    return round(value * 10**digits) / 10**digits


# --- describe, balance, frequency -------------------------------------------------------


def describe_with_skew(df: DataFrame, cols: Sequence[str], digits: int = 4) -> DataFrame:
    """Count, mean, deviation, five-number summary and bias-adjusted skewness."""

    def adjusted_skew(c: Column) -> Column:
        n = F.count(c)
        g1 = F.coalesce(F.skewness(c), F.when(n > 0, F.lit(0.0)))  # missing without spread
        return F.when(n > 2, g1 * F.sqrt(n * (n - 1.0)) / F.nullif(n - 2, F.lit(0)))

    moments = summarize_columns(
        df, cols,
        {
            "count": F.count, "mean": F.avg, "std": F.stddev_samp,
            "min": F.min, "max": F.max, "skew": adjusted_skew,
        },
    )
    quartiles = quantile_table(df, cols, {"p25": 0.25, "p50": 0.5, "p75": 0.75}).drop("n")
    joined = moments.join(quartiles, "variable", "left")
    names = ("mean", "std", "min", "p25", "p50", "p75", "max", "skew")
    return joined.select("variable", "count", *[half_even(F.col(c), digits).alias(c) for c in names])


def group_balance(df: DataFrame, group: str, label: str) -> DataFrame:
    """Positives, labelled rows and percentage per group."""
    return (
        df.groupBy(group)
        .agg(F.sum(F.col(label).cast("long")).alias("positive"), F.count(label).alias("total"))
        .withColumn("pct_positive", half_even(safe_ratio(F.col("positive") * 100, F.col("total")), 4))
        .orderBy(group)
    )


def overall_balance(df: DataFrame, label: str) -> DataFrame:
    """Class balance of a whole table."""
    positive = F.count_if(F.col(label) == 1)
    total = F.count(label)
    return df.agg(
        total.alias("total"),
        positive.alias("positive"),
        (total - positive).alias("negative"),
        half_even(safe_ratio(positive * 100, total), 1).alias("pct_positive"),
    )


def balance_rollup(df: DataFrame, group: str, label: str) -> DataFrame:
    """Per-group and overall balance from one aggregation; the overall row is named ``all``."""
    return (
        df.withColumn(group, F.col(group).cast("string"))
        .rollup(group)
        .agg(F.sum(F.col(label).cast("long")).alias("positive"), F.count(label).alias("total"),
             F.grouping(group).alias("__overall"))
        .withColumn("pct_positive", half_even(safe_ratio(F.col("positive") * 100, F.col("total")), 4))
        .withColumn(group, F.when(F.col("__overall") == 1, "all").otherwise(F.col(group)))
        .drop("__overall")
    )


def value_frequency(df: DataFrame, value: str) -> DataFrame:
    """Rows per discrete value, in value order."""
    return (
        df.where(F.col(value).isNotNull())
        .groupBy(F.col(value).alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy("value")
    )


# --- distributions ----------------------------------------------------------------------


def _bounds(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return summarize_columns(
        df, cols,
        {"low": F.min, "high": F.max, "size": F.count, "std": F.stddev_samp},
    )


def histogram(df: DataFrame, cols: Sequence[str], bins: int = 30) -> DataFrame:
    """Equal-width bins over [min, max], last bin closed, with density; empty bins included."""
    bounds = F.broadcast(_bounds(df, cols))
    width = (F.col("high") - F.col("low")) / F.lit(float(bins))
    position = F.floor((F.col("value") - F.col("low")) / F.nullif(width, F.lit(0.0)))
    bin_no = F.least(F.coalesce(position, F.lit(0)), F.lit(bins - 1)).cast("int")
    filled = (
        long_values(df, cols)
        .where(F.col("value").isNotNull())
        .join(bounds, "variable")
        .groupBy("variable", bin_no.alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    frame = bounds.where(F.col("size") > 0).select(
        "variable", "low", "size", width.alias("width"),
        F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"),
    )
    n = F.coalesce(F.col("n"), F.lit(0).cast("long"))
    return frame.join(F.broadcast(filled), ["variable", "bin"], "left").select(
        "variable",
        "bin",
        half_even(F.col("low") + F.col("bin") * F.col("width"), 6).alias("left_edge"),
        n.alias("n"),
        half_even(safe_ratio(n, F.col("size") * F.col("width")), 9).alias("density"),
    )


#: Bandwidths beyond which a kernel weighs under 2e-16 of its centre.
KERNEL_REACH = 8.5


def kde_curve(
    df: DataFrame,
    cols: Sequence[str],
    points: int = 200,
    cut: float = 0.0,
    bandwidth: str = "scott",
    cells: int | None = None,
) -> DataFrame:
    """Gaussian kernel density on an even grid per variable.

    ``scott`` uses the sample deviation times n^(-1/5); ``nrd0`` uses 0.9 times the smaller
    of deviation and IQR/1.34. A value reaches the points within ``KERNEL_REACH``
    bandwidths only; what is left out of a density is under 1e-16/h. Equal values are
    combined first. With ``cells`` each row is shared linearly between the two nearest of
    that many cells, so the shuffle and the kernel work are bounded whatever the number of
    rows; with cells of width w a density is off by w^2 / (8 sqrt(2 pi) h^3) at most.
    """
    bounds = _bounds(df, cols)
    scale = F.col("std")
    if bandwidth == "nrd0":
        quartiles = quantile_table(df, cols, {"q1": 0.25, "q3": 0.75}).drop("n")
        bounds = bounds.join(quartiles, "variable")
        iqr = (F.col("q3") - F.col("q1")) / F.lit(1.34)
        narrow = F.when(iqr > 0, F.least(F.col("std"), iqr)).otherwise(F.col("std"))
        scale = F.lit(0.9) * narrow
    bounds = bounds.withColumn("h", scale * F.pow(F.col("size"), F.lit(-0.2))).where("h > 0")
    bounds = bounds.select(
        "variable", "size", "h",
        F.col("low").alias("min"),
        F.col("high").alias("max"),
        (F.col("low") - F.col("h") * cut).alias("start"),
        ((F.col("high") - F.col("low") + F.col("h") * (2 * cut)) / (points - 1)).alias("step"),
    )
    if cells:
        present = long_values(df, cols).where(F.col("value").isNotNull()).withColumn("n", F.lit(1.0))
        weighted = _spread_over_cells(present.join(F.broadcast(bounds), "variable"), cells)
    else:
        counts = value_counts(df, cols).withColumn("n", F.col("n").cast("double"))
        weighted = counts.join(F.broadcast(bounds), "variable")
    at = F.col("start") + F.col("point") * F.col("step")
    z = (at - F.col("value")) / F.col("h")
    reach = F.col("h") * KERNEL_REACH
    first = F.greatest(F.ceil((F.col("value") - reach - F.col("start")) / F.col("step")), F.lit(0)).cast("int")
    last = F.least(F.floor((F.col("value") + reach - F.col("start")) / F.col("step")), F.lit(points - 1)).cast("int")
    sums = (
        weighted.withColumn("point", F.explode(F.when(first <= last, F.sequence(first, last))))
        .groupBy("variable", "point")
        .agg(F.sum(F.col("n") * F.exp(F.lit(-0.5) * z * z)).alias("mass"))
    )
    grid = bounds.withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    scale = F.col("size") * F.col("h") * F.lit((2 * 3.141592653589793) ** 0.5)
    density = F.coalesce("mass", F.lit(0.0)) / scale
    return grid.join(sums, ["variable", "point"], "left").select(
        "variable", "point", half_even(at, 6).alias("x"), half_even(density, 8).alias("density")
    )


def _spread_over_cells(weighted: DataFrame, cells: int) -> DataFrame:
    """Share each value between its two neighbouring cell centres."""
    width = (F.col("max") - F.col("min")) / F.lit(float(cells - 1))
    place = (F.col("value") - F.col("min")) / width
    left = F.least(F.floor(place), F.lit(cells - 2))
    shares = F.array(
        F.struct(left.alias("cell"), (F.col("n") * (left + 1 - place)).alias("w")),
        F.struct((left + 1).alias("cell"), (F.col("n") * (place - left)).alias("w")),
    )
    same = ["variable", "size", "h", "min", "max", "start", "step"]
    return (
        weighted.withColumn("share", F.explode(shares))
        .groupBy(*same, F.col("share.cell").alias("cell"))
        .agg(F.sum("share.w").alias("n"))
        .withColumn("value", F.col("min") + F.col("cell") * width)
    )


def profile_all(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A general profile of every column from one scan."""
    table = summarize_columns(
        df, cols,
        {
            "n": F.count,
            "n_missing": lambda c: F.count_if(c.isNull()),
            "mean": F.avg,
            "std": F.stddev_samp,
            "min": F.min,
            "max": F.max,
            "total": F.sum,
        },
    )
    rounded = [half_even(F.col(c), 4).alias(c) for c in ("mean", "std", "min", "max", "total")]
    return table.select("variable", "n", "n_missing", *rounded)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
