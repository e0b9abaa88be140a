"""Typing, filtering and repairing of raw tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from metricloom.functions.scalars import (
    first_filled,
    floor_at,
    nan_to_null,
    slashed,
    to_instant,
    to_number,
)

MATURITY_DAYS = 180
# Types whose text, read as a number, is the number itself.
_NUMBERS = {"tinyint", "smallint", "int", "bigint", "double"}


def coerce_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Cast to double; what is not a number becomes missing."""
    return df.withColumns({c: to_number(F.col(c)) for c in cols})


def coerce_all_but(df: DataFrame, text_cols: Sequence[str]) -> DataFrame:
    """Keep the named columns as text and make every other column numeric."""
    return coerce_numeric(df, [c for c in df.columns if c not in set(text_cols)])


def coerce_timestamp(df: DataFrame, col: str) -> DataFrame:
    """Parse to a UTC instant and drop the rows that have none."""
    return df.withColumn(col, to_instant(F.col(col))).where(F.col(col).isNotNull())


def drop_incomplete(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a missing value in the subset (default: in any column)."""
    return df.dropna(how="any", subset=list(subset or df.columns))


def dedup_keep_first(df: DataFrame, key: str, order: Sequence[str | Column]) -> DataFrame:
    """One row per key: the first in the given order.

    The smallest (order, row) struct is an aggregate, so copies of one key are combined
    before the shuffle however many there are.
    """
    ranks = [c if isinstance(c, Column) else F.col(c) for c in order]
    first = F.min_by(F.struct(*df.columns), F.struct(*[r.alias(f"o{i}") for i, r in enumerate(ranks)]))
    return df.groupBy(F.col(key).alias("__key")).agg(first.alias("__row")).select("__row.*")


def maturity_filter(df: DataFrame, date: str, as_of: datetime, days: int = MATURITY_DAYS) -> DataFrame:
    """Keep rows strictly older than ``days`` before ``as_of``."""
    cutoff = F.timestamp_add("DAY", F.lit(-days), F.lit(as_of).cast("timestamp"))
    return df.where(F.col(date) < cutoff)


def ensure_features(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Missing values and absent columns become 0.0. Numbers do not take the way through text."""
    kinds = dict(df.dtypes)

    def number(c: str) -> Column:
        return nan_to_null(F.col(c).cast("double")) if kinds[c] in _NUMBERS else to_number(F.col(c))

    return df.withColumns(
        {c: F.coalesce(number(c), F.lit(0.0)) if c in df.columns else F.lit(0.0) for c in cols}
    )


def constant_columns(df: DataFrame, cols: Sequence[str], rule: str = "distinct") -> DataFrame:
    """Names of the columns without variation.

    ``distinct``: at most one distinct value, so empty columns count too.
    ``deviation``: the sample deviation is zero, which needs at least two values.
    """
    test = {
        "distinct": lambda n, low, high: (n == 0) | (low == high),
        "deviation": lambda n, low, high: (n > 1) & (low == high),
    }[rule]
    packed = [
        F.struct(
            F.lit(c).alias("variable"),
            test(F.count(c), F.min(c), F.max(c)).alias("constant"),
        )
        for c in cols
    ]
    return (
        df.agg(F.array(*packed).alias("__all"))
        .select(F.inline("__all"))
        .where("constant")
        .select("variable")
    )


def drop_constant_columns(df: DataFrame, cols: Sequence[str], rule: str = "distinct") -> DataFrame:
    """Remove them; only the names (at most one per column) reach the driver."""
    return df.drop(*[r["variable"] for r in constant_columns(df, cols, rule).collect()])


def select_columns(df: DataFrame, keep: Sequence[str] = (), drop: Sequence[str] = ()) -> DataFrame:
    """Keep the listed columns that exist, or drop the listed ones."""
    if keep:
        return df.select(*[c for c in keep if c in df.columns])
    return df.drop(*drop)


def clamp_label(label: Column) -> Column:
    """Missing becomes 0, fractions are cut off, the result lies in {0, 1}."""
    whole = F.coalesce(nan_to_null(label.cast("double")), F.lit(0.0))
    return F.least(F.greatest(whole, F.lit(-1.0)), F.lit(2.0)).cast("int").between(1, 2).cast("int")


def binarize(df: DataFrame, value: str, out: str) -> DataFrame:
    """1 where positive, else 0; rows without a value go."""
    return df.where(F.col(value).isNotNull()).withColumn(out, (F.col(value) > 0).cast("int"))


def touched_path(new_path: Column, old_path: Column) -> Column:
    """Path after the change, else before it, with forward slashes; missing if neither."""
    path = first_filled(new_path, old_path, default="")
    return slashed(F.nullif(path, F.lit("")))


def commit_filter(changes: DataFrame) -> DataFrame:
    """Drop merges and file rows without a path before any history is computed.

    A change left without file rows disappears, so it advances no counter.
    """
    return changes.where(~F.col("merge") & F.col("path").isNotNull() & (F.col("path") != ""))


def non_negative(value: Column) -> Column:
    return floor_at(value, 0.0)


def number_rows(df: DataFrame, group: Sequence[str], order: Sequence[str], out: str) -> DataFrame:
    """1-based position inside small groups."""
    return df.withColumn(out, F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
