"""Joins, unions, pivots and ordered views of result tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from metricloom.operators.profile import union_all
from metricloom.session import written_once


def annotate_join(long: DataFrame, summary: DataFrame, key: str = "variable") -> DataFrame:
    """Attach a per-variable summary (one row per column of the profile) to long rows.

    The summary is written first, so its size is known: a small one is broadcast by the
    optimizer, one beyond its threshold is joined by shuffling.
    """
    return long.join(written_once(summary, "summary"), key, "left")


def aligned_join(left: DataFrame, right: DataFrame, row_id: Sequence[str]) -> DataFrame:
    """Put columns side by side that belong to the same row."""
    return left.join(right, list(row_id), "left")


def key_lookup(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key is present in the other table."""
    return df.join(keys.select(*on), list(on), "left_semi")


def tagged_union(tables: Mapping[str, DataFrame], tag: str = "split") -> DataFrame:
    """Stack tables of one shape, naming where each row came from."""
    return union_all([t.withColumn(tag, F.lit(name)) for name, t in tables.items()])


def pivot_metric(df: DataFrame, row: str, column: str, value: str, columns: Sequence[str]) -> DataFrame:
    """One row per ``row``, one column per listed value of ``column``, holding the mean.

    Listing the values spares the extra job that would look them up.
    """
    return df.groupBy(row).pivot(column, list(columns)).agg(F.avg(value))


def chronological(df: DataFrame, date: str, tie: Sequence[str]) -> DataFrame:
    """Total order by date with explicit tie-breaks (a distributed range sort)."""
    return df.orderBy(date, *tie)


def top_importance(importances: DataFrame, k: int = 15) -> DataFrame:
    """The k most important features."""
    return importances.orderBy(F.desc("importance"), "feature").limit(k)
