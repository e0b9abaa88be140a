"""Train/test splits and folds that are exact, repeatable and free of global sorts.

Random order is the order of a keyed hash of the row id. The hash is uniform, so equal
slices of its range are equal shares of the rows: only the one slice that holds the
boundary has to be ranked.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from metricloom.operators.ordered import ROWS_PER_TASK, Cut, find_cut, is_before
from metricloom.session import written_once

HASH_DIGITS = 15
SLICES = 65_536
SEED = 42


def temporal_split(
    df: DataFrame, date: str, tie: str, train_share: float = 0.75,
    rows_per_task: int = ROWS_PER_TASK,
) -> tuple[DataFrame, DataFrame]:
    """The first ``int(share * n)`` rows by (date, tie) train, the rest test.

    Both sides are plain filters against one located row, so they reach the scan.
    ``tie`` is a numeric row id. Rows without a date or id count as the earliest: they
    train, and the two sides always add up to the input.
    """
    cut = temporal_cut(df, date, tie, train_share, rows_per_task)
    before = is_before(cut, date, tie)
    placed = F.col(date).isNotNull() & F.col(tie).isNotNull()
    return df.where(~placed | before), df.where(placed & ~before)


def temporal_cut(df, date, tie, train_share=0.75, rows_per_task=ROWS_PER_TASK) -> Cut:
    placed = F.col(date).isNotNull() & F.col(tie).isNotNull()
    sizes = df.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(placed, 1)).alias("dated")).first()
    first = max(0, int(sizes["n"] * train_share) - (sizes["n"] - sizes["dated"]))
    return find_cut(df.where(placed), date, tie, first, sizes["dated"], rows_per_task)


def hash_order(key: Column, seed: int = SEED) -> Column:
    """Uniform whole number in [0, 16^15) from the seed and the row id."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), key.cast("string")).cast("binary"))
    return F.conv(F.substring(digest, 1, HASH_DIGITS), 16, 10).cast("long")


def _sliced(df: DataFrame, key: str, seed: int) -> DataFrame:
    width = 16**HASH_DIGITS // SLICES
    hashed = df.withColumn("__h", hash_order(F.col(key), seed))
    return hashed.withColumn("__slice", F.floor(F.col("__h") / F.lit(width)).cast("int"))


def _slice_starts(sliced: DataFrame, strata: Sequence[str]) -> DataFrame:
    """Rows before each slice: at most strata x slices rows."""
    counts = sliced.groupBy(*strata, "__slice").agg(F.count(F.lit(1)).alias("__n"))
    by = Window.partitionBy(*(strata or [F.lit(0)]))
    earlier = by.orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(
        *strata, "__slice", "__n",
        F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__start"),
        F.sum("__n").over(by).alias("__total"),
    )


def hash_split(
    df: DataFrame, key: str, strata: Sequence[str] = (), test_share: float = 0.25, seed: int = SEED,
    stored: bool = False,
) -> DataFrame:
    """Mark exactly ``ceil(share * n)`` rows of each stratum as test (``is_test``).

    The boundaries, one row per stratum, are written first: the optimizer broadcasts them
    if that size allows and shuffles otherwise. With ``stored`` the rows are written with their
    hash, since four passes read them.
    """
    strata = list(strata)
    sliced = _sliced(df, key, seed)
    sliced = written_once(sliced, "sliced") if stored else sliced
    starts = _slice_starts(sliced, strata).withColumn(
        "__need", F.ceil(F.col("__total") * F.lit(test_share))
    )
    holds = (F.col("__start") < F.col("__need")) & (F.col("__start") + F.col("__n") >= F.col("__need"))
    cut = starts.where(holds).select(
        *[F.col(s).alias(f"__s_{s}") for s in strata],
        F.col("__slice").alias("__cut"),
        (F.col("__need") - F.col("__start")).alias("__left"),
    )
    if strata:
        same = F.lit(True)
        for s in strata:
            same = same & F.col(s).eqNullSafe(F.col(f"__s_{s}"))
        marked = sliced.join(written_once(cut, "split-cut"), same, "left")
    else:
        edge = cut.select(F.struct("__cut", "__left").alias("e")).scalar()
        marked = sliced.withColumns({"__cut": edge["__cut"], "__left": edge["__left"]})
    aside = marked.where(~F.col("__cut").eqNullSafe(F.col("__slice"))).withColumn(
        "is_test", F.coalesce(F.col("__slice") < F.col("__cut"), F.lit(False))
    )
    place = F.row_number().over(
        Window.partitionBy(*(strata or [F.lit(0)])).orderBy("__h", key)
    )
    edge_rows = (
        marked.where(F.col("__cut").eqNullSafe(F.col("__slice")))
        .withColumn("__place", place)
        .withColumn("is_test", F.col("__place") <= F.col("__left"))
        .drop("__place")
    )
    return aside.unionByName(edge_rows).select(*df.columns, "is_test")


def stratified_split(df, key, label, test_share=0.25, seed=SEED) -> DataFrame:
    """Random split that keeps the label shares."""
    return hash_split(df, key, [label], test_share, seed)


def random_split(df, key, test_share=0.25, seed=SEED, stored=False) -> DataFrame:
    """Random split without strata."""
    return hash_split(df, key, [], test_share, seed, stored)


def stratified_folds(
    df: DataFrame, key: str, label: str, folds: int = 5, seed: int = SEED
) -> DataFrame:
    """Deal the shuffled rows of each label round over the folds (``fold`` = 0, 1, ...)."""
    sliced = _sliced(df, key, seed)
    starts = written_once(_slice_starts(sliced, [label]).select(label, "__slice", "__start"), "split-starts")
    place = F.row_number().over(Window.partitionBy(label, "__slice").orderBy("__h", key))
    return (
        sliced.withColumn("__place", place)
        .join(starts, [label, "__slice"])
        .withColumn("fold", ((F.col("__start") + F.col("__place") - 1) % folds).cast("int"))
        .select(*df.columns, "fold")
    )
