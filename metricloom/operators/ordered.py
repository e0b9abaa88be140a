"""Ordered running totals that do not depend on any group fitting into one task.

A plain window puts a whole group into one task. Groups of bounded size are left to it: one
count per bucket of the keys' hash shows which rows may belong to larger ones. Those rows are
cut along the order column into blocks of about equal size, and are dealt by (group, block):
so no task holds more rows of a group than a block has. Totals run inside a block;
one partial total per (group, block) is scanned along the blocks, and what it carries into
a block joins the block's rows as one more row of the same window. The carried rows are
dealt like the others, not broadcast.

The number of blocks follows from the number of rows. With one block this is the plain
window.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from metricloom.session import written_once

#: Rows of a block. An order without groups has no other way to spread, so its blocks are smaller.
ROWS_PER_TASK = 1_000_000
ROWS_WITHOUT_GROUPS = 100_000
#: Bounds between blocks that one sketch of the order column provides. Beyond as many blocks
#: of the size above, blocks grow with the rows.
MOST_BLOCKS = 4_096
_ACCURACY = 50_000
BUCKETS = 65_536  # of the keys' hash, counted to find groups too large for one task
_BLOCK, _CARRIED = "__block", "__carried"


@dataclass(frozen=True)
class Blocks:
    """Where blocks of rows begin along an order column; a block holds the values above its bound."""

    bounds: tuple[float, ...] = ()

    def mark(self, df: DataFrame, order: str) -> DataFrame:
        """Add the block of each row; missing values come first, as in a sort."""
        splits = [float("-inf"), *self.bounds, float("inf")]
        cut = Bucketizer(splits=splits, inputCol="__order", outputCol=_BLOCK, handleInvalid="keep")
        marked = cut.transform(df.withColumn("__order", F.col(order).cast("double")))
        last = len(self.bounds)  # where not-a-number belongs
        block = F.when(F.col("__order").isNull(), 0).otherwise(F.least(F.col(_BLOCK).cast("int"), F.lit(last)))
        return marked.withColumn(_BLOCK, block).drop("__order")


def find_blocks(
    df: DataFrame, order: str, grouped: bool = True, rows_per_task: int = ROWS_PER_TASK, at_most: int | None = None
) -> Blocks:
    """Bounds that cut all rows into blocks of about ``rows_per_task`` rows along ``order``.

    One pass counts the rows and sketches the order column. If a known bound ``at_most`` on
    the rows fits one block, the pass is spared. Rows of equal order stay together.
    """
    size = rows_per_task if grouped else min(rows_per_task, ROWS_WITHOUT_GROUPS)
    if at_most is not None and at_most <= size:
        return Blocks()
    shares = [i / MOST_BLOCKS for i in range(1, MOST_BLOCKS)]
    value = F.col(order).cast("double")
    row = df.agg(
        F.count(F.lit(1)).alias("n"), F.percentile_approx(F.nanvl(value, F.lit(None)), shares, _ACCURACY).alias("b")
    ).first()
    wanted = min(MOST_BLOCKS, math.ceil(row["n"] / size))
    step = MOST_BLOCKS / max(wanted, 1)
    bounds = {row["b"][min(round(step * i), MOST_BLOCKS - 1) - 1] for i in range(1, wanted)} if row["b"] else set()
    return Blocks(tuple(sorted(b for b in bounds if math.isfinite(b))))


def running_before(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    sums: Mapping[str, Column] | None = None,
    latest: Mapping[str, Column] | None = None,
    *,
    unique_order: bool = False,
    blocks: Blocks | None = None,
    at_most: int | None = None,
    rows_per_task: int = ROWS_PER_TASK,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Add totals (and latest non-missing values) over strictly earlier rows of the group.

    ``order`` is numeric. Rows of equal order do not see each other: for that the
    order must be a whole number, or ``unique_order`` states that it never repeats
    inside a group. ``blocks`` may be given if several totals share an order. ``counted``
    is a table that is cheaper to read and holds each group's rows at least.
    """
    sums, latest, keys = dict(sums or {}), dict(latest or {}), list(keys)
    how = (keys, order, sums, latest, unique_order)
    size = rows_per_task if keys else min(rows_per_task, ROWS_WITHOUT_GROUPS)
    if (blocks is not None and not blocks.bounds) or (blocks is None and at_most is not None and at_most <= size):
        return _totals(df, *how, Blocks())
    work = written_once(df, "ordered") if counted is None else df  # read by the count, the cut and the totals
    light = None
    if keys:
        heavy = heavy_buckets(work if counted is None else counted, keys, rows_per_task)
        if not heavy:
            return _totals(work, *how, Blocks())
        light = _totals(work.where(~_bucket(keys).isin(heavy)), *how, Blocks())
        work = work.where(_bucket(keys).isin(heavy))
        work = work if counted is None else written_once(work, "ordered")
    blocks = blocks or find_blocks(work, order, bool(keys), rows_per_task)
    cut = _totals(work, *how, blocks)
    return cut if light is None else light.unionByName(cut)


def _bucket(keys: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int")


def heavy_buckets(df: DataFrame, keys: Sequence[str], most: int = ROWS_PER_TASK) -> list[int]:
    """Buckets of the keys' hash with more than ``most`` rows: only they can hold such a group.

    At most one bucket for each ``most`` rows, found from one small count per task.
    """
    counts = df.groupBy(_bucket(keys).alias("b")).agg(F.count(F.lit(1)).alias("n"))
    return sorted(r["b"] for r in counts.where(F.col("n") > most).collect())


def _totals(df: DataFrame, keys, order, sums, latest, unique_order, blocks: Blocks) -> DataFrame:
    """``running_before`` with the given blocks; without any this is the plain window."""
    work = df
    inner = {name: f"__in_{name}" for name in (*sums, *latest)}
    work = work.withColumns({inner[name]: value for name, value in {**sums, **latest}.items()})
    local_keys = keys
    if blocks.bounds:
        work = blocks.mark(work, order)
        carry = _carried(work, keys, order, sums, latest, inner)
        work = work.withColumn(_CARRIED, F.lit(False)).unionByName(carry, allowMissingColumns=True)
        local_keys = [*keys, _BLOCK]
    group = Window.partitionBy(*(local_keys or [F.lit(0)]))
    ordered = group.orderBy(order)
    before = (
        ordered.rowsBetween(Window.unboundedPreceding, -1)
        if unique_order
        else ordered.rangeBetween(Window.unboundedPreceding, -1)
    )
    kinds = {name: work.select(F.sum(inner[name])).schema[0].dataType for name in sums}
    made = {name: F.sum(inner[name]).over(before) for name in sums}
    made |= {name: F.last(inner[name], ignorenulls=True).over(before) for name in latest}
    if blocks.bounds:
        brought = {n: F.max(f"__c_{n}").over(group) for n in sums}
        made = {n: F.coalesce(v, F.lit(0)) + F.coalesce(brought[n], F.lit(0)) if n in sums else v for n, v in made.items()}
        made = {
            n: F.coalesce(v, F.first(f"__c_{n}", ignorenulls=True).over(group)) if n in latest else v
            for n, v in made.items()
        }
    for n in sums:
        made[n] = F.coalesce(made[n], F.lit(0)).cast(kinds[n])
    out = work.withColumns(made)
    if blocks.bounds:
        out = out.where(~F.col(_CARRIED)).drop(_BLOCK, _CARRIED, *[f"__c_{n}" for n in inner])
    return out.drop(*inner.values())


def _carried(work: DataFrame, keys, order, sums, latest, inner) -> DataFrame:
    """One row per group and block with the totals of the group's earlier blocks.

    The rows have no order and no values of their own, so that the window over the block
    passes them by.
    """
    totals = work.groupBy(*keys, _BLOCK).agg(
        *[F.sum(inner[n]).alias(f"__t_{n}") for n in sums],
        *[
            F.max_by(inner[n], F.when(F.col(inner[n]).isNotNull(), F.col(order))).alias(f"__t_{n}")
            for n in latest
        ],
    )
    earlier = (
        Window.partitionBy(*(keys or [F.lit(0)])).orderBy(_BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    )
    return totals.select(
        *keys, _BLOCK, F.lit(True).alias(_CARRIED),
        *[F.sum(f"__t_{n}").over(earlier).alias(f"__c_{n}") for n in sums],
        *[F.last(f"__t_{n}", ignorenulls=True).over(earlier).alias(f"__c_{n}") for n in latest],
    )


@dataclass(frozen=True)
class Cut:
    """Position ``k`` of an ordered table: everything before ``(value, tie)``."""

    value: object = None
    tie: object = None
    everything: bool = field(default=False)


def value_at(
    df: DataFrame,
    order: str,
    position: int,
    at_most: int | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> tuple[object, int] | None:
    """The value at a 0-based position of the sorted column and how many rows precede it."""
    counts = df.groupBy(order).agg(F.count(F.lit(1)).alias("__n"))
    ranked = running_before(
        counts, [], order, {"__start": F.col("__n")},
        unique_order=True, at_most=at_most, rows_per_task=rows_per_task,
    )
    row = ranked.where(
        (F.col("__start") <= position) & (F.col("__start") + F.col("__n") > position)
    ).first()
    return (row[order], row["__start"]) if row else None


def find_cut(
    df: DataFrame,
    order: str,
    tie: str,
    position: int,
    at_most: int | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> Cut:
    """Locate a position under (order, tie) without sorting rows across the table."""
    at = value_at(df, order, position, at_most, rows_per_task)
    if at is None:
        return Cut(everything=True)
    value, start = at
    ties = df.where(F.col(order) == F.lit(value)).select(tie)
    tie_at = value_at(ties, tie, position - start, at_most, rows_per_task)
    return Cut(value, tie_at[0])


def is_before(cut: Cut, order: str, tie: str) -> Column:
    if cut.everything:
        return F.lit(True)
    return (F.col(order) < F.lit(cut.value)) | (
        (F.col(order) == F.lit(cut.value)) & (F.col(tie) < F.lit(cut.tie))
    )
