"""Helpers shared by the operators on texts."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

import metricloom
from metricloom.session import scratch_path

# Workers need not have the package installed: its Python functions travel by value.
cloudpickle.register_pickle_by_value(metricloom)

#: Rows of a batch handed to Python; texts may be long, so batches hold few of them.
BATCH_ROWS = 256

#: Words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark.read.parquet(f"{folder}/{name}.parquet")


def small_batches(df: DataFrame) -> DataFrame:
    """Bound what Python holds at once, whatever the caller's session says."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return df


def fresh(taken: Iterable[str], name: str) -> str:
    """A column name that no column of the input has."""
    names = {x.lower() for x in taken}
    while name.lower() in names:
        name += "_"
    return name


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, name: str, label: str) -> DataFrame:
    """Add a unique row number and store the rows, so that the number can't change later."""
    return stored(df.withColumn(name, F.monotonically_increasing_id()), label)


def light(df: DataFrame, label: str, most: int = 1_000_000, weight: Column | None = None) -> DataFrame:
    """Store a side of a join, and mark it for broadcast if its counted size is small.

    ``weight`` is a row's size in items (default 1). Up to ``most`` items of a few dozen
    bytes go to every executor, which spares the shuffle of the other side; beyond that
    the join shuffles. The result is the same.
    """
    kept = stored(df, label)
    items = kept.agg(F.sum(F.lit(1) if weight is None else weight).alias("n")).first()["n"]
    return F.broadcast(kept) if (items or 0) <= most else kept


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit integers (a fixed finaliser of shifts and products)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Ranges:
    """64-bit hashes of arbitrary ranges of a text, all from one running polynomial.

    The hash of a range depends on its characters alone, not on its place. Base and
    its inverse are odd numbers modulo 2**64.
    """

    def __init__(self, base: int = 0x9E3779B97F4A7C15) -> None:
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self._up = np.ones(1, np.uint64)
        self._down = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if n > self._up.size:
            n = max(n, 2 * self._up.size)
            self._up = np.cumprod(np.r_[1, np.full(n - 1, self.base, np.uint64)].astype(np.uint64))
            self._down = np.cumprod(
                np.r_[1, np.full(n - 1, self.inverse, np.uint64)].astype(np.uint64)
            )

    def without_one(self, units: np.ndarray) -> np.ndarray:
        """Hashes of the whole sequence with each of its units left out in turn."""
        n = units.size
        self._grow(n + 1)
        run = np.zeros(n + 1, np.uint64)
        np.cumsum(mixed(units.astype(np.uint64) + np.uint64(1)) * self._up[:n], out=run[1:])
        rest = (run[n] - run[1:]) * np.uint64(self.inverse)
        return mixed(run[:-1] + rest + np.uint64(n - 1))

    def hashes(
        self, units: np.ndarray, start: np.ndarray, end: np.ndarray, values: np.ndarray | None = None
    ) -> np.ndarray:
        """Hashes of the ranges; ``values`` are the mixed units plus one, if at hand (overwritten)."""
        n = units.size
        self._grow(n + 1)
        if values is None:
            values = mixed(units.astype(np.uint64) + np.uint64(1))
        values *= self._up[:n]
        run = np.zeros(n + 1, np.uint64)
        np.cumsum(values, out=run[1:])
        return mixed((run[end] - run[start]) * self._down[start] + (end - start).astype(np.uint64))


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def word_bounds(units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each word in an array of bytes or code points."""
    if units.dtype == np.uint8:
        inside = ~_SPACE[units]
    else:
        inside = ~((units == 32) | ((units >= 9) & (units <= 13)))
    edge = np.diff(np.concatenate(([0], inside.view(np.int8), [0])).astype(np.int8))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
