"""Ingest that remembers which keys it has already taken in."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from metricloom.session import path_exists


class KeyLedger:
    """A results table and the table of processed keys next to it, both Parquet.

    Rows land under the run that wrote them and the keys are recorded last. A run that dies
    in between is repeated: its rows sit in the same run folder and are overwritten.
    """

    def __init__(self, spark: SparkSession, root: str, key: str):
        self.spark, self.key = spark, key
        self.rows_path, self.keys_path = f"{root}/rows", f"{root}/keys"

    def _read(self, path: str) -> DataFrame | None:
        # Only an absent folder is an absent table; any other fault is the caller's to see.
        return self.spark.read.parquet(path) if path_exists(self.spark, path) else None

    def rows(self) -> DataFrame | None:
        table = self._read(self.rows_path)
        return None if table is None else table.drop("run")

    def keys(self) -> DataFrame | None:
        return self._read(self.keys_path)

    def _next_run(self) -> int:
        done = self.keys()
        last = None if done is None else done.agg(F.max("run").alias("r")).first()["r"]
        return 0 if last is None else last + 1

    def ingest(self, batch: DataFrame, offered: DataFrame | None = None, force: bool = False) -> None:
        """Append the rows whose key is not recorded yet, then record the keys.

        ``offered`` lists the keys of this run (default: those in the batch), so that a key
        is recorded even when it gave no rows. ``force`` starts both tables over.
        """
        run = 0 if force else self._next_run()
        done = None if force else self.keys()
        offered = (offered if offered is not None else batch).select(self.key).distinct()
        if done is not None:
            taken = done.select(F.col(self.key).alias("__taken"))
            # A missing key is a key like any other: it is taken in once.
            same = F.col(self.key).eqNullSafe(F.col("__taken"))
            batch = batch.join(taken, same, "left_anti")
            offered = offered.join(taken, same, "left_anti")
        self._write(batch, self.rows_path, run, force)
        self._write(offered, self.keys_path, run, force)

    def _write(self, df: DataFrame, path: str, run: int, force: bool) -> None:
        if force:
            df.withColumn("run", F.lit(run)).write.mode("overwrite").partitionBy("run").option(
                "partitionOverwriteMode", "static"
            ).parquet(path)
        else:
            df.withColumn("run", F.lit(run)).write.mode("overwrite").partitionBy("run").option(
                "partitionOverwriteMode", "dynamic"
            ).parquet(path)
