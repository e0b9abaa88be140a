"""Incremental, deduplicated ingest of a change stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from metricloom.session import written_once
from metricloom.streaming import buckets


def read_stream(
    spark: SparkSession, folder: str, schema: T.StructType, glob: str = "*.parquet",
    files_per_batch: int = 100,
) -> DataFrame:
    """Parquet files of a folder as a stream; the checkpoint is the ledger of files."""
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", glob)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(folder)
    )


def run_deduplicated(stream: DataFrame, key: str, path: str, checkpoint: str, order: Sequence[str] = ()) -> None:
    """Append the rows of new keys, one row per key, and stop; a later call goes on from here.

    Keys are compared with all stored ones, so a row is never lost for arriving late, and a
    repeat is dropped however late it comes. Stored rows lie in buckets of the key's hash,
    and a batch reads only the buckets of its keys. Of several rows of a key in one batch
    the first by ``order`` stays, then by all columns. Each batch owns its folders: a replayed
    batch overwrites its own rows. A missing key is a key like any other. Columns named
    ``bucket`` or ``batch`` are refused.
    """
    if {buckets.BUCKET, buckets.BATCH} & set(stream.columns):
        raise ValueError(f"columns {buckets.BUCKET} and {buckets.BATCH} name the store's folders; rename them first")
    cols = [*order, *[c for c in stream.columns if c not in order]]

    def process(batch: DataFrame, batch_id: int) -> None:
        first = batch.groupBy(F.col(key).alias("__key")).agg(F.min(F.struct(*cols)).alias("row")).select("row.*")
        new = first.select(*stream.columns).withColumn(buckets.BUCKET, buckets.bucket_of([key]))
        new = written_once(new, "arrived")
        earlier = buckets.read_before(batch.sparkSession, path, stream.schema, buckets.touched(new), batch_id)
        known = earlier.select(F.col(key).alias("__known"))
        new = new.join(known, F.col(key).eqNullSafe(F.col("__known")), "left_anti")
        buckets.write_batch(new, path, batch_id)

    query = (
        stream.writeStream.foreachBatch(process)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def run_to_table(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Process everything available and stop; a later call goes on where this one ended."""
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
