"""Tables that streams keep by key: rows lie in buckets of the key's hash, versioned by batch.

A batch reads and writes only the buckets of its keys. Its files lie under its own batch
number, so a replayed batch overwrites what it wrote and never sees it.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from metricloom.session import path_exists, remove_path

#: Buckets of a table; also the bound on the bucket numbers that reach the driver.
BUCKETS = 32
BUCKET, BATCH = "bucket", "batch"


def bucket_of(keys: Sequence[str]) -> Column:
    """The bucket of a row; a missing key is a key like any other."""
    return F.pmod(F.xxhash64(F.lit(0), *[F.col(k) for k in keys]), F.lit(BUCKETS)).cast("int")


def touched(df: DataFrame) -> list[int]:
    return sorted(r[BUCKET] for r in df.select(BUCKET).distinct().collect())


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Write rows with their bucket as those of a batch.

    Rows of a bucket are brought together, so that it gets few files; a large bucket is
    split over tasks again.
    """
    df.hint("rebalance", F.col(BUCKET)).withColumn(BATCH, F.lit(batch_id)).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy(BUCKET, BATCH).parquet(path)


def read_before(spark: SparkSession, path: str, schema: T.StructType, buckets: Iterable[int], batch_id: int) -> DataFrame:
    """The stored rows of some buckets from batches before this one, with bucket and batch."""
    kept = T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType()), T.StructField(BATCH, T.IntegerType())])
    if not path_exists(spark, path):
        return spark.createDataFrame([], kept)
    stored = spark.read.schema(kept).parquet(path)
    return stored.where(F.col(BUCKET).isin(list(buckets)) & (F.col(BATCH) < batch_id))


def latest(
    spark: SparkSession, path: str, schema: T.StructType, buckets: Iterable[int], batch_id: int
) -> tuple[DataFrame, dict[int, set[int]]]:
    """The last version of each bucket of a table that is rewritten by bucket, and the older ones."""
    stored = read_before(spark, path, schema, buckets, batch_id)
    there: dict[int, set[int]] = {}
    for r in stored.select(BUCKET, BATCH).distinct().collect():
        there.setdefault(r[BUCKET], set()).add(r[BATCH])
    versions = {b: max(v) for b, v in there.items()}
    some = F.lit(False)
    for version in sorted(set(versions.values())):
        some = some | ((F.col(BATCH) == version) & F.col(BUCKET).isin([b for b, v in versions.items() if v == version]))
    return stored.where(some), {b: v - {versions[b]} for b, v in there.items()}


def drop_older(spark: SparkSession, path: str, older: dict[int, set[int]]) -> None:
    """Remove versions of buckets that no replay can need."""
    for bucket, versions in older.items():
        for version in versions:
            remove_path(spark, f"{path}/{BUCKET}={bucket}/{BATCH}={version}")
