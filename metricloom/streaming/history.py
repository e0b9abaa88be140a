"""Running counters over a stream of changes (earlier changes per author or file).

Totals per key lie in buckets of the key's hash; a batch reads and rewrites only the
buckets of its keys. Rows behind all earlier ones of their key add the key's total to their
place in the batch. A key with a row that arrives out of order is counted anew: its stored
rows are read from their buckets and written again with the batch, and replace what was
written before. So the stream gives the batch result in whatever order rows arrive.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from metricloom.operators.ordered import ROWS_PER_TASK, running_before
from metricloom.session import path_exists, written_once
from metricloom.streaming import buckets
from metricloom.streaming.buckets import BATCH, BUCKET

#: Whether a batch wrote all rows of a key anew.
_WHOLE = "__whole"


def _same(keys: Sequence[str]) -> Column:
    """Equal keys, a missing key included; the other side's are named ``__k_...``."""
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in keys])


def _renamed(df: DataFrame, keys: Sequence[str], *cols: Column) -> DataFrame:
    return df.select(*[F.col(k).alias(f"__k_{k}") for k in keys], *cols)


def _current(stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The valid rows: those written since the last batch that wrote their key anew."""
    rewritten = _renamed(
        stored.where(_WHOLE).groupBy(*keys).agg(F.max(BATCH).alias("__since")), keys, F.col("__since")
    )
    joined = stored.join(rewritten, _same(keys), "left")
    return joined.where(F.col(BATCH) >= F.coalesce("__since", F.lit(-1))).drop(
        "__since", _WHOLE, BATCH, *[f"__k_{k}" for k in keys]
    )


def current_counts(spark: SparkSession, root: str, schema: T.StructType, keys: Sequence[str], count_as: str = "EXP") -> DataFrame:
    """All rows that arrived (columns of ``schema``), each with its count as of now."""
    full = T.StructType([*schema.fields, T.StructField(count_as, T.LongType()), T.StructField(_WHOLE, T.BooleanType())])
    if not path_exists(spark, f"{root}/out"):
        return spark.createDataFrame([], full).drop(_WHOLE)
    every = range(buckets.BUCKETS)
    return _current(buckets.read_before(spark, f"{root}/out", full, every, 2**31 - 1), keys).drop(BUCKET)


def running_counts(
    stream: DataFrame,
    keys: Sequence[str],
    order: str,
    root: str,
    count_as: str = "EXP",
    rows_per_task: int = ROWS_PER_TASK,
) -> str:
    """Count the earlier rows of the same keys for all that arrives; read them by ``current_counts``.

    Returns the folder of the output. ``order`` is a whole number; rows of equal order do
    not see each other. Columns named ``bucket`` or ``batch`` are refused.
    """
    keys = list(keys)
    if {BUCKET, BATCH} & set(stream.columns):
        raise ValueError(f"columns {BUCKET} and {BATCH} name the store's folders; rename them first")
    out, totals_root = f"{root}/out", f"{root}/totals"
    rows_schema = T.StructType(
        [*stream.schema.fields, T.StructField(count_as, T.LongType()), T.StructField(_WHOLE, T.BooleanType())]
    )
    totals_schema = T.StructType(
        [*[stream.schema[k] for k in keys], T.StructField("__n", T.LongType()), T.StructField("__last", stream.schema[order].dataType)]
    )
    one = {count_as: F.lit(1).cast("long")}

    def process(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = written_once(batch.withColumn(BUCKET, buckets.bucket_of(keys)), "arrived")
        mine = buckets.touched(rows)
        prior, older = buckets.latest(spark, totals_root, totals_schema, mine, batch_id)
        prior = prior.drop(BATCH)
        arrived = rows.count()
        counted = prior.agg(F.sum("__n").alias("n")).first()["n"] or 0
        added = rows.groupBy(*keys, BUCKET).agg(
            F.count(F.lit(1)).alias("__n"), F.max(order).alias("__last"), F.min(order).alias("__first")
        )
        known = _renamed(prior, keys, F.col("__n").alias("__earlier"), F.col("__last").alias("__seen"))
        # Rows of equal order do not see each other, so an equal one is out of order as well.
        late = written_once(
            _renamed(added.join(known, _same(keys)).where(F.col("__first") <= F.col("__seen")), keys), "late"
        )
        behind = running_before(
            rows.join(late, _same(keys), "left_anti"), keys, order, one, at_most=arrived, rows_per_task=rows_per_task
        )
        behind = behind.join(known, _same(keys), "left").withColumn(
            count_as, F.col(count_as) + F.coalesce("__earlier", F.lit(0))
        )
        stored = buckets.read_before(spark, out, rows_schema, mine, batch_id)
        before = _current(stored.join(late, _same(keys), "left_semi"), keys).select(*rows.columns)
        anew = running_before(
            before.unionByName(rows.join(late, _same(keys), "left_semi")), keys, order, one,
            at_most=arrived + counted, rows_per_task=rows_per_task,
        )
        cols = [*rows.columns, count_as]
        made = behind.select(*cols, F.lit(False).alias(_WHOLE)).unionByName(
            anew.select(*cols, F.lit(True).alias(_WHOLE))
        )
        buckets.write_batch(made, out, batch_id)
        totals = prior.unionByName(added.drop("__first")).groupBy(*keys, BUCKET).agg(
            F.sum("__n").alias("__n"), F.max("__last").alias("__last")
        )
        buckets.write_batch(totals, totals_root, batch_id)
        buckets.drop_older(spark, totals_root, older)

    query = (
        stream.writeStream.foreachBatch(process)
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return out
