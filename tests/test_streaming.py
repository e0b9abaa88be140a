from datetime import datetime, timedelta

import pytest
from pyspark.sql import Row, functions as F

from metricloom.operators.ordered import running_before
from metricloom.session import scratch_path
from metricloom.streaming import buckets, history, ingest


def test_incremental_ingest_deduplicates_and_resumes(spark):
    root = scratch_path(spark, "t")
    t0 = datetime(2024, 1, 1)
    rows = [(i % 6, t0 + timedelta(minutes=i)) for i in range(12)]
    df = spark.createDataFrame(rows, "hash long, ts timestamp")
    df.limit(8).write.parquet(f"{root}/in/a")

    def run():
        stream = ingest.read_stream(spark, f"{root}/in/*", df.schema)
        ingest.run_deduplicated(stream, "hash", f"{root}/out", f"{root}/cp")
        return sorted(r["hash"] for r in spark.read.schema(df.schema).parquet(f"{root}/out").collect())

    assert run() == list(range(6))
    assert run() == list(range(6))
    later = spark.createDataFrame([(3, t0), (77, t0 + timedelta(hours=1))], df.schema)
    later.write.parquet(f"{root}/in/b")
    assert run() == [*range(6), 77]
    # Keys far older than all that was seen are new keys, too.
    older = spark.createDataFrame([(90, t0 - timedelta(days=90)), (77, t0 - timedelta(days=9))], df.schema)
    older.write.parquet(f"{root}/in/c")
    assert run() == [*range(6), 77, 90]


def _streamed(spark, log, batches, keys, **more):
    root = scratch_path(spark, "t")
    for rows in batches:
        log.where(rows).coalesce(1).write.mode("append").parquet(f"{root}/in")
        stream = ingest.read_stream(spark, f"{root}/in", log.schema, files_per_batch=1)
        history.running_counts(stream, keys, "seq", root, **more)
    return root, history.current_counts(spark, root, log.schema, keys)


@pytest.mark.parametrize("batches", [
    ["seq < 40", "seq between 40 and 79", "seq > 79"], ["seq > 79", "seq < 40", "seq between 40 and 79"],
    ["seq % 3 = 1", "seq % 3 = 0", "seq % 3 = 2"], ["seq % 7 = 5", "seq % 7 < 5", "seq % 7 = 6", "false"],
])
def test_stream_counts_equal_batch_counts(spark, batches):
    rows = [(i, "bot" if i % 3 == 0 else None if i % 11 == 0 else f"a{i % 5}") for i in range(120)]
    log = spark.createDataFrame(rows, "seq long, author string")
    more = {"rows_per_task": 10} if batches[0] == "seq > 79" else {}
    _, got = _streamed(spark, log, batches, ["author"], **more)
    want = running_before(log, ["author"], "seq", {"EXP": F.lit(1).cast("long")})
    assert sorted(map(str, got.collect())) == sorted(map(str, want.select("seq", "author", "EXP").collect()))


def test_rows_of_equal_order_do_not_see_each_other(spark):
    log = spark.createDataFrame([(i // 4, "x", i) for i in range(40)], "seq long, author string, id int")
    _, got = _streamed(spark, log, ["id % 2 = 0", "id % 4 = 1", "id % 4 = 3"], ["author"])
    assert {r["id"]: r["EXP"] for r in got.collect()} == {i: i // 4 * 4 for i in range(40)}


def test_a_batch_touches_only_its_buckets(spark):
    log = spark.createDataFrame([(i, f"a{i % 50}") for i in range(200)], "seq long, author string")
    root, _ = _streamed(spark, log, ["seq < 100", "author = 'a7' and seq >= 100"], ["author"])
    totals = spark.read.parquet(f"{root}/totals")
    assert totals.where("batch = 1").select("bucket").distinct().count() == 1
    stored = buckets.read_before(spark, f"{root}/totals", totals.drop("bucket", "batch").schema, [3], 1)
    plan = stored._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "bucket" in plan.split("PartitionFilters")[1].split("]")[0]


def test_the_first_row_of_a_key_stays(spark):
    root = scratch_path(spark, "t")
    rows = [(k, 10 - i, f"v{i}") for i in range(8) for k in (1, None)]
    df = spark.createDataFrame(rows, "hash long, at int, v string").repartition(3)
    df.coalesce(1).write.parquet(f"{root}/in")
    stream = ingest.read_stream(spark, f"{root}/in", df.schema)
    ingest.run_deduplicated(stream, "hash", f"{root}/out", f"{root}/cp", order=["at"])
    got = spark.read.schema(df.schema).parquet(f"{root}/out").select("hash", "at", "v").collect()
    assert sorted(map(str, got)) == sorted(map(str, [Row(hash=1, at=3, v="v7"), Row(hash=None, at=3, v="v7")]))
    with pytest.raises(ValueError, match="rename"):
        ingest.run_deduplicated(stream.withColumn("batch", F.lit(1)), "hash", f"{root}/o", f"{root}/c")
