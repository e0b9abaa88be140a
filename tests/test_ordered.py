import random

import pytest
from pyspark.sql import functions as F

from metricloom.operators.ordered import find_blocks, find_cut, heavy_buckets, is_before, running_before, value_at


def _rows(n=900, seed=3):
    """One key holds a third of all rows; some orders repeat inside a key."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if i % 3 == 0 else f"k{rng.randrange(40)}"
        rows.append((i, key, rng.randrange(300), rng.randrange(10), rng.choice(["a", "b", None])))
    return rows


def _expected(rows):
    out = {}
    for i, key, at, _, _ in rows:
        before = [r for r in rows if r[1] == key and r[2] < at]
        out[i] = (sum(r[3] for r in before), len(before))
    return out


@pytest.mark.parametrize("rows_per_task", [40, 1_000_000])
def test_sums_over_strictly_earlier_rows(spark, rows_per_task):
    rows = _rows()
    df = spark.createDataFrame(rows, "id int, key string, at long, v int, tag string").repartition(5)
    got = running_before(
        df, ["key"], "at", {"s": F.col("v"), "c": F.lit(1).cast("long")}, rows_per_task=rows_per_task
    )
    assert {r["id"]: (r["s"], r["c"]) for r in got.collect()} == _expected(rows)


@pytest.mark.parametrize("rows_per_task", [40, 1_000_000])
def test_latest_skips_missing_values(spark, rows_per_task):
    rows = [(i, k, i, v, t) for i, k, _, v, t in _rows()]
    df = spark.createDataFrame(rows, "id int, key string, at long, v int, tag string")
    got = running_before(
        df, ["key"], "at", latest={"last": F.col("tag")}, rows_per_task=rows_per_task
    ).collect()
    for r in got:
        before = [t for _, k, at, _, t in rows if k == r["key"] and at < r["at"] and t is not None]
        assert r["last"] == (before[-1] if before else None)


def test_a_missing_key_can_be_hot(spark):
    rows = [(i, None if i % 2 else "x", i) for i in range(400)]
    df = spark.createDataFrame(rows, "id int, key string, at long")
    got = running_before(df, ["key"], "at", {"c": F.lit(1).cast("long")}, rows_per_task=50)
    assert all(r["c"] == r["id"] // 2 for r in got.collect())


@pytest.mark.parametrize("rows_per_task", [30, 1_000_000])
def test_no_keys_and_fractional_unique_order(spark, rows_per_task):
    rows = [(i, i / 7.0 - 20) for i in range(500)]
    df = spark.createDataFrame(rows, "id int, at double").repartition(4)
    got = running_before(
        df, [], "at", {"c": F.lit(1).cast("long")}, unique_order=True, rows_per_task=rows_per_task
    )
    assert all(r["c"] == r["id"] for r in got.collect())


def test_blocks_are_bounded_whatever_the_groups(spark):
    """A group of fifty times the block size, and two thousand groups, cut alike."""
    rows = [("hot", i) for i in range(5_000)] + [(f"k{i}", (i * 7919) % 5_000) for i in range(2_000) for _ in range(3)]
    df = spark.createDataFrame(rows, "key string, at long").repartition(5)
    blocks = find_blocks(df, "at", rows_per_task=100)
    sizes = blocks.mark(df, "at").groupBy("key", "__block").count().agg(F.max("count")).first()[0]
    assert sizes <= 130 and len(blocks.bounds) > 90
    got = running_before(df, ["key"], "at", {"c": F.lit(1).cast("long")}, rows_per_task=100).collect()
    assert len(got) == len(rows) and all(r["c"] == (r["at"] if r["key"] == "hot" else 0) for r in got)
    assert find_blocks(df, "at", rows_per_task=100, at_most=90).bounds == ()


def test_missing_and_odd_orders(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, x) for i, x in enumerate([None, -inf, *range(60), inf, nan])]
    df = spark.createDataFrame([(i, None if x is None else float(x)) for i, x in rows], "id int, at double")
    for size in (10, 1_000):
        got = running_before(
            df.repartition(3), [], "at", {"c": F.lit(1).cast("long")}, {"was": F.col("id")}, unique_order=True, rows_per_task=size
        ).collect()
        assert {r["id"]: (r["c"], r["was"]) for r in got} == {i: (i, i - 1 if i else None) for i, _ in rows}


def test_totals_keep_their_types(spark):
    df = spark.range(300).selectExpr("id as at", "id % 3 as key", "cast(1.5 as decimal(10,2)) as d", "cast(id as double) as x")
    small, large = (
        running_before(df, ["key"], "at", {"sd": F.col("d"), "sx": F.col("x")}, {"ld": F.col("d")}, rows_per_task=n)
        for n in (20, 10_000)
    )
    assert small.dtypes == large.dtypes
    assert sorted(map(str, small.collect())) == sorted(map(str, large.collect()))


@pytest.mark.parametrize("rows_per_task", [20, 1_000_000])
def test_cut_on_tied_dates(spark, rows_per_task):
    rows = [(i, (i * 7919) % 5) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, day int").repartition(3)
    cut = find_cut(df, "day", "id", 137, rows_per_task=rows_per_task)
    first = sorted(rows, key=lambda r: (r[1], r[0]))[:137]
    got = {r["id"] for r in df.where(is_before(cut, "day", "id")).collect()}
    assert got == {r[0] for r in first}
    assert value_at(df, "day", 10_000) is None


def test_only_groups_too_large_for_a_task_are_cut(spark):
    rows = [("hot", i) for i in range(400)] + [(f"k{i}", (i * 7919) % 400) for i in range(300) for _ in range(3)]
    df = spark.createDataFrame(rows, "key string, at long").repartition(3)
    assert len(heavy_buckets(df, ["key"], 100)) == 1 and heavy_buckets(df.where("key != 'hot'"), ["key"], 100) == []
    blocks = find_blocks(df, "at", rows_per_task=100)
    assert blocks.bounds
    one = {"c": F.lit(1).cast("long")}
    small = running_before(
        df.where("key != 'hot'"), ["key"], "at", one, blocks=blocks, rows_per_task=100, counted=df.where("key != 'hot'")
    )
    assert "__carried" not in small._jdf.queryExecution().toString()
    mixed = running_before(df, ["key"], "at", one, blocks=blocks, rows_per_task=100, counted=df)
    assert mixed.columns == ["key", "at", "c"] and "__carried" in mixed._jdf.queryExecution().toString()
    assert sorted(map(tuple, mixed.collect())) == sorted((k, at, at if k == "hot" else 0) for k, at in rows)
