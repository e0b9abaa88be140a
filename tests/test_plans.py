"""The physical plans are the ones meant: no pair-wise joins, filters at the scan."""

import re

import pytest
from pyspark.sql import functions as F

from metricloom.operators import correlation, evaluation, history, profile, splits
from metricloom.operators.ordered import running_before
from metricloom.plans import registry, roles
from tests.conftest import SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


NESTED = re.compile(r"CartesianProduct|BroadcastNestedLoopJoin")


@pytest.fixture(scope="module")
def orders(spark):
    day = F.unix_date(F.col("o_orderdate").cast("date"))
    return roles.table(spark, SMALL, "orders").select("o_orderkey", "o_orderstatus", day.alias("day"))


def test_no_pairwise_joins(spark, orders):
    scored = roles.scored(spark, SMALL)
    frames = [
        splits.stratified_split(scored, "id", "label"),
        splits.random_split(scored, "id"),
        splits.stratified_folds(scored, "id", "label"),
        running_before(
            orders, ["o_orderstatus"], "o_orderkey", {"c": F.lit(1).cast("long")}, rows_per_task=100
        ),
        running_before(orders, [], "o_orderkey", {"c": F.lit(1).cast("long")}, rows_per_task=100),
        correlation.average_ranks(scored.select("score"), ["score"], rows_per_task=100),
        evaluation.classifier_metrics(
            evaluation.with_prediction(scored, "score"), "score", "label", "prediction"
        ),
        profile.histogram(roles.metric_table(spark, SMALL), roles.METRICS),
        history.change_features(roles.change_log(spark, SMALL), registry.AS_OF),
    ]
    for df in frames:
        assert not NESTED.search(plan(df))


def test_temporal_cut_is_a_row_filter_without_shuffle(orders):
    train, test = splits.temporal_split(orders, "day", "o_orderkey")
    for side in (train, test):
        text = plan(side)
        assert "Exchange" not in text and "Window" not in text


def test_extremes_reach_the_scan_as_a_literal(spark):
    log = roles.commit_log(spark, SMALL)
    text = plan(profile.top_extremes(log, "churn", ["hash", "churn"], ["hash"]))
    assert "GreaterThan(value," in text and "TakeOrderedAndProject" in text
    assert "props" not in re.search(r"ReadSchema: .*", text).group(0)


def test_file_history_uses_one_shuffle_per_grouping(spark):
    changes = roles.table(spark, SMALL, "lineitem").select(
        F.col("l_returnflag").alias("repo"), F.col("l_orderkey").alias("hash"),
        F.col("l_orderkey").alias("commit_seq"), F.col("l_suppkey").cast("string").alias("author"),
        F.col("l_shipdate").cast("timestamp").alias("committer_date"),
        F.col("l_partkey").cast("string").alias("path"), F.lit(False).alias("merge"),
    )
    touches = history._touches(changes)
    text = plan(history._file_history(touches, history.Blocks()))
    assert len(re.findall(r"Exchange ", text)) == 1


def test_no_row_window_in_one_task(orders):
    """An order without groups is cut into blocks; only their totals meet in one task."""
    text = plan(running_before(orders, [], "o_orderkey", {"c": F.lit(1).cast("long")}, rows_per_task=100))
    rows = [part for part in text.split("Window")[1:] if "SinglePartition" in part.split("Window")[0]]
    assert len(rows) == 1 and "__t_c" in rows[0]
    keyed = plan(running_before(
        orders, ["o_orderstatus"], "o_orderkey", {"c": F.lit(1).cast("long")}, rows_per_task=100
    ))
    assert "SinglePartition" not in keyed and "Broadcast" not in keyed


def test_a_change_log_is_dealt_by_its_rows(spark, monkeypatch):
    """Grouped by change, no task holds more file rows than the bound, however small they are in bytes."""
    rows = spark.read.parquet(f"{SMALL}/lineitem.parquet").count()
    monkeypatch.setattr(roles, "FILES_PER_TASK", 200)
    found = history.diffusion(roles.change_log(spark, SMALL, by_change=True))
    assert found.rdd.getNumPartitions() >= rows / 200
    plain = history.diffusion(roles.change_log(spark, SMALL))
    assert sorted(found.collect()) == sorted(plain.collect())
