import random

import pytest
from pyspark.sql import functions as F

from metricloom.operators import correlation, evaluation, splits

PROBE = [(0.9, 1), (0.8, 0), (0.7, 1), (0.7, 0), (0.1, 0), (0.05, 1)]


def _scored(n=600):
    rng = random.Random(1)
    return [(i, 0.5 if i % 3 == 0 else rng.randrange(200) / 200, int(rng.random() < 0.3)) for i in range(n)]


def test_average_precision_and_auc_probe(spark):
    df = spark.createDataFrame(PROBE, "score double, label int")
    assert evaluation.average_precision(df, "score", "label").first()[0] == pytest.approx(0.666667)
    assert evaluation.roc_auc(df, "score", "label").first()[0] == 0.5


@pytest.mark.parametrize("rows_per_task", [25, 10**6])
def test_auc_counts_pairs(spark, rows_per_task):
    rows = _scored()
    df = spark.createDataFrame(rows, "id int, score double, label int")
    pos = [s for _, s, y in rows if y]
    neg = [s for _, s, y in rows if not y]
    wins = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))
    auc = evaluation.roc_auc(df, "score", "label", 9, rows_per_task).first()[0]
    assert auc == pytest.approx(wins, abs=1e-8)
    flipped = evaluation.roc_auc(df.withColumn("score", 1 - F.col("score")), "score", "label", 9).first()[0]
    assert auc + flipped == pytest.approx(1.0, abs=1e-8)
    curve = evaluation.roc_curve(df, "score", "label", rows_per_task).orderBy("threshold").collect()
    assert curve[0]["fpr"] == curve[0]["tpr"] == 1.0
    assert len(curve) == len({s for _, s, _ in rows})
    precision = evaluation.pr_curve(df, "score", "label", rows_per_task).orderBy("threshold").first()
    assert precision["precision"] == pytest.approx(len(pos) / len(rows)) and precision["recall"] == 1.0


def test_metrics_on_degenerate_classes(spark):
    df = spark.createDataFrame([(0.2, 0), (0.4, 0)], "score double, label int")
    df = evaluation.with_prediction(df, "score")
    row = evaluation.classifier_metrics(df, "score", "label", "prediction").first()
    assert (row["accuracy"], row["precision"], row["recall"], row["f1"]) == (1.0, 0.0, 0.0, 0.0)
    assert row["roc_auc"] is None
    assert evaluation.confusion_matrix(df, "label", "prediction").count() == 4
    report = {r["row"]: r for r in evaluation.classification_report(df, "label", "prediction").collect()}
    assert report["0"]["f1"] == 1.0 and report["1"]["support"] == 0


def test_leakage_gap_matches_published_scores(spark):
    """F1 0.5091 against 0.6540 is a gap of 22.2 % of the random score."""
    late = spark.createDataFrame([("boosted", 0.5091)], "model string, f1 double")
    mixed = spark.createDataFrame([("boosted", 0.6540)], "model string, f1 double")
    assert evaluation.leakage_gap(late, mixed).first()["gap_pct"] == pytest.approx(22.16)


def test_splits_are_exact_and_disjoint(spark):
    rows = [(i, int(i % 3 == 0), i // 10) for i in range(1003)]
    df = spark.createDataFrame(rows, "id long, label int, day int").repartition(5)
    for label, want in ((0, 668), (1, 335)):
        n = splits.stratified_split(df, "id", "label").where((F.col("label") == label) & F.col("is_test"))
        assert n.count() == -(-want // 4)
    assert splits.random_split(df, "id").where("is_test").count() == 251
    marked = splits.random_split(df, "id")
    assert marked.count() == 1003 and marked.select("id").distinct().count() == 1003
    other = splits.random_split(df.repartition(2), "id")
    assert set(map(tuple, marked.collect())) == set(map(tuple, other.collect()))
    train, test = splits.temporal_split(df, "day", "id")
    assert train.count() == int(0.75 * 1003)
    assert train.agg(F.max("id")).first()[0] < test.agg(F.min("id")).first()[0]
    folds = splits.stratified_folds(df, "id", "label").groupBy("label", "fold").count().collect()
    for label in (0, 1):
        sizes = [r["count"] for r in folds if r["label"] == label]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1


def test_small_strata(spark):
    df = spark.createDataFrame([(1, 0), (2, 1), (3, 1)], "id long, label int")
    marked = splits.stratified_split(df, "id", "label").collect()
    assert len(marked) == 3 and sum(r["is_test"] for r in marked) == 2


@pytest.mark.parametrize("rows_per_task", [20, 10**6])
def test_spearman_is_pearson_of_average_ranks(spark, rows_per_task):
    import pandas as pd

    rng = random.Random(9)
    rows = [(0.0 if i % 3 == 0 else rng.random(), float(rng.randrange(6)),
             None if i % 7 == 0 else rng.gauss(0, 1)) for i in range(300)]
    frame = pd.DataFrame(rows, columns=["a", "b", "c"])
    df = spark.createDataFrame(rows, "a double, b double, c double")

    def check(table, want):
        for r in table.collect():
            assert r["r"] == pytest.approx(want.loc[r["x"], r["y"]], abs=1e-9), r

    cols = ["a", "b", "c"]
    ranks = frame.dropna().rank()
    check(correlation.spearman_matrix(df, cols, digits=None, rows_per_task=rows_per_task), ranks.corr())
    if rows_per_task > 20:
        pairwise = frame.corr(method=lambda x, y: pd.Series(x).rank().corr(pd.Series(y).rank()))
        check(correlation.spearman_matrix(df, cols, "pairwise", digits=None), pairwise)
        check(correlation.pearson_matrix(df, cols, digits=None), frame.corr())
        check(correlation.pearson_matrix(df, cols, "listwise", digits=None), frame.dropna().corr())


def test_constant_column_has_no_correlation(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0), (4.0, 2.0)], "a double, k double")
    cells = {(r["x"], r["y"]): r["r"] for r in correlation.pearson_matrix(df, ["a", "k"]).collect()}
    assert cells["a", "k"] is None and cells["a", "a"] == 1.0
    summary = correlation.pair_summary(df, [("a", "k")]).first()
    assert summary["r"] is None and summary["slope"] == 0.0


def test_notable_pairs_orders(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 2.1), (3.0, 2.9), (4.0, 4.2)], "z double, a double")
    assert correlation.notable_pairs(df, ["z", "a"]).first()["x"] == "a"
    row = correlation.notable_pairs(df, ["z", "a"], order="column").first()
    assert (row["x"], row["strength"]) == ("z", "strong")


def test_pair_summary_p(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 1.0), (3.0, 4.0), (4.0, 3.0)], "x double, y double")
    row = correlation.pair_summary(df, [("x", "y")]).first()
    assert row["r"] == 0.6 and row["p"] == pytest.approx(0.4, abs=1e-9) and row["stars"] == ""
    assert row["slope"] == 0.6 and row["rho"] == 0.6


def test_temporal_split_keeps_rows_without_a_date(spark):
    rows = [(i, None if i % 5 == 0 else i // 2) for i in range(40)]
    df = spark.createDataFrame(rows, "id long, day long").repartition(3)
    train, test = splits.temporal_split(df, "day", "id")
    assert train.count() + test.count() == 40 and train.count() == 30
    assert test.where("day is null").count() == 0


def test_stored_split_marks_the_same_rows_and_hashes_once(spark):
    """With stored rows no later pass computes the hash; repeated and missing keys are marked alike."""
    keys = [None if i % 90 == 0 else i // 2 for i in range(1_001)]
    df = spark.createDataFrame([(k, float(i)) for i, k in enumerate(keys)], "id long, x double")
    plain, stored = splits.random_split(df, "id"), splits.random_split(df, "id", stored=True)
    assert "md5" in plain._jdf.queryExecution().optimizedPlan().toString()
    assert "md5" not in stored._jdf.queryExecution().optimizedPlan().toString()
    assert stored.columns == plain.columns and stored.where("is_test").count() == 251
    marks = [sorted((r["id"] is None, r["id"] or 0, r["is_test"]) for r in x.collect()) for x in (plain, stored)]
    assert marks[0] == marks[1]
