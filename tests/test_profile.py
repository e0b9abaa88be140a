import numpy as np
import pytest
from pyspark.sql import functions as F

from metricloom.functions.scalars import half_even
from metricloom.operators import profile


def test_rounding_is_half_even(spark):
    df = spark.createDataFrame([(-19.125,), (47.875,), (0.5,), (1.5,)], "x double")
    two = [r[0] for r in df.select(half_even(F.col("x"), 2)).collect()]
    assert two[:2] == [-19.12, 47.88]
    assert [r[0] for r in df.select(half_even(F.col("x"), 0)).collect()][2:] == [0.0, 2.0]


@pytest.mark.parametrize("bracket,accuracy,rows_per_task", [
    (0.5, 10_000, 10**6), (0.02, 10_000, 10**6), (0.02, 10_000, 60), (1e-9, 5, 10**6), (1e-4, 20, 60),
])
def test_exact_quantiles_on_ties_and_gaps(spark, monkeypatch, bracket, accuracy, rows_per_task):
    """Through brackets that hold, and through ones of coarse sketches that miss and are widened."""
    monkeypatch.setattr(profile, "_BRACKET", bracket)
    monkeypatch.setattr(profile, "_ACCURACY", accuracy)
    asked, plain = [], profile._brackets
    monkeypatch.setattr(profile, "_brackets", lambda *a: asked.append(a[3]) or plain(*a))
    rng = np.random.default_rng(5)
    a = np.where(np.arange(3001) % 3 == 0, 7.0, rng.normal(size=3001) * 10)
    b = rng.integers(0, 12, size=3001).astype(float)
    rows = [(float(x), None if i % 10 == 0 else float(y)) for i, (x, y) in enumerate(zip(a, b))]
    df = spark.createDataFrame(rows, "a double, b double").repartition(4)
    probs = {"p5": 0.05, "q1": 0.25, "m": 0.5, "p99": 0.99, "top": 1.0}
    got = profile.quantile_values(df, ["a", "b"], probs, rows_per_task)
    b_present = np.array([y for _, y in rows if y is not None])
    for name, p in probs.items():
        assert got["a"][name] == pytest.approx(np.quantile(a, p), abs=1e-9)
        assert got["b"][name] == pytest.approx(np.quantile(b_present, p), abs=1e-9)
    assert (len(asked) > 1) == (accuracy < 100)


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None, 1.0)], "a double, b double")
    assert profile.quantile_values(df, ["a", "b"], {"m": 0.5}) == {"b": {"m": 1.0}}
    assert profile.quantile_table(df.limit(0), ["a", "b"], {"m": 0.5}).collect() == []


def test_mode_ties(spark):
    df = spark.createDataFrame([(3.0, 0), (3.0, 1), (1.0, 2), (1.0, 3), (2.0, 4)], "x double, at int")
    assert profile.central_tendency(df, ["x"]).first()["mode"] == 1.0
    assert profile.central_tendency(df, ["x"], "at").first()["mode"] == 3.0


def test_adjusted_skew_and_describe(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (10.0,), (4.0,)], "x double")
    row = profile.describe_with_skew(df, ["x"], digits=12).first()
    assert row["skew"] == pytest.approx(1.469334548210623, abs=1e-11)
    assert (row["count"], row["min"], row["max"], row["p50"]) == (4, 1.0, 10.0, 3.0)


def test_constant_column_does_not_break_profiles(spark):
    df = spark.createDataFrame([(5.0, None)] * 4, "c double, e double")
    assert profile.describe_with_skew(df, ["c"]).first()["skew"] == 0.0
    assert profile.histogram(df, ["c"], 4).where("n > 0").collect()[0]["n"] == 4
    assert profile.dispersion(df, ["c", "e"]).count() == 2
    assert profile.outlier_fences(df, ["c"]).first()["n_high"] == 0
    assert profile.kde_curve(df, ["c"], 5).count() == 0


def test_skew_and_cv_classes(spark):
    df = spark.createDataFrame([(0.0, 10.0), (0.0, 10.5), (9.0, 11.0)], "a double, b double")
    skew = {r["variable"]: r["skew_class"] for r in profile.skew_class(df, ["a", "b"]).collect()}
    assert skew == {"a": "strong right skew", "b": "symmetric"}
    cv = {r["variable"]: r["cv_class"] for r in profile.cv_class(df, ["a", "b"]).collect()}
    assert cv == {"a": "extreme", "b": "low"}


def test_top_extremes_use_the_rounded_fence(spark):
    values = [1.0, 2.0, 3.0, 4.0, 100.0, 50.0]
    df = spark.createDataFrame(list(enumerate(values)), "id int, x double")
    got = [r["id"] for r in profile.top_extremes(df, "x", ["id", "x"], ["id"], 1).collect()]
    q1, q3 = np.quantile(values, [0.25, 0.75])
    assert got == ([4] if 100 > round(q3 + 1.5 * (q3 - q1), 2) else [])


def test_density_integrates_to_one(spark):
    rng = np.random.default_rng(1)
    df = spark.createDataFrame([(float(x),) for x in rng.normal(size=400)], "x double")
    for options in ({}, {"cells": 400}, {"bandwidth": "nrd0", "cells": 400}):
        rows = profile.kde_curve(df, ["x"], 200, cut=4.0, **options).orderBy("point").collect()
        step = rows[1]["x"] - rows[0]["x"]
        assert sum(r["density"] for r in rows) * step == pytest.approx(1.0, abs=0.01)


def test_density_window_and_cells_keep_their_error_bounds(spark):
    rng = np.random.default_rng(4)
    x = np.round(np.concatenate([rng.normal(0, 1, 500), rng.normal(60, 0.5, 300), [800.0]]), 3)
    df = spark.createDataFrame([(float(v), None) for v in x] + [(None, None)], "x double, e double")
    h = x.std(ddof=1) * len(x) ** -0.2
    grid = np.linspace(x.min() - 4 * h, x.max() + 4 * h, 300)
    plain = np.exp(-0.5 * ((grid[:, None] - x) / h) ** 2).sum(1) / (len(x) * h * np.sqrt(2 * np.pi))
    assert (plain < 1e-12).any()  # points that no value reaches are listed too
    for cells in (None, 50, 400):
        rows = profile.kde_curve(df, ["x", "e"], 300, cut=4.0, cells=cells).orderBy("point").collect()
        assert [r["point"] for r in rows] == list(range(300))
        width = (x.max() - x.min()) / (cells - 1) if cells else 0.0
        bound = width**2 / (8 * np.sqrt(2 * np.pi) * h**3) + 1e-16 / h + 5e-9
        assert max(abs(r["density"] - p) for r, p in zip(rows, plain)) <= bound


def test_published_table_relations():
    """Rows of published result tables must be consistent with the rules used here."""
    q1, q3 = 6.0, 22.75
    iqr = q3 - q1
    assert profile.round_literal(q1 - 1.5 * iqr, 2) == -19.12
    assert profile.round_literal(q3 + 1.5 * iqr, 2) == 47.88
    for p, r, f1 in (
        (.3440, .9152, .5000), (.3848, .8329, .5264), (.3547, .9015, .5091), (.3611, .8835, .5127),
        (.5113, .8583, .6408), (.5834, .7198, .6445), (.5495, .8075, .6540), (.5400, .8053, .6465),
    ):
        assert 2 * p * r / (p + r) == pytest.approx(f1, abs=2e-4)
    assert int(0.75 * 31_492) == 23_619
