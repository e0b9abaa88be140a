import numpy as np
import pytest
from pyspark.sql import functions as F

from metricloom.operators import learners, linear_models as lm
from metricloom.plans import risk
from metricloom.plans.risk import compare_models
from metricloom.session import scratch_path

RNG = np.random.default_rng(11)
N = 240
X = RNG.normal(size=(N, 2)) * [2.0, 5.0] + [1.0, -3.0]
Y = 1.5 + X @ [2.0, -0.5] + RNG.normal(size=N)
B = (X @ [1.0, -0.3] + RNG.logistic(size=N) > 2).astype(int)


@pytest.fixture(scope="module")
def data(spark):
    rows = [(i, float(a), float(b), float(y), int(z)) for i, ((a, b), y, z) in enumerate(zip(X, Y, B))]
    return spark.createDataFrame(rows, "id long, a double, b double, y double, label int").cache()


def test_ols_matches_normal_equations(data):
    design = np.column_stack([X, np.ones(N)])
    beta, *_ = np.linalg.lstsq(design, Y, rcond=None)
    resid = Y - design @ beta
    se = np.sqrt(resid @ resid / (N - 3) * np.diag(np.linalg.inv(design.T @ design)))
    rows = {r["term"]: r for r in lm.ols_summary(data, "y", ["a", "b"]).collect()}
    for i, term in enumerate(["a", "b", "const"]):
        assert rows[term]["coefficient"] == pytest.approx(beta[i], rel=1e-6)
        assert rows[term]["std_error"] == pytest.approx(se[i], rel=1e-6)
    quality = lm.ols_fit_quality(data, "y", ["a", "b"], digits=9).first()
    assert quality["rmse"] == pytest.approx(np.sqrt(np.mean(resid**2)), abs=1e-6)
    left = lm.residuals(data, "y", ["a", "b"], ["id"]).agg(F.sum("residual")).first()[0]
    assert abs(left) < 1e-6


def test_nested_models_improve(data):
    base, more = lm.nested_models(data, "y", ["a"], ["b"]).collect()
    assert more["r2"] > base["r2"]


def test_vif_is_the_auxiliary_regression(data):
    df = data.withColumn("c", F.col("a") + 0.3 * F.col("b") + F.sin("id"))
    m = np.array([tuple(r) for r in df.select("a", "b", "c").collect()])
    got = {r["variable"]: r["vif"] for r in lm.vif(df, ["a", "b", "c"], constant=True).collect()}
    for i, name in enumerate("abc"):
        others = np.column_stack([np.delete(m, i, axis=1), np.ones(N)])
        fit = others @ np.linalg.lstsq(others, m[:, i], rcond=None)[0]
        r2 = 1 - ((m[:, i] - fit) ** 2).sum() / ((m[:, i] - m[:, i].mean()) ** 2).sum()
        assert got[name] == pytest.approx(1 / (1 - r2), rel=1e-6)
    fit = m @ np.linalg.lstsq(m, np.ones(N), rcond=None)[0]
    assert got["const"] == pytest.approx(N / ((1 - fit) ** 2).sum(), rel=1e-6)


def test_logit_is_the_maximum(data):
    rows = {r["term"]: r for r in lm.logit_summary(data, "label", ["a", "b"]).collect()}
    beta = np.array([rows[t]["coefficient"] for t in ("a", "b", "const")])
    design = np.column_stack([X, np.ones(N)])
    p = 1 / (1 + np.exp(-design @ beta))
    assert np.abs(design.T @ (B - p)).max() < 1e-5
    cov = np.linalg.inv(design.T @ (design * (p * (1 - p))[:, None]))
    assert rows["a"]["std_error"] == pytest.approx(np.sqrt(cov[0, 0]), rel=1e-4)
    odds = {r["term"]: r["odds_ratio"] for r in lm.odds_ratios(data, "label", ["a", "b"]).collect()}
    assert odds["a"] == pytest.approx(np.exp(beta[0]), abs=1e-4)


def test_logit_agrees_with_plain_newton_steps_at_bad_scales(spark):
    rng = np.random.default_rng(3)
    x = np.column_stack([rng.normal(5e6, 3.0, 500), rng.exponential(1e-4, 500)])
    centred = (x - x.mean(0)) / x.std(0)
    y = (centred @ [0.8, -0.5] + rng.logistic(size=500) > 1).astype(float)
    rows = [(float(a), float(b), float(z), None) for (a, b), z in zip(x, y)]
    df = spark.createDataFrame([*rows, (None, 1.0, 1.0, None), (1.0, 1.0, None, None)], "a double, b double, y double, e double")
    fit = lm.fit_logit(df, "y", ["a", "b"])
    design, beta = np.column_stack([centred, np.ones(500)]), np.zeros(3)
    for _ in range(30):
        p = 1 / (1 + np.exp(-design @ beta))
        information = design.T @ (design * (p * (1 - p))[:, None])
        beta += np.linalg.solve(information, design.T @ (y - p))
    error = np.sqrt(np.diag(np.linalg.inv(information)))
    assert (fit.state, fit.n) == ("converged", 500)
    assert fit.coefficients[:2] * x.std(0) == pytest.approx(beta[:2], rel=1e-7)
    assert fit.errors[:2] * x.std(0) == pytest.approx(error[:2], rel=1e-7)
    assert fit.log_likelihood == pytest.approx((y * np.log(p) + (1 - y) * np.log(1 - p)).sum(), rel=1e-9)


def test_logit_states(spark):
    schema = "x double, z double, y int"
    apart = spark.createDataFrame([(float(i), float(i % 3), int(i > 20)) for i in range(40)], schema)
    cases = {
        "separated": (apart, ["x"]),
        # One value of a predictor has a single class, the rest overlap.
        "quasi": (spark.createDataFrame([(float(i % 2), 0.0, int(i % 2 or i % 4 == 2)) for i in range(40)], schema), ["x"]),
        "collinear": (apart.withColumn("w", F.col("x") * 2 - F.col("z")), ["x", "z", "w"]),
        "constant": (apart.withColumn("w", F.lit(7.5)), ["z", "w"]),
        "one class": (apart.where("y = 1"), ["x"]),
        "no rows": (apart.where("y > 1"), ["x"]),
    }
    states = {"quasi": "separated", "constant": "collinear"}
    for name, (df, xs) in cases.items():
        rows = lm.logit_summary(df, "y", xs).collect()
        assert [r["term"] for r in rows] == [*xs, "const"]
        assert {r["state"] for r in rows} == {states.get(name, name)}
        assert all(r["coefficient"] is None and r["p"] is None for r in rows)
        assert lm.odds_ratios(df, "y", xs).where("odds_ratio IS NOT NULL").isEmpty()
    with pytest.raises(ValueError, match="between 0 and 1"):
        lm.fit_logit(apart.withColumn("y", F.col("x")), "y", ["z"])


def test_penalised_logistic_has_zero_gradient(data):
    model = learners.LogisticBaseline(["a", "b"]).fit(data).model
    z = (X - X.mean(0)) / X.std(0)
    w = np.where(B == 1, N / (2 * B.sum()), N / (2 * (N - B.sum())))
    coef = model.coefficients.toArray()
    p = 1 / (1 + np.exp(-(z @ coef + model.intercept)))
    assert np.abs(z.T @ (w * (p - B)) + coef).max() < 1e-3
    assert abs((w * (p - B)).sum()) < 1e-3


def test_ridge_closed_form(data):
    model = learners.RidgeRegression(["a", "b"], "y", alpha=7.0).fit(data).model
    z = (X - X.mean(0)) / X.std(0)
    beta = np.linalg.solve(z.T @ z + 7.0 * np.eye(2), z.T @ (Y - Y.mean()))
    assert model.coefficients.toArray() == pytest.approx(beta, rel=1e-8)


def test_trees_importances_and_split_counts(data):
    forest = learners.TreeClassifier("forest", ["a", "b"], trees=5, depth=4).fit(data)
    shares = learners.feature_importance(forest.model).collect()
    assert sum(r["importance"] for r in shares) == pytest.approx(1.0)
    assert shares[0]["importance"] >= shares[1]["importance"]
    boosted = learners.TreeClassifier("boosted_leafwise", ["a", "b"], rounds=3, leaves=7).fit(data)
    counts = learners.split_counts(boosted.model).collect()
    assert sum(r["importance"] for r in counts) == sum((len(t.left) - 1) // 2 for t in boosted.model.trees)


def test_search_space_sizes():
    sizes = {k: len(learners.draw_settings(k, 10_000)) for k in learners.SEARCH_SPACES}
    assert sizes == {"forest": 72, "boosted": 243, "boosted_leafwise": 243}
    assert learners.draw_settings("forest") == learners.draw_settings("forest")


@pytest.mark.parametrize("margin", [None, 0.0, 0.5])
def test_random_search_picks_the_best_mean(data, margin):
    space = {"trees": [3], "depth": [1, 4], "min_leaf": [1, 2], "columns": ["all"]}
    model, best, table = learners.random_search(data, "forest", ["a", "b"], "id", folds=3, space=space, margin=margin)
    rows = table.collect()
    whole = [r for r in rows if r["folds"] == 3]
    top = max(whole, key=lambda r: r["roc_auc"])
    assert top["best"] and sum(r["best"] for r in rows) == 1 and len(rows) == 4
    assert str(best) in {r["settings"] for r in whole if r["roc_auc"] == top["roc_auc"]}
    assert len(model.model.trees) == 3
    assert (len(whole) == 4) if margin in (None, 0.5) else (len(whole) >= 1)


def test_search_repeats(data):
    space = {"rounds": [4], "leaves": [3, 5], "rate": [0.3], "rows": [0.7], "columns": [1.0]}
    one, two = (
        learners.random_search(data.repartition(n), "boosted_leafwise", ["a", "b"], "id", folds=3, space=space)
        for n in (2, 5)
    )
    assert one[2].collect() == two[2].collect() and one[1] == two[1]
    assert [t.value.tolist() for t in one[0].model.trees] == [t.value.tolist() for t in two[0].model.trees]


def test_comparison_refuses_a_single_class(data):
    with pytest.raises(ValueError):
        compare_models(data.where("label = 0"), data, ["a", "b"], {})
    table = compare_models(data.where("id < 180"), data.where("id >= 180"), ["a", "b"], {})
    row = table.first()
    assert row["model"] == "logistic" and row["roc_auc"] > 0.7


def test_scoring_rounds(data):
    model = learners.ForestRegression(["a", "b"], "y", trees=3, depth=3).fit(data)
    values = [r["estimate"] for r in learners.score_batch(model, data, ["id"]).collect()]
    assert all(v == round(v, 2) for v in values) and len(values) == N


def test_collinear_predictors_have_infinite_inflation(spark):
    rows = [(float(i), 2.0 * i, float(i * i % 7)) for i in range(30)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    got = {r["variable"]: r["vif"] for r in lm.vif(df, ["a", "b", "c"]).collect()}
    assert got["a"] == got["b"] == float("inf") and 1 <= got["c"] < 2


def test_nested_models_use_the_same_rows(spark):
    rows = [(float(i), float(3 * i + i % 3), None if i % 4 == 0 else float(i % 5)) for i in range(40)]
    df = spark.createDataFrame(rows, "x double, y double, z double")
    assert {r["n"] for r in lm.nested_models(df, "y", ["x"], ["z"]).collect()} == {30}


def test_depth_is_checked():
    assert learners.forest_trial(9, depth=None).how.depth is None
    with pytest.raises(ValueError):
        learners.forest_trial(9, depth=0)
    assert [learners.tried_columns(c, 16) for c in ("sqrt", "log2", "onethird", "all", 3)] == [4, 4, 5, None, 3]


def test_registered_learners_use_the_defaults(monkeypatch):
    """Only the settings are looked at; nothing is fitted."""
    import inspect

    from metricloom.operators import learners
    from metricloom.plans import registry

    asked = []

    def kept(name):
        def run(*args, **kwargs):
            asked.append((name, args[0], kwargs))
            raise StopIteration

        return run

    names = ("TreeClassifier", "ForestRegression")
    monkeypatch.setattr(registry, "_holdout", lambda *_: ("train", "test"))
    monkeypatch.setattr(registry, "_regression_split", lambda *_: ("train", "test"))
    monkeypatch.setattr(learners.ForestRegression, "plain", kept("plain"))
    plain = learners.ForestRegression.plain
    for name in (*names, "random_search"):
        monkeypatch.setattr(learners, name, kept(name))
    learners.ForestRegression.plain = plain
    queries = (
        "train_rf", "train_gbt", "train_gbt_leaf", "train_rf_regressor", "feature_importance",
        "feature_split_counts", "top_importance", "random_search", "score_batch",
    )
    for q in queries:
        try:
            registry.QUERIES[q](None, None)
        except StopIteration:
            pass
    assert len(asked) == len(queries)
    assert not any(set(k) & {"trees", "rounds", "depth", "leaves", "draws", "folds", "space"} for _, _, k in asked)
    assert set(registry.TREE_MODELS) == {"forest", "boosted", "boosted_leafwise"}
    assert not any(registry.TREE_MODELS.values())
    for q in ("model_comparison", "risk_end_to_end", "risk_tuned", "risk_leakage"):
        assert "TREE_MODELS" in inspect.getsource(registry.QUERIES[q])


def test_models_of_a_split_are_fitted_side_by_side(spark, monkeypatch):
    import threading

    together = threading.Barrier(2)

    def waiting(fit):
        def run(*args, **kwargs):
            together.wait(timeout=120)  # breaks if one fit only begins after the other
            return fit(*args, **kwargs)

        return run

    for kind in (learners.LogisticBaseline, learners.TreeClassifier):
        monkeypatch.setattr(kind, "fit", waiting(kind.fit))
    rows = spark.range(400).select(
        "id", (F.col("id") % 17).cast("double").alias("x"), ((F.col("id") % 17) + (F.col("id") % 3) > 9).cast("int").alias("label")
    )
    train, test = rows.where("id % 4 > 0"), rows.where("id % 4 = 0")
    found = risk.fit_and_compare(train, test, ["x"], {"forest": {"trees": 3}})
    assert sorted(r["model"] for r in found.metrics.collect()) == ["forest", "logistic"]
    assert [r["feature"] for r in found.importances.collect()] == ["x"]


def _searchable(spark, n):
    x = F.xxhash64("id") % 1000 / 100.0
    return spark.range(n).select(
        "id", x.alias("a"), (F.col("id") % 9).cast("double").alias("b"),
        ((x + F.col("id") % 9 + F.xxhash64("id", F.lit(1)) % 5) > 4).cast("int").alias("label"),
    )


def test_a_search_fits_on_all_rows(spark, monkeypatch):
    from metricloom.operators import learners, trees

    seen, plain = [], trees.fold_scores
    monkeypatch.setattr(trees, "fold_scores", lambda table, *rest: seen.append(table.count()) or plain(table, *rest))
    space = {"rounds": [2], "depth": [2], "rate": [0.1, 0.3]}
    learners.random_search(_searchable(spark, 5_600), "boosted", ["a", "b"], "id", folds=2, space=space)
    assert seen == [5_600]


@pytest.mark.parametrize(("kind", "space"), [
    ("boosted", {"rounds": [2], "depth": [2], "rate": [0.1, 0.3], "rows": [1.0], "columns": [1.0]}), ("forest", {"trees": [3], "depth": [3, 4], "columns": ["all"]}),
])
def test_fits_of_a_search_whose_rows_exceed_a_task(spark, monkeypatch, kind, space):
    from metricloom.operators import learners, trees

    data = _searchable(spark, 1_500)
    want = {r["settings"]: r["roc_auc"] for r in learners.random_search(data, kind, ["a", "b"], "id", folds=2, space=space)[2].collect()}
    monkeypatch.setattr(trees, "TASK_ROWS", 400)
    got = {r["settings"]: r["roc_auc"] for r in learners.random_search(data, kind, ["a", "b"], "id", folds=2, space=space)[2].collect()}
    assert got == pytest.approx(want, abs=1e-4 if kind == "boosted" else 0.03)
