import math
from statistics import NormalDist

import numpy as np
import pytest
from pyspark.sql import functions as F

from metricloom.functions import distributions as dist
from metricloom.operators import normality


def test_normal_functions(spark):
    xs = [-38.0, -8.0, -3.1, -1.0, -0.2, 0.0, 0.7, 2.5, 7.5, 12.0]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    for x, got in zip(xs, df.select(dist.normal_cdf(F.col("x"))).collect()):
        assert got[0] == pytest.approx(NormalDist().cdf(x), abs=1e-14)
    ps = [1e-12, 1e-5, 0.01, 0.3, 0.5, 0.8, 0.999, 1 - 1e-9]
    df = spark.createDataFrame([(p,) for p in ps], "p double")
    for p, got in zip(ps, df.select(dist.normal_ppf(F.col("p"))).collect()):
        assert got[0] == pytest.approx(NormalDist().inv_cdf(p), rel=1e-12, abs=1e-12)
    assert dist.normal_ppf_array(np.array(ps)) == pytest.approx([NormalDist().inv_cdf(p) for p in ps])


def test_student_t():
    # closed forms for one and two degrees of freedom
    for t in (0.0, 0.5, 2.0, 30.0):
        assert dist.t_two_sided(t, 1) == pytest.approx(1 - 2 / math.pi * math.atan(t), abs=1e-12)
        assert dist.t_two_sided(t, 2) == pytest.approx(1 - t / math.sqrt(2 + t * t), abs=1e-12)
    assert dist.t_two_sided(1.96, 1e7) == pytest.approx(0.05, abs=1e-5)


# Published statistics (4 decimals) of ten columns with 1,154 values: W, its p, D, its p
# with known and with estimated parameters.
PUBLISHED = [
    (0.4297, 4.6759e-51, 0.3085, 5.1931e-98, 1.4026e-314),
    (0.5097, 1.2601e-48, 0.2333, 1.0390e-55, 1.0161e-177),
    (0.6657, 9.6579e-43, 0.3789, 2.1712e-149, 0.0),
    (0.5295, 5.6566e-48, 0.2759, 3.9829e-78, 1.8118e-250),
    (0.3526, 3.8475e-53, 0.3534, 1.9449e-129, 0.0),
]


def test_published_p_values(spark):
    df = spark.createDataFrame([(d, 1154) for _, _, d, _, _ in PUBLISHED], "d double, n long")
    corrected = [r[0] for r in df.select(dist.lilliefors_p(F.col("d"), F.col("n"))).collect()]
    for (w, sw_p, d, ks_p, lf_p), mine in zip(PUBLISHED, corrected):
        assert math.log10(dist.shapiro_p(w, 1154)) == pytest.approx(math.log10(sw_p), abs=0.02)
        assert math.log10(dist.ks_two_sided(d, 1154)) == pytest.approx(math.log10(ks_p), abs=0.1)
        if lf_p > 1e-300:
            assert math.log10(mine) == pytest.approx(math.log10(lf_p), abs=0.3)
        else:
            assert mine < 1e-300


def test_shapiro_properties():
    # Published example: weights of eleven men.
    men = np.array([148, 154, 158, 160, 161, 162, 166, 170, 182, 195, 236.0])
    w, p = dist.shapiro(men)
    assert w == pytest.approx(0.7888, abs=1e-3) and p == pytest.approx(0.0067, abs=5e-4)
    rng = np.random.default_rng(0)
    x = rng.normal(size=200)
    w, p = dist.shapiro(x)
    assert w > 0.98 and p > 0.05
    assert dist.shapiro(3 - 2 * x)[0] == pytest.approx(w, abs=1e-12)
    weights = dist.shapiro_weights(50)
    assert weights == pytest.approx(-weights[::-1]) and weights @ weights == pytest.approx(1, abs=1e-6)
    assert dist.shapiro(np.array([1.0, 2.0])) == (None, None)


def test_kolmogorov_branches_agree():
    # one observation: P(D >= d) = 2 - 2d for d >= 1/2
    assert dist.ks_two_sided(0.7, 1) == pytest.approx(0.6, abs=1e-12)
    n, d = 400, math.sqrt(2.2 / 400)
    assert 1 - dist._ks_matrix(d, n) == pytest.approx(2 * dist._one_sided_tail(d, n), rel=1e-3)
    assert dist.ks_two_sided(0.008, 10_001) == pytest.approx(dist._kolmogorov_series(0.8 * 1.00005), rel=1e-3)


@pytest.mark.parametrize("rows_per_task", [30, 10**6])
def test_ks_statistic_by_hand(spark, rows_per_task):
    rng = np.random.default_rng(2)
    x = np.where(np.arange(300) % 3 == 0, 1.0, rng.exponential(size=300))
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    z = np.sort((x - x.mean()) / x.std(ddof=1))
    cdf = np.array([NormalDist().cdf(v) for v in z])
    i = np.arange(1, 301)
    d = max((i / 300 - cdf).max(), (cdf - (i - 1) / 300).max())
    got = normality.ks_statistic(df, ["x"], rows_per_task).first()
    assert got["d"] == pytest.approx(d, abs=1e-12) and got["n"] == 300


def test_qq_points_number_every_row(spark, monkeypatch):
    monkeypatch.setattr(normality, "_CHUNK", 7)
    x = [1.0] * 50 + [2.0, 3.0, 3.0] + [0.5] * 7
    df = spark.createDataFrame([(v,) for v in x], "x double")
    points = normality.qq_points(df, ["x"]).orderBy("i").collect()
    assert [p["i"] for p in points] == list(range(1, 61))
    assert [p["value"] for p in points] == sorted(x)
    assert points[0]["theoretical"] == pytest.approx(-points[-1]["theoretical"])


def test_shapiro_reads_all_rows(spark):
    rng = np.random.default_rng(4)
    for n in (2, 3, 4, 5, 6, 11, 12, 300, 6_000):
        x = np.round(rng.normal(size=n), 2 if n > 12 else 6)
        df = spark.createDataFrame([(float(v),) for v in x] + [(None,)], "x double").repartition(6)
        got = normality.shapiro_wilk(df, ["x"]).first()
        w, p = dist.shapiro(x)
        assert got["n"] == n and got["p_valid"] == (3 <= n <= 5_000)
        assert (got["w"], got["p"]) == (None, None) if n < 3 else got["w"] == pytest.approx(w, abs=1e-9)
        assert n < 3 or got["p"] == pytest.approx(p, rel=1e-5, abs=1e-12)
    x[-1] = 40.0
    far = spark.createDataFrame([(float(v),) for v in x], "x double")
    assert normality.shapiro_wilk(far, ["x"]).first()["w"] < w - 0.01


def test_sums_over_stretches_of_ranks_equal_the_single_ranks(spark):
    """Ties of 1 to 30,000 values, also across the ends, against scores added up one by one."""
    counts = [1, 3, 40, 900, 300, 17, 16, 5_000, 1, 30_000, 2_000, 700, 500, 2, 1]
    samples, rows = [counts, counts[:4], [20_000], [1, 2_500], [1_500, 1_600]], []
    for k, some in enumerate(samples):
        starts = np.cumsum([0, *some]).tolist()
        rows += [(str(k), float(v), n, starts[v], starts[-1]) for v, n in enumerate(some)]
    ranked = spark.createDataFrame(rows, "variable string, value double, n long, start long, size long")
    got = normality._score_sums(normality._stretches(ranked)).groupBy("variable", "value", "n", "start", "size").agg(
        F.sum("scores").alias("a"), F.sum("squares").alias("b"), F.sum(F.col("until") - F.col("since")).alias("ranks"),
        F.count(F.lit(1)).alias("parts"),
    ).collect()
    assert len(got) == len(rows) and all(r["n"] == r["ranks"] for r in got)
    for r in got:
        score = dist.normal_ppf_array((np.arange(1, r["size"] + 1) - 0.375) / (r["size"] + 0.25))
        mine = score[r["start"] : r["start"] + r["n"]]
        assert r["a"] == pytest.approx(mine.sum(), rel=1e-11, abs=1e-9)
        assert r["b"] == pytest.approx((mine * mine).sum(), rel=1e-11, abs=1e-9)
    assert max(r["parts"] for r in got) <= 2 * normality._EDGE + 1


def test_log_transform_helps_skewed_data(spark):
    rng = np.random.default_rng(4)
    df = spark.createDataFrame(
        [(i, float(v)) for i, v in enumerate(rng.lognormal(3, 1, size=300))], "id int, x double"
    )
    assert normality.log1p_effect(df, ["x"]).first()["improved"]
    table = normality.normality_table(df, ["x"], corrected=True).first()
    assert table["normal"] is False
