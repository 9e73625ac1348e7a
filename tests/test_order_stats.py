import random
import statistics

import pytest

from adtally.operators.order_stats import exact_median, global_rank, roc_area


def medians(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(3)
    return [r["median"] for r in exact_median(df, "x").collect()]


@pytest.mark.parametrize(
    "values",
    [
        [1.0],
        [1.0, 2.0],
        [3.0, 1.0, 2.0],
        [-5.0, 0.0, 0.0, 7.5],
        [1e-9, 2e-9, 3e-9, 4e-9],
        [1e12, -1e12, 5.0, 5.0, 5.0, 6.0],
        [0.1, 0.1 + 2**-55, 0.1 + 2**-54],
        [2.0] * 30 + [1.0] * 29 + [3.0] * 5,
        [2.0] * 10 + [3.0] * 10,
    ],
)
def test_small_medians(spark, values):
    assert medians(spark, values) == [statistics.median(values)]


@pytest.mark.parametrize("seed", range(4))
def test_random_medians(spark, seed):
    rng = random.Random(seed)
    hot = [round(rng.lognormvariate(1, 2), 2)] * rng.randrange(0, 200)
    values = hot + [rng.choice([1, -1]) * rng.lognormvariate(0, 4) for _ in range(rng.randrange(300, 600))]
    assert medians(spark, values) == [statistics.median(values)]


def test_median_ignores_null_and_nan_and_may_be_absent(spark):
    assert medians(spark, [None, float("nan"), 4.0, 2.0]) == [3.0]
    assert medians(spark, [None]) == []


def test_grouped_medians(spark):
    rng = random.Random(9)
    rows = [(rng.choice(["a", "a", "b", None]), rng.choice([1, 2]), rng.uniform(-3, 300)) for _ in range(800)]
    got = exact_median(spark.createDataFrame(rows, "g string, h int, x double"), "x", ["g", "h"]).collect()
    want = {(g, h): statistics.median(x for a, b, x in rows if (a, b) == (g, h)) for g, h, _ in rows}
    assert {(r.g, r.h): r.median for r in got} == want


def test_global_rank_matches_brute_force(spark):
    rng = random.Random(3)
    values = [-100.0] * 60 + [rng.uniform(-100, 500) for _ in range(100)] + [0.0, 0.0, 1e9]
    df = spark.createDataFrame(list(enumerate(values)), "id long, v double")
    got = {r.id: r.rank for r in global_rank(df, "v", "rank").collect()}
    assert got == {i: 1 + sum(w > v for w in values) for i, v in enumerate(values)}


def test_roc_area_matches_pair_counting(spark):
    rng = random.Random(5)
    rows = [(rng.choice([0.0, 0.5, 1.0, rng.random()]), float(rng.random() < 0.4)) for _ in range(200)]
    pos, neg = [s for s, y in rows if y == 1], [s for s, y in rows if y == 0]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    df = spark.createDataFrame(rows, "s double, y double")
    assert roc_area(df, "s", "y").first()["roc_auc"] == pytest.approx(want, abs=1e-12)
    assert roc_area(df.where("y = 1"), "s", "y").first()["roc_auc"] is None
