import itertools

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lotmetrics.operators import models, spatial
from lotmetrics.plans import catalog


def brute(x, y, w, lam):
    """Ridge as plain least squares: one more row for each feature pulls its standardised slope to 0."""
    share = w / w.sum()
    centre = share @ x
    spread = np.sqrt(share @ (x - centre) ** 2)
    spread = np.where(spread < 1e-12, 1.0, spread)
    root = np.sqrt(share)[:, None]
    rows = np.vstack([root * np.column_stack([np.ones(len(x)), (x - centre) / spread]), np.column_stack([np.zeros(x.shape[1]), np.sqrt(lam) * np.eye(x.shape[1])])])
    goal = np.concatenate([root[:, 0] * y, np.zeros(x.shape[1])])
    found = np.linalg.lstsq(rows, goal, rcond=None)[0]
    return lambda v: found[0] + (np.minimum(np.maximum(v, x.min(axis=0)), x.max(axis=0)) - centre) / spread @ found[1:]


@pytest.fixture(scope="module")
def panel():
    rng = np.random.default_rng(3)
    rows = [(p, o, h, *rng.normal(size=2), rng.normal(), 0.5 + rng.random()) for p in range(12) for o in range(10) for h in (1, 3)]
    return pd.DataFrame(rows, columns=["place", "origin", "h", "x1", "x2", "y", "w"])


def test_backtest_knows_only_the_past(spark, panel):
    got = models.backtest(spark.createDataFrame(panel), ["x1", "x2"], "y", F.col("w"), 0.05, 20).toPandas()
    for r in got.itertuples():
        past = panel[(panel.h == r.h) & (panel.origin + panel.h <= r.origin)]
        if len(past) < 20:
            assert np.isnan(r.pred)
        else:
            assert abs(brute(past[["x1", "x2"]].to_numpy(), past.y.to_numpy(), past.w.to_numpy(), 0.05)(np.array([r.x1, r.x2])) - r.pred) < 1e-8


def test_out_of_fold(spark, panel):
    rows = panel.assign(fold=panel.index % 4)
    for r in models.out_of_fold(spark.createDataFrame(rows), ["x1", "x2"], "y", "fold").toPandas().itertuples():
        rest = rows[rows.fold != r.fold]
        assert abs(brute(rest[["x1", "x2"]].to_numpy(), rest.y.to_numpy(), np.ones(len(rest)), 0.01)(np.array([r.x1, r.x2])) - r.pred) < 1e-8


def test_intervals_hold_their_share(spark, panel):
    past = panel.assign(pred=0.0, sigma=1.0)
    got = models.intervals(spark.createDataFrame(past), spark.createDataFrame(past[["place", "h", "pred", "sigma"]]).where("place = 0").distinct()).toPandas()
    assert sorted(got.h) == [1, 3] and (got.q10 < got.q25).all() and (got.q75 < got.q90).all()
    for r in got.itertuples():
        of = past[past.h == r.h]
        assert 0.7 < ((of.y > r.q10) & (of.y < r.q90)).mean() < 0.95


def test_segments_are_the_best_ones():
    rng = np.random.default_rng(5)
    y = np.concatenate([np.arange(7) * 0.1, 0.6 - np.arange(6) * 0.2, np.full(5, -0.4)]) + rng.normal(0, 0.01, 18)
    def cost(i, j):
        t = np.arange(i, j)
        return float(((np.polyval(np.polyfit(t, y[i:j], 1), t) - y[i:j]) ** 2).sum())

    best = (np.inf, None)
    for k in range(3):
        for cuts in itertools.combinations(range(1, 18), k):
            ends = [0, *cuts, 18]
            if min(np.diff(ends)) >= 4:
                value = 18 * np.log(sum(cost(*p) for p in itertools.pairwise(ends)) / 18) + 3 * (k + 1) * np.log(18)
                best = min(best, (value, list(itertools.pairwise(ends))))
    assert models.segments(y, 4, 3) == best[1]


def test_holes_and_parts(spark):
    rings = [[[0.0, 0.0], [10.0, 0.0], [10.0, 10.0], [0.0, 10.0]], [[4.0, 4.0], [6.0, 4.0], [6.0, 6.0], [4.0, 6.0]], [[20.0, 0.0], [22.0, 0.0], [22.0, 2.0], [20.0, 0.0]]]
    places = spark.createDataFrame([("a", rings), ("b", [])], "polygon string, rings array<array<array<double>>>")
    points = spark.createDataFrame([(1, 1.0, 1.0), (2, 5.0, 5.0), (3, 21.5, 0.5), (4, 30.0, 1.0), (5, None, 1.0)], "id int, x double, y double")
    assert sorted(r["id"] for r in spatial.points_in_polygons(points, places, 3.0).collect()) == [1, 3]


@pytest.mark.parametrize("name", ["ridge_forecast", "forecast_metrics", "fair_value", "regimes"])
def test_query_without_sql_runs(spark, name):
    got = catalog.QUERIES[name](spark, "/root/testdata/sf0.001").toPandas()
    assert len(got) and got.columns.is_unique
