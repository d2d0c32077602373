"""Extremely randomised trees: equal to trees grown one by one with the same draws, on any spread of the rows."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from recsense.operators import model, trees


def grown(x, y, weight, seed, tree, depth):
    """One tree by recursion; gives a function from a row to the share of the high class."""
    p = x.shape[1]
    k = max(1, math.isqrt(p))

    def node(rows, path, level):
        n = np.array([(y[rows] == 0).sum(), (y[rows] == 1).sum()])
        w = n * weight
        share = w[1] / w.sum() if w.sum() else 0.0
        if level == depth or not n.all():
            return lambda row: share
        drawn, u = trees.candidates(np.array([seed]), np.array([tree]), np.array([path]), p, k)
        best = None
        for f, z in zip(drawn[0], u[0], strict=True):
            lo, hi = x[rows, f].min(), x[rows, f].max()
            if lo < hi:
                cut = lo + z * (hi - lo)
                cut = lo if cut >= hi else cut
                cost = 0.0
                for side in (rows[x[rows, f] <= cut], rows[x[rows, f] > cut]):
                    c = np.array([(y[side] == 0).sum(), (y[side] == 1).sum()]) * weight
                    cost += c[0] * c[1] / c.sum()
                if best is None or cost < best[0]:
                    best = (cost, f, cut)
        if best is None:
            return lambda row: share
        _, f, cut = best
        low, high = node(rows[x[rows, f] <= cut], 2 * path, level + 1), node(rows[x[rows, f] > cut], 2 * path + 1, level + 1)
        return lambda row: low(row) if row[f] <= cut else high(row)

    return node(np.arange(len(y)), 1, 0)


def made(spark, n=300, p=7):
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=(n, p)), 2)
    x[:, 6] = 1.0
    y = (x[:, 0] + 0.5 * x[:, 1] + rng.normal(scale=0.5, size=n) > 0.6).astype(int)
    g = rng.integers(0, 3, n)
    names = [f"f{k}" for k in range(p)]
    rows = [(k, *map(float, x[k]), int(10 * y[k]), f"g{g[k]}") for k in range(n)]
    return spark.createDataFrame(rows, ["id", *names, "label", "grp"]), names, x, y, g


def test_all_fits_in_shared_passes_equal_trees_grown_one_by_one(spark):
    df, names, x, y, g = made(spark)
    forest = trees.fit_trees(df.repartition(5, "id"), names, "label", "grp", [0, 4], trees=6, depth=5)
    got = {r.id: r.ps for r in trees.score_trees(forest, df.repartition(3, "f0"), "grp").select("id", "ps").collect()}
    for s, seed in enumerate([0, 4]):
        for fold in range(3):
            train = g != fold
            n = np.array([(y[train] == 0).sum(), (y[train] == 1).sum()])
            one = [grown(x[train], y[train], train.sum() / (2.0 * n), seed, t, 5) for t in range(6)]
            for k in np.flatnonzero(~train):
                assert got[k][s] == pytest.approx(np.mean([t(x[k]) for t in one]), abs=1e-12)


def test_jobs_do_not_grow_with_folds_and_seeds(spark, monkeypatch):
    df, names, *_ = made(spark, 120)
    passes = []
    real = trees._passes
    monkeypatch.setattr(trees, "_passes", lambda *a: passes.append(a[3]) or real(*a))
    trees.fit_trees(df, names, "label", None, [0], trees=4, depth=3)
    one = len(passes)
    trees.fit_trees(df, names, "label", "grp", [0, 1, 2], trees=4, depth=3)
    assert one == len(passes) - one == 6


def test_forest_finds_what_matters_and_takes_odd_rows(spark):
    df, names, x, y, _ = made(spark, 600)
    forest = model.fit_forest(df, names, "label", trees=30, depth=8)
    scored = model.predict(forest, df, names).select("label", "p").collect()
    assert np.mean([(r.p >= 0.5) == (r.label == 10) for r in scored]) > 0.9
    share = dict(zip(names, trees.importances(forest), strict=True))
    assert max(share, key=share.get) == "f0" and share["f6"] == 0 and sum(share.values()) == pytest.approx(1)
    odd = df.withColumn("f2", F.when(F.col("id") % 3 == 0, F.lit(float("nan"))).when(F.col("id") % 3 == 1, F.lit(None).cast("double")).otherwise(F.col("f2")))
    assert model.predict(model.fit_forest(odd, names, "label", trees=3, depth=4), odd, names).filter("p is null or isnan(p)").count() == 0
    none = model.fit_forest(df.limit(0), names, "label", trees=2, depth=3)
    assert {r.p for r in model.predict(none, df, names).select("p").distinct().collect()} == {0.0}
    assert model.logo_cv(df.limit(0), names, "label", "grp", trees=2, depth=2).count() == 0
    same = model.fit_forest(df.filter("label = 10"), names, "label", trees=2, depth=3)
    assert {r.p for r in model.predict(same, df, names).select("p").distinct().collect()} == {1.0}


def test_leave_one_group_out_never_sees_the_group(spark):
    df, names, *_ = made(spark, 200)
    lying = df.withColumn("label", F.when(F.col("grp") == "g1", 10 - F.col("label")).otherwise(F.col("label")))
    got = {r.id: r.p for r in model.logo_cv(lying, names, "label", "grp", trees=5, depth=4).filter("grp = 'g1'").collect()}
    want = {r.id: r.p for r in model.predict(model.fit_forest(df.filter("grp <> 'g1'"), names, "label", trees=5, depth=4), df.filter("grp = 'g1'"), names).collect()}
    assert got == want and got


def test_few_rows_in_one_file_keep_all_cores_busy_and_give_the_same_forest(spark, monkeypatch):
    df, names, *_ = made(spark, 200)
    tasks, real = set(), trees._passes
    monkeypatch.setattr(trees, "_passes", lambda rows, *a: tasks.add(rows.rdd.getNumPartitions()) or real(rows, *a))
    few = trees.fit_trees(df.coalesce(1), names, "label", "grp", [0], trees=20, depth=4)
    assert min(tasks) >= spark.sparkContext.defaultParallelism
    for name, value in (("SHARE", 60), ("SLOTS", 37), ("ROWS", 11), ("TREES", 3)):  # rows shared out, levels in several passes, trees cut by them
        monkeypatch.setattr(trees, name, value)
    many = trees.fit_trees(df, names, "label", "grp", [0], trees=20, depth=4)
    for column in ("tree", "path", "feature", "cut", "left", "counts"):
        assert (getattr(few, column) == getattr(many, column)).all()


def test_seeds_that_do_not_fit_at_once_are_fitted_in_turn(spark, monkeypatch):
    df, names, *_ = made(spark, 120)
    whole = {r.seed: r.accuracy for r in model.ablation_grid(df, names, "label", "grp", [("all", [])], range(3), trees=4, depth=3).collect()}
    monkeypatch.setattr(trees, "MOST_NODES", 3 * 4 * 15)
    assert {r.seed: r.accuracy for r in model.ablation_grid(df, names, "label", "grp", [("all", [])], range(3), trees=4, depth=3).collect()} == whole
