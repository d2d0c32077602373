"""Ordered operators on one recording over many ranges give what they give in one task; exact percentiles by selection."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from recsense.operators import joins, scan, selection, timebase, verdict

PARTS = 7


def recordings(spark, n=3000):
    """One recording with nearly all rows, a short one, one with a null key."""
    rng = random.Random(11)
    rows, t = [], 0.0
    for k in range(n):
        t += rng.choice([1.0, 1.0, 1.0, 1.25, 9.0])
        rows.append(("huge", k, t, rng.choice([0, 10, None, None, -1]), rng.random()))
    rows += [("short", k, float(k), 0, 0.5) for k in range(3)] + [("one", 0, 5.0, 10, 0.1)] + [(None, k, 2.0 * k, 10 * (k % 2), 0.2) for k in range(6)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "rec string, id long, t double, code int, a double")


def same(one, two):
    names = sorted(two.columns)
    got, want = (sorted(map(repr, df.select(names).collect())) for df in (one, two))
    assert got == want and got


def test_no_range_holds_most_of_the_recording(spark):
    rows = scan.ranged(recordings(spark), ["rec"], ["t", "id"], PARTS)
    sizes = [r["count"] for r in rows.filter("rec = 'huge'").groupBy("__range").count().collect()]
    assert len(sizes) >= PARTS - 1 and max(sizes) < 2 * 3000 / PARTS


def test_gap_segments(spark):
    rows = recordings(spark).filter("rec is not null")
    same(scan.gap_segments(rows, parts=PARTS), timebase.gap_segments(rows))


def test_time_profile(spark):
    rows = recordings(spark).filter("rec is not null").drop("code", "a")
    same(scan.time_profile(rows, parts=PARTS), timebase.time_profile(rows))


def test_asof_nearest(spark):
    rows = recordings(spark)
    left, right = rows.filter("id % 3 > 0").select("rec", "id", "t"), rows.filter("id % 3 = 0 and id % 50 < 20").select("rec", "t", "a")
    for tolerance, inclusive in ((3.0, True), (3.0, False), (float("inf"), True)):
        same(scan.asof_nearest(left, right, "rec", "t", "a", tolerance, inclusive, parts=PARTS), joins.asof_nearest(left, right, "rec", "t", "a", tolerance, inclusive))


def test_runs(spark):
    rows = recordings(spark).withColumn("code", F.when(F.col("id") < 1500, F.lit(0)).otherwise(F.col("code")))  # a run over several ranges
    same(scan.runs(rows, ["rec"], ["t", "id"], "code", PARTS), joins.runs(rows, ["rec"], ["t", "id"], "code"))


@pytest.mark.parametrize("half", [1, 2, 700])
def test_near_change(spark, half):
    rows = recordings(spark).withColumn("code", F.when(F.col("id") % 400 < 390, F.lit(None)).otherwise(F.col("code")))
    same(scan.near_change(rows, ["rec"], ["t", "id"], "code", half, PARTS), verdict.near_change(rows, ["rec"], ["t", "id"], "code", half))


@pytest.mark.parametrize("sizes", [{}, {"buckets": 2, "few": 1}, {"buckets": 16, "few": 5}])
def test_selection_equals_sorting(spark, sizes):
    rng = np.random.default_rng(2)
    groups = {
        "normal": rng.normal(size=700), "ties": np.repeat([1.0, 1.0, 2.0], 50), "one": np.array([4.5]), "two": np.array([-1.0, 1e300]),
        "far": np.concatenate([rng.random(300), [1e308, -1e308, 1e-300]]), "micro": 10.0 + 1e-3 * rng.random(500),
    }
    rows = [(k, float(v)) for k, vs in groups.items() for v in vs] + [("ties", None), ("ties", float("nan")), ("none", None), (None, 3.0)]
    df = spark.createDataFrame(rows, "g string, x double")
    qs = [0.0, 0.01, 0.5, 0.99, 1.0]
    got = {r.g: (r.n, r.q) for r in selection.quantiles(df, ["g"], "x", qs, **sizes).collect()}
    assert set(got) == {*groups, None} and got[None] == (1, [3.0] * 5)
    want = {r.g: r.q for r in df.filter("not isnan(x)").groupBy("g").agg(F.percentile("x", qs).alias("q")).collect()}
    for k, vs in groups.items():
        assert got[k][0] == len(vs) and got[k][1] == pytest.approx(want[k], rel=1e-12)
    whole = selection.quantiles(df, [], "x", [0.5], **sizes).first()
    assert whole.q == [df.filter("not isnan(x)").agg(F.percentile("x", 0.5)).first()[0]]
    assert selection.quantiles(df.limit(0), ["g"], "x", [0.5], **sizes).count() == 0


def test_infinities_are_values(spark):
    df = spark.createDataFrame([(float("-inf"),), (1.0,), (float("inf"),), (float("inf"),)], "x double")
    assert selection.quantiles(df, [], "x", [0.0, 1 / 3, 1.0], few=1).first().q == [float("-inf"), 1.0, float("inf")]
