"""Greedy picks apart from each other, against a walk over sorted rows; and no array of a whole key."""

import math
import random

import pytest

from recsense.operators import joins


def walk(rows, most, apart):
    taken = []
    for e, t in sorted((-e, t) for t, e in rows):
        if len(taken) < most and all(abs(t - y) >= apart for y, _ in taken):
            taken.append((t, -e))
    return taken, len(rows) - len(taken)


@pytest.mark.parametrize("share", [7, 100_000])
def test_equals_a_walk(spark, share):
    rng = random.Random(5)
    per = {k: [(float(rng.randrange(200)), float(rng.randrange(12))) for _ in range(n)] for k, n in enumerate((1, 5, 40, 300))}
    df = spark.createDataFrame([(k, t, e) for k, rows in per.items() for t, e in rows], "rec long, t double, e double")
    got = joins.greedy_spread_topk(df, "rec", "t", "e", 5, 9.0, share)
    assert {r.rec: ([tuple(x) for x in r.taken], r.n_dropped) for r in got.collect()} == {k: walk(rows, 5, 9.0) for k, rows in per.items()}


def test_gathers_no_key(spark):
    df = spark.createDataFrame([(1, 1.0, 1.0)], "rec long, t double, e double")
    plan = joins.greedy_spread_topk(df, "rec", "t", "e", 2, 9.0)._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan


@pytest.mark.parametrize("batch, apart", [(1, 9.0), (3, 9.0), (256, 60.0), (256, 0.5)])
def test_equals_a_walk_however_few_cells_a_pass_weighs(spark, batch, apart):
    rng = random.Random(batch)
    # slow waves with ties: a pick shadows its flanks only in part
    per = {k: [(i * 0.5, float(round(6 * math.sin(i / 9 + k)) + rng.randrange(2))) for i in range(n)] for k, n in enumerate((1, 30, 400))}
    df = spark.createDataFrame([(k, t, e) for k, rows in per.items() for t, e in rows], "rec long, t double, e double")
    got = joins.greedy_spread_topk(df, "rec", "t", "e", 4, apart, 50, batch)
    assert {r.rec: ([tuple(x) for x in r.taken], r.n_dropped) for r in got.collect()} == {k: walk(rows, 4, apart) for k, rows in per.items()}


def test_rows_without_a_time_or_evidence(spark):
    rows = [(1, None, 9.0), (1, math.inf, 9.0), (1, math.nan, 9.0), (1, 5.0, None), (1, 40.0, 1.0), (1, 41.0, 1.0), (2, None, 1.0)]
    got = joins.greedy_spread_topk(spark.createDataFrame(rows, "rec long, t double, e double"), "rec", "t", "e", 3, 9.0)
    assert {r.rec: ([tuple(x) for x in r.taken], r.n_dropped) for r in got.collect()} == {1: ([(40.0, 1.0), (5.0, None)], 4), 2: ([], 1)}
    none = spark.createDataFrame([], "rec long, t double, e double")
    assert joins.greedy_spread_topk(none, "rec", "t", "e").count() == 0


def test_contenders_are_cut_before_the_shuffle(spark):
    rows = spark.range(40).selectExpr("id div 40 as rec", "id % 3 as __s", "id as __c", "double(id) as __t", "struct(false as n, double(-id) as e, double(id) as t) as __r")
    found = joins.contenders(rows, "rec", 5)
    assert [len(r.found) for r in found.collect()] == [5]
    assert "WindowGroupLimit" in found._jdf.queryExecution().optimizedPlan().toString()
