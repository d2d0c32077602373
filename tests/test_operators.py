"""Operators on made-up signals, against scalar loops and known cases."""

import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from recsense.functions import columns
from recsense.operators import census, evaluate, joins, physics, signals, timebase, trust, verdict, windows


def series(spark, values, rec=1, step=10.0, start=0.0):
    return spark.createDataFrame([(rec, k, start + k * step, float(v)) for k, v in enumerate(values)], "rec long, id long, t double, a double")


def scalar_swaps(values, delta):
    side, n = None, 0
    for v in values:
        now = 1 if v > delta else -1 if v < -delta else None
        if now is not None:
            n += side is not None and now != side
            side = now
    return n


def test_swap_counts_equal_a_scalar_loop(spark):
    rng = random.Random(1)
    rows, want = [], {}
    for rec in range(30):
        kind = rec % 4
        values = [0.0 if kind == 0 else 2.0 if kind == 1 else 3 * math.sin(k / 3 + rec) + rng.gauss(0, 0.5 * (kind == 3)) for k in range(80)]
        rows += [(rec, 0, k, k, v) for k, v in enumerate(values)]
        want[rec] = values
    df = spark.createDataFrame(rows, "rec long, segment long, i long, id long, d double")
    whole = {r.rec: r.swaps for r in signals.swap_count(df, ["rec"], ["i"], "d", 1.0).collect()}
    assert whole == {rec: scalar_swaps(v, 1.0) for rec, v in want.items()}
    found = windows.feat_interleg(df, 16, 4, "d", 1.0).collect()
    assert len(found) == 30 * 17
    for r in found:
        part = want[r.rec][r.start : r.start + 16]
        assert r.swaps == scalar_swaps(part, 1.0) == physics.swaps_of(np.array([part]), 1.0)[0]
        assert math.isclose(r.minhalf, min(np.ptp(part[:8]), np.ptp(part[8:])), abs_tol=1e-12)


def test_lowpass_blocks_equal_a_scalar_loop(spark):
    rng = random.Random(2)
    values = [rng.gauss(50, 10) for _ in range(100)]
    a = signals.smoothing(0.01, 1.0)
    y, want = None, []
    for v in values:
        y = v if y is None else a * v + (1 - a) * y
        want.append(y)
    got = {r.id: r.y for r in signals.lowpass_causal(series(spark, values), ["rec"], "id", "a", a, block=7).collect()}
    assert max(abs(got[k] - w) for k, w in enumerate(want)) < 1e-12


def test_grid_is_half_open(spark):
    df = series(spark, range(1000)).withColumn("segment", F.lit(0))
    grid = signals.grid_linear(df, ["rec", "segment"], ["a"])
    row = grid.agg(F.count("*").alias("n"), F.max(F.abs(F.col("a") - F.col("k"))).alias("d")).first()
    assert row.n == 999 and row.d < 1e-9


def test_nearest_label_takes_the_earlier_of_a_tie(spark):
    df = spark.createDataFrame([(1, 0, 0, 0.0, 1), (1, 0, 1, 20.0, 2), (1, 0, 2, 40.0, 3)], "rec long, segment long, id long, t double, code int")
    assert [r.code for r in signals.grid_nearest(df, ["rec", "segment"], ["code"]).orderBy("k").collect()] == [1, 1, 2, 2]


def test_decimation_removes_a_tone_and_keeps_a_slow_one(spark):
    fast = [math.sin(2 * math.pi * 60 * k / 500) for k in range(1000)]
    slow = [math.sin(2 * math.pi * 1 * k / 500) for k in range(1000)]
    rows = [(1, k, v) for k, v in enumerate(fast)] + [(2, k, v) for k, v in enumerate(slow)]
    out = signals.decimate_fir(spark.createDataFrame(rows, "rec long, k long, x double"), ["rec"], "x", 5).filter("j between 20 and 180").collect()
    assert max(abs(r.x) for r in out if r.rec == 1) < 0.02
    assert max(abs(r.x - slow[5 * r.j]) for r in out if r.rec == 2) < 0.02


def test_gaps_rates_and_buckets(spark):
    times = [k * 10.0 for k in range(5)] + [1000 + k * 10.0 for k in range(1500)] + [90000 + k * 10.0 for k in range(50)]
    df = spark.createDataFrame([(1, k, t) for k, t in enumerate(times)] + [(2, 0, 5.0)], "rec long, id long, t double")
    table = timebase.segment_usability(timebase.segment_table(timebase.gap_segments(df)))
    rows = sorted((r.rec, r.segment, r.n_source_rows, r.usable) for r in table.collect())
    assert rows == [(1, 0, 5, False), (1, 1, 1500, True), (1, 2, 50, False), (2, 0, 1, False)]
    buckets = {r.bucket: r.n_segments for r in timebase.drop_buckets(table.filter("rec = 1")).collect()}
    assert buckets == {"preamble": 1, "fragment": 1}
    hz = spark.createDataFrame([(100.4,), (300.0,), (499.0,)], "hz double").select(timebase.nominal_rate(F.col("hz")).alias("r"))
    assert [r.r for r in hz.collect()] == [100.0, None, 500.0]


def test_rates_in_reasons_are_rounded_as_sql_rounds_them(spark):
    rates = [k / 1e6 for k in range(1, 3000)] + [0.5, 12.34565, 123456.00005]
    want = {hz: f"no nominal rate near {shown} Hz" for hz, shown in duckdb.sql(f"SELECT hz, CAST(CAST(hz AS DECIMAL(18,4)) AS VARCHAR) FROM (SELECT unnest({rates}::DOUBLE[]) AS hz)").fetchall()}
    df = spark.createDataFrame([(hz, 5.0) for hz in rates], "source_hz double, duration_s double")
    assert {r.source_hz: r.reason for r in timebase.segment_usability(df).collect()} == want


def test_axis_permutation_and_unit(spark):
    rows = []
    for k in range(600):
        s = k / 100
        deg = [20 * math.sin(2 * math.pi * f * s) for f in (0.3, 0.7, 1.1)]
        vel = [20 * 2 * math.pi * f * math.cos(2 * math.pi * f * s) for f in (0.3, 0.7, 1.1)]
        rows.append((1, 0, k, s * 1000, *deg, vel[0] / 57.3, vel[2] / 57.3, vel[1] / 57.3))
    df = spark.createDataFrame(rows, "rec long, segment long, id long, t double, X double, Y double, Z double, gX double, gY double, gZ double")
    for c in "XYZ":
        df = signals.gradient_in_segment(df, ["rec", "segment"], "t", c, f"d{c}")
    matrix = trust.axis_corr_matrix(df, ["rec"], {c: f"d{c}" for c in "XYZ"}, {c: f"g{c}" for c in "XYZ"})
    record = trust.trust_record(trust.axis_match(matrix, ["rec"]), ["rec"], {"X": "X", "Y": "Z", "Z": "Y"}).first()
    assert [(a.angle, a.match) for a in record.axes] == [("X", "X"), ("Y", "Z"), ("Z", "Y")]
    assert record.conflicts == [] and record.bijection and math.isclose(record.unit, 1 / 57.3)


def test_constant_windows(spark):
    df = series(spark, [3.0] * 32).withColumn("segment", F.lit(0)).withColumn("i", F.col("id"))
    m = windows.feat_moments(df, 16, 4, "a", 100.0).first()
    assert (m["skew"], m["kurtosis"], m["angacc"]) == (0.0, -3.0, 0.0)
    assert windows.feat_corr(df.withColumn("b", F.col("id").cast("double")), 16, 4, {"r": ("a", "b")}).first()["r"] == 0.0
    assert windows.spectrum(np.zeros((1, 200)), 100.0, 0.13, 3.0, 15.0).tolist() == [[0.0, 0.0, 0.0]]
    tone = np.sin(2 * np.pi * 2 * np.arange(200) / 100)[None, :]
    assert windows.spectrum(tone, 100.0, 0.13, 3.0, 15.0)[0, 0] == 2.0
    assert windows.cycle(tone, 100.0, 33, 120)[0] == 0.5


def test_large_offsets_do_not_cancel(spark):
    rng = random.Random(3)
    values = [1e6 + rng.gauss(0, 1e-2) for _ in range(64)]
    df = series(spark, values).withColumn("segment", F.lit(0)).withColumn("i", F.col("id"))
    for r in windows.feat_basic(df, 16, 4, ["a"], []).collect():
        assert math.isclose(r.a_std, float(np.std(values[r.start : r.start + 16])), rel_tol=1e-6)


def test_transitions_allow_one_unsure_run(spark):
    codes = [0] * 4 + [-1] * 2 + [10] * 4 + [-1, 255] + [0] * 4 + [10] + [0] * 3
    df = spark.createDataFrame([(1, 1000.0 * k, c, 0, "") for k, c in enumerate(codes)], "rec long, t double, code int, guess int, reason string")
    got = sorted((r.t_truth_s, r.width_s, r.rejected, r.flagged) for r in joins.find_transitions(df, ["rec"], ["t"], "t", "code", "guess", "reason", 1000.0).collect())
    assert got == [(4.5, 3.0, None, False), (15.5, 1.0, "short_flank", None), (16.5, 1.0, "short_flank", None)]


def test_verdict_invariants(spark):
    df = spark.createDataFrame([(1, 0.9), (2, 0.6), (3, None), (4, 0.15), (5, float("nan"))], "id long, p double")
    called = verdict.commit_rule(df, 0.85).withColumns({"posture": F.lit(0.0), "n_oob": F.lit(0), "near_change": F.lit(False), "swaps": F.lit(1.0), "minhalf": F.lit(9.0), "in_band": F.lit(False)})
    rows = {r.id: r for r in verdict.verdict_projection(verdict.reason_cascade(called, 5.0, 1.0), ["id"]).collect()}
    assert {k: r.Label for k, r in rows.items()} == {1: 10, 2: -1, 3: 255, 4: 0, 5: 255}
    assert {k: r.reason for k, r in rows.items()} == {1: "", 2: "weight_shift_or_step", 3: "uncovered", 4: "", 5: "uncovered"}


def test_asof_tolerances_and_ties(spark):
    left = spark.createDataFrame([(1, 5.0), (1, 20.0), (1, 41.0)], "rec long, t double")
    right = spark.createDataFrame([(1, 0.0, 1.0), (1, 10.0, 2.0), (1, 30.0, 3.0)], "rec long, t double, v double")
    got = {r.t: r.v for r in joins.asof_nearest(left, right, "rec", "t", "v", 10.0, False).collect()}
    assert got == {5.0: 1.0, 20.0: 2.0, 41.0: None}


def test_perfect_scores_and_names(spark):
    df = spark.createDataFrame([("a", 0, 0.1), ("a", 10, 0.9), ("b", 10, 0.8)], "rev string, truth int, p double")
    assert evaluate.evaluate(evaluate.guessed(df)).first().macro_f1 == 1.0
    worst = evaluate.selective_curve(df, [0.55]).first()
    assert (worst.worst_group, worst.errors) == ("a", 0)
    with pytest.raises(ValueError, match="unknown features"):
        census.selected_features(["x"], ["y"])


def test_binomial_matches_enumeration(spark):
    df = spark.createDataFrame([(k, 20) for k in range(21)], "k long, n long").withColumn("p", physics.binomial_test(F.col("k"), F.col("n"), F.lit(0.3)))
    pmf = [math.comb(20, i) * 0.3**i * 0.7 ** (20 - i) for i in range(21)]
    for r in df.collect():
        assert math.isclose(r.p, min(1.0, sum(x for x in pmf if x <= pmf[r.k] * (1 + 1e-7))), rel_tol=1e-9)


def test_faults_are_seen(spark):
    d = [20 * math.sin(k / 5) for k in range(300)]
    df = spark.createDataFrame([(1, k, v, -v) for k, v in enumerate(d)], "rec long, id long, a double, b double")
    swaps = {}
    for fault in ("none", "duplicated", "dead", "swapped"):
        part = physics.with_faults(df, "a", "b").filter(F.col("fault") == fault).withColumn("d", F.col("a") - F.col("b"))
        swaps[fault] = signals.swap_count(part, ["rec"], ["id"], "d", 1.0).first().swaps
    assert swaps["none"] == swaps["swapped"] > 5 and swaps["duplicated"] == 0


def test_lowpass_carries_over_blocks_nulls_and_several_channels(spark):
    rng = random.Random(5)
    values = [(0, k, rng.gauss(0, 1), None if k % 5 == 3 else rng.gauss(9, 1)) for k in range(211)]
    df = spark.createDataFrame(values, "rec long, row_idx long, x double, z double")
    for a, block in ((0.2, 7), (0.2, None), (0.9, 3), (0.001, 50)):
        got = signals.lowpass_channels(df, ["rec"], "row_idx", {"x": F.col("x"), "y": F.col("z")}, a, block).orderBy("row_idx").collect()
        for out, place in (("x", 2), ("y", 3)):
            y = values[0][place]
            for r, v in zip(got, values, strict=True):
                y = y if v[1] == 0 else a * (v[place] or 0.0) + (1 - a) * y
                assert math.isclose(r[out], y, abs_tol=1e-11)


def test_window_arrays_of_panes_equal_copied_rows(spark):
    rng = random.Random(6)
    rows = [(rec, s, i, rng.random(), rng.random()) for rec in (1, 2) for s, n in ((0, 37), (1, 16), (2, 15)) for i in range(n)]
    df = spark.createDataFrame(rows, "rec long, segment long, i long, a double, b double")
    for n, step in ((16, 4), (16, 16), (16, 5), (4, 1)):
        got = {(r.rec, r.segment, r.start): (r.a, r.b) for r in windows.window_arrays(df, n, step, ["a", "b"]).collect()}
        want = {}
        for rec in (1, 2):
            for s in (0, 1, 2):
                x = [r[3:] for r in rows if r[:2] == (rec, s)]
                for at in range(0, len(x) - n + 1, step):
                    want[rec, s, at] = tuple(map(list, zip(*x[at : at + n], strict=True)))
        assert got == want


def test_quantile_of_an_array_equals_the_aggregate(spark):
    rng = random.Random(7)
    rows = [(k, [None if rng.random() < 0.2 else rng.gauss(0, 9) for _ in range(k)]) for k in range(12)] + [(90, [2.5] * 5), (91, [None]), (92, None)]
    df = spark.createDataFrame(rows, "k long, v array<double>")
    got = {r.k: r[1:] for r in df.select("k", *[columns.quantile_of(F.col("v"), q) for q in (0.05, 0.5, 1)]).collect()}
    flat = df.select("k", F.explode_outer("v").alias("x")).groupBy("k").agg(F.percentile("x", [0.05, 0.5, 1.0]).alias("p")).collect()
    for r in flat:
        assert got[r.k] == (None,) * 3 if r.p is None else all(math.isclose(a, b, abs_tol=1e-9) for a, b in zip(got[r.k], r.p, strict=True))


def test_fills_reach_the_nearest_row_on_both_sides(spark):
    rng = random.Random(8)
    left = [(rec, rng.randrange(500)) for rec in (1, 2, 3) for _ in range(60)]
    right = [(rec, t, float(t)) for rec in (1, 2) for t in rng.sample(range(500), 25)]
    got = joins.asof_nearest(spark.createDataFrame(left, "rec long, t long"), spark.createDataFrame(right, "rec long, t long, v double"), "rec", "t", "v", 12.0, True).collect()
    assert len(got) == len(left)
    for r in got:
        near = min(((abs(t - r.t), t, v) for rec, t, v in right if rec == r.rec), default=None)
        assert r.v == (near[2] if near and near[0] <= 12 else None)
