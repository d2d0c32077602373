"""The whole path from log to verdict: every reason can be given, no input row is lost."""

import os

import pytest
from pyspark.sql import functions as F

from recsense import plans
from recsense.operators import model, verdict, windows

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_each_reason_occurs(spark):
    ref = model.Reference({f"f{k}": (0.0, 1.0) for k in range(3)}, 5.0, 10.0, (30.0, 40.0))
    # per recording: p of its one or two windows, swaps, minhalf, rest-relative medians, feature values
    cases = {
        "posture_shift": ([0.6], 3, 50.0, (6.0, 7.0), 9.0),
        "out_of_distribution": ([0.6], 3, 50.0, (6.0, 1.0), 9.0),
        "near_transition": ([0.6, 0.4], 1, 50.0, (0.0, 0.0), 0.5),
        "weight_shift_or_step": ([0.6], 1, 35.0, (0.0, 0.0), 0.5),
        "low_excursion_gait": ([0.6], 3, 5.0, (0.0, 0.0), 0.5),
        "amplitude_ambiguous": ([0.4], 3, 35.0, (0.0, 0.0), 0.5),
        "model_split": ([0.4], 3, 50.0, (0.0, 0.0), 0.5),
        "": ([0.9], 3, 35.0, (9.0, 9.0), 9.0),
        "uncovered": ([], 0, 0.0, (0.0, 0.0), 0.0),
    }
    grid, scored = [], []
    for rec, (p, swaps, minhalf, med, x) in enumerate(cases.values()):
        grid += [(rec, 0, k, float(k), k) for k in range(4 * max(1, len(p)))]
        scored += [(rec, 0, 4 * k, v, swaps, minhalf, *med, x, x, x) for k, v in enumerate(p)]
    rows = spark.createDataFrame(grid, "rec long, segment long, id long, t double, i long")
    per = spark.createDataFrame(scored, "rec long, segment long, start long, p double, swaps long, minhalf double, a_med double, b_med double, f0 double, f1 double, f2 double")
    got = model.explain_rows(rows, per, list(ref.stats), ref, 4, 4, 0.85)
    assert {(r.rec, r.reason) for r in got.collect() if r.rec != 2} == {(k, name) for k, name in enumerate(cases) if k != 2}
    assert "near_transition" in {r.reason for r in got.filter("rec = 2").collect()}
    assert {name for name in cases if name} == set(verdict.REASONS)
    banded = model.explain_rows(rows, per, list(ref.stats), ref, 4, 4, 0.85, band_abstains=True)
    assert {r.ambiguous for r in banded.filter("rec = 7").collect()} == {True}


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_label_recordings_keeps_rows_and_says_why(spark):
    got = plans.queries()["label_recordings"](spark, SF).persist()
    assert got.count() == spark.read.parquet(f"{SF}/events.parquet").count()
    reasons = {r.reason for r in got.filter("ambiguous").select("reason").distinct().collect()}
    assert {"uncovered", "near_transition"} <= reasons <= set(verdict.REASONS)
    assert got.filter("Label = 255 and reason <> 'uncovered'").count() == 0
    gate = {r.file: r.refusal for r in plans.queries()["serve_refusals"](spark, SF).filter("refusal is not null").collect()}
    declined = {r.rec: r.refusal for r in got.filter("refusal is not null").select("rec", "refusal").distinct().collect()}
    assert gate.items() <= declined.items() and gate
    assert got.filter("refusal is not null and Label <> 255").count() == got.filter("(Label = 255) <> (n_windows = 0)").count() == 0
    assert got.filter("refusal is null and plausibility not like '%too_short%'").count() == 0  # all recordings of the tables are short
    for r in got.select("reason", "reason_detail", "alternative").distinct().collect():
        assert (r.reason_detail, r.alternative) == verdict.REASON_TEXTS.get(r.reason, ("", ""))


def test_refused_recordings_are_named(spark):
    rows = spark.createDataFrame([(rec, 0, k, float(k), None if rec == 2 and k == 5 else float(k % 3)) for rec in (1, 2, 3) for k in range(4 if rec == 3 else 12)], "rec long, segment long, id long, t double, a double")
    _, health = model.on_grid(rows, ["a"], 1.0, 8)
    assert {r.rec: (r.usable, r.errors) for r in health.collect()} == {1: (True, []), 2: (False, ["a: non-finite"]), 3: (False, ["no segment long enough"])}


def test_all_features_have_both_sides(spark):
    names = windows.feature_names(("a", "b"), ("va", "vb"))
    assert len(names) == len(set(names)) == 42
    df = spark.range(32).select(F.lit(1).cast("long").alias("rec"), F.lit(0).cast("long").alias("segment"), F.col("id").alias("i"), *[F.sin(F.col("id") * k).alias(c) for c, k in (("a", 0.7), ("b", 0.9), ("va", 1.1), ("vb", 1.3))])
    zero = spark.createDataFrame([(1, 0.25, -0.25, 0.5)], "rec long, zero_a double, zero_b double, zero_d double")
    found = windows.all_features(df, 16, 4, ("a", "b"), ("va", "vb"), zero, 0.1, 16.0, (1.0, 3.0, 7.0), (3, 8), 4).filter("start = 4").first()
    import numpy as np

    x = {c: np.sin(np.arange(4, 20) * k) for c, k in (("a", 0.7), ("b", 0.9), ("va", 1.1), ("vb", 1.3))}
    assert found.a_med == pytest.approx(np.median(x["a"]) - 0.25) and found.b_high == pytest.approx(np.percentile(x["b"], 95) + 0.25)
    assert found.rate_corr == pytest.approx(np.corrcoef(x["va"], x["vb"])[0, 1])
    z = (x["vb"] - x["vb"].mean()) / x["vb"].std()
    assert found.vb_skew == pytest.approx((z**3).mean()) and found.vb_angacc == pytest.approx(np.sqrt(((np.diff(x["vb"]) * 16) ** 2).mean()))
    side = np.sign(x["a"] - x["b"] - 0.5) * (abs(x["a"] - x["b"] - 0.5) > 0.1)
    side = side[side != 0]
    assert found.swaps == (side[1:] != side[:-1]).sum()
    assert found.vb_band == pytest.approx(windows.spectrum(x["vb"][None], 16.0, 1.0, 3.0, 7.0)[0, 1])


def test_seed_sweep_fits_for_every_seed(spark):
    df = spark.range(60).select((F.col("id") % 7).cast("double").alias("x"), F.rand(3).alias("y"), F.when(F.col("id") % 7 > 2, 10).otherwise(0).alias("label"), (F.col("id") % 2).alias("g"))
    got = {r.metric: r for r in model.seed_sweep(df, ["x", "y"], "label", "g", (0, 1), trees=3, depth=3).collect()}
    one = [model.ablation_grid(df, ["x", "y"], "label", "g", [("all", [])], (s,), trees=3, depth=3).first().accuracy for s in (0, 1)]
    assert got["accuracy"].n_seeds == 2 and (got["accuracy"].least, got["accuracy"].most) == (min(one), max(one))
    assert got["macro_f1"].spread == got["macro_f1"].most - got["macro_f1"].least


def test_fault_controls_name_what_caught_each(spark):
    rows = [(1, 0, k, float(k), k, 20.0 * (-1) ** (k // 4), -20.0 * (-1) ** (k // 4), 1.0 * (k % 3)) for k in range(64)]
    grid = spark.createDataFrame(rows, "rec long, segment long, id long, t double, i long, a double, b double, va double")

    def score(copy):  # a model that calls all rows walking
        swaps = copy.groupBy("rec").agg(F.when(F.max(F.abs(F.col("a") - F.col("b"))) > 30, 4.0).otherwise(0.0).alias("swaps"))
        return copy.join(swaps, "rec").select("rec", F.lit(10).alias("guess"), F.lit(False).alias("ambiguous"), "swaps", F.lit(True).alias("rest_trusted"))

    got = {r.fault: r.caught_by for r in model.fault_controls(grid, ["a", "b", "va"], ("a", "b"), score, 16, 16).collect()}
    assert got == {"none": [], "duplicated": ["physics_silent"], "dead": ["a: constant", "physics_silent"], "swapped": []}
