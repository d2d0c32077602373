"""All features from one aggregate of panes, against the features taken one by one, over stretches of any size."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from recsense.operators import windows

N, STEP, CHANNELS = 16, 4, ("a", "b", "va", "vb")
SETTINGS = {"delta": 0.4, "fs": 16.0, "bands": (1.0, 3.0, 7.0), "lags": (3, 8), "within": 4}
SCHEMA = "rec long, segment long, i long, a double, b double, va double, vb double"


def signals():
    """Segments of lengths about a window's, a long one, constant stretches within, values far from zero."""
    rng = random.Random(11)
    rows = []
    for rec, segment, length in ((1, 0, 15), (1, 1, 16), (1, 2, 203), (2, 0, 77), (3, 0, 40)):
        for i in range(length):
            still = rec == 3 or 60 <= i < 90
            values = [1000.0 * rec + (0.0 if still else rng.gauss(0, 1)) for _ in range(2)] + [0.0 if still else math.sin(i * k) + rng.gauss(0, 0.1) for k in (0.7, 1.3)]
            rows.append((rec, segment, i, *values))
    return rows


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(signals(), SCHEMA)


@pytest.fixture(scope="module")
def zero(spark):
    return spark.createDataFrame([(k, 1000.0 * k, 1000.0 * k - 0.25, 0.25) for k in (1, 2, 3)], "rec long, zero_a double, zero_b double, zero_d double")


def one_by_one(df, zero):
    rows = df.join(zero.select("rec", "zero_d"), "rec").withColumn("leg", F.col("a") - F.col("b") - F.col("zero_d"))
    parts = [windows.feat_basic(df, N, STEP, ["a", "b"], ["va", "vb"]), windows.feat_corr(df, N, STEP, {"angle_corr": ("a", "b"), "rate_corr": ("va", "vb")}), windows.feat_rest_relative(df, N, STEP, ["a", "b"], zero), windows.feat_interleg(rows, N, STEP, "leg", SETTINGS["delta"])]
    for c in ("va", "vb"):
        moments = windows.feat_moments(df, N, STEP, c, SETTINGS["fs"])
        parts.append(moments.select("rec", "segment", "start", *[F.col(x).alias(f"{c}_{x}") for x in moments.columns[3:]]))
        spectra = windows.feat_spectral(windows.window_arrays(df, N, STEP, ["va", "vb"]), c, "vb", SETTINGS["fs"], SETTINGS["bands"], SETTINGS["lags"], SETTINGS["within"])
        parts.append(spectra.select("rec", "segment", "start", *[F.col(x).alias(f"{c}_{x}") for x in ("dominant", "band", "high_band", "cycle")], *(["lead"] if c == "va" else [])))
    found = {}
    for part in parts:
        for r in part.collect():
            found.setdefault((r.rec, r.segment, r.start), {}).update(r.asDict())
    return found


@pytest.mark.parametrize("panes", [1, 5, 4096])
def test_equals_the_features_one_by_one(df, zero, panes):
    names = windows.feature_names(("a", "b"), ("va", "vb"))
    got = {(r.rec, r.segment, r.start): r for r in windows.all_features(df, N, STEP, ("a", "b"), ("va", "vb"), zero, **SETTINGS, panes=panes).collect()}
    want = one_by_one(df, zero)
    assert set(got) == set(want) and len(got) == 1 + 47 + 16 + 7
    for k, row in got.items():
        for c in names:
            assert row[c] == pytest.approx(want[k][c], rel=1e-6, abs=1e-6), (k, c)


def test_few_exchanges(df, zero):
    plan = windows.all_features(df, N, STEP, ("a", "b"), ("va", "vb"), zero, **SETTINGS)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning", plan)) <= 3


def test_nulls_and_empty_tables(spark, zero):
    rows = [(1, 0, i, None if i == 5 else float(i), 2.0, None, 0.0) for i in range(20)] + [(9, 0, i, 1.0, 1.0, 1.0, 1.0) for i in range(16)]
    got = windows.all_features(spark.createDataFrame(rows, SCHEMA), N, STEP, ("a", "b"), ("va", "vb"), zero, **SETTINGS).collect()
    assert sorted((r.rec, r.start) for r in got) == [(1, 0), (1, 4)]  # 9 has no rest angles
    assert all(math.isnan(r.a_std) and math.isnan(r.va_mean) and r.b_std == 0 and r.vb_kurtosis == -3 for r in got)
    # a rises past b once, early; the row without a value has no side
    assert {r.start: r.swaps for r in got} == {0: 1, 4: 0}
    none = spark.createDataFrame([], SCHEMA)
    assert windows.all_features(none, N, STEP, ("a", "b"), ("va", "vb"), zero, **SETTINGS).count() == 0
    with pytest.raises(ValueError):
        windows.all_features(none, 12, 4, ("a", "b"), ("va", "vb"), zero, **SETTINGS)
