"""Every registered query of the log operators with SQL gives the SQL's rows; the others run."""

import os

import pytest
from oracle import connection, differences

from recsense import plans

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connection(SF)


@pytest.mark.parametrize("name", sorted(plans.sql()))
def test_query_equals_sql(spark, con, name):
    more, missing = differences(spark, con, plans.queries()[name], plans.sql()[name], SF)
    assert not more and not missing, (list(more.items())[:3], list(missing.items())[:3])


WINDOWED = ["stride_period", "adaptive_verdict", "trial_anchor_table"]


@pytest.mark.parametrize("name", WINDOWED)
def test_query_has_a_row_per_window(spark, name):
    """One row for each window that SQL finds; the values are held against scalar walks in test_physics.py."""
    key = ["rec", "segment", "start"]
    want = plans.queries()["sliding_windows"](spark, SF).select(key).collect()
    got = plans.queries()[name](spark, SF).select(key).collect()
    assert sorted(got) == sorted(want) and len(got) > 50


def test_adaptive_verdict_is_consistent(spark):
    rows = plans.queries()["trial_anchor_table"](spark, SF).collect()
    assert all((r.span_swaps == 0) == (r.verdict == "STANDING") and (r.span_swaps == 1) == (r.verdict == "AMBIGUOUS") for r in rows)
    assert all(16 <= r.span <= 96 and 0 <= r.periodicity <= 1 and (r.period is None or 2 / 16 <= r.period <= 12 / 16) for r in rows)


def test_rate_invariance_reports_each_anchor(spark):
    rows = {r.anchor: r for r in plans.queries()["rate_invariance"](spark, SF).collect()}
    assert set(rows) == {"periodicity", "antiphase", "grav_stab", "gyro_energy"}
    assert not rows["gyro_energy"].invariant and all(0 <= r.median_change <= r.p90_change for r in rows.values())
    assert all(r.n_windows >= r.n_walking == r.n_audited + r.n_skipped and r.n_audited > 0 for r in rows.values())


def test_feature_vector_has_all_features_of_every_window(spark):
    df = plans.queries()["feature_vector"](spark, SF)
    rows = df.collect()
    assert len(rows) == plans.queries()["sliding_windows"](spark, SF).count() > 50
    assert {len(r.features) for r in rows} == {42}
    assert len({tuple(r.features) for r in rows}) > len(rows) // 2


def test_label_recordings_calls_every_row(spark):
    df = plans.queries()["label_recordings"](spark, SF)
    assert df.filter("guess is not null and guess not in (0, 10)").count() == 0 and df.count() > 0


def test_entry_and_registry(spark):
    import __spark_entry__

    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert __spark_entry__.entry(spark).count() > 0
