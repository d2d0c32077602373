"""Queries on one recording as long as the table: its rows lie in ranges, no task sorts it whole."""

from __future__ import annotations

from pyspark.sql import functions as F

from recsense.operators import scan as op

from . import joins, timebase, verdict  # noqa: F401 (their SQL is registered when they are imported)
from .registry import SQL, query
from .views import ev

ONE = "CAST(0 AS BIGINT) AS rec"


def whole(sql: str) -> str:
    """The SQL with all events as one recording."""
    return sql.replace("user_id AS rec", ONE)


def one(spark, sf_dir):
    return ev(spark, sf_dir).withColumn("rec", F.lit(0).cast("long"))


@query("long_time_profile", whole(SQL["time_profile"]))
def long_time_profile(spark, sf_dir):
    return timebase.rounded_profile(op.time_profile(one(spark, sf_dir)))


@query("long_gap_segments", whole(SQL["gap_segments"]))
def long_gap_segments(spark, sf_dir):
    return op.gap_segments(one(spark, sf_dir)).select("rec", "id", "segment", "row_idx")


@query("long_asof_nearest", whole(SQL["asof_nearest_tol_full"]))
def long_asof_nearest(spark, sf_dir):
    rows = one(spark, sf_dir)
    left, right = rows.filter("event_type = 'click'").select("rec", "id", "t"), rows.filter("event_type = 'purchase'").select("rec", "t", "a")
    return op.asof_nearest(left, right, "rec", "t", "a", 10 * joins.HOUR, False).select("rec", "id", "a")


@query("long_run_length", whole(SQL["run_length"]))
def long_run_length(spark, sf_dir):
    return op.runs(one(spark, sf_dir), ["rec"], ["t", "id"], "code")


@query("long_near_change", whole(SQL["near_change"]))
def long_near_change(spark, sf_dir):
    rows = one(spark, sf_dir).withColumn("guess", F.when(F.col("code") >= 0, F.col("code")))
    return op.near_change(rows, ["rec"], ["t", "id"], "guess", 2).select("rec", "id", "near_change")
