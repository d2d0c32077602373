"""Queries on models; forests draw their cuts by hashes that SQL lacks, so they have no SQL (tests/test_trees.py grows them one by one)."""

from __future__ import annotations

from pyspark.sql import functions as F

from recsense.operators import model as op
from recsense.operators import signals, timebase, trees, verdict, windows

from .registry import query
from .trust import served as gate
from .views import ev, kept
from .windows import ANGLES, N, RATES, STEP, features, rows

#: Interval of the grid in ms, weight of the low pass, block of rows that it is run in.
TICK, WEIGHT, BLOCK = 6 * 3600 * 1000.0, 0.3, 32


def walks(df):
    """Whether more rows of a window are labelled walking than standing."""
    count = lambda c: (F.col("code") == c).cast("long")
    known = windows.over_panes(df, N, STEP, {"nl": count(0), "nh": count(10)}, {}, {})
    return known.select("rec", "segment", "start", F.when(F.col("nh") > F.col("nl"), 10).otherwise(0).alias("label"))


def grouped(df):
    return df.withColumn("grp", F.concat(F.lit("g"), (F.col("rec") % 3).cast("string")))


def labelled(spark, sf_dir):
    """Window features with the class that most of their rows are labelled with, and a group of recordings."""
    x = kept(rows(spark, sf_dir), "model-rows")
    found, names = features(x)
    return kept(grouped(found.join(walks(x), ["rec", "segment", "start"])), "model-windows"), names


def served(spark, sf_dir):
    """Input rows, the grid of the bridged rows, its health, its windows with the class that most of their rows have, and the features' names."""
    raw = kept(timebase.gap_segments(ev(spark, sf_dir)).select("rec", "segment", "id", "t", "a", "b", "code", "row_idx"), "raw-rows")
    mirrored = F.col("rec") % 4 == 1
    left, right = F.when(mirrored, F.col("b")).otherwise(F.col("a")), F.when(mirrored, F.col("a")).otherwise(F.col("b"))
    bridged = kept(signals.raw_to_features(raw, {"a": left, "b": right, "va": left - 50.0, "vb": right - 50.0}, WEIGHT, BLOCK), "bridged-rows")
    grid, health = op.on_grid(bridged, [*ANGLES, *RATES], TICK, N)
    grid = kept(grid.withColumn("d", F.col("a") - F.col("b")), "grid-rows")
    found, names = features(grid)
    code = signals.grid_nearest(raw, ["rec", "segment"], ["code"], step=TICK).select("rec", "segment", F.col("k").alias("i"), "code")
    return raw, grid, health, kept(grouped(found.join(walks(code), ["rec", "segment", "start"])), "served-windows"), names


@query("fit_forest")
def fit_forest(spark, sf_dir):
    data, names = labelled(spark, sf_dir)
    model = op.fit_forest(data, names, "label")
    return op.predict(model, data, names).groupBy("label").agg(F.count("*").alias("n"), F.round(F.avg("p"), 6).alias("mean_p"))


@query("feature_importance")
def feature_importance(spark, sf_dir):
    data, names = labelled(spark, sf_dir)
    model = op.fit_forest(data, names, "label")
    return verdict.feature_importance(trees.importances(model), names, spark, "a_")


@query("logo_cv")
def logo_cv(spark, sf_dir):
    data, names = labelled(spark, sf_dir)
    return op.logo_cv(data, names, "label", "grp").groupBy("grp", "label").agg(F.count("*").alias("n"), F.round(F.avg("p"), 6).alias("mean_p"))


@query("ablation_grid")
def ablation_grid(spark, sf_dir):
    data, names = labelled(spark, sf_dir)
    return op.ablation_grid(data, names, "label", "grp", [("all", []), ("no_a", ["a_std", "a_ptp"])])


@query("label_recordings")
def label_recordings(spark, sf_dir):
    """Every recording is scored by the forest that has not seen its group, unless it can't be served."""
    raw, grid, health, data, names = served(spark, sf_dir)
    model = op.fit_trees(data, names, "label", "grp")
    trusted = windows.rest_reference(grid, [*ANGLES, "d"], "d", 8, 20.0).select("rec", "rest_trusted")
    return op.label_recordings(raw, grid, health, data, names, model, op.reference(data, names, "label"), N, STEP, 0.85, TICK, "grp", refusals(spark, sf_dir), trusted)


def refusals(spark, sf_dir):
    """``rec, refusal`` of the recordings that the serve gate declines."""
    return gate(spark, sf_dir).filter("refusal is not null").select(F.col("file").alias("rec"), "refusal")


@query("seed_sweep")
def seed_sweep(spark, sf_dir):
    data, names = labelled(spark, sf_dir)
    return op.seed_sweep(data, names, "label", "grp")


@query("fault_controls")
def fault_controls(spark, sf_dir):
    _, grid, _, data, names = served(spark, sf_dir)
    model, ref = op.fit_trees(data, names, "label", "grp"), op.reference(data, names, "label")

    def score(copy):
        x = kept(copy.withColumn("d", F.col("a") - F.col("b")), "fault-rows")
        trusted = windows.rest_reference(x, [*ANGLES, "d"], "d", 8, 20.0).select("rec", "rest_trusted")
        scored = op.predict(model, grouped(kept(features(x)[0], "fault-windows")), names, "grp")
        return op.explain_rows(x, scored, names, ref, N, STEP, 0.85).join(trusted, "rec")

    return op.fault_controls(grid, [*ANGLES, *RATES], ANGLES, score, N, N)
