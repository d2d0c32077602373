"""Forests over window features: fit, leave-one-group-out, grids, and the whole path from log to verdict."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import evaluate, joins, physics, signals, timebase, verdict, windows
from .trees import Forest, fit_trees, score_trees, seeds_at_once


def fit_forest(df: DataFrame, features: list[str], label: str, trees: int = 400, depth: int = 12, seed: int = 0) -> Forest:
    """A class-balanced forest of extremely randomised trees for ``label`` (0 or 10)."""
    return fit_trees(df, features, label, None, [seed], trees, depth)


def predict(model: Forest, df: DataFrame, features: list[str], group: str | None = None) -> DataFrame:
    """``df`` with ``p``, the probability of class 10; with ``group`` by the fit that has not seen the row's group."""
    if list(features) != list(model.features):
        raise ValueError("the forest was fitted on other features")
    return score_trees(model, df, group).withColumn("p", F.get("ps", 0)).drop("ps")


def logo_cv(df: DataFrame, features: list[str], label: str, group: str, seed: int = 0, **forest) -> DataFrame:
    """Out-of-fold probabilities, leaving one group out at a time; all folds share the passes over ``df``. An empty table gives no rows."""
    return predict(fit_trees(df, features, label, group, [seed], **forest), df, features, group)


def ablation_grid(df: DataFrame, features: list[str], label: str, group: str, drops: Iterable[tuple[str, list[str]]], seeds: Iterable[int] = (0,), **forest) -> DataFrame:
    """Metrics of each set of dropped features and each seed: ``feature_set, seed, macro_f1, accuracy``.

    Folds share passes, and so do, after the first one, as many seeds as its number of nodes lets hold at once.
    """
    out, seeds = None, list(seeds)
    for name, drop in drops:
        begun, at_once = 0, 1
        while begun < len(seeds):
            some = seeds[begun : begun + at_once]
            fitted = fit_trees(df, [c for c in features if c not in drop], label, group, some, **forest)
            begun, at_once = begun + at_once, seeds_at_once(fitted) if begun == 0 else at_once
            each = F.explode(F.transform("ps", lambda p, k: F.struct(F.get(F.array(*map(F.lit, some)), k).alias("seed"), p.alias("p")))).alias("x")  # noqa: B023
            scored = score_trees(fitted, df, group).select(F.col(label).alias("truth"), each).select("truth", "x.*")
            rows = evaluate.evaluate(evaluate.guessed(scored), ["seed"]).select(F.lit(name).alias("feature_set"), "seed", "macro_f1", "accuracy")
            out = rows if out is None else out.unionByName(rows)
    return out


def seed_sweep(df: DataFrame, features: list[str], label: str, group: str, seeds: Iterable[int] = range(5), **forest) -> DataFrame:
    """Leave-one-group-out again for every seed: ``metric, mean, least, most, spread, n_seeds``."""
    rows = ablation_grid(df, features, label, group, [("all", [])], seeds, **forest)
    long = rows.select("seed", F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).alias("v")) for c in ("macro_f1", "accuracy")])).alias("x")).select("seed", "x.*")
    return long.groupBy("metric").agg(F.avg("v").alias("mean"), F.min("v").alias("least"), F.max("v").alias("most"), (F.max("v") - F.min("v")).alias("spread"), F.count("*").alias("n_seeds"))


@dataclass(frozen=True)
class Reference:
    """What reasons are stated against, out of the windows that a model was trained on."""

    stats: dict[str, tuple[float, float]]
    posture: float
    minhalf: float
    band: tuple[float, float]


def posture(angles: tuple[str, str]) -> Column:
    """How far both sides lie above the recording's own rest angles."""
    return F.least(*[F.col(f"{c}_med") for c in angles])


def reference(df: DataFrame, features: list[str], label: str, angles: tuple[str, str] = ("a", "b"), posture_limit: float = 0.99, minhalf_limit: float = 0.05) -> Reference:
    """Ranges of the features, the posture limit, the least swing of the high class and the band of amplitudes, out of training windows."""
    stats = {r.feature: (r.p01, r.p99) for r in windows.reference_stats(df, features).collect()}
    limits = df.agg(F.percentile(posture(angles), posture_limit).alias("p"), F.percentile(F.when(F.col(label) == 10, F.col("minhalf")), minhalf_limit).alias("m")).first()
    band = windows.amplitude_band(df.withColumn("__label", F.col(label).cast("string")), "minhalf", "__label", "0", "10").first()
    return Reference(stats, limits.p, float("-inf") if limits.m is None else limits.m, (band.band_low, band.band_high))


def on_grid(rows: DataFrame, channels: list[str], step: float, n: int) -> tuple[DataFrame, DataFrame]:
    """Channels on the uniform grid as rows of windows (``rec, segment, id, t, i, channels``), and the health of each recording."""
    grid = signals.grid_linear(rows, ["rec", "segment"], channels, step=step)
    grid = grid.select("rec", F.col("segment").cast("long").alias("segment"), F.col("k").alias("id"), F.col("grid_t").alias("t"), F.col("k").alias("i"), *channels)
    per = grid.groupBy("rec", "segment").agg(F.count("*").alias("n_source_rows"))
    return grid, timebase.health_check(grid, channels, per, least_rows=n)


def explain_rows(grid: DataFrame, scored: DataFrame, names: list[str], ref: Reference, n: int, step: int, threshold: float, angles: tuple[str, str] = ("a", "b"), band_abstains: bool = False) -> DataFrame:
    """Each row of the grid with its call and its reason, out of windows with ``p`` and all features.

    Rows whose swing lies in the band of both classes are ``in_band``; only with ``band_abstains`` that alone
    makes them ambiguous.
    """
    means = ["p", "swaps", "minhalf", "n_oob", "posture"]
    per = scored.withColumns({"n_oob": verdict.oob_count(scored, {c: ref.stats[c] for c in names}).cast("double"), "posture": posture(angles), "swaps": F.col("swaps").cast("double")})
    called = verdict.commit_rule(verdict.row_probability(grid, per.select("rec", "segment", "start", *means), n, step, means), threshold)
    banded = verdict.band_abstain(called.withColumn("__ambiguous", F.col("ambiguous")), "minhalf", *ref.band)
    called = banded.drop("__ambiguous") if band_abstains else banded.withColumn("ambiguous", F.col("__ambiguous")).drop("__ambiguous")
    called = verdict.near_change(called, ["rec"], ["t", "segment", "id"], "guess", max(1, n // 2))
    return verdict.reason_cascade(called, ref.posture, ref.minhalf)


def label_recordings(rows: DataFrame, grid: DataFrame, health: DataFrame, features: DataFrame, names: list[str], model: Forest, ref: Reference, n: int, step: int, threshold: float, tick: float, group: str | None = None, refusals: DataFrame | None = None, trusted: DataFrame | None = None, least_rows: int = 3000) -> DataFrame:
    """All recordings from bridged, resampled, checked rows to delivered input rows: score windows, average over rows, commit, explain, map back, project.

    ``grid`` and ``health`` are :func:`on_grid` of the bridged ``rows``. Each input row takes the call of the
    nearest row of the grid; further than a ``tick`` from any it is uncovered. A recording is served if ``refusals`` (``rec, refusal``,
    the serve gate) doesn't name it and its health allows scoring; the rows of the others are all uncovered, and
    ``refusal`` says why, the gate before health. With ``group`` windows are scored by the fit that has not seen theirs. Rows carry the
    reason's text, the alternative, the number of windows behind the call, and their recording's ``plausibility``: findings on the
    scored rows (``trusted``: ``rec, rest_trusted``), which refuse nothing.
    """
    declined = health.filter("not usable").select("rec", F.array_join("errors", "; ").alias("refusal"))
    if refusals is not None:
        both = refusals.select("rec", F.lit(0).alias("__k"), "refusal").unionByName(declined.select("rec", F.lit(1).alias("__k"), "refusal"))
        declined = both.groupBy("rec").agg(F.min_by("refusal", "__k").alias("refusal"))
    served = health.select("rec").join(declined, "rec", "left_anti")
    scored = predict(model, features.join(served, "rec", "left_semi"), names, group)
    called = explain_rows(grid.join(served, "rec", "left_semi"), scored, names, ref, n, step, threshold)
    call = F.struct("guess", "confidence", "ambiguous", "reason", "n_windows").alias("__call")
    found = joins.asof_nearest(rows, called.select("rec", "t", call), "rec", "t", "__call", tick, True)
    mapped = found.withColumns({c: F.col(f"__call.{c}") for c in ("guess", "confidence")}).withColumns({"ambiguous": F.coalesce("__call.ambiguous", F.lit(True)), "reason": F.coalesce("__call.reason", F.lit(verdict.REASONS[0])), "n_windows": F.coalesce("__call.n_windows", F.lit(0))})
    text, alternative = verdict.reason_texts(F.col("reason"))
    mapped = mapped.withColumns({"reason_detail": text, "alternative": alternative})
    seen = called.withColumn("physics", physics.swap_verdict(F.col("swaps"), mean=True))
    seen = seen.withColumn("rest_trusted", F.lit(True)) if trusted is None else seen.join(trusted, "rec", "left").withColumn("rest_trusted", F.coalesce("rest_trusted", F.lit(False)))
    findings = physics.plausibility_check(physics.file_stats(seen, "rec"), "rec", least_rows).groupBy("rec").agg(F.array_join(F.sort_array(F.collect_list("finding")), ",").alias("plausibility"))
    out = mapped.join(declined, "rec", "left").join(findings, "rec", "left")
    return verdict.verdict_projection(out, ["rec", "segment", "id", "t", "refusal"], ("n_windows", "reason_detail", "alternative", "plausibility"))


def fault_controls(grid: DataFrame, channels: list[str], angles: tuple[str, str], score: Callable[[DataFrame], DataFrame], n: int, least_rows: int) -> DataFrame:
    """Health and plausibility of each recording, run again on a copy with each fault: ``rec, fault, shares, caught_by``.

    ``score`` gives the rows of a copy that can be served their ``guess, ambiguous, swaps, rest_trusted``; ``caught_by`` is
    empty where nothing says anything, and the copy without a fault is the control.
    """
    copies, out = physics.with_faults(grid, *angles), None
    for fault in ("none", "duplicated", "dead", "swapped"):
        copy = copies.filter(F.col("fault") == fault).drop("fault")
        per = copy.groupBy("rec", "segment").agg(F.count("*").alias("n_source_rows"))
        health = timebase.health_check(copy, channels, per, least_rows=n)
        called = score(copy.join(health.filter("usable").select("rec"), "rec", "left_semi")).withColumn("physics", physics.swap_verdict(F.col("swaps"), mean=True))
        stats = physics.file_stats(called, "rec")
        found = physics.plausibility_check(stats, "rec", least_rows).groupBy("rec").agg(F.sort_array(F.collect_list("finding")).alias("findings"))
        none = F.array().cast("array<string>")
        row = health.join(stats.drop("rest_trusted"), "rec", "left").join(found, "rec", "left")
        row = row.select("rec", F.lit(fault).alias("fault"), "committed_frac", "model_walk_frac", "physics_walk_frac", F.concat("errors", "warnings", F.coalesce("findings", none)).alias("caught_by"))
        out = row if out is None else out.unionByName(row)
    return out
