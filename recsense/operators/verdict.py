"""From window probabilities to one committed call per row, with a reason where it abstains."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recsense.functions.columns import filled, first_message, flag, ratio

LOW, HIGH = 0, 10
UNSURE, UNCOVERED = -1, 255
#: The reasons of an abstention in the order in which they are looked for, with their texts and what the row may be instead.
REASON_TEXTS = {
    "uncovered": ("no full window covers this row (segment shorter than the window, or a gap)", "unknown - not enough measured signal to judge"),
    "posture_shift": ("both thighs sit well above this recording's own standing posture: not upright", "a state outside {stand, walk}: sitting, sit-to-stand, or stand-to-sit"),
    "out_of_distribution": ("feature values fall outside the range seen anywhere in training", "unmodelled state, or a channel mapping error - check the input columns"),
    "near_transition": ("a predicted state change falls within one window of this row", "the other class - the boundary is real, its exact timing is not resolvable"),
    "weight_shift_or_step": ("interleg signal crosses once in the window: the swap rule's own AMBIGUOUS verdict", "stand (a weight shift) or walk (a single step) - one leg passing the other is both"),
    "low_excursion_gait": ("called walking, but the legs swing less than walking normally does", "stand (postural sway) or very slow shuffling gait"),
    "amplitude_ambiguous": (
        "the legs swing in the range where human annotators call both stand and walk, so no amplitude rule separates it and neither does a model reading amplitude",
        "either class - the ground truth itself is not consistent in this range",
    ),
    "model_split": ("the ensemble is genuinely divided with no single diagnostic cause", "the other class"),
}
REASONS = tuple(REASON_TEXTS)


def reason_texts(reason: Column) -> tuple[Column, Column]:
    """The text of a reason and the alternative it leaves; empty without a reason."""
    out = []
    for k in range(2):
        text = F.lit("")
        for name, both in REASON_TEXTS.items():
            text = F.when(reason == name, both[k]).otherwise(text)
        out.append(text)
    return out[0], out[1]

def row_probability(rows: DataFrame, windows: DataFrame, n: int, step: int, means: list[str], key: tuple[str, ...] = ("rec", "segment")) -> DataFrame:
    """``rows`` with the mean of each of ``means`` over the windows that cover the row (null without any), and ``n_windows``.

    Values are the same within a block of ``step`` rows, so they are averaged per block over a frame of starts.
    """
    blocks = rows.groupBy(*key, F.floor(F.col("i") / step).alias("__b")).agg(F.lit(1).alias("__one"))
    per = windows.select(*key, F.floor(F.col("start") / step).alias("__b"), *means, F.lit(1).alias("__w"))
    frame = Window.partitionBy(*key).orderBy("__b").rowsBetween(-(n // step - 1), 0)
    spread = blocks.join(per, [*key, "__b"], "left").select(*key, "__b", *[F.avg(c).over(frame).alias(c) for c in means], F.coalesce(F.sum("__w").over(frame), F.lit(0)).alias("n_windows"))
    return rows.withColumn("__b", F.floor(F.col("i") / step)).join(spread, [*key, "__b"]).drop("__b")


def oob_count(df: DataFrame, stats: dict[str, tuple[float, float]]) -> Column:
    """How many features lie outside their reference range."""
    return sum((flag((F.col(c) < lo) | (F.col(c) > hi)).cast("int") for c, (lo, hi) in stats.items()), F.lit(0))


def commit_rule(df: DataFrame, threshold: Column | float, p: str = "p") -> DataFrame:
    """``guess, conf`` (unrounded), ``confidence`` (4 decimals) and ``ambiguous``: uncovered or below the threshold."""
    covered = F.col(p).isNotNull() & ~F.isnan(p)
    guess = F.when(covered, F.when(F.col(p) >= 0.5, HIGH).otherwise(LOW))
    conf = F.when(covered, F.greatest(F.col(p), 1.0 - F.col(p)))
    limit = threshold if isinstance(threshold, Column) else F.lit(threshold)
    return df.withColumn("guess", guess).withColumn("conf", conf).withColumn("confidence", F.round(conf, 4)).withColumn("ambiguous", ~flag(conf >= limit))


def physics_floor(verdict: Column, guess: Column, threshold: float, floor: float = 0.70) -> Column:
    """The row's threshold: lower where the second opinion is decisive and agrees."""
    agrees = ((verdict == "WALKING") & (guess == HIGH)) | ((verdict == "STANDING") & (guess == LOW))
    return F.when(flag(agrees), F.lit(floor)).otherwise(F.lit(threshold))


def band_abstain(df: DataFrame, value: str, low: float, high: float) -> DataFrame:
    """``in_band``; rows in the band become ambiguous."""
    inside = flag(F.col(value).between(low, high)) & F.col("guess").isNotNull()
    return df.withColumn("in_band", inside).withColumn("ambiguous", F.col("ambiguous") | inside)


def near_change(df: DataFrame, rec: list[str], order: list[str], guess: str, half: int) -> DataFrame:
    """``near_change``: within ``half`` rows of a change of the guess, filled forward then backward over the whole recording."""
    w = Window.partitionBy(*rec).orderBy(*order)
    back = filled(F.col(guess), w)
    ahead = filled(F.col(guess), Window.partitionBy(*rec).orderBy(*[F.col(c).desc() for c in order]))
    rows = df.withColumn("__g", F.coalesce(back, ahead)).withColumn("__p", F.lag("__g").over(w))
    rows = rows.withColumn("__c", flag(F.col("__g") != F.col("__p")).cast("int"))
    return rows.withColumn("near_change", F.max("__c").over(w.rowsBetween(-(half - 1), half)) == 1).drop("__g", "__p", "__c")


def reason_cascade(df: DataFrame, posture_limit: float, minhalf_limit: float) -> DataFrame:
    """The first reason that holds, on ambiguous rows only.

    ``df``: ``guess, ambiguous, posture, n_oob, near_change, swaps, minhalf, in_band``.
    """
    reason = first_message(
        (F.col("guess").isNull(), REASONS[0]),
        (F.col("posture") > posture_limit, REASONS[1]),
        (F.coalesce("n_oob", F.lit(0)) >= 3, REASONS[2]),
        (F.col("near_change"), REASONS[3]),
        ((F.col("swaps") >= 0.5) & (F.col("swaps") < 1.5), REASONS[4]),
        ((F.col("guess") == HIGH) & (F.col("minhalf") < minhalf_limit), REASONS[5]),
        (F.col("in_band"), REASONS[6]),
        (F.lit(True), REASONS[7]),
    )
    return df.withColumn("reason", F.when(F.col("ambiguous"), reason).otherwise(""))


def verdict_projection(df: DataFrame, keep: list[str], more: tuple[str, ...] = ()) -> DataFrame:
    """The delivered columns: ``Label`` is the guess where committed, -1 where ambiguous, 255 where uncovered; ``more`` come last."""
    label = F.when(F.col("guess").isNull(), UNCOVERED).when(F.col("ambiguous"), UNSURE).otherwise(F.col("guess"))
    return df.select(*keep, label.alias("Label"), "guess", "confidence", "ambiguous", "reason", *more)


def rethreshold(verdicts: DataFrame, threshold: float) -> DataFrame:
    """A labelled table moved to another threshold; ``boundary`` rows have just that printed confidence."""
    label = F.when(F.col("guess").isNull(), UNCOVERED).when(F.col("confidence") >= threshold, F.col("guess")).otherwise(UNSURE)
    return verdicts.withColumn("Label", label).withColumn("boundary", flag(F.col("confidence") == threshold))


def sweep_summary(df: DataFrame, file: str = "file") -> DataFrame:
    """Per file: rows, committed rows and share, calls of each class, the commonest reason (ties: first by name)."""
    on = flag(~F.col("ambiguous"))
    per = df.groupBy(file).agg(F.count("*").alias("rows"), F.sum(on.cast("long")).alias("n_confident"), F.sum((on & (F.col("guess") == LOW)).cast("long")).alias("n_stand"), F.sum((on & (F.col("guess") == HIGH)).cast("long")).alias("n_walk"))
    reasons = df.filter("ambiguous").groupBy(file, "reason").count().groupBy(file).agg(F.min_by("reason", F.struct(-F.col("count"), "reason")).alias("top_reason"))
    return per.withColumn("confident_frac", ratio(F.col("n_confident"), F.col("rows"))).join(reasons, file, "left")


def abstention_groups(df: DataFrame) -> DataFrame:
    """Refusals by kind and exact message: how many files, first and last of them."""
    return df.groupBy("kind", "message").agg(F.count("*").alias("n"), F.min("file").alias("first_file"), F.max("file").alias("last_file"))


def label_summary_stats(df: DataFrame) -> DataFrame:
    """Shares of labelled rows, and of each reason among the ambiguous ones: ``what, name, n, share``."""
    total = df.agg(F.count("*").alias("__n"))
    state = F.when(F.col("guess").isNull(), "uncovered").when(F.col("ambiguous"), "ambiguous").otherwise(F.concat(F.lit("label "), F.col("guess").cast("string")))
    states = df.groupBy(state.alias("name")).agg(F.count("*").alias("n")).crossJoin(F.broadcast(total)).select(F.lit("state").alias("what"), "name", "n", ratio(F.col("n"), F.col("__n")).alias("share"))
    amb = df.filter("ambiguous")
    reasons = amb.groupBy(F.col("reason").alias("name")).agg(F.count("*").alias("n")).crossJoin(F.broadcast(amb.agg(F.count("*").alias("__n")))).select(F.lit("reason").alias("what"), "name", "n", ratio(F.col("n"), F.col("__n")).alias("share"))
    return states.unionByName(reasons)


def feature_importance(importances: list[float], names: list[str], spark, prefix: str) -> DataFrame:
    """A model's importances with names and ranks, and the share of features with a prefix."""
    df = spark.createDataFrame(list(zip(names, map(float, importances), strict=True)), "feature string, importance double")
    rank = F.row_number().over(Window.orderBy(F.col("importance").desc(), "feature"))
    share = F.sum(F.when(F.col("feature").startswith(prefix), F.col("importance")).otherwise(0.0)).over(Window.partitionBy())
    return df.withColumn("rank", rank).withColumn("prefix_share", share)
