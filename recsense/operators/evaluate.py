"""Evaluation tables over scored rows: class metrics, selective curves, gates, ledgers of experiments.

Scored rows have ``truth`` and the probability ``p`` of class ``HIGH``; every table is one or two aggregations
over them. Thresholds and policies are parameters, so the tables that are joined to every row are as small as
the caller's lists.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recsense.functions.columns import flag, ratio

LOW, HIGH = 0, 10


def guessed(df: DataFrame) -> DataFrame:
    """``df`` with ``guess, conf, ok`` (conf = the larger probability)."""
    guess = F.when(F.col("p") >= 0.5, HIGH).otherwise(LOW)
    return df.withColumn("guess", guess).withColumn("conf", F.greatest("p", 1.0 - F.col("p"))).withColumn("ok", F.col("guess") == F.col("truth"))


def n_if(condition: Column) -> Column:
    return F.coalesce(F.sum(flag(condition).cast("long")), F.lit(0))


def zero_ratio(a: Column, b: Column) -> Column:
    """a / b, 0 where undefined."""
    return F.coalesce(ratio(a, b), F.lit(0.0))


def confusion(df: DataFrame, by: list[str]) -> DataFrame:
    """Counts of the four cells, per group."""
    cell = lambda t, g: n_if((F.col("truth") == t) & (F.col("guess") == g))
    cells = [cell(LOW, LOW).alias("ll"), cell(LOW, HIGH).alias("lh"), cell(HIGH, LOW).alias("hl"), cell(HIGH, HIGH).alias("hh")]
    return (df.groupBy(*by) if by else df.groupBy()).agg(*cells)


def scores_of_cells(cells: DataFrame) -> DataFrame:
    """Recall, precision and F1 of both classes (0 where undefined), macro-F1, accuracy, balanced accuracy."""
    c = {k: F.col(k) for k in ("ll", "lh", "hl", "hh")}
    out = cells.withColumn("low_precision", zero_ratio(c["ll"], c["ll"] + c["hl"])).withColumn("low_recall", zero_ratio(c["ll"], c["ll"] + c["lh"]))
    out = out.withColumn("high_precision", zero_ratio(c["hh"], c["hh"] + c["lh"])).withColumn("high_recall", zero_ratio(c["hh"], c["hh"] + c["hl"]))
    for k in ("low", "high"):
        p, r = F.col(f"{k}_precision"), F.col(f"{k}_recall")
        out = out.withColumn(f"{k}_f1", zero_ratio(2.0 * p * r, p + r))
    out = out.withColumn("n", c["ll"] + c["lh"] + c["hl"] + c["hh"]).withColumn("macro_f1", (F.col("low_f1") + F.col("high_f1")) / 2.0)
    return out.withColumn("accuracy", zero_ratio(c["ll"] + c["hh"], F.col("n"))).withColumn("balanced_accuracy", (F.col("low_recall") + F.col("high_recall")) / 2.0)


def class_metrics(df: DataFrame) -> DataFrame:
    """One row per class: precision, recall, F1, support."""
    s = scores_of_cells(confusion(df, []))
    row = lambda code, k, support: F.struct(F.lit(code).alias("code"), F.col(f"{k}_precision").alias("precision"), F.col(f"{k}_recall").alias("recall"), F.col(f"{k}_f1").alias("f1"), support.alias("support"))
    return s.select(F.explode(F.array(row(LOW, "low", F.col("ll") + F.col("lh")), row(HIGH, "high", F.col("hl") + F.col("hh")))).alias("x")).select("x.*")


def evaluate(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Macro-F1 (over both classes always), accuracy, balanced accuracy, per group or overall."""
    return scores_of_cells(confusion(df, by or []))


def at_thresholds(df: DataFrame, thresholds: list[float]) -> DataFrame:
    """Each row once per threshold, by exploding a literal list: no join."""
    return df.withColumn("threshold", F.explode(F.array(*map(F.lit, thresholds))))


def selective_curve(df: DataFrame, thresholds: list[float], group: str = "rev") -> DataFrame:
    """Per threshold: coverage, committed rows, selective accuracy, errors, and the worst group (ties by name)."""
    on = F.col("conf") >= F.col("threshold")
    per = at_thresholds(guessed(df), thresholds).groupBy("threshold", group).agg(F.count("*").alias("rows"), n_if(on).alias("n"), n_if(on & F.col("ok")).alias("n_ok"))
    worst = F.min(F.when(F.col("n") > 0, F.struct((F.col("n_ok") / F.col("n")).alias("accuracy"), F.col(group).alias("name"))))
    out = per.groupBy("threshold").agg(F.sum("rows").alias("rows"), F.sum("n").alias("n"), F.sum("n_ok").alias("n_ok"), worst.alias("w"))
    return out.select("threshold", ratio(F.col("n"), F.col("rows")).alias("coverage"), "n", ratio(F.col("n_ok"), F.col("n")).alias("accuracy"), (F.col("n") - F.col("n_ok")).alias("errors"), F.col("w.accuracy").alias("worst_accuracy"), F.col("w.name").alias("worst_group"))


def per_subject(df: DataFrame, threshold: float, group: str = "rev") -> DataFrame:
    """Per group: coverage, accuracy, errors, recall of each class with its denominator, over committed rows."""
    on = F.col("conf") >= threshold
    is_ = lambda code: on & (F.col("truth") == code)
    out = guessed(df).groupBy(group).agg(F.count("*").alias("rows"), n_if(on).alias("n"), n_if(on & F.col("ok")).alias("n_ok"), n_if(is_(LOW)).alias("n_low"), n_if(is_(LOW) & F.col("ok")).alias("ok_low"), n_if(is_(HIGH)).alias("n_high"), n_if(is_(HIGH) & F.col("ok")).alias("ok_high"))
    return out.select(group, ratio(F.col("n"), F.col("rows")).alias("coverage"), ratio(F.col("n_ok"), F.col("n")).alias("accuracy"), (F.col("n") - F.col("n_ok")).alias("errors"), ratio(F.col("ok_low"), F.col("n_low")).alias("low_recall"), "n_low", ratio(F.col("ok_high"), F.col("n_high")).alias("high_recall"), "n_high")


def committed_confusion(df: DataFrame, threshold: float) -> DataFrame:
    """Truth by guess on committed rows, all four cells, and the abstained; the dominant direction of error."""
    on = F.col("conf") >= threshold
    g = guessed(df)
    cells = confusion(g.filter(on), []).crossJoin(g.agg(n_if(~on).alias("abstained")))
    direction = F.when(F.col("lh") > F.col("hl"), "low_to_high").when(F.col("hl") > F.col("lh"), "high_to_low").otherwise("even")
    return cells.withColumn("dominant", direction)


def reason_report(df: DataFrame, threshold: float, reason: str = "reason") -> DataFrame:
    """Rows and would-be accuracy per reason of abstention, and of the committed rows as ``confident``."""
    name = F.when(F.col("conf") >= threshold, "confident").otherwise(F.col(reason))
    return guessed(df).groupBy(name.alias("reason")).agg(F.count("*").alias("n"), F.avg(F.col("ok").cast("double")).alias("accuracy"))


def unknown_agreement(df: DataFrame, threshold: float, unknown: Column) -> DataFrame:
    """Share of rows abstained from where the human was unsure, and elsewhere."""
    off = (F.col("conf") < threshold).cast("double")
    return guessed(df).agg(F.avg(F.when(unknown, off)).alias("on_unknown"), F.avg(F.when(~unknown, off)).alias("elsewhere"))


def physics_gate(df: DataFrame, thresholds: list[float], agrees: Column, band: Column, floor: float = 0.70, step: float = 0.0025) -> DataFrame:
    """Policies off / ceiling / floor / both at each threshold, each beside the ``off`` point of nearest coverage.

    ``floor`` commits from ``floor`` on where the second opinion agrees; ``ceiling`` abstains where ``band`` holds.
    The ``off`` points sweep 0.5 to 1 in steps; of equal distances the first counts.
    """
    g = guessed(df).withColumn("__agrees", flag(agrees)).withColumn("__band", flag(band))
    # all conditions depend on few numbers: the rows are counted by them first, the policies look at the counts
    cube = g.groupBy("conf", "__agrees", "__band").agg(F.count("*").alias("rows"), n_if(F.col("ok")).alias("ok"))
    policy = F.explode(F.array(*[F.struct(F.lit(n).alias("policy"), F.lit(f).alias("fl"), F.lit(c).alias("ce")) for n, f, c in (("off", False, False), ("ceiling", False, True), ("floor", True, False), ("both", True, True))])).alias("x")
    spread = at_thresholds(cube, thresholds).select("*", policy)
    least = F.when(F.col("x.fl") & F.col("__agrees"), F.least(F.lit(floor), F.col("threshold"))).otherwise(F.col("threshold"))
    on = (F.col("conf") >= least) & ~(F.col("x.ce") & F.col("__band"))
    counted = lambda c: F.sum(F.when(on, F.col(c)).otherwise(0))
    points = spread.groupBy(F.col("x.policy").alias("policy"), "threshold").agg(F.sum("rows").alias("rows"), counted("rows").alias("n"), counted("ok").alias("n_ok"))
    points = points.select("policy", "threshold", "n", (F.col("n") / F.col("rows")).alias("coverage"), (F.col("n") - F.col("n_ok")).alias("errors"))
    sweep = [round(0.5 + step * k, 4) for k in range(round(0.5 / step) + 1)]
    off = at_thresholds(cube, sweep).groupBy("threshold").agg(F.sum("rows").alias("rows"), F.sum(F.when(F.col("conf") >= F.col("threshold"), F.col("rows")).otherwise(0)).alias("n"), F.sum(F.when(F.col("conf") >= F.col("threshold"), F.col("ok")).otherwise(0)).alias("n_ok"))
    off = off.select(F.struct(F.col("threshold").alias("t"), (F.col("n") / F.col("rows")).alias("coverage"), (F.col("n") - F.col("n_ok")).alias("errors")).alias("o"))
    near = points.crossJoin(F.broadcast(off)).groupBy("policy", "threshold", "n", "coverage", "errors").agg(F.min_by("o", F.struct(F.round(F.abs(F.col("coverage") - F.col("o.coverage")), 12), F.col("o.t"))).alias("m"))
    return near.select("policy", "threshold", "n", "coverage", "errors", F.col("m.t").alias("off_threshold"), (F.col("coverage") - F.col("m.coverage")).alias("coverage_gap"), (F.col("errors") - F.col("m.errors")).alias("error_delta"))


def eval_summary(df: DataFrame, threshold: float, group: str, variant: str) -> DataFrame:
    """Coverage and accuracy overall, per group and per variant in one pass over the rows (grouping sets)."""
    on = F.col("conf") >= threshold
    per = guessed(df).groupingSets([[], [F.col(group)], [F.col(variant)]], group, variant).agg(F.count("*").alias("rows"), n_if(on).alias("n"), n_if(on & F.col("ok")).alias("n_ok"))
    level = F.when(F.col(group).isNotNull(), "group").when(F.col(variant).isNotNull(), "variant").otherwise("overall")
    return per.select(level.alias("level"), F.coalesce(F.col(group).cast("string"), F.col(variant).cast("string"), F.lit("")).alias("name"), "rows", ratio(F.col("n"), F.col("rows")).alias("coverage"), ratio(F.col("n_ok"), F.col("n")).alias("accuracy"))


def route_equivalence(one: DataFrame, two: DataFrame, key: list[str], columns: list[str], confidence: str) -> DataFrame:
    """One recording by two routes: mismatches of each verdict column, coverage mismatch, largest difference of confidence."""
    other = two.select(*key, *[F.col(c).alias(f"__{c}") for c in [*columns, confidence]])
    joined = one.join(other, key)
    return joined.agg(F.count("*").alias("n"), *[n_if(~F.col(c).eqNullSafe(F.col(f"__{c}"))).alias(f"diff_{c}") for c in columns], n_if(F.col(confidence).isNull() != F.col(f"__{confidence}").isNull()).alias("diff_coverage"), F.max(F.abs(F.col(confidence) - F.col(f"__{confidence}"))).alias("max_delta"))


def coverage_sweep(df: DataFrame, thresholds: list[float], file: str, within: float = 5e-5) -> tuple[DataFrame, DataFrame]:
    """``(per file and threshold, per threshold)``: committed rows, rows at the boundary; files below half and at zero."""
    on = F.col("conf") >= F.col("threshold")
    per = at_thresholds(df, thresholds).groupBy(file, "threshold").agg(F.count("*").alias("rows"), n_if(on).alias("committed"), n_if(F.abs(F.col("conf") - F.col("threshold")) < within).alias("boundary"))
    total = per.groupBy("threshold").agg(F.sum("rows").alias("rows"), F.sum("committed").alias("committed"), F.sum("boundary").alias("boundary"), n_if(F.col("committed") * 2 < F.col("rows")).alias("files_under_half"), n_if(F.col("committed") == 0).alias("files_at_zero"))
    return per, total


def seed_band(df: DataFrame, metrics: list[str], seed: str = "seed", shipped: int = 0) -> DataFrame:
    """Per metric over seeds: the shipped seed's value, mean, extremes, spread, and whether the shipped one is extreme."""
    long = df.select(seed, F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics])).alias("x")).select(seed, "x.*")
    out = long.groupBy("metric").agg(F.max(F.when(F.col(seed) == shipped, F.col("value"))).alias("shipped"), F.avg("value").alias("mean"), F.min("value").alias("least"), F.max("value").alias("most"))
    return out.withColumn("spread", F.col("most") - F.col("least")).withColumn("extreme", (F.col("shipped") == F.col("least")) | (F.col("shipped") == F.col("most")))


def ablation_compare(df: DataFrame, reference: str) -> DataFrame:
    """Per feature set over seeds: F1 mean, extremes, spread, coverage; a single-seed difference inside the widest spread is a tie."""
    per = df.groupBy("feature_set").agg(F.avg("f1").alias("f1_mean"), F.min("f1").alias("f1_min"), F.max("f1").alias("f1_max"), F.avg("coverage").alias("coverage"))
    per = per.withColumn("spread", F.col("f1_max") - F.col("f1_min"))
    band = per.agg(F.max("spread").alias("band"), F.max(F.when(F.col("feature_set") == reference, F.col("f1_mean"))).alias("base"))
    out = per.crossJoin(F.broadcast(band))
    return out.withColumn("delta", F.col("f1_mean") - F.col("base")).withColumn("tie", F.abs("delta") <= F.col("band")).drop("base")


def curve_monotonicity(curve: DataFrame) -> DataFrame:
    """Does accuracy ever fall as the threshold rises, and where most."""
    fall = F.lag("accuracy").over(Window.orderBy("threshold")) - F.col("accuracy")
    falls = curve.withColumn("fall", fall).agg(F.max("fall").alias("largest"), F.max_by("threshold", "fall").alias("at"), n_if(F.col("fall") > 0).alias("n_falls"))
    return falls.select((F.col("n_falls") > 0).alias("falls"), F.greatest(F.col("largest"), F.lit(0.0)).alias("largest_fall"), F.when(F.col("largest") > 0, F.col("at")).alias("at_threshold"))


def basis_fingerprint(df: DataFrame, classes: str, groups: str) -> DataFrame:
    """What a figure rests on: number of rows, classes and groups in order."""
    return df.agg(F.count("*").alias("n"), F.sort_array(F.collect_set(classes)).alias("classes"), F.sort_array(F.collect_set(groups)).alias("groups"))


def ledger_by_basis(ledger: DataFrame, current: DataFrame) -> DataFrame:
    """Ledger rows with ``basis``: same as the current fingerprint, or earlier (a missing one is earlier)."""
    now = current.select(F.col("fingerprint").alias("__now"))
    return ledger.crossJoin(F.broadcast(now)).withColumn("basis", F.when(flag(F.col("fingerprint") == F.col("__now")), "same").otherwise("earlier")).drop("__now")


def promotion_verdict(candidates: DataFrame, incumbent: DataFrame, gain: float = 0.005) -> DataFrame:
    """Per candidate: promote without an incumbent, keep if not comparable, promote from a gain of ``gain``."""
    joined = candidates.join(incumbent.select(F.col("slot").alias("__slot"), F.col("f1").alias("__f1"), F.col("basis").alias("__basis")), F.col("slot") == F.col("__slot"), "left")
    verdict = F.when(F.col("__slot").isNull(), "promote: none before").when(~flag(F.col("basis") == F.col("__basis")), "keep: not comparable").when(F.col("f1") - F.col("__f1") >= gain, "promote").otherwise("keep")
    return joined.select("slot", "f1", verdict.alias("verdict"))
