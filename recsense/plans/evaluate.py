"""Queries on evaluation tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from recsense.operators import evaluate as op

from .registry import query
from .views import SCORE, score

T5 = [0.55, 0.65, 0.75, 0.85, 0.95]
THR = "thr AS (SELECT unnest([0.55e0, 0.65e0, 0.75e0, 0.85e0, 0.95e0]) AS threshold)"
G = SCORE + """, g AS (SELECT *, CASE WHEN p >= 0.5 THEN 10 ELSE 0 END AS guess, greatest(p, 1.0e0 - p) AS conf, (CASE WHEN p >= 0.5 THEN 10 ELSE 0 END) = truth AS ok FROM score)"""
CELLS = """sum(CASE WHEN truth = 0 AND guess = 0 THEN 1 ELSE 0 END) AS ll, sum(CASE WHEN truth = 0 AND guess = 10 THEN 1 ELSE 0 END) AS lh,
  sum(CASE WHEN truth = 10 AND guess = 0 THEN 1 ELSE 0 END) AS hl, sum(CASE WHEN truth = 10 AND guess = 10 THEN 1 ELSE 0 END) AS hh"""


def metrics_sql(by: str) -> str:
    key, group = (f"{by}, ", f"GROUP BY {by}") if by else ("", "")
    return f"""c AS (SELECT {key}{CELLS} FROM g {group}), m AS (
  SELECT *, coalesce(ll / nullif(ll + hl, 0), 0) AS lp, coalesce(ll / nullif(ll + lh, 0), 0) AS lr, coalesce(hh / nullif(hh + lh, 0), 0) AS hp, coalesce(hh / nullif(hh + hl, 0), 0) AS hr FROM c
), f AS (SELECT *, coalesce(2 * lp * lr / nullif(lp + lr, 0), 0) AS lf, coalesce(2 * hp * hr / nullif(hp + hr, 0), 0) AS hf FROM m)"""


def rounded(df, *names, places=6):
    return df.withColumns({c: F.round(c, places) for c in names})


@query("class_metrics", f"""WITH {G}, {metrics_sql('')} SELECT 0 AS code, round(lp, 6) AS precision, round(lr, 6) AS recall, round(lf, 6) AS f1, CAST(ll + lh AS BIGINT) AS support FROM f
UNION ALL SELECT 10, round(hp, 6), round(hr, 6), round(hf, 6), CAST(hl + hh AS BIGINT) FROM f""")
def class_metrics(spark, sf_dir):
    return rounded(op.class_metrics(op.guessed(score(spark, sf_dir))), "precision", "recall", "f1")


EVAL = "round((lf + hf) / 2, 6) AS macro_f1, round((ll + hh) / (ll + lh + hl + hh), 6) AS accuracy, round((lr + hr) / 2, 6) AS balanced_accuracy, CAST(ll + lh + hl + hh AS BIGINT) AS n"


@query("evaluate", f"WITH {G}, {metrics_sql('')} SELECT {EVAL} FROM f")
def evaluate(spark, sf_dir):
    return rounded(op.evaluate(op.guessed(score(spark, sf_dir))).select("macro_f1", "accuracy", "balanced_accuracy", "n"), "macro_f1", "accuracy", "balanced_accuracy")


@query("evaluate_by_group", f"WITH {G}, {metrics_sql('rev')} SELECT rev, {EVAL} FROM f")
def evaluate_by_group(spark, sf_dir):
    return rounded(op.evaluate(op.guessed(score(spark, sf_dir)), ["rev"]).select("rev", "macro_f1", "accuracy", "balanced_accuracy", "n"), "macro_f1", "accuracy", "balanced_accuracy")


CURVE = G + f""", {THR}, per AS (SELECT threshold, rev, count(*) AS rows, sum(CASE WHEN conf >= threshold THEN 1 ELSE 0 END) AS n, sum(CASE WHEN conf >= threshold AND ok THEN 1 ELSE 0 END) AS n_ok FROM g CROSS JOIN thr GROUP BY threshold, rev
), curve AS (SELECT threshold, sum(n) / sum(rows) AS coverage, CAST(sum(n) AS BIGINT) AS n, sum(n_ok) / sum(n) AS accuracy, CAST(sum(n) - sum(n_ok) AS BIGINT) AS errors, min(CASE WHEN n > 0 THEN n_ok / n END) AS worst_accuracy,
  arg_min(rev, (n_ok / n, rev)) AS worst_group FROM per GROUP BY threshold)"""


@query("selective_curve", f"WITH {CURVE} SELECT threshold, round(coverage, 6) AS coverage, n, round(accuracy, 6) AS accuracy, errors, round(worst_accuracy, 6) AS worst_accuracy, worst_group FROM curve")
def selective_curve(spark, sf_dir):
    return rounded(op.selective_curve(score(spark, sf_dir), T5), "coverage", "accuracy", "worst_accuracy")


@query("curve_monotonicity", f"""WITH {CURVE}, d AS (SELECT threshold, lag(accuracy) OVER (ORDER BY threshold) - accuracy AS fall FROM curve)
SELECT max(fall) > 0 AS falls, round(greatest(max(fall), 0.0e0), 6) AS largest_fall, CASE WHEN max(fall) > 0 THEN arg_max(threshold, fall) END AS at_threshold FROM d""")
def curve_monotonicity(spark, sf_dir):
    return rounded(op.curve_monotonicity(op.selective_curve(score(spark, sf_dir), T5)), "largest_fall")


@query("per_subject", f"""WITH {G} SELECT rev, round(sum(CASE WHEN conf >= 0.85 THEN 1 ELSE 0 END) / count(*), 6) AS coverage, round(sum(CASE WHEN conf >= 0.85 AND ok THEN 1 ELSE 0 END) / sum(CASE WHEN conf >= 0.85 THEN 1 ELSE 0 END), 6) AS accuracy,
  CAST(sum(CASE WHEN conf >= 0.85 AND NOT ok THEN 1 ELSE 0 END) AS BIGINT) AS errors, round(count(*) FILTER (WHERE conf >= 0.85 AND truth = 0 AND ok) / count(*) FILTER (WHERE conf >= 0.85 AND truth = 0), 6) AS low_recall, count(*) FILTER (WHERE conf >= 0.85 AND truth = 0) AS n_low,
  round(count(*) FILTER (WHERE conf >= 0.85 AND truth = 10 AND ok) / count(*) FILTER (WHERE conf >= 0.85 AND truth = 10), 6) AS high_recall, count(*) FILTER (WHERE conf >= 0.85 AND truth = 10) AS n_high FROM g GROUP BY rev""")
def per_subject(spark, sf_dir):
    return rounded(op.per_subject(score(spark, sf_dir), 0.85), "coverage", "accuracy", "low_recall", "high_recall")


@query("committed_confusion", f"""WITH {G}, c AS (SELECT CAST(count(*) FILTER (WHERE truth = 0 AND guess = 0 AND conf >= 0.85) AS BIGINT) AS ll, count(*) FILTER (WHERE truth = 0 AND guess = 10 AND conf >= 0.85) AS lh, count(*) FILTER (WHERE truth = 10 AND guess = 0 AND conf >= 0.85) AS hl,
  count(*) FILTER (WHERE truth = 10 AND guess = 10 AND conf >= 0.85) AS hh, count(*) FILTER (WHERE conf < 0.85) AS abstained FROM g) SELECT *, CASE WHEN lh > hl THEN 'low_to_high' WHEN hl > lh THEN 'high_to_low' ELSE 'even' END AS dominant FROM c""")
def committed_confusion(spark, sf_dir):
    return op.committed_confusion(score(spark, sf_dir), 0.85)


@query("reason_report", f"WITH {G} SELECT CASE WHEN conf >= 0.75 THEN 'confident' ELSE reason END AS reason, count(*) AS n, round(avg(CASE WHEN ok THEN 1.0e0 ELSE 0.0e0 END), 6) AS accuracy FROM g GROUP BY 1")
def reason_report(spark, sf_dir):
    return rounded(op.reason_report(score(spark, sf_dir), 0.75), "accuracy")


@query("unknown_agreement", f"WITH {G} SELECT round(avg(CASE WHEN reason = 'N' THEN CASE WHEN conf < 0.85 THEN 1.0e0 ELSE 0.0e0 END END), 6) AS on_unknown, round(avg(CASE WHEN reason <> 'N' THEN CASE WHEN conf < 0.85 THEN 1.0e0 ELSE 0.0e0 END END), 6) AS elsewhere FROM g")
def unknown_agreement(spark, sf_dir):
    return rounded(op.unknown_agreement(score(spark, sf_dir), 0.85, F.col("reason") == "N"), "on_unknown", "elsewhere")


@query("physics_gate", f"""WITH {G}, {THR}, pol AS (SELECT unnest(['off', 'ceiling', 'floor', 'both']) AS policy), pts AS (
  SELECT policy, threshold, count(*) AS rows, count(*) FILTER (WHERE conf >= CASE WHEN policy IN ('floor', 'both') AND tax > 0.04 THEN least(0.705e0, threshold) ELSE threshold END AND NOT (policy IN ('ceiling', 'both') AND disc < 0.02)) AS n,
    count(*) FILTER (WHERE ok AND conf >= CASE WHEN policy IN ('floor', 'both') AND tax > 0.04 THEN least(0.705e0, threshold) ELSE threshold END AND NOT (policy IN ('ceiling', 'both') AND disc < 0.02)) AS n_ok FROM g CROSS JOIN thr CROSS JOIN pol GROUP BY policy, threshold
), sw AS (SELECT CAST(round(0.5 + 0.025 * k, 4) AS DOUBLE) + 0.0e0 AS t FROM range(21) r(k)
), off AS (SELECT t, count(*) FILTER (WHERE conf >= t) / count(*) AS coverage, count(*) FILTER (WHERE conf >= t AND NOT ok) AS errors FROM g CROSS JOIN sw GROUP BY t
), j AS (SELECT p.*, p.n / p.rows AS coverage, p.n - p.n_ok AS errors, o.t, o.coverage AS oc, o.errors AS oe, row_number() OVER (PARTITION BY policy, threshold ORDER BY round(abs(p.n / p.rows - o.coverage), 12), o.t) AS k FROM pts p CROSS JOIN off o)
SELECT policy, threshold, n, round(coverage, 6) AS coverage, errors, t AS off_threshold, round(coverage - oc, 6) AS coverage_gap, errors - oe AS error_delta FROM j WHERE k = 1""")
def physics_gate(spark, sf_dir):
    return rounded(op.physics_gate(score(spark, sf_dir), T5, F.col("tax") > 0.04, F.col("disc") < 0.02, 0.705, 0.025), "coverage", "coverage_gap")


@query("raw_eval_summary", f"""WITH {G} SELECT CASE WHEN grouping(rev) = 0 THEN 'group' WHEN grouping(reason) = 0 THEN 'variant' ELSE 'overall' END AS level, coalesce(rev, reason, '') AS name, count(*) AS rows,
  round(count(*) FILTER (WHERE conf >= 0.85) / count(*), 6) AS coverage, round(count(*) FILTER (WHERE conf >= 0.85 AND ok) / count(*) FILTER (WHERE conf >= 0.85), 6) AS accuracy FROM g GROUP BY GROUPING SETS ((), (rev), (reason))""")
def raw_eval_summary(spark, sf_dir):
    return rounded(op.eval_summary(score(spark, sf_dir), 0.85, "rev", "reason"), "coverage", "accuracy")


@query("route_equivalence", """SELECT count(*) AS n, count(*) FILTER (WHERE doc_id % 7 = 0) AS diff_lang, CAST(0 AS BIGINT) AS diff_source, count(*) FILTER (WHERE doc_id % 11 = 0) AS diff_coverage, max(CASE WHEN doc_id % 11 <> 0 THEN doc_id % 3 END) AS max_delta FROM documents""")
def route_equivalence(spark, sf_dir):
    from .views import table

    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    k = F.col("doc_id")
    other = docs.select("doc_id", F.when(k % 7 == 0, "xx").otherwise(F.col("lang")).alias("lang"), "source", F.when(k % 11 != 0, F.col("n_chars") + k % 3).alias("n_chars"))
    return op.route_equivalence(docs, other, ["doc_id"], ["lang", "source"], "n_chars")


@query("coverage_sweep", f"""WITH {G}, {THR}, per AS (SELECT trial, threshold, count(*) AS rows, count(*) FILTER (WHERE conf >= threshold) AS committed, count(*) FILTER (WHERE abs(conf - threshold) < 5e-5) AS boundary FROM g CROSS JOIN thr GROUP BY ALL)
SELECT threshold, CAST(sum(rows) AS BIGINT) AS rows, CAST(sum(committed) AS BIGINT) AS committed, CAST(sum(boundary) AS BIGINT) AS boundary, count(*) FILTER (WHERE committed * 2 < rows) AS files_under_half, count(*) FILTER (WHERE committed = 0) AS files_at_zero FROM per GROUP BY threshold""")
def coverage_sweep(spark, sf_dir):
    return op.coverage_sweep(op.guessed(score(spark, sf_dir)), T5, "trial")[1]


#: Seeds are trials, feature sets are reasons: metrics of each.
SEEDS = G + ", seeds AS (SELECT trial AS seed, reason AS feature_set, round(avg(CASE WHEN ok THEN 1.0e0 ELSE 0.0e0 END), 9) AS f1, round(avg(CASE WHEN conf >= 0.85 THEN 1.0e0 ELSE 0.0e0 END), 9) AS coverage FROM g GROUP BY ALL)"


def seeds(spark, sf_dir):
    share = lambda c: F.round(F.avg(c.cast("double")), 9)
    return op.guessed(score(spark, sf_dir)).groupBy(F.col("trial").alias("seed"), F.col("reason").alias("feature_set")).agg(share(F.col("ok")).alias("f1"), share(F.col("conf") >= 0.85).alias("coverage"))


@query("seed_band", f"""WITH {SEEDS}, l AS (SELECT seed, 'f1' AS metric, f1 AS value FROM seeds WHERE feature_set = 'A' UNION ALL SELECT seed, 'coverage', coverage FROM seeds WHERE feature_set = 'A')
SELECT metric, max(CASE WHEN seed = 0 THEN value END) AS shipped, round(avg(value), 6) AS mean, min(value) AS least, max(value) AS most, round(max(value) - min(value), 6) AS spread, max(CASE WHEN seed = 0 THEN value END) IN (min(value), max(value)) AS extreme FROM l GROUP BY metric""")
def seed_band(spark, sf_dir):
    return rounded(op.seed_band(seeds(spark, sf_dir).filter("feature_set = 'A'"), ["f1", "coverage"]), "mean", "spread")


@query("seed_sweep_groups", f"WITH {SEEDS} SELECT feature_set, round(avg(f1), 6) AS mean, min(f1) AS least, max(f1) AS most FROM seeds GROUP BY feature_set")
def seed_sweep_groups(spark, sf_dir):
    return seeds(spark, sf_dir).groupBy("feature_set").agg(F.round(F.avg("f1"), 6).alias("mean"), F.min("f1").alias("least"), F.max("f1").alias("most"))


@query("ablation_compare", f"""WITH {SEEDS}, p AS (SELECT feature_set, avg(f1) AS f1_mean, min(f1) AS f1_min, max(f1) AS f1_max, avg(coverage) AS coverage FROM seeds GROUP BY feature_set), b AS (SELECT max(f1_max - f1_min) AS band, max(CASE WHEN feature_set = 'A' THEN f1_mean END) AS base FROM p)
SELECT feature_set, round(f1_mean, 6) AS f1_mean, f1_min, f1_max, round(coverage, 6) AS coverage, round(f1_max - f1_min, 6) AS spread, round(band, 6) AS band, round(f1_mean - base, 6) AS delta, abs(f1_mean - base) <= band AS tie FROM p CROSS JOIN b""")
def ablation_compare(spark, sf_dir):
    return rounded(op.ablation_compare(seeds(spark, sf_dir), "A"), "f1_mean", "coverage", "spread", "band", "delta")


@query("basis_fingerprint", f"WITH {SCORE} SELECT count(*) AS n, string_agg(DISTINCT CAST(truth AS VARCHAR), ',' ORDER BY CAST(truth AS VARCHAR)) AS classes, string_agg(DISTINCT rev, ',' ORDER BY rev) AS groups FROM score")
def basis_fingerprint(spark, sf_dir):
    rows = score(spark, sf_dir).withColumn("truth", F.col("truth").cast("string"))
    return op.basis_fingerprint(rows, "truth", "rev").select("n", F.array_join("classes", ",").alias("classes"), F.array_join("groups", ",").alias("groups"))


@query("ledger_by_basis", "SELECT CASE WHEN CASE WHEN doc_id % 6 = 0 THEN NULL ELSE lang END = 'en' THEN 'same' ELSE 'earlier' END AS basis, count(*) AS n FROM documents GROUP BY 1")
def ledger_by_basis(spark, sf_dir):
    from .views import table

    ledger = table(spark, sf_dir, "documents").select(F.when(F.col("doc_id") % 6 != 0, F.col("lang")).alias("fingerprint"))
    return op.ledger_by_basis(ledger, spark.createDataFrame([("en",)], "fingerprint string")).groupBy("basis").agg(F.count("*").alias("n"))


@query("promotion_verdict", f"""WITH {SEEDS}, cand AS (SELECT seed AS slot, f1, CASE WHEN seed % 3 = 0 THEN 'old' ELSE 'new' END AS basis FROM seeds WHERE feature_set = 'A'), inc AS (SELECT seed AS slot, f1, 'new' AS basis FROM seeds WHERE feature_set = 'R' AND seed <> 5)
SELECT c.slot, c.f1, CASE WHEN i.slot IS NULL THEN 'promote: none before' WHEN c.basis <> i.basis THEN 'keep: not comparable' WHEN c.f1 - i.f1 >= 0.005 THEN 'promote' ELSE 'keep' END AS verdict FROM cand c LEFT JOIN inc i USING (slot)""")
def promotion_verdict(spark, sf_dir):
    s = seeds(spark, sf_dir).withColumnRenamed("seed", "slot")
    cand = s.filter("feature_set = 'A'").withColumn("basis", F.when(F.col("slot") % 3 == 0, "old").otherwise("new"))
    return op.promotion_verdict(cand, s.filter("feature_set = 'R' and slot <> 5").withColumn("basis", F.lit("new")))
