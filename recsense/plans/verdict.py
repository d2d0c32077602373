"""Queries on verdicts and the second opinion."""

from __future__ import annotations

from pyspark.sql import functions as F

from recsense.functions.columns import quantile_of
from recsense.operators import physics as ph
from recsense.operators import verdict as op
from recsense.operators import windows as win

from .registry import query
from .views import EV, ev, kept, score, SCORE
from .windows import INTERLEG, N, ROWS, STEP, r6, rows

#: Scored rows with diagnostics: p missing for high tax, averaged swaps, range of the halves, posture.
DIAG = SCORE + """, dg AS (SELECT *, CASE WHEN tax < 0.08 THEN p END AS q, disc * 20 AS swaps, price / 1000.0e0 AS minhalf, trial + 0.0e0 AS posture, CAST(floor(tax * 50 + 1e-9) AS INTEGER) AS n_oob, CAST(rev AS VARCHAR) || '-' || CAST(trial AS VARCHAR) AS file FROM score
), cm AS (SELECT *, CASE WHEN q >= 0.5 THEN 10 WHEN q < 0.5 THEN 0 END AS guess, greatest(q, 1.0e0 - q) AS conf0 FROM dg
), co AS (SELECT *, CASE WHEN q IS NOT NULL THEN conf0 END AS conf, CASE WHEN q IS NOT NULL THEN round(conf0, 4) END AS confidence, NOT coalesce(CASE WHEN q IS NOT NULL THEN conf0 END >= 0.85, false) AS amb0, coalesce(minhalf BETWEEN 20 AND 30, false) AND q IS NOT NULL AS in_band FROM cm
), vd AS (SELECT *, amb0 OR in_band AS ambiguous FROM co
), rs AS (SELECT *, CASE WHEN NOT ambiguous THEN '' WHEN guess IS NULL THEN 'uncovered' WHEN posture > 7.5 THEN 'posture_shift' WHEN n_oob >= 3 THEN 'out_of_distribution' WHEN reason = 'R' THEN 'near_transition' WHEN swaps >= 0.5 AND swaps < 1.5 THEN 'weight_shift_or_step'
  WHEN guess = 10 AND minhalf < 25 THEN 'low_excursion_gait' WHEN in_band THEN 'amplitude_ambiguous' ELSE 'model_split' END AS why FROM vd)"""


def diag(spark, sf_dir):
    d = score(spark, sf_dir).withColumns({"q": F.when(F.col("tax") < 0.08, F.col("p")), "swaps": F.col("disc") * 20, "minhalf": F.col("price") / 1000.0, "posture": F.col("trial").cast("double"), "n_oob": F.floor(F.col("tax") * 50 + 1e-9).cast("int"), "file": F.concat_ws("-", "rev", F.col("trial").cast("string"))})
    return d.withColumn("near_change", F.col("reason") == "R")


def decided(spark, sf_dir):
    d = op.band_abstain(op.commit_rule(diag(spark, sf_dir), 0.85, "q"), "minhalf", 20.0, 30.0)
    return op.reason_cascade(d, 7.5, 25.0)


@query("row_probability", f"""WITH {ROWS}, pw AS (SELECT rec, segment, start, avg(CASE WHEN va > 0 THEN 1.0e0 ELSE 0.0e0 END) AS p FROM wr GROUP BY ALL)
SELECT r.rec, r.segment, r.id, round(avg(p.p) + 3e-8, 5) AS p, count(p.p) AS n_windows FROM wrow r LEFT JOIN pw p ON p.rec = r.rec AND p.segment = r.segment AND r.i // 4 * 4 >= p.start AND r.i // 4 * 4 < p.start + 16 GROUP BY ALL""")
def row_probability(spark, sf_dir):
    x = rows(spark, sf_dir)
    w = win.over_panes(x, N, STEP, {"s": (F.col("va") > 0).cast("double")}, {}, {}).withColumn("p", F.col("s") / N)
    return op.row_probability(x, w, N, STEP, ["p"]).select("rec", "segment", "id", F.round(F.col("p") + 3e-8, 5).alias("p"), "n_windows")


@query("oob_count", f"WITH {SCORE} SELECT CAST(CASE WHEN p < 0.1 OR p > 0.9 THEN 1 ELSE 0 END + CASE WHEN disc < 0.015 OR disc > 0.085 THEN 1 ELSE 0 END + CASE WHEN tax > 0.065 THEN 1 ELSE 0 END AS INTEGER) AS n_oob, count(*) AS n FROM score GROUP BY 1")
def oob_count(spark, sf_dir):
    s = score(spark, sf_dir)
    return s.groupBy(op.oob_count(s, {"p": (0.1, 0.9), "disc": (0.015, 0.085), "tax": (-1.0, 0.065)}).alias("n_oob")).agg(F.count("*").alias("n"))


@query("commit_rule", f"WITH {DIAG} SELECT guess, confidence, amb0 AS ambiguous, count(*) AS n FROM co GROUP BY ALL")
def commit_rule(spark, sf_dir):
    return op.commit_rule(diag(spark, sf_dir), 0.85, "q").groupBy("guess", "confidence", "ambiguous").agg(F.count("*").alias("n"))


@query("physics_floor", f"""WITH {DIAG}, pf AS (SELECT *, CASE WHEN swaps < 0.5 THEN 'STANDING' WHEN swaps < 1.5 THEN 'AMBIGUOUS' ELSE 'WALKING' END AS physics FROM co)
SELECT physics, guess, NOT coalesce(conf >= CASE WHEN (physics = 'WALKING' AND guess = 10) OR (physics = 'STANDING' AND guess = 0) THEN 0.705e0 ELSE 0.85e0 END, false) AS ambiguous, count(*) AS n FROM pf GROUP BY ALL""")
def physics_floor(spark, sf_dir):
    d = op.commit_rule(diag(spark, sf_dir), 0.85, "q").withColumn("physics", ph.swap_verdict(F.col("swaps"), True))
    d = op.commit_rule(d, op.physics_floor(F.col("physics"), F.col("guess"), 0.85, 0.705), "q")
    return d.groupBy("physics", "guess", "ambiguous").agg(F.count("*").alias("n"))


@query("band_abstain", f"WITH {DIAG} SELECT in_band, ambiguous, count(*) AS n FROM vd GROUP BY ALL")
def band_abstain(spark, sf_dir):
    return decided(spark, sf_dir).groupBy("in_band", "ambiguous").agg(F.count("*").alias("n"))


@query("near_change", f"""WITH {EV}, g AS (SELECT rec, id, CASE WHEN code >= 0 THEN code END AS guess, row_number() OVER (PARTITION BY rec ORDER BY t, id) AS i FROM ev), f AS (
  SELECT *, coalesce(last_value(guess IGNORE NULLS) OVER (PARTITION BY rec ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), first_value(guess IGNORE NULLS) OVER (PARTITION BY rec ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS g FROM g
), c AS (SELECT *, coalesce(g <> lag(g) OVER (PARTITION BY rec ORDER BY i), false) AS ch FROM f) SELECT rec, id, bool_or(ch) OVER (PARTITION BY rec ORDER BY i ROWS BETWEEN 1 PRECEDING AND 2 FOLLOWING) AS near_change FROM c""")
def near_change(spark, sf_dir):
    g = ev(spark, sf_dir).withColumn("guess", F.when(F.col("code") >= 0, F.col("code")))
    return op.near_change(g, ["rec"], ["t", "id"], "guess", 2).select("rec", "id", "near_change")


@query("reason_cascade", f"WITH {DIAG} SELECT why AS reason, count(*) AS n FROM rs GROUP BY why")
def reason_cascade(spark, sf_dir):
    return decided(spark, sf_dir).groupBy("reason").agg(F.count("*").alias("n"))


LABEL = "CASE WHEN guess IS NULL THEN 255 WHEN ambiguous THEN -1 ELSE guess END"


@query("verdict_projection", f"WITH {DIAG} SELECT rev, {LABEL} AS \"Label\", guess, confidence, ambiguous, why AS reason, count(*) AS n FROM rs GROUP BY ALL")
def verdict_projection(spark, sf_dir):
    v = op.verdict_projection(decided(spark, sf_dir), ["rev"])
    return v.groupBy(*v.columns).agg(F.count("*").alias("n"))


@query("rethreshold", f"WITH {DIAG} SELECT CASE WHEN guess IS NULL THEN 255 WHEN confidence >= 0.9 THEN guess ELSE -1 END AS \"Label\", coalesce(confidence = 0.9, false) AS boundary, count(*) AS n FROM rs GROUP BY ALL")
def rethreshold(spark, sf_dir):
    return op.rethreshold(op.verdict_projection(decided(spark, sf_dir), ["rev"]), 0.9).groupBy("Label", "boundary").agg(F.count("*").alias("n"))


@query("sweep_summary", f"""WITH {DIAG}, tr AS (SELECT file, why, row_number() OVER (PARTITION BY file ORDER BY count(*) DESC, why) AS k FROM rs WHERE ambiguous GROUP BY file, why)
SELECT r.file, count(*) AS rows, count(*) FILTER (WHERE NOT ambiguous) AS n_confident, count(*) FILTER (WHERE NOT ambiguous AND guess = 0) AS n_stand, count(*) FILTER (WHERE NOT ambiguous AND guess = 10) AS n_walk, round(count(*) FILTER (WHERE NOT ambiguous) / count(*), 6) AS confident_frac, any_value(t.why) AS top_reason
FROM rs r LEFT JOIN tr t ON t.file = r.file AND t.k = 1 GROUP BY r.file""")
def sweep_summary(spark, sf_dir):
    return op.sweep_summary(decided(spark, sf_dir)).withColumn("confident_frac", F.round("confident_frac", 6))


@query("label_summary_stats", f"""WITH {DIAG}, st AS (SELECT CASE WHEN guess IS NULL THEN 'uncovered' WHEN ambiguous THEN 'ambiguous' ELSE concat('label ', CAST(guess AS VARCHAR)) END AS name, count(*) AS n FROM rs GROUP BY 1), rr AS (SELECT why AS name, count(*) AS n FROM rs WHERE ambiguous GROUP BY 1)
SELECT 'state' AS what, name, n, round(n / sum(n) OVER (), 6) AS share FROM st UNION ALL SELECT 'reason', name, n, round(n / sum(n) OVER (), 6) FROM rr""")
def label_summary_stats(spark, sf_dir):
    return op.label_summary_stats(decided(spark, sf_dir)).withColumn("share", F.round("share", 6))


@query("abstention_groups", "SELECT lang AS kind, concat('from ', source) AS message, count(*) AS n, min(doc_id) AS first_file, max(doc_id) AS last_file FROM documents WHERE n_chars < 500 GROUP BY ALL")
def abstention_groups(spark, sf_dir):
    from .views import table

    d = table(spark, sf_dir, "documents").filter("n_chars < 500")
    return op.abstention_groups(d.select(F.col("lang").alias("kind"), F.concat(F.lit("from "), "source").alias("message"), F.col("doc_id").alias("file")))


# --- the second opinion -----------------------------------------------------------------------------


@query("swap_verdict", f"WITH {DIAG} SELECT CASE WHEN swaps < 0.5 THEN 'STANDING' WHEN swaps < 1.5 THEN 'AMBIGUOUS' ELSE 'WALKING' END AS verdict, count(*) AS n FROM dg GROUP BY 1")
def swap_verdict(spark, sf_dir):
    return diag(spark, sf_dir).groupBy(ph.swap_verdict(F.col("swaps"), True).alias("verdict")).agg(F.count("*").alias("n"))


#: The rest centre of the difference of the sides, and what is counted about it.
CENTRED = INTERLEG + """, rl AS (SELECT rec, segment, count(*) AS len FROM wrow GROUP BY ALL), rwin AS (SELECT rec, segment, unnest(range(0, len - 8 + 1, 2)) AS start FROM rl WHERE len >= 8
), rwr AS (SELECT w.start, r.* FROM rwin w JOIN wrow r ON r.rec = w.rec AND r.segment = w.segment AND r.i >= w.start AND r.i < w.start + 8
), rsp AS (SELECT rec, segment, start, quantile_cont(d, 0.5) AS m, max(d) - min(d) AS ptp FROM rwr GROUP BY ALL
), rst AS (SELECT w.rec, w.segment, w.start, NOT (bool_or(w.d - s.m > 20) AND bool_or(w.d - s.m < -20)) AS still FROM rwr w JOIN rsp s ON w.rec = s.rec AND w.segment = s.segment AND w.start = s.start GROUP BY ALL
), rbs AS (SELECT *, row_number() OVER (PARTITION BY rec ORDER BY CASE WHEN segment = 0 AND start = 0 THEN 0 ELSE 1 END, ptp, segment, start) AS k FROM rsp JOIN rst USING (rec, segment, start) WHERE still
), rz AS (SELECT w.rec, coalesce(m, wd) AS zero_d, m IS NOT NULL AS rest_trusted FROM (SELECT rec, quantile_cont(d, 0.5) AS wd FROM wrow GROUP BY rec) w LEFT JOIN rbs ON w.rec = rbs.rec AND k = 1
), sg0 AS (SELECT w.rec, segment, start, i, CASE WHEN d - zero_d > 20 THEN 1 WHEN d - zero_d < -20 THEN -1 END AS s FROM wr w JOIN rz ON w.rec = rz.rec
), cm0 AS (SELECT *, last_value(s IGNORE NULLS) OVER (PARTITION BY rec, segment, start ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p FROM sg0
), sc0 AS (SELECT rec, segment, start, CAST(sum(CASE WHEN s <> p THEN 1 ELSE 0 END) AS BIGINT) AS swaps FROM cm0 GROUP BY ALL)"""


def rest(x):
    """``rec, zero_d, rest_trusted``: the rest centre of the difference of the sides."""
    return win.rest_reference(x, ["d"], "d", 8, 20.0)


@query("window_anchors", f"""WITH {CENTRED}, mh AS (SELECT rec, segment, start, min(p) AS minhalf FROM hv GROUP BY ALL)
SELECT w.rec, w.segment, w.start, round(corr(a, b) * -1, 5) AS antiphase, round(1 / (1 + 0.5 * (stddev_pop(a) + stddev_pop(b))), 5) AS grav_stab, round(sum(va * va) + sum(vb * vb) + 0.00003e0, 3) AS gyro_energy, round(quantile_cont(d, 0.5) + 3e-8, 5) AS median_offset, round(max(d) - min(d), 5) AS ptp,
  any_value(round(minhalf, 5)) AS minhalf, any_value(swaps) AS swaps, CASE WHEN any_value(swaps) = 0 THEN 'STANDING' WHEN any_value(swaps) = 1 THEN 'AMBIGUOUS' ELSE 'WALKING' END AS swap_verdict, round(any_value(zero_d) + 3e-8, 5) AS interleg_center, any_value(rest_trusted) AS rest_offset_trusted
FROM wr w JOIN mh USING (rec, segment, start) JOIN sc0 USING (rec, segment, start) JOIN rz ON w.rec = rz.rec GROUP BY w.rec, w.segment, w.start""")
def window_anchors(spark, sf_dir):
    """The descriptors of a window that SQL can say; periodicity is in ``stride_period``."""
    x = kept(rows(spark, sf_dir), "anchor-rows")
    key = ["rec", "segment", "start"]
    zero = rest(x)
    basic = win.feat_basic(x, N, STEP, ["a", "b", "d"], [])
    energy = win.over_panes(x, N, STEP, {"e": F.col("va") ** 2 + F.col("vb") ** 2}, {}, {})
    median = win.window_arrays(x, N, STEP, ["d"]).select(*key, quantile_of(F.col("d"), 0.5).alias("m"))
    swaps = win.feat_interleg(x.join(zero, "rec").withColumn("d", F.col("d") - F.col("zero_d")), N, STEP, "d", DELTA).select(*key, "swaps")
    halves = win.over_panes(x, N // 2, STEP, {}, {"lo": F.col("d")}, {"hi": F.col("d")}).select("rec", "segment", F.col("start").alias("h"), (F.col("hi") - F.col("lo")).alias("p"))
    first, second = halves.withColumnRenamed("h", "start"), halves.select("rec", "segment", (F.col("h") - N // 2).alias("start"), F.col("p").alias("q"))
    minhalf = first.join(second, key).select(*key, F.least("p", "q").alias("minhalf"))
    out = basic.join(win.feat_corr(x, N, STEP, {"r": ("a", "b")}), key).join(energy, key).join(median, key).join(swaps, key).join(minhalf, key).join(zero, "rec")
    return out.select(*key, F.round(F.col("r") * -1, 5).alias("antiphase"), F.round(1 / (1 + 0.5 * (F.col("a_std") + F.col("b_std"))), 5).alias("grav_stab"), F.round(F.col("e") + 0.00003, 3).alias("gyro_energy"), F.round(F.col("m") + 3e-8, 5).alias("median_offset"), F.round("d_ptp", 5).alias("ptp"), F.round("minhalf", 5).alias("minhalf"), "swaps", ph.swap_verdict(F.col("swaps")).alias("swap_verdict"), F.round(F.col("zero_d") + 3e-8, 5).alias("interleg_center"), F.col("rest_trusted").alias("rest_offset_trusted"))


#: At 16 rows a second: rows on both sides of a window's middle that a span may reach (3 s), shortest and longest stride, and the swap threshold.
REACH, SHORTEST, LONGEST, DELTA = 48, 2, 12, 20.0


def anchors(spark, sf_dir):
    x = kept(rows(spark, sf_dir), "anchor-rows")
    around = ph.spans(x, N, STEP, REACH, ["a", "b"]).join(rest(x).select("rec", "zero_d"), "rec")
    return ph.anchor_features(around, "a", "b", 16.0, N, REACH, SHORTEST, LONGEST, 0.35, DELTA, zero="zero_d")


@query("stride_period")
def stride_period(spark, sf_dir):
    return anchors(spark, sf_dir).select("rec", "segment", "start", "period", F.round("periodicity", 5).alias("periodicity"))


@query("adaptive_verdict")
def adaptive_verdict(spark, sf_dir):
    return anchors(spark, sf_dir).select("rec", "segment", "start", "verdict", "swaps", "span")


@query("trial_anchor_table")
def trial_anchor_table(spark, sf_dir):
    own = anchors(spark, sf_dir).withColumnRenamed("swaps", "span_swaps").withColumn("periodicity", F.round("periodicity", 5))
    return window_anchors(spark, sf_dir).join(own, ["rec", "segment", "start"])


@query("window_truth", f"""WITH {ROWS}, c AS (SELECT rec, segment, start, count(*) FILTER (WHERE code = 0) AS nl, count(*) FILTER (WHERE code = 10) AS nh FROM wr GROUP BY ALL) SELECT rec, segment, start, CASE WHEN nh > nl THEN 10 ELSE 0 END AS label, nl = 0 OR nh = 0 AS pure FROM c""")
def window_truth(spark, sf_dir):
    w = win.over_panes(rows(spark, sf_dir), N, STEP, {"nl": (F.col("code") == 0).cast("long"), "nh": (F.col("code") == 10).cast("long")}, {}, {})
    return w.select("rec", "segment", "start", F.when(F.col("nh") > F.col("nl"), 10).otherwise(0).alias("label"), ((F.col("nl") == 0) | (F.col("nh") == 0)).alias("pure"))


COH = SCORE + """, ch AS (SELECT rev, trial, truth AS label, CASE WHEN disc * 20 < 0.5 THEN 'STANDING' WHEN disc * 20 < 1.5 THEN 'AMBIGUOUS' ELSE 'WALKING' END AS verdict, price AS t FROM score)"""


def audited(spark, sf_dir):
    return score(spark, sf_dir).select("rev", "trial", F.col("truth").alias("label"), ph.swap_verdict(F.col("disc") * 20, True).alias("verdict"), F.col("price").alias("t"), F.col("price").alias("minhalf"))


@query("coherence", f"""WITH {COH}, b AS (SELECT *, verdict <> 'AMBIGUOUS' AS dec, coalesce(CASE verdict WHEN 'WALKING' THEN 10 WHEN 'STANDING' THEN 0 END <> label, false) AS bad FROM ch)
SELECT rev, trial, count(*) FILTER (WHERE dec) AS windows, count(*) FILTER (WHERE bad) AS disagree, round(avg(CASE WHEN dec THEN 0.0e0 ELSE 1.0e0 END), 6) AS abstain_frac, min(t) AS t_first, max(t) AS t_last, min(CASE WHEN bad THEN t END) AS bad_first, max(CASE WHEN bad THEN t END) AS bad_last,
  round(count(*) FILTER (WHERE bad) / count(*) FILTER (WHERE dec), 6) AS disagree_frac, count(*) FILTER (WHERE dec) >= 20 AND count(*) FILTER (WHERE bad) / count(*) FILTER (WHERE dec) > 0.5 AS flag FROM b GROUP BY ALL""")
def coherence(spark, sf_dir):
    return ph.coherence(audited(spark, sf_dir), ["rev", "trial"], "t").withColumns({"abstain_frac": F.round("abstain_frac", 6), "disagree_frac": F.round("disagree_frac", 6)})


@query("band_policy", f"""WITH {COH}, per AS (SELECT rev, trial, count(*) AS n, count(*) FILTER (WHERE label = 10) AS k FROM ch WHERE t BETWEEN 20000 AND 20500 GROUP BY ALL), c AS (SELECT sum(k) / sum(n) AS p, count(*) FILTER (WHERE n >= 5) AS tests FROM per
), pm AS (SELECT rev, trial, n, k, i, exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln(p) + (n - i) * ln(1 - p)) AS f FROM (SELECT per.*, p, CAST(unnest(range(n + 1)) AS DOUBLE) AS i FROM per CROSS JOIN c WHERE n >= 5)
), pv AS (SELECT rev, trial, least(sum(CASE WHEN f <= fk * (1 + 1e-7) THEN f ELSE 0 END), 1.0e0) AS band_p FROM (SELECT *, max(CASE WHEN i = k THEN f END) OVER (PARTITION BY rev, trial) AS fk FROM pm) GROUP BY ALL)
SELECT per.rev, per.trial, n AS band_windows, k AS band_walk, round(k / n, 6) AS band_walk_frac, round(band_p, 6) AS band_p, coalesce(band_p < 0.05 / greatest(tests, 1), false) AS band_flag FROM per LEFT JOIN pv ON pv.rev = per.rev AND pv.trial = per.trial CROSS JOIN c""")
def band_policy(spark, sf_dir):
    b = ph.band_policy(audited(spark, sf_dir), ["rev", "trial"], "minhalf", 20000.0, 20500.0, 5)
    return b.withColumns({"band_walk_frac": F.round("band_walk_frac", 6), "band_p": F.round("band_p", 6)})


@query("rate_invariance")
def rate_invariance(spark, sf_dir):
    from recsense.operators import signals

    from .signals import KEY, STEP as GRID
    from recsense.operators import timebase

    seg = timebase.gap_segments(ev(spark, sf_dir))
    zero = rest(kept(rows(spark, sf_dir), "audit-rows")).select("rec", "zero_d")

    # windows of 32 grid points against the same windows halved by the FIR, with 20 real points on both sides
    n, context, names = 32, 20, ("a", "b", "va", "vb")
    grid = signals.grid_linear(seg, KEY, ["a", "b"], step=GRID).withColumns({"va": F.col("a") - 50.0, "vb": F.col("b") - 50.0})
    grid = kept(grid.select(*KEY, "k", *names), "audit-grid")
    window = lambda df, i, size: win.window_arrays(df.withColumnRenamed(i, "i"), size, size, list(names)).withColumn("start", F.floor(F.col("start") / size).cast("long")).join(zero, "rec")
    native = kept(ph.audited_anchors(window(grid, "k", n), "a", "b", names[2:], SHORTEST, DELTA, "zero_d"), "audit-native")
    ends = grid.groupBy(*KEY).agg(F.max("k").alias("end"))
    walking = F.col("verdict") == ph.WALKING
    inside = (F.col("start") * n >= context) & ((F.col("start") + 1) * n + context <= F.col("end") + 1)
    half = ph.audited_anchors(window(signals.decimate_channels(grid, KEY, list(names), 2), "j", n // 2), "a", "b", names[2:], SHORTEST // 2, DELTA, "zero_d")
    found = ph.rate_invariance(native.filter(walking).join(ends, KEY).filter(inside), half, ["rec", "segment", "start"], ph.AUDITED)
    counts = native.agg(F.count("*").alias("n_windows"), F.coalesce(F.sum(walking.cast("long")), F.lit(0)).alias("n_walking"))
    found = found.crossJoin(F.broadcast(counts)).withColumn("n_skipped", F.col("n_walking") - F.col("n_audited"))
    return found.withColumns({"median_change": F.round("median_change", 4), "p90_change": F.round("p90_change", 4)})


FILE = DIAG + """, fs AS (SELECT file, count(*) AS n_rows, count(guess) AS n_covered, count(*) FILTER (WHERE guess IS NOT NULL AND NOT ambiguous) AS n_committed, round(avg(CASE WHEN guess IS NOT NULL THEN CASE WHEN ambiguous THEN 0.0e0 ELSE 1.0e0 END END), 4) AS committed_frac,
  round(avg(CASE WHEN guess IS NOT NULL AND NOT ambiguous THEN CASE WHEN guess = 10 THEN 1.0e0 ELSE 0.0e0 END END), 4) AS model_walk_frac, round(avg(CASE WHEN guess IS NOT NULL THEN CASE WHEN swaps >= 1.5 THEN 1.0e0 ELSE 0.0e0 END END), 4) AS physics_walk_frac, bool_and(trial <> 4) AS rest_trusted FROM rs GROUP BY file)"""


def stats(spark, sf_dir):
    return ph.file_stats(decided(spark, sf_dir).withColumns({"physics": ph.swap_verdict(F.col("swaps"), True), "rest_trusted": F.col("trial") != 4}))


@query("file_stats", f"WITH {FILE} SELECT * FROM fs")
def file_stats(spark, sf_dir):
    return stats(spark, sf_dir)


@query("plausibility_check", f"""WITH {FILE} SELECT file, 'rest_untrusted' AS finding FROM fs WHERE NOT rest_trusted UNION ALL SELECT file, 'too_short' FROM fs WHERE n_covered < 800 UNION ALL SELECT file, 'commitment_collapse' FROM fs WHERE n_covered >= 800 AND committed_frac < 0.1855
UNION ALL SELECT file, 'physics_silent' FROM fs WHERE n_covered >= 800 AND model_walk_frac >= 0.6 AND physics_walk_frac <= 0.83 UNION ALL SELECT file, 'physics_loud' FROM fs WHERE n_covered >= 800 AND physics_walk_frac >= 0.8 AND model_walk_frac <= 0.55""")
def plausibility_check(spark, sf_dir):
    return ph.plausibility_check(stats(spark, sf_dir), least_rows=800, commit=0.1855, silent=(0.6, 0.83), loud=(0.8, 0.55))


@query("plausibility_calibration", f"WITH {FILE} SELECT min(physics_walk_frac) AS least, round(quantile_cont(physics_walk_frac, 0.05), 6) AS p05, round(quantile_cont(physics_walk_frac, 0.5), 6) AS median, round(corr(physics_walk_frac, model_walk_frac), 5) AS r FROM fs")
def plausibility_calibration(spark, sf_dir):
    return ph.plausibility_calibration(stats(spark, sf_dir), "physics_walk_frac", "model_walk_frac").withColumns({"p05": F.round("p05", 6), "median": F.round("median", 6), "r": F.round("r", 5)})


@query("fault_flags", f"""WITH {EV}, md AS (SELECT rec, quantile_cont(a, 0.5) AS m FROM ev GROUP BY rec), x AS (SELECT rec, 'none' AS fault, a AS l, b AS r FROM ev UNION ALL SELECT rec, 'duplicated', a, a FROM ev UNION ALL SELECT e.rec, 'dead', m, b FROM ev e JOIN md USING (rec) UNION ALL SELECT rec, 'swapped', b, a FROM ev)
SELECT rec, fault, round(stddev_pop(l - r), 5) AS diff_std, stddev_pop(l) < 1e-6 AS dead_channel, stddev_pop(l - r) < 1e-6 AS same_legs FROM x GROUP BY ALL""")
def fault_flags(spark, sf_dir):
    x = ph.with_faults(ev(spark, sf_dir).select("rec", "a", "b"), "a", "b")
    return x.groupBy("rec", "fault").agg(F.round(F.stddev_pop(F.col("a") - F.col("b")), 5).alias("diff_std"), (F.stddev_pop("a") < 1e-6).alias("dead_channel"), (F.stddev_pop(F.col("a") - F.col("b")) < 1e-6).alias("same_legs"))
