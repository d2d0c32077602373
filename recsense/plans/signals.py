"""Queries on resampling, filters and swaps."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from recsense.operators import signals as op
from recsense.operators import timebase

from .registry import query
from .views import EV, SEG, ev

STEP = 7_200_000.0
KEY = ["rec", "segment"]
PAIRS = SEG + """, pr AS (SELECT rec, segment, id, t, a, b, code, min(t) OVER (PARTITION BY rec, segment) AS t0, lead(t) OVER w AS tn, lead(a) OVER w AS an, lead(b) OVER w AS bn, lead(code) OVER w AS cn FROM seg WINDOW w AS (PARTITION BY rec, segment ORDER BY t, id)
), gr AS (SELECT *, unnest(generate_series(CAST(ceil((t - t0) / 7200000.0e0) AS BIGINT), CAST(ceil((tn - t0) / 7200000.0e0) AS BIGINT) - 1)) AS k FROM pr WHERE tn IS NOT NULL
), grid AS (SELECT rec, segment, k, t0 + k * 7200000.0e0 AS grid_t, a + (an - a) * ((t0 + k * 7200000.0e0 - t) / (tn - t)) AS a, b + (bn - b) * ((t0 + k * 7200000.0e0 - t) / (tn - t)) AS b,
  CASE WHEN t0 + k * 7200000.0e0 - t <= tn - (t0 + k * 7200000.0e0) THEN code ELSE cn END AS code FROM gr)"""


def seg(spark, sf_dir):
    return timebase.gap_segments(ev(spark, sf_dir))


def grid(spark, sf_dir):
    return op.grid_linear(seg(spark, sf_dir), KEY, ["a", "b"], step=STEP)


@query("grid_linear", f"WITH {PAIRS} SELECT rec, segment, k, round(grid_t, 3) AS grid_t, round(a, 5) AS a, round(b, 5) AS b FROM grid")
def grid_linear(spark, sf_dir):
    return grid(spark, sf_dir).select(*KEY, "k", F.round("grid_t", 3).alias("grid_t"), F.round("a", 5).alias("a"), F.round("b", 5).alias("b"))


@query("grid_nearest", f"WITH {PAIRS} SELECT rec, segment, k, code FROM grid")
def grid_nearest(spark, sf_dir):
    return op.grid_nearest(seg(spark, sf_dir), KEY, ["code"], step=STEP).drop("grid_t")


TAPS = ", ".join(repr(x) + ("e0" if "e" not in repr(x) else "") for x in op.taps(5))


@query("decimate_fir", f"""WITH {PAIRS}, h AS (SELECT [{TAPS}] AS h), l AS (SELECT rec, segment, max(k) // 5 AS last FROM grid GROUP BY ALL), o AS (SELECT rec, segment, unnest(range(last + 1)) AS j FROM l)
SELECT o.rec, o.segment, o.j, round(sum(g.a * h.h[o.j * 5 - g.k + 51]), 5) AS a FROM o JOIN grid g ON g.rec = o.rec AND g.segment = o.segment AND g.k BETWEEN o.j * 5 - 50 AND o.j * 5 + 50 CROSS JOIN h GROUP BY ALL""")
def decimate_fir(spark, sf_dir):
    return op.decimate_fir(grid(spark, sf_dir), KEY, "a", 5).withColumn("a", F.round("a", 5))


@query("decimate_with_context")
def decimate_with_context(spark, sf_dir):
    halved, skipped = op.decimate_with_context(grid(spark, sf_dir), KEY, "a", window=20, context=10)
    kept = halved.groupBy(*KEY).agg(F.count("*").alias("n_windows"), F.round(F.sum(F.aggregate("points", F.lit(0.0), lambda s, x: s + x["a"])), 4).alias("total"))
    return kept.join(skipped, KEY, "full")


@query("resample_method", f"WITH {SEG}, s AS (SELECT rec, segment, CASE WHEN max(t) > min(t) THEN round((count(*) - 1) * 1000.0e0 / (max(t) - min(t)), 5) END AS hz FROM seg GROUP BY ALL) SELECT rec, segment, CASE WHEN hz = 0.00003e0 THEN 'grid_aligned' ELSE 'interp_to_grid' END AS method FROM s")
def resample_method(spark, sf_dir):
    span = F.max("t") - F.min("t")
    per = seg(spark, sf_dir).groupBy(*KEY).agg(F.round(F.try_divide((F.count("*") - 1) * 1000.0, span), 5).alias("hz"))
    return per.select(*KEY, op.resample_method(F.col("hz"), 0.00003).alias("method"))


@query("lowpass_causal", f"""WITH RECURSIVE {SEG}, f AS (
  SELECT rec, row_idx, id, a AS y FROM seg WHERE row_idx = 0 UNION ALL SELECT s.rec, s.row_idx, s.id, 0.2e0 * s.a + 0.8e0 * f.y FROM f JOIN seg s ON s.rec = f.rec AND s.row_idx = f.row_idx + 1)
SELECT rec, id, round(y + 0.0000003e0, 5) AS y FROM f""")
def lowpass_causal(spark, sf_dir):
    return op.lowpass_causal(seg(spark, sf_dir).select("rec", "id", "row_idx", "a"), ["rec"], "row_idx", "a", 0.2, block=32).select("rec", "id", F.round(F.col("y") + 0.0000003, 5).alias("y"))


@query("serve_dt", f"""WITH {SEG}, p AS (SELECT rec, arg_max(dt, row_idx) AS last_dt, any_value(med) AS med FROM seg GROUP BY rec)
SELECT rec, round(last_dt, 3) AS last_dt, round(last_dt / med, 6) AS last_over_median, CASE WHEN last_dt > 5 * med THEN 'last interval is a gap' END AS refusal FROM p""")
def serve_dt(spark, sf_dir):
    return op.serve_dt(ev(spark, sf_dir)).withColumns({"last_dt": F.round("last_dt", 3), "last_over_median": F.round("last_over_median", 6)})


GRAD = SEG + """, gw AS (SELECT rec, segment, id, t, a, b, code, count(*) OVER (PARTITION BY rec, segment) AS n, (t - lag(t) OVER w) / 1000.0e0 AS hs, (lead(t) OVER w - t) / 1000.0e0 AS hd, a - lag(a) OVER w AS ba, lead(a) OVER w - a AS fa, b - lag(b) OVER w AS bb, lead(b) OVER w - b AS fb FROM seg WINDOW w AS (PARTITION BY rec, segment ORDER BY t, id)
), grad AS (SELECT *, CASE WHEN hs IS NULL THEN fa / hd WHEN hd IS NULL THEN ba / hs ELSE (hs * hs * fa + hd * hd * ba) / (hs * hd * (hs + hd)) END AS da, CASE WHEN hs IS NULL THEN fb / hd WHEN hd IS NULL THEN bb / hs ELSE (hs * hs * fb + hd * hd * bb) / (hs * hd * (hs + hd)) END AS db FROM gw WHERE n >= 3)"""


def gradients(spark, sf_dir):
    rows = op.gradient_in_segment(seg(spark, sf_dir), KEY, "t", "a", "da")
    return op.gradient_in_segment(rows, KEY, "t", "b", "db")


@query("gradient_in_segment", f"WITH {GRAD} SELECT rec, segment, id, round(da * 1000, 6) AS da FROM grad")
def gradient_in_segment(spark, sf_dir):
    return gradients(spark, sf_dir).select("rec", "segment", "id", F.round(F.col("da") * 1000, 6).alias("da"))


@query("interleg_diff", f"WITH {EV}, z AS (SELECT rec, quantile_cont(a - b, 0.5) AS zero FROM ev GROUP BY rec) SELECT rec, id, round(a - b - zero, 6) AS d FROM ev JOIN z USING (rec)")
def interleg_diff(spark, sf_dir):
    rows = ev(spark, sf_dir)
    zero = rows.groupBy("rec").agg(F.median(F.col("a") - F.col("b")).alias("zero"))
    return rows.join(zero, "rec").select("rec", "id", F.round(F.col("a") - F.col("b") - F.col("zero"), 6).alias("d"))


SWAP = EV + """, sg AS (SELECT rec, id, t, a, row_number() OVER (PARTITION BY rec ORDER BY t, id) - 1 AS row_idx, CASE WHEN a - b > 10 THEN 1 WHEN a - b < -10 THEN -1 END AS s FROM ev
), sp AS (SELECT *, last_value(s IGNORE NULLS) OVER (PARTITION BY rec ORDER BY row_idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p FROM sg
), sw AS (SELECT *, s IS NOT NULL AND s IS DISTINCT FROM p AS is_commit, coalesce(s <> p, false) AS is_swap FROM sp)"""


def swaps_of(spark, sf_dir):
    w = Window.partitionBy("rec").orderBy("t", "id")
    return ev(spark, sf_dir).withColumn("row_idx", (F.row_number().over(w) - 1).cast("long")).withColumn("d", F.col("a") - F.col("b"))


@query("swap_count", f"WITH {SWAP} SELECT rec, CAST(sum(CASE WHEN is_swap THEN 1 ELSE 0 END) AS BIGINT) AS swaps FROM sw GROUP BY rec")
def swap_count(spark, sf_dir):
    return op.swap_count(swaps_of(spark, sf_dir), ["rec"], ["row_idx"], "d", 10.0)


@query("crossings", f"WITH {SWAP} SELECT rec, row_idx, t, round(t - lag(t) OVER (PARTITION BY rec ORDER BY t), 3) AS gap_ms FROM sw WHERE is_commit")
def crossings(spark, sf_dir):
    return op.crossings(swaps_of(spark, sf_dir), ["rec"], ["row_idx"], "t", "row_idx", "d", 10.0).select("rec", "row_idx", "t", F.round("interval", 3).alias("gap_ms"))


@query("window_trace", f"""WITH {SWAP} SELECT rec, CAST(floor((t - 1704500000000.0e0) / 21600000.0e0) AS BIGINT) AS bucket, arg_min(a, (t, id)) AS first_value, bool_or(is_commit) AS is_commit FROM sw WHERE t >= 1704500000000.0e0 AND t < 1705000000000.0e0 GROUP BY 1, 2""")
def window_trace(spark, sf_dir):
    rows = op.commits(swaps_of(spark, sf_dir), ["rec"], ["row_idx"], "d", 10.0)
    return op.window_trace(rows, ["rec"], "t", "a", 1704500000000.0, 1705000000000.0, 21_600_000.0).withColumnRenamed("commit", "is_commit")
