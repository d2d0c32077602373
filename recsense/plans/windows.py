"""Queries on windows and features."""

from __future__ import annotations

from pyspark.sql import functions as F

from recsense.operators import timebase
from recsense.operators import windows as op

from .registry import query
from .views import SEG, ev, kept

N, STEP = 16, 4
ROWS = SEG + """, wrow AS (SELECT rec, segment, id, t, a, b, a - 50.0e0 AS va, b - 50.0e0 AS vb, a - b AS d, code, row_number() OVER (PARTITION BY rec, segment ORDER BY t, id) - 1 AS i FROM seg
), lens AS (SELECT rec, segment, count(*) AS len FROM wrow GROUP BY ALL), win AS (SELECT rec, segment, unnest(range(0, len - 16 + 1, 4)) AS start FROM lens WHERE len >= 16
), wr AS (SELECT w.start, r.* FROM win w JOIN wrow r ON r.rec = w.rec AND r.segment = w.segment AND r.i >= w.start AND r.i < w.start + 16)"""


def rows(spark, sf_dir):
    seg = timebase.gap_segments(ev(spark, sf_dir)).select("rec", "segment", "id", "t", "a", "b", (F.col("a") - 50.0).alias("va"), (F.col("b") - 50.0).alias("vb"), (F.col("a") - F.col("b")).alias("d"), "code")
    return op.with_place(seg)


def r6(df, *skip):
    return df.withColumns({c: F.round(c, 5) for c, t in df.dtypes if t == "double" and c not in skip})


@query("tumbling_windows", f"WITH {ROWS} SELECT rec, segment, i // 16 * 16 AS start, min(t) AS t_start, max(t) AS t_end FROM wrow GROUP BY ALL HAVING count(*) = 16")
def tumbling_windows(spark, sf_dir):
    return op.tumbling_windows(rows(spark, sf_dir), N)


@query("sliding_windows", f"WITH {ROWS} SELECT rec, segment, start, min(t) AS t_start, max(t) AS t_end FROM wr GROUP BY ALL")
def sliding_windows(spark, sf_dir):
    return op.sliding_windows(rows(spark, sf_dir), N, STEP)


@query("feat_basic", f"""WITH {ROWS} SELECT rec, segment, start, round(3e-8 + stddev_pop(a), 5) AS a_std, round(3e-8 + stddev_pop(b), 5) AS b_std, round(3e-8 + stddev_pop(va), 5) AS va_std, round(3e-8 + stddev_pop(vb), 5) AS vb_std, round(3e-8 + max(a) - min(a), 5) AS a_ptp, round(3e-8 + max(b) - min(b), 5) AS b_ptp,
  round(3e-8 + max(va) - min(va), 5) AS va_ptp, round(3e-8 + max(vb) - min(vb), 5) AS vb_ptp, round(3e-8 + avg(va), 5) AS va_mean, round(3e-8 + avg(vb), 5) AS vb_mean, round(3e-8 + avg(abs(va)), 5) AS va_absmean, round(3e-8 + avg(abs(vb)), 5) AS vb_absmean FROM wr GROUP BY ALL""")
def feat_basic(spark, sf_dir):
    f = op.feat_basic(rows(spark, sf_dir), N, STEP, ["a", "b"], ["va", "vb"])
    return f.withColumns({c: F.round(F.col(c) + 3e-8, 5) for c, t in f.dtypes if t == "double"})


@query("feat_corr", f"WITH {ROWS} SELECT rec, segment, start, round(corr(a, b), 5) AS angle_corr FROM wr GROUP BY ALL")
def feat_corr(spark, sf_dir):
    return r6(op.feat_corr(rows(spark, sf_dir), N, STEP, {"angle_corr": ("a", "b")}))


@query("feat_moments", f"""WITH {ROWS}, m AS (SELECT *, va - avg(va) OVER (PARTITION BY rec, segment, start) AS c, (va - lag(va) OVER (PARTITION BY rec, segment, start ORDER BY i)) * 2.0e0 AS dv FROM wr)
SELECT rec, segment, start, round(avg(c * c * c) / pow(avg(c * c), 1.5e0), 5) AS skew, round(avg(c * c * c * c) / (avg(c * c) * avg(c * c)) - 3, 5) AS kurtosis, round(avg(CASE WHEN va > 0 THEN 1.0e0 ELSE 0.0e0 END), 5) AS posfrac, round(max(va) / (abs(min(va)) + 1e-6), 5) AS peakratio, round(sqrt(avg(dv * dv)), 5) AS angacc FROM m GROUP BY ALL""")
def feat_moments(spark, sf_dir):
    return r6(op.feat_moments(rows(spark, sf_dir), N, STEP, "va", 2.0))


ZERO = ", zero AS (SELECT rec, quantile_cont(a, 0.5) AS za, quantile_cont(b, 0.5) AS zb FROM wrow GROUP BY rec)"


@query("feat_rest_relative", f"""WITH {ROWS}{ZERO} SELECT w.rec, segment, start, round(quantile_cont(a, 0.95) - any_value(za), 5) AS a_high, round(quantile_cont(a, 0.5) - any_value(za), 5) AS a_med, round(quantile_cont(a, 0.95) - quantile_cont(a, 0.05), 5) AS a_range,
  round(quantile_cont(b, 0.95) - any_value(zb), 5) AS b_high, round(quantile_cont(b, 0.5) - any_value(zb), 5) AS b_med, round(quantile_cont(b, 0.95) - quantile_cont(b, 0.05), 5) AS b_range FROM wr w JOIN zero z ON w.rec = z.rec GROUP BY w.rec, segment, start""")
def feat_rest_relative(spark, sf_dir):
    x = rows(spark, sf_dir)
    zero = x.groupBy("rec").agg(F.median("a").alias("zero_a"), F.median("b").alias("zero_b"))
    return r6(op.feat_rest_relative(x, N, STEP, ["a", "b"], zero))


INTERLEG = ROWS + """, hv AS (SELECT rec, segment, start, (i - start) // 8 AS h, max(d) - min(d) AS p FROM wr GROUP BY ALL), qv AS (SELECT rec, segment, start, (i - start) // 4 AS h, max(d) - min(d) AS p FROM wr GROUP BY ALL
), sg AS (SELECT rec, segment, start, i, CASE WHEN d > 20 THEN 1 WHEN d < -20 THEN -1 END AS s FROM wr), cm AS (SELECT *, last_value(s IGNORE NULLS) OVER (PARTITION BY rec, segment, start ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p FROM sg
), sc AS (SELECT rec, segment, start, CAST(sum(CASE WHEN s <> p THEN 1 ELSE 0 END) AS BIGINT) AS swaps FROM cm GROUP BY ALL)"""


@query("feat_interleg", f"""WITH {INTERLEG} SELECT rec, segment, start, round(any_value(h.p), 5) AS minhalf, round(any_value(q.p), 5) AS minquarter, any_value(swaps) AS swaps FROM (SELECT rec, segment, start, min(p) AS p FROM hv GROUP BY ALL) h JOIN (SELECT rec, segment, start, min(p) AS p FROM qv GROUP BY ALL) q USING (rec, segment, start) JOIN sc USING (rec, segment, start) GROUP BY ALL""")
def feat_interleg(spark, sf_dir):
    return r6(op.feat_interleg(rows(spark, sf_dir), N, STEP, "d", 20.0))


def spectral(spark, sf_dir):
    arrays = op.window_arrays(rows(spark, sf_dir), N, STEP, ["a", "b"])
    return op.feat_spectral(arrays, "a", "b", 16.0, (1.0, 3.0, 7.0), (3, 8), 4)


DFT = ROWS + """, cw AS (SELECT *, (a - avg(a) OVER (PARTITION BY rec, segment, start)) * (0.5e0 - 0.5e0 * cos(2 * pi() * (i - start) / 15.0e0)) AS x FROM wr
), ft AS (SELECT rec, segment, start, f, pow(sum(x * cos(2 * pi() * f * (i - start) / 16.0e0)), 2) + pow(sum(x * sin(2 * pi() * f * (i - start) / 16.0e0)), 2) AS p FROM cw CROSS JOIN (SELECT unnest(range(1, 9)) AS f) GROUP BY ALL)"""


@query("feat_spectral", f"""WITH {DFT} SELECT rec, segment, start, CAST(arg_max(f, CASE WHEN f <= 3 THEN p END) AS DOUBLE) AS dominant, round(sum(CASE WHEN f <= 3 THEN p END) / sum(p), 5) AS band, round(sum(CASE WHEN f >= 3 AND f <= 7 THEN p END) / sum(p), 5) AS high_band FROM ft GROUP BY ALL""")
def feat_spectral(spark, sf_dir):
    return r6(spectral(spark, sf_dir).select("rec", "segment", "start", "dominant", "band", "high_band"))


@query("feat_cycle", f"""WITH {ROWS}, c AS (SELECT rec, segment, start, i, a - avg(a) OVER (PARTITION BY rec, segment, start) AS x FROM wr), l AS (
  SELECT p.rec, p.segment, p.start, q.i - p.i AS lag, sum(p.x * q.x) AS r FROM c p JOIN c q ON p.rec = q.rec AND p.segment = q.segment AND p.start = q.start AND q.i - p.i BETWEEN 3 AND 8 GROUP BY ALL)
SELECT rec, segment, start, arg_max(lag, r) / 16.0e0 AS cycle FROM l GROUP BY ALL""")
def feat_cycle(spark, sf_dir):
    return spectral(spark, sf_dir).select("rec", "segment", "start", "cycle")


@query("feat_lag", f"""WITH {ROWS}, c AS (SELECT rec, segment, start, i, a - avg(a) OVER w AS x, b - avg(b) OVER w AS y FROM wr WINDOW w AS (PARTITION BY rec, segment, start)), l AS (
  SELECT p.rec, p.segment, p.start, p.i - q.i AS lag, sum(p.x * q.y) AS r FROM c p JOIN c q ON p.rec = q.rec AND p.segment = q.segment AND p.start = q.start AND p.i - q.i BETWEEN -4 AND 4 GROUP BY ALL)
SELECT rec, segment, start, arg_max(lag, r) / 16.0e0 AS lead FROM l GROUP BY ALL""")
def feat_lag(spark, sf_dir):
    return spectral(spark, sf_dir).select("rec", "segment", "start", "lead")


#: What the features are taken with: swap threshold, rate, spectral bands, cycle lags, greatest lead.
FEATURES = {"delta": 20.0, "fs": 16.0, "bands": (1.0, 3.0, 7.0), "lags": (3, 8), "within": 4}
ANGLES, RATES = ("a", "b"), ("va", "vb")


def features(x):
    """All 42 features of the windows of rows ``x``, and their names."""
    zero = op.rest_reference(x, [*ANGLES, "d"], "d", 8, FEATURES["delta"])
    return op.all_features(x, N, STEP, ANGLES, RATES, zero, **FEATURES), op.feature_names(ANGLES, RATES)


@query("feature_vector")
def feature_vector(spark, sf_dir):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    found, names = features(kept(rows(spark, sf_dir), "feature-rows"))
    vectors = VectorAssembler(inputCols=names, outputCol="features").transform(found)
    return vectors.select("rec", "segment", "start", F.transform(vector_to_array("features"), lambda v: F.round(v, 4)).alias("features"))


@query("window_label", f"""WITH {ROWS}, c AS (SELECT rec, segment, start, count(*) FILTER (WHERE code = 0) AS nl, count(*) FILTER (WHERE code = 10) AS nh, count(*) FILTER (WHERE code = -1) AS nu FROM wr GROUP BY ALL)
SELECT rec, segment, start, round(greatest(nl, nh) / nullif(nl + nh, 0), 5) AS purity, CASE WHEN nl + nh = 0 THEN NULL WHEN nl > 0 AND nh > 0 THEN 'transition' WHEN nl > 0 THEN '0' ELSE '10' END AS label, round(nu / 16.0e0, 5) AS unknown_frac FROM c""")
def window_label(spark, sf_dir):
    return r6(op.window_label(rows(spark, sf_dir), N, STEP))


@query("rest_reference", f"""WITH {SEG}, wrow AS (SELECT rec, segment, a, b, a - b AS d, row_number() OVER (PARTITION BY rec, segment ORDER BY t, id) - 1 AS i FROM seg), lens AS (SELECT rec, segment, count(*) AS len FROM wrow GROUP BY ALL
), win AS (SELECT rec, segment, unnest(range(0, len - 8 + 1, 2)) AS start FROM lens WHERE len >= 8), wr AS (SELECT w.start, r.* FROM win w JOIN wrow r ON r.rec = w.rec AND r.segment = w.segment AND r.i >= w.start AND r.i < w.start + 8
), sp AS (SELECT rec, segment, start, quantile_cont(d, 0.5) AS m, max(d) - min(d) AS ptp, quantile_cont(a, 0.5) AS za, quantile_cont(b, 0.5) AS zb FROM wr GROUP BY ALL
), st AS (SELECT w.rec, w.segment, w.start, NOT (bool_or(w.d - s.m > 20) AND bool_or(w.d - s.m < -20)) AS still FROM wr w JOIN sp s ON w.rec = s.rec AND w.segment = s.segment AND w.start = s.start GROUP BY ALL
), bs AS (SELECT *, row_number() OVER (PARTITION BY rec ORDER BY CASE WHEN segment = 0 AND start = 0 THEN 0 ELSE 1 END, ptp, segment, start) AS k FROM sp JOIN st USING (rec, segment, start) WHERE still
), wh AS (SELECT rec, quantile_cont(a, 0.5) AS wa, quantile_cont(b, 0.5) AS wb FROM wrow GROUP BY rec)
SELECT w.rec, round(coalesce(za, wa), 5) AS zero_a, round(coalesce(zb, wb), 5) AS zero_b, za IS NOT NULL AS rest_trusted FROM wh w LEFT JOIN bs ON w.rec = bs.rec AND k = 1""")
def rest_reference(spark, sf_dir):
    return r6(op.rest_reference(rows(spark, sf_dir), ["a", "b"], "d", 8, 20.0))


@query("amplitude_band", f"""WITH {ROWS}, f AS (SELECT rec, segment, start, max(a) - min(a) AS ptp, CASE WHEN count(*) FILTER (WHERE code = 10) > 8 THEN '10' ELSE '0' END AS label FROM wr GROUP BY ALL)
SELECT round(quantile_cont(CASE WHEN label = '10' THEN ptp END, 0.01), 5) AS band_low, round(quantile_cont(CASE WHEN label = '0' THEN ptp END, 0.99), 5) AS band_high FROM f""")
def amplitude_band(spark, sf_dir):
    w = op.over_panes(rows(spark, sf_dir), N, STEP, {"nh": (F.col("code") == 10).cast("long")}, {"lo": F.col("a")}, {"hi": F.col("a")})
    f = w.select((F.col("hi") - F.col("lo")).alias("ptp"), F.when(F.col("nh") > 8, "10").otherwise("0").alias("label"))
    return r6(op.amplitude_band(f, "ptp", "label", "0", "10"))


@query("reference_stats", f"""WITH {ROWS}, f AS (SELECT stddev_pop(a) AS s, max(a) - min(a) AS p FROM wr GROUP BY rec, segment, start) SELECT 'a_std' AS feature, round(quantile_cont(s, 0.01), 5) AS p01, round(quantile_cont(s, 0.99), 5) AS p99 FROM f UNION ALL SELECT 'a_ptp', round(quantile_cont(p, 0.01), 5), round(quantile_cont(p, 0.99), 5) FROM f""")
def reference_stats(spark, sf_dir):
    return r6(op.reference_stats(op.feat_basic(rows(spark, sf_dir), N, STEP, ["a"], []), ["a_std", "a_ptp"]))
