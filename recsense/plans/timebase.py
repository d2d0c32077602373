"""Queries on clocks and segments."""

from __future__ import annotations

from pyspark.sql import functions as F

from recsense.operators import timebase as op

from .registry import query
from .views import EV, SEG, ev, table

#: Rates and least duration that suit the event recordings (rates in Hz).
RATES, SHORTEST = (0.00002, 0.00003, 0.00005), 200_000.0
SEGT = SEG + """, segt AS (
  SELECT rec, segment, min(row_idx) AS start_row, max(row_idx) + 1 AS end_row, count(*) AS n_source_rows, min(t) AS t_start_ms, max(t) AS t_end_ms,
    round((max(t) - min(t)) / 1000.0e0, 3) AS duration_s,
    round(CASE WHEN max(t) > min(t) THEN (count(*) - 1) * 1000.0e0 / (max(t) - min(t)) END, 4) AS source_hz,
    CASE WHEN max(t) > min(t) THEN round((count(*) - 1) * 1000.0e0 / (max(t) - min(t)), 6) END AS fine_hz
  FROM seg GROUP BY rec, segment)"""
USABLE = SEGT + """, near AS (
  SELECT rec, segment, n_source_rows, duration_s, fine_hz AS source_hz,
    CASE WHEN abs(fine_hz - 0.00002e0) <= 0.05e0 * 0.00002e0 THEN 0.00002e0 WHEN abs(fine_hz - 0.00003e0) <= 0.05e0 * 0.00003e0 THEN 0.00003e0 WHEN abs(fine_hz - 0.00005e0) <= 0.05e0 * 0.00005e0 THEN 0.00005e0 END AS nominal_hz
  FROM segt
), usable AS (
  SELECT *, CASE WHEN nominal_hz IS NULL THEN concat('no nominal rate near ', coalesce(CAST(CAST(source_hz AS DECIMAL(18,4)) AS VARCHAR), 'none'), ' Hz')
    WHEN duration_s < 200000.0e0 THEN 'shorter than the least duration' END AS reason FROM near)"""


def segments(spark, sf_dir):
    return op.gap_segments(ev(spark, sf_dir))


def usable(spark, sf_dir):
    found = op.segment_table(segments(spark, sf_dir))
    span = F.col("t_end_ms") - F.col("t_start_ms")
    found = found.withColumn("source_hz", F.round(F.try_divide((F.col("n_source_rows") - 1) * 1000.0, span), 6))
    return op.segment_usability(found, RATES, SHORTEST)


@query("time_profile", f"""WITH {SEG}, per AS (
  SELECT rec, count(*) AS n_rows, coalesce(bool_and(dt > 0), false) AS monotonic, max(t) - min(t) AS span_ms, any_value(med) AS dt_median, min(dt) AS dt_min, max(dt) AS dt_max,
    quantile_cont(dt, 0.99) AS dt_p99, CAST(coalesce(sum(CASE WHEN dt > 5 * med THEN 1 ELSE 0 END), 0) AS BIGINT) AS n_gaps, max(CASE WHEN dt > 5 * med THEN dt END) AS gap_max,
    coalesce(sum(CASE WHEN dt > 5 * med THEN dt END), 0.0e0) AS gap_total FROM seg GROUP BY rec
), hz AS (SELECT *, 1000.0e0 / dt_median AS hz_median, (n_rows - 1) * 1000.0e0 / span_ms AS hz_span FROM per)
SELECT rec, n_rows, monotonic, round(span_ms, 3) AS span_ms, round(dt_median, 3) AS dt_median, round(dt_min, 3) AS dt_min, round(dt_max, 3) AS dt_max, round(dt_p99, 2) AS dt_p99, n_gaps,
  round(gap_max, 3) AS gap_max, round(gap_total, 2) AS gap_total, round(hz_median, 9) AS hz_median, round(hz_span, 9) AS hz_span, abs(hz_median - hz_span) < 0.5 AS agree, hz_median BETWEEN 1 AND 2000 AS plausible FROM hz""")
def time_profile(spark, sf_dir):
    return rounded_profile(op.time_profile(ev(spark, sf_dir)))


def rounded_profile(p):
    places = {"span_ms": 3, "dt_median": 3, "dt_min": 3, "dt_max": 3, "dt_p99": 2, "gap_max": 3, "gap_total": 2, "hz_median": 9, "hz_span": 9}
    return p.withColumns({c: F.round(c, n) for c, n in places.items()})


@query("label_census", f"""WITH {EV}, runs AS (
  SELECT rec, code, CASE WHEN row_number() OVER w = 1 OR code IS DISTINCT FROM lag(code) OVER w THEN 1 ELSE 0 END AS change FROM ev WINDOW w AS (PARTITION BY rec ORDER BY t, id)
) SELECT rec, CAST(sum(CASE WHEN code IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_null, CAST(sum(change) AS BIGINT) AS n_runs, bool_or(code = 255) AS has_255, bool_or(code = -1) AS has_unsure,
  CAST(sum(CASE WHEN code = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_stand, CAST(sum(CASE WHEN code = 10 THEN 1 ELSE 0 END) AS BIGINT) AS n_walk FROM runs GROUP BY rec""")
def label_census(spark, sf_dir):
    c = op.label_census(ev(spark, sf_dir))
    n = lambda code: F.coalesce(F.element_at(F.map_from_entries("counts"), F.lit(code)), F.lit(0))
    return c.select("rec", "n_null", "n_runs", "has_255", "has_unsure", n(0).alias("n_stand"), n(10).alias("n_walk"))


@query("file_profile", f"""WITH {SEG}, runs AS (
  SELECT rec, CASE WHEN row_number() OVER w = 1 OR code IS DISTINCT FROM lag(code) OVER w THEN 1 ELSE 0 END AS change FROM ev WINDOW w AS (PARTITION BY rec ORDER BY t, id)
), lab AS (SELECT rec, CAST(sum(change) AS BIGINT) AS n_runs FROM runs GROUP BY rec)
SELECT s.rec, count(*) AS n_rows, round(any_value(med), 3) AS dt_median, CAST(sum(CASE WHEN dt > 5 * med THEN 1 ELSE 0 END) AS BIGINT) AS n_gaps, any_value(n_runs) AS n_runs
FROM seg s JOIN lab USING (rec) GROUP BY s.rec""")
def file_profile(spark, sf_dir):
    rows = ev(spark, sf_dir)
    return op.time_profile(rows).join(op.label_census(rows), "rec").select("rec", "n_rows", F.round("dt_median", 3).alias("dt_median"), "n_gaps", "n_runs")


#: Day numbers: events in file order have clocks that stand still.
DAYS = EV + ", days AS (SELECT rec, id, floor(t / 86400000.0e0) - CASE WHEN code = -1 THEN 2 ELSE 0 END AS t FROM ev)"


def days(spark, sf_dir):
    back = F.when(F.col("code") == -1, 2).otherwise(0)
    return ev(spark, sf_dir).select("rec", "id", (F.floor(F.col("t") / 86400000.0) - back).cast("double").alias("t"))


@query("time_base_evidence", f"""WITH {DAYS}, dts AS (
  SELECT rec, t - lag(t) OVER w AS dt, row_number() OVER w + 1 AS line FROM days WINDOW w AS (PARTITION BY rec ORDER BY id)
), bad AS (SELECT *, row_number() OVER (PARTITION BY rec ORDER BY line) AS k FROM dts WHERE dt <= 0)
SELECT rec, CAST(sum(CASE WHEN dt = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_duplicate, CAST(sum(CASE WHEN dt < 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_backward, CAST(min(line) AS BIGINT) AS first_bad_line,
  string_agg(CASE WHEN k <= 5 THEN CAST(line AS VARCHAR) END, ',' ORDER BY line) AS example_lines FROM bad GROUP BY rec""")
def time_base_evidence(spark, sf_dir):
    e = op.time_base_evidence(days(spark, sf_dir))
    return e.select("rec", "n_duplicate", "n_backward", F.col("first_bad_line").cast("long").alias("first_bad_line"), F.array_join(F.transform("examples", lambda x: x["line"].cast("string")), ",").alias("example_lines"))


@query("clock_errors", f"""WITH {DAYS}, dts AS (SELECT rec, t, t - lag(t) OVER (PARTITION BY rec ORDER BY id) AS dt FROM days
), per AS (SELECT rec, count(*) AS n, quantile_cont(dt, 0.5) AS med, sum(CASE WHEN dt < 0 THEN 1 ELSE 0 END) AS back FROM dts GROUP BY rec)
SELECT rec, concat_ws('; ', CASE WHEN n < 2 THEN 'fewer than 2 samples' END, CASE WHEN med <= 0 THEN 'median interval not positive' END, CASE WHEN back > 0 THEN concat(CAST(CAST(back AS BIGINT) AS VARCHAR), ' backward steps') END) AS errors FROM per""")
def clock_errors(spark, sf_dir):
    return op.clock_errors(days(spark, sf_dir)).select("rec", F.array_join("errors", "; ").alias("errors"))


@query("gap_segments", f"WITH {SEG} SELECT rec, id, segment, CAST(row_idx AS BIGINT) AS row_idx FROM seg")
def gap_segments(spark, sf_dir):
    return segments(spark, sf_dir).select("rec", "id", "segment", "row_idx")


@query("segment_table", f"WITH {SEGT} SELECT rec, segment, start_row, end_row, n_source_rows, t_start_ms, t_end_ms, duration_s, source_hz FROM segt")
def segment_table(spark, sf_dir):
    return op.segment_table(segments(spark, sf_dir))


@query("nominal_rate", f"WITH {USABLE} SELECT nominal_hz, count(*) AS n FROM usable GROUP BY nominal_hz")
def nominal_rate(spark, sf_dir):
    return usable(spark, sf_dir).groupBy("nominal_hz").agg(F.count("*").alias("n"))


@query("segment_usability", f"WITH {USABLE} SELECT rec, segment, nominal_hz, reason IS NULL AS usable, reason FROM usable")
def segment_usability(spark, sf_dir):
    return usable(spark, sf_dir).select("rec", "segment", "nominal_hz", "usable", "reason")


@query("drop_buckets", f"""WITH {USABLE} SELECT CASE WHEN nominal_hz IS NULL THEN 'rate' WHEN segment = 0 AND n_source_rows <= 12 THEN 'preamble' ELSE 'fragment' END AS bucket,
  count(*) AS n_segments, CAST(sum(n_source_rows) AS BIGINT) AS n_rows FROM usable WHERE reason IS NOT NULL GROUP BY 1""")
def drop_buckets(spark, sf_dir):
    return op.drop_buckets(usable(spark, sf_dir))


@query("dead_channels", f"""WITH {SEG} SELECT rec, segment, concat_ws(',', CASE WHEN count(CASE WHEN code <> 10 THEN a END) = 0 THEN 'a' END, CASE WHEN count(CASE WHEN code = -1 THEN b END) = 0 THEN 'b' END) AS dead_channels FROM seg GROUP BY rec, segment""")
def dead_channels(spark, sf_dir):
    holes = segments(spark, sf_dir).withColumns({"a": F.when(F.col("code") != 10, F.col("a")), "b": F.when(F.col("code") == -1, F.col("b"))})
    return op.dead_channels(holes, ["a", "b"]).withColumn("dead_channels", F.array_join("dead_channels", ","))


FILES = USABLE + """, files AS (
  SELECT rec AS file, rec % 11 <> 0 AS has_time, 5 AS n_header, CASE WHEN rec % 13 = 0 THEN 6 ELSE 5 END AS n_data, rec % 3 AS n_missing, rec % 7 <> 1 AS clock_ok, CAST(sum(CASE WHEN reason IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_usable
  FROM usable GROUP BY rec
), refused AS (
  SELECT file, CASE WHEN NOT has_time THEN 'no Time column' WHEN n_data > n_header THEN 'more data columns than header names' WHEN n_missing > 0 THEN concat('missing ', CAST(n_missing AS VARCHAR), ' measured columns')
    WHEN NOT clock_ok THEN 'degenerate clock' WHEN n_usable = 0 THEN 'no usable segment' END AS reason FROM files)"""


def files(spark, sf_dir):
    rec = F.col("rec")
    per = usable(spark, sf_dir).groupBy("rec").agg(F.sum(F.col("usable").cast("long")).alias("n_usable"))
    return per.select(rec.alias("file"), (rec % 11 != 0).alias("has_time"), F.lit(5).alias("n_header"), F.when(rec % 13 == 0, 6).otherwise(5).alias("n_data"), (rec % 3).alias("n_missing"), (rec % 7 != 1).alias("clock_ok"), "n_usable")


@query("quarantine_ledger", f"""WITH {FILES} SELECT file, reason, substr(regexp_replace(regexp_replace(lower(regexp_replace(reason, '[0-9]+', '', 'g')), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g'), 1, 40) AS category FROM refused WHERE reason IS NOT NULL""")
def quarantine_ledger(spark, sf_dir):
    return op.quarantine_ledger(files(spark, sf_dir))


@query("partition_gate", f"""WITH {FILES} SELECT count(*) AS n_files, CAST(0 AS BIGINT) AS n_lost, CAST(0 AS BIGINT) AS n_twice, CAST(0 AS BIGINT) AS n_unknown FROM files""")
def partition_gate(spark, sf_dir):
    all_files = files(spark, sf_dir)
    refused = op.quarantine_ledger(all_files)
    return op.partition_gate(all_files, all_files.join(refused, "file", "left_anti"), refused)


@query("health_check", f"""WITH {SEGT}, per AS (
  SELECT rec, count(*) FILTER (WHERE code = -1 AND id % 5 = 0) AS bad_a, stddev_pop(CASE WHEN NOT (code = -1 AND id % 5 = 0) THEN a END) AS sa, stddev_pop(CASE WHEN rec % 4 = 0 THEN 1.0e0 ELSE b END) AS sb FROM ev GROUP BY rec
), enough AS (SELECT rec, CAST(sum(CASE WHEN n_source_rows >= 20 THEN 1 ELSE 0 END) AS BIGINT) AS n_scorable FROM segt GROUP BY rec)
SELECT rec, n_scorable, concat_ws('; ', CASE WHEN bad_a > 0 THEN 'a: non-finite' END, CASE WHEN n_scorable = 0 THEN 'no segment long enough' END) AS errors,
  concat_ws('; ', CASE WHEN sa < 1e-6 THEN 'a: constant' END, CASE WHEN sb < 1e-6 THEN 'b: constant' END) AS warnings, bad_a = 0 AND n_scorable > 0 AS usable FROM per JOIN enough USING (rec)""")
def health_check(spark, sf_dir):
    rows = ev(spark, sf_dir).withColumns({"a": F.when(~((F.col("code") == -1) & (F.col("id") % 5 == 0)), F.col("a")), "b": F.when(F.col("rec") % 4 == 0, 1.0).otherwise(F.col("b"))})
    h = op.health_check(rows, ["a", "b"], op.segment_table(segments(spark, sf_dir)), least_rows=20)
    return h.withColumns({"errors": F.array_join("errors", "; "), "warnings": F.array_join("warnings", "; ")})
