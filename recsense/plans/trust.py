"""Queries on channel trust and serving."""

from __future__ import annotations

from pyspark.sql import functions as F

from recsense.operators import signals
from recsense.operators import trust as op

from .registry import query
from .signals import GRAD, gradients
from .timebase import segments
from .views import SEG, ev

ANGLES = {"X": "da", "Y": "db"}
GYROS = {"X": "gx", "Y": "gy", "Z": "gz"}
#: Gyro channels out of the derivatives: exact for some recordings, mixed with the value for others.
DEV = GRAD + """, dev AS (SELECT rec, id, da, db, CASE WHEN rec % 3 = 0 THEN da / 57.3e0 ELSE da END AS gx, CASE WHEN rec % 4 = 0 THEN a / 1e5 ELSE -db END AS gy, CASE WHEN rec % 5 = 0 THEN db ELSE b / 1e5 END AS gz FROM grad)"""
MATRIX = DEV + """, lng AS (SELECT rec, 'X' AS angle, 'X' AS gyro, da AS x, gx AS y FROM dev UNION ALL SELECT rec, 'X', 'Y', da, gy FROM dev UNION ALL SELECT rec, 'X', 'Z', da, gz FROM dev UNION ALL SELECT rec, 'Y', 'X', db, gx FROM dev UNION ALL SELECT rec, 'Y', 'Y', db, gy FROM dev UNION ALL SELECT rec, 'Y', 'Z', db, gz FROM dev
), mx AS (SELECT rec, angle, gyro, corr(y, x) AS r, regr_slope(y, x) AS slope FROM lng GROUP BY ALL)"""
MATCH = MATRIX + """, bst AS (SELECT *, row_number() OVER (PARTITION BY rec, angle ORDER BY -round(abs(r), 9), gyro) AS k FROM mx
), mt AS (SELECT rec, angle, CASE WHEN abs(r) >= 0.9 THEN gyro END AS match, r, slope FROM bst WHERE k = 1
), anc AS (SELECT *, row_number() OVER (PARTITION BY rec ORDER BY match IS NULL, round(abs(r), 9) DESC, angle) = 1 AND match IS NOT NULL AS anchor FROM mt)"""
UNIT = "CASE WHEN abs(log10(abs(slope))) <= abs(log10(abs(slope)) - log10(1.0e0 / 57.3e0)) THEN 1.0e0 ELSE 1.0e0 / 57.3e0 END"
RECORD = MATCH + f""", trec AS (SELECT rec, count(*) AS n_angles, string_agg(CASE WHEN match IS NOT NULL THEN concat(angle, match) END, ',' ORDER BY angle) AS axes, string_agg(CASE WHEN match <> angle THEN angle END, ',' ORDER BY angle) AS conflicts,
  max(CASE WHEN anchor THEN {UNIT} END) AS unit, count(match) AS n_match, count(DISTINCT match) AS n_axes FROM anc GROUP BY rec)"""


def device(spark, sf_dir):
    rec = F.col("rec")
    return gradients(spark, sf_dir).withColumns({"gx": F.when(rec % 3 == 0, F.col("da") / 57.3).otherwise(F.col("da")), "gy": F.when(rec % 4 == 0, F.col("a") / 1e5).otherwise(-F.col("db")), "gz": F.when(rec % 5 == 0, F.col("db")).otherwise(F.col("b") / 1e5)})


def matrix(spark, sf_dir):
    m = op.axis_corr_matrix(device(spark, sf_dir), ["rec"], ANGLES, GYROS)
    return m.withColumn("r", F.round("r", 9))


def matches(spark, sf_dir):
    return op.axis_match(matrix(spark, sf_dir), ["rec"])


def record(spark, sf_dir):
    return op.trust_record(matches(spark, sf_dir), ["rec"], {"X": "X", "Y": "Y"})


@query("axis_corr_matrix", f"WITH {MATRIX} SELECT rec, angle, gyro, round(r, 5) AS r FROM mx")
def axis_corr_matrix(spark, sf_dir):
    return matrix(spark, sf_dir).select("rec", "angle", "gyro", F.round("r", 5).alias("r"))


@query("axis_match", f"WITH {MATCH} SELECT rec, angle, match, anchor FROM anc")
def axis_match(spark, sf_dir):
    return matches(spark, sf_dir).select("rec", "angle", "match", "anchor")


@query("gyro_unit", f"WITH {MATCH} SELECT rec, round({UNIT}, 6) AS unit FROM anc WHERE anchor")
def gyro_unit(spark, sf_dir):
    return matches(spark, sf_dir).filter("anchor").select("rec", F.round(op.gyro_unit(F.col("slope")), 6).alias("unit"))


@query("trust_record", f"WITH {RECORD} SELECT rec, coalesce(axes, '') AS axes, coalesce(conflicts, '') AS conflicts, round(unit, 6) AS unit, n_match = n_angles AND n_axes = n_angles AS bijection, n_match = n_angles AND n_axes = n_angles AND unit IS NOT NULL AS confident FROM trec")
def trust_record(spark, sf_dir):
    r = record(spark, sf_dir)
    return r.select("rec", F.array_join(F.transform("axes", lambda x: F.concat(x["angle"], x["match"])), ",").alias("axes"), F.array_join("conflicts", ",").alias("conflicts"), F.round("unit", 6).alias("unit"), "bijection", "confident")


@query("drift_check", f"""WITH {SEG}, st AS (SELECT rec, segment, t, a, (t - min(t) OVER (PARTITION BY rec, segment)) / 1000.0e0 AS x FROM seg
), dr AS (SELECT rec, segment, CASE WHEN count(*) >= 3 THEN abs(corr(a, x)) END AS r, max(x) AS s FROM st GROUP BY ALL), av AS (SELECT rec, sum(CASE WHEN s >= 100000 AND r IS NOT NULL THEN r * s END) / sum(CASE WHEN s >= 100000 AND r IS NOT NULL THEN s END) AS drift FROM dr GROUP BY rec)
SELECT rec, round(drift, 5) AS drift, CASE WHEN drift IS NULL THEN 'inconclusive' WHEN drift >= 0.3 THEN 'flagged' ELSE 'ok' END AS verdict FROM av""")
def drift_check(spark, sf_dir):
    return op.drift_check(segments(spark, sf_dir), "rec", "segment", "t", "a", 100_000.0, 0.3).withColumn("drift", F.round("drift", 5))


@query("normalize_unit", f"WITH {RECORD} SELECT d.rec, d.id, round((CASE WHEN unit IS NOT NULL THEN gx / unit ELSE gx END) * 1000, 6) AS gx, unit IS NULL AS abstained FROM dev d LEFT JOIN trec USING (rec)")
def normalize_unit(spark, sf_dir):
    return op.normalize_unit(device(spark, sf_dir), record(spark, sf_dir), ["rec"], "gx").select("rec", "id", F.round(F.col("gx") * 1000, 6).alias("gx"), "abstained")


@query("trust_rollup", f"WITH {RECORD} SELECT CASE WHEN unit IS NULL THEN 'abstained' WHEN conflicts IS NOT NULL THEN 'anomaly' ELSE 'ok' END AS kind, count(*) AS n FROM trec GROUP BY 1")
def trust_rollup(spark, sf_dir):
    return record(spark, sf_dir).groupBy(op.trust_kind(F.col("unit"), F.col("conflicts")).alias("kind")).agg(F.count("*").alias("n"))


VARIANTS = [("v0", "X"), ("v1", "Y"), ("v2", "X")]
SAG = RECORD + """, vf AS (SELECT rec AS file, axes, conflicts, unit, concat('v', CAST(rec % 4 AS VARCHAR)) AS variant, CASE rec % 4 WHEN 0 THEN 'X' WHEN 1 THEN 'Y' WHEN 2 THEN 'X' END AS angle_axis FROM trec)"""


def sagittal(spark, sf_dir):
    rows = record(spark, sf_dir).withColumnRenamed("rec", "file")
    files = rows.select("file", F.concat(F.lit("v"), (F.col("file") % 4).cast("string")).alias("variant"))
    return op.resolve_sagittal(files, spark.createDataFrame(VARIANTS, "variant string, angle_axis string"), rows)


@query("resolve_sagittal", f"WITH {SAG} SELECT file, variant, angle_axis, CASE WHEN angle_axis IS NOT NULL THEN nullif(regexp_extract(axes, concat(angle_axis, '([XYZ])(,|$)'), 1), '') END AS gyro_axis, CASE WHEN angle_axis IS NULL THEN concat('unknown variant ', variant) END AS refusal FROM vf")
def resolve_sagittal(spark, sf_dir):
    return sagittal(spark, sf_dir)


SERVE = SAG + """, sv AS (SELECT file, variant, angle_axis, CASE WHEN file % 23 = 0 THEN 'not a raw log' WHEN unit IS NULL THEN 'no trust record' WHEN unit <> 1.0e0 THEN 'gyro is not in the canonical unit' WHEN angle_axis IS NULL THEN 'unknown variant' WHEN conflicts IS NOT NULL THEN 'axis conflict' END AS refusal FROM vf)"""


def served(spark, sf_dir):
    rows = sagittal(spark, sf_dir).drop("refusal").join(record(spark, sf_dir).withColumnRenamed("rec", "file"), "file")
    return op.serve_refusals(rows.select("file", "variant", "angle_axis", (F.col("file") % 23 != 0).alias("is_raw"), F.col("unit").isNotNull().alias("has_trust"), "unit", F.col("angle_axis").isNotNull().alias("variant_known"), F.lit(None).cast("string").alias("clock_refusal"), (F.size("conflicts") > 0).alias("axis_conflict")))


@query("serve_refusals", f"WITH {SERVE} SELECT file, refusal FROM sv")
def serve_refusals(spark, sf_dir):
    return served(spark, sf_dir).select("file", "refusal")


@query("servable_sweep", f"WITH {SERVE} SELECT variant, angle_axis, refusal, count(*) AS n FROM sv GROUP BY ALL")
def servable_sweep(spark, sf_dir):
    return served(spark, sf_dir).groupBy("variant", "angle_axis", "refusal").agg(F.count("*").alias("n"))


CHANNELS = ("l_ang", "r_ang", "l_vel", "r_vel")


def bridged(spark, sf_dir):
    """Angles and rates of both sides, taken from the variant's axes, low-passed at the raw rate."""
    turned = F.col("rec") % 4 == 1
    left, right = F.when(turned, F.col("b")).otherwise(F.col("a")), F.when(turned, F.col("a")).otherwise(F.col("b"))
    return signals.raw_to_features(segments(spark, sf_dir), dict(zip(CHANNELS, (left, right, left - 50.0, right - 50.0), strict=True)), 0.3, 32)


@query("raw_to_features", f"""WITH RECURSIVE {SEG}, sx AS (SELECT rec, row_idx, id, CASE WHEN rec % 4 = 1 THEN b ELSE a END AS x, CASE WHEN rec % 4 = 1 THEN a ELSE b END AS z FROM seg), f AS (
  SELECT rec, row_idx, id, x AS la, z AS ra, x - 50.0e0 AS lv, z - 50.0e0 AS rv FROM sx WHERE row_idx = 0
  UNION ALL SELECT s.rec, s.row_idx, s.id, 0.3e0 * s.x + 0.7e0 * f.la, 0.3e0 * s.z + 0.7e0 * f.ra, 0.3e0 * (s.x - 50.0e0) + 0.7e0 * f.lv, 0.3e0 * (s.z - 50.0e0) + 0.7e0 * f.rv FROM f JOIN sx s ON s.rec = f.rec AND s.row_idx = f.row_idx + 1)
SELECT rec, id, round(la + 0.000000314159e0, 5) AS l_ang, round(ra + 0.000000314159e0, 5) AS r_ang, round(lv + 0.000000314159e0, 5) AS l_vel, round(rv + 0.000000314159e0, 5) AS r_vel FROM f""")
def raw_to_features(spark, sf_dir):
    return bridged(spark, sf_dir).select("rec", "id", *[F.round(F.col(c) + 0.000000314159, 5).alias(c) for c in CHANNELS])


@query("bridge_equivalence", "SELECT user_id AS rec, CAST(CASE WHEN user_id % 10 = 3 THEN 1.0e0 ELSE 0.0e0 END AS DOUBLE) AS d_a, user_id % 10 <> 3 AS equal FROM events GROUP BY user_id")
def bridge_equivalence(spark, sf_dir):
    rows = ev(spark, sf_dir).select("rec", "id", F.floor("a").cast("double").alias("a"))
    other = rows.withColumn("a", F.col("a") + F.when(F.col("rec") % 10 == 3, 1.0).otherwise(0.0)).drop("rec")
    return op.bridge_equivalence(rows, other, ["id"], ["a"], "rec")
