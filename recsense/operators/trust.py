"""Which gyro axis and unit belongs to each angle, drift, and whether a recording can be served."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recsense.functions.columns import correlation, correlation_of, first_message, flag, ratio

#: Least correlation of a match; scales a gyro may be in; correlation with time that is drift; s a segment must last for it.
FLOOR, SCALES, DRIFT, DRIFT_S = 0.9, (1.0, 1.0 / 57.3), 0.9, 5.0


def unpivot_pairs(df: DataFrame, key: list[str], angles: dict[str, str], gyros: dict[str, str]) -> DataFrame:
    """``key, angle, gyro, x, y``: every derivative of an angle beside every gyro channel (3 x 3 rows at most per sample)."""
    pairs = [F.struct(F.lit(a).alias("angle"), F.lit(g).alias("gyro"), F.col(ca).cast("double").alias("x"), F.col(cg).cast("double").alias("y")) for a, ca in angles.items() for g, cg in gyros.items()]
    return df.select(*key, F.explode(F.array(*pairs)).alias("p")).select(*key, "p.*")


def axis_corr_matrix(df: DataFrame, key: list[str], angles: dict[str, str], gyros: dict[str, str]) -> DataFrame:
    """Correlation of each angle's derivative with each gyro axis over finite pairs; null below 3 pairs or if constant. Also the slope of gyro on derivative."""
    long = unpivot_pairs(df, key, angles, gyros)
    sums = long.groupBy(*key, "angle", "gyro").agg(*correlation("x", "y"))
    slope = ratio(F.col("n") * F.col("sxy") - F.col("sx") * F.col("sy"), F.col("n") * F.col("sxx") - F.col("sx") * F.col("sx"))
    return sums.select(*key, "angle", "gyro", correlation_of().alias("r"), slope.alias("slope"))


def axis_match(matrix: DataFrame, key: list[str], floor: float = FLOOR) -> DataFrame:
    """Per angle the gyro axis of greatest ``abs(r)`` (of equals the first), null under the floor; ``anchor`` marks the strongest resolved one."""
    best = matrix.filter("r is not null").groupBy(*key, "angle").agg(F.min_by(F.struct("gyro", "r", "slope"), F.struct(-F.abs("r"), "gyro")).alias("b"))
    out = best.select(*key, "angle", F.when(F.abs("b.r") >= floor, F.col("b.gyro")).alias("match"), F.col("b.r").alias("r"), F.col("b.slope").alias("slope"))
    strongest = F.row_number().over(Window.partitionBy(*key).orderBy(F.col("match").isNull(), F.abs("r").desc(), "angle"))
    return out.withColumn("anchor", (strongest == 1) & F.col("match").isNotNull())


def gyro_unit(slope: Column, scales: tuple[float, ...] = SCALES) -> Column:
    """The scale nearest to ``abs(slope)`` in logarithm."""
    distance = [F.abs(F.log10(F.abs(slope)) - math.log10(s)) for s in scales]
    least = F.least(*distance)
    return F.coalesce(*[F.when(d == least, F.lit(s)) for d, s in zip(distance, scales, strict=True)])


def trust_record(matches: DataFrame, key: list[str], documented: dict[str, str]) -> DataFrame:
    """Per key: angle to axis map, unit, conflicts with the documented map, whether it is a bijection and confident."""
    pairs = F.sort_array(F.collect_list(F.when(F.col("match").isNotNull(), F.struct("angle", "match"))))
    want = F.create_map(*[F.lit(x) for kv in documented.items() for x in kv])
    conflict = F.when(F.col("match").isNotNull() & (F.col("match") != want[F.col("angle")]), F.col("angle"))
    per = matches.groupBy(*key).agg(pairs.alias("axes"), F.count("*").alias("n_angles"), F.sort_array(F.collect_set(conflict)).alias("conflicts"), F.max(F.when(F.col("anchor"), gyro_unit(F.col("slope")))).alias("unit"), F.countDistinct("match").alias("n_axes"))
    bijection = (F.size("axes") == F.col("n_angles")) & (F.col("n_axes") == F.col("n_angles"))
    return per.withColumn("bijection", bijection).withColumn("confident", bijection & F.col("unit").isNotNull()).drop("n_angles", "n_axes")


def drift_check(df: DataFrame, rec: str, segment: str, t: str, x: str, least_s: float = DRIFT_S, limit: float = DRIFT) -> DataFrame:
    """Per recording the duration-weighted mean of ``abs(corr(x, t))`` over long segments: ok, flagged or inconclusive."""
    start = F.min(t).over(Window.partitionBy(rec, segment))
    rows = df.withColumn("__t", (F.col(t) - start) / 1000.0)
    sums = rows.groupBy(rec, segment).agg(*correlation(x, "__t"), F.max("__t").alias("s"))
    per = sums.select(rec, F.abs(correlation_of()).alias("r"), "s").withColumn("use", flag((F.col("s") >= least_s) & F.col("r").isNotNull()))
    used = lambda c: F.sum(F.when(F.col("use"), c))
    out = per.groupBy(rec).agg(ratio(used(F.col("r") * F.col("s")), used(F.col("s"))).alias("drift"))
    return out.withColumn("verdict", F.when(F.col("drift").isNull(), "inconclusive").when(F.col("drift") >= limit, "flagged").otherwise("ok"))


def normalize_unit(df: DataFrame, trust: DataFrame, key: list[str], column: str) -> DataFrame:
    """``df`` with the gyro in the canonical unit: divided by the measured scale; sides without a unit are left and named."""
    joined = df.join(trust.select(*key, "unit"), key, "left")
    return joined.withColumn(column, F.when(F.col("unit").isNotNull(), F.col(column) / F.col("unit")).otherwise(F.col(column))).withColumn("abstained", F.col("unit").isNull())


def trust_kind(unit: Column, conflicts: Column) -> Column:
    return F.when(unit.isNull(), "abstained").when(F.size(conflicts) > 0, "anomaly").otherwise("ok")


def resolve_sagittal(files: DataFrame, variants: DataFrame, trust: DataFrame) -> DataFrame:
    """Angle axis of each file's variant and the gyro axis it maps to; unknown variants are refused."""
    joined = files.join(variants, "variant", "left").join(trust.select("file", "axes"), "file", "left")
    gyro = F.element_at(F.transform(F.filter("axes", lambda x: x["angle"] == F.col("angle_axis")), lambda x: x["match"]), 1)
    return joined.withColumn("gyro_axis", F.when(F.size(F.filter("axes", lambda x: x["angle"] == F.col("angle_axis"))) > 0, gyro)).withColumn("refusal", F.when(F.col("angle_axis").isNull(), F.concat(F.lit("unknown variant "), F.col("variant")))).drop("axes")


def serve_refusals(files: DataFrame) -> DataFrame:
    """First reason why a file can't be served, in the order in which it is looked for; null if it can.

    ``files``: ``file, is_raw, has_trust, unit, variant_known, clock_refusal, axis_conflict``.
    """
    why = first_message((~F.col("is_raw"), "not a raw log"), (~F.col("has_trust"), "no trust record"), (F.col("unit") != 1.0, "gyro is not in the canonical unit"), (~F.col("variant_known"), "unknown variant"), (F.col("clock_refusal").isNotNull(), F.col("clock_refusal")), (F.col("axis_conflict"), "axis conflict"))
    return files.select("*", why.alias("refusal"))


def bridge_equivalence(one: DataFrame, two: DataFrame, key: list[str], columns: list[str], group: str, tolerance: float = 1e-9) -> DataFrame:
    """Per group the largest difference between rebuilt and exported channels, and whether it is within tolerance."""
    joined = one.join(two.select(*key, *[F.col(c).alias(f"__{c}") for c in columns]), key)
    out = joined.groupBy(group).agg(*[F.max(F.abs(F.col(c) - F.col(f"__{c}"))).alias(f"d_{c}") for c in columns])
    return out.withColumn("equal", F.array_max(F.array(*[F.col(f"d_{c}") for c in columns])) <= tolerance)
