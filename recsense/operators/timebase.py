"""Clocks: profiles, evidence of clock faults, segments at gaps, and what becomes of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recsense.functions.columns import first_message, flag, messages, ratio, slug

#: A gap is an interval above GAP medians; grids have STEP ms; segments last at least SHORTEST s.
GAP, STEP, SHORTEST = 5.0, 10.0, 1.0
#: Nominal rates, and the relative distance within which a rate snaps to one.
RATES, SNAP = (100.0, 200.0, 500.0), 0.05
PREAMBLE_ROWS = 12


def intervals(df: DataFrame, rec: str = "rec", t: str = "t", order: tuple[str, ...] = ("t", "id")) -> DataFrame:
    """``df`` with ``dt``, the time since the row before (null at a recording's first row)."""
    return df.withColumn("dt", F.col(t) - F.lag(t).over(Window.partitionBy(rec).orderBy(*order)))


def with_median(df: DataFrame, rec: str = "rec") -> DataFrame:
    """``df`` with ``med``, the median of ``dt`` over the whole recording."""
    return df.join(df.groupBy(rec).agg(F.median("dt").alias("med")), rec)


def time_profile(df: DataFrame, rec: str = "rec", t: str = "t", order: tuple[str, ...] = ("t", "id"), gap: float = GAP) -> DataFrame:
    """Per recording: rows, span, statistics of the intervals, rates, gaps."""
    return profile_of(with_median(intervals(df, rec, t, order), rec), F.percentile("dt", 0.99), rec, t, gap)


def profile_of(rows: DataFrame, p99: Column, rec: str, t: str, gap: float) -> DataFrame:
    """:func:`time_profile` of rows with ``dt`` and ``med``, with an aggregate for the 99th percentile."""
    is_gap = F.col("dt") > gap * F.col("med")
    per = rows.groupBy(rec).agg(
        F.count("*").alias("n_rows"),
        flag(F.min(F.col("dt") > 0)).alias("monotonic"),
        (F.max(t) - F.min(t)).alias("span_ms"),
        F.first("med").alias("dt_median"),
        F.min("dt").alias("dt_min"),
        F.max("dt").alias("dt_max"),
        p99.alias("dt_p99"),
        F.coalesce(F.sum(is_gap.cast("long")), F.lit(0)).alias("n_gaps"),
        F.max(F.when(is_gap, F.col("dt"))).alias("gap_max"),
        F.coalesce(F.sum(F.when(is_gap, F.col("dt"))), F.lit(0.0)).alias("gap_total"),
    )
    hz_median, hz_span = ratio(F.lit(1000.0), F.col("dt_median")), ratio((F.col("n_rows") - 1) * 1000.0, F.col("span_ms"))
    per = per.withColumn("hz_median", hz_median).withColumn("hz_span", hz_span)
    return per.withColumn("agree", flag(F.abs(F.col("hz_median") - F.col("hz_span")) < 0.5)).withColumn("plausible", flag(F.col("hz_median").between(1, 2000)))


def label_census(df: DataFrame, rec: str = "rec", code: str = "code", order: tuple[str, ...] = ("t", "id")) -> DataFrame:
    """Per recording: counts by code, nulls, runs of equal codes, and whether 255 and -1 occur."""
    before = F.lag(code).over(Window.partitionBy(rec).orderBy(*order))
    first = F.row_number().over(Window.partitionBy(rec).orderBy(*order)) == 1
    rows = df.withColumn("__change", (first | ~F.col(code).eqNullSafe(before)).cast("long"))
    counts = rows.filter(F.col(code).isNotNull()).groupBy(rec, code).count()
    counts = counts.groupBy(rec).agg(F.sort_array(F.collect_list(F.struct(F.col(code).alias("code"), F.col("count").alias("n")))).alias("counts"))
    per = rows.groupBy(rec).agg(F.sum(F.col(code).isNull().cast("long")).alias("n_null"), F.sum("__change").alias("n_runs"), flag(F.max(F.col(code) == 255)).alias("has_255"), flag(F.max(F.col(code) == -1)).alias("has_unsure"))
    return per.join(counts, rec, "left")


def time_base_evidence(df: DataFrame, rec: str = "rec", t: str = "t", order: tuple[str, ...] = ("id",), examples: int = 5) -> DataFrame:
    """Per recording with intervals that don't advance: how many, the first bad line of the file, first examples.

    Rows come in file order; interval j (from 0) ends on line j + 3, after the header and one row before.
    """
    w = Window.partitionBy(rec).orderBy(*order)
    rows = intervals(df, rec, t, order).withColumn("line", F.row_number().over(w) + 1).filter(F.col("dt") <= 0)
    rows = rows.withColumn("__k", F.row_number().over(Window.partitionBy(rec).orderBy("line")))
    return rows.groupBy(rec).agg(
        F.sum((F.col("dt") == 0).cast("long")).alias("n_duplicate"),
        F.sum((F.col("dt") < 0).cast("long")).alias("n_backward"),
        F.min("line").alias("first_bad_line"),
        F.sort_array(F.collect_list(F.when(F.col("__k") <= examples, F.struct("line", "dt")))).alias("examples"),
    )


def clock_errors(df: DataFrame, rec: str = "rec", t: str = "t", order: tuple[str, ...] = ("id",)) -> DataFrame:
    """Per recording the list of what is wrong with its clock."""
    per = intervals(df, rec, t, order).groupBy(rec).agg(F.count("*").alias("n"), F.sum((F.col(t).isNull() | F.isnan(t)).cast("long")).alias("bad"), F.median("dt").alias("med"), F.sum((F.col("dt") < 0).cast("long")).alias("back"))
    found = messages((F.col("n") < 2, "fewer than 2 samples"), (F.col("bad") > 0, "non-finite time"), (F.col("med") <= 0, "median interval not positive"), (F.col("back") > 0, F.format_string("%d backward steps", "back")))
    return per.select(rec, found.alias("errors"))


def gap_segments(df: DataFrame, rec: str = "rec", t: str = "t", order: tuple[str, ...] = ("t", "id"), gap: float = GAP) -> DataFrame:
    """``df`` with ``dt, med, segment, row_idx``: a segment ends where an interval exceeds ``gap`` medians of the recording."""
    rows = with_median(intervals(df, rec, t, order), rec)
    w = Window.partitionBy(rec).orderBy(*order)
    cut = F.when(F.col("dt") > gap * F.col("med"), 1).otherwise(0)
    return rows.withColumn("segment", F.sum(cut).over(w.rowsBetween(Window.unboundedPreceding, 0))).withColumn("row_idx", (F.row_number().over(w) - 1).cast("long"))


def segment_table(segments: DataFrame, rec: str = "rec", t: str = "t") -> DataFrame:
    """Per segment: rows (half-open), times, duration (s, 3 decimals), source rate (Hz, 4 decimals)."""
    per = segments.groupBy(rec, "segment").agg(F.min("row_idx").alias("start_row"), (F.max("row_idx") + 1).alias("end_row"), F.count("*").alias("n_source_rows"), F.min(t).alias("t_start_ms"), F.max(t).alias("t_end_ms"))
    span = F.col("t_end_ms") - F.col("t_start_ms")
    return per.withColumn("duration_s", F.round(span / 1000.0, 3)).withColumn("source_hz", F.round(ratio((F.col("n_source_rows") - 1) * 1000.0, span), 4))


def nominal_rate(hz: Column, rates: tuple[float, ...] = RATES, within: float = SNAP) -> Column:
    """The rate that ``hz`` is within ``within`` of, or null."""
    return F.coalesce(*[F.when(F.abs(hz - r) <= within * r, F.lit(r)) for r in rates])


def segment_usability(table: DataFrame, rates: tuple[float, ...] = RATES, shortest: float = SHORTEST) -> DataFrame:
    """``usable`` and ``reason``: the rate is looked at before the duration."""
    nominal = nominal_rate(F.col("source_hz"), rates)
    # rounded as SQL does, by the binary product: 0.00015 is 1.4999999999999998 ten-thousandths, where a cast would take its printed digits
    shown = (F.round(F.col("source_hz") * 10_000.0).cast("decimal(22,0)") / 10_000).cast("decimal(18,4)").cast("string")
    reason = F.coalesce(
        F.when(nominal.isNull(), F.concat(F.lit("no nominal rate near "), F.coalesce(shown, F.lit("none")), F.lit(" Hz"))),
        F.when(F.col("duration_s") < shortest, F.lit("shorter than the least duration")),
    )
    return table.withColumn("nominal_hz", nominal).withColumn("reason", reason).withColumn("usable", F.col("reason").isNull())


def drop_buckets(table: DataFrame, preamble_rows: int = PREAMBLE_ROWS) -> DataFrame:
    """Unusable segments by cause: rate, preamble (first and short), fragment."""
    bucket = F.when(F.col("nominal_hz").isNull(), "rate").when((F.col("segment") == 0) & (F.col("n_source_rows") <= preamble_rows), "preamble").otherwise("fragment")
    return table.filter(~F.col("usable")).groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n_segments"), F.sum("n_source_rows").alias("n_rows"))


def dead_channels(segments: DataFrame, channels: list[str], rec: str = "rec") -> DataFrame:
    """Per segment the channels without a single finite sample."""
    per = segments.groupBy(rec, "segment").agg(*[flag(F.max(F.col(c).isNotNull() & ~F.isnan(c))).alias(c) for c in channels])
    dead = F.array_compact(F.array(*[F.when(~F.col(c), F.lit(c)) for c in channels]))
    return per.select(rec, "segment", dead.alias("dead_channels"))


def quarantine_ledger(files: DataFrame) -> DataFrame:
    """First reason for which a whole file is refused, and its category.

    ``files``: ``file, has_time, n_header, n_data, n_missing, clock_ok, n_usable``.
    """
    reason = first_message(
        (~F.col("has_time"), "no Time column"),
        (F.col("n_data") > F.col("n_header"), "more data columns than header names"),
        (F.col("n_missing") > 0, F.format_string("missing %d measured columns", "n_missing")),
        (~F.col("clock_ok"), "degenerate clock"),
        (F.col("n_usable") == 0, "no usable segment"),
    )
    return files.select("file", reason.alias("reason")).filter("reason is not null").withColumn("category", slug(F.regexp_replace("reason", "[0-9]+", "")))


def partition_gate(all_files: DataFrame, clean: DataFrame, refused: DataFrame, key: str = "file") -> DataFrame:
    """One row: how many files are in neither list, in both, or in a list without being known; all zero if all is well."""
    a = all_files.select(key, F.lit(1).alias("a")).join(clean.select(key, F.lit(1).alias("c")), key, "full").join(refused.select(key, F.lit(1).alias("r")), key, "full")
    has = {c: F.col(c).isNotNull() for c in "acr"}
    count = lambda cond: F.coalesce(F.sum(cond.cast("long")), F.lit(0))
    return a.agg(count(has["a"]).alias("n_files"), count(has["a"] & ~has["c"] & ~has["r"]).alias("n_lost"), count(has["c"] & has["r"]).alias("n_twice"), count(~has["a"]).alias("n_unknown"))


def health_check(df: DataFrame, channels: list[str], segments: DataFrame, rec: str = "rec", least_rows: int = 200) -> DataFrame:
    """Per recording: channels that are not finite or constant, segments long enough to score, and whether it is usable."""
    finite = {c: F.col(c).isNotNull() & ~F.isnan(c) for c in channels}
    per = df.groupBy(rec).agg(*[F.sum((~finite[c]).cast("long")).alias(f"bad_{c}") for c in channels], *[F.stddev_pop(F.when(finite[c], F.col(c))).alias(f"std_{c}") for c in channels])
    enough = segments.groupBy(rec).agg(F.sum((F.col("n_source_rows") >= least_rows).cast("long")).alias("n_scorable"))
    joined = per.join(enough, rec, "left").withColumn("n_scorable", F.coalesce("n_scorable", F.lit(0)))
    errors = messages(*[(F.col(f"bad_{c}") > 0, f"{c}: non-finite") for c in channels], (F.col("n_scorable") == 0, "no segment long enough"))
    warnings = messages(*[(F.col(f"std_{c}") < 1e-6, f"{c}: constant") for c in channels])
    return joined.select(rec, "n_scorable", errors.alias("errors"), warnings.alias("warnings")).withColumn("usable", F.size("errors") == 0)
