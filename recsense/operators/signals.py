"""Resampling, filters, derivatives and swap counts over segments."""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recsense.functions.columns import first_message, flag, ratio

STEP = 10.0


def _pairs(df: DataFrame, key: list[str], t: str, columns: list[str], step: float) -> DataFrame:
    """Each sample with the next one of its segment and the grid points that fall between them (half-open at the end).

    The grid starts at the segment's first sample. Every pair makes its own points, so there is no range join.
    """
    w = Window.partitionBy(*key).orderBy(t, "id")
    start = F.first(t).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = df.withColumn("__t0", start).withColumn("__tn", F.lead(t).over(w)).withColumns({f"__n_{c}": F.lead(c).over(w) for c in columns})
    low, high = F.ceil((F.col(t) - F.col("__t0")) / step), F.ceil((F.col("__tn") - F.col("__t0")) / step) - 1
    rows = rows.filter("__tn is not null").withColumn("k", F.explode(F.when(high >= low, F.sequence(low, high)).otherwise(F.array().cast("array<bigint>"))))
    return rows.withColumn("grid_t", F.col("__t0") + F.col("k") * step)


def grid_linear(df: DataFrame, key: list[str], columns: list[str], t: str = "t", step: float = STEP) -> DataFrame:
    """Channels on the uniform grid, by linear interpolation: ``key, k, grid_t, columns``."""
    rows = _pairs(df, key, t, columns, step)
    share = (F.col("grid_t") - F.col(t)) / (F.col("__tn") - F.col(t))
    return rows.select(*key, "k", "grid_t", *[(F.col(c) + (F.col(f"__n_{c}") - F.col(c)) * share).alias(c) for c in columns])


def grid_nearest(df: DataFrame, key: list[str], columns: list[str], t: str = "t", step: float = STEP) -> DataFrame:
    """Labels on the uniform grid, of the nearest sample (of equals the earlier)."""
    rows = _pairs(df, key, t, columns, step)
    earlier = F.col("grid_t") - F.col(t) <= F.col("__tn") - F.col("grid_t")
    return rows.select(*key, "k", "grid_t", *[F.when(earlier, F.col(c)).otherwise(F.col(f"__n_{c}")).alias(c) for c in columns])


def taps(q: int) -> list[float]:
    """Windowed-sinc low pass for decimation by q: 20q + 1 taps, Hamming window, cutoff 1/q, unit gain at zero."""
    half = 10 * q
    n = np.arange(-half, half + 1)
    h = np.sinc(n / q) * (0.54 + 0.46 * np.cos(math.pi * n / half))
    return [float(x) for x in h / h.sum()]


#: Output points of a block of the decimating filter.
BLOCK = 512


def decimate_channels(grid: DataFrame, key: list[str], columns: list[str], q: int, block: int = BLOCK) -> DataFrame:
    """Every q-th point of the low-passed series of all ``columns``, without delay, zeros beyond the ends: ``key, j, columns``.

    Overlap-save: the points that a block of ``block`` outputs needs, its own and a halo on both sides, are gathered once (only
    points of the halo travel twice), and a batch of blocks is a matrix whose transform is multiplied by that of the taps.
    No point is multiplied by its taps one by one, and the blocks of a long series are independent. Missing points are zeros.
    """
    h, half = np.asarray(taps(q)), 10 * q
    span, width = block * q, block * q + 2 * half
    k = F.col("k")
    low, high = F.greatest(F.floor((k - half) / span), F.lit(0)), F.floor((k + half) / span)
    last = grid.groupBy(*[F.col(c).alias(f"__{c}") for c in key]).agg(F.floor(F.max("k") / q).alias("__last"))
    placed = grid.select(*key, "k", *columns, F.explode(F.sequence(low, high)).alias("__b"))
    gathered = placed.groupBy(*key, "__b").agg(F.collect_list(F.struct((k - F.col("__b") * span + half).cast("int").alias("p"), *[F.col(c).cast("double").alias(c) for c in columns])).alias("__x"))
    same = reduce(lambda c, n: c & F.col(n).eqNullSafe(F.col(f"__{n}")), key, F.lit(True))
    blocks = gathered.join(last, same).filter(F.col("__b") * block <= F.col("__last"))
    arrays = blocks.select(*key, "__b", F.least(F.col("__last") + 1 - F.col("__b") * block, F.lit(block)).cast("int").alias("__n"), F.col("__x.p").alias("__p"), *[F.col(f"__x.{c}").alias(c) for c in columns])
    schema = arrays.select(*key).schema.add("j", "long")
    for c in columns:
        schema = schema.add(c, "double")
    points = 1 << (width + len(h) - 2).bit_length()
    response = np.fft.rfft(h[::-1], points)

    def run(batches):
        for pdf in batches:
            for at in range(0, len(pdf), 64):
                part = pdf.iloc[at : at + 64].reset_index(drop=True)
                lengths = part["__p"].map(len).to_numpy()
                row, place = np.repeat(np.arange(len(part)), lengths), np.concatenate([*part["__p"], np.zeros(0, int)]).astype(int)
                n = part["__n"].to_numpy()
                kept = np.arange(block)[None, :] < n[:, None]
                out = {c: np.repeat(part[c].to_numpy(), n) for c in key}
                out["j"] = (part["__b"].to_numpy()[:, None] * block + np.arange(block)[None, :])[kept]
                for c in columns:
                    x = np.zeros((len(part), width))
                    x[row, place] = np.nan_to_num(np.concatenate([*map(np.asarray, part[c]), np.zeros(0)]).astype(float))
                    y = np.fft.irfft(np.fft.rfft(x, points, axis=1) * response, points, axis=1)
                    out[c] = y[:, 2 * half : 2 * half + span : q][kept]
                yield pd.DataFrame(out)

    return arrays.mapInPandas(run, schema)


def decimate_fir(grid: DataFrame, key: list[str], column: str, q: int) -> DataFrame:
    """Every q-th point of the low-passed series, without delay, zeros beyond the ends: ``key, j, column``."""
    return decimate_channels(grid, key, [column], q)


def decimate_with_context(grid: DataFrame, key: list[str], column: str, window: int, context: int = 128) -> tuple[DataFrame, DataFrame]:
    """Windows halved in rate with real samples on both sides; those without are skipped and counted."""
    halved = decimate_fir(grid, key, column, 2)
    ends = grid.groupBy(*key).agg(F.max("k").alias("__end"))
    rows = halved.join(ends, key).withColumn("win", F.floor(F.col("j") * 2 / window))
    inside = (F.col("win") * window >= context) & ((F.col("win") + 1) * window + context <= F.col("__end") + 1)
    per = rows.groupBy(*key, "win").agg(F.max(inside).alias("inside"), F.sort_array(F.collect_list(F.struct("j", column))).alias("points"))
    return per.filter("inside").drop("inside"), per.filter("not inside").groupBy(*key).agg(F.count("*").alias("n_skipped"))


def resample_method(hz: Column, target: float = 100.0) -> Column:
    return F.when(hz == target, "grid_aligned").otherwise("interp_to_grid")


def smoothing(dt: float, cutoff: float) -> float:
    """Weight of the new sample in a first-order low pass."""
    x = 2 * math.pi * dt * cutoff
    return x / (x + 1)


def lowpass_channels(df: DataFrame, key: list[str], row: str, channels: dict[str, Column], a: float, block: int | None = None) -> DataFrame:
    """``df`` with every one of ``channels`` (name: source) low-passed: y0 = x0, y = a x + (1 - a) y before.

    Rows of a key are taken in order of ``row``, which counts from 0; 0 < a < 1; a null sample adds nothing.
    Blocks of rows are filtered on their own from zero, as running sums of the samples weighted with (1 - a)^-i
    (a block is so short that the weights stay finite; the latest weigh most, so nothing is lost to rounding).
    What enters a block are the ends of those before it, each decayed by the blocks between: a frame of as
    many blocks as it takes for the decay to fall below the least double, so no recording is gathered in a row.
    It decays into the block: y = local + (1 - a)^(i + 1) carry.
    """
    rate = -math.log(1 - a)
    most = max(1, int(230 / rate))
    block = max(1, min(block or most, most))
    decay = lambda k: F.pow(F.lit(1 - a), k)
    rows = df.withColumns({f"__x_{k}": c for k, c in channels.items()}).withColumns({"__block": F.floor(F.col(row) / block), "__i": (F.col(row) % block).cast("double")})
    running = Window.partitionBy(*key, "__block").orderBy(row).rowsBetween(Window.unboundedPreceding, 0)
    weighed = {k: F.when(F.col(row) == 0, F.col(f"__x_{k}")).otherwise(a * F.col(f"__x_{k}")) * decay(-F.col("__i")) for k in channels}
    done = rows.withColumns({f"__l_{k}": F.coalesce(F.sum(x).over(running), F.lit(0.0)) * decay(F.col("__i")) for k, x in weighed.items()})
    ends = done.groupBy(*key, "__block").agg(F.max_by(F.struct(*[f"__l_{k}" for k in channels]), "__i").alias("__end"))
    reach = max(1, math.ceil(745 / (rate * block)))
    before = Window.partitionBy(*key).orderBy("__block").rowsBetween(-reach, -1)
    into = ends.select(*key, "__block", F.collect_list("__end").over(before).alias("__ends"))
    carry = lambda k: F.aggregate("__ends", F.lit(0.0), lambda sofar, end: sofar * (1 - a) ** block + end[f"__l_{k}"])
    into = into.select(*key, "__block", *[carry(k).alias(f"__c_{k}") for k in channels])
    out = {k: F.col(f"__l_{k}") + decay(F.col("__i") + 1) * F.col(f"__c_{k}") for k in channels}
    return done.join(into, [*key, "__block"]).select(*[c for c in df.columns if c not in channels], *[y.alias(k) for k, y in out.items()])


def lowpass_causal(df: DataFrame, key: list[str], row: str, x: str, a: float, block: int | None = None) -> DataFrame:
    """``df`` with ``y``, the low pass of ``x`` (see :func:`lowpass_channels`)."""
    return lowpass_channels(df, key, row, {"y": F.col(x)}, a, block)


def raw_to_features(df: DataFrame, channels: dict[str, Column], a: float, block: int | None = None) -> DataFrame:
    """``rec, segment, id, t, row_idx`` and each of ``channels`` (name: source of the recording's variant), low-passed at the raw rate, in one pass."""
    done = lowpass_channels(df, ["rec"], "row_idx", {k: c.cast("double") for k, c in channels.items()}, a, block)
    return done.select("rec", "segment", "id", "t", "row_idx", *channels)


def serve_dt(df: DataFrame, rec: str = "rec", t: str = "t", order: tuple[str, ...] = ("t", "id"), most: float = 5.0) -> DataFrame:
    """Per recording the interval the filter is served with (the last one), its ratio to the median, and why not."""
    w = Window.partitionBy(rec).orderBy(*order)
    rows = df.withColumn("dt", F.col(t) - F.lag(t).over(w)).withColumn("__r", F.row_number().over(w))
    per = rows.groupBy(rec).agg(F.count("*").alias("n"), F.max_by("dt", "__r").alias("last_dt"), F.median("dt").alias("med"))
    why = first_message((F.col("n") < 2, "fewer than 2 rows"), (F.col("med") <= 0, "median interval not positive"), (F.col("last_dt") <= 0, "last interval not positive"), (F.col("last_dt") > most * F.col("med"), "last interval is a gap"))
    return per.select(rec, "last_dt", ratio(F.col("last_dt"), F.col("med")).alias("last_over_median"), why.alias("refusal"))


def gradient_in_segment(df: DataFrame, key: list[str], t: str, x: str, out: str, least: int = 3) -> DataFrame:
    """``df`` with the derivative of ``x`` per second inside each segment: central of second order for uneven steps, one-sided at the ends.

    Segments of fewer than ``least`` rows are left out.
    """
    w = Window.partitionBy(*key).orderBy(t, "id")
    whole = Window.partitionBy(*key)
    hs, hd = (F.col(t) - F.lag(t).over(w)) / 1000.0, (F.lead(t).over(w) - F.col(t)) / 1000.0
    back, ahead = F.col(x) - F.lag(x).over(w), F.lead(x).over(w) - F.col(x)
    central = (hs * hs * ahead + hd * hd * back) / (hs * hd * (hs + hd))
    value = F.when(hs.isNull(), ahead / hd).when(hd.isNull(), back / hs).otherwise(central)
    return df.withColumn("__n", F.count("*").over(whole)).withColumn(out, value).filter(F.col("__n") >= least).drop("__n")


def commits(df: DataFrame, key: list[str], order: list[str], d: str, delta: float = 1.0) -> DataFrame:
    """``df`` with ``commit``: the sign of ``d`` beyond +-delta differs from the last such sign (the first counts), and ``swap``: it is not the first."""
    w = Window.partitionBy(*key).orderBy(*order)
    sign = F.when(F.col(d) > delta, 1).when(F.col(d) < -delta, -1)
    rows = df.withColumn("__s", sign).withColumn("__p", F.last("__s", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)))
    commit = F.col("__s").isNotNull() & ~F.col("__s").eqNullSafe(F.col("__p"))
    return rows.withColumn("commit", commit).withColumn("swap", flag(F.col("__s") != F.col("__p"))).drop("__s", "__p")


def swap_count(df: DataFrame, key: list[str], order: list[str], d: str, delta: float = 1.0) -> DataFrame:
    """Number of swaps: commits to the other side, without the first one."""
    return commits(df, key, order, d, delta).groupBy(*key).agg(F.sum(F.col("swap").cast("long")).alias("swaps"))


def crossings(df: DataFrame, key: list[str], order: list[str], t: str, row: str, d: str, delta: float = 1.0) -> DataFrame:
    """Commits with the time since the one before."""
    rows = commits(df, key, order, d, delta).filter("commit")
    return rows.select(*key, row, t, (F.col(t) - F.lag(t).over(Window.partitionBy(*key).orderBy(t))).alias("interval"))


def window_trace(df: DataFrame, key: list[str], t: str, x: str, start: float, stop: float, bucket: float) -> DataFrame:
    """The trace around a moment: per bucket the first value and whether a commit falls in it."""
    rows = df.filter((F.col(t) >= start) & (F.col(t) < stop)).withColumn("bucket", F.floor((F.col(t) - start) / bucket))
    return rows.groupBy(*key, "bucket").agg(F.min_by(x, F.struct(t, "id")).alias("first_value"), F.max("commit").alias("commit"))
