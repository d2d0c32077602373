"""Sliding windows over segments: panes for what adds up, window arrays for spectra, labels, rest references.

Rows have ``i``, their place in the segment. A window starts at every ``step`` rows and has ``n``; where ``step``
divides ``n``, rows are aggregated once per pane of ``step`` rows and panes are combined over a frame, so no row is
copied into its n / step windows. Sums are of values less a centre (the recording's mean), so that squares and
higher powers don't cancel.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recsense.functions.columns import flag, quantile_at, quantile_of, ratio

from .selection import quantiles

KEY = ("rec", "segment")
#: Order in which the features come.
BASIC = ("std", "ptp")
RATE = ("mean", "absmean")


def with_place(df: DataFrame, order: tuple[str, ...] = ("t", "id")) -> DataFrame:
    """``df`` with ``i``, the row's place in its segment."""
    return df.withColumn("i", (F.row_number().over(Window.partitionBy(*KEY).orderBy(*order)) - 1).cast("long"))


def centred(df: DataFrame, columns: list[str], rec: str = "rec") -> DataFrame:
    """``df`` with ``c_x``: each channel less the mean of the recording's finite values (any centre near them will do)."""
    centres = df.groupBy(rec).agg(*[F.coalesce(F.avg(F.when(F.abs(c) < float("inf"), F.col(c))), F.lit(0.0)).alias(f"__m_{c}") for c in columns])
    return df.join(centres, rec).withColumns({f"c_{c}": F.col(c) - F.col(f"__m_{c}") for c in columns}).drop(*[f"__m_{c}" for c in columns])


def over_panes(df: DataFrame, n: int, step: int, sums: dict[str, Column], lows: dict[str, Column], highs: dict[str, Column]) -> DataFrame:
    """``rec, segment, start`` and the sums, minima and maxima of every whole window."""
    aggs = [F.count("*").alias("__n")] + [F.sum(c).alias(k) for k, c in sums.items()] + [F.min(c).alias(k) for k, c in lows.items()] + [F.max(c).alias(k) for k, c in highs.items()]
    panes = df.groupBy(*KEY, F.floor(F.col("i") / step).alias("pane")).agg(*aggs)
    frame = Window.partitionBy(*KEY).orderBy("pane").rowsBetween(0, n // step - 1)
    out = panes.select(*KEY, (F.col("pane") * step).alias("start"), F.sum("__n").over(frame).alias("__n"), *[F.sum(k).over(frame).alias(k) for k in sums], *[F.min(k).over(frame).alias(k) for k in lows], *[F.max(k).over(frame).alias(k) for k in highs])
    return out.filter(F.col("__n") == n).drop("__n")


def tumbling_windows(df: DataFrame, n: int) -> DataFrame:
    """Windows that don't overlap; the rest of a segment is dropped."""
    return over_panes(df, n, n, {}, {"t_start": F.col("t")}, {"t_end": F.col("t")})


def sliding_windows(df: DataFrame, n: int, step: int) -> DataFrame:
    """Windows every ``step`` rows, within segments."""
    return over_panes(df, n, step, {}, {"t_start": F.col("t")}, {"t_end": F.col("t")})


def exploded(df: DataFrame, n: int, step: int) -> DataFrame:
    """Each row once per window that holds it (for any step): only for what needs all values of a window."""
    last = F.floor(F.col("i") / step)
    first = F.greatest(F.ceil((F.col("i") - n + 1) / step), F.lit(0))
    starts = F.transform(F.when(last >= first, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>")), lambda k: k * step)
    rows = df.withColumn("start", F.explode(starts))
    length = df.groupBy(*KEY).agg(F.count("*").alias("__len"))
    return rows.join(length, list(KEY)).filter(F.col("start") + n <= F.col("__len")).drop("__len")


def _std(n: int, s: Column, ss: Column) -> Column:
    return F.sqrt(F.greatest(ss / n - (s / n) * (s / n), F.lit(0.0)))


def feat_basic(df: DataFrame, n: int, step: int, angles: list[str], rates: list[str]) -> DataFrame:
    """Population std and range of all channels; mean and mean of absolute values of the rates."""
    channels = angles + rates
    rows = centred(df, channels)
    sums = {f"s_{c}": F.col(f"c_{c}") for c in channels} | {f"q_{c}": F.col(f"c_{c}") ** 2 for c in channels} | {f"v_{c}": F.col(c) for c in rates} | {f"a_{c}": F.abs(c) for c in rates}
    w = over_panes(rows, n, step, sums, {f"l_{c}": F.col(c) for c in channels}, {f"h_{c}": F.col(c) for c in channels})
    out = {f"{c}_std": _std(n, F.col(f"s_{c}"), F.col(f"q_{c}")) for c in channels} | {f"{c}_ptp": F.col(f"h_{c}") - F.col(f"l_{c}") for c in channels}
    out |= {f"{c}_mean": F.col(f"v_{c}") / n for c in rates} | {f"{c}_absmean": F.col(f"a_{c}") / n for c in rates}
    return w.select(*KEY, "start", *[v.alias(k) for k, v in out.items()])


def feat_corr(df: DataFrame, n: int, step: int, pairs: dict[str, tuple[str, str]]) -> DataFrame:
    """Correlation of channel pairs; 0 where a side is constant."""
    channels = sorted({c for p in pairs.values() for c in p})
    rows = centred(df, channels)
    sums = {f"s_{c}": F.col(f"c_{c}") for c in channels} | {f"q_{c}": F.col(f"c_{c}") ** 2 for c in channels} | {f"x_{k}": F.col(f"c_{a}") * F.col(f"c_{b}") for k, (a, b) in pairs.items()}
    w = over_panes(rows, n, step, sums, {f"l_{c}": F.col(c) for c in channels}, {f"h_{c}": F.col(c) for c in channels})

    def corr(k: str, a: str, b: str) -> Column:
        cov = F.col(f"x_{k}") / n - F.col(f"s_{a}") / n * F.col(f"s_{b}") / n
        constant = (F.col(f"l_{a}") == F.col(f"h_{a}")) | (F.col(f"l_{b}") == F.col(f"h_{b}"))
        return F.when(constant, 0.0).otherwise(F.coalesce(ratio(cov, _std(n, F.col(f"s_{a}"), F.col(f"q_{a}")) * _std(n, F.col(f"s_{b}"), F.col(f"q_{b}"))), F.lit(0.0)))

    return w.select(*KEY, "start", *[corr(k, a, b).alias(k) for k, (a, b) in pairs.items()])


def feat_moments(df: DataFrame, n: int, step: int, rate: str, fs: float) -> DataFrame:
    """Skewness and excess kurtosis (constant: 0 and -3), share above zero, peak ratio, rms of the derivative inside the window."""
    rows = centred(df, [rate])
    w = Window.partitionBy(*KEY).orderBy("i")
    rows = rows.withColumn("__d", (F.col(rate) - F.lag(rate).over(w)) * fs)
    c = F.col(f"c_{rate}")
    sums = {f"m{k}": c**k for k in (1, 2, 3, 4)} | {"pos": (F.col(rate) > 0).cast("double"), "dd": F.coalesce(F.col("__d") ** 2, F.lit(0.0)), "d0": F.when(F.col("i") % step == 0, F.coalesce(F.col("__d") ** 2, F.lit(0.0))).otherwise(0.0)}
    out = over_panes(rows, n, step, sums, {"low": F.col(rate)}, {"high": F.col(rate)})
    # the step into the window's first row is no part of it: that of the window's first pane goes
    head = rows.filter(F.col("i") % step == 0).select(*KEY, F.col("i").alias("start"), F.coalesce(F.col("__d") ** 2, F.lit(0.0)).alias("into"))
    out = out.join(head, [*KEY, "start"])
    mean = F.col("m1") / n
    e2, e3, e4 = (F.col(f"m{k}") / n for k in (2, 3, 4))
    var = e2 - mean * mean
    third = e3 - 3 * mean * e2 + 2 * mean**3
    fourth = e4 - 4 * mean * e3 + 6 * mean * mean * e2 - 3 * mean**4
    constant = F.col("low") == F.col("high")
    skew = F.when(constant, 0.0).otherwise(third / F.pow(F.greatest(var, F.lit(1e-300)), F.lit(1.5)))
    kurt = F.when(constant, -3.0).otherwise(fourth / F.greatest(var * var, F.lit(1e-300)) - 3.0)
    return out.select(*KEY, "start", skew.alias("skew"), kurt.alias("kurtosis"), (F.col("pos") / n).alias("posfrac"), (F.col("high") / (F.abs("low") + 1e-6)).alias("peakratio"), F.sqrt((F.col("dd") - F.col("into")) / (n - 1)).alias("angacc"))


def feat_rest_relative(df: DataFrame, n: int, step: int, channels: list[str], zero: DataFrame) -> DataFrame:
    """Per channel: 95th percentile and median over the rest angle, and the range between percentiles 5 and 95."""
    per = window_arrays(df, n, step, channels).select(*KEY, "start", *[F.array(*[quantile_of(F.col(c), q) for q in (0.05, 0.5, 0.95)]).alias(f"p_{c}") for c in channels])
    joined = per.join(zero, "rec")
    get = lambda c, k: F.get(F.col(f"p_{c}"), k)
    return joined.select(*KEY, "start", *[x for c in channels for x in ((get(c, 2) - F.col(f"zero_{c}")).alias(f"{c}_high"), (get(c, 1) - F.col(f"zero_{c}")).alias(f"{c}_med"), (get(c, 2) - get(c, 0)).alias(f"{c}_range"))])


def feat_interleg(df: DataFrame, n: int, step: int, d: str, delta: float) -> DataFrame:
    """Least range over two halves and four quarters, and swaps inside the window (panes hold first sign, last sign, changes)."""
    sign = F.when(F.col(d) > delta, 1).when(F.col(d) < -delta, -1)
    rows = df.withColumn("__s", sign)
    w = Window.partitionBy(*KEY, F.floor(F.col("i") / step)).orderBy("i")
    rows = rows.withColumn("__p", F.last("__s", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)))
    panes = rows.groupBy(*KEY, F.floor(F.col("i") / step).alias("pane")).agg(F.count("*").alias("n"), F.min(d).alias("lo"), F.max(d).alias("hi"), F.min_by("__s", F.when(F.col("__s").isNotNull(), F.col("i"))).alias("first"), F.max_by("__s", F.when(F.col("__s").isNotNull(), F.col("i"))).alias("last"), F.sum(flag(F.col("__s") != F.col("__p")).cast("long")).alias("changes"))
    m = n // step
    frame = Window.partitionBy(*KEY).orderBy("pane").rowsBetween(0, m - 1)
    items = panes.select(*KEY, (F.col("pane") * step).alias("start"), F.sum("n").over(frame).alias("__n"), F.collect_list(F.struct("lo", "hi", "first", "last", "changes")).over(frame).alias("x")).filter(F.col("__n") == n)

    def least(parts: int) -> Column:
        size = m // parts
        ranges = [F.array_max(F.transform(F.slice("x", k * size + 1, size), lambda p: p["hi"])) - F.array_min(F.transform(F.slice("x", k * size + 1, size), lambda p: p["lo"])) for k in range(parts)]
        return F.least(*ranges)

    zero = F.struct(F.lit(None).cast("int").alias("last"), F.lit(0).cast("long").alias("n"))
    step_ = lambda acc, p: F.struct(F.coalesce(p["last"], acc["last"]).alias("last"), (acc["n"] + p["changes"] + flag(p["first"] != acc["last"]).cast("long")).alias("n"))
    return items.select(*KEY, "start", least(2).alias("minhalf"), least(4).alias("minquarter"), F.aggregate("x", zero, step_)["n"].alias("swaps"))


# --- features of window arrays ----------------------------------------------------------------------


def window_arrays(df: DataFrame, n: int, step: int, channels: list[str]) -> DataFrame:
    """``rec, segment, start`` and one array per channel, in row order, of every whole window.

    Rows are gathered once per pane and panes joined over a frame of n / step; only where ``step`` doesn't divide
    ``n`` rows are copied into their windows.
    """
    ordered = F.sort_array(F.collect_list(F.struct("i", *channels)))
    if n % step:
        per = exploded(df, n, step).groupBy(*KEY, "start").agg(ordered.alias("__x"))
        return per.select(*KEY, "start", *[F.col(f"__x.{c}").alias(c) for c in channels])
    panes = df.groupBy(*KEY, F.floor(F.col("i") / step).alias("__pane")).agg(ordered.alias("__x"))
    panes = panes.select(*KEY, "__pane", F.size("__x").alias("__n"), *[F.col(f"__x.{c}").alias(c) for c in channels])
    frame = Window.partitionBy(*KEY).orderBy("__pane").rowsBetween(0, n // step - 1)
    whole = panes.select(*KEY, (F.col("__pane") * step).alias("start"), F.sum("__n").over(frame).alias("__n"), *[F.collect_list(c).over(frame).alias(c) for c in channels])
    return whole.filter(F.col("__n") == n).select(*KEY, "start", *[F.flatten(c).alias(c) for c in channels])


def spectrum(x: np.ndarray, fs: float, low: float, middle: float, high: float) -> np.ndarray:
    """Rows of ``dominant frequency, share of the low band, share of the high band`` for rows of values.

    Symmetric Hann window, mean removed, power without the zero bin; all zero where there is no power.
    """
    n = x.shape[1]
    taper = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(n) / (n - 1))
    power = np.abs(np.fft.rfft((x - x.mean(1, keepdims=True)) * taper, axis=1)) ** 2
    freq = np.arange(power.shape[1]) * fs / n
    total = power[:, 1:].sum(1)
    band, upper = (freq >= low) & (freq <= middle), (freq >= middle) & (freq <= high)
    safe = np.where(total > 0, total, 1)
    dominant = freq[band][power[:, band].argmax(1)] if band.any() else np.zeros(len(x))
    return np.stack([np.where(total > 0, dominant, 0), np.where(total > 0, power[:, band].sum(1) / safe, 0), np.where(total > 0, power[:, upper].sum(1) / safe, 0)], 1)


def autocorrelation(x: np.ndarray, most: int) -> np.ndarray:
    """Autocorrelation at lags 0..most, of values less their mean, over that at lag 0 (0 if constant)."""
    y = x - x.mean(1, keepdims=True)
    size = 1 << (2 * y.shape[1] - 1).bit_length()
    acf = np.fft.irfft(np.abs(np.fft.rfft(y, size, axis=1)) ** 2, size, axis=1)[:, : most + 1]
    base = acf[:, :1]
    return np.where(base > 1e-12, acf / np.where(base > 1e-12, base, 1), 0.0)


def cycle(x: np.ndarray, fs: float, shortest: int, longest: int) -> np.ndarray:
    """Lag of the greatest autocorrelation between two lags, in seconds."""
    most = min(longest, x.shape[1] - 1)
    if most < shortest:
        return np.zeros(len(x))
    return (autocorrelation(x, most)[:, shortest:].argmax(1) + shortest) / fs


def lead_lag(x: np.ndarray, y: np.ndarray, fs: float, within: int) -> np.ndarray:
    """Lag within +-``within`` rows at which the z-scored rows correlate most, in seconds."""
    def z(v: np.ndarray) -> np.ndarray:
        s = v.std(1, keepdims=True)
        return np.where(s > 1e-12, (v - v.mean(1, keepdims=True)) / np.where(s > 1e-12, s, 1), 0.0)

    a, b, n = z(x), z(y), x.shape[1]
    lags = range(-min(within, n - 1), min(within, n - 1) + 1)
    products = np.stack([(a[:, max(0, k) : n + min(0, k)] * b[:, max(0, -k) : n - max(0, k)]).sum(1) for k in lags], 1)
    return (products.argmax(1) + lags[0]) / fs


def feat_spectral(arrays: DataFrame, angle: str, other: str, fs: float, bands: tuple[float, float, float], lags: tuple[int, int], within: int) -> DataFrame:
    """Spectral shares, cycle and lead of two channels' window arrays, in one batched pass."""

    def run(batches):
        for pdf in batches:
            if len(pdf):
                x, y = np.stack(pdf[angle].to_numpy()).astype(float), np.stack(pdf[other].to_numpy()).astype(float)
                s = spectrum(x, fs, *bands)
                yield pd.DataFrame({"rec": pdf["rec"], "segment": pdf["segment"], "start": pdf["start"], "dominant": s[:, 0], "band": s[:, 1], "high_band": s[:, 2], "cycle": cycle(x, fs, *lags), "lead": lead_lag(x, y, fs, within)})

    return arrays.mapInPandas(run, "rec long, segment long, start long, dominant double, band double, high_band double, cycle double, lead double")


def spectra_of_sides(fs: float, bands: tuple[float, float, float], lags: tuple[int, int], within: int):
    """A function of both sides' window arrays: spectral shares and cycle of each and the lead of the left one, in one batched pass."""
    names = [f"{side}_{f}" for side in ("left", "right") for f in ("dominant", "band", "high_band", "cycle")]

    @F.pandas_udf(", ".join(f"{c} double" for c in [*names, "lead"]))
    def run(left: pd.Series, right: pd.Series) -> pd.DataFrame:
        if not len(left):
            return pd.DataFrame({c: np.zeros(0) for c in [*names, "lead"]})
        x, y = (np.stack(c.to_numpy()).astype(float) for c in (left, right))
        values = [v for z in (x, y) for v in (*spectrum(z, fs, *bands).T, cycle(z, fs, *lags))]
        return pd.DataFrame({**dict(zip(names, values, strict=True)), "lead": lead_lag(x, y, fs, within)})

    return run


def feature_names(angles: tuple[str, str], rates: tuple[str, str]) -> list[str]:
    """The 42 features in their order."""
    names = [f"{c}_{s}" for c in angles for s in BASIC] + [f"{c}_{s}" for c in rates for s in ("mean", "std", "ptp", "absmean")] + ["angle_corr", "rate_corr"]
    for angle, rate in zip(angles, rates, strict=True):
        names += [f"{rate}_{s}" for s in ("dominant", "band", "skew", "kurtosis", "posfrac", "peakratio", "high_band", "angacc", "cycle")]
        names += [f"{angle}_{s}" for s in ("high", "med", "range")]
    return [*names, "lead", "minhalf", "minquarter", "swaps"]


#: Panes that one task's stretch of a segment has at least.
STRETCH = 4096


def stretches(df: DataFrame, n: int, step: int, panes: int = STRETCH) -> DataFrame:
    """``df`` with ``__pane`` and ``__stretch``; the first panes of a stretch also go to the one before, whose last windows reach into them.

    A segment of any length is dealt out this way: a stretch has ``panes`` panes and those of one window more.
    """
    halo = n // step - 1
    panes = max(panes, halo)
    pane = F.floor(F.col("i") / step)
    own = F.floor(pane / panes)
    into = F.when((own > 0) & (pane % panes < halo), F.array(own - 1, own)).otherwise(F.array(own))
    return df.withColumns({"__pane": pane, "__stretch": F.explode(into)})


def _pane_state(channels: tuple[str, ...], rates: tuple[str, ...], pairs: dict[str, tuple[str, str]], delta: float) -> list[Column]:
    """What is known of a pane, from its ordered rows ``__x`` and its aggregates: central moments, extremes, ends, swaps."""
    out = [F.col(f"{k}_{c}") for c in (*channels, "__leg") for k in ("lo", "hi")] + [F.col(f"mean_{c}") for c in channels]
    out += [(F.col("__n") * F.col(f"var_{c}")).alias(f"m2_{c}") for c in channels] + [(F.col("__n") * F.col(f"cov_{k}")).alias(f"xy_{k}") for k in pairs]
    for c in rates:
        # powers from the standardised moments, which are null in a constant pane
        second = F.col(f"var_{c}")
        out += [F.coalesce(F.col("__n") * F.col(f"skew_{c}") * F.pow(second, F.lit(1.5)), F.lit(0.0)).alias(f"m3_{c}"), F.coalesce(F.col("__n") * (F.col(f"kurt_{c}") + 3.0) * second * second, F.lit(0.0)).alias(f"m4_{c}")]
        x = F.col(f"__x.{c}")
        steps = F.zip_with(F.slice(x, 2, F.size(x)), F.slice(x, 1, F.size(x) - 1), lambda p, q: (p - q) * (p - q))
        out += [F.col(f"abs_{c}"), F.col(f"pos_{c}"), F.aggregate(steps, F.lit(0.0), lambda s, v: s + v).alias(f"dd_{c}"), F.element_at(x, 1).alias(f"first_{c}"), F.element_at(x, -1).alias(f"last_{c}")]
    sides = F.filter(F.transform("__x.__leg", lambda v: F.when(F.isnan(v), None).when(v > delta, 1).when(v < -delta, -1)), lambda v: v.isNotNull())
    changes = lambda v: F.aggregate(F.zip_with(F.slice(v, 2, F.size(v)), v, lambda p, q: flag(p != q).cast("long")), F.lit(0).cast("long"), lambda s, k: s + k)
    return [*out, F.get(sides, 0).alias("side"), F.try_element_at(sides, F.lit(-1)).alias("last_side"), F.when(F.size(sides) > 0, changes(sides)).otherwise(F.lit(0).cast("long")).alias("changes")]


def all_features(df: DataFrame, n: int, step: int, angles: tuple[str, str], rates: tuple[str, str], zero: DataFrame, delta: float, fs: float, bands: tuple[float, float, float], lags: tuple[int, int], within: int, panes: int = STRETCH) -> DataFrame:
    """Every window with all of :func:`feature_names`, both sides, from one aggregate of panes.

    ``zero`` has the rest angles ``zero_x`` of both angles and ``zero_d`` of their difference (see
    :func:`rest_reference`), from which swaps are counted; recordings without them have no windows.

    Rows are dealt once to stretches of segments, so that no task holds a long recording. A pane's state merges:
    central moments and cross moments by the shift of the means, extremes, ends (for steps between panes), and swaps by the first and
    last side and the changes between. Only percentiles and spectra need the values of a window, in its panes' arrays.
    Null values count as NaN, which moments hand on; rows without a side, as NaN ones, are no swap. ``step`` divides ``n`` into panes whose number four divides.
    """
    if n % step or n // step % 4:
        raise ValueError("windows have to have a multiple of four panes")
    key, m, channels = [*KEY, "__stretch"], n // step, (*angles, *rates)
    pairs = {"angle_corr": angles, "rate_corr": rates}
    zeros = [f"zero_{c}" for c in (*angles, "d")]
    rows = df.select(*KEY, "i", *[F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))).alias(c) for c in channels]).join(zero.select("rec", *zeros), "rec")
    rows = stretches(rows.withColumn("__leg", F.col(angles[0]) - F.col(angles[1]) - F.col("zero_d")), n, step, panes).repartition(*key)
    aggs = [F.count("*").alias("__n"), F.sort_array(F.collect_list(F.struct("i", *channels, "__leg"))).alias("__x"), *[F.first(c).alias(c) for c in zeros]]
    aggs += [f(c).alias(f"{k}_{c}") for c in (*channels, "__leg") for k, f in (("lo", F.min), ("hi", F.max))]
    aggs += [f(c).alias(f"{k}_{c}") for c in channels for k, f in (("mean", F.avg), ("var", F.var_pop))]
    aggs += [f(c).alias(f"{k}_{c}") for c in rates for k, f in (("skew", F.skewness), ("kurt", F.kurtosis), ("abs", lambda c: F.sum(F.abs(c))), ("pos", lambda c: F.sum((F.col(c) > 0).cast("double"))))]
    aggs += [F.covar_pop(*p).alias(f"cov_{k}") for k, p in pairs.items()]
    states = rows.groupBy(*key, "__pane").agg(*aggs).select(*key, "__pane", "__n", *zeros, F.col("__x"), F.struct(*_pane_state(channels, rates, pairs, delta)).alias("__p"))

    frame = Window.partitionBy(*key).orderBy("__pane").rowsBetween(0, m - 1)
    gathered = states.select(*KEY, (F.col("__pane") * step).alias("start"), F.sum("__n").over(frame).alias("__n"), *zeros, F.collect_list("__p").over(frame).alias("__p"), F.flatten(F.collect_list("__x").over(frame)).alias("__x"), (F.floor(F.col("__pane") / max(panes, m - 1)) == F.col("__stretch")).alias("__own"))
    whole = gathered.filter((F.col("__n") == n) & F.col("__own"))

    total = lambda f: F.aggregate("__p", F.lit(0.0), lambda s, p: s + f(p))
    extreme = lambda f, k, part=None: f(F.transform("__p" if part is None else F.slice("__p", *part), lambda p: p[k]))
    span = lambda c, part=None: extreme(F.array_max, f"hi_{c}", part) - extreme(F.array_min, f"lo_{c}", part)
    cut = lambda parts: F.least(*[span("__leg", (k * (m // parts) + 1, m // parts)) for k in range(parts)])
    means = {f"__m_{c}": total(lambda p, c=c: p[f"mean_{c}"]) / m for c in channels} | {f"__o_{c}": F.sort_array(F.col(f"__x.{c}")) for c in angles}
    whole = whole.withColumns(means)
    shift = lambda p, c: p[f"mean_{c}"] - F.col(f"__m_{c}")
    moments = {f"__2_{c}": total(lambda p, c=c: p[f"m2_{c}"] + step * shift(p, c) * shift(p, c)) / n for c in channels}
    moments |= {f"__r_{c}": span(c) for c in channels} | {f"__xy_{k}": total(lambda p, k=k, a=a, b=b: p[f"xy_{k}"] + step * shift(p, a) * shift(p, b)) / n for k, (a, b) in pairs.items()}
    moments |= {f"__3_{c}": total(lambda p, c=c: p[f"m3_{c}"] + 3 * shift(p, c) * p[f"m2_{c}"] + step * F.pow(shift(p, c), F.lit(3))) / n for c in rates}
    moments |= {f"__4_{c}": total(lambda p, c=c: p[f"m4_{c}"] + 4 * shift(p, c) * p[f"m3_{c}"] + 6 * shift(p, c) * shift(p, c) * p[f"m2_{c}"] + step * F.pow(shift(p, c), F.lit(4))) / n for c in rates}
    whole = whole.withColumns(moments).withColumn("__s", spectra_of_sides(fs, bands, lags, within)(*[F.col(f"__x.{c}") for c in rates]))

    tiny, col = F.lit(1e-300), F.col
    out = {f"{c}_std": F.sqrt(f"__2_{c}") for c in channels} | {f"{c}_ptp": col(f"__r_{c}") for c in channels}
    out |= {f"{c}_mean": col(f"__m_{c}") for c in rates} | {f"{c}_absmean": total(lambda p, c=c: p[f"abs_{c}"]) / n for c in rates}
    for k, (a, b) in pairs.items():
        r = ratio(col(f"__xy_{k}"), F.sqrt(f"__2_{a}") * F.sqrt(f"__2_{b}"))
        out[k] = F.when((col(f"__r_{a}") == 0) | (col(f"__r_{b}") == 0), 0.0).otherwise(F.coalesce(r, F.lit(0.0)))
    for c, side in zip(rates, ("left", "right"), strict=True):
        constant, var = col(f"__r_{c}") == 0, col(f"__2_{c}")
        jumps = F.zip_with(F.transform(F.slice("__p", 2, m - 1), lambda p: p[f"first_{c}"]), F.transform(F.slice("__p", 1, m - 1), lambda p: p[f"last_{c}"]), lambda x, y: (x - y) * (x - y))
        between = F.aggregate(jumps, F.lit(0.0), lambda s, v: s + v)
        out |= {f"{c}_{f}": col(f"__s.{side}_{f}") for f in ("dominant", "band", "high_band", "cycle")}
        out |= {f"{c}_skew": F.when(constant, 0.0).otherwise(col(f"__3_{c}") / F.pow(F.greatest(var, tiny), F.lit(1.5))), f"{c}_kurtosis": F.when(constant, -3.0).otherwise(col(f"__4_{c}") / F.greatest(var * var, tiny) - 3.0)}
        out |= {f"{c}_posfrac": total(lambda p, c=c: p[f"pos_{c}"]) / n, f"{c}_peakratio": extreme(F.array_max, f"hi_{c}") / (F.abs(extreme(F.array_min, f"lo_{c}")) + 1e-6), f"{c}_angacc": fs * F.sqrt((total(lambda p, c=c: p[f"dd_{c}"]) + between) / (n - 1))}
    for c in angles:
        low, middle, high = (quantile_at(col(f"__o_{c}"), n, q) for q in (0.05, 0.5, 0.95))
        out |= {f"{c}_high": high - col(f"zero_{c}"), f"{c}_med": middle - col(f"zero_{c}"), f"{c}_range": high - low}
    nothing = F.struct(F.lit(None).cast("int").alias("side"), F.lit(0).cast("long").alias("n"))
    merge = lambda s, p: F.struct(F.coalesce(p["last_side"], s["side"]).alias("side"), (s["n"] + p["changes"] + flag(p["side"] != s["side"]).cast("long")).alias("n"))
    out |= {"lead": col("__s.lead"), "minhalf": cut(2), "minquarter": cut(4), "swaps": F.aggregate("__p", nothing, merge)["n"]}
    return whole.select(*KEY, "start", *[out[c].alias(c) for c in feature_names(angles, rates)])


# --- labels, rest, reference ------------------------------------------------------------------------


def window_label(df: DataFrame, n: int, step: int, code: str = "code", low: int = 0, high: int = 10) -> DataFrame:
    """Purity over the two classes; the class if pure, ``transition`` if mixed, null without either; share of unsure rows."""
    is_ = lambda v: flag(F.col(code) == v).cast("long")
    w = over_panes(df, n, step, {"nl": is_(low), "nh": is_(high), "nu": is_(-1)}, {}, {})
    known = F.col("nl") + F.col("nh")
    purity = ratio(F.greatest("nl", "nh"), known)
    label = F.when(known == 0, None).when(purity < 1, "transition").when(F.col("nl") > 0, str(low)).otherwise(str(high))
    return w.select(*KEY, "start", purity.alias("purity"), label.alias("label"), (F.col("nu") / n).alias("unknown_frac"))


def rest_reference(df: DataFrame, channels: list[str], d: str, span: int, delta: float) -> DataFrame:
    """Rest angles per recording: the opening span if it has no swap, else the calmest span without one, else all rows (untrusted).

    Calm spans start at every quarter of a span, within segments; swaps are of ``d`` less the span's median.
    """
    arrays = window_arrays(df, span, max(1, span // 4), list(dict.fromkeys([d, *channels]))).withColumn("__m", quantile_of(F.col(d), 0.5))
    # no swap: the rows beyond +-delta are all on one side
    swung = flag(F.exists(d, lambda x: x - F.col("__m") > delta)) & flag(F.exists(d, lambda x: x - F.col("__m") < -delta))
    spans = arrays.filter(~swung).select(*KEY, "start", (F.array_max(d) - F.array_min(d)).alias("ptp"), *[quantile_of(F.col(c), 0.5).alias(f"zero_{c}") for c in channels])
    zeros = [f"zero_{c}" for c in channels]
    opening = (F.col("segment") == 0) & (F.col("start") == 0)
    best = spans.groupBy("rec").agg(F.min_by(F.struct(*zeros), F.struct((~opening).cast("int"), "ptp", "segment", "start")).alias("z"))
    whole = df.groupBy("rec").agg(*[F.median(c).alias(f"__w_{c}") for c in channels])
    joined = whole.join(best, "rec", "left")
    return joined.select("rec", *[F.coalesce(F.col(f"z.zero_{c}"), F.col(f"__w_{c}")).alias(f"zero_{c}") for c in channels], F.col("z").isNotNull().alias("rest_trusted"))


def amplitude_band(df: DataFrame, value: str, label: str, low: str, high: str) -> DataFrame:
    """1st percentile of the high class and 99th of the low class, selected exactly; infinities the wrong way round if either is empty."""
    found = quantiles(df.filter(F.col(label).isin(low, high)), [label], value, [0.01, 0.99])
    per = found.agg(F.max(F.when(F.col(label) == high, F.get("q", 0))).alias("a"), F.max(F.when(F.col(label) == low, F.get("q", 1))).alias("b"))
    none = F.col("a").isNull() | F.col("b").isNull()
    return per.select(F.when(none, float("inf")).otherwise(F.col("a")).alias("band_low"), F.when(none, float("-inf")).otherwise(F.col("b")).alias("band_high"))


def reference_stats(df: DataFrame, features: list[str]) -> DataFrame:
    """1st and 99th percentile of every feature, selected exactly in passes that all features share: ``feature, p01, p99``."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("v")) for c in features])).alias("x")).select("x.*")
    names = df.sparkSession.createDataFrame([(c,) for c in features], "feature string")
    return names.join(quantiles(long, ["feature"], "v", [0.01, 0.99]), "feature", "left").select("feature", F.get("q", 0).alias("p01"), F.get("q", 1).alias("p99"))
