"""A second opinion without labels: the swap rule, audits of labels, plausibility of files."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recsense.functions.columns import correlation, correlation_of, flag, ratio

STANDING, AMBIGUOUS, WALKING = "STANDING", "AMBIGUOUS", "WALKING"


def swap_verdict(swaps: Column, mean: bool = False) -> Column:
    """0: standing, 1: ambiguous, 2 or more: walking; of a row's mean: below 0.5, below 1.5; null is ambiguous."""
    low, high = (0.5, 1.5) if mean else (1, 2)
    return F.when(swaps.isNull(), AMBIGUOUS).when(swaps < low, STANDING).when(swaps < high, AMBIGUOUS).otherwise(WALKING)


def padded(values: pd.Series, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Arrays as rows of a matrix, and how long each is."""
    lengths = values.map(len).to_numpy(np.int64)
    out = np.zeros((len(lengths), width))
    out[np.arange(width) < lengths[:, None]] = np.concatenate([np.asarray(v, float) for v in values]) if lengths.sum() else []
    return out, lengths


def rhythm(x: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """Autocorrelation of the part of each row that is ``inside``, at all lags; 0 where it is constant or under eight long."""
    size = inside.sum(1, keepdims=True)
    y = np.where(inside, x - (x * inside).sum(1, keepdims=True) / np.maximum(size, 1), 0.0)
    points = 1 << (2 * x.shape[1] - 1).bit_length()
    acf = np.fft.irfft(np.abs(np.fft.rfft(y, points, axis=1)) ** 2, points, axis=1)[:, : x.shape[1]]
    power = acf[:, :1]
    return np.where((power > 1e-9) & (size >= 8), acf / np.where(power > 1e-9, power, 1), 0.0)


def stride_lag(acf: np.ndarray, size: np.ndarray, shortest: int, longest: int, floor: float) -> np.ndarray:
    """For each row the lag of its highest value after the autocorrelation has turned negative, within the two lags; 0 if that is under ``floor``."""
    lag = np.arange(acf.shape[1])
    allowed = (lag >= shortest) & (lag <= longest) & (lag < size[:, None])
    turned = np.logical_or.accumulate(allowed & (acf < 0), axis=1) & allowed
    height = np.where(turned, acf, -np.inf)
    return np.where(height.max(1) >= floor, height.argmax(1), 0)


def tallest(acf: np.ndarray, size: np.ndarray, shortest: int) -> np.ndarray:
    """Height of the highest value between ``shortest`` and half the row's size, 0..1."""
    lag = np.arange(acf.shape[1])
    allowed = (lag >= shortest) & (lag <= (size // 2)[:, None]) & (size // 2 > shortest)[:, None]
    return np.clip(np.where(allowed, acf, 0.0).max(1), 0.0, 1.0)


def swaps_of(d: np.ndarray, delta: float, inside: np.ndarray | None = None) -> np.ndarray:
    """Per row the changes of side beyond +-delta, within ``inside``."""
    side = (d > delta).astype(np.int8) - (d < -delta)
    side = side if inside is None else side * inside
    at = np.maximum.accumulate(np.where(side != 0, np.arange(d.shape[1]), 0), axis=1)
    last = np.take_along_axis(side, at, 1)  # the side that was taken last
    return ((side[:, 1:] != 0) & (last[:, :-1] != 0) & (side[:, 1:] != last[:, :-1])).sum(1)


def swing(d: np.ndarray, inside: np.ndarray) -> np.ndarray:
    return np.where(inside.any(1), np.where(inside, d, -np.inf).max(1) - np.where(inside, d, np.inf).min(1), 0.0)


def antiphase(x: np.ndarray, y: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """Minus the correlation of two sides, 0 where one is constant."""
    n = np.maximum(inside.sum(1, keepdims=True), 1)
    u, v = (np.where(inside, z - (z * inside).sum(1, keepdims=True) / n, 0.0) for z in (x, y))
    norm = np.sqrt((u * u).sum(1) * (v * v).sum(1))
    return np.where(norm > 1e-9, -(u * v).sum(1) / np.where(norm > 1e-9, norm, 1), 0.0)


def centre(pdf: pd.DataFrame, zero: str | None) -> np.ndarray | float:
    return pdf[zero].to_numpy(float)[:, None] if zero else 0.0


def spans(df: DataFrame, n: int, step: int, reach: int, channels: list[str]) -> DataFrame:
    """``rec, segment, start, middle, <channel arrays>`` per full window: the rows up to ``reach`` on both sides of its middle.

    The rows of a pane are gathered once, and panes are joined over a frame of bounded width; ``middle`` is where the window's
    middle lies in the arrays, which end at the segment's ends.
    """
    key = ["rec", "segment"]
    pane = df.groupBy(*key, F.floor(F.col("i") / step).cast("long").alias("__pane")).agg(F.sort_array(F.collect_list(F.struct("i", *channels))).alias("__rows"))
    last = F.max(F.size("__rows") + F.col("__pane") * step).over(Window.partitionBy(*key))
    low, high = (n // 2 - reach) // step, -(-(n // 2 + reach) // step) - 1
    near = F.flatten(F.collect_list("__rows").over(Window.partitionBy(*key).orderBy("__pane").rowsBetween(low, high)))
    rows = pane.withColumns({"__len": last, "__near": near, "start": F.col("__pane") * step}).filter(F.col("start") + n <= F.col("__len"))
    middle = F.col("start") + n // 2
    rows = rows.withColumn("__near", F.filter("__near", lambda x: (x["i"] >= middle - reach) & (x["i"] < middle + reach)))
    return rows.select(*key, "start", (middle - F.col("__near")[0]["i"]).cast("int").alias("middle"), *[F.col(f"__near.{c}").alias(c) for c in channels])


def anchor_features(around: DataFrame, left: str, right: str, fs: float, n: int, reach: int, shortest: int, longest: int, floor: float, delta: float, least_swing: float = 8.0, least_antiphase: float = 0.5, zero: str | None = None) -> DataFrame:
    """Per row of :func:`spans`: stride period (s), periodicity, and the adaptive verdict with its swaps and span (rows).

    The span is a stride long on each side of the middle, at least half a window and at most ``reach``. Where it
    isn't walking, all that is in reach decides instead if both of its halves swing, the sides are in antiphase and
    swap twice. ``zero`` names the column with the recording's rest centre, which is taken off the difference of the sides before swaps
    are counted. All rows of a batch are matrices; no row is looked at on its own.
    """
    schema = around.select("rec", "segment", "start").schema.add("period", "double").add("periodicity", "double").add("verdict", "string").add("swaps", "long").add("span", "long")

    def run(batches):
        for pdf in batches:
            (x, size), (y, _) = padded(pdf[left], 2 * reach), padded(pdf[right], 2 * reach)
            place, middle, d = np.arange(2 * reach), pdf["middle"].to_numpy()[:, None], x - y - centre(pdf, zero)
            known = place < size[:, None]
            lag = stride_lag(rhythm(d, known), size, shortest, longest, floor)
            half = np.where(lag > 0, np.clip(lag, n // 2, reach), n // 2)
            part = known & (place >= middle - half[:, None]) & (place < middle + half[:, None])
            swaps, span, wide = swaps_of(d, delta, part), 2 * half, swaps_of(d, delta, known)
            first = known & (place < (size // 2)[:, None])
            both = np.minimum(swing(d, first), swing(d, known & ~first)) >= least_swing
            grown = (swaps < 2) & both & (size >= 8) & (antiphase(x, y, known) >= least_antiphase) & (wide >= 2)
            swaps, span = np.where(grown, wide, swaps), np.where(grown, size, span)
            inner = part.sum(1)
            beat = (tallest(rhythm(x, part), inner, shortest) + tallest(rhythm(y, part), inner, shortest)) / 2
            verdict = np.select([swaps >= 2, swaps == 1], [WALKING, AMBIGUOUS], STANDING)
            period = pd.Series(lag / fs).where(lag > 0)
            yield pdf[["rec", "segment", "start"]].reset_index(drop=True).assign(period=period, periodicity=beat, verdict=verdict, swaps=swaps, span=span)

    return around.mapInPandas(run, schema)


#: The anchors whose rate is audited, and whether their change is absolute or relative.
AUDITED = {"periodicity": "abs", "antiphase": "abs", "grav_stab": "abs", "gyro_energy": "rel"}


def audited_anchors(arrays: DataFrame, left: str, right: str, rates: tuple[str, ...], shortest: int, delta: float, zero: str | None = None) -> DataFrame:
    """Per window array the audited anchors and the swap rule's verdict: ``rec, segment, start, <anchors>, verdict``.

    The energy is the sum of squares of all ``rates``; swaps are counted about the rest centre in the column ``zero``.
    """
    schema = arrays.select("rec", "segment", "start").schema
    for c in AUDITED:
        schema = schema.add(c, "double")

    def run(batches):
        for pdf in batches:
            width = max(map(len, pdf[left]), default=1)
            (x, size), (y, _), *vs = (padded(pdf[c], width) for c in (left, right, *rates))
            known = np.arange(width) < size[:, None]
            spread = [np.sqrt(np.maximum((z * z).sum(1) / size - (z.sum(1) / size) ** 2, 0)) for z in (x, y)]
            beat = (tallest(rhythm(x, known), size, shortest) + tallest(rhythm(y, known), size, shortest)) / 2
            verdict = np.select([(s := swaps_of(x - y - centre(pdf, zero), delta, known)) >= 2, s == 1], [WALKING, AMBIGUOUS], STANDING)
            yield pdf[["rec", "segment", "start"]].reset_index(drop=True).assign(periodicity=beat, antiphase=antiphase(x, y, known), grav_stab=1 / (1 + 0.5 * (spread[0] + spread[1])), gyro_energy=sum((v * v).sum(1) for v, _ in vs), verdict=verdict)

    return arrays.mapInPandas(run, schema.add("verdict", "string"))


def coherence(df: DataFrame, key: list[str], t: str, least: int = 20, most: float = 0.5) -> DataFrame:
    """Per trial: decided windows, contradictions of the label, shares, and when they are.

    ``df``: pure windows with ``label`` and ``verdict``.
    """
    opinion = F.when(F.col("verdict") == WALKING, 10).when(F.col("verdict") == STANDING, 0)
    rows = df.withColumn("__bad", flag(opinion != F.col("label"))).withColumn("__decided", opinion.isNotNull())
    count = lambda c: F.sum(c.cast("long"))
    out = rows.groupBy(*key).agg(count(F.col("__decided")).alias("windows"), count(F.col("__bad")).alias("disagree"), F.avg((~F.col("__decided")).cast("double")).alias("abstain_frac"), F.min(t).alias("t_first"), F.max(t).alias("t_last"), F.min(F.when(F.col("__bad"), F.col(t))).alias("bad_first"), F.max(F.when(F.col("__bad"), F.col(t))).alias("bad_last"))
    out = out.withColumn("disagree_frac", ratio(F.col("disagree"), F.col("windows")))
    return out.withColumn("flag", flag((F.col("windows") >= least) & (F.col("disagree_frac") > most)))


def log_factorial(n: Column) -> Column:
    """log n!: a sum of logs below ten, from there Stirling's series, whose next term is under 1e-12."""
    x = n.cast("double")
    small = F.get(F.array(*[F.lit(math.lgamma(k + 1)) for k in range(10)]), n.cast("int"))
    series = (x + 0.5) * F.log(x) - x + 0.5 * math.log(2 * math.pi) + 1 / (12 * x) - 1 / (360 * x**3) + 1 / (1260 * x**5) - 1 / (1680 * x**7) + 1 / (1188 * x**9)
    return F.when(n < 10, small).otherwise(series)


def log_choose(n: Column, k: Column) -> Column:
    """log of n over k."""
    return log_factorial(n) - log_factorial(k) - log_factorial(n - k)


def binomial_test(k: Column, n: Column, p: Column) -> Column:
    """Two-sided exact p-value: the sum of all outcomes no likelier than k.

    Outcomes further than 40 deviations and 800 from the mean have no probability that a double holds, so those between
    are summed, about the root of n.
    """
    log_pmf = lambda i: log_choose(n, i) + i * F.log(p) + (n - i) * F.log(1 - p)
    limit = F.exp(log_pmf(k)) * (1 + 1e-7)
    reach = 40 * F.sqrt(n * p * (1 - p)) + 800
    low, high = F.greatest(F.floor(n * p - reach), F.lit(0)).cast("long"), F.least(F.ceil(n * p + reach), n).cast("long")
    terms = F.transform(F.sequence(low, high), lambda i: F.exp(log_pmf(i)))
    return F.least(F.aggregate(terms, F.lit(0.0), lambda s, x: s + F.when(x <= limit, x).otherwise(0.0)), F.lit(1.0))


def band_policy(df: DataFrame, key: list[str], value: str, low: float, high: float, least: int = 20, alpha: float = 0.05) -> DataFrame:
    """Per trial the share of the high class among windows in the band, tested against the corpus share (Bonferroni over testable trials)."""
    inside = df.filter(F.col(value).between(low, high))
    per = inside.groupBy(*key).agg(F.count("*").alias("band_windows"), F.sum((F.col("label") == 10).cast("long")).alias("band_walk"))
    corpus = per.agg((F.sum("band_walk") / F.sum("band_windows")).alias("__share"), F.sum((F.col("band_windows") >= least).cast("long")).alias("__tests"))
    out = per.crossJoin(F.broadcast(corpus)).withColumn("band_walk_frac", ratio(F.col("band_walk"), F.col("band_windows")))
    out = out.withColumn("band_p", F.when(F.col("band_windows") >= least, binomial_test(F.col("band_walk"), F.col("band_windows"), F.col("__share"))))
    return out.withColumn("band_flag", flag(F.col("band_p") < alpha / F.greatest("__tests", F.lit(1)))).drop("__share", "__tests")


def rate_invariance(one: DataFrame, two: DataFrame, key: list[str], anchors: dict[str, str], tolerance: float = 0.10, least: float = 1.0) -> DataFrame:
    """Median and 90th percentile of each anchor's change between two rates, and whether it is within tolerance.

    ``abs``: the difference; ``rel``: over the first value's size plus ``least``. ``n_audited``: windows of both rates.
    """
    other = two.select(*key, *[F.col(c).alias(f"__{c}") for c in anchors])
    joined = one.join(other, key)
    change = {c: F.abs(F.col(c) - F.col(f"__{c}")) / (F.lit(1.0) if kind == "abs" else F.abs(F.col(c)) + F.lit(least)) for c, kind in anchors.items()}
    row = joined.agg(F.count("*").alias("n_audited"), *[F.percentile(v, [0.5, 0.9]).alias(c) for c, v in change.items()])
    out = row.select("n_audited", F.explode(F.array(*[F.struct(F.lit(c).alias("anchor"), F.get(F.col(c), 0).alias("median_change"), F.get(F.col(c), 1).alias("p90_change")) for c in anchors])).alias("x")).select("x.*", "n_audited")
    return out.withColumn("invariant", F.col("median_change") <= tolerance)


def file_stats(df: DataFrame, file: str = "file") -> DataFrame:
    """Per file: covered and committed rows, the model's share of walking among committed rows, physics' shares among covered ones."""
    covered = F.col("guess").isNotNull()
    on = covered & flag(~F.col("ambiguous"))
    share = lambda cond, base: F.round(F.avg(F.when(base, cond.cast("double"))), 4)
    return df.groupBy(file).agg(F.count("*").alias("n_rows"), F.sum(covered.cast("long")).alias("n_covered"), F.sum(on.cast("long")).alias("n_committed"), share(on, covered).alias("committed_frac"), share(F.col("guess") == 10, on).alias("model_walk_frac"), share(F.col("physics") == WALKING, covered).alias("physics_walk_frac"), flag(F.min("rest_trusted")).alias("rest_trusted"))


def plausibility_check(stats: DataFrame, file: str = "file", least_rows: int = 3000, commit: float = 0.02, silent: tuple[float, float] = (0.9, 0.05), loud: tuple[float, float] = (0.5, 0.05)) -> DataFrame:
    """Findings per file; one that is too short is looked at no further."""
    long_enough = F.col("n_covered") >= least_rows
    known = F.col("model_walk_frac").isNotNull()
    findings = F.array_compact(F.array(
        F.when(~F.col("rest_trusted"), "rest_untrusted"),
        F.when(~long_enough, "too_short"),
        F.when(long_enough & (F.col("committed_frac") < commit), "commitment_collapse"),
        F.when(long_enough & known & (F.col("model_walk_frac") >= silent[0]) & (F.col("physics_walk_frac") <= silent[1]), "physics_silent"),
        F.when(long_enough & known & (F.col("physics_walk_frac") >= loud[0]) & (F.col("model_walk_frac") <= loud[1]), "physics_loud"),
    ))
    return stats.select(file, F.explode(findings).alias("finding"))


def plausibility_calibration(df: DataFrame, one: str, two: str) -> DataFrame:
    """Least, 5th percentile and median of the physics share, and its correlation with the annotated share."""
    pct = df.agg(F.min(one).alias("least"), F.percentile(one, [0.05, 0.5]).alias("p"))
    r = df.agg(*correlation(one, two)).select(correlation_of().alias("r"))
    return pct.crossJoin(r).select("least", F.get("p", 0).alias("p05"), F.get("p", 1).alias("median"), "r")


def with_faults(df: DataFrame, left: str, right: str, rec: str = "rec") -> DataFrame:
    """The rows again for each fault: left leg doubled, left sensor dead at its median, legs swapped; ``fault`` names it."""
    dead = df.groupBy(rec).agg(F.median(left).alias("__dead"))
    rows = df.join(dead, rec)
    case = lambda name, a, b: F.struct(F.lit(name).alias("fault"), a.alias(left), b.alias(right))
    l_, r_ = F.col(left).cast("double"), F.col(right).cast("double")
    spread = rows.withColumn("__x", F.explode(F.array(case("none", l_, r_), case("duplicated", l_, l_), case("dead", F.col("__dead"), r_), case("swapped", r_, l_))))
    return spread.select(*[c for c in df.columns if c not in (left, right)], "__x.*")
