"""The second opinion at 100 Hz, windows of 200 rows every 25, against a scalar walk over hand-made signals."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from recsense.operators import physics, signals

FS, N, STEP, REACH, SHORTEST, LONGEST, FLOOR, DELTA = 100.0, 200, 25, 300, 33, 200, 0.35, 5.0


def lag_products(x, k):
    m = sum(x) / len(x)
    return sum((x[i] - m) * (x[i + k] - m) for i in range(len(x) - k))


def scalar_cell(left, right, c, zero=0.0):
    a, b = max(0, c - REACH), min(len(left), c + REACH)
    d = [x - y - zero for x, y in zip(left, right, strict=True)]
    around, base = d[a:b], lag_products(d[a:b], 0)
    acf = {k: lag_products(around, k) / base for k in range(SHORTEST, min(LONGEST, len(around) - 1) + 1)} if base > 1e-9 else {}
    lag = None
    if any(v < 0 for v in acf.values()):
        start = min(k for k, v in acf.items() if v < 0)
        best = max((k for k in acf if k >= start), key=lambda k: (acf[k], -k))
        lag = best if acf[best] >= FLOOR else None
    half = N // 2 if lag is None else min(max(lag, N // 2), REACH)

    def swaps(values):
        sides = [1 if v > DELTA else -1 for v in values if abs(v) > DELTA]
        return sum(p != q for p, q in zip(sides, sides[1:], strict=False))

    s0, s1 = max(0, c - half), min(len(d), c + half)
    count, span = swaps(d[s0:s1]), 2 * half
    h = len(around) // 2
    if count < 2 and min(max(p) - min(p) for p in (around[:h], around[h:])) >= 8 and swaps(around) >= 2:
        if np.std(left[a:b]) > 0 and np.std(right[a:b]) > 0 and -np.corrcoef(left[a:b], right[a:b])[0, 1] >= 0.5:
            count, span = swaps(around), b - a
    return lag, ("STANDING", "AMBIGUOUS", "WALKING")[min(count, 2)], count, span


@pytest.fixture(scope="module")
def walk():
    """Standing, a slow walk (strides longer than a window's half), a fast one, standing with one shift of weight."""
    rng = np.random.default_rng(3)
    rate = np.concatenate((np.zeros(400), np.full(700, 0.7), np.full(500, 1.6), np.zeros(600)))
    phase = np.cumsum(rate) / FS * 2 * math.pi
    left = np.where(rate > 0, 20 * np.sin(phase), 0.0) + rng.normal(0, 0.4, len(rate))
    right = np.where(rate > 0, -20 * np.sin(phase), 0.0) + rng.normal(0, 0.4, len(rate))
    left[1900:] += 12
    return left, right


def frame(spark, walk):
    rows = [("r", 0, i, float(a), float(b)) for i, (a, b) in enumerate(zip(*walk, strict=True))] + [("short", 0, i, 0.0, 1.0) for i in range(N - 1)]
    return spark.createDataFrame(rows, "rec string, segment int, i long, a double, b double")


def test_adaptive_verdict_equals_a_scalar_walk(spark, walk):
    around = physics.spans(frame(spark, walk), N, STEP, REACH, ["a", "b"])
    got = physics.anchor_features(around, "a", "b", FS, N, REACH, SHORTEST, LONGEST, FLOOR, DELTA).orderBy("start").collect()
    starts = list(range(0, len(walk[0]) - N + 1, STEP))
    assert [(r.rec, r.start) for r in got] == [("r", s) for s in starts]
    kinds, spans = set(), set()
    for r in got:
        lag, verdict, swaps, span = scalar_cell(*(x.tolist() for x in walk), r.start + N // 2)
        assert (r.period is None) == (lag is None) and (lag is None or math.isclose(r.period, lag / FS))
        assert (r.verdict, r.swaps, r.span) == (verdict, swaps, span)
        kinds.add(verdict)
        spans.add(span)
    assert kinds == {"STANDING", "AMBIGUOUS", "WALKING"} and max(spans) > N


def test_periodicity_is_the_tallest_peak(spark, walk):
    around = physics.spans(frame(spark, walk), N, STEP, REACH, ["a", "b"])
    got = physics.anchor_features(around, "a", "b", FS, N, REACH, SHORTEST, LONGEST, FLOOR, DELTA).orderBy("start").collect()
    for r in got[::9]:
        c, half = r.start + N // 2, N // 2 if r.period is None else int(min(max(round(r.period * FS), N // 2), REACH))
        want = []
        for x in walk:
            part = x[max(0, c - half) : c + half].tolist()
            base = lag_products(part, 0)
            want.append(min(1.0, max(0.0, max(lag_products(part, k) / base for k in range(SHORTEST, len(part) // 2 + 1)))) if len(part) // 2 > SHORTEST else 0.0)
        assert math.isclose(r.periodicity, sum(want) / 2, abs_tol=1e-6)


def test_rate_audit_tells_sums_from_shapes(spark, walk):
    """Halving the rate leaves shapes alone and halves a sum of squares."""
    grid = frame(spark, walk).filter("rec = 'r'").withColumnRenamed("i", "k").withColumn("v", F.col("a") * 3)
    key = ["rec", "segment"]
    from recsense.operators import windows

    def table(df, i, n, shortest):
        arrays = windows.window_arrays(df.withColumnRenamed(i, "i"), n, n, ["a", "b", "v"]).withColumn("start", (F.col("start") / n).cast("long"))
        return physics.audited_anchors(arrays, "a", "b", ("v",), shortest, DELTA)

    native = table(grid, "k", N, SHORTEST)
    assert {r.verdict for r in native.collect()} == {"STANDING", "WALKING"}
    a, b, v = (signals.decimate_fir(grid, key, c, 2) for c in ("a", "b", "v"))
    half = table(a.join(b, [*key, "j"]).join(v, [*key, "j"]), "j", N // 2, SHORTEST // 2)
    inside = native.filter("verdict = 'WALKING' and start >= 1")
    found = {r.anchor: r for r in physics.rate_invariance(inside, half, [*key, "start"], physics.AUDITED).collect()}
    assert set(found) == set(physics.AUDITED)
    assert all(found[c].invariant for c in ("periodicity", "antiphase", "grav_stab"))
    assert not found["gyro_energy"].invariant and abs(found["gyro_energy"].median_change - 0.5) < 0.02


def test_windows_halved_with_context_equal_a_scalar_filter(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=700)
    grid = spark.createDataFrame([("r", k, float(v)) for k, v in enumerate(x)], "rec string, k long, x double")
    kept, skipped = signals.decimate_with_context(grid, ["rec"], "x", 200, 128)
    got = {r.win: [p.x for p in r.points] for r in kept.collect()}
    assert set(got) == {1} and [r.n_skipped for r in skipped.collect()] == [3]
    h = np.asarray(signals.taps(2))
    want = [sum(h[j] * x[k + j - len(h) // 2] for j in range(len(h))) for k in range(200, 400, 2)]
    assert np.allclose(got[1], want)


def test_legs_that_rest_apart_swap_about_their_centre(spark, walk):
    """One leg rests 10 degrees off: without the centre other verdicts come out, with it those of the scalar walk."""
    left, right = walk[0] + 10.0, walk[1]
    around = physics.spans(frame(spark, (left, right)), N, STEP, REACH, ["a", "b"]).withColumn("zero_d", F.lit(10.0))
    run = lambda zero: physics.anchor_features(around, "a", "b", FS, N, REACH, SHORTEST, LONGEST, FLOOR, DELTA, zero=zero).orderBy("start").collect()
    got, off = run("zero_d"), run(None)
    for r in got:
        _, verdict, swaps, span = scalar_cell(left.tolist(), right.tolist(), r.start + N // 2, 10.0)
        assert (r.verdict, r.swaps, r.span) == (verdict, swaps, span)
    assert [r.swaps for r in got] != [r.swaps for r in off]
    from recsense.operators import windows

    both = frame(spark, (left, right)).filter("rec = 'r'").withColumns({"v": F.col("a") * 3, "u": F.col("b") * 2, "d": F.col("a") - F.col("b")})
    zero = windows.rest_reference(both, ["d"], "d", 300, DELTA)
    assert abs(zero.first().zero_d - 10.0) < 0.3 and zero.first().rest_trusted
    arrays = windows.window_arrays(both, N, N, ["a", "b", "v", "u"]).join(zero, "rec")
    one = {r.start: r for r in physics.audited_anchors(arrays, "a", "b", ("v", "u"), SHORTEST, DELTA, "zero_d").collect()}
    energy = (left[:N] * 3) ** 2 + (right[:N] * 2) ** 2
    assert one[0].verdict == "STANDING" and math.isclose(one[0].gyro_energy, energy.sum(), rel_tol=1e-9)


def test_binomial_tail_of_a_million_windows(spark):
    """The two-sided tail equals sums of exact terms, and a million outcomes take seconds."""
    rows = [(k, n, p) for n, p in ((0, 0.3), (1, 0.5), (9, 0.2), (10, 0.5), (60, 0.35), (400, 0.71)) for k in {0, n // 3, n // 2, n}]
    df = spark.createDataFrame(rows, "k long, n long, p double")
    for r in df.withColumn("got", physics.binomial_test(F.col("k"), F.col("n"), F.col("p"))).collect():
        pmf = [math.comb(r.n, i) * r.p**i * (1 - r.p) ** (r.n - i) for i in range(r.n + 1)]
        assert math.isclose(r.got, min(1.0, sum(f for f in pmf if f <= pmf[r.k] * (1 + 1e-7))), rel_tol=1e-9, abs_tol=1e-14)
    import time

    big = spark.createDataFrame([(500_900, 1_000_000, 0.5)], "k long, n long, p double")
    began = time.time()
    got = big.select(physics.binomial_test(F.col("k"), F.col("n"), F.col("p")).alias("p")).first().p
    assert time.time() - began < 20 and abs(got - math.erfc(899.5 / 500 / math.sqrt(2))) < 1e-4


def test_decimation_in_blocks_equals_a_scalar_filter(spark):
    rng = np.random.default_rng(9)
    series = {"r": rng.normal(size=(733, 2)), "s": rng.normal(size=(3, 2)), None: rng.normal(size=(41, 2))}
    grid = spark.createDataFrame([(n, k, *map(float, v)) for n, x in series.items() for k, v in enumerate(x)], "rec string, k long, x double, y double").filter("rec <> 'r' or rec is null or k <> 300")
    series["r"][300] = 0.0
    for q, block in ((2, 16), (5, 7), (2, 512)):
        h = np.asarray(signals.taps(q))
        got = {(r.rec, r.j): (r.x, r.y) for r in signals.decimate_channels(grid, ["rec"], ["x", "y"], q, block).collect()}
        assert len(got) == sum((len(x) - 1) // q + 1 for x in series.values())
        for (n, j), v in got.items():
            x = series[n]
            want = sum(h[i] * x[j * q + i - len(h) // 2] for i in range(len(h)) if 0 <= j * q + i - len(h) // 2 < len(x))
            assert np.allclose(v, want, atol=1e-12)
