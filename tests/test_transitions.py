"""Boundaries of segments in time, against a walk over each segment."""

import random

import numpy as np
import pytest

from recsense.operators import joins

WINDOW = 4.0


def walk(rows):
    """Boundaries of one segment: rows are (t, truth, guess, reason) in time order."""
    t = np.array([r[0] for r in rows])
    runs, start = [], 0
    for k in range(1, len(rows) + 1):
        if k == len(rows) or rows[k][1] != rows[start][1]:
            runs.append((rows[start][1], start, k))
            start = k
    covered = [k for k, r in enumerate(rows) if r[2] is not None]
    changes = [(t[a] + t[b]) / 2 for a, b in zip(covered, covered[1:], strict=False) if rows[a][2] != rows[b][2]]
    for i, (v, a, b) in enumerate(runs):
        j = i + 1 + (i + 1 < len(runs) and runs[i + 1][0] == -1)
        if v not in (0, 10) or j >= len(runs) or runs[j][0] not in (0, 10) or runs[j][0] == v:
            continue
        _, c, d = runs[j]
        at = (t[b - 1] + t[c]) / 2
        before, after = t[b - 1] - t[a], t[d - 1] - t[c]
        rejected = "short_flank" if min(before, after) < WINDOW else "near_segment_edge" if min(at - t[0], t[-1] - at) < WINDOW else None
        offset = flagged = None
        if rejected is None:
            offset = changes[int(np.argmin([abs(x - at) for x in changes]))] - at if changes else None
            flagged = any(r[3] == "near_transition" and abs(r[0] - at) <= WINDOW / 2 for r in rows)
        names = {0: "stand", 10: "walk"}
        yield (f"{names[v]}->{names[runs[j][0]]}", *(round(float(x) / 1000, 3) for x in (at, t[c] - t[b - 1], before, after)), None if offset is None else round(float(offset) / 1000, 3), flagged, rejected)


@pytest.fixture(scope="module")
def made(spark):
    rng = random.Random(4)
    segments = {}
    for rec in range(12):
        for seg in range(3):
            rows, t, code = [], 0.0, 0
            for _ in range(rng.choice([0, 1, 60, 200])):
                t += rng.choice([250.0, 500.0, 1000.0]) * WINDOW
                if rng.random() < 0.15:
                    code = rng.choice([0, 10, -1, None])
                rows.append((t, code, rng.choice([0, 10, 10, None]) if rec % 4 else None, rng.choice(["", "near_transition", "model_split"])))
            segments[rec, seg] = rows
    frame = spark.createDataFrame([(*k, *r) for k, rows in segments.items() for r in rows], "rec long, segment long, t double, code int, guess int, reason string")
    return segments, frame


def test_transitions_equal_a_walk_over_each_segment(spark, made):
    segments, frame = made
    window = WINDOW
    found = joins.find_transitions(frame, ["rec", "segment"], ["t"], "t", "code", "guess", "reason", window)
    got = sorted((tuple(r) for r in found.collect()), key=repr)
    want = sorted(((*k, *x) for k, rows in segments.items() for x in walk(rows)), key=repr)
    assert got == want and {g[-1] for g in got} >= {None}


def test_summary_counts_every_boundary(spark, made):
    _, frame = made
    found = joins.find_transitions(frame, ["rec", "segment"], ["t"], "t", "code", "guess", "reason", 2000.0 * WINDOW, flank=0.25).persist()
    rows = found.collect()
    whole = joins.transition_summary(found, 2.0 * WINDOW).first()
    assert whole.n_timeable + whole.n_short_flank + whole.n_near_edge == len(rows) and min(whole.n_timeable, whole.n_short_flank, whole.n_near_edge) > 0
    off = [r.offset_s for r in rows if r.rejected is None and r.offset_s is not None]
    assert (whole.n_timed, whole.n_late, whole.n_early) == (len(off), sum(x > 0 for x in off), sum(x < 0 for x in off))
    assert whole.offset_median == pytest.approx(np.median(off)) and whole.offset_abs_p90 == pytest.approx(np.percentile(np.abs(off), 90))
    per = joins.transition_summary(found, 2.0 * WINDOW, ["rec"]).collect()
    assert sum(r.n_timeable for r in per) == whole.n_timeable
    assert joins.transition_summary(found.limit(0), 2.0 * WINDOW, ["rec"]).count() == 0
