import math
import random

import numpy as np

from recsense.llm.topk import Side, best_of_block, distances, far_apart, top_k


LONG = (1 << 63) - 1


def brute(rows, k, every):
    vectors = []
    for vec_id, v in rows:
        if vec_id is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        vectors.append((vec_id, [max(-LONG - 1, min(LONG, math.floor(64 * x))) for x in v]))
    out = []
    for j, (q, a) in enumerate(vectors):
        if q % every == 0:
            scores = sorted((-max(-LONG, min(LONG, sum(x * y for x, y in zip(a, b, strict=False)))), c) for i, (c, b) in enumerate(vectors) if i != j)
            out += [(q, r + 1, c, -s) for r, (s, c) in enumerate(scores[:k])]
    return sorted(out)


def test_equals_brute_force(spark):
    rng = random.Random(4)
    rows = [(k, [rng.gauss(0, 0.3) for _ in range(8)]) for k in range(300)]
    rows += [(400 + k, [0.5] * 8) for k in range(60)]  # ties
    rows += [(500, None), (501, [0.1, None]), (502, [float("nan")] * 8), (503, [float("inf")] * 8), (None, [1.0] * 8), (504, [0.2] * 3), (505, []), (7, rows[7][1]), (8, [0.9] * 8)]
    frame = spark.createDataFrame([(v, i, 1) for i, v in rows], "embedding array<double>, vec_id long, score int")
    for options in ({"query_block": 5, "vector_block": 40}, {}):
        got = top_k(frame, k=20, every=20, **options)
        assert sorted(map(tuple, got.collect())) == brute(rows, 20, 20)
    assert sorted(map(tuple, top_k(frame.filter("vec_id < 5"), k=20, every=4).collect())) == brute([r for r in rows if r[0] is not None and r[0] < 5], 20, 4)
    assert top_k(frame.limit(0)).count() == 0


def test_large_scores(spark):
    """Scores near the range of a long are exact, beyond it they end at its edge; components too."""
    rng = random.Random(5)
    for size in (1e5, 1e7, 3e9, 1e20):
        rows = [(k, [rng.gauss(0, size) for _ in range(6)]) for k in range(120)]
        frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
        assert sorted(map(tuple, top_k(frame, k=20, every=20, vector_block=50).collect())) == brute(rows, 20, 20)


def test_fewer_rows_than_k_and_no_queries(spark):
    rows = [(20, [1.0, 2.0]), (20, [1.0, 2.0]), (20, [-1.0, 2.0]), (3, [1.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(map(tuple, top_k(frame, k=20, every=20).collect())) == brute(rows, 20, 20)
    assert top_k(frame, k=20, every=7).count() == 0


def test_bounds_eliminate_where_vectors_lie_in_clusters():
    """On clustered vectors most pairs are never evaluated; on noise in many dimensions nearly all are."""
    rng = np.random.default_rng(6)
    shares = []
    for spread in (1.0, 40.0):
        centres = rng.normal(0, 40, (30, 32))
        v = np.floor(centres[rng.integers(0, 30, 6000)] + rng.normal(0, spread, (6000, 32))).astype(np.int64)
        v[::7] //= 2
        centre = far_apart(v[:1000].tolist(), 32, 64)
        far = distances(v.astype(float), centre)
        rows = np.arange(6000)
        queries, vectors = Side(rows[:100], rows[:100], v[:100], far[:100]), Side(rows, rows, v, far)
        query, _, ids, scores, evaluated = best_of_block(queries, vectors, 20)
        shares.append(evaluated / (100 * 5999))
        for q in range(0, 100, 9):
            s = v @ v[q]
            want = sorted((-s[c], c) for c in rows if c != q)[:20]
            assert sorted(zip(-scores[query == q], ids[query == q], strict=True)) == want
    assert shares[0] < 0.5 < shares[1]
