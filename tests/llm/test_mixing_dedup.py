import hashlib
import random
import re

from recsense.llm.exact_dedup import exact_dedup
from recsense.llm.mixing import mix, mixed_rows

SPACE = re.compile(r"[\x20\x09-\x0D]")


def test_exact_dedup_equals_brute_force(spark):
    rng = random.Random(1)
    texts = [None, "", " \t\n", "a b", "ab", "a  b", "ab ", "é é", "x" * 50000, "x" * 50000 + " "] + ["hot one"] * 500 + [f"t {k}" for k in range(50)]
    ids = rng.sample(range(-1000, 100000), len(texts))
    rows = spark.createDataFrame([(i, t, "c", "s") for i, t in zip(ids, texts, strict=True)], "doc_id long, text string, content string, salt string")
    groups = {}
    for i, t in zip(ids, texts, strict=True):
        groups.setdefault(SPACE.sub("", t or ""), []).append((-len(t or ""), i))
    got = exact_dedup(rows).collect()
    assert len(got) == len(texts)
    by = dict(zip(ids, texts, strict=True))
    for r in got:
        norm = SPACE.sub("", by[r.doc_id] or "")
        keep = min(groups[norm])[1]
        assert (r.keep_id, r.group_size, r.kept) == (keep, len(groups[norm]), r.doc_id == keep)
        assert r.text_sha256 == hashlib.sha256(norm.encode()).hexdigest()
    assert exact_dedup(rows.limit(0)).count() == 0
    far = spark.createDataFrame([(-(1 << 63), "same"), (-(1 << 63) + 1, "sa me"), ((1 << 63) - 1, "other"), (None, "other"), (None, "same")], "doc_id long, text string")
    assert sorted((r.doc_id is None, r.doc_id or 0, r.keep_id) for r in exact_dedup(far).collect()) == [(False, -(1 << 63), -(1 << 63) + 1), (False, -(1 << 63) + 1, -(1 << 63) + 1), (False, (1 << 63) - 1, (1 << 63) - 1), (True, 0, -(1 << 63) + 1), (True, 0, (1 << 63) - 1)]
    odd = spark.createDataFrame([(None, "same"), (4, "sa me"), (4, "sa me"), (None, "alone")], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.keep_id, r.group_size, r.kept) for r in exact_dedup(odd).collect() if r.group_size > 1)
    assert got == [(0, 4, 3, False), (4, 4, 3, True), (4, 4, 3, True)]


def level(sizes, weights, share, cap):
    targets, stopped, left = {}, set(), share * sum(sizes.values())
    while True:
        open_ = [s for s in sizes if s not in stopped]
        weight = sum(weights[s] for s in open_)
        over = [s for s in open_ if left * weights[s] / weight > cap * sizes[s]]
        if not over:
            return targets | {s: left * weights[s] / weight for s in open_}
        for s in over:
            targets[s] = cap * sizes[s]
            stopped.add(s)
            left -= targets[s]


def test_mix_meets_targets(spark):
    rng = random.Random(2)
    rows = [(k, " ".join(["w"] * rng.randint(0, 40)), rng.choice(["a", "b", "c", "D", "é", None, "hot", "hot", "hot"])) for k in range(3000)]
    rows += [(9001, None, "a"), (9002, "one  two\tthree\x0bfour", "only"), (None, "x y", "a"), (9003, " ", "blank")]
    frame = spark.createDataFrame([(*r, 5) for r in rows], "doc_id long, text string, source string, size int")
    got = mix(frame).collect()
    assert len(got) == len(rows)
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, mix(frame).collect()), key=str)
    sizes = {}
    for r in got:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
    order = sorted((s for s in sizes if s is not None)) + [None]
    want = level(sizes, {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}, 1.5, 2.0)
    for r in got:
        assert abs(r.target - want[r.source]) < 1e-6 * (1 + want[r.source]) and r.source_size == sizes[r.source]
        assert r.taken in (0, r.size, 2 * r.size)
    for s in ("a", "b", "c", "D", "hot"):
        taken = sum(r.taken for r in got if r.source == s)
        assert abs(taken - want[s]) < 0.12 * want[s]
    assert sum(r.size for r in got if r.doc_id == 9002) == 4
    assert mix(frame.limit(0)).count() == 0
    emitted = mixed_rows(frame)
    assert emitted.columns == frame.columns
    assert emitted.count() == sum(r.copies for r in got)
