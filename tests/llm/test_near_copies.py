import random

import numpy as np
import pytest
import xxhash

from recsense.llm import simhash
from recsense.llm.simhash import COPY_DISTANCE, LANES, near_copies, sketch

MASK = (1 << 64) - 1


def mixed(x):
    x = (x ^ x >> 30) * simhash.MIX[0] & MASK
    x = (x ^ x >> 27) * simhash.MIX[1] & MASK
    return x ^ x >> 31


def scalar(text):
    """Bits of the sketch, each counted by itself."""
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").split(" ") if w]
    raw = [int.from_bytes(xxhash.xxh64_digest(w.encode(), 42), "little") for w in words]
    out = []
    for width, n_lanes in ((5, LANES), (1, 3), (2, 1)):
        shingles = set()
        for i in range(max(1, len(raw) - width + 1) if raw else 0):
            h = 0
            for w in raw[i : i + width]:
                h = mixed((h + simhash.GAMMA + w) & MASK)
            shingles.add(h)
        for lane in range(1, n_lanes + 1):
            hashes = [mixed((h + lane * simhash.GAMMA) & MASK) for h in shingles]
            out.append(sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes)))
    return out


def test_sketch_equals_a_scalar_loop():
    for text in (None, "", " \t", "One", "a b", "Ünder SCORE x", "a b c d e f g A B\tC\nd", "the quick brown " * 300, " ".join(f"w{k * k % 701}" for k in range(900))):
        assert sketch(text).tolist() == scalar(text)


def test_lanes_are_in_proportion_to_the_angle():
    rng = random.Random(1)
    vocabulary = [f"w{k}" for k in range(3000)]
    for edits, least, most in ((0, 0, 0), (3, 8, COPY_DISTANCE), (400, 90, 170)):
        words = [rng.choice(vocabulary) for _ in range(400)]
        other = list(words)
        for k in rng.sample(range(400), edits):
            other[k] = rng.choice(vocabulary) + "x"
        a, b = sketch(" ".join(words))[:LANES], sketch(" ".join(other))[:LANES]
        assert least <= int(np.bitwise_count(a ^ b).sum()) <= most


def corpus():
    rng = random.Random(11)
    vocabulary = [f"w{k}" for k in range(2000)]
    texts, group = [None, "", " \n ", "one two", "ONE two", "one two three"], [0, 0, 0, 1, 1, 2]
    for g in range(30):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(80, 600))]
        texts += [" ".join(words)] * 2
        group += [3 + g] * 2
        for _ in range(g % 4):
            copy = list(words)
            copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            texts.append(" ".join(copy))
            group.append(3 + g)
    texts += ["long text " * 30_000, "long text " * 29_999 + "indeed"]
    group += [99, 100]
    return texts, group


def test_components_equal_the_planted_groups(spark):
    texts, group = corpus()
    rng = random.Random(3)
    ids = rng.sample(range(10**6), len(texts))
    ids[7] = None
    rows = spark.createDataFrame([(i, t, "x", "y") for i, t in zip(ids, texts, strict=True)], "doc_id long, text string, fp string, component_id string")
    least = {}
    for i, g in zip(ids, group, strict=True):
        if i is not None:
            least[g] = min(least.get(g, i), i)
    got = near_copies(rows)
    assert got.columns == ["doc_id", "component_id"]
    want = sorted((i is None, i or 0, least[g]) for i, g in zip(ids, group, strict=True))
    # two long repeated texts that share most of their few different shingles may be one group or two
    long = {ids[-1], ids[-2]}
    found = sorted((r.doc_id is None, r.doc_id or 0, r.component_id) for r in got.collect())
    assert [w for w in want if w[1] not in long] == [f for f in found if f[1] not in long]
    assert len(found) == len(texts)
    assert near_copies(rows.limit(0)).count() == 0
    twice = near_copies(rows.unionByName(rows)).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.component_id) for r in twice) == sorted(found * 2)


def test_large_keys_are_compared_by_blocks(spark):
    rng = random.Random(2)
    base = np.array([rng.getrandbits(64) for _ in range(LANES)], np.uint64)
    rows = []
    for _ in range(150):
        x = base.copy()
        for k in rng.sample(range(64 * LANES), 20):
            x[k // 64] ^= np.uint64(1 << (k % 64))
        rows.append(x)
    other = np.array([rng.getrandbits(64) for _ in range(LANES)], np.uint64)
    rows.append(other)
    names = ", ".join(f"{c} long" for c in ["key", *simhash.COPY_COLUMNS])
    frame = spark.createDataFrame([(5, *map(int, r.view(np.int64))) for r in rows], names)
    for most in (7, simhash.BLOCK):
        found = simhash.linked_by_keys(frame, COPY_DISTANCE, most, 30).persist()
        assert {r.unsure for r in found.collect()} == {True, False}
        labels = simhash.components(found.select("a", "b")).collect()
        assert len({r.root for r in labels}) == 1
        assert {r.node for r in labels} == {int(r.view(np.int64)[0]) for r in rows[:-1]}


def test_merged_links_have_the_same_components(spark):
    rng = random.Random(8)
    edges = {(rng.randrange(10, 400), rng.randrange(-200, 10)) for _ in range(300)}
    edges |= {(m, r) for m in range(1000, 1300) for r in range(500, 520)}
    frame = spark.createDataFrame(sorted(edges), "a long, b long")
    fewer = simhash.merged(frame)
    assert fewer.filter("a >= 1000").count() == 300
    assert fewer.count() < 700
    assert sorted(simhash.components(fewer).collect()) == sorted(simhash.components(frame).collect())


@pytest.mark.parametrize("edits, least", [(0.005, 0.98), (0.015, 0.9)])
def test_recall_of_pairs_of_similarity_080(edits, least):
    """Of pairs whose five-word shingles have a similarity of 0.8 or more, the share that has a key and is verified."""
    rng = random.Random(5)
    vocabulary = [f"w{k}" for k in range(5000)]
    hit = total = 0
    while total < 150:
        words = [rng.choice(vocabulary) for _ in range(rng.randint(80, 500))]
        copy = [rng.choice(vocabulary) if rng.random() < edits else w for w in words]
        one, two = ({tuple(x[i : i + 5]) for i in range(len(x) - 4)} for x in (words, copy))
        if words == copy or len(one & two) < 0.8 * len(one | two):
            continue
        a, b = sketch(" ".join(words)), sketch(" ".join(copy))
        found = False
        for lane in range(LANES, 2 * LANES):
            key, row = simhash.keys(np.array([a[lane], b[lane]], np.uint64), False)
            found |= bool(set(key[row == 0].tolist()) & set(key[row == 1].tolist()))
        hit += found and int(np.bitwise_count(a[:LANES] ^ b[:LANES]).sum()) <= COPY_DISTANCE
        total += 1
    assert hit / total >= least
