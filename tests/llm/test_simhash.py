import random

import numpy as np
import xxhash

from recsense.llm import simhash
from recsense.llm.simhash import decode, fingerprint, keys, near_duplicates, stars


def plain(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if counts[b] * 2 > len(shingles))


def test_fingerprint_equals_a_scalar_loop():
    for text in (None, "", " \t", "One", "Ünder SCORE x", "a b c d e f g A B\tC\nd", "the quick " * 300):
        assert fingerprint(text) == plain(text)


def test_golay_decodes_three_errors():
    rng = np.random.default_rng(3)
    word = np.arange(1 << 12) << 11
    code = np.array([w ^ int(simhash._tables()[0][w >> 11]) for w in word.tolist()])
    for n in range(4):
        error = np.array([sum(1 << int(k) for k in rng.choice(23, n, replace=False)) for _ in code])
        assert (decode(code ^ error) == np.arange(1 << 12)).all()


def test_near_pairs_share_a_key():
    rng = random.Random(7)
    for _ in range(400):
        a = rng.getrandbits(64)
        b = a
        for k in rng.sample(range(64), rng.randint(0, 4)):
            b ^= 1 << k
        key, row = keys(np.array([a, b], np.uint64))
        assert set(key[row == 0]) & set(key[row == 1])


def brute(texts, ids):
    fps = [plain(t) for t in texts]
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= 4:
                root[find(i)] = find(j)
    least = {}
    for i in range(len(fps)):
        if ids[i] is not None:
            least[find(i)] = min(least.get(find(i), ids[i]), ids[i])
    return sorted((ids[i] is None, ids[i] or 0, f"{fps[i]:016x}", least.get(find(i))) for i in range(len(fps)))


def test_components_equal_brute_force(spark):
    rng = random.Random(11)
    vocabulary = ["w%d" % k for k in range(300)]
    texts = [None, "", "one two", " \n "]
    for _ in range(12):
        words = [rng.choice(vocabulary) for _ in range(120)]
        texts += [" ".join(words)] * 2
        for _ in range(6):
            copy = list(words)
            for _ in range(rng.randint(1, 4)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            texts.append(" ".join(copy))
    ids = [rng.randrange(10**6) for _ in texts]
    ids[5] = None
    rows = spark.createDataFrame([(i, t, "x") for i, t in zip(ids, texts, strict=True)], "doc_id long, text string, fingerprint string")
    want = brute(texts, ids)

    def got():
        return sorted((r.doc_id is None, r.doc_id or 0, r.fingerprint, r.component_id) for r in near_duplicates(rows).collect())

    assert got() == want
    assert len({w[3] for w in want}) < len(texts) - 20
    assert near_duplicates(rows.limit(0)).count() == 0


def test_large_keys_are_compared_by_blocks(spark):
    rng = random.Random(2)
    base = rng.getrandbits(64)
    fps = set()
    while len(fps) < 200:
        x = base
        for k in rng.sample(range(64), 3):
            x ^= 1 << k
        fps.add(x)
    m, r = simhash.contract(*stars(np.array(sorted(fps), np.uint64))[:2])
    frame = spark.createDataFrame([(int(np.uint64(x).astype(np.int64)),) for x in fps], "fp long")
    labels = simhash.components(simhash.links(frame, most=7))
    want = {}
    for a, b in zip(m.tolist(), r.tolist(), strict=True):
        want.setdefault(b, {b}).add(a)
    got = {}
    for row in labels.collect():
        got.setdefault(row.root, set()).add(int(np.int64(row.node).astype(np.uint64)))
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))
