import hashlib
import math
import random
import zlib

from recsense.llm.prefix_trie import prefix_trie


def brute(rows):
    convs = {}
    for c, t, r, x in rows:
        if c is not None:
            convs.setdefault(c, []).append(((t is not None, t or 0), r or "", x or ""))
    for v in convs.values():
        v.sort()
    rebuilt = {}
    for c, v in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = convs.get(c - int(math.fmod(c, 5)), [])
        rebuilt[c] = tuple(x[1:] for x in base[:h] + v[h:])
    nodes, kids = {}, {}
    for c, s in rebuilt.items():
        for d in range(len(s) + 1):
            nodes.setdefault(s[:d], []).append(c)
    for n in nodes:
        if n:
            kids.setdefault(n[:-1], []).append(n)
    totals, out = {}, []
    for n in sorted(nodes, key=len, reverse=True):
        below = kids.get(n, [])
        own = (len(nodes[n]) - 1) * (len(n[-1][1].encode()) if n else 0)
        totals[n] = (sum(totals[k][0] for k in below) or 1, own + sum(totals[k][1] for k in below))
        ends = sorted(c for c in nodes[n] if len(rebuilt[c]) == len(n))
        out.append((min(nodes[n]), len(n), min(nodes[n[:-1]]) if n else None, len(nodes[n]), len(below), *totals[n], hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=repr)


def made(spark, rows):
    return spark.createDataFrame([(*r, 1, 2) for r in rows], "conv_id long, turn long, role string, text string, depth int, at int")


def test_trie_equals_brute_force(spark):
    rng = random.Random(4)
    rows = []
    for c in [*range(-12, 90), 5_000_000_003, (1 << 63) - 1, -(1 << 63)]:
        for t in range(rng.choice([1, 2, 3, 5, 9, 12])):
            rows.append((c, rng.choice([t, t, t, None, 1]), rng.choice(["user", "assistant", None]), rng.choice(["a", "b", "é", "", None])))
    rows += [(200, t, "user", "long" * (t % 3)) for t in range(150)] + [(201, t, "user", "long" * (t % 3)) for t in range(90)]
    rows += [(None, 1, "user", "lost"), (3, 1, "user", "x" * 100_000)] + [(7, 2, "user", "again")] * 3
    want = brute(rows)
    for sizes in ({}, {"band": 3, "block": 4}):
        assert sorted(map(tuple, prefix_trie(made(spark, rows), **sizes).collect()), key=repr) == want


def test_groups_of_equal_conversations(spark):
    rows = [(c, t, "user", f"same {t}") for c in range(0, 60_000, 5) for t in range(2)]
    found = prefix_trie(made(spark, rows)).collect()
    assert sorted(map(tuple, found), key=repr) == brute(rows)
    assert max(r.n_convs for r in found) == 12_000


def test_turnless_and_empty(spark):
    heads = [c for c in range(1, 400) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 1][:7]
    rows = [(c, 0, "user", "own") for c in heads]  # their first turns go, and no base is there
    assert sorted(map(tuple, prefix_trie(made(spark, rows)).collect()), key=repr) == brute(rows)
    assert [(r.depth, r.n_convs, r.n_leaves) for r in prefix_trie(made(spark, rows)).collect()] == [(0, len(heads), 1)]
    assert prefix_trie(made(spark, rows).limit(0)).count() == 0
