import hashlib
import itertools
import random
import re
import zlib

from recsense.llm import repair as R
from recsense.llm.queries import repaired

WHITE = " \t\n\x0b\x0c\r"
NEXT = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}
NAME = {"u": "user", "a": "assistant"}


def damage(rows):
    for c, t, r, x in rows:
        r, x = (" " if v is None else v for v in (r, x))
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if k:
            x = "" if k == 1 else re.sub("[.!?]", "", x) if k == 2 else x
            yield from [(c, t, "user" if k == 4 else r, x)] * (2 if k == 3 else 1)


def cheapest(rows):
    """One pass with whole edit strings and texts in the four states."""
    now = {0: (0, "", [])}
    for role, text, fault in rows:
        new = {}
        for q, (c, s, o) in now.items():
            for _ in range(3):
                late = 5 if fault == "truncated" else 0
                ways = [(q, c + 2, s + "D", o)]
                if fault in (None, "truncated"):
                    ways += [(NEXT[role[:1], q], c + late, s + "K", [*o, f"{role}:{text}"])] if (role[:1], q) in NEXT else []
                    ways += [(NEXT[x, q], c + late + 1, s + "R", [*o, f"{NAME[x]}:{text}"]) for x in "ua" if (x, q) in NEXT]
                for z, *v in ways:
                    new[z] = min(new.get(z, v), v, key=lambda v: v[:2])
                x = "a" if q == 2 else "u"
                q, c, s, o = NEXT[x, q], c + 5, s + "I", [*o, NAME[x] + ":"]
        now = new
    ends = {0: [], 3: [], 2: ["assistant:"], 1: ["user:", "assistant:"]}
    return min(((c + 5 * len(ends[q]), s + "I" * len(ends[q]), [*o, *ends[q]]) for q, (c, s, o) in now.items()), key=lambda v: v[:2])


def brute(rows):
    convs = {r[0]: [] for r in rows}
    for r in damage(rows):
        convs[r[0]].append(r)
    for c, found in convs.items():
        found.sort(key=lambda r: ((r[1] is not None, r[1] or 0), r[2], r[3]))
        turns = [r[1] for r in found if r[1] is not None]
        seen, marked = set(), []
        for _, _, r, x in found:
            rest = x.strip(WHITE)
            marked.append((r, x, "blank" if not rest else "duplicate" if (r, x) in seen else "truncated" if rest[-1] not in ".!?" else None))
            seen.add((r, x))
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(marked))
        cost, audit, said = cheapest(marked)
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        yield c, gaps, *(sum(m[2] == f for m in marked) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(said).encode()).hexdigest()


def test_repair_equals_one_pass_over_whole_strings(spark):
    rng = random.Random(5)
    rows = [(None, 1, "user", "Of nobody."), (None, 2, "assistant", "Nor"), (900, None, None, None), (901, 3, "user", "x." * 60_000), (901, 3, "user", "x." * 60_000)]
    for c in range(300):
        for t in range(rng.choice([1, 2, 3, 9, 40])):
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None])
            rows.append((c, rng.choice([None, t, t, t, rng.randint(0, 5)]), role, rng.choice(["Hi.", "no end", "", " \n", "x!  ", "é", None, "same.", f"u{rng.random()}."])))
    frame = spark.createDataFrame([(*r, "c", 1) for r in rows], "conv_id long, turn long, role string, text string, codes string, place int")
    want = sorted(brute(rows), key=repr)
    for sizes in ({}, {"block": 4, "fan": 3}):
        assert sorted(map(tuple, repaired(frame, **sizes).collect()), key=repr) == want
    assert repaired(frame.limit(0)).count() == 0


def test_divide_and_conquer_on_all_short_sequences():
    """Every sequence of up to four turns of all kinds: the least edits of the cheapest, among all ways."""
    codes = sorted(R.STEPS)
    for n in range(1, 4):
        for word in itertools.product(codes if n < 3 else codes[::2] + codes[1:2], repeat=n):
            every = {(0, 0, "")}
            for code in word:
                every = {(after, cost + price, edits + more) for at, cost, edits in every for start, after, price, more, _ in R.STEPS[code] if start == at}
            for end in {e[0] for e in every}:
                cost, edits = min(e[1:] for e in every if e[0] == end)
                assert R.forward("".join(word), 0)[0][end] == cost == R.backward("".join(word), end)[0]
                assert R.moves_between("".join(word), 0, end)[0] == edits


def test_repaired_turns_alternate(spark):
    rng = random.Random(9)
    rows = [(c, t, rng.choice(["system", "user", "assistant", "tool"]), rng.choice(["One.", "two", "Three?", f"n{c}-{t}."])) for c in range(60) for t in range(rng.randint(1, 12))]
    _, turns = R.repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), 4, 2)
    convs = {}
    for r in turns.orderBy("conv_id", "place").collect():
        convs.setdefault(r.conv_id, []).append(r.role[0])
    assert convs and all(re.fullmatch("(s?(ua)+)?", "".join(v)) for v in convs.values())
