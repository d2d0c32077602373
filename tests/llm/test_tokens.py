import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from recsense.llm.packing import LENGTH, Cheapest, pack, place
from recsense.llm.tokens import Prefixes, encode, token_counts

LIBRARY = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
TEXTS = ["", None, "Hello, world", "a   b\n\n c \t", "it's we'll x's", "  lead", "trail   ", "x<|endoftext|> y<|endoftext|>", "ñ ü é 漢字 😀😀    x", "12345 67,89", "\n\nE", "a" * 3000, "idiot\x00z", "word " * 5000]


def library_ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def test_ids_and_totals_equal_the_library(spark):
    rows = spark.createDataFrame([(k, t, "z") for k, t in enumerate(TEXTS)] + [(None, "x", "z")], "doc_id long, text string, n_tokens string")
    got = {r.doc_id: r for r in token_counts(rows).collect()}
    for k, text in enumerate(TEXTS):
        want = library_ids(text)
        assert encode(text or "") == want
        assert (got[k].n_tokens, got[k].n_bytes, got[k].over_limit) == (len(want), len((text or "").encode()), len(want) > 1024)
    assert got[None].n_tokens == 1
    assert token_counts(rows.limit(0)).count() == 0
    table = token_counts(rows.filter("doc_id = 3"), prefixes=True).first()
    assert table.piece_tokens[-1] == table.n_tokens and table.piece_ends[-1] == len(TEXTS[3])


def test_every_prefix_is_exact():
    rng = random.Random(5)
    for _ in range(60):
        text = "".join(rng.choice(["a", "the", " ", "  ", "\n", "'s", "'", "9", ".", "é", "\t", "<|endoftext|>", "<|end"]) for _ in range(25))
        found = Prefixes(text)
        assert [found.at(i) for i in range(len(text) + 1)] == [len(library_ids(text[:i])) for i in range(len(text) + 1)]
        for budget in (0, 3, 7, 1000):
            cut = found.truncate(budget)
            assert len(library_ids(text[:cut])) <= budget or cut == 0


def test_place_fills_sequences():
    rng = random.Random(1)
    for n in (0, 1, 5, 300):
        lengths = [rng.choice([1, 3, 700, 2047, 2048, 2049, 9000]) for _ in range(n)]
        rows = place(lengths)
        seen = {}
        for d, start, length, _, _ in rows:
            seen.setdefault(d, []).append((start, length))
        for d, n_tokens in enumerate(lengths):
            at = 0
            for start, length in sorted(seen[d]):
                assert start == at
                at += length
            assert at == n_tokens
        fill = {}
        for _, _, length, s, offset in rows:
            fill.setdefault(s, []).append((offset, length))
        for parts in fill.values():
            at = 0
            for offset, length in sorted(parts):
                assert offset == at
                at += length
            assert at == LENGTH or at & (at - 1) == 0


def test_cheapest_with_room():
    rng = random.Random(7)
    found, free = Cheapest(64, 5), {s: (0.0, 64) for s in range(5)}
    while free:
        n = rng.randint(1, 64)
        want = min(((c, s) for s, (c, room) in free.items() if room >= n), default=None)
        assert found.take(n) == want
        if want is None:
            want, n = found.take(1), 1
        cost, s = want
        room = free.pop(s)[1] - rng.randint(n, min(free.get(s, (0, 64))[1], n + 3))
        if room > 0:
            free[s] = (cost + rng.randint(1, 3), room)
            found.put(room, *[free[s][0], s])


def test_pack_round_trip(spark):
    rows = spark.createDataFrame([(k, t, 1) for k, t in enumerate(TEXTS)] + [(None, "x y", 1), (2, TEXTS[2], 1)], "doc_id long, text string, length int")
    got = pack(rows, round_tokens=3000).collect()
    for k, text in enumerate(TEXTS):
        ids = np.array([*library_ids(text), 1], "<u4")
        for r in got:
            if r.doc_id == k:
                assert r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
        assert sum(r.length for r in got if r.doc_id == k) == len(ids) * (2 if k == 2 else 1)
    assert pack(rows.limit(0)).count() == 0
