import functools
import math
import zlib

from recsense.llm.language import LEAST, ORDER, grow, identify


def scalar_bits(samples, lang, text):
    """Prediction by partial matching from plain counts: one byte at a time, one context at a time."""
    known = {b for texts in samples.values() for t in texts for b in t.encode()}
    counts = {name: {} for name in samples}
    for name, texts in samples.items():
        for t in texts:
            padded = [None] * ORDER + list(t.encode())
            for k in range(ORDER, len(padded)):
                for n in range(ORDER + 1):
                    own = counts[name].setdefault(tuple(padded[k - n : k]), {})
                    own[padded[k]] = own.get(padded[k], 0) + 1
    often = {c for own in counts.values() for c, seen in own.items() if sum(seen.values()) >= (LEAST if len(c) > 1 else 1)}
    kept = {c for c in often if all(c[k:] in often for k in range(len(c)))}

    @functools.cache
    def p(context, byte):
        if context is None:
            return 1 / 256
        shorter = context[1:] if context else None
        seen = counts[lang].get(context, {})
        total = sum(seen.values()) + len(seen)
        if not seen:
            return p(shorter, byte)
        if byte in seen:
            return seen[byte] / total
        return len(seen) / total * p(shorter, byte) / sum(p(shorter, b) for b in range(256) if b not in seen)

    padded = [None] * ORDER + [b if b in known else None for b in text]
    bits = 0.0
    for k, byte in enumerate(text, ORDER):
        context = tuple(padded[k - ORDER : k])
        while context not in kept:
            context = context[1:]
        bits -= math.log2(p(context, byte))
    return bits


def test_grow_equals_scalar_ppm():
    samples = {"en": ["the cat sat on the mat", "a cat, the hat", "ee"] * 2, "de": ["die katze saß", "der hut, die matte"] * 3, "fr": [""]}
    trees = grow(samples)
    for text in ("the käse zzz", "die the \x00 hat", "q", "ß" * 5):
        got = trees.code_lengths([text.encode()])[0]
        for lang in ("en", "de"):
            assert math.isclose(got[trees.languages.index(lang)], scalar_bits(samples, lang, text.encode()), rel_tol=1e-4)


def test_tables_are_bounded():
    samples = {f"l{k}": ["".join(chr(97 + (j * (k + 3) + j * j) % 26) for j in range(3000))] for k in range(6)}
    full, small = grow(samples), grow(samples, cells=30_000)
    assert full.bits.size > 30_000 >= small.bits.size
    # contexts of up to a byte stay, and probabilities still sum to one
    p = 2.0 ** -small.bits.astype(float)
    assert abs((p[:, 1:].sum(1) + p[:, 0] * (257 - small.n_symbols)) - 1).max() < 0.02


def test_code_lengths_equal_a_scalar_walk():
    samples = {"en": ["the cat sat on the mat"] * 4, "de": ["die katze saß"] * 4}
    trees = grow(samples)
    text = "the käse zzz".encode()
    got = trees.code_lengths([text, b""])
    assert got[1].tolist() == [0.0, 0.0]
    want = [0.0, 0.0]
    for k in range(len(text)):
        context = 0
        for j in range(ORDER, 0, -1):
            context = context * trees.n_symbols + (int(trees.symbol[text[k - j]]) if k >= j else 0)
        for lang in range(2):
            want[lang] += float(trees.bits[trees.node[context], trees.symbol[text[k]], lang])
    assert all(math.isclose(a, b, rel_tol=1e-6) for a, b in zip(got[0], want, strict=True))
    # every context's symbols and the bytes never seen share probability one
    p = 2.0 ** -trees.bits.astype(float)
    unseen = 256 - (trees.n_symbols - 1)
    assert abs((p[:, 1:].sum(1) + p[:, 0] * unseen) - 1).max() < 0.02


def test_identify(spark):
    rows = [(k, "the cat and the dog were in the house with them" if k % 2 else "der hund und die katze waren mit ihnen im haus", "en" if k % 2 else "de", 7.0) for k in range(60)]
    rows += [(100, None, "en", 1.0), (101, "", "en", 1.0), (102, "123 .,!", None, 1.0), (103, "the dog " * 20000, None, 1.0), (None, "die katze", "de", 1.0), (1, rows[1][1], "en", 7.0)]
    got = identify(spark.createDataFrame(rows, "doc_id long, text string, lang string, score double")).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert all(by[k].lang_pred == ("en" if k % 2 else "de") for k in range(60))
    assert [by[k].lang_pred for k in (100, 101, 102, 103, None)] == ["und", "und", "und", "en", "de"]
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in got)
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert identify(empty).count() == 0
