import random
import re

from recsense.llm.licenses import PHRASES, TEMPLATES, license_scan

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(text, templates=TEMPLATES, threshold=0.8, block=64, step=32):
    words = WORD.findall((text or "").translate(LOWER))
    at = {p: [k for k in range(len(words)) if words[k : k + len(p.split())] == p.split()] for p in PHRASES}
    base = {PHRASES[p] for p, k in at.items() if k}
    joined, best = set(), 0.0
    for k in range(0, max(len(words) - 1 - (block - step), 0) + 1, step):
        for label, notice in templates:
            notice = set(notice.split())
            share = len(notice & set(words[k : k + block])) / len(notice)
            if share >= threshold:
                joined.add(label)
                best = max(best, share)
    every = sorted(k for v in at.values() for k in v)
    return len(words), len(every), every[0] if every else None, every[-1] if every else None, ",".join(sorted(base)), ",".join(sorted(base | joined)), 1.0 if every else best


def test_scan_equals_brute_force(spark):
    rng = random.Random(6)
    filler = ["the", "of", "license", "software", "and", "éa", "x1", "version", "this", "is", "work"]
    texts = [None, "", " \n", "Released under the MIT License.", "CC BY-NC 4.0", "cc by nc cc-by-nc", "Éunder the mit license", "under the mit licenseé", "the" * 200_000, "under the mit license " * 3000]
    for _ in range(300):
        words = [rng.choice(filler) for _ in range(rng.choice([0, 5, 40, 200]))]
        for _ in range(rng.randint(0, 2)):
            notice = rng.choice(TEMPLATES)[1].split()
            kept = [w for w in notice if rng.random() > rng.choice([0, 0.15, 0.3])]
            rng.random() < 0.3 and rng.shuffle(kept)
            k = rng.randint(0, len(words))
            words[k:k] = [w.upper() if rng.random() < 0.2 else w for w in kept]
        texts.append(rng.choice([" ", "\n", ", "]).join(words))
    rows = [(k, t, 1, "x") for k, t in enumerate(texts)] + [(None, "under the mit license", 1, "x"), (3, texts[3], 1, "x"), (3, texts[3], 1, "x")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, row int, words string")
    want = sorted(((i, *brute(t)) for i, t, *_ in rows), key=repr)
    assert sorted(map(tuple, license_scan(frame).collect()), key=repr) == want
    assert sum(w[6] not in ("", w[5]) for w in want) > 50
    assert license_scan(frame.limit(0)).count() == 0


def test_join_keeps_every_block_over_any_threshold(spark):
    rng = random.Random(8)
    templates = [("a", "p q r s t u v w"), ("b", "p q x y"), ("c", "z")]
    texts = [" ".join(rng.choice("pqrstuvwxyzabc") for _ in range(rng.randint(0, 60))) for _ in range(200)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for threshold in (0.3, 0.75, 1.0):
        got = {r.doc_id: (r.labels, r.score) for r in license_scan(frame, templates=templates, threshold=threshold, block=12, step=6).collect()}
        assert got == {k: brute(t, templates, threshold, 12, 6)[5:] for k, t in enumerate(texts)}
