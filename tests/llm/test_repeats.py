import hashlib
import os
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from recsense.llm import repeats
from recsense.llm.byte_dedup import repeated_bytes
from recsense.llm.phrase_dedup import FingerprintIndex, repeated_phrases
from recsense.llm.repeats import Deal, Shape, keyed, leading, multikey_order


def test_multikey_order():
    rng = np.random.default_rng(1)
    keys = [rng.integers(0, n, 3000) for n in (7, 5, 9)]
    got = np.stack([k[multikey_order(*keys)] for k in keys], 1)
    assert (got == np.array(sorted(zip(*keys, strict=True)))).all()


def brute_bytes(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = {}
    for t in raw:
        for i in range(len(t) - length + 1):
            seen[t[i : i + length]] = seen.get(t[i : i + length], 0) + 1
    out = []
    for t in raw:
        covered = [False] * len(t)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                covered[i : i + length] = [True] * length
        kept = bytes(b for b, c in zip(t, covered, strict=True) if not c)
        spans = sum(c and not (i and covered[i - 1]) for i, c in enumerate(covered))
        out.append((len(t), sum(covered), spans, hashlib.sha256(kept).hexdigest()))
    return out


def brute_words(rows, window):
    first = {}
    words = [(i if i is not None else 1 << 63, (t or "").encode().split()) for i, t in rows]
    for i, w in words:
        for k in range(len(w) - window + 1):
            key = tuple(w[k : k + window])
            first[key] = min(first.get(key, i), i)
    out = []
    for i, w in words:
        covered = [False] * len(w)
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] < i:
                covered[k : k + window] = [True] * window
        kept = b" ".join(x for x, c in zip(w, covered, strict=True) if not c)
        out.append((len(w), sum(covered), hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed):
    rng = random.Random(seed)
    pool = ["w%d" % rng.randrange(400) for _ in range(400)]
    passage = [" ".join(rng.choice(pool) for _ in range(n)) for n in (14, 30, 60, 90)]
    texts = []
    for _ in range(70):
        parts = []
        for _ in range(rng.randint(0, 6)):
            parts.append(rng.choice(passage) if rng.random() < 0.3 else " ".join(rng.choice(pool) for _ in range(rng.randint(1, 60))))
        if rng.random() < 0.3 and parts:
            words = rng.choice(passage).split()
            cut = rng.randrange(len(words))
            parts.append(" ".join(words[cut:] + ["é"] + words[:cut]))
        texts.append(rng.choice([" ", "\n", "\t "]).join(parts))
    texts += [texts[3], texts[5], texts[5], None, "", "und " * 400, "ab" * 900, "x", texts[7] + " more"]
    return texts


@pytest.mark.parametrize("seed", [1, 2])
def test_bytes_equal_brute_force(spark, seed):
    texts = corpus(seed)
    rows = spark.createDataFrame([(k * 7, t, "x", 1) for k, t in enumerate(texts)], "doc_id long, text string, kept string, doc int").repartition(5)
    for length, gram, anchors in ((100, 8, 30), (400, 32, 128)):
        want = brute_bytes(texts, length)
        got = {r.doc_id: r for r in repeated_bytes(rows, length=length, gram=gram, anchors=anchors).collect()}
        assert len(got) == len(texts)
        for k, w in enumerate(want):
            r = got[k * 7]
            assert (r.n_bytes, sum(s.end - s.start for s in r.spans), len(r.spans), hashlib.sha256(bytes(r.kept)).hexdigest()) == w
    assert repeated_bytes(rows.limit(0)).count() == 0


@pytest.mark.parametrize("batches", [1, 2, 3])
def test_words_equal_brute_force(spark, batches):
    texts = corpus(batches)
    rng = random.Random(batches)
    ids = rng.sample(range(-50, 1000), len(texts))
    ids[9] = None
    ids[11] = ids[12]
    data = list(zip(ids, texts, strict=True))
    rows = spark.createDataFrame([(*d, 1) for d in data], "doc_id long, text string, n_words int").repartition(5)
    want = sorted(((i is None, i or 0, *w) for (i, _), w in zip(data, brute_words(data, 13), strict=True)))
    got = repeated_phrases(rows, batches=batches).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_words, sum(s.end - s.start for s in r.spans), hashlib.sha256(r.kept.encode()).hexdigest()) for r in got) == want
    assert sum(w[3] for w in want) > 500
    assert repeated_phrases(rows.limit(0)).count() == 0


def test_leading_bytes_sort_as_bytes():
    rng = np.random.default_rng(2)
    text = rng.integers(0, 256, 400).astype(np.uint8).tobytes()
    at = np.arange(392)
    got = leading(text, at)
    assert (np.argsort(got, kind="stable") == sorted(at, key=lambda k: (text[k : k + 8], k))).all()


def test_deal_spreads_heavy_rows_only():
    split = np.array([5, 9, 9, 9, 20])
    first, common, salt = np.full(3000, 9), np.repeat([1, 2, 3], 1000), np.arange(3000)
    got = Deal(split, np.array([2])).place(first, common, salt)
    assert got.min() >= 1 and got.max() <= 4
    assert len(set(got[common == 2])) == 4 and len(set(got[common == 1])) == len(set(got[common == 3])) == 1
    assert Deal(split, np.array([2])).place(np.array([4, 6, 21]), np.array([2, 2, 2]), np.arange(3)).tolist()[::2] == [0, 5]


@pytest.mark.parametrize("by", ["bytes", "words"])
def test_hot_rows(spark, monkeypatch, by):
    """One passage in a third of the rows: most blocks are heavy, and all goes through the comparison over boundaries."""
    monkeypatch.setattr(repeats, "SAMPLE", 1)
    rng = random.Random(3)
    passage = " ".join("p%d" % rng.randrange(90) for _ in range(120))
    texts = [passage if k % 3 == 0 else " ".join("q%d" % rng.randrange(300) for _ in range(90)) + (" " + passage[: 9 * k] if k % 3 == 1 else "") for k in range(90)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    if by == "bytes":
        want = brute_bytes(texts, 400)
        got = [(r.n_bytes, sum(s.end - s.start for s in r.spans), len(r.spans), hashlib.sha256(bytes(r.kept)).hexdigest()) for r in repeated_bytes(rows).orderBy("doc_id").collect()]
    else:
        want = brute_words(list(enumerate(texts)), 13)
        got = [(r.n_words, sum(s.end - s.start for s in r.spans), hashlib.sha256(r.kept.encode()).hexdigest()) for r in repeated_phrases(rows).orderBy("doc_id").collect()]
    assert got == want


def test_two_sessions_equal_one(spark, tmp_path):
    """The index is opened again by its folder; earlier documents count, and runs are compacted by level."""
    texts = corpus(4)
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    path, cuts, got = f"{tmp_path}/index", [0, 20, 40, 60, 1000], []
    for low, high in zip(cuts, cuts[1:], strict=False):
        now, before = rows.filter(f"doc_id >= {low} and doc_id < {high}"), rows.filter(f"doc_id < {low}")
        got += repeated_phrases(now, index=path, history=before, batches=1 if low else 2).collect()
    want = brute_words(list(enumerate(texts)), 13)
    assert [(r.n_words, sum(s.end - s.start for s in r.spans), hashlib.sha256(r.kept.encode()).hexdigest()) for r in sorted(got)] == want
    # five batches with a fan of two: 4 + 1
    left = [n for n in os.listdir(path) if n.startswith("run-")]
    assert len(left) == 2
    blocks = spark.read.parquet(*[f"{path}/{n}" for n in left])
    assert blocks.count() == blocks.select("common", "whole").distinct().count() > 100


def test_history_is_joined_where_it_lies(spark, tmp_path, monkeypatch):
    """A batch is merge-joined with the buckets of all runs, also where a fingerprint is spread, without a shuffle of the history."""
    monkeypatch.setattr(repeats, "SAMPLE", 1)
    rng = random.Random(7)
    common = "alpha beta gamma"
    texts = [" ".join(f"{common} {rng.randrange(9)}{k} w{rng.randrange(400)} v{rng.randrange(400)} u{k}" for _ in range(20)) for k in range(60)]
    texts[50:] = [texts[k][: 150 + k] for k in range(10)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    path, shape = f"{tmp_path}/it's an index", Shape(13, 3, 11)
    index = FingerprintIndex(spark, path, shape, fan=9, buckets=6)
    for low in (0, 20, 40):
        index.add(keyed(rows.filter(f"doc_id >= {low} and doc_id < {low + 20}"), "text", "doc_id"))
    index = FingerprintIndex(spark, path, shape, buckets=77)
    assert index.buckets == 6 and len(index.runs) == 3 and index.heavy
    history = index.read()
    assert {r.slot for r in history.filter(F.col("common").isin(index.heavy)).select("slot").distinct().collect()} > {0} or history.filter("slot > 0").count()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        keys = {r.common for r in history.filter("doc % 7 = 3").collect()}
        met = index.meeting(spark.createDataFrame([(k,) for k in sorted(keys)], "common long"))
        plan = met._jdf.queryExecution().executedPlan().toString()
        scans = re.findall(r"FileScan parquet [^\[]*\[(common#\d+)", plan)
        moved = re.findall(r"Exchange hashpartitioning\((common#\d+)", plan)
        assert len(scans) == plan.count("Bucketed: true") == 3
        assert moved and not set(scans) & set(moved) and len(moved) == plan.count("Exchange")
        got = sorted((r.common, r.whole, r.doc) for r in met.collect())
        assert got == sorted((r.common, r.whole, r.doc) for r in history.collect() if r.common in keys)
        assert "Exchange" not in index.merged(index.runs)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    want = brute_words(list(enumerate(texts)), 13)
    got = [(r.n_words, sum(s.end - s.start for s in r.spans), hashlib.sha256(r.kept.encode()).hexdigest()) for r in repeated_phrases(rows, batches=4).orderBy("doc_id").collect()]
    assert got == want


def test_index_of_nothing(spark, tmp_path):
    """Empty batches and null texts add empty runs, and the index goes on."""
    index = FingerprintIndex(spark, f"{tmp_path}/index", Shape(13, 3, 11))
    none = spark.createDataFrame([], "doc long, text string")
    assert index.add(none).count() == 0
    assert index.add(spark.createDataFrame([(1, None), (2, "")], "doc long, text string")).count() == 0
    text = " ".join(f"w{k}" for k in range(40))
    assert index.add(spark.createDataFrame([(3, text)], "doc long, text string")).count() == 0
    assert index.add(spark.createDataFrame([(4, text), (4, text)], "doc long, text string")).filter("kind = 1 and doc = 4").count() > 0
