import hashlib
import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_repeats import brute_words

from recsense.llm import repeats
from recsense.llm.phrase_dedup import FingerprintIndex, repeated_phrases, word_codes
from recsense.llm.repeats import COMPARE, Shape, classify, keyed, stretches


def alike(seed, n=40):
    """Texts of five different words, which share many grams, and longer stretches now and then."""
    rng = random.Random(seed)
    texts = [" ".join(rng.choice("abcde") for _ in range(rng.randint(0, 60))) for _ in range(n)]
    for _ in range(n // 2):
        words, other = rng.choice(texts).split(), rng.choice(texts).split()
        at, to = rng.randrange(len(words) + 1), rng.randrange(len(other) + 1)
        texts.append(" ".join(other[:to] + words[at : at + rng.randint(8, 25)] + other[to:]))
    return texts


@pytest.mark.parametrize("shape", [Shape(13, 3, 11), Shape(5, 3, 3), Shape(4, 2, 1), Shape(6, 1, 2)])
def test_blocks_with_a_window_in_common_agree_on_a_side(shape):
    texts = alike(shape.window)
    _, _, found, _ = next(stretches(texts, word_codes, shape))
    sides = found.sides(shape)
    block, _, one, _ = found.windows(np.arange(len(found.first)), shape)
    holders = {}
    for b, h in zip(block.tolist(), one.tolist(), strict=True):
        holders.setdefault(h, set()).add(b)
    met = {(a, b) for s in holders.values() for a in s for b in s if a < b}
    assert len(met) > 20
    for a, b in met:
        x, y = int(sides[a]), int(sides[b])
        assert found.common[a] == found.common[b]
        assert (x >> 32 == y >> 32 != 0) or (x & 0xFFFFFFFF == y & 0xFFFFFFFF != 0)


def test_only_blocks_that_agree_on_a_side_are_compared():
    common, whole, doc = np.array([1, 1, 1, 1, 2, 2]), np.array([5, 6, 7, 7, 5, 6]), np.arange(6)
    sides = np.array([3 << 32 | 1, 4 << 32 | 1, 5 << 32, 5 << 32, 3 << 32, 0])
    got = classify(common, whole, doc, np.ones(6, int), False, sides)
    assert (got & COMPARE > 0).tolist() == [True, True, False, False, False, False]


def test_a_shared_gram_is_no_reason_to_compare(spark, tmp_path):
    """Texts that share three words here and there name nothing; a passage in two of them names its edges."""
    own = [" ".join(f"alpha beta gamma u{k}x{j} v{k}x{j} w{k}x{j}" for j in range(30)) for k in range(8)]
    index = FingerprintIndex(spark, f"{tmp_path}/index", Shape(13, 3, 11))
    rows = spark.createDataFrame(list(enumerate(own)), "doc_id long, text string")
    assert index.add(keyed(rows.filter("doc_id < 4"), "text", "doc_id")).count() == 0
    assert index.add(keyed(rows.filter("doc_id >= 4"), "text", "doc_id")).count() == 0
    passage = " ".join(own[2].split()[31:60])
    later = spark.createDataFrame([(9, f"n1 n2 {passage} n3 n4")], "doc long, text string")
    said = index.add(later).select("doc", F.col("kind").bitwiseAND(COMPARE).alias("kind")).distinct().collect()
    assert {(2, COMPARE), (9, COMPARE)} <= {tuple(r) for r in said} <= {(2, COMPARE), (9, COMPARE), (9, 0)}


@pytest.mark.parametrize("sample", [1, 32])
def test_few_words_equal_brute_force(spark, monkeypatch, sample):
    """Most grams are shared; with each block in the sample, the grams are too frequent for one range as well."""
    monkeypatch.setattr(repeats, "SAMPLE", sample)
    texts = alike(5, 60)
    want = brute_words(list(enumerate(texts)), 13)
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = [(r.n_words, sum(s.end - s.start for s in r.spans), hashlib.sha256(r.kept.encode()).hexdigest()) for r in repeated_phrases(rows).orderBy("doc_id").collect()]
    assert got == want
    assert sum(w[1] for w in want) > 50


def test_index_of_other_columns_is_refused(spark, tmp_path):
    (tmp_path / "manifest-000000001").write_text(json.dumps({"buckets": 4, "heavy": [], "runs": []}))
    with pytest.raises(ValueError, match="other columns"):
        FingerprintIndex(spark, str(tmp_path), Shape(13, 3, 11))


def test_windows_are_made_once(spark):
    """The texts go through Python for their edges and for the cut, each once."""
    rows = spark.createDataFrame([(k, " ".join(f"w{j % (5 + k)}" for j in range(40))) for k in range(6)], "doc_id long, text string")
    plan = repeated_phrases(rows)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 2
