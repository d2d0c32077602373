import itertools
import random
import zlib

import numpy as np

from recsense.llm.toxicity import Settings, cross_validated, fit, fit_toxicity, marginals, score_toxicity, telling_stems


def test_marginals_equal_all_paths():
    rng = np.random.default_rng(1)
    lengths = np.array([6, 4, 1])
    cells = np.zeros((6, 3))
    for j, n in enumerate(lengths):
        cells[:n, j] = rng.normal(size=n)
    step, start = np.exp(rng.normal(size=(2, 2))), 0.7
    got = marginals(cells, lengths, step, start)[0]
    for j, n in enumerate(lengths):
        total, ones = 0.0, np.zeros(n)
        for path in itertools.product((0, 1), repeat=int(n)):
            w = (start if path[0] else 1.0) * np.exp(sum(cells[t, j] for t in range(n) if path[t]))
            for a, b in itertools.pairwise(path):
                w *= step[a, b]
            total += w
            ones += w * np.array(path)
        assert np.allclose(got[:n, j], ones / total)


def test_held_out_accuracy_and_spans(spark):
    rng = random.Random(3)
    plain = ["alpha", "beta", "gamma", "delta", "omega", "sigma", "kappa", "theta"]
    rows, labels = [], []
    for k in range(600):
        words = [rng.choice(plain) + rng.choice(["", "s", ","]) for _ in range(30)]
        bad = k % 4 == 0
        if bad:
            for _ in range(3):
                words[rng.randrange(30)] = rng.choice(["grotty", "vilest", "VILEST!"])
        rows.append((k, " ".join(words), "x"))
        labels.append((k, int(bad)))
    rows += [(1000, None, "x"), (1001, "", "x"), (1002, "alpha " * 30000, "x"), (None, "grotty vilest", "x"), (1, rows[1][1], "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    marks = spark.createDataFrame([*labels, (5, None), (None, 1)], "doc_id long, toxic int")
    field = fit_toxicity(docs, marks)
    got = score_toxicity(docs, field, spans=True).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    held = [k for k, _ in labels if zlib.crc32(str(k).encode()) % 5 == 0]
    assert all(by[k].held_out for k in held) and not by[None].held_out
    assert np.mean([by[k].predicted == dict(labels)[k] for k in held]) > 0.97
    assert by[1000].predicted == by[1001].predicted == by[1002].predicted == 0 and by[None].predicted == 1
    assert all(0 <= r.score <= 1 for r in got)
    for r in by[None].spans:
        assert "grotty vilest"[r.start : r.end] == "grotty vilest"
    assert score_toxicity(docs.limit(0), field).count() == 0
    assert fit_toxicity(docs, marks.limit(0)) is None
    assert score_toxicity(docs, None).filter("score != 0").count() == 0


def labelled(n):
    rng = random.Random(8)
    plain = ["alpha", "beta", "gamma", "delta", "omega", "sigma", "kappa", "theta"]
    texts, toxic = [], []
    for k in range(n):
        words = [rng.choice(plain) for _ in range(20)]
        if k % 3 == 0:
            words[rng.randrange(20)] = rng.choice(["grotty", "vilest"])
        texts.append(" ".join(words))
        toxic.append(int(k % 3 == 0))
    return texts, toxic


def test_chain_weights_are_a_stationary_point():
    """After fitting, the chain's expected counts of the labelled tokens are close to the observed ones."""
    texts, toxic = labelled(240)
    field = fit(texts, toxic)
    found = field.probabilities([np.array([field.emission(w) for w in t.split()]) for t in texts])
    bad = [[w in ("grotty", "vilest") for w in t.split()] for t in texts]
    expected, observed = sum(p.sum() for p in found), sum(map(sum, bad))
    assert abs(expected - observed) < 0.1 * observed
    on = np.concatenate(found)[np.concatenate(bad)]
    assert on.min() > 0.8
    # document scores follow the logistic of the marginals' summary
    score = field.scores(found)
    assert all((s >= 0.5) == bool(y) for s, y in zip(score, toxic, strict=True))


def test_evidence_sees_whole_documents():
    """Documents alike in their first words are still different documents."""
    head = ["same"] * 60
    words = [[*head, f"x{k}", "grotty", f"y{k}"] for k in range(40)] + [[*head, f"z{k}"] for k in range(40)]
    found = telling_stems(words, [1] * 40 + [0] * 40, Settings(ratio=4.0))
    assert "=grotty" in found and "=same" not in found


def test_cross_validation_prefers_settings_that_learn():
    texts, toxic = labelled(160)
    folds = [k % 4 + 1 for k in range(160)]
    assert cross_validated(texts, toxic, folds, Settings()) < 0.2 < cross_validated(texts, toxic, folds, Settings(ratio=1e9))
