import random
import re

import corpus_pipeline
from recsense.llm.mixing import mix
from recsense.llm.simhash import near_copies
from recsense.llm.tokens import encode

SPACE = re.compile(r"[\x20\x09-\x0D]")
NAMES = "doc_id long, text string, lang string, source string, n_chars long"


def corpus():
    en = "the cat and the dog were in the house with them number {} when rain fell on {} of the old roofs by day {}"
    de = "der hund und die katze waren mit ihnen im haus nummer {} als regen auf {} der alten daecher fiel am tag {}"
    rows = []
    for k in range(150):
        lang, text = ("en", en) if k % 3 else ("de", de)
        rows.append((k, text.format(k * 7919 % 1000, k * 104729 % 977, k * 31 % 89), lang, f"s{k % 4}"))
    rows += [(500, rows[3][1], "de", "s1"), (501, rows[4][1].replace(" ", "  "), "en", None), (502, "123 456", "en", "s0"), (503, None, None, None), (504, "", "en", "s0"), (505, "漢字" * 40, None, "s2"), (10, rows[10][1], "en", "s2"), (None, rows[11][1] + " indeed it was so", "en", "s1")]
    return [(*r, len(r[1] or "")) for r in rows]


def test_each_stage_against_brute_force(spark):
    docs = spark.createDataFrame(corpus(), NAMES)
    stages = dict(corpus_pipeline.STAGES)

    def step(name, frame):
        out = stages[name](spark, frame, "")
        rows = out.collect()
        if name != "packing":
            assert out.columns == docs.columns
        return rows, spark.createDataFrame(rows, out.schema)

    rows, one = step("language ID", docs)
    assert {r.doc_id for r in docs.collect()} - {r.doc_id for r in rows} == {502, 503, 504, 505}
    rows, two = step("exact dedup", one)
    groups = {}
    for r in one.collect():
        groups.setdefault(SPACE.sub("", r.text), []).append((-len(r.text), r.doc_id if r.doc_id is not None else 1 << 63))
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(min(g)[1] if min(g)[1] < 1 << 63 else None) for g in groups.values())
    rows, three = step("SimHash near-dedup", two)
    of = near_copies(two).collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted({str(r.component_id) for r in of})
    rows, four = step("mixing sources", three)
    copies = {r.doc_id: r.copies for r in mix(three).collect()}
    counted = {}
    for r in rows:
        counted[r.doc_id] = counted.get(r.doc_id, 0) + 1
    assert counted == {k: n for k, n in copies.items() if n}
    pieces, _ = step("packing", four)
    assert sum(p.length for p in pieces) == sum(len(encode(r.text)) + 1 for r in rows)


def test_near_copies_go_and_others_stay(spark):
    """Of a long text and its copies with two words changed the smallest id stays, and so do texts that share only a passage."""
    rng = random.Random(4)
    vocabulary = [f"w{k}" for k in range(3000)]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    rows, stay = [], set()
    for k in range(40):
        words = [rng.choice(vocabulary) for _ in range(150)] + passage + [rng.choice(vocabulary) for _ in range(150)]
        rows.append((k * 10, " ".join(words), "en", "s0", 0))
        stay.add(k * 10)
        for j in range(1, k % 3 + 1):
            copy = list(words)
            for at in rng.sample(range(len(copy)), 2):
                copy[at] = rng.choice(vocabulary)
            rows.append((k * 10 + j, " ".join(copy), "en", "s1", 0))
    got = {r.doc_id for r in corpus_pipeline.drop_near_copies(spark, spark.createDataFrame(rows, NAMES), "").collect()}
    assert stay <= got
    assert len(got - stay) <= 0.1 * (len(rows) - len(stay))  # copies no key of which meets


def test_empty_and_run(spark, tmp_path):
    empty = spark.createDataFrame([], NAMES)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, "").count() == 0
    spark.createDataFrame(corpus()[:40], NAMES).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0


def test_clashing_columns_repeats_and_long_texts(spark):
    """Further columns named like the stages' own ones pass through; repeated rows and a long text change nothing else."""
    rows = corpus()[:60]
    rows += [rows[5], rows[5], (900, "the cat and the dog " * 40_000, "en", "s1", 800_000)]
    extra = ["score", "lang_pred", "bits_per_byte", "__text", "__id", "__sha256", "copies", "row", "kept", "component_id", "c0", "fp"]
    docs = spark.createDataFrame([(*r, *[f"{r[0]}-{k}" for k in range(len(extra))]) for r in rows], NAMES + "".join(f", `{c}` string" for c in extra))
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, "")
        if name == "packing":
            assert sum(r.length for r in out.collect()) == sum(len(encode(r.text)) + 1 for r in docs.collect())
            break
        assert out.columns == docs.columns
        got = out.collect()
        assert got and all(r[c] == f"{r.doc_id}-{k}" for r in got for k, c in enumerate(extra))
        assert name == "mixing sources" or 900 in {r.doc_id for r in got}
        if name == "exact dedup":
            assert [r.doc_id for r in got].count(rows[5][0]) == 1
        docs = spark.createDataFrame(got, out.schema)
