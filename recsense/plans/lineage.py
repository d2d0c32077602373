"""Queries on stamps, queues and roll-ups."""

from __future__ import annotations

from pyspark.sql import functions as F

from recsense.operators import evaluate, lineage as op, timebase

from .census import TRIALS, trials
from .evaluate import CURVE, G, T5
from .registry import query
from .sources import raw_logs
from .timebase import FILES, USABLE, files, segments, usable
from .trust import SAG, SERVE, record, served
from .verdict import COH, FILE, audited, decided, stats
from .views import SEG, kept, score, table


@query("input_stamps", "SELECT source AS stage, CAST(doc_id AS VARCHAR) AS label, CASE WHEN doc_id % 9 <> 0 THEN sha256(text) END AS sha256, CASE WHEN doc_id % 9 <> 0 THEN CAST(strlen(text) AS BIGINT) END AS bytes, doc_id % 9 = 0 AS missing FROM documents")
def input_stamps(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("source", F.col("doc_id").cast("string").alias("name"), F.when(F.col("doc_id") % 9 != 0, F.col("text")).alias("text"))
    return op.input_stamps(d, "source", "name", "text")


@query("file_stamps", "SELECT user_id % 4 AS session, count(*) AS n_rows, true AS same, false AS missing FROM events GROUP BY ALL")
def file_stamps(spark, sf_dir):
    """The logs that the events are written to, a folder a session: stamped, and stamped again from what is known."""
    path = raw_logs(spark, sf_dir)
    first = op.stamp_files(spark, [("clean", "logs", path), ("train", "logs", path), ("train", "model", f"{path}-none")])
    first = kept(first, "stamps")
    again = op.stamp_files(spark, [("clean", "logs", path)], first).select("path", F.col("sha256").alias("again"))
    lines = spark.read.text(path, recursiveFileLookup=True).filter("value not like '01_%'").groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count("*").alias("n_rows"))
    session = F.regexp_extract("path", "session=([0-9]+)", 1).cast("long")
    found = first.filter("stage = 'train' and label = 'logs'").join(again, "path").join(lines, "path")
    return found.groupBy(session.alias("session")).agg(F.sum("n_rows").alias("n_rows"), F.min(F.col("sha256") == F.col("again")).alias("same"), F.max("missing").alias("missing"))


@query("stale_inputs", """SELECT source AS stage, CAST(doc_id AS VARCHAR) AS label, CASE WHEN doc_id % 12 = 0 THEN 'unstamped' WHEN doc_id % 12 = 1 THEN 'appeared' WHEN doc_id % 12 IN (2, 3) THEN 'deleted' ELSE 'changed' END AS complaint FROM documents WHERE doc_id % 12 < 5""")
def stale_inputs(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("source", F.col("doc_id").cast("string").alias("name"), "text", (F.col("doc_id") % 12).alias("k"))
    then = op.input_stamps(d.filter("k <> 0").withColumn("text", F.when(F.col("k") != 1, F.col("text"))), "source", "name", "text")
    now = op.input_stamps(d.filter("k <> 2").withColumn("text", F.when(F.col("k") == 4, F.concat("text", F.lit("."))).when(F.col("k") != 3, F.col("text"))), "source", "name", "text")
    return op.stale_inputs(then, now)


def queue(spark, sf_dir):
    quarantine = timebase.quarantine_ledger(files(spark, sf_dir))
    from recsense.operators import trust

    drift = trust.drift_check(segments(spark, sf_dir), "rec", "segment", "t", "a", 100_000.0, 0.3).filter("verdict <> 'ok'").withColumnRenamed("rec", "file")
    return op.exception_queue(quarantine, record(spark, sf_dir).withColumnRenamed("rec", "file"), drift)


QUEUE = SAG + FILES[len(SEG) :] + """, ledger AS (SELECT file, substr(regexp_replace(regexp_replace(lower(regexp_replace(reason, '[0-9]+', '', 'g')), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g'), 1, 40) AS category FROM refused WHERE reason IS NOT NULL
), ax AS (SELECT file, unnest(string_split(conflicts, ',')) AS axis FROM vf WHERE conflicts IS NOT NULL
), st AS (SELECT rec, segment, t, a, (t - min(t) OVER (PARTITION BY rec, segment)) / 1000.0e0 AS x FROM seg), dr AS (SELECT rec, segment, CASE WHEN count(*) >= 3 THEN abs(corr(a, x)) END AS r, max(x) AS s FROM st GROUP BY ALL
), av AS (SELECT rec, sum(CASE WHEN s >= 100000 AND r IS NOT NULL THEN r * s END) / sum(CASE WHEN s >= 100000 AND r IS NOT NULL THEN s END) AS drift FROM dr GROUP BY rec
), qu AS (SELECT 'quarantine' AS cause, CAST(file AS VARCHAR) AS file, category AS detail FROM ledger UNION ALL SELECT 'axis', CAST(file AS VARCHAR), axis FROM ax
  UNION ALL SELECT 'drift', CAST(rec AS VARCHAR), CASE WHEN drift IS NULL THEN 'inconclusive' ELSE 'flagged' END FROM av WHERE drift IS NULL OR drift >= 0.3
), items AS (SELECT concat(cause, ':', file, ':', detail) AS ref, * FROM qu)"""


@query("exception_queue", f"WITH {QUEUE} SELECT ref, cause, file, detail FROM items")
def exception_queue(spark, sf_dir):
    return queue(spark, sf_dir)


@query("disposition_map", f"""WITH {QUEUE}, d AS (SELECT cause, CASE WHEN length(ref) % 2 = 0 THEN 'drop' WHEN cause = 'axis' THEN 'accept' ELSE 'watch' END AS action, length(ref) % 5 = 0 AS handled FROM items)
SELECT cause, CASE WHEN handled THEN 'closed' WHEN cause = 'quarantine' AND action = 'drop' THEN 'dropped' WHEN cause = 'axis' AND action = 'accept' THEN 'accepted' WHEN cause = 'drift' AND action = 'watch' THEN 'watched' ELSE 'escalated' END AS disposition, count(*) AS n FROM d GROUP BY ALL""")
def disposition_map(spark, sf_dir):
    n = F.length("ref")
    action = F.when(n % 2 == 0, "drop").when(F.col("cause") == "axis", "accept").otherwise("watch")
    q = queue(spark, sf_dir).withColumn("action", action).withColumn("handled", n % 5 == 0)
    return q.groupBy("cause", op.disposition("cause", "action", "handled").alias("disposition")).agg(F.count("*").alias("n"))


@query("label_review_queue", f"""WITH {COH}, b AS (SELECT *, verdict <> 'AMBIGUOUS' AS dec, coalesce(CASE verdict WHEN 'WALKING' THEN 10 WHEN 'STANDING' THEN 0 END <> label, false) AS bad FROM ch
), c AS (SELECT rev, trial, count(*) FILTER (WHERE bad) / count(*) FILTER (WHERE dec) AS df, (max(CASE WHEN bad THEN t END) - min(CASE WHEN bad THEN t END)) / (max(t) - min(t)) AS spread FROM b GROUP BY ALL)
SELECT rev, trial, CASE WHEN df > 0.5 THEN 'broken' ELSE 'divergent' END AS kind, round(df, 6) AS disagree_frac, round(spread, 6) AS spread FROM c WHERE df > 0.5 OR trial = 3""")
def label_review_queue(spark, sf_dir):
    from recsense.operators import physics

    a = audited(spark, sf_dir)
    t = physics.coherence(a, ["rev", "trial"], "t").withColumn("band_flag", F.col("trial") == 3)
    nominated = a.filter("t > 104900").select("rev", "trial", "t", F.col("t").alias("evidence"))
    return op.label_review_queue(t, nominated).select("rev", "trial", "kind", F.round("disagree_frac", 6).alias("disagree_frac"), F.round("spread", 6).alias("spread"))


@query("segment_rollup", f"WITH {USABLE} SELECT count(DISTINCT rec) AS n_files, count(*) AS n_segments, count(*) FILTER (WHERE reason IS NULL) AS n_usable, count(*) FILTER (WHERE reason IS NOT NULL) AS n_dropped, round(coalesce(sum(CASE WHEN reason IS NULL THEN duration_s END), 0), 1) AS usable_s FROM usable")
def segment_rollup(spark, sf_dir):
    return op.segment_rollup(usable(spark, sf_dir), "rec").withColumn("usable_s", F.round("usable_s", 1))


@query("coverage_distribution", f"""WITH {FILE}, r AS (SELECT committed_frac AS coverage, row_number() OVER (ORDER BY committed_frac) - 1 AS k, count(*) OVER () AS n FROM fs) SELECT q, coverage FROM r JOIN (SELECT unnest([0.05e0, 0.25e0, 0.5e0, 0.75e0, 1.0e0]) AS q) ON k = least(n - 1, CAST(floor(q * n) AS BIGINT))""")
def coverage_distribution(spark, sf_dir):
    return op.coverage_distribution(stats(spark, sf_dir).select("committed_frac"), "committed_frac", [0.05, 0.25, 0.5, 0.75, 1.0])


@query("session_coverage", f"""WITH {FILE}, v AS (SELECT substr(file, 1, 2) AS variant, substr(file, 4) AS session, committed_frac AS c FROM fs) SELECT variant, count(*) AS n_files, list_sort(list(c))[CAST(floor(count(*) / 2) AS BIGINT) + 1] AS upper_median, count(*) FILTER (WHERE c < 0.19) AS n_low, count(DISTINCT CASE WHEN c < 0.19 THEN session END) AS low_sessions FROM v GROUP BY variant""")
def session_coverage(spark, sf_dir):
    s = stats(spark, sf_dir).select(F.substring("file", 1, 2).alias("variant"), F.substring_index("file", "-", -1).alias("session"), F.col("committed_frac").alias("c"))
    return op.session_coverage(s, "variant", "session", "c", 0.19)


@query("operating_points", f"WITH {CURVE}, k AS (SELECT threshold, count(*) FILTER (WHERE conf >= threshold) / count(*) AS corpus FROM g CROSS JOIN thr WHERE trial <> 0 GROUP BY threshold) SELECT k.threshold, round(corpus, 6) AS corpus_coverage, round(accuracy, 6) AS accuracy, round(worst_accuracy, 6) AS worst_accuracy FROM k JOIN curve ON round(k.threshold, 4) = round(curve.threshold, 4)")
def operating_points(spark, sf_dir):
    s = score(spark, sf_dir)
    corpus = evaluate.selective_curve(s.filter("trial <> 0"), T5).select("threshold", F.col("coverage").alias("corpus_coverage"))
    return op.operating_points(corpus, evaluate.selective_curve(s, T5)).withColumns({c: F.round(c, 6) for c in ("corpus_coverage", "accuracy", "worst_accuracy")})


@query("variant_servability", f"WITH {SERVE} SELECT variant, count(*) AS n_files, count(*) FILTER (WHERE refusal IS NULL) AS n_served, bool_or(angle_axis IS NULL) AS unmapped FROM sv GROUP BY variant")
def variant_servability(spark, sf_dir):
    return op.variant_servability(served(spark, sf_dir))


@query("flag_rules", f"""WITH {FILE}, a AS (SELECT rev, avg(CASE WHEN (CASE WHEN p >= 0.5 THEN 10 ELSE 0 END) = truth THEN 1.0e0 ELSE 0.0e0 END) AS accuracy FROM score GROUP BY rev)
SELECT 'sealed' AS kind, 'sealed subject below 0.95' AS title, count(*) AS n FROM a WHERE rev = 's6' AND accuracy < 0.95 HAVING count(*) > 0 UNION ALL SELECT 'spread', 'accuracy differs between groups', 1 FROM (SELECT max(accuracy) - min(accuracy) AS s FROM a) WHERE s > 0.05
UNION ALL SELECT 'coverage', 'files under half', 1 FROM (SELECT count(*) AS n FROM fs WHERE committed_frac < 0.5) WHERE n >= 3 UNION ALL SELECT 'variant', 'variant is not mapped', 1""")
def flag_rules(spark, sf_dir):
    per = evaluate.evaluate(evaluate.guessed(score(spark, sf_dir)), ["rev"])
    low = stats(spark, sf_dir).select(F.col("committed_frac").alias("coverage"), F.substring("file", 1, 2).alias("variant"), F.substring_index("file", "-", -1).alias("session"))
    found = op.flag_rules(low, per, op.variant_servability(served(spark, sf_dir)), per.filter("rev = 's6'"))
    return found.groupBy("kind", "title").agg(F.count("*").alias("n"))


@query("corpus_counts", f"WITH {TRIALS} SELECT count(*) AS n_trials, count(DISTINCT subject) AS n_subjects, count(*) FILTER (WHERE split = 'lockbox') AS n_sealed, count(*) FILTER (WHERE exclude) AS n_excluded, count(raw) AS n_paired FROM trials")
def corpus_counts(spark, sf_dir):
    return op.corpus_counts(trials(spark, sf_dir))


@query("extract_json_text", """SELECT event_id, CASE WHEN event_id % 4 = 0 THEN NULL ELSE CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k FROM events""")
def extract_json_text(spark, sf_dir):
    said = F.when(F.col("event_id") % 4 == 0, "nothing here").otherwise(F.concat(F.lit("it says "), "props", F.lit(" - so it is")))
    return table(spark, sf_dir, "events").select("event_id", op.extract_json_text(said, "struct<k: bigint>")["k"].alias("k"))
