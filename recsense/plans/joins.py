"""Queries on joins, runs, transitions, top k and sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from recsense.functions.columns import flag
from recsense.operators import joins as op
from recsense.operators import timebase

from .registry import query
from .views import EV, SEG, ev, kept, table

HOUR = 3_600_000.0
#: As-of: clicks look for the nearest purchase of their recording.
ASOF = EV + """, l AS (SELECT rec, id, t FROM ev WHERE event_type = 'click'), r AS (SELECT rec, t, a FROM ev WHERE event_type = 'purchase'), n AS (
  SELECT l.rec, l.id, l.t, b.t AS bt, b.a AS ba, f.t AS ft, f.a AS fa FROM l ASOF LEFT JOIN r b ON l.rec = b.rec AND l.t >= b.t ASOF LEFT JOIN r f ON l.rec = f.rec AND l.t <= f.t
), d AS (SELECT rec, id, CASE WHEN coalesce(t - bt <= ft - t, false) OR ft IS NULL THEN t - bt ELSE ft - t END AS distance, CASE WHEN coalesce(t - bt <= ft - t, false) OR ft IS NULL THEN ba ELSE fa END AS a FROM n)"""


def sides(spark, sf_dir):
    rows = ev(spark, sf_dir)
    return rows.filter("event_type = 'click'").select("rec", "id", "t"), rows.filter("event_type = 'purchase'").select("rec", "t", "a")


@query("asof_nearest_tol_full", f"WITH {ASOF} SELECT rec, id, CASE WHEN distance <= 36000000.0e0 THEN a END AS a FROM d")
def asof_full(spark, sf_dir):
    return op.asof_nearest(*sides(spark, sf_dir), "rec", "t", "a", 10 * HOUR, False).select("rec", "id", "a")


@query("asof_nearest_tol_half", f"WITH {ASOF} SELECT rec, id, coalesce(CASE WHEN distance <= 18000000.0e0 THEN a END, -2.0e0) AS a FROM d")
def asof_half(spark, sf_dir):
    return op.asof_nearest(*sides(spark, sf_dir), "rec", "t", "a", 5 * HOUR, True, F.lit(-2.0)).select("rec", "id", "a")


@query("inner_one_to_one", "SELECT count(*) AS n, round(sum(o_totalprice + c_acctbal), 2) AS total, CAST(0 AS BIGINT) AS n_twice FROM (SELECT o_custkey, max(o_totalprice) AS o_totalprice FROM orders GROUP BY 1) JOIN customer ON o_custkey = c_custkey")
def inner_one_to_one(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("k")).agg(F.max("o_totalprice").alias("p"))
    joined, twice = op.one_to_one(orders, table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), "c_acctbal"), ["k"])
    return joined.agg(F.count("*").alias("n"), F.round(F.sum(F.col("p") + F.col("c_acctbal")), 2).alias("total")).crossJoin(twice.agg(F.count("*").alias("n_twice")))


@query("left_join_policy", "SELECT d.doc_id, coalesce(l.toxic = 1, false) AS flagged FROM documents d LEFT JOIN labels l USING (doc_id)")
def left_join_policy(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").select("doc_id", (F.col("toxic") == 1).alias("flagged"))
    return table(spark, sf_dir, "documents").select("doc_id").join(labels, "doc_id", "left").withColumn("flagged", flag(F.col("flagged")))


@query("semi_anti_key", "SELECT lang, source IN ('src1', 'src2') AS in_set, count(*) AS n FROM documents GROUP BY 1, 2")
def semi_anti_key(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("lang", "source")
    keys = spark.createDataFrame([("src1",), ("src2",)], "source string")
    parts = [docs.join(keys, "source", how).groupBy("lang").agg(F.count("*").alias("n")).withColumn("in_set", F.lit(inside)) for how, inside in (("left_semi", True), ("left_anti", False))]
    return parts[0].unionByName(parts[1]).select("lang", "in_set", "n")


@query("positional_align", f"""WITH {EV}, x AS (SELECT rec, a, row_number() OVER (PARTITION BY rec ORDER BY t, id) AS k FROM ev), y AS (SELECT rec, b, row_number() OVER (PARTITION BY rec ORDER BY a, id) AS k FROM ev)
SELECT rec, k, a, b FROM x JOIN y USING (rec, k)""")
def positional_align(spark, sf_dir):
    from pyspark.sql import Window

    rows = ev(spark, sf_dir)
    x = rows.withColumn("k", F.row_number().over(Window.partitionBy("rec").orderBy("t", "id")).cast("long")).select("rec", "k", "a")
    y = rows.withColumn("k", F.row_number().over(Window.partitionBy("rec").orderBy("a", "id")).cast("long")).select("rec", "k", "b")
    return x.join(y, ["rec", "k"])


@query("review_join", "SELECT d.doc_id AS ref, coalesce(CASE l.quality WHEN 1 THEN 'accepted' WHEN 0 THEN 'rejected' END, 'needs_human') AS decision FROM documents d LEFT JOIN labels l USING (doc_id) WHERE d.n_chars > 1000")
def review_join(spark, sf_dir):
    decided = table(spark, sf_dir, "labels").select("doc_id", F.when(F.col("quality") == 1, "accepted").when(F.col("quality") == 0, "rejected").alias("decision"))
    queue = table(spark, sf_dir, "documents").filter("n_chars > 1000").select("doc_id").join(decided, "doc_id", "left")
    return queue.select(F.col("doc_id").alias("ref"), F.coalesce("decision", F.lit("needs_human")).alias("decision"))


RUNS = EV + """, c AS (SELECT rec, code, row_number() OVER w - 1 AS pos, CASE WHEN row_number() OVER w = 1 OR code IS DISTINCT FROM lag(code) OVER w THEN 1 ELSE 0 END AS ch FROM ev WINDOW w AS (PARTITION BY rec ORDER BY t, id)
), n AS (SELECT *, sum(ch) OVER (PARTITION BY rec ORDER BY pos ROWS UNBOUNDED PRECEDING) - 1 AS run FROM c
), runs AS (SELECT rec, CAST(run AS BIGINT) AS run, any_value(code) AS code, min(pos) AS start, max(pos) + 1 AS stop FROM n GROUP BY rec, run)"""


def code_runs(spark, sf_dir):
    return op.runs(ev(spark, sf_dir), ["rec"], ["t", "id"], "code")


@query("run_length", f"WITH {RUNS} SELECT rec, run, code, start, stop FROM runs")
def run_length(spark, sf_dir):
    return code_runs(spark, sf_dir)


CHANGES = EV + """, p AS (SELECT rec, t, event_type, lag(t) OVER w AS pt, lag(event_type) OVER w AS pe FROM ev WHERE event_type IN ('view', 'purchase') WINDOW w AS (PARTITION BY rec ORDER BY t)
), chg AS (SELECT rec, (t + pt) / 2.0e0 AS t, pe AS before, event_type AS after FROM p WHERE event_type <> pe)"""


def changes(spark, sf_dir):
    covered = F.when(F.col("event_type").isin("view", "purchase"), F.col("event_type"))
    return op.predicted_changes(ev(spark, sf_dir).withColumn("guess", covered), ["rec"], "t", "guess")


@query("predicted_changes", f"WITH {CHANGES} SELECT rec, t, before, after FROM chg")
def predicted_changes(spark, sf_dir):
    return changes(spark, sf_dir)


#: Two-hour windows; the guess and the reasons of rows are made up from other columns.
WINDOW = 2 * HOUR
TRANS = SEG + """, tr AS (SELECT rec, segment, id, t, code, CASE WHEN id % 5 = 0 THEN NULL WHEN a >= 50 THEN 10 ELSE 0 END AS guess, CASE WHEN id % 3 = 0 THEN 'near_transition' ELSE '' END AS reason FROM seg
), tc AS (SELECT *, CASE WHEN row_number() OVER w = 1 OR code IS DISTINCT FROM lag(code) OVER w THEN 1 ELSE 0 END AS ch FROM tr WINDOW w AS (PARTITION BY rec, segment ORDER BY t, id)
), tn AS (SELECT *, sum(ch) OVER (PARTITION BY rec, segment ORDER BY t, id ROWS UNBOUNDED PRECEDING) AS run FROM tc
), rn AS (SELECT rec, segment, run, any_value(code) AS v, min(t) AS t0, max(t) AS t1 FROM tn GROUP BY ALL
), led AS (SELECT *, lead(v) OVER w AS v1, lead(t0) OVER w AS a1, lead(t1) OVER w AS b1, lead(v, 2) OVER w AS v2, lead(t0, 2) OVER w AS a2, lead(t1, 2) OVER w AS b2, min(t0) OVER (PARTITION BY rec, segment) AS low, max(t1) OVER (PARTITION BY rec, segment) AS high FROM rn WINDOW w AS (PARTITION BY rec, segment ORDER BY run)
), tgt AS (SELECT *, CASE WHEN v1 = -1 THEN v2 ELSE v1 END AS vt, CASE WHEN v1 = -1 THEN a2 ELSE a1 END AS ta, CASE WHEN v1 = -1 THEN b2 ELSE b1 END AS tb FROM led WHERE v IN (0, 10)
), pts AS (SELECT rec, segment, concat(CASE v WHEN 0 THEN 'stand' ELSE 'walk' END, '->', CASE vt WHEN 0 THEN 'stand' ELSE 'walk' END) AS direction, (t1 + ta) / 2.0e0 AS t, ta - t1 AS width, t1 - t0 AS fb, tb - ta AS fa, low, high FROM tgt WHERE vt IN (0, 10) AND vt <> v
), cau AS (SELECT *, CASE WHEN fb < 7200000.0e0 OR fa < 7200000.0e0 THEN 'short_flank' WHEN t - low < 7200000.0e0 OR high - t < 7200000.0e0 THEN 'near_segment_edge' END AS rejected FROM pts
), pg AS (SELECT rec, segment, t, guess, lag(t) OVER w AS pt, lag(guess) OVER w AS pv FROM tr WHERE guess IS NOT NULL WINDOW w AS (PARTITION BY rec, segment ORDER BY t)
), pc AS (SELECT rec, segment, (t + pt) / 2.0e0 AS t FROM pg WHERE guess <> pv
), nr AS (SELECT c.*, b.t AS bt, f.t AS ft FROM (SELECT * FROM cau WHERE rejected IS NULL) c ASOF LEFT JOIN pc b ON c.rec = b.rec AND c.segment = b.segment AND c.t >= b.t ASOF LEFT JOIN pc f ON c.rec = f.rec AND c.segment = f.segment AND c.t <= f.t
), of AS (SELECT *, CASE WHEN coalesce(t - bt <= ft - t, false) OR ft IS NULL THEN bt - t ELSE ft - t END AS off,
  EXISTS (SELECT 1 FROM tr r WHERE r.rec = nr.rec AND r.segment = nr.segment AND r.reason = 'near_transition' AND abs(r.t - nr.t) <= 3600000.0e0) AS flagged FROM nr
), trans AS (SELECT rec, segment, direction, round(t / 1000.0e0, 3) AS t_truth_s, round(width / 1000.0e0, 3) AS width_s, round(fb / 1000.0e0, 3) AS flank_before_s, round(fa / 1000.0e0, 3) AS flank_after_s, round(off / 1000.0e0, 3) AS offset_s, flagged, rejected FROM of
  UNION ALL SELECT rec, segment, direction, round(t / 1000.0e0, 3), round(width / 1000.0e0, 3), round(fb / 1000.0e0, 3), round(fa / 1000.0e0, 3), NULL, NULL, rejected FROM cau WHERE rejected IS NOT NULL)"""


def transitions(spark, sf_dir):
    seg = timebase.gap_segments(ev(spark, sf_dir))
    guess = F.when(F.col("id") % 5 != 0, F.when(F.col("a") >= 50, 10).otherwise(0))
    rows = kept(seg.select("rec", "segment", "id", "t", "code", guess.alias("guess"), F.when(F.col("id") % 3 == 0, "near_transition").otherwise("").alias("reason")), "transition-rows")
    return op.find_transitions(rows, ["rec", "segment"], ["t", "id"], "t", "code", "guess", "reason", WINDOW)


@query("find_transitions", f"WITH {TRANS} SELECT * FROM trans")
def find_transitions(spark, sf_dir):
    return transitions(spark, sf_dir)


@query("transition_summary", f"""WITH {TRANS}, o AS (SELECT *, rejected IS NULL AS ok, CASE WHEN rejected IS NULL THEN width_s END AS w, CASE WHEN rejected IS NULL THEN offset_s END AS f FROM trans)
SELECT rec, count(*) FILTER (ok) AS n_timeable, count(*) FILTER (rejected = 'short_flank') AS n_short_flank, count(*) FILTER (rejected = 'near_segment_edge') AS n_near_edge,
  count(*) FILTER (ok AND direction = 'stand->walk') AS n_stand_walk, count(*) FILTER (ok AND direction = 'walk->stand') AS n_walk_stand,
  round(quantile_cont(w, 0.5) + 0.0000031e0, 4) AS width_median, round(avg(w) + 0.0000031e0, 4) AS width_mean, round(quantile_cont(w, 0.9) + 0.0000031e0, 4) AS width_p90, max(w) AS width_max, count(*) FILTER (w = 0) AS n_zero_width,
  count(*) FILTER (ok AND flagged) AS n_flagged, count(f) AS n_timed, count(*) FILTER (ok AND f IS NULL) AS n_no_change,
  round(quantile_cont(f, 0.5) + 0.0000031e0, 4) AS offset_median, round(quantile_cont(abs(f), 0.5) + 0.0000031e0, 4) AS offset_abs_median, round(quantile_cont(abs(f), 0.9) + 0.0000031e0, 4) AS offset_abs_p90,
  count(*) FILTER (abs(f) <= 3600) AS n_tight, count(*) FILTER (abs(f) <= 7200) AS n_loose, count(*) FILTER (f > 0) AS n_late, count(*) FILTER (f < 0) AS n_early,
  round(count(*) FILTER (ok AND flagged) / nullif(count(*) FILTER (ok), 0), 6) AS frac_flagged, round(count(*) FILTER (abs(f) <= 3600) / nullif(count(f), 0), 6) AS frac_tight, round(count(*) FILTER (abs(f) <= 7200) / nullif(count(f), 0), 6) AS frac_loose
FROM o GROUP BY GROUPING SETS ((), (rec))""")
def transition_summary(spark, sf_dir):
    """Over all recordings (``rec`` null) and for each."""
    trans = kept(transitions(spark, sf_dir), "transitions")
    both = [op.transition_summary(trans, WINDOW / 1000.0).withColumn("rec", F.lit(None).cast("long")), op.transition_summary(trans, WINDOW / 1000.0, ["rec"])]
    out = both[0].unionByName(both[1])
    return out.withColumns({c: F.round(c, 6) if c.startswith("frac") else F.round(F.col(c) + 0.0000031, 4) for c, kind in out.dtypes if kind == "double" and c != "width_max"})


NEAREST = CHANGES + """, pt AS (SELECT rec, id, t FROM ev WHERE event_type = 'error'), ne AS (
  SELECT p.rec, p.id, p.t, b.t AS bt, f.t AS ft FROM pt p ASOF LEFT JOIN chg b ON p.rec = b.rec AND p.t >= b.t ASOF LEFT JOIN chg f ON p.rec = f.rec AND p.t <= f.t)"""


@query("nearest_event", f"WITH {NEAREST} SELECT rec, id, round(CASE WHEN coalesce(t - bt <= ft - t, false) OR ft IS NULL THEN bt - t ELSE ft - t END, 3) AS event_offset FROM ne")
def nearest_event(spark, sf_dir):
    points = ev(spark, sf_dir).filter("event_type = 'error'").select("rec", "id", "t")
    return op.nearest_event(points, changes(spark, sf_dir), "rec", "t").select("rec", "id", F.round("offset", 3).alias("event_offset"))


REGIONS = SEG + ", regions AS (SELECT rec, segment, min(t) AS t0, max(t) AS t1 FROM seg GROUP BY rec, segment)"


def regions(spark, sf_dir):
    return timebase.gap_segments(ev(spark, sf_dir)).groupBy("rec", "segment").agg(F.min("t").alias("t0"), F.max("t").alias("t1"))


@query("interval_contains", f"WITH {REGIONS} SELECT g.rec, g.segment, EXISTS (SELECT 1 FROM ev e WHERE e.rec = g.rec AND e.event_type = 'error' AND e.t >= g.t0 - 3600000.0e0 AND e.t <= g.t1 + 3600000.0e0) AS hit FROM regions g")
def interval_contains(spark, sf_dir):
    events = ev(spark, sf_dir).filter("event_type = 'error'")
    return op.contains_event(regions(spark, sf_dir), events, "rec", "t0", "t1", "t", HOUR, 24 * HOUR).select("rec", "segment", "hit")


@query("transition_regions", f"""WITH {RUNS}, tm AS (SELECT rec, row_number() OVER (PARTITION BY rec ORDER BY t, id) - 1 AS pos, t FROM ev), reg AS (
  SELECT r.rec, r.run, min(t) AS t0, max(t) AS t1 FROM runs r JOIN tm ON r.rec = tm.rec AND tm.pos >= r.start AND tm.pos < r.stop WHERE r.code = -1 GROUP BY r.rec, r.run
), h AS (SELECT g.*, EXISTS (SELECT 1 FROM ev e WHERE e.rec = g.rec AND e.event_type = 'signup' AND e.t >= g.t0 - 14400000.0e0 AND e.t <= g.t1 + 14400000.0e0) AS hit FROM reg g)
SELECT count(*) AS n_regions, CAST(sum(CASE WHEN hit THEN 0 ELSE 1 END) AS BIGINT) AS n_unmatched, round(sum(CASE WHEN hit THEN 0 ELSE 1 END) / CAST(count(*) AS DOUBLE), 6) AS share FROM h""")
def transition_regions(spark, sf_dir):
    from pyspark.sql import Window

    rows = ev(spark, sf_dir)
    w = Window.partitionBy("rec").orderBy("t", "id")
    change = (F.row_number().over(w) == 1) | ~F.col("code").eqNullSafe(F.lag("code").over(w))
    marked = rows.withColumn("c", change.cast("long")).withColumn("run", F.sum("c").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    reg = marked.filter("code = -1").groupBy("rec", "run").agg(F.min("t").alias("t0"), F.max("t").alias("t1"))
    hit = op.contains_event(reg, rows.filter("event_type = 'signup'"), "rec", "t0", "t1", "t", 4 * HOUR, 24 * HOUR)
    missed = F.sum((~F.col("hit")).cast("long"))
    return hit.agg(F.count("*").alias("n_regions"), missed.alias("n_unmatched"), F.round(missed / F.count("*").cast("double"), 6).alias("share"))


@query("greedy_spread_topk", """WITH RECURSIVE src AS (
  SELECT user_id AS rec, value AS e, CAST(epoch_us(ts) AS DOUBLE) / 1000.0e0 AS t, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, ts) AS k FROM events
), walk AS (
  SELECT rec, CAST(0 AS BIGINT) AS k, CAST([] AS DOUBLE[]) AS taken FROM (SELECT DISTINCT rec FROM src)
  UNION ALL
  SELECT w.rec, s.k, CASE WHEN len(w.taken) < 6 AND len(list_filter(w.taken, lambda x: abs(x - s.t) < 86400000.0e0)) = 0 THEN list_append(w.taken, s.t) ELSE w.taken END FROM walk w JOIN src s ON s.rec = w.rec AND s.k = w.k + 1
), done AS (SELECT rec, max(k) AS n, arg_max(taken, k) AS taken FROM walk GROUP BY rec)
SELECT rec, CAST(n - len(taken) AS INTEGER) AS n_dropped, CAST(len(taken) AS INTEGER) AS n_taken, round(list_sum(taken), 1) AS t_sum FROM done""")
def greedy_spread_topk(spark, sf_dir):
    found = op.greedy_spread_topk(ev(spark, sf_dir), "rec", "t", "a", 6, 24 * HOUR)
    return found.select("rec", F.col("n_dropped").cast("int").alias("n_dropped"), F.size("taken").alias("n_taken"), F.round(F.aggregate("taken", F.lit(0.0), lambda s, x: s + x["t"]), 1).alias("t_sum"))


@query("worst_n", "SELECT user_id AS rec, round(avg(value), 6) AS mean_value FROM events GROUP BY user_id ORDER BY avg(value), user_id LIMIT 10")
def worst_n(spark, sf_dir):
    per = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("rec")).agg(F.avg("value").alias("m"))
    return op.worst_n(per, [F.col("m"), F.col("rec")], 10).select("rec", F.round("m", 6).alias("mean_value"))


@query("latest_partition", "SELECT strftime(o_orderdate, '%Y%m%d') AS date, CAST(o_custkey % 13 AS INTEGER) AS run FROM orders WHERE o_totalprice > 100000 ORDER BY 1 DESC, 2 DESC LIMIT 1")
def latest_partition(spark, sf_dir):
    dirs = table(spark, sf_dir, "orders").select(F.date_format("o_orderdate", "yyyyMMdd").alias("date"), (F.col("o_custkey") % 13).cast("string").alias("run"), (F.col("o_totalprice") > 100000).cast("int").alias("n_items"))
    return op.latest_partition(dirs)


@query("dataset_diff", """SELECT CAST(doc_id AS VARCHAR) AS place, CASE WHEN doc_id % 10 = 3 THEN 'row only in want' WHEN doc_id % 10 = 4 THEN 'row only in got' WHEN lang IS DISTINCT FROM CASE WHEN doc_id % 10 = 5 THEN NULL ELSE lang END THEN 'value of lang' ELSE 'value of n_chars' END AS difference
FROM documents WHERE doc_id % 10 IN (3, 4, 5, 6) UNION ALL SELECT 'text', 'only in want' UNION ALL SELECT 'source', 'only in got'""")
def dataset_diff(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    k = F.col("doc_id") % 10
    got = docs.filter(k != 3).select("doc_id", F.when(k != 5, F.col("lang")).alias("lang"), (F.col("n_chars") + (k == 6).cast("int")).alias("n_chars"), "source")
    return op.first_difference(docs.filter(k != 4).select("doc_id", "lang", "n_chars", "text"), got, ["doc_id"])


@query("concat_frames", "SELECT event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY event_type")
def concat_frames(spark, sf_dir):
    rows = table(spark, sf_dir, "events")
    low, high = rows.filter("user_id < 75"), rows.filter("user_id >= 75").withColumn("extra", F.lit(1))
    return low.unionByName(high, allowMissingColumns=True).groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))


@query("set_difference", "SELECT DISTINCT lang, source FROM documents WHERE n_chars > 2000 EXCEPT SELECT lang, source FROM documents WHERE n_chars < 200")
def set_difference(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.filter("n_chars > 2000").select("lang", "source").distinct().exceptAll(docs.filter("n_chars < 200").select("lang", "source").distinct())


@query("intersect_axes", "SELECT doc_id, array_to_string(list_filter(['de', 'fr', 'en'], lambda x: x = lang OR x = CASE WHEN doc_id % 2 = 0 THEN 'fr' ELSE 'de' END), ',') AS shared FROM documents")
def intersect_axes(spark, sf_dir):
    own = F.array("lang", F.when(F.col("doc_id") % 2 == 0, "fr").otherwise("de"))
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(F.array_intersect(F.array(F.lit("de"), F.lit("fr"), F.lit("en")), own), ",").alias("shared"))
