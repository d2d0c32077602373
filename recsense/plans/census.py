"""Queries on headers, sessions and splits."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from recsense.functions.columns import strip_prefix
from recsense.operators import census as op
from recsense.sources import logs

from .registry import query
from .views import HEAD, SCORE, ev, head, score, shared, table

MARKERS = [("clicked", "click"), ("seen", "view")]
ROLES = [("click", "left"), ("view", "right"), ("purchase", "right"), ("signup", "time")]
LABELS = ["error"]
CONTRACT = ["signup", "view", "click", "angle"]

#: The first three names of each header, so that variants differ in what they hold.
NAMES = HEAD + """, named AS (
  SELECT file, list_transform(list_slice(header, 1, 3 + CAST(file % 3 AS INTEGER)), lambda x: trim(regexp_replace(trim(x), '^[0-9]{2,}_', ''))) AS names FROM head
), heads AS (
  SELECT file, names, substr(sha1(array_to_string(names, '|')), 1, 8) AS variant_id,
    CASE WHEN list_contains(names, 'click') THEN 'clicked' WHEN list_contains(names, 'view') THEN 'seen' ELSE 'unknown' END AS family FROM named)"""


def heads(spark, sf_dir):
    cut = head(spark, sf_dir).withColumn("header", F.slice("header", F.lit(1), (F.lit(3) + F.col("file") % 3).cast("int")))
    return op.headers(cut, MARKERS)


@query("strip_prefix", f"WITH {HEAD} SELECT file, trim(regexp_replace(trim(x), '^[0-9]{{2,}}_', '')) AS name, length(x) AS n FROM (SELECT file, unnest(header) AS x FROM head)")
def strip(spark, sf_dir):
    x = head(spark, sf_dir).select("file", F.explode("header").alias("x"))
    return x.select("file", strip_prefix(F.col("x")).alias("name"), F.length("x").cast("long").alias("n"))


@query("header_fingerprint", f"WITH {NAMES} SELECT file, variant_id FROM heads")
def header_fingerprint(spark, sf_dir):
    return heads(spark, sf_dir).select("file", "variant_id")


@query("family_of", f"WITH {NAMES} SELECT family, count(*) AS n FROM heads GROUP BY family")
def family_of(spark, sf_dir):
    return heads(spark, sf_dir).groupBy("family").agg(F.count("*").alias("n"))


@query("resolve_roles", f"""WITH {NAMES}, x AS (SELECT file, unnest(names) AS name FROM heads), r AS (
  SELECT file, name, CASE name WHEN 'click' THEN 'left' WHEN 'view' THEN 'right' WHEN 'purchase' THEN 'right' WHEN 'signup' THEN 'time' END AS role FROM x)
SELECT file, coalesce(string_agg(DISTINCT role, ',' ORDER BY role), '') AS roles, coalesce(string_agg(DISTINCT CASE WHEN role IS NULL AND name <> 'error' THEN name END, ','), '') AS unknown,
  coalesce(string_agg(DISTINCT CASE WHEN name = 'error' THEN name END, ','), '') AS labels FROM r GROUP BY file""")
def resolve_roles(spark, sf_dir):
    roles = spark.createDataFrame(ROLES, "name string, role string")
    return op.resolve_roles(heads(spark, sf_dir), roles, LABELS).withColumns({c: F.array_join(c, ",") for c in ("roles", "unknown", "labels")})


@query("variant_registry", f"WITH {NAMES} SELECT variant_id, any_value(family) AS family, any_value(len(names)) AS n_cols, count(*) AS n_files, min(file) AS first_file, max(file) AS last_file FROM heads GROUP BY variant_id")
def variant_registry(spark, sf_dir):
    return op.variant_registry(heads(spark, sf_dir)).withColumn("n_cols", F.col("n_cols").cast("long"))


@query("moved_columns", f"""WITH {NAMES}, x AS (SELECT DISTINCT family, unnest(names) AS name, generate_subscripts(names, 1) - 1 AS pos FROM heads)
SELECT family, name, string_agg(CAST(pos AS VARCHAR), ',' ORDER BY pos) AS places FROM x GROUP BY family, name HAVING count(*) > 1""")
def moved_columns(spark, sf_dir):
    return op.moved_columns(heads(spark, sf_dir)).withColumn("places", F.array_join(F.transform("places", lambda x: x.cast("string")), ","))


@query("session_of", r"""WITH f AS (SELECT o_orderkey, concat(strftime(o_orderdate, '%Y%m%d'), CASE o_orderkey % 4 WHEN 0 THEN '' WHEN 1 THEN concat('_', CAST(o_orderkey % 9 AS VARCHAR)) WHEN 2 THEN 'x' ELSE '_12' END) AS folder FROM orders)
SELECT o_orderkey, CASE WHEN regexp_matches(folder, '^(\d{8})(?:_(\d+))?$') THEN substr(folder, 1, 8) END AS session_date,
  CASE WHEN regexp_matches(folder, '^(\d{8})(?:_(\d+))?$') THEN CAST(coalesce(nullif(regexp_extract(folder, '^(\d{8})(?:_(\d+))?$', 2), ''), '1') AS INTEGER) END AS session_run FROM f""")
def session_of(spark, sf_dir):
    k = F.col("o_orderkey")
    tail = F.when(k % 4 == 0, "").when(k % 4 == 1, F.concat(F.lit("_"), (k % 9).cast("string"))).when(k % 4 == 2, "x").otherwise("_12")
    date, run = op.session_of(F.concat(F.date_format("o_orderdate", "yyyyMMdd"), tail))
    return table(spark, sf_dir, "orders").select(k, date.alias("session_date"), run.alias("session_run"))


@query("select_measured", f"""WITH {NAMES} SELECT file, array_to_string(list_filter(['signup', 'view', 'click', 'angle'], lambda x: list_contains(names, x)), ',') AS present,
  array_to_string(list_filter(['signup', 'view', 'click', 'angle'], lambda x: NOT list_contains(names, x)), ',') AS missing FROM heads""")
def select_measured(spark, sf_dir):
    return op.select_measured(heads(spark, sf_dir), CONTRACT).select("file", F.array_join("present", ",").alias("present"), F.array_join("missing", ",").alias("missing"))


@query("label_contamination", f"WITH {NAMES} SELECT file FROM heads WHERE list_contains(names, 'error')")
def label_contamination(spark, sf_dir):
    return heads(spark, sf_dir).filter(F.arrays_overlap("names", F.array(*map(F.lit, LABELS)))).select("file")


@query("duplicate_or_ragged", f"""WITH {NAMES}, d AS (SELECT file, CASE WHEN file % 10 = 0 THEN list_append(names, names[1]) ELSE names END AS names, 3 + file % 5 AS n_data FROM heads)
SELECT file, CASE WHEN len(list_distinct(names)) < len(names) THEN 'duplicate column names' ELSE 'more data columns than header names' END AS reason FROM d WHERE len(list_distinct(names)) < len(names) OR n_data > len(names)""")
def duplicate_or_ragged(spark, sf_dir):
    h = heads(spark, sf_dir)
    again = h.withColumn("names", F.when(F.col("file") % 10 == 0, F.concat("names", F.slice("names", 1, 1))).otherwise(F.col("names")))
    return op.duplicate_or_ragged(again, 3 + F.col("file") % 5)


#: A manifest out of the customers: subject, session, split, exclusion, raw pairing.
TRIALS = """trials AS (
  SELECT CASE WHEN c_custkey % 97 = 0 THEN NULL ELSE concat('p', CAST(c_nationkey AS VARCHAR)) END AS subject, CAST(c_custkey % 40 AS INTEGER) AS session, c_name AS annotated,
    CASE c_custkey % 5 WHEN 0 THEN 'lockbox' WHEN 1 THEN 'other' ELSE 'train' END AS split, c_mktsegment = 'MACHINERY' AS exclude, CASE WHEN c_custkey % 3 = 0 THEN c_custkey END AS raw FROM customer)"""


def trials(spark, sf_dir):
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        F.when(k % 97 != 0, F.concat(F.lit("p"), F.col("c_nationkey").cast("string"))).alias("subject"),
        (k % 40).cast("int").alias("session"),
        F.col("c_name").alias("annotated"),
        F.when(k % 5 == 0, "lockbox").when(k % 5 == 1, "other").otherwise("train").alias("split"),
        (F.col("c_mktsegment") == "MACHINERY").alias("exclude"),
        F.when(k % 3 == 0, k).alias("raw"),
    )


@query("scan_manifest", f"""WITH {TRIALS}, k AS (SELECT *, concat(coalesce(subject, '?'), '/', coalesce(CAST(session AS VARCHAR), '?')) AS key FROM trials)
SELECT key, 'required field missing' AS problem FROM k WHERE subject IS NULL OR session IS NULL OR annotated IS NULL
UNION ALL SELECT key, 'unknown split' FROM k WHERE split NOT IN ('train', 'lockbox') UNION ALL SELECT key, 'key repeats' FROM k GROUP BY key HAVING count(*) > 1""")
def scan_manifest(spark, sf_dir):
    """A manifest per thousand customers, written as JSON, read back and checked."""
    path = f"{shared(spark)}/manifests-{uuid.uuid4().hex}"
    listed = trials(spark, sf_dir).withColumn("part", F.floor(F.regexp_extract("annotated", r"(\d+)$", 1).cast("long") / 1000))
    fields = [c for c in listed.columns if c != "part"]
    listed.groupBy("part").agg(F.lit(1).alias("schema"), F.collect_list(F.struct(*fields)).alias("trials")).drop("part").write.json(path)
    ddl = "subject string, session int, annotated string, split string, exclude boolean, raw long"
    return op.manifest_violations(logs.scan_manifest(spark, path, ddl, lines=True))


@query("filter_trials", f"WITH {TRIALS} SELECT subject, session, annotated, 'train' AS split FROM trials WHERE NOT exclude")
def filter_trials(spark, sf_dir):
    return op.filter_trials(trials(spark, sf_dir), unseal=True).select("subject", "session", "annotated", "split")


@query("declared_pairs", f"WITH {TRIALS}, f AS (SELECT DISTINCT o_custkey AS path FROM orders WHERE o_custkey % 2 = 0) SELECT annotated, raw, f.path IS NULL AS refused FROM trials LEFT JOIN f ON raw = f.path WHERE raw IS NOT NULL")
def declared_pairs(spark, sf_dir):
    files = table(spark, sf_dir, "orders").filter("o_custkey % 2 = 0").select(F.col("o_custkey").alias("path"))
    return op.declared_pairs(trials(spark, sf_dir), files).select("annotated", "raw", "refused")


@query("trainable_filter", "SELECT user_id AS rec, count(*) AS n FROM events WHERE event_type <> 'error' AND user_id % 5 <> 0 GROUP BY user_id")
def trainable_filter(spark, sf_dir):
    return ev(spark, sf_dir).filter((F.col("rec") % 5 != 0) & F.col("code").isin(0, 10)).groupBy("rec").agg(F.count("*").alias("n"))


@query("scorable_filter", f"WITH {SCORE} SELECT rev, count(*) AS n FROM score WHERE truth IN (0, 10) AND CASE WHEN tax < 0.07 THEN p END IS NOT NULL GROUP BY rev")
def scorable_filter(spark, sf_dir):
    p = F.when(F.col("tax") < 0.07, F.col("p"))
    return score(spark, sf_dir).filter(F.col("truth").isin(0, 10) & p.isNotNull()).groupBy("rev").agg(F.count("*").alias("n"))


@query("drop_lockbox", f"WITH {SCORE} SELECT rev, count(*) AS n FROM score WHERE rev NOT IN ('s2', 's5') GROUP BY rev UNION ALL SELECT 'refused', count(*) FROM score WHERE rev IN ('s2', 's5')")
def drop_lockbox(spark, sf_dir):
    stay, refused = op.refuse(score(spark, sf_dir), spark.createDataFrame([("s2",), ("s5",)], "rev string"), ["rev"])
    return stay.groupBy("rev").agg(F.count("*").alias("n")).unionByName(refused.select(F.lit("refused").alias("rev"), F.col("n_refused").alias("n")))


@query("drop_quarantined", f"WITH {SCORE}, q AS (SELECT rev, trial FROM score GROUP BY rev, trial HAVING avg(p) < 0.51) SELECT rev, trial, count(*) AS n FROM score WHERE (rev, trial) NOT IN (SELECT (rev, trial) FROM q) GROUP BY rev, trial")
def drop_quarantined(spark, sf_dir):
    s = score(spark, sf_dir)
    bad = s.groupBy("rev", "trial").agg(F.avg("p").alias("m")).filter("m < 0.51").select("rev", "trial")
    return op.refuse(s, bad, ["rev", "trial"])[0].groupBy("rev", "trial").agg(F.count("*").alias("n"))


@query("feature_select", "SELECT l_linestatus AS status, round(sum(l_quantity), 2) AS l_quantity, round(sum(l_tax), 2) AS l_tax FROM lineitem GROUP BY l_linestatus")
def feature_select(spark, sf_dir):
    kept = op.selected_features(["l_quantity", "l_discount", "l_tax"], ["l_discount"])
    return table(spark, sf_dir, "lineitem").groupBy(F.col("l_linestatus").alias("status")).agg(*[F.round(F.sum(c), 2).alias(c) for c in kept])
