"""Queries that write logs out of the tables into the shared folder and read them back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from recsense.sources import logs

from .registry import query
from .views import EV, SCORE, decided_rows, ev, shared


def folder(spark, name: str) -> str:
    return f"{shared(spark)}/{name}-{uuid.uuid4().hex}"


def raw_logs(spark, sf_dir) -> str:
    """One folder of CSV logs per four recordings, header with prefixes."""
    path = folder(spark, "raw-logs")
    rows = ev(spark, sf_dir).select((F.col("rec") % 4).alias("session"), F.col("t").alias("01_Time"), F.col("a").alias("02_A"), F.col("b").alias("03_B"), F.col("rec").cast("double").alias("04_Rec"))
    rows.repartition("session").write.option("header", True).partitionBy("session").csv(path)
    return path


NAMES = ["01_Time", "02_A", "03_B", "04_Rec"]


@query("scan_headers", "SELECT '01_Time,02_A,03_B,04_Rec' AS header, count(DISTINCT user_id % 4) AS n FROM events")
def scan_headers(spark, sf_dir):
    return logs.scan_headers(spark, raw_logs(spark, sf_dir)).groupBy(F.array_join("header", ",").alias("header")).agg(F.count("*").alias("n"))


@query("scan_raw_csv", f"WITH {EV} SELECT CAST(rec AS DOUBLE) AS rec, count(*) AS n, round(sum(a), 4) AS a, round(sum(b), 4) AS b, min(t) AS t_start FROM ev GROUP BY rec")
def scan_raw_csv(spark, sf_dir):
    rows = logs.scan_raw_csv(spark, raw_logs(spark, sf_dir), NAMES)
    rows = rows.select(*[F.col(f"`{c}`").alias(c[3:].lower() if c[:2].isdigit() else c) for c in rows.columns])
    return rows.groupBy("rec").agg(F.count("*").alias("n"), F.round(F.sum("a"), 4).alias("a"), F.round(F.sum("b"), 4).alias("b"), F.min("time").alias("t_start"))


@query("scan_annotated", f"WITH {EV} SELECT code AS \"Label\", count(*) AS n, round(sum(a), 3) AS a FROM ev GROUP BY code")
def scan_annotated(spark, sf_dir):
    path = folder(spark, "annotated")
    ev(spark, sf_dir).select(F.col("t").alias(" Time "), F.col("a").alias("A "), F.col("code").alias(" Label")).write.option("header", True).csv(path)
    return logs.scan_annotated(spark, path, ["Time", "A", "Label"]).groupBy("Label").agg(F.count("*").alias("n"), F.round(F.sum("A"), 3).alias("a"))


@query("transcode_cache", f"WITH {EV} SELECT count(*) AS n, round(sum(a), 2) AS a, CAST(0 AS BIGINT) AS n_again, count(DISTINCT rec % 4) AS n_files FROM ev")
def transcode_cache(spark, sf_dir):
    raw, cache = raw_logs(spark, sf_dir), folder(spark, "cache")
    logs.transcode_cache(spark, raw, cache, NAMES)
    again = logs.transcode_cache(spark, raw, cache, NAMES)
    rows = logs.Transcoded(spark, cache).read()
    return rows.agg(F.count("*").alias("n"), F.round(F.sum("02_A"), 2).alias("a"), F.lit(again).cast("long").alias("n_again"), F.count_distinct("path").alias("n_files"))


@query("write_verdicts", f"WITH {SCORE} SELECT rev, CAST(trial AS INTEGER) AS trial, count(*) AS n FROM score GROUP BY ALL")
def write_verdicts(spark, sf_dir):
    path = folder(spark, "verdicts")
    logs.write_verdicts(decided_rows(spark, sf_dir), path, "rev", "trial")
    return spark.read.parquet(path).groupBy("rev", F.col("trial").cast("int").alias("trial")).agg(F.count("*").alias("n"))


@query("write_ledgers", "SELECT lang, count(*) AS n, true AS empty_is_there FROM documents GROUP BY lang")
def write_ledgers(spark, sf_dir):
    from .views import table

    path, none = folder(spark, "ledger"), folder(spark, "ledger")
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    logs.write_ledger(docs, path)
    logs.write_ledger(docs.limit(0), none)
    there = spark.read.schema(docs.schema).json(none).isEmpty()
    return spark.read.schema(docs.schema).json(path).groupBy("lang").agg(F.count("*").alias("n")).withColumn("empty_is_there", F.lit(there))
