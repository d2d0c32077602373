"""Views over the given tables that stand in for sensor logs, in Spark and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recsense.functions.shared import kept, shared

__all__ = ["ev", "head", "kept", "score", "shared", "table"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def micros(column: str):
    """Microseconds since the epoch of a timestamp without zone."""
    return F.expr(f"timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', {column})")


#: A recording per user: time in ms, two channels, a label track.
EV = """ev AS (
  SELECT user_id AS rec, event_id AS id, CAST(epoch_us(ts) AS DOUBLE) / 1000.0e0 AS t, value AS a,
    CAST(json_extract_string(props, '$.k') AS DOUBLE) AS b, event_type,
    CASE WHEN event_type IN ('view', 'click') THEN 0 WHEN event_type = 'error' THEN -1 ELSE 10 END AS code
  FROM events)"""


def ev(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.when(F.col("event_type").isin("view", "click"), 0).when(F.col("event_type") == "error", -1).otherwise(10)
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("rec"),
        F.col("event_id").alias("id"),
        (micros("ts").cast("double") / 1000.0).alias("t"),
        F.col("value").alias("a"),
        F.get_json_object("props", "$.k").cast("double").alias("b"),
        "event_type",
        code.alias("code"),
    )


#: Scored rows: group, truth, probability of class 10, trial, reason.
SCORE = """score AS (
  SELECT concat('s', CAST(l_suppkey % 7 AS VARCHAR)) AS rev, CASE l_linestatus WHEN 'F' THEN 0 ELSE 10 END AS truth, l_quantity / 50.0e0 AS p,
    l_partkey % 9 AS trial, l_returnflag AS reason, l_discount AS disc, l_tax AS tax, l_extendedprice AS price
  FROM lineitem)"""


def score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("s"), (F.col("l_suppkey") % 7).cast("string")).alias("rev"),
        F.when(F.col("l_linestatus") == "F", 0).otherwise(10).alias("truth"),
        (F.col("l_quantity") / 50.0).alias("p"),
        (F.col("l_partkey") % 9).alias("trial"),
        F.col("l_returnflag").alias("reason"),
        F.col("l_discount").alias("disc"),
        F.col("l_tax").alias("tax"),
        F.col("l_extendedprice").alias("price"),
    )


#: A header per user: names of event types in the order of their first event, with the place as prefix.
HEAD = """seen AS (
  SELECT user_id AS file, event_type, min(event_id) AS first FROM events GROUP BY ALL
), placed AS (
  SELECT file, event_type, CAST(row_number() OVER (PARTITION BY file ORDER BY first) AS INTEGER) AS pos FROM seen
), head AS (
  SELECT file, list(concat(' ', lpad(CAST(pos AS VARCHAR), 2, '0'), '_', event_type, ' ') ORDER BY pos) AS header FROM placed GROUP BY file)"""


def head(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("file"), "event_type").agg(F.min("event_id").alias("first"))
    ordered = F.sort_array(F.collect_list(F.struct("first", "event_type")))
    named = F.transform(ordered, lambda x, i: F.concat(F.lit(" "), F.lpad((i + 1).cast("string"), 2, "0"), F.lit("_"), x["event_type"], F.lit(" ")))
    return first.groupBy("file").agg(named.alias("header"))


#: Segments of the recordings at gaps above five medians.
SEG = EV + """, dts AS (
  SELECT *, t - lag(t) OVER (PARTITION BY rec ORDER BY t, id) AS dt FROM ev
), med AS (
  SELECT rec, quantile_cont(dt, 0.5) AS med FROM dts GROUP BY rec
), seg AS (
  SELECT d.*, m.med, CAST(sum(CASE WHEN d.dt > 5 * m.med THEN 1 ELSE 0 END) OVER (PARTITION BY d.rec ORDER BY d.t, d.id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS segment,
    row_number() OVER (PARTITION BY d.rec ORDER BY d.t, d.id) - 1 AS row_idx
  FROM dts d JOIN med m USING (rec))"""


def decided_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored rows with the call at 0.85."""
    return score(spark, sf_dir).withColumn("Label", F.when(F.greatest("p", 1.0 - F.col("p")) < 0.85, -1).when(F.col("p") >= 0.5, 10).otherwise(0))
