"""Streaming jobs replayed over the events table."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from recsense.streaming import jobs

from .registry import query
from .views import shared, table

#: An event at the end of time, so that the watermark passes all windows and closes them.
CLOSING = "timestamp'2100-01-01 00:00:00'"


#: Files that a trigger reads, and those of a slice of time; a slice is a day, or the part of one that has about ROWS rows.
FILES, PARTS, ROWS = 4, 4, 2_000_000


def replay(spark, sf_dir, files: int = FILES, parts: int = PARTS, most: int = ROWS):
    """The events as a file stream: slices of time of at most ``parts`` files, several files a trigger, then one event far in the future.

    A file source reads files in the order of their modification times, so slices are written one after another.
    """
    base = f"{shared(spark)}/stream-{uuid.uuid4().hex}"
    rows = table(spark, sf_dir, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts"), "value")
    rows.withColumn("day", F.to_date("ts")).repartitionByRange("ts").write.partitionBy("day").parquet(f"{base}/ranged")
    ranged = spark.read.schema("user_id long, ts timestamp, value double, day date").parquet(f"{base}/ranged")
    days = ranged.groupBy("day").agg(F.count("*").alias("n")).orderBy("day").collect()  # days of the stream: few
    for day, n in days:
        of_day = ranged.filter(F.col("day") == F.lit(day))
        cuts = -(-n // most)
        slot = F.floor((F.hour("ts") * 3600 + F.minute("ts") * 60 + F.second("ts")) * cuts / 86400)
        for k in range(cuts):
            (of_day.filter(slot == k) if cuts > 1 else of_day).drop("day").repartitionByRange(parts, "ts").write.parquet(f"{base}/in/part={day}-{k}")
    spark.range(1).select(F.lit(-1).cast("long").alias("user_id"), F.expr(CLOSING).alias("ts"), F.lit(0.0).alias("value")).coalesce(1).write.parquet(f"{base}/in/part=9999-12-31")
    stream = spark.readStream.schema(rows.schema).option("recursiveFileLookup", True).option("maxFilesPerTrigger", files).parquet(f"{base}/in")
    return stream, base


@query("stream_tumbling_stats", """SELECT user_id, epoch_ms(epoch_ms(ts) // 86400000 * 86400000) AS start, count(*) AS n, round(avg(value) + 3e-8, 5) AS mean, round(max(value) - min(value), 5) AS ptp, CAST(0 AS BIGINT) AS n_dropped FROM events GROUP BY 1, 2""")
def stream_tumbling_stats(spark, sf_dir):
    stream, base = replay(spark, sf_dir)
    out, dropped = jobs.run_counted(jobs.stream_tumbling_stats(stream, "user_id", "ts", "value", "1 day", "1 hour"), f"{base}/out", f"{base}/check")
    return out.filter("user_id >= 0").select("user_id", F.col("start").cast("timestamp_ntz").alias("start"), "n", F.round(F.col("mean") + 3e-8, 5).alias("mean"), F.round("ptp", 5).alias("ptp"), F.lit(dropped).cast("long").alias("n_dropped"))


@query("stream_gap_sessions", """WITH g AS (SELECT user_id, ts, value, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 12 HOUR THEN 0 ELSE 1 END AS cut FROM events), s AS (SELECT *, sum(cut) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g)
SELECT user_id, min(ts) AS start, count(*) AS n, min(value) AS low, max(value) AS high FROM s GROUP BY user_id, k""")
def stream_gap_sessions(spark, sf_dir):
    stream, base = replay(spark, sf_dir)
    out = jobs.run_to_table(jobs.stream_gap_sessions(stream, "user_id", "ts", "value", "12 hours", "1 hour"), f"{base}/out", f"{base}/check")
    return out.filter("user_id >= 0").select("user_id", F.col("start").cast("timestamp_ntz").alias("start"), "n", "low", "high")


@query("stream_label_files", "SELECT user_id, count(*) FILTER (WHERE value >= 50) AS n_high, count(*) FILTER (WHERE value < 50) AS n_low FROM events GROUP BY user_id")
def stream_label_files(spark, sf_dir):
    stream, base = replay(spark, sf_dir)
    jobs.stream_label_files(stream, lambda df: df.withColumn("high", F.col("value") >= 50), f"{base}/out", f"{base}/check").awaitTermination()
    called = spark.read.parquet(f"{base}/out").filter("user_id >= 0")
    return called.groupBy("user_id").agg(F.sum(F.col("high").cast("long")).alias("n_high"), F.sum((~F.col("high")).cast("long")).alias("n_low"))


@query("stream_lowpass", """WITH RECURSIVE s AS (SELECT user_id, ts, value, row_number() OVER (PARTITION BY user_id ORDER BY ts) AS k FROM events), f AS (
  SELECT user_id, ts, k, value AS y FROM s WHERE k = 1 UNION ALL SELECT s.user_id, s.ts, s.k, 0.2e0 * s.value + 0.8e0 * f.y FROM f JOIN s ON s.user_id = f.user_id AND s.k = f.k + 1) SELECT user_id, ts, round(y + 0.0000003e0, 5) AS y FROM f""")
def stream_lowpass(spark, sf_dir):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        stream, base = replay(spark, sf_dir)
        out = jobs.run_to_table(jobs.stream_lowpass(stream, "user_id", "ts", "value", 0.2, "1 hour"), f"{base}/out", f"{base}/check")
    finally:
        spark.conf.set(key, before)
    return out.filter("user_id >= 0").select("user_id", F.col("ts").cast("timestamp_ntz").alias("ts"), F.round(F.col("y") + 0.0000003, 5).alias("y"))
