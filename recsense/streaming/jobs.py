"""Structured Streaming jobs for logs that keep arriving; each also runs over a finished folder (available now)."""

from __future__ import annotations

import math
import pickle
import time
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def stream_gap_sessions(rows: DataFrame, rec: str, ts: str, value: str, gap: str, late: str) -> DataFrame:
    """Segments of arriving samples, cut at a fixed gap (the whole recording's median can't be known yet)."""
    per = rows.withWatermark(ts, late).groupBy(rec, F.session_window(ts, gap).alias("w")).agg(F.count("*").alias("n"), F.min(value).alias("low"), F.max(value).alias("high"))
    return per.select(rec, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n", "low", "high")


def stream_tumbling_stats(rows: DataFrame, rec: str, ts: str, value: str, width: str, late: str) -> DataFrame:
    """Count, mean, population std and range per recording and window; rows behind the watermark are dropped, and :func:`run_counted` counts them."""
    per = rows.withWatermark(ts, late).groupBy(rec, F.window(ts, width).alias("w")).agg(F.count("*").alias("n"), F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"), (F.max(value) - F.min(value)).alias("ptp"))
    return per.select(rec, F.col("w.start").alias("start"), "n", "mean", "std", "ptp")


def stream_label_files(files: DataFrame, label: Callable[[DataFrame], DataFrame], out: str, checkpoint: str):
    """Label newly landed files once each: a batch's verdicts go to a folder of its own, which a repeated batch replaces."""

    def batch(df: DataFrame, number: int) -> None:
        label(df).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return files.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def recursion(x: np.ndarray, before: float | None, weight: float) -> np.ndarray:
    """y = a x + (1 - a) y before, from ``before`` (none: y0 = x0), by running sums over blocks so short that the weights stay finite."""
    out = np.empty(len(x))
    block = max(1, int(230 / -math.log1p(-weight)))
    for at in range(0, len(x), block):
        part = weight * x[at : at + block]
        if before is None:
            part[0], before = x[at], 0.0
        i = np.arange(len(part))
        fade = (1 - weight) ** i
        out[at : at + block] = fade * np.cumsum(part / fade) + (1 - weight) ** (i + 1) * before
        before = out[at + len(part) - 1]
    return out


#: Rows that the filter gives out at once.
CHUNK = 10_000


def lowpass_step(weight: float, rec: str, x: str) -> Callable:
    """y = a x + (1 - a) y before, per recording, in the order of event time; y0 = x0. A key of the state is a bucket of recordings.

    Rows (with ``__us``, their time in microseconds) wait in the state until the watermark has passed them; by then all rows up to it
    are there, whatever files they came in. They are sorted, filtered from their recording's last y on and given out, at the bucket's next
    rows or, if none come, by a timer at the earliest that waits. So the state holds one y per recording and what arrived within the watermark's delay,
    however long a recording is. Rows behind the watermark come too late for their place; Spark drops them before this, and
    :class:`Dropped` counts them.
    """

    def step(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, held = pickle.loads(state.get[0]) if state.exists else ({}, [])
        waiting = held if state.hasTimedOut else [*held, *((p[rec].to_numpy(), p["__us"].to_numpy(), p[x].to_numpy(float)) for p in parts)]
        recs, us, values = (np.concatenate(c) for c in zip(*waiting, strict=True))
        due = us <= state.getCurrentWatermarkMs() * 1000
        codes, names = pd.factorize(recs[due], use_na_sentinel=False)
        order = np.lexsort((us[due], codes))
        times, samples, y = us[due][order], values[due][order], np.empty(len(order))
        counts = np.bincount(codes, minlength=len(names))
        ends = np.cumsum(counts)
        for name, a, b in zip(names, ends - counts, ends, strict=True):
            one = None if pd.isna(name) else name
            y[a:b] = recursion(samples[a:b], last.get(one), weight)
            last[one] = float(y[b - 1])
        left = [(recs[~due], us[~due], values[~due])] if not due.all() else []
        state.update((pickle.dumps((last, left)),))
        if left:
            state.setTimeoutTimestamp(int(-(-us[~due].min() // 1000)))
        for at in range(0, len(y), CHUNK):
            yield pd.DataFrame({rec: names[codes[order][at : at + CHUNK]], "__us": times[at : at + CHUNK], "y": y[at : at + CHUNK]})

    return step


def stream_lowpass(rows: DataFrame, rec: str, ts: str, x: str, weight: float, late: str = "0 seconds", buckets: int = 64) -> DataFrame:
    """The causal filter over rows that arrive in any order within ``late``; a state store on disk (RocksDB) keeps memory bounded, any does.

    Recordings share ``buckets`` keys of the state, because every key costs some ms a batch; as many tasks can work at once.
    """
    kind = dict(rows.dtypes)
    timed = rows.withColumns({"__us": F.unix_micros(F.col(ts).cast("timestamp")), "__bucket": F.pmod(F.xxhash64(rec), F.lit(buckets))}).withWatermark(ts, late)
    out = timed.groupBy("__bucket").applyInPandasWithState(lowpass_step(weight, rec, x), f"{rec} {kind[rec]}, __us long, y double", "held binary", "append", GroupStateTimeout.EventTimeTimeout)
    return out.select(rec, F.timestamp_micros("__us").cast(kind[ts]).alias(ts), "y")


class Dropped(StreamingQueryListener):
    """A ledger of what state operators drop because it comes behind the watermark: ``batches`` by query name, run and number.

    A filter or a session counts rows. An aggregation counts after its first step: rows of one task, window and recording are one.
    """

    def __init__(self) -> None:
        self.batches: dict[tuple[str, str, int], int] = {}
        self.ended: set[str] = set()

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        self.batches[p.name or "", str(p.runId), p.batchId] = sum(op.numRowsDroppedByWatermark for op in p.stateOperators)

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self.ended.add(str(event.runId))

    def total(self, run: str, patience: float = 30.0) -> int:
        """All that a finished run has dropped; its last events may still be on their way."""
        until = time.time() + patience
        while run not in self.ended and time.time() < until:
            time.sleep(0.05)
        return sum(n for (_, r, _), n in self.batches.items() if r == run)


def run_counted(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> tuple[DataFrame, int]:
    """As :func:`run_to_table`, and how much was dropped behind the watermark."""
    spark, ledger = stream.sparkSession, Dropped()
    spark.streams.addListener(ledger)
    try:
        query = stream.writeStream.format("parquet").outputMode(mode).option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        run = str(query.runId)
        query.awaitTermination()
        return spark.read.parquet(path), ledger.total(run)
    finally:
        spark.streams.removeListener(ledger)


def run_to_table(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """Run a stream over what is there into Parquet, and read that."""
    stream.writeStream.format("parquet").outputMode(mode).option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return stream.sparkSession.read.parquet(path)
