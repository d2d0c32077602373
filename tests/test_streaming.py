"""Streams run over many batches and carry their state from one to the next."""

import datetime
import os
import random

import numpy as np
import pytest

from recsense.plans import streaming
from recsense.streaming import jobs

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_replay_runs_in_many_batches_in_time_order(spark):
    stream, base = streaming.replay(spark, SF)
    ends = []
    stream.writeStream.foreachBatch(lambda df, n: ends.append(df.selectExpr("min(ts)", "max(ts)", "count(*)", "count(distinct user_id)").first())).option("checkpointLocation", f"{base}/c").trigger(availableNow=True).start().awaitTermination()
    assert len(ends) >= 20 and sum(e[2] for e in ends) == spark.read.parquet(f"{SF}/events.parquet").count() + 1
    assert all(a[1] <= b[0] for a, b in zip(ends, ends[1:], strict=False))


@pytest.fixture
def rocks(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    yield spark
    spark.conf.set(key, before)


def landed(spark, path, batches):
    """One file a batch, in order of landing; an event at the end of time comes last."""
    schema = "rec long, ts timestamp, x double"
    for k, rows in enumerate([*batches, [(-1, datetime.datetime(2100, 1, 1), 0.0)]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{path}/in/part={k:04d}")
        for f in os.listdir(f"{path}/in/part={k:04d}"):
            os.utime(f"{path}/in/part={k:04d}/{f}", (1_700_000_000 + k, 1_700_000_000 + k))
    return spark.readStream.schema(schema).option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")


def at(second):
    return datetime.datetime(2025, 1, 1) + datetime.timedelta(seconds=second)


def test_shuffled_files_within_the_watermark_equal_the_batch_filter(rocks, tmp_path):
    rng = random.Random(7)
    rows = [(rec, at(k + rec / 10), float(rng.gauss(0, 1))) for rec in (1, 2) for k in range(120)]
    late = sorted(rows, key=lambda r: r[1].timestamp() + rng.uniform(0, 25))  # at most 25 s out of order
    stream = landed(rocks, str(tmp_path), [late[k : k + 16] for k in range(0, len(late), 16)])
    out = jobs.run_to_table(jobs.stream_lowpass(stream, "rec", "ts", "x", 0.2, "30 seconds"), f"{tmp_path}/out", f"{tmp_path}/check")
    got = {(r.rec, r.ts): r.y for r in out.filter("rec > 0").collect()}
    assert len(got) == len(rows)
    for rec in (1, 2):
        y = None
        for _, t, x in sorted(r for r in rows if r[0] == rec):
            y = x if y is None else 0.2 * x + 0.8 * y
            assert got[rec, t] == pytest.approx(y, abs=1e-9)


def test_recordings_share_keys_of_the_state_and_do_not_wait_for_each_other(rocks, tmp_path):
    rows = [(rec, at(60 * k + rec / 1000), float(rec + k)) for k in range(3) for rec in range(150)]
    stream = landed(rocks, str(tmp_path), [rows[:150], rows[150:300], rows[300:]])
    query = jobs.stream_lowpass(stream, "rec", "ts", "x", 0.5, "30 seconds").writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/check").trigger(availableNow=True).start()
    query.awaitTermination()
    assert 0 < max(op["numRowsTotal"] for p in query.recentProgress for op in p["stateOperators"]) <= 64
    got = {(r.rec, r.ts): r.y for r in rocks.read.parquet(f"{tmp_path}/out").filter("rec >= 0").collect()}  # the closing event shares a key with some
    want = {(rec, at(60 * k + rec / 1000)): y for rec in range(150) for k, y in enumerate([rec, rec + 0.5, rec + 1.25])}
    assert got == pytest.approx(want)


def test_late_rows_are_dropped_and_counted(spark, tmp_path):
    ahead = [(rec, at(1000 + rec), 1.0) for rec in range(3)]
    behind = [(rec, at(10), 9.0) for rec in range(5)]  # five groups, an hour's window that is closed by then
    stream = landed(spark, str(tmp_path), [[(0, at(5), 1.0)], [(r, t + datetime.timedelta(hours=3), x) for r, t, x in ahead], [(0, at(3 * 3600 + 1200), 2.0)], behind])
    out, dropped = jobs.run_counted(jobs.stream_tumbling_stats(stream, "rec", "ts", "x", "1 hour", "1 minute"), f"{tmp_path}/out", f"{tmp_path}/check")
    assert dropped == 5
    assert {(r.rec, r.n) for r in out.filter("rec >= 0").collect()} == {(0, 1), (0, 2), (1, 1), (2, 1)}


@pytest.mark.parametrize("weight", [0.001, 0.2, 0.999])
def test_recursion_equals_a_loop(weight):
    x = np.random.default_rng(2).normal(size=3000)
    for before in (None, 0.7):
        y, want = before, []
        for v in x:
            y = v if y is None else weight * v + (1 - weight) * y
            want.append(y)
        assert np.allclose(jobs.recursion(x, before, weight), want, atol=1e-12)
