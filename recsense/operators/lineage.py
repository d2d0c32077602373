"""Stamps of inputs, review queues, roll-ups and flags over ledgers."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recsense.functions.columns import flag, ratio


def input_stamps(files: DataFrame, stage: str, label: str, content: str) -> DataFrame:
    """``stage, label, sha256, bytes, missing`` of each artifact a stage consumed; a null content is a missing file."""
    raw = F.col(content).cast("binary")
    return files.select(F.col(stage).alias("stage"), F.col(label).alias("label"), F.sha2(raw, 256).alias("sha256"), F.octet_length(raw).cast("long").alias("bytes"), raw.isNull().alias("missing"))


#: Bytes of a file that a digest reads at once.
CHUNK = 8 << 20


def digest_of(uri: str, chunk: int = CHUNK) -> tuple[str, int] | None:
    """SHA-256 and size of a file of any size, in pieces of ``chunk`` bytes; null if it is gone."""
    local = re.fullmatch("(?:file:)?/+(.*)", uri)  # names of local files come as they are, not as the rest of a URI
    system, path = (fs.LocalFileSystem(), "/" + local[1]) if local else fs.FileSystem.from_uri(uri)
    state, n = hashlib.sha256(), 0
    try:
        with system.open_input_stream(path) as stream:
            while piece := stream.read(chunk):
                state.update(piece)
                n += len(piece)
    except FileNotFoundError:
        return None
    return state.hexdigest(), n


def stamp_files(spark: SparkSession, inputs: list[tuple[str, str, str]], known: DataFrame | None = None, chunk: int = CHUNK) -> DataFrame:
    """Stamps of the files that stages consume: ``stage, label, path, sha256, bytes, mtime, missing``.

    ``inputs`` are (stage, label, file or folder); a folder gives a row for each file below it. What isn't there has a row that says
    ``missing``. Folders are listed without reading; ``known`` stamps of an earlier run are taken over where path, size and time
    are the same. The other files are dealt out singly, and an executor streams each in pieces, so
    size is no matter; the same file is read once however many stages name it. Spark's listing leaves out files of no bytes, so
    those have no row.
    """
    rows, lost = None, []
    for stage, label, path in inputs:
        try:
            found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select(F.lit(stage).alias("stage"), F.lit(label).alias("label"), "path", F.col("length").alias("bytes"), F.col("modificationTime").alias("mtime"))
        except AnalysisException:
            lost.append((stage, label, path))
            continue
        rows = found if rows is None else rows.unionByName(found)
    gone = spark.createDataFrame(lost, "stage string, label string, path string").select("*", F.lit(None).cast("string").alias("sha256"), F.lit(None).cast("long").alias("bytes"), F.lit(None).cast("timestamp").alias("mtime"), F.lit(True).alias("missing"))
    if rows is None:
        return gone
    files = rows.select("path", "bytes", "mtime").distinct()
    before = files.select("*", F.lit(None).cast("string").alias("sha256")).limit(0) if known is None else known.filter("not missing").select("path", "bytes", "mtime", "sha256").distinct()
    files = files.join(before, ["path", "bytes", "mtime"], "left")

    def digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path in batch["path"]:
                found = digest_of(path, chunk)
                yield pd.DataFrame({"path": [path], "read": [found and found[0]], "n": pd.array([found and found[1]], "Int64")})

    stale = files.filter("sha256 is null").select("path")
    fresh = stale.repartition(F.xxhash64("path")).mapInPandas(digests, "path string, read string, n long")
    joined = rows.join(files.select("path", "sha256"), "path").join(fresh, "path", "left")
    vanished = F.col("sha256").isNull() & F.col("read").isNull()
    done = joined.select("stage", "label", "path", F.coalesce("sha256", "read").alias("sha256"), F.when(~vanished, F.coalesce("n", "bytes")).alias("bytes"), F.when(~vanished, F.col("mtime")).alias("mtime"), vanished.alias("missing"))
    return done.unionByName(gone)


def stale_inputs(then: DataFrame, now: DataFrame) -> DataFrame:
    """What has become of the inputs since they were stamped: changed, deleted, appeared, unstamped."""
    t = then.select("stage", "label", F.col("sha256").alias("t_sha"), F.col("missing").alias("t_missing"), F.lit(True).alias("t"))
    n = now.select("stage", "label", F.col("sha256").alias("n_sha"), F.col("missing").alias("n_missing"), F.lit(True).alias("n"))
    there = F.col("n").isNotNull() & ~F.col("n_missing")
    what = F.when(F.col("t").isNull(), F.when(there, "unstamped")).when(F.col("t_missing"), F.when(there, "appeared")).when(~flag(there), "deleted").when(F.col("t_sha") != F.col("n_sha"), "changed")
    return t.join(n, ["stage", "label"], "full").select("stage", "label", what.alias("complaint")).filter("complaint is not null")


def exception_queue(quarantine: DataFrame, anomalies: DataFrame, drift: DataFrame) -> DataFrame:
    """One queue of what needs a look, with a stable reference: ``ref, cause, file, detail``."""
    item = lambda df, cause, detail: df.select(F.concat_ws(":", F.lit(cause), F.col("file").cast("string"), detail).alias("ref"), F.lit(cause).alias("cause"), F.col("file").cast("string").alias("file"), detail.alias("detail"))
    spread = anomalies.select("file", F.explode("conflicts").alias("axis"))
    return item(quarantine, "quarantine", F.col("category")).unionByName(item(spread, "axis", F.col("axis"))).unionByName(item(drift, "drift", F.col("verdict")))


def disposition(cause: str, action: str, handled: str) -> Column:
    """What is done with a queue item; whatever isn't listed is escalated."""
    c, a, h = F.col(cause), F.col(action), F.col(handled)
    return F.when(h, "closed").when((c == "quarantine") & (a == "drop"), "dropped").when((c == "axis") & (a == "accept"), "accepted").when((c == "drift") & (a == "watch"), "watched").otherwise("escalated")


def label_review_queue(trials: DataFrame, nominations: DataFrame) -> DataFrame:
    """Broken and divergent trials with their evidence and the spread of the contradiction.

    ``trials``: ``rev, trial, flag, band_flag, disagree_frac, t_first, t_last, bad_first, bad_last``;
    ``nominations``: ``rev, trial, t, evidence`` (at most a few per trial).
    """
    kind = F.when(F.col("flag"), "broken").when(F.col("band_flag"), "divergent")
    spread = ratio(F.col("bad_last") - F.col("bad_first"), F.col("t_last") - F.col("t_first"))
    picked = nominations.groupBy("rev", "trial").agg(F.sort_array(F.collect_list(F.struct((-F.col("evidence")).alias("e"), "t"))).alias("evidence"))
    rows = trials.select("rev", "trial", kind.alias("kind"), "disagree_frac", spread.alias("spread")).filter("kind is not null")
    return rows.join(picked, ["rev", "trial"], "left")


def segment_rollup(segments: DataFrame, file: str) -> DataFrame:
    """Files seen, usable and dropped segments, usable minutes, rows by method."""
    return segments.agg(
        F.countDistinct(file).alias("n_files"), F.count("*").alias("n_segments"), F.sum(F.col("usable").cast("long")).alias("n_usable"), F.sum((~F.col("usable")).cast("long")).alias("n_dropped"),
        F.coalesce(F.sum(F.when(F.col("usable"), F.col("duration_s"))), F.lit(0.0)).alias("usable_s"))


def dead_by_channel(dead: DataFrame) -> DataFrame:
    """How many segments each channel is dead in."""
    return dead.select(F.explode("dead_channels").alias("channel")).groupBy("channel").agg(F.count("*").alias("n_segments"))


def coverage_distribution(df: DataFrame, coverage: str, quantiles: list[float]) -> DataFrame:
    """Percentiles by index ``min(n - 1, floor(q n))``, not interpolated; of one value per file."""
    order = Window.orderBy(coverage)
    ranked = df.withColumn("__r", F.row_number().over(order) - 1).withColumn("__n", F.count("*").over(Window.partitionBy()))
    want = F.explode(F.array(*map(F.lit, quantiles)))
    rows = ranked.withColumn("q", want).filter(F.col("__r") == F.least(F.col("__n") - 1, F.floor(F.col("q") * F.col("__n"))))
    return rows.select("q", F.col(coverage).alias("coverage"))


def session_coverage(df: DataFrame, variant: str, session: str, coverage: str, low: float = 0.5) -> DataFrame:
    """Per variant: files, upper median of coverage, files under ``low`` and in how many sessions they are."""
    values = F.sort_array(F.collect_list(coverage))
    return df.groupBy(variant).agg(F.count("*").alias("n_files"), F.element_at(values, (F.floor(F.count("*") / 2) + 1).cast("int")).alias("upper_median"), F.sum((F.col(coverage) < low).cast("long")).alias("n_low"), F.countDistinct(F.when(F.col(coverage) < low, F.col(session))).alias("low_sessions"))


def operating_points(corpus: DataFrame, held_out: DataFrame) -> DataFrame:
    """Coverage of the corpus beside the held-out accuracy at the same threshold (4 decimals)."""
    other = held_out.select(F.round("threshold", 4).alias("__t"), "accuracy", "worst_accuracy")
    return corpus.withColumn("__t", F.round("threshold", 4)).join(other, "__t").drop("__t")


def variant_servability(files: DataFrame) -> DataFrame:
    """Files by variant: served, refused, unmapped."""
    return files.groupBy("variant").agg(F.count("*").alias("n_files"), F.sum(F.col("refusal").isNull().cast("long")).alias("n_served"), F.max(F.col("angle_axis").isNull()).alias("unmapped"))


def flag_rules(files: DataFrame, groups: DataFrame, variants: DataFrame, sealed: DataFrame) -> DataFrame:
    """Everything worth a warning: ``kind, title, detail``.

    Sealed accuracy below 0.95; spread of accuracy over groups above 0.05; three or more files under half
    coverage (a cluster if of one variant and at most four sessions); variants that aren't mapped.
    """
    rows = lambda df, kind, title, detail: df.select(F.lit(kind).alias("kind"), title.alias("title"), detail.alias("detail"))
    lock = rows(sealed.filter("accuracy < 0.95"), "sealed", F.lit("sealed subject below 0.95"), F.round("accuracy", 4).cast("string"))
    spread = groups.agg((F.max("accuracy") - F.min("accuracy")).alias("s")).filter("s > 0.05")
    wide = rows(spread, "spread", F.lit("accuracy differs between groups"), F.round("s", 4).cast("string"))
    low = files.filter("coverage < 0.5").agg(F.count("*").alias("n"), F.countDistinct("variant").alias("v"), F.countDistinct("session").alias("s")).filter("n >= 3")
    under = rows(low, "coverage", F.when((F.col("v") == 1) & (F.col("s") <= 4), "cluster of files under half").otherwise("files under half"), F.col("n").cast("string"))
    unmapped = rows(variants.filter("unmapped"), "variant", F.lit("variant is not mapped"), F.col("variant"))
    return lock.unionByName(wide).unionByName(under).unionByName(unmapped)


def corpus_counts(trials: DataFrame) -> DataFrame:
    """Trials, subjects, sealed, excluded, paired with a raw log."""
    one = lambda c: F.coalesce(F.sum(flag(c).cast("long")), F.lit(0))
    return trials.agg(F.count("*").alias("n_trials"), F.countDistinct("subject").alias("n_subjects"), one(F.col("split") == "lockbox").alias("n_sealed"), one(F.col("exclude")).alias("n_excluded"), one(F.col("raw").isNotNull()).alias("n_paired"))


def extract_json_text(text: Column, schema: str = "array<string>") -> Column:
    """What stands from the first ``[`` to the last ``]`` of a free text, parsed; null if it isn't of that type."""
    opening, closing = ("[", "]") if schema.startswith("array") else ("{", "}")
    part = F.regexp_extract(text, "(?s)\\" + opening + ".*\\" + closing, 0)
    return F.when(part != "", F.from_json(part, schema))
