"""Removal of phrases that earlier documents hold, by a log-structured index of window fingerprints."""

from __future__ import annotations

import json
import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .byte_dedup import _SPANS, spans_of
from .common import discard, folder, parquet_options, shared_dir, written
from .repeats import HASHES, INDEX, Deal, Shape, dealt, finish, hashed_deal, keyed, over_boundaries, scan_blocks, sorted_pass

#: Words of a window.
WINDOW = 13
#: The anchor of a window lies at its first ANCHORS words and is chosen by GRAM words, longest first.
GRAM, ANCHORS = 3, 11
#: Batches of ascending ids in which a table is put into the index, and runs of a level that are compacted into one.
BATCHES, FAN = 3, 2

#: Buckets that a frequent fingerprint is spread over, and one for its blocks from before it was frequent.
SLOTS = 9

RUN = "common long, slot int, whole long, doc long, sides long"


def word_codes(texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Hashes of the words (of bytes, split at [\\x20\\x09-\\x0D]) and their lengths."""
    digest = xxhash.xxh64_digest
    codes, lengths = [], []
    for text in texts:
        words = text.encode().split()
        codes.append(np.frombuffer(b"".join(map(digest, words)), ">u8").astype(np.uint64))
        lengths.append(np.minimum(np.fromiter(map(len, words), np.int64, len(words)), 80))
    return codes, lengths


def cut_words(text: str, covered: np.ndarray | None) -> tuple[int, list[dict[str, int]], str]:
    words = text.encode().split()
    spans = [] if covered is None else spans_of(covered)
    if spans:
        words_kept = [w for w, gone in zip(words, covered.tolist(), strict=True) if not gone]
    else:
        words_kept = words
    return len(words), spans, b" ".join(words_kept).decode()


class FingerprintIndex:
    """A log-structured index of the windows of documents seen so far, in a folder that any later job can open.

    It is a list of immutable runs in levels; a run is a table ``(common, slot, whole, doc, sides)``: each block of windows
    that no older run holds, with its smallest id. All runs lie in the same ``buckets`` of (common, slot), one sorted file each, so
    :meth:`add` merge-joins a batch with the history where that lies: only the batch's keys, and the blocks that meet one of
    them, are shuffled, never the history. ``slot`` is 0 but for fingerprints that were too frequent for one range
    when their block came: those are spread over SLOTS buckets. The new blocks become a run of level 0. When a level
    has ``fan`` runs, they are compacted bucket by bucket, without a shuffle, into one run of the next level, so n
    batches leave about log n runs and a block is rewritten about log n times. The newest complete manifest names the valid
    runs, the number of buckets (fixed when the index begins; by default the shuffle partitions) and the frequent
    fingerprints (HEAVY a range and batch at most); it is put in place by a rename, so a job that is lost leaves the
    index as it was.

    Batches have to come in the order of their ids. Null text has no words, a null id comes after all ids, rows that repeat an
    id are one document; an empty batch says nothing and adds an empty run.
    """

    def __init__(self, spark: SparkSession, path: str, shape: Shape, fan: int = FAN, buckets: int | None = None):
        self.spark, self.path, self.shape, self.fan = spark, path.rstrip("/"), shape, fan
        self.version, self.runs, self.heavy = 0, [], []
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        #: Tables that :meth:`add`'s answers still read.
        self.spent: list[DataFrame] = []
        files, at = folder(spark, self.path)
        found = sorted(f.getPath().getName() for f in files.listStatus(at)) if files.exists(at) else []
        if names := [n for n in found if n.startswith("manifest-")]:
            self.version = int(names[-1].removeprefix("manifest-"))
            said = json.loads(spark.read.text(f"{self.path}/{names[-1]}").collect()[0][0])
            if said.get("columns") != RUN:
                raise ValueError(f"the runs of the index {self.path} have other columns than {RUN}; it has to be built again")
            self.buckets, self.heavy = said["buckets"], said["heavy"]
            self.runs = [(level, name) for level, name in said["runs"]]

    def _commit(self, runs: list[tuple[int, str]], heavy: list[int]) -> None:
        self.version += 1
        files, at = folder(self.spark, f"{self.path}/manifest-{self.version:09d}")
        draft = folder(self.spark, f"{self.path}/draft-{uuid.uuid4().hex}")[1]
        out = files.create(draft)
        out.write(bytearray(json.dumps({"columns": RUN, "buckets": self.buckets, "heavy": heavy, "runs": runs}).encode()))
        out.close()
        if not files.rename(draft, at):
            raise RuntimeError(f"another job has changed the index {self.path}")
        gone = [name for _, name in self.runs if name not in {n for _, n in runs}]
        self.runs, self.heavy = runs, heavy
        for name in gone:
            files.delete(folder(self.spark, f"{self.path}/{name}")[1], True)

    def _write(self, blocks: DataFrame) -> str:
        """A run of ``blocks``, which should come in the partitions of the buckets."""
        name, table_name = f"run-{uuid.uuid4().hex}", f"run_{uuid.uuid4().hex}"
        table = blocks.select("common", "slot", "whole", "doc", "sides").write.format("parquet").options(**parquet_options(HASHES))
        table.bucketBy(self.buckets, "common", "slot").sortBy("common", "slot", "whole").option("path", f"{self.path}/{name}").saveAsTable(table_name)
        self.spark.sql(f"DROP TABLE {table_name}")  # an external table: its files stay
        return name

    def read(self, runs: list[tuple[int, str]] | None = None) -> DataFrame | None:
        """The blocks of these runs, of all valid ones if none are given, in their buckets; None where there is none."""
        out = None
        for _, name in self.runs if runs is None else runs:
            known, at = f"open_{uuid.uuid4().hex}", f"{self.path}/{name}".replace("\\", "\\\\").replace("'", "\\'")
            self.spark.sql(f"CREATE TABLE {known} ({RUN}) USING parquet CLUSTERED BY (common, slot) SORTED BY (common, slot, whole) INTO {self.buckets} BUCKETS LOCATION '{at}'")
            run = self.spark.table(known)
            self.spark.sql(f"DROP TABLE {known}")
            out = run if out is None else out.unionByName(run)
        return out

    def _slotted(self, keys: DataFrame, slots: Column) -> DataFrame:
        return keys.withColumn("slot", F.explode(F.when(F.col("common").isin(self.heavy), slots).otherwise(F.array(F.lit(0)))))

    def meeting(self, rows: DataFrame) -> DataFrame | None:
        """The blocks of the history that agree in ``common`` with one of ``rows``; None where there is no history."""
        history = self.read()
        if history is None:
            return None
        keys = self._slotted(rows.select("common"), F.sequence(F.lit(0), F.lit(SLOTS - 1))).groupBy("common", "slot").agg(F.lit(1).alias("one"))
        met = history.join(keys, ["common", "slot"], "left_semi")
        return met.select("common", "whole", "doc", "sides", F.lit(1).cast("long").alias("n"), F.lit(True).alias("old"))

    def add(self, texts: DataFrame, keep: bool = True) -> DataFrame:
        """``(whole, doc, kind)`` for the batch ``(doc, text)``; unless ``keep``, the index stays as it is.

        Null texts, repeated ids and empty batches: see the class.
        """
        nothing = Deal(np.zeros(0, np.int64), np.zeros(0, np.int64))
        tables = [written(scan_blocks(texts, word_codes, self.shape, nothing), "index-batch", HASHES)]
        met = self.meeting(tables[0])
        rows = tables[0]
        if met is not None:
            tables.append(written(met, "index-met", HASHES))
            rows = rows.unionByName(tables[1])
        deal = hashed_deal(rows)
        merged = written(sorted_pass(dealt(rows, deal), deal, by_count=False, index=keep), "index-merge", HASHES)
        discard(*tables)
        self.spent.append(merged)
        rest = over_boundaries(merged.filter("kind = 0"), by_count=False, index=keep)
        said = merged.filter("kind > 0").select("common", "whole", "doc", "kind", "sides").unionByName(rest, allowMissingColumns=True)
        if keep:
            self.heavy = sorted({*self.heavy, *deal.heavy.tolist()})
            spread = F.array((F.pmod(F.col("whole"), F.lit(SLOTS - 1)) + 1).cast("int"))
            new = self._slotted(said.filter(F.col("kind").bitwiseAND(INDEX) > 0), spread)
            self._commit([*self.runs, (0, self._write(new.repartition(self.buckets, "common", "slot")))], self.heavy)
            self.compact()
        return said.filter(f"kind != {INDEX}").select("whole", "doc", "kind")

    def merged(self, runs: list[tuple[int, str]]) -> DataFrame:
        """The blocks of several runs as one, bucket by bucket."""
        return self.read(runs).groupBy("common", "slot", "whole").agg(F.min("doc").alias("doc"), F.min("sides").alias("sides"))

    def compact(self) -> None:
        """Merge the runs of each level that has ``fan`` of them, from the lowest."""
        level = 0
        while any(a >= level for a, _ in self.runs):
            own = [r for r in self.runs if r[0] == level]
            if len(own) >= self.fan:
                self._commit([*(r for r in self.runs if r not in own), (level + 1, self._write(self.merged(own)))], self.heavy)
            level += 1

    def clear(self) -> None:
        files, at = folder(self.spark, self.path)
        files.delete(at, True)


def repeated_phrases(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", window: int = WINDOW, gram: int = GRAM, anchors: int = ANCHORS, batches: int = BATCHES, index: str | None = None, history: DataFrame | None = None) -> DataFrame:
    """One row per document: ``doc_id, n_words, spans, kept`` (removed ranges of words, and the text that stays).

    A word is removed if a window of ``window`` words that covers it also starts in a document with a smaller
    id; all is judged on the input. The table goes into a :class:`FingerprintIndex` in batches of ascending
    ids: the merge finds equal fingerprints, and windows are compared where blocks agree only in part.

    ``index`` names the folder of an index that stays: documents of earlier calls count as well, and these are added.
    The index holds fingerprints only, so ``history`` has to give the earlier documents (same columns) from which
    those that share a part of a block are read again. Without a name the index is cleared after the merge.

    Null text has no words. Rows that repeat an id are one document as far as smaller ids go; a null id comes after
    all ids. An empty table gives no rows.
    """
    shape = Shape(window, gram, anchors)
    texts = keyed(docs, text, doc_id)
    shares = [k / batches for k in range(1, batches)]
    marks = texts.agg(F.percentile_approx("doc", shares, 10_000)).first()[0] or [] if shares else []
    bounds = [None, *sorted(set(marks)), None]
    spark = docs.sparkSession
    runs = FingerprintIndex(spark, index or f"{shared_dir(spark)}/index-{uuid.uuid4().hex}", shape)
    said = None
    for k, (low, high) in enumerate(zip(bounds, bounds[1:], strict=False)):
        batch = texts
        if low is not None:
            batch = batch.filter(F.col("doc") > low)
        if high is not None:
            batch = batch.filter(F.col("doc") <= high)
        part = runs.add(batch, keep=index is not None or k < len(bounds) - 2)
        said = part if said is None else said.unionByName(part)
    said = written(said, "index-blocks")
    discard(*runs.spent)
    if index is None:
        runs.clear()
    fields = [("n_words", pa.int64()), ("spans", _SPANS), ("kept", pa.string())]
    earlier = None if history is None else keyed(history, text, doc_id)
    return finish(texts, said, False, word_codes, shape, cut_words, fields, "n_words long, spans array<struct<start: long, end: long>>, kept string", earlier)
