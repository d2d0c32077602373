"""Device logs, annotated trials and manifests in; verdicts and ledgers out."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T



def scan_headers(spark: SparkSession, path: str) -> DataFrame:
    """``path, header``: the first line of each file, split; blank names at the end are dropped.

    A file's first line is the one of the split that starts at byte 0, so later splits are filtered out unread.
    """
    lines = spark.read.option("recursiveFileLookup", True).text(path).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("at"), "value", F.monotonically_increasing_id().alias("__id"))
    first = lines.filter("at = 0").groupBy("path").agg(F.min_by("value", "__id").alias("line"))
    names = F.transform(F.split(F.regexp_replace("line", "[\\s,]+$|^\\x{FEFF}", ""), ","), lambda x: F.trim(x))
    return first.select("path", names.alias("header"))


def scan_raw_csv(spark: SparkSession, path: str | list[str], names: list[str], strings: tuple[str, ...] = ()) -> DataFrame:
    """Raw logs of one header variant, whole width, columns by name, all doubles but ``strings``; ``path`` and ``row_idx`` added.

    ``names`` is the variant's header as :func:`scan_headers` gives it; a trailing comma becomes a column that is
    dropped, so it can't shift the others. Row numbers follow from the splits' row counts, without a sort.
    """
    clean = [n if n else f"__blank{k}" for k, n in enumerate(names)]
    schema = T.StructType([T.StructField(n, T.StringType() if n in strings else T.DoubleType()) for n in [*clean, "__tail"]])
    rows = spark.read.schema(schema).option("header", True).option("enforceSchema", True).option("recursiveFileLookup", True).csv(path)
    kept = [c for c in clean if not c.startswith(("__blank", "Unnamed"))]
    rows = rows.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("__at"), F.monotonically_increasing_id().alias("__id"), *kept)
    return numbered(rows).toDF(*["path", "row_idx"], *[c.strip() for c in kept])


def numbered(rows: DataFrame) -> DataFrame:
    """``path, row_idx, ...``: rows of each file numbered in order from (split start, running id)."""
    from pyspark.sql import Window

    splits = rows.groupBy("path", "__at").agg(F.min("__id").alias("__first"), F.count("*").alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.partitionBy("path").orderBy("__at").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    splits = splits.withColumn("__offset", before).drop("__n")
    joined = rows.join(splits, ["path", "__at"])
    out = joined.withColumn("row_idx", F.col("__offset") + F.col("__id") - F.col("__first"))
    return out.select("path", "row_idx", *[c for c in rows.columns if not c.startswith("__") and c != "path"])


def scan_annotated(spark: SparkSession, path: str, wanted: list[str]) -> DataFrame:
    """Annotated trials: header names are stripped and the wanted columns taken by name; missing ones are an error."""
    rows = spark.read.option("header", True).option("recursiveFileLookup", True).csv(path)
    rows = rows.select("*", F.col("_metadata.file_path").alias("path"))
    rows = rows.toDF(*[c.strip() for c in rows.columns])
    if missing := [c for c in wanted if c not in rows.columns]:
        raise ValueError(f"missing columns: {missing}")
    return rows.select("path", *[F.col(c).try_cast("int" if c == "Label" else "double").alias(c) for c in wanted])


def scan_manifest(spark: SparkSession, path: str, fields: str, schema: int = 1, lines: bool = False) -> DataFrame:
    """Trials of JSON manifests, with the columns ``fields`` (null where a trial lacks one); another schema version is an error.

    A manifest is a file, or with ``lines`` a line of one. Without manifests there are no trials.
    """
    whole = spark.read.option("multiLine", not lines).option("recursiveFileLookup", True).schema(f"schema int, trials array<struct<{fields}>>").json(path)
    found = whole.filter(~F.col("schema").eqNullSafe(F.lit(schema))).select("schema").first()
    if found:
        raise ValueError(f"manifest schema {found[0]}, not {schema}")
    return whole.select(F.explode("trials").alias("t")).select("t.*")


def listing(spark: SparkSession, path: str) -> DataFrame:
    """``path, size, mtime`` of the files under a folder, without reading them."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", F.col("length").alias("size"), F.col("modificationTime").alias("mtime"))


class Transcoded:
    """A versioned table of raw logs in Parquet under a folder: immutable parts, and manifests that say which of them are valid.

    A raw file is (path, size, mtime). Its rows lie in the part that read it, under a key hashed from all three, so files of
    equal names in different sessions, or an older state of the same file, never meet. A snapshot is a manifest
    ``v<number>`` with a line per raw file; it is written under another name and put in place by one rename, so a reader sees the old
    snapshot or the new one, and a run that fails leaves at most a part that no manifest names. Of two writers
    that start from the same snapshot the second fails at the rename and changes nothing.
    """

    #: Names of a manifest's columns.
    MANIFEST = "path string, size long, mtime timestamp, key string, part string"

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _files(self):
        at = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()), lambda name: self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")

    def version(self) -> int:
        """The newest snapshot's number, 0 without any."""
        files, at = self._files()
        names = [s.getPath().getName() for s in files.listStatus(at(""))] if files.exists(at("")) else []
        return max((int(n[1:]) for n in names if n[:1] == "v" and n[1:].isdigit()), default=0)

    def manifest(self, version: int | None = None) -> DataFrame:
        """The raw files of a snapshot (the newest), with the part that holds each."""
        version = self.version() if version is None else version
        if not version:
            return self.spark.createDataFrame([], self.MANIFEST)
        return self.spark.read.schema(self.MANIFEST).parquet(f"{self.folder}/v{version}")

    def refresh(self, raw: str, names: list[str]) -> int:
        """Take over the state of the folder ``raw``, reading only files that are new or changed; gives how many those are.

        Only stale paths are handed to the reader, unchanged ones are not opened. Files that are gone leave the
        snapshot. Paths of stale files come to the driver, which lists files anyway.
        """
        files, at = self._files()
        before = self.version()
        now = listing(self.spark, raw).withColumn("key", F.sha1(F.concat_ws("|", "path", F.col("size").cast("string"), F.unix_micros("mtime").cast("string"))))
        known = self.manifest(before).select("key", "part")
        lines = now.join(known, "key", "left").select("path", "size", "mtime", "key", "part")
        stale = [(r["path"], r["key"]) for r in lines.filter("part is null").select("path", "key").collect()]
        part = f"part=p{before + 1}-{uuid.uuid4().hex}"
        if stale:
            keys = self.spark.createDataFrame(stale, "path string, key string")
            rows = scan_raw_csv(self.spark, [p for p, _ in stale], names).join(keys, "path")
            rows.write.option("compression", "zstd").parquet(f"{self.folder}/{part}")
        new = self.manifest(0).union(lines.withColumn("part", F.coalesce("part", F.lit(part))).select("path", "size", "mtime", "key", "part"))
        name = f".v{before + 1}-{uuid.uuid4().hex}"
        new.coalesce(1).write.parquet(f"{self.folder}/{name}")
        if files.exists(at(f"v{before + 1}")) or not files.rename(at(name), at(f"v{before + 1}")):
            files.delete(at(name), True)
            raise RuntimeError(f"another writer has made v{before + 1}")
        return len(stale)

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a snapshot: of each part those of the files that the manifest still gives to it."""
        lines = self.manifest(version)
        parts = [r["part"] for r in lines.select("part").distinct().collect()]
        if not parts:
            raise ValueError("no snapshot has a file")
        rows = self.spark.read.option("basePath", self.folder).parquet(*[f"{self.folder}/{p}" for p in sorted(parts)])
        return rows.join(lines.select("key"), "key", "left_semi").drop("part")

    def vacuum(self, keep: int = 1) -> list[str]:
        """Delete manifests before the newest ``keep`` and parts that none of those names; not while others read or write."""
        files, at = self._files()
        newest = self.version()
        used = {r["part"] for v in range(max(1, newest - keep + 1), newest + 1) for r in self.manifest(v).select("part").distinct().collect()}
        names = [s.getPath().getName() for s in files.listStatus(at(""))]
        old = [n for n in names if (n.startswith("part=") and n not in used) or (n[:1] == "v" and n[1:].isdigit() and int(n[1:]) <= newest - keep) or n.startswith(".v")]
        for n in old:
            files.delete(at(n), True)
        return sorted(old)


def transcode_cache(spark: SparkSession, raw: str, cache: str, names: list[str]) -> int:
    """Bring the transcoded table under ``cache`` up to date with ``raw``; how many files were read."""
    return Transcoded(spark, cache).refresh(raw, names)


def write_verdicts(df: DataFrame, path: str, session: str, file: str, fmt: str = "parquet") -> None:
    """Verdicts under ``session=.../file=...``."""
    df.write.mode("overwrite").partitionBy(session, file).format(fmt).save(path)


def write_ledger(df: DataFrame, path: str) -> None:
    """A ledger as JSON lines; an empty one is written too (a file without rows), because empty isn't missing."""
    (df.coalesce(1) if df.isEmpty() else df).write.mode("overwrite").json(path)
