"""Pieces that several corpus operators share."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Sequence

from py4j.java_gateway import JavaObject
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed value: what counts as white space between words.
SPACE = r"[\x20\x09-\x0D]"
#: Fixed value: a word.
WORD = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors see (``spark.checkpoint.dir``).

    Only a session of one machine (master ``local``), as in tests, may name none and gets a folder of its own;
    on a cluster that is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        named = spark.sparkContext.getCheckpointDir()
    if not named:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors see")
        named = tempfile.mkdtemp(prefix="recsense-")
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def folder(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    """Hadoop's file system of a path, and the path for it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def parquet_options(hashes: Sequence[str] = ()) -> dict[str, str]:
    """How tables are packed: those of ``hashes`` quickly, because neither zstd nor a dictionary makes hashes smaller."""
    return {"compression": "lz4_raw" if hashes else "zstd"} | {f"parquet.enable.dictionary#{c}": "false" for c in hashes}


def written(df: DataFrame, name: str, hashes: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the lineage ends in files that outlive executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.options(**parquet_options(hashes)).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def discard(*frames: DataFrame) -> None:
    """Delete tables of :func:`written` whose successors are written, so nothing will read them again.

    Tables that a returned DataFrame still reads stay in the shared folder, whose owner clears it.
    """
    for frame in frames:
        files, at = folder(frame.sparkSession, frame.written_to)
        files.delete(at, True)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id's decimal text, modulo ``modulus``: the fold of a document (null ids: null)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(modulus)
