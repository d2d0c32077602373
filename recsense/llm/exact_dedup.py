"""Exact deduplication by content sort, in DataFrame operations alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, written

#: Ways in which the range partitioner may split one content.
SALTS = 64
#: Characters of a content that the splitters see.
HEAD = 32
#: What one character of length weighs against all ids: more than there are of them.
STEP = "36893488147419103232"


def normalised(text: Column) -> Column:
    """The text without white space (null: empty)."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, "")


def _order(text: Column, doc_id: Column) -> Column:
    """One number that is greatest for the longest text and then the smallest id (a null id: below all ids)."""
    length = F.length(F.coalesce(text, F.lit(""))).cast("decimal(38,0)")
    back = F.when(doc_id.isNull(), F.lit(0)).otherwise(F.lit("9223372036854775808").cast("decimal(38,0)") - doc_id.cast("decimal(38,0)"))
    return (length * F.lit(STEP).cast("decimal(20,0)")).cast("decimal(38,0)") + back.cast("decimal(38,0)")


def contents(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", salts: int = SALTS) -> DataFrame:
    """``(doc_id, content, text_sha256, head, hash, salt, best)`` of every document, written: texts are normalised once."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), normalised(F.col(text)).alias("content"), _order(F.col(text), F.col(doc_id)).alias("best"))
    lead = [F.substring("content", 1, HEAD).alias("head"), F.xxhash64("content").alias("hash"), F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int").alias("salt")]
    return written(rows.select("doc_id", "content", F.sha2("content", 256).alias("text_sha256"), *lead, "best"), "exact-contents")


def content_runs(rows: DataFrame) -> DataFrame:
    """``(text_sha256, size, best)`` for each run of equal contents in each range of the sorted :func:`contents`.

    Spark samples the splitters of the range partitioning over (first characters, hash, salt), so that the
    sample stays small however long the texts are (it reads these columns alone); inside a range the rows are
    sorted externally, equals become neighbours, and the window compares whole neighbouring contents. The salt
    lets a content with a large share of all rows spread over many ranges, so the runs of one content are summed
    up afterwards (:func:`groups`), across the range boundaries.
    """
    lead = ["head", "hash", "salt"]
    ranged = rows.select(*lead, "content", "text_sha256", "best").repartitionByRange(*lead)
    # this range partitioning satisfies the window's distribution: no further exchange
    run = Window.partitionBy(*lead, "content").orderBy("best")
    last = ranged.withColumn("size", F.row_number().over(run).cast("long")).withColumn("more", F.lead(F.lit(1)).over(run)).filter(F.col("more").isNull())
    return last.select("text_sha256", "size", "best")


def groups(runs: DataFrame) -> DataFrame:
    """One row per content: ``text_sha256, group_size, keep_id``."""
    per = runs.groupBy("text_sha256").agg(F.sum("size").alias("group_size"), F.max("best").alias("best"))
    back = F.col("best") % F.lit(STEP).cast("decimal(20,0)")
    keep = F.when(back > 0, (F.lit("9223372036854775808").cast("decimal(20,0)") - back).cast("long"))
    return per.select("text_sha256", "group_size", keep.alias("keep_id"))


def exact_dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", salts: int = SALTS) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical without white space. Of equals the longest original stays, then the
    smallest id. Null text counts as empty; empty texts are equal to each other. Rows that repeat an id
    share its decision; a null id stays only where its group has no other. An empty table gives no rows.
    """
    rows = contents(docs, text, doc_id, salts)
    kept = groups(content_runs(rows)).withColumnRenamed("text_sha256", "of_sha256")
    joined = rows.select("doc_id", "text_sha256").join(kept, F.col("text_sha256") == F.col("of_sha256"))
    return joined.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")
