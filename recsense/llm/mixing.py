"""Mix sources to target weights: repetition rates per source, whole copies plus one seeded Bernoulli copy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, written

#: Weights of the sources in code point order, repeating.
WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2.0
SEED = "mix-1"


def n_words(text: Column) -> Column:
    """Number of words (null text: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """``(source, size)`` rows -> one row per source with ``source_size`` and ``target``.

    Targets share ``share`` times the total by weight, and stop at ``cap`` times their source's size; the
    excess goes to the others by weight. With sources ordered by size / weight, the level at which a unit
    of weight ends is the greatest of (what is left) / (weight left), so no iteration is needed.
    A source of size 0 gets target 0; the null source is a source like any other and comes last.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    named = Window.orderBy(F.col("source").asc_nulls_last())
    at = (F.row_number().over(named) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (at + 1).cast("int"))
    per = per.withColumn("weight", weight).withColumn("most", F.col("source_size").cast("double") * cap)
    rising = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before, whole = rising.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    left = F.sum(F.col("source_size").cast("double")).over(whole) * share - F.coalesce(F.sum("most").over(before), F.lit(0.0))
    weight_left = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    per = per.withColumn("level", left / weight_left)
    level = F.max("level").over(whole)
    return per.select("source", "source_size", F.least("most", F.col("weight") * level).alias("target"))


def mix(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id", weights=WEIGHTS, share: float = SHARE, cap: float = CAP, seed: str = SEED) -> DataFrame:
    """One row per document: ``doc_id, source, size, source_size, target, copies, taken``.

    A document is taken floor(rate) times, and once more with the fraction as probability; the draw is a
    hash of the seed and the id, so reruns and lost executors change nothing. Repeated ids share one draw;
    a null id draws as the text ``null``; empty tables give no rows.
    """
    sizes = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), n_words(F.col(text)).alias("size"))
    sizes = written(sizes, "mix-sizes")
    joined = with_copies(sizes, source_targets(sizes, weights, share, cap), seed)
    return joined.select("doc_id", "source", "size", "source_size", "target", "copies").withColumn("taken", F.col("size") * F.col("copies"))


def with_copies(rows: DataFrame, targets: DataFrame, seed: str = SEED, doc_id: str = "doc_id", source: str = "source") -> DataFrame:
    """``rows`` with ``source_size, target, copies``: how often each is taken."""
    # one row per source, written: its size in bytes is known, so Spark broadcasts it only below its threshold
    targets = written(targets, "mix-targets").withColumnRenamed("source", "__source")
    draw = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("null"))).cast("binary")), 1, 13), 16, 10).cast("double") / float(1 << 52)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size").cast("double")).otherwise(F.lit(0.0))
    joined = rows.join(targets, rows[source].eqNullSafe(F.col("__source"))).drop("__source")
    return joined.withColumn("copies", (F.floor(rate) + F.when(draw < rate - F.floor(rate), 1).otherwise(0)).cast("long"))


def mixed_rows(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id", weights=WEIGHTS, share: float = SHARE, cap: float = CAP, seed: str = SEED) -> DataFrame:
    """The mix itself: every document of ``docs`` as often as it is taken, with the columns of ``docs``.

    Null and empty texts have size 0 and are taken at their source's rate; a source of size 0 is not taken. A null
    source is a source like any other, repeated ids share one draw, repeated rows are each taken, a null id draws
    as the text ``null``, an empty table gives no rows. Other columns may have any names.
    """
    sizes = docs.select(F.col(source).alias("source"), n_words(F.col(text)).alias("size"))
    whole = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    taken = with_copies(whole, source_targets(sizes, weights, share, cap), seed)
    return taken.withColumn("copy", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))).select("row.*")
