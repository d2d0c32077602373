"""Places of conversation turns, without ever bringing one conversation into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

#: Bits that a row's number inside its range has in ``monotonically_increasing_id``.
ROW_BITS = 33


def sorted_turns(rows: DataFrame, order: list[Column], keep: list[Column], name: str) -> DataFrame:
    """``keep`` and ``at`` of every row, written; ``at`` grows along ``order`` over the whole table.

    Spark samples the splitters of the ranges and sorts each range externally, so a conversation of any length spreads
    over as many ranges as its rows need, and equal rows are neighbours. What is written isn't computed again, so
    ``at`` stays as it is.
    """
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return written(ranged.withColumn("at", F.monotonically_increasing_id()).select(*keep, "at"), name)


def conversation_runs(turns: DataFrame) -> DataFrame:
    """``(run_conv, run_range, first_at, before)``: where each conversation begins in each range, and its rows in earlier ranges.

    A conversation has at most one run a range, so the running sum holds as many rows of it as there are ranges.
    """
    runs = turns.groupBy(F.col("conv_id").alias("run_conv"), F.shiftright("at", ROW_BITS).alias("run_range")).agg(F.min("at").alias("first_at"), F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("run_conv").orderBy("run_range").rowsBetween(Window.unboundedPreceding, -1)
    return runs.select("run_conv", "run_range", "first_at", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))


def numbered(turns: DataFrame, runs: DataFrame) -> DataFrame:
    """``turns`` with ``place``, from 0 in each conversation, and the further columns of ``runs``."""
    same = F.col("conv_id").eqNullSafe(F.col("run_conv")) & (F.shiftright("at", ROW_BITS) == F.col("run_range"))
    found = turns.join(runs, same).withColumn("place", F.col("at") - F.col("first_at") + F.col("before"))
    return found.drop("run_conv", "run_range", "first_at", "before")
