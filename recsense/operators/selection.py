"""Exact percentiles of any number of values in bounded memory, by counts in narrowing buckets."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recsense.functions.shared import kept

#: Buckets of an interval, and how many values may at last be sorted together.
BUCKETS, FEW = 1024, 4096
MOST = 1.7976931348623157e308


def _same(keys: list[str]) -> Column:
    return reduce(lambda c, k: c & F.col(k).eqNullSafe(F.col(f"__{k}")), keys, F.lit(True))


def quantiles(df: DataFrame, keys: list[str], value: str | Column, qs: list[float], buckets: int = BUCKETS, few: int = FEW) -> DataFrame:
    """``keys, n, q``: per key the count of values and their percentiles ``qs`` (an array), interpolated as ``percentile`` does.

    Each wanted rank starts in the interval of all values of its key. A round counts the values of each open interval in
    ``buckets`` of equal width (partial sums meet in the shuffle, no values do), and goes on in the bucket that holds the
    rank, between the least and the greatest value there. An interval ends when it holds one value or ``few``, which
    are sorted. Values only travel if the intervals are too many to be broadcast. Nulls and NaN don't count; keys without
    values are not in the result; null keys are keys; infinities are values. An empty table gives no rows.
    """
    spread = keys or ["__all"]
    if not keys:
        df = df.withColumn("__all", F.lit(0))
    v = (F.col(value) if isinstance(value, str) else value).cast("double")
    rows = df.select(*spread, v.alias("v")).filter("v is not null and not isnan(v)").withColumn("v", F.greatest(F.least("v", F.lit(MOST)), F.lit(-MOST)))
    rows = kept(rows, "selection-values")
    per = rows.groupBy(*spread).agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    at = [F.lit(float(q)) * (F.col("n") - 1) for q in qs]
    ranks = F.array_distinct(F.array(*[f(x).cast("long") for x in at for f in (F.floor, F.ceil)]))
    targets = kept(per.select(*spread, "n", F.explode(ranks).alias("rank"), "lo", "hi").withColumns({"k": F.col("rank"), "m": F.col("n")}), "selection-targets")
    open_ = (F.col("m") > few) & (F.col("lo") < F.col("hi"))
    inside = (F.col("v") >= F.col("lo")) & (F.col("v") <= F.col("hi"))

    def of(intervals: DataFrame) -> DataFrame:
        renamed = intervals.select(*[F.col(k).alias(f"__{k}") for k in spread], "lo", "hi").distinct()
        return rows.join(renamed, _same(spread) & inside)

    while not targets.filter(open_).isEmpty():
        place = F.least(F.floor((F.col("v") / 2 - F.col("lo") / 2) / (F.col("hi") / 2 - F.col("lo") / 2) * buckets), F.lit(buckets - 1))
        counts = of(targets.filter(open_)).groupBy(*spread, "lo", "hi", place.alias("bucket")).agg(F.count("*").alias("c"), F.min("v").alias("a"), F.max("v").alias("b"))
        before = F.coalesce(F.sum("c").over(Window.partitionBy(*spread, "lo", "hi").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        counts = counts.select(*[F.col(k).alias(f"__{k}") for k in spread], F.col("lo").alias("__lo"), F.col("hi").alias("__hi"), "a", "b", "c", before.alias("before"))
        here = _same([*spread, "lo", "hi"]) & (F.col("k") >= F.col("before")) & (F.col("k") < F.col("before") + F.col("c"))
        narrowed = targets.filter(open_).join(counts, here).select(*spread, "n", "rank", F.col("a").alias("lo"), F.col("b").alias("hi"), (F.col("k") - F.col("before")).alias("k"), F.col("c").alias("m"))
        targets = kept(targets.filter(~open_).unionByName(narrowed), "selection-targets")
    one = targets.filter("lo = hi").select(*spread, "n", "rank", F.col("lo").alias("v"))
    rest = targets.filter("lo < hi")
    lists = of(rest).groupBy(*[F.col(k).alias(f"__{k}") for k in spread], F.col("lo").alias("__lo"), F.col("hi").alias("__hi")).agg(F.sort_array(F.collect_list("v")).alias("vs"))
    few_ = rest.join(lists, _same([*spread, "lo", "hi"])).select(*spread, "n", "rank", F.get("vs", F.col("k").cast("int")).alias("v"))
    found = one.unionByName(few_).groupBy(*spread, "n").agg(F.map_from_entries(F.collect_list(F.struct("rank", F.when(F.col("v") >= MOST, math.inf).when(F.col("v") <= -MOST, -math.inf).otherwise(F.col("v"))))).alias("of"))
    low, high = ([F.col("of")[f(x).cast("long")] for x in at] for f in (F.floor, F.ceil))
    between = [F.when((a == b) | (F.floor(x) == x), a).otherwise((F.ceil(x) - x) * a + (x - F.floor(x)) * b) for x, a, b in zip(at, low, high, strict=True)]
    return found.select(*keys, "n", F.array(*between).alias("q"))
