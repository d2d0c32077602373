"""Ordered operators on recordings of any length: rows in ranges, summaries of ranges, a second pass.

The functions give what those of the same names in ``timebase``, ``joins`` and ``verdict`` give. Those sort a recording in one task, which
is best for many recordings; these spread one recording over as many ranges as its rows need.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recsense.functions.columns import flag
from recsense.functions.shared import kept

from . import selection
from .timebase import GAP, profile_of

#: Bits that a row's number inside its range has in ``monotonically_increasing_id``.
ROW_BITS = 33


def ranged(df: DataFrame, keys: list[str], order: list[str | Column], parts: int | None = None) -> DataFrame:
    """``df`` with ``__at``, which grows along (keys, order), and ``__range``, written to the shared folder.

    Spark samples the splitters and sorts each range externally; rows that are equal in keys and order may come in any order.
    """
    by = [*map(F.col, keys), *[F.col(c) if isinstance(c, str) else c for c in order]]
    rows = (df.repartitionByRange(parts, *by) if parts else df.repartitionByRange(*by)).sortWithinPartitions(*by)
    at = F.monotonically_increasing_id()
    return kept(rows.withColumn("__at", at).withColumn("__range", F.shiftright("__at", ROW_BITS)), "ranged-rows")


def scan(rows: DataFrame, keys: list[str], lags: dict[str, Column] | None = None, fills: dict[str, Column] | None = None, aheads: dict[str, Column] | None = None, totals: dict[str, Column] | None = None) -> DataFrame:
    """Running values over :func:`ranged` rows, by segmented scan.

    ``lags``: the value of the row before; ``fills``: the latest value that isn't null, up to the row; ``aheads``: the first
    one from the row on; ``totals``: the sum up to the row. Inside a (key, range) they are windows; a summary of each
    (key, range) is carried over the ranges of its key, of which there are few, and joined back.
    """
    lags, fills, aheads, totals = ({} if x is None else x for x in (lags, fills, aheads, totals))
    w = Window.partitionBy(*keys, "__range").orderBy("__at")
    to_here = w.rowsBetween(Window.unboundedPreceding, 0)
    from_here = Window.partitionBy(*keys, "__range").orderBy(F.col("__at").desc()).rowsBetween(Window.unboundedPreceding, 0)
    box = {n: F.struct(c.alias("v")) for n, c in lags.items()}
    full = {n: F.when(c.isNotNull(), F.struct(c.alias("v"))) for n, c in [*fills.items(), *aheads.items()]}

    summary = rows.groupBy(*[F.col(k).alias(f"__{k}") for k in keys], F.col("__range").alias("__of")).agg(
        F.count("*").alias("__n"),
        *[F.max_by(c, "__at").alias(f"__s_{n}") for n, c in box.items()],
        *[F.max_by(full[n], F.when(full[n].isNotNull(), F.col("__at"))).alias(f"__s_{n}") for n in fills],
        *[F.min_by(full[n], F.when(full[n].isNotNull(), F.col("__at"))).alias(f"__s_{n}") for n in aheads],
        *[F.sum(c).alias(f"__s_{n}") for n, c in totals.items()],
    )
    over = [F.col(f"__{k}") for k in keys]
    up, down = Window.partitionBy(*over).orderBy("__of"), Window.partitionBy(*over).orderBy(F.col("__of").desc())
    before, after = up.rowsBetween(Window.unboundedPreceding, -1), down.rowsBetween(Window.unboundedPreceding, -1)
    carries = {n: F.lag(f"__s_{n}").over(up) for n in lags} | {n: F.last(f"__s_{n}", ignorenulls=True).over(before) for n in fills}
    carries |= {n: F.last(f"__s_{n}", ignorenulls=True).over(after) for n in aheads} | {n: F.sum(f"__s_{n}").over(before) for n in totals}
    carried = summary.select(*over, "__of", *[c.alias(f"__c_{n}") for n, c in carries.items()])

    inside = {n: F.lag(c).over(w) for n, c in box.items()} | {n: F.last(full[n], ignorenulls=True).over(to_here) for n in fills}
    inside |= {n: F.last(full[n], ignorenulls=True).over(from_here) for n in aheads} | {n: F.sum(c).over(to_here) for n, c in totals.items()}
    local = rows.select("*", *[c.alias(f"__l_{n}") for n, c in inside.items()])
    here = reduce(lambda c, k: c & F.col(k).eqNullSafe(F.col(f"__{k}")), keys, F.col("__range") == F.col("__of"))
    joined = local.join(carried, here)
    out = {n: F.coalesce(f"__l_{n}", f"__c_{n}")["v"] for n in (*lags, *fills, *aheads)}
    out |= {n: F.coalesce(F.col(f"__l_{n}") + F.coalesce(f"__c_{n}", F.lit(0)), f"__l_{n}", f"__c_{n}") for n in totals}
    return joined.select(*[c for c in rows.columns if c not in out], *[c.alias(n) for n, c in out.items()])


def plain(rows: DataFrame) -> DataFrame:
    return rows.select(*[c for c in rows.columns if not c.startswith("__")])


def intervals(df: DataFrame, rec: str, t: str, order: tuple[str, ...], qs: list[float], parts: int | None = None) -> DataFrame:
    """:func:`ranged` rows with ``dt`` and ``q``, the percentiles ``qs`` of the recording's intervals, which are selected, not buffered."""
    rows = scan(ranged(df, [rec], list(order), parts), [rec], lags={"__p": F.col(t)})
    rows = kept(rows.withColumn("dt", F.col(t) - F.col("__p")).drop("__p"), "ranged-intervals")
    found = selection.quantiles(rows, [rec], "dt", qs).select(F.col(rec).alias("__r"), "q")
    return rows.join(found, F.col(rec).eqNullSafe(F.col("__r")), "left").drop("__r")


def time_profile(df: DataFrame, rec: str = "rec", t: str = "t", order: tuple[str, ...] = ("t", "id"), gap: float = GAP, parts: int | None = None) -> DataFrame:
    """Per recording: rows, span, statistics of the intervals, rates, gaps."""
    rows = intervals(df, rec, t, order, [0.5, 0.99], parts).withColumn("med", F.get("q", 0))
    return profile_of(rows, F.first(F.get("q", 1)), rec, t, gap)


def gap_segments(df: DataFrame, rec: str = "rec", t: str = "t", order: tuple[str, ...] = ("t", "id"), gap: float = GAP, parts: int | None = None) -> DataFrame:
    """``df`` with ``dt, med, segment, row_idx``."""
    rows = intervals(df, rec, t, order, [0.5], parts).withColumn("med", F.get("q", 0)).drop("q")
    cut = F.when(F.col("dt") > gap * F.col("med"), 1).otherwise(0)
    found = scan(rows, [rec], totals={"segment": cut, "row_idx": F.lit(1).cast("long")})
    return plain(found.withColumn("row_idx", F.col("row_idx") - 1))


def asof_nearest(left: DataFrame, right: DataFrame, key: str, t: str, value: str, tolerance: float, inclusive: bool, missing: Column | None = None, parts: int | None = None) -> DataFrame:
    """``left`` with ``value`` of the row of ``right`` nearest in time (of equals the earlier), and its distance."""
    names = left.columns
    both = left.select("*", F.lit(1).alias("__side"), F.lit(None).cast(right.schema[value].dataType).alias("__v"))
    both = both.unionByName(right.select(key, t, F.col(value).alias("__v"), F.lit(0).alias("__side")), allowMissingColumns=True)
    point = F.when(F.col("__side") == 0, F.struct(F.col(t).alias("t"), F.col("__v").alias("v")))
    found = scan(ranged(both, [key], [t, "__side"], parts), [key], fills={"__b": point}, aheads={"__a": point}).filter("__side = 1")
    db, da = F.col(t) - F.col("__b.t"), F.col("__a.t") - F.col(t)
    use_back = flag(db <= da) | F.col("__a").isNull()
    distance = F.when(use_back, db).otherwise(da)
    near = (distance <= tolerance) if inclusive else ~(distance > tolerance)
    chosen = F.when(flag(near), F.when(use_back, F.col("__b.v")).otherwise(F.col("__a.v")))
    return found.select(*names, (F.coalesce(chosen, missing) if missing is not None else chosen).alias(value), distance.alias("distance"))


def runs(df: DataFrame, key: list[str], order: list[str], value: str, parts: int | None = None) -> DataFrame:
    """Runs of equal values: ``key, run, value, start, stop`` (row numbers, half-open); a run may span any number of ranges."""
    one = F.lit(1).cast("long")
    rows = scan(ranged(df, key, order, parts), key, lags={"__p": F.struct(F.col(value).alias("v"))}, totals={"__k": one})
    change = F.when((F.col("__k") == 1) | ~F.col(value).eqNullSafe(F.col("__p.v")), 1).otherwise(0).cast("long")
    marked = scan(rows.withColumn("__c", change), key, totals={"run": F.col("__c")}).withColumn("run", F.col("run") - 1)
    return marked.groupBy(*key, "run").agg(F.first(value).alias(value), (F.min("__k") - 1).alias("start"), F.max("__k").alias("stop"))


def near_change(df: DataFrame, rec: list[str], order: list[str], guess: str, half: int, parts: int | None = None) -> DataFrame:
    """``df`` with ``near_change``: within ``half`` rows of a change of the guess, filled forward then backward over the whole recording."""
    rows = scan(ranged(df, rec, order, parts), rec, fills={"__b": F.col(guess)}, aheads={"__a": F.col(guess)}, totals={"__k": F.lit(1).cast("long")})
    rows = scan(rows.withColumn("__g", F.coalesce("__b", "__a")), rec, lags={"__p": F.col("__g")})
    at = F.when(flag(F.col("__g") != F.col("__p")), F.col("__k"))
    rows = scan(rows, rec, fills={"__last": at}, aheads={"__next": at})
    near = flag(F.col("__k") - F.col("__last") <= half - 1) | flag(F.col("__next") - F.col("__k") <= half)
    return plain(rows.withColumn("near_change", near))
