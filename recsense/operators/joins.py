"""Joins in time and by key, runs, transitions, spread-out top k, differences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recsense.functions.columns import filled, flag, ratio
from recsense.functions.shared import kept


def asof_nearest(left: DataFrame, right: DataFrame, key: str, t: str, value: str, tolerance: float, inclusive: bool, missing: Column | None = None) -> DataFrame:
    """``left`` with ``value`` of the row of ``right`` nearest in time (of equals the earlier), and its distance.

    Both sides are put together, shuffled by key once and sorted by time forwards and backwards; the neighbours
    come from running fills, so there is no range join and no frame that looks at the rest of a key for each row. Where the distance exceeds the tolerance the value is ``missing``.
    """
    names = left.columns
    both = left.withColumn("__side", F.lit(1)).withColumn("__v", F.lit(None).cast(right.schema[value].dataType)).unionByName(right.select(key, t, F.col(value).alias("__v")).withColumn("__side", F.lit(0)), allowMissingColumns=True)
    w = Window.partitionBy(key)
    point = F.when(F.col("__side") == 0, F.struct(F.col(t).alias("t"), F.col("__v").alias("v")))
    back = filled(point, w.orderBy(F.col(t).asc(), F.col("__side").asc()))
    ahead = filled(point, w.orderBy(F.col(t).desc(), F.col("__side").desc()))
    both = both.withColumn("__b", back).withColumn("__a", ahead).filter("__side = 1")
    db, da = F.col(t) - F.col("__b.t"), F.col("__a.t") - F.col(t)
    use_back = flag(db <= da) | F.col("__a").isNull()
    distance = F.when(use_back, db).otherwise(da)
    near = (distance <= tolerance) if inclusive else ~(distance > tolerance)
    found = F.when(use_back, F.col("__b.v")).otherwise(F.col("__a.v"))
    chosen = F.when(flag(near), found)
    return both.select(*names, (F.coalesce(chosen, missing) if missing is not None else chosen).alias(value), distance.alias("distance"))


def one_to_one(left: DataFrame, right: DataFrame, key: list[str]) -> tuple[DataFrame, DataFrame]:
    """``(inner join, keys that aren't unique on a side)``."""
    twice = left.groupBy(*key).count().filter("count > 1").select(*key, F.lit("left").alias("side")).unionByName(right.groupBy(*key).count().filter("count > 1").select(*key, F.lit("right").alias("side")))
    return left.join(right, key), twice


def runs(df: DataFrame, key: list[str], order: list[str], value: str) -> DataFrame:
    """Runs of equal values: ``key, run, value, start, stop`` (row numbers, half-open)."""
    w = Window.partitionBy(*key).orderBy(*order)
    at = (F.row_number().over(w) - 1).cast("long")
    change = flag(~F.col(value).eqNullSafe(F.lag(value).over(w))) | (F.row_number().over(w) == 1)
    marked = df.withColumn("__at", at).withColumn("__c", change.cast("long"))
    marked = marked.withColumn("run", F.sum("__c").over(w.rowsBetween(Window.unboundedPreceding, 0)) - 1)
    return marked.groupBy(*key, "run").agg(F.first(value).alias(value), F.min("__at").alias("start"), (F.max("__at") + 1).alias("stop"))


def predicted_changes(df: DataFrame, key: list[str], t: str, value: str) -> DataFrame:
    """Times halfway between covered rows whose class differs."""
    w = Window.partitionBy(*key).orderBy(t)
    rows = df.filter(F.col(value).isNotNull()).withColumn("__t", F.lag(t).over(w)).withColumn("__v", F.lag(value).over(w))
    return rows.filter(F.col(value) != F.col("__v")).select(*key, ((F.col(t) + F.col("__t")) / 2.0).alias(t), F.col("__v").alias("before"), F.col(value).alias("after"))


#: Names of the classes in a direction.
CLASS_NAMES = {0: "stand", 10: "walk"}


def find_transitions(rows: DataFrame, key: list[str], order: list[str], t: str, truth: str, guess: str, reason: str, window: float, flank: float = 1.0, edge: float = 1.0, tight: float = 0.5, unsure: int = -1, near: str = "near_transition") -> DataFrame:
    """Annotated boundaries between the two classes, directly or over one run of ``unsure``, with the model's timing.

    Times are in ms, ``flank``, ``edge`` and ``tight`` in windows of ``window`` ms. ``key`` names a segment, so no boundary
    spans a gap. Gives ``key, direction, t_truth_s, width_s, flank_before_s, flank_after_s, offset_s`` (of the nearest change of the
    guess, of equals the earlier; positive is late; null without any), ``flagged`` (a row within ``tight`` has the reason ``near``)
    and ``rejected``: ``short_flank`` where a run beside it is shorter than ``flank``, else ``near_segment_edge`` where the boundary is closer
    than ``edge`` to an end of the segment, else null. Rejected ones have no offset and no flag. Null truths are runs of their own.
    """
    w = Window.partitionBy(*key).orderBy(*order)
    first = F.row_number().over(w) == 1
    marked = rows.select(*key, *dict.fromkeys([*order, t]), truth).withColumn("__c", (first | ~F.col(truth).eqNullSafe(F.lag(truth).over(w))).cast("long"))
    marked = marked.withColumn("run", F.sum("__c").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    found = marked.groupBy(*key, "run").agg(F.first(truth).alias("v"), F.min(t).alias("t0"), F.max(t).alias("t1"))
    by_run = Window.partitionBy(*key).orderBy("run")
    nxt = {n: F.lead(F.struct("v", "t0", "t1"), n).over(by_run) for n in (1, 2)}
    whole = Window.partitionBy(*key)
    runs_ = found.select("*", nxt[1].alias("n"), nxt[2].alias("m"), F.min("t0").over(whole).alias("low"), F.max("t1").over(whole).alias("high"))
    to = F.when(flag(F.col("n.v") == unsure), F.col("m")).otherwise(F.col("n"))
    classes = list(CLASS_NAMES)
    pairs = runs_.filter(F.col("v").isin(classes)).withColumn("to", to).filter(flag(F.col("to.v").isin(classes) & (F.col("to.v") != F.col("v"))))
    at = (F.col("t1") + F.col("to.t0")) / 2.0
    before, after = F.col("t1") - F.col("t0"), F.col("to.t1") - F.col("to.t0")
    cause = F.when((before < flank * window) | (after < flank * window), "short_flank").when((at - F.col("low") < edge * window) | (F.col("high") - at < edge * window), "near_segment_edge")
    name = lambda c: F.when(c == classes[0], CLASS_NAMES[classes[0]]).otherwise(CLASS_NAMES[classes[1]])
    points = pairs.select(*key, F.concat(name(F.col("v")), F.lit("->"), name(F.col("to.v"))).alias("direction"), at.alias(t), (F.col("to.t0") - F.col("t1")).alias("width"), before.alias("before"), after.alias("after"), cause.alias("rejected"))
    points = points.withColumn("__key", F.struct(*key))
    changes = predicted_changes(rows, key, t, guess).select(F.struct(*key).alias("__key"), t)
    timed = nearest_event(points.filter("rejected is null"), changes, "__key", t)
    spots = timed.withColumns({"__s": F.col(t), "__e": F.col(t)})
    marks = rows.filter(F.col(reason) == near).select(F.struct(*key).alias("__key"), t)
    hit = contains_event(spots, marks, "__key", "__s", "__e", t, tight * window, 2 * tight * window)
    out = hit.unionByName(points.filter("rejected is not null"), allowMissingColumns=True)
    s3 = lambda c: F.round(c / 1000.0, 3)
    return out.select(*key, "direction", s3(F.col(t)).alias("t_truth_s"), s3(F.col("width")).alias("width_s"), s3(F.col("before")).alias("flank_before_s"), s3(F.col("after")).alias("flank_after_s"), s3(F.col("offset")).alias("offset_s"), F.col("hit").alias("flagged"), "rejected")


def transition_summary(trans: DataFrame, window_s: float, by: list[str] | None = None, tight: float = 0.5, loose: float = 1.0) -> DataFrame:
    """Statistics of :func:`find_transitions` over all boundaries, or per ``by``: rejections by cause, directions, widths, flags and timing (positive is late)."""
    on = F.col("rejected").isNull()
    n = lambda c: F.sum(flag(c).cast("long"))
    width, off = F.when(on, F.col("width_s")), F.when(on, F.col("offset_s"))
    size = F.abs(off)
    out = trans.groupBy(*(by or [])).agg(
        n(on).alias("n_timeable"), n(F.col("rejected") == "short_flank").alias("n_short_flank"), n(F.col("rejected") == "near_segment_edge").alias("n_near_edge"),
        n(on & (F.col("direction") == "stand->walk")).alias("n_stand_walk"), n(on & (F.col("direction") == "walk->stand")).alias("n_walk_stand"),
        F.percentile(width, 0.5).alias("width_median"), F.avg(width).alias("width_mean"), F.percentile(width, 0.9).alias("width_p90"), F.max(width).alias("width_max"), n(width == 0).alias("n_zero_width"),
        n(on & F.col("flagged")).alias("n_flagged"), F.count(off).alias("n_timed"), n(on & F.col("offset_s").isNull()).alias("n_no_change"),
        F.percentile(off, 0.5).alias("offset_median"), F.percentile(size, 0.5).alias("offset_abs_median"), F.percentile(size, 0.9).alias("offset_abs_p90"),
        n(size <= tight * window_s).alias("n_tight"), n(size <= loose * window_s).alias("n_loose"), n(off > 0).alias("n_late"), n(off < 0).alias("n_early"),
    )
    shares = {"frac_flagged": ("n_flagged", "n_timeable"), "frac_tight": ("n_tight", "n_timed"), "frac_loose": ("n_loose", "n_timed")}
    return out.withColumns({c: ratio(F.col(a), F.col(b)) for c, (a, b) in shares.items()})


def nearest_event(points: DataFrame, events: DataFrame, key: str, t: str) -> DataFrame:
    """Each point with the time of the nearest event and the signed offset (event - point)."""
    tagged = events.select(key, t).withColumn("nearest", F.col(t))
    found = asof_nearest(points, tagged, key, t, "nearest", float("inf"), True)
    return found.withColumn("offset", F.col("nearest") - F.col(t)).drop("distance")


def contains_event(regions: DataFrame, events: DataFrame, key: str, start: str, stop: str, t: str, tolerance: float, bucket: float) -> DataFrame:
    """Regions with ``hit``: an event lies within ``[start - tolerance, stop + tolerance]``.

    Regions are spread over the time buckets they touch and joined by (key, bucket), then compared.
    """
    low, high = F.col(start) - tolerance, F.col(stop) + tolerance
    spread = regions.withColumn("__b", F.explode(F.sequence(F.floor(low / bucket), F.floor(high / bucket))))
    other = events.select(F.col(key).alias("__k"), F.col(t).alias("__t"), F.floor(F.col(t) / bucket).alias("__eb")).distinct()
    within = (F.col(key) == F.col("__k")) & (F.col("__b") == F.col("__eb")) & (F.col("__t") >= low) & (F.col("__t") <= high)
    hits = spread.join(other, within, "left_semi").select(key, start, stop).distinct().withColumn("hit", F.lit(True))
    return regions.join(hits, [key, start, stop], "left").withColumn("hit", flag(F.col("hit")))


#: Time cells to a distance ``apart``, and cells of a key that one pass of :func:`greedy_spread_topk` weighs.
CELLS, CONTENDERS = 8, 256


def contenders(rows: DataFrame, key: str, batch: int) -> DataFrame:
    """Of rows ``key, __s, __c, __t, __r`` the best of each cell with its rows' extent in time, and of each key the ``batch`` best cells: ``key, found`` in order.

    Both steps cut inside tasks before they shuffle, so a key of any size sends at most ``batch`` rows a task.
    """
    best = rows.groupBy(key, "__s", "__c").agg(F.min("__r").alias("__r"), F.min("__t").alias("__lo"), F.max("__t").alias("__hi"))
    ranked = best.withColumn("__k", F.row_number().over(Window.partitionBy(key).orderBy("__r"))).filter(F.col("__k") <= batch)
    return ranked.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("__r", "__lo", "__hi"))).alias("found"))


def greedy_spread_topk(df: DataFrame, key: str, t: str, evidence: str, most: int = 12, apart: float = 5000.0, share: int = 100_000, batch: int = CONTENDERS) -> DataFrame:
    """Per key the rows of greatest evidence (ties: earlier), at most ``most``, none within ``apart`` of one taken.

    Returns ``key, taken array<struct<t, evidence>>, n_dropped``. A row that an earlier pick shadows is dropped,
    and so is one without a finite time; null evidence comes last, NaN before it. An empty table gives no rows.

    Time is cut into cells shorter than ``apart``, of which one row at most can be taken. A pass finds the best free row of each
    cell and walks over the best cells of each key in order. The walk takes rows until it comes to a cell whose best row
    a pick of this pass shadows, but not all of whose rows: what is left there is not known, so the key goes on in the next pass.
    Each pass takes a row at least of each key that goes on, mostly several. Rows are written once; of those, a pass reads the
    keys that go on, dealt out in shares of about ``share`` rows. No more than ``batch`` cells of a key come together.
    """
    if apart <= 0:
        raise ValueError("apart has to be positive")
    width = apart / CELLS
    counts = df.groupBy(key).agg(F.count("*").alias("__n"), F.ceil(F.count("*") / share).alias("__shares"))
    rank = F.struct(F.col(evidence).isNull().alias("n"), (-F.col(evidence)).alias("e"), F.col(t).alias("t")).alias("__r")
    rows = df.filter(F.abs(t) < float("inf")).select(key, F.floor(F.col(t) / width).alias("__c"), F.col(t).alias("__t"), rank).join(counts.select(key, "__shares"), key)
    rows = kept(rows.select(key, F.pmod(F.xxhash64("__c"), "__shares").alias("__s"), "__c", "__t", "__r"), "spread-rows")
    none = F.slice(F.array(F.struct(F.lit(True).alias("n"), F.lit(None).cast(df.schema[evidence].dataType).alias("e"), F.lit(None).cast(df.schema[t].dataType).alias("t"))), 1, 0)
    picks = kept(counts.withColumns({"taken": none, "more": F.lit(True)}), "spread-picks")

    def near(taken: Column, at: Column) -> Column:
        return F.exists(taken, lambda y: F.abs(y["t"] - at) < apart)

    def gone(taken: Column, c: Column) -> Column:
        """Whether one pick shadows all rows of a cell."""
        return F.exists(taken, lambda y: (F.abs(y["t"] - c["__lo"]) < apart) & (F.abs(y["t"] - c["__hi"]) < apart))

    def step(s: Column, c: Column) -> Column:
        over, shadowed = ~s["on"] | (F.size(s["taken"]) >= most), near(s["taken"], c["__r"]["t"])
        taken = F.when(over | shadowed, s["taken"]).otherwise(F.concat(s["taken"], F.array(c["__r"])))
        return F.struct(taken.alias("taken"), (s["on"] & (over | ~shadowed | gone(s["taken"], c))).alias("on"))

    out, first = picks.filter("not more"), True
    while not picks.isEmpty():
        free = rows
        if not first:
            held = picks.select(key, "taken", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__shares") - 1)).alias("__s"))
            free = rows.join(held, [key, "__s"]).filter(~near(F.col("taken"), F.col("__t"))).drop("taken")
        walked = picks.join(contenders(free, key, batch), key, "left").withColumn("__w", F.aggregate("found", F.struct("taken", F.lit(True).alias("on")), step))
        taken = F.coalesce("__w.taken", "taken")
        more = flag((F.size(taken) < most) & (~F.col("__w.on") | (F.size("found") == batch)))
        walked = kept(walked.select(key, "__n", "__shares", taken.alias("taken"), more.alias("more")), "spread-picks")
        out, picks, first = out.unionByName(walked.filter("not more")), walked.filter("more"), False
    return out.select(key, F.transform("taken", lambda x: F.struct(x["t"].alias("t"), (-x["e"]).alias("evidence"))).alias("taken"), (F.col("__n") - F.size("taken")).alias("n_dropped"))


def worst_n(df: DataFrame, by: list[Column], n: int) -> DataFrame:
    """The first ``n`` rows in that order."""
    return df.orderBy(*by).limit(n)


def latest_partition(dirs: DataFrame) -> DataFrame:
    """The newest ``(date, run)`` (run as a number) among rows whose review isn't empty."""
    return dirs.filter("n_items > 0").agg(F.max(F.struct("date", F.col("run").cast("int").alias("run"))).alias("m")).select("m.date", "m.run")


def first_difference(want: DataFrame, got: DataFrame, key: list[str]) -> DataFrame:
    """Where two frames differ: columns that only one has, then rows (nulls and NaNs equal themselves)."""
    spark = want.sparkSession
    schema = [(c, "only in want") for c in want.columns if c not in got.columns] + [(c, "only in got") for c in got.columns if c not in want.columns]
    shared = [c for c in want.columns if c in got.columns and c not in key]
    w, g = want.select(*key, F.struct(*shared).alias("w")), got.select(*key, F.struct(*shared).alias("g"))
    joined = w.join(g, key, "full")
    what = F.when(F.col("g").isNull(), "row only in want").when(F.col("w").isNull(), "row only in got")
    first = F.coalesce(*[F.when(~F.col(f"w.{c}").eqNullSafe(F.col(f"g.{c}")), F.lit(f"value of {c}")) for c in shared])
    rows = joined.select(F.concat_ws("/", *[F.col(k).cast("string") for k in key]).alias("place"), F.coalesce(what, first).alias("difference")).filter("difference is not null")
    return spark.createDataFrame(schema, "place string, difference string").unionByName(rows)
