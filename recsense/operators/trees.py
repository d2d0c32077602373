"""Extremely randomised trees, grown level by level; all seeds and folds share every pass over the rows."""

from __future__ import annotations

import math
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from recsense.functions.shared import kept

#: Nodes of a level that one pass fills, all nodes that the driver and each task may hold, and passes of a level that run side by side.
SLOTS, MOST_NODES, ASIDE = 400_000, 20_000_000, 3
#: Rows and trees that are walked at once (their features stay in a core's cache), rows from which one more task shares a tree's rows, lines that a task hands out at once.
ROWS, TREES, SHARE, LINES = 1024, 8, 16_384, 50_000


def draws(*parts: np.ndarray | int) -> np.ndarray:
    """64 random bits for each combination of the integers, by rounds of a 64-bit mixer."""
    with np.errstate(over="ignore"):
        out = np.uint64(0x9E3779B97F4A7C15)
        for part in parts:
            out = out ^ np.asarray(part).astype(np.uint64)
            out = (out ^ (out >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            out = (out ^ (out >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            out = out ^ (out >> np.uint64(31))
        return out


def candidates(seed: np.ndarray, tree: np.ndarray, path: np.ndarray, n_features: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each node: ``k`` different features, and for each a number in [0, 1) that says where between the extremes it is cut."""
    bits = np.uint64((n_features - 1).bit_length())
    keys = draws(seed[:, None], tree[:, None], path[:, None], np.arange(n_features)[None, :])
    # the feature's number in the lowest bits, so that a plain sort gives the order
    chosen = np.sort(keys >> bits << bits | np.arange(n_features, dtype=np.uint64), axis=1)[:, :k] & ((np.uint64(1) << bits) - np.uint64(1))
    at = draws(seed[:, None], tree[:, None], path[:, None], n_features + np.arange(k)[None, :])
    return chosen.astype(np.int32), (at >> np.uint64(11)).astype(np.float64) * 2.0**-53


def cut_points(lo: np.ndarray, hi: np.ndarray, u: np.ndarray) -> np.ndarray:
    """A point in [lo, hi): values up to it go left, so both sides get rows where lo < hi."""
    at = lo + u * (hi - lo)
    return np.where(at >= hi, lo, at)


@dataclass
class Forest:
    """Nodes of all trees of all fits as columns; the right child follows the left one. A fit is a seed and the fold it has not seen (-1: none)."""

    features: list[str]
    seeds: list[int]
    groups: list
    trees: int
    fit_seed: np.ndarray
    fit_fold: np.ndarray
    weight: np.ndarray  # of a fit: weights of both classes
    feature: np.ndarray = field(default_factory=lambda: np.empty(0, np.int32))
    cut: np.ndarray = field(default_factory=lambda: np.empty(0))
    left: np.ndarray = field(default_factory=lambda: np.empty(0, np.int32))
    counts: np.ndarray = field(default_factory=lambda: np.empty((0, 2), np.int64))
    tree: np.ndarray = field(default_factory=lambda: np.empty(0, np.int32))
    path: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    depth: int = 0

    def add(self, counts: np.ndarray, tree: np.ndarray, path: np.ndarray) -> np.ndarray:
        """New leaves; ``tree`` counts through all fits."""
        first, n = len(self.feature), len(tree)
        if first + n > MOST_NODES:
            raise ValueError(f"more than {MOST_NODES} nodes: fewer trees, folds or seeds, or less depth")
        self.feature = np.concatenate([self.feature, np.full(n, -1, np.int32)])
        self.cut = np.concatenate([self.cut, np.zeros(n)])
        self.left = np.concatenate([self.left, np.zeros(n, np.int32)])
        self.counts = np.concatenate([self.counts, counts])
        self.tree = np.concatenate([self.tree, tree.astype(np.int32)])
        self.path = np.concatenate([self.path, path])
        return np.arange(first, first + n)

    def fit_of(self, nodes: np.ndarray) -> np.ndarray:
        return self.tree[nodes] // self.trees

    def leaf_p(self) -> np.ndarray:
        """The weighted share of the high class in every node."""
        w = self.counts * self.weight[self.fit_of(np.arange(len(self.tree)))]
        total = w.sum(axis=1)
        return np.divide(w[:, 1], total, out=np.zeros(len(w)), where=total > 0)


@dataclass
class Layout:
    """The nodes of each tree side by side: a leaf goes left to itself, the right child follows the left one."""

    order: np.ndarray  # the forest's numbers of the nodes
    starts: np.ndarray  # of each tree, and the end
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray

    @classmethod
    def of(cls, forest: Forest) -> Layout:
        order = np.argsort(forest.tree, kind="stable")
        starts = np.searchsorted(forest.tree[order], np.arange(len(forest.fit_seed) * forest.trees + 1))
        place = np.empty(len(order), np.int32)
        place[order] = np.arange(len(order))
        feature = forest.feature[order]
        left = np.where(feature < 0, place[order], place[forest.left[order]])
        return cls(order, starts, np.maximum(feature, 0), np.where(feature < 0, np.inf, forest.cut[order]), left)

    def tables(self, first: int, end: int) -> dict:
        """What :func:`walk` needs of the trees from ``first`` up to ``end``."""
        a, b = self.starts[first], self.starts[end]
        return {"starts": self.starts[first : end + 1] - a, "feature": self.feature[a:b], "cut": self.cut[a:b], "left": self.left[a:b] - a}


def walk(flat: np.ndarray, row: np.ndarray, tables: dict, first: int, end: int, steps: int) -> np.ndarray:
    """For each of some trees the nodes that the rows reach, as places in ``tables``; ``flat`` holds the features of row after row, which begin at ``row``."""
    a, b = tables["starts"][first], tables["starts"][end]
    feature, cut, left = tables["feature"][a:b].astype(np.intp), tables["cut"][a:b], tables["left"][a:b] - np.intp(a)
    at, row = np.repeat(tables["starts"][first:end] - a, len(row)), np.tile(row, end - first)
    for _ in range(steps if b - a > end - first else 0):
        place = feature.take(at)
        place += row
        right = flat.take(place) > cut.take(at)
        at = left.take(at)
        at += right
    return at + a


def _pieces(x: np.ndarray) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """ROWS rows at most at once: which they are, their features in one row, and where each begins there."""
    for a in range(0, len(x), ROWS):
        some = x[a : a + ROWS]
        yield slice(a, a + len(some)), some.reshape(-1), np.arange(len(some)) * x.shape[1]


def _cells(batch: pa.RecordBatch, m: dict) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, slice]]:
    """For TREES trees at once: flat features, where the training rows in open nodes begin in them, their classes, their open nodes counted from the slice of the pass."""
    x = batch.column(0).flatten().to_numpy().reshape(len(batch), -1)
    y, fold, part = (c.to_numpy() for c in batch.columns[1:])
    for one in np.unique(part):
        mine = m["groups"][one :: m["parts"]]
        for held in dict.fromkeys(h for _, _, h in mine):
            use = np.flatnonzero((part == one) & (fold != held)) if held >= 0 else np.flatnonzero(part == one)
            for piece, flat, row in _pieces(x[use]):
                classes = y[use[piece]]
                for first, end, _ in (g for g in mine if g[2] == held):
                    a, b = m["starts"][first], m["starts"][end]
                    slots = m["slot"][a:b]
                    open_ = slots[slots >= 0]
                    if not len(open_):
                        continue
                    at = slots.astype(np.intp).take(walk(flat, row, m, first, end, m["depth"]) - a)
                    at -= open_.min()
                    stay = np.flatnonzero(at >= 0)
                    yield flat, np.tile(row, end - first)[stay], np.tile(classes, end - first)[stay], at[stay], slice(open_.min(), open_.max() + 1)


def _lines(slot: np.ndarray, columns: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
    for a in range(0, len(slot), LINES):
        yield pa.RecordBatch.from_pydict({"slot": slot[a : a + LINES]} | {c: v[a : a + LINES] for c, v in columns.items()})


def _passes(rows: DataFrame, model: dict, k: int, cuts: bool) -> pd.DataFrame:
    """One aggregate over all rows, a line per open node: extremes of its drawn features, or how many rows of each class lie left of the cuts."""
    n = model["drawn"].shape[1]
    names = [f"{c}{j}" for j in range(k) for c in ("lo", "hi")]
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def extremes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        lo, hi = np.full((k, n), np.inf), np.full((k, n), -np.inf)
        for batch in batches:
            for flat, row, _, at, open_ in _cells(batch, m):
                for j in range(k):
                    place = m["drawn"][j, open_].astype(np.intp).take(at)
                    place += row
                    v = flat.take(place)
                    np.minimum.at(lo[j, open_], at, v)
                    np.maximum.at(hi[j, open_], at, v)
        seen = np.flatnonzero(hi[0] > -np.inf)
        yield from _lines(seen, {f"{c}{j}": a[j, seen] for j in range(k) for c, a in (("lo", lo), ("hi", hi))})

    def classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        left = np.zeros((k, 2 * n), np.int64)
        for batch in batches:
            for flat, row, y, at, open_ in _cells(batch, m):
                key, two = 2 * at + y, slice(2 * open_.start, 2 * open_.stop)
                for j in range(k):
                    place = m["drawn"][j, open_].astype(np.intp).take(at)
                    place += row
                    np.add.at(left[j, two], key, (flat.take(place) <= m["at"][j, open_].take(at)).astype(np.int64))
        seen = np.flatnonzero(left.reshape(k, n, 2).any(axis=(0, 2)))
        yield from _lines(seen, {f"{c}{j}": left[j, 2 * seen + z] for j in range(k) for z, c in enumerate(("lo", "hi"))})

    kind = "long" if cuts else "double"
    found = rows.mapInArrow(classes if cuts else extremes, "slot long, " + ", ".join(f"{c} {kind}" for c in names))
    merge = [F.sum(c) for c in names] if cuts else [(F.min if c.startswith("lo") else F.max)(c) for c in names]
    out = found.groupBy("slot").agg(*[m.alias(c) for m, c in zip(merge, names, strict=True)]).toArrow().to_pandas()
    shared.destroy()
    return out


def _purity(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Weight times Gini impurity over two."""
    total = a + b
    return np.divide(a * b, total, out=np.zeros(np.broadcast(a, b).shape), where=total > 0)


def _splits(rows: DataFrame, forest: Forest, layout: Layout, nodes: np.ndarray, k: int, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the open ``nodes`` those that can be split, the feature and the cut that do it, and the classes to the left; two passes."""
    seed, tree = forest.fit_seed[forest.fit_of(nodes)], forest.tree[nodes]
    drawn, u = candidates(seed, tree % forest.trees, forest.path[nodes], len(forest.features), k)
    first, end = int(tree[0]), int(tree[-1]) + 1
    slot = np.full(len(forest.feature), -1, np.int32)
    slot[nodes] = np.arange(len(nodes))
    slot = slot[layout.order[layout.starts[first] : layout.starts[end]]]
    # trees that are walked at once are of one fit
    groups = [(max(a, first) - first, min(a + TREES, f + forest.trees, end) - first, int(forest.fit_fold[f // forest.trees])) for f in range(first // forest.trees * forest.trees, end, forest.trees) for a in range(f, min(f + forest.trees, end), TREES) if a + TREES > first]
    model = layout.tables(first, end) | {"groups": groups, "parts": parts, "depth": forest.depth, "slot": slot, "drawn": np.ascontiguousarray(drawn.T)}
    found = _passes(rows, model, k, False)
    lo, hi = np.full((len(nodes), k), np.inf), np.full((len(nodes), k), -np.inf)
    lo[found["slot"]], hi[found["slot"]] = (found[[f"{c}{j}" for j in range(k)]].to_numpy() for c in ("lo", "hi"))
    with np.errstate(invalid="ignore"):
        at = np.where(lo < hi, cut_points(lo, hi, u), -np.inf)
    found = _passes(rows, model | {"at": np.ascontiguousarray(at.T)}, k, True)
    left = np.zeros((len(nodes), k, 2), np.int64)
    for z, c in enumerate(("lo", "hi")):
        left[found["slot"].to_numpy(), :, z] = found[[f"{c}{j}" for j in range(k)]].to_numpy()
    total = forest.counts[nodes][:, None, :]
    w = forest.weight[forest.fit_of(nodes)][:, None, :]
    l, r = left * w, (total - left) * w
    cost = np.where(at > -np.inf, _purity(l[..., 0], l[..., 1]) + _purity(r[..., 0], r[..., 1]), np.inf)
    best = cost.argmin(axis=1)
    split = np.flatnonzero(np.isfinite(cost[np.arange(len(nodes)), best]))
    best = best[split]
    return nodes[split], drawn[split, best], at[split, best], left[split, best]


def _level(rows: DataFrame, forest: Forest, nodes: np.ndarray, k: int, parts: int) -> np.ndarray:
    """Split the open ``nodes``, which come tree by tree, and give their children."""
    layout = Layout.of(forest)
    with ThreadPoolExecutor(ASIDE) as pool:
        found = list(pool.map(lambda a: _splits(rows, forest, layout, nodes[a : a + SLOTS], k, parts), range(0, len(nodes), SLOTS)))
    parents, feature, cut, below = (np.concatenate(c) for c in zip(*found, strict=True))
    forest.feature[parents], forest.cut[parents] = feature, cut
    both = np.stack([below, forest.counts[parents] - below], axis=1).reshape(-1, 2)
    path = np.stack([2 * forest.path[parents], 2 * forest.path[parents] + 1], axis=1).reshape(-1)
    children = forest.add(both, np.repeat(forest.tree[parents], 2), path)
    forest.left[parents] = children[::2]
    forest.depth += 1
    return children


def _filled(column: str) -> Column:
    value = F.col(column).cast("double")
    return F.coalesce(F.nanvl(value, F.lit(0.0)), F.lit(0.0))


def _rows(df: DataFrame, features: list[str], y: Column, fold: Column) -> DataFrame:
    return df.select(F.array(*map(_filled, features)).alias("x"), y.cast("long").alias("y"), fold.cast("int").alias("fold"))


def _dealt(rows: DataFrame, n: int) -> tuple[DataFrame, int]:
    """Training rows written once, so that every pass keeps all cores busy: many rows lie in as many files as there are cores.

    Few rows, which would be few tasks, also go to several parts that each are for one share of the trees; the number of parts comes along.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    files = max(g for g in range(1, cores + 1) if cores % g == 0 and g <= max(1, n // SHARE))
    parts = cores // files
    if parts == 1:
        return kept(rows.withColumn("part", F.lit(0)).repartition(files), "forest-rows"), parts
    every = rows.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    own = F.col("part") * files + F.pmod(F.xxhash64("x"), F.lit(files)).cast("int")
    return kept(every.repartitionById(cores, own), "forest-rows"), parts


def fold_of(groups: list, group: str | None) -> Column:
    """The number of a row's group, -1 for none of them."""
    return F.lit(-1) if group is None or not groups else F.coalesce(F.array_position(F.array(*map(F.lit, groups)), F.col(group)) - 1, F.lit(-1)).cast("int")


def fit_trees(df: DataFrame, features: list[str], label: str, group: str | None = None, seeds: list[int] | None = None, trees: int = 400, depth: int = 12) -> Forest:
    """Class-balanced forests of extremely randomised trees for ``label`` (10 or not), one per seed and, with ``group``, per group left out.

    Every tree sees all training rows. A node draws about the square root of the features, each with a cut at a random
    place between its least and greatest value there, and takes the purest. A level is two aggregates over the rows for all nodes of all
    trees of all fits (SLOTS nodes a time): extremes, then class counts; counts are whole numbers and draws hash (seed, tree, node), so the forest
    doesn't depend on how the rows are spread. Null and NaN count as 0. A node with one class, without a drawn
    feature that varies, or at ``depth`` is a leaf. What the driver and the tasks hold is bounded by MOST_NODES, whatever the number of rows.
    A row whose group is null is in every training set. Without rows there are trees without splits.
    """
    seeds = [0] if seeds is None else list(seeds)
    groups = [] if group is None else sorted(r[0] for r in df.select(group).distinct().filter(F.col(group).isNotNull()).collect())
    rows = _rows(df, features, F.col(label).eqNullSafe(F.lit(10)), fold_of(groups, group))
    counts = np.zeros((max(len(groups), 1) + 1, 2), np.int64)
    for r in rows.groupBy("fold", "y").count().collect():
        counts[r["fold"], r["y"]] += r["count"]  # fold -1 is the last line
    folds = list(range(len(groups))) if group is not None else [-1]
    fit_fold = np.array([f for _ in seeds for f in folds], np.int32)
    train = np.array([counts.sum(axis=0) - (counts[f] if f >= 0 else 0) for f in fit_fold]).reshape(-1, 2)
    weight = np.divide(train.sum(axis=1, keepdims=True), 2.0 * train, out=np.zeros(train.shape), where=train > 0)
    forest = Forest(features, seeds, groups, trees, np.array([s for s in seeds for _ in folds], np.int64), fit_fold, weight)
    rows, parts = _dealt(rows, int(counts.sum()))
    n_trees = len(fit_fold) * trees
    children = forest.add(np.repeat(train, trees, axis=0), np.arange(n_trees), np.ones(n_trees, np.int64))
    k = max(1, math.isqrt(len(features)))
    for _ in range(depth):
        open_ = children[(forest.counts[children] > 0).all(axis=1)]
        if not len(open_):
            break
        children = _level(rows, forest, open_, k, parts)
    return forest


def seeds_at_once(forest: Forest) -> int:
    """How many seeds may be fitted together, if all have trees like those of ``forest``, of one seed: half of MOST_NODES at most."""
    return max(1, MOST_NODES // 2 // len(forest.feature))


def score_trees(forest: Forest, df: DataFrame, group: str | None = None) -> DataFrame:
    """``df`` with ``ps``: for each seed the mean share of the high class, by the fit that has not seen the row's group."""
    layout, folds = Layout.of(forest), max(len(forest.groups), 1)
    model = layout.tables(0, len(layout.starts) - 1) | {"p": forest.leaf_p()[layout.order], "trees": forest.trees, "seeds": len(forest.seeds), "folds": folds, "depth": forest.depth}
    shared = df.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        m = shared.value
        for *columns, fold in batches:
            x, fold = np.stack([c.to_numpy() for c in columns], axis=1), np.maximum(fold.to_numpy(), 0)
            out = np.zeros((len(x), m["seeds"]))
            for f in np.unique(fold):
                rows = np.flatnonzero(fold == f)
                for piece, flat, row in _pieces(x[rows]):
                    for s in range(m["seeds"]):
                        begin, total = (s * m["folds"] + f) * m["trees"], np.zeros(len(row))
                        for t in range(begin, begin + m["trees"], TREES):
                            end = min(t + TREES, begin + m["trees"])
                            total += m["p"].take(walk(flat, row, m, t, end, m["depth"])).reshape(end - t, -1).sum(axis=0)
                        out[rows[piece], s] = total / m["trees"]
            yield pd.Series(list(out))

    score.__annotations__ = {"batches": Iterator[tuple[pd.Series, ...]], "return": Iterator[pd.Series]}
    return df.withColumn("ps", pandas_udf(score, "array<double>")(*map(_filled, forest.features), fold_of(forest.groups, group)))


def importances(forest: Forest, fit: int = 0) -> list[float]:
    """Of each feature, the mean over the trees of a fit of its share of all decrease of impurity."""
    inner = np.flatnonzero((forest.feature >= 0) & (forest.tree // forest.trees == fit))
    w = forest.counts * forest.weight[fit]
    cost = _purity(w[:, 0], w[:, 1])
    gain = cost[inner] - cost[forest.left[inner]] - cost[forest.left[inner] + 1]
    per = np.zeros((forest.trees, len(forest.features)))
    np.add.at(per, (forest.tree[inner] - fit * forest.trees, forest.feature[inner]), gain)
    total = per.sum(axis=1, keepdims=True)
    per = np.divide(per, total, out=np.zeros(per.shape), where=total > 0)
    mean = per.mean(axis=0)
    return list(mean / mean.sum()) if mean.sum() > 0 else list(mean)
