"""Exact top-k inner-product search by pivot-table elimination."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, written

K = 20
#: Pivots, chosen far apart from CANDIDATES times as many vectors (those whose rows hash lowest). A bounded
#: sample that only decides how sharp the bounds are.
PIVOTS, CANDIDATES = 64, 32
#: Queries and vectors that one task compares; its memory follows from these alone.
QUERY_BLOCK, VECTOR_BLOCK = 1024, 8192
#: Components that a block of vectors has at most (wide vectors make smaller blocks).
CELLS = 1 << 21
#: Queries whose bounds are held at once, and candidates a query evaluates before its first look at the bounds.
CHUNK, STEP = 32, 512
#: Share of a block from which the candidates of a query are evaluated as a product of matrices.
GATHER = 0.1
#: What rounding may take off a bound, as a share of the norms and distances it is made of (float64, float32).
SLACK, SLACK_32 = 1e-9, 4e-6
LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1


def quantised(embedding: Column, scale: float = 64.0) -> Column:
    """floor(scale * x) of each component; null where the vector or a component is null or not finite."""
    fine = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.when(fine, F.transform(embedding, lambda x: F.floor(F.lit(scale) * x.cast("double"))))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column, filled up with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(lengths) and (lengths == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(lengths), width), flat.dtype)
    starts = np.cumsum(lengths) - lengths
    for k, (s, n) in enumerate(zip(starts, lengths, strict=True)):
        out[k, :n] = flat[s : s + n]
    return out


def distances(v: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """``(vectors, pivots)``; from differences, so near ones lose no digits."""
    out = np.zeros((len(v), len(centre)))
    for p, c in enumerate(centre):
        out[:, p] = np.sqrt(((v - c) ** 2).sum(1))
    return out


def far_apart(some: list[list[int]], width: int, pivots: int) -> np.ndarray:
    """Pivots: the first vector, then again and again the one farthest from those chosen."""
    v = np.zeros((len(some), width))
    for k, row in enumerate(some):
        v[k, : len(row)] = row
    chosen: list[int] = []
    far = np.full(len(v), np.inf)
    while len(chosen) < pivots and len(v) and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, ((v - v[chosen[-1]]) ** 2).sum(1))
    return v[chosen]


@dataclass
class Side:
    """Vectors of one side of a block pair, with the numbers of their rows, ids, distances to the pivots and norms."""

    row: np.ndarray
    vec_id: np.ndarray
    v: np.ndarray
    far: np.ndarray
    least: np.ndarray | None = None  # queries: a score that k other rows are known to reach

    @staticmethod
    def of(table: pa.Table, width: int, pivots: int) -> Side:
        least = table["least"].to_numpy() if "least" in table.column_names else None
        return Side(table["row"].to_numpy(), table["vec_id"].to_numpy(), matrix(table["v"], width), matrix(table["far"], pivots), least)


def inner_products(q: np.ndarray, v: np.ndarray, exact: bool) -> np.ndarray:
    """Scores ``(queries, vectors)``; where a long might overflow, by whole numbers of any size, ending at the range of a long."""
    if exact:
        return (q @ v.T).astype(np.int64)
    wide = q.astype(object) @ v.astype(object).T
    return np.array([[max(LOWEST + 1, min(HIGHEST, int(x))) for x in row] for row in wide], np.int64).reshape(wide.shape)


def best(query: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Which of these answers are among the k best of their query, best first within each query."""
    order = np.lexsort((ids, ~scores, query))
    start = np.concatenate(([True], query[order][1:] != query[order][:-1])) if len(order) else np.zeros(0, bool)
    place = np.arange(len(order)) - np.flatnonzero(start)[np.cumsum(start) - 1] if len(order) else order
    return order[place < k]


def best_of_block(queries: Side, vectors: Side, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """``(query row, query_id, vec_id, score)`` of the k best vectors of this block for each query, and how many pairs were evaluated.

    Distances to pivots give d(q, v) >= max |d(q, p) - d(v, p)|, and so q.v = (|q|^2 + |v|^2 - d^2) / 2 has
    an upper bound. Each query evaluates vectors in the order of its own bounds, STEP of them and then all whose bound
    reaches the k-th score it has by then; no other can be among its k (a tie is still evaluated).
    ``queries.least`` is a k-th score known from another block: with it the second step is the first, and a block whose bounds
    don't reach it is not evaluated at all. Score and id are kept apart; the slack of the bounds is relative to
    the norms and distances they are made of.
    """
    reach = max(float(np.abs(x.v.astype(np.float64)).max(initial=0)) for x in (queries, vectors))
    width, n = max(1, vectors.v.shape[1]), len(vectors.row)
    exact = reach * reach * width < 2.0**62
    # products of float64 are exact below 2^53, and faster than those of int64; bounds may be coarse where numbers are small
    kind = np.float64 if reach * reach * width < 2.0**52 else np.int64
    real, slack = (np.float32, SLACK_32) if reach * width < 1e15 else (np.float64, SLACK)
    q_num, v_num = queries.v.astype(kind), vectors.v.astype(kind)
    v_norm, q_norm = ((x.v.astype(np.float64) ** 2).sum(1).astype(real) for x in (vectors, queries))
    v_far, q_far = np.ascontiguousarray(vectors.far.T.astype(real)), queries.far.astype(real)
    own = {r: j for j, r in enumerate(vectors.row.tolist())}
    evaluated, out = 0, []

    def answers(q: np.ndarray, c: np.ndarray, scores: np.ndarray) -> None:
        """Of evaluated pairs the k best of each query are kept and lift its k-th score."""
        keep = best(q, vectors.vec_id[c], scores, k)
        q, c, scores = q[keep], c[keep], scores[keep]
        out.append((q, vectors.vec_id[c], scores))
        last = np.flatnonzero(np.append(q[1:] != q[:-1], True)) if len(q) else keep
        count = np.diff(np.concatenate(([-1], last)))
        full = last[count == k]
        least[q[full]] = np.maximum(least[q[full]], scores[full])

    least = np.full(len(queries.row), LOWEST) if queries.least is None else queries.least.copy()
    for at in range(0, len(queries.row), CHUNK):
        rows = np.arange(at, min(at + CHUNK, len(queries.row)))
        far, one = np.zeros((len(rows), n), real), np.empty((len(rows), n), real)
        for p in range(len(v_far)):
            np.subtract(v_far[p], q_far[rows, p][:, None], out=one)
            np.maximum(far, np.abs(one, out=one), out=far)
        scale = q_norm[rows][:, None] + v_norm
        bound = scale * real(0.5 + slack) - np.square(far, out=far) * real(0.5) + real(slack) * (np.square(q_far[rows].max(1, initial=0))[:, None] + 1)
        mine = np.array([own.get(r, -1) for r in queries.row[rows].tolist()])
        bound[np.flatnonzero(mine >= 0), mine[mine >= 0]] = -np.inf  # a query is no candidate of its own
        new = rows[least[rows] == LOWEST]
        if len(new) and n:
            m = min(STEP, n)
            head = np.argpartition(-bound[new - at], m - 1, axis=1)[:, :m]
            for j, c in zip(new, head, strict=True):
                c = c[bound[j - at, c] > -np.inf]
                evaluated += len(c)
                answers(np.full(len(c), j), c, inner_products(q_num[j : j + 1], v_num[c], exact)[0])
                bound[j - at, c] = -np.inf
        open_ = (bound >= least[rows][:, None].astype(np.float64)) & (bound > -np.inf)
        share = open_.sum(1)
        evaluated += int(share.sum())
        few = np.flatnonzero((share > 0) & (share < n * GATHER))
        for j in few:
            c = np.flatnonzero(open_[j])
            answers(np.full(len(c), rows[j]), c, inner_products(q_num[rows[j] : rows[j] + 1], v_num[c], exact)[0])
        many = np.flatnonzero(share >= max(1, n * GATHER))
        if len(many):  # cheaper as one product of matrices; pairs whose bound is too low are not looked at
            scores = np.where(open_[many], inner_products(q_num[rows[many]], v_num, exact), LOWEST)
            kth = np.maximum(np.partition(scores, max(0, n - k), axis=1)[:, max(0, n - k)], LOWEST + 1)
            j, c = np.nonzero(scores >= kth[:, None])
            answers(rows[many[j]], c, scores[j, c])
    none = np.zeros(0, np.int64)
    q, ids, scores = (np.concatenate(x) for x in zip(*out, strict=True)) if out else (none, none, none)
    keep = best(q, ids, scores, k)
    keep = keep[scores[keep] >= least[q[keep]]] if queries.least is not None else keep
    return queries.row[q[keep]], queries.vec_id[q[keep]], ids[keep], scores[keep], evaluated


def top_k(embeddings: DataFrame, k: int = K, every: int = 20, vec_id: str = "vec_id", embedding: str = "embedding", pivots: int = PIVOTS, query_block: int = QUERY_BLOCK, vector_block: int = VECTOR_BLOCK) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best other rows for each query row, ties to the smaller id.

    Queries are the rows whose id is divisible by ``every``. Vectors of one pivot lie together in blocks. First each
    query meets its own block, which gives it a k-th score; then it meets the other blocks with that score in
    hand. A block pair is a task of bounded size. Rows that repeat an id are rows of their own: each is a candidate of the
    others, and each gets its k. Vectors that are null or hold null or non-finite components, and rows without id, take no
    part. Shorter vectors are filled up with zeros. Components and scores beyond the range of a long end at it. An
    empty table gives no rows.
    """
    rows = embeddings.select(F.col(vec_id).cast("long").alias("vec_id"), quantised(F.col(embedding)).alias("v")).filter("vec_id is not null and v is not null")
    rows = written(rows.withColumn("row", F.monotonically_increasing_id()), "topk-vectors")
    size = rows.agg(F.max(F.size("v")), F.sum((F.col("vec_id") % every == 0).cast("long"))).first()
    width, asked = size[0] or 0, size[1] or 0
    centre = far_apart([r[0] for r in rows.orderBy(F.xxhash64("vec_id", "row"), "row").limit(CANDIDATES * pivots).select("v").collect()], width, pivots)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, STEP):
                part = batch.slice(at, STEP)
                v = matrix(part.column(1), width).astype(np.float64)
                far = distances(v, centre)
                home = far.argmin(1) if len(centre) else np.zeros(len(v), np.int64)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(v) + 1, dtype=np.int32) * len(centre)), pa.array(far.ravel()))
                yield pa.RecordBatch.from_arrays([*part.columns, lists, pa.array(home.astype(np.int32))], names=["vec_id", "v", "row", "far", "home"])

    table = written(rows.mapInArrow(measure, "vec_id long, v array<long>, row long, far array<double>, home int"), "topk-pivots")
    discard(rows)
    n_query, vector_block = max(1, -(-asked // query_block)), max(1, min(vector_block, CELLS // max(1, width)))
    # the blocks of a pivot follow from how many vectors it has
    per = table.groupBy("home").agg(F.count("*").alias("n")).orderBy("home").collect()
    first, blocks = {}, 0
    for r in per:  # at most one row for each pivot
        first[r[0]] = (blocks, -(-r[1] // vector_block))
        blocks += first[r[0]][1]
    ends = F.create_map(*[F.lit(x) for h, (at, n) in first.items() for x in (h, (at << 32) + n)]) if first else F.create_map(F.lit(0), F.lit(1))
    packed = ends[F.col("home")]
    at, parts = F.shiftright(packed, 32), packed.bitwiseAND(F.lit((1 << 32) - 1))
    placed = table.withColumn("vb", (at + F.pmod(F.xxhash64("row"), parts)).cast("int"))
    pivots_n, ddl = len(centre), "query long, query_id long, vec_id long, score long"

    def answers(queries: pa.Table, vectors: pa.Table) -> pa.Table:
        found = [np.zeros(0, np.int64)] * 4
        if queries.num_rows and vectors.num_rows:
            found = best_of_block(Side.of(queries, width, pivots_n), Side.of(vectors, width, pivots_n), k)[:4]
        return pa.table({n: pa.array(x) for n, x in zip(("query", "query_id", "vec_id", "score"), found, strict=True)})

    def own_block(block: pa.Table) -> pa.Table:
        return answers(block.filter(pc.equal(pc.subtract(block["vec_id"], pc.multiply(pc.divide(block["vec_id"], every), every)), 0)), block)

    home = written(placed.groupBy("vb").applyInArrow(own_block, ddl), "topk-home")
    least = home.groupBy("query").agg(F.count("*").alias("n"), F.min("score").alias("least")).filter(F.col("n") == k).select(F.col("query").alias("row"), "least")
    queries = placed.filter(F.col("vec_id") % every == 0).join(least, "row", "left").withColumn("least", F.coalesce("least", F.lit(LOWEST)))
    queries = queries.withColumn("qb", F.pmod(F.xxhash64("row", F.lit(7)), F.lit(n_query)).cast("int"))
    other = queries.withColumn("vb", F.explode(F.array_except(F.sequence(F.lit(0), F.lit(max(blocks - 1, 0))), F.array("vb"))))
    vectors = placed.select(*[F.col(c).alias(c) for c in placed.columns]).withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(n_query - 1))))
    rest = other.groupBy("qb", "vb").cogroup(vectors.groupBy("qb", "vb")).applyInArrow(answers, ddl)
    rank = Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id")
    met = home.unionByName(rest).withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= k)
    return met.select("query_id", "rank", "vec_id", "score")
