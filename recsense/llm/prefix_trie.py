"""The trie of conversation prefixes and totals over its subtrees, by a rollup over bands of depths."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written
from .turns import conversation_runs, numbered, sorted_turns

#: Depths in a band: a node explodes to at most so many ancestors.
BAND = 16
#: Turns in a block of a running sum.
BLOCK = 1024
#: Conversations to a family, and shared turns less one at most.
FAMILY, MOST_SHARED = 5, 8
#: Ids of one stretch of numbers that are joined before they are hashed.
STRETCH = 4096
NO_TEXT = hashlib.sha256(b"").hexdigest()
LANES = ["s0", "s1", "s2", "s3"]
TOTALS = ["leaves", "saved"]
LOW = 0xFFFFFFFF


def _terms() -> list[Column]:
    """Four 32-bit numbers of a turn at its depth; their sums over a prefix name the prefix."""
    a, b = (F.xxhash64(F.lit(k), F.col("depth"), F.col("digest")) for k in (1, 2))
    return [c.alias(n) for n, c in zip(LANES, (F.shiftrightunsigned(a, 32), a.bitwiseAND(F.lit(LOW)), F.shiftrightunsigned(b, 32), b.bitwiseAND(F.lit(LOW))), strict=True)]


def _packed(lanes: list[Column], names: tuple[str, str]) -> list[Column]:
    low = [x.bitwiseAND(F.lit(LOW)) for x in lanes]
    return [F.shiftleft(low[k], 32).bitwiseOR(low[k + 1]).alias(name) for k, name in ((0, names[0]), (2, names[1]))]


def rebuilt_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(conv_id, depth, digest, n_bytes)`` of the turns of every rebuilt conversation, and ``(conv_id, length)`` of each.

    The first h turns of conversation c - c % 5 are followed by c's own turns after its first h, where h is the crc32 of
    c's decimal text modulo 9.
    """
    text, role = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("text", "role"))
    rows = conversations.filter("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    content = F.unhex(F.sha2(F.concat_ws(":", F.length("role"), "role", "text"), 256)).alias("digest")
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    turns = sorted_turns(rows, order, [F.col("conv_id"), content, F.octet_length("text").cast("long").alias("n_bytes")], "trie-turns")
    runs = conversation_runs(turns)
    convs = runs.join(turns.groupBy(F.col("conv_id").alias("run_conv")).agg(F.count(F.lit(1)).alias("n")), "run_conv")
    convs = convs.groupBy("run_conv").agg(F.first("n").alias("n"))
    shared = F.crc32(F.col("run_conv").cast("string").cast("binary")) % (MOST_SHARED + 1)
    convs = convs.withColumns({"h": shared, "base": F.col("run_conv") - F.col("run_conv") % FAMILY})
    of_base = convs.filter(F.col("run_conv") == F.col("base")).select(F.col("base").alias("of_base"), F.col("n").alias("n_base"))
    convs = convs.join(of_base, F.col("base") == F.col("of_base"), "left").withColumn("k", F.least("h", F.coalesce("n_base", F.lit(0))))
    convs = written(convs.select("run_conv", "base", "h", "k", (F.col("k") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length")), "trie-conversations")
    own = numbered(turns, runs.join(convs.select("run_conv", "h", "k"), "run_conv")).filter("place >= h")
    own = own.select("conv_id", (F.col("k") + F.col("place") - F.col("h") + 1).alias("depth"), "digest", "n_bytes")
    heads = numbered(turns.filter(F.col("conv_id") % FAMILY == 0), runs.filter(F.col("run_conv") % FAMILY == 0)).filter(F.col("place") < MOST_SHARED)
    heads = heads.withColumnRenamed("conv_id", "base").join(convs, "base").filter("place < h")
    heads = heads.select(F.col("run_conv").alias("conv_id"), (F.col("place") + 1).alias("depth"), "digest", "n_bytes")
    return own.unionByName(heads), convs.select(F.col("run_conv").alias("conv_id"), "length")


def prefixes(turns: DataFrame, convs: DataFrame, block: int = BLOCK) -> DataFrame:
    """``(conv_id, depth, a, b, parent_a, parent_b, n_bytes, last)`` of every prefix of every rebuilt conversation, written.

    ``a, b`` name the sequence of turns: sums of 128 bits for each turn and depth. Running sums go over blocks of turns, then over
    the blocks, so a long conversation isn't one task.
    """
    terms = turns.select("conv_id", "depth", "n_bytes", F.expr(f"(depth - 1) div {block}").alias("block"), *_terms())
    inside = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = terms.groupBy("conv_id", "block").agg(*[F.sum(x).alias(x) for x in LANES])
    carried = blocks.select("conv_id", "block", *[F.coalesce(F.sum(x).over(before), F.lit(0)).alias(f"carried_{x}") for x in LANES])
    sums = terms.select("*", *[F.sum(x).over(inside).alias(f"sum_{x}") for x in LANES]).join(carried, ["conv_id", "block"])
    lanes = [F.col(f"sum_{x}") + F.col(f"carried_{x}") for x in LANES]
    parents = [total - F.col(x) for total, x in zip(lanes, LANES, strict=True)]
    named = sums.select("conv_id", "depth", *_packed(lanes, ("a", "b")), *_packed(parents, ("parent_a", "parent_b")), "n_bytes")
    none = F.lit(0).cast("long")
    roots = convs.select("conv_id", none.alias("depth"), none.alias("a"), none.alias("b"), none.alias("parent_a"), none.alias("parent_b"), none.alias("n_bytes"))
    found = named.unionByName(roots).join(convs, "conv_id")
    return written(found.withColumn("last", F.col("depth") == F.col("length")).drop("length"), "trie-prefixes")


def band_totals(paths: DataFrame, values: DataFrame, stride: int, band: int = BAND) -> DataFrame:
    """``(a, b, leaves, saved)``: of each node at a multiple of ``stride``, the values below it in its band.

    ``values`` holds ``(conv_id, depth, leaves, saved)`` of those nodes under their smallest member. The nodes
    of one member in one band, at most ``band``, are summed from below before anything is exploded to their ancestors.
    """
    rows = paths.filter(F.col("depth") % stride == 0).select("conv_id", "depth", "a", "b").join(values, ["conv_id", "depth"], "left")
    groups = rows.groupBy("conv_id", F.expr(f"depth div {stride * band}").alias("band")).agg(F.sort_array(F.collect_list(F.struct("depth", "a", "b", *TOTALS))).alias("path"))
    groups = groups.filter(F.exists("path", lambda x: x["leaves"].isNotNull()))

    def below(field: str) -> Column:
        return lambda x, k: F.aggregate(F.slice("path", k + 1, F.size("path")), F.lit(0).cast("long"), lambda t, y: t + F.coalesce(y[field], F.lit(0)))

    summed = F.transform("path", lambda x, k: F.struct(x["a"].alias("a"), x["b"].alias("b"), *[below(f)(x, k).alias(f) for f in TOTALS]))
    return groups.select(F.inline(summed)).groupBy("a", "b").agg(*[F.sum(f).alias(f) for f in TOTALS])


def subtree_totals(paths: DataFrame, nodes: DataFrame, band: int = BAND) -> DataFrame:
    """``(a, b, leaves, saved)``: sums of those columns of ``nodes`` over each node's whole subtree.

    Rollup over bands of depths: nodes explode to their ancestors inside their band alone. The roots of bands are then nodes of a trie whose
    steps are whole bands, which is rolled up in the same way, so that rounds grow with the logarithm of the greatest depth. Finished
    totals of band roots go back down, to the ancestors in the band above them.
    """
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    keys = nodes.select("a", "b", "conv_id", "depth")
    levels, values, stride = [], nodes.select("conv_id", "depth", *TOTALS), 1
    while True:
        partial = written(band_totals(paths, values, stride, band).join(keys, ["a", "b"]), "trie-band")
        levels.append((stride, partial))
        stride *= band
        if stride > deepest:
            break
        values = partial.filter(F.col("depth") % stride == 0).select("conv_id", "depth", *TOTALS)
    total = levels[-1][1]
    for stride, partial in levels[-2::-1]:
        upward = F.transform(F.sequence(F.lit(1), F.lit(band)), lambda k: F.col("depth") - k * stride)
        given = total.filter(f"depth > 0 and depth % {stride * band} = 0").select("conv_id", F.explode(upward).alias("depth"), *[F.col(f).alias(f"given_{f}") for f in TOTALS])
        given = given.join(paths.select("conv_id", "depth", "a", "b"), ["conv_id", "depth"]).groupBy("a", "b").agg(*[F.sum(f"given_{f}").alias(f"given_{f}") for f in TOTALS])
        both = partial.join(given, ["a", "b"], "left")
        total = written(both.select("a", "b", "conv_id", "depth", *[(F.col(f) + F.coalesce(f"given_{f}", F.lit(0))).alias(f) for f in TOTALS]), "trie-totals")
    return total.select("a", "b", *TOTALS)


def hashed_members(paths: DataFrame) -> DataFrame:
    """``(a, b, ends_sha256)``: the SHA-256 of the comma-joined ids, ascending, of the conversations that end at a node.

    Ids are joined stretch by stretch; the digest of a node then streams over its stretches in order, whatever their number.
    """
    ended = paths.filter("last").select("a", "b", "conv_id", F.floor(F.col("conv_id") / F.lit(STRETCH)).cast("long").alias("stretch"))
    joined = ended.groupBy("a", "b", "stretch").agg(F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))

    def digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        node, state = None, None
        for batch in batches:
            out = []
            for a, b, ids in zip(batch["a"], batch["b"], batch["ids"], strict=True):
                if node == (a, b):
                    state.update(b",")
                else:
                    if state:
                        out.append((*node, state.hexdigest()))
                    node, state = (a, b), hashlib.sha256()
                state.update(ids.encode())
            yield pd.DataFrame(out, columns=["a", "b", "ends_sha256"])
        if state:
            yield pd.DataFrame([(*node, state.hexdigest())], columns=["a", "b", "ends_sha256"])

    return joined.repartition("a", "b").sortWithinPartitions("a", "b", "stretch").select("a", "b", "ids").mapInPandas(digests, "a long, b long, ends_sha256 string")


def prefix_trie(conversations: DataFrame, band: int = BAND, block: int = BLOCK) -> DataFrame:
    """One row per distinct prefix of the rebuilt conversations (:func:`rebuilt_turns`), the textless root included.

    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (root: null), ``n_convs``, ``n_children``, ``n_leaves`` and
    ``saved_tokens`` over the subtree, ``ends_sha256``. Turns are ordered by turn, null first, ties by role and then text; null roles and texts
    are empty. Rows that repeat are turns of their own. Rows without a conv_id belong to no conversation and take
    no part. Prefixes are equal when 128 bits of sums over SHA-256 digests of their turns are. Texts of any length are hashed
    whole. An empty table has no members and gives no rows. Further columns play no part.
    """
    turns, convs = rebuilt_turns(conversations)
    paths = prefixes(turns, convs, block)
    nodes = paths.groupBy("a", "b").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), *[F.min(c).alias(c) for c in ("depth", "parent_a", "parent_b", "n_bytes")])
    children = nodes.filter("depth > 0").groupBy(F.col("parent_a").alias("a"), F.col("parent_b").alias("b")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = nodes.join(children, ["a", "b"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    own = {"leaves": F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long"), "saved": (F.col("n_convs") - 1) * F.col("n_bytes")}
    nodes = written(nodes.withColumns(own), "trie-nodes")
    totals = subtree_totals(paths, nodes, band)
    parents = nodes.select(F.col("a").alias("parent_a"), F.col("b").alias("parent_b"), F.col("conv_id").alias("parent_conv_id"))
    found = nodes.drop(*TOTALS).join(parents, ["parent_a", "parent_b"], "left").join(totals, ["a", "b"]).join(hashed_members(paths), ["a", "b"], "left")
    parent = F.when(F.col("depth") > 0, F.col("parent_conv_id")).alias("parent_conv_id")
    return found.select("conv_id", "depth", parent, "n_convs", "n_children", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(NO_TEXT)).alias("ends_sha256"))
