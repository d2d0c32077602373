"""What substring deduplication by bytes and by words share: anchored blocks of windows, and their verification.

A window is a fixed number of units (bytes or words). Its anchor is the least of the hashes of the grams it
begins with, the leftmost of equals (winnowing), so equal windows have their anchor at the same place.
Neighbouring windows with the same anchor form a block. A block has two fingerprints: ``common``, of what all
its windows hold from the anchor on, and ``whole``, of all it covers. Blocks whose ``common`` is unique have
no repeated window; blocks equal in ``common`` and ``whole`` (128 bits) are equal throughout; only blocks that
are equal in ``common`` alone, at the edges of repeats, are compared window by window.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, written

#: Units that are hashed at once, unless one document has more.
UNITS = 1 << 19
#: Rows of an Arrow batch that are worked on at a time.
ROWS = 1000
#: One block in SAMPLE, of all documents, shows where the ranges of the sort are to be cut; blocks that a range may have.
SAMPLE, RANGE = 32, 500_000
#: A fingerprint with more than 1 / (HEAVY * ranges) of the blocks may be spread over ranges.
HEAVY = 4
#: Low bits of an order key that hold the place.
PLACE = 24
#: Stands for a null id; so it comes after all ids.
NO_ID = 9223372036854775807

#: Columns of hashes.
HASHES = ["common", "whole", "sides"]

#: What is said of a block: all its windows are repeated; its windows are to be compared; it belongs to the index.
WHOLE, COMPARE, INDEX = 1, 2, 4


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


@lru_cache(maxsize=4)
def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Hashes:
    """Hashes of any stretch of a sequence of 64-bit codes, from prefix sums of code * base ** place."""

    def __init__(self, codes: np.ndarray, base: int):
        size = max(2 * UNITS, 1 << int(len(codes)).bit_length())
        self.back = _powers(pow(base, -1, 1 << 64), size)
        self.sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(codes * _powers(base, size)[: len(codes)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.back[start])


@dataclass
class Shape:
    """Units of a window, of a gram, and how many grams from a window's start on can be its anchor.

    With ``lead`` the suffixes that begin at the anchors are sorted by their first units themselves (8 bytes),
    and by fingerprints of more units after that; without it by fingerprints alone.
    """

    window: int
    gram: int
    anchors: int
    lead: bool = False


@dataclass
class Deal:
    """How rows are dealt out to the ranges of a sort.

    ``split``: ascending values of the first key; a value that is several splitters has several ranges. ``heavy``:
    ascending fingerprints (``common``) with so many rows that they are spread over all ranges of their first key.
    """

    split: np.ndarray
    heavy: np.ndarray
    #: Rows whose first key is a hash need no splitters: so many ranges by a hash of it (:func:`dealt`).
    hashed: int = 0

    @property
    def ranges(self) -> int:
        return self.hashed or len(self.split) + 1

    def place(self, first: np.ndarray, common: np.ndarray, salt: np.ndarray) -> np.ndarray:
        """Range of each row: rows alike in ``common`` meet in one range, unless they are heavy."""
        low, high = np.searchsorted(self.split, first, "left"), np.searchsorted(self.split, first, "right")
        by = np.where(np.isin(common, self.heavy), salt.view(np.uint64), mixed(common.view(np.uint64)))
        return (low + (mixed(by) >> np.uint64(33)).astype(np.int64) % (high - low + 1)).astype(np.int32)


@dataclass
class Blocks:
    """Blocks of the documents ``[starts, ends)`` of one stretch of codes: windows ``first..last``."""

    first: np.ndarray
    last: np.ndarray
    common: np.ndarray
    whole: np.ndarray
    document: np.ndarray
    one: Hashes
    two: Hashes
    anchor: np.ndarray

    def windows(self, chosen: np.ndarray, shape: Shape) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """``(block, start, hash, second hash)`` of all windows of the chosen blocks."""
        n = self.last[chosen] - self.first[chosen] + 1
        block = np.repeat(chosen, n)
        start = self.first[block] + np.arange(len(block)) - np.repeat(np.cumsum(n) - n, n)
        return block, start, self.one.of(start, start + shape.window), self.two.of(start, start + shape.window)

    def sides(self, shape: Shape) -> np.ndarray:
        """What the windows of each block hold on either side of the anchor: two fingerprints of 32 bits, 0 for none.

        Windows that begin ``half`` units or more before the anchor hold those units, all others hold the ones that
        follow up to where the last of them ends. Equal windows have their anchor at the same place, so blocks
        that agree on neither side have no window in common.
        """
        half, m = shape.anchors // 2, self.anchor
        before = self.one.of(np.maximum(m - half, 0), m + shape.window - shape.anchors + 1)
        after = self.one.of(m, np.minimum(m + shape.window - half + 1, len(self.one.sums) - 1))
        before, after = (x >> np.uint64(32) | np.uint64(1) for x in (before, after))
        before[m - self.first < half] = 0
        after[m - self.last >= half] = 0
        return before << np.uint64(32) | after


def blocks(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray, shape: Shape, prefer: np.ndarray | None = None) -> Blocks:
    """``prefer`` (0..255 per unit) makes grams with a large sum the anchors, before their hashes decide."""
    one, two = Hashes(codes, 0x5851F42D4C957F2D), Hashes(mixed(codes + np.uint64(1)), 0x14057B7EF767814F | 5)
    n = len(codes)
    long_enough = ends - starts >= shape.window
    step = np.zeros(n + 1, np.int32)
    step[starts[long_enough]] += 1
    step[ends[long_enough] - shape.window + 1] -= 1
    p = np.flatnonzero(np.cumsum(step[:n]))
    none = np.zeros(0, np.int64)
    if not len(p):
        return Blocks(none, none, np.zeros(0, np.uint64), np.zeros(0, np.uint64), none, one, two, none)
    place = np.arange(n - shape.gram + 1)
    order = one.of(place, place + shape.gram)
    if prefer is not None:
        weight = np.concatenate(([0], np.cumsum(prefer)))
        weight = 255 - np.minimum(weight[shape.gram :] - weight[: n - shape.gram + 1], 255)
        order = (order >> np.uint64(8)) | (weight.astype(np.uint64) << np.uint64(56))
    if n >= 1 << PLACE:
        anchor = _leftmost_least(order, p, shape.anchors)
    else:
        key = (order >> np.uint64(PLACE) << np.uint64(PLACE)) | place.astype(np.uint64)
        width, least = 1, key
        while width * 2 <= shape.anchors:
            least = np.minimum(least[:-width], least[width:]) if len(least) > width else least
            width *= 2
        rest = shape.anchors - width
        anchor = (np.minimum(least[p], least[p + rest]) & np.uint64((1 << PLACE) - 1)).astype(np.int64)
    cut = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
    first, last, m = p[cut], p[np.concatenate((cut[1:], [len(p)])) - 1], anchor[cut]
    common = one.of(m, m + shape.window - shape.anchors + 1)
    shape_code = mixed(((m - first).astype(np.uint64) << np.uint64(32)) + (last - first).astype(np.uint64))
    whole = two.of(first, last + shape.window) ^ shape_code
    return Blocks(first, last, common, whole, np.searchsorted(starts, first, "right") - 1, one, two, m)


def _leftmost_least(order: np.ndarray, p: np.ndarray, anchors: int) -> np.ndarray:
    """The same for documents whose places don't fit the key: slower, a part at a time."""
    view = np.lib.stride_tricks.sliding_window_view(order >> np.uint64(PLACE), anchors)
    return np.concatenate([view[part].argmin(1) + part for part in np.array_split(p, len(p) // 65536 + 1)])


#: Makes codes of a text: ``(codes, preference or None)``.
Coder = Callable[[list[str]], tuple[list[np.ndarray], list[np.ndarray] | None]]


def stretches(texts: list[str], coder: Coder, shape: Shape) -> Iterator[tuple[int, list[np.ndarray], Blocks, np.ndarray]]:
    """Blocks of texts, some at a time: ``(first text, codes, blocks, starts)``."""
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end]) <= UNITS):
            size += len(texts[end])
            end += 1
        codes, prefer = coder(texts[at:end])
        ends = np.cumsum([len(c) for c in codes])
        starts = ends - [len(c) for c in codes]
        # empty documents share their start with the next one; the last of equal starts is the one with units
        yield at, codes, blocks(np.concatenate(codes), starts, ends, shape, np.concatenate(prefer) if prefer else None), starts
        at = end


def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches cut into ones of at most ROWS rows."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def leading(text: bytes, anchors: np.ndarray) -> np.ndarray:
    """The 8 bytes at each anchor as numbers in the order of the bytes."""
    view = np.lib.stride_tricks.sliding_window_view(np.frombuffer(text, np.uint8), 8)[anchors]
    return (np.ascontiguousarray(view).view(">u8").ravel().astype(np.uint64) ^ np.uint64(1 << 63)).view(np.int64)


def scan_blocks(docs: DataFrame, coder: Coder, shape: Shape, deal: Deal | None = None) -> DataFrame:
    """``(lead, common, whole, doc)`` of the blocks of ``(doc, text)`` rows; ``(common, whole, doc, sides)`` without ``shape.lead``.

    With a ``deal`` all blocks, with ``n`` (how often the document has the block: repeats within a document are
    summed up here), ``old`` (false) and, with ``shape.lead``, the ``range``; without a deal the first and last key
    of a sample of them.
    """
    names = ["lead"] * shape.lead + ["common", "whole", "doc"] + ["sides"] * (not shape.lead)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            doc = batch.column(0).to_numpy(zero_copy_only=False)
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for at, codes, found, _ in stretches(texts, coder, shape):
                common, whole = np.ascontiguousarray(found.common).view(np.int64), np.ascontiguousarray(found.whole).view(np.int64)
                of = doc[at + found.document]
                salt = mixed(found.whole ^ mixed(of.astype(np.uint64)))
                first = common
                if shape.lead:
                    first = leading("".join(texts[at : at + len(codes)]).encode(), found.anchor) if len(common) else common
                if deal is None:
                    some = np.flatnonzero(mixed(salt + found.first.astype(np.uint64)) % np.uint64(SAMPLE) == 0)
                    yield pa.RecordBatch.from_pydict({"first": pa.array(first[some]), "common": pa.array(common[some])})
                    continue
                # repeats of a block within a document as one row
                order = np.lexsort((whole, of))
                new = np.ones(len(order), bool)
                new[1:] = (whole[order[1:]] != whole[order[:-1]]) | (of[order[1:]] != of[order[:-1]])
                one = order[new]
                times = np.diff(np.append(np.flatnonzero(new), len(order)))
                columns = {"lead": first} if shape.lead else {}
                columns |= {"common": common, "whole": whole, "doc": of}
                if not shape.lead:
                    columns["sides"] = found.sides(shape).view(np.int64)
                columns = {k: pa.array(v[one]) for k, v in columns.items()}
                columns |= {"n": pa.array(times.astype(np.int64)), "old": pa.array(np.zeros(len(one), bool))}
                if shape.lead:
                    columns["range"] = pa.array(deal.place(first[one], common[one], salt[one].view(np.int64)))
                yield pa.RecordBatch.from_pydict(columns)

    if deal is None:
        return docs.mapInArrow(run, "first long, common long")
    return docs.mapInArrow(run, ", ".join(f"{c} long" for c in names) + ", n long, old boolean" + ", range int" * shape.lead)


def dealt(rows: DataFrame, deal: Deal) -> DataFrame:
    """Blocks ``(common, whole, doc, sides, n, old)`` with their ``range``: one for each ``common``, any for heavy ones."""
    salt = F.when(F.col("common").isin(deal.heavy.tolist()), F.xxhash64("whole", "doc")).otherwise(F.lit(0).cast("long"))
    return rows.withColumn("range", F.pmod(F.xxhash64("common", salt), F.lit(deal.ranges)).cast("int"))


def classify(common: np.ndarray, whole: np.ndarray, doc: np.ndarray, n_of: np.ndarray, by_count: bool, sides: np.ndarray | None = None) -> np.ndarray:
    """What is said of each block of rows sorted by ``(common, whole, doc)``, that stand for ``n_of`` blocks each.

    ``by_count``: equal blocks are repeated, all of them; else those of larger ids than the smallest are.
    Where blocks with one ``common`` differ in ``whole``, the first of each is to be compared; if ``sides`` are given,
    only where another one agrees on a side.
    """
    n = len(common)
    new_common = np.concatenate(([True], common[1:] != common[:-1]))
    new_whole = new_common | np.concatenate(([True], whole[1:] != whole[:-1]))
    group = np.cumsum(new_whole) - 1
    of_common = np.cumsum(new_common) - 1
    kinds = np.bincount(of_common, new_whole)  # different blocks of each common
    if by_count:
        repeated = np.bincount(group, n_of)[group] > 1
    else:
        repeated = doc > doc[np.flatnonzero(new_whole)][group]
    compare = new_whole & (kinds[of_common] > 1)
    if sides is not None:
        some = np.flatnonzero(compare)
        agree = np.zeros(len(some), bool)
        for shift in (32, 0):
            side = sides[some] >> shift & 0xFFFFFFFF
            _, at, times = np.unique(of_common[some] << 32 | side, return_inverse=True, return_counts=True)
            agree |= (times[at] > 1) & (side != 0)
        compare[some] = agree
    return repeated * WHOLE + compare * COMPARE + new_whole * INDEX if n else np.zeros(0, np.int64)


def multikey_order(*keys: np.ndarray) -> np.ndarray:
    """Order of rows by several keys: by the first one, then each stretch of equals by the next (multikey quicksort)."""
    order = np.argsort(keys[0], kind="quicksort")
    same = _as_before(keys[0][order])
    for key in keys[1:]:
        rows = np.flatnonzero(same | np.append(same[1:], False))
        if not len(rows):
            break
        stretch = np.cumsum(~same)[rows]
        order[rows] = order[rows][np.lexsort((key[order[rows]], stretch))]
        same &= _as_before(key[order])
    return order


def _as_before(values: np.ndarray) -> np.ndarray:
    return np.concatenate((np.zeros(min(1, len(values)), bool), values[1:] == values[:-1]))


def splitters(texts: DataFrame, coder: Coder, shape: Shape) -> Deal:
    """Deals blocks out evenly, by a sample of the blocks of all documents."""
    sample = written(scan_blocks(texts, coder, shape), "block-sample")
    deal = deal_of(sample)
    discard(sample)
    return deal


def hashed_deal(rows: DataFrame) -> Deal:
    """Deals written blocks ``(common, whole, doc)`` out by a hash: how many ranges, and which fingerprints are too frequent for one."""
    some = F.pmod(F.xxhash64("common", "whole", "doc"), F.lit(SAMPLE)) == 0
    sample = written(rows.filter(some).select("common"), "block-sample", ["common"])
    taken = sample.count()
    n = ranges_for(sample, taken)
    deal = Deal(np.zeros(0, np.int64), heavy_ones(sample, taken, n), n)
    discard(sample)
    return deal


def ranges_for(sample: DataFrame, taken: int) -> int:
    return max(int(sample.sparkSession.conf.get("spark.sql.shuffle.partitions")), taken * SAMPLE // RANGE + 1)


def heavy_ones(sample: DataFrame, taken: int, n: int) -> np.ndarray:
    """Fingerprints with more than a HEAVY-th of what is due to one of ``n`` ranges."""
    found = sample.groupBy("common").count().filter((F.col("count") > 1) & (F.col("count") * F.lit(HEAVY * n) > taken)).select("common").collect()
    return np.sort(np.array([r[0] for r in found], np.int64))


def deal_of(sample: DataFrame) -> Deal:
    """Ranges from a sample ``(first, common)`` of one block in SAMPLE, which is read a few times.

    The number of ranges follows from the shuffle partitions and from how many blocks the sample lets expect, so
    that a range has about RANGE blocks at any size. What comes to the driver are the splitters, and at most
    HEAVY fingerprints a range.
    """
    taken = sample.count()
    n = ranges_for(sample, taken)
    found = sample.agg(F.percentile_approx("first", [k / n for k in range(1, n)], 10 * n)).first()[0] if n > 1 else None
    # without a sample (a handful of blocks in all) one range holds everything
    return Deal(np.array(found or [], np.int64), heavy_ones(sample, taken, n))


def sorted_pass(rows: DataFrame, deal: Deal, by_count: bool, lead: bool = False, index: bool = False) -> DataFrame:
    """``(common, whole, doc, old, kind, n)``, and ``sides`` without ``lead``, of blocks of which something is to be said, out of the rows of :func:`scan_blocks`.

    Blocks are dealt out by the ranges between the splitters; each range is sorted on its own by a multikey
    quicksort (leading units, fingerprints of what follows, document), and neighbours are compared. Blocks
    that are alike in ``common`` meet in one range unless they are heavy: of heavy ones each different block is
    given once more, with kind 0, its smallest id and its number, for :func:`over_boundaries`. ``old``
    blocks are of earlier batches and are only named again where they are to be compared.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        names = ["lead"] * lead + ["common", "whole", "doc"]
        order = multikey_order(*(table[n].to_numpy() for n in names))
        common, whole, doc, times, old = (table[n].to_numpy()[order] for n in ("common", "whole", "doc", "n", "old"))
        sides = None if lead else table["sides"].to_numpy()[order]
        kind = classify(common, whole, doc, times, by_count, sides)
        first = kind & INDEX > 0
        number = np.bincount(np.cumsum(first) - 1, times).astype(np.int64)[np.cumsum(first) - 1]
        edge = np.isin(common, deal.heavy)
        said = np.where(old, kind & COMPARE, kind)
        said = np.where(edge, said & WHOLE, said if index else said & ~INDEX)
        for take, what in ((np.flatnonzero(said), said), (np.flatnonzero(edge & first), np.zeros_like(said))):
            for part in np.array_split(take, len(take) // 100_000 + 1):
                columns = {"common": common, "whole": whole, "doc": doc, "old": old, "kind": what.astype(np.int32), "n": number}
                if not lead:
                    columns["sides"] = sides
                yield pa.RecordBatch.from_pydict({k: pa.array(v[part]) for k, v in columns.items()})

    ranged = rows.repartitionById(deal.ranges, "range").drop("range")
    return ranged.mapInArrow(run, "common long, whole long, doc long, old boolean, kind int, n long" + ", sides long" * (not lead))


def over_boundaries(edges: DataFrame, by_count: bool, index: bool = False) -> DataFrame:
    """The same judgement as :func:`classify` for the different blocks of heavy ``common`` that several ranges hold.

    Here all of them are compared, whether they agree on a side or not. With ``index`` the rows name their ``sides``.
    """
    sides = [F.min("sides").alias("sides")] if index else []
    per = edges.groupBy("common", "whole").agg(F.sum("n").alias("n"), F.min("doc").alias("least"), F.min(~F.col("old")).alias("fresh"), *sides)
    # one row for each heavy fingerprint, HEAVY a range at most: small enough to be sent to all tasks
    kinds = F.broadcast(per.groupBy("common").agg(F.count("*").alias("kinds")))
    compare = per.join(kinds, "common").filter("kinds > 1").select("common", "whole", F.col("least").alias("doc"), F.lit(COMPARE).alias("kind"))
    other = per.select(F.col("common").alias("c"), F.col("whole").alias("w"), F.col("n").alias("all"), "least")
    repeated = (F.col("all") > 1) if by_count else (F.col("doc") > F.col("least"))
    whole = edges.filter("not old").join(other, (F.col("common") == F.col("c")) & (F.col("whole") == F.col("w"))).filter(repeated)
    out = compare.unionByName(whole.select("common", "whole", "doc", F.lit(WHOLE).alias("kind")))
    if index:
        out = out.unionByName(per.filter("fresh").select("common", "whole", F.col("least").alias("doc"), F.lit(INDEX).alias("kind"), "sides"), allowMissingColumns=True)
    return out


def keyed(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("doc"), F.col(text).alias("text"))


def finish(texts: DataFrame, said: DataFrame, by_count: bool, coder: Coder, shape: Shape, cut: Callable, fields: list[tuple[str, pa.DataType]], ddl: str, history: DataFrame | None = None) -> DataFrame:
    """Compare windows where blocks differ, then cut every text.

    ``texts``: ``(doc, text)``; ``said``: ``(whole, doc, kind)``, of documents of ``history`` too, which are
    compared but not cut. ``cut(text, covered)`` gives the output columns of one document from the mask of its
    covered units (None: nothing is). The texts are shuffled by id once; both joins read that shuffle.
    """
    compared = said.filter(F.col("kind").bitwiseAND(COMPARE) > 0).groupBy("doc").agg(F.collect_set("whole").alias("wholes"))

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            doc = batch.column(0).to_numpy(zero_copy_only=False)
            texts = [t or "" for t in batch.column(1).to_pylist()]
            wanted = batch.column(2)
            for at, _, found, _ in stretches(texts, coder, shape):
                chosen = _members(found, wanted, at, once=True)
                block, _, h1, h2 = found.windows(chosen, shape)
                yield pa.RecordBatch.from_arrays([signed(h1), signed(h2), signed(found.whole[block]), pa.array(doc[at + found.document[block]])], names=["h1", "h2", "whole", "doc"])

    known = texts if history is None else texts.unionByName(history)
    found = known.join(compared, "doc").select("doc", "text", "wholes").mapInArrow(windows, "h1 long, h2 long, whole long, doc long")
    if by_count:
        least = found.groupBy("h1", "h2").agg(F.min("whole").alias("a"), F.max("whole").alias("b")).filter("a != b")
        other = least.select(F.col("h1").alias("g1"), F.col("h2").alias("g2"))
        hits = found.join(other, (F.col("h1") == F.col("g1")) & (F.col("h2") == F.col("g2")))
    else:
        # the first row so far has the least id, so rows are judged as they come, and windows are made once
        before = Window.partitionBy("h1", "h2").orderBy("doc").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        hits = found.select("h1", "h2", "doc", F.first("doc").over(before).alias("least")).filter("doc > least")
    single = hits.groupBy("doc").agg(F.collect_set("h1").alias("singles"))
    wholes = said.filter(F.col("kind").bitwiseAND(WHOLE) > 0).groupBy("doc").agg(F.collect_set("whole").alias("wholes"))
    marks = wholes.join(single, "doc", "full")
    schema = pa.schema([("doc_id", pa.int64()), *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            doc = batch.column(0).to_pylist()
            texts = [t or "" for t in batch.column(1).to_pylist()]
            marked = np.flatnonzero(pc.or_(batch.column(2).is_valid(), batch.column(3).is_valid()).to_numpy(zero_copy_only=False))
            rows: list[tuple | None] = [None] * len(texts)
            wholes, singles = batch.column(2).take(marked), batch.column(3).take(marked)
            for at, codes, found, starts in stretches([texts[k] for k in marked], coder, shape):
                step = np.zeros(sum(map(len, codes)) + 1, np.int64)
                chosen = _members(found, wholes, at)
                np.add.at(step, found.first[chosen], 1)
                np.add.at(step, found.last[chosen] + shape.window, -1)
                some = np.flatnonzero(singles.is_valid().to_numpy(zero_copy_only=False)[at + found.document])
                block, start, h1, _ = found.windows(some, shape)
                own = found.document[block]
                edges = np.searchsorted(own, np.arange(len(codes) + 1))
                for d in np.unique(own).tolist():
                    mine = slice(edges[d], edges[d + 1])
                    hit = start[mine][np.isin(h1[mine].view(np.int64), singles[at + d].values.to_numpy())]
                    np.add.at(step, hit, 1)
                    np.add.at(step, hit + shape.window, -1)
                covered = np.cumsum(step[:-1]) > 0
                for k, (c, s) in enumerate(zip(codes, starts.tolist(), strict=True)):
                    rows[marked[at + k]] = cut(texts[marked[at + k]], covered[s : s + len(c)])
            rows = [cut(t, None) if r is None else r for t, r in zip(texts, rows, strict=True)]
            columns = [pa.array([None if d == NO_ID else d for d in doc], pa.int64())]
            columns += [pa.array([r[j] for r in rows], t) for j, (_, t) in enumerate(fields)]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return texts.join(marks, "doc", "left").select("doc", "text", "wholes", "singles").mapInArrow(run, f"doc_id long, {ddl}")


def _members(found: Blocks, wanted: pa.Array, at: int, once: bool = False) -> np.ndarray:
    """Blocks whose ``whole`` is in their document's list; with ``once`` the first of equals only."""
    out = []
    edges = np.searchsorted(found.document, np.arange(found.document[-1] + 2)) if len(found.document) else [0]
    for d in range(len(edges) - 1):
        value = wanted[at + d]
        if value.is_valid and edges[d] < edges[d + 1]:
            own = found.whole[edges[d] : edges[d + 1]].view(np.int64)
            hit = np.flatnonzero(np.isin(own, value.values.to_numpy()))
            if once:
                hit = hit[np.sort(np.unique(own[hit], return_index=True)[1])]
            out.append(edges[d] + hit)
    return np.concatenate(out) if out else np.zeros(0, np.int64)
