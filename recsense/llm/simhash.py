"""Near-duplicates by 64-bit SimHash; candidate pairs by Golay-code fuzzy hashing of fingerprint segments."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written
from .repeats import parts

#: Words of a shingle, seed of its hash, and bits in which linked fingerprints may differ.
SHINGLE, SEED, DISTANCE = 4, 42, 4
#: Fixed value: generator polynomial of the binary Golay code (23, 12, 7).
GOLAY = 0b101011100011
#: Bits of the three segments of a fingerprint, from the lowest; each fits a word of the code.
SEGMENTS = (21, 21, 22)
#: Near copies (:func:`near_copies`): words of the features of each fingerprint that gives keys, and of the shingles that are compared.
#: An edit changes one word, two pairs and five shingles, so fingerprints of single words seldom move; pairs also see the order.
KEY_WORDS, COPY_WORDS = (1, 1, 1, 2), 5
#: 64-bit fingerprints of each kind, and the bits of all of a document's compared ones in which candidates may differ. At a
#: similarity of 0.8 the shingle vectors meet at arccos(2 * 0.8 / 1.8), so 38.7 of 256 bits differ, by 5.7 (standard deviation).
LANES, COPY_DISTANCE = 4, 52
#: Similarity of the different shingles of copies, and bits up to which it isn't looked up (at 0.75 a pair differs in 44 bits, by 6).
COPY_SIMILARITY, SURE = 0.8, 28
#: Columns of the compared fingerprints of near copies, and of those that give keys.
COPY_COLUMNS = ["fp", *[f"f{k}" for k in range(1, LANES)]]
KEY_COLUMNS = [f"k{k}" for k in range(LANES)]
#: Increment and multipliers of the SplitMix64 finalizer.
GAMMA, MIX = 0x9E3779B97F4A7C15, (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)
#: Members of a key that one task compares at once; larger groups are compared block by block.
BLOCK = 16_384
#: Links that a task holds before it contracts them.
HELD = 1 << 17


# --- fingerprints -----------------------------------------------------------------------------------


def fingerprint(text: str | None) -> int:
    """SimHash of a whole text's word shingles (no words: 0); a bit is set if it is in over half the hashes."""
    words = (text or "").encode().lower().split()  # of bytes: A-Z only, and splits at [\x20\x09-\x0D]
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - SHINGLE + 1)
    last = ends[SHINGLE - 1 :] if len(words) >= SHINGLE else ends[-1:]
    digest = xxhash.xxh64_digest
    counts = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        part = zip(starts[at : min(n, at + (1 << 16))].tolist(), last[at : at + (1 << 16)].tolist(), strict=True)
        raw = b"".join([digest(joined[a:b], SEED) for a, b in part])
        counts += np.unpackbits(np.frombuffer(raw, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``(doc_id, fp)``, the fingerprint as a signed long."""
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            found = np.array([fingerprint(t.as_py()) for t in batch.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], schema=schema)

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, "doc_id long, fp long")


def mixed(x: np.ndarray) -> np.ndarray:
    """SplitMix64's finalizer, for each number."""
    x = (x ^ x >> np.uint64(30)) * np.uint64(MIX[0])
    x = (x ^ x >> np.uint64(27)) * np.uint64(MIX[1])
    return x ^ x >> np.uint64(31)


def word_hashes(text: str | None) -> np.ndarray:
    """Hashes of a whole text's words; words and case as in :func:`fingerprint`."""
    return np.frombuffer(b"".join([xxhash.xxh64_digest(w, SEED) for w in (text or "").encode().lower().split()]), np.uint64)


def shingles_of(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hashes of the different ``width``-word shingles of a sequence of word hashes (fewer words: one, none: none)."""
    if not len(hashes):
        return np.zeros(0, np.uint64)
    n = max(1, len(hashes) - width + 1)
    shingle = np.zeros(n, np.uint64)
    for k in range(min(width, len(hashes))):
        shingle = mixed(shingle + np.uint64(GAMMA) + hashes[k : k + n])
    return np.unique(shingle)


def lanes(hashes: np.ndarray, width: int, n_lanes: int = LANES) -> np.ndarray:
    """``n_lanes`` SimHashes of the different ``width``-word shingles of a sequence of word hashes (no words: zeros)."""
    shingle = shingles_of(hashes, width)
    if not len(shingle):
        return np.zeros(n_lanes, np.uint64)
    counts = np.zeros(64 * n_lanes, np.int64)
    step = (np.arange(1, n_lanes + 1, dtype=np.uint64) * np.uint64(GAMMA))[None, :]
    for at in range(0, len(shingle), 255):  # so the counts of a part fit a byte
        wide = mixed(shingle[at : at + 255, None] + step)
        counts += np.unpackbits(wide.view(np.uint8), axis=1).sum(axis=0, dtype=np.uint8)
    return np.packbits(counts * 2 > len(shingle)).view(np.uint64)


def sketch(text: str | None) -> np.ndarray:
    """The compared fingerprints of a whole text, then those that give its keys."""
    hashes = word_hashes(text)
    return np.concatenate((lanes(hashes, COPY_WORDS), *[lanes(hashes, w, KEY_WORDS.count(w)) for w in sorted(set(KEY_WORDS))]))


def sketches(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``(doc_id, fp, f1 ..., k0 ...)``: the compared fingerprints and those for keys, as signed longs."""
    names = ["doc_id", *COPY_COLUMNS, *KEY_COLUMNS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            found = np.array([sketch(t.as_py()) for t in batch.column(1)], np.uint64).reshape(-1, 2 * LANES).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c) for c in found.T]], names=names)

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, ", ".join(f"{c} long" for c in names))


# --- Golay keys -------------------------------------------------------------------------------------


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Parity of each 12-bit message, and of each syndrome the only error of at most three bits."""
    parity = np.arange(1 << 12, dtype=np.int64) << 11
    for bit in range(22, 10, -1):
        parity = np.where(parity >> bit & 1, parity ^ (GOLAY << (bit - 11)), parity)
    single = [1 << k for k in range(23)]
    errors = [0, *single]
    errors += [a | b for k, a in enumerate(single) for b in single[:k]]
    errors += [a | b | c for k, a in enumerate(single) for j, b in enumerate(single[:k]) for c in single[:j]]
    error = np.array(errors, np.int64)
    leader = np.zeros(1 << 11, np.int64)
    leader[parity[error >> 11] ^ (error & 0x7FF)] = error
    return parity, leader


def decode(words: np.ndarray) -> np.ndarray:
    """Index (message) of the codeword nearest to each 23-bit word."""
    parity, leader = _tables()
    return (words ^ leader[parity[words >> 11] ^ (words & 0x7FF)]) >> 11


def near_indices(words: np.ndarray, bits: int) -> np.ndarray:
    """``(n, 1 + bits)`` indices to which a word or one of its neighbours decodes; repeats are -1.

    Two words at most two bits apart have a word in the middle that both reach with one flip, so they
    share an index. A word that is three from its codeword has six, any other one.
    """
    flips = np.concatenate(([0], 1 << np.arange(bits))).astype(np.int64)
    found = np.sort(decode(words[:, None] ^ flips[None, :]), axis=1)
    found[:, 1:][found[:, 1:] == found[:, :-1]] = -1
    return found


def keys(fps: np.ndarray, triples: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """``(key, row)``: keys such that any two fingerprints within DISTANCE = 4 share one.

    With at most four errors in three segments, either one segment has none and another at most two
    (its value with the index of the other: six kinds), or two have one each and the third at most two
    (the indices of all three). Keys have 33 to 36 bits, so chance candidates stay few at any size. Without
    ``triples`` the seventh kind, most of the keys, is left out.
    """
    n, segments, at = len(fps), [], 0
    for bits in SEGMENTS:
        segments.append((fps >> np.uint64(at) & np.uint64((1 << bits) - 1)).astype(np.int64))
        at += bits
    near = []
    for value, bits in zip(segments, SEGMENTS, strict=True):
        found = near_indices(value, bits)
        row, col = np.nonzero(found >= 0)
        near.append((row, found[row, col]))
    out_key, out_row = [], []
    kind = 0
    for i in range(3):
        for j in range(3):
            if i != j:
                row, index = near[j]
                out_key.append(kind << 40 | segments[i][row] << 12 | index)
                out_row.append(row)
                kind += 1
    if not triples:
        return np.concatenate(out_key), np.concatenate(out_row)
    row, key = near[0][0], near[0][1]
    for j in (1, 2):
        n_of = np.bincount(near[j][0], minlength=n)
        first = np.concatenate(([0], np.cumsum(n_of)[:-1]))
        repeat = n_of[row]
        step = np.arange(repeat.sum()) - np.repeat(np.cumsum(repeat) - repeat, repeat)
        pick = np.repeat(first[row], repeat) + step
        row, key = np.repeat(row, repeat), np.repeat(key, repeat) << 12 | near[j][1][pick]
    out_key.append(kind << 40 | key)
    out_row.append(row)
    return np.concatenate(out_key), np.concatenate(out_row)


# --- links ------------------------------------------------------------------------------------------


def apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bits in which fingerprints (the last axis holds their words) differ."""
    bits = np.bitwise_count(a ^ b)
    total = bits[..., 0]
    for k in range(1, bits.shape[-1]):
        total = total + bits[..., k].astype(np.uint16)
    return total


def stars(members: np.ndarray, distance: int = DISTANCE, sure: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(member, other, unsure, found_by)``: trees over the components of fingerprints within ``distance``.

    A row of ``members`` is a fingerprint, of one or more words of 64 bits; its first word names it. Links of more than ``sure``
    bits are apart from the others.

    A search from a member takes all its links out of what is left, so a group of close copies costs a few
    passes, not all its pairs.
    """
    members = members.reshape(len(members), -1)
    left = np.unique(members)[:, None] if members.shape[1] == 1 else np.unique(members, axis=0)
    out: list[list[np.ndarray]] = [[], [], [], []]
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            at = queue.pop()
            bits = apart(left, at)
            near = bits <= distance
            if near.any():
                hit, bits, left = left[near], bits[near], left[~near]
                queue.extend(hit)
                for k, part in ((0, bits <= (distance if sure is None else sure)), (2, bits > (distance if sure is None else sure))):
                    out[k].append(hit[part, 0])
                    out[k + 1].append(np.full(int(part.sum()), at[0]))
    none = np.zeros(0, np.uint64)
    return tuple(np.concatenate(x) if x else none for x in out)


def contract(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The links a task has found, as one tree of depth one for each of their components."""
    nodes, ends = np.unique(np.concatenate((a, b)), return_inverse=True)
    left, right = ends[: len(a)], ends[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[left], root[right])
        after = root.copy()
        for side in (left, right):
            np.minimum.at(after, side, low)
            np.minimum.at(after, root[side], low)
        after = after[after]
        if (after == root).all():
            break
        root = after
    member = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[member], nodes[root[member]]


def _edges_of_runs(key: np.ndarray, fp: np.ndarray, seen: set[bytes], distance: int, sure: int | None) -> tuple[np.ndarray, ...]:
    """Links within each run of equal keys, as of :func:`stars`; sets of members that this task has seen are not compared again."""
    cut = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1], [True])))
    size = np.diff(cut)
    two = cut[:-1][size == 2]
    bits = apart(fp[two], fp[two + 1])
    limit = distance if sure is None else sure
    parts = [bits <= limit, (bits > limit) & (bits <= distance)]
    out = [[fp[two + k, 0][p]] for p in parts for k in (0, 1)]
    for k in np.flatnonzero(size > 2):
        members = fp[cut[k] : cut[k + 1]]
        members = members[np.lexsort(members.T)]
        if (mark := xxhash.xxh3_128_digest(members.tobytes())) in seen:
            continue
        if len(seen) < 1 << 18:
            seen.add(mark)
        for column, found in zip(out, stars(members, distance, sure), strict=True):
            column.append(found)
    return tuple(map(np.concatenate, out))


def linked_by_keys(keyed: DataFrame, distance: int, most: int = BLOCK, sure: int | None = None) -> DataFrame:
    """``(a, b, unsure)`` links that connect the fingerprints which share a key as all pairs within ``distance`` would.

    ``keyed`` has a key and the words of a fingerprint; the first word names it, so links are pairs of first words. Keys
    are shuffled and sorted; a task compares the members of each key as they stream by. A key with
    more than twice ``most`` members is passed on in blocks, and the pairs of its blocks are compared by tasks of
    their own, so no group is gathered whole. Links of more than ``sure`` bits are pairs that were compared, marked ``unsure``; the others
    may be contracted to trees over the same members.
    """
    first, *more = keyed.columns[1:]
    schema = pa.schema([("key", pa.int64()), ("block", pa.int32()), ("unsure", pa.bool_()), ("a", pa.int64()), ("b", pa.int64()), *[(c, pa.int64()) for c in more]])
    declared = "key long, block int, unsure boolean, a long, b long" + "".join(f", {c} long" for c in more)

    def linked(a: np.ndarray, b: np.ndarray, unsure: bool) -> pa.RecordBatch:
        none = [pa.nulls(len(a), f.type) for f in schema]
        return pa.RecordBatch.from_arrays([*none[:2], pa.array([unsure] * len(a), pa.bool_()), pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), *none[5:]], schema=schema)

    def passed(fp: np.ndarray, key: int, block: int) -> pa.RecordBatch:
        n = len(fp)
        words = [pa.array(np.ascontiguousarray(c).view(np.int64)) for c in fp.T]
        return pa.RecordBatch.from_arrays([pa.array([key] * n, pa.int64()), pa.array([block] * n, pa.int32()), pa.nulls(n, pa.bool_()), words[0], words[0], *words[1:]], schema=schema)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        held: list[tuple[np.ndarray, np.ndarray]] = []
        doubts: list[np.ndarray] = []
        key, fp = np.zeros(0, np.int64), np.zeros((0, 1 + len(more)), np.uint64)
        block = 0  # blocks of the open key that were passed on

        def keep(a: np.ndarray, b: np.ndarray, c: np.ndarray, d: np.ndarray) -> None:
            held.append((a, b))
            if len(c):
                doubts.append(np.stack((np.minimum(c, d), np.maximum(c, d)), axis=1))

        for batch in batches:
            key = np.concatenate((key, batch.column(0).to_numpy(zero_copy_only=False)))
            fp = np.concatenate((fp, np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns[1:]], axis=1).view(np.uint64)))
            while len(key):
                whole = int(np.searchsorted(key, key[-1]))  # rows of keys that have ended
                end = int(np.searchsorted(key, key[0], "right"))
                if block and end < len(key):  # the rest of a large key
                    yield passed(fp[:end], int(key[0]), block)
                    key, fp, block = key[end:], fp[end:], 0
                elif whole and not block:
                    keep(*_edges_of_runs(key[:whole], fp[:whole], seen, distance, sure))
                    if sum(len(x) for x, _ in held) > HELD:
                        held = [contract(*map(np.concatenate, zip(*held, strict=True)))]
                        if len(held[0][0]) > HELD // 2:
                            yield linked(*held.pop(), False)
                    if sum(map(len, doubts)) > HELD:
                        doubts = [np.unique(np.concatenate(doubts), axis=0)]
                        if len(doubts[0]) > HELD // 2:
                            yield linked(*np.ascontiguousarray(doubts.pop().T), True)
                    key, fp = key[whole:], fp[whole:]
                elif end >= 2 * most:
                    yield passed(fp[:most], int(key[0]), block)
                    key, fp, block = key[most:], fp[most:], block + 1
                else:
                    break
        if len(key):
            if block:
                yield passed(fp, int(key[0]), block)
            else:
                keep(*_edges_of_runs(key, fp, seen, distance, sure))
        if held:
            yield linked(*contract(*map(np.concatenate, zip(*held, strict=True))), False)
        if doubts:
            yield linked(*np.ascontiguousarray(np.unique(np.concatenate(doubts), axis=0).T), True)

    found = written(keyed.repartition("key").sortWithinPartitions("key").mapInArrow(compare, declared), "simhash-links")
    near = found.filter("block is null").select("a", "b", "unsure").distinct()
    # the blocks of large keys: each block meets each other block of its key
    large = found.filter("block is not null").select("key", "block", F.col("a").alias(first), *more)
    last = large.groupBy("key").agg(F.max("block").alias("last"))
    meet = large.join(last, "key").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("last"))))
    meet = meet.select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), first, *more)

    def block_pair(rows: pd.DataFrame) -> pd.DataFrame:
        a, b, c, d = stars(np.ascontiguousarray(rows[[first, *more]].to_numpy(np.int64)).view(np.uint64), distance, sure)
        one = pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64), "unsure": False})
        return pd.concat([one, pd.DataFrame({"a": np.minimum(c, d).view(np.int64), "b": np.maximum(c, d).view(np.int64), "unsure": True})])

    return near.unionByName(meet.groupBy("key", "i", "j").applyInPandas(block_pair, "a long, b long, unsure boolean")).distinct()


def keyed(distinct: DataFrame, compared: list[str], keying: list[str], triples: bool) -> DataFrame:
    """``(key, *compared)``: every row once for each Golay key of its ``keying`` fingerprints."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                words = [part.column(c).to_numpy(zero_copy_only=False) for c in compared]
                for lane, column in enumerate(keying):
                    key, row = keys(part.column(column).to_numpy(zero_copy_only=False).view(np.uint64), triples)
                    yield pa.RecordBatch.from_arrays([pa.array(key | lane << 48), *[pa.array(w[row]) for w in words]], names=["key", *compared])

    n = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = distinct.select(*dict.fromkeys([*compared, *keying])).repartition(n, compared[0])
    return spread.mapInArrow(emit, ", ".join(f"{c} long" for c in ["key", *compared]))


def merged(edges: DataFrame) -> DataFrame:
    """Fewer links with the same components: of a node's partners in ``b`` it keeps the least, with which the others are linked.

    Each task roots its trees at the least node that it has seen, so a member of a large group has a link to each of several
    roots, at most one for each of its keys; the roots then are linked once and not over every member.
    """
    held = edges.groupBy("a").agg(F.min("b").alias("least"), F.collect_set("b").alias("all"))
    roots = held.select(F.explode("all").alias("a"), F.col("least").alias("b")).filter("a != b")
    return held.select("a", F.col("least").alias("b")).unionByName(roots).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` of every node with a link; root is the component's smallest node.

    Labels fall to the smallest of the neighbours, then jump to their label's label, so a chain of n nodes
    takes about log n rounds. Each round is a written table; only a count comes to the driver.
    """
    both = written(edges.select(F.col("a").alias("node"), F.col("b").alias("to")).unionByName(edges.select(F.col("b").alias("node"), F.col("a").alias("to"))).distinct(), "cc-edges")
    labels = written(both.groupBy("node").agg(F.least(F.first("node"), F.min("to")).alias("root")), "cc-labels")
    while True:
        offered = both.join(labels.withColumnRenamed("node", "to"), "to").groupBy("node").agg(F.min("root").alias("offer"))
        lower = labels.join(offered, "node").select("node", "root", F.least("root", "offer").alias("next"))
        jump = labels.select(F.col("node").alias("next"), F.col("root").alias("jumped"))
        after = written(lower.join(jump, "next").select("node", F.col("root").alias("was"), F.least("next", "jumped").alias("root")), "cc-labels")
        labels = after.select("node", "root")
        if after.filter("root != was").isEmpty():
            return labels


def links(distinct: DataFrame, most: int = BLOCK) -> DataFrame:
    """``(a, b)`` links that connect the distinct fingerprints ``fp`` as all pairs within DISTANCE would."""
    return linked_by_keys(keyed(distinct, ["fp"], ["fp"], True), DISTANCE, most).select("a", "b")


def _grouped(rows: DataFrame, edges: DataFrame) -> DataFrame:
    """``fp, component_id`` of all rows' fingerprints ``fp``, joined over ``edges`` between them."""
    distinct = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(edges)
    joined = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    joined = written(joined, "simhash-roots")
    least = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    return joined.select("fp", "root").join(least, "root").select("fp", "component_id")


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: ``doc_id, fingerprint, component_id``.

    ``fingerprint`` is 16 hex digits, ``component_id`` the smallest id reachable over links. Null texts and
    texts without words have fingerprint zero, which links like any other; fewer than four words are one
    shingle. Rows that repeat get the same result; null ids are never the smallest unless alone. An empty
    table gives no rows.
    """
    rows = written(fingerprints(docs, text, doc_id), "simhash-fp")
    component = _grouped(rows, links(rows.select("fp").distinct()))
    return rows.join(component, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def shingle_sets(docs: DataFrame, text: str, doc_id: str, wanted: DataFrame) -> DataFrame:
    """``(fp, shingles)``: of one document of each wanted ``fp`` the hashes of its different five-word shingles; ``wanted`` has ``id, fp``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            texts = [t.as_py() for t in batch.column(0)]
            fp = np.array([sketch(t)[0] for t in texts], np.uint64).view(np.int64)
            sets = [shingles_of(word_hashes(t), COPY_WORDS).view(np.int64) for t in texts]
            yield pa.RecordBatch.from_arrays([pa.array(fp), pa.array(sets, pa.list_(pa.int64()))], names=["fp", "shingles"])

    rows = docs.select(F.col(doc_id).cast("long").alias("of"), F.col(text).alias("text"))
    rows = rows.join(wanted.select("id").distinct(), F.col("of").eqNullSafe(F.col("id")), "left_semi").select("text")
    found = rows.mapInArrow(run, "fp long, shingles array<long>")
    return found.join(wanted.select("fp").distinct(), "fp", "left_semi").dropDuplicates(["fp"])


def verified(pairs: DataFrame, rows: DataFrame, docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """The links ``(a, b)`` of ``pairs`` whose documents share ``COPY_SIMILARITY`` of their different shingles, counted exactly."""
    names = pairs.select(F.explode(F.array("a", "b")).alias("fp")).distinct()
    wanted = written(rows.groupBy("fp").agg(F.min("doc_id").alias("id")).join(names, "fp", "left_semi"), "simhash-wanted")
    sets = written(shingle_sets(docs, text, doc_id, wanted), "simhash-sets")
    one, two = (sets.select(F.col("fp").alias(c), F.col("shingles").alias(f"s{c}")) for c in "ab")
    both = F.size(F.array_intersect("sa", "sb"))
    share = both / (F.size("sa") + F.size("sb") - both)
    return pairs.join(one, "a").join(two, "b").filter(share >= COPY_SIMILARITY).select("a", "b")


def near_copies(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: ``doc_id, component_id``, for copies that share 0.8 or more of their five-word shingles.

    A document has SimHashes of its different words and of its different pairs of words, which an edit hardly moves: their Golay keys
    (an exact segment with an index of another) find the candidates, which differ in at most ``COPY_DISTANCE`` of the 256 bits of
    four SimHashes of their different five-word shingles. Up to ``SURE`` bits they are copies; of the others the shingles are
    compared one by one. Of the candidates that share a key a spanning tree is compared, not all pairs. Documents whose first such
    SimHash is equal are one.

    ``component_id`` is the smallest id reachable over links. Null texts and texts without words have zeros for fingerprints,
    which link like any others; texts of fewer words than a shingle are one shingle. Rows that repeat get the same result; null ids
    are never the smallest unless alone. Very long texts are hashed whole. An empty table gives no rows.
    """
    rows = written(sketches(docs, text, doc_id), "simhash-sketches")
    distinct = rows.select(*COPY_COLUMNS, *KEY_COLUMNS).distinct()
    edges = written(linked_by_keys(keyed(distinct, COPY_COLUMNS, KEY_COLUMNS, False), COPY_DISTANCE, sure=SURE), "simhash-edges")
    close = edges.filter("not unsure").select("a", "b").unionByName(verified(edges.filter("unsure").select("a", "b"), rows, docs, text, doc_id))
    component = _grouped(rows, merged(close))
    return rows.select("doc_id", "fp").join(component, "fp").select("doc_id", "component_id")
