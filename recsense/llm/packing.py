"""Cost-balanced packing of token sequences."""

from __future__ import annotations

import heapq
import zlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokens import encode

#: Tokens of a sequence.
LENGTH = 2048
#: The id that ends a document.
END_ID = 1
#: Cost of a piece of n tokens: LINEAR * n + QUADRATIC * n * n, in units of one token's linear work.
LINEAR, QUADRATIC = 1.0, 1.0 / 2048
#: Tokens that one packing round gathers, unless a single document has more.
ROUND = 512 * LENGTH

SCHEMA = pa.schema([(n, pa.int64()) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")])
DDL = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class Cheapest:
    """The lowest-cost sequence among those with room for n tokens: a heap for each room, and the least of each
    stretch of rooms in a tree."""

    def __init__(self, length: int, sequences: int):
        self.size = 1 << length.bit_length()
        self.heaps: dict[int, list[tuple[float, int]]] = {length: [(0.0, s) for s in range(sequences)]}
        self.least: list[tuple[float, int] | None] = [None] * (2 * self.size)
        self._rise(length)

    def _rise(self, room: int) -> None:
        heap, at = self.heaps.get(room), self.size + room
        self.least[at] = heap[0] if heap else None
        while at > 1:
            at >>= 1
            one, two = self.least[2 * at], self.least[2 * at + 1]
            self.least[at] = one if two is None else two if one is None else min(one, two)

    def take(self, n: int) -> tuple[float, int] | None:
        """``(cost, sequence)`` of the cheapest with room for ``n``, taken out; of equals the first; None if none has."""
        at, best, room = self.size + n, self.least[self.size + n], self.size + n
        while at > 1:
            if at % 2 == 0 and (right := self.least[at + 1]) is not None and (best is None or right < best):
                best, room = right, at + 1
            at >>= 1
        if best is None:
            return None
        while room < self.size:
            room = 2 * room if self.least[2 * room] == best else 2 * room + 1
        heapq.heappop(self.heaps[room - self.size])
        self._rise(room - self.size)
        return best

    def put(self, room: int, cost: float, sequence: int) -> None:
        if room:
            heapq.heappush(self.heaps.setdefault(room, []), (cost, sequence))
            self._rise(room)


def place(lengths: list[int], length: int = LENGTH) -> list[tuple[int, int, int, int, int]]:
    """Pieces ``(document, start, length, sequence, offset)`` for documents of these token counts.

    Whole sequences are cut from long documents. The rests go, longest first, each to the lowest-cost
    sequence that still has room for it, and are cut, into the lowest-cost one, only where none has. There are
    just as many sequences as the rests fill; what is over (less than one sequence, from the shortest rests) goes into
    sequences of a power of two tokens, which need no padding.
    """
    out, rests, n_seq = [], [], 0
    for d, n in enumerate(lengths):
        for start in range(0, n - length + 1, length):
            out.append((d, start, length, n_seq, 0))
            n_seq += 1
        if n % length:
            rests.append((n % length, d, n - n % length))
    rests.sort(key=lambda r: (-r[0], r[1]))
    total = sum(r[0] for r in rests)
    over = total % length
    tail: list[tuple[int, int, int]] = []
    left = over
    while left:
        n, d, start = rests.pop()
        if n > left:
            rests.append((n - left, d, start))
            start, n = start + n - left, left
        tail.append((n, d, start))
        left -= n
    rests.sort(key=lambda r: (-r[0], r[1]))
    used = [0] * (total // length)
    cheapest = Cheapest(length, len(used))
    for n, d, start in rests:
        while n:
            cost, s = cheapest.take(n) or cheapest.take(1)
            take = min(n, length - used[s])
            out.append((d, start, take, n_seq + s, used[s]))
            used[s] += take
            cheapest.put(length - used[s], cost + LINEAR * take + QUADRATIC * take * take, s)
            start, n = start + take, n - take
    n_seq += len(used)
    sizes = [1 << k for k in range(length.bit_length(), -1, -1) if over >> k & 1]
    at = 0
    for n, d, start in tail:
        while n:
            take = min(n, sizes[0] - at)
            out.append((d, start, take, n_seq, at))
            at, start, n = at + take, start + take, n - take
            if at == sizes[0]:
                sizes.pop(0)
                n_seq, at = n_seq + 1, 0
    return out


def pack(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", length: int = LENGTH, end_id: int = END_ID, round_tokens: int = ROUND) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    Each task packs its own documents in rounds of bounded size, so nothing is shuffled and a round is all
    that memory holds; the task's number and a counter make the sequence ids, so a task that runs again
    gives the same rows. Null text is empty and gives one piece, the end id. Rows that repeat are packed
    each. An empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 40
        done = 0
        held: list[tuple[int | None, array]] = []

        def flush() -> pa.RecordBatch:
            nonlocal done
            rows = place([len(ids) for _, ids in held], length)
            crc = [zlib.crc32(memoryview(held[d][1])[start : start + n]) for d, start, n, _, _ in rows]
            columns = [[held[r[0]][0] for r in rows], [r[1] for r in rows], [r[2] for r in rows], crc, [len(held[r[0]][1]) for r in rows], [base + done + r[3] for r in rows], [r[4] for r in rows]]
            done += max((r[3] for r in rows), default=-1) + 1
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=SCHEMA)

        tokens = 0
        for batch in batches:
            for key, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = array("I", encode(value.as_py() or ""))
                ids.append(end_id)
                held.append((key, ids))
                tokens += len(ids)
                if tokens >= round_tokens:
                    yield flush()
                    tokens = 0
        if held:
            yield flush()

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, DDL)
