"""Removal of repeated byte strings by a sparse suffix sort over the whole corpus.

Suffixes begin at winnowed anchors, about one in 65 bytes, because a suffix for every byte would shuffle many
times the input. A suffix is sorted by its first eight bytes, then by fingerprints of its next 273 bytes and of
all that the windows around its anchor cover.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import discard, written
from .repeats import Shape, finish, keyed, mixed, over_boundaries, scan_blocks, sorted_pass, splitters

#: Bytes of a string that is removed when it occurs again.
LENGTH = 400
#: The anchor of a string lies in its first ANCHORS places and is chosen by GRAM bytes.
GRAM, ANCHORS = 32, 128

_BYTE = mixed(np.arange(1, 257, dtype=np.uint64))
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def byte_codes(texts: list[str]) -> tuple[list[np.ndarray], None]:
    return [_BYTE[np.frombuffer(t.encode(), np.uint8)] for t in texts], None


def spans_of(covered: np.ndarray) -> list[dict[str, int]]:
    """Maximal runs of True."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], covered.astype(np.int8), [0]))))
    return [{"start": a, "end": b} for a, b in edge.reshape(-1, 2).tolist()]


def cut_bytes(text: str, covered: np.ndarray | None) -> tuple[int, list[dict[str, int]], bytes]:
    raw = text.encode()
    spans = [] if covered is None else spans_of(covered)
    return len(raw), spans, np.frombuffer(raw, np.uint8)[~covered].tobytes() if spans else raw


def repeated_bytes(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", length: int = LENGTH, gram: int = GRAM, anchors: int = ANCHORS) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, spans, kept`` (removed byte ranges, and the bytes that stay).

    A byte is removed if a string of ``length`` bytes that covers it also starts anywhere else, in the same or
    another document; all is judged on the input. Suffixes stand for the blocks of strings that share an
    anchor (see :mod:`.repeats`). They are dealt out by sampled splitters over their leading bytes, sorted within
    each range by a multikey quicksort (leading bytes, fingerprint of the bytes from the anchor on, of the whole
    block), and compared with their neighbours; suffixes too frequent for one range are compared over range
    boundaries. Null text is empty; texts shorter than ``length`` lose nothing. A row that repeats another is a
    text elsewhere, so both lose everything that is long enough; rows with one id share what either loses at
    equal strings. An empty table gives no rows.
    """
    shape = Shape(length, gram, anchors, lead=True)
    texts = keyed(docs, text, doc_id)
    deal = splitters(texts, byte_codes, shape)
    sorted_ = written(sorted_pass(scan_blocks(texts, byte_codes, shape, deal), deal, by_count=True, lead=True), "suffixes")
    rest = over_boundaries(sorted_.filter("kind = 0"), by_count=True)
    said = written(sorted_.filter("kind > 0").select("whole", "doc", "kind").unionByName(rest.select("whole", "doc", "kind")), "suffix-blocks")
    discard(sorted_)
    fields = [("n_bytes", pa.int64()), ("spans", _SPANS), ("kept", pa.binary())]
    return finish(texts, said, True, byte_codes, shape, cut_bytes, fields, "n_bytes long, spans array<struct<start: long, end: long>>, kept binary")
