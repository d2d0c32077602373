"""Token ids and exact token counts at every prefix of a text, under a public byte-level BPE vocabulary."""

from __future__ import annotations

import base64
import functools
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
import public_tokenizers
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The vocabulary of byte_bpe_50k.json, as ranks.
RANKS = "byte_bpe_50k.tiktoken"
#: Fixed value: the special token of that vocabulary and its id; its string in a text stands for it.
SPECIAL, SPECIAL_ID = "<|endoftext|>", 50256
#: Distinct pieces whose counts a worker remembers at most; then it starts anew.
MEMO = 1 << 19
LIMIT = 1024


@functools.lru_cache(maxsize=2)
def encoder(ranks: str = RANKS) -> tiktoken.Encoding:
    with open(public_tokenizers.path(ranks), "rb") as lines:
        table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding(ranks, pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={SPECIAL: SPECIAL_ID})


def encode(text: str) -> list[int]:
    """The ids of a whole text; special strings in it become their ids, as the library does by default."""
    if SPECIAL in text:
        return encoder().encode(text, allowed_special="all")
    return encoder().encode_ordinary(text)


@functools.lru_cache(maxsize=2)
def pieces(pattern: str = public_tokenizers.PATTERN):
    """Splits a text without special strings into the pieces that the vocabulary's merges never cross."""
    return regex.compile(pattern).findall


class PieceCounts(dict):
    """piece -> number of its tokens, reckoned once per distinct piece and worker."""

    def __missing__(self, piece: str) -> int:
        if len(self) >= MEMO:
            self.clear()
        n = self[piece] = len(encoder().encode_ordinary(piece))
        return n


def sections(text: str) -> list[tuple[str, int]]:
    """The parts of a text between special strings, and the special strings, with their tokens (0: to be counted)."""
    if SPECIAL not in text:
        return [(text, 0)]
    out: list[tuple[str, int]] = []
    for k, part in enumerate(text.split(SPECIAL)):
        out += [(SPECIAL, 1)] * (k > 0) + [(part, 0)] * bool(part)
    return out


class Prefixes:
    """Exact token counts of a text's prefixes.

    ``ends[j]`` is where piece j ends and ``totals[j]`` the tokens up to there: each entry is the one before
    plus the count of one piece, so nothing is encoded twice. A prefix that ends inside a piece is that sum
    plus the count of the rest, a few characters; white space before the cut is counted anew, because the
    pattern groups a run of it by what follows, and so is what stands before a special string that is cut.
    """

    def __init__(self, text: str, memo: PieceCounts | None = None):
        memo = PieceCounts() if memo is None else memo
        split, found, counts = pieces(), [], []
        for part, known in sections(text):
            if known:
                found.append(part)
                counts.append(known)
            else:
                own = split(part)
                found += own
                counts += map(memo.__getitem__, own)
        self.text, self.pieces, self.memo = text, found, memo
        self.counts = counts

    @functools.cached_property
    def ends(self) -> list[int]:
        return list(accumulate(map(len, self.pieces)))

    @functools.cached_property
    def totals(self) -> list[int]:
        return list(accumulate(self.counts))

    @property
    def total(self) -> int:
        return self.totals[-1] if self.totals else 0

    def at(self, n_chars: int) -> int:
        """Tokens of the first ``n_chars`` characters."""
        n_chars = max(0, min(n_chars, len(self.text)))
        if n_chars == len(self.text):
            return self.total
        j = bisect_right(self.ends, n_chars)
        if j and self.pieces[j] == SPECIAL:  # cut short, its first characters are text that continues the piece before
            j -= self.pieces[j - 1] != SPECIAL
        while j and self.pieces[j - 1].isspace():
            j -= 1
        start, before = (self.ends[j - 1], self.totals[j - 1]) if j else (0, 0)
        return before + len(encode(self.text[start:n_chars]))

    def truncate(self, budget: int) -> int:
        """Characters of a prefix with at most ``budget`` tokens.

        The table gives the last piece end that fits; the piece that crosses the budget is searched by halves
        for a cut that fits where one more character doesn't.
        """
        j = bisect_right(self.totals, budget)
        while j and self.at(self.ends[j - 1]) > budget:
            j -= 1
        low = self.ends[j - 1] if j else 0
        high = next((end for end in self.ends[j:] if self.at(end) > budget), None)
        if budget < 0 or high is None:
            return low
        while high - low > 1:
            middle = (low + high) // 2
            low, high = (middle, high) if self.at(middle) <= budget else (low, middle)
        return low


def token_counts(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", limit: int = LIMIT, prefixes: bool = False) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_tokens, over_limit``; with ``prefixes`` also ``piece_ends, piece_tokens``.

    Null text counts as empty: 0 bytes, 0 tokens. Rows that repeat are counted each. A document is one
    task's work and needs memory in proportion to its own length; no shuffle. ``piece_ends`` (characters)
    and ``piece_tokens`` (tokens up to there) are the prefix table.
    """
    fields = [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_())]
    fields += [("piece_ends", pa.list_(pa.int64())), ("piece_tokens", pa.list_(pa.int64()))] if prefixes else []
    schema = pa.schema(fields)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = PieceCounts()
        for batch in batches:
            n_tokens, ends, totals = [], [], []
            for value in batch.column(2):
                found = Prefixes(value.as_py() or "", memo)
                n_tokens.append(found.total)  # the last entry of the prefix table
                if prefixes:
                    ends.append(found.ends)
                    totals.append(found.totals)
            columns = [batch.column(0), batch.column(1), pa.array(n_tokens, pa.int64()), pa.array([n > limit for n in n_tokens], pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns + ([pa.array(ends, pa.list_(pa.int64())), pa.array(totals, pa.list_(pa.int64()))] if prefixes else []), schema=schema)

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"), F.col(text).alias("text"))
    ddl = "doc_id long, n_bytes long, n_tokens long, over_limit boolean" + (", piece_ends array<long>, piece_tokens array<long>" if prefixes else "")
    return rows.mapInArrow(count, ddl)
