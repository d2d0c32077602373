"""Language identification by prediction by partial matching: exact code lengths under frozen byte context trees."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import remainder

#: Longest context in bytes.
ORDER = 3
#: Documents of each language that the trees are fitted on, and the most characters such a document has:
#: the bound of what the driver reads.
SAMPLE_DOCS, SAMPLE_CHARS = 400, 10_000
#: Contexts of two bytes and more are kept when seen this often in some language.
LEAST = 3
#: Contexts times symbols times languages that the tables hold at most (4 bytes each: 256 MB).
CELLS = 1 << 26
#: Fold that training never sees.
MODULUS, HELD_OUT = 4, 2
UNDETERMINED = "und"
#: Bits a byte beyond which no learned language explains a text; the pipeline's language stage rejects it. Documents
#: labelled with a language need 6.9 at most on the given tables (median 2.1), texts in scripts not learned over 22.
WORST_BITS = 10.0
#: Bytes scored at a time.
BLOCK = 1 << 20

_LETTER = regex.compile(r"\p{L}")


@dataclass
class Trees:
    """The context trees of all languages as two tables.

    Bytes become symbols 1..A-1; symbol 0 stands for the start of a text and for bytes never seen, which
    all cost the same and occur in no context, so nothing is lost. ``node[c]`` is the longest known context
    among the last ORDER symbols, ``bits[node, symbol, language]`` the exact code length.
    """

    languages: list[str]
    symbol: np.ndarray
    n_symbols: int
    node: np.ndarray
    bits: np.ndarray

    def code_lengths(self, texts: list[bytes]) -> np.ndarray:
        """Bits of each text in each language, ``(texts, languages)``."""
        out = np.zeros((len(texts), len(self.languages)))
        start = 0
        while start < len(texts):
            stop, n = start, 0
            while stop < len(texts) and (n == 0 or n + len(texts[stop]) + ORDER <= BLOCK):
                n += len(texts[stop]) + ORDER
                stop += 1
            out[start:stop] = self._block(texts[start:stop])
            start = stop
        return out

    def _block(self, texts: list[bytes]) -> np.ndarray:
        a = self.n_symbols
        gap = bytes(ORDER)
        raw = np.frombuffer(gap + gap.join(texts), np.uint8)
        ends = np.cumsum([len(t) + ORDER for t in texts])
        starts = ends - [len(t) for t in texts]
        symbols = self.symbol[raw].astype(np.int32)
        for at in starts:
            symbols[at - ORDER : at] = 0
        context = symbols[:-ORDER].copy()
        for k in range(1, ORDER):
            context = context * a + symbols[k : len(symbols) - ORDER + k]
        bits = self.bits[self.node[context], symbols[ORDER:]]
        total = np.zeros((len(texts), bits.shape[1]))
        for k, (at, end) in enumerate(zip(starts - ORDER, ends - ORDER, strict=True)):
            if end > at:
                total[k] = bits[at:end].sum(axis=0, dtype=np.float64)
        return total


def grow(samples: dict[str, list[str]], cells: int = CELLS) -> Trees:
    """Context trees from texts by language.

    A symbol seen n times after a context seen N times with D distinct symbols has probability n / (N + D);
    the escape D / (N + D) goes to the symbols not seen there, in proportion to the shorter context. Of the contexts of two bytes
    and more the most frequent ones are kept, as many as ``cells`` (contexts times symbols times languages) allow,
    so the tables that are sent to all tasks have a fixed bound however many languages there are.
    """
    languages = sorted(samples)
    data = {name: [t.encode() for t in samples[name] if t] for name in languages}
    seen = np.unique(np.frombuffer(b"".join(b"".join(v) for v in data.values()), np.uint8))
    symbol = np.zeros(256, np.uint8)
    symbol[seen] = np.arange(1, len(seen) + 1)
    a = len(seen) + 1
    streams = {}
    for name in languages:
        gap = bytes(ORDER)
        lengths = [len(t) for t in data[name]]
        ids = symbol[np.frombuffer(gap + gap.join(data[name]), np.uint8)].astype(np.int64)
        real = np.ones(len(ids), bool)
        at = 0
        for n in lengths:
            real[at : at + ORDER] = False
            at += ORDER + n
        real[at:] = False
        ids[~real] = 0
        streams[name] = (ids, np.flatnonzero(real))
    n_lang = len(languages)
    room = max(0, cells // (a * n_lang) - a - 1)
    # contexts by length: key = the context's symbols in base a, oldest first
    index: list[dict[int, int]] = [{0: 0}]
    probability = [np.zeros((1, a, n_lang), np.float32)]
    for k, name in enumerate(languages):
        ids, where = streams[name]
        counts = np.bincount(ids[where], minlength=a).astype(float)
        probability[0][0, :, k] = _escape(counts[None], np.full((1, a), 1.0 / 256))[0]
    offsets, total = [0], 1
    for order in range(1, ORDER + 1):
        keys = {}
        for name in languages:
            ids, where = streams[name]
            context = np.zeros(len(where), np.int64)
            for j in range(order, 0, -1):
                context = context * a + ids[where - j]
            keys[name] = context
        most: dict[int, int] = {}  # how often each context is seen in the language that has it most
        for name in languages:
            u, n = np.unique(keys[name], return_counts=True)
            enough = n >= (LEAST if order > 1 else 1)
            for c, m in zip(u[enough].tolist(), n[enough].tolist(), strict=True):
                most[c] = max(most.get(c, 0), m)
        # a context is kept only if the one shorter by its oldest symbol is
        kept = [c for c in most if c % a ** (order - 1) in index[order - 1]]
        if order > 1:
            kept = sorted(kept, key=lambda c: (-most[c], c))[: room // (ORDER - order + 1)]
            room -= len(kept)
        kept.sort()
        index.append({c: j for j, c in enumerate(kept)})
        parent = np.array([index[order - 1][c % a ** (order - 1)] for c in kept], np.int64)
        table = np.zeros((len(kept), a, n_lang), np.float32)
        kept_array = np.array(kept, np.int64)
        for k, name in enumerate(languages):
            ids, where = streams[name]
            j = np.searchsorted(kept_array, keys[name])
            j[j == len(kept)] = 0
            hit = kept_array[j] == keys[name] if len(kept) else np.zeros(len(j), bool)
            counts = np.bincount(j[hit] * a + ids[where][hit], minlength=len(kept) * a).reshape(len(kept), a).astype(float)
            table[:, :, k] = _escape(counts, probability[order - 1][parent, :, k].astype(float))
        probability.append(table)
        offsets.append(total)
        total += len(kept)
    node = np.zeros(a**ORDER, np.int32)
    every = np.arange(a**ORDER)
    for order in range(1, ORDER + 1):
        lookup = np.full(a**order, -1, np.int32)
        for c, j in index[order].items():
            lookup[c] = offsets[order] + j
        found = lookup[every % a**order]
        node = np.where(found >= 0, found, node)
    bits = -np.log2(np.concatenate(probability)).astype(np.float32)
    return Trees(languages, symbol, a, node, bits)


def _escape(counts: np.ndarray, shorter: np.ndarray) -> np.ndarray:
    """Probabilities of one byte of each symbol, with escape to the shorter context, without what was seen here."""
    bytes_of = np.ones(counts.shape[1])
    bytes_of[0] = 257 - counts.shape[1]
    seen = counts > 0
    n, distinct = counts.sum(1, keepdims=True), seen.sum(1, keepdims=True)
    rest = np.where(seen, 0.0, shorter)
    mass = np.maximum((rest * bytes_of).sum(1, keepdims=True), 1e-300)
    share = np.where(n > 0, distinct / np.maximum(n + distinct, 1), 1.0)
    out = np.where(seen, counts / np.maximum(n + distinct, 1), share * rest / mass)
    return np.where(n > 0, np.maximum(out, 1e-12), shorter)


def training_rows(docs: DataFrame, text: str, lang: str, doc_id: str, sample_docs: int, sample_chars: int) -> DataFrame:
    """``(lang, text)`` of at most ``sample_docs`` documents a language, chosen by a hash of their id."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(lang).alias("lang"), F.col(text).alias("text"))
    length, fold = F.length("text"), remainder(F.col("doc_id"), MODULUS)
    fit = rows.filter(F.col("lang").isNotNull() & (length > 0) & (length <= sample_chars) & (fold != HELD_OUT))
    first = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = fit.select("doc_id", "lang").withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= sample_docs)
    chosen = chosen.select(F.col("doc_id").alias("__id")).distinct()
    return fit.join(F.broadcast(chosen), F.col("doc_id") == F.col("__id")).select("lang", "text")


def fit_languages(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", sample_docs: int = SAMPLE_DOCS, sample_chars: int = SAMPLE_CHARS) -> Trees | None:
    """Trees from labelled documents outside the held-out fold; None if there are none.

    Documents with null text, null language, null id (in no fold) or without characters teach nothing, nor do those longer
    than ``sample_chars``. Rows that repeat are read once or more often, which changes counts but no bound.
    Ties of the id's hash go to the smaller id. An empty table, or one without languages, gives None.
    """
    samples: dict[str, list[str]] = {}
    for row in sorted(training_rows(docs, text, lang, doc_id, sample_docs, sample_chars).collect()):
        samples.setdefault(row[0], []).append(row[1])
    return grow(samples) if samples else None


def predict_languages(docs: DataFrame, trees: Trees | None, text: str = "text", keep: list[Column] | None = None, with_text: bool = False) -> DataFrame:
    """The ``keep`` columns with ``lang_pred, score, bits_per_byte``, and with ``__text`` if asked for.

    The language of the shortest code wins (of equals the first by name). The tables that are broadcast have at most
    CELLS entries and one for each three symbols. ``score`` is its posterior
    probability among the languages. Null texts, texts without letters, and all texts when nothing was
    learned are ``und`` with score 0 and null bits. Whole texts are scored; rows that repeat get the same result.
    """
    model = docs.sparkSession.sparkContext.broadcast(trees)
    kept = docs.select(*(keep or []), F.col(text).alias("__text"))
    out = pa.schema([("lang_pred", pa.string()), ("score", pa.float64()), ("bits_per_byte", pa.float64())])
    names = kept.columns[:-1]
    passed = len(names) + with_text
    kept_names = kept.columns[:passed]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = model.value
        for batch in batches:
            texts = [t or "" for t in batch.column(len(names)).to_pylist()]
            lang: list[str] = [UNDETERMINED] * len(texts)
            sure: list[float] = [0.0] * len(texts)
            rate: list[float | None] = [None] * len(texts)
            some = [k for k, t in enumerate(texts) if trees is not None and _LETTER.search(t)]
            if some:
                raw = [texts[k].encode() for k in some]
                bits = trees.code_lengths(raw)
                best = bits.argmin(1)
                least = bits[np.arange(len(some)), best]
                posterior = 1.0 / np.exp2(np.maximum(least[:, None] - bits, -1000)).sum(1)
                for j, k in enumerate(some):
                    lang[k], sure[k], rate[k] = trees.languages[best[j]], float(posterior[j]), float(least[j] / len(raw[j]))
            columns = [batch.column(j) for j in range(passed)] + [pa.array(lang, pa.string()), pa.array(sure), pa.array(rate, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept_names, *out.names])

    ddl = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:passed]] + ["lang_pred string, score double, bits_per_byte double"])
    return kept.mapInArrow(score, ddl)


def identify(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", **sample) -> DataFrame:
    """One row per document: ``doc_id, held_out, lang_pred, score, bits_per_byte``; trees fitted on the other fold.

    A null id is in no fold: not held out and not learned from. An empty table gives no rows.
    """
    trees = fit_languages(docs, text, lang, doc_id, **sample)
    held_out = F.coalesce(remainder(F.col(doc_id), MODULUS) == HELD_OUT, F.lit(False))
    return predict_languages(docs, trees, text, [F.col(doc_id).alias("doc_id"), held_out.alias("held_out")])
