"""A training-data pipeline over ``documents``: language ID, exact and near deduplication, mixing, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written as Parquet and read again as
the next one's ``docs``; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recsense.llm.common import discard, documents, written
from recsense.llm.exact_dedup import exact_dedup, normalised
from recsense.llm.language import UNDETERMINED, WORST_BITS, fit_languages, predict_languages
from recsense.llm.mixing import mixed_rows
from recsense.llm.packing import pack
from recsense.llm.repeats import NO_ID
from recsense.llm.simhash import near_copies


def plain(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with its columns numbered, so no helper column can clash with one of them; and the number of each name."""
    numbered = docs.toDF(*[f"c{k}" for k in range(len(docs.columns))])
    return numbered, dict(zip(docs.columns, numbered.columns, strict=True))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters go, and those that no learned language explains (over WORST_BITS bits a byte).

    Null and empty texts have no letters and go. Very long texts are scored whole. Ties between languages keep the document
    all the same. Rows that repeat are judged alike. Where no document has a language all go; an empty table stays
    empty. Further columns, whatever their names, are passed on.
    """
    rows, of = plain(docs)
    others = [c for c in rows.columns if c != of["text"]]
    found = predict_languages(rows, fit_languages(docs), of["text"], [F.col(c) for c in others], with_text=True)
    kept = found.filter((F.col("lang_pred") != UNDETERMINED) & (F.col("bits_per_byte") <= WORST_BITS))
    return kept.withColumnRenamed("__text", of["text"]).select(rows.columns).toDF(*docs.columns)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of texts that are equal without white space stays: the longest text, of these the smallest id.

    Null texts count as empty and are one group. Rows that repeat it in id and text are one, whichever of them. A null id stays only
    where its group has no other. Very long texts are sorted externally. An empty table stays empty. Further
    columns, whatever their names, are passed on.
    """
    rows, of = plain(docs)
    kept = exact_dedup(rows, of["text"], of["doc_id"]).filter("kept")
    stays = kept.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("__id"), F.col("text_sha256").alias("__sha256"))
    rows = rows.withColumns({"__id": F.coalesce(of["doc_id"], F.lit(NO_ID)), "__sha256": F.sha2(normalised(F.col(of["text"])), 256)})
    one = rows.join(stays.distinct(), ["__id", "__sha256"], "left_semi").dropDuplicates(["__id", "__sha256"])
    return one.select(*of.values()).toDF(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked copies, which share about 0.8 or more of their five-word shingles, the document with the smallest id stays.

    Null texts and texts without words are one group. Rows that repeat an id all stay if that id does
    (the stage before leaves one). A null id stays only where its group has no other. Very long texts are
    hashed whole. An empty table stays empty. Further columns, whatever their names, are passed on.
    """
    rows, of = plain(docs)
    groups = near_copies(rows, of["text"], of["doc_id"])
    stays = groups.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.coalesce("doc_id", F.lit(NO_ID)).alias("__id"))
    rows = rows.withColumn("__id", F.coalesce(of["doc_id"], F.lit(NO_ID)))
    return rows.join(stays.distinct(), "__id", "left_semi").select(*of.values()).toDF(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it.

    Null and empty texts weigh nothing and are taken at their source's rate; the null source is a source and comes
    last. Rows that repeat an id share one draw. An empty table stays empty. Further columns are passed on.
    """
    rows, of = plain(docs)
    return mixed_rows(rows, of["text"], of["source"], of["doc_id"]).toDF(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048 tokens.

    Null and empty texts are one piece, the end id. Very long texts are cut over sequences; copies of a document are
    packed each. An empty table gives no pieces. Further columns play no part.
    """
    return pack(docs)


STAGES = [
    ("language ID", identify_language),
    ("exact dedup", drop_exact_copies),
    ("SimHash near-dedup", drop_near_copies),
    ("mixing sources", mix_sources),
    ("packing", pack_sequences),
]

#: SQL has no context trees and no tokenizer; tests/llm/test_pipeline.py holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of the last stage; each stage's table is deleted when the next one is written."""
    docs, before = documents(spark, sf_dir), []
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
        discard(*before)
        before = [docs]
    return STAGES[-1][1](spark, docs, sf_dir)
