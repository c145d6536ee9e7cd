"""Corpus pipeline: from raw documents to packed sequences.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written before the next one reads it. All but the
last return the columns of `documents`; the last returns one row per packed piece.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeweave.llm.line_rules import judge_documents
from tradeweave.llm.mixing import mix
from tradeweave.llm.ngram_join import jaccard_classes
from tradeweave.llm.packing import pack
from tradeweave.llm.quality_model import classify
from tradeweave.llm.queries import BYTE_BPE, table, tokenizer_path
from tradeweave.session import stage

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
LEAST_SCORE = 0.3
BROADCAST_IDS = 1_000_000  # 16 bytes each; more meet the texts in a shuffle


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines go from the texts, documents that lose too much or fail as a whole go altogether."""
    kept = judge_documents(docs, cleaned=True).filter("kept")
    return kept.withColumn("text", F.col("cleaned_text")).withColumn(
        "n_chars", F.length("text").cast("long")).select(*COLUMNS)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents likely to be labelled 0 go. The model learns from the labelled raw documents: of those that the rules
    rejected too few are left here to learn from."""
    scored = classify(docs, table(spark, sf_dir, "labels"), learn_docs=table(spark, sf_dir, "documents"))
    return scored.filter(F.col("score") >= LEAST_SCORE).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links lead through: the one with the smallest id, null ids last, then the smallest
    hash of its text; a repeated row stays once. Texts without words link with nothing and stay."""
    classes = stage(jaccard_classes(docs))
    alone = F.col("n_shingles") == 0
    one = [F.col("cluster"), F.when(alone, F.col("doc_id")).alias("own_id"), F.when(alone, F.col("body")).alias("own_body")]
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "body")).alias("first")
    chosen = stage(classes.groupBy(*one).agg(first).select("first.doc_id", "first.body"))
    if chosen.count() <= BROADCAST_IDS:
        chosen = F.broadcast(chosen)
    same = F.col("d.doc_id").eqNullSafe(F.col("c.doc_id")) & (F.xxhash64("d.text") == F.col("c.body"))
    kept = docs.alias("d").join(chosen.alias("c"), same, "left_semi")
    if not classes.groupBy("doc_id", "body").count().filter("count > 1").isEmpty():
        kept = kept.dropDuplicates(["doc_id", "text"])
    return kept.select(*COLUMNS)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    copied = mix(docs).filter(F.col("copies") > 0)
    return copied.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*COLUMNS)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document, with its sequence and place there."""
    return pack(docs.select("doc_id", "text", "lang", "source"), tokenizer_path(BYTE_BPE))


STAGES = [("quality_rules", quality_rules), ("quality_classifier", quality_classifier),
          ("near_duplicates", near_duplicates), ("source_mix", source_mix), ("packed_sequences", packed_sequences)]

ORACLE_SQL = None  # the classifier, the mix and the packing have no SQL form; tests hold the stages against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
