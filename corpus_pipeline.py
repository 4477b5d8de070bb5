"""From raw documents to packed training sequences, in five stages that can each be stored and resumed."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from silverlode.llm import decontaminate, minhash, packing, secrets, toxicity
from silverlode.llm.common import packed_texts, ship_package, stored, table, unpacked_texts

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

SHINGLE = 5
# Toxicity, groupings and alignments are not expressible in SQL; tests compare the stages with plain versions.
ORACLE_SQL = None


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones among them, does not predict toxic."""
    ship_package(spark)
    return toxicity.without_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id, and one of rows equal in id and text.

    Rows without id stay unless their group has a document with an id.
    """
    ship_package(spark)
    groups = minhash.near_duplicates(docs, SHINGLE)
    kept = stored(groups.filter("kept").select(F.col("doc_id").alias("kept_id")))
    repeated = kept.filter("kept_id IS NOT NULL").groupBy("kept_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    # All columns in one, so that no name of theirs meets those of the steps.
    packed = packed_texts(docs)
    rows = packed.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"))
    left = rows.join(kept.distinct(), F.col("row.doc_id").eqNullSafe(F.col("kept_id")), "left_semi")
    if not repeated.isEmpty():
        same = Window.partitionBy("row.doc_id", F.xxhash64("row.text")).orderBy(F.monotonically_increasing_id())
        left = left.withColumn("place", F.row_number().over(same)).filter("place = 1 OR row.doc_id IS NULL")
    return unpacked_texts(left.select("row.*"), docs.schema)


def remove_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by a mark and the number of characters counted anew."""
    masked = secrets.without_secrets(docs)
    if "n_chars" not in docs.columns:
        return masked
    changed = F.when(F.col("text").isNotNull(), F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return masked.withColumn("n_chars", changed)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their sequences and places."""
    ship_package(spark)
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", reject_toxic),
    ("near_dedup", keep_one_of_near_duplicates),
    ("decontamination", remove_leaks),
    ("secret_scans", mask_secrets),
    ("best_fit_packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each stage keeps is stored before the next begins."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
