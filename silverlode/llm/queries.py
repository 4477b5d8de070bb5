"""The text operators as queries over a folder of tables, with production parameters."""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverlode.llm import chat, decontaminate, hnsw, html_text, katz, minhash, packing, repeats, resample, secrets, toxicity, url_rules, whitening
from silverlode.llm.common import ship_package, stored, table

Query = Callable[[SparkSession, str], DataFrame]

# Fixed values of the contract: (host, path, verdict).
URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]

# Fixed value of the contract: a conversation that is formatted besides those of the table.
ADDED_CONVERSATION = """
SELECT -7L AS conv_id, turn, role, '</s>[INST] ok [/INST]' AS text
FROM VALUES (0L, 'user'), (1L, 'assistant') AS said (turn, role)
"""


def op1_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return hnsw.nearest(vectors, vectors.filter(F.col("vec_id") % 20 == 0))


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), size=2)


def op3_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_digests(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_documents(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_rules.judge_urls(table(spark, sf_dir, "pages"), rules)


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.score_documents(table(spark, sf_dir, "documents"))


def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaked_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_text.main_text(pages, stored(html_text.site_templates(pages)))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"), "vec_id", "embedding").withColumnRenamed("key", "vec_id")


def op12_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = spark.sql(ADDED_CONVERSATION)
    return chat.digests(chat.examples(table(spark, sf_dir, "conversations").select(said.columns).unionByName(said)))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _query(run: Query) -> Query:
    @functools.wraps(run)
    def shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return run(spark, sf_dir)

    return shipped


QUERIES: dict[str, Query] = {
    run.__name__: _query(run)
    for run in (
        op1_nearest_neighbours,
        op2_minhash_near_dedup,
        op3_secret_scans,
        op4_toxicity,
        op5_url_filters,
        op6_lm_scoring,
        op7_suffix_array_dedup,
        op8_decontamination,
        op9_html_extraction,
        op10_best_fit_packing,
        op11_embedding_whitening,
        op12_chat_formatting,
        op13_importance_resampling,
    )
}
