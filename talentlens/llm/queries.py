"""Registered queries of the corpus operators: each applies one operator to its whole table."""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession

from .. import session
from . import bpe, centroids, decontaminate, language_id, lexical, minhash, oracles, quality, sharding, simhash, substring_dedup, suffix_dedup, toxicity, warc
from .staging import small_batches

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return session.read_table(spark, sf_dir, name)


def op1_suffix_array_dedup(spark, sf):
    return suffix_dedup.digests(read_table(spark, sf, "documents"))


def op2_language_id(spark, sf):
    docs = read_table(spark, sf, "documents")
    model = language_id.fit(docs.where(~language_id.held_out()))
    return (language_id.predict(docs, model, keep=["doc_id"])
            .select("doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score"))


def op3_substring_dedup(spark, sf):
    return substring_dedup.digests(read_table(spark, sf, "documents"))


def op4_benchmark_decontamination(spark, sf):
    return decontaminate.digests(read_table(spark, sf, "documents"), read_table(spark, sf, "benchmark"))


def op5_simhash_near_dedup(spark, sf):
    return simhash.digests(read_table(spark, sf, "documents"))


def op6_quality_rules(spark, sf):
    return quality.digests(read_table(spark, sf, "documents"))


def op7_warc(spark, sf):
    return warc.digests(read_table(spark, sf, "pages"))


def op8_sharding(spark, sf):
    return sharding.digests(read_table(spark, sf, "documents"))


def op9_byte_level_bpe(spark, sf):
    import public_tokenizers

    return bpe.digests(read_table(spark, sf, "documents"), public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)


def op10_toxicity(spark, sf):
    docs = read_table(spark, sf, "documents")
    model = toxicity.fit(docs, read_table(spark, sf, "labels").where(~language_id.held_out()))
    return (toxicity.score(docs, model, keep=["doc_id"])
            .select("doc_id", language_id.held_out().alias("held_out"), "score", "predicted"))


def op11_centroid_clustering(spark, sf):
    return centroids.digests(read_table(spark, sf, "embeddings"))


def op12_ranked_lexical_search(spark, sf):
    return lexical.search(read_table(spark, sf, "documents"), read_table(spark, sf, "benchmark"))


def op13_minhash_near_dedup(spark, sf):
    return minhash.digests(read_table(spark, sf, "documents"))


QUERIES = {f.__name__: f for f in (op1_suffix_array_dedup, op2_language_id, op3_substring_dedup, op4_benchmark_decontamination, op5_simhash_near_dedup, op6_quality_rules, op7_warc, op8_sharding, op9_byte_level_bpe, op10_toxicity, op11_centroid_clustering, op12_ranked_lexical_search, op13_minhash_near_dedup)}
ORACLE = {
    op1_suffix_array_dedup.__name__: oracles.SUFFIX_DEDUP,
    op3_substring_dedup.__name__: oracles.SUBSTRING_DEDUP,
    op4_benchmark_decontamination.__name__: oracles.DECONTAMINATION,
    op7_warc.__name__: oracles.WARC,
    op11_centroid_clustering.__name__: oracles.CENTROIDS,
    op12_ranked_lexical_search.__name__: oracles.LEXICAL_SEARCH,
    op13_minhash_near_dedup.__name__: oracles.MINHASH,
}
