"""The corpus pipeline: five stages, each one operator over all that the stage before it kept.

toxicity                   documents that it predicts toxic go
simhash_near_dedup         of each group of near duplicates the document with the least id stays
substring_dedup            words of passages that a document with a smaller id holds go; a text that loses nothing
                           stays as it is, one that loses all its words goes
benchmark_decontamination  documents that hold a window of a benchmark item go
byte_level_bpe             the token ids of each document, and whether they decode to its text

``run`` writes each stage's result as Parquet in the shared folder and reads it back for the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talentlens.llm import bpe, decontaminate, language_id, simhash, substring_dedup, toxicity
from talentlens.llm.queries import VOCABULARY, read_table
from talentlens.llm.staging import small_batches, stage


def _packed(docs: DataFrame) -> DataFrame:
    """The text beside the whole row, so that no column of the row can clash with an operator's."""
    return docs.select("doc_id", "text", F.struct("*").alias("row"))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learned from the labelled documents that aren't held out, as the toxicity query does."""
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels").where(~language_id.held_out()))
    return toxicity.score(_packed(docs), model, keep=["row"]).where("predicted = 0").select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return simhash.keep_one(docs)


def cut_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in ("text", "n_chars")])
    cut = substring_dedup.dedup(docs.select("doc_id", "text", rest.alias("row")), keep=["row"], rejoin=False).where("n_removed = 0 OR n_removed < n_words")
    new = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("long")}
    return cut.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.find(_packed(docs), read_table(spark, sf_dir, "benchmark"), keep=["row"]).where("n_hit = 0").select("row.*")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    import public_tokenizers

    vocabulary = public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN
    decoded = bpe.encode(docs, *vocabulary, keep=["doc_id", "text"], decoded=True)
    return decoded.select("doc_id", "n_tokens", "ids", (F.col("decoded") == F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("exact"))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("substring_dedup", cut_passages),
    ("benchmark_decontamination", drop_contaminated),
    ("byte_level_bpe", tokens),
]

#: Learned scores, XXH64 fingerprints and byte-pair merges can't be said in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
