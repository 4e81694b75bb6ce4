"""From raw documents to token ids: five stages, each over all rows that the one before kept.

A stage is a function (spark, docs, sf_dir) -> DataFrame. `run` stores each result as Parquet in the shared folder and
reads it again, so a lost executor costs at most one stage. All stages but the last return the columns of `documents`.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlake.llm import bpe, decontaminate, jaccard, language, toxicity
from bazaarlake.llm.common import stored, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a learnt language is recognised, with `lang` set to it; those without any letter go."""
    teachers = docs.filter(F.col("doc_id").isNotNull() & ~language.held_out())
    known = language.identify(docs, teachers).filter("lang_pred <> 'und'")
    return known.withColumn("lang", F.col("lang_pred")).select(*docs.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain does not call toxic."""
    categories = toxicity.categories()
    chain = toxicity.train(docs, table(spark, sf_dir, "labels"), categories)
    return toxicity.score(docs, chain, list(categories), decision="_toxic").filter("not _toxic").select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of linked ones, and all documents that are linked with none."""
    marked = jaccard.similar(docs)
    return marked.filter(F.col("component_id").isNull() | (F.col("component_id") == F.col("doc_id"))).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    found = decontaminate.scan(docs, table(spark, sf_dir, "benchmark"))
    return found.filter("contamination.n_hit = 0").select(*docs.columns)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and their digest, and the digest of the bytes that the ids decode to."""
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    encoded = bpe.encode(docs.select("doc_id", "text"), ranks, public_tokenizers.PATTERN, decoded="decoded")
    return encoded.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids", "ids_sha256",
                          F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language_id", identify_language), ("toxicity", drop_toxic), ("ngram_jaccard_join", drop_near_duplicates),
    ("decontamination", drop_contaminated), ("byte_bpe", encode_tokens),
]
ORACLE_SQL = None  # suffix automata, fitted models and token merges are beyond SQL; tests hold the stages against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; an empty table, null texts, and null or repeated ids pass like any other rows.

    Rows without text have no language and go in the first stage. Rows that share an id are one document for the
    duplicate stage and stay or go together unless their texts differ.
    """
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
