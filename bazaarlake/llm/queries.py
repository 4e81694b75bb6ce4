"""The named queries of the operators, over whole tables, and their SQL counterparts."""

from __future__ import annotations

import public_tokenizers

from bazaarlake.llm import (
    alignment, bpe, decontaminate, jaccard, language, neighbours, periodic, sharding, simhash, token_counts, toxicity,
    url_filter, warc,
)
from bazaarlake.llm.common import table


def op1_byte_bpe(spark, sf):
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return bpe.round_trip(table(spark, sf, "documents"), ranks, public_tokenizers.PATTERN)


def op2_token_counts(spark, sf):
    model = token_counts.read_model(public_tokenizers.path("byte_bpe_50k.json"))
    return token_counts.count(table(spark, sf, "documents"), model, public_tokenizers.PATTERN)


def op3_decontamination(spark, sf):
    return decontaminate.report(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op4_toxicity(spark, sf):
    return toxicity.judge_documents(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op5_ngram_jaccard(spark, sf):
    return jaccard.report(table(spark, sf, "documents"))


def op6_warc_revisits(spark, sf):
    return warc.report(table(spark, sf, "pages"))


def op7_sharding(spark, sf):
    return sharding.shard_documents(table(spark, sf, "documents"))


def op8_url_filter(spark, sf):
    return url_filter.judge(table(spark, sf, "pages"))


def op9_language_id(spark, sf):
    return language.predict_documents(table(spark, sf, "documents"))


def op10_nearest_neighbours(spark, sf):
    vectors = table(spark, sf, "embeddings")
    return neighbours.nearest(vectors.filter("vec_id % 100 = 0"), vectors)


def op11_tokenizer_alignment(spark, sf):
    pair = alignment.Pair.read(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"),
                               public_tokenizers.PATTERN)
    return alignment.score(table(spark, sf, "documents"), pair)


def op12_simhash(spark, sf):
    return simhash.cluster(table(spark, sf, "documents"))


def op13_periodic_runs(spark, sf):
    return periodic.report(table(spark, sf, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_byte_bpe, op2_token_counts, op3_decontamination, op4_toxicity, op5_ngram_jaccard, op6_warc_revisits, op7_sharding, op8_url_filter,
    op9_language_id, op10_nearest_neighbours, op11_tokenizer_alignment, op12_simhash, op13_periodic_runs)}
ORACLES = {"op6_warc_revisits": warc.ORACLE, "op8_url_filter": url_filter.ORACLE,
           "op10_nearest_neighbours": neighbours.ORACLE}
