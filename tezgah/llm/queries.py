"""The queries of the thirteen operators and the pipeline, each over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tezgah.llm import chat, decontaminate, line_dedup, lm_score, packing, pii, quality_lines, resample, sharding, simhash, token_files, toxicity, turn_repair
from tezgah.llm.common import table
from tezgah.llm.oracle import ORACLE_SQL

#: Surrogates depend on this key; a user keeps a secret one of their own.
PII_KEY = b"surrogates of the registered query"


def op1_simhash(spark: SparkSession, folder: str) -> DataFrame:
    near = simhash.near_duplicates(table(spark, folder, "documents"))
    return near.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op2_cross_entropy_difference(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    target = table(spark, folder, "labels").where("quality = 1").select("doc_id")
    return lm_score.scored(docs, lm_score.train(docs, target))


def op3_suffix_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.report(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "labels")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    model = toxicity.train(docs, labels.where(~held_out))
    scores = toxicity.scored(docs, model)
    return scores.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op5_perspectives(spark: SparkSession, folder: str) -> DataFrame:
    seen = chat.perspectives(table(spark, folder, "conversations"))
    spans = F.array_join(F.transform("mask", lambda s: F.concat_ws("-", s.start.cast("string"), s.stop.cast("string"))), ",")
    return seen.select("conv_id", "assistant", "part", "n_turns", "n_learned", "text", spans.alias("mask"))


def op6_bin_completion(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op7_winnowed_lines(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.report(table(spark, folder, "documents"))


def op8_surrogates(spark: SparkSession, folder: str) -> DataFrame:
    out = pii.anonymized(table(spark, folder, "documents").select("doc_id", "text"), PII_KEY)
    return out.select("row.doc_id", "text", "n_entities")


def op9_line_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality_lines.report(table(spark, folder, "documents"))


def op10_token_files(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    path = token_files.write_tokens(docs, public_tokenizers.path("word_bpe_49k.json"))
    return token_files.read_ids(token_files.find_keys(docs.select("doc_id").distinct(), path), path)


def op11_turn_repair(spark: SparkSession, folder: str) -> DataFrame:
    conversations = table(spark, folder, "conversations")
    return turn_repair.report(turn_repair.damaged(conversations), conversations)


def op12_resample(spark: SparkSession, folder: str) -> DataFrame:
    return resample.report(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op13_hilbert_shards(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.report(table(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_simhash, op2_cross_entropy_difference, op3_suffix_decontamination, op4_toxicity, op5_perspectives,
        op6_bin_completion, op7_winnowed_lines, op8_surrogates, op9_line_quality, op10_token_files,
        op11_turn_repair, op12_resample, op13_hilbert_shards,
    )
} | {"pipeline": corpus_pipeline.run}

ORACLE = dict(ORACLE_SQL)
