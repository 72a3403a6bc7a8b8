"""The registered queries of this folder, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waycast.llm import bpe_codec, decontaminate, line_dedup, nearest, oracles, phrases, quality, secrets, simhash, spelling, suffix_dedup, token_counts, toxicity, warc
from waycast.llm.common import label_fold, read, work_dir

CATALOG: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        CATALOG[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


@query("op1_token_counts")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_counts.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


@query("op6_bpe_codec")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe_codec.encode_digests(docs, public_tokenizers.path("byte_bpe_50k.json"))


@query("op7_line_dedup")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.kept(line_dedup.build(docs), docs, digest=True)


@query("op9_simhash")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.classes(read(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op2_decontaminate")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "benchmark"))


@query("op3_toxicity")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read(spark, sf_dir, "labels").where(label_fold(F.col("doc_id"), 5) != 0).select("doc_id", "toxic")
    scored = toxicity.score(docs, toxicity.fit(docs, labels))
    return scored.select("doc_id", (label_fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "predicted", "evidence")


@query("op4_quality")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read(spark, sf_dir, "labels").where(label_fold(F.col("doc_id"), 3) != 1).select("doc_id", "quality")
    scored = quality.score(docs, quality.fit(docs, labels))
    return scored.select("doc_id", (label_fold(F.col("doc_id"), 3) == 1).alias("held_out"), "score", "predicted")


@query("op5_nearest")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return nearest.search(vectors.where(F.col("vec_id") % 20 == 0), vectors, k=20)


@query("op8_secrets")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return secrets.digests(secrets.scan(docs, secrets.fit(docs)))


@query("op10_suffix_dedup")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove(read(spark, sf_dir, "documents").select("doc_id", "text"), digest=True)


@query("op11_phrases", oracles.PHRASES)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(phrases.count(read(spark, sf_dir, "documents").select("text", "lang")))


@query("op12_warc", oracles.ARCHIVED)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "warc")
    warc.write(read(spark, sf_dir, "pages"), path)
    return warc.read_archives(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op13_spelling", oracles.SPELLING)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.counted(read(spark, sf_dir, "documents").select("doc_id", "text"), slip=199))


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)
