"""A corpus from raw documents to token ids, in five stages.

Every stage takes ``(spark, docs, sf_dir)`` and works on all documents that the stage
before left; all but the last return the columns of their input.

1. ``toxicity``: documents predicted toxic go.
2. ``line_dedup``: lines repeated in three documents or more stay only in the last.
3. ``near_dedup``: of each group of near-duplicates (five-word shingles, similarity
   0.8 or more) the document with the smallest id stays.
4. ``decontaminate``: documents that leak a benchmark item go.
5. ``encode``: texts become token ids; their decoding is digested.

Columns other than ``doc_id`` and ``text`` may have any names.  ``n_chars`` follows
the text where lines were dropped.  Empty tables pass through.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waycast.llm import bpe_codec, decontaminate, line_dedup, simhash, toxicity
from waycast.llm.common import read, staged


def _apart(docs: DataFrame, work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``work`` on ``docs`` with its other columns under names that no operator uses; they get their names back."""
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    hidden = {c: f"_other_{i}" for i, c in enumerate(others)}
    done = work(docs.select("doc_id", "text", *(F.col(f"`{c}`").alias(h) for c, h in hidden.items())))
    back = {h: c for c, h in hidden.items()}
    return done.select(*(F.col(c).alias(back.get(c, c)) for c in done.columns))


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = read(spark, sf_dir, "labels").select("doc_id", "toxic")

    def work(rows: DataFrame) -> DataFrame:
        model = toxicity.fit(rows, labels)
        return toxicity.score(rows, model).where("predicted = 0").select(*rows.columns)

    return _apart(docs, work).select(*(f"`{c}`" for c in docs.columns))


def lines_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    def work(rows: DataFrame) -> DataFrame:
        left = line_dedup.kept(line_dedup.build(rows), rows.withColumn("_null", F.col("text").isNull()))
        text = F.when(F.col("_null"), None).otherwise(F.col("kept")).alias("text")
        return left.select(*(text if c == "text" else c for c in rows.columns), (F.col("n_dropped") > 0).alias("_changed"))

    done = _apart(docs, work)
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        length = F.when(F.col("_changed"), F.length("text").cast(kind)).otherwise(F.col("n_chars"))
        done = done.withColumn("n_chars", length)
    return done.select(*(f"`{c}`" for c in docs.columns))


def copies_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _apart(docs, simhash.one_of_each).select(*(f"`{c}`" for c in docs.columns))


def leaks_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    items = read(spark, sf_dir, "benchmark")
    return _apart(docs, lambda rows: decontaminate.clean(rows, items)).select(*(f"`{c}`" for c in docs.columns))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The columns but the text, with ``n_tokens``, ``ids`` (little-endian u32) and ``decoded_sha256``."""
    file = public_tokenizers.path("byte_bpe_50k.json")

    def work(rows: DataFrame) -> DataFrame:
        others = [c for c in rows.columns if c != "text"]
        return bpe_codec.encode(rows, file, digest=True).select(*others, "n_tokens", "ids", "decoded_sha256")

    others = [c for c in docs.columns if c not in ("n_tokens", "ids", "decoded_sha256")]
    return _apart(docs.select(*(f"`{c}`" for c in others)), work)


STAGES = [
    ("toxicity", toxic_out),
    ("line_dedup", lines_out),
    ("near_dedup", copies_out),
    ("decontaminate", leaks_out),
    ("encode", encoded),
]

#: The trained score, the random projections and the tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
