"""Token counts: Arrow batches in, lengths out.

``count_tokens(docs, file)`` adds ``n_bytes``, ``n_tokens`` and ``over_limit`` to
every row.  Texts are cut at boundaries where the encoding must cut as well, so a
text of any length is encoded in parts and no call gets more than ``CALL_BYTES``,
unless a single piece without a boundary is longer.  Calls are balanced by bytes,
not by rows.  Within a task every distinct piece is encoded once and only its
length is kept; the table of lengths is emptied at ``KEPT_PIECES`` entries.

Defined cases: a null or empty text has 0 bytes and 0 tokens; special strings in
a text count as the tokenizer's default has it; repeated rows each count; an
existing column of a new column's name is replaced; an empty table stays empty.
There is no shuffle: rows stay where they were read.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from waycast.llm.common import pieces, slices, texts

CALL_BYTES = 1 << 20
KEPT_PIECES = 200_000


def encoder(file: str):
    """A function from a list of texts to a list of id lists or of objects with a length."""
    if file.endswith(".model"):
        import sentencepiece

        processor = sentencepiece.SentencePieceProcessor(model_file=file)
        return lambda batch: processor.encode(batch, num_threads=1)
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark gives a task one core
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(file)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return lambda batch: tokenizer.encode_batch_fast(batch, add_special_tokens=False)


def _calls(parts: list[str]) -> Iterator[list[str]]:
    call, size = [], 0
    for part in parts:
        if call and size + len(part) > CALL_BYTES:
            yield call
            call, size = [], 0
        call.append(part)
        size += len(part) if part.isascii() else len(part.encode())
    if call:
        yield call


class Lengths(dict):
    """Token counts of pieces."""

    def learn(self, parts: set[str], encode) -> None:
        if len(self) > KEPT_PIECES:
            self.clear()
        fresh = [p for p in parts if p not in self]
        for call in _calls(fresh):
            self.update(zip(call, map(len, encode(call)), strict=True))


def _lengths_of(batch_texts: list[str], known: Lengths, encode, splits: bool) -> list[int]:
    cut = [pieces(t) for t in batch_texts] if splits else [[t] if t else [] for t in batch_texts]
    known.learn(set().union(*cut), encode)
    return [sum(map(known.__getitem__, c)) for c in cut]


def count_tokens(docs: DataFrame, file: str, limit: int = 1024, text: str = "text") -> DataFrame:
    """All columns of ``docs`` with ``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens).

    ``file``: a tokenizer file of the tokenizers library (byte-level BPE is cut at
    its boundaries; other kinds are encoded whole) or a ``.model`` of sentencepiece.
    """
    new = ["n_bytes", "n_tokens", "over_limit"]
    rows = docs.select(*[c for c in docs.columns if c not in new])
    schema = T.StructType([
        *rows.schema.fields, T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()),
        T.StructField("over_limit", T.BooleanType()),
    ])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, known, splits = encoder(file), Lengths(), _byte_level(file)
        for batch in slices(batches, text):
            column = batch.column(text)
            counts = pa.array(_lengths_of(texts(column), known, encode, splits), pa.int64())
            size = pc.cast(pc.fill_null(pc.binary_length(column), 0), pa.int64())
            arrays = [*batch.columns, size, counts, pc.greater(counts, limit)]
            yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names, *new])

    return rows.mapInArrow(work, schema)


def _byte_level(file: str) -> bool:
    """Whether the file is a byte-level BPE with the usual pattern and no prefix space, whose boundaries are known."""
    if file.endswith(".model"):
        return False
    import json

    with open(file) as f:
        spec = json.load(f)
    pre = spec.get("pre_tokenizer") or {}
    return (
        pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
        and spec.get("normalizer") is None and spec.get("post_processor") is None
        and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or any(c.isspace() for c in t["content"])
                    or not t["content"][0] in "<[" for t in spec.get("added_tokens", []))
    )
