"""Helpers shared by the operators of this folder.

All heavy steps are Arrow functions over Spark partitions.  ``staged`` cuts
lineage through the shared folder of ``spark.checkpoint.dir``, never through a
folder of one machine.
"""

from __future__ import annotations

import ctypes
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waycast.session import staged, work_dir

__all__ = ["staged", "work_dir", "read", "texts", "pieces", "ragged", "arrow", "label_fold", "partitions"]

#: Letters that are letters in every version of Unicode's tables.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ſ"

#: Cuts a text where byte-level BPE must cut it as well: before ASCII white space
#: that follows something else, and after a letter that an ASCII non-letter
#: follows.  What lies on either side is encoded alone, to the same tokens.
PIECE = re.compile(rf"\s*[{_LETTERS}]++(?![^\x00-\x7f])|\s*\S+(?:[^\S \t-\r]\s*\S+)*|\s+")


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def texts(column: pa.Array) -> list[str]:
    """The column as Python strings, null as the empty text."""
    return [t or "" for t in column.to_pylist()]


def pieces(text: str) -> list[str]:
    """Pieces of a text that encode independently; joined they are the text."""
    return PIECE.findall(text)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indexes ``starts[i] .. starts[i] + lengths[i] - 1`` of all i, one after the other."""
    total = int(lengths.sum())
    if not total:
        return np.empty(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)


def arrow(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type) for f in schema], schema=schema)


def label_fold(doc_id, mod: int):
    """crc32 of the document's id as text, modulo ``mod``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % mod


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def give_back() -> None:
    """Memory a task no longer needs goes back to the machine: the worker lives on and takes other tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim:
        trim(0)


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows whose ``column`` holds about ``limit`` bytes at most, one row at least."""
    import pyarrow.compute as pc

    for batch in batches:
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0)).astype(np.int64)
        bins = (np.cumsum(sizes) - 1).clip(0) // limit
        borders = np.flatnonzero(np.diff(bins)) + 1
        for a, b in zip([0, *borders.tolist()], [*borders.tolist(), batch.num_rows], strict=True):
            if b > a:
                yield batch.slice(a, b - a)
    give_back()
