"""Reversible line dedup: exact reference counts behind sharded cuckoo filters.

A line's key is the line without ASCII white space at its ends, A-Z in lower case,
as its MD5 digest.  An ``Index`` is three tables in the shared folder:

* ``refs`` (key, doc_id): which document holds which key, once each;
* ``counts`` (key, n_docs, last_doc): exact reference counts;
* ``filters`` (shard, slots): a cuckoo filter per shard of keys with the keys that
  are held by at least ``min_docs`` documents, about ``SHARD_KEYS`` of them.

``insert`` adds documents and ``delete`` takes them away again; both change the
counts of the keys they touch only, and insert or delete exactly those keys in the
filters that cross ``min_docs``.  ``kept`` drops from documents of the index every
line whose key is in the filter, by the exact counts, except in the document with
the largest id.  Most keys are in one document and end at the filter, so only the
rest is joined with the counts.

Skew: a line may be in a third of all documents.  Counting combines before the
shuffle; probing is dealt by (shard, salt of the document), each with its copy of
the small filter, and streams; the counts are a written table, so that the join
with them can be split at run time.

Defined cases: null and empty texts are one empty line; keys shorter than
``min_chars`` code points always stay; rows with equal ids are one document (a null
id is one document as well, smaller than all others) and all of their rows are
treated alike; a column of the name of a result is replaced; empty tables give
empty results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waycast.llm.common import partitions, slices, staged

SHARD_KEYS = 4096
SALTS = 8
SLOTS, KICKS = 4, 500


class Cuckoo:
    """Buckets of four 16-bit fingerprints; a key may be in either of two buckets.

    ``slots`` is an array of (buckets, 4), buckets a power of two, 0 for empty.
    """

    def __init__(self, slots: np.ndarray):
        self.slots = slots

    @classmethod
    def of(cls, keys: list[bytes]) -> Cuckoo:
        buckets = 1
        while buckets * SLOTS * 0.85 < len(keys) + 1:
            buckets *= 2
        while True:
            made = cls(np.zeros((buckets, SLOTS), np.uint16))
            if all(made.insert(k) for k in keys):
                return made
            buckets *= 2

    def places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Fingerprint and both buckets of keys given as rows of 16 bytes."""
        words = np.ascontiguousarray(keys[:, 4:12]).view("<u4")
        print_ = (words[:, 0] % 65535 + 1).astype(np.uint16)
        mask = np.uint32(len(self.slots) - 1)
        one = words[:, 1] & mask
        return print_, one, (one ^ self._turn(print_)) & mask

    @staticmethod
    def _turn(print_):
        return np.uint32(0x5BD1E995) * np.asarray(print_, np.uint32) >> np.uint32(7)

    def _places(self, key: bytes) -> tuple[int, int, int]:
        p, one, two = self.places(np.frombuffer(key, np.uint8).reshape(1, -1))
        return int(p[0]), int(one[0]), int(two[0])

    def contains(self, keys: np.ndarray) -> np.ndarray:
        p, one, two = self.places(keys)
        return ((self.slots[one] == p[:, None]) | (self.slots[two] == p[:, None])).any(1)

    def insert(self, key: bytes) -> bool:
        """False if no room was found; the filter must then be built anew, larger."""
        p, at, other = self._places(key)
        for bucket in (at, other):
            free = np.flatnonzero(self.slots[bucket] == 0)
            if len(free):
                self.slots[bucket, free[0]] = p
                return True
        mask = len(self.slots) - 1
        for i in range(KICKS):
            slot = (i * 7 + p) % SLOTS
            p, self.slots[at, slot] = int(self.slots[at, slot]), p
            at = (at ^ int(self._turn(p))) & mask
            free = np.flatnonzero(self.slots[at] == 0)
            if len(free):
                self.slots[at, free[0]] = p
                return True
        return False

    def delete(self, key: bytes) -> None:
        p, *buckets = self._places(key)
        for bucket in buckets:
            hit = np.flatnonzero(self.slots[bucket] == p)
            if len(hit):
                self.slots[bucket, hit[0]] = 0
                return

    def to_bytes(self) -> bytes:
        return self.slots.tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> Cuckoo:
        return cls(np.frombuffer(data, np.uint16).reshape(-1, SLOTS).copy())


@dataclass(frozen=True)
class Index:
    refs: DataFrame
    counts: DataFrame
    filters: DataFrame
    shards: int
    min_docs: int = 3
    min_chars: int = 20


def line_key(line: bytes) -> bytes:
    return line.strip(b" \t\n\r\x0b\x0c").lower()


def _long(key: bytes, min_chars: int) -> bool:
    return len(key) >= min_chars and (len(key) >= 4 * min_chars or len(key.decode()) >= min_chars)


def _lines(column: pa.Array) -> list[list[bytes]]:
    return [(t or b"").split(b"\n") for t in column.cast(pa.binary()).to_pylist()]


def _refs(docs: DataFrame, min_chars: int, text: str) -> DataFrame:
    """(key, doc_id) of each document, once per document row."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            keys = [{k for k in map(line_key, lines) if _long(k, min_chars)} for lines in _lines(batch.column("text"))]
            ids = np.repeat(np.arange(batch.num_rows), [len(k) for k in keys])
            digests = pa.array([hashlib.md5(k).digest() for own in keys for k in own], pa.binary())
            yield pa.RecordBatch.from_arrays([digests, batch.column("doc_id").take(pa.array(ids))], names=["key", "doc_id"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(work, "key binary, doc_id long")


def _count(refs: DataFrame) -> DataFrame:
    return refs.groupBy("key").agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("last_doc"))


def _shard(key, shards: int):
    """By the first four bytes of the digest; the filter uses others."""
    return (F.conv(F.hex(F.substring(key, 1, 4)), 16, 10).cast("long") % shards).cast("int")


def _change(filters: DataFrame, keys: DataFrame, counts: DataFrame, index: Index) -> DataFrame:
    """Filters after inserting (``add``) or deleting the ``keys``; a full one is built anew from the exact counts."""
    old = filters.select("shard", F.lit(0).alias("kind"), F.col("slots").alias("data"))
    new = keys.select(_shard(F.col("key"), index.shards).alias("shard"), F.when(F.col("add"), 1).otherwise(2).alias("kind"), F.col("key").alias("data"))
    touched = new.select("shard").distinct()
    exact = counts.where(F.col("n_docs") >= index.min_docs).select(_shard(F.col("key"), index.shards).alias("shard"), F.lit(3).alias("kind"), F.col("key").alias("data"))
    rows = old.unionByName(new).unionByName(exact.join(touched, "shard", "left_semi"))

    def work(key: tuple, table: pa.Table) -> pa.Table:
        kinds, data = table.column("kind").to_pylist(), table.column("data").to_pylist()
        of = lambda kind: [d for k, d in zip(kinds, data, strict=True) if k == kind]
        had = of(0)
        filter_ = Cuckoo.from_bytes(had[0]) if had else None
        if had:
            for k in of(2):
                filter_.delete(k)
        if not had or not all(filter_.insert(k) for k in of(1)):
            filter_ = Cuckoo.of(of(3))
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "slots": pa.array([filter_.to_bytes()], pa.binary())})

    return rows.groupBy("shard").applyInArrow(work, "shard int, slots binary")


def build(docs: DataFrame, min_docs: int = 3, min_chars: int = 20, text: str = "text") -> Index:
    """The index of a first set of documents."""
    spark = docs.sparkSession
    refs = staged(_refs(docs, min_chars, text).distinct(), "line-refs")
    counts = staged(_count(refs), "line-counts")
    repeated = counts.where(F.col("n_docs") >= min_docs)
    shards = max(1, -(-repeated.count() // SHARD_KEYS))
    index = Index(refs, counts, spark.createDataFrame([], "shard int, slots binary"), shards, min_docs, min_chars)
    filters = _change(index.filters, repeated.select("key", F.lit(True).alias("add")), counts, index)
    return replace(index, filters=staged(filters, "line-filters"))


def _recounted(index: Index, refs: DataFrame, touched: DataFrame) -> Index:
    fresh = _count(refs.join(touched, "key", "left_semi"))
    counts = staged(index.counts.join(touched, "key", "left_anti").unionByName(fresh), "line-counts")
    was = index.counts.select("key", F.col("n_docs").alias("was")).join(touched, "key", "left_semi")
    now = counts.select("key", F.col("n_docs").alias("now")).join(touched, "key", "left_semi")
    both = was.join(now, "key", "full").select("key", *((F.coalesce(F.col(c), F.lit(0)) >= index.min_docs).alias(c) for c in ("was", "now")))
    crossed = both.where("was != now").select("key", F.col("now").alias("add"))
    filters = staged(_change(index.filters, crossed, counts, index), "line-filters")
    return replace(index, refs=refs, counts=counts, filters=filters)


def insert(index: Index, docs: DataFrame, text: str = "text") -> Index:
    """The index with more documents; a document it holds already gains the lines that are new to it."""
    more = _refs(docs, index.min_chars, text).distinct()
    fresh = staged(_minus(more, index.refs, ["key", "doc_id"]), "line-refs")
    refs = staged(index.refs.unionByName(fresh), "line-refs")
    return _recounted(index, refs, fresh.select("key").distinct())


def delete(index: Index, ids: DataFrame) -> Index:
    """The index without the documents in column ``doc_id`` of ``ids``: as if they had never been inserted."""
    gone = ids.select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    refs = staged(_minus(index.refs, gone, ["doc_id"]), "line-refs")
    touched = index.refs.join(gone.withColumnRenamed("doc_id", "_id"), F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
    return _recounted(index, refs, staged(touched.select("key").distinct(), "line-keys"))


def _minus(rows: DataFrame, other: DataFrame, on: list[str]) -> DataFrame:
    renamed = other.select(*[F.col(c).alias(f"_{c}") for c in on])
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in on]
    return rows.join(renamed, same, "left_anti")


def dropped(index: Index) -> DataFrame:
    """(doc_id, keys): the keys whose lines each document loses, for documents that lose any."""
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")
    refs = index.refs.select(_shard(F.col("key"), index.shards).alias("shard"), salt.alias("salt"), F.lit(1).alias("kind"), F.col("key").alias("data"), "doc_id")
    salts = F.explode(F.array(*map(F.lit, range(SALTS)))).alias("salt")
    filters = index.filters.select("shard", salts, F.lit(0).alias("kind"), F.col("slots").alias("data"), F.lit(None).cast("long").alias("doc_id"))
    n = partitions(index.refs.sparkSession)
    dealt = refs.unionByName(filters).repartition(n, "shard", "salt").sortWithinPartitions("shard", "salt", "kind")

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Filters come before the keys they are for."""
        at, current = None, None
        for batch in batches:
            shard, salt, kind = (np.asarray(batch.column(c)) for c in ("shard", "salt", "kind"))
            data = batch.column("data")
            borders = np.flatnonzero((np.diff(shard) != 0) | (np.diff(salt) != 0) | (np.diff(kind) != 0)) + 1
            for a, b in zip(np.r_[0, borders].tolist(), np.r_[borders, len(shard)].tolist(), strict=True):
                own = data.slice(a, b - a).to_pylist()
                if not own:
                    continue
                if kind[a] == 0:
                    at, current = (shard[a], salt[a]), Cuckoo.from_bytes(own[0])
                elif at == (shard[a], salt[a]):
                    hit = current.contains(np.frombuffer(b"".join(own), np.uint8).reshape(len(own), -1))
                    found = pa.array(np.flatnonzero(hit) + a)
                    yield pa.RecordBatch.from_arrays([data.take(found), batch.column("doc_id").take(found)], names=["key", "doc_id"])

    maybe = dealt.mapInArrow(probe, "key binary, doc_id long")
    counts = index.counts.where(F.col("n_docs") >= index.min_docs).select("key", "last_doc")
    lost = maybe.join(counts, "key").where(~F.col("doc_id").eqNullSafe(F.col("last_doc")))
    return lost.groupBy("doc_id").agg(F.collect_list("key").alias("keys"))


def kept(index: Index, docs: DataFrame, text: str = "text", digest: bool = False) -> DataFrame:
    """All columns of ``docs`` (documents of the index) but the text, with ``n_lines``, ``n_dropped`` and ``kept``.

    ``kept`` is the text of the lines that stay; with ``digest`` its SHA-256 comes as ``kept_sha256``.
    """
    last = "kept_sha256" if digest else "kept"
    results = ["n_lines", "n_dropped", last]
    others = [c for c in docs.columns if c not in (text, *results)]
    lost = dropped(index).select(F.col("doc_id").alias("_id"), F.col("keys").alias("_keys"))
    rows = docs.select(*others, F.col(text).alias("_text"))
    joined = rows.join(lost.hint("shuffle_hash"), F.col("doc_id").cast("long").eqNullSafe(F.col("_id")), "left").select(*others, "_text", "_keys")
    schema = T.StructType([
        *docs.select(*others).schema.fields, T.StructField("n_lines", T.LongType()),
        T.StructField("n_dropped", T.LongType()), T.StructField(last, T.StringType()),
    ])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            counts, gone, left = [], [], []
            for lines, keys in zip(_lines(batch.column("_text")), batch.column("_keys").to_pylist(), strict=True):
                drop = set(keys or ())
                stay = [x for x in lines if hashlib.md5(line_key(x)).digest() not in drop] if drop else lines
                counts.append(len(lines))
                gone.append(len(lines) - len(stay))
                whole = b"\n".join(stay)
                left.append(hashlib.sha256(whole).hexdigest() if digest else whole.decode())
            new = [pa.array(counts, pa.int64()), pa.array(gone, pa.int64()), pa.array(left, pa.string())]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in others), *new], names=[*others, *results])

    return joined.mapInArrow(work, schema)
