"""BPE encoding and decoding by a distributed table of distinct words.

1. Blocks.  Each task cuts its texts into words (pieces that encode alone) and
   packs about ``BLOCK_BYTES`` of text into one block: the list of the block's
   distinct words and, for each document, the positions of its words in that list.
2. Word table.  The blocks' words are dealt out by hash; each shard encodes every
   distinct word once.
3. Join back.  Every block gets the ids of its words by position, joins the ids of
   each distinct word with the id-to-piece table, and puts its documents together.
   The piece table has one row per entry of the vocabulary file, so its size is
   fixed by the file; it is broadcast as a list and looked up by id (``decode`` joins).

A frequent word is one entry per block, never one row per occurrence, so no word
can be a hot key.  A block holds ``BLOCK_BYTES`` of text or one document.

Shuffled: the blocks (word positions, about a third of the text), the distinct
words of each block, and their ids.  The block exchange is used twice and computed
once; block numbers are digests of the block's content, so a recomputed block is
the same block.  Ids missing for a block raise an error instead of losing rows.

Defined cases: null and empty texts have no tokens and the digests of no bytes;
special strings in texts become their special token, as is the tokenizer's
default, and are kept in decoding; repeated rows are encoded each; columns of
``docs`` of the same names as results are replaced; an empty table stays empty.
"""

from __future__ import annotations

import hashlib
import json
import pickle
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waycast.llm.common import arrow, give_back, partitions, pieces, slices, texts
from waycast.llm.token_counts import _byte_level, _calls, encoder

BLOCK_BYTES = 8 << 20
#: More shards than this do not help: a shard of a hundred terabytes still has a few million words.
MOST_SHARDS = 4096


def _byte_values() -> dict[str, int]:
    """The character that byte-level vocabularies write for each byte: printable ones stand for themselves."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def piece_table(spark: SparkSession, file: str) -> DataFrame:
    """(id, piece): the bytes each id of a byte-level vocabulary stands for."""
    spec = json.load(open(file))
    value = _byte_values()
    special = {t["id"]: t["content"].encode() for t in spec["added_tokens"]}
    table = {i: bytes(value[c] for c in p) for p, i in spec["model"]["vocab"].items() if i not in special} | special
    rows = pa.table({"id": pa.array(table.keys(), pa.int32()), "piece": pa.array(table.values(), pa.binary())})
    return spark.createDataFrame(rows)


class _Places(dict):
    def __missing__(self, word: str) -> int:
        self[word] = place = len(self)
        return place


def decode(rows: DataFrame, file: str, ids: str = "ids") -> DataFrame:
    """``rows`` with ``decoded``: the bytes of the array column ``ids``, by a join of every id with its piece.

    Unknown ids decode to nothing; a null array to null.
    """
    names = [c for c in rows.columns if c != "decoded"]
    rows = rows.select(*names).withColumn("_row", F.monotonically_increasing_id())
    parts = rows.select("_row", F.posexplode(ids).alias("_at", "_id"))
    found = parts.join(F.broadcast(piece_table(rows.sparkSession, file)), parts["_id"] == F.col("id"))
    joined = found.groupBy("_row").agg(F.array_sort(F.collect_list(F.struct("_at", "piece"))).alias("_found"))
    empty = F.lit(b"")
    whole = F.aggregate("_found", empty, lambda done, p: F.concat(done, p["piece"]))
    decoded = F.when(F.col(ids).isNotNull(), F.coalesce(whole, empty))
    return rows.join(joined, "_row", "left").select(*names, decoded.alias("decoded"))


def _pack(value, level: int = 3) -> bytes:
    return zstandard.ZstdCompressor(level=level).compress(pickle.dumps(value, protocol=5))


def _unpack(data: bytes):
    return pickle.loads(zstandard.ZstdDecompressor().decompress(data))


def _planes(values: np.ndarray) -> list[bytes]:
    """Byte planes of small numbers: these compress well, mixed bytes do not."""
    raw = np.ascontiguousarray(values, "<u4").view(np.uint8).reshape(-1, 4)
    return [np.ascontiguousarray(raw[:, i]).tobytes() for i in range(4)]


def _pack_words(words: list[str]) -> bytes:
    return _pack((_planes(np.array([len(w) for w in words], np.uint32)), "".join(words).encode()), 9)


def _unpack_words(data: bytes) -> list[str]:
    lengths, text = _unpack(data)
    text, ends = text.decode(), np.cumsum(_numbers(lengths)).tolist()
    return [text[a:b] for a, b in zip([0, *ends], ends, strict=False)]


def _numbers(planes: list[bytes]) -> np.ndarray:
    return np.ascontiguousarray(np.stack([np.frombuffer(p, np.uint8) for p in planes], 1)).view("<u4").ravel()


_BLOCK = pa.schema([pa.field("block", pa.string(), False), pa.field("body", pa.binary(), False)])
_WORDS = pa.schema([("shard", pa.int32()), ("block", pa.string()), ("words", pa.binary())])
_CODES = pa.schema([pa.field("block", pa.string(), False), pa.field("codes", pa.binary())])


def _blocks(docs: DataFrame, text: str, others: list[str]) -> DataFrame:
    def pack(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        places, lengths, runs = _Places(), [], []
        for part in rows:
            for t in texts(part.column(text)):
                run = list(map(places.__getitem__, pieces(t)))
                lengths.append(len(run))
                runs.append(np.array(run, np.uint32))
        with pa.BufferOutputStream() as sink:
            kept = pa.Table.from_batches(rows).select(others)
            with pa.ipc.new_stream(sink, kept.schema) as writer:
                writer.write_table(kept)
            rest = sink.getvalue().to_pybytes()
        at, words = np.concatenate(runs), list(places)
        order = np.argsort(-np.bincount(at, minlength=len(words)), kind="stable")  # frequent words get small numbers
        place = np.empty(len(words), np.uint32)
        place[order] = np.arange(len(words), dtype=np.uint32)
        body = pickle.dumps((_pack_words([words[i] for i in order.tolist()]), _pack((lengths, _planes(place[at]), rest))))
        return arrow(_BLOCK, block=[hashlib.md5(body).hexdigest()], body=[body])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in slices(batches, text, BLOCK_BYTES // 4):
            held.append(batch)
            size += batch.column(text).nbytes
            if size >= BLOCK_BYTES:
                yield pack(held)
                held, size = [], 0
        if held:
            yield pack(held)

    schema = T.StructType([T.StructField("block", T.StringType(), False), T.StructField("body", T.BinaryType(), False)])
    n = partitions(docs.sparkSession)
    return docs.select(text, *others).mapInArrow(work, schema).repartition(n, "block")


def _homes(words: list[str], shards: int) -> Iterator[tuple[int, np.ndarray]]:
    """The shard and the places of a list's words in it, for each shard that has any."""
    home = np.fromiter((zlib.crc32(w.encode()) for w in words), np.uint32, len(words)) % shards
    order = np.argsort(home, kind="stable")
    for at in np.split(order, np.flatnonzero(np.diff(home[order])) + 1) if words else []:
        yield int(home[at[0]]), at


def _words(blocks: DataFrame, shards: int) -> DataFrame:
    """The distinct words of each block, dealt out to shards by a hash of the word."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, body in zip(batch.column("block").to_pylist(), batch.column("body"), strict=True):
                words = _unpack_words(pickle.loads(body.as_buffer())[0])
                for shard, at in _homes(words, shards):
                    own = _pack_words([words[i] for i in at.tolist()])
                    yield arrow(_WORDS, shard=[shard], block=[block], words=[own])
        give_back()

    return blocks.mapInArrow(work, "shard int, block string, words binary")


def _codes(words: DataFrame, file: str) -> DataFrame:
    """The ids of each block's words of each shard, from the shard's table: (block, codes)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_batch, table, current = encoder(file), {}, None
        for batch in batches:
            for shard, block, data in zip(*(batch.column(c).to_pylist() for c in ("shard", "block", "words")), strict=True):
                if shard != current:
                    current, table = shard, {}
                own = _unpack_words(data)
                for call in _calls([w for w in own if w not in table]):
                    table.update(zip(call, (e.ids for e in encode_batch(call)), strict=True))
                coded = [table[w] for w in own]
                flat = np.array([i for ids in coded for i in ids], np.uint32)
                body = shard, _planes(np.array(list(map(len, coded)), np.uint32)), _planes(flat)
                yield arrow(_CODES, block=[block], codes=[_pack(body)])
        give_back()

    return words.mapInArrow(work, "block string, codes binary")


def _encoded(docs: DataFrame, file: str, text: str, results: list, finish) -> DataFrame:
    """``results``: name and type of the new columns; ``finish`` makes their values from all ids and bytes of a text."""
    if not _byte_level(file):
        raise ValueError("the word table needs a byte-level BPE file without prefix space")
    spark, n = docs.sparkSession, partitions(docs.sparkSession)
    others = [c for c in docs.columns if c not in (text, *(name for name, _ in results))]
    blocks = _blocks(docs, text, others)
    shards = min(n, MOST_SHARDS)
    dealt = _words(blocks, shards).repartition(n, "shard").sortWithinPartitions("shard")
    table = sorted((r["id"], bytes(r["piece"])) for r in piece_table(spark, file).toLocalIterator())
    pieces_of = [b""] * (table[-1][0] + 1)
    for i, piece in table:
        pieces_of[i] = piece
    held = spark.sparkContext.broadcast(pieces_of)
    codes = _codes(dealt, file).groupBy("block").agg(F.collect_list("codes").alias("codes"))
    whole = blocks.join(codes.hint("shuffle_hash"), "block", "left")
    schema = T.StructType([*docs.select(*others).schema.fields, *(T.StructField(name, kind) for name, kind in results)])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for body, parts in zip(batch.column("body"), batch.column("codes"), strict=True):
                words, rest = pickle.loads(body.as_buffer())
                lengths, planes, kept = _unpack(rest)
                ids, back = _by_place(_unpack_words(words), shards, parts.as_py() or [], held.value)
                places, rows = _numbers(planes), []
                for e, k in zip(np.cumsum(lengths).tolist(), lengths, strict=True):
                    at = places[e - k : e].tolist()
                    rows.append(finish(b"".join(map(ids.__getitem__, at)), b"".join(map(back.__getitem__, at))))
                with pa.ipc.open_stream(kept) as reader:
                    old = reader.read_all().combine_chunks()
                columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
                done = pa.Table.from_arrays([*old.columns, *columns], names=[*old.column_names, *names]) if others else pa.table(columns, names=names)
                yield from done.to_batches()
        give_back()

    names, kinds = [name for name, _ in results], [_ARROW[kind] for _, kind in results]
    return whole.mapInArrow(work, schema)


_ARROW = {T.LongType(): pa.int64(), T.StringType(): pa.string(), T.BinaryType(): pa.binary()}


def _by_place(words: list[str], shards: int, parts: list[bytes], pieces_of: list[bytes]) -> tuple[list[bytes], list[bytes]]:
    """Ids (as bytes) and decoded bytes of a block's words, each at the word's place."""
    ids: list = [None] * len(words)
    back: list = [None] * len(words)
    by_shard = {shard: (lengths, flat) for shard, lengths, flat in map(_unpack, parts)}
    for shard, at in _homes(words, shards):
        if shard not in by_shard:
            raise RuntimeError("a block lacks ids of its words: the input gave other rows when it was read again")
        lengths, flat = map(_numbers, by_shard[shard])
        found = list(map(pieces_of.__getitem__, flat.tolist()))
        raw, a = flat.astype("<u4").tobytes(), 0
        for i, k in zip(at.tolist(), lengths.tolist(), strict=True):
            ids[i], back[i] = raw[4 * a : 4 * (a + k)], b"".join(found[a : a + k])
            a += k
    return ids, back


def _shown_digest(back: bytes) -> str:
    """Digest of the decoded text; what is no UTF-8 becomes the replacement character, as in the library."""
    return hashlib.sha256(back.decode("utf-8", "replace").encode()).hexdigest()


def encode(docs: DataFrame, file: str, text: str = "text", digest: bool = False) -> DataFrame:
    """All columns of ``docs`` but the text, with ``n_tokens``, ``ids`` (little-endian u32) and ``decoded`` (bytes).

    With ``digest`` the decoded text comes as ``decoded_sha256``, made where it is decoded.
    ``file`` must be a byte-level BPE of the tokenizers library without prefix space.
    """
    last = ("decoded_sha256", T.StringType()) if digest else ("decoded", T.BinaryType())
    results = [("n_tokens", T.LongType()), ("ids", T.BinaryType()), last]
    return _encoded(docs, file, text, results, lambda ids, back: (len(ids) // 4, ids, _shown_digest(back) if digest else back))


def encode_digests(docs: DataFrame, file: str, text: str = "text") -> DataFrame:
    """As ``encode``, with ``ids_sha256`` and ``decoded_sha256`` in place of ids and bytes."""
    results = [("n_tokens", T.LongType()), ("ids_sha256", T.StringType()), ("decoded_sha256", T.StringType())]

    def finish(ids: bytes, back: bytes) -> tuple:
        return len(ids) // 4, hashlib.sha256(ids).hexdigest(), _shown_digest(back)

    return _encoded(docs, file, text, results, finish)
