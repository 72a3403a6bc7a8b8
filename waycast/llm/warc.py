"""WARC archives with a Zstandard dictionary, written and read by Spark.

``write`` archives pages, one record each, and ``read_archives`` gives them back.

1. Roles.  Of pages with equal payloads of at least ``min_bytes`` that with the smallest
   id is a ``response``, the others are ``revisit`` records that refer to it and hold no
   payload.  Digests and ids alone are grouped; payloads move only if the table of
   repeated digests is too large to be broadcast, which Spark decides by its written size.
2. Dictionary.  A task trains it from the records whose payloads have the ``SAMPLES``
   smallest digest hashes, one per payload, of ``min_bytes`` to ``SAMPLE_BYTES`` each
   (others are archived like all, but teach nothing).  It has ``dict_bytes`` at most.
3. Archives.  Each file begins with a skippable frame that holds the dictionary, itself
   compressed; each record is a Zstandard frame of its own, compressed with it, so any
   record can be read alone.

The files are written by Spark's text sink, with the usual commit: a lost task leaves
nothing behind, and any file system that Spark writes to will do.  The line separator is
an empty skippable frame, which every Zstandard reader passes over, so a file is one valid
``.warc.zst`` whatever its suffix.  A frame in which these eight bytes occur is compressed
again at another level.  Reading splits large files at the separators.

Defined cases: a null payload is empty; pages that repeat the smallest id and the payload
are all responses; pages without an id are never referred to, and are revisits if a page
with an id has their payload; a null address is left out; characters that a header cannot
hold are percent-encoded in addresses; other columns are not read; where too few payloads
can teach, files have no dictionary; an empty table gives an archive without records.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Callable, Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waycast.llm.common import slices, staged

#: Fixed values of the formats: magic numbers of skippable frames, little-endian.
DICTIONARY = struct.pack("<I", 0x184D2A5D)
SEPARATOR = struct.pack("<II", 0x184D2A50, 0)
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

SAMPLES, SAMPLE_BYTES, LEAST_SAMPLES = 1024, 32 << 10, 8
#: Dictionaries a reader holds at most; archives of one ``write`` share one.
DICTIONARIES = 64

_URI = "!#$%&'()*+,/:;=?@[]~-._"
_SPACE = re.compile(r"[\x00-\x20\x7f]")


def _keyed(pages: DataFrame, page_id: str, html: str, url: str | None = None) -> DataFrame:
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    columns = [F.col(page_id).cast("long").alias("page_id"), *([F.col(url).cast("string").alias("url")] if url else []), payload.alias("payload")]
    return pages.select(*columns).withColumns({"digest": F.sha2("payload", 256), "size": F.octet_length("payload").cast("long")})


def _clean(make: Callable[[int], bytes]) -> bytes:
    """The first of ``make(level)`` that does not hold the separator."""
    for level in (3, *range(4, 20), *range(-1, -50, -1)):
        if SEPARATOR not in (frame := make(level)):
            return frame
    raise ValueError("no compression level avoids the separator")


def _record(page_id: int | None, url: str | None, digest: str, size: int, payload: bytes | None, first: int | None, date: str) -> bytes:
    own, about = (f"<urn:page:{'null' if i is None else i}:{digest[:16]}>" for i in (page_id, first))
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if payload is None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if payload is None else 'response'}", f"WARC-Record-ID: {own}", f"WARC-Date: {date}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=_URI) if _SPACE.search(url) or not url.isascii() else url}")
    head.append(f"WARC-Payload-Digest: sha256:{digest}")
    if payload is None:
        head += [f"WARC-Refers-To: {about}", f"WARC-Profile: {REVISIT}"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode() + block + b"\r\n\r\n"


def _trained(rows: DataFrame, size: int, level: int, date: str) -> bytes | None:
    """The dictionary from the records of ``rows``, at most ``SAMPLES`` of them, trained in a task."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        samples = []
        for batch in batches:
            for values in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
                samples.append(_record(*values, None, date))
        samples.sort()
        if len(samples) < LEAST_SAMPLES:
            return
        try:
            trained = zstandard.train_dictionary(size, samples, k=1024, d=8, level=level)
        except zstandard.ZstdError:  # too little in them
            return
        yield pa.RecordBatch.from_arrays([pa.array([trained.as_bytes()], pa.binary())], names=["dictionary"])

    names = ["page_id", "url", "digest", "size", "payload"]
    made = rows.select(*names).coalesce(1).mapInArrow(work, "dictionary binary").collect()
    return bytes(made[0][0]) if made else None


def write(
    pages: DataFrame, path: str, min_bytes: int = 100, dict_bytes: int = 64 << 10, level: int = 3,
    date: str = "2024-01-01T00:00:00Z", page_id: str = "page_id", url: str = "url", html: str = "html",
) -> None:
    """Archives ``pages`` as files in the new folder ``path``; ``date`` is that of all records."""
    ids = staged(_keyed(pages, page_id, html).select("page_id", "digest", "size"), "warc-digests")
    groups = ids.where(F.col("size") >= min_bytes).groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("c"))
    groups = staged(groups.where("c > 1 and first is not null").select("digest", "first"), "warc-repeats")
    hashed = F.xxhash64("digest")
    teaching = (F.col("size") >= min_bytes) & (F.col("size") <= SAMPLE_BYTES)
    last = ids.where(teaching).select(hashed.alias("h")).distinct().orderBy("h").limit(SAMPLES).agg(F.max("h")).first()[0]
    rows = _keyed(pages, page_id, html, url).join(groups, "digest", "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    rows = rows.withColumn("payload", F.when(~revisit, F.col("payload")))
    dictionary = None
    if last is not None:
        one = F.min(F.struct("page_id", "url", "size", "payload")).alias("one")
        sample = _keyed(pages, page_id, html, url).where(teaching & (hashed <= F.lit(last))).groupBy("digest").agg(one)
        dictionary = _trained(sample.select("digest", "one.*"), dict_bytes, level, date)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def frames(*made: bytes) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], names=["frame"])

        compressors: dict[int, zstandard.ZstdCompressor] = {}
        trained = zstandard.ZstdCompressionDict(dictionary) if dictionary else None

        def compress(record: bytes, at: int) -> bytes:
            if at not in compressors:
                compressors[at] = zstandard.ZstdCompressor(level=at, dict_data=trained, write_checksum=True)
            return compressors[at].compress(record)

        begun = False
        for batch in slices(batches, "payload"):
            if dictionary and not begun:
                packed = _clean(lambda at: zstandard.ZstdCompressor(level=at).compress(dictionary))
                yield frames(DICTIONARY + struct.pack("<I", len(packed)) + packed)
            begun = True
            made = []
            for values in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "digest", "size", "payload", "first")), strict=True):
                record = _record(*values, date)
                made.append(_clean(lambda at, record=record: compress(record, level if at == 3 else at)))
            yield frames(*made)

    written = rows.select("page_id", "url", "digest", "size", "payload", "first").mapInArrow(work, "frame binary")
    written.select(F.col("frame").cast("string").alias("value")).write.option("lineSep", SEPARATOR.decode()).text(path)


def _parsed(record: bytes) -> tuple:
    """(page_id, url, record type, payload bytes, digest, id referred to, payload) of one record; the digest of a payload is recomputed."""
    head, _, rest = record.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines)
    block = rest[: int(fields["Content-Length"])]
    if version != "WARC/1.1" or rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("not a whole WARC record")
    http, _, payload = block.partition(b"\r\n\r\n")
    number = lambda urn: None if urn is None or urn.split(":")[2] == "null" else int(urn.split(":")[2])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    size = int(dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])["Content-Length"])
    kind = fields["WARC-Type"]
    if kind == "response":
        if len(payload) != size or hashlib.sha256(payload).hexdigest() != digest:
            raise ValueError(f"payload of {fields['WARC-Record-ID']} does not have its digest")
    else:
        payload = None
    return number(fields["WARC-Record-ID"]), fields.get("WARC-Target-URI"), kind, size, digest, number(fields.get("WARC-Refers-To")), payload


def read_archives(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """(page_id, url, record_type, payload_bytes, payload_digest, refers_to), with ``payload`` if wanted: null for revisits."""
    frames = spark.read.option("lineSep", SEPARATOR.decode()).text(path).select(F.col("value").cast("binary").alias("frame"))
    embedded = frames.where(F.substring("frame", 1, 4) == F.lit(DICTIONARY)).distinct().limit(DICTIONARIES + 1).collect()
    if len(embedded) > DICTIONARIES:
        raise ValueError(f"more than {DICTIONARIES} dictionaries: read fewer archives at a time")
    dictionaries = [zstandard.ZstdDecompressor().decompress(bytes(r[0])[8:]) for r in embedded]
    columns = ["page_id long", "url string", "record_type string", "payload_bytes long", "payload_digest string", "refers_to long", "payload binary"]
    columns = columns if payloads else columns[:-1]
    names = [c.split()[0] for c in columns]
    types = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trained = [zstandard.ZstdCompressionDict(d) for d in dictionaries]
        readers = {0: zstandard.ZstdDecompressor(), **{t.dict_id(): zstandard.ZstdDecompressor(dict_data=t) for t in trained}}
        for batch in slices(batches, "frame"):
            records = []
            for frame in batch.column("frame").to_pylist():
                if frame and not 0x184D2A50 <= struct.unpack_from("<I", frame)[0] <= 0x184D2A5F:
                    records.append(_parsed(readers[zstandard.get_frame_parameters(frame).dict_id].decompress(frame)))
            parts = list(zip(*records, strict=True)) if records else [()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(p, types[c.split()[1]]) for p, c in zip(parts, columns, strict=False)], names=names)

    return frames.mapInArrow(work, ", ".join(columns))
