"""WARC archives: an exact round trip, roles by brute force, files that a plain Zstandard reader understands."""

import glob
import hashlib
import struct

import pytest
import zstandard

from waycast.llm import warc

HEAD = "<html><head><title>A page of the collection</title><meta charset='utf-8'></head><body class='main'>"


def archived(spark, tmp_path, rows, schema="page_id long, url string, html string", **options):
    path = f"{tmp_path}/archive"
    warc.write(spark.createDataFrame(rows, schema).repartition(3), path, **options)
    return path


def roles(rows, least=100):
    first = {}
    for page_id, _, html in rows:
        data = (html or "").encode()
        if len(data) >= least and page_id is not None:
            first[data] = min(page_id, first.get(data, page_id))
    out = []
    for page_id, _, html in rows:
        data = (html or "").encode()
        of = first.get(data)
        revisit = of is not None and of != page_id
        out.append((page_id, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", of if revisit else None))
    return sorted(out, key=str)


def rows_of(n):
    rows = [(i, f"http://h/{i}", HEAD + f"<p>text {i * 7919}</p>" * (i % 40)) for i in range(n)]
    rows += [(n + i, "u", rows[11][2]) for i in range(20)]
    return rows


ODD = [
    (None, None, None), (None, "http://h/ü ü\r\nX: y", "n" * 100), (5, "", "n" * 100), (5, "", "n" * 100), (3, "x", "n" * 99), (4, "x", "n" * 99),
    (None, "a", "only without an id" * 20), (None, "a", "only without an id" * 20), (9, "a", "\r\n\r\nWARC/1.1\r\n\r\n" * 30),
    (10, "a", warc.SEPARATOR.decode() * 50), (11, "a", "é" * 2_000_000), (12, "a", ""),
]


@pytest.mark.parametrize("rows", [rows_of(300) + ODD, ODD, []], ids=["dictionary", "none", "empty"])
def test_round_trip(spark, tmp_path, rows):
    path = archived(spark, tmp_path, rows)
    read = warc.read_archives(spark, path, payloads=True).collect()
    got = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in read), key=str)
    assert got == roles(rows)
    for r in read:
        assert r.record_type == "revisit" and r.payload is None or hashlib.sha256(bytes(r.payload)).hexdigest() == r.payload_digest
    kept = {(r.page_id, r.payload_digest) for r in read if r.record_type == "response"}
    assert all((r.refers_to, r.payload_digest) in kept for r in read if r.record_type == "revisit")


def test_files_are_plain_zstandard_with_the_dictionary_first(spark, tmp_path):
    rows = rows_of(300)
    path = archived(spark, tmp_path, rows)
    whole, alone, count = 0, 0, 0
    for name in glob.glob(f"{path}/part-*"):
        data = open(name, "rb").read()
        magic, size = struct.unpack_from("<II", data)
        assert magic == 0x184D2A5D
        trained = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(data[8 : 8 + size]))
        text = zstandard.ZstdDecompressor(dict_data=trained).stream_reader(data, read_across_frames=True).read()
        records = text.split(b"WARC/1.1\r\n")[1:]
        count += len(records)
        whole += len(data) - size
        alone += sum(len(zstandard.compress(r, 3)) for r in records)
    assert count == len(rows)
    assert whole < alone * 0.8  # the dictionary pays


def test_a_frame_never_holds_the_separator():
    frames = iter([b"x" + warc.SEPARATOR + b"y", b"fine"])
    assert warc._clean(lambda level: next(frames)) == b"fine"


def test_many_splits_and_extra_columns(spark, tmp_path):
    rows = rows_of(400)
    wide = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, payload string, digest int")
    path = f"{tmp_path}/wide"
    warc.write(wide.repartition(2), path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        read = warc.read_archives(spark, path)
        assert read.rdd.getNumPartitions() > 3
        got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in read.collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted(got, key=str) == roles(rows)
