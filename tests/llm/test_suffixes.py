"""Removal of repeated byte strings against a table of all strings of that length."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from waycast.llm import suffix_dedup
from waycast.llm.catalog import CATALOG
from waycast.llm.common import read


def plain(rows):
    n = suffix_dedup.LENGTH
    data = [(t or "").encode() for _, t in rows]
    seen = Counter(d[i : i + n] for d in data for i in range(len(d) - n + 1))
    out = []
    for (doc, _), d in zip(rows, data, strict=True):
        gone = bytearray(len(d))
        for i in range(len(d) - n + 1):
            if seen[d[i : i + n]] > 1:
                gone[i : i + n] = b"\1" * n
        spans = sum(gone[i] and not (i and gone[i - 1]) for i in range(len(d)))
        kept = bytes(c for c, g in zip(d, gone, strict=True) if not g)
        out.append((str(doc), len(d), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def got_of(df):
    return sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect())


def cases():
    rng = random.Random(9)
    text = lambda n: "".join(rng.choice("abcdefgh é") for _ in range(n))
    passage, edge, short = text(900), text(400), text(350)
    rows = [(1, None), (2, ""), (3, "x"), (4, passage), (5, passage), (5, passage), (None, text(500)), (6, "q" * 3000)]
    rows += [(10 + i, text(rng.randint(0, 700)) + passage[i * 13 : 900 - i * 17] + text(rng.randint(0, 700))) for i in range(25)]
    rows += [(50 + i, text(60) + edge + text(60)) for i in range(3)] + [(60 + i, text(200) + short + text(200)) for i in range(30)]
    rows += [(100, text(300) + edge[:399] + "!"), (101, passage + text(50) + passage), (102, "ab" * 600), (103, text(30000))]
    rows += [(300 + i, text(100 + i) + "xyz pq " * (50 + 4 * i) + text(150)) for i in range(8)] + [(320, "yz pq x" * 70), (321, text(450) + "r" * 390)]
    words = text(5000)
    for i in range(20):
        at = rng.randrange(4000)
        words = words[:at] + "Z" + words[at + 1 :]
        rows.append((200 + i, words))
    return rows


@pytest.mark.parametrize("batch", [4 << 20, 3000])
def test_odd_documents(spark, batch, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BATCH", batch)
    rows = cases()
    docs = spark.createDataFrame([(*r, b"k") for r in rows], "doc_id long, text string, kept binary").repartition(4)
    assert got_of(suffix_dedup.remove(docs, digest=True)) == plain(rows)


def test_query(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in read(spark, sf_dir, "documents").collect()]
    got = got_of(CATALOG["op10_suffix_dedup"](spark, sf_dir))
    assert got == plain(rows) and any(g[2] for g in got)


def test_spans_and_kept_bytes(spark):
    rows = cases()[8:20]
    for r in suffix_dedup.remove(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        data = dict(rows)[r.doc_id].encode()
        left = bytearray(data)
        for s in reversed(r.spans):
            del left[s.start : s.end]
        assert bytes(left) == bytes(r.kept) and len(r.spans) == r.n_spans
    assert suffix_dedup.remove(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_factors_are_longest_previous_factors():
    rng = np.random.default_rng(1)
    part = rng.integers(0, 4, 700).astype(np.uint8)
    raw = np.concatenate([rng.integers(0, 4, 300).astype(np.uint8), part, rng.integers(0, 4, 90).astype(np.uint8), part])
    data, n = raw.tobytes(), suffix_dedup.LENGTH
    windows = np.arange(len(raw) - n + 1)
    earlier, later = suffix_dedup.factors(raw, windows)
    strings = [data[i : i + n] for i in windows.tolist()]
    assert earlier.tolist() == [s in strings[:i] for i, s in enumerate(strings)]
    assert later.tolist() == [s in strings[i + 1 :] for i, s in enumerate(strings)]
