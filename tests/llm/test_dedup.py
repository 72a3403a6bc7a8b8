"""SimHash classes and reversible line dedup against brute force."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from near_pairs import KINDS, pairs, similarity

from waycast.llm import components, line_dedup, simhash
from waycast.llm.catalog import CATALOG
from waycast.llm.common import read

ODD = [
    (1, None), (2, ""), (3, " \t\n "), (4, "one"), (4, "one"), (5, "one two three"), (6, "ONE Two three"),
    (None, "one two three"), (None, None), (7, "É x é " * 4000), (8, "É x é " * 4000),
]


def smallest(pairs, nodes):
    nodes = list(nodes)
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def plain_print(text):
    words = (text or "").encode().lower().split()
    parts = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_classes(rows):
    prints = [plain_print(t) for _, t in rows]
    distinct = np.array(sorted(set(prints)), np.uint64)
    pairs = [(int(a), int(b)) for a in distinct for b in distinct[np.bitwise_count(distinct ^ a) <= 3]]
    root = smallest(pairs, map(int, distinct))
    least = defaultdict(list)
    for (d, _), p in zip(rows, prints, strict=True):
        least[root[p]] += [] if d is None else [d]
    return sorted((str(d), f"{p:016x}", str(min(least[root[p]], default=None))) for (d, _), p in zip(rows, prints, strict=True))


def test_odd_documents(spark):
    docs = spark.createDataFrame([(*r, "x") for r in ODD], "doc_id long, text string, fp string")
    got = sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in simhash.classes(docs).collect())
    assert got == plain_classes(ODD)


def test_classes_query(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in read(spark, sf_dir, "documents").collect()]
    got = sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in CATALOG["op9_simhash"](spark, sf_dir).collect())
    assert got == plain_classes(rows)


def test_every_close_pair_is_linked(spark):
    rng = random.Random(5)
    fps = set()
    for _ in range(60):
        base = rng.getrandbits(64)
        fps.add(base)
        for _ in range(12):
            base ^= sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3)))
            fps.add(base)
    rows = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    got = {r.node: r.root for r in components.components(simhash.links(rows)).collect()}
    signed = np.array([r.fp for r in rows.collect()])
    near = np.bitwise_count((signed[:, None] ^ signed[None, :]).view(np.uint64)) <= 3
    want = smallest([(int(signed[i]), int(signed[j])) for i, j in zip(*np.nonzero(near), strict=True)], signed.tolist())
    assert all(got.get(n, n) == r for n, r in want.items())


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 30)] + [(7, 100), (200, 100)]])
def test_components(spark, edges):
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = {n for a, b in edges if a != b for n in (a, b)}
    assert got == smallest([e for e in edges if e[0] != e[1]], nodes)


def test_duplicates_by_shingles(spark, sf_dir):
    rng = random.Random(3)
    rows = [(r.doc_id, r.text) for r in read(spark, sf_dir, "documents").limit(80).collect() if len(r.text.split()) > 150]
    rows = [(d, t) for d, t in rows if t in {x for _, x in rows}]
    start = len(simhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    planted = []
    for i, (_, t) in enumerate(rows):
        words = t.split(" ")
        for at in rng.sample(range(len(words)), max(1, len(words) // 100)):
            words[at] = f"new{at}"
        planted.append((10_000 + i, " ".join(words)))
    docs = spark.createDataFrame([*rows, *planted, (20_000, rows[0][1])], "doc_id long, text string")
    left = {r.doc_id for r in simhash.one_of_each(docs).collect()}
    assert 20_000 not in left
    caught = sum(d not in left for d, _ in planted)
    assert caught >= 0.9 * len(planted) and sum(d < 10_000 for d in left) >= 0.9 * start


@pytest.mark.parametrize("kind", KINDS)
def test_near_pairs_of_any_edit_share_a_part(spark, kind):
    texts = [r.text for r in read(spark, "/root/testdata/sf0.1", "documents").limit(2000).collect() if r.text and 150 <= len(r.text.split()) <= 800]
    parts = lambda t: simhash._parts(simhash._shingle_hashes(simhash.words_of(t)))
    for low, high in ((0.80, 0.83), (0.83, 0.87), (0.87, 0.92)):
        met = [(parts(a) == parts(b)).any() for a, b in pairs(texts, kind, low, high, 150)]
        assert np.mean(met) >= 0.97, (low, np.mean(met))


def test_duplicates_are_decided_by_exact_similarity(spark, monkeypatch):
    texts = [r.text for r in read(spark, "/root/testdata/sf0.1", "documents").limit(2000).collect() if r.text and 150 <= len(r.text.split()) <= 300]
    rows, want = [], []
    for kind in KINDS:
        for low, high in ((0.70, 0.75), (0.75, 0.80), (0.80, 0.85)):
            for a, b in pairs(texts, kind, low, high, 12, seed=len(rows)):
                n = len(rows)
                # words of their own, so that pairs of one text do not meet
                rows += [(n, " ".join(f"{w}{n}" for w in a.split())), (n + 1, " ".join(f"{w}{n}" for w in b.split()))]
                want.append((n, similarity(rows[n][1], rows[n + 1][1]) >= 0.8))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.least for r in simhash.duplicates(docs).collect()}
    assert all(got[n] == n for n, _ in want)
    assert not any(got[n + 1] == n for n, near in want if not near)
    assert np.mean([got[n + 1] == n for n, near in want if near]) >= 0.97

    words = [f"w{i}" for i in range(300)]
    chain = [(i, " ".join(words[5 * i : 5 * i + 200])) for i in range(20)] + [(100 + i, " ".join(words[5 * i : 5 * i + 200]) + " more") for i in range(20)]
    chain = spark.createDataFrame(chain, "doc_id long, text string")
    whole = sorted(map(tuple, simhash.duplicates(chain).collect()))
    assert {least for _, least in whole} == {0}
    monkeypatch.setattr(simhash, "BLOCK_BYTES", 8_000)
    assert sorted(map(tuple, simhash.duplicates(chain).collect())) == whole


def plain_lines(rows, min_docs=3, min_chars=20):
    strip = " \t\n\r\x0b\x0c"
    key = lambda x: "".join(c.lower() if c.isascii() else c for c in x.strip(strip))
    holders = defaultdict(set)
    for d, t in rows:
        for x in (t or "").split("\n"):
            holders[key(x)].add(d)
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        keep = []
        for x in lines:
            k = key(x)
            last = max((h for h in holders[k] if h is not None), default=None)
            if len(k) < min_chars or len(holders[k]) < min_docs or d == last:
                keep.append(x)
        out.append((str(d), len(lines), len(lines) - len(keep), hashlib.sha256("\n".join(keep).encode()).hexdigest()))
    return sorted(out)


LONG = "A line that is long enough"
LINES = [
    (1, f"{LONG}\nshort\n  {LONG.upper()}\x0b"), (2, f"x\n\t{LONG} "), (3, LONG), (3, LONG), (4, f"{LONG}\n{LONG}"), (None, LONG),
    (5, None), (6, ""), (7, "\n\n"), (8, "É" * 19), (9, "É" * 19), (10, "É" * 19), (11, "é" * 20), (12, "é" * 20),
    (13, "é" * 20 + "\n" + "É" * 20), (14, f"{LONG} "), (15, f"{LONG} "), (16, "y" * 100_000),
]


def digests(index, docs):
    return sorted((str(r.doc_id), r.n_lines, r.n_dropped, r.kept_sha256) for r in line_dedup.kept(index, docs, digest=True).collect())


def test_lines_of_odd_documents(spark):
    docs = spark.createDataFrame([(*r, b"k") for r in LINES], "doc_id long, text string, keys binary")
    assert digests(line_dedup.build(docs), docs) == plain_lines(LINES)
    none = docs.limit(0)
    assert line_dedup.kept(line_dedup.build(none), none).count() == 0


def test_lines_query(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in read(spark, sf_dir, "documents").collect()]
    got = sorted((str(r.doc_id), r.n_lines, r.n_dropped, r.kept_sha256) for r in CATALOG["op7_line_dedup"](spark, sf_dir).collect())
    assert got == plain_lines(rows)
    assert any(g[2] for g in got)


def test_insert_and_delete_are_reversible(spark):
    schema = "doc_id long, text string"
    first, more = spark.createDataFrame(LINES[:6], schema), spark.createDataFrame(LINES[6:], schema)
    index = line_dedup.insert(line_dedup.build(first), more)
    both = spark.createDataFrame(LINES, schema)
    assert digests(index, both) == plain_lines(LINES)
    back = line_dedup.delete(index, more.select("doc_id"))
    assert digests(back, first) == plain_lines(LINES[:6])
    fewer = line_dedup.delete(index, spark.createDataFrame([(4,), (2,), (None,)], "doc_id long"))
    left = [r for r in LINES if r[0] not in (4, 2, None)]
    assert digests(fewer, spark.createDataFrame(left, schema)) == plain_lines(left)


def test_cuckoo():
    keys = [hashlib.md5(str(i).encode()).digest() for i in range(6000)]
    held = line_dedup.Cuckoo.of(keys[:3000])
    rows = np.frombuffer(b"".join(keys), np.uint8).reshape(-1, 16)
    assert held.contains(rows[:3000]).all() and held.contains(rows[3000:]).mean() < 0.01
    for k in keys[:1500]:
        held.delete(k)
    again = line_dedup.Cuckoo.from_bytes(held.to_bytes())
    assert again.contains(rows[1500:3000]).all() and again.contains(rows[:1500]).mean() < 0.01
