"""Spelling variants against brute force over all pairs of words."""

import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from waycast.llm import spelling


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(words, ratio=5):
    near = {w: sorted((-words[o], o) for o in words if one_edit(w, o)) for w in words}
    form = {w: o[0][1] if o and -o[0][0] >= ratio * words[w] else None for w, o in near.items()}

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return {(w, form[w], root(w), n, len(near[w]), words[form[w]] if form[w] else None) for w, n in words.items()}


def table(spark, words):
    return spark.createDataFrame(list(words.items()), "word string, n long").coalesce(2)


def test_variants_equal_brute_force(spark):
    import random

    rng = random.Random(4)
    stems = ["".join(rng.choice("aabcé") for _ in range(rng.randint(1, 7))) for _ in range(150)]
    words = {w: rng.choice([1, 1, 2, 7, 40, 300]) for w in stems}
    words |= {"z" * n: n for n in range(1, 9)} | {"q" * 3000: 9, "q" * 2999 + "p": 60, "q" * 3001: 400, "x" * 50 + "y" * 50: 1, "x" * 49 + "y" * 50: 30}
    got = {tuple(r) for r in spelling.variants(table(spark, words)).collect()}
    assert got == brute(words)


def test_crowded_nodes_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(spelling, "CROWD", 3)
    words = {"prefix" + a + b: 1 + (a == b) * 9 for a in "abcde" for b in "abcde"} | {"prefix": 100}
    got = {tuple(r) for r in spelling.variants(table(spark, words)).collect()}
    assert got == brute(words)
    edges = spelling.trie(table(spark, words))
    assert edges.where("salt > 0").count() > 0


@settings(max_examples=5, deadline=None)
@given(st.dictionaries(st.text("abÿ", min_size=1, max_size=5), st.integers(1, 50), max_size=30))
def test_any_words(spark, words):
    got = {tuple(r) for r in spelling.variants(table(spark, words)).collect()}
    assert got == brute(words)


@pytest.mark.parametrize("slip", [None, 3])
def test_words_are_counted_whole(spark, slip, monkeypatch):
    monkeypatch.setattr(spelling, "PART", 40)
    texts = [None, "", "ABCÀbc×abc÷ÉÉÉÉÉÉ and abcdefg-ABCDEFG", "abcdefg " * 30 + "q" * 500, "abcdefg\nabcdefg", "kurz"]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(None, "abcdefg", "x"), (2, "abcdefg", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n string").coalesce(2)
    expected = Counter()
    letters = {chr(c) for c in [*range(97, 123), *range(0xC0, 0x100)]}
    for doc_id, text, _ in rows:
        low = "".join(c.lower() if c.isascii() else c for c in text or "")
        for run in "".join(c if c in letters else " " for c in low).split():
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if slip and h % slip == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            expected[run] += 1
    got = {r["word"]: r["n"] for r in spelling.counted(docs, 6, 2, slip).collect()}
    assert got == {w: n for w, n in expected.items() if len(w) >= 6 and n >= 2}


def test_nothing_to_do(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.variants(spelling.counted(empty)).collect() == []
