"""Phrase counts and cohesion against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from waycast.llm import phrases


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def brute_counts(rows, depth):
    f, n = Counter(), Counter()
    for text, lang in rows:
        for piece in re.split("[.,;:!?\n-\r]", lower(text or "")):
            words = re.findall("[^ \t]+", piece)
            n[lang or "und"] += len(words)
            for i in range(len(words)):
                for d in range(1, min(depth, len(words) - i) + 1):
                    f[lang or "und", tuple(words[i : i + d])] += 1
    return f, n


def brute(rows, depth=5, least=100, share=100, top=2000):
    f, n = brute_counts(rows, depth)
    found = {}
    for (lang, words), a in f.items():
        if len(words) < 2 or a < least:
            continue
        cuts = [(1000 * a * n[lang] // (f[lang, words[:k]] * f[lang, words[k:]]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        found[lang, words] = (a, f[lang, words[:k]], f[lang, words[k:]], n[lang], score)
    gone = set()
    for (lang, words), (a, *_) in found.items():
        for d in range(2, len(words)):
            for i in range(len(words) - d + 1):
                part = words[i : i + d]
                if 100 * a >= share * found[lang, part][0]:
                    gone.add((lang, part))
    out = []
    for lang in {lang for lang, _ in found}:
        rows_ = [(" ".join(w), *found[lang, w]) for of, w in found if of == lang and (lang, w) not in gone]
        rows_.sort(key=lambda r: (-r[5], -r[1], r[0].encode()))
        out += [(lang, i + 1, *r) for i, r in enumerate(rows_[:top])]
    return sorted(out)


def texts(seed, n=60, words=("a", "b", "the", "The", "ein", "\x01x", "a\x08", "a\x00", "ü", "-")):
    rng = random.Random(seed)
    joins = [" "] * 12 + ["  ", "\t", ". ", ",", "\n", "\x0b", " ? "]
    rows = []
    for _ in range(n):
        text = "".join(rng.choice(words) + rng.choice(joins) for _ in range(rng.randint(0, 60)))
        rows.append((text + " once more the same words " * rng.randint(0, 2), rng.choice(["en", "de", None])))
    return rows + [(None, "en"), ("", None), ("...", "de"), ("a " * 400, "en")]


@pytest.mark.parametrize(("least", "share", "budget", "part", "top"), [(5, 100, 1 << 16, 1 << 20, 2000), (3, 60, 20, 50, 7), (2, 100, 1, 500, 2000)])
def test_collocations_equal_brute_force(spark, monkeypatch, least, share, budget, part, top):
    monkeypatch.setattr(phrases, "PART", part)
    rows = texts(least)
    docs = spark.createDataFrame([(*r, 1) for r in rows], "text string, lang string, key int").repartition(3)
    counts = phrases.count(docs, min_count=least, budget=budget)
    got = sorted(tuple(r) for r in phrases.collocations(counts, share=share, top=top).collect())
    assert got == brute(rows, least=least, share=share, top=top)


def test_all_frequent_phrases_are_counted_once(spark, monkeypatch):
    monkeypatch.setattr(phrases, "SLOTS", 4)
    monkeypatch.setattr(phrases, "HELD", 50)
    monkeypatch.setattr(phrases, "WORD_BITS", 64)
    monkeypatch.setattr(phrases, "PAIR_BITS", 64)
    rows = texts(9)
    counts = phrases.count(spark.createDataFrame(rows, "text string, lang string").repartition(3), depth=4, min_count=3, budget=30)
    f, n = brute_counts(rows, 4)
    back = str.maketrans({chr(i): chr(i - 1) for i in range(1, 10)})
    got = [(r.lang, tuple(w.translate(back) for w in r.key.split("\0")), r.f) for r in counts.phrases.collect()]
    assert len(got) == len(set(got))
    assert set(got) == {(lang, words, a) for (lang, words), a in f.items() if a >= 3}
    assert {tuple(r) for r in counts.totals.collect()} == set(n.items())


def test_counts_past_64_bits(spark):
    phrase_rows = [("en", "x", 4 * 10**12), ("en", "y", 3 * 10**12), ("en", "x\0y", 2 * 10**12)]
    made = phrases.Counts(spark.createDataFrame(phrase_rows, "lang string, key string, f long"), spark.createDataFrame([("en", 9 * 10**13)], "lang string, n long"), 5)
    (row,) = phrases.collocations(made).collect()
    assert row.score == 1000 * 2 * 10**12 * 9 * 10**13 // (12 * 10**24)


def test_groups_fit_the_budget():
    sizes = np.array([1 + s * 37 % 50 for s in range(200)])
    group = phrases._packed(sizes, 60)
    totals = np.bincount(group, sizes)
    assert totals.max() <= 60
    assert len(totals) < 1.3 * sizes.sum() / 60


def test_nothing_to_do(spark):
    assert phrases.collocations(phrases.count(spark.createDataFrame([], "text string, lang string"))).collect() == []


def test_only_suffixes_with_a_frequent_triple_are_sent(spark, monkeypatch):
    sent, leaves = [], phrases._leaves
    monkeypatch.setattr(phrases, "_leaves", lambda *a: sent.append(leaves(*a)) or sent[-1])
    rng = random.Random(4)
    rows = [(" ".join(rng.choice(["ab", "cd", "ef", "gh", "ij", "kl"]) for _ in range(20)), "en") for _ in range(100)] + [("one two three", "en")] * 40
    counts = phrases.count(spark.createDataFrame(rows, "text string, lang string").repartition(3), min_count=30)
    f, _ = brute_counts(rows, 5)
    assert {(r.lang, tuple(r.key.split("\0"))): r.f for r in counts.phrases.collect()} == {k: a for k, a in f.items() if a >= 30}
    assert {bytes(r.key) for r in sent[0].collect()} == {b"one\0two\0three"}
    assert sum(len(w) == 2 and a >= 30 for (_, w), a in f.items()) > 30


def test_words_alone(spark):
    counts = phrases.count(spark.createDataFrame([("a b a b", "en")], "text string, lang string"), depth=1, min_count=2)
    assert {(r.lang, r.key, r.f) for r in counts.phrases.collect()} == {("en", "a", 2), ("en", "b", 2)}
