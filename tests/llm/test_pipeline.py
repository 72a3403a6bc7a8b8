"""Decontamination against brute force, and the pipeline stage by stage."""

import hashlib
import os
import random
import subprocess
import sys
from collections import defaultdict
from pathlib import Path

import corpus_pipeline
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import __spark_entry__
from waycast.llm import decontaminate, simhash, toxicity
from waycast.llm.catalog import CATALOG
from waycast.llm.common import read


def plain_distance(item, run):
    """Smallest edit distance of the item to any run of ``run``."""
    row = list(range(len(item) + 1))
    best = row[-1]
    for w in run:
        above, row = row, [0]
        for i, x in enumerate(item):
            row.append(min(above[i] + (w != x), above[i + 1] + 1, row[i] + 1))
        best = min(best, row[-1])
    return best


def plain_leaks(docs, items):
    out = {}
    words = lambda t: (t or "").encode().lower().split()
    for d, t in docs:
        run = words(t)
        for i, x in items:
            item = words(x)
            if item and len(set(run) & set(item)) >= 0.5 * len(set(item)):
                best = plain_distance(item, run)
                if best <= len(item) // 5:
                    out[d, i] = min(best, out.get((d, i), best))
    return out


def edited(rng, words, k):
    words = list(words)
    for _ in range(k):
        at = rng.randrange(len(words))
        kind = rng.randrange(3)
        if kind == 0:
            words[at] = f"w{rng.randrange(10**6)}"
        elif kind == 1:
            words.insert(at, f"w{rng.randrange(10**6)}")
        else:
            del words[at]
    return words


def test_distance():
    rng = random.Random(1)
    for _ in range(300):
        item = [b"%d" % rng.randrange(6) for _ in range(rng.randint(1, 40))]
        run = [b"%d" % rng.randrange(6) for _ in range(rng.randint(0, 60))]
        assert decontaminate.distance(item, run)[0] == plain_distance(item, run)


def test_planted_leaks(spark, sf_dir):
    rng = random.Random(8)
    items = [(r.item_id, r.text) for r in read(spark, sf_dir, "benchmark").collect()]
    items += [(900, None), (901, ""), (902, "four words only here"), (903, items[0][1]), (902, "Some other text with the same id")]
    body = [t.split(" ") for t in (r.text for r in read(spark, sf_dir, "documents").collect()) if len(t) > 400]
    docs, n = [(None, None), (1, ""), (2, " \n"), (3, "Four WORDS only\there"), (4, items[1][1]), (4, items[1][1]), (None, items[2][1])], 100
    for _, text in items[:40]:
        for share in (0, 0.05, 0.1, 0.15, 0.2, 0.3):
            words = text.split()
            words = edited(rng, words, int(share * len(words)))
            around = rng.choice(body)
            cut = rng.randrange(len(around))
            docs.append((n, " ".join(around[:cut] + words + around[cut:])))
            n += 1
    docs.append((n, "long " * 50_000 + items[3][1]))
    rows = spark.createDataFrame([(*d, 0.5) for d in docs], "doc_id long, text string, similarity double").repartition(4)
    table = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, key string")
    got = {(r.doc_id, r.item_id): r.distance for r in decontaminate.leaks(rows, table).collect()}
    want = plain_leaks(docs, items)
    assert set(got) <= set(want) and all(got[x] >= want[x] for x in got)
    assert len(got) >= 0.97 * len(want) and all(x in got for x, d in want.items() if d <= 2)
    left = {r.doc_id for r in decontaminate.clean(rows, table).collect()}
    assert left == {d for d, _ in docs} - {d for d, _ in got}


@pytest.mark.parametrize("m", [1, 3, 15, 60, 250, 500, 1000])
def test_recall_at_the_limit(m):
    """Of items with as many mixed edits as the limit allows, keys find 95 of 100 or more, whatever their length."""
    rng, n = random.Random(m), 60
    vocabulary, weights = [rng.getrandbits(64) for _ in range(5000)], [1 / (i + 3) for i in range(5000)]
    plan, met = decontaminate.Plan(1, 1000), 0
    c = plan.class_of(m)
    for _ in range(n):
        item = rng.choices(vocabulary, weights, k=m)
        around = rng.choices(vocabulary, k=40 + m)
        run = [w if isinstance(w, int) else rng.getrandbits(64) for w in edited(rng, item, m // 5)]
        text = np.array(around[:20] + run + around[20:], np.uint64)
        own = plan.keys(np.array(item, np.uint64), np.zeros(1, np.int64), c)
        met += bool(np.isin(plan.keys(text, np.arange(10, 32), c), own).any())
    assert met >= 0.95 * n


def test_words_are_those_of_split():
    texts = [None, "", " a\tB\nc\x0bd\x0ce\rf  ", "Ünï\x00x \x1cy\u2003z", "A" * 300]
    made = decontaminate.Words(pa.array(texts))
    own = [decontaminate.words_of(t or "") for t in texts]
    flat = [w for ws in own for w in ws]
    assert made.hashes.tolist() == [decontaminate.word_hash(w) for w in flat]
    assert made.ends.tolist() == np.cumsum([len(ws) for ws in own]).tolist()
    assert made.run(0, len(flat)) == b" ".join(flat)


def test_functions_travel_to_workers_without_the_package(tmp_path, sf_dir):
    """A session whose workers start elsewhere and have no path to the package."""
    root = Path(__file__).resolve().parents[2]
    code = f"""
import sys
sys.path.insert(0, {str(root)!r})
from waycast.session import build_session
spark = build_session(cores=2, shuffle_partitions=2)
sys.path.remove({str(root)!r})
from pyspark.sql.functions import udf
import __main__
def there(_):
    try:
        import waycast.session
        return 1
    except ImportError:
        return 0
sys.path.insert(0, {str(root)!r})
assert spark.range(1).select(udf(there, "int")("id")).first()[0] == 0
from waycast.llm.catalog import CATALOG
for name in ("op2_decontaminate", "op3_toxicity", "op11_phrases", "op12_warc"):
    CATALOG[name](spark, {sf_dir!r}).collect()
print("all ran")
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "all ran" in done.stdout, done.stderr[-3000:]


def test_empty_tables(spark, sf_dir):
    docs, items = read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")
    assert decontaminate.leaks(docs, items.limit(0)).count() == 0 and decontaminate.leaks(docs.limit(0), items).count() == 0


def test_leak_query(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in read(spark, sf_dir, "documents").collect()]
    items = [(r.item_id, r.text) for r in read(spark, sf_dir, "benchmark").collect()]
    got = {(r.doc_id, r.item_id): r.distance for r in CATALOG["op2_decontaminate"](spark, sf_dir).collect()}
    assert got == plain_leaks(docs, items) and got


def plain_lines(docs):
    key = lambda x: "".join(c.lower() if c.isascii() else c for c in x.strip(" \t\n\r\x0b\x0c"))
    held = defaultdict(set)
    for d, t in docs:
        for x in t.split("\n"):
            held[key(x)].add(d)
    stays = lambda d, k: len(k) < 20 or len(held[k]) < 3 or d == max(held[k])
    return [(d, "\n".join(x for x in t.split("\n") if stays(d, key(x)))) for d, t in docs]


def plain_copies(docs):
    """Smallest id of each group of documents linked by a five-word Jaccard similarity of 0.8."""
    parts = {d: set(simhash.shingles(simhash.words_of(t), 5)) for d, t in docs}
    root = {d: d for d, _ in docs}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for d in parts:
        for e in parts:
            if e < d and len(parts[d] & parts[e]) >= 0.8 * len(parts[d] | parts[e]):
                a, b = find(d), find(e)
                root[max(a, b)] = min(a, b)
    return {d for d in root if find(d) == d}


def test_stages_equal_plain_versions(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    labels, items = read(spark, sf_dir, "labels"), [(r.item_id, r.text) for r in read(spark, sf_dir, "benchmark").collect()]
    rows = {r.doc_id: r for r in docs.collect()}
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "line_dedup", "near_dedup", "decontaminate", "encode"]
    toxic = {r.doc_id for r in toxicity.score(docs, toxicity.fit(docs, labels)).where("predicted = 1").collect()}
    one = corpus_pipeline.toxic_out(spark, docs, sf_dir)
    assert one.columns == docs.columns
    left = sorted((r.doc_id, r.text) for r in one.collect())
    assert [d for d, _ in left] == sorted(set(rows) - toxic) and toxic
    two = corpus_pipeline.lines_out(spark, one, sf_dir)
    assert two.columns == docs.columns and two.dtypes == docs.dtypes
    lined = sorted((r.doc_id, r.text, r.n_chars) for r in two.collect())
    want = plain_lines(left)
    assert [x[:2] for x in lined] == want and all(n == len(t) for _, t, n in lined)
    three = corpus_pipeline.copies_out(spark, two, sf_dir)
    kept = {r.doc_id for r in three.collect()}
    exact = plain_copies(want)
    assert len(kept - exact) <= 0.1 * (len(want) - len(exact)) and len(exact - kept) <= 0.02 * len(exact)
    four = corpus_pipeline.leaks_out(spark, three, sf_dir)
    text = dict(want)
    gone = {d for d, _ in plain_leaks([(d, text[d]) for d in kept], items)}
    assert {r.doc_id for r in four.collect()} == kept - gone and four.columns == docs.columns
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    last = corpus_pipeline.encoded(spark, four, sf_dir).collect()
    assert {r.doc_id for r in last} == kept - gone
    for r in last:
        ids = tokenizer.encode(text[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and bytes(r.ids) == b"".join(i.to_bytes(4, "little") for i in ids)
        assert r.decoded_sha256 == hashlib.sha256(text[r.doc_id].encode()).hexdigest()


@pytest.mark.parametrize("empty", [False, True])
def test_stages_take_odd_documents(spark, sf_dir, empty):
    same = "the quick brown fox jumps over the lazy dog near the river bank today"
    rows = [(None, None, 1, None), (None, "", 2, "x"), (1, same, 3, None), (1, same, 3, None), (2, same, 4, "y"), (3, "z " * 50_000, 5, None)]
    docs = spark.createDataFrame(rows[: 0 if empty else None], "doc_id long, text string, n_tokens long, predicted string")
    docs = docs.withColumn("kept", docs["predicted"]).withColumn("node", docs["n_tokens"])
    for name, stage in corpus_pipeline.STAGES:
        done = stage(spark, docs, sf_dir)
        if name != "encode":
            assert done.columns == docs.columns
            docs = done
    got = done.collect()
    assert (not got) == empty
    assert not empty or "ids" in done.columns
    assert empty or {r.doc_id for r in got} == {None, 1, 3}


def test_pipeline_is_registered(spark, sf_dir):
    queries = __spark_entry__.queries()
    assert [n for i in range(1, 11) for n in queries if n.startswith(f"op{i}_")].__len__() == 10
    assert queries["pipeline"](spark, sf_dir).count() > 0
