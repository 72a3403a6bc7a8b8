"""Benchmark decontamination: CGK embedding, bit-sampling LSH, exact edit distance.

A document leaks an item if some run of its words has an edit distance (in words)
to the item of at most a fifth of the item's words.  Words are what lies between
ASCII white space, A-Z in lower case.

* CGK embedding: a walk over a window repeats or advances a word at every step, by a
  random bit of the step and the word.  Windows at a small edit distance come into
  step again, so their walks agree at most steps: edit distance becomes Hamming
  distance.
* LSH: each of ``TABLES`` keys is the words at ``SAMPLES`` random steps of one of
  ``WALKS`` independent walks, among its first ``REACH`` steps: further on, the walks
  of two texts have lost step.  Windows have the sizes of the items, in classes a
  quarter apart; an item is filed under the largest class it fills.  Items of fewer than
  five words have a class for each length, whose one key is all words.
* Windows of documents meet items in a join on the key; each meeting is verified by
  the edit distance between the item and the best run inside the window's
  surroundings, so nothing wrong is reported.

At the limit of a fifth, 60 items each of 15 to 1,000 words with mixed edits are all found
(test: 0.95 or more of each size).

Two filters keep the walk off places where no item can be, without loss.  With k
edits among m words, some ``q = floor((m - k) / (k + 1))`` words in a row are
untouched, and as one edit changes q rows of q words at most, ``m - q + 1 - k q`` such
rows are; a window with fewer rows that any item has is not walked.  Each class has its
own lengths, so short items let no more windows of long ones pass.  And a key that no item
has is not sent.  Both are bit maps of a fixed size, built by ``bitmap`` aggregates,
whatever the number of items; more items than fit only let more windows pass.

Defined cases: null and empty texts or items have no words and take no part; items
below five words must occur unchanged; rows with equal ids count as one document,
a null id as one as well; items with equal ids and other texts are items each, and
the best match counts; extra columns are not read; empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waycast.llm.common import slices, texts

LIMIT, STEP = 5, 1.25  # one edit in five words; ratio of the window classes
WALKS, TABLES, SAMPLES, REACH = 6, 36, 2, 100
GATE_BITS, KEY_BITS = 1 << 22, 1 << 25
_BUCKET = 32768  # bits of one bitmap of the aggregates

_MIX = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str) -> list[bytes]:
    return text.encode().lower().split()


def _scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _rows(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hash of the ``length`` words from each place."""
    n = max(0, len(hashes) - length + 1)
    h = np.zeros(n, np.uint64)
    for i in range(length):
        h = _scramble(h * _MIX + hashes[i : i + n])
    return h


def word_hash(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word, 5)


class Plan:
    """Window classes and sampled steps for items of ``least`` to ``most`` words."""

    def __init__(self, least: int, most: int):
        self.sizes = list(range(least, min(LIMIT, most + 1))) or [least]
        if most >= LIMIT > self.sizes[-1]:
            self.sizes.append(LIMIT)
        while self.sizes[-1] >= LIMIT and self.sizes[-1] * STEP + 1 <= most:
            self.sizes.append(int(np.ceil(self.sizes[-1] * STEP)))
        rng = np.random.default_rng(3)
        reach = [max(SAMPLES, min(int(1.5 * c), REACH)) for c in self.sizes]
        self.steps = [np.stack([rng.choice(r, SAMPLES, replace=False) for _ in range(TABLES)]) for r in reach]

    def class_of(self, m: int) -> int:
        return int(np.searchsorted(self.sizes, m, "right")) - 1

    def keys(self, hashes: np.ndarray, starts: np.ndarray, c: int) -> np.ndarray:
        """Keys of the windows of class ``c`` at ``starts``: windows x tables, or windows x 1 for less than five words."""
        padded = np.r_[hashes, np.zeros(1, np.uint64)]
        if self.sizes[c] < LIMIT:
            h = np.full(len(starts), c * TABLES + 1, np.uint64)
            for i in range(self.sizes[c]):
                h = _scramble(h * _MIX + padded[np.minimum(starts + i, len(hashes))])
            return h[:, None]
        out = np.zeros((len(starts), TABLES), np.uint64)
        for walk in range(WALKS):
            tables = range(walk, TABLES, WALKS)
            wanted = {int(s) for t in tables for s in self.steps[c][t]}
            at, seen = starts.copy(), {}
            for step in range(max(wanted) + 1):
                word = padded[at]
                if step in wanted:
                    seen[step] = word
                odd = np.uint64(((walk * 1_000_003 + step) * 2 + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
                at = np.minimum(at + (_scramble(word * odd) >> np.uint64(63)).astype(np.int64), len(hashes))
            for t in tables:
                h = np.full(len(starts), c * TABLES + t + 1, np.uint64)
                for s in sorted(self.steps[c][t].tolist()):
                    h = _scramble(h * _MIX + seen[s])
                out[:, t] = h
        return out


class Words:
    """The words of some texts, lower-cased and hashed, each distinct one once."""

    def __init__(self, column: pa.Array):
        parts = [t or b"" for t in column.cast(pa.binary()).to_pylist()]
        self.raw = np.frombuffer(b"\n".join([*parts, b""]).lower(), np.uint8)
        inside = ~_SPACE[self.raw]
        edges = np.flatnonzero(np.diff(inside.view(np.int8), prepend=np.int8(0)))  # the last byte is a space
        self.first, self.end = edges[::2], edges[1::2]
        text = np.searchsorted(np.cumsum([len(t) + 1 for t in parts]), self.first, "right")
        self.ends = np.cumsum(np.bincount(text, minlength=len(parts)))
        offsets = np.r_[0, np.cumsum(self.end - self.first)].astype(np.int32)
        buffers = [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(self.raw[inside].tobytes())]
        coded = pa.BinaryArray.from_buffers(pa.binary(), len(self.first), buffers).dictionary_encode()
        values = np.fromiter(map(word_hash, coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary))
        self.hashes = values[np.asarray(coded.indices)]

    def run(self, a: int, b: int) -> bytes:
        return b" ".join(self.raw[i:j].tobytes() for i, j in zip(self.first[a:b].tolist(), self.end[a:b].tolist(), strict=True))


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def distance(item: list[bytes], run: list[bytes]) -> tuple[int, int]:
    """Smallest edit distance between the item and any run inside ``run``, and where that run ends.

    Bit-parallel dynamic programming: one bit per word of the item.
    """
    m = len(item)
    masks: dict[bytes, int] = {}
    for i, w in enumerate(item):
        masks[w] = masks.get(w, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score = full, 0, m
    best, end = m, 0
    for j, w in enumerate(run):
        eq = masks.get(w, 0)
        diagonal = ((((eq & up) + up) ^ up) | eq | down) & full
        plus, minus = (down | ~(diagonal | up)) & full, up & diagonal
        score += bool(plus & top) - bool(minus & top)
        plus, minus = plus << 1 & full, minus << 1 & full
        up, down = (minus | ~(diagonal | plus)) & full, plus & diagonal
        if score < best:
            best, end = score, j + 1
    return best, end


def _bits(values: DataFrame, column: str, size: int) -> np.ndarray:
    """A bit map of ``size`` bits of the hashes in ``column``: at most ``size / 8`` bytes come to the driver."""
    at = F.pmod(F.col(column), F.lit(size))
    rows = values.select((at / _BUCKET).cast("int").alias("b"), (at % _BUCKET).alias("i")).groupBy("b").agg(F.bitmap_construct_agg("i").alias("bits"))
    out = np.zeros((size // _BUCKET, _BUCKET // 8), np.uint8)
    for r in rows.collect():
        out[r.b] = np.frombuffer(r.bits, np.uint8)
    return out.ravel()


def _has(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = (hashes.view(np.int64) % (len(bits) * 8)).astype(np.int64)
    return bits[at >> 3] >> (at & 7).astype(np.uint8) & 1 == 1


def _items(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """(item_id, words as one string, m) of items that have words."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [words_of(t) for t in texts(batch.column("text"))]
            at = pa.array([i for i, w in enumerate(own) if w], pa.int64())
            joined = pa.array([b" ".join(own[i]) for i in at.to_pylist()], pa.binary())
            counts = pa.array([len(own[i]) for i in at.to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("item_id").take(at), joined, counts], names=["item_id", "item", "m"])

    rows = items.select(F.col(item_id).cast("long").alias("item_id"), F.col(text).alias("text"))
    return rows.mapInArrow(work, "item_id long, item binary, m long")


def _classes(known: DataFrame, plan: Plan) -> dict[int, tuple[int, int, int]]:
    """By class: length of its rows, how many of them stay in any item within the limit, and its longest item."""
    sizes = F.array(*map(F.lit, plan.sizes))
    known = known.select("m", (F.size(F.filter(sizes, lambda x: x <= F.col("m"))) - 1).alias("c"), F.floor(F.col("m") / LIMIT).alias("k"))
    row = F.min(F.floor((F.col("m") - F.col("k")) / (F.col("k") + 1))).alias("row")
    by_class = known.groupBy("c").agg(row, F.max("m").alias("most"))
    rows = F.min(F.col("m") - F.col("row") + 1 - F.col("k") * F.col("row")).alias("rows")
    found = known.join(F.broadcast(by_class), "c").groupBy("c", "row", "most").agg(rows).collect()
    return {r["c"]: (r["row"], max(1, r["rows"]), r["most"]) for r in sorted(found)}


def leaks(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(``doc_id``, ``item_id``, ``distance``, ``n_words``, ``similarity``): each document with each item it leaks."""
    known = _items(items, item_id, item_text)
    bounds = known.agg(F.min("m").alias("least"), F.max("m").alias("most")).first()
    if bounds["least"] is None:
        return docs.sparkSession.createDataFrame([], "doc_id long, item_id long, distance int, n_words int, similarity double")
    plan = Plan(bounds["least"], bounds["most"])
    classes = _classes(known, plan)

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, item in zip(batch.column("item_id").to_pylist(), batch.column("item").to_pylist(), strict=True):
                own = np.array([word_hash(w) for w in item.split(b" ")], np.uint64)
                keys = np.unique(plan.keys(own, np.zeros(1, np.int64), plan.class_of(len(own))))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.view(np.int64)), pa.array([i] * len(keys), pa.int64()), pa.array([item] * len(keys), pa.binary())],
                    names=["key", "item_id", "item"],
                )

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item in batch.column("item").to_pylist():
                own = np.array([word_hash(w) for w in item.split(b" ")], np.uint64)
                row = classes[plan.class_of(len(own))][0]
                yield pa.RecordBatch.from_arrays([pa.array(_rows(own, row).view(np.int64))], names=["h"])

    filed = known.mapInArrow(file, "key long, item_id long, item binary")
    gate = _bits(known.mapInArrow(rows_of, "h long"), "h", GATE_BITS)
    wanted = _bits(filed, "key", KEY_BITS)
    held = docs.sparkSession.sparkContext.broadcast((gate, wanted))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gate_bits, key_bits = held.value
        for batch in slices(batches, "text", 2 << 20):
            words, met = Words(batch.column("text")), []
            n, ends = len(words.hashes), words.ends
            begin = np.r_[0, ends[:-1]]
            upto = {}  # rows of items before each word, by their length
            for row in {row for row, _, _ in classes.values()}:
                flags = np.zeros(n + 1, np.int32)
                flags[np.flatnonzero(_has(gate_bits, _rows(words.hashes, row))) + 1] = 1
                upto[row] = np.cumsum(flags)
            for c, (row, rows, most) in classes.items():
                # a window may count rows of the next text: that only lets more pass
                reach = np.minimum(np.arange(n) + most + most // LIMIT, n)
                starts = np.flatnonzero(upto[row][reach] - upto[row][:-1] >= rows)
                for i in range(0, len(starts), 20_000):
                    part = starts[i : i + 20_000]
                    keys = plan.keys(words.hashes, part, c)
                    found = _has(key_bits, keys.ravel()).reshape(keys.shape)
                    hit = np.flatnonzero(found.any(1))
                    if not len(hit):
                        continue
                    # hits close to each other in a text are one run
                    at, d = part[hit], np.searchsorted(ends, part[hit], "right")
                    cuts = np.flatnonzero((np.diff(d) != 0) | (np.diff(at) > most // LIMIT + 1)) + 1
                    for own in np.split(np.arange(len(hit)), cuts):
                        doc, k = int(d[own[0]]), most // LIMIT
                        a, b = max(int(begin[doc]), int(at[own[0]]) - k), min(int(ends[doc]), int(at[own[-1]]) + most + 2 * k + 1)
                        rows_of_run = hit[own]
                        met.append((doc, words.run(a, b), np.unique(keys[rows_of_run][found[rows_of_run]]).view(np.int64).tolist()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array([m[0] for m in met], pa.int64())), pa.array([m[1] for m in met], pa.binary()), pa.array([m[2] for m in met], pa.list_(pa.int64()))],
                names=["doc_id", "run", "keys"],
            )

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: dict = {}
        for batch in batches:
            out = []
            for row in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "run", "item_id", "item")), strict=True):
                if row in done:
                    continue  # the same meeting in another table
                if len(done) > 10_000:
                    done.clear()
                done[row] = None
                item = row[3].split(b" ")
                best, _ = distance(item, row[1].split(b" "))
                if best <= len(item) // LIMIT:
                    out.append((row[0], row[2], best, len(item)))
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate(kinds)], names=["doc_id", "item_id", "distance", "n_words"])

    asked = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    met = asked.mapInArrow(scan, "doc_id long, run binary, keys array<long>").select("doc_id", "run", F.explode("keys").alias("key"))
    checked = met.join(filed, "key").mapInArrow(verify, "doc_id long, item_id long, distance int, n_words int")
    share = (1 - F.col("distance") / F.col("n_words")).alias("similarity")
    best = checked.select("*", share).groupBy("doc_id", "item_id").agg(F.max(F.struct("similarity", (-F.col("distance")).alias("d"), "n_words")).alias("best"))
    return best.select("doc_id", "item_id", (-F.col("best.d")).alias("distance"), F.col("best.n_words"), F.col("best.similarity"))


def clean(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", **names: str) -> DataFrame:
    """The documents that leak no item."""
    found = leaks(docs, items, doc_id, **names).select(F.col("doc_id").alias("_leaks")).distinct()
    return docs.join(found, F.col(doc_id).cast("long").eqNullSafe(F.col("_leaks")), "left_anti")
