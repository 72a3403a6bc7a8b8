"""Toxicity by the nearest labelled examples under exact TF-IDF cosine.

``fit`` learns from a sample of labelled documents whose size is bounded by
``most_labels`` (those with the smallest hashes of their ids):

* terms: words without punctuation and their beginnings of four and five letters,
  in at least ``LEAST_DOCS`` and a thousandth of the sampled documents, and related
  to the label beyond what chance gives among so many terms (likelihood ratio above
  twice the logarithm of their number); the ``most_terms`` strongest;
* document frequencies of these terms over all documents, counted in Spark;
* the inverted index: all sampled examples with any term, sorted so that similar ones lie
  together, in blocks of ``BLOCK``; for every term the weights of its examples, and
  for every term and block the largest weight;
* calibration: a logistic curve from the vote to the label, fitted to the votes of
  the examples with themselves left out.

``score`` adds to each document its ``score``, ``predicted`` and ``evidence`` (ids
of the nearest examples).  For a document the largest weights bound the cosine
with any example of a block; blocks are taken from the highest bound downwards
until the bound is below the k-th best cosine found, so the neighbours are exact.
The vote of a neighbour is weighted by its closeness, one over its distance.

The index and model are bounded by the parameters, so they are broadcast; the
documents stay where they are read.

Defined cases: null and empty texts, and texts without any term, have no
neighbours and get the score of a vote without neighbours, which is the share of
toxic rows among such examples; labels that are null are not used, of rows with
one id the larger label counts; without labels of both kinds every score is 0;
neighbours of equal cosine come in order of their ids; empty tables give empty
results.
"""

from __future__ import annotations

import pickle
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waycast.llm.common import ragged, slices, staged, texts

LEAST_DOCS, BLOCK, NEAREST = 3, 64, 15

#: Runs of letters; whatever is not ASCII counts as a letter, which is fast to test.
_WORD = re.compile("[a-z\u00aa-\U0010ffff]+")


def _terms_of_word(word: str) -> list[str]:
    """A lower-case word, and its first four and five letters if it has them, marked by a star."""
    return [word, *([word[:4] + "*"] if len(word) > 3 else []), *([word[:5] + "*"] if len(word) > 4 else [])]


def terms_of(text: str) -> Counter:
    found: Counter = Counter()
    for word, n in Counter(_WORD.findall(text.lower())).items():
        for term in _terms_of_word(word):
            found[term] += n
    return found


class WordTerms(dict):
    """Numbers of a word's terms; most words have none."""

    def __init__(self, terms: dict[str, int]):
        self.terms = terms
        self.heads = {t.rstrip("*")[:4] for t in terms}  # what a word with a term begins with

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) > 100_000:
            self.clear()
        self[word] = own = tuple(i for i in map(self.terms.get, _terms_of_word(word)) if i is not None)
        return own

    def counts(self, text: str) -> dict[int, int]:
        words = _WORD.findall(text.lower())
        known = {w for w in set(words) if w[:4] in self.heads}
        found: dict[int, int] = {}
        for word, n in Counter(filter(known.__contains__, words)).items() if known else ():
            for i in self[word]:
                found[i] = found.get(i, 0) + n
        return found


@dataclass
class Model:
    terms: dict[str, int]
    idf: np.ndarray
    ids: np.ndarray  # of examples, by position
    toxic: np.ndarray
    pointers: np.ndarray  # terms x blocks + 1: where each term's postings of a block start
    places: np.ndarray  # positions of the examples
    weights: np.ndarray
    block_max: np.ndarray  # terms x blocks
    vote: tuple[float, float]  # slope and offset of the calibration
    alone: float  # score without neighbours

    def vector(self, text: str, known: WordTerms | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Term numbers and unit weights of a text."""
        return _weigh((known or WordTerms(self.terms)).counts(text), self.idf)

    def _cosines(self, at: np.ndarray, w: np.ndarray, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the examples of some blocks and their cosines: only the postings of these blocks are read."""
        first = self.pointers[at[:, None], blocks[None, :]].ravel()
        length = self.pointers[at[:, None], blocks[None, :] + 1].ravel() - first
        read = ragged(first, length)
        weight = self.weights[read] * np.repeat(np.repeat(w, len(blocks)), length)
        sums = np.bincount(self.places[read], weight, (int(blocks.max()) + 1) * BLOCK)
        found = np.flatnonzero(sums > 0)
        return found, sums[found]

    def nearest(self, at: np.ndarray, w: np.ndarray, but: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """Positions and cosines of the ``NEAREST`` examples with a positive cosine, nearest first."""
        found, cos = np.empty(0, np.int64), np.empty(0)
        if not len(at) or not len(self.ids):
            return found, cos
        bounds = w @ self.block_max[at]
        left, step = np.argsort(-bounds, kind="stable")[: int((bounds > 0).sum())], 4
        while len(left):
            own, near = self._cosines(at, w, left[:step])
            keep = own != but
            found, cos = np.r_[found, own[keep]], np.r_[cos, near[keep]]
            best = np.lexsort((self.ids[found], -cos.round(12)))[:NEAREST]
            found, cos = found[best], cos[best]
            least = cos[-1] - 1e-9 if len(cos) == NEAREST else 0.0
            left, step = left[step:], 4 * step
            left = left[bounds[left] >= least]  # no other block can hold a nearer example
        return found, cos

    def votes(self, found: np.ndarray, cos: np.ndarray) -> float:
        """The share of closeness that votes toxic: one over the distance, less that of no cosine; and a weak clean vote."""
        close = 1 / (1.05 - np.minimum(cos, 1.0)) - 1 / 1.05
        return float(close @ self.toxic[found] / (close.sum() + 0.1))

    def of(self, text: str, known: WordTerms) -> tuple[float, list[int]]:
        found, cos = self.nearest(*self.vector(text, known))
        if not len(found):
            return self.alone, []
        a, b = self.vote
        return float(1 / (1 + np.exp(-(a * self.votes(found, cos) + b)))), self.ids[found[:3]].tolist()


def _weigh(found: dict[int, int], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.array(sorted(found), np.int64)
    w = (1 + np.log(np.array([found[i] for i in at.tolist()], float))) * idf[at] if len(at) else np.empty(0)
    norm = np.sqrt((w**2).sum())
    return at, w / norm if norm else w


def sample(docs: DataFrame, labels: DataFrame, label: str, most: int) -> DataFrame:
    """(doc_id, text, label) of at most ``most`` labelled documents: those with the smallest hashes of their ids.

    The ids are bounded by ``most``, so the join that fetches the texts broadcasts them.
    """
    one = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(label).alias("_label"))
    chosen = one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).select(F.col("doc_id").alias("_id"), "_label")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    found = rows.join(F.broadcast(chosen), rows["doc_id"] == F.col("_id"))
    return found.select("doc_id", "text", F.col("_label").cast("int").alias("label"))


def _chosen_terms(rows: DataFrame, most_terms: int) -> list[str]:
    """The terms most related to the label, by the likelihood ratio over the sampled documents."""
    total = rows.agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("t")).first()
    n, toxic = total["n"], total["t"] or 0
    if not 0 < toxic < n:
        return []

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, tf = Counter(), Counter()  # a share of a bounded sample
        for batch in slices(batches, "text"):
            for t, label in zip(texts(batch.column("text")), batch.column("label").to_pylist(), strict=True):
                own = terms_of(t).keys()
                df.update(own)
                if label:
                    tf.update(own)
        yield pa.RecordBatch.from_arrays(
            [pa.array(df.keys(), pa.string()), pa.array(df.values(), pa.int64()), pa.array(map(tf.__getitem__, df), pa.int64())],
            names=["term", "df", "tf"],
        )

    counted = rows.mapInArrow(work, "term string, df long, tf long").groupBy("term").agg(F.sum("df").alias("df"), F.sum("tf").alias("tf"))
    with_term = counted.where(F.col("df") >= max(LEAST_DOCS, n // 1000))
    with_term = staged(with_term, "terms")
    df, tf = F.col("df"), F.col("tf")

    def part(seen, rows: int):
        return F.when(seen > 0, seen * F.log(seen * n / (rows * 1.0 * F.col("of")))).otherwise(0.0)

    both = with_term.withColumn("of", df)
    inside = part(tf, toxic) + part(df - tf, n - toxic)
    both = both.withColumn("inside", inside).withColumn("of", n - df)
    ratio = 2 * (F.col("inside") + part(toxic - tf, toxic) + part((n - toxic) - (df - tf), n - toxic))
    least = 2 * float(np.log(max(2, with_term.count())))
    strong = both.where(df < n).withColumn("ratio", ratio).where(F.col("ratio") > least)
    return [r.term for r in strong.orderBy(F.desc("ratio"), "term").limit(most_terms).select("term").collect()]


def document_frequencies(docs: DataFrame, terms: list[str]) -> tuple[np.ndarray, int]:
    """In how many of all documents each term occurs, and how many documents there are."""
    number = {t: i for i, t in enumerate(terms)}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n, known = np.zeros(len(number), np.int64), 0, WordTerms(number)
        for batch in slices(batches, "text"):
            for t in texts(batch.column("text")):
                n += 1
                df[list(known.counts(t))] += 1
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[-1, at]), pa.array(np.r_[n, df[at]])], names=["term", "n"])

    rows = docs.select("text").mapInArrow(work, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    counts = {r.term: r.n for r in rows}
    return np.array([counts.get(i, 0) for i in range(len(terms))], float), counts.get(-1, 0)


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", most_labels: int = 10_000, most_terms: int = 2048) -> Model:
    """``labels``: (doc_id, ``label``), the rows to learn from.  The two bounds limit what the driver and the index hold."""
    rows = staged(sample(docs, labels, label, most_labels), "labelled")
    terms = _chosen_terms(rows, most_terms)
    df, total = document_frequencies(docs, terms)
    number = {t: i for i, t in enumerate(terms)}

    def known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = WordTerms(number)
        for batch in slices(batches, "text"):
            found = [list(own.counts(t).items()) for t in texts(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), pa.array(found, pa.map_(pa.int32(), pa.int32()))],
                names=["doc_id", "label", "found"],
            )

    found = rows.mapInArrow(known, "doc_id long, label int, found map<int,int>").collect() if terms else []
    examples = sorted(((r.doc_id, r.label, r.found) for r in found), key=lambda r: r[:2])
    return _indexed(number, np.log((1 + total) / (1 + df)) + 1, examples)


def _indexed(number: dict[str, int], idf: np.ndarray, rows: list) -> Model:
    bare = [label for _, label, found in rows if not found]
    chosen = [(i, kind, *_weigh(found, idf)) for i, kind, found in rows if found]
    chosen.sort(key=lambda r: (int(r[2][np.argmax(r[3])]), r[1], r[0]))
    n, blocks = len(chosen), -(-len(chosen) // BLOCK)
    block_max = np.zeros((len(number), blocks))
    posted: list[list[tuple[int, float]]] = [[] for _ in number]
    for place, (_, _, at, w) in enumerate(chosen):
        block_max[at, place // BLOCK] = np.maximum(block_max[at, place // BLOCK], w)
        for i, x in zip(at.tolist(), w.tolist(), strict=True):
            posted[i].append((place, x))
    flat = [p for own in posted for p in own]
    sizes = np.zeros((len(number), blocks + 1), np.int64)
    for i, own in enumerate(posted):
        for p, _ in own:
            sizes[i, p // BLOCK + 1] += 1
    ends = np.cumsum([len(own) for own in posted], dtype=np.int64)
    pointers = np.cumsum(sizes, 1) + (ends - sizes.sum(1))[:, None]
    model = Model(
        number, idf, np.array([r[0] for r in chosen], np.int64), np.array([r[1] for r in chosen], float),
        pointers, np.array([p for p, _ in flat], np.int64),
        np.array([x for _, x in flat], float), block_max, (1.0, 0.0), (sum(bare) + 0.0) / (len(bare) + 1.0),
    )
    if n:
        votes = np.array([model.votes(*model.nearest(at, w, but=p)) for p, (_, _, at, w) in enumerate(chosen)])
        model.vote = _curve(votes, model.toxic)
    return model


def _curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve, by Newton's method with a weak penalty on the slope."""
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-(a * x + b)))
        s = np.maximum(p * (1 - p), 1e-9)
        g = np.array([((p - y) * x).sum() + 1e-2 * a, (p - y).sum() + 1e-3 * b])
        h = np.array([[(s * x * x).sum() + 1e-2, (s * x).sum()], [(s * x).sum(), s.sum() + 1e-3]])
        step = np.clip(np.linalg.solve(h, g), -5, 5)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(a), float(b)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """All columns of ``docs`` with ``score``, ``predicted`` (1 from a score of 0.5) and ``evidence``."""
    results = ["score", "predicted", "evidence"]
    rows = docs.select(*[c for c in docs.columns if c not in results])
    # pickled with its classes, which workers need not have
    held = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(model))
    schema = T.StructType([
        *rows.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType()),
        T.StructField("evidence", T.ArrayType(T.LongType())),
    ])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pickle.loads(held.value)
        known = WordTerms(own.terms)
        for batch in slices(batches, "text"):
            found = [own.of(t, known) for t in texts(batch.column("text"))]
            new = [
                pa.array([s for s, _ in found], pa.float64()), pa.array([int(s >= 0.5) for s, _ in found], pa.int32()),
                pa.array([e for _, e in found], pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=[*batch.schema.names, *results])

    return rows.mapInArrow(work, schema)
