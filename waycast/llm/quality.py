"""Document quality by Bradley-Terry ranking.

Each document has a strength, linear in features of its text; the good document of
a preference pair wins with the logistic of the difference of strengths.  ``fit``
draws pairs of a good and a poor document from a sample of at most ``most_labels``
labelled rows (those with the smallest hashes of their ids): ``pairs`` pairs in a
fixed order that takes every row equally often.  It minimises the logistic loss on
the pairs' feature differences by Newton's method.  The threshold is the quantile
of the sample's strengths that leaves out its share of poor documents; ``score``
is the logistic of the strength above the threshold, so 0.5 lies on it.

Features are counts of bytes and words of the whole text, taken in one pass where
the documents are read; there is no shuffle.  Only the weights are sent.

Defined cases: null and empty texts have all features zero and get the score that
follows; null labels are not used, of rows with one id the larger label counts;
without labels of both kinds every score is 0.5; equal texts get equal scores; a
column of the name of a result is replaced; an empty table stays empty.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from waycast.llm.common import slices, texts
from waycast.llm.toxicity import sample

#: Kinds of bytes that are counted: of a text in UTF-8, by value.
_KINDS = [b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b" \t\r", b"\n", b".,;:", b"!?", b"|", b"#&$%*@^~", b"()[]{}<>/\\=_+-\"'`", bytes(range(128, 256))]
_KIND = np.zeros(256, np.int64)
for _i, _kind in enumerate(_KINDS):
    _KIND[list(_kind)] = _i + 1


def features(text: str) -> np.ndarray:
    raw = text.encode()
    if not raw:
        return np.zeros(len(_KINDS) + 8)
    kinds = np.bincount(_KIND, np.bincount(np.frombuffer(raw, np.uint8), minlength=256), len(_KINDS) + 1)[1:]
    words = raw.split()
    n = len(words)
    counts = Counter(words)
    twice = sum(a == b for a, b in zip(words, words[1:], strict=False))
    lines = [x for x in raw.split(b"\n") if x]
    short = sum(len(w) <= 3 for w in words)
    return np.r_[
        kinds / len(raw),
        np.log1p(n), len(counts) / max(n, 1), twice / max(n, 1), max(counts.values(), default=0) / max(n, 1),
        short / max(n, 1), len(raw) / max(n, 1) / 10, 1 - len(set(lines)) / max(len(lines), 1), n / max(len(lines), 1) / 100,
    ]


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float
    spread: float

    def strengths(self, rows: np.ndarray) -> np.ndarray:
        z = np.clip((rows - self.mean) / self.scale, -8, 8)
        return np.c_[z, z**2] @ self.weights

    def scores(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip((self.strengths(rows) - self.threshold) / self.spread, -50, 50)))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", most_labels: int = 20_000, pairs: int = 100_000) -> Model:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = pa.array([features(t).tolist() for t in texts(batch.column("text"))], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), found], names=["doc_id", "label", "found"])

    chosen = sample(docs, labels, label, most_labels).mapInArrow(work, "doc_id long, label int, found array<double>")
    rows = sorted(chosen.collect(), key=lambda r: (r.doc_id, r.label, r.found))
    width = len(features(""))
    x = np.array([r.found for r in rows], float).reshape(-1, width)
    good = np.array([r.label > 0 for r in rows], bool)
    if not good.any() or good.all():
        return Model(np.zeros(width), np.ones(width), np.zeros(2 * width), 0.0, 1.0)
    mean, scale = x.mean(0), np.maximum(x.std(0), 1e-6)
    z = np.clip((x - mean) / scale, -8, 8)
    z = np.c_[z, z**2]
    winners, losers = np.flatnonzero(good), np.flatnonzero(~good)
    rng = np.random.default_rng(42)
    first = np.concatenate([rng.permutation(winners) for _ in range(-(-pairs // len(winners)))])[:pairs]
    second = np.concatenate([rng.permutation(losers) for _ in range(-(-pairs // len(losers)))])[:pairs]
    d = z[first] - z[second]
    w = np.zeros(d.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(d @ w, -30, 30)))
        gradient = d.T @ (p - 1) / len(d) + 1e-3 * w
        hessian = (d * (p * (1 - p))[:, None]).T @ d / len(d) + 1e-3 * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    strengths = z @ w
    threshold = float(np.quantile(strengths, 1 - good.mean()))
    return Model(mean, scale, w, threshold, 1.0)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """All columns of ``docs`` with ``score`` and ``predicted`` (1 from a score of 0.5)."""
    results = ["score", "predicted"]
    rows = docs.select(*[c for c in docs.columns if c not in results])
    schema = T.StructType([*rows.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = [features(t) for t in texts(batch.column("text"))]
            scores = model.scores(np.array(found).reshape(len(found), -1))
            new = [pa.array(scores, pa.float64()), pa.array((scores >= 0.5).astype(np.int32))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=[*batch.schema.names, *results])

    return rows.mapInArrow(work, schema)
