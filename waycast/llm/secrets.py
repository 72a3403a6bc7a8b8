"""Secret scans: fixed patterns, and random-looking strings by two Markov models.

Patterns give the base spans (``assign``, ``access``, ``hex``).  Strings that no
pattern covers are judged by character Markov models of first order: one of random
strings, trained on the values that the patterns find, and one of ordinary
identifiers, trained on other strings of the same documents.  The labels are those
of the patterns; every distinct string of all documents counts once.  A string of at
least ``LEAST`` characters becomes a span of kind ``random`` if its log-likelihood
ratio is above a threshold: what all but a ten-thousandth of the ordinary strings of
that length stay below, at least ``MARGIN`` per character.  As secrets that no pattern
covers are among the ordinary strings, the threshold is never so high that more than
a twentieth of the patterns' values of that length would be missed, unless that is
below ``MARGIN``.  Base spans are never changed.

The models are two tables of fixed size, summed over tasks from their step counts; the
threshold comes from a histogram of ratios, summed likewise.  Strings are shuffled once
to be distinct; documents are scanned where they are read.

Defined cases: null and empty texts have no spans; offsets are code points, the
end exclusive; spans come by start, then by kind in the order above, ``random``
last; without random or without ordinary samples no span is added; repeated rows
are scanned each; columns of the names of results are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waycast.llm.common import slices, staged, texts

KINDS = ["assign", "access", "hex", "random"]
LEAST, MARGIN = 20, 0.5
#: Ratios of the histogram go from -BINS / FINE to BINS / FINE.
BINS, FINE = 32_000, 1000

_ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")  # shorter runs hold no other start of 20 characters
_HEX = re.compile(r"[0-9a-f]{24,}")
_STRING = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
_TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{8,}")

_SYMBOLS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-."
_NUMBER = np.full(128, len(_SYMBOLS) - 1, np.int64)
_NUMBER[[ord(c) for c in _SYMBOLS]] = np.arange(len(_SYMBOLS))


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind's number, end, secret value) of the patterns' matches, by start."""
    found = []
    if ":" in text or "=" in text:
        found += [(m.start(), 0, m.end(), m[2]) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), m[0]) for m in _ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end(), m[0]) for m in _HEX.finditer(text)]
    return sorted(found)


def _outside(pattern: re.Pattern, text: str, base: list) -> list[tuple[int, int, str]]:
    """Matches of a pattern that touch no base span."""
    out, i = [], 0
    for m in pattern.finditer(text):
        while i < len(base) and base[i][2] <= m.start():
            i += 1
        if not any(b[0] < m.end() and m.start() < b[2] for b in base[i:]):
            out.append((m.start(), m.end(), m[0]))
    return out


@dataclass
class Model:
    ratio: np.ndarray | None  # log ratio of each step between symbols; None adds no spans
    threshold: float = 0.0

    def ratios(self, strings: list[str]) -> np.ndarray:
        """Log-likelihood ratio per character of each string, positive for random ones."""
        return _means(self.ratio, strings)


def _steps(strings: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    raw = _NUMBER[np.frombuffer("".join(strings).encode("ascii"), np.uint8)]
    lengths = np.array([len(s) for s in strings])
    starts = np.cumsum(lengths) - lengths
    inner = np.ones(len(raw), bool)
    inner[starts] = False
    return raw, inner, starts


def _means(table: np.ndarray, strings: list[str]) -> np.ndarray:
    if not strings:
        return np.empty(0)
    raw, inner, starts = _steps(strings)
    value = np.zeros(len(raw))
    at = np.flatnonzero(inner)
    value[at] = table[raw[at - 1], raw[at]]
    return np.add.reduceat(value, starts) / np.array([len(s) for s in strings])


def _counts(strings: list[str]) -> np.ndarray:
    """How often each symbol follows each."""
    n = len(_SYMBOLS)
    if not strings:
        return np.zeros(n * n, np.int64)
    raw, inner, _ = _steps(strings)
    at = np.flatnonzero(inner)
    return np.bincount(raw[at - 1] * n + raw[at], minlength=n * n)


def _log_chances(counts: np.ndarray) -> np.ndarray:
    counts = counts.reshape(len(_SYMBOLS), -1) + 0.5
    return np.log(counts / counts.sum(1, keepdims=True))


def _histogram(ratio: np.ndarray, strings: list[str]) -> np.ndarray:
    """How many strings of ``LEAST`` characters or more have a ratio in each bin."""
    bins = np.floor(_means(ratio, [s for s in strings if len(s) >= LEAST]) * FINE).astype(np.int64) + BINS
    return np.bincount(bins.clip(0, 2 * BINS - 1), minlength=2 * BINS)


def _threshold(secret: np.ndarray, ordinary: np.ndarray) -> float:
    """From the histograms: the upper end of the ordinary quantile's bin, or the lower end of the secret one's."""

    def place(counts: np.ndarray, share: float) -> int:
        return int(np.searchsorted(np.cumsum(counts), max(1, np.ceil(share * counts.sum()))))

    if not ordinary.any():
        return MARGIN
    least = (place(ordinary, 1 - 1e-4) + 1 - BINS) / FINE
    return max(MARGIN, min(least, (place(secret, 0.05) - BINS) / FINE) if secret.any() else least)


def train(secret: list[str], ordinary: list[str]) -> Model:
    if not secret or not ordinary:
        return Model(None)
    ratio = _log_chances(_counts(secret)) - _log_chances(_counts(ordinary))
    return Model(ratio, _threshold(_histogram(ratio, secret), _histogram(ratio, ordinary)))


def _strings(docs: DataFrame, text: str) -> DataFrame:
    """(``secret``, ``s``): the distinct strings of both kinds."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: tuple[set, set] = (set(), set())  # spares the shuffle most repetitions
        for batch in slices(batches, text):
            new: tuple[set, set] = (set(), set())
            for t in texts(batch.column(text)):
                base = base_spans(t)
                new[1].update(v for _, _, _, v in base)
                new[0].update([s for _, _, s in _outside(_TOKEN, t, base)] if base else _TOKEN.findall(t))
            for own, known in zip(new, seen, strict=True):
                own -= known
                known |= {s for s in own if len(s) < 200}
                if len(known) > 200_000:
                    known.clear()
            yield pa.RecordBatch.from_arrays([pa.array([False] * len(new[0]) + [True] * len(new[1])), pa.array([*new[0], *new[1]], pa.string())], names=["secret", "s"])

    return staged(docs.select(text).mapInArrow(work, "secret boolean, s string").distinct(), "strings")


def _sums(strings: DataFrame, of: Callable[[list[str]], np.ndarray], size: int) -> tuple[np.ndarray, np.ndarray]:
    """``of`` the ordinary and of the secret strings, a table of ``size`` counts, summed over all tasks."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, size), np.int64)
        for batch in slices(batches, "s"):
            for kind in (0, 1):
                total[kind] += of(batch.filter(pc.equal(batch.column("secret"), bool(kind))).column("s").to_pylist())
        kind, at = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(kind), pa.array(at), pa.array(total[kind, at])], names=["kind", "at", "n"])

    out = np.zeros((2, size), np.int64)
    for r in strings.mapInArrow(work, "kind long, at long, n long").groupBy("kind", "at").agg(F.sum("n").alias("n")).collect():
        out[r.kind, r.at] = r.n
    return out[0], out[1]


def fit(docs: DataFrame, text: str = "text") -> Model:
    """The models from the distinct strings of all documents."""
    strings = _strings(docs, text)
    ordinary, secret = _sums(strings, _counts, len(_SYMBOLS) ** 2)
    if not ordinary.any() or not secret.any():
        return Model(None)
    ratio = _log_chances(secret) - _log_chances(ordinary)
    long = strings.where(F.length("s") >= LEAST)
    ordinary, secret = _sums(long, lambda own: _histogram(ratio, own), 2 * BINS)
    return Model(ratio, _threshold(secret, ordinary))


def scan(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """All columns of ``docs`` but the text, with ``found``: an array of (kind, start, end)."""
    others = [c for c in docs.columns if c not in (text, "found")]
    span = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
    schema = T.StructType([*docs.select(*others).schema.fields, T.StructField("found", T.ArrayType(span))])
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            found, strings, at = [], [], []
            for i, t in enumerate(texts(batch.column(text))):
                base = base_spans(t)
                found.append([(s, k, e) for s, k, e, _ in base])
                if model.ratio is not None:
                    for s, e, value in _outside(_STRING, t, base):
                        strings.append(value)
                        at.append((i, s, e))
            if strings:
                for j in np.flatnonzero(model.ratios(strings) > model.threshold).tolist():
                    i, s, e = at[j]
                    found[i].append((s, 3, e))
            rows = [[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in sorted(own)] for own in found]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in others), pa.array(rows, kind)], names=[*others, "found"])

    return docs.select(*others, text).mapInArrow(work, schema)


def digests(scanned: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) of ``scan``'s rows."""

    def joined(spans):
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")

    def count(kind: str):
        return F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("found", lambda x: x["kind"] != "random")
    return scanned.select("doc_id", *map(count, KINDS[:3]), F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("found")).alias("spans"))

