"""Removal of long repeated byte strings, by longest-previous-factor arrays.

A byte goes if a string of ``LENGTH`` bytes that covers it starts anywhere else as
well.  For one text this is a question to its longest-previous-factor array and its
mirror image: does the suffix at a position share ``LENGTH`` bytes with an earlier,
or with a later, suffix?  ``factors`` answers it from the order of the suffixes by
their first ``LENGTH`` bytes: equal beginnings are neighbours there, and the
previous and next smaller (larger) positions among the neighbours are the matches.

Over all documents the suffixes are never sorted as a whole:

1. Anchors.  Of each window of ``LENGTH`` bytes the string of ``GRAM`` bytes with
   the smallest hash is the anchor; equal windows have equal anchors.  An anchor
   stands for the run of windows it is chosen by, some hundred bytes on average; a
   periodic stretch, where it comes again and again, is one run.  Runs are dealt by
   the anchor's hash and sorted; a run whose anchor is found nowhere else, nor twice
   in it, has no repeated window, one whose bytes are found elsewhere has only
   repeated ones.  Neighbours in the sorted order tell.
2. The rest (equal anchors, different bytes around them) gets its bytes and is
   dealt by the anchor again; ``factors`` decides each window.  Anchors come in
   bunches of ``BATCH`` bytes.  The windows of an anchor with more than that (a
   passage in very many documents) are dealt out one by one by their digests and
   compared there, in the same way.
3. Each document gets its repeated runs and loses the bytes they cover.

Equal texts are known by their digest: their runs and bytes are sent once per task; a text of at least ``LENGTH`` bytes that occurs twice goes wholly.

Defined cases: null and empty texts have no bytes; texts below ``LENGTH`` bytes stay;
rows with equal ids and equal texts are copies of each other like any others; kept
bytes may be no UTF-8 and are returned as bytes; columns of the names of results
are replaced; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waycast.llm.common import partitions, ragged, slices, staged

LENGTH, GRAM, BATCH, SEEN = 400, 64, 4 << 20, 1 << 20

_RNG = np.random.default_rng(20)
_BYTE = _RNG.integers(1, 1 << 63, (2, 256), dtype=np.uint64)
_FACTOR = _RNG.integers(1, 1 << 63, (2, 16), dtype=np.uint64) | np.uint64(1)


def _grams(raw: np.ndarray, length: int, kind: int = 0) -> np.ndarray:
    """Hash of the ``length`` bytes from each position, put together from hashes of powers of two."""
    h, n, step, done, whole = _BYTE[kind][raw], 1, 0, 0, None
    while True:
        if length & n:
            size = len(raw) - length + 1
            part = h[done : done + size]
            whole = part.copy() if whole is None else whole * _FACTOR[kind][8 + step % 8] + part
            done += n
        n *= 2
        if n > length:
            break
        h = h[: -(n // 2)] * _FACTOR[kind][step] + h[n // 2 :]
        step += 1
    whole ^= whole >> np.uint64(31)
    whole *= np.uint64(0x9E3779B97F4A7C15)
    whole ^= whole >> np.uint64(29)
    return whole


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values."""
    n = len(values) - width + 1
    full = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    full[: len(values)] = values
    blocks = full.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def anchors(raw: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, ...]:
    """Text number, anchor's hash, first and last window of each run, and whether the anchor moves within it.

    The texts lie end to end in ``raw``.
    """
    whole = np.flatnonzero(lengths >= LENGTH)
    if not len(whole):
        return (*(np.empty(0, np.int64),) * 4, np.empty(0, bool))
    h = _grams(raw, GRAM)
    keyed = h >> np.uint64(32) << np.uint64(32) | np.arange(len(h), dtype=np.uint64)  # ties go to the left
    place = (_least(keyed, LENGTH - GRAM + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    window = ragged(starts[whole], lengths[whole] - LENGTH + 1)
    at = place[window]
    own = h[at]
    begin = np.flatnonzero(np.r_[True, (own[1:] != own[:-1]) | (window[1:] != window[:-1] + 1)])
    end = np.r_[begin[1:], len(window)] - 1
    first = window[begin]
    return np.searchsorted(starts, first, "right") - 1, own[begin].view(np.int64), first, window[end], at[begin] != at[end]


def factors(raw: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether the suffix at each of the (ascending) ``windows`` shares LENGTH bytes with an earlier and with a later one.

    The suffixes are ordered by the two 64-bit digests of their first LENGTH bytes
    and then by position.  Among equal beginnings the neighbours in this order are
    the previous smaller and the next larger position, so a longest previous factor
    reaches LENGTH if and only if the neighbour before has equal digests.
    """
    if not len(windows):
        return np.empty(0, bool), np.empty(0, bool)
    one, two = _grams(raw, LENGTH)[windows], _grams(raw, LENGTH, 1)[windows]
    order = np.argsort(one, kind="stable")
    same = one[order][1:] == one[order][:-1]
    if (same & (two[order][1:] != two[order][:-1])).any():  # a collision of the first digest
        order = np.lexsort((two, one))
        same = (one[order][1:] == one[order][:-1]) & (two[order][1:] == two[order][:-1])
    earlier, later = np.zeros(len(windows), bool), np.zeros(len(windows), bool)
    earlier[order[1:]], later[order[:-1]] = same, same
    return earlier, later


def _bytes(column: pa.Array) -> list[bytes]:
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def _laid(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    lengths = np.array([len(p) for p in parts], np.int64)
    return np.frombuffer(b"".join(parts), np.uint8), np.cumsum(lengths) - lengths, lengths


#: A run of windows as one number: its first window, and in the lower bits the distance of its last.
BITS = 31
REST = (1 << BITS) - 1


def _distinct(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[list[tuple[bytes, bytes]]]:
    """(digest, text) of texts that are long enough, once per task as long as ``SEEN`` digests reach back."""
    seen: set[bytes] = set()
    for batch in slices(batches, column):
        own = []
        for t in _bytes(batch.column(column)):
            if len(t) >= LENGTH and (k := hashlib.md5(t).digest()) not in seen:
                seen.add(k)
                own.append((k, t))
        if len(seen) > SEEN:
            seen.clear()
        if own:
            yield own


def _runs(docs: DataFrame, text: str) -> DataFrame:
    """(h, around, key, run, moves): every run of windows, with its anchor's hash and a digest of all its bytes."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own in _distinct(batches, "_text"):
            raw, starts, lengths = _laid([t for _, t in own])
            text_no, h, first, last, moves = anchors(raw, starts, lengths)
            whole = memoryview(raw)
            parts = zip(first.tolist(), (last + LENGTH).tolist(), strict=True)
            around = np.array([xxhash.xxh3_64_intdigest(whole[a:b]) for a, b in parts], np.uint64).view(np.int64)
            keys = pa.array([k for k, _ in own], pa.binary()).take(pa.array(text_no))
            run = first - starts[text_no] << BITS | last - first
            yield pa.RecordBatch.from_arrays(
                [pa.array(h), pa.array(around), keys, pa.array(run), pa.array(moves.astype(np.int64))],
                names=["h", "around", "key", "run", "moves"],
            )

    return docs.select(F.col(text).alias("_text")).mapInArrow(work, "h long, around long, key binary, run long, moves long")


def _neighbours(batches: Iterator[pa.RecordBatch], columns: list[str], same: list[int]) -> Iterator[tuple]:
    """Sorted rows without repeats, with what they share with the rows before and after them.

    ``columns`` are longs and one column of 16-byte values; for each n in ``same``:
    whether the first n columns equal those of the row before, and of the row after.
    Yields (arrays, [(before, after), ...]); a byte column comes as rows of two words.
    """

    def load(batch: pa.RecordBatch) -> list[np.ndarray]:
        out = []
        for name in columns:
            c = batch.column(name)
            out.append(np.frombuffer(b"".join(c.to_pylist()), np.uint64).reshape(-1, 2) if pa.types.is_binary(c.type) else np.asarray(c))
        return out

    def equal(a: np.ndarray) -> np.ndarray:
        e = a[1:] == a[:-1]
        return e.all(1) if e.ndim == 2 else e

    def judge(rows: list[np.ndarray], a: int, b: int) -> tuple:
        chain = np.ones(len(rows[0]) - 1, bool)
        shared = []
        for i, c in enumerate(rows):
            chain = chain & equal(c)
            if i + 1 in same:
                e = np.r_[False, chain, False]
                shared.append((e[a:b], e[a + 1 : b + 1]))
        return [c[a:b] for c in rows], shared

    held, done = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = load(batch)
        if held is not None:
            rows = [np.concatenate(x) for x in zip(held, rows, strict=True)]
        repeat = np.logical_and.reduce([equal(c) for c in rows])
        rows = [c[np.r_[True, ~repeat]] for c in rows]
        n = len(rows[0])
        if n - 1 > done:
            yield judge(rows, done, n - 1)
        keep = min(n, 2)
        held, done = [c[n - keep :] for c in rows], keep - 1
    if held is not None:
        yield judge(held, done, len(held[0]))


def _key_column(words: np.ndarray) -> pa.Array:
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(words), [None, pa.py_buffer(np.ascontiguousarray(words).tobytes())]).cast(pa.binary())


def _judged(runs: DataFrame) -> DataFrame:
    """(h, key, run, whole, send) of runs whose anchor is found elsewhere, or twice in the run.

    ``whole``: all windows are repeated; ``send``: the bytes are needed to decide
    the windows of this or of another run.
    """
    n = partitions(runs.sparkSession)
    dealt = runs.repartition(n, "h").sortWithinPartitions("h", "around", "key", "run")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = ["h", "around", "key", "run", "moves"]
        for (h, _, key, run, moves), ((h_before, h_after), (before, after)) in _neighbours(batches, columns, [1, 2]):
            whole = before | after
            other = (h_before & ~before) | (h_after & ~after)  # a neighbour has the anchor but other bytes
            send = other | (moves > 0) & ~whole
            at = np.flatnonzero(whole | send)
            yield pa.RecordBatch.from_arrays(
                [pa.array(h[at]), _key_column(key[at]), pa.array(run[at]), pa.array(whole[at]), pa.array(send[at])],
                names=["h", "key", "run", "whole", "send"],
            )

    return dealt.mapInArrow(work, "h long, key binary, run long, whole boolean, send boolean")


def _sent(docs: DataFrame, judged: DataFrame, text: str) -> DataFrame:
    """(h, key, run, data): the bytes of the runs that are needed."""

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own in _distinct(batches, "_text"):
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in own], pa.binary()) for i in (0, 1)], names=["key", "data"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "data"):
            h, key, run, data = [], [], [], []
            for k, t, asked in zip(*(batch.column(c).to_pylist() for c in ("key", "data", "asked")), strict=True):
                for a in asked:
                    first = a["run"] >> BITS
                    h.append(a["h"])
                    key.append(k)
                    run.append(a["run"])
                    data.append(t[first : first + (a["run"] & REST) + LENGTH])
            yield pa.RecordBatch.from_arrays(
                [pa.array(h, pa.int64()), pa.array(key, pa.binary()), pa.array(run, pa.int64()), pa.array(data, pa.binary())],
                names=["h", "key", "run", "data"],
            )

    asked = judged.where("send").groupBy("key").agg(F.collect_list(F.struct("h", "run")).alias("asked"))
    texts = docs.select(F.col(text).alias("_text")).mapInArrow(distinct, "key binary, data binary")
    return texts.join(asked.hint("shuffle_hash"), "key").mapInArrow(cut, "h long, key binary, run long, data binary")


_DECIDED = "key binary, first long, last long, one long, two long"


def _decided(sent: DataFrame) -> DataFrame:
    """Repeated windows ``first`` to ``last`` of texts; or, with digests ``one`` and ``two``, a window of a crowded anchor."""
    n = partitions(sent.sparkSession)
    dealt = sent.repartition(n, "h").sortWithinPartitions("h", "key", "run")

    def laid(rows: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        raw, starts, lengths = _laid([r[3] for r in rows])
        counts = lengths - LENGTH + 1
        return raw, ragged(starts, counts), np.repeat(np.arange(len(rows)), counts)

    def decide(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        if not rows:
            return
        raw, windows, row = laid(rows)
        earlier, later = factors(raw, windows)
        at = np.flatnonzero(earlier | later)
        if not len(at):
            return
        change = np.r_[True, (np.diff(windows[at]) != 1) | (np.diff(row[at]) != 0)]
        begin = np.flatnonzero(change)
        end = np.r_[begin[1:], len(at)] - 1
        starts = np.cumsum([0, *(len(r[3]) for r in rows)])[:-1]
        own = row[at[begin]]
        shift = np.array([r[2] >> BITS for r in rows], np.int64)[own] - starts[own]
        none = pa.nulls(len(begin), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array([rows[i][1] for i in own.tolist()], pa.binary()), pa.array(windows[at[begin]] + shift), pa.array(windows[at[end]] + shift), none, none],
            names=["key", "first", "last", "one", "two"],
        )

    def single(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        for i in range(0, len(rows), 1000):
            part = rows[i : i + 1000]
            raw, windows, row = laid(part)
            first = windows - np.cumsum([0, *(len(r[3]) for r in part)])[:-1][row] + np.array([r[2] >> BITS for r in part], np.int64)[row]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[1] for r in part], pa.binary()).take(pa.array(row)), pa.array(first), pa.array(first), *(pa.array(_grams(raw, LENGTH, k)[windows].view(np.int64)) for k in (0, 1))],
                names=["key", "first", "last", "one", "two"],
            )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []  # rows of anchors that are complete
        own: list[tuple] = []  # rows of the present anchor
        size = own_size = 0
        crowded, previous = None, None
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("h", "key", "run", "data")), strict=True):
                if row[:3] == previous:
                    continue
                if own and row[0] != own[0][0] or crowded is not None and row[0] != crowded:
                    if crowded is not None:
                        yield from single(own)
                    else:
                        done += own
                        size += own_size
                    own, own_size, crowded = [], 0, None
                    if size > BATCH:
                        yield from decide(done)
                        done, size = [], 0
                previous = row[:3]
                own.append(row)
                own_size += len(row[3])
                if own_size > BATCH:
                    crowded = row[0]
                    yield from single(own)
                    own, own_size = [], 0
        if crowded is not None:
            yield from single(own)
        else:
            done += own
        yield from decide(done)

    return dealt.mapInArrow(work, _DECIDED)


def _crowded(windows: DataFrame) -> DataFrame:
    """Those of single windows that another one equals."""
    n = partitions(windows.sparkSession)
    dealt = windows.repartition(n, "one").sortWithinPartitions("one", "two", "key", "first")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, _, key, first), ((before, after),) in _neighbours(batches, ["one", "two", "key", "first"], [2]):
            at = np.flatnonzero(before | after)
            yield pa.RecordBatch.from_arrays([_key_column(key[at]), pa.array(first[at]), pa.array(first[at])], names=["key", "first", "last"])

    return dealt.mapInArrow(work, "key binary, first long, last long")


def repeated(docs: DataFrame, text: str = "text") -> DataFrame:
    """(key, runs): for the MD5 of a text the repeated windows, as an array of (first, last); first -1 for a text that occurs twice."""
    judged = staged(_judged(_runs(docs, text)), "runs")
    decided = staged(_decided(_sent(docs, judged, text)), "windows")
    first = F.shiftright("run", BITS)
    whole = judged.where("whole").select("key", first.alias("first"), (first + F.col("run").bitwiseAND(F.lit(REST).cast("long"))).alias("last"))
    data = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
    twice = docs.where(F.octet_length(data) >= LENGTH).select(F.unhex(F.md5(data)).alias("key")).groupBy("key").count().where("count > 1")
    found = whole.unionByName(decided.where("one is null").select("key", "first", "last"))
    found = found.unionByName(_crowded(decided.where("one is not null")))
    found = found.unionByName(twice.select("key", F.lit(-1).cast("long").alias("first"), F.lit(-1).cast("long").alias("last")))
    return found.groupBy("key").agg(F.collect_list(F.struct("first", "last")).alias("runs"))


def covered(n: int, runs: list) -> np.ndarray:
    """Maximal covered spans (start, end) of a text of n bytes, as rows."""
    if any(r["first"] < 0 for r in runs):
        return np.array([[0, n]])
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, [r["first"] for r in runs], 1)
    np.add.at(edge, [r["last"] + LENGTH for r in runs], -1)
    inside = np.r_[False, np.cumsum(edge)[:n] > 0, False]
    return np.flatnonzero(inside[1:] != inside[:-1]).reshape(-1, 2)


def remove(docs: DataFrame, text: str = "text", digest: bool = False) -> DataFrame:
    """All columns of ``docs`` but the text, with ``n_bytes``, ``n_removed``, ``n_spans``, ``spans`` and ``kept`` (bytes).

    With ``digest``, ``kept_sha256`` comes in place of the spans and the bytes.
    """
    results = ["n_bytes", "n_removed", "n_spans", *(["kept_sha256"] if digest else ["spans", "kept"])]
    others = [c for c in docs.columns if c not in (text, *results)]
    data = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
    rows = docs.select(*others, data.alias("_data")).withColumn("_key", F.unhex(F.md5("_data")))
    found = repeated(docs, text).select(F.col("key").alias("_key"), F.col("runs").alias("_runs"))
    joined = rows.join(found.hint("shuffle_hash"), "_key", "left").select(*others, "_data", "_runs")
    span = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    kinds = [T.LongType(), T.LongType(), T.LongType(), *([T.StringType()] if digest else [span, T.BinaryType()])]
    schema = T.StructType([*docs.select(*others).schema.fields, *(T.StructField(n, t) for n, t in zip(results, kinds, strict=True))])
    of_span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    arrows = [pa.int64(), pa.int64(), pa.int64(), *([pa.string()] if digest else [of_span, pa.binary()])]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_data"):
            out = []
            for t, runs in zip(batch.column("_data").to_pylist(), batch.column("_runs").to_pylist(), strict=True):
                spans = covered(len(t), runs).tolist() if runs else []
                ends = [0, *(x for s in spans for x in s), len(t)]
                left = b"".join(t[a:b] for a, b in zip(ends[::2], ends[1::2], strict=True)) if spans else t
                shown = [hashlib.sha256(left).hexdigest()] if digest else [[{"start": a, "end": b} for a, b in spans], left]
                out.append((len(t), len(t) - len(left), len(spans), *shown))
            new = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), arrows, strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in others), *new], names=[*others, *results])

    return joined.mapInArrow(work, schema)
