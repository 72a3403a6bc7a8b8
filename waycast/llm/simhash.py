"""SimHash near-duplicates by pigeonhole blocks.

A fingerprint has one bit per position: set if it is set in over half of the
hashes of the document's shingles.  Two fingerprints that differ in at most
``distance`` bits agree wholly in ``blocks - distance`` of ``blocks`` parts at
least.  So every fingerprint is filed under each choice of that many parts, and
only fingerprints filed together are compared; no pair within the distance is
missed.  Equal fingerprints are folded before, so copies never meet.  Fingerprints
filed together are grouped in one sorted pass: each is compared with those not yet
reached, and one link per reached fingerprint comes out, never all pairs.

``duplicates`` serves filtering: documents whose five-word shingles have a
similarity of 0.8 or more.  Such pairs differ in too many bits of a fingerprint of
bits to share a part, wherever they were edited, so it files them under ``PARTS``
parts of a fingerprint of minima: each part holds the least of ``PART_MINIMA`` hashes
of the distinct shingles, equal in both with a chance of the similarity, so a pair at
0.8 shares a part with a chance of 0.998 whatever the edit.  A limit on the Hamming
distance of 512-bit fingerprints of the shingles, wide enough for every such pair, only
leaves out what is far apart.  The sets of shingle hashes of the documents left are then
fetched, once each, and the exact similarity of the sets decides every pair before
chains are followed; groups of more than ``BLOCK_BYTES`` are compared in pairs of blocks.

Defined cases: a null or empty text, or one of white space, has no words and
fingerprint zero, linked like any other; a text shorter than a shingle is one
shingle; shingles count as often as they occur; documents with equal ids count
each; a null id never names a component unless all its ids are null; extra columns
are not touched; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waycast.llm.common import partitions, slices, staged, texts
from waycast.llm.components import components

#: Parts of the fingerprint of minima in ``duplicates`` and the minima of each: 1 - (1 - 0.8^6)^20 = 0.998.
PARTS, PART_MINIMA = 20, 6
#: Expected share of differing bits at similarity 0.8 is 0.151, and one standard deviation 0.016: four of them are left as room.
VERIFY_BITS, VERIFY_MOST = 512, 110
#: Bytes of shingle hashes in a block of a crowded group; bits of the map of the nodes whose sets are fetched.
BLOCK_BYTES, MAP_BITS = 64 << 20, 1 << 25


def words_of(text: str) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case."""
    return text.encode().lower().split()


def shingles(words: list[bytes], k: int) -> list[bytes]:
    if len(words) <= k:
        return [b" ".join(words)] if words else []
    return list(map(b" ".join, zip(*(words[i:] for i in range(k)), strict=False)))


def _hashes(parts: list[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(p, 42) for p in parts), np.uint64, len(parts))


def _majority(hashes: np.ndarray, bits: int) -> bytes:
    """``hashes``: one row of 64-bit words per shingle; the bits set in over half of the rows, high bit first."""
    n = len(hashes)
    if not n:
        return bytes(bits // 8)
    raw = hashes.astype(">u8").view(np.uint8).reshape(n, -1)
    counts = np.zeros(raw.shape[1] * 8, np.int64)
    for i in range(0, n, 8192):
        counts += np.unpackbits(raw[i : i + 8192], axis=1).sum(0, dtype=np.int32)
    return np.packbits(counts[:bits] * 2 > n).tobytes()


def fingerprint(text: str, k: int) -> int:
    hashes = _hashes(shingles(words_of(text), k))
    return int.from_bytes(_majority(hashes.reshape(-1, 1), 64), "big")


def fingerprints(docs: DataFrame, k: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(``doc_id``, ``fp``): the 64-bit fingerprint as a signed long."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            fps = np.array([fingerprint(t, k) for t in texts(batch.column("text"))], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fps)], names=["doc_id", "fp"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(work, "doc_id long, fp long")


def _masks(distance: int, blocks: int) -> list[int]:
    """Signed bit masks: each choice of ``blocks - distance`` of ``blocks`` parts of 64 bits."""
    borders = [64 * i // blocks for i in range(blocks + 1)]
    parts = [(1 << b) - (1 << a) for a, b in zip(borders, borders[1:], strict=False)]
    masks = [sum(c) for c in combinations(parts, blocks - distance)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def reach(items: np.ndarray, near: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
    """For each item the first one it is linked to over any chain of near items."""
    root = np.arange(len(items))
    rest = root.copy()
    while len(rest):
        first, rest = rest[0], rest[1:]
        border = np.array([first])
        while len(border) and len(rest):
            step, hit = max(1, (1 << 20) // len(rest)), np.zeros(len(rest), bool)
            for i in range(0, len(border), step):
                left = ~hit
                if not left.any():
                    break
                hit[left] = near(items[border[i : i + step]], items[rest[left]]).any(0)
            border, rest = rest[hit], rest[~hit]
            root[border] = first
    return root


def filed_together(batches: Iterator[pa.RecordBatch], keys: list[str], rest: list[str]) -> Iterator[list[np.ndarray]]:
    """Runs of two or more rows with equal keys in sorted batches: the other columns of each run.

    A pair of columns comes as one array; byte columns of one length come as rows of bytes.
    """
    held: list[np.ndarray] | None = None

    def columns(batch: pa.RecordBatch) -> list[np.ndarray]:
        out = []
        for name in [*keys, *rest]:
            c = batch.column(name)
            if pa.types.is_binary(c.type):
                out.append(np.frombuffer(b"".join(c.to_pylist()), np.uint8).reshape(len(c), -1))
            else:
                out.append(np.asarray(c))
        return out

    def split(now: list[np.ndarray], last: bool) -> Iterator[list[np.ndarray]]:
        nonlocal held
        n = len(now[0])
        change = np.flatnonzero(np.any([c[1:] != c[:-1] for c in now[: len(keys)]], axis=0)) + 1
        starts, ends = np.r_[0, change], np.r_[change, n]
        if not last:
            held = [c[starts[-1] :] for c in now]
            starts, ends = starts[:-1], ends[:-1]
        for a, b in zip(starts[(two := ends - starts > 1)].tolist(), ends[two].tolist(), strict=True):
            yield [c[a:b] for c in now[len(keys) :]]

    for batch in batches:
        if batch.num_rows:
            now = columns(batch)
            yield from split([np.concatenate(x) for x in zip(held, now, strict=True)] if held is not None else now, False)
    if held is not None:
        yield from split(held, True)


_LINKS = ["a", "b"]


def _batches(a: list, b: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=_LINKS)


def _linked(filed: DataFrame, keys: list[str], rest: list[str], near) -> DataFrame:
    """Links between the nodes of each run: the first of ``rest`` is the node, the last is what ``near`` compares."""
    n = partitions(filed.sparkSession)
    dealt = filed.repartition(n, *keys).sortWithinPartitions(*keys)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b, size = [], [], 0
        for run in filed_together(batches, keys, rest):
            root = reach(run[-1], near)
            tied = np.flatnonzero(root != np.arange(len(root)))
            if len(tied):
                a.append(run[0][tied])
                b.append(run[0][root[tied]])
                size += len(tied)
            if size > 50_000:
                yield _batches(a, b)
                a, b, size = [], [], 0
        if a:
            yield _batches(a, b)

    return dealt.mapInArrow(work, "a long, b long")


def links(fps: DataFrame, distance: int = 3, blocks: int = 6) -> DataFrame:
    """Links (``a``, ``b``) that connect all distinct fingerprints ``fp`` within ``distance`` bits."""
    masks = _masks(distance, blocks)
    files = F.array(*[F.struct(F.lit(i).alias("place"), F.col("fp").bitwiseAND(F.lit(m).cast("long")).alias("part")) for i, m in enumerate(masks)])
    filed = fps.select("fp").distinct().select("fp", F.inline(files))

    def near(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        return np.bitwise_count((x[:, None] ^ y[None, :]).view(np.uint64)) <= distance

    return _linked(filed, ["place", "part"], ["fp"], near)


def classes(docs: DataFrame, k: int = 3, distance: int = 3, blocks: int = 6) -> DataFrame:
    """(``doc_id``, ``fingerprint``, ``component_id``): one row per document, with the smallest id it is linked to."""
    prints = staged(fingerprints(docs, k), "fingerprints")
    roots = components(links(prints, distance, blocks))
    named = _named(prints.select("doc_id", F.col("fp").alias("node")), roots)
    shown = F.lpad(F.lower(F.hex("node")), 16, "0")
    return named.select("doc_id", shown.alias("fingerprint"), F.col("least").alias("component_id"))


def _named(rows: DataFrame, roots: DataFrame, also: list[Column] | None = None) -> DataFrame:
    """``rows`` (doc_id, node, more) with ``least``, the smallest doc_id of the node's component."""
    own = rows.groupBy("node").agg(F.min("doc_id").alias("least"))
    rooted = own.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = rooted.groupBy("root").agg(F.min("least").alias("least"))
    table = staged(rooted.select("node", "root").join(least, "root").select("node", "least"), "classes")
    return rows.join(table, "node")


_ODD = np.arange(1, 33, 2, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) | np.uint64(1)
_FACTORS = np.random.default_rng(42).integers(0, 1 << 31, (PARTS * PART_MINIMA, 1), np.uint32) * np.uint32(2) + np.uint32(1)


def _shingle_hashes(words: list[bytes], k: int = 5) -> np.ndarray:
    """Sorted hashes of the distinct shingles of ``k`` words; fewer words are one shingle."""
    own = _hashes(words)
    if not len(own):
        return own
    k, mix = min(k, len(own)), np.uint64(0xD6E8FEB86659FD93)
    h = np.full(len(own) - k + 1, k, np.uint64)
    for i in range(k):
        h = (h ^ own[i : len(own) - k + 1 + i]) * mix
        h ^= h >> np.uint64(32)
    h.sort()
    return h[np.r_[True, h[1:] != h[:-1]]]


def _parts(hashes: np.ndarray) -> np.ndarray:
    """``PARTS`` hashes of ``PART_MINIMA`` minima each; none without shingles."""
    if not len(hashes):
        return np.empty(0, np.int64)
    low, least = (hashes >> np.uint64(16)).astype(np.uint32), np.full(len(_FACTORS), 0xFFFFFFFF, np.uint32)
    for i in range(0, len(low), 1024):
        h = low[i : i + 1024] * _FACTORS
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x2C1B3C6D)
        np.minimum(least, h.min(1), out=least)
    return np.array([xxhash.xxh64_intdigest(m, i) for i, m in enumerate(map(np.ndarray.tobytes, least.reshape(PARTS, -1)))], np.uint64).view(np.int64)


def _bits(hashes: np.ndarray) -> bytes:
    """The 512-bit fingerprint of the shingles."""
    total = np.zeros(VERIFY_BITS, np.int64)
    for i in range(0, len(hashes), 4096):
        h = hashes[i : i + 4096, None] * _ODD[None, : VERIFY_BITS // 64]
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(29)
        total += np.unpackbits(h.view(np.uint8), axis=1).sum(0, dtype=np.int32)
    return np.packbits(total * 2 > len(hashes)).tobytes()


def _node(words: list[bytes]) -> int:
    return xxhash.xxh64_intdigest(b" ".join(words), 42) - (1 << 63)


def duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(``doc_id``, ``least``) per document: ``least`` is the smallest id among its near-duplicates and itself."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            words = [words_of(t) for t in texts(batch.column("text"))]
            hashes = list(map(_shingle_hashes, words))
            columns = [pa.array(map(_node, words), pa.int64()), pa.array([_parts(h) for h in hashes], pa.list_(pa.int64())), pa.array(map(_bits, hashes), pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=["doc_id", "node", "parts", "bits"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    prints = staged(rows.mapInArrow(work, "doc_id long, node long, parts array<long>, bits binary"), "fingerprints")

    own = prints.groupBy("node").agg(F.first("parts").alias("parts"), F.first("bits").alias("bits"))
    filed = own.select("node", F.posexplode("parts").alias("place", "part"), "bits")

    def near(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        a, b = np.ascontiguousarray(x).view(np.uint64), np.ascontiguousarray(y).view(np.uint64)
        return sum(np.bitwise_count(a[:, None, i] ^ b[None, :, i]).astype(np.int16) for i in range(a.shape[1])) <= VERIFY_MOST

    close = staged(components(_linked(filed, ["place", "part"], ["node", "bits"], near)), "close")
    return _named(prints.select("doc_id", "node"), components(_exact_links(rows, close))).select("doc_id", "least")


def _exact_near(sets: list[np.ndarray], bits: np.ndarray) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """For ``reach`` over places in ``sets``: a similarity of 0.8 or more.  A column that has a hit is not compared again."""
    size = np.array(list(map(len, sets)))

    def near(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        out, free = np.zeros((len(x), len(y)), bool), np.ones(len(y), bool)
        for i, a in enumerate(x.tolist()):
            at = np.flatnonzero(free)
            at = at[np.bitwise_count(bits[a] ^ bits[y[at]]).sum(1) <= VERIFY_MOST]
            chunks = np.cumsum(size[y[at]]) >> 20
            for part in np.split(at, np.flatnonzero(np.diff(chunks)) + 1) if len(at) else ():
                n = size[y[part]]
                both = np.concatenate([sets[j] for j in y[part].tolist()])
                place = np.minimum(np.searchsorted(sets[a], both), size[a] - 1)
                common = np.add.reduceat(sets[a][place] == both, np.cumsum(n) - n, dtype=np.int64)
                out[i, part] = 9 * common >= 4 * (size[a] + n)  # common >= 0.8 of the union
            free &= ~out[i]
        return out

    return near


def _exact_links(rows: DataFrame, close: DataFrame) -> DataFrame:
    """Links within the groups of ``close`` (node, root) that connect all nodes of a similarity of 0.8 or more."""
    spark = rows.sparkSession
    at = F.col("node").bitwiseAND(F.lit(MAP_BITS - 1))
    words = close.select(F.shiftright(at, 6).alias("word"), F.expr("shiftleft(1L, cast(node & 63 as int))").alias("bit"))
    held = words.groupBy("word").agg(F.bit_or("bit").alias("bit")).toArrow()
    filled = np.zeros(MAP_BITS // 64, np.int64)
    filled[np.asarray(held["word"])] = np.asarray(held["bit"])
    known = spark.sparkContext.broadcast(filled)

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in slices(batches, "text"):
            node, hashes = [], []
            for t in texts(batch.column("text")):
                w = words_of(t)
                x = _node(w)
                i = x & (MAP_BITS - 1)
                if int(known.value[i >> 6]) >> (i & 63) & 1 and x not in seen:
                    node.append(x)
                    hashes.append(_shingle_hashes(w))
                    seen.add(x)
            if len(seen) > 100_000:
                seen.clear()
            if node:
                columns = [pa.array(node, pa.int64()), pa.array([h.tobytes() for h in hashes], pa.binary()), pa.array(map(_bits, hashes), pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["node", "hashes", "bits"])

    sets = rows.mapInArrow(fetch, "node long, hashes binary, bits binary").join(close, "node").dropDuplicates(["node"])
    sets = staged(sets, "sets")
    crowded = sets.groupBy("root").agg(F.ceil(F.sum(F.length("hashes")) / BLOCK_BYTES).cast("int").alias("k")).where("k > 1")
    dealt = sets.join(F.broadcast(crowded), "root", "left").withColumn("k", F.coalesce("k", F.lit(1)))
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("node"), "k").cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("k") - 1))).where("k = 1 or own != other")
    keys = ["root", "i", "j"]
    dealt = dealt.select("root", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "node", "hashes", "bits")
    dealt = dealt.repartition(partitions(spark), *keys).sortWithinPartitions(*keys)

    def linked(node: list[int], hashes: list[bytes], bits: list[bytes]) -> pa.RecordBatch:
        node = np.array(node)
        near = _exact_near([np.frombuffer(h, np.uint64) for h in hashes], np.frombuffer(b"".join(bits), np.uint64).reshape(len(bits), -1))
        root = reach(np.arange(len(node)), near)
        tied = np.flatnonzero(root != np.arange(len(root)))
        return _batches([node[tied]], [node[root[tied]]])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, run = None, ([], [], [])
        for batch in batches:
            for *key, x, h, b in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key != last:
                    if run[0]:
                        yield linked(*run)
                    last, run = key, ([], [], [])
                for own, value in zip(run, (x, h, b), strict=True):
                    own.append(value)
        if run[0]:
            yield linked(*run)

    return dealt.mapInArrow(work, "a long, b long")


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without near-duplicates of a smaller id; of rows with one id and equal text, all or none stay.

    Documents whose id is null have no place in that order: they stay if their group has no other id.
    """
    named = duplicates(docs, doc_id, text).where("least is not null and doc_id > least or doc_id is null and least is not null")
    gone = named.select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, F.col(doc_id).eqNullSafe(F.col("_gone")), "left_anti")
