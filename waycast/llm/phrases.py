"""Frequent phrases and their cohesion, from suffix trees of a few words' depth.

A piece is a text's stretch between punctuation marks, a suffix a word with up to
``depth - 1`` words that follow it in its piece; all is counted per language.  The tree of
all suffixes has a node per phrase; the leaves below it hold the phrase's count.  It is
never built whole, but in groups, by vertical partitioning:

1. Prefixes.  A scan counts words, a second one pairs of words that are both frequent
   (``min_count`` occurrences), a third one the hashes of triples whose pairs both are.
   Each leaves a bit map of the hashes that are frequent, of ``WORD_BITS``, ``PAIR_BITS``
   and ``TRIPLE_BITS`` bits, whatever the input; a bit that two hashes share costs work and
   no result.  A suffix is cut before the first triple that is not frequent, since no
   frequent phrase goes on there; one that is cut to a word or a pair was counted as such.
2. Groups.  A fourth scan counts suffixes by slots: by the hash of the first word, of the
   first two words, and so on.  A suffix belongs to its first slot of no more than
   ``budget`` suffixes, so the prefixes are as short as the budget allows.  Slots are
   packed into groups of at most ``budget`` suffixes, first-fit by falling size; a slot
   of one long prefix may exceed it.  A task and the driver hold ``SLOTS`` numbers for
   each length of prefix.
3. Trees.  The last scan sends each suffix, combined with up to ``HELD`` others of its
   task, to its group, where they are sorted and the subtree is read off them in one
   pass: a node is a run of equal beginnings, its total comes from the leaves of the run.
   The pass holds a single path, so the size of a group costs no memory.  A beginning
   shorter than the prefix of its slot also occurs in other groups; its totals are added.

``collocations`` scores phrases by the counts of their parts, in decimals of 38 digits.
Parts are found by a join on whole phrases with a written table, so that Spark can split
the rows of a frequent part.

Keys: words are joined by a zero byte, and their bytes below 9 moved up by one (byte 9 is
in no word), so that byte order is the order of the words.

Defined cases: null and empty texts have no words; a null language is ``und``; rows with
equal ids count on their own; other columns are not read; no phrases give no rows.  A long
text is worked on in parts cut between pieces; a single piece is held whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waycast.llm.common import partitions, ragged, slices, staged

WORD_BITS, PAIR_BITS, TRIPLE_BITS = 1 << 23, 1 << 26, 1 << 26
SLOTS = 1 << 12
BUDGET = 1 << 16
#: Texts are cut into parts of about this many bytes, between pieces.
PART = 1 << 20
#: Suffixes a task combines before it sends them.
HELD = 1_000_000
#: Windows of a language's best phrases before the last one.
SPREAD = 64

_MUL = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)

_KIND = np.zeros(256, np.uint8)  # 0 word, 1 between words, 2 between pieces
_KIND[[0x20, 0x09]] = 1
_KIND[[ord(c) for c in ".,;:!?"]] = 2
_KIND[0x0A:0x0E] = 2
_KEY = np.arange(256, dtype=np.uint8)
_KEY[ord("A") : ord("Z") + 1] += 32
_KEY[:9] += 1


@dataclass
class _Words:
    """The words of some texts; ``letters`` holds their keys, each followed by a zero byte."""

    letters: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    last: np.ndarray  #: whether the word ends its piece
    lang: np.ndarray
    langs: list[str]
    hashes: np.ndarray  #: of the word in its language


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX
    return h ^ (h >> np.uint64(29))


def _followed(h: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Hash of a phrase with the word of hash ``after`` behind it."""
    return _mixed(h * _MUL + after)


def _strings(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    buffers = [None, pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(data.tobytes())]
    return pa.BinaryArray.from_buffers(pa.binary(), len(offsets) - 1, buffers)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[bytes], list[str]]]:
    """Texts and languages in runs of about ``PART`` bytes; a long text is cut between pieces, where there are any."""
    texts, langs, size = [], [], 0
    for batch in slices(batches, "text", PART):
        for raw, lang in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("lang").to_pylist(), strict=True):
            raw, at = raw or b"", 0
            while len(raw) - at > PART:
                gaps = np.flatnonzero(_KIND[np.frombuffer(raw, np.uint8, len(raw) - at - PART, at + PART)] == 2)
                if not len(gaps):
                    break
                yield [raw[at : at + PART + gaps[0]]], [lang]
                at += PART + int(gaps[0])
            texts.append(raw[at:])
            langs.append(lang)
            size += len(raw) - at
            if size > PART:
                yield texts, langs
                texts, langs, size = [], [], 0
    if texts:
        yield texts, langs


def _words(part: tuple[list[bytes], list[str]]) -> _Words | None:
    texts, langs = part
    raw = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    kind = _KIND[raw]
    edges = np.flatnonzero(np.diff((kind == 0).view(np.int8), prepend=np.int8(0)))
    first, end = edges[::2], edges[1::2]  # the last byte is no letter
    if not len(first):
        return None
    piece = np.cumsum(kind == 2)[first]
    names, codes = np.unique(np.array(langs, object).astype(str), return_inverse=True)
    text = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), first, "right")
    lang = codes.reshape(-1)[text]
    keep = kind == 0
    letters = _KEY[raw]
    letters[end] = 0
    keep[end] = True
    letters = letters[keep]
    after = np.cumsum(end - first + 1)
    starts = after - (end - first + 1)
    # with their zero byte, which no word holds
    coded = _strings(letters, np.r_[0, after]).dictionary_encode()
    own = np.array([xxhash.xxh3_64_intdigest(v) for v in coded.dictionary.to_pylist()], np.uint64)[np.asarray(coded.indices)]
    of = np.array([xxhash.xxh3_64_intdigest(x) for x in names.tolist()], np.uint64)[lang]
    return _Words(letters, starts, after - 1, np.diff(piece, append=-1) != 0, lang, names.tolist(), _mixed(own * _MUL + of))


class _Bits:
    """A bit map of hashes."""

    def __init__(self, words: np.ndarray):
        self.words, self.mask = words, np.uint64(len(words) * 64 - 1)

    @classmethod
    def of(cls, hashes: DataFrame, size: int) -> _Bits:
        """From column ``h``; the driver gets the words of the map that are not zero."""
        place = F.pmod(F.col("h"), F.lit(size))
        bit = F.expr(f"shiftleft(1L, cast(pmod(h, {size}) % 64 as int))")
        table = hashes.select(F.shiftright(place, 6).alias("at"), bit.alias("bit")).groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow()
        words = np.zeros(size // 64, np.int64)
        words[np.asarray(table.column("at"))] = np.asarray(table.column("bits"))
        return cls(words.view(np.uint64))

    def has(self, hashes: np.ndarray) -> np.ndarray:
        place = hashes & self.mask
        return (self.words[(place >> np.uint64(6)).view(np.int64)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)


def _word_counts(rows: DataFrame) -> DataFrame:
    """(lang, key, f) of all words; under the empty key the number of words of a language."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words in map(_words, _parts(batches)):
            if words is None:
                continue
            totals = np.bincount(words.lang, minlength=len(words.langs))
            first, key, n = _combined(words, np.arange(len(words.starts)), 1)
            lang = [*words.langs, *(words.langs[i] for i in words.lang[first].tolist())]
            keys = pa.concat_arrays([pa.array([b""] * len(totals), pa.binary()), key])
            yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), keys, pa.array(np.r_[totals, n])], names=["lang", "key", "f"])

    return rows.mapInArrow(work, "lang string, key binary, f long").groupBy("lang", "key").agg(F.sum("f").alias("f"))


def _with_hash(phrases: DataFrame) -> DataFrame:
    """(h) of phrases with equal numbers of words."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            of = np.array([xxhash.xxh3_64_intdigest(x) for x in batch.column("lang").to_pylist()], np.uint64)
            h = None
            for words in zip(*(k.split(b"\0") for k in batch.column("key").to_pylist()), strict=True):
                own = _mixed(np.array([xxhash.xxh3_64_intdigest(w + b"\0") for w in words], np.uint64) * _MUL + of)
                h = own if h is None else _followed(h, own)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64))], names=["h"])

    return phrases.select("lang", "key").mapInArrow(work, "h long")


def _pair_counts(rows: DataFrame, word_bits: _Bits) -> DataFrame:
    """(lang, key, f) of all pairs of frequent words."""
    known = rows.sparkSession.sparkContext.broadcast(word_bits.words)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = _Bits(known.value)
        for words in map(_words, _parts(batches)):
            if words is None:
                continue
            at = _paired(words, bits)
            first, key, n = _combined(words, at, 2)
            lang = pa.array(words.langs, pa.string()).take(pa.array(words.lang[at[first]]))
            yield pa.RecordBatch.from_arrays([lang, key, pa.array(n)], names=["lang", "key", "f"])

    return rows.mapInArrow(work, "lang string, key binary, f long").groupBy("lang", "key").agg(F.sum("f").alias("f"))


def _triples(rows: DataFrame, bits: tuple[_Bits, _Bits], min_count: int) -> DataFrame:
    """(h) of frequent triples of words: the lower half of the hash, since triples that share it only cost work."""
    known = rows.sparkSession.sparkContext.broadcast([b.words for b in bits])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = [_Bits(b) for b in known.value]
        for words in map(_words, _parts(batches)):
            if words is None:
                continue
            _, h = _tripled(words, *of)
            values, n = np.unique(h & np.uint64(0xFFFFFFFF), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(n)], names=["h", "n"])

    return rows.mapInArrow(work, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count).select("h")


def _combined(words: _Words, at: np.ndarray, depth) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Of the suffixes of ``depth`` words at the words ``at``, distinct ones: place in ``at``, key, number."""
    starts, ends = words.starts[at], words.ends[at + depth - 1]
    lengths = ends - starts
    keys = _strings(words.letters[ragged(starts, lengths)], np.r_[0, np.cumsum(lengths)]).dictionary_encode()
    _, first, n = np.unique(words.lang[at].astype(np.int64) << 32 | np.asarray(keys.indices), return_index=True, return_counts=True)
    return first, keys.dictionary.take(keys.indices.take(pa.array(first))), n


def _paired(words: _Words, word_bits: _Bits) -> np.ndarray:
    """Places of frequent words with a frequent one after them in their piece."""
    ok = word_bits.has(words.hashes)
    return np.flatnonzero(ok[:-1] & ok[1:] & ~words.last[:-1])


def _tripled(words: _Words, word_bits: _Bits, pair_bits: _Bits) -> tuple[np.ndarray, np.ndarray]:
    """Places of frequent pairs with a frequent one from their second word on, and the hashes of these triples."""
    at = _paired(words, word_bits)
    h = _followed(words.hashes[at], words.hashes[at + 1])
    ok = pair_bits.has(h)
    at, h = at[ok], h[ok]
    next_too = np.flatnonzero(at[1:] == at[:-1] + 1)
    at = at[next_too]
    return at, _followed(h[next_too], words.hashes[at + 2])


def _suffixes(words: _Words, word_bits: _Bits, pair_bits: _Bits, triple_bits: _Bits, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Places where a suffix of three words or more begins, and how many words it has before a triple that is not frequent."""
    n = len(words.starts)
    go_on = np.zeros(n, bool)
    at, h = _tripled(words, word_bits, pair_bits)
    go_on[at] = triple_bits.has(h)
    stop = np.flatnonzero(~go_on)
    long = np.minimum(stop[np.searchsorted(stop, np.arange(n))] - np.arange(n) + 2, depth)
    at = np.flatnonzero(long > 2)
    return at, long[at]


def _by_length(words: _Words, at: np.ndarray, long: np.ndarray, depth: int) -> Iterator[np.ndarray]:
    """Slot of each suffix by its first word, its first two words and so on; one that ends keeps its hash."""
    h = words.hashes[at]
    for r in range(depth):
        if r:
            further = np.flatnonzero(long > r)
            h[further] = _followed(h[further], words.hashes[at[further] + r])
        yield r * SLOTS + (h >> np.uint64(20) & np.uint64(SLOTS - 1)).astype(np.int64)


def _slots(words: _Words, at: np.ndarray, long: np.ndarray, crowded: np.ndarray) -> np.ndarray:
    """The first slot of each suffix that is not ``crowded``, else the last."""
    depth = len(crowded) // SLOTS
    slot = np.full(len(at), -1)
    for r, own in enumerate(_by_length(words, at, long, depth)):
        settled = (slot < 0) & (~crowded[own] | (r == depth - 1))
        slot[settled] = own[settled]
    return slot


def _packed(sizes: np.ndarray, budget: int) -> np.ndarray:
    """Group of each slot, first-fit by falling size among the last few groups."""
    group, room = np.zeros(len(sizes), np.int64), []
    for slot in np.argsort(-sizes, kind="stable").tolist():
        n = int(sizes[slot])
        g = next((g for g in range(max(0, len(room) - 16), len(room)) if room[g] >= n), len(room))
        if g == len(room):
            room.append(budget)
        group[slot] = g
        room[g] -= n
    return group


def _partitioned(rows: DataFrame, bits: tuple[_Bits, _Bits, _Bits], depth: int, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Whether a slot is crowded, and the group of each slot."""
    known = rows.sparkSession.sparkContext.broadcast([b.words for b in bits])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = [_Bits(b) for b in known.value]
        sizes = np.zeros(depth * SLOTS, np.int64)
        for words in map(_words, _parts(batches)):
            if words is not None:
                for slot in _by_length(words, *_suffixes(words, *of, depth), depth):
                    sizes += np.bincount(slot, minlength=len(sizes))
        used = np.flatnonzero(sizes)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(sizes[used])], names=["slot", "n"])

    counted = rows.mapInArrow(work, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    sizes = np.zeros(depth * SLOTS, np.int64)
    sizes[np.asarray(counted.column("slot"))] = np.asarray(counted.column("n"))
    crowded = sizes > budget
    return crowded, _packed(np.where(crowded & (np.arange(len(sizes)) < (depth - 1) * SLOTS), 0, sizes), budget)


def _leaves(rows: DataFrame, bits: tuple[_Bits, _Bits, _Bits], depth: int, crowded: np.ndarray, groups: np.ndarray) -> DataFrame:
    """(group, shared, lang, key, n): suffixes, and the words that their beginnings may share with other groups."""
    known = rows.sparkSession.sparkContext.broadcast(([b.words for b in bits], crowded, groups))
    names = ["group", "shared", "lang", "key"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maps, crowded, groups = known.value
        of = [_Bits(b) for b in maps]
        held, size = [], 0

        def together() -> Iterator[pa.RecordBatch]:
            whole = pa.concat_tables(held).group_by(names, use_threads=False).aggregate([("n", "sum")])
            yield from whole.select([*names, "n_sum"]).rename_columns([*names, "n"]).combine_chunks().to_batches()

        for words in map(_words, _parts(batches)):
            if words is None:
                continue
            at, long = _suffixes(words, *of, depth)
            first, key, n = _combined(words, at, long)
            slot = _slots(words, at[first], long[first], crowded)
            lang = pa.array(words.langs, pa.string()).take(pa.array(words.lang[at[first]]))
            held.append(pa.table([pa.array(groups[slot]), pa.array((slot // SLOTS).astype(np.int32)), lang, key, pa.array(n)], names=[*names, "n"]))
            size += len(first)
            if size > HELD:
                yield from together()
                held, size = [], 0
        if held:
            yield from together()

    return rows.mapInArrow(work, "group long, shared int, lang string, key binary, n long")


def _nodes(leaves: DataFrame, min_count: int) -> DataFrame:
    """(lang, key, f, whole): the nodes of three words or more of each group's subtree; those that are ``whole`` are frequent."""
    schema = pa.schema([("lang", pa.string()), ("key", pa.binary()), ("f", pa.int64()), ("whole", pa.bool_())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        under, path, totals, shared = None, [], [], 0

        def close(keep: int) -> None:
            while len(path) > keep:
                n, d = totals.pop(), len(path)
                if totals:
                    totals[-1] += n
                if d > 2 and (d <= shared or n >= min_count):
                    out.append((under[1], b"\0".join(path), n, d > shared))
                path.pop()

        for batch in batches:
            for group, r, lang, key, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = key.split(b"\0")
                if (group, lang) != under:
                    close(0)
                    under = group, lang
                same = 0
                for a, b in zip(path, words, strict=False):
                    if a != b:
                        break
                    same += 1
                close(same)
                path.extend(words[same:])
                totals.extend([0] * (len(words) - same))
                totals[-1] += n
                shared = r
            yield arrow_rows(out, schema)
            out.clear()
        close(0)
        yield arrow_rows(out, schema)

    n = partitions(leaves.sparkSession)
    dealt = leaves.repartition(n, "group").sortWithinPartitions("group", "lang", "key")
    return dealt.select("group", "shared", "lang", "key", "n").mapInArrow(work, "lang string, key binary, f long, whole boolean")


def arrow_rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


@dataclass(frozen=True)
class Counts:
    """``phrases`` (lang, key, f): frequent words and phrases; ``totals`` (lang, n): words of each language."""

    phrases: DataFrame
    totals: DataFrame
    depth: int


def count(docs: DataFrame, depth: int = 5, min_count: int = 100, budget: int = BUDGET, text: str = "text", lang: str = "lang") -> Counts:
    """The exact counts of all phrases of up to ``depth`` words that occur ``min_count`` times or more."""
    rows = docs.select(F.col(text).alias("text"), F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"))
    words = staged(_word_counts(rows).where((F.col("f") >= min_count) | (F.octet_length("key") == 0)), "phrase-words")
    empty = F.octet_length("key") == 0
    frequent = words.where(~empty)
    word_bits = _Bits.of(_with_hash(frequent), WORD_BITS)
    pairs = staged(_pair_counts(rows, word_bits).where(F.col("f") >= min_count), "phrase-pairs")
    bits = word_bits, _Bits.of(_with_hash(pairs), PAIR_BITS)
    bits = *bits, _Bits.of(_triples(rows, bits, min_count), TRIPLE_BITS)
    crowded, groups = _partitioned(rows, bits, depth, budget)
    nodes = staged(_nodes(_leaves(rows, bits, depth, crowded, groups), min_count), "phrase-nodes")
    parts = nodes.where("not whole").groupBy("lang", "key").agg(F.sum("f").alias("f")).where(F.col("f") >= min_count)
    every = frequent.unionByName(pairs.where(F.lit(depth > 1))).select("lang", "key", "f").unionByName(nodes.where("whole").select("lang", "key", "f")).unionByName(parts)
    phrases = staged(every.select("lang", F.col("key").cast("string").alias("key"), "f"), "phrase-counts")
    return Counts(phrases, words.where(empty).select("lang", F.col("f").alias("n")), depth)


def _spoken(key):
    """The phrase as it is written, from its key."""
    key = F.replace(key, F.lit("\0"), F.lit(" "))
    for b in range(1, 10):
        key = F.replace(key, F.lit(chr(b)), F.lit(chr(b - 1)))
    return key


def collocations(counts: Counts, share: int = 100, top: int = 2000) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases of two words or more.

    Cutting a phrase in two gives floor(1000 a n / (l r)) from its count ``a``, those of the
    parts and the number ``n`` of words; the cut with the lowest score counts, of equals the
    first.  A phrase goes if one that contains it has ``share`` percent of its count; it is
    enough to look at those with one word more, which occur as often as any longer one.
    """
    words = F.split("key", "\0")
    own = counts.phrases.select("lang", "key", "f", words.alias("w")).where(F.size("w") > 1)
    join = lambda a, n: F.array_join(F.slice("w", a, n), "\0")
    cuts = own.select("lang", "key", "w", F.explode(F.sequence(F.lit(1), F.size("w") - 1)).alias("k"))
    sides = F.explode(F.array(
        F.struct(F.lit("l").alias("side"), join(F.lit(1), F.col("k")).alias("part")),
        F.struct(F.lit("r").alias("side"), join(F.col("k") + 1, F.size("w") - F.col("k")).alias("part")),
    )).alias("s")
    parts = cuts.select("lang", F.col("key").alias("phrase"), "k", sides).select("lang", "phrase", "k", "s.side", F.col("s.part").alias("key"))
    found = parts.join(counts.phrases, ["lang", "key"]).select("lang", "phrase", "k", "side", "f")
    shorter = F.explode(F.array(join(F.lit(1), F.size("w") - 1), join(F.lit(2), F.size("w") - 1)))
    longer = own.where(F.size("w") > 2).select("lang", shorter.alias("phrase"), F.lit(0).alias("k"), F.lit("longer").alias("side"), "f")
    itself = own.select("lang", F.col("key").alias("phrase"), F.lit(0).alias("k"), F.lit("a").alias("side"), "f")
    pick = lambda side, k: F.max(F.when((F.col("side") == side) & (F.col("k") == k), F.col("f")))
    lengths = range(1, counts.depth)
    sums = [pick("a", 0).alias("a"), pick("longer", 0).alias("longer"), *(pick(s, k).alias(f"{s}{k}") for k in lengths for s in "lr")]
    table = found.unionByName(longer).unionByName(itself).groupBy("lang", "phrase").agg(*sums)
    exact = lambda c: F.col(c).cast("decimal(19,0)")
    table = table.where("longer is null or 100 * longer < a * " + str(int(share))).join(counts.totals, "lang")
    table = table.withColumn("over", F.lit(1000).cast("decimal(4,0)") * exact("a") * exact("n"))
    scored = [
        F.when(F.col(f"l{k}").isNotNull(), F.struct(F.expr(f"over div (cast(l{k} as decimal(19,0)) * cast(r{k} as decimal(19,0)))").alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")))
        for k in lengths
    ]
    best = F.least(*scored) if len(scored) > 1 else scored[0]
    rows = table.select("lang", _spoken(F.col("phrase")).alias("phrase"), "a", "n", best.alias("best")).select("lang", "phrase", "a", "best.l", "best.r", "n", "best.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SPREAD))
    rows = rows.withColumn("salt", salt).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= top)
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return rows.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
