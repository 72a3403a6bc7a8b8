"""Groups of spelling variants, by walking a trie of all words with one edit to spare.

``counted`` gives the words and how often they occur.  ``trie`` stores them as an edge
table: a node is a beginning that words part at or end in (a chain of nodes with one
child is one edge with a longer label), named by the hash of its letters.

``near`` finds the words one edit apart.  Its frontier is a table of states (word,
position, node, edits).  Level by level it is joined with the edges of that level:

* a state goes on along the edge that spells the word's next letters;
* a state without an edit also crosses every edge whose first letter is larger than the
  word's own (a replaced letter), and skips one letter (a deleted one).  Larger letters
  and deletions are enough, since the other word finds the rest; letters differ from the
  trie's only at its nodes, and of equal neighbouring letters the last is deleted, so
  every pair is found once;
* a state whose next letter no edge of its node begins with is dropped before it is
  written; one whose word ends at a node where another word ends is a pair.

Every level is written to the shared folder and read back; there are as many levels as
the longest chain of partings, whatever the length of words.  The node that a state has
reached is compared with the letters it must stand for, so equal hashes make no pair.

Skew: beginnings such as the root are shared by all words.  An edge knows how many words
pass below its node; crowded nodes have their edges copied once per ``CROWD`` words and
their states dealt over the copies.  A node has as many edges as there are letters.

``variants`` names for each word the far more frequent word near it, and the last word
of that chain, found by pointer jumping.

Defined cases: null and empty texts have no words; rows with equal ids count on their
own; a null id counts as the empty text in the hash that misspells; other columns are not
read; no words give no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waycast.llm.common import slices, staged

CROWD = 20_000
#: Long texts are counted in parts of about this many characters, cut between words.
PART = 4 << 20

_LETTERS = "a-zÀ-ÿ"
_GAP = re.compile(f"[^{_LETTERS}]")


def _parts(text: str) -> Iterator[str]:
    at = 0
    while len(text) - at > PART:
        gap = _GAP.search(text, at + PART)
        if not gap:
            break
        yield text[at : gap.start()]
        at = gap.start()
    yield text[at:]


def counted(docs: DataFrame, min_chars: int = 6, min_count: int = 5, slip: int | None = None, text: str = "text") -> DataFrame:
    """(word, n): the runs of letters of all texts, A-Z in lower case, that are long and frequent enough.

    With ``slip``, a run of a document loses a letter if ``slip`` divides the crc32 h of
    ``<doc_id>:<run>``: that at position h modulo the run's length.
    """
    runs = re.compile(f"[{_LETTERS}]{{{max(1, min_chars)},}}")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 8 << 20):
            total: Counter[str] = Counter()
            texts = batch.column("text").cast(pa.binary())
            for doc_id, raw in zip(batch.column("doc_id").to_pylist(), texts, strict=True):
                raw = raw.as_py()
                if not raw:
                    continue
                own = Counter()
                for part in _parts(raw.lower().decode()):
                    own.update(runs.findall(part))
                if not slip:
                    total.update(own)
                    continue
                begin = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for run, n in own.items():
                    h = zlib.crc32(run.encode(), begin)
                    if h % slip == 0:
                        at = h % len(run)
                        run = run[:at] + run[at + 1 :]
                        if len(run) < min_chars:
                            continue
                    total[run] += n
            yield pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], names=["word", "n"])

    rows = docs.select("doc_id", F.col(text).alias("text")).mapInArrow(work, "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _salts(below):
    return F.ceil(below / F.lit(CROWD)).cast("int")


def _salt(salts):
    return F.pmod(F.xxhash64("word"), salts).cast("int")


def trie(words: DataFrame) -> DataFrame:
    """(level, node, salt, ch, label, child, next, term, term_n, salts): one row per edge and copy of it.

    ``ch`` is the first letter of ``label``; ``next`` the first letters of the child's own
    edges; ``term`` the word that ends at the child and ``term_n`` its count; ``salts`` the
    number of copies of the child's own edges.
    """
    word, p = F.col("word"), F.col("p")
    begins = words.select("word", "n", F.explode(F.sequence(F.lit(0), F.length("word"))).alias("p"))
    begins = begins.select("word", "n", "p", F.substring(word, F.lit(1), p).alias("begin"), F.substring(word, p + 1, F.lit(1)).alias("ch"))
    begins = begins.select("word", "n", "p", F.xxhash64("begin").alias("node"), "ch")
    ends = F.col("ch") == ""
    nodes = begins.groupBy("node").agg(
        F.count(F.lit(1)).alias("below"), F.min("ch").alias("first"), F.max("ch").alias("last"), F.array_join(F.collect_set("ch"), "").alias("next"),
        F.max(F.when(ends, word)).alias("term"), F.max(F.when(ends, F.col("n"))).alias("term_n"), F.min("p").alias("p"),
    )
    nodes = staged(nodes.where("first != last or first = '' or p = 0").drop("first", "last", "p"), "trie-nodes")
    stops = begins.select("word", "p", "node").join(nodes.select("node"), "node", "left_semi")
    paths = stops.groupBy("word").agg(F.sort_array(F.collect_list("p")).alias("stops"))
    steps = paths.where(F.size("stops") > 1).select("word", "stops", F.explode(F.sequence(F.lit(0), F.size("stops") - 2)).alias("level"))
    a, b = F.get("stops", F.col("level")), F.get("stops", F.col("level") + 1)
    steps = steps.select("level", "word", a.alias("a"), b.alias("b"))
    edges = steps.select(
        "level",
        F.xxhash64(F.substring(word, F.lit(1), F.col("a"))).alias("node"), F.xxhash64(F.substring(word, F.lit(1), F.col("b"))).alias("child"),
        F.substring(word, F.col("a") + 1, F.col("b") - F.col("a")).alias("label"),
    ).distinct()
    child = nodes.select(F.col("node").alias("child"), "next", "term", "term_n", _salts(F.col("below")).alias("salts"))
    own = nodes.select("node", F.explode(F.sequence(F.lit(0), _salts(F.col("below")) - 1)).alias("salt"))
    return edges.join(child, "child").join(own, "node").select(
        "level", "node", "salt", F.substring("label", 1, 1).alias("ch"), "label", "child", "next", "term", "term_n", "salts"
    )


def _arrived(rows: DataFrame, edits, at, put) -> DataFrame:
    """States at the child's node, with ``pos`` after its label; those that can neither go on nor end there are left out."""
    rows = rows.select(
        "word", "n", F.col("after").alias("pos"), F.col("child").alias("node"), _salt(F.col("salts")).alias("salt"),
        edits.cast("int").alias("edits"), at.cast("int").alias("at"), put.cast("string").alias("put"), "next", "term", "term_n",
    )
    return _alive(rows)


def _alive(rows: DataFrame) -> DataFrame:
    end = F.col("pos") == F.length("word")
    on = F.instr(F.col("next"), F.substring(F.col("word"), F.col("pos") + 1, F.lit(1))) > 0
    return rows.where((end & (F.col("edits") == 1) & F.col("term").isNotNull()) | (~end & (on | (F.col("edits") == 0))))


def near(words: DataFrame) -> DataFrame:
    """(word, n, other, other_n): each pair of words exactly one inserted, deleted or replaced letter apart, once."""
    spark = words.sparkSession
    edges = staged(trie(words), "trie-edges")
    root = edges.where("level = 0").select("node", "salt", "ch")
    about = root.groupBy("node").agg((F.max("salt") + 1).alias("salts"), F.array_join(F.collect_set("ch"), "").alias("next")).first()
    found = spark.createDataFrame([], "word string, n long, other string, other_n long")
    if about is None:
        return found
    none = F.lit(None)
    states = words.select(
        "word", "n", F.lit(0).alias("pos"), F.lit(about["node"]).alias("node"), _salt(F.lit(about["salts"])).alias("salt"), F.lit(0).alias("edits"),
        none.cast("int").alias("at"), none.cast("string").alias("put"), F.lit(about["next"]).alias("next"), none.cast("string").alias("term"), none.cast("long").alias("term_n"),
    )
    word, pos, level = F.col("word"), F.col("pos"), 0
    own, second = F.substring(word, pos + 1, F.lit(1)), F.substring(word, pos + 2, F.lit(1))
    while states is not None:
        here = edges.where(F.col("level") == level).select("node", "salt", "ch", "label", "child", *(F.col(c).alias(f"to_{c}") for c in ("next", "term", "term_n", "salts")))
        zero = states.where("edits = 0")
        skipped = zero.where(own != second).withColumns({"edits": F.lit(1), "at": pos, "put": F.lit(""), "pos": pos + 1})
        one = states.where("edits = 1").unionByName(_alive(skipped))
        end = F.col("pos") == F.length("word")
        other = F.concat(F.substring(word, F.lit(1), F.col("at")), F.col("put"), F.substring(word, F.col("at") + 2, F.length("word")))
        pairs = one.where(end).select("word", "n", other.alias("other"), "term", F.col("term_n").alias("other_n")).where("other = term")

        def step(left: DataFrame, on: list, test, passed, here=here) -> DataFrame:
            left = left.drop("next", "term", "term_n").withColumns({"own": own})
            rows = left.join(here, on).where(test).withColumn("after", pos + F.length("label"))
            rows = rows.withColumnsRenamed({f"to_{c}": c for c in ("next", "term", "term_n", "salts")})
            return _arrived(rows, *passed)

        rest = F.substring(word, pos + 2, F.length("label") - 1) == F.substring(F.col("label"), F.lit(2), F.length("label"))
        same = F.col("own") == F.col("ch")
        edit = lambda if_same, if_not: F.when(same, if_same).otherwise(if_not)
        forward = step(zero, ["node", "salt"], (F.col("ch") >= F.col("own")) & rest, (edit(F.lit(0), F.lit(1)), edit(none, pos), edit(none, F.col("ch"))))
        along = one.where(~end).withColumn("ch", own)
        forward = forward.unionByName(step(along, ["node", "salt", "ch"], rest, (F.lit(1), F.col("at"), F.col("put"))))
        out = staged(
            forward.withColumns({"other": none.cast("string"), "other_n": none.cast("long")}).unionByName(pairs.drop("term"), allowMissingColumns=True), "trie-level"
        )
        found = found.unionByName(out.where("other is not null").select("word", "n", "other", "other_n"))
        states = out.where("other is null").drop("other", "other_n")
        states = None if states.isEmpty() else states
        level += 1
    return found


def _roots(links: DataFrame) -> DataFrame:
    """(word, root) of the forest (word, form): the last word of each chain.  Forms are more frequent than their words, so chains end."""
    roots = staged(links.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "form-roots")
    while not roots.where("moved").isEmpty():
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        joined = roots.join(ahead, "root", "left")
        roots = staged(joined.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "form-roots")
    return roots.select("word", "root")


def variants(words: DataFrame, ratio: int = 5) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of all ``words``.

    ``form`` is the word one edit away with the largest count (of equal counts the first
    in code-point order) if that is at least ``ratio`` times the word's own, ``root`` the
    last word that forms lead to, ``n_near`` the number of words one edit away.
    """
    words = staged(words, "trie-words")
    pairs = near(words)
    both = pairs.select("word", "other", "other_n").unionByName(pairs.select(F.col("other").alias("word"), F.col("word").alias("other"), F.col("n").alias("other_n")))
    best = F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("form")))
    nearest = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    rows = words.join(nearest, "word", "left").withColumn("form_n", -F.col("best.less"))
    far = F.col("form_n") >= ratio * F.col("n")
    rows = staged(rows.select("word", F.when(far, F.col("best.form")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(far, F.col("form_n")).alias("form_n")), "forms")
    roots = _roots(rows.where("form is not null").select("word", "form"))
    return rows.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
