"""Connected components of a graph that no machine holds, by alternating stars.

``components(edges)`` takes columns ``a`` and ``b`` (long) and returns ``node`` and
``root``, the smallest node of its component, for every node of an edge.  Each
round links every node to the smallest neighbour it knows, first over larger and
then over smaller neighbours; the graph becomes one star per component in a few
rounds.  Every round is written to the shared folder and read back; the driver
sees only a row count and a sum of hashes.  Self loops and repeated edges do no
harm; no edges give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waycast.llm.common import staged

SALTS = 16


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def _round(edges: DataFrame) -> DataFrame:
    """``edges``: distinct pairs with a > b."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    # the centre of a star may have very many neighbours: they are dealt out over SALTS tasks
    salted = both.where("b > a").withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(SALTS)).cast("int"))
    copies = least.withColumn("salt", F.explode(F.array(*map(F.lit, range(SALTS)))))
    large = salted.join(copies, ["a", "salt"]).select(F.col("b").alias("a"), F.col("m").alias("b"))
    lower = large.groupBy("a").agg(F.min("b").alias("m"))
    small = large.join(lower, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return small.unionByName(lower.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    pairs = edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    pairs = staged(pairs, "links")
    before = _state(pairs)
    while before[0]:
        pairs = staged(_round(pairs), "links")
        now = _state(pairs)
        if now == before:
            break
        before = now
    roots = pairs.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
