"""Cutting routes into time chunks of a bounded number of rows.

Everything stateful here is ordered per route, and one route may hold a third of
all rows.  All events are therefore dealt into ranges of ``(route, seq)`` with
about ``rows_per_chunk`` rows each and written once; Spark finds the borders by
sampling rows, so gaps, bursts and outliers in ``seq`` do not matter.  A route that
lies in several ranges is cut there: its ranges are its chunks, numbered from 0.
All other routes have chunk 0 only.  Later work is shuffled on ``(route, chunk)``,
and what a chunk must know about the rest of its route arrives as a few extra rows:
the state left by earlier chunks, or the first row of the next one.

No step joins events on the bare route.  The table of cut routes has at most two
rows per range and is joined on route and range, a key that holds one range at most.

Incomplete events (``streams.is_complete``) are left out here, once for all users.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waycast.operators.streams import is_complete
from waycast.schemas import ROUTE
from waycast.session import staged

ROWS_PER_CHUNK = 250_000
# Ranges beyond this number only cost: every task streams its chunk, however long.
MOST_CHUNKS = 20_000
ROWS_PER_FILE = 100_000

GROUP = [*ROUTE, "chunk"]


@dataclass
class ChunkedEvents:
    """Events with ``chunk`` and ``last_chunk``; ``grid`` has a row per chunk of every cut route, ``ranges`` is their number."""

    events: DataFrame
    grid: DataFrame | None = None
    ranges: int = 0

    @property
    def is_cut(self) -> bool:
        return self.grid is not None

    def dealt(self, frame: DataFrame) -> DataFrame:
        """Rows with their chunk, for windows by chunk: in a partition per range, if the session's number is less.

        A window sorts its whole partition, so a fixed number of them would need memory
        with the size of the input.
        """
        if self.ranges <= int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions")):
            return frame
        return frame.repartition(self.ranges, *GROUP)

    def cut_only(self, frame: DataFrame) -> DataFrame:
        return frame.filter(F.col("last_chunk") > 0)


def cut_into_chunks(events: DataFrame, rows_per_chunk: int = ROWS_PER_CHUNK,
                    count_from: DataFrame | None = None) -> ChunkedEvents:
    """Number the chunks.

    Runs at once: a count of the events (of ``count_from`` if given, a frame that is
    cheap to count and has at least as many rows) and, if they fill more than one range,
    the write that deals them out.
    """
    events = events.filter(is_complete())
    total = (events if count_from is None else count_from).count()
    if total <= rows_per_chunk:
        zero = F.lit(0).cast("bigint")
        return ChunkedEvents(events.withColumn("chunk", zero).withColumn("last_chunk", zero))
    ranges = min(math.ceil(1.25 * total / rows_per_chunk), MOST_CHUNKS)
    files = max(events.sparkSession.sparkContext.defaultParallelism, total // ROWS_PER_FILE)
    dealt = staged(
        events.repartitionByRange(ranges, *ROUTE, "seq")
        .withColumn("_range", F.spark_partition_id().cast("bigint")).coalesce(files), "chunks"
    )
    spans = dealt.groupBy(*ROUTE).agg(F.min("_range").alias("_first"), F.max("_range").alias("_last"))
    grid = staged(
        spans.filter(F.col("_last") > F.col("_first")).select(
            *ROUTE, "_first", (F.col("_last") - F.col("_first")).alias("_length"),
            F.explode(F.sequence("_first", "_last")).alias("_range")), "chunk-grid"
    )
    zero = F.lit(0).cast("bigint")
    numbered = dealt.join(grid, [*ROUTE, "_range"], "left").select(
        *events.columns, F.coalesce(F.col("_range") - F.col("_first"), zero).alias("chunk"),
        F.coalesce("_length", zero).alias("last_chunk"),
    )
    return ChunkedEvents(numbered, grid.select(
        *ROUTE, F.col("_length").alias("last_chunk"), (F.col("_range") - F.col("_first")).alias("chunk")), ranges)


def first_row_of_next_chunk(frame: DataFrame, keys: list[str], order: str) -> DataFrame:
    """For a key seen in several chunks: per chunk, where its next row lies.

    Returned rows carry ``keys``, the chunk they belong to and, in ``order``, the
    position of the key's first row in a later chunk.  Added to that chunk they
    let a plain ``lead`` see across the cut.
    """
    by_key = Window.partitionBy(*keys).orderBy("chunk")
    return (
        frame.groupBy(*keys, "chunk", "last_chunk")
        .agg(F.min(order).alias("_first"))
        .withColumn(order, F.lead("_first").over(by_key))
        .filter(F.col(order).isNotNull())
        .drop("_first")
    )


def aligned_blocks(begin: Column, end: Column, levels: Column) -> Column:
    """An array of (level, block): the blocks of ``2 ** level`` numbers that make up ``begin`` to ``end``, without ``end``."""

    def of(level: Column) -> Column:
        size = F.pow(F.lit(2), level).cast("bigint")
        first, last = F.ceil(begin / size), F.floor(end / size)
        return F.filter(
            F.array(
                F.struct(level.alias("level"), F.when(first % 2 == 1, first).alias("block")),
                F.struct(level.alias("level"), F.when(last % 2 == 1, last - 1).alias("block")),
            ),
            lambda b: b["block"].isNotNull() & (first < last),
        )

    return F.flatten(F.transform(levels, of))
