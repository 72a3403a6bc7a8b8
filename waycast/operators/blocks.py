"""The best travel over time in built-in functions only.

The form of ``timeline.best_timeline`` without a Python worker: the same rows, about
``2 log n`` rows shuffled per entry and ``log n`` per event instead of one, ``n`` being the
rows of a chunk.  Use it where Python workers are not to be had, or to check the other.

Rows of a chunk are numbered in order.  An entry holds for a stretch of numbers, written
as aligned blocks of 1, 2, 4, ... rows, two per size at most; each block keeps the best of
its entries.  What is best after a row is the best of the blocks the row lies in, one per
size.  A join key is a block, which at most the rows of one chunk ask.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waycast import schemas as S
from waycast.operators.chunks import GROUP, ChunkedEvents, aligned_blocks
from waycast.operators.streams import is_update
from waycast.operators.timeline import ADDED, PAYLOAD, carried_entries, is_closing, timetable_events


def best_timeline(cut: ChunkedEvents) -> DataFrame:
    """Every timetable event with the best entries around it, in the columns of ``timeline.best_timeline``."""
    rows = timetable_events(cut.events)
    if cut.is_cut:
        rows = rows.unionByName(carried_entries(rows, cut))
    in_order = Window.partitionBy(*GROUP).orderBy("seq")
    by_travel = Window.partitionBy(*GROUP, "travel_id").orderBy("seq")
    placed = rows.withColumns({"place": F.row_number().over(in_order).cast("bigint"), "n": F.count(F.lit(1)).over(Window.partitionBy(*GROUP))})
    levels = F.sequence(F.lit(0), F.ceil(F.log2(F.col("n") + 2)).cast("int"))
    until = F.coalesce(F.lead("place").over(by_travel), F.col("n") + 1)
    spans = placed.withColumn("until", until).filter(F.col("entry").isNotNull())
    rank = F.struct("entry.arrival_time", "entry.travel_id")
    best_of_block = (
        spans.select(*GROUP, "entry", F.explode(aligned_blocks(F.col("place"), F.col("until"), levels)).alias("b"))
        .groupBy(*GROUP, "b.level", "b.block").agg(F.min_by("entry", rank).alias("entry"))
    )
    asked = placed.select(*GROUP, "place", F.explode(levels).alias("level")).withColumn("block", F.floor(F.col("place") / F.pow(F.lit(2), F.col("level"))))
    after = asked.join(best_of_block, [*GROUP, "level", "block"]).groupBy(*GROUP, "place").agg(F.min_by("entry", rank).alias("after"))
    known = placed.join(after, [*GROUP, "place"], "left").withColumn("before", F.lag("after").over(in_order))
    earlier = in_order.rowsBetween(Window.unboundedPreceding, -1)
    own_update = is_update() & ~F.col("carried")
    updated = F.last(F.when(own_update, F.struct("seq", F.col("before.travel_id").alias("moved_from"))), ignorenulls=True).over(earlier)
    closed = F.last(F.when(is_closing(), F.col("seq")), ignorenulls=True).over(earlier)
    done = known.withColumns({"closed_at": closed, "updated": updated})
    done = done.withColumns({"updated_at": F.col("updated.seq"), "updated_from": F.col("updated.moved_from")})
    return done.filter(~F.col("carried") & F.col(S.ROUTE[0]).isNotNull()).select(*GROUP, *PAYLOAD, *ADDED)
