"""The best travel of a route before and after each timetable event.

The best travel is the least ``(arrival_time, travel_id)`` among entries that
are live, where an update opens or replaces an entry and a departure closes it.
A running minimum whose members can also leave is the one thing the built-in
window functions cannot express without pairing every event with every live
travel, so the ordered pass is an Arrow function; Spark deals out and sorts the
rows by ``(route, chunk)`` and ``seq``, and the pass streams through them.  Requests never pass through it.

A departure of the best travel is a *closing* departure.  Closing departures
cut a route into epochs; an epoch is named by the closing departure before it.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waycast import schemas as S
from waycast.operators.chunks import GROUP, ChunkedEvents, aligned_blocks
from waycast.operators.streams import is_update

PAYLOAD = ["seq", "ts", "kind", "id", "travel_id", "last_chunk"]
ADDED = ["before", "after", "closed_at", "updated_at", "updated_from"]
NO_EPOCH = -1


def is_closing() -> Column:
    """The departing travel was the best one at that moment."""
    return (F.col("kind") == S.DEPARTURE) & (F.col("travel_id") == F.col("before.travel_id"))


def opens_timetable() -> Column:
    """An update that finds the timetable empty: it serves the waiting requests."""
    return is_update() & F.col("before").isNull()


class _Live:
    """The open entries of one chunk while its rows pass; entries are numbers of rows."""

    def __init__(self) -> None:
        self.entries: dict[str, int] = {}
        self.heap: list[tuple[int, str, int]] = []
        self.best: tuple[int, str] | None = None  # row and travel
        self.closed = self.updated = self.moved_from = None

    def open(self, row: int, travel: str, arrival: int) -> None:
        self.entries[travel] = row
        heapq.heappush(self.heap, (arrival, travel, row))

    def settle(self) -> None:
        while self.heap and self.entries.get(self.heap[0][1]) != self.heap[0][2]:
            heapq.heappop(self.heap)  # replaced or departed since it was pushed
        self.best = (self.heap[0][2], self.heap[0][1]) if self.heap else None

    def renumber(self) -> list[int]:
        """The rows of the open entries, which get the numbers 0, 1, ... from now on."""
        rows = sorted(self.entries.values())
        place = {row: i for i, row in enumerate(rows)}
        self.heap = [(a, t, place[r]) for a, t, r in self.heap if self.entries.get(t) == r]
        self.entries = {t: place[r] for t, r in self.entries.items()}
        heapq.heapify(self.heap)
        self.settle()
        return rows


def best_around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by chunk and ``seq`` in; the same rows with what held around them out.

    Added are ``before`` and ``after`` (best entries), ``closed_at`` (last closing
    departure) and ``updated_at``/``updated_from`` (last update and the travel it
    moved from).  A chunk may run over any number of batches; between them only its
    open entries are kept.
    """
    group, live, kept = None, _Live(), None
    for batch in batches:
        table = pa.Table.from_batches([batch]).combine_chunks()
        if not table.num_rows:
            continue
        entry = table["entry"].combine_chunks()
        shift = 0 if kept is None else len(kept)
        entries = entry if not shift else pa.concat_arrays([kept, entry])
        arrivals = pc.struct_field(entry, "arrival_time").cast(pa.int64()).to_pylist()
        opens, carried = entry.is_valid().to_pylist(), table["carried"].to_pylist()
        seqs, travels = table["seq"].to_pylist(), table["travel_id"].to_pylist()
        before, after, closed, updated, moved = [], [], [], [], []
        for i, key in enumerate(zip(*(table[c].to_pylist() for c in GROUP), strict=True)):
            if key != group:
                group, live = key, _Live()
            best, travel = live.best, travels[i]
            before.append(best and best[0])
            closed.append(live.closed)
            updated.append(live.updated)
            moved.append(live.moved_from)
            if opens[i]:
                live.open(shift + i, travel, arrivals[i])
                if not carried[i]:
                    live.updated, live.moved_from = seqs[i], best and best[1]
            elif live.entries.pop(travel, None) is not None and best and best[1] == travel:
                live.closed = seqs[i]
            live.settle()
            after.append(live.best and live.best[0])
        added = [
            entries.take(pa.array(before, pa.int64())), entries.take(pa.array(after, pa.int64())),
            pa.array(closed, pa.int64()), pa.array(updated, pa.int64()), pa.array(moved, pa.string()),
        ]
        names = [*GROUP, *PAYLOAD]
        done = pa.Table.from_arrays([*(table[c] for c in names), *added], names=[*names, *ADDED])
        yield from done.filter(pc.invert(table["carried"])).to_batches()
        kept = entries.take(pa.array(live.renumber(), pa.int64()))


def timetable_events(events: DataFrame) -> DataFrame:
    """Updates and departures, with the entry an update brings."""
    return events.filter(F.col("kind").isin(*S.UPDATE_KINDS, S.DEPARTURE)).select(
        *GROUP, *PAYLOAD,
        F.when(is_update(), F.struct(
            "travel_id", F.col("kind").alias("travel_type"), "departure_time", "arrival_time",
        )).alias("entry"),
        F.lit(False).alias("carried"),
    )


def best_timeline(cut: ChunkedEvents) -> DataFrame:
    """Every timetable event with the best entries around it.

    ``closed_at``, ``updated_at`` and ``updated_from`` are known within the chunk
    only; :func:`with_openings` completes them.
    """
    rows = timetable_events(cut.events)
    if cut.is_cut:
        rows = rows.unionByName(carried_entries(rows, cut))
    fields = {f.name: f.dataType for f in rows.schema.fields}
    kinds = [fields["entry"], fields["entry"], T.LongType(), T.LongType(), T.StringType()]
    out = T.StructType([T.StructField(c, fields[c]) for c in [*GROUP, *PAYLOAD]]
                       + [T.StructField(c, t) for c, t in zip(ADDED, kinds, strict=True)])
    timeline = cut.dealt(rows.repartition(*GROUP)).sortWithinPartitions(*GROUP, "seq").mapInArrow(best_around, out)
    # Spark cannot know what the function returns.  Stating that routes are set
    # gives every user of the timeline the same plan, so shuffles above it are shared.
    return timeline.filter(F.col("departure_location").isNotNull() & F.col("arrival_location").isNotNull())


def chunk_openings(timeline: DataFrame, cut: ChunkedEvents) -> DataFrame:
    """Per chunk of a cut route, what its earlier chunks end with."""
    left = cut.cut_only(timeline).groupBy(*GROUP).agg(
        F.max_by(F.struct("after"), "seq").alias("o_state"),
        F.max(F.when(is_closing(), F.struct("seq", "chunk"))).alias("o_closed"),
        F.max(F.when(is_update(), F.struct("seq", F.col("before.travel_id").alias("moved_from")))).alias("o_updated"),
    )
    earlier = Window.partitionBy(*S.ROUTE).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    kept = ["o_state", "o_closed", "o_updated"]
    return (
        cut.grid.join(left, GROUP, "left")
        .select(*GROUP, "last_chunk", *[F.last(c, ignorenulls=True).over(earlier).alias(c) for c in kept])
        .filter(F.col("chunk") > 0)
    )


def with_openings(timeline: DataFrame, openings: DataFrame | None, cut: ChunkedEvents) -> DataFrame:
    """Timeline with ``epoch`` and its first chunk; chunk borders bridged."""
    none = F.lit(NO_EPOCH).cast("bigint")
    if openings is None:
        return timeline.select(
            "*", F.coalesce("closed_at", none).alias("epoch"), F.col("chunk").alias("epoch_chunk")
        ).drop("closed_at")
    bridged = timeline.join(openings.drop("last_chunk"), GROUP, "left")
    return bridged.select(
        *GROUP, *PAYLOAD, "before", "after",
        F.coalesce("updated_at", "o_updated.seq").alias("updated_at"),
        F.when(F.col("updated_at").isNull(), F.col("o_updated.moved_from"))
        .otherwise(F.col("updated_from")).alias("updated_from"),
        F.coalesce("closed_at", "o_closed.seq", none).alias("epoch"),
        F.when(F.col("closed_at").isNotNull(), F.col("chunk"))
        .otherwise(F.coalesce("o_closed.chunk", F.lit(0).cast("bigint"))).alias("epoch_chunk"),
    )


def carried_entries(rows: DataFrame, cut: ChunkedEvents) -> DataFrame:
    """What earlier chunks of a cut route leave for a later one.

    An entry still open at the end of its chunk reaches the next chunk that
    touches its travel as itself.  Chunks in between only need the best of all
    such entries, because none of them can change there.
    """
    by_travel = Window.partitionBy(*S.ROUTE, "travel_id").orderBy("chunk")
    open_entries = (
        cut.cut_only(rows)
        .groupBy(*GROUP, "last_chunk", "travel_id")
        .agg(F.max_by(F.struct("seq", "entry"), "seq").alias("last"))
        .withColumn("touched", F.coalesce(F.lead("chunk").over(by_travel), F.col("last_chunk") + 1))
        .filter(F.col("last.entry").isNotNull())
        .select(*S.ROUTE, "last_chunk", "travel_id", "last.*",
                (F.col("chunk") + 1).alias("begin"), F.col("touched").alias("end"))
    )
    touched = open_entries.filter(F.col("end") <= F.col("last_chunk")).withColumn("chunk", F.col("end"))
    carried = touched.unionByName(_best_untouched(open_entries, cut), allowMissingColumns=True)
    no_text = F.lit(None).cast("string")
    return carried.select(
        *GROUP, "seq", F.lit(None).cast("timestamp_ntz").alias("ts"), no_text.alias("kind"),
        no_text.alias("id"), "travel_id", "last_chunk", "entry", F.lit(True).alias("carried"),
    )


def _best_untouched(spans: DataFrame, cut: ChunkedEvents) -> DataFrame:
    """Per chunk, the best entry among those open all through it.

    Each span of chunks is written as aligned blocks of 1, 2, 4, ... chunks (two
    per size at most), so a long-lived entry costs a handful of rows and not one
    per chunk.  A chunk then asks only the blocks it lies in.
    """
    levels = F.sequence(F.lit(0), F.ceil(F.log2(F.col("last_chunk") + 2)).cast("int"))

    best_of_block = (
        spans.filter(F.col("begin") < F.col("end"))
        .select(*S.ROUTE, "travel_id", "seq", "entry",
                F.explode(aligned_blocks(F.col("begin"), F.col("end"), levels)).alias("b"))
        .groupBy(*S.ROUTE, "b.level", "b.block")
        .agg(F.min_by(F.struct("travel_id", "seq", "entry"),
                      F.struct("entry.arrival_time", "travel_id")).alias("best"))
    )
    asked = cut.grid.select("*", F.explode(levels).alias("level")).withColumn(
        "block", F.floor(F.col("chunk") / F.pow(F.lit(2), F.col("level")))
    )
    found = asked.join(best_of_block, [*S.ROUTE, "level", "block"])
    return (
        found.groupBy(*GROUP, "last_chunk")
        .agg(F.min_by("best", F.struct("best.entry.arrival_time", "best.travel_id")).alias("best"))
        .select(*GROUP, "last_chunk", "best.*")
    )
