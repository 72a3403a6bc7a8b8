"""Timetable entries: upsert, validity, snapshot, best per route."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waycast import schemas as S
from waycast.operators.chunks import GROUP, ChunkedEvents, first_row_of_next_chunk
from waycast.operators.streams import is_complete, is_update
from waycast.session import staged

TRAVEL = [*S.ROUTE, "travel_id"]
TIMES = ["departure_time", "arrival_time"]


def entries(trains: DataFrame, planes: DataFrame) -> DataFrame:
    """Both update types as one: the update's columns and ``travel_type``."""
    return trains.withColumn("travel_type", F.lit(S.TRAIN)).unionByName(
        planes.withColumn("travel_type", F.lit(S.PLANE))
    )


def latest(events: DataFrame) -> DataFrame:
    """Last update per travel; aggregated before the shuffle."""
    return (
        events.filter(is_complete() & is_update()).groupBy(*TRAVEL)
        .agg(F.max_by(F.struct(F.col("id").alias("update_id"), F.col("kind").alias("travel_type"), *TIMES, "seq"),
                      "seq").alias("u"))
        .select(*TRAVEL, "u.*")
    )


def live(events: DataFrame) -> DataFrame:
    """Entries left once departures have taken theirs away.

    A travel's last event decides, so one aggregation does what an anti join
    against later departures would.
    """
    return (
        events.filter(is_complete() & (F.col("kind") != S.REQUEST)).groupBy(*TRAVEL)
        .agg(F.max_by(F.struct("kind", F.col("id").alias("update_id"), F.col("kind").alias("travel_type"),
                               *TIMES, "seq"), "seq").alias("u"))
        .filter(F.col("u.kind") != S.DEPARTURE)
        .select(*TRAVEL, "u.update_id", "u.travel_type", *[f"u.{c}" for c in TIMES], "u.seq")
    )


def intervals(cut: ChunkedEvents) -> DataFrame:
    """Each entry with the events it is valid between: from its update up to the
    next update or departure of the same travel."""
    changes = cut.events.filter(F.col("kind") != S.REQUEST).select(
        *GROUP, "last_chunk", "travel_id", "seq", "kind", "id", *TIMES
    )
    if cut.is_cut:
        changes = changes.unionByName(
            first_row_of_next_chunk(cut.cut_only(changes), TRAVEL, "seq"), allowMissingColumns=True
        )
    by_travel = Window.partitionBy(*GROUP, "travel_id").orderBy("seq")
    return cut.dealt(changes).withColumn("valid_to", F.lead("seq").over(by_travel)).filter(is_update()).select(
        *TRAVEL, F.col("id").alias("update_id"), *TIMES, F.col("seq").alias("valid_from"), "valid_to"
    )


def best_per_route(entries: DataFrame) -> DataFrame:
    """Earliest arrival per route; ties go to the least travel id."""
    return (
        entries.groupBy(*S.ROUTE)
        .agg(F.min(F.struct("arrival_time", "travel_id", "travel_type", "departure_time")).alias("best"))
        .select(*S.ROUTE, "best.*")
    )


def tied_for_best(entries: DataFrame) -> DataFrame:
    """Per route: the best arrival, who wins it, and how many entries share it."""
    return (
        entries.groupBy(*S.ROUTE, "arrival_time")
        .agg(F.min("travel_id").alias("travel_id"), F.count("*").alias("entries"))
        .groupBy(*S.ROUTE)
        .agg(F.min(F.struct("arrival_time", "travel_id", "entries")).alias("best"))
        .select(*S.ROUTE, "best.*")
    )


def unmatched_departures(events: DataFrame, valid: DataFrame) -> DataFrame:
    """Departures that end no entry.  ``seq`` is unique, so the join cannot skew."""
    ended = valid.filter(F.col("valid_to").isNotNull()).select(*TRAVEL, F.col("valid_to").alias("seq"))
    return (
        events.filter(is_complete() & (F.col("kind") == S.DEPARTURE))
        .select("seq", "id", *TRAVEL)
        .join(ended, [*TRAVEL, "seq"], "left_anti")
    )


def as_items(frame: DataFrame, keys: list[str], order: str, value: list[str]) -> DataFrame:
    """A map or list per key in rows: the key's columns, the item's place in it (by ``order``), ``order`` and ``value``.

    A key may have any number of items, so they never become one value, nor are they
    counted in one task.  Rows are dealt into ranges of key and order; the place is that
    within the range behind the number of the key's rows in earlier ranges.
    """
    rows = staged(frame.select(*keys, order, *value), "items")
    dealt = staged(rows.repartitionByRange(*keys, order).withColumn("_range", F.spark_partition_id()), "item-ranges")
    counts = dealt.groupBy(*keys, "_range").agg(F.count(F.lit(1)).alias("n"))
    ranges = counts.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("_range", "n"))).alias("ranges"))
    before = F.transform("ranges", lambda r, i: F.struct(
        r["_range"].alias("_range"),
        F.aggregate(F.slice("ranges", 1, i), F.lit(0).cast("bigint"), lambda sum_, x: sum_ + x["n"]).alias("before"),
    ))
    at = [*keys, "_range"]
    offsets = ranges.select(*keys, F.inline(before)).withColumnsRenamed({c: f"_of_{c}" for c in at})
    within = F.row_number().over(Window.partitionBy(*at).orderBy(order))
    joined = dealt.withColumn("_within", within).join(offsets, [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in at])
    return joined.select(*keys, (F.col("_within") + F.col("before")).alias("place"), order, *value)
