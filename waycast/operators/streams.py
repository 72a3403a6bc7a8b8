"""Tagging, merging, dispatching and filtering of event streams.

Every function is a projection or filter, so it works unchanged on batch and
on streaming frames and never shuffles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waycast import schemas as S
from waycast.functions import times


def is_update() -> Column:
    return F.col("kind").isin(*S.UPDATE_KINDS)


def is_complete() -> Column:
    """Rows the rules can work with; anything else is a reject, never an error."""
    return F.coalesce(
        F.col("seq").isNotNull() & F.col("id").isNotNull()
        & F.col("departure_location").isNotNull() & F.col("arrival_location").isNotNull()
        & F.when(F.col("kind") == S.REQUEST, True)
        .when(F.col("kind") == S.DEPARTURE, F.col("travel_id").isNotNull())
        .when(is_update(), F.col("travel_id").isNotNull() & F.col("arrival_time").isNotNull()
              & F.col("departure_time").isNotNull()),
        F.lit(False),
    )


def union_events(requests: DataFrame, planes: DataFrame, trains: DataFrame, departures: DataFrame) -> DataFrame:
    """Bag union of the four streams as one tagged frame."""
    tagged = [
        requests.withColumn("kind", F.lit(S.REQUEST)),
        planes.withColumnRenamed("update_id", "id").withColumn("kind", F.lit(S.PLANE)),
        trains.withColumnRenamed("update_id", "id").withColumn("kind", F.lit(S.TRAIN)),
        departures.withColumnsRenamed({
            "effective_departure_time": "departure_time",
            "expected_arrival_time": "arrival_time",
        }).withColumn("kind", F.lit(S.DEPARTURE)),
    ]
    merged = tagged[0]
    for frame in tagged[1:]:
        merged = merged.unionByName(frame, allowMissingColumns=True)
    return merged.select(*S.EVENT_COLUMNS)


def envelopes(events: DataFrame) -> DataFrame:
    """One row per event: route, and the one filled member of four."""
    update = F.struct(
        F.col("id").alias("update_id"), "travel_id", "departure_location", "arrival_location",
        "departure_time", "arrival_time",
    )
    return events.select(
        "seq", "ts", *S.ROUTE,
        F.when(F.col("kind") == S.REQUEST, F.struct("id", *S.ROUTE)).alias("request"),
        F.when(F.col("kind") == S.TRAIN, update).alias("train"),
        F.when(F.col("kind") == S.PLANE, update).alias("plane"),
        F.when(F.col("kind") == S.DEPARTURE, F.struct(
            "id", "travel_id", *S.ROUTE,
            F.col("departure_time").alias("effective_departure_time"),
            F.col("arrival_time").alias("expected_arrival_time"),
        )).alias("departure"),
    )


def entries_from_envelopes(wrapped: DataFrame) -> DataFrame:
    """Timetable entries out of the envelope, the train member first."""
    def member(field: str) -> Column:
        return F.coalesce(F.col(f"train.{field}"), F.col(f"plane.{field}"))

    return wrapped.filter(F.col("train").isNotNull() | F.col("plane").isNotNull()).select(
        "seq",
        *[member(f).alias(f) for f in (
            "update_id", "travel_id", "departure_location", "arrival_location",
            "departure_time", "arrival_time")],
        F.when(F.col("train").isNotNull(), S.TRAIN).otherwise(S.PLANE).alias("travel_type"),
    )


def dispatch(wrapped: DataFrame) -> DataFrame:
    """Which rule an envelope goes to: request, departure, else update."""
    return wrapped.select(
        "seq",
        F.when(F.col("request").isNotNull(), "request")
        .when(F.col("departure").isNotNull(), "departure")
        .otherwise("update").alias("rule"),
        F.coalesce("request.id", "departure.id", "train.update_id", "plane.update_id").alias("record_id"),
    )


def leaves_late_enough(min_lead: int | None = S.MIN_LEAD_MINUTES, as_of: Column | None = None) -> Column:
    """Departure strictly later than ``as_of`` plus the lead; other kinds pass.

    ``as_of`` defaults to the event's own time, which makes replays repeatable;
    a live stream passes the current time.
    """
    if min_lead is None:
        return F.lit(True)
    as_of = F.col("ts") if as_of is None else as_of
    return ~is_update() | (F.col("departure_time") > as_of + times.minutes(min_lead))


def utc_now() -> Column:
    return times.from_epoch_micros(F.unix_micros(F.current_timestamp()))


def apply_lead_time(events: DataFrame, min_lead: int | None = S.MIN_LEAD_MINUTES, as_of: Column | None = None) -> DataFrame:
    return events if min_lead is None else events.filter(leaves_late_enough(min_lead, as_of))
