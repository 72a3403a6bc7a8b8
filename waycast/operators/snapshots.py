"""What is open when the events end: timetable, active alerts, waiting requests.

A snapshot needs each route's last state and its open requests, never the
alerts sent on the way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waycast import schemas as S
from waycast.operators.matching import EPOCH, History
from waycast.operators.streams import is_update
from waycast.operators.timeline import is_closing, opens_timetable
from waycast.session import staged


def route_states(history: History) -> DataFrame:
    """One row per route: the open epoch, the best entry and the last update."""
    return (
        history.timeline.groupBy(*S.ROUTE)
        .agg(
            F.max_by(F.struct(
                F.when(is_closing(), F.col("seq")).otherwise(F.col("epoch")).alias("epoch"), "after"
            ), "seq").alias("s"),
            F.max(F.when(is_update(), F.struct(
                "seq", "ts", "kind", "id", F.col("before.travel_id").alias("moved_from")))).alias("u"),
        )
        .select(*S.ROUTE, F.col("s.epoch").alias("epoch"), F.col("s.after").alias("last_best"), "u")
    )


def _small_side(frame: DataFrame, history: History, purpose: str) -> DataFrame:
    """One row per route or epoch, to be joined with requests.

    As a written table it lets Spark split a crowded epoch at run time, which it
    cannot do when the other side is an aggregation.
    """
    return staged(frame, purpose) if history.cut.is_cut else frame


def active_alerts(history: History) -> DataFrame:
    """The last alert of every request whose travel has not departed."""
    open_requests = history.requests.filter(F.col("replaced_at").isNull())
    joined = open_requests.join(_small_side(route_states(history), history, "route-states"), EPOCH)
    told = F.col("u.seq") > F.col("seq")
    active = joined.filter(F.col("best").isNotNull() | told).select("*", F.coalesce(told, F.lit(False)).alias("told"))

    def either(update: str, request: Column) -> Column:
        return F.when(F.col("told"), F.col(update)).otherwise(request)

    entry = F.coalesce("last_best", "best")
    no_text = F.lit(None).cast("string")
    return active.select(
        either("u.seq", F.col("seq")).alias("seq"), either("u.ts", F.col("ts")).alias("alert_ts"),
        either("u.kind", F.lit(S.REQUEST)).alias("trigger_kind"), "id",
        entry["travel_id"].alias("travel_id"), either("u.moved_from", no_text).alias("last_travel_id"),
        either("u.id", no_text).alias("update_id"), entry["travel_type"].alias("travel_type"), *S.ROUTE,
        entry["departure_time"].alias("departure_time"), entry["arrival_time"].alias("arrival_time"),
        no_text.alias("reason"),
    )


def waiting_requests(history: History) -> DataFrame:
    """Requests nobody has answered: none found, no update since, not repeated.

    An epoch that began with an empty timetable has one first update at most, so
    the right side of the anti join has one row per epoch.
    """
    served = history.timeline.filter(opens_timetable()).select(*EPOCH)
    return (
        history.requests.filter(F.col("best").isNull() & F.col("replaced_at").isNull())
        .join(served, EPOCH, "left_anti")
        .select("seq", "ts", "id", *S.ROUTE)
    )


def request_lifetimes(history: History) -> DataFrame:
    """Per request: when it got its first travel, when that epoch closed, when it was repeated."""
    borders = history.timeline.groupBy(*EPOCH).agg(
        F.min(F.when(opens_timetable(), F.col("seq"))).alias("opened_at"),
        F.max(F.when(is_closing(), F.col("seq"))).alias("closed_at"),
    )
    return history.requests.join(_small_side(borders, history, "epochs"), EPOCH, "left").select(
        "seq", "id", *S.ROUTE,
        F.when(F.col("best").isNotNull(), F.col("seq")).when(
            F.col("replaced_at").isNull() | (F.col("opened_at") < F.col("replaced_at")), F.col("opened_at")
        ).alias("started_at"),
        "closed_at", "replaced_at",
    )
