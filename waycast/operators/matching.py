"""Which alerts every request receives.

Two facts make this a relational job.  All active alerts of a route name the
same travel, the best one, so an alert's content depends on the event alone and
hardly on the request.  And a departure ends either all active alerts of a route
(a closing departure) or none, so an alert is a request meeting a later event
of its own epoch.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waycast import schemas as S
from waycast.operators import blocks
from waycast.operators.chunks import GROUP, ROWS_PER_CHUNK, ChunkedEvents, cut_into_chunks, first_row_of_next_chunk
from waycast.operators.streams import is_update
from waycast.operators.timeline import NO_EPOCH, best_timeline, chunk_openings, is_closing, with_openings
from waycast.session import staged

EPOCH = [*S.ROUTE, "epoch"]


@dataclass
class History:
    """Requests and timetable events with the state of their route around them.

    ``requests`` has ``best`` (the entry a request finds), ``epoch`` and
    ``replaced_at`` (the next request with the same id on the route).
    ``timeline`` is that of :func:`waycast.operators.timeline.with_openings`.
    """

    requests: DataFrame
    timeline: DataFrame
    cut: ChunkedEvents
    openings: DataFrame | None = None


def trace(events: DataFrame, rows_per_chunk: int = ROWS_PER_CHUNK, count_from: DataFrame | None = None, builtin: bool = False) -> History:
    """Annotate events; incomplete ones (``streams.is_complete``) take no part.

    Timetable events are shuffled on ``(route, chunk)`` for their timeline, and
    requests with the timeline's marks for their windows; alerts shuffle both again
    on the epoch.  With more events than one chunk holds, everything is shuffled and
    written once before (``chunks.cut_into_chunks``), and so is the timeline: then
    this call itself runs jobs, and so does every query built on it.

    ``builtin`` finds the best travel without Python workers (:mod:`waycast.operators.blocks`).
    """
    cut = cut_into_chunks(events, rows_per_chunk, count_from)
    local, openings = (blocks.best_timeline if builtin else best_timeline)(cut), None
    if cut.is_cut:
        # read several times below, and a small part of the data: requests are not in it
        local = staged(local, "timeline")
        openings = chunk_openings(local, cut)
    timeline = with_openings(local, openings, cut)

    requests = cut.events.filter(F.col("kind") == S.REQUEST).select(*GROUP, "last_chunk", "seq", "ts", "id")
    marks = timeline.select(*GROUP, "seq", "ts", F.struct(
        "after", F.when(is_closing(), F.col("seq")).otherwise(F.col("epoch")).alias("epoch")
    ).alias("state"))
    rows = requests.unionByName(marks, allowMissingColumns=True)
    if openings is not None:
        carried = openings.select(*GROUP, F.struct(
            F.col("o_state.after").alias("after"),
            _opening_epoch().alias("epoch"),
        ).alias("state"))
        announced = first_row_of_next_chunk(cut.cut_only(requests), [*S.ROUTE, "id"], "seq")
        rows = rows.unionByName(carried, allowMissingColumns=True).unionByName(
            announced.withColumn("announced", F.lit(True)), allowMissingColumns=True)
    else:
        rows = rows.withColumn("announced", F.lit(None).cast("boolean"))
    # An opening row has no seq and sorts first; a row announcing the next chunk
    # sorts last.  Ordering by ts as well keeps the shuffled columns the same for
    # every user of the result, so that Spark runs that shuffle once.
    earlier = Window.partitionBy(*GROUP).orderBy("seq", "ts").rowsBetween(Window.unboundedPreceding, -1)
    same_request = Window.partitionBy(*GROUP, "id").orderBy("seq", "ts")
    found = cut.dealt(rows).select(
        *GROUP, "seq", "ts", "id", "announced",
        F.last("state", ignorenulls=True).over(earlier).alias("found"),
        F.lead("seq").over(same_request).alias("replaced_at"),
    ).filter(F.col("id").isNotNull() & F.col("announced").isNull())
    requests = found.select(
        *GROUP, "seq", "ts", "id", "replaced_at", F.col("found.after").alias("best"),
        F.coalesce("found.epoch", F.lit(NO_EPOCH).cast("bigint")).alias("epoch"),
    )
    return History(requests, timeline, cut, openings)


def _chunk_ends(history: History) -> DataFrame:
    """Per chunk of a cut route: the epoch that is open at its end, and the chunk where that one ends."""
    opening = history.openings.select(*GROUP, _opening_epoch().alias("open_epoch"))
    return opening.select(
        *S.ROUTE, (F.col("chunk") - 1).alias("chunk"), "open_epoch",
        F.max("chunk").over(Window.partitionBy(*S.ROUTE, "open_epoch")).alias("ends_in"),
    )


def _opening_epoch() -> Column:
    return F.coalesce("o_closed.seq", F.lit(NO_EPOCH).cast("bigint"))


def request_event_pairs(history: History, wanted: Column | None = None, one_each: bool = False) -> DataFrame:
    """Requests joined with the later events of their epoch.

    ``one_each`` states that at most one wanted event lies in an epoch, as is so for
    closing departures and for updates that find the timetable empty.  Then requests
    meet a side with unique keys, each once, and a crowded epoch can be split at run
    time; no request is repeated for the chunks its epoch covers.

    An equi-join on route and epoch, whose result is close to the alerts
    themselves.  An epoch that runs over several chunks is joined chunk by
    chunk: a request visits the chunks its epoch still covers (of those, the chunks that
    hold a ``wanted`` event), an event the chunks its epoch came from, so a join key holds
    the rows of two chunks.
    """
    chosen = is_update() | is_closing()
    requests = history.requests.select(*EPOCH, "seq", "id", "replaced_at", "chunk")
    events = history.timeline.filter(chosen if wanted is None else chosen & wanted).select(
        *EPOCH, "epoch_chunk", "chunk",
        F.col("seq").alias("e_seq"), F.col("ts").alias("e_ts"), F.col("kind").alias("e_kind"),
        F.col("id").alias("e_id"),
        F.when(is_update(), F.col("after")).otherwise(F.col("before")).alias("e_entry"),
        # an update moves everyone off the best travel before it; a departure
        # repeats what the last update did, if the request was there to see it
        F.when(is_update(), F.col("before.travel_id")).otherwise(F.col("updated_from")).alias("e_last"),
        F.when(~is_update(), F.coalesce("updated_at", F.lit(NO_EPOCH).cast("bigint"))).alias("e_last_seq"),
    )
    keys = list(EPOCH)
    if history.cut.is_cut and not one_each:
        events = events.withColumn("request_chunk", F.explode(F.sequence("epoch_chunk", "chunk")))
        events = events.withColumnRenamed("chunk", "event_chunk")
        keys += ["request_chunk", "event_chunk"]
        requests = requests.withColumnRenamed("chunk", "request_chunk")
        if wanted is None:  # nearly every chunk holds an event
            last = F.when(F.col("epoch") == F.col("open_epoch"), F.col("ends_in"))
            ends = _chunk_ends(history).withColumnRenamed("chunk", "request_chunk")
            covered = F.sequence("request_chunk", F.greatest("request_chunk", F.coalesce(last, "request_chunk")))
            requests = requests.join(ends, [*S.ROUTE, "request_chunk"], "left").withColumn("event_chunk", F.explode(covered)).drop("open_epoch", "ends_in")
        else:
            requests = requests.join(events.select(*keys).distinct(), [*EPOCH, "request_chunk"])
    else:
        requests, events = requests.drop("chunk"), events.drop("chunk")
    return requests.join(events, keys).filter(
        (F.col("e_seq") > F.col("seq"))
        & (F.col("replaced_at").isNull() | (F.col("e_seq") < F.col("replaced_at")))
    )


def _no_text() -> Column:
    return F.lit(None).cast("string")


def immediate_alerts(history: History) -> DataFrame:
    """Requests that find a live travel when they arrive."""
    return history.requests.filter(F.col("best").isNotNull()).select(
        "seq", F.col("ts").alias("alert_ts"), F.lit(S.REQUEST).alias("trigger_kind"), "id",
        F.col("best.travel_id").alias("travel_id"), _no_text().alias("last_travel_id"),
        _no_text().alias("update_id"), F.col("best.travel_type").alias("travel_type"), *S.ROUTE,
        F.col("best.departure_time").alias("departure_time"),
        F.col("best.arrival_time").alias("arrival_time"), _no_text().alias("reason"),
    )


def later_alerts(history: History, wanted: Column | None = None, one_each: bool = False) -> DataFrame:
    """Alerts set off by updates and closing departures.

    ``wanted`` restricts the events, for instance to those with no best entry
    before them, which serve the requests that were waiting.  For ``one_each`` see
    :func:`request_event_pairs`.
    """
    departed = F.col("e_kind") == S.DEPARTURE
    return request_event_pairs(history, wanted, one_each).select(
        F.col("e_seq").alias("seq"), F.col("e_ts").alias("alert_ts"), F.col("e_kind").alias("trigger_kind"), "id",
        F.col("e_entry.travel_id").alias("travel_id"),
        F.when(~departed | (F.col("e_last_seq") > F.col("seq")), F.col("e_last")).alias("last_travel_id"),
        F.col("e_id").alias("update_id"), F.col("e_entry.travel_type").alias("travel_type"), *S.ROUTE,
        F.col("e_entry.departure_time").alias("departure_time"),
        F.col("e_entry.arrival_time").alias("arrival_time"),
        F.when(departed, S.DEPARTED).alias("reason"),
    )


def all_alerts(history: History) -> DataFrame:
    return immediate_alerts(history).unionByName(later_alerts(history))


def active_at_events(history: History) -> DataFrame:
    """Per update and closing departure: ``e_kind``, ``opens`` and ``active``, the number of requests it alerts.

    A running count over requests that start and end, so no alert is built.  Within
    a cut route the count runs per chunk, on top of what earlier chunks of the same
    epoch leave.
    """
    place = [*EPOCH, "chunk", "seq"]
    starts = history.requests.select(*place, F.lit(1).cast("bigint").alias("change"))
    ended = history.requests.filter(F.col("replaced_at").isNotNull()).select(*EPOCH, F.col("replaced_at").alias("seq"))
    if history.cut.is_cut:  # seq is unique, so this join cannot skew
        ended = ended.join(history.requests.select(*S.ROUTE, "seq", "chunk"), [*S.ROUTE, "seq"])
    else:
        ended = ended.withColumn("chunk", F.lit(0).cast("bigint"))
    ends = ended.select(*place, F.lit(-1).cast("bigint").alias("change"))
    events = history.timeline.filter(is_update() | is_closing()).select(
        *place, F.lit(0).cast("bigint").alias("change"), F.col("kind").alias("e_kind"), F.col("before").isNull().alias("opens")
    )
    rows = starts.unionByName(ends).unionByName(events, allowMissingColumns=True)
    earlier = Window.partitionBy(*EPOCH, "chunk").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    counted = rows.withColumn("active", F.coalesce(F.sum("change").over(earlier), F.lit(0))).filter(F.col("e_kind").isNotNull())
    if history.cut.is_cut:
        chunks = Window.partitionBy(*EPOCH).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
        left = rows.groupBy(*EPOCH, "chunk").agg(F.sum("change").alias("change")).select(
            *EPOCH, "chunk", F.coalesce(F.sum("change").over(chunks), F.lit(0)).alias("carried"))
        counted = counted.join(left, [*EPOCH, "chunk"]).withColumn("active", F.col("active") + F.col("carried"))
    return counted.select(*EPOCH, "seq", "e_kind", "opens", "active")
