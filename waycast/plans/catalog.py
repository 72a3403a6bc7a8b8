"""The questions the engine answers, by name.

Each takes ``(spark, sf_dir)`` and runs over its whole tables.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waycast import schemas as S
from waycast.functions import codec, keys
from waycast.operators import index, matching, snapshots, streams, timetable
from waycast.operators.chunks import cut_into_chunks
from waycast.operators.timeline import is_closing, opens_timetable
from waycast.session import work_dir
from waycast.sources import logs, tables, topics
from waycast.streaming import runs

# Point in time for as-of questions: about half of the events lie before it.
AS_OF = "2024-01-16 00:00:00"

# Values that hold the state of many small routes.
PAGES = 4096

Query = Callable[[SparkSession, str], DataFrame]
CATALOG: dict[str, Query] = {}


def query(function: Query) -> Query:
    CATALOG[function.__name__] = function
    return function


def _events(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    """Events after the lead-time filter."""
    return streams.apply_lead_time(tables.read_events(spark, sf_dir, parse_once=True, **options))


def _bound(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw table, counted from the footers of its files: no query has more events."""
    return tables.read_table(spark, sf_dir, "events")


def _history(spark: SparkSession, sf_dir: str, **options) -> matching.History:
    return matching.trace(_events(spark, sf_dir, **options), count_from=_bound(spark, sf_dir))


def _alerts(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return matching.all_alerts(_history(spark, sf_dir, **options))


def _four_streams(events: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    return (tables.requests(events), tables.updates(events, S.PLANE),
            tables.updates(events, S.TRAIN), tables.departures(events))


def _entry(prefix: str) -> list[Column]:
    return [F.col(f"{prefix}.{c}").alias(f"{prefix}_{c}") for c in ("travel_id", "arrival_time")]


# Sources

@query
def src_plane_updates(spark, sf_dir):
    return tables.updates(tables.read_events(spark, sf_dir), S.PLANE)


@query
def src_train_updates(spark, sf_dir):
    return tables.updates(tables.read_events(spark, sf_dir), S.TRAIN)


@query
def src_requests(spark, sf_dir):
    return tables.requests(tables.read_events(spark, sf_dir))


@query
def src_departures(spark, sf_dir):
    return tables.departures(tables.read_events(spark, sf_dir))


@query
def src_event_log(spark, sf_dir):
    """The log written to files and read back, with a field taken from the JSON."""
    path = logs.write_log(codec.encode_events(tables.read_events(spark, sf_dir)), work_dir(spark, "log"))
    return logs.read_log(spark, path).select(
        "topic", "key", "ts", "seq",
        F.get_json_object("value", "$.departureLocation").alias("departure_location"),
    )


@query
def src_from_time(spark, sf_dir):
    """The log read from a point in time on."""
    log = codec.encode_events(tables.read_events(spark, sf_dir))
    return logs.from_position(log, from_time=AS_OF).select("topic", "key", "ts", "seq")


CATALOG["src_from_latest"] = src_from_time  # its former name


@query
def src_topic_positions(spark, sf_dir):
    """A log read from positions of its own for each topic: one from its end, one from a point in time, the others whole."""
    path = logs.write_log(codec.encode_events(tables.read_events(spark, sf_dir)), work_dir(spark, "log"))
    starts = json.dumps({S.TOPICS[S.TRAIN]: AS_OF, S.TOPICS[S.DEPARTURE]: "latest"})
    spark.dataSource.register(topics.TopicLog)
    log = spark.read.format("topiclog").option("path", path).option("startingOffsets", starts).load()
    return log.select("topic", "key", "ts", "seq")


@query
def src_topic_stream(spark, sf_dir):
    """A stream over the log that starts at the end of each topic, stops and starts again: the second half, once."""
    path, out, checkpoint = (work_dir(spark, n) for n in ("log", "records", "state"))
    spark.dataSource.register(topics.TopicLog)
    log = codec.encode_events(tables.read_events(spark, sf_dir))
    late = F.col("ts") >= F.lit(AS_OF).cast("timestamp_ntz")
    logs.write_log(log.filter(~late), path)
    for part in (None, late & (F.col("seq") % 2 == 0), late & (F.col("seq") % 2 == 1)):
        if part is not None:
            logs.write_log(log.filter(part), path)
        arriving = spark.readStream.format("topiclog").option("path", path).option("startingOffsets", "latest").load()
        runs.start_files(arriving, out, checkpoint).awaitTermination()
    return spark.read.schema(S.LOG_SCHEMA).parquet(out).select("topic", "key", "ts", "seq")


@query
def decode_events(spark, sf_dir):
    log = codec.encode_events(tables.read_events(spark, sf_dir))
    return codec.accepted(codec.decode_events(log))


@query
def decode_rejects(spark, sf_dir):
    """Good records mixed with those of the ``error`` events, which are null, cut or incomplete."""
    good = codec.encode_events(tables.read_events(spark, sf_dir))
    k = F.get_json_object("props", "$.k").cast("int") % 3
    bad = tables.read_table(spark, sf_dir, "events").filter(F.col("event_type") == "error").select(
        F.lit(S.TOPICS[S.PLANE]).alias("topic"), F.lit(None).cast("string").alias("key"),
        F.when(k == 1, F.rtrim(F.col("props"), F.lit("}"))).when(k == 2, F.col("props")).alias("value"),
        "ts", F.col("event_id").alias("seq"),
    )
    decoded = codec.decode_events(good.unionByName(bad))
    return codec.rejected(decoded).select("seq", "topic", "problem")


# Sinks and keys

@query
def encode_alerts(spark, sf_dir):
    """Alerts written as JSON and read again."""
    return codec.decode_alerts(codec.encode_alerts(_alerts(spark, sf_dir)))


@query
def event_keys(spark, sf_dir):
    key = codec.event_key()
    return tables.read_events(spark, sf_dir).select(
        "seq", "kind", key.alias("key"),
        F.octet_length(F.encode(key, "UTF-8")).cast("bigint").alias("key_bytes"),
    )


@query
def event_log_by_topic(spark, sf_dir):
    """Records and distinct keys per topic of a log partitioned by topic."""
    path = logs.write_log(codec.encode_events(tables.read_events(spark, sf_dir)), work_dir(spark, "log"))
    return (
        logs.read_log(spark, path, [S.TOPICS[k] for k in (S.REQUEST, S.PLANE, S.TRAIN, S.DEPARTURE)])
        .groupBy("topic", "key").agg(F.count("*").alias("n"), F.max("seq").alias("last_seq"))
    )


@query
def alerts_by_request_key(spark, sf_dir):
    return _alerts(spark, sf_dir).select(codec.alert_key("request").alias("key"), "seq", "id", "travel_id")


@query
def alerts_by_travel_key(spark, sf_dir):
    return _alerts(spark, sf_dir).select(codec.alert_key("travel").alias("key"), "seq", "id", "travel_id")


# Projections and filters

@query
def timetable_entries(spark, sf_dir):
    events = tables.read_events(spark, sf_dir)
    return timetable.entries(tables.updates(events, S.TRAIN), tables.updates(events, S.PLANE))


@query
def envelope_entry(spark, sf_dir):
    return streams.entries_from_envelopes(streams.envelopes(tables.read_events(spark, sf_dir)))


@query
def event_union(spark, sf_dir):
    return streams.union_events(*_four_streams(tables.read_events(spark, sf_dir)))


@query
def event_dispatch(spark, sf_dir):
    return streams.dispatch(streams.envelopes(tables.read_events(spark, sf_dir)))


@query
def route_keys(spark, sf_dir):
    return tables.read_events(spark, sf_dir).select(
        "seq", *S.ROUTE, keys.route_key().alias("route_key"), keys.dashed_route_key().alias("dashed_route_key")
    )


@query
def travel_id_parts(spark, sf_dir):
    return tables.read_events(spark, sf_dir).filter(F.col("travel_id").isNotNull()).select(
        "seq", "travel_id", keys.slot_group().alias("slot_group"), keys.travel_slot().alias("slot"),
        keys.travel_type().alias("travel_type"),
        keys.travel_id("departure_location", "arrival_location", keys.travel_slot(), keys.travel_type()).alias("rebuilt"),
    )


@query
def slot_groups(spark, sf_dir):
    return (
        tables.read_events(spark, sf_dir).filter(F.col("travel_id").isNotNull())
        .groupBy(keys.slot_group().alias("slot_group"))
        .agg(F.count("*").alias("events"), F.min("seq").alias("first_seq"), F.max("seq").alias("last_seq"))
    )


@query
def state_keys(spark, sf_dir):
    """Per request, the key text of its active alert (null if no travel is given) and of an early request."""
    requests = _history(spark, sf_dir).requests.select("seq", "id", *S.ROUTE, F.col("best.travel_id").alias("travel_id"))
    return requests.select(
        "seq", keys.active_alert_key().alias("active_key"), keys.early_request_key().alias("early_key")
    )


@query
def lead_time_filter(spark, sf_dir):
    return _events(spark, sf_dir)


@query
def lead_time_dropped(spark, sf_dir):
    return tables.read_events(spark, sf_dir).filter(~streams.leaves_late_enough())


# Joins

@query
def request_best_match(spark, sf_dir):
    """What each request gets on arrival; null columns when it must wait."""
    return _history(spark, sf_dir).requests.select(
        "seq", "id", *S.ROUTE,
        *[F.col(f"best.{c}").alias(c) for c in S.ENTRY_SCHEMA.fieldNames()],
    )


@query
def reoptimised_alerts(spark, sf_dir):
    history = _history(spark, sf_dir)
    return matching.later_alerts(history, streams.is_update() & ~opens_timetable())


@query
def early_request_match(spark, sf_dir):
    """Waiting requests served by the first update after them."""
    return matching.later_alerts(_history(spark, sf_dir, routes="per_user"), opens_timetable(), one_each=True)


@query
def timetable_intervals(spark, sf_dir):
    return timetable.intervals(cut_into_chunks(_events(spark, sf_dir), count_from=_bound(spark, sf_dir)))


@query
def timetable_after_departures(spark, sf_dir):
    return timetable.live(_events(spark, sf_dir))


@query
def departed_alerts(spark, sf_dir):
    return matching.later_alerts(_history(spark, sf_dir), is_closing(), one_each=True)


@query
def departures_without_travel(spark, sf_dir):
    events = _events(spark, sf_dir)
    return timetable.unmatched_departures(events, timetable.intervals(cut_into_chunks(events, count_from=_bound(spark, sf_dir))))


@query
def early_requests(spark, sf_dir):
    """Requests that find no travel on arrival."""
    history = _history(spark, sf_dir, routes="per_user")
    return history.requests.filter(F.col("best").isNull()).select("seq", "ts", "id", *S.ROUTE)


@query
def route_prefix_scan(spark, sf_dir):
    """Timetable entries found for each requested route by the text of their travel id.

    The prefix ends with the closing sign, so that S1 does not find S10.  As an
    equality of prefixes it stays an equi-join.
    """
    events = _events(spark, sf_dir)
    wanted = tables.requests(events).groupBy(keys.route_key().alias("route_key")).agg(F.count("*").alias("requests"))
    found = timetable.live(events).select(
        F.substring_index("travel_id", "#", 2).alias("route_key"), "travel_id", "update_id", "seq"
    )
    return wanted.join(found, "route_key")


# Aggregations

@query
def best_per_route(spark, sf_dir):
    return timetable.best_per_route(timetable.live(_events(spark, sf_dir)))


@query
def best_tie_break(spark, sf_dir):
    return timetable.tied_for_best(timetable.live(_events(spark, sf_dir)))


@query
def timetable_latest(spark, sf_dir):
    return timetable.latest(_events(spark, sf_dir))


@query
def timetable_sorted(spark, sf_dir):
    return timetable.live(_events(spark, sf_dir)).orderBy("travel_id")


@query
def timetable_map(spark, sf_dir):
    """The timetable of each route by travel id, one row per item."""
    return timetable.as_items(timetable.live(_events(spark, sf_dir)), S.ROUTE, "travel_id",
                              ["update_id", "travel_type", *timetable.TIMES])


@query
def early_request_list(spark, sf_dir):
    waiting = snapshots.waiting_requests(_history(spark, sf_dir, routes="daily"))
    return timetable.as_items(waiting, S.ROUTE, "seq", ["id"])


@query
def alert_map(spark, sf_dir):
    active = snapshots.active_alerts(_history(spark, sf_dir))
    # a request id may be active on several routes; its place then follows the sequence number
    named = active.withColumn("item", F.struct("id", "seq", *S.ROUTE))
    rows = timetable.as_items(named, ["travel_id"], "item", [c for c in S.ALERT_COLUMNS if c not in ("travel_id",)])
    return rows.drop("item")


@query
def active_alerts(spark, sf_dir):
    return snapshots.active_alerts(_history(spark, sf_dir))


# State over time

@query
def alert_history(spark, sf_dir):
    """Each alert with the travel the customer had before it."""
    return _alerts(spark, sf_dir).select("id", "seq", "travel_id", "last_travel_id", "reason")


@query
def best_timeline(spark, sf_dir):
    return _history(spark, sf_dir).timeline.select("seq", "kind", *S.ROUTE, *_entry("before"), *_entry("after"))


@query
def best_timeline_builtin(spark, sf_dir):
    """The same in built-in functions, without a Python worker."""
    history = matching.trace(_events(spark, sf_dir), count_from=_bound(spark, sf_dir), builtin=True)
    return history.timeline.select("seq", "kind", *S.ROUTE, *_entry("before"), *_entry("after"))


@query
def request_lifetimes(spark, sf_dir):
    return snapshots.request_lifetimes(_history(spark, sf_dir))


@query
def alerts_merged(spark, sf_dir):
    """The outputs of the four inputs, merged: one join serves updates and departures alike."""
    return matching.all_alerts(_history(spark, sf_dir))


@query
def early_remaining(spark, sf_dir):
    """Requests still waiting when the events end."""
    return snapshots.waiting_requests(_history(spark, sf_dir, routes="daily"))


# Composite questions

@query
def alerts_replay(spark, sf_dir):
    """Every alert ever sent."""
    return _alerts(spark, sf_dir)


@query
def alerts_replay_repeated_ids(spark, sf_dir):
    return _alerts(spark, sf_dir, repeat_ids=True)


@query
def alerts_replay_per_user(spark, sf_dir):
    return _alerts(spark, sf_dir, routes="per_user")


@query
def alerts_replay_single_route(spark, sf_dir):
    return _alerts(spark, sf_dir, routes="single")


@query
def alert_scenario_counts(spark, sf_dir):
    """How many alerts of each kind there are, counted without building them."""
    history = _history(spark, sf_dir)
    later = (
        F.when(F.col("e_kind") == S.DEPARTURE, "departed").when(F.col("opens"), "deferred").otherwise("re-optimised")
    )
    first = history.requests.filter(F.col("best").isNotNull()).select(
        F.lit("immediate").alias("scenario"), F.lit(1).cast("bigint").alias("n"))
    counts = matching.active_at_events(history).select(later.alias("scenario"), F.col("active").alias("n"))
    return first.unionByName(counts).groupBy("scenario").agg(F.sum("n").alias("alerts")).filter("alerts > 0")


@query
def alerts_changed_only(spark, sf_dir):
    """Alerts without the repeats of an unchanged travel.

    Whether the travel changed is a property of the update, so unchanged
    updates leave before the join.
    """
    history = _history(spark, sf_dir)
    same = F.col("before.travel_id").eqNullSafe(F.col("after.travel_id"))
    changed = matching.later_alerts(history, is_closing() | ~same)
    return matching.immediate_alerts(history).unionByName(changed)


@query
def state_as_of(spark, sf_dir):
    """Timetable, active and early requests at a point in time."""
    events = _events(spark, sf_dir, routes="daily").filter(F.col("ts") <= F.lit(AS_OF).cast("timestamp_ntz"))
    history = matching.trace(events, count_from=_bound(spark, sf_dir))
    parts = [
        ("timetable", timetable.live(events).select(*S.ROUTE, F.col("update_id").alias("item"), "travel_id")),
        ("active", snapshots.active_alerts(history).select(*S.ROUTE, F.col("id").alias("item"), "travel_id")),
        ("early", snapshots.waiting_requests(history).select(
            *S.ROUTE, F.col("id").alias("item"), F.lit(None).cast("string").alias("travel_id"))),
    ]
    named = [frame.select(F.lit(name).alias("state"), "*") for name, frame in parts]
    return named[0].unionByName(named[1]).unionByName(named[2])


@query
def state_at_points(spark, sf_dir):
    """Timetable, active and early requests at a hundred points, from a stored index."""
    last = tables.read_table(spark, sf_dir, "events").agg(F.max("event_id")).first()[0]
    every = max(1, (last + 1) // 20)
    path = work_dir(spark, "state-index")
    index.build(_history(spark, sf_dir), path, every)
    return index.at(spark, path, [(last + 1) * i // 100 for i in range(100)], every)


# Streaming

@query
def stream_alerts(spark, sf_dir):
    """The replay's alerts, from a stream that arrives in parts."""
    return runs.replay_table(spark, sf_dir)[0]


@query
def stream_alert_sink(spark, sf_dir):
    """The whole job: a log of JSON records in, a log of JSON alerts out, read again."""
    source, path, rejects, checkpoint = (work_dir(spark, n) for n in ("log", "alert-log", "rejects", "state"))
    cores = spark.sparkContext.defaultParallelism
    for part in runs.in_parts(codec.encode_events(tables.read_events(spark, sf_dir)), "seq"):
        logs.write_log(part, source)
        for run in runs.start_job(logs.stream_log(spark, source), path, rejects, checkpoint, cores, live=False, partitions=cores):
            run.awaitTermination()
    return codec.decode_alerts(runs.read_alert_log(spark, path))


@query
def stream_alerts_unordered(spark, sf_dir):
    """The replay's alerts, from records that come up to six hours late and in no order."""
    return runs.replay_on_a_clock(spark, sf_dir, late_hours=6)[0]


@query
def stream_alerts_rescaled(spark, sf_dir):
    """The replay's alerts, the first half matched by two shards a route and the second by five."""
    return runs.replay_rescaled(spark, sf_dir)


@query
def stream_expired(spark, sf_dir):
    """First matches if travels leave the timetable when their departure time has come."""
    alerts, _ = runs.replay_on_a_clock(spark, sf_dir, parts=2, expiring=True, tell_changes=False)
    return alerts.filter(F.col("trigger_kind") == S.REQUEST).select("seq", "id", *S.ROUTE, *S.ENTRY_SCHEMA.fieldNames())


@query
def stream_timetable_state(spark, sf_dir):
    _, checkpoint = runs.replay_table(spark, sf_dir)
    return runs.read_timetable(spark, checkpoint)


@query
def stream_active_state(spark, sf_dir):
    _, checkpoint = runs.replay_table(spark, sf_dir)
    return runs.read_active(spark, checkpoint)


@query
def stream_early_state(spark, sf_dir):
    _, checkpoint = runs.replay_table(spark, sf_dir, routes="daily", pages=PAGES)
    return runs.read_early(spark, checkpoint)


@query
def stream_timetable_feed(spark, sf_dir):
    """Every put and delete of the timetable, from the state's change feed."""
    _, checkpoint = runs.replay_table(spark, sf_dir, every_write=True)
    return runs.read_changes(spark, checkpoint, "timetable").select(
        "change_type", *[F.col(f"key.{c}").alias(c) for c in S.ROUTE], F.col("user_map_key.key").alias("travel_id"),
        *[F.col(f"user_map_value.{c}").alias(c) for c in ("travel_type", "departure_time", "arrival_time")],
    )
