"""The streaming form: equal to the replay, restartable, order-proof within a batch."""

import random
import time
from collections import Counter
from datetime import timedelta

import pytest
from pyspark.sql import functions as F
from by_hand import DAY, as_rows, event, incomplete_events, random_events, replay
from scenarios import everything

from waycast import schemas as S
from waycast.functions import codec
from waycast.operators import matching, streams
from waycast.sources import logs, tables, topics
from waycast.streaming import matcher, runs


def write_parts(spark, parts, path):
    """One file per part, in order of time, each shuffled inside."""
    for part in parts:
        shuffled = list(part)
        random.Random(5).shuffle(shuffled)
        spark.createDataFrame(as_rows(shuffled), S.EVENT_SCHEMA).coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.05)  # the file source orders by modification time


def stream(spark, path):
    return spark.readStream.schema(S.EVENT_SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)


def bag(df):
    return Counter(tuple(r) for r in df.select(*S.ALERT_COLUMNS).collect())


@pytest.mark.parametrize("shards", [1, 3])
def test_stream_equals_replay_over_batches(spark, tmp_path, shards):
    scenario_events, expected = everything()
    extra = random_events(41, routes=12, length=15)
    for e in extra:
        e.seq += 10_000
    events = scenario_events + extra
    parts = [events[: len(events) // 3], events[len(events) // 3: 2 * len(events) // 3], events[2 * len(events) // 3:]]
    junk = incomplete_events(12)
    parts = [[*part, *junk] for part in parts]
    write_parts(spark, parts, str(tmp_path / "in"))
    alerts, checkpoint = runs.run_to_end(spark, stream(spark, str(tmp_path / "in")), min_lead=None, shards=shards)
    wanted, left = replay(events)
    assert bag(alerts) == Counter(wanted)
    assert Counter(t for t in wanted if t[0] < 10_000).total() == len(expected)
    timetable = runs.read_timetable(spark, checkpoint).select(*S.ROUTE, "travel_id")
    assert sorted(tuple(r) for r in timetable.collect()) == left["timetable"]
    active = runs.read_active(spark, checkpoint).select(*S.ROUTE, "id", "travel_id", "last_travel_id")
    assert Counter(tuple(r) for r in active.collect()) == Counter(a[:5] for a in left["active"])
    early = runs.read_early(spark, checkpoint).select(*S.ROUTE, "id")
    assert sorted(tuple(r) for r in early.collect()) == left["early"]


def test_restart_in_the_middle_loses_and_repeats_nothing(spark, tmp_path):
    events = random_events(42, routes=10, length=12)
    half = len(events) // 2
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    for part in (events[:half], events[half:]):
        write_parts(spark, [part], source)
        alerts = matcher.match_stream(stream(spark, source), min_lead=None, shards=2)
        runs.start_alert_files(alerts, out, checkpoint).awaitTermination()
    assert bag(spark.read.schema(S.ALERT_SCHEMA).parquet(out)) == Counter(replay(events)[0])


def test_job_from_log_to_log(spark, tmp_path, sf_dir):
    """JSON log in, JSON alerts and rejects out, equal to the batch alerts."""
    events = tables.read_events(spark, sf_dir)
    source, out, rejects, checkpoint = (str(tmp_path / n) for n in ("in", "out", "rejects", "checkpoint"))
    logs.write_log(codec.encode_events(events), source)
    bad = events.limit(3).select(F.lit("departed").alias("topic"), F.lit("k").alias("key"), F.lit("{broken").alias("value"), "ts", "seq")
    logs.write_log(bad, source)
    for query in runs.start_job(logs.stream_log(spark, source), out, rejects, checkpoint, shards=2, live=False):
        query.awaitTermination()
    got = codec.decode_alerts(runs.read_alert_log(spark, out)).drop("alert_ts")
    wanted = matching.all_alerts(matching.trace(streams.apply_lead_time(events)))
    wanted = wanted.withColumn("key", wanted["id"]).select(*got.columns)
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, wanted.collect()))
    assert spark.read.parquet(rejects).count() == 3


def test_job_measures_the_lead_time_from_now(spark, tmp_path, sf_dir):
    events = tables.read_events(spark, sf_dir)
    source, out, rejects, checkpoint = (str(tmp_path / n) for n in ("in", "out", "rejects", "checkpoint"))
    logs.write_log(codec.encode_events(events), source)
    for query in runs.start_job(logs.stream_log(spark, source), out, rejects, checkpoint, shards=2):
        query.awaitTermination()
    # every update of the table left long ago, so no request finds a travel
    assert runs.read_alert_log(spark, out).count() == 0


def shuffled(events, parts, disorder, seed=3):
    """Parts in which an event may lie up to ``disorder`` seconds of event time behind later ones."""
    rng = random.Random(seed)
    late = sorted(events, key=lambda e: (e.ts + timedelta(seconds=rng.uniform(0, disorder)), e.seq))
    step = -(-len(late) // parts)
    return [late[i : i + step] for i in range(0, len(late), step)]


def clock(ts):
    """A record that only tells the time."""
    made = event(None, 0, None, None, None)
    made.seq, made.ts = None, ts
    return made


def test_late_records_are_taken_in_their_place(spark, tmp_path):
    events = random_events(44, routes=15, length=14)
    parts = shuffled(events, 4, 60)
    assert [e.seq for p in parts for e in p] != sorted(e.seq for e in events)
    parts[-1] = [*parts[-1], *incomplete_events(3)]
    parts.append([clock(max(e.ts for e in events) + timedelta(days=400))])
    write_parts(spark, parts, str(tmp_path / "in"))
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    alerts = matcher.match_stream(stream(spark, str(tmp_path / "in")), min_lead=None, shards=2, disorder="61 seconds")
    runs.start_alert_files(alerts, out, checkpoint, partitions=3).awaitTermination()
    assert bag(spark.read.schema(S.ALERT_SCHEMA).parquet(out)) == Counter(replay(events)[0])
    assert runs.read_state(spark, checkpoint, "held").count() == 0


def test_records_wait_for_the_watermark(spark, tmp_path):
    events = random_events(45, routes=5, length=10)
    write_parts(spark, [events], str(tmp_path / "in"))
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    alerts = matcher.match_stream(stream(spark, str(tmp_path / "in")), min_lead=None, shards=1, disorder="20 seconds")
    runs.start_alert_files(alerts, out, checkpoint, partitions=2).awaitTermination()
    # the slower of the two clocks, requests and the rest, counts
    passed = min(max(e.ts for e in events if (e.kind == "REQUEST") == of) for of in (True, False)) - timedelta(seconds=20)
    held = runs.read_state(spark, checkpoint, "held").select("list_element.seq").collect()
    assert sorted(r.seq for r in held) == sorted(e.seq for e in events if e.ts > passed) != []
    done = [e for e in events if e.ts <= passed]
    assert bag(spark.read.schema(S.ALERT_SCHEMA).parquet(out)) == Counter(replay(done)[0])


@pytest.mark.parametrize("disorder", [None, "30 seconds"])
def test_state_moves_to_another_number_of_shards(spark, tmp_path, disorder):
    events = random_events(46, routes=9, length=16)
    half = len(events) // 2
    outs, state = [], None
    for i, (part, shards) in enumerate([(events[:half], 2), (events[half:], 5)]):
        source, out, checkpoint = (str(tmp_path / f"{n}{i}") for n in ("in", "out", "checkpoint"))
        end = [clock(max(e.ts for e in events) + timedelta(days=9))] if disorder and i else []
        write_parts(spark, [part, end] if end else [part], source)
        alerts = matcher.match_stream(stream(spark, source), min_lead=None, shards=shards, disorder=disorder, state=state)
        runs.start_alert_files(alerts, out, checkpoint, partitions=2).awaitTermination()
        state = runs.saved_state(spark, checkpoint, disorder is not None)
        outs.append(spark.read.schema(S.ALERT_SCHEMA).parquet(out))
    assert "shard" not in state["timetable"].columns
    assert bag(outs[0].unionByName(outs[1])) == Counter(replay(events)[0])
    early = runs.read_early(spark, checkpoint).select(*S.ROUTE, "id")
    assert sorted(tuple(r) for r in early.collect()) == replay(events)[1]["early"]


def departing(seq, n, arrives, departs):
    return event("TRAIN", seq, f"u{seq}", travel=f"ATL#DFW#{n}_TRAIN", departs=DAY + timedelta(seconds=departs), arrives=DAY + timedelta(hours=arrives))


def test_travels_leave_the_timetable_when_their_time_has_come(spark, tmp_path):
    first = [departing(1, 1, 1, 30), departing(2, 2, 2, 50), departing(3, 3, 3, 500), event("REQUEST", 10, "a"), event("REQUEST", 29, "b"),
             event("REQUEST", 30, "c"), event("REQUEST", 49, "d")]
    later = [departing(55, 3, 3, 60), event("REQUEST", 58, "e"), event("REQUEST", 61, "f"), event("REQUEST", 62, "g"), departing(70, 1, 9, 900)]
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))

    def run(part):
        write_parts(spark, [part], source)
        alerts = matcher.match_stream(stream(spark, source), min_lead=None, shards=2, disorder="0 seconds", expiring=True)
        runs.start_alert_files(alerts, out, checkpoint, partitions=2).awaitTermination()
        return {r.travel_id[8] for r in runs.read_timetable(spark, checkpoint).collect()}

    # the clock alone empties the state
    assert run([*first, clock(DAY + timedelta(seconds=49))]) == {"2", "3"}
    assert run([clock(DAY + timedelta(seconds=51))]) == {"3"}
    run(later)
    assert run([clock(DAY + timedelta(seconds=71))]) == {"1"}
    assert run([clock(DAY + timedelta(seconds=901))]) == set()
    got = spark.read.schema(S.ALERT_SCHEMA).parquet(out)
    found = {r.id: r.travel_id[8] for r in got.filter("trigger_kind = 'REQUEST'").collect()}
    assert found == {"a": "1", "b": "1", "c": "2", "d": "2", "e": "3"}
    told = sorted((r.seq, r.id, r.travel_id[8], r.last_travel_id) for r in got.filter("trigger_kind = 'TRAIN'").collect())
    assert told == [(55, i, "3", "ATL#DFW#3_TRAIN") for i in "abcd"] + [(70, i, "1", None) for i in "abcdefg"]


def test_expiry_needs_a_clock(spark, tmp_path):
    write_parts(spark, [random_events(1, 2, 3)], str(tmp_path / "in"))
    with pytest.raises(ValueError, match="clock"):
        matcher.match_stream(stream(spark, str(tmp_path / "in")), shards=1, expiring=True)


@pytest.mark.parametrize("when", ["before", "after"])
def test_a_crash_around_the_commit_loses_and_repeats_nothing(spark, tmp_path, monkeypatch, when):
    """Killed between writing a batch's data and entering it in the manifest, or right behind that."""
    events = random_events(47, routes=8, length=12)
    half = len(events) // 2
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    write_parts(spark, [events[:half], events[half:]], source)
    commit, killed = runs._commit, []

    def dying(spark, path, batch_id, folder):
        if batch_id == 1 and not killed:
            killed.append(folder)
            if when == "after":
                commit(spark, path, batch_id, folder)
            raise RuntimeError("killed")
        commit(spark, path, batch_id, folder)

    monkeypatch.setattr(runs, "_commit", dying)

    def run():
        alerts = matcher.match_stream(stream(spark, source), min_lead=None, shards=2)
        runs.start_alert_log(alerts, out, checkpoint, partitions=2).awaitTermination()

    with pytest.raises(Exception, match="killed"):
        run()
    assert spark.read.schema(S.LOG_SCHEMA).parquet(f"{out}/{killed[0]}").count() > 0  # written, and read only if committed
    assert runs.read_alert_log(spark, out, after_batch=0).isEmpty() == (when == "before")
    run()
    got = codec.decode_alerts(runs.read_alert_log(spark, out))
    wanted = Counter((a[0], a[3], a[4], a[5]) for a in replay(events)[0])
    assert Counter(tuple(r) for r in got.select("seq", "id", "travel_id", "last_travel_id").collect()) == wanted


def records(spark, topic, seqs, path):
    rows = [(topic, f"k{i}", "{}", DAY + timedelta(seconds=i), i) for i in seqs]
    logs.write_log(spark.createDataFrame(rows, S.LOG_SCHEMA).coalesce(1), path)
    time.sleep(0.05)  # positions go by time of writing


@pytest.mark.parametrize("start", ["latest", "earliest", "2030-01-01T00:00:05", '{"a": "latest", "b": "2030-01-01 00:00:04"}'])
def test_topics_start_at_their_positions(spark, tmp_path, start):
    path, out, checkpoint = (str(tmp_path / n) for n in ("log", "out", "checkpoint"))
    spark.dataSource.register(topics.TopicLog)

    def run():
        log = spark.readStream.format("topiclog").option("path", path).option("startingOffsets", start).load()
        runs.start_files(log, out, checkpoint).awaitTermination()
        return sorted(r.seq for r in spark.read.schema(S.LOG_SCHEMA).parquet(out).collect())

    for topic, seqs in (("a", range(0, 8)), ("b", range(100, 104)), ("b", range(2, 7))):
        records(spark, topic, seqs, path)
    first = {
        "latest": [], "earliest": [*range(8), *range(100, 104), *range(2, 7)],
        "2030-01-01T00:00:05": [5, 6, 7, *range(100, 104), 5, 6],
    }.get(start, [*range(100, 104), 4, 5, 6])
    assert run() == sorted(first)
    assert run() == sorted(first)  # nothing new
    for topic, seqs in (("a", [1, 50]), ("c", [3, 60])):
        records(spark, topic, seqs, path)
    early = [i for i in (1, 3) if start != "2030-01-01T00:00:05"]
    assert run() == sorted([*first, 50, 60, *early])
    whole = spark.read.format("topiclog").option("path", path).option("topics", "a,c,none").load()
    assert sorted((r.topic, r.seq) for r in whole.collect()) == [("a", i) for i in sorted([*range(8), 1, 50])] + [("c", 3), ("c", 60)]
