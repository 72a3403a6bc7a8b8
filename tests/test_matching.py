"""Batch matching against literal scenarios and a sequential replay."""

import re
from collections import Counter

import pytest
from by_hand import DAY, as_rows, event, incomplete_events, random_events, replay
from pyspark.sql import functions as F
from scenarios import SCENARIOS, events_of, everything

from waycast import schemas as S
from waycast.operators import matching, snapshots, streams, timetable
from waycast.operators.chunks import cut_into_chunks
from waycast.operators.timeline import is_closing, opens_timetable
from waycast.sources import tables
from waycast.streaming.rules import DictState, apply


def frame(spark, events):
    return spark.createDataFrame(as_rows(events), S.EVENT_SCHEMA)


def bag(df):
    return Counter(tuple(r) for r in df.select(*S.ALERT_COLUMNS).collect())


def short(df):
    return Counter(tuple(r) for r in df.select("seq", "travel_id", "last_travel_id", "update_id", "reason").collect())


@pytest.mark.parametrize("name", SCENARIOS)
def test_rules_give_the_scenario_alerts(name):
    state = {}
    got = []
    for e in events_of(name):
        route = (e.departure_location, e.arrival_location)
        for a in apply(e, state.setdefault(route, DictState())):
            got.append((a[0], a[4], a[5], a[6], a[12]))
    assert got == SCENARIOS[name][1]


@pytest.mark.parametrize("rows_per_chunk", [250_000, 1, 2])
def test_batch_gives_the_scenario_alerts(spark, rows_per_chunk):
    events, expected = everything()
    history = matching.trace(frame(spark, events), rows_per_chunk)
    assert short(matching.all_alerts(history)) == Counter(expected)


@pytest.mark.parametrize("seed,rows_per_chunk", [(1, 250_000), (2, 250_000), (3, 1), (4, 3), (5, 7), (6, 4)])
def test_batch_equals_sequential_replay(spark, seed, rows_per_chunk):
    """Whole routes and routes cut into tiny chunks give the same alerts and the same end state."""
    events = random_events(seed)
    expected, left = replay(events)
    df = frame(spark, events)
    history = matching.trace(df, rows_per_chunk)
    assert bag(matching.all_alerts(history)) == Counter(expected)
    active = snapshots.active_alerts(history).select(*S.ROUTE, "id", "travel_id", "last_travel_id", "update_id")
    assert Counter(tuple(r) for r in active.collect()) == Counter(left["active"])
    early = snapshots.waiting_requests(history).select(*S.ROUTE, "id")
    assert sorted(tuple(r) for r in early.collect()) == left["early"]
    live = timetable.live(df).select(*timetable.TRAVEL)
    assert sorted(tuple(r) for r in live.collect()) == left["timetable"]


@pytest.mark.parametrize("rows_per_chunk", [250_000, 3])
def test_incomplete_events_change_nothing(spark, rows_per_chunk):
    events = random_events(8)
    history = matching.trace(frame(spark, events + incomplete_events(40)), rows_per_chunk)
    assert bag(matching.all_alerts(history)) == Counter(replay(events)[0])


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("shape", ["even", "gaps", "burst", "outlier"])
def test_no_chunk_is_much_larger_than_asked(spark, shape):
    """One hot route and some small ones; what ``seq`` looks like makes no difference."""
    n, limit = 4000, 200
    place = F.col("id")
    seq = {
        "even": place, "gaps": place * 1_000_003 + F.when(place > 2000, 10**15).otherwise(0),
        "burst": F.when(place < 50, place * 10**12).otherwise(10**15 + place), "outlier": F.when(place == 0, -(10**17)).otherwise(place),
    }[shape]
    hot = place % 10 != 0
    rows = spark.range(n).select(
        F.lit("REQUEST").alias("kind"), seq.cast("long").alias("seq"), F.lit(None).cast("timestamp_ntz").alias("ts"),
        F.concat(F.lit("r"), place).alias("id"), F.when(hot, "A").otherwise(F.concat(F.lit("X"), place)).alias("departure_location"),
        F.lit("B").alias("arrival_location"), F.lit(None).cast("string").alias("travel_id"),
        F.lit(None).cast("timestamp_ntz").alias("departure_time"), F.lit(None).cast("timestamp_ntz").alias("arrival_time"),
    )
    cut = cut_into_chunks(rows, limit)
    sizes = cut.events.groupBy(*S.ROUTE, "chunk").count().collect()
    assert sum(r["count"] for r in sizes) == n and max(r["count"] for r in sizes) <= 2 * limit
    chunks = sorted((r for r in sizes if r.departure_location == "A"), key=lambda r: r.chunk)
    assert [r.chunk for r in chunks] == list(range(len(chunks))) and len(chunks) > n / limit / 2
    borders = cut.events.filter("departure_location = 'A'").groupBy("chunk").agg(F.min("seq").alias("a"), F.max("seq").alias("b")).orderBy("chunk").collect()
    assert all(x.b < y.a for x, y in zip(borders, borders[1:], strict=False))


def test_cut_routes_are_never_joined_on_the_bare_route(spark, monkeypatch):
    monkeypatch.setattr("waycast.operators.chunks.ROWS_PER_FILE", 10)
    history = matching.trace(frame(spark, random_events(7)), 40)
    assert history.cut.is_cut
    for df in (matching.all_alerts(history), timetable.intervals(history.cut)):
        for line in plan_of(df).splitlines():
            if "Join " in line:
                assert any(name in line for name in ("chunk", "_range", "epoch", "level")), line
    assert bag(matching.all_alerts(history)) == Counter(replay(random_events(7))[0])


def test_one_event_per_epoch_joins_give_the_same(spark):
    events = random_events(12)
    for rows in (250_000, 30):
        history = matching.trace(frame(spark, events), rows)
        for wanted in (is_closing(), opens_timetable()):
            assert bag(matching.later_alerts(history, wanted, one_each=True)) == bag(matching.later_alerts(history, wanted))


@pytest.mark.parametrize("rows", [250_000, 30])
def test_counts_without_alerts_equal_the_alerts(spark, rows):
    history = matching.trace(frame(spark, random_events(15)), rows)
    counted = {r.seq: r.active for r in matching.active_at_events(history).collect() if r.active}
    sent = Counter(r.seq for r in matching.later_alerts(history).select("seq").collect())
    assert counted == dict(sent)


def test_timeline_streams_over_batches(spark):
    """Chunks that run over many Arrow batches keep what is open between them."""
    events = random_events(13, routes=3, length=200)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert bag(matching.all_alerts(matching.trace(frame(spark, events)))) == Counter(replay(events)[0])
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_incomplete_events_are_no_timetable_entries(spark):
    events = random_events(14)
    junk = incomplete_events(40)
    for e in junk[::5]:
        e.seq = None
    clean, mixed = frame(spark, events), frame(spark, events + junk)
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(timetable.live(mixed)) == rows(timetable.live(clean))
    assert rows(timetable.latest(mixed)) == rows(timetable.latest(clean))
    assert rows(timetable.best_per_route(timetable.live(mixed))) == rows(timetable.best_per_route(timetable.live(clean)))
    assert rows(timetable.intervals(cut_into_chunks(mixed))) == rows(timetable.intervals(cut_into_chunks(clean)))
    assert rows(timetable.unmatched_departures(mixed, timetable.intervals(cut_into_chunks(mixed)))) == rows(
        timetable.unmatched_departures(clean, timetable.intervals(cut_into_chunks(clean))))


def test_one_long_route_in_many_chunks(spark):
    """A single route, as long epochs and long-lived entries cross many chunks."""
    events = random_events(11, routes=1, length=600, arrivals=50, request_ids=300)
    rare = [e for e in events if e.kind != "DEPARTURE" or e.seq % 10 == 0]
    for chosen in (events, rare):
        history = matching.trace(frame(spark, chosen), 20)
        assert bag(matching.all_alerts(history)) == Counter(replay(chosen)[0])


@pytest.mark.parametrize("rows_per_chunk", [250_000, 2])
def test_intervals_do_not_depend_on_chunks(spark, rows_per_chunk):
    events = [e for e in random_events(21) if e.kind != "REQUEST"]
    following = {}
    expected = {}
    for e in sorted(events, key=lambda x: -x.seq):
        key = (e.departure_location, e.arrival_location, e.travel_id)
        if e.kind != "DEPARTURE":
            expected[e.seq] = following.get(key)
        following[key] = e.seq
    got = timetable.intervals(cut_into_chunks(frame(spark, events), rows_per_chunk))
    assert {r.valid_from: r.valid_to for r in got.collect()} == expected


def test_sequential_rules_equal_replay():
    events = random_events(31, routes=200)
    states, got = {}, []
    for e in events:
        got += apply(e, states.setdefault((e.departure_location, e.arrival_location), DictState()))
    assert Counter(got) == Counter(replay(events)[0])


def test_lead_time_limit_is_strict(spark):
    (base,) = [e for e in events_of("T5") if e.kind == "TRAIN"]
    df = frame(spark, [base]).withColumn("as_of", F.col("departure_time") - F.expr("INTERVAL 5 MINUTES"))
    assert streams.apply_lead_time(df, as_of=F.col("as_of")).count() == 0
    later = df.withColumn("departure_time", F.col("departure_time") + F.expr("INTERVAL '0.000001' SECOND"))
    assert streams.apply_lead_time(later, as_of=F.col("as_of")).count() == 1
    assert streams.apply_lead_time(df, min_lead=None).count() == 1


def test_known_counts(spark, sf_dir):
    events = streams.apply_lead_time(tables.read_events(spark, sf_dir))
    assert matching.all_alerts(matching.trace(events)).count() == 1958
    early_part = events.filter("seq <= 100")
    history = matching.trace(early_part)
    assert snapshots.waiting_requests(history).count() == 5
    assert snapshots.active_alerts(history).count() == 20
    assert timetable.live(early_part).count() == 24
    repeated = streams.apply_lead_time(tables.read_events(spark, sf_dir, repeat_ids=True))
    assert matching.all_alerts(matching.trace(repeated)).count() == 521


def test_items_have_their_places(spark):
    rows = [("A", "B", f"t{i:03}", i) for i in range(250)] + [("C", "D", "t0", 1)]
    df = spark.createDataFrame(rows, "departure_location string, arrival_location string, travel_id string, seq long")
    got = timetable.as_items(df, S.ROUTE, "travel_id", ["seq"]).collect()
    assert sorted((r.departure_location, r.place, r.seq) for r in got) == sorted(
        [("A", i + 1, i) for i in range(250)] + [("C", 1, 1)])


def test_requests_visit_only_chunks_with_wanted_events(spark):
    """A cut route whose travel changes once: requests are not copied to the chunks that hold nothing of interest."""
    events = [event("TRAIN", 0, "u0", travel="t1", departs=DAY, arrives=DAY)]
    events += [event("REQUEST", i, f"r{i}") if i % 2 else event("TRAIN", i, f"u{i}", travel="t1", departs=DAY, arrives=DAY) for i in range(1, 200)]
    events.append(event("TRAIN", 200, "u200", travel="t0", departs=DAY, arrives=DAY))
    history = matching.trace(frame(spark, events), rows_per_chunk=20)
    assert history.cut.is_cut
    changed = is_closing() | ~F.col("before.travel_id").eqNullSafe(F.col("after.travel_id"))
    pairs = matching.request_event_pairs(history, changed)
    assert pairs.count() == 100
    sides = pairs._jdf.queryExecution().optimizedPlan().toString()
    assert "ends_in" not in sides
    got = matching.immediate_alerts(history).unionByName(matching.later_alerts(history, changed))
    wanted = [a for a in replay(events)[0] if a[5] is None or a[5] != a[4] or a[12]]
    assert bag(got) == Counter(wanted)


def test_places_in_a_crowded_map(spark):
    """A key with most rows lies in several ranges, and no window is over the key alone."""
    rows = [("hot", f"{i:04d}", i) for i in range(3000)] + [(f"k{i % 40}", f"{i:04d}", i) for i in range(400)] + [(None, "x", 1)]
    items = spark.createDataFrame(rows, "k string, o string, v int").repartition(5)
    made = timetable.as_items(items, ["k"], "o", ["v"])
    places, expected = {}, set()
    for k, o, v in sorted(rows, key=lambda r: (r[0] or "", r[1])):
        places[k] = places.get(k, 0) + 1
        expected.add((k, places[k], o, v))
    assert {tuple(r) for r in made.collect()} == expected
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" in plan and all("_range" in line for line in plan.splitlines() if "Window [" in line)


def test_events_are_parsed_once(spark, sf_dir):
    from waycast.plans.catalog import CATALOG

    for name in ("best_per_route", "timetable_latest", "timetable_intervals", "alerts_replay"):
        plan = CATALOG[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
        scans = plan.count("Relation [")
        assert plan.count("get_json_object") == scans, name


@pytest.mark.parametrize("rows_per_chunk", [10_000, 15])
def test_state_index_at_every_point(spark, tmp_path, rows_per_chunk):
    from waycast.operators import index

    events = random_events(51, routes=6, length=20)
    path, every = str(tmp_path / "index"), 20
    index.build(matching.trace(frame(spark, events), rows_per_chunk), path, every)
    points = [0, *(e.seq for e in events), events[-1].seq + 5]
    got = {}
    for r in index.at(spark, path, points, every).collect():
        got.setdefault(r.point, {}).setdefault(r.state, []).append((r.departure_location, r.arrival_location, r.item, r.travel_id))
    for p in points:
        left, now = replay([e for e in events if e.seq <= p])[1], got.get(p, {})
        assert sorted((*r[:2], r[3]) for r in now.get("timetable", [])) == left["timetable"]
        assert sorted(now.get("active", [])) == sorted(tuple(a[:4]) for a in left["active"])
        assert sorted(r[:3] for r in now.get("early", [])) == left["early"]
    one = index.at(spark, path, [points[len(points) // 2]], every)
    assert re.search(r"PartitionFilters: \[[^\]]*block", one._jdf.queryExecution().executedPlan().toString())
    rows = spark.read.schema(index.SCHEMA).parquet(path)
    sizes = [r["count"] for r in rows.groupBy("block").count().collect()]
    assert max(sizes) < 0.5 * sum(sizes)


@pytest.mark.parametrize("rows_per_chunk", [10_000, 15, 1])
def test_best_travel_in_built_in_functions(spark, rows_per_chunk):
    events = random_events(52, routes=8, length=25) + incomplete_events(3)
    one, other = (matching.trace(frame(spark, events), rows_per_chunk, builtin=b) for b in (True, False))
    plan = one.timeline._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" not in plan
    columns = ["seq", "kind", "id", *S.ROUTE, "before", "after", "epoch", "updated_at", "updated_from"]
    assert Counter(map(str, one.timeline.select(*columns).collect())) == Counter(map(str, other.timeline.select(*columns).collect()))
