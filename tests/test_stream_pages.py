"""Many small routes: as many state values as pages, and the alerts and state of the replay."""

from collections import Counter

import pytest
from by_hand import incomplete_events, random_events, replay
from test_streaming import bag, stream, write_parts

from waycast import schemas as S
from waycast.streaming import matcher, runs


@pytest.mark.parametrize("tell", [True, False])
def test_pages_of_routes_give_the_replay(spark, tmp_path, tell):
    events = random_events(52, routes=40, length=12)
    third = len(events) // 3
    junk = incomplete_events(12)
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    for part in (events[:third], events[third : 2 * third], events[2 * third :]):
        write_parts(spark, [[*part, *junk]], source)
        alerts = matcher.match_stream(stream(spark, source), min_lead=None, shards=2, pages=5, tell_changes=tell)
        runs.start_alert_files(alerts, out, checkpoint, partitions=2).awaitTermination()
    wanted, left = replay(events)
    assert bag(spark.read.schema(S.ALERT_SCHEMA).parquet(out)) == Counter(a for a in wanted if tell or a[2] == S.REQUEST)
    assert runs.read_state(spark, checkpoint, "page").count() <= 5
    timetable = runs.read_timetable(spark, checkpoint).select(*S.ROUTE, "travel_id")
    assert sorted(map(tuple, timetable.collect())) == left["timetable"]
    active = runs.read_active(spark, checkpoint).select(*S.ROUTE, "id", "travel_id", "last_travel_id")
    assert Counter(map(tuple, active.collect())) == Counter(a[:5] for a in left["active"])
    early = runs.read_early(spark, checkpoint)
    assert sorted(map(tuple, early.select(*S.ROUTE, "id").collect())) == left["early"]
    assert {r.seq for r in early.collect()} <= {e.seq for e in events if e.kind == S.REQUEST}


def test_pages_refuse_what_they_do_not_keep(spark, tmp_path):
    write_parts(spark, [random_events(1, 2, 3)], str(tmp_path / "in"))
    for options in ({"every_write": True}, {"expiring": True, "disorder": "1 hour"}, {"state": {"timetable": None}}):
        with pytest.raises(ValueError, match="pages"):
            matcher.match_stream(stream(spark, str(tmp_path / "in")), shards=1, pages=4, **options)


def test_early_state_has_no_key_per_route(spark, sf_dir, monkeypatch):
    """One state value per page, however many routes, users and days there are."""
    from waycast.plans import catalog

    kept = []
    replay_table = runs.replay_table
    monkeypatch.setattr(catalog.runs, "replay_table", lambda *a, **o: kept.append(replay_table(*a, parts=2, **o)) or kept[-1])
    monkeypatch.setattr(catalog, "PAGES", 8, raising=False)
    assert catalog.stream_early_state(spark, sf_dir).count() > 8
    operators = spark.read.format("state-metadata").load(kept[0][1]).select("operatorId").distinct().collect()
    assert len(operators) == 1 and runs.read_state(spark, kept[0][1], "page").count() <= 8
