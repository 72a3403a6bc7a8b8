"""What a stream holds back and packs: no event passes a Python worker by itself, and nothing is lost."""

import pickle
from collections import Counter
from datetime import timedelta

from by_hand import DAY, as_rows, event, random_events, replay
from test_streaming import bag, clock, stream, write_parts

from waycast import schemas as S
from waycast.streaming import matcher, runs


def test_events_are_held_back_by_built_in_state(spark, tmp_path):
    """Copies of a record are kept, and the clock runs below the lead-time filter, also in a run of its own."""
    events = random_events(51, routes=6, length=10)
    for e in events:
        if e.kind in S.UPDATE_KINDS:
            e.departure_time = e.ts + timedelta(hours=1)
    twice = [e for e in events if e.kind in S.UPDATE_KINDS][:3]
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))

    def run(part):
        write_parts(spark, [part], source)
        alerts = matcher.match_stream(stream(spark, source), shards=2, disorder="1 hour")
        runs.start_alert_files(alerts, out, checkpoint, partitions=2).awaitTermination()
        return runs.read_state(spark, checkpoint, "held").select("list_element.*")

    held = run([*events, *twice])
    assert Counter(r.seq for r in held.collect()) == Counter(e.seq for e in [*events, *twice])
    assert run([clock(DAY + timedelta(days=400))]).count() == 0
    assert bag(spark.read.schema(S.ALERT_SCHEMA).parquet(out)) == Counter(replay([*events, *twice])[0])
    operators = Counter(r.operatorName for r in spark.read.format("state-metadata").load(checkpoint).select("operatorId", "operatorName").distinct().collect())
    assert operators["stateStoreSave"] == 2 and operators.total() == 4


def test_events_of_a_key_travel_in_one_row(spark):
    events = [event("REQUEST", seq, f"r{seq}", arr=f"B{seq % 3}") for seq in range(60)]
    frame = spark.createDataFrame(as_rows(events), S.EVENT_SCHEMA).coalesce(1)
    packed = matcher._packed_events(frame, S.ROUTE, ["kind", "seq", "id"]).collect()
    assert sorted(r.arrival_location for r in packed) == ["B0", "B1", "B2"]
    assert sorted(e for r in packed for e in pickle.loads(r.events)) == [("REQUEST", seq, f"r{seq}") for seq in range(60)]


def test_alerts_of_a_batch_are_packed_and_unpacked(spark, monkeypatch):
    monkeypatch.setattr(matcher, "HELD_EVENTS", 3)
    alerts = [(seq, DAY, "TRAIN", f"r{seq}", "t", None, "u", "TRAIN", "A", "B", DAY, DAY, None) for seq in range(10)]
    packs = [(pickle.dumps([*zip(*alerts[a:b], strict=True)]),) for a, b in ((0, 4), (4, 5), (5, 10))]
    rows = matcher._unpacked_alerts(spark.createDataFrame(packs, matcher.ALERTS_SCHEMA))
    assert sorted(map(tuple, rows.collect())) == alerts
