"""Windows by chunk run in as many partitions as there are ranges, not in a fixed number."""

from by_hand import as_rows, random_events, replay

from waycast import schemas as S
from waycast.operators import matching, timetable
from waycast.operators.chunks import cut_into_chunks


def test_partitions_grow_with_the_ranges(spark):
    events = random_events(53, routes=3, length=60)
    frame = spark.createDataFrame(as_rows(events), S.EVENT_SCHEMA)
    cut = cut_into_chunks(frame, rows_per_chunk=5)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert cut.ranges > partitions
    assert cut.dealt(cut.events).rdd.getNumPartitions() == cut.ranges
    assert timetable.intervals(cut).rdd.getNumPartitions() == cut.ranges
    whole = cut_into_chunks(frame)
    assert whole.dealt(whole.events) is whole.events
    alerts = matching.all_alerts(matching.trace(frame, rows_per_chunk=5))
    assert sorted(r.seq for r in alerts.collect()) == sorted(a[0] for a in replay(events)[0])
