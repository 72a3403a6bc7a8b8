"""JSON, rejects, log and time functions."""

from collections import Counter
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from waycast import schemas as S
from waycast.functions import codec, keys, times
from waycast.operators import streams
from waycast.sources import logs, tables


def record(value, topic="trainTimeUpdated", seq=1):
    return (topic, None, value, datetime(2030, 1, 1), seq)


def log_of(spark, *records):
    return spark.createDataFrame(list(records), S.LOG_SCHEMA)


def test_bad_records_go_to_the_rejects(spark):
    good = ('{"updateId":"u1","travelId":"A#B#9_TRAIN","departureLocation":"A","arrivalLocation":"B",'
            '"departureTime":1893489000.123456789,"arrivalTime":"2030-01-01T13:00:00.5+01:00"}')
    no_route = '{"updateId":"u1","travelId":"A#B#9_TRAIN","departureTime":1,"arrivalTime":2}'
    decoded = codec.decode_events(log_of(
        spark, record(good, seq=1), record("{bad", seq=2), record(None, seq=3), record(no_route, seq=4),
        record(good, topic="other", seq=5), record("[1, 2]", seq=6), record("", seq=7)))
    (row,) = codec.accepted(decoded).collect()
    assert (row.kind, row.id, row.travel_id) == ("TRAIN", "u1", "A#B#9_TRAIN")
    assert row.departure_time == datetime(2030, 1, 1, 9, 10, 0, 123456)
    assert row.arrival_time == datetime(2030, 1, 1, 12, 0, 0, 500000)
    problems = {r.seq: r.problem for r in codec.rejected(decoded).collect()}
    assert {k: problems[k] for k in (2, 3, 4, 5)} == {2: "not JSON", 3: "no value", 4: "incomplete", 5: "unknown topic"}
    assert set(problems) == {2, 3, 4, 5, 6, 7}


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_times_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        moment = datetime(2024, 3, 10, 2, 30, 15, 123456)  # inside a daylight saving gap
        df = spark.createDataFrame([(moment,)], "t timestamp_ntz").select(
            times.from_epoch_seconds(times.epoch_seconds(F.col("t"))).alias("back"),
            times.hour_start(F.col("t")).alias("hour"), times.day_start(F.col("t")).alias("day"),
            times.from_iso_text(F.lit("2024-03-10T04:30:15.123456+02:00")).alias("iso"),
            streams.utc_now().alias("now"),
        )
        (row,) = df.collect()
        assert row.back == moment and row.iso == moment
        assert row.hour == datetime(2024, 3, 10, 2) and row.day == datetime(2024, 3, 10)
        assert abs((row.now - datetime.now(UTC).replace(tzinfo=None)).total_seconds()) < 60
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_events_survive_encoding_in_another_zone(spark, sf_dir):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        events = tables.read_events(spark, sf_dir)
        back = codec.accepted(codec.decode_events(codec.encode_events(events)))
        assert Counter(map(tuple, back.collect())) == Counter(map(tuple, events.select(*S.EVENT_COLUMNS).collect()))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_log_reads_topics_and_positions(spark, sf_dir, tmp_path):
    events = tables.read_events(spark, sf_dir)
    path = logs.write_log(codec.encode_events(events), str(tmp_path / "log"))
    log = logs.read_log(spark, path, ["departed"])
    assert log.count() == events.filter("kind = 'DEPARTURE'").count()
    assert logs.from_position(logs.read_log(spark, path), after_seq=500).agg(F.min("seq")).first()[0] > 500
    plan = log._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "departed" in plan


def test_keys(spark):
    row = spark.createDataFrame([("A", "B", "A#B#9_TRAIN", "c1")], "departure_location string, arrival_location string, travel_id string, id string").select(
        keys.route_key().alias("a"), keys.dashed_route_key().alias("b"), keys.slot_group().alias("c"),
        keys.travel_slot().alias("d"), keys.travel_type().alias("e"), keys.active_alert_key().alias("f"),
        keys.early_request_key().alias("g"), keys.travel_type(F.lit("A#B#9_BOAT")).alias("h"),
    ).first()
    assert tuple(row) == ("A#B", "A-B", "A#B#9", 9, "TRAIN", "A#B#9_TRAIN#c1", "A#B#c1", None)
