"""Column layout of every record type.

All times are UTC instants kept as ``timestamp_ntz``, so no result depends on
the session time zone.  Every input also carries ``seq`` (order of arrival,
unique) and ``ts`` (event time).
"""

from __future__ import annotations

from pyspark.sql import types as T

# Record kinds, travel types, reason codes and topic names.
TRAIN = "TRAIN"
PLANE = "PLANE"
REQUEST = "REQUEST"
DEPARTURE = "DEPARTURE"
DEPARTED = "DEPARTED"
EXPIRED = "EXPIRED"
TOPICS = {
    "REQUEST": "customerTravelRequested",
    "PLANE": "planeTimeUpdated",
    "TRAIN": "trainTimeUpdated",
    "DEPARTURE": "departed",
    "ALERT": "travelChanged",
}

UPDATE_KINDS = (TRAIN, PLANE)
ROUTE = ["departure_location", "arrival_location"]
MIN_LEAD_MINUTES = 5


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


S, L, TS = T.StringType(), T.LongType(), T.TimestampNTZType()

REQUEST_SCHEMA = _struct(
    id=S, departure_location=S, arrival_location=S, seq=L, ts=TS
)
UPDATE_SCHEMA = _struct(
    update_id=S, travel_id=S, departure_location=S, arrival_location=S,
    departure_time=TS, arrival_time=TS, seq=L, ts=TS,
)
DEPARTURE_SCHEMA = _struct(
    id=S, travel_id=S, departure_location=S, arrival_location=S,
    effective_departure_time=TS, expected_arrival_time=TS, seq=L, ts=TS,
)
# One row per event of any kind; fields a kind does not have are null.
EVENT_SCHEMA = _struct(
    kind=S, seq=L, ts=TS, id=S, departure_location=S, arrival_location=S,
    travel_id=S, departure_time=TS, arrival_time=TS,
)
# What an alert copies from the timetable.
ENTRY_SCHEMA = _struct(travel_id=S, travel_type=S, departure_time=TS, arrival_time=TS)
ALERT_SCHEMA = _struct(
    seq=L, alert_ts=TS, trigger_kind=S, id=S, travel_id=S, last_travel_id=S,
    update_id=S, travel_type=S, departure_location=S, arrival_location=S,
    departure_time=TS, arrival_time=TS, reason=S,
)
LOG_SCHEMA = _struct(topic=S, key=S, value=S, ts=TS, seq=L)

EVENT_COLUMNS = EVENT_SCHEMA.fieldNames()
ALERT_COLUMNS = ALERT_SCHEMA.fieldNames()
