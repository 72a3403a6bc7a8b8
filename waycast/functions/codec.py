"""Events and alerts as log records: text key, JSON value.

Times are written as decimal epoch seconds.  They are read in that form, exact
to the microsecond, or as ISO-8601 text.  Reading never fails: a record that
cannot be used comes back with its ``problem`` named.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waycast import schemas as S
from waycast.functions import times
from waycast.operators.streams import is_complete, is_update

# Field names inside the JSON documents.
EVENT_FIELDS = {
    S.REQUEST: {"id": "id", "departure_location": "departureLocation", "arrival_location": "arrivalLocation"},
    S.PLANE: {
        "id": "updateId", "travel_id": "travelId",
        "departure_location": "departureLocation", "arrival_location": "arrivalLocation",
        "departure_time": "departureTime", "arrival_time": "arrivalTime",
    },
    S.TRAIN: {
        "id": "updateId", "travel_id": "travelId",
        "departure_location": "departureLocation", "arrival_location": "arrivalLocation",
        "departure_time": "departureTime", "arrival_time": "arrivalTime",
    },
    S.DEPARTURE: {
        "id": "id", "travel_id": "travelId",
        "departure_location": "departureLocation", "arrival_location": "arrivalLocation",
        "departure_time": "effectiveDepartureTime", "arrival_time": "expectedArrivalTime",
    },
}
ALERT_FIELDS = {
    "id": "id", "travel_id": "travelId", "last_travel_id": "lastTravelId", "update_id": "updateId",
    "travel_type": "travelType", "departure_location": "departureLocation",
    "arrival_location": "arrivalLocation", "departure_time": "departureTime",
    "arrival_time": "arrivalTime", "reason": "reason",
}
TIME_COLUMNS = ("departure_time", "arrival_time")


def _document(fields: dict[str, str]) -> Column:
    members = [
        (times.epoch_seconds(F.col(c)) if c in TIME_COLUMNS else F.col(c)).alias(name)
        for c, name in fields.items()
    ]
    return F.to_json(F.struct(*members), {"ignoreNullFields": "false"})


def _by_kind(values: dict[str, Column]) -> Column:
    picked = F.lit(None).cast("string")
    for kind, value in values.items():
        picked = F.when(F.col("kind") == kind, value).otherwise(picked)
    return picked


def event_key() -> Column:
    """Updates are keyed by travel, requests and departures by their own id."""
    return F.when(F.col("kind").isin(*S.UPDATE_KINDS), F.col("travel_id")).otherwise(F.col("id"))


def alert_key(key_by: str = "request") -> Column:
    return F.col({"request": "id", "travel": "travel_id"}[key_by])


def encode_events(events: DataFrame) -> DataFrame:
    return events.select(
        _by_kind({k: F.lit(S.TOPICS[k]) for k in EVENT_FIELDS}).alias("topic"),
        event_key().alias("key"),
        _by_kind({k: _document(fields) for k, fields in EVENT_FIELDS.items()}).alias("value"),
        "ts", "seq",
    )


def encode_alerts(alerts: DataFrame, key_by: str = "request") -> DataFrame:
    return alerts.select(
        F.lit(S.TOPICS["ALERT"]).alias("topic"), alert_key(key_by).alias("key"),
        _document(ALERT_FIELDS).alias("value"), F.col("alert_ts").alias("ts"), "seq",
    )


def _parsed(names: set[str], time_names: set[str]) -> list[Column]:
    """The document read twice: times as exact decimals, and times as text."""
    plain = ", ".join(f"{n} string" for n in sorted(names - time_names))
    decimals = ", ".join(f"{n} decimal(20,9)" for n in sorted(time_names))
    texts = ", ".join(f"{n} string" for n in sorted(time_names))
    # most records hold numbers only and are read once
    has_text_time = F.col("value").rlike('"(' + "|".join(sorted(time_names)) + r')"\s*:\s*"')
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"}
    return [
        F.from_json("value", f"{plain}, {decimals}, _broken string", options).alias("_doc"),
        F.when(has_text_time, F.from_json("value", texts)).alias("_text"),
    ]


def _evaluated_once(frame: DataFrame, kept: list[str], fields: list[Column]) -> DataFrame:
    """``kept`` columns and computed ``fields``.

    A one-element explode: filters on the fields stay behind it, so they see
    values and do not parse or convert the record again for each mention.
    """
    return frame.select(*kept, F.explode(F.array(F.struct(*fields))).alias("_e")).select(*kept, "_e.*")


def _time(pick) -> Column:
    """A time field, ``pick`` choosing it out of either reading."""
    return F.coalesce(times.from_epoch_seconds(pick("_doc")), times.from_iso_text(pick("_text")))


def decode_events(log: DataFrame) -> DataFrame:
    """Log records as events plus ``problem``, null for a usable record."""
    names = {n for fields in EVENT_FIELDS.values() for n in fields.values()}
    time_names = {fields[c] for fields in EVENT_FIELDS.values() for c in TIME_COLUMNS if c in fields}
    kind = F.lit(None).cast("string")
    for name in EVENT_FIELDS:
        kind = F.when(F.col("topic") == S.TOPICS[name], name).otherwise(kind)
    parsed = log.select("topic", "key", "value", kind.alias("kind"), "seq", "ts", *_parsed(names, time_names))
    departed = F.col("kind") == S.DEPARTURE

    def time(update_field: str, departure_field: str) -> Column:
        return _time(lambda doc: F.when(is_update(), F.col(f"{doc}.{update_field}"))
                     .when(departed, F.col(f"{doc}.{departure_field}")))

    decoded = _evaluated_once(parsed, ["topic", "key", "value", "kind", "seq", "ts"], [
        F.when(is_update(), F.col("_doc.updateId")).otherwise(F.col("_doc.id")).alias("id"),
        F.col("_doc.departureLocation").alias("departure_location"),
        F.col("_doc.arrivalLocation").alias("arrival_location"),
        F.when(is_update() | departed, F.col("_doc.travelId")).alias("travel_id"),
        time("departureTime", "effectiveDepartureTime").alias("departure_time"),
        time("arrivalTime", "expectedArrivalTime").alias("arrival_time"),
        F.col("_doc._broken").isNotNull().alias("_broken"),
    ])
    problem = (
        F.when(F.col("kind").isNull(), "unknown topic")
        .when(F.col("value").isNull(), "no value")
        .when(F.col("_broken") & F.col("id").isNull(), "not JSON")
        .when(~is_complete(), "incomplete")
    )
    return decoded.withColumn("problem", problem).drop("_broken")


def accepted(decoded: DataFrame) -> DataFrame:
    return decoded.filter(F.col("problem").isNull()).select(*S.EVENT_COLUMNS)


def rejected(decoded: DataFrame) -> DataFrame:
    return decoded.filter(F.col("problem").isNotNull()).select("topic", "key", "value", "ts", "seq", "problem")


def decode_alerts(log: DataFrame) -> DataFrame:
    names = set(ALERT_FIELDS.values())
    time_names = {ALERT_FIELDS[c] for c in TIME_COLUMNS}
    parsed = log.select("key", "seq", F.col("ts").alias("alert_ts"), *_parsed(names, time_names))
    return _evaluated_once(parsed, ["key", "seq", "alert_ts"], [
        (_time(lambda doc, n=n: F.col(f"{doc}.{n}")) if c in TIME_COLUMNS else F.col(f"_doc.{n}")).alias(c)
        for c, n in ALERT_FIELDS.items()
    ])
