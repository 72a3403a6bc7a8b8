"""Text keys.  Joins use the key columns themselves; these are projections."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _columns(*names: str | Column) -> list[Column]:
    return [F.col(n) if isinstance(n, str) else n for n in names]


def _joined(*parts: Column) -> Column:
    # concat, not concat_ws: a null part must not silently shorten a key
    spaced = [parts[0]]
    for part in parts[1:]:
        spaced += [F.lit("#"), part]
    return F.concat(*spaced)


def route_key(departure="departure_location", arrival="arrival_location") -> Column:
    return _joined(*_columns(departure, arrival))


def dashed_route_key(departure="departure_location", arrival="arrival_location") -> Column:
    dep, arr = _columns(departure, arrival)
    return F.concat(dep, F.lit("-"), arr)


def travel_id(departure, arrival, slot: Column, travel_type: Column) -> Column:
    dep, arr = _columns(departure, arrival)
    return F.concat(dep, F.lit("#"), arr, F.lit("#"), slot.cast("string"), F.lit("_"), travel_type)


def slot_group(travel="travel_id") -> Column:
    (travel,) = _columns(travel)
    return F.split(travel, "_").getItem(0)


def travel_slot(travel="travel_id") -> Column:
    return F.element_at(F.split(slot_group(travel), "#"), -1).cast("int")


def travel_type(travel="travel_id") -> Column:
    """Type named by a travel id; null when it is not one of the known types."""
    (travel,) = _columns(travel)
    tail = F.element_at(F.split(travel, "_"), -1)
    return F.when(tail.isin("TRAIN", "PLANE"), tail)


def active_alert_key(travel="travel_id", request="id") -> Column:
    return _joined(*_columns(travel, request))


def early_request_key(departure="departure_location", arrival="arrival_location", request="id") -> Column:
    return _joined(*_columns(departure, arrival, request))
