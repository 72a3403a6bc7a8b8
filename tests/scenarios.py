"""Scenario rows T1-T13 and T16 with the alerts they must give."""

from __future__ import annotations

from datetime import timedelta

from by_hand import DAY, event

TRAIN, PLANE = "ATL#DFW#9_TRAIN", "ATL#DFW#9_PLANE"


def _at(clock):
    hours, minutes = clock.split(":")
    return DAY + timedelta(hours=int(hours), minutes=int(minutes))


def _update(kind, id, travel, departs, arrives, dep="ATL", arr="DFW"):
    return lambda seq: event(kind, seq, id, dep, arr, travel, _at(departs), _at(arrives))


BLOCKS = {
    "train": _update("TRAIN", "u-t1", TRAIN, "09:10", "12:00"),
    "plane": _update("PLANE", "u-p1", PLANE, "09:40", "11:58"),
    "train_late": _update("TRAIN", "u-t2", TRAIN, "09:10", "13:00"),
    "plane_8": _update("PLANE", "u-p3", "ATL#DFW#8_PLANE", "08:20", "11:00"),
    "plane_tie": _update("PLANE", "u-p4", PLANE, "09:40", "12:00"),
    "plane_xy": _update("PLANE", "u-p2", "ATL#DFW#5_PLANE", "05:00", "08:00", "X", "Y"),
    "train_xyz": _update("TRAIN", "u-t9", "X#YZ#9_TRAIN", "09:10", "12:00", "X", "YZ"),
    "c1": lambda seq: event("REQUEST", seq, "c1"),
    "c1_xy": lambda seq: event("REQUEST", seq, "c1", "X", "Y"),
    "dep_train": lambda seq: event("DEPARTURE", seq, "d1", travel=TRAIN),
    "dep_plane": lambda seq: event("DEPARTURE", seq, "d2", travel=PLANE),
}

# name: (events in order, expected (seq, travel, last travel, update id, reason))
SCENARIOS = {
    "T1": ("train c1 plane plane_xy", [(2, TRAIN, None, None, None), (3, PLANE, TRAIN, "u-p1", None)]),
    "T2": ("c1", []),
    "T3": ("c1 train", [(2, TRAIN, None, "u-t1", None)]),
    "T4": ("c1 train dep_train", [(2, TRAIN, None, "u-t1", None), (3, TRAIN, None, "d1", "DEPARTED")]),
    "T5": ("train dep_train", []),
    "T6": ("dep_train", []),
    "T7": ("train c1 plane train_late dep_plane", [
        (2, TRAIN, None, None, None), (3, PLANE, TRAIN, "u-p1", None),
        (4, PLANE, PLANE, "u-t2", None), (5, PLANE, PLANE, "d2", "DEPARTED")]),
    "T8": ("train plane c1 dep_train dep_plane", [
        (3, PLANE, None, None, None), (5, PLANE, None, "d2", "DEPARTED")]),
    "T9": ("train c1 plane_8", [(2, TRAIN, None, None, None), (3, "ATL#DFW#8_PLANE", TRAIN, "u-p3", None)]),
    "T10": ("train plane_tie c1", [(3, PLANE, None, None, None)]),
    "T11": ("train_xyz c1_xy", []),
    "T12": ("c1 c1 train", [(3, TRAIN, None, "u-t1", None)]),
    "T13": ("train c1 c1 plane", [
        (2, TRAIN, None, None, None), (3, TRAIN, None, None, None), (4, PLANE, TRAIN, "u-p1", None)]),
    "T16": ("c1 train dep_train dep_train", [
        (2, TRAIN, None, "u-t1", None), (3, TRAIN, None, "d1", "DEPARTED")]),
}


def events_of(name, first_seq=1, location_prefix=""):
    """The scenario's events, on routes of its own when given a prefix."""
    events = []
    for offset, block in enumerate(SCENARIOS[name][0].split()):
        e = BLOCKS[block](first_seq + offset)
        e.departure_location = location_prefix + e.departure_location
        events.append(e)
    return events


def everything():
    """All scenarios in one list, and the expected rows with their seq moved along."""
    events, expected = [], []
    for number, (name, (_, alerts)) in enumerate(SCENARIOS.items()):
        base = number * 100
        events += events_of(name, base + 1, f"{name}:")
        expected += [(base + seq, *rest) for seq, *rest in alerts]
    return events, expected
