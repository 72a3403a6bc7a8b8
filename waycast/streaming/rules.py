"""What one event does to the state of its route, in two halves.

The timetable half follows updates and departures and tells what changed
(:class:`Change`): the best entry after the event, the travel everyone is moved from,
and what is said.  The request half keeps the active and the early (waiting) requests
and turns requests and changes into alerts.  It never sees the timetable, so the
requests of a busy route can be spread over any number of places that all get the same
changes.

All active alerts of a route name the best travel, so what they have in common is kept
once: the best entry, the number of updates so far and the travel the last update moved
everyone from.  An active request only remembers how many updates there were when it
got its first alert; an update rewrites one row and not one per request.

The timetable half works on ``best``/``set_best`` and the mapping ``timetable``, the
request half on ``route``/``set_route`` and the mappings ``active`` and ``early``.
Mappings have ``put``, ``remove``, ``items`` and ``clear``; :class:`DictState` is the
plain form of both.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any, NamedTuple

from waycast import schemas as S


class Entry(NamedTuple):
    travel_id: str
    travel_type: str
    departure_time: Any
    arrival_time: Any

    @property
    def rank(self):
        return self.arrival_time, self.travel_id


class Change(NamedTuple):
    """``told``: the entry alerts show; ``best``: the best entry from now on."""

    kind: str
    seq: int | None
    ts: Any
    id: str | None
    departure_location: str
    arrival_location: str
    told: Entry | None
    best: Entry | None
    moved_from: str | None


class Route(NamedTuple):
    best: Entry | None = None
    updates: int = 0
    moved_from: str | None = None


# The timetable half

def least(state) -> Entry | None:
    return min((entry for _, entry in state.timetable.items()), key=lambda e: e.rank, default=None)


def _change(event, told: Entry | None, best: Entry | None, moved_from: str | None) -> Change:
    return Change(event.kind, event.seq, event.ts, event.id, event.departure_location, event.arrival_location, told, best, moved_from)


def on_update(event, state) -> Change:
    before = state.best()
    entry = Entry(event.travel_id, event.kind, event.departure_time, event.arrival_time)
    state.timetable.put(event.travel_id, entry)
    best = before
    if best is None or entry.rank <= best.rank:
        best = entry
    elif entry.travel_id == best.travel_id:  # the best travel got later
        best = least(state)
    state.set_best(best)
    return _change(event, best, best, before.travel_id if before else None)


def on_departure(event, state) -> Change | None:
    """Nothing if the travel was not the best one."""
    before = state.best()
    state.timetable.remove(event.travel_id)
    if before is None or before.travel_id != event.travel_id:
        return None
    best = least(state)
    state.set_best(best)
    return _change(event, before, best, None)


def expire(now, route: tuple[str, str], state) -> Iterator[Change]:
    """Entries whose departure time has come leave the timetable, the earliest first.

    Nobody is alerted: requests that were told of the travel stay active and hear of the
    next update.
    """
    gone = sorted((e for _, e in state.timetable.items() if e.departure_time <= now), key=lambda e: (e.departure_time, e.travel_id))
    for entry in gone:
        state.timetable.remove(entry.travel_id)
        best = state.best()
        if best and best.travel_id == entry.travel_id:
            state.set_best(least(state))
            yield Change(S.EXPIRED, None, entry.departure_time, None, *route, None, state.best(), None)


def follow(event, state) -> Change | None:
    return on_departure(event, state) if event.kind == S.DEPARTURE else on_update(event, state)


# The request half

def _alert(cause, request_id: str, entry: Entry, last_travel: str | None, update_id: str | None, reason: str | None = None):
    return (
        cause.seq, cause.ts, cause.kind, request_id, entry.travel_id, last_travel, update_id,
        entry.travel_type, cause.departure_location, cause.arrival_location,
        entry.departure_time, entry.arrival_time, reason,
    )


def on_request(event, state) -> Iterator[tuple]:
    route = state.route()
    if route.best is None:
        state.early.put(event.id, event.seq)
        return
    state.active.put(event.id, route.updates)
    yield _alert(event, event.id, route.best, None, None)


def on_change(change: Change, state, tell: bool = True) -> Iterator[tuple]:
    """Without ``tell``, the state moves on and no alert is made, so active requests are not walked."""
    route = state.route()
    if change.kind == S.EXPIRED:
        state.set_route(route._replace(best=change.best))
    elif change.kind == S.DEPARTURE:
        for request_id, updates in state.active.items() if tell else ():
            last_travel = route.moved_from if updates < route.updates else None
            yield _alert(change, request_id, change.told, last_travel, change.id, S.DEPARTED)
        state.active.clear()
        state.set_route(route._replace(best=change.best))
    else:
        updates = route.updates + 1
        state.set_route(Route(change.best, updates, change.moved_from))
        for request_id, _ in state.active.items() if tell else ():
            yield _alert(change, request_id, change.told, change.moved_from, change.id)
        if route.best is None:  # only an empty timetable leaves requests waiting
            for request_id, _ in state.early.items():
                state.active.put(request_id, updates)
                if tell:
                    yield _alert(change, request_id, change.told, None, change.id)
            state.early.clear()


def apply(event, state, tell: bool = True) -> Iterator[tuple]:
    """Alerts of one event on a state with both halves, as tuples in the order of the alert columns."""
    if event.kind == S.REQUEST:
        return on_request(event, state)
    change = follow(event, state)
    return iter(()) if change is None else on_change(change, state, tell)


class DictMap(dict):
    put = dict.__setitem__

    def remove(self, key):
        self.pop(key, None)


class DictState:
    """State of one route in memory."""

    def __init__(self):
        self._route, self._best = Route(), None
        self.timetable, self.active, self.early = DictMap(), DictMap(), DictMap()

    def best(self) -> Entry | None:
        return self._best

    def set_best(self, best: Entry | None) -> None:
        self._best = best

    def route(self) -> Route:
        return self._route

    def set_route(self, route: Route) -> None:
        self._route = route
