"""A plain sequential replay, written from the rules' text with whole alerts as state.

It shares nothing with the package but column names, so it can disagree.
"""

from __future__ import annotations

import random
from datetime import datetime, timedelta
from types import SimpleNamespace

DAY = datetime(2030, 1, 1)


def event(kind, seq, id, dep="ATL", arr="DFW", travel=None, departs=None, arrives=None):
    return SimpleNamespace(
        kind=kind, seq=seq, ts=DAY + timedelta(seconds=seq), id=id, departure_location=dep,
        arrival_location=arr, travel_id=travel, departure_time=departs, arrival_time=arrives,
    )


def as_rows(events):
    names = ["kind", "seq", "ts", "id", "departure_location", "arrival_location", "travel_id",
             "departure_time", "arrival_time"]
    return [tuple(getattr(e, n) for n in names) for e in events]


def replay(events):
    """Alerts as tuples in the order of the alert columns."""
    timetable, active, early, out = {}, {}, {}, []

    def best(route):
        entries = [u for (r, _), u in timetable.items() if r == route]
        return min(entries, key=lambda u: (u.arrival_time, u.travel_id), default=None)

    def fill(alert, update, update_id):
        alert["last"], alert["travel"] = alert["travel"], update.travel_id
        alert["type"], alert["dep_t"], alert["arr_t"] = update.kind, update.departure_time, update.arrival_time
        alert["update"] = update_id

    def emit(trigger, alert):
        route = alert["route"]
        out.append((trigger.seq, trigger.ts, trigger.kind, alert["id"], alert["travel"], alert["last"],
                    alert["update"], alert["type"], *route, alert["dep_t"], alert["arr_t"], alert["reason"]))

    def fresh(request_id, route):
        return {"id": request_id, "route": route, "travel": None, "last": None, "update": None, "reason": None}

    for e in sorted(events, key=lambda x: x.seq):
        route = (e.departure_location, e.arrival_location)
        if e.kind == "REQUEST":
            found = best(route)
            if found is None:
                early[route, e.id] = e
            else:
                alert = fresh(e.id, route)
                fill(alert, found, None)
                active[route, e.id] = alert
                emit(e, alert)
        elif e.kind == "DEPARTURE":
            timetable.pop((route, e.travel_id), None)
            for key in [k for k, a in active.items() if k[0] == route and a["travel"] == e.travel_id]:
                alert = active.pop(key)
                alert["reason"], alert["update"] = "DEPARTED", e.id
                emit(e, alert)
        else:
            timetable[route, e.travel_id] = e
            found = best(route)
            for key, alert in active.items():
                if key[0] == route:
                    fill(alert, found, e.id)
                    emit(e, alert)
            for key in [k for k in early if k[0] == route]:
                del early[key]
                alert = fresh(key[1], route)
                fill(alert, e, e.id)
                active[key] = alert
                emit(e, alert)
    left = {
        "timetable": sorted((*r, t) for r, t in timetable),
        "active": sorted((*r, i, a["travel"], a["last"], a["update"]) for (r, i), a in active.items()),
        "early": sorted((*r, i) for r, i in early),
    }
    return out, left


def random_events(seed, routes=40, length=30, arrivals=5, request_ids=7):
    """Short routes with many ties and repeated request ids, interleaved."""
    rng = random.Random(seed)
    events, seq = [], 0
    pending = [r for r in range(routes) for _ in range(rng.randint(1, length))]
    rng.shuffle(pending)
    for r in pending:
        seq += rng.randint(1, 3)
        dep, arr = f"A{r}", f"B{r % 3}"
        travel_type = rng.choice(["TRAIN", "PLANE"])
        travel = f"{dep}#{arr}#{rng.randint(0, 2)}_{travel_type}"
        kind = rng.choices(["UPDATE", "REQUEST", "DEPARTURE"], [3, 4, 2])[0]
        if kind == "REQUEST":
            events.append(event("REQUEST", seq, f"c{rng.randint(0, request_ids - 1)}", dep, arr))
        elif kind == "DEPARTURE":
            events.append(event("DEPARTURE", seq, f"d{seq}", dep, arr, travel, DAY, DAY))
        else:
            arrives = DAY + timedelta(hours=rng.randint(1, arrivals))
            events.append(event(travel_type, seq, f"u{seq}", dep, arr, travel, DAY, arrives))
    return events


def incomplete_events(routes):
    """Rows that miss something, on routes that are in use; they must not matter."""
    events, seq = [], 1_000_000
    for r in range(routes):
        dep, arr = f"A{r}", f"B{r % 3}"
        travel = f"{dep}#{arr}#0_TRAIN"
        for e in (
            event("TRAIN", 0, "x", dep, arr, travel, DAY, None), event("TRAIN", 0, "x", dep, arr, travel, None, DAY),
            event("TRAIN", 0, "x", dep, arr, None, DAY, DAY), event("TRAIN", 0, None, dep, arr, travel, DAY, DAY),
            event("BOAT", 0, "x", dep, arr, travel, DAY, DAY), event("TRAIN", 0, "x", None, arr, travel, DAY, DAY),
            event("DEPARTURE", 0, "x", dep, arr, None, DAY, DAY), event("DEPARTURE", 0, None, dep, arr, travel, DAY, DAY),
            event("REQUEST", 0, None, dep, arr), event("REQUEST", 0, "x", dep, None),
        ):
            seq += 1
            e.seq = seq if len(events) % 2 else -seq  # before and after the good ones
            events.append(e)
    return events
