"""A batch calls the state store as often as it leaves rows, not as often as it has events."""

import random
from collections import Counter

import pytest
from pyspark.sql import Row

from by_hand import random_events, replay
from waycast import schemas as S
from waycast.streaming import matcher


class Store:
    """The states and timers of one key, in memory, with the calls made."""

    def __init__(self):
        self.calls, self.values, self.maps, self.timers = Counter(), {}, {}, set()

    def getValueState(self, name, schema):
        return Value(self, name)

    def getMapState(self, name, key, value):
        return Map(self, name)

    def registerTimer(self, at):
        self.calls["timer"] += 1
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.remove(at)


class Value:
    def __init__(self, store, name):
        self.store, self.name = store, name

    def get(self):
        self.store.calls["get"] += 1
        return self.store.values.get(self.name)

    def update(self, value):
        self.store.calls["update"] += 1
        self.store.values[self.name] = tuple(value)

    def clear(self):
        self.store.values.pop(self.name, None)


class Map:
    def __init__(self, store, name):
        self.store, self.rows = store, store.maps.setdefault(name, {})

    def iterator(self):
        self.store.calls["walk"] += 1
        return iter(list(self.rows.items()))

    def containsKey(self, key):
        return key in self.rows

    def updateValue(self, key, value):
        self.store.calls["put"] += 1
        self.rows[key] = value

    def removeKey(self, key):
        self.store.calls["remove"] += 1
        self.rows.pop(key, None)

    def clear(self):
        self.store.calls["clear"] += 1
        self.rows.clear()


def run(events, batches, every_write=False, tell_changes=True):
    """The alerts of one route on one shard, and both stores."""
    route = (events[0].departure_location, events[0].arrival_location)
    follow, match = matcher.FollowTimetable(every_write=every_write), matcher.MatchRequests(tell_changes=tell_changes)
    stores = Store(), Store()
    follow.init(stores[0])
    match.init(stores[1])
    alerts, step = [], -(-len(events) // batches)
    for i in range(0, len(events), step):
        part = list(events[i : i + step])
        random.Random(3).shuffle(part)
        requests = [Row(**vars(e), changes=None) for e in part if e.kind == S.REQUEST]
        changes = list(follow.handleInputRows(route, iter([Row(**vars(e)) for e in part if e.kind != S.REQUEST]), None))
        alerts += map(tuple, match.handleInputRows(route, iter([*requests, *[Row(kind=None, **c.asDict()) for c in changes]]), None))
    return Counter(alerts), stores


def busy(length):
    return random_events(48, routes=1, length=length)


@pytest.mark.parametrize("every_write", [False, True])
@pytest.mark.parametrize("limit", [0, 3, 100_000])
@pytest.mark.parametrize("batches", [1, 4, 1000])
def test_any_memory_and_batches_give_the_replay(monkeypatch, limit, batches, every_write):
    monkeypatch.setattr(matcher, "MEMO_ROWS", limit)
    monkeypatch.setattr(matcher, "PACK", 7)
    events = busy(300)
    alerts, (follow, match) = run(events, batches, every_write)
    wanted, left = replay(events)
    assert alerts == Counter(wanted)
    assert sorted(key for (key,) in follow.maps["timetable"]) == sorted(row[-1] for row in left["timetable"])
    assert sorted(key for (key,) in match.maps["active"]) == sorted(row[2] for row in left["active"])
    assert sorted(key for (key,) in match.maps["early"]) == sorted(row[2] for row in left["early"])


def test_calls_of_a_batch_do_not_grow_with_its_events():
    calls = []
    for length in (100, 1000):
        _, stores = run(busy(length), 1)
        rows = sum(len(m) for s in stores for m in s.maps.values())
        calls.append(sum((s.calls for s in stores), Counter()).total() - rows)
    assert calls[1] <= calls[0] + 20


def test_the_feed_has_every_put_if_asked():
    events = busy(300)
    updates = sum(e.kind in S.UPDATE_KINDS for e in events)
    assert run(events, 2, every_write=True)[1][0].calls["put"] == updates
    assert run(events, 2)[1][0].calls["put"] < updates / 4


def test_one_timer_a_route_for_the_earliest_departure():
    events = [e for e in busy(300) if e.kind in S.UPDATE_KINDS]
    follow, store = matcher.FollowTimetable(expiring=True), Store()
    follow.init(store)
    list(follow.handleInputRows((events[0].departure_location, events[0].arrival_location), iter([Row(**vars(e)) for e in events]), None))
    assert len(store.timers) <= 1 and store.calls["timer"] <= 1


def test_first_matches_alone_walk_no_active_request_and_keep_the_state():
    events = busy(400)
    told, (_, all_state) = run(events, 3)
    first, (_, state) = run(events, 3, tell_changes=False)
    assert first == Counter({alert: n for alert, n in told.items() if alert[2] == S.REQUEST}) != told
    assert state.maps == all_state.maps and state.values == all_state.values
    assert state.calls["walk"] < all_state.calls["walk"]
