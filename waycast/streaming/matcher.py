"""The rules as chained stateful Structured Streaming operators.

1. :func:`hold_back` (only if ``disorder`` is given) keeps every event until the watermark
   has passed it.  A batch then lets out exactly the events up to its watermark, so
   sorting within a batch sorts the whole stream, whatever batch a record arrived in.
   It is a built-in aggregation, grouped by the whole event, that counts its copies: no
   event passes a Python worker for it, and no route or moment can crowd it.
2. ``FollowTimetable``, per route, holds the timetable, once, and turns updates and
   departures into changes of the best travel.
3. ``MatchRequests``, per route and shard, holds requests and turns them and the changes
   into alerts.  A route may hold a third of the traffic; requests of a route never
   affect each other, so ``shards`` splits them by their id, and every shard gets the
   (few) changes of its route, many of them packed in one row.

With ``pages``, steps 2 and 3 are one operator (:class:`KeepPages`) for streams of many small
routes: a page is all routes of a hash, with both halves of their state in one value, so
the calls of the state store are as many as pages and not as routes.

A row that enters or leaves a stateful operator costs far more than the work on it, so
events are packed by key before an operator and alerts behind it, in lists of plain
tuples, by functions on Arrow batches (:func:`_packed_events`, :func:`_unpacked_alerts`).

A call of the state store is a round trip to the JVM.  So what a batch needs of a key's
state is read once (:class:`_Memo`, :class:`_MapMemo`), and what it leaves is written at
the end.

With ``expire``, an entry also leaves the timetable when its departure time has come: at
the latest when the watermark passes it, by a timer, and before any later event is
looked at.
"""

from __future__ import annotations

import pickle
from collections import namedtuple
from collections.abc import Iterator
from datetime import datetime, timedelta

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from waycast import schemas as S
from waycast.functions import times
from waycast.operators.streams import apply_lead_time, is_complete
from waycast.streaming.rules import Change, DictMap, DictState, Entry, Route, apply, expire, follow, on_change, on_request

TEXT_KEY = T.StructType([T.StructField("key", T.StringType())])
COUNTER = T.StructType([T.StructField("n", T.LongType())])
ROUTE_SCHEMA = T.StructType(
    S.ENTRY_SCHEMA.fields
    + [T.StructField("updates", T.LongType()), T.StructField("moved_from", T.StringType())]
)
#: When a message takes effect, for the watermark; ``ts`` has no zone.
TIME = "_time"
EVENT_FIELDS = S.EVENT_SCHEMA.fields
HELD_SCHEMA = T.StructType([*EVENT_FIELDS, T.StructField(TIME, T.TimestampType())])
#: How often an event came.
COPIES = "copies"
#: Changes on their way to the request shards, ``PACK`` of a route in one row.
PACK_SCHEMA = T.StructType([*[f for f in EVENT_FIELDS if f.name in S.ROUTE], T.StructField("changes", T.BinaryType())])
PACKED = Row(*PACK_SCHEMA.fieldNames())
PACK = 500
#: Events that a task packs at a time.
HELD_EVENTS = 50_000
TIMETABLE_EVENT = namedtuple("TIMETABLE_EVENT", S.EVENT_SCHEMA.fieldNames())
REQUEST = namedtuple("REQUEST", ["kind", "seq", "ts", "id", *S.ROUTE, "changes"], defaults=[None])
ALERTS_SCHEMA = T.StructType([T.StructField("alerts", T.BinaryType())])
ALERTS = Row(*ALERTS_SCHEMA.fieldNames())
PAGE_SCHEMA = T.StructType([T.StructField("routes", T.BinaryType())])
#: A key with more rows than this in a map state is walked in the store and not kept in memory.
MEMO_ROWS = 100_000
NO_ENTRY = (None,) * len(S.ENTRY_SCHEMA.fields)
EPOCH = datetime(1970, 1, 1)


def _millis(time: datetime) -> int:
    """The millisecond by which a time without zone, in UTC, has passed."""
    return -((EPOCH - time) // timedelta(milliseconds=1))


def _entry(values) -> Entry | None:
    return Entry(*values) if values[0] is not None else None


def _pack(changes: list[Change]) -> bytes:
    """Plain tuples, so that reading them needs no class of this package."""
    return pickle.dumps([(*c[:4], c.told and tuple(c.told), c.best and tuple(c.best), c.moved_from) for c in changes], protocol=5)


def _unpack(packed: bytes, route: tuple[str, str]) -> Iterator[Change]:
    for kind, seq, ts, id_, told, best, moved_from in pickle.loads(packed):
        yield Change(kind, seq, ts, id_, *route, told and Entry(*told), best and Entry(*best), moved_from)


class _Memo:
    """A value state that a batch reads at most once and writes at its end."""

    def __init__(self, state, pack=lambda v: v, unpack=lambda v: v):
        self._state, self._pack, self._unpack = state, pack, unpack
        self.forget()

    def forget(self) -> None:
        self._known, self._changed, self._value = False, False, None

    def get(self):
        if not self._known:
            stored = self._state.get()  # None if there is none
            self._known, self._value = True, None if stored is None else self._unpack(stored)
        return self._value

    def set(self, value) -> None:
        if not self._known or value != self._value:
            self._known, self._changed, self._value = True, True, value

    def write(self) -> None:
        if self._changed:
            self._state.clear() if self._value is None else self._state.update(self._pack(self._value))
        self.forget()


class _MapMemo:
    """A Spark map state with the few calls the rules need.

    Its rows are read once, when they are first walked.  With ``through``, every put and
    removal is written as it comes, so that the state's change feed has all of them; else
    only what the batch leaves.  Beyond ``MEMO_ROWS`` rows nothing is kept and the store
    is walked, lazily.
    """

    def __init__(self, state, pack, unpack, through: bool = False):
        self._state, self._pack, self._unpack, self._through = state, pack, unpack, through
        self.forget()

    def forget(self) -> None:
        self._rows, self._unwritten, self._too_many, self._stored = None, {}, False, True

    def _walk(self):
        return ((key[0], self._unpack(value)) for key, value in self._state.iterator())

    def _update(self, key, value) -> None:
        self._state.updateValue((key,), self._pack(value))
        self._stored = True

    def _flush(self) -> None:
        for key, value in self._unwritten.items():  # None: removed
            self._state.removeKey((key,)) if value is None else self._update(key, value)
        self._unwritten = {}

    def _spill(self) -> None:
        self._flush()
        self._rows, self._too_many = None, True

    def _load(self) -> bool:
        """Whether all rows are in memory, read now if need be."""
        if self._rows is None and not self._too_many:
            rows = {}
            for key, value in self._walk() if self._stored else ():
                rows[key] = value
                if len(rows) > MEMO_ROWS:
                    self._spill()
                    return False
            self._rows = {**rows, **self._unwritten}
        return self._rows is not None

    def put(self, key, value):
        if self._through or self._too_many:
            self._update(key, value)
        else:
            self._unwritten[key] = value
        if self._rows is not None:
            self._rows[key] = value
        if max(len(self._unwritten), len(self._rows or ())) > MEMO_ROWS:
            self._spill()

    def remove(self, key):
        if self._load():
            if self._rows.pop(key, None) is None:
                return
            if not self._through:
                self._unwritten[key] = None
                return
        elif not self._state.containsKey((key,)):
            return
        self._state.removeKey((key,))

    def items(self):
        # no rule changes the mapping it walks
        return self._rows.items() if self._load() else self._walk()

    def clear(self):
        if self._stored:
            self._state.clear()
        self._rows, self._unwritten, self._too_many, self._stored = {}, {}, False, False

    def write(self) -> None:
        self._flush()
        self.forget()


class FollowTimetable(StatefulProcessor):
    """The timetable of a route; ``expiring`` entries leave at their departure time.

    One timer per route, for the earliest departure.
    """

    def __init__(self, expiring: bool = False, every_write: bool = False):
        self._expiring, self._every_write = expiring, every_write

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._best_state = _Memo(handle.getValueState("best", S.ENTRY_SCHEMA), tuple, lambda v: Entry(*v))
        # no entry departs before this millisecond; the timer is set for it
        self._due = _Memo(handle.getValueState("due", COUNTER), lambda at: (at,), lambda v: v[0])
        self.timetable = _MapMemo(handle.getMapState("timetable", TEXT_KEY, S.ENTRY_SCHEMA), tuple, lambda v: Entry(*v), self._every_write)

    def best(self) -> Entry | None:
        return self._best_state.get()

    def set_best(self, best: Entry | None) -> None:
        self._best_state.set(best)

    def _until_departure(self, entry: Entry) -> None:
        if self._expiring:
            at, due = _millis(entry.departure_time), self._due.get()
            if due is None or at < due:
                self._due.set(at)

    def _expire(self, now: datetime, key) -> Iterator[Change]:
        due = self._due.get()
        if due is None or _millis(now) < due:
            return
        yield from expire(now, key, self)
        self._due.set(min((_millis(e.departure_time) for _, e in self.timetable.items()), default=None))

    def _write(self, timer: int | None) -> None:
        """Ends a batch's work on a key, whose timer was set for ``timer``."""
        if self._expiring:
            due = self._due.get()
            if due != timer:
                if timer is not None:
                    self._handle.deleteTimer(timer)
                if due is not None:
                    self._handle.registerTimer(due)
        for state in (self._best_state, self._due, self.timetable):
            state.write()

    def handleInitialState(self, key, initialState: Row, timerValues) -> None:
        timer = self._due.get() if self._expiring else None
        entry = Entry(*(initialState[f] for f in S.ENTRY_SCHEMA.fieldNames()))
        self.timetable.put(entry.travel_id, entry)
        best = self.best()
        if best is None or entry.rank < best.rank:
            self.set_best(entry)
        self._until_departure(entry)
        self._write(timer)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        """One route's updates and departures of a micro-batch, whose size the source options bound."""
        timer = self._due.get() if self._expiring else None
        yield from self._packed(self._changes(key, sorted(rows, key=lambda row: row.seq)), key)
        self._write(timer)

    def _changes(self, key, events: list[Row]) -> Iterator[Change]:
        for event in events:
            if self._expiring:
                yield from self._expire(event.ts, key)
            change = follow(event, self)
            if event.kind != S.DEPARTURE:
                self._until_departure(Entry(event.travel_id, event.kind, event.departure_time, event.arrival_time))
            if change is not None:
                yield change

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        """Everything that has departed by the watermark leaves, in order of time; Spark then drops the timer."""
        passed = EPOCH + timedelta(milliseconds=timerValues.getCurrentWatermarkInMs())
        yield from self._packed(self._expire(passed, key), key)
        self._write(None)

    @staticmethod
    def _packed(changes: Iterator[Change], key) -> Iterator[Row]:
        pack = []
        for change in changes:
            pack.append(change)
            if len(pack) == PACK:
                yield PACKED(*key, _pack(pack))
                pack = []
        if pack:
            yield PACKED(*key, _pack(pack))


class MatchRequests(StatefulProcessor):
    """The requests of a shard; messages in order of time where entries expire, else of ``seq``."""

    def __init__(self, by_time: bool = False, tell_changes: bool = True):
        self._by_time, self._tell_changes = by_time, tell_changes

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._route = _Memo(
            handle.getValueState("route", ROUTE_SCHEMA),
            lambda r: (*(r.best or NO_ENTRY), r.updates, r.moved_from), lambda v: Route(_entry(v[:4]), v[4], v[5]))
        self.active = _MapMemo(handle.getMapState("active", TEXT_KEY, COUNTER), lambda n: (n,), lambda v: v[0])
        self.early = _MapMemo(handle.getMapState("early", TEXT_KEY, COUNTER), lambda n: (n,), lambda v: v[0])

    def route(self) -> Route:
        return self._route.get() or Route()

    def set_route(self, route: Route) -> None:
        self._route.set(route)

    def _write(self) -> None:
        for state in (self._route, self.active, self.early):
            state.write()

    def handleInitialState(self, key, initialState: Row, timerValues) -> None:
        if initialState.id is None:
            values = [initialState[f] for f in ROUTE_SCHEMA.fieldNames()]
            self.set_route(Route(_entry(values[:4]), *values[4:]))
        else:
            (self.active if initialState.is_active else self.early).put(initialState.id, initialState.n)
        self._write()

    def _order(self, message: Row | Change):
        # an expiry has no seq and comes before events of its moment
        return (message.ts, -1 if message.seq is None else message.seq) if self._by_time else message.seq

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        messages = []
        for row in rows:
            messages.extend([row] if row.changes is None else _unpack(row.changes, key[:2]))
        for message in sorted(messages, key=self._order):
            for alert in on_request(message, self) if message.kind == S.REQUEST else on_change(message, self, self._tell_changes):
                yield alert
        self._write()


class FollowPacked(FollowTimetable):
    """Takes :func:`_packed_events`."""

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        events = [TIMETABLE_EVENT(*e) for row in rows for e in pickle.loads(row.events)]
        yield from super().handleInputRows(key, events, timerValues)


class MatchPacked(MatchRequests):
    """Takes requests as :func:`_packed_events` and sends alerts by column, up to ``PACK`` in a row."""

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        return _alert_packs(super().handleInputRows(key, self._messages(rows), timerValues))

    @staticmethod
    def _messages(rows: Iterator[Row]) -> Iterator[Row]:
        for row in rows:
            if row.changes is None:
                yield from (REQUEST(*r) for r in pickle.loads(row.events))
            else:
                yield row


class KeepPages(StatefulProcessor):
    """All routes of a page: a value with the bytes of each route that has anything left.

    A batch reads and writes the pages it has events of, and unpacks the routes it has
    events of.  One route is worked on by one task and lies in one value, so this is for
    routes of a bounded number of requests.
    """

    def __init__(self, tell_changes: bool = True):
        self._tell_changes = tell_changes

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._page = handle.getValueState("page", PAGE_SCHEMA)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        stored = self._page.get()
        page, states = {} if stored is None else pickle.loads(stored[0]), {}
        events = [TIMETABLE_EVENT(*e) for row in rows for e in pickle.loads(row.events)]
        yield from _alert_packs(self._alerts(sorted(events, key=lambda e: e.seq), page, states))
        for route, state in states.items():
            if state.timetable or state.active or state.early:
                page[route] = _pack_route(state)
            else:  # what it counted and moved from concerns nobody
                page.pop(route, None)
        if page:
            self._page.update((pickle.dumps(page, protocol=5),))
        elif stored is not None:
            self._page.clear()

    def _alerts(self, events: list[tuple], page: dict, states: dict) -> Iterator[tuple]:
        for event in events:
            route = event.departure_location, event.arrival_location
            if route not in states:
                states[route] = _unpack_route(page[route]) if route in page else DictState()
            yield from apply(event, states[route], self._tell_changes)


def _pack_route(state: DictState) -> bytes:
    """Plain values; without expiry, the best entry of both halves is the same and one of the timetable."""
    best, (_, updates, moved_from) = state.best(), state.route()
    timetable = {travel: tuple(entry) for travel, entry in state.timetable.items()}
    return pickle.dumps((timetable, best and best.travel_id, updates, moved_from, dict(state.active), dict(state.early)), protocol=5)


def _unpack_route(packed: bytes) -> DictState:
    timetable, best, updates, moved_from, active, early = pickle.loads(packed)
    state = DictState()
    state.timetable = DictMap((travel, Entry(*entry)) for travel, entry in timetable.items())
    state.active, state.early = DictMap(active), DictMap(early)
    state.set_best(best and state.timetable[best])
    state.set_route(Route(state.best(), updates, moved_from))
    return state


def page_rows(pages: DataFrame, what: str) -> DataFrame:
    """``timetable``, ``active`` or ``early`` of all routes from column ``routes``, the values of :class:`KeepPages`."""
    text, number = T.StringType(), T.LongType()
    entry = [(f.name, f.dataType) for f in S.ENTRY_SCHEMA.fields]
    route = [(c, text) for c in S.ROUTE]
    columns = {"timetable": [*route, *entry], "active": [("id", text), *route, *entry, ("last_travel_id", text)],
               "early": [("id", text), *route, ("seq", number)]}[what]
    schema = T.StructType([T.StructField(*c) for c in columns])
    arrow = to_arrow_schema(schema)

    def rows_of(key: tuple[str, str], packed: bytes) -> Iterator[tuple]:
        timetable, best, updates, moved_from, active, early = pickle.loads(packed)
        if what == "timetable":
            return ((*key, *e) for e in timetable.values())
        if what == "early":
            return ((i, *key, seq) for i, seq in early.items())
        told = timetable[best] if best else NO_ENTRY
        return ((i, *key, *told, moved_from if n < updates else None) for i, n in active.items())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for page in batch.column("routes"):
                rows = [row for key, packed in pickle.loads(page.as_py()).items() for row in rows_of(key, packed)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), arrow, strict=True)], schema=arrow)

    return pages.select("routes").mapInArrow(work, schema)


def _alert_packs(alerts: Iterator[tuple]) -> Iterator[Row]:
    pack = []
    for alert in alerts:
        pack.append(alert)
        if len(pack) == PACK:
            yield ALERTS(pickle.dumps([*zip(*pack, strict=True)], protocol=5))
            pack = []
    if pack:
        yield ALERTS(pickle.dumps([*zip(*pack, strict=True)], protocol=5))


def _packed_events(events: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """``keys`` and the ``events`` that share them, tuples of ``fields``; several rows a key."""
    limit = HELD_EVENTS

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups, held, schema = {}, 0, None

        def packs() -> pa.RecordBatch:
            columns = [pa.array(c, schema.field(k).type) for c, k in zip(zip(*groups, strict=True), keys, strict=True)]
            blobs = [pickle.dumps(group, protocol=5) for group in groups.values()]
            return pa.RecordBatch.from_arrays([*columns, pa.array(blobs, pa.binary())], names=[*keys, "events"])

        for batch in batches:
            schema = batch.schema
            columns = {name: batch.column(name).to_pylist() for name in schema.names}
            rows = zip(*(columns[f] for f in fields), strict=True)
            for key, row in zip(zip(*(columns[k] for k in keys), strict=True), rows, strict=True):
                groups.setdefault(key, []).append(row)
            held += batch.num_rows
            if held >= limit:
                yield packs()
                groups, held = {}, 0
        if held:
            yield packs()

    types = {f.name: f for f in events.schema.fields}
    out = T.StructType([*(T.StructField(k, types[k].dataType) for k in keys), T.StructField("events", T.BinaryType())])
    return events.mapInArrow(work, out)


def _unpacked_alerts(packed: DataFrame) -> DataFrame:
    schema, limit = to_arrow_schema(S.ALERT_SCHEMA), HELD_EVENTS

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = [[] for _ in schema]

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

        for packs in batches:
            for pack in packs.column("alerts"):
                for column, values in zip(columns, pickle.loads(pack.as_py()), strict=True):
                    column.extend(values)
                if len(columns[0]) >= limit:
                    yield batch()
                    columns = [[] for _ in schema]
        if columns[0]:
            yield batch()

    return packed.mapInArrow(work, S.ALERT_SCHEMA)


def hold_back(events: DataFrame, disorder: str) -> DataFrame:
    """Complete events, let out when the stream is ``disorder`` (an interval) past them.

    Rows that are not complete move the clock as well, if they have a time: a clock
    record is one with nothing else.  Events that arrive after their time has passed are
    left out; Spark counts them in ``numRowsDroppedByWatermark``.
    """
    timed = events.withColumn(TIME, F.timestamp_micros((times.epoch_seconds(F.col("ts")) * 1000000).cast("bigint")))
    # a filter would be pushed below the clock, so what is incomplete is counted as none
    ready = timed.withWatermark(TIME, disorder).withColumn("complete", is_complete()).filter(F.col(TIME).isNotNull())
    held = ready.groupBy(*HELD_SCHEMA.fieldNames()).agg(F.count(F.when(F.col("complete"), 1)).alias(COPIES))
    return one_row_each(held)


def one_row_each(held: DataFrame) -> DataFrame:
    """Held events as often as they came.

    The columns are those of what is exploded, so that no filter on them is pushed below the clock.
    """
    copies = F.array_repeat(F.struct(*S.EVENT_SCHEMA.fieldNames()), F.col(COPIES).cast("int"))
    return held.select(TIME, F.explode(copies).alias("event")).select("event.*", TIME)


def _shard(shards: int):
    return F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int").alias("shard")


def match_stream(events: DataFrame, min_lead: int | None = S.MIN_LEAD_MINUTES, as_of=None, *, shards: int,
                 disorder: str | None = None, expiring: bool = False, state: dict[str, DataFrame] | None = None,
                 every_write: bool = False, tell_changes: bool = True, pages: int | None = None) -> DataFrame:
    """Alerts of a streaming event frame.  Filters run before the state's shuffle.

    ``shards`` is the number of tasks the requests of a single route can use.  It is part
    of the state's key: a checkpoint keeps it, and a new one can start from the
    ``state`` of an old one (``runs.saved_state``) with another.  Events the old one held
    back are a source of the new stream, so it takes them at every restart.

    ``disorder`` is how late records may arrive, in event time, and still be taken in
    their place; without it, arrival order decides across batches.  ``expiring`` needs
    it.  With ``every_write``, the timetable's change feed has every put and delete, at a
    call of the state store each; else what each batch leaves.

    Without ``tell_changes``, only alerts of requests that find a travel on arrival are
    made; the state is the same.  With ``expiring``, requests of a travel that expired stay
    active, so the alerts of changes may grow with the square of the stream.

    ``pages`` is for many small routes: their state lies in that many values, fixed by the
    checkpoint, and ``shards`` has no use.  A value grows with the routes of its page, and a
    batch rewrites the pages it has events of.
    """
    if pages is not None and (expiring or every_write or state):
        raise ValueError("pages keep no timers, no feed of every write, and start empty")
    if expiring and disorder is None:
        raise ValueError("expiring entries need an event-time clock: give disorder")
    state = state or {}
    if "held" in state:  # held events come once more, with those of the first batch
        events = events.unionByName(state["held"].select(*events.columns))
    is_request = F.col("kind") == S.REQUEST

    def of(kind: Column) -> DataFrame:
        """Both branches read the source; filters reach it."""
        if disorder is None:
            return events.filter(is_complete() & kind)
        return hold_back(events.filter(F.coalesce(kind, F.lit(True))), disorder)

    if pages is not None:
        rows = of(is_request).unionByName(apply_lead_time(of(~is_request), min_lead, as_of)).select(
            *TIMETABLE_EVENT._fields, F.pmod(F.xxhash64(*S.ROUTE), F.lit(pages)).cast("int").alias("page"))
        return _unpacked_alerts(_packed_events(rows, ["page"], [*TIMETABLE_EVENT._fields]).groupBy("page").transformWithState(
            KeepPages(tell_changes), ALERTS_SCHEMA, "Append", "None"
        ))
    requests = _packed_events(of(is_request).select("kind", "seq", "ts", "id", *S.ROUTE, _shard(shards)), [*S.ROUTE, "shard"], [*REQUEST._fields[:-1]])
    timetable = state.get("timetable")
    timed = apply_lead_time(of(~is_request), min_lead, as_of)
    if not expiring:  # packs have no time of their own, which timers ask for
        timed = _packed_events(timed.select(*TIMETABLE_EVENT._fields), S.ROUTE, [*TIMETABLE_EVENT._fields])
    follow = FollowTimetable if expiring else FollowPacked
    changes = timed.groupBy(*S.ROUTE).transformWithState(
        follow(expiring, every_write), PACK_SCHEMA, "Append", "EventTime" if expiring else "None",
        initialState=None if timetable is None else timetable.groupBy(*S.ROUTE),
    )
    everywhere = F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard")
    messages = requests.unionByName(changes.select("*", everywhere), allowMissingColumns=True)
    initial = None
    if "requests" in state:
        of = state["requests"].withColumn("shard", F.when(F.col("id").isNotNull(), F.array(_shard(shards))).otherwise(F.sequence(F.lit(0), F.lit(shards - 1))))
        initial = of.withColumn("shard", F.explode("shard")).groupBy(*S.ROUTE, "shard")
    return _unpacked_alerts(messages.groupBy(*S.ROUTE, "shard").transformWithState(
        MatchPacked(expiring, tell_changes), ALERTS_SCHEMA, "Append", "None", initialState=initial
    ))
