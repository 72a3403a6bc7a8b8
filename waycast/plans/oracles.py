"""The catalog's questions in plain SQL, written another way than the Spark plans.

State is found by joining events with validity intervals and ranking, without
epochs, chunks or carried rows; every event meets every entry it may see, which
is fine for checking and for nothing else.
"""

from __future__ import annotations

from waycast.plans.catalog import AS_OF

ROUTES = {
    "shared": ("user_id % 25", "user_id % 25 + 1 + (user_id // 25) % 2"),
    "per_user": ("user_id", "user_id + 1"),
    "daily": ("user_id", "user_id * 100 + day(ts)"),
    "single": ("0", "1"),
}
EVENT = "kind, seq, ts, id, departure_location, arrival_location, travel_id, departure_time, arrival_time"
ROUTE = "departure_location, arrival_location"
UPDATE = f"id AS update_id, travel_id, {ROUTE}, departure_time, arrival_time, seq, ts"
ALERT = f"""seq, alert_ts, trigger_kind, id, travel_id, last_travel_id, update_id, travel_type,
  {ROUTE}, departure_time, arrival_time, reason"""


def _events(routes: str = "shared", repeat_ids: bool = False, where: str = "TRUE") -> str:
    """``raw``: all events; ``ev``: those the lead-time filter keeps."""
    departure, arrival = ROUTES[routes]
    request_id = "'C' || user_id" if repeat_ids else "'R' || event_id"
    return f"""
parsed AS (
  SELECT event_id, ts, user_id, value,
    CASE event_type WHEN 'view' THEN 'TRAIN' WHEN 'click' THEN 'PLANE'
      WHEN 'signup' THEN 'REQUEST' WHEN 'purchase' THEN 'DEPARTURE' END AS kind,
    CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
    'S' || ({departure}) AS departure_location, 'S' || ({arrival}) AS arrival_location
  FROM events WHERE event_type IN ('view', 'click', 'signup', 'purchase') AND {where}
),
raw AS (
  SELECT kind, event_id AS seq, ts,
    CASE kind WHEN 'REQUEST' THEN {request_id} WHEN 'DEPARTURE' THEN 'D' || event_id ELSE 'U' || event_id END AS id,
    departure_location, arrival_location,
    CASE WHEN kind <> 'REQUEST' THEN departure_location || '#' || arrival_location || '#' || (k % 4) || '_' ||
      CASE WHEN kind <> 'DEPARTURE' THEN kind WHEN (k // 10) % 2 = 0 THEN 'TRAIN' ELSE 'PLANE' END END AS travel_id,
    CASE WHEN kind <> 'REQUEST' THEN ts + to_minutes(k) END AS departure_time,
    CASE WHEN kind <> 'REQUEST' THEN
      CAST(date_trunc('hour', ts + to_minutes(k)) AS TIMESTAMP)
      + to_hours(1 + CAST(floor(value) AS INTEGER) % 15)
    END AS arrival_time
  FROM parsed
),
ev AS (
  SELECT * FROM raw
  WHERE kind IN ('REQUEST', 'DEPARTURE') OR departure_time > ts + INTERVAL 5 MINUTE
)"""


_TIMETABLE = """
changes AS (
  SELECT *, lead(seq) OVER (PARTITION BY departure_location, arrival_location, travel_id ORDER BY seq) AS valid_to,
    lag(kind) OVER (PARTITION BY departure_location, arrival_location, travel_id ORDER BY seq) AS previous_kind
  FROM ev WHERE kind <> 'REQUEST'
),
entries AS (SELECT * FROM changes WHERE kind <> 'DEPARTURE'),
latest AS (
  SELECT * FROM entries
  QUALIFY row_number() OVER (PARTITION BY departure_location, arrival_location, travel_id ORDER BY seq DESC) = 1
)"""

# b_*: the best entry at each event: counting the event's own entry after an
# update, the departing travel before a departure.
_BEST = _TIMETABLE + """,
best AS (
  SELECT e.seq AS at_seq, t.seq AS b_seq, t.travel_id AS b_travel, t.kind AS b_type,
    t.departure_time AS b_departure, t.arrival_time AS b_arrival
  FROM ev e JOIN entries t
    ON t.departure_location = e.departure_location AND t.arrival_location = e.arrival_location
    AND t.seq <= e.seq
    AND (t.valid_to IS NULL OR t.valid_to > e.seq OR (t.valid_to = e.seq AND e.kind = 'DEPARTURE'))
  QUALIFY row_number() OVER (PARTITION BY e.seq ORDER BY t.arrival_time, t.travel_id) = 1
),
seen AS (SELECT e.*, b.* FROM ev e LEFT JOIN best b ON b.at_seq = e.seq)"""

_ALERTS = _BEST + """,
requests AS (
  SELECT r.*, lead(seq) OVER (PARTITION BY departure_location, arrival_location, id ORDER BY seq) AS replaced_at
  FROM seen r WHERE kind = 'REQUEST'
),
firsts AS (
  SELECT r.seq, min(u.seq) AS next_update
  FROM requests r JOIN ev u
    ON u.departure_location = r.departure_location AND u.arrival_location = r.arrival_location
    AND u.kind IN ('TRAIN', 'PLANE') AND u.seq > r.seq
  GROUP BY r.seq
),
started AS (
  SELECT r.*, CASE WHEN r.b_seq IS NOT NULL THEN r.seq ELSE f.next_update END AS started_at
  FROM requests r LEFT JOIN firsts f ON f.seq = r.seq
),
ends AS (
  SELECT s.seq, min(d.seq) AS closed_at
  FROM started s JOIN seen d
    ON d.departure_location = s.departure_location AND d.arrival_location = s.arrival_location
    AND d.kind = 'DEPARTURE' AND d.travel_id = d.b_travel AND d.seq > s.started_at
  GROUP BY s.seq
),
lives AS (SELECT s.*, e.closed_at FROM started s LEFT JOIN ends e ON e.seq = s.seq),
steps AS (
  SELECT l.id, l.seq AS r_seq, e.seq, e.ts, e.kind, e.id AS e_id, e.b_travel, e.b_type, e.b_departure, e.b_arrival,
    l.departure_location, l.arrival_location
  FROM lives l JOIN seen e
    ON e.departure_location = l.departure_location AND e.arrival_location = l.arrival_location
    AND e.seq >= l.started_at AND (l.closed_at IS NULL OR e.seq <= l.closed_at)
    AND (l.replaced_at IS NULL OR e.seq < l.replaced_at)
    AND (e.seq = l.seq OR e.kind IN ('TRAIN', 'PLANE') OR e.seq = l.closed_at)
),
alerts AS (
  SELECT seq, ts AS alert_ts, kind AS trigger_kind, id, b_travel AS travel_id,
    CASE WHEN kind = 'DEPARTURE' THEN lag(b_travel, 2) OVER w ELSE lag(b_travel) OVER w END AS last_travel_id,
    CASE WHEN kind <> 'REQUEST' THEN e_id END AS update_id, b_type AS travel_type,
    departure_location, arrival_location, b_departure AS departure_time, b_arrival AS arrival_time,
    CASE WHEN kind = 'DEPARTURE' THEN 'DEPARTED' END AS reason, r_seq
  FROM steps WINDOW w AS (PARTITION BY r_seq ORDER BY seq)
)"""

_TOPIC = """CASE kind WHEN 'REQUEST' THEN 'customerTravelRequested' WHEN 'PLANE' THEN 'planeTimeUpdated'
  WHEN 'TRAIN' THEN 'trainTimeUpdated' ELSE 'departed' END"""
_KEY = "CASE WHEN kind IN ('TRAIN', 'PLANE') THEN travel_id ELSE id END"


def _raw(select: str, **options) -> str:
    return f"WITH {_events(**options)}\n{select}"


def _timetable(select: str, **options) -> str:
    return f"WITH {_events(**options)},{_TIMETABLE}\n{select}"


def _best(select: str, **options) -> str:
    return f"WITH {_events(**options)},{_BEST}\n{select}"


def _alerts(select: str = f"SELECT {ALERT} FROM alerts", **options) -> str:
    return f"WITH {_events(**options)},{_ALERTS}\n{select}"


ORACLES: dict[str, str] = {
    "src_plane_updates": _raw(f"SELECT {UPDATE} FROM raw WHERE kind = 'PLANE'"),
    "src_train_updates": _raw(f"SELECT {UPDATE} FROM raw WHERE kind = 'TRAIN'"),
    "src_requests": _raw(f"SELECT id, {ROUTE}, seq, ts FROM raw WHERE kind = 'REQUEST'"),
    "src_departures": _raw(f"""SELECT id, travel_id, {ROUTE}, departure_time AS effective_departure_time,
        arrival_time AS expected_arrival_time, seq, ts FROM raw WHERE kind = 'DEPARTURE'"""),
    "src_event_log": _raw(f"SELECT {_TOPIC} AS topic, {_KEY} AS key, ts, seq, departure_location FROM raw"),
    "src_from_time": _raw(
        f"SELECT {_TOPIC} AS topic, {_KEY} AS key, ts, seq FROM raw WHERE ts >= TIMESTAMP '{AS_OF}'"),
    "src_topic_positions": _raw(f"""SELECT {_TOPIC} AS topic, {_KEY} AS key, ts, seq FROM raw
        WHERE kind <> 'DEPARTURE' AND (kind <> 'TRAIN' OR ts >= TIMESTAMP '{AS_OF}')"""),
    "src_topic_stream": _raw(
        f"SELECT {_TOPIC} AS topic, {_KEY} AS key, ts, seq FROM raw WHERE ts >= TIMESTAMP '{AS_OF}'"),
    "decode_events": _raw(f"SELECT {EVENT} FROM raw"),
    "decode_rejects": """
        SELECT event_id AS seq, 'planeTimeUpdated' AS topic,
          CASE CAST(json_extract_string(props, '$.k') AS INTEGER) % 3
            WHEN 0 THEN 'no value' WHEN 1 THEN 'not JSON' ELSE 'incomplete' END AS problem
        FROM events WHERE event_type = 'error'""",
    "encode_alerts": _alerts(f"""SELECT id AS key, seq, alert_ts, id, travel_id, last_travel_id, update_id, travel_type,
        {ROUTE}, departure_time, arrival_time, reason FROM alerts"""),
    "event_keys": _raw(f"""SELECT seq, kind, {_KEY} AS key,
        CAST(octet_length(encode({_KEY})) AS BIGINT) AS key_bytes FROM raw"""),
    "event_log_by_topic": _raw(f"""SELECT {_TOPIC} AS topic, {_KEY} AS key, count(*) AS n, max(seq) AS last_seq
        FROM raw GROUP BY 1, 2"""),
    "alerts_by_request_key": _alerts("SELECT id AS key, seq, id, travel_id FROM alerts"),
    "alerts_by_travel_key": _alerts("SELECT travel_id AS key, seq, id, travel_id FROM alerts"),
    "timetable_entries": _raw(f"SELECT {UPDATE}, kind AS travel_type FROM raw WHERE kind IN ('TRAIN', 'PLANE')"),
    "envelope_entry": _raw(f"""SELECT seq, id AS update_id, travel_id, {ROUTE}, departure_time, arrival_time,
        kind AS travel_type FROM raw WHERE kind IN ('TRAIN', 'PLANE')"""),
    "event_union": _raw(f"SELECT {EVENT} FROM raw"),
    "event_dispatch": _raw("""SELECT seq, CASE kind WHEN 'REQUEST' THEN 'request' WHEN 'DEPARTURE' THEN 'departure'
        ELSE 'update' END AS rule, id AS record_id FROM raw"""),
    "route_keys": _raw(f"""SELECT seq, {ROUTE}, departure_location || '#' || arrival_location AS route_key,
        departure_location || '-' || arrival_location AS dashed_route_key FROM raw"""),
    "travel_id_parts": _raw("""SELECT seq, travel_id, regexp_extract(travel_id, '^([^_]*)_', 1) AS slot_group,
        CAST(regexp_extract(travel_id, '#(\\d+)_', 1) AS INTEGER) AS slot,
        regexp_extract(travel_id, '_(TRAIN|PLANE)$', 1) AS travel_type, travel_id AS rebuilt
        FROM raw WHERE kind <> 'REQUEST'"""),
    "slot_groups": _raw("""SELECT replace(replace(travel_id, '_TRAIN', ''), '_PLANE', '') AS slot_group,
        count(*) AS events, min(seq) AS first_seq, max(seq) AS last_seq
        FROM raw WHERE kind <> 'REQUEST' GROUP BY 1"""),
    "state_keys": _best("""SELECT seq, b_travel || '#' || id AS active_key,
        departure_location || '#' || arrival_location || '#' || id AS early_key
        FROM seen WHERE kind = 'REQUEST'"""),
    "lead_time_filter": _raw(f"SELECT {EVENT} FROM ev"),
    "lead_time_dropped": _raw(f"""SELECT {EVENT} FROM raw
        WHERE kind IN ('TRAIN', 'PLANE') AND epoch_us(departure_time) - epoch_us(ts) <= 300000000"""),
    "request_best_match": _best(f"""SELECT seq, id, {ROUTE}, b_travel AS travel_id, b_type AS travel_type,
        b_departure AS departure_time, b_arrival AS arrival_time FROM seen WHERE kind = 'REQUEST'"""),
    "reoptimised_alerts": _alerts(f"""SELECT {ALERT} FROM alerts
        WHERE trigger_kind IN ('TRAIN', 'PLANE') AND last_travel_id IS NOT NULL"""),
    "early_request_match": _alerts(f"""SELECT {ALERT} FROM alerts a
        WHERE trigger_kind IN ('TRAIN', 'PLANE') AND last_travel_id IS NULL""", routes="per_user"),
    "timetable_intervals": _timetable(f"""SELECT {ROUTE}, travel_id, id AS update_id, departure_time, arrival_time,
        seq AS valid_from, valid_to FROM entries"""),
    "timetable_after_departures": _timetable(f"""SELECT {ROUTE}, travel_id, id AS update_id, kind AS travel_type,
        departure_time, arrival_time, seq FROM latest l
        WHERE NOT EXISTS (SELECT 1 FROM ev d WHERE d.kind = 'DEPARTURE' AND d.departure_location = l.departure_location
          AND d.arrival_location = l.arrival_location AND d.travel_id = l.travel_id AND d.seq > l.seq)"""),
    "departed_alerts": _alerts(f"SELECT {ALERT} FROM alerts WHERE reason IS NOT NULL"),
    "departures_without_travel": _timetable(f"""SELECT seq, id, {ROUTE}, travel_id FROM changes
        WHERE kind = 'DEPARTURE' AND (previous_kind IS NULL OR previous_kind = 'DEPARTURE')"""),
    "early_requests": _best(f"""SELECT seq, ts, id, {ROUTE} FROM seen
        WHERE kind = 'REQUEST' AND b_seq IS NULL""", routes="per_user"),
    "route_prefix_scan": _timetable("""SELECT route_key, requests, travel_id, id AS update_id, seq
        FROM (SELECT departure_location || '#' || arrival_location AS route_key, count(*) AS requests
              FROM ev WHERE kind = 'REQUEST' GROUP BY 1) r
        JOIN (SELECT * FROM entries WHERE valid_to IS NULL) l ON starts_with(l.travel_id, r.route_key || '#')"""),
    "best_per_route": _timetable(f"""SELECT {ROUTE}, arrival_time, travel_id, kind AS travel_type, departure_time
        FROM entries WHERE valid_to IS NULL
        QUALIFY row_number() OVER (PARTITION BY {ROUTE} ORDER BY arrival_time, travel_id) = 1"""),
    "best_tie_break": _timetable(f"""SELECT {ROUTE}, arrival_time, min(travel_id) AS travel_id, count(*) AS entries
        FROM (SELECT *, rank() OVER (PARTITION BY {ROUTE} ORDER BY arrival_time) AS place FROM entries WHERE valid_to IS NULL)
        WHERE place = 1 GROUP BY {ROUTE}, arrival_time"""),
    "timetable_latest": _timetable(f"""SELECT {ROUTE}, travel_id, id AS update_id, kind AS travel_type,
        departure_time, arrival_time, seq FROM latest"""),
    "timetable_sorted": _timetable(f"""SELECT {ROUTE}, travel_id, id AS update_id, kind AS travel_type,
        departure_time, arrival_time, seq FROM entries WHERE valid_to IS NULL ORDER BY travel_id"""),
    "active_alerts": _alerts(f"""SELECT {ALERT} FROM alerts
        WHERE r_seq IN (SELECT seq FROM lives WHERE replaced_at IS NULL AND closed_at IS NULL)
        QUALIFY row_number() OVER (PARTITION BY r_seq ORDER BY seq DESC) = 1"""),
    "alert_history": _alerts("SELECT id, seq, travel_id, last_travel_id, reason FROM alerts"),
    "best_timeline": f"""WITH {_events()},{_TIMETABLE},
        around AS (
          SELECT e.seq, t.travel_id, t.arrival_time,
            t.seq < e.seq AS was, t.valid_to IS NULL OR t.valid_to > e.seq AS stays
          FROM ev e JOIN entries t
            ON t.departure_location = e.departure_location AND t.arrival_location = e.arrival_location
            AND t.seq <= e.seq AND (t.valid_to IS NULL OR t.valid_to >= e.seq)
          WHERE e.kind <> 'REQUEST'
        ),
        b AS (SELECT * FROM around WHERE was
              QUALIFY row_number() OVER (PARTITION BY seq ORDER BY arrival_time, travel_id) = 1),
        a AS (SELECT * FROM around WHERE stays
              QUALIFY row_number() OVER (PARTITION BY seq ORDER BY arrival_time, travel_id) = 1)
        SELECT e.seq, e.kind, e.departure_location, e.arrival_location,
          b.travel_id AS before_travel_id, b.arrival_time AS before_arrival_time,
          a.travel_id AS after_travel_id, a.arrival_time AS after_arrival_time
        FROM ev e LEFT JOIN b ON b.seq = e.seq LEFT JOIN a ON a.seq = e.seq WHERE e.kind <> 'REQUEST'""",
    "request_lifetimes": _alerts(f"SELECT seq, id, {ROUTE}, started_at, closed_at, replaced_at FROM lives"),
    "alerts_merged": _alerts(),
    "early_remaining": _alerts(f"""SELECT seq, ts, id, {ROUTE} FROM started
        WHERE started_at IS NULL AND replaced_at IS NULL""", routes="daily"),
    "alerts_replay": _alerts(),
    "alerts_replay_repeated_ids": _alerts(repeat_ids=True),
    "alerts_replay_per_user": _alerts(routes="per_user"),
    "alerts_replay_single_route": _alerts(routes="single"),
    "alert_scenario_counts": _alerts("""SELECT CASE WHEN reason IS NOT NULL THEN 'departed'
          WHEN trigger_kind = 'REQUEST' THEN 'immediate' WHEN last_travel_id IS NULL THEN 'deferred'
          ELSE 're-optimised' END AS scenario, count(*) AS alerts FROM alerts GROUP BY 1"""),
    "alerts_changed_only": _alerts(f"""SELECT {ALERT} FROM alerts
        WHERE reason IS NOT NULL OR last_travel_id IS DISTINCT FROM travel_id"""),
    "state_as_of": _alerts(f"""
        SELECT 'timetable' AS state, {ROUTE}, id AS item, travel_id FROM entries WHERE valid_to IS NULL
        UNION ALL
        SELECT 'active', {ROUTE}, id, travel_id FROM (
          SELECT * FROM alerts WHERE r_seq IN (SELECT seq FROM lives WHERE replaced_at IS NULL AND closed_at IS NULL)
          QUALIFY row_number() OVER (PARTITION BY r_seq ORDER BY seq DESC) = 1)
        UNION ALL
        SELECT 'early', {ROUTE}, id, NULL FROM started WHERE started_at IS NULL AND replaced_at IS NULL
        """, routes="daily", where=f"ts <= TIMESTAMP '{AS_OF}'"),
    "state_at_points": _alerts(f"""
        , points AS (SELECT (SELECT max(event_id) + 1 FROM events) * i // 100 AS point FROM range(100) r(i)),
        held AS (SELECT point, e.* FROM points p JOIN entries e ON e.seq <= p.point AND (e.valid_to IS NULL OR e.valid_to > p.point)),
        top AS (SELECT * FROM held QUALIFY row_number() OVER (PARTITION BY point, {ROUTE} ORDER BY arrival_time, travel_id) = 1)
        SELECT point, 'timetable' AS state, {ROUTE}, id AS item, travel_id FROM held
        UNION ALL
        SELECT p.point, 'active', l.departure_location, l.arrival_location, l.id, t.travel_id
        FROM points p JOIN lives l ON l.started_at <= p.point AND (l.closed_at IS NULL OR l.closed_at > p.point)
          AND (l.replaced_at IS NULL OR l.replaced_at > p.point)
        LEFT JOIN top t ON t.point = p.point AND t.departure_location = l.departure_location AND t.arrival_location = l.arrival_location
        UNION ALL
        SELECT p.point, 'early', s.departure_location, s.arrival_location, s.id, NULL
        FROM points p JOIN started s ON s.seq <= p.point AND (s.started_at IS NULL OR s.started_at > p.point)
          AND (s.replaced_at IS NULL OR s.replaced_at > p.point)"""),
    "stream_timetable_feed": _timetable(f"""
        SELECT 'update' AS change_type, {ROUTE}, travel_id, kind AS travel_type, departure_time, arrival_time FROM entries
        UNION ALL
        SELECT 'delete', {ROUTE}, travel_id, NULL, NULL, NULL FROM changes WHERE kind = 'DEPARTURE' AND previous_kind IN ('TRAIN', 'PLANE')"""),
    "stream_alerts": _alerts(),
    "stream_alerts_unordered": _alerts(),
    "stream_alerts_rescaled": _alerts(),
    "stream_expired": _timetable(f"""SELECT r.seq, r.id, r.departure_location, r.arrival_location,
        t.travel_id, t.kind AS travel_type, t.departure_time, t.arrival_time
        FROM ev r JOIN entries t ON t.departure_location = r.departure_location AND t.arrival_location = r.arrival_location
          AND t.seq < r.seq AND (t.valid_to IS NULL OR t.valid_to > r.seq) AND t.departure_time > r.ts
        WHERE r.kind = 'REQUEST'
        QUALIFY row_number() OVER (PARTITION BY r.seq ORDER BY t.arrival_time, t.travel_id) = 1"""),
    "stream_alert_sink": _alerts(f"""SELECT id AS key, seq, alert_ts, id, travel_id, last_travel_id, update_id, travel_type,
        {ROUTE}, departure_time, arrival_time, reason FROM alerts"""),
    "stream_timetable_state": _timetable(f"""SELECT {ROUTE}, travel_id, kind AS travel_type, departure_time, arrival_time
        FROM entries WHERE valid_to IS NULL"""),
    "stream_active_state": _alerts(f"""SELECT id, {ROUTE}, travel_id, travel_type, departure_time, arrival_time,
        last_travel_id FROM alerts
        WHERE r_seq IN (SELECT seq FROM lives WHERE replaced_at IS NULL AND closed_at IS NULL)
        QUALIFY row_number() OVER (PARTITION BY r_seq ORDER BY seq DESC) = 1"""),
    "stream_early_state": _alerts(f"""SELECT id, {ROUTE}, seq FROM started
        WHERE started_at IS NULL AND replaced_at IS NULL""", routes="daily"),
    "timetable_map": _timetable(f"""SELECT {ROUTE}, row_number() OVER (PARTITION BY {ROUTE} ORDER BY travel_id) AS place,
        travel_id, id AS update_id, kind AS travel_type, departure_time, arrival_time
        FROM entries WHERE valid_to IS NULL"""),
    "early_request_list": _alerts(f"""SELECT {ROUTE}, row_number() OVER (PARTITION BY {ROUTE} ORDER BY seq) AS place,
        seq, id FROM started WHERE started_at IS NULL AND replaced_at IS NULL""", routes="daily"),
    "alert_map": _alerts(f"""SELECT row_number() OVER (PARTITION BY travel_id ORDER BY id, seq, {ROUTE}) AS place, * FROM (
          SELECT {ALERT} FROM alerts
          WHERE r_seq IN (SELECT seq FROM lives WHERE replaced_at IS NULL AND closed_at IS NULL)
          QUALIFY row_number() OVER (PARTITION BY r_seq ORDER BY seq DESC) = 1)"""),
}
ORACLES["src_from_latest"] = ORACLES["src_from_time"]
ORACLES["best_timeline_builtin"] = ORACLES["best_timeline"]
