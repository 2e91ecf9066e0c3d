"""SQL for DuckDB that says what each query should return."""

from __future__ import annotations

from eqscene.plans import views as v

Q, S, TS, A, L, O, J, FT = (v.duck(x) for x in (v.QUAKE, v.SCENE, v.TRACK_SCENE, v.AREA, v.LAND, v.OPTICAL, v.JOB_SQL, v.FOOTPRINT))
HISTORIC = "mag >= 6.0 AND alert IN ('green', 'yellow', 'orange', 'red') AND depth_km <= 40"
FORWARD = "((mag >= 5.5 AND depth_km <= 15) OR (mag >= 6.0 AND depth_km <= 40))"

_BASE = f"""WITH ts AS ({TS}),
m AS (
  SELECT event_id, track, event_time, acq_date, sum(area)::BIGINT AS coverage, arg_min(start_time, pos) AS start_time,
         count(*) AS n_scenes, string_agg(scene_id, ',' ORDER BY pos) AS scenes
  FROM ts GROUP BY ALL),
mm AS (SELECT *, max(coverage) OVER (PARTITION BY event_id, track) AS max_coverage FROM m),
a AS (SELECT * FROM mm WHERE max_coverage > 0 AND coverage / max_coverage > 0.5)"""


def _next(source: str, where: str = "true") -> str:
    return f"""SELECT event_id, track, event_time, acq_date AS secondary_date, scenes AS secondary, start_time AS t1,
  lead(acq_date) OVER w AS reference_date, lead(scenes) OVER w AS reference, lead(start_time) OVER w AS t2
  FROM {source} WHERE {where} WINDOW w AS (PARTITION BY event_id, track ORDER BY acq_date)"""


_PAIR = "event_id, track, secondary_date, reference_date, secondary, reference"
_CO = f"""SELECT * FROM ({_next('a')}) WHERE t1 < event_time AND event_time < t2
  QUALIFY row_number() OVER (PARTITION BY event_id, track ORDER BY secondary_date) = 1"""
_SEQ = {k: f"SELECT * FROM ({_next('a', c)}) WHERE reference_date IS NOT NULL" for k, c in (("pre", "start_time < event_time"), ("post", "start_time > event_time"))}


def _all(condition: str) -> str:
    return f"""SELECT x.event_id, x.track, x.acq_date AS secondary_date, y.acq_date AS reference_date, x.scenes AS secondary, y.scenes AS reference
  FROM (SELECT * FROM a WHERE {condition}) x JOIN (SELECT * FROM a WHERE {condition}) y USING (event_id, track) WHERE x.acq_date < y.acq_date"""


def _asof(kind: str) -> str:
    side = "start_time < event_time" if kind == "pre" else "start_time > event_time"
    most = "sum(area)" if kind == "pre" else f"sum(area) FILTER ({side})"
    return f"""SELECT event_id, track, acq_date, coverage, scenes FROM (
  SELECT event_id, track, acq_date, (sum(area) FILTER ({side}))::BIGINT AS coverage,
         string_agg(scene_id, ',' ORDER BY pos) FILTER ({side}) AS scenes,
         max({most}) OVER (PARTITION BY event_id, track) AS most
  FROM ({TS}) GROUP BY event_id, track, acq_date)
WHERE coverage IS NOT NULL AND most > 0 AND coverage / most > 0.5
QUALIFY row_number() OVER (PARTITION BY event_id, track ORDER BY acq_date {'DESC' if kind == 'pre' else 'ASC'}) = 1"""


_OVERLAP = "e.minx < s.maxx AND s.minx < e.maxx AND e.miny < s.maxy AND s.miny < e.maxy"
_MET = f"""SELECT e.event_id, e.minx, e.miny, e.maxx, e.maxy, s.file_id, s.path_number, s.flight_direction, s.frame_number, s.acq_date,
  s.start_time, s.pos, e.window_start, s.minx AS sx1, s.miny AS sy1, s.maxx AS sx2, s.maxy AS sy2
  FROM ({A}) e JOIN ({S}) s ON {_OVERLAP} AND s.start_time BETWEEN e.window_start AND e.window_end"""

def _tiles(source: str) -> str:
    return f"""WITH t AS (SELECT * FROM ({source})
  QUALIFY row_number() OVER (PARTITION BY event_id, orbit_id, acq_date, tile_id ORDER BY cloud_cover, pos) = 1),
u AS (
  SELECT event_id, orbit_id, acq_date, count(DISTINCT (x, y))::DOUBLE / any_value((maxx - minx) * (maxy - miny)) * 100 AS coverage
  FROM (SELECT *, unnest(range(greatest(y1, miny::BIGINT), least(y2, maxy::BIGINT))) AS y FROM (SELECT *, unnest(range(greatest(x1, minx::BIGINT), least(x2, maxx::BIGINT))) AS x FROM t)) GROUP BY event_id, orbit_id, acq_date),
c AS (
  SELECT event_id, orbit_id, event_time, acq_date, avg(cloud_cover) AS cc, count(*) AS tile_count,
         any_value(coverage) AS coverage, string_agg(granule_id, ',' ORDER BY pos) AS scenes,
         abs(floor((epoch(acq_date::TIMESTAMP) - epoch(event_time)) / 86400))::BIGINT AS delta,
         CASE WHEN acq_date < event_time THEN 'pre' WHEN acq_date > event_time THEN 'post' END AS side
  FROM t JOIN u USING (event_id, orbit_id, acq_date) GROUP BY event_id, orbit_id, event_time, acq_date)"""


_TILES = _tiles(O)

_OPTICAL_JOBS = """, n AS (SELECT *, count(DISTINCT side) OVER (PARTITION BY event_id, orbit_id) AS sides FROM c),
  p AS (SELECT * FROM n WHERE sides = 2 QUALIFY row_number() OVER (PARTITION BY event_id, orbit_id, side ORDER BY coverage DESC, cc, delta, acq_date) = 1
    UNION ALL SELECT * FROM n WHERE sides = 1 QUALIFY row_number() OVER (PARTITION BY event_id, orbit_id, side ORDER BY cc, acq_date) = 1),
  g AS (SELECT event_id, orbit_id, sides, max(acq_date) FILTER (side = 'pre') AS d1, max(acq_date) FILTER (side = 'post') AS d2,
    max(scenes) FILTER (side = 'pre') AS s1, max(scenes) FILTER (side = 'post') AS s2 FROM p GROUP BY ALL)
  SELECT event_id, orbit_id, concat(s_name, '-S2-R', orbit_id, '-', coalesce(d1::VARCHAR, 'MISSING'), '_', coalesce(d2::VARCHAR, 'MISSING')) AS name,
    CASE WHEN sides = 1 THEN 'PARTIAL' END AS status_note, replace(coalesce(s1, ''), '.SAFE', '') AS reference, replace(coalesce(s2, ''), '.SAFE', '') AS secondary
  FROM g JOIN supplier ON s_suppkey = event_id"""
_OPTICAL_MET = f"""SELECT e.event_id, e.event_time, e.minx, e.miny, e.maxx, e.maxy, s.* FROM ({v.duck(v.OPTICAL_EVENT)}) e JOIN ({v.duck(v.OPTICAL_SCENE)}) s
  ON e.minx < x2 AND x1 < e.maxx AND e.miny < y2 AND y1 < e.maxy AND s.start_time >= date_trunc('day', event_time - INTERVAL 90 DAY)
 AND s.start_time <= date_trunc('day', event_time + INTERVAL 30 DAY)::TIMESTAMP + INTERVAL 1 DAY - INTERVAL 1 SECOND"""

#: The same for the events of a historic run: strong, near an island, 90 days to either side.
_HISTORIC_MET = f"""SELECT e.event_id, e.event_time, e.minx, e.miny, e.maxx, e.maxy, s.* FROM ({v.duck(v.OPTICAL_EVENT)}) e JOIN ({v.duck(v.OPTICAL_SCENE)}) s
  ON e.minx < x2 AND x1 < e.maxx AND e.miny < y2 AND y1 < e.maxy AND s.start_time >= event_time - INTERVAL 90 DAY AND s.start_time <= event_time + INTERVAL 90 DAY
  WHERE e.event_id % 40 >= 10 AND EXISTS (FROM (SELECT n_nationkey * 7 % 34 - 1 AS a, n_nationkey * 5 % 34 - 1 AS b FROM nation)
    WHERE pow(greatest(a - e.minx - 3, 0, e.minx + 3 - a - 4), 2) + pow(greatest(b - e.miny - 3, 0, e.miny + 3 - b - 4), 2) < 1)"""
_SNAKE = "lower(replace(s_name, '#', ''))"

#: Footprints of whole units: the union's area is the number of unit squares that any covers.
_FOOT = f"""ft AS ({FT}),
sq AS (SELECT *, unnest(range(greatest(y1, 0), least(y2, 10))) AS y FROM (SELECT *, unnest(range(greatest(x1, 0), least(x2, 10))) AS x FROM ft))"""


def _asof_foot(kind: str) -> str:
    side = "start_time < event_time" if kind == "pre" else "start_time > event_time"
    whole = "true" if kind == "pre" else side
    return f"""SELECT '{kind}' AS side, event_id, track, acq_date, coverage, scenes FROM (
  SELECT event_id, track, acq_date, scenes, coverage, max(whole) OVER (PARTITION BY event_id, track) AS most
  FROM (SELECT event_id, track, acq_date, string_agg(scene_id, ',' ORDER BY pos) FILTER ({side}) AS scenes FROM ft GROUP BY ALL)
  JOIN (SELECT event_id, track, acq_date, count(DISTINCT (x, y)) FILTER ({side})::DOUBLE AS coverage,
          count(DISTINCT (x, y)) FILTER ({whole}) AS whole FROM sq GROUP BY ALL) USING (event_id, track, acq_date))
WHERE scenes IS NOT NULL AND most > 0 AND coverage / most > 0.95
QUALIFY row_number() OVER (PARTITION BY event_id, track ORDER BY acq_date {'DESC' if kind == 'pre' else 'ASC'}) = 1"""


_EXPECTED = {
    t: f"""SELECT doc_id, concat('share/', year, '/', event, '/prod.', doc_id, '/prod.', doc_id, '.zip') AS key
  FROM ({v.duck(v.DELIVERED)} FROM {t}) WHERE year IS NOT NULL"""
    for t in ("documents", "labels")
}

_NAMED = f"""SELECT *, regexp_extract(name, '^(.*)-([^-]*)$', 1) AS event_name, regexp_extract(name, '^(.*)-([^-]*)$', 2) AS track FROM ({J})"""
_CONFORMS = "len(list_filter(granules || secondary_granules, lambda g: NOT (contains(g, 'IW') AND (contains(g, '1SDV') OR contains(g, '1SSV'))))) = 0"


_TURN = "SELECT * REPLACE (if(pos % 2 = 0, list_reverse(granules), granules) AS granules, if(pos % 2 = 0, list_reverse(secondary_granules), secondary_granules) AS secondary_granules)"


def _turned(key: str, magnitude: str) -> str:
    return f"""SELECT pos, name FROM ({_TURN} FROM ({_NAMED})) QUALIFY row_number() OVER (PARTITION BY {key.format('granules')}, {key.format('secondary_granules')}
  ORDER BY coalesce(TRY_CAST(regexp_extract(name, '{magnitude}', 1) AS INT), -1) DESC, pos) = 1"""


def _dedupe(variant: str = "m_") -> str:
    return f"""SELECT *, row_number() OVER (PARTITION BY granules, secondary_granules
  ORDER BY coalesce(TRY_CAST(regexp_extract(name, '^m_(\\d+)', 1) AS INT), -1) DESC, pos) = 1 AS keep FROM ({_NAMED})"""


_STATE = f"""WITH pre AS ({_asof('pre')}), post AS ({_asof('post')}),
st AS (
  SELECT pre.event_id, pre.track, pre.acq_date AS reference_date, post.acq_date AS post_date,
    CASE WHEN post.acq_date IS NULL OR (pre.event_id + pre.track) % 7 = 0 THEN 'AWAITING_POST_SEISMIC'
         WHEN pre.event_id % 2 <> 0 THEN 'READY_FOR_EMAIL'
         WHEN (pre.event_id + pre.track) % 5 = 0 THEN 'FAILED_NEEDS_ATTENTION' ELSE 'REMOVED' END AS status
  FROM pre LEFT JOIN post USING (event_id, track))"""

#: Union of boxes within a box by slabs: distinct heights, then merged spans in each slab.
_G = "event_id, path_number, flight_direction, acq_date"
_AREA = f"""b AS (SELECT {_G}, greatest(sx1, minx) AS x1, least(sx2, maxx) AS x2, greatest(sy1, miny) AS y1, least(sy2, maxy) AS y2 FROM met),
y AS (SELECT DISTINCT {_G}, y1 AS y FROM b UNION SELECT DISTINCT {_G}, y2 FROM b),
slab AS (SELECT {_G}, y AS lo, lead(y) OVER (PARTITION BY {_G} ORDER BY y) AS hi FROM y),
span AS (SELECT {_G}, lo, hi, x1, x2 FROM slab s JOIN b USING ({_G}) WHERE b.y1 <= lo AND b.y2 >= hi AND hi IS NOT NULL),
reach AS (SELECT *, max(x2) OVER (PARTITION BY {_G}, lo ORDER BY x1, x2 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM span),
w AS (SELECT {_G}, lo, hi, sum(greatest(0, x2 - greatest(x1, coalesce(before, x1)))) AS width FROM reach GROUP BY ALL),
n AS (SELECT {_G}, count(*) AS n_scenes, arg_min(start_time, pos) AS start_time, min(pos) AS pos FROM met GROUP BY ALL),
ar AS (SELECT {_G}, n_scenes, start_time, pos, round(sum(width * (hi - lo))::DOUBLE, 6) AS area FROM w JOIN n USING ({_G}) GROUP BY ALL)"""

_IN = """start_time >= date_trunc('day', event_time - INTERVAL 90 DAY)
    AND start_time <= date_trunc('day', event_time + INTERVAL 30 DAY)::TIMESTAMP + INTERVAL 1 DAY - INTERVAL 1 SECOND"""
#: Scenes of the forward run, by what they are compared for: dates before the rupture as known in an event's first
#: pass (``p0``), and dates after it as known in either pass.
_FORWARD = f"""WITH q AS (SELECT DISTINCT q.*, q.event_id % 2 + 1 AS p0 FROM ({Q}) q JOIN ({L}) l
  ON pow(greatest(x1 - lon, 0, lon - x2), 2) + pow(greatest(y1 - lat, 0, lat - y2), 2) < 1 WHERE {FORWARD}),
s AS (SELECT *, CASE WHEN pos % 3 = 0 THEN 2 ELSE 1 END AS p FROM ({S})),
near AS (SELECT q.event_id, q.event_time, q.p0, lon - 50 AS minx, lat - 50 AS miny, lon + 50 AS maxx, lat + 50 AS maxy, s.minx AS sx1, s.miny AS sy1, s.maxx AS sx2, s.maxy AS sy2,
    s.file_id, s.path_number, s.flight_direction AS direction, s.acq_date, s.start_time, s.pos, s.p
  FROM q JOIN s ON lon - 50 < s.maxx AND s.minx < lon + 50 AND lat - 50 < s.maxy AND s.miny < lat + 50),
met AS (
  SELECT *, concat('whole|', direction) AS flight_direction FROM near WHERE p <= p0 AND {_IN}
  UNION ALL SELECT *, concat('pre|', direction) FROM near WHERE p <= p0 AND start_time < event_time AND {_IN}
  UNION ALL SELECT *, concat('post1|', direction) FROM near WHERE p0 = 1 AND p = 1 AND start_time > event_time
  UNION ALL SELECT *, concat('post2|', direction) FROM near WHERE start_time > event_time),
{_AREA},
k AS (SELECT event_id, path_number, split_part(flight_direction, '|', 2) AS direction, split_part(flight_direction, '|', 1) AS kind, acq_date, area FROM ar),
most AS (SELECT event_id, path_number, direction, kind, max(area) AS most FROM k GROUP BY ALL),
found AS (SELECT k.*, max(k.acq_date) OVER w AS latest, min(k.acq_date) OVER w AS earliest FROM k JOIN most m
  ON m.event_id = k.event_id AND m.path_number = k.path_number AND m.direction = k.direction AND m.kind = CASE k.kind WHEN 'pre' THEN 'whole' ELSE k.kind END
  WHERE k.kind <> 'whole' AND most > 0 AND area / most > 0.95 WINDOW w AS (PARTITION BY k.event_id, k.path_number, k.direction, k.kind)),
one AS (SELECT DISTINCT event_id, path_number, direction, kind, CASE kind WHEN 'pre' THEN latest ELSE earliest END AS day FROM found),
ids AS (SELECT event_id, path_number, direction, split_part(flight_direction, '|', 1) AS kind, acq_date AS day, string_agg(file_id, ',' ORDER BY pos) AS ids FROM met GROUP BY ALL),
best AS (SELECT * FROM one JOIN ids USING (event_id, path_number, direction, kind, day)),
t AS (SELECT a.event_id, concat(a.direction, '_', a.path_number) AS track, a.day AS reference_date, coalesce(b.day, c.day) AS post_date, a.ids AS pre, coalesce(b.ids, c.ids) AS post
  FROM best a LEFT JOIN best b ON b.kind = 'post1' AND b.event_id = a.event_id AND b.path_number = a.path_number AND b.direction = a.direction
  LEFT JOIN best c ON c.kind = 'post2' AND c.event_id = a.event_id AND c.path_number = a.path_number AND c.direction = a.direction WHERE a.kind = 'pre')
SELECT event_id::VARCHAR AS event_id, track, reference_date, post_date,
  CASE WHEN post_date IS NULL OR event_id % 3 = 0 THEN 'AWAITING_POST_SEISMIC' WHEN event_id % 4 = 0 THEN 'READY_FOR_EMAIL'
    WHEN event_id % 5 = 0 THEN 'FAILED_NEEDS_ATTENTION' ELSE 'REMOVED' END AS status,
  CASE WHEN post_date IS NOT NULL THEN pre END AS secondary, CASE WHEN post_date IS NOT NULL THEN post END AS reference FROM t"""


def _pending(check: int) -> str:
    """Events with a pair by the rules of v1 in a check: of those that came up to it, with the AOI and the scenes of that time."""
    half = f"CASE WHEN event_id % 2 <= {check - 2} THEN 100 ELSE 0.5 END"
    return f"""
  SELECT DISTINCT event_id, {check} AS left_at FROM (
    SELECT event_id, event_time, path_number, flight_direction, acq_date AS d, lead(acq_date) OVER (PARTITION BY event_id, path_number, flight_direction ORDER BY acq_date) AS e FROM (
      SELECT k.event_id, k.event_time, s.path_number, s.flight_direction, s.acq_date FROM (
        SELECT DISTINCT q.event_id, q.event_time, s.path_number, s.flight_direction, s.frame_number
        FROM (SELECT *, {half} AS half FROM ({Q}) WHERE mag >= 6.0 AND depth_km <= 40 AND event_id % 3 + 1 <= {check}) q JOIN ({S}) s
          ON s.pos % 4 < {check + 1} AND lon - half < s.maxx AND s.minx < lon + half AND lat - half < s.maxy AND s.miny < lat + half
         AND s.start_time >= date_trunc('day', event_time - INTERVAL 24 DAY) AND s.start_time <= date_trunc('day', event_time)::TIMESTAMP + INTERVAL 1 DAY - INTERVAL 1 SECOND) k
      JOIN ({S}) s ON s.pos % 4 < {check + 1} AND s.path_number = k.path_number AND s.flight_direction = k.flight_direction AND s.frame_number = k.frame_number
       AND s.start_time >= date_trunc('day', k.event_time - INTERVAL 90 DAY)
      GROUP BY ALL HAVING count(*) = count(DISTINCT s.frame_number)))
  WHERE d < date_trunc('day', event_time) AND e > date_trunc('day', event_time)"""


_PENDING = f"""WITH a AS ({_pending(1)}), b AS ({_pending(2)}), c AS ({_pending(3)})
SELECT event_id::VARCHAR AS event_id, coalesce(a.left_at, b.left_at, c.left_at, 0)::INT AS left_at
FROM (SELECT event_id FROM ({Q}) WHERE mag >= 6.0 AND depth_km <= 40) LEFT JOIN a USING (event_id) LEFT JOIN b USING (event_id) LEFT JOIN c USING (event_id)"""

_BOX = "minx, miny, maxx, maxy"

ORACLES: dict[str, str] = {
    "significant_historic": f"SELECT event_id, mag, depth_km, alert FROM ({Q}) WHERE {HISTORIC}",
    "significant_forward": f"SELECT event_id, mag, depth_km FROM ({Q}) WHERE {FORWARD}",
    "significant_v1": f"SELECT event_id, mag, depth_km FROM ({Q}) WHERE mag >= 6.0 AND depth_km <= 40",
    "significant_export": f"""SELECT place, mag AS magnitude, strftime(event_time, '%Y-%m-%d') AS date, strftime(event_time, '%H:%M:%S') AS time_utc,
  lon AS longitude, lat AS latitude, depth_km, alert, url FROM ({Q}) WHERE {HISTORIC}""",
    "event_info": f"""{_BASE} SELECT event_id, title, lat AS latitude, lon AS longitude, depth_km, url AS event_url,
  strftime(event_time, '%Y-%m-%d %H:%M:%S UTC') AS time FROM ({Q}) WHERE event_id IN (SELECT event_id FROM ({_CO}))""",
    "aoi_box": f"SELECT event_id, lon - 0.5 AS minx, lat - 0.5 AS miny, lon + 0.5 AS maxx, lat + 0.5 AS maxy FROM ({Q})",
    "window_bounds": f"""SELECT event_id, date_trunc('day', event_time - INTERVAL 90 DAY)::TIMESTAMP AS window_start,
  date_trunc('day', event_time + INTERVAL 30 DAY)::TIMESTAMP + INTERVAL 1 DAY - INTERVAL 1 SECOND AS window_end FROM ({Q})""",
    "day_delta_floor": f"""SELECT event_id, pos, abs(floor((epoch(acq_date::TIMESTAMP) - floor(epoch(event_time))) / 86400))::BIGINT AS delta FROM ({TS})""",
    "asof_pre": _asof("pre"),
    "asof_post": _asof("post"),
    "coseismic_pair": f"{_BASE} SELECT {_PAIR} FROM ({_CO})",
    "pairs_sequential": f"{_BASE} SELECT {_PAIR} FROM ({_SEQ['pre']}) UNION ALL SELECT {_PAIR} FROM ({_SEQ['post']})",
    "pairs_all": f"{_BASE} {_all('start_time < event_time')} UNION ALL {_all('start_time > event_time')}",
    "pairs_labelled": f"""{_BASE} SELECT {_PAIR}, 'pre_seismic' AS timing FROM ({_SEQ['pre']}) UNION ALL
  SELECT {_PAIR}, 'co_seismic' FROM ({_CO}) UNION ALL SELECT {_PAIR}, 'post_seismic' FROM ({_SEQ['post']})""",
    "pairs_v1": f"""WITH a AS (
  SELECT event_id, track, date_trunc('day', event_time) AS event_time, acq_date, acq_date::TIMESTAMP AS start_time, string_agg(scene_id, ',' ORDER BY pos) AS scenes
  FROM ({TS}) t GROUP BY event_id, track, t.event_time, acq_date HAVING count(*) = count(DISTINCT frame_number))
  SELECT {_PAIR}, 'co-seismic' AS timing FROM ({_CO})""",
    "coverage_ratio": f"{_BASE} SELECT event_id, track, acq_date, coverage, max_coverage, start_time AS first_time FROM mm",
    "frames_complete": f"""SELECT event_id, track, acq_date, count(*) AS n_scenes FROM ({TS}) GROUP BY ALL HAVING count(*) = count(DISTINCT frame_number)""",
    "track_frames": f"""SELECT event_id, flight_direction, path_number, count(DISTINCT (frame_number, date_trunc('second', start_time))) AS n_frame_times,
  array_to_string(list_sort(list_distinct(list(frame_number))), ',') AS frames FROM ({TS}) GROUP BY ALL""",
    "scene_event_join": f"SELECT event_id, file_id, path_number, acq_date FROM ({_MET})",
    "track_scene_join": f"""WITH met AS ({_MET}), k AS (SELECT DISTINCT event_id, flight_direction, path_number FROM met)
  SELECT k.event_id, k.path_number, s.file_id FROM k JOIN ({A}) e USING (event_id)
  JOIN ({S}) s ON s.flight_direction = k.flight_direction AND s.path_number = k.path_number AND {_OVERLAP} AND s.start_time BETWEEN e.window_start AND e.window_end""",
    "track_frame_join": f"""WITH met AS ({_MET}), k AS (SELECT DISTINCT event_id, flight_direction, path_number, frame_number FROM met)
  SELECT k.event_id, k.path_number, k.frame_number, s.file_id FROM k JOIN ({A}) e USING (event_id)
  JOIN ({S}) s ON s.flight_direction = k.flight_direction AND s.path_number = k.path_number AND s.frame_number = k.frame_number
   AND s.start_time BETWEEN e.window_start AND e.window_end""",
    "mosaic_coverage": f"WITH met AS ({_MET}), {_AREA} SELECT event_id, path_number, acq_date, n_scenes, area FROM ar",
    "asof_footprints": f"WITH {_FOOT} ({_asof_foot('pre')}) UNION ALL ({_asof_foot('post')})",
    "pairs_footprints": f"""WITH {_FOOT},
k AS (SELECT event_id, track, acq_date, count(DISTINCT (x, y)) AS coverage FROM sq GROUP BY ALL),
m AS (SELECT event_id, track, event_time, acq_date, arg_min(start_time, pos) AS start_time, string_agg(scene_id, ',' ORDER BY pos) AS scenes FROM ft GROUP BY ALL),
a AS (SELECT * FROM (SELECT *, max(coverage) OVER (PARTITION BY event_id, track) AS most FROM m JOIN k USING (event_id, track, acq_date))
  WHERE coverage / most > 0.95)
SELECT {_PAIR}, 'co-seismic' AS timing FROM ({_CO})""",
    "track_state_stream": f"""WITH met AS (SELECT * FROM ({_MET}) WHERE start_time > window_start AND event_id % 3 > 0 AND event_id % 2 = 0), {_AREA}
  SELECT event_id::VARCHAR AS event_id, concat(flight_direction, '_', path_number) AS track, 'READY_FOR_EMAIL' AS status, min(acq_date) AS post_date
  FROM (SELECT *, max(area) OVER (PARTITION BY event_id, flight_direction, path_number) AS most FROM ar) WHERE most > 0 AND area / most > 0.95
  GROUP BY event_id, flight_direction, path_number""",
    "discovery_run": f"""SELECT region::VARCHAR AS event_id, event_id AS revision, mag, event_time FROM ({Q}) WHERE {FORWARD}
  AND region NOT IN (SELECT s_suppkey FROM supplier) QUALIFY row_number() OVER (PARTITION BY region ORDER BY event_time DESC, event_id DESC) = 1""",
    "forward_run": _FORWARD,
    "pending_queue": _PENDING,
    "discovery_stateless": f"""WITH p AS (SELECT region, event_id % 3 AS poll, max(event_id) AS event_id, arg_max(mag, event_id) AS mag, arg_max(depth_km, event_id) AS depth_km FROM ({Q}) GROUP BY 1, 2)
  SELECT region::VARCHAR AS event_id, poll, event_id AS revision, mag FROM p WHERE {FORWARD} QUALIFY row_number() OVER (PARTITION BY region ORDER BY poll) = 1""",
    "waiting_scenes": f"""WITH met AS (SELECT * FROM ({_MET}) WHERE start_time > window_start AND event_id % 3 > 0), {_AREA}
  SELECT event_id, concat(flight_direction, '_', path_number) AS track, 'mosaic' AS kind, acq_date, start_time, pos, area FROM ar""",
    **{
        f"significant_{k}_land": f"""SELECT DISTINCT event_id, mag, depth_km FROM ({Q}) q JOIN ({L}) l
  ON pow(greatest(x1 - lon, 0, lon - x2), 2) + pow(greatest(y1 - lat, 0, lat - y2), 2) < 100 WHERE {rule}"""
        for k, rule in (("historic", HISTORIC), ("forward", FORWARD), ("v1", "mag >= 6.0 AND depth_km <= 40"))
    },
    "direction_coverage": f"""WITH met AS (SELECT 0 AS event_id, 0 AS path_number, flight_direction, 0 AS acq_date, start_time, pos,
  minx AS sx1, miny AS sy1, maxx AS sx2, maxy AS sy2, -1700 AS minx, -500 AS miny, 1700 AS maxx, 500 AS maxy FROM ({S})
  WHERE minx < 1700 AND maxx > -1700 AND miny < 500 AND maxy > -500), {_AREA}
  SELECT flight_direction, round(area::DOUBLE, 3) AS area FROM ar""",
    "bbox_agg": f"SELECT path_number, min(minx) AS minx, min(miny) AS miny, max(maxx) AS maxx, max(maxy) AS maxy FROM ({S}) GROUP BY ALL",
    "aoi_precedence": f"""SELECT q.event_id, coalesce(l.x1, u.minx, q.lon - 0.5)::DOUBLE AS minx, coalesce(l.y1, u.miny, q.lat - 0.5)::DOUBLE AS miny,
  coalesce(l.x2, u.maxx, q.lon + 0.5)::DOUBLE AS maxx, coalesce(l.y2, u.maxy, q.lat + 0.5)::DOUBLE AS maxy,
  CASE WHEN l.ring_id IS NOT NULL THEN 'fault' WHEN u.event_id IS NOT NULL THEN 'user' ELSE 'square' END AS source
  FROM ({Q}) q LEFT JOIN ({L}) l ON l.ring_id = q.event_id LEFT JOIN ({A}) u ON u.event_id = q.event_id""",
    "near_line": f"""SELECT DISTINCT event_id FROM ({Q}) q JOIN ({L}) l
  ON pow(greatest(x1 - lon, 0, lon - x2), 2) + pow(greatest(y1 - lat, 0, lat - y2), 2) < 100""",
    "tile_dedupe": f"{_TILES} SELECT event_id, orbit_id, acq_date, tile_id, granule_id FROM t",
    "optical_candidates": f"{_TILES} SELECT event_id, orbit_id, acq_date, round(cc, 6) AS cc, tile_count, coverage, delta, side FROM c",
    "optical_best_pair": f"""{_TILES} SELECT event_id, orbit_id, side, acq_date, scenes FROM c
  QUALIFY row_number() OVER (PARTITION BY event_id, orbit_id, side ORDER BY coverage DESC, cc, delta, acq_date) = 1""",
    "optical_partial": f"""{_TILES} SELECT event_id, orbit_id, side, acq_date, round(cc, 6) AS cc FROM c
  QUALIFY row_number() OVER (PARTITION BY event_id, orbit_id, side ORDER BY cc, acq_date) = 1""",
    "optical_jobs": f"{_TILES}{_OPTICAL_JOBS}",
    "optical_run": f"{_tiles(_OPTICAL_MET)}{_OPTICAL_JOBS}",
    "historic_optical_run": f"{_tiles(_HISTORIC_MET)}{_OPTICAL_JOBS}".replace("concat(s_name,", f"concat({_SNAKE},"),
    "selected_scenes": f"""{_tiles(_HISTORIC_MET)},
  n AS (SELECT *, count(DISTINCT side) OVER (PARTITION BY event_id, orbit_id) AS sides FROM c),
  p AS (SELECT * FROM n WHERE sides = 2 QUALIFY row_number() OVER (PARTITION BY event_id, orbit_id, side ORDER BY coverage DESC, cc, delta, acq_date) = 1)
  SELECT p.event_id, {_SNAKE} AS earthquake, CASE side WHEN 'pre' THEN 'Pre-Event' ELSE 'Post-Event' END AS role, p.acq_date::VARCHAR AS date, p.orbit_id AS orbit,
    'sentinel-2a' AS platform, granule_id, cloud_cover, round(coverage, 1) AS coverage_pct, x1::DOUBLE AS x
  FROM p JOIN t ON t.event_id = p.event_id AND t.orbit_id = p.orbit_id AND t.acq_date = p.acq_date JOIN supplier ON s_suppkey = p.event_id""",
    "historic_run": f"""WITH q AS (SELECT DISTINCT q.* FROM ({Q}) q JOIN ({L}) l
  ON pow(greatest(x1 - lon, 0, lon - x2), 2) + pow(greatest(y1 - lat, 0, lat - y2), 2) < 1 WHERE {HISTORIC}),
met AS (SELECT q.event_id, q.event_time, lon - 400 AS minx, lat - 400 AS miny, lon + 400 AS maxx, lat + 400 AS maxy, s.minx AS sx1, s.miny AS sy1, s.maxx AS sx2, s.maxy AS sy2,
    s.file_id, s.path_number, s.flight_direction, s.acq_date, s.start_time, s.pos
  FROM q JOIN ({S}) s ON lon - 400 < s.maxx AND s.minx < lon + 400 AND lat - 400 < s.maxy AND s.miny < lat + 400
   AND s.start_time >= date_trunc('day', event_time - INTERVAL 90 DAY) AND s.start_time <= date_trunc('day', event_time + INTERVAL 30 DAY)::TIMESTAMP + INTERVAL 1 DAY - INTERVAL 1 SECOND),
{_AREA},
m AS (SELECT {_G}, event_time, string_agg(file_id, ',' ORDER BY pos) AS scenes FROM met GROUP BY {_G}, event_time),
a AS (SELECT * FROM (SELECT *, concat(flight_direction, path_number) AS track, max(area) OVER (PARTITION BY event_id, flight_direction, path_number) AS most
  FROM m JOIN ar USING ({_G})) WHERE most > 0 AND area / most > 0.95)
SELECT event_id, secondary_date, reference_date, secondary, reference FROM ({_CO})""",
    "read_feed": f"""SELECT event_id::VARCHAR AS event_id, title, place, url, mag, alert, lon, lat, depth_km, strftime(event_time, '%Y-%m-%d %H:%M:%S') AS at
  FROM ({Q}) WHERE mag >= 6.0 AND depth_km <= 40""",
    "read_radar_scenes": f"""SELECT file_id, acq_date, flight_direction, path_number::BIGINT AS path_number, frame_number,
  minx::DOUBLE AS minx, miny::DOUBLE AS miny, maxx::DOUBLE AS maxx, maxy::DOUBLE AS maxy FROM ({S}) WHERE flight_direction = 'ASCENDING'""",
    "read_optical_scenes": f"""SELECT concat('S2A_MSIL1C_R', orbit_id, '_T', lpad(tile_id[2:], 5, '0'), '_', pos) AS granule_id, acq_date, cloud_cover, orbit_id,
  lpad(tile_id[2:], 5, '0') AS tile_id, x1::DOUBLE AS minx, y1::DOUBLE AS miny, x2::DOUBLE AS maxx, y2::DOUBLE AS maxy
  FROM ({v.duck(v.OPTICAL_SCENE)}) WHERE cloud_cover <= 15 AND pos % 4 <> 0""",
    "read_job_lists": f"""SELECT array_to_string(granules, ',') AS reference, array_to_string(secondary_granules, ',') AS secondary, 1::BIGINT AS n
  FROM ({J}) GROUP BY granules, secondary_granules""",
    "read_shapes": f"""SELECT pos // 1000 AS part, min(minx)::DOUBLE AS minx, min(miny)::DOUBLE AS miny, max(maxx)::DOUBLE AS maxx, max(maxy)::DOUBLE AS maxy, 4 * count(*) AS n_points
  FROM ({S}) GROUP BY 1""",
    "catalogue_join": f"SELECT event_id, file_id, path_number, acq_date FROM ({_MET})",
    "read_coastline": f"""SELECT seg::INT AS seg, [x1, x2, x2, x1][seg + 1] AS x1, [y1, y1, y2, y2][seg + 1] AS y1, [x2, x2, x1, x1][seg + 1] AS x2, [y1, y2, y2, y1][seg + 1] AS y2
  FROM ({L}), (SELECT unnest(range(4)) AS seg) WHERE ring_id % 5 <> 0""",
    "attr_lookup": "SELECT event_id, coalesce(TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE), 0.0)::DOUBLE AS k, 0.0::DOUBLE AS other FROM events",
    "title_snake": r"""SELECT doc_id, lower(replace(trim(regexp_replace(regexp_replace(regexp_replace(strip_accents(text), '[^\x00-\x7F]', '', 'g'),
  '[^A-Za-z0-9_\s]', '', 'g'), '\s+', ' ', 'g')), ' ', '_')) AS snake FROM documents""",
    "name_magnitude": rf"""SELECT pos, coalesce(TRY_CAST(regexp_extract(name, '^m_(\d+)', 1) AS INT), -1) AS start,
  coalesce(TRY_CAST(regexp_extract(name, '^m_(\d+)_', 1) AS INT), -1) AS bounded, TRY_CAST(regexp_extract(name, 'm_(\d+)', 1) AS DOUBLE) / 10 AS tenths FROM ({J})""",
    "job_name_parse": f"""SELECT pos, event_name, track, CASE WHEN track[1] = 'A' THEN 'Ascending' ELSE 'Descending' END AS direction,
  track[2:] AS path, false AS bad_name FROM ({_NAMED})""",
    "work_path": f"""{_BASE} SELECT event_id, track, concat('root/', event_id, '/A', lpad(track::VARCHAR, 3, '0'), '/co-seismic/A', lpad(track::VARCHAR, 3, '0'),
  '_', strftime(secondary_date, '%Y%m%d'), '_', strftime(reference_date, '%Y%m%d')) AS path FROM ({_CO})""",
    "strip_names": f"""SELECT pos, CASE WHEN pos % 2 = 0 THEN file_id ELSE concat(file_id, '.SAFE') END AS bare,
  CASE WHEN pos % 2 = 0 THEN concat(file_id, '-SLC') ELSE file_id END AS plain, flight_direction[1] AS code, lpad(path_number::VARCHAR, 3, '0') AS path FROM ({S})""",
    "delivery_keys": _EXPECTED["documents"],
    "delivery_missing": f"SELECT * FROM ({_EXPECTED['documents']}) WHERE key NOT IN (SELECT key FROM ({_EXPECTED['labels']}))",
    "delivery_present": f"SELECT * FROM ({_EXPECTED['documents']}) WHERE key IN (SELECT key FROM ({_EXPECTED['labels']}))",
    "delivery_totals": f"""SELECT count_if(key IN (SELECT key FROM ({_EXPECTED['labels']})))::BIGINT AS n_present,
  count_if(key NOT IN (SELECT key FROM ({_EXPECTED['labels']})))::BIGINT AS n_missing FROM ({_EXPECTED['documents']})""",
    "dirs_without_browse": f"SELECT dir FROM ({v.duck(v.PAGE_KEY)}) GROUP BY dir HAVING NOT bool_or(key LIKE '%.png')",
    "ffm_url_pick": "SELECT page_id, CASE WHEN page_id % 3 = 0 THEN url END AS fault_url FROM pages",
    "geojson_compile": """SELECT page_id, unnest(range(CASE WHEN page_id % 3 = 1 THEN 2 ELSE 1 END)) AS at, page_id AS feature_id FROM pages WHERE page_id % 3 < 2""",
    "product_boxes": f"""SELECT concat(file_id, '.nc') AS filename, concat('m_', pos % 90, '_place') AS earthquake_name, (pos % 90) / 10 AS magnitude, {_BOX} FROM ({S})""",
    "mainshocks_kept": f"SELECT pos, name FROM ({_dedupe()}) WHERE keep",
    "mainshocks_removed": f"SELECT pos, name FROM ({_dedupe()}) WHERE NOT keep",
    "dedupe_sorted_key": _turned("list_sort({})", "^m_(\\d+)_"),
    "dedupe_ordered_key": _turned("{}", "^m_(\\d+)"),
    "jobs_conforming": f"SELECT pos, {_CONFORMS} AS ok FROM ({J})",
    "exclude_platform": f"SELECT pos, name FROM ({J}) WHERE len(list_filter(granules || secondary_granules, lambda g: starts_with(g, 'S1C_'))) = 0",
    "frame_groups": f"""SELECT CASE WHEN len(granules) = len(secondary_granules) THEN len(granules)::VARCHAR ELSE 'mismatched' END AS frame_group, count(*) AS n_jobs FROM ({J}) GROUP BY 1""",
    "job_summary": f"SELECT count(DISTINCT event_name) AS n_events, count(*) AS n_jobs FROM ({_NAMED})",
    "tracks_per_event": f"SELECT event_name, count(DISTINCT track) AS num_tracks, array_to_string(list_sort(list_distinct(list(track))), ' ') AS tracks FROM ({_NAMED}) GROUP BY 1",
    "job_struct": f"""SELECT pos, name, 'ARIA_S1_COSEIS' AS job_type, concat('{{"granules":', CASE WHEN len(granules) = 0 THEN '[]' ELSE '["' || array_to_string(granules, '","') || '"]' END,
  ',"secondary_granules":', CASE WHEN len(secondary_granules) = 0 THEN '[]' ELSE '["' || array_to_string(secondary_granules, '","') || '"]' END,
  ',"frame_id":-1,"estimate_ionosphere_delay":true,"esd_coherence_threshold":-1,"compute_solid_earth_tide":true,"goldstein_filter_power":0.5,"unfiltered_coherence":true,"dense_offsets":true,"output_resolution":90}}') AS parameters FROM ({J})""",
    "local_params": f"""SELECT pos, name.split('-')[1] AS title, CASE WHEN name.split('-')[2][1] = 'A' THEN 'ASCENDING' ELSE 'DESCENDING' END AS direction,
  name.split('-')[2][2:]::INT AS path, array_to_string(granules, ',') AS reference, 30 AS resolution FROM ({J})""",
    "footprint_ring": f"SELECT pos, 4::BIGINT AS n, minx::DOUBLE AS minx, miny::DOUBLE AS miny, maxx::DOUBLE AS maxx, maxy::DOUBLE AS maxy FROM ({S})",
    "missing_local": f"""SELECT doc_id, file FROM ({v.duck(v.DELIVERED)} FROM documents) WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
    "tracker_orphans": f"SELECT DISTINCT event_id, track FROM ({TS}) WHERE (event_id, track) NOT IN (SELECT (event_id, track) FROM ({_asof('pre')}))",
    "set_resolution": f"SELECT pos, 30 AS output_resolution, array_to_string(granules, ',') AS granules FROM ({J})",
    "curation_funnel": f"""WITH f AS (SELECT *, keep AND {_CONFORMS} AS ok FROM ({_dedupe()}))
  SELECT 0 AS step_no, 'all' AS step, count(DISTINCT event_name) AS n_events, count(*) AS n_jobs FROM f UNION ALL
  SELECT 1, 'deduplicated', count(DISTINCT event_name), count(*) FROM f WHERE keep UNION ALL
  SELECT 2, 'conforming', count(DISTINCT event_name), count(*) FROM f WHERE ok""",
    "curation_run": f"""SELECT pos, CASE WHEN NOT keep THEN 'removed' WHEN {_CONFORMS} THEN 'kept' ELSE 'nonconforming' END AS goes,
  CASE WHEN len(granules) = len(secondary_granules) THEN len(granules)::VARCHAR ELSE 'mismatched' END AS frame_group FROM ({_dedupe()})""",
    "new_events_anti": f"SELECT event_id, mag FROM ({Q}) WHERE {FORWARD} AND event_id NOT IN (SELECT o_orderkey FROM orders)",
    "complete_partial": f"""WITH n AS ({_NAMED}), best AS (SELECT event_name, track, arg_min(granules, pos) AS g FROM n WHERE len(granules) > 0 GROUP BY ALL)
  SELECT pos, event_name, track, array_to_string(g, ',') AS granules FROM n JOIN best USING (event_name, track) WHERE len(granules) = 0""",
    "completion_summary": "SELECT o_custkey AS event_id, o_orderpriority AS track, count(*) AS n_jobs, bool_or(o_orderstatus = 'F') AS any_failed FROM orders GROUP BY ALL",
    "los_to_phase": """SELECT vec_id, i - 1 AS x, round(CAST(CAST(embedding[i] AS DOUBLE) * 4.0::DOUBLE * pi() / 0.056::DOUBLE AS FLOAT)::DOUBLE, 4) AS phase
  FROM (SELECT *, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)""",
    "tracker_init": f"SELECT event_id, track, acq_date AS reference_date, scenes AS secondary, 'AWAITING_POST_SEISMIC' AS status FROM ({_asof('pre')})",
    "tracker_state": f"{_STATE} SELECT * FROM st",
    "tracker_gc": f"{_STATE} SELECT event_id FROM st GROUP BY 1 HAVING bool_and(status = 'REMOVED')",
    "tracker_sync": f"{_STATE} SELECT event_id, CASE WHEN bool_and(status = 'REMOVED') THEN 'delete' ELSE 'update' END AS action FROM st GROUP BY 1",
    "tracker_saved": f"""{_STATE} SELECT event_id, CASE WHEN bool_and(status = 'REMOVED') THEN 'delete' ELSE 'update' END AS action,
  count(*) FILTER (status <> 'REMOVED') AS n_tracks FROM st GROUP BY 1""",
    "pending_resolve": f"{_BASE} SELECT event_id, event_id IN (SELECT event_id FROM ({_CO})) AS resolved FROM ({Q})",
    "stream_discovery": f"""SELECT region AS event_id, event_id AS revision, mag, event_time FROM ({Q}) WHERE {FORWARD}
  AND region NOT IN (SELECT s_suppkey FROM supplier) QUALIFY row_number() OVER (PARTITION BY region ORDER BY event_time DESC, event_id DESC) = 1""",
    "stream_feed": f"""SELECT event_id::VARCHAR AS event_id, title, mag, lon, lat, depth_km, strftime(event_time, '%Y-%m-%d %H:%M:%S') AS at FROM ({Q})
  WHERE date_trunc('second', event_time) >= TIMESTAMP '2024-01-18 00:00:00' AND mag >= 5.5""",
    "read_tracker_files": """SELECT concat('ev', l_suppkey) AS title, concat('A00', l_linenumber) AS track, l_linenumber::INT AS path_number,
  max(l_shipdate)::DATE::VARCHAR AS reference_date, 'AWAITING_POST_SEISMIC' AS status FROM lineitem WHERE l_suppkey % 5 <> 0 GROUP BY l_suppkey, l_linenumber""",
    "manifest_missing": f"""SELECT concat(event, '-D', doc_id) AS name, f AS file, key FROM (
    SELECT *, concat('share/', year, '/', event, '/prod.', doc_id, '/prod.', doc_id, right(f, 4)) AS key FROM (
      SELECT *, unnest(CASE WHEN doc_id % 3 = 0 THEN [file, concat('prod.', doc_id, '.png')] ELSE [file] END) AS f FROM ({v.duck(v.DELIVERED)} FROM documents) WHERE year IS NOT NULL))
  WHERE key NOT IN (SELECT key FROM ({_EXPECTED['labels']}))""",
    "job_export": f"""SELECT pos, name, 'ARIA_S1_COSEIS' AS job_type, name.split('-')[2][1] AS code, array_to_string(granules, ',') AS granules FROM ({J})""",
    "job_split_export": f"""SELECT pos, name, array_to_string(granules, ',') AS granules,
  CASE WHEN len(granules) = len(secondary_granules) THEN len(granules)::VARCHAR ELSE 'mismatched' END AS frame_group FROM ({J})""",
    "summary_export": f"""SELECT event_name, count(DISTINCT track) AS num_tracks, array_to_string(list_sort(list_distinct(list(track))), ' ') AS tracks FROM ({_NAMED}) GROUP BY 1
  UNION ALL SELECT 'all', count(DISTINCT event_name), count(*)::VARCHAR FROM ({_NAMED})""",
    "aoi_export": f"""SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'fault' ELSE 'square' END AS source, minx - h AS minx, miny - h AS miny,
  CASE WHEN event_id % 3 = 0 THEN maxx ELSE minx + h END AS maxx, CASE WHEN event_id % 3 = 0 THEN maxy ELSE miny + h END AS maxy, 5::BIGINT AS n, true AS closed
  FROM (SELECT *, CASE WHEN event_id % 3 = 0 THEN 0.0 ELSE 0.5 END::DOUBLE AS h FROM ({v.duck(v.OPTICAL_EVENT)}))""",
    "frames_export": f"""SELECT event_id, flight_direction, path_number, array_to_string(list_sort(list_distinct(list(frame_number))), ',') AS frames FROM ({TS}) GROUP BY ALL""",
    "partial_jobs_completed": f"""SELECT b.event_id, b.track, concat('e', b.event_id, '-A', lpad(b.track::VARCHAR, 3, '0')) AS name, b.scenes AS secondary, a.scenes AS reference
  FROM ({_asof('pre')}) b JOIN ({_asof('post')}) a USING (event_id, track)""",
    "platforms": """SELECT l_orderkey, l_linenumber, CASE l_suppkey % 4 WHEN 0 THEN 'sentinel-2a' WHEN 1 THEN 'sentinel-2b' WHEN 2 THEN 'sentinel-2c' ELSE 'sentinel-2' END AS platform FROM lineitem""",
    "display_rounding": f"SELECT event_id, round(lon / 3, 3) AS lon, round(lat / 3, 3) AS lat, round(depth_km / 3, 1) AS depth_km FROM ({Q})",
    "transitions_by_pass": f"""WITH met AS (SELECT * FROM ({_MET}) WHERE start_time > window_start AND event_id % 3 > 0), {_AREA},
first AS (SELECT event_id, concat(flight_direction, '_', path_number) AS track, min(acq_date) AS post_date
  FROM (SELECT *, max(area) OVER (PARTITION BY event_id, flight_direction, path_number) AS most FROM ar) WHERE most > 0 AND area / most > 0.95
  GROUP BY event_id, flight_direction, path_number)
  SELECT event_id::VARCHAR AS event_id, track, 1::BIGINT AS pass, 'READY_FOR_EMAIL' AS status, post_date FROM first UNION ALL
  SELECT event_id::VARCHAR, track, 2, CASE WHEN event_id % 5 = 0 THEN 'FAILED_NEEDS_ATTENTION' ELSE 'REMOVED' END, post_date FROM first WHERE event_id % 2 = 0""",
}
