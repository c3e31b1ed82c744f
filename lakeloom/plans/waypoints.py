"""Vehicle-position plans. Events stand for waypoints: vehicle = user, time = ts,
speed = value (not sent with errors), driver = event type (not sent with views);
the route map comes from customers and leaves out one region."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeloom.plans.registry import query
from lakeloom.plans.star import Star
from lakeloom.streaming import gps
from lakeloom.streaming.kalman import kalman_smooth, rts_smooth


def routes(s: Star):
    raw = s.buyer.filter("buyer_region <> 'AFRICA'").select(
        F.col("buyer_id").cast("string").alias("vehicle"), F.substring("buyer_nation", 8, 2).alias("route_id"),
        F.when(F.col("buyer_nation") != "NATION_7", F.col("buyer_nation")).alias("route_no"))
    return gps.route_map(raw)


def waypoints(s: Star):
    kind = F.col("event_type")
    return s.events.select(
        "event_id", F.col("user_id").cast("string").alias("vehicle"), "ts",
        F.when(kind != "error", F.col("value")).alias("speed"), F.when(kind != "view", kind).alias("driver"),
        F.get_json_object("props", "$.k").cast("double").alias("heading"))


def enriched(s: Star):
    return gps.enrich_routes(waypoints(s), routes(s))


GPS_SQL = """WITH routes AS (
  SELECT CAST(buyer_id AS VARCHAR) AS vehicle, substr(buyer_nation, 8, 2) AS route_id,
         CASE WHEN buyer_nation <> 'NATION_7' THEN buyer_nation ELSE '' END AS route_no
  FROM buyer WHERE buyer_region <> 'AFRICA'),
wp AS (
  SELECT event_id, CAST(user_id AS VARCHAR) AS vehicle, ts, CASE WHEN event_type <> 'error' THEN value END AS speed,
         CASE WHEN event_type <> 'view' THEN event_type END AS driver, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS heading
  FROM events),
en AS (SELECT wp.*, coalesce(route_id, 'Unknown') AS route_id, coalesce(route_no, 'Unknown') AS route_no
       FROM wp LEFT JOIN routes USING (vehicle))"""


@query("gps_enrich", GPS_SQL + " SELECT * FROM en")
def gps_enrich(s: Star):
    return enriched(s)


_STATE = GPS_SQL + """,
g AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY vehicle ORDER BY ts, event_id) >= INTERVAL 2 HOUR THEN 1 ELSE 0 END AS cut FROM en),
sess AS (SELECT *, sum(cut) OVER (PARTITION BY vehicle ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS session FROM g),
last_s AS (SELECT vehicle AS v, max(session) AS session FROM sess GROUP BY 1)
SELECT vehicle, max(ts) AS last_seen,
       arg_max(speed, ts) FILTER (WHERE speed IS NOT NULL) AS speed,
       arg_max(driver, ts) FILTER (WHERE driver IS NOT NULL) AS driver,
       arg_max(route_no, ts) AS route_no
FROM sess JOIN last_s ON v = vehicle AND last_s.session = sess.session
GROUP BY 1 HAVING max(ts) > {as_of} - INTERVAL 2 HOUR"""


@query("gps_latest_state", _STATE.format(as_of="(SELECT max(ts) FROM events)"))
def gps_latest_state(s: Star):
    return gps.latest_state(enriched(s), "vehicle", "ts", ["speed", "driver", "route_no"], tie="event_id")


@query("gps_latest_state_day", _STATE.format(as_of="(SELECT max(ts) - INTERVAL 22 HOUR FROM events)"))
def gps_latest_state_day(s: Star):
    # state of every vehicle heard of in the last day
    en = enriched(s)
    as_of = en.agg(F.max("ts") - F.expr("INTERVAL 22 HOURS")).scalar()
    return gps.latest_state(en, "vehicle", "ts", ["speed", "driver", "route_no"], tie="event_id", as_of=as_of)


@query("gps_active_routes", GPS_SQL + """,
m AS (SELECT * FROM en WHERE route_no <> 'Unknown'),
g AS (SELECT *, CASE WHEN ts - lag(ts) OVER (ORDER BY ts, event_id) >= INTERVAL 2 HOUR THEN 1 ELSE 0 END AS cut FROM m),
sess AS (SELECT *, sum(cut) OVER (ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS session FROM g)
SELECT route_no, max(ts) AS last_seen FROM sess
WHERE session = (SELECT max(session) FROM sess)
  AND (SELECT max(ts) FROM m) > (SELECT max(ts) FROM events) - INTERVAL 2 HOUR
GROUP BY 1""")
def gps_active_routes(s: Star):
    return gps.active_routes(enriched(s), "ts")


@query("gps_active_routes_own", GPS_SQL + """
SELECT route_no, max(ts) AS last_seen FROM en WHERE route_no <> 'Unknown'
GROUP BY 1 HAVING max(ts) > (SELECT max(ts) FROM events) - INTERVAL 2 HOUR""")
def gps_active_routes_own(s: Star):
    return gps.active_routes(enriched(s), "ts", mode="route")


@query("gps_retain_latest", "SELECT event_id, ts, user_id FROM events ORDER BY ts DESC, event_id DESC LIMIT 2500")
def gps_retain_latest(s: Star):
    return gps.retain_latest(s.events.select("event_id", "ts", "user_id"), "ts", 2500, tie="event_id")


# row after row of each vehicle
_FILTER = """
WITH RECURSIVE p AS (
  SELECT event_id, CAST(user_id AS VARCHAR) AS vehicle, ts, CASE WHEN event_type <> 'error' THEN value END AS x,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS y, epoch_us(ts) / 1e6 AS t,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn
  FROM events),
k AS (
  SELECT p.*, x IS NOT NULL AND y IS NOT NULL AS begun, x AS sx, y AS sy,
         CASE WHEN x IS NOT NULL AND y IS NOT NULL THEN 0e0 END AS vx, CASE WHEN x IS NOT NULL AND y IS NOT NULL THEN 0e0 END AS vy,
         1e0 AS a, 0e0 AS b, 1e0 AS c
  FROM p WHERE rn = 1
  UNION ALL
  SELECT event_id, vehicle, ts, x, y, t, rn, was OR told,
    CASE WHEN NOT was THEN x WHEN told THEN px + pa / (pa + 1) * (x - px) ELSE px END,
    CASE WHEN NOT was THEN y WHEN told THEN py + pa / (pa + 1) * (y - py) ELSE py END,
    CASE WHEN NOT was THEN CASE WHEN told THEN 0e0 END WHEN told THEN pvx + pb / (pa + 1) * (x - px) ELSE pvx END,
    CASE WHEN NOT was THEN CASE WHEN told THEN 0e0 END WHEN told THEN pvy + pb / (pa + 1) * (y - py) ELSE pvy END,
    CASE WHEN NOT was THEN 1e0 WHEN told THEN pa / (pa + 1) ELSE pa END,
    CASE WHEN NOT was THEN 0e0 WHEN told THEN pb / (pa + 1) ELSE pb END,
    CASE WHEN NOT was THEN 1e0 WHEN told THEN (pc + (pa * pc - pb * pb)) / (pa + 1) ELSE pc END
  FROM (
    SELECT n.*, n.x IS NOT NULL AND n.y IS NOT NULL AS told, k.begun AS was, k.vx AS pvx, k.vy AS pvy,
      k.sx + (n.t - k.t) * k.vx AS px, k.sy + (n.t - k.t) * k.vy AS py,
      k.a + (n.t - k.t) * (2 * k.b + (n.t - k.t) * k.c) + 1e-3 * (n.t - k.t) * (n.t - k.t) * (n.t - k.t) / 3 AS pa,
      k.b + (n.t - k.t) * k.c + 1e-3 * (n.t - k.t) * (n.t - k.t) / 2 AS pb, k.c + 1e-3 * (n.t - k.t) AS pc
    FROM k JOIN p n ON n.vehicle = k.vehicle AND n.rn = k.rn + 1))"""


def _tracks(s: Star):
    return waypoints(s).select("event_id", "vehicle", "ts", F.col("speed").alias("x"), F.col("heading").alias("y"))


def _shown(out):
    names = ("x_smooth", "y_smooth", "vx", "vy")
    return out.select("event_id", "vehicle", "ts", "x", "y", *[F.round(F.nullif(F.col(c), F.lit(float("nan"))), 4).alias(c) for c in names])


@query("kalman_smooth", _FILTER + """
SELECT event_id, vehicle, ts, x, y, round(sx, 4) AS x_smooth, round(sy, 4) AS y_smooth, round(vx, 4) AS vx, round(vy, 4) AS vy FROM k
""", star=False)
def smoothed(s: Star):
    return _shown(kalman_smooth(_tracks(s), ts="ts", tie="event_id", slice_seconds=86400))


# from the last row of each vehicle back: the mean of a row moves towards what the next
# row's smoothed mean says, by covariance(row, next) / variance(next as foreseen)
@query("kalman_rts", _FILTER + """,
n AS (
  SELECT k.*, lead(t) OVER (PARTITION BY vehicle ORDER BY rn) - t AS dt, count(*) OVER (PARTITION BY vehicle) AS n FROM k),
f AS (
  SELECT *, a + 2 * dt * b + dt * dt * c + 1e-3 * dt * dt * dt / 3 AS qa, b + dt * c + 1e-3 * dt * dt / 2 AS qb, c + 1e-3 * dt AS qc,
         a + dt * b AS ca, b AS cb, b + dt * c AS cc, c AS cd FROM n),
g AS (
  SELECT *, (ca * qc - cb * qb) / (qa * qc - qb * qb) AS g11, (cb * qa - ca * qb) / (qa * qc - qb * qb) AS g12,
         (cc * qc - cd * qb) / (qa * qc - qb * qb) AS g21, (cd * qa - cc * qb) / (qa * qc - qb * qb) AS g22 FROM f),
r AS (
  SELECT event_id, vehicle, ts, x, y, rn, sx AS rx, sy AS ry, vx AS rvx, vy AS rvy FROM g WHERE rn = n
  UNION ALL
  SELECT g.event_id, g.vehicle, g.ts, g.x, g.y, g.rn,
    CASE WHEN begun THEN sx + g11 * (rx - sx - dt * vx) + g12 * (rvx - vx) ELSE sx END,
    CASE WHEN begun THEN sy + g11 * (ry - sy - dt * vy) + g12 * (rvy - vy) ELSE sy END,
    CASE WHEN begun THEN vx + g21 * (rx - sx - dt * vx) + g22 * (rvx - vx) END,
    CASE WHEN begun THEN vy + g21 * (ry - sy - dt * vy) + g22 * (rvy - vy) END
  FROM r JOIN g ON g.vehicle = r.vehicle AND g.rn = r.rn - 1)
SELECT event_id, vehicle, ts, x, y, round(rx, 4) AS x_smooth, round(ry, 4) AS y_smooth, round(rvx, 4) AS vx, round(rvy, 4) AS vy FROM r
""", star=False)
def smoothed_both_ways(s: Star):
    return _shown(rts_smooth(_tracks(s), ts="ts", tie="event_id", slice_seconds=86400))


_DENSITY = GPS_SQL + """,
d AS (
  SELECT to_timestamp(floor(epoch(ts) / 300) * 300)::TIMESTAMP AS window_start, route_no, count(DISTINCT vehicle) AS vehicles,
         round(round(sum(speed), 2) / nullif(count(speed), 0), 6) AS avg_speed
  FROM en GROUP BY 1, 2)"""


@query("gps_route_density", _DENSITY + " SELECT * FROM d")
def gps_route_density(s: Star):
    return gps.route_density(enriched(s), "ts", "speed")


@query("gps_congestion", _DENSITY + " SELECT route_no, count(*) * 5 AS congested_minutes FROM d WHERE avg_speed < 5 GROUP BY 1")
def gps_congestion(s: Star):
    return gps.congestion_time(gps.route_density(enriched(s), "ts", "speed"), 5.0)


@query("gps_common_routes", GPS_SQL + """
SELECT route_no, count(*) AS messages, count(DISTINCT vehicle) AS vehicles FROM en
GROUP BY 1 ORDER BY messages DESC, route_no LIMIT 5""")
def gps_common_routes(s: Star):
    return gps.common_routes(enriched(s), 5)


@query("gps_flatten", """
SELECT event_id, CASE WHEN event_type = 'error' THEN 'Unknown' ELSE event_type END AS "msgType", CAST(user_id AS VARCHAR) AS vehicle,
       CASE WHEN event_type = 'click' THEN 'n/a' || event_id
            ELSE strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') END AS datetime
FROM events""")
def gps_flatten(s: Star):
    """Messages built from events as nested JSON, then read back."""
    kind = F.col("event_type")
    when = F.when(kind == "click", F.concat(F.lit("n/a"), F.col("event_id"))) \
        .otherwise(F.unix_seconds(F.col("ts").cast("timestamp")).cast("string"))
    message = F.struct(F.when(kind != "error", kind).alias("msgType"),
                       F.struct(F.col("user_id").cast("string").alias("vehicle"), when.alias("datetime")).alias("msgBusWayPoint"))
    flat = gps.flatten_gps(s.events.select("event_id", F.to_json(message).alias("value")))
    return flat.select("event_id", "msgType", "vehicle", "datetime")
