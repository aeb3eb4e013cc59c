"""Batch queries over the given tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamlab.functions import geo, register_functions
from streamlab.functions import rides as rx
from streamlab.functions import text as tx
from streamlab.operators import control, graph, joins, mail, nearest, patterns, rides, rules, segments, travel
from streamlab.sources import etl, readers, sinks
from streamlab.workloads.registry import query
from streamlab.workloads.tables import (
    ARCHIVE_SQL,
    CARS_SQL,
    CONTROLS_SQL,
    EDGES_SQL,
    FARES_SQL,
    MAILS_SQL,
    PREDICATES_SQL,
    QUERIES_SQL,
    RIDES_SQL,
    Tables,
)

RIDE_LIST = (
    '"rideId", "isStart", "startTime", "endTime", "startLon", "startLat", "endLon", "endLat", '
    '"passengerCnt", "taxiId", "driverId"'
)
FARE_LIST = '"rideId", "taxiId", "driverId", "startTime", "paymentType", tip, tolls, "totalFare"'
CELL_SQL = (
    "(floor((74.05::DOUBLE - abs({0}::DOUBLE)) / 0.0014::DOUBLE)"
    " + 250 * floor((41::DOUBLE - {1}::DOUBLE) / 0.00125::DOUBLE))::INT"
)
START_CELL = CELL_SQL.format('"startLon"', '"startLat"')
END_CELL = CELL_SQL.format('"endLon"', '"endLat"')
RIDE_CELL = f'CASE WHEN "isStart" THEN {START_CELL} ELSE {END_CELL} END'
LON_OF_CELL = "(-((74.05::DOUBLE - (cell % 250) * 0.0014::DOUBLE - 0.0007::DOUBLE)::FLOAT))"
LAT_OF_CELL = "(41::DOUBLE - (cell // 250) * 0.00125::DOUBLE - 0.000625::DOUBLE)::FLOAT"


def dist_sql(lon1: str, lat1: str, lon2: str, lat2: str) -> str:
    return (
        f"(110.25::DOUBLE * sqrt(({lat1} - {lat2})::DOUBLE * ({lat1} - {lat2})::DOUBLE"
        f" + (({lon1} - {lon2})::DOUBLE * cos({lat2}::DOUBLE))"
        f" * (({lon1} - {lon2})::DOUBLE * cos({lat2}::DOUBLE))))"
    )


def angle_sql(lon1: str, lat1: str, lon2: str, lat2: str) -> str:
    return (
        f"(trunc(degrees(atan2(({lat2} - {lat1})::DOUBLE,"
        f" ({lon2} - {lon1})::DOUBLE * cos({lat1}::DOUBLE))))::INT + 179)"
    )


EVENT_DISTANCE = (
    'CASE WHEN "isStart" THEN '
    + dist_sql("{0}", "{1}", '"startLon"', '"startLat"')
    + " ELSE "
    + dist_sql("{0}", "{1}", '"endLon"', '"endLat"')
    + " END"
)


def rounded(name: str) -> F.Column:
    return F.round(F.col(name).cast("double"), 6).alias(name)


# --- projections and filters ---------------------------------------------------------------------


@query(f"WITH {RIDES_SQL} SELECT {RIDE_LIST} FROM v_city")
def ride_cleansing(t: Tables) -> DataFrame:
    return rides.cleanse_rides(t.rides)


@query(f'WITH {RIDES_SQL} SELECT {RIDE_LIST} FROM v_rides WHERE "isStart"')
def start_rides(t: Tables) -> DataFrame:
    return rides.start_rides(t.rides)


@query(f'WITH {RIDES_SQL} SELECT {RIDE_LIST} FROM v_rides WHERE "isStart" AND "rideId" % 1000 <> 0')
def drop_every_nth(t: Tables) -> DataFrame:
    return rides.drop_every_nth(rides.start_rides(t.rides), "rideId", 1000)


@query(
    f'WITH {RIDES_SQL} SELECT "rideId", "isStart", "eventTime", {RIDE_CELL} AS cell,'
    f' {END_CELL} AS "destCell" FROM v_rides'
)
def ride_cells(t: Tables) -> DataFrame:
    located = rides.dest_cells(rides.ride_cells(rides.with_event_time(t.rides)))
    return located.select("rideId", "isStart", "eventTime", "cell", "destCell")


@query(
    f"WITH {RIDES_SQL}, c AS (SELECT *, {RIDE_CELL} AS cell FROM v_city)"
    f' SELECT "rideId", "isStart", cell, round({LON_OF_CELL}::DOUBLE, 6) AS lon,'
    f" round({LAT_OF_CELL}::DOUBLE, 6) AS lat FROM c"
)
def cell_coords(t: Tables) -> DataFrame:
    located = rides.ride_cells(rides.cleanse_rides(t.rides))
    coords = located.select("rideId", "isStart", "cell", geo.cell_coords(F.col("cell")).alias("p"))
    return coords.select("rideId", "isStart", "cell", "p.lon", "p.lat").select(
        "rideId", "isStart", "cell", rounded("lon"), rounded("lat")
    )


@query(
    f"""WITH {RIDES_SQL} SELECT "rideId", "isStart",
    round({dist_sql('"startLon"', '"startLat"', '"endLon"', '"endLat"')}, 6) AS km,
    {angle_sql('"endLon"', '"endLat"', '"startLon"', '"startLat"')} AS angle,
    trunc({angle_sql('"endLon"', '"endLat"', '"startLon"', '"startLat"')} / 45)::INT AS bucket,
    round({EVENT_DISTANCE.format("(-73.9)::FLOAT", "40.7::FLOAT")}, 6) AS "toPoint",
    round(((epoch_us("endTime") // 1000) - (epoch_us("startTime") // 1000)) / 60000.0::DOUBLE, 6) AS minutes
    FROM v_rides"""
)
def geo_functions(t: Tables) -> DataFrame:
    c = F.col
    angle = geo.direction_angle(c("endLon"), c("endLat"), c("startLon"), c("startLat"))
    point = F.lit(-73.9).cast("float"), F.lit(40.7).cast("float")
    return (
        t.rides.withColumn(
            "km", geo.distance(c("startLon"), c("startLat"), c("endLon"), c("endLat"))
        )
        .withColumn("toPoint", rx.ride_distance(*point))
        .withColumn("minutes", rx.minutes_between(c("startTime"), c("endTime")))
        .select(
            "rideId",
            "isStart",
            rounded("km"),
            angle.alias("angle"),
            geo.direction_bucket(angle).alias("bucket"),
            rounded("toPoint"),
            rounded("minutes"),
        )
    )


_PATH = f"""WITH {RIDES_SQL}, s AS (
      SELECT "rideId", "isStart",
        floor((74.05::DOUBLE - abs("startLon"::DOUBLE)) / 0.0014::DOUBLE)::INT AS x0,
        floor((41::DOUBLE - "startLat"::DOUBLE) / 0.00125::DOUBLE)::INT AS y0,
        floor((74.05::DOUBLE - abs("endLon"::DOUBLE)) / 0.0014::DOUBLE)::INT AS x1,
        floor((41::DOUBLE - "endLat"::DOUBLE) / 0.00125::DOUBLE)::INT AS y1
      FROM v_city),
    k AS (SELECT *, (y1 - y0)::DOUBLE / (x1 - x0)::DOUBLE AS slope,
                 unnest(range(x0, x1 + 1))::INT AS x FROM s),
    b AS (SELECT *, y0 + (greatest(x - 0.5::DOUBLE, x0) - x0) * slope AS a,
                 y0 + (least(x + 0.5::DOUBLE, x1) - x0) * slope AS z FROM k),
    c AS (SELECT *,
      CASE WHEN slope > 0 THEN floor(a + 0.55::DOUBLE) ELSE ceil(a - 0.55::DOUBLE) END::INT AS ya,
      CASE WHEN slope > 0 THEN floor(z + 0.45::DOUBLE) ELSE ceil(z - 0.45::DOUBLE) END::INT AS yz FROM b)
    SELECT "rideId", "isStart", x + 250 * unnest(CASE WHEN slope > 0 THEN range(ya, greatest(ya, yz) + 1)
      ELSE range(least(ya, yz), ya + 1) END)::INT AS cell FROM c"""


@query(_PATH)
def grid_cells_on_way(t: Tables) -> DataFrame:
    c = F.col
    way = geo.grid_cells_on_way(c("startLon"), c("startLat"), c("endLon"), c("endLat"))
    return rides.cleanse_rides(t.rides).select("rideId", "isStart", F.explode(way).alias("cell"))


@query(_PATH)
def path_cells(t: Tables) -> DataFrame:
    c = F.col
    city = rides.cleanse_rides(t.rides)
    cells = geo.path_cells(city, c("startLon"), c("startLat"), c("endLon"), c("endLat"))
    return cells.select("rideId", "isStart", "cell")


@query(
    f"""WITH {RIDES_SQL} SELECT "rideId", "eventTime" FROM v_rides
    WHERE NOT "isStart" AND "passengerCnt" > 2
      AND {EVENT_DISTANCE.format("(-73.8793)::FLOAT", "40.748::FLOAT")} < 2.0
      AND (epoch_us("eventTime") // 1000) % 2 = 0"""
)
def match_predicate(t: Tables) -> DataFrame:
    predicate = (
        "NOT ride.isStart AND passengerCnt > 2 AND watermark % 2 = 0"
        " AND rideDistance(ride, CAST(-73.8793 AS FLOAT), CAST(40.748 AS FLOAT)) < 2.0"
    )
    return rides.match_predicate(t.rides, predicate).select("rideId", "eventTime")


# --- windows and counts --------------------------------------------------------------------------

_HOPS = f"""WITH {RIDES_SQL}, c AS (
  SELECT {RIDE_CELL} AS cell, "isStart",
         unnest([time_bucket(INTERVAL 5 MINUTE, "eventTime"),
                 time_bucket(INTERVAL 5 MINUTE, "eventTime") - INTERVAL 5 MINUTE,
                 time_bucket(INTERVAL 5 MINUTE, "eventTime") - INTERVAL 10 MINUTE]) AS ws
  FROM v_city),
hops AS (SELECT cell, "isStart", ws, count(*) AS cnt FROM c GROUP BY ALL)
"""


@query(
    f'{_HOPS} SELECT round({LON_OF_CELL}::DOUBLE, 6) AS lon, round({LAT_OF_CELL}::DOUBLE, 6) AS lat,'
    ' ws AS "windowStart", ws + INTERVAL 15 MINUTE AS "windowEnd", "isStart", cnt'
    " FROM hops WHERE cnt >= 2"
)
def popular_places(t: Tables) -> DataFrame:
    return rides.popular_places(t.rides, min_count=2).select(
        rounded("lon"), rounded("lat"), "windowStart", "windowEnd", "isStart", "cnt"
    )


@query(
    f'{_HOPS} SELECT round({LON_OF_CELL}::DOUBLE, 6) AS lon, round({LAT_OF_CELL}::DOUBLE, 6) AS lat,'
    ' ws AS wstart, ws + INTERVAL 15 MINUTE AS wend, "isStart", cnt AS "popCnt"'
    " FROM hops WHERE cnt > 2"
)
def popular_places_sql(t: Tables) -> DataFrame:
    register_functions(t.spark)
    readers.register_rides(t.spark, t.rides, "TaxiRides")
    found = t.spark.sql(rides.POPULAR_PLACES_SQL.format(rides="TaxiRides", over=2))
    named = found.select(
        "place.*", F.col("span.start").alias("wstart"), F.col("span.end").alias("wend"),
        F.col("starting").alias("isStart"), F.col("events").alias("popCnt"),
    )
    return named.select(rounded("lon"), rounded("lat"), "wstart", "wend", "isStart", "popCnt")


_TIPS = f"""WITH {FARES_SQL}, h AS (
  SELECT date_trunc('hour', "startTime") + INTERVAL 1 HOUR AS "windowEnd", "driverId",
         sum(tip::DOUBLE) AS tips FROM v_fares GROUP BY ALL)
"""


@query(f'{_TIPS} SELECT "windowEnd", "driverId", round(tips, 6) AS tips FROM h')
def hourly_tips(t: Tables) -> DataFrame:
    return rides.hourly_tips(t.fares).select("windowEnd", "driverId", rounded("tips"))


@query(
    f"""{_TIPS} SELECT "windowEnd", "driverId", round(tips, 6) AS tips FROM (
    SELECT *, row_number() OVER (PARTITION BY "windowEnd" ORDER BY tips DESC, "driverId") AS rn FROM h)
    WHERE rn = 1"""
)
def hourly_tip_max(t: Tables) -> DataFrame:
    return rides.hourly_tip_max(t.fares).select("windowEnd", "driverId", rounded("tips"))


@query(f'{_TIPS} SELECT "windowEnd" AS wend, "driverId", round(tips, 6) AS tips FROM h WHERE tips > 50')
def hourly_tips_having(t: Tables) -> DataFrame:
    readers.register_fares(t.spark, t.fares, "TaxiFares")
    found = t.spark.sql(rides.HOURLY_TIPS_HAVING_SQL.format(fares="TaxiFares", over=50))
    return found.select(
        F.col("span.end").alias("wend"), "driverId", F.round("earned", 6).alias("tips")
    )


@query(
    f"""WITH {RIDES_SQL} SELECT date_trunc('hour', "eventTime") AS "windowStart", "isStart",
    count(*) AS cnt FROM v_rides GROUP BY ALL"""
)
def rides_per_hour(t: Tables) -> DataFrame:
    return rides.rides_per_hour(t.rides)


@query(
    f"""WITH {RIDES_SQL} SELECT "passengerCnt",
    round(avg((epoch_us("endTime") // 1000) - (epoch_us("startTime") // 1000)), 3) AS "avgDurationMs"
    FROM v_rides WHERE NOT "isStart" GROUP BY ALL"""
)
def avg_duration_by_passengers(t: Tables) -> DataFrame:
    return rides.avg_duration_by_passengers(t.rides).select(
        "passengerCnt", F.round("avgDurationMs", 3).alias("avgDurationMs")
    )


@query(f'WITH {RIDES_SQL} SELECT "driverId", count(*) AS cnt FROM v_rides GROUP BY ALL')
def ride_count(t: Tables) -> DataFrame:
    return rides.ride_count(t.rides)


@query(
    f"""WITH {RIDES_SQL} SELECT "driverId", "rideId", "eventTime",
    row_number() OVER (PARTITION BY "driverId" ORDER BY "eventTime", NOT "isStart", "rideId") AS cnt
    FROM v_rides"""
)
def running_ride_count(t: Tables) -> DataFrame:
    timed = rides.with_event_time(t.rides)
    counted = rides.running_count(
        timed, "driverId", rx.ride_order(), F.unix_micros("eventTime")
    )
    return counted.select("driverId", "rideId", "eventTime", "cnt")


_ROLLING = f"""WITH {RIDES_SQL}, e AS (
  SELECT {END_CELL} AS c, "eventTime" FROM v_rides WHERE NOT "isStart"),
n AS (SELECT c::VARCHAR AS cell, c, "eventTime", count(*) OVER (PARTITION BY c ORDER BY "eventTime"
  RANGE BETWEEN INTERVAL 10 MINUTE PRECEDING AND CURRENT ROW) AS cnt FROM e)
"""


@query(f'{_ROLLING} SELECT cell, "eventTime", cnt FROM n')
def ending_rides_rolling_count(t: Tables) -> DataFrame:
    return rides.ending_rides_rolling_count(t.rides)


@query(f'{_ROLLING} SELECT cell, "eventTime", cnt FROM n WHERE c = 50120')
def ending_rides_in_cell(t: Tables) -> DataFrame:
    return rides.ending_rides_rolling_count(t.rides, cell=50120)


@query(
    f"""WITH {RIDES_SQL} SELECT {RIDE_LIST}, "eventTime" FROM (SELECT *, row_number() OVER (
    PARTITION BY "taxiId" ORDER BY "eventTime" DESC, "isStart", "rideId" DESC) AS rn FROM v_rides)
    WHERE rn = 1"""
)
def latest_ride(t: Tables) -> DataFrame:
    return rides.latest_ride(t.rides)


# --- joins ---------------------------------------------------------------------------------------

_PAIRS = f"""WITH {RIDES_SQL}, {FARES_SQL},
l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY "rideId" ORDER BY "eventTime" DESC) AS rn
      FROM v_rides WHERE "isStart") WHERE rn = 1),
r AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY "rideId" ORDER BY "startTime" DESC) AS rn
      FROM v_fares) WHERE rn = 1)
"""


@query(
    f"""{_PAIRS} SELECT l."rideId", l."eventTime" AS "rideTime", r."startTime" AS "fareTime",
    round(r.tip::DOUBLE, 6) AS tip FROM l JOIN r USING ("rideId")"""
)
def join_rides_fares(t: Tables) -> DataFrame:
    pairs = joins.join_rides_fares(t.rides, t.fares)
    return pairs.select(
        "rideId",
        F.col("ride.eventTime").alias("rideTime"),
        F.col("fare.startTime").alias("fareTime"),
        "fare.tip",
    ).withColumn("tip", rounded("tip"))


@query(
    f"""{_PAIRS} SELECT coalesce(l."rideId", r."rideId") AS "rideId",
    CASE WHEN r."rideId" IS NULL THEN 'left_only' WHEN l."rideId" IS NULL THEN 'right_only'
         ELSE 'matched' END AS status,
    l."eventTime" AS "rideTime", r."startTime" AS "fareTime"
    FROM l FULL JOIN r ON l."rideId" = r."rideId" """
)
def match_or_expire(t: Tables) -> DataFrame:
    return joins.match_or_expire(t.rides, t.fares).select(
        "rideId",
        "status",
        F.col("ride.eventTime").alias("rideTime"),
        F.col("fare.startTime").alias("fareTime"),
    )


@query(
    f"""{_PAIRS}, p AS (SELECT l."rideId" AS a, r."rideId" AS b, l."eventTime" AS lt, r."startTime" AS rt,
      l."rideId" IS NOT NULL AND r."rideId" IS NOT NULL
        AND abs(epoch_us(l."eventTime") - epoch_us(r."startTime")) > 600000000 AS far
    FROM l FULL JOIN r ON l."rideId" = r."rideId")
    SELECT coalesce(a, b) AS "rideId", 'matched' AS status, lt AS "rideTime", rt AS "fareTime" FROM p
      WHERE NOT far AND a IS NOT NULL AND b IS NOT NULL
    UNION ALL SELECT a, 'left_only', lt, NULL FROM p WHERE a IS NOT NULL AND (far OR b IS NULL)
    UNION ALL SELECT b, 'right_only', NULL, rt FROM p WHERE b IS NOT NULL AND (far OR a IS NULL)"""
)
def match_or_expire_within(t: Tables) -> DataFrame:
    return joins.match_or_expire(t.rides, t.fares, "10 minutes").select(
        "rideId",
        "status",
        F.col("ride.eventTime").alias("rideTime"),
        F.col("fare.startTime").alias("fareTime"),
    )


_ASOF = """
FROM (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase') a
ASOF LEFT JOIN (SELECT event_id, user_id, ts FROM events WHERE event_type = 'signup') b
ON a.user_id = b.user_id AND a.ts >= b.ts
"""


@query(
    f"""SELECT a.event_id AS "tradeId", a.user_id AS "customerId", a.ts,
    coalesce('signup ' || b.event_id, 'No customer info available') AS "customerInfo" {_ASOF}"""
)
def enrich_trades(t: Tables) -> DataFrame:
    ev = t["events"]
    trades = ev.filter("event_type = 'purchase'").select(
        "ts",
        F.col("user_id").alias("customerId"),
        F.col("event_id").cast("string").alias("tradeInfo"),
    )
    customers = ev.filter("event_type = 'signup'").select(
        "ts",
        F.col("user_id").alias("customerId"),
        F.concat(F.lit("signup "), F.col("event_id").cast("string")).alias("customerInfo"),
    )
    return joins.enrich_trades(trades, customers).select(
        F.col("trade.tradeInfo").cast("long").alias("tradeId"),
        "trade.customerId",
        "trade.ts",
        "customerInfo",
    )


@query(f'SELECT a.event_id, a.user_id, a.ts, b.event_id AS "signupId" {_ASOF}')
def asof_join(t: Tables) -> DataFrame:
    ev = t["events"].select("event_id", "user_id", "ts", "event_type")
    signups = ev.filter("event_type = 'signup'").withColumnRenamed("event_id", "signupId")
    purchases = ev.filter("event_type = 'purchase'").drop("event_type")
    return joins.asof_join(purchases, signups, "user_id", "ts", ["signupId"])


_OPEN = """ s WHERE s."isStart" AND NOT EXISTS (SELECT 1 FROM v_rides e
  WHERE e."rideId" = s."rideId" AND NOT e."isStart"
    AND e."eventTime" <= s."eventTime" + INTERVAL 120 MINUTE)"""


@query(f'WITH {RIDES_SQL} SELECT "rideId", "taxiId", "eventTime" FROM v_rides {_OPEN}')
def long_rides(t: Tables) -> DataFrame:
    return joins.long_rides(t.rides).select("rideId", "taxiId", "eventTime")


@query(
    f'WITH {RIDES_SQL} SELECT "rideId", "taxiId", "eventTime" FROM v_city {_OPEN}'
    """ AND s."eventTime" + INTERVAL 120 MINUTE <= (SELECT max("eventTime") FROM v_rides)"""
)
def long_rides_cleansed(t: Tables) -> DataFrame:
    timed = rides.with_event_time(t.rides)
    horizon = timed.select(F.max("eventTime")).scalar()
    return joins.long_rides(rides.cleanse_rides(timed), horizon=horizon).select(
        "rideId", "taxiId", "eventTime"
    )


@query(
    """SELECT event_id, user_id, ts FROM events v WHERE event_type = 'view' AND NOT EXISTS (
    SELECT 1 FROM events p WHERE p.event_type = 'purchase' AND p.user_id = v.user_id
      AND p.ts <= v.ts + INTERVAL 3 DAY)"""
)
def sequence_timeout(t: Tables) -> DataFrame:
    kind = F.col("event_type")
    return joins.sequence_timeout(
        t["events"].select("event_id", "user_id", "ts", "event_type"),
        "user_id",
        "ts",
        kind == "view",
        kind == "purchase",
        "3 days",
    ).drop("event_type")


# --- segments and order --------------------------------------------------------------------------

_LABEL = "CASE trunc(e / 2.5)::INT WHEN 0 THEN 'calm' WHEN 1 THEN 'busy' ELSE 'crazy' END"
_SEGMENTS = f"""WITH {CARS_SQL},
m AS (SELECT *, speed = 0 AS stop, coalesce(sum((speed = 0)::INT) OVER (PARTITION BY "carId" ORDER BY ts
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS run,
      sum((speed = 0)::INT) OVER (PARTITION BY "carId") AS stops FROM v_car),
g AS (SELECT "carId", run, min(ts) AS "startTime", count(*) AS length,
        trunc(max(speed))::INT AS "maxSpeed", stddev_pop(throttle::DOUBLE) AS e
      FROM m WHERE NOT stop AND run < stops GROUP BY ALL)
SELECT "carId", "startTime", length, "maxSpeed", round(e, 6) AS erraticness, {_LABEL} AS label FROM g
"""


def _rounded_segments(df: DataFrame) -> DataFrame:
    return df.select(
        "carId", "startTime", "length", "maxSpeed", rounded("erraticness"), "label"
    )


@query(_SEGMENTS)
def driving_segments(t: Tables) -> DataFrame:
    return _rounded_segments(segments.driving_segments(t.cars))


@query(f"{_SEGMENTS} WHERE run > 0")
def driving_segments_pattern(t: Tables) -> DataFrame:
    return _rounded_segments(segments.driving_segments(t.cars, require_leading_stop=True))


@query(
    f"""WITH {CARS_SQL},
    f AS (SELECT *, CASE WHEN ts - lag(ts) OVER w <= INTERVAL 6 HOUR THEN 0 ELSE 1 END AS fresh
          FROM v_car WINDOW w AS (PARTITION BY "carId" ORDER BY ts)),
    s AS (SELECT *, sum(fresh) OVER (PARTITION BY "carId" ORDER BY ts) AS run FROM f),
    g AS (SELECT "carId", run, min(ts) AS "startTime", count(*) AS length,
            trunc(max(speed))::INT AS "maxSpeed", stddev_pop(throttle::DOUBLE) AS e FROM s GROUP BY ALL)
    SELECT "carId", "startTime", length, "maxSpeed", round(e, 6) AS erraticness, {_LABEL} AS label FROM g"""
)
def driving_sessions(t: Tables) -> DataFrame:
    return _rounded_segments(segments.driving_sessions(t.cars, "6 hours"))


@query(
    f"""WITH {CARS_SQL} SELECT id, "carId", ts,
    row_number() OVER (PARTITION BY "carId" ORDER BY ts, id) AS seq FROM v_car"""
)
def event_time_order(t: Tables) -> DataFrame:
    ordered = segments.event_time_order(t.cars, "carId", "ts", "id")
    return ordered.select("id", "carId", "ts", "seq")


@query(f'WITH {CARS_SQL} SELECT id, "carId", ts, round(speed::DOUBLE, 6) AS speed FROM v_car')
def event_time_sort(t: Tables) -> DataFrame:
    return segments.event_time_sort(t.cars, "carId", "ts", "id").select(
        "id", "carId", "ts", rounded("speed")
    )


RULES = [("buy", "view", "purchase"), ("fail", "click", "error"), ("again", "signup", "signup")]


@query(
    """WITH rules(rule, a, b) AS (VALUES ('buy', 'view', 'purchase'), ('fail', 'click', 'error'),
      ('again', 'signup', 'signup')),
    i AS (SELECT event_id, user_id, rule, event_type = a AS fst, event_type = b AS snd
          FROM events JOIN rules ON event_type IN (a, b)),
    n AS (SELECT *, min(CASE WHEN snd THEN event_id END) OVER (PARTITION BY user_id, rule
            ORDER BY event_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS nxt FROM i)
    SELECT rule, user_id, event_id AS "firstSeq", nxt AS "secondSeq" FROM n
    WHERE fst AND nxt IS NOT NULL"""
)
def sequence_rules(t: Tables) -> DataFrame:
    items = t["events"].select(
        F.col("event_id").alias("seq"), "user_id", F.col("event_type").alias("shape")
    )
    given = t.spark.createDataFrame(RULES, "rule STRING, first STRING, second STRING")
    return rules.match_sequence_rules(items, given, "user_id").select(
        "rule", "user_id", "firstSeq", "secondSeq"
    )


@query(
    f"""WITH {RIDES_SQL},
    f AS (SELECT *, {END_CELL} AS cell,
      trunc({angle_sql('"endLon"', '"endLat"', '"startLon"', '"startLat"')} / 45)::INT AS bucket,
      {dist_sql('"startLon"', '"startLat"', '"endLon"', '"endLat"')} AS x,
      CASE WHEN NOT "isStart" THEN ((epoch_us("endTime") // 1000) - (epoch_us("startTime") // 1000)) / 60000.0::DOUBLE END AS y
      FROM v_city),
    m AS (SELECT *, count(y) OVER w AS n, sum(x * y) OVER w AS sxy,
      sum(CASE WHEN NOT "isStart" THEN x * x END) OVER w AS sxx FROM f
      WINDOW w AS (PARTITION BY cell, bucket ORDER BY "eventTime", NOT "isStart", "rideId"
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
    SELECT "rideId", CASE WHEN n >= 2 AND sxx > 0 THEN trunc(sxy / sxx * x)::INT ELSE -1 END AS prediction
    FROM m WHERE "isStart" """
)
def travel_time_predictions(t: Tables) -> DataFrame:
    return travel.travel_time_predictions(t.rides)


# --- sequence patterns ---------------------------------------------------------------------------

def drive() -> list[patterns.Step]:
    """A stop, driving rows, and the stop that ends them."""
    stops = F.col("speed") == 0
    return [patterns.Step("stop", stops), patterns.Step("drive", F.col("speed") != 0, repeated=True), patterns.Step("end", stops)]


def whole_ride() -> list[patterns.Step]:
    """A ride that begins and, as the next thing, ends."""
    return [patterns.Step("start", F.col("isStart")), patterns.Step("end", ~F.col("isStart"))]


@query(
    f"""WITH {CARS_SQL}, n AS (SELECT *, row_number() OVER w AS k, sum((speed = 0)::INT) OVER w AS stops FROM v_car
      WINDOW w AS (PARTITION BY "carId" ORDER BY ts, id::BIGINT ROWS UNBOUNDED PRECEDING)),
    stop AS (SELECT *, lead(k) OVER s AS "nextStop", lead(ts) OVER s AS "matchedAt" FROM n WHERE speed = 0
      WINDOW s AS (PARTITION BY "carId" ORDER BY k))
    SELECT id, "carId", ts, "matchedAt", ("nextStop" - k - 1)::BIGINT AS "rowsBetween" FROM stop WHERE "nextStop" > k + 1"""
)
def pattern_driving_segments(t: Tables) -> DataFrame:
    found = patterns.match_pattern(t.cars, ["carId"], "ts", drive(), ties=[F.col("id").cast("long")])
    return found.select("id", "carId", "ts", "matchedAt", "rowsBetween")


@query(
    f"""WITH {RIDES_SQL}, n AS (SELECT *, lead("eventTime") OVER w AS nt, lead("isStart") OVER w AS ns FROM v_rides
      WINDOW w AS (PARTITION BY "rideId" ORDER BY "eventTime", NOT "isStart", "taxiId"))
    SELECT "rideId", "taxiId", "eventTime",
      CASE WHEN nt IS NULL OR nt > "eventTime" + INTERVAL 2 HOUR THEN 'timeout' ELSE 'match' END AS outcome
    FROM n WHERE "isStart" AND (nt IS NULL OR nt > "eventTime" + INTERVAL 2 HOUR OR NOT ns)"""
)
def pattern_long_rides(t: Tables) -> DataFrame:
    timed = rides.with_event_time(t.rides)
    found = patterns.match_pattern(
        timed, ["rideId"], "eventTime", whole_ride(), "120 minutes", [~F.col("isStart"), F.col("taxiId")]
    )
    return found.select("rideId", "taxiId", "eventTime", "outcome")


# --- questions while rides flow ------------------------------------------------------------------

_REPORTS = f"""WITH {RIDES_SQL}, {QUERIES_SQL},
reports AS (SELECT q."queryId", r."taxiId", r."rideId", r."eventTime", q.ts,
  ({EVENT_DISTANCE.format("q.lon", "q.lat")})::FLOAT AS km
  FROM v_rides r JOIN v_queries q ON r."eventTime" >= q.ts WHERE NOT "isStart")
"""


@query(f'{_REPORTS} SELECT "queryId", "taxiId", round(km::DOUBLE, 4) AS km, "eventTime" FROM reports')
def taxi_reports(t: Tables) -> DataFrame:
    return control.taxi_reports(t.rides, t.taxi_queries).select(
        "queryId", "taxiId", F.round(F.col("km").cast("double"), 4).alias("km"), "eventTime"
    )


@query(
    f"""{_REPORTS} SELECT "queryId", "taxiId", round(km::DOUBLE, 4) AS km, "eventTime" FROM (
    SELECT *, row_number() OVER (PARTITION BY "queryId" ORDER BY km, "eventTime") AS rn FROM reports)
    WHERE rn = 1"""
)
def nearest_taxi(t: Tables) -> DataFrame:
    found = nearest.nearest_taxi(t.rides, t.taxi_queries)
    return found.withColumn("km", F.round(F.col("km").cast("double"), 4))


_IMPROVING = """ SELECT "queryId", "taxiId", round(km::DOUBLE, 4) AS km, "eventTime" FROM (
    SELECT *, min(km) OVER (PARTITION BY "queryId" ORDER BY "eventTime"
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best FROM {0})
    WHERE best IS NULL OR km < best"""


@query(_REPORTS + _IMPROVING.format("reports"))
def nearest_taxi_improvements(t: Tables) -> DataFrame:
    found = nearest.nearest_taxi_improvements(t.rides, t.taxi_queries)
    return found.withColumn("km", F.round(F.col("km").cast("double"), 4))


@query(
    _REPORTS
    + """, live AS (SELECT * FROM reports r WHERE NOT EXISTS (SELECT 1 FROM v_queries c
      WHERE c.ts > r.ts + INTERVAL 15 MINUTE AND c.ts <= r."eventTime"))"""
    + _IMPROVING.format("live")
)
def nearest_taxi_expiring(t: Tables) -> DataFrame:
    found = nearest.nearest_taxi_improvements(t.rides, t.taxi_queries, "15 minutes")
    return found.withColumn("km", F.round(F.col("km").cast("double"), 4))


@query(
    f"""WITH RECURSIVE {RIDES_SQL}, {QUERIES_SQL},
    spans AS (SELECT q.*, (SELECT min(c.ts) FROM v_queries c WHERE c.ts > q.ts + INTERVAL 15 MINUTE) AS until FROM v_queries q),
    reports AS (SELECT q."queryId", r."taxiId", r."eventTime", ({EVENT_DISTANCE.format("q.lon", "q.lat")})::FLOAT AS km,
      row_number() OVER (PARTITION BY q."queryId" ORDER BY r."eventTime", r."rideId") AS k
      FROM v_rides r JOIN spans q ON r."eventTime" >= q.ts AND (q.until IS NULL OR r."eventTime" < q.until)
      WHERE NOT "isStart"),
    chain AS (
      SELECT * FROM reports WHERE k = 1
      UNION ALL
      SELECT r.* FROM (
        SELECT c."queryId", min(r.k) AS k FROM chain c JOIN reports r ON r."queryId" = c."queryId" AND r.k > c.k
          AND (r.km < c.km OR r."eventTime" > c."eventTime" + INTERVAL 8 HOUR)
        GROUP BY c."queryId") n
      JOIN reports r ON r."queryId" = n."queryId" AND r.k = n.k)
    SELECT "queryId", "taxiId", round(km::DOUBLE, 4) AS km, "eventTime" FROM chain"""
)
def nearest_taxi_cleanup(t: Tables) -> DataFrame:
    found = nearest.nearest_taxi_improvements(t.rides, t.taxi_queries, "15 minutes", "8 hours")
    return found.withColumn("km", F.round(F.col("km").cast("double"), 4))


_VALID = f"""WITH {RIDES_SQL}, valid AS (SELECT *, lead("eventTime") OVER (PARTITION BY "taxiId"
  ORDER BY "eventTime", NOT "isStart", "rideId") AS "until" FROM v_rides)
"""


@query(
    f"""{_VALID}, {CONTROLS_SQL} SELECT "controlId", "controlTime", "rideId", "taxiId", "eventTime"
    FROM valid JOIN v_controls ON "eventTime" <= "controlTime"
      AND ("until" IS NULL OR "controlTime" < "until")
    WHERE "isStart" AND ((epoch_us("controlTime") // 1000) - (epoch_us("eventTime") // 1000)) // 60000 >= minutes"""
)
def ongoing_rides(t: Tables) -> DataFrame:
    return control.ongoing_rides(t.rides, t.controls).select(
        "controlId", "controlTime", "rideId", "taxiId", "eventTime"
    )


def _predicate_sql(watermark: str) -> str:
    near = EVENT_DISTANCE.format("(-73.8793)::FLOAT", "40.748::FLOAT")
    return (
        '(CASE "controlId" WHEN 0 THEN "isStart" WHEN 1 THEN NOT "isStart" AND "passengerCnt" > 2 '
        f'WHEN 2 THEN {near} < 2.0 WHEN 3 THEN (epoch_us({watermark}) // 1000) % 2 = 0 '
        'ELSE "driverId" < 30 AND "isStart" END)'
    )


@query(
    f"""{_VALID}, {PREDICATES_SQL},
    spans AS (SELECT *, lead("controlTime") OVER (ORDER BY "controlTime") AS nxt FROM v_predicates)
    SELECT 'QUERY' AS kind, "controlTime" AS at, "controlId", NULL::BIGINT AS "rideId" FROM v_predicates
    UNION ALL
    SELECT 'PBE', "controlTime", "controlId", "rideId" FROM valid JOIN v_predicates
      ON (epoch_us("eventTime") // 1000) <= (epoch_us("controlTime") // 1000)
      AND ("until" IS NULL OR (epoch_us("controlTime") // 1000) < (epoch_us("until") // 1000))
      WHERE {_predicate_sql('"controlTime"')}
    UNION ALL
    SELECT 'PE', "eventTime", "controlId", "rideId" FROM v_rides JOIN spans
      ON (epoch_us("eventTime") // 1000) > (epoch_us("controlTime") // 1000)
      AND (nxt IS NULL OR (epoch_us("eventTime") // 1000) <= (epoch_us(nxt) // 1000))
      WHERE {_predicate_sql('"eventTime"')}"""
)
def taxi_query(t: Tables) -> DataFrame:
    return control.taxi_query(t.rides, t.predicates).select("kind", "at", "controlId", "rideId")


# --- mails ---------------------------------------------------------------------------------------


@query(f"WITH {MAILS_SQL} SELECT month, email FROM v_sent")
def month_email(t: Tables) -> DataFrame:
    return mail.month_email(t.mails)


@query(f"WITH {MAILS_SQL} SELECT month, email FROM v_sent WHERE email <> 'jira@apache.org'")
def exclude_senders(t: Tables) -> DataFrame:
    return mail.exclude_senders(mail.month_email(t.mails), mail.MEMBER_BOTS)


@query(f"WITH {MAILS_SQL} SELECT month, email, count(*) AS cnt FROM v_sent GROUP BY ALL")
def mail_count(t: Tables) -> DataFrame:
    return mail.mail_count(t.mails)


_REPLIES = f"""WITH {MAILS_SQL}, p AS (SELECT r.email AS replier, o.email AS author, o."messageId"
  FROM v_sent r JOIN v_sent o ON r."replyTo" = o."messageId"
  WHERE r.email <> 'jira@apache.org' AND o.email <> 'jira@apache.org')
"""


@query(f'{_REPLIES} SELECT "messageId", replier, author, count(*) AS cnt FROM p GROUP BY ALL')
def reply_connections(t: Tables) -> DataFrame:
    return mail.reply_connections(t.mails)


@query(f"{_REPLIES} SELECT replier, author, count(*) AS cnt FROM p GROUP BY ALL")
def reply_graph(t: Tables) -> DataFrame:
    return mail.reply_graph(t.mails)


@query(
    f"""WITH {MAILS_SQL}, c AS (SELECT month, email, count(*) AS cnt FROM v_sent
      WHERE email <> 'jira@apache.org' GROUP BY ALL)
    SELECT month, email, cnt FROM c QUALIFY cnt = max(cnt) OVER (PARTITION BY month)"""
)
def member_of_month(t: Tables) -> DataFrame:
    return mail.member_of_month(t.mails)


_STOP = ", ".join(f"'{w}'" for w in tx.STOP_WORDS)
_TERMS = f"""WITH w AS (SELECT doc_id, unnest(string_split_regex(lower(text), '[ \\t\\n\\r\\f]+')) AS word
  FROM documents),
tf AS (SELECT doc_id, word, count(*) AS tf FROM w
  WHERE regexp_full_match(word, '[A-Za-z]+') AND word NOT IN ({_STOP}) GROUP BY ALL),
df AS (SELECT word, count(*) AS df FROM tf GROUP BY ALL)
"""


@query(f"{_TERMS} SELECT doc_id, word, tf FROM tf")
def term_frequency(t: Tables) -> DataFrame:
    return mail.term_frequency(t["documents"], "doc_id", "text")


@query(f"{_TERMS} SELECT word, df FROM df")
def document_frequency(t: Tables) -> DataFrame:
    return mail.document_frequency(t["documents"], "text")


@query(
    f"""{_TERMS} SELECT doc_id, word,
    round(tf * ((SELECT count(*) FROM documents)::DOUBLE / df), 6) AS tfidf FROM tf JOIN df USING (word)"""
)
def tf_idf(t: Tables) -> DataFrame:
    return mail.tf_idf(t["documents"], "doc_id", "text").select("doc_id", "word", rounded("tfidf"))


@query(
    f"""WITH {ARCHIVE_SQL} SELECT "messageId", time, sender, subject, body, "replyTo" FROM v_archive
    QUALIFY row_number() OVER (PARTITION BY "messageId"
      ORDER BY time, body, sender, subject, "replyTo") = 1"""
)
def mbox_to_mails(t: Tables) -> DataFrame:
    return mail.mbox_to_mails(t.archive)


@query(f'WITH {ARCHIVE_SQL} SELECT "messageId", time, sender, subject, body, "replyTo" FROM v_archive')
def parse_mails(t: Tables) -> DataFrame:
    return mail.parse_mails(t.archive)


@query(f'WITH {MAILS_SQL} SELECT "messageId", time, sender, subject, body, "replyTo" FROM v_mails')
def mail_records(t: Tables) -> DataFrame:
    return readers.split_mails(sinks.encode_mails(t.mails))


# --- graph ---------------------------------------------------------------------------------------


@query(
    f'WITH {EDGES_SQL} SELECT src, round(sum(weight), 2) AS "outWeight" FROM v_edges GROUP BY src'
)
def out_weights(t: Tables) -> DataFrame:
    return graph.out_weights(t.edges).select("src", F.round("outWeight", 2).alias("outWeight"))


@query(f"WITH {EDGES_SQL} SELECT src, dst, round(weight, 6) AS weight FROM v_transitions")
def transition_weights(t: Tables) -> DataFrame:
    return graph.transition_weights(t.edges).select("src", "dst", rounded("weight"))


ROUNDS = 10


def _pagerank_sql(edges: str) -> str:
    steps = [
        "v AS (SELECT src AS id FROM v_edges UNION SELECT dst FROM v_edges)",
        "p0 AS (SELECT id, 1.0::DOUBLE AS rank FROM v)",
    ]
    for i in range(1, ROUNDS + 1):
        steps.append(
            f"p{i} AS (SELECT v.id, 0.15::DOUBLE / (SELECT count(*) FROM v)"
            f" + 0.85::DOUBLE * coalesce(s.got, 0) AS rank FROM v LEFT JOIN (SELECT dst AS id,"
            f" sum(rank * weight) AS got FROM v_transitions JOIN p{i - 1} ON src = id GROUP BY dst) s"
            " ON v.id = s.id)"
        )
    return f"WITH {edges}, {', '.join(steps)} SELECT id, round(rank, 6) AS rank FROM p{ROUNDS}"


@query(_pagerank_sql(EDGES_SQL))
def pagerank(t: Tables) -> DataFrame:
    return graph.pagerank(t.edges, iterations=ROUNDS).select("id", rounded("rank"))


#: Customers and the suppliers of their lines, both ways, so that rank flows on.
_TRADE_SQL = """
v_lines AS (SELECT 'c' || o_custkey AS c, 's' || l_suppkey AS s, count(*)::DOUBLE AS n
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL),
v_edges AS (SELECT c AS src, s AS dst, n AS weight FROM v_lines UNION ALL SELECT s, c, n FROM v_lines),
v_transitions AS (SELECT src, dst, weight / sum(weight) OVER (PARTITION BY src) AS weight FROM v_edges)
"""


@query(_pagerank_sql(_TRADE_SQL))
def pagerank_customers(t: Tables) -> DataFrame:
    lines = t["lineitem"].join(t["orders"], F.col("l_orderkey") == F.col("o_orderkey"))
    c, s = F.concat(F.lit("c"), "o_custkey"), F.concat(F.lit("s"), "l_suppkey")
    sold = lines.groupBy(c.alias("c"), s.alias("s")).agg(F.count(F.lit(1)).cast("double").alias("n"))
    edge = lambda a, b: F.struct(F.col(a).alias("src"), F.col(b).alias("dst"), F.col("n").alias("weight"))
    edges = sold.select(F.inline(F.array(edge("c", "s"), edge("s", "c"))))
    return graph.pagerank(edges, iterations=ROUNDS).select("id", rounded("rank"))


# --- sources and sinks ---------------------------------------------------------------------------

_SECOND = "date_trunc('second', {0})"


def _coordinates(df: DataFrame) -> DataFrame:
    return df.select(
        *[
            rounded(c) if c in ("startLon", "startLat", "endLon", "endLat") else F.col(c)
            for c in df.columns
        ]
    )


def _rides_out_sql(source: str) -> str:
    coords = ", ".join(
        f'round("{c}"::DOUBLE, 6) AS "{c}"' for c in ("startLon", "startLat", "endLon", "endLat")
    )
    return f"""SELECT "rideId", "isStart", date_trunc('second', "startTime") AS "startTime",
      date_trunc('second', "endTime") AS "endTime", {coords}, "passengerCnt", "taxiId", "driverId",
      date_trunc('second', "eventTime") AS "eventTime" FROM {source}"""


@query(f"WITH {RIDES_SQL} {_rides_out_sql('v_city')}")
def ride_topic_round_trip(t: Tables) -> DataFrame:
    values = sinks.encode_rides(rides.cleanse_rides(t.rides))
    return _coordinates(readers.decode_rides(values, delay=None))


@query(
    f"""WITH {FARES_SQL} SELECT "rideId", "taxiId", "driverId",
    date_trunc('second', "startTime") AS "startTime", "paymentType",
    round(tip::DOUBLE, 4) AS tip, round(tolls::DOUBLE, 4) AS tolls,
    round("totalFare"::DOUBLE, 4) AS "totalFare" FROM v_fares"""
)
def fare_text_round_trip(t: Tables) -> DataFrame:
    fares = readers.parse_fares(sinks.encode_fares(t.fares))
    money = [F.round(F.col(c).cast("double"), 4).alias(c) for c in ("tip", "tolls", "totalFare")]
    return fares.select("rideId", "taxiId", "driverId", "startTime", "paymentType", *money)


@query(
    f"""WITH {CARS_SQL} SELECT id, "carId", date_trunc('second', ts) AS ts,
    round(speed::DOUBLE, 4) AS speed, round(throttle::DOUBLE, 4) AS throttle,
    round(consumption::DOUBLE, 4) AS consumption FROM v_car"""
)
def car_event_lines(t: Tables) -> DataFrame:
    cars = t.cars
    text = {
        0: F.col("carId"),
        1: F.col("id"),
        7: F.col("consumption").cast("string"),
        9: F.when(F.col("speed") == 0, "").otherwise(F.col("speed").cast("string")),
        12: F.col("throttle").cast("string"),
        19: F.col("engineload").cast("string"),
        20: F.col("longitude").cast("string"),
        21: F.col("latitude").cast("string"),
        22: F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ssXX"),
    }
    line = F.concat_ws("; ", *[text.get(i, F.lit("-")) for i in range(23)])
    parsed = readers.parse_car_events(cars.select(line.alias("value")))
    numbers = [
        F.round(F.col(c).cast("double"), 4).alias(c) for c in ("speed", "throttle", "consumption")
    ]
    return parsed.select("id", "carId", "ts", *numbers)


_TRIPS = """WITH tr AS (SELECT row_number() OVER (ORDER BY date_trunc('second', ts), event_id::VARCHAR) AS n,
  event_id, user_id, date_trunc('second', ts) AS up,
  date_trunc('second', ts) + to_minutes(floor(value)::BIGINT + 1) AS down FROM events)
"""


def _trip_lines(t: Tables) -> DataFrame:
    c = F.col
    down = F.date_trunc("second", "ts") + F.make_interval(
        mins=(F.floor("value") + 1).cast("int")
    )
    fields = [
        c("user_id"), (c("user_id") + 1000), F.lit("VTS"), F.lit(""), F.lit("N"),
        rx.format_time(c("ts")), rx.format_time(down), c("event_id") % 4 + 1, F.lit("60"),
        F.lit("1.5"), F.lit("-73.98"), F.lit("40.75"), F.lit(""), F.lit("40.76"),
    ]
    # The text after the pick-up time must order trips of one second by event.
    return t["events"].select(
        F.concat(F.concat_ws(",", *[f.cast("string") for f in fields]), F.lit("\r")).alias("value"),
        "event_id",
        "ts",
    )


@query(
    _TRIPS
    + """SELECT event_id AS "rideId", true AS "isStart", up AS "startTime",
      TIMESTAMP '1970-01-01 00:00:00' AS "endTime", round((-73.98)::FLOAT::DOUBLE, 6) AS "startLon", 0::DOUBLE AS "endLon",
      (event_id % 4 + 1)::SMALLINT AS "passengerCnt", user_id AS "taxiId", user_id + 1000 AS "driverId"
      FROM tr UNION ALL
    SELECT event_id, false, up, down, round((-73.98)::FLOAT::DOUBLE, 6), 0, (event_id % 4 + 1)::SMALLINT, user_id, user_id + 1000
      FROM tr"""
)
def trips_to_ride_events(t: Tables) -> DataFrame:
    events = etl.trips_to_ride_events(_trip_lines(t), row_id=F.col("event_id"))
    return events.select(
        "rideId", "isStart", "startTime", "endTime", rounded("startLon"), rounded("endLon"),
        "passengerCnt", "taxiId", "driverId",
    )


@query(
    """WITH tr AS (SELECT user_id, date_trunc('second', ts) AS up, date_trunc('second', ts)
        + to_minutes(floor(value)::BIGINT + 1) AS down, event_id % 4 + 1 AS people FROM events),
      n AS (SELECT *, row_number() OVER (ORDER BY up, user_id || ',' || (user_id + 1000) || ',VTS,,N,'
        || strftime(up, '%Y-%m-%d %H:%M:%S') || ',' || strftime(down, '%Y-%m-%d %H:%M:%S') || ',' || people) AS id FROM tr)
    SELECT id AS "rideId", true AS "isStart", up AS "startTime", TIMESTAMP '1970-01-01 00:00:00' AS "endTime",
      people::SMALLINT AS "passengerCnt", user_id AS "taxiId" FROM n UNION ALL
    SELECT id, false, up, down, people::SMALLINT, user_id FROM n"""
)
def numbered_trips(t: Tables) -> DataFrame:
    events = etl.trips_to_ride_events(_trip_lines(t))
    return events.select("rideId", "isStart", "startTime", "endTime", "passengerCnt", "taxiId")


@query(
    """SELECT row_number() OVER (ORDER BY date_trunc('second', ts), line) AS "rideId", user_id AS "taxiId",
      user_id + 1000 AS "driverId", date_trunc('second', ts) AS "startTime", 'CRD' AS "paymentType",
      round(value::FLOAT::DOUBLE, 4) AS tip, 0::DOUBLE AS tolls, round((value + 1)::FLOAT::DOUBLE, 4) AS "totalFare"
    FROM (SELECT *, user_id || ',' || (user_id + 1000) || ',VTS,' AS line, FROM events)"""
)
def raw_fares_to_fares(t: Tables) -> DataFrame:
    c = F.col
    fields = [
        c("user_id"), c("user_id") + 1000, F.lit("VTS"), rx.format_time(c("ts")), F.lit("CRD"),
        F.lit("5"), F.lit("0"), F.lit("0.5"), c("value"), F.lit(""), c("value") + 1,
    ]
    lines = t["events"].select(F.concat_ws(",", *[f.cast("string") for f in fields]).alias("value"))
    fares = etl.raw_fares_to_fares(lines)
    money = [F.round(F.col(x).cast("double"), 4).alias(x) for x in ("tip", "tolls", "totalFare")]
    return fares.select("rideId", "taxiId", "driverId", "startTime", "paymentType", *money)


@query(
    f"""{_HOPS} SELECT '{{"time":"' || (epoch_us(ws + INTERVAL 15 MINUTE) // 1000) || '","location":"'
      || {LAT_OF_CELL} || ',' || {LON_OF_CELL} || '","isStart":"' || "isStart" || '","cnt":"' || cnt
      || '"}}' AS document FROM hops WHERE cnt >= 2"""
)
def place_documents(t: Tables) -> DataFrame:
    places = rides.popular_places(t.rides, min_count=2)
    return sinks.to_place_documents(places).select("document")


@query(
    """SELECT 'rides,key=' || user_id || ' value=' || value || ' ' || (epoch_us(ts) // 1000) AS value FROM events"""
)
def line_protocol(t: Tables) -> DataFrame:
    return sinks.to_line_protocol(
        t["events"], "rides", F.col("ts"), F.col("value"), key=F.col("user_id")
    )
