"""The given tables seen as rides, fares, car events, mails, controls and edges.

Each view is a projection of a whole table, written once for Spark and once as a SQL common table
expression for the checks. Ride ends are shifted against their starts by ``value``, so some rides
end late, some twice and some never.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from streamlab.schemas import CAR_EVENT, FARE, MAIL_COLUMNS, RIDE

BASE = "2024-01-01 00:00:00"


def _typed(df: DataFrame, ddl: str) -> DataFrame:
    return df.select(*[F.col(c).cast(t).alias(c) for c, t in (p.split() for p in ddl.split(", "))])


def _center_lon(x: Column) -> Column:
    return (-(F.lit(74.05) - x * F.lit(0.0014) - F.lit(0.0007))).cast("float")


def _center_lat(y: Column) -> Column:
    return (F.lit(41.0) - y * F.lit(0.00125) - F.lit(0.000625)).cast("float")


def rides_from_events(ev: DataFrame) -> DataFrame:
    c = F.col
    half = F.floor(c("event_id") / 2)
    start = c("event_id") % 2 == 0
    shifted = half - F.floor("value")
    rows = ev.select(
        F.when(start, half).otherwise(shifted).alias("rideId"),
        start.alias("isStart"),
        F.when(start, c("ts"))
        .otherwise(c("ts") - F.make_interval(mins=(F.floor("value") + 1).cast("int")))
        .alias("startTime"),
        F.when(start, F.lit("1970-01-01 00:00:00").cast("timestamp")).otherwise(c("ts")).alias("endTime"),
        (c("event_id") % 4 + 1).alias("passengerCnt"),
        c("user_id").alias("taxiId"),
        c("user_id").alias("driverId"),
    )
    ride = c("rideId")
    return _typed(
        rows.withColumn("startLon", _center_lon(F.lit(100) + ride % 2))
        .withColumn(
            "startLat", F.when(ride % 11 == 0, F.lit(42.0)).otherwise(_center_lat(F.lit(200)))
        )
        .withColumn("endLon", _center_lon(F.lit(120) + ride % 3))
        .withColumn("endLat", _center_lat(F.lit(200) + ride % 3)),
        RIDE,
    )


RIDES_SQL = """
r0 AS (
  SELECT CASE WHEN event_id % 2 = 0 THEN event_id // 2
              ELSE event_id // 2 - floor(value)::BIGINT END AS "rideId",
         event_id % 2 = 0 AS "isStart",
         CASE WHEN event_id % 2 = 0 THEN ts
              ELSE ts - to_minutes(floor(value)::BIGINT + 1) END AS "startTime",
         CASE WHEN event_id % 2 = 0 THEN TIMESTAMP '1970-01-01 00:00:00' ELSE ts END AS "endTime",
         (event_id % 4 + 1)::SMALLINT AS "passengerCnt",
         user_id AS "taxiId", user_id AS "driverId", ts AS "eventTime"
  FROM events),
v_rides AS (
  SELECT *,
    (-(74.05::DOUBLE - (100 + "rideId" % 2) * 0.0014::DOUBLE - 0.0007::DOUBLE))::FLOAT AS "startLon",
    CASE WHEN "rideId" % 11 = 0 THEN 42::FLOAT
         ELSE (41::DOUBLE - 200 * 0.00125::DOUBLE - 0.000625::DOUBLE)::FLOAT END AS "startLat",
    (-(74.05::DOUBLE - (120 + "rideId" % 3) * 0.0014::DOUBLE - 0.0007::DOUBLE))::FLOAT AS "endLon",
    (41::DOUBLE - (200 + "rideId" % 3) * 0.00125::DOUBLE - 0.000625::DOUBLE)::FLOAT AS "endLat"
  FROM r0),
v_city AS (
  SELECT * FROM v_rides
  WHERE "startLon"::DOUBLE BETWEEN -74.05 AND -73.7 AND "startLat"::DOUBLE BETWEEN 40.5 AND 41.0
    AND "endLon"::DOUBLE BETWEEN -74.05 AND -73.7 AND "endLat"::DOUBLE BETWEEN 40.5 AND 41.0)
"""


def fares_from_events(ev: DataFrame) -> DataFrame:
    c = F.col
    return _typed(
        ev.select(
            (c("event_id") - F.floor("value")).alias("rideId"),
            c("user_id").alias("taxiId"),
            c("user_id").alias("driverId"),
            c("ts").alias("startTime"),
            F.when(c("event_type") == "purchase", "CRD").otherwise("CSH").alias("paymentType"),
            c("value").alias("tip"),
            F.lit(0.0).alias("tolls"),
            (c("value") + 2.5).alias("totalFare"),
        ),
        FARE,
    )


FARES_SQL = """
v_fares AS (
  SELECT event_id - floor(value)::BIGINT AS "rideId", user_id AS "taxiId", user_id AS "driverId",
         ts AS "startTime", CASE WHEN event_type = 'purchase' THEN 'CRD' ELSE 'CSH' END AS "paymentType",
         value::FLOAT AS tip, 0::FLOAT AS tolls, (value + 2.5::DOUBLE)::FLOAT AS "totalFare"
  FROM events)
"""


def cars_from_events(ev: DataFrame) -> DataFrame:
    c = F.col
    return _typed(
        ev.select(
            c("event_id").alias("id"),
            c("user_id").alias("carId"),
            "ts",
            F.lit(-73.9).alias("longitude"),
            F.lit(40.7).alias("latitude"),
            (c("value") / 10).alias("consumption"),
            F.when(c("event_type") == "error", 0.0).otherwise(c("value")).alias("speed"),
            (c("value") % 100).alias("throttle"),
            (c("value") / 2).alias("engineload"),
        ),
        CAR_EVENT,
    )


CARS_SQL = """
v_car AS (
  SELECT event_id::VARCHAR AS id, user_id::VARCHAR AS "carId", ts,
         (-73.9)::FLOAT AS longitude, 40.7::FLOAT AS latitude, (value / 10)::FLOAT AS consumption,
         CASE WHEN event_type = 'error' THEN 0 ELSE value END::FLOAT AS speed,
         (value % 100)::FLOAT AS throttle, (value / 2)::FLOAT AS engineload
  FROM events)
"""


def mails_from_orders(orders: DataFrame) -> DataFrame:
    c = F.col
    key = c("o_orderkey")
    customer = F.concat(
        F.lit("Customer <c"), c("o_custkey").cast("string"), F.lit("@example.com>")
    )
    return orders.select(
        key.cast("string").alias("messageId"),
        F.date_format("o_orderdate", "yyyy-MM-dd-HH:mm:ss").alias("time"),
        F.when(c("o_orderpriority") == "5-LOW", "JIRA <jira@apache.org>")
        .otherwise(customer)
        .alias("sender"),
        c("o_orderpriority").alias("subject"),
        c("o_orderstatus").alias("body"),
        F.when(c("o_orderstatus") == "P", "null")
        .otherwise((key - 1 - c("o_custkey") % 7).cast("string"))
        .alias("replyTo"),
    )


MAILS_SQL = """
v_mails AS (
  SELECT o_orderkey::VARCHAR AS "messageId", strftime(o_orderdate, '%Y-%m-%d-%H:%M:%S') AS time,
         CASE WHEN o_orderpriority = '5-LOW' THEN 'JIRA <jira@apache.org>'
              ELSE 'Customer <c' || o_custkey || '@example.com>' END AS sender,
         o_orderpriority AS subject, o_orderstatus AS body,
         CASE WHEN o_orderstatus = 'P' THEN 'null'
              ELSE (o_orderkey - 1 - o_custkey % 7)::VARCHAR END AS "replyTo"
  FROM orders),
v_sent AS (
  SELECT *, substr(time, 1, 7) AS month,
         regexp_replace(sender, '^.*<(.*).$', '\\1') AS email
  FROM v_mails)
"""


def archive_from_documents(docs: DataFrame) -> DataFrame:
    """Raw mails whose body is a document; equal documents share a message id."""
    c = F.col
    day = F.lpad((c("doc_id") % 28 + 1).cast("string"), 2, " ")
    return docs.select(
        F.concat(
            F.lit("From dev-return-"),
            c("doc_id").cast("string"),
            F.lit("@example.org Thu Apr "),
            day,
            F.lit(" 10:11:12 2014\nMessage-ID: <"),
            F.md5("text"),
            F.lit(">\nFROM: "),
            c("source"),
            F.lit(" <"),
            c("source"),
            F.lit("@example.org>\nSubject: "),
            c("lang"),
            F.lit("\nX-Note: none\n\n"),
            c("text"),
        ).alias("value")
    )


ARCHIVE_SQL = """
v_archive AS (
  SELECT '<' || md5(text) || '>' AS "messageId",
         '2014-04-' || lpad((doc_id % 28 + 1)::VARCHAR, 2, '0') || '-10:11:12' AS time,
         source || ' <' || source || '@example.org>' AS sender, lang AS subject,
         replace(chr(10) || regexp_replace(text, '\\n+$', '') || chr(10), '=' || chr(10), '') AS body,
         'null' AS "replyTo"
  FROM documents WHERE regexp_replace(text, '\\n+$', '') <> ''
    AND NOT contains(text, '#|#') AND NOT contains(text, '##//##'))
"""


def queries_from_nations(nation: DataFrame) -> DataFrame:
    k = F.col("n_nationkey")
    return nation.select(
        k.cast("long").alias("queryId"),
        (F.lit(BASE).cast("timestamp") + F.make_interval(hours=k * 26)).alias("ts"),
        _center_lon(F.lit(110) + k).alias("lon"),
        _center_lat(F.lit(201)).alias("lat"),
    )


QUERIES_SQL = """
v_queries AS (
  SELECT n_nationkey::BIGINT AS "queryId",
         TIMESTAMP '2024-01-01 00:00:00' + to_hours(n_nationkey * 26) AS ts,
         (-(74.05::DOUBLE - (110 + n_nationkey) * 0.0014::DOUBLE - 0.0007::DOUBLE))::FLOAT AS lon,
         (41::DOUBLE - 201 * 0.00125::DOUBLE - 0.000625::DOUBLE)::FLOAT AS lat
  FROM nation)
"""


def controls_from_nations(nation: DataFrame) -> DataFrame:
    k = F.col("n_nationkey")
    return nation.select(
        k.cast("long").alias("controlId"),
        (F.lit(BASE).cast("timestamp") + F.make_interval(hours=k * 24 + 12)).alias("ts"),
        (k * 10).cast("long").alias("minutes"),
    )


CONTROLS_SQL = """
v_controls AS (
  SELECT n_nationkey::BIGINT AS "controlId",
         TIMESTAMP '2024-01-01 00:00:00' + to_hours(n_nationkey * 24 + 12) AS "controlTime",
         n_nationkey::BIGINT * 10 AS minutes
  FROM nation)
"""

PREDICATES = {
    0: "isStart",
    1: "NOT ride.isStart AND ride.passengerCnt > 2",
    2: "rideDistance(ride, CAST(-73.8793 AS FLOAT), CAST(40.748 AS FLOAT)) < 2.0",
    3: "watermark % 2 = 0",
}
PREDICATE_ELSE = "driverId < 30 AND isStart"


def predicates_from_regions(region: DataFrame) -> DataFrame:
    k = F.col("r_regionkey")
    text = F.lit(PREDICATE_ELSE)
    for key, predicate in PREDICATES.items():
        text = F.when(k == key, predicate).otherwise(text)
    return region.select(
        k.cast("long").alias("controlId"),
        (F.lit(BASE).cast("timestamp") + F.make_interval(hours=k * 120 + 1)).alias("ts"),
        text.alias("predicate"),
    )


PREDICATES_SQL = """
v_predicates AS (
  SELECT r_regionkey::BIGINT AS "controlId",
         TIMESTAMP '2024-01-01 00:00:00' + to_hours(r_regionkey * 120 + 1) AS "controlTime"
  FROM region)
"""


def edges_from_trade(
    lineitem: DataFrame, orders: DataFrame, customer: DataFrame, supplier: DataFrame
) -> DataFrame:
    """Trade between nations: customer's nation to supplier's nation, weighted by price."""
    lines = lineitem.join(orders, lineitem.l_orderkey == orders.o_orderkey)
    sold = lines.groupBy("o_custkey", "l_suppkey").agg(F.sum("l_extendedprice").alias("price"))
    return (
        sold.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy(
            F.col("c_nationkey").cast("string").alias("src"),
            F.col("s_nationkey").cast("string").alias("dst"),
        )
        .agg(F.sum("price").alias("weight"))
    )


EDGES_SQL = """
v_edges AS (
  SELECT c_nationkey::VARCHAR AS src, s_nationkey::VARCHAR AS dst, sum(l_extendedprice) AS weight
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
       JOIN supplier ON l_suppkey = s_suppkey
  GROUP BY 1, 2),
v_transitions AS (
  SELECT src, dst, weight / sum(weight) OVER (PARTITION BY src) AS weight FROM v_edges)
"""


#: Schemas read so far, so that a file's footer is not read again for each use of a table.
_SCHEMAS: dict[str, StructType] = {}


class Tables:
    """The given tables of one folder, and the views over them."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.sf_dir = sf_dir

    def __getitem__(self, name: str) -> DataFrame:
        """A table; its times without a zone are UTC."""
        path = f"{self.sf_dir}/{name}.parquet"
        if path not in _SCHEMAS:
            _SCHEMAS[path] = self.spark.read.parquet(path).schema
        df = self.spark.read.schema(_SCHEMAS[path]).parquet(path)
        zoneless = [c for c, kind in df.dtypes if kind == "timestamp_ntz"]
        return df.withColumns({c: F.col(c).cast("timestamp") for c in zoneless})

    @property
    def rides(self) -> DataFrame:
        return rides_from_events(self["events"])

    @property
    def fares(self) -> DataFrame:
        return fares_from_events(self["events"])

    @property
    def cars(self) -> DataFrame:
        return cars_from_events(self["events"])

    @property
    def mails(self) -> DataFrame:
        return mails_from_orders(self["orders"]).select(*MAIL_COLUMNS)

    @property
    def archive(self) -> DataFrame:
        return archive_from_documents(self["documents"])

    @property
    def taxi_queries(self) -> DataFrame:
        return queries_from_nations(self["nation"])

    @property
    def controls(self) -> DataFrame:
        return controls_from_nations(self["nation"])

    @property
    def predicates(self) -> DataFrame:
        return predicates_from_regions(self["region"])

    @property
    def edges(self) -> DataFrame:
        return edges_from_trade(
            self["lineitem"], self["orders"], self["customer"], self["supplier"]
        )
