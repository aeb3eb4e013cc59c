"""Record schemas. All times are UTC; coordinates stay FLOAT because the grid maths depends on it."""

from __future__ import annotations

RIDE = (
    "rideId BIGINT, isStart BOOLEAN, startTime TIMESTAMP, endTime TIMESTAMP, "
    "startLon FLOAT, startLat FLOAT, endLon FLOAT, endLat FLOAT, "
    "passengerCnt SMALLINT, taxiId BIGINT, driverId BIGINT"
)
RIDE_COLUMNS = [part.split()[0] for part in RIDE.split(", ")]

FARE = (
    "rideId BIGINT, taxiId BIGINT, driverId BIGINT, startTime TIMESTAMP, "
    "paymentType STRING, tip FLOAT, tolls FLOAT, totalFare FLOAT"
)
FARE_COLUMNS = [part.split()[0] for part in FARE.split(", ")]

CAR_EVENT = (
    "id STRING, carId STRING, ts TIMESTAMP, longitude FLOAT, latitude FLOAT, "
    "consumption FLOAT, speed FLOAT, throttle FLOAT, engineload FLOAT"
)

TRADE = "ts TIMESTAMP, customerId BIGINT, tradeInfo STRING"
CUSTOMER = "ts TIMESTAMP, customerId BIGINT, customerInfo STRING"
ITEM = "seq BIGINT, color STRING, shape STRING"
RULE = "rule STRING, first STRING, second STRING"
TAXI_QUERY = "queryId BIGINT, ts TIMESTAMP, lon FLOAT, lat FLOAT"
ONGOING_CONTROL = "controlId BIGINT, ts TIMESTAMP, minutes BIGINT"
PREDICATE_CONTROL = "controlId BIGINT, ts TIMESTAMP, predicate STRING"

MAIL_COLUMNS = ["messageId", "time", "sender", "subject", "body", "replyTo"]
MAIL = ", ".join(f"{name} STRING" for name in MAIL_COLUMNS)

EDGE = "src STRING, dst STRING, weight DOUBLE"

#: Time formats of the files (fixed values).
EVENT_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
CAR_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ssX"
MAIL_TIME_FORMAT = "yyyy-MM-dd-HH:mm:ss"
