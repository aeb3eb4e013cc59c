"""The scalar functions under SQL names, as SQL-bodied functions that Catalyst inlines."""

from __future__ import annotations

from pyspark.sql import SparkSession

from streamlab.schemas import RIDE

_POINT = "lon FLOAT, lat FLOAT"
_POINTS = "lon1 FLOAT, lat1 FLOAT, lon2 FLOAT, lat2 FLOAT"

#: name -> (parameters, return type, body)
SQL_FUNCTIONS = {
    "isInNYC": (
        _POINT,
        "BOOLEAN",
        "CAST(lon AS DOUBLE) BETWEEN -74.05D AND -73.7D AND CAST(lat AS DOUBLE) BETWEEN 40.5D AND 41.0D",
    ),
    "toCellId": (
        _POINT,
        "INT",
        "CASE WHEN abs((74.05D - abs(CAST(lon AS DOUBLE))) / 0.0014D) < 4000000D"
        " AND abs((41.0D - CAST(lat AS DOUBLE)) / 0.00125D) < 4000000D"
        " THEN CAST(floor((74.05D - abs(CAST(lon AS DOUBLE))) / 0.0014D) AS INT)"
        " + 250 * CAST(floor((41.0D - CAST(lat AS DOUBLE)) / 0.00125D) AS INT) END",
    ),
    "toCoords": (
        "cell INT",
        "STRUCT<lon: FLOAT, lat: FLOAT>",
        "named_struct("
        "'lon', -CAST(74.05D - (cell % 250) * 0.0014D - 0.0007D AS FLOAT),"
        "'lat', CAST(41.0D - ((cell - cell % 250) DIV 250) * 0.00125D - 0.000625D AS FLOAT))",
    ),
    "geoDistance": (
        _POINTS,
        "DOUBLE",
        "110.25D * sqrt(power(CAST(lat1 - lat2 AS DOUBLE), 2)"
        " + power(CAST(lon1 - lon2 AS DOUBLE) * cos(CAST(lat2 AS DOUBLE)), 2))",
    ),
    "rideDistance": (
        f"ride STRUCT<{RIDE}>, {_POINT}",
        "DOUBLE",
        "CASE WHEN ride.isStart THEN geoDistance(lon, lat, ride.startLon, ride.startLat)"
        " ELSE geoDistance(lon, lat, ride.endLon, ride.endLat) END",
    ),
    "directionAngle": (
        _POINTS,
        "INT",
        "CAST(degrees(atan2(CAST(lat2 - lat1 AS DOUBLE),"
        " CAST(lon2 - lon1 AS DOUBLE) * cos(CAST(lat1 AS DOUBLE)))) AS INT) + 179",
    ),
    "directionBucket": ("angle INT", "INT", "CAST(angle DIV 45 AS INT)"),
    "erraticnessLabel": (
        "erraticness DOUBLE",
        "STRING",
        "CASE WHEN erraticness IS NULL THEN NULL WHEN erraticness < 2.5D THEN 'calm'"
        " WHEN erraticness < 5D THEN 'busy' ELSE 'crazy' END",
    ),
    "mailMonth": ("time STRING", "STRING", "substring(time, 1, 7)"),
    "emailAddress": (
        "sender STRING",
        "STRING",
        "substring(substring_index(sender, '<', -1), 1, length(substring_index(sender, '<', -1)) - 1)",
    ),
}


def register_functions(spark: SparkSession) -> list[str]:
    for name, (params, result, body) in SQL_FUNCTIONS.items():
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({params}) RETURNS {result} RETURN {body}"
        )
    return list(SQL_FUNCTIONS)
