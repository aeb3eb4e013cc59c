"""City grid and distance expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamlab.plans.once import once

# The city box, the grid steps and the length of a degree in km.
LON_EAST = -73.7
LON_WEST = -74.05
LAT_NORTH = 41.0
LAT_SOUTH = 40.5
DELTA_LON = 0.0014
DELTA_LAT = 0.00125
GRID_WIDTH = 250
DEGREE_KM = 110.25

DIRECTION_BUCKET_DEGREES = 45
#: Beyond so many steps from the corner a place has no cell number.
MAX_STEPS = 4_000_000.0


def _double(c: Column) -> Column:
    return c.cast("float").cast("double")


def is_in_nyc(lon: Column, lat: Column) -> Column:
    """Inside the city box, borders included. NaN is outside (Spark orders it above all numbers)."""
    return _double(lon).between(LON_WEST, LON_EAST) & _double(lat).between(LAT_SOUTH, LAT_NORTH)


def _whole(steps: Column) -> Column:
    """Whole grid steps; null where there is no cell: NaN, infinity, or beyond what a cell number holds."""
    return F.when(F.abs(steps) < MAX_STEPS, F.floor(steps)).cast("int")


def grid_x(lon: Column) -> Column:
    return _whole((F.lit(-LON_WEST) - F.abs(_double(lon))) / F.lit(DELTA_LON))


def grid_y(lat: Column) -> Column:
    return _whole((F.lit(LAT_NORTH) - _double(lat)) / F.lit(DELTA_LAT))


def cell_id(lon: Column, lat: Column) -> Column:
    """Number of the ~100 m grid cell, counted row by row from the north-west corner."""
    return grid_x(lon) + F.lit(GRID_WIDTH) * grid_y(lat)


def cell_center_lon(cell: Column) -> Column:
    x = cell % GRID_WIDTH
    return -((F.lit(-LON_WEST) - x * F.lit(DELTA_LON) - F.lit(DELTA_LON / 2)).cast("float"))


def cell_center_lat(cell: Column) -> Column:
    y = ((cell - cell % GRID_WIDTH) / GRID_WIDTH).cast("int")
    return (F.lit(LAT_NORTH) - y * F.lit(DELTA_LAT) - F.lit(DELTA_LAT / 2)).cast("float")


def cell_coords(cell: Column) -> Column:
    return F.struct(cell_center_lon(cell).alias("lon"), cell_center_lat(cell).alias("lat"))


def _cos(lat: Column, radians: bool) -> Column:
    return F.cos(F.radians(_double(lat)) if radians else _double(lat))


def distance(
    lon1: Column, lat1: Column, lon2: Column, lat2: Column, radians: bool = False
) -> Column:
    """Flat distance in km. By default the cosine takes the degrees of lat2 unconverted, because the
    numbers of the existing jobs depend on it; ``radians=True`` gives the geographic value."""
    dy = (lat1.cast("float") - lat2.cast("float")).cast("double")
    dx = (lon1.cast("float") - lon2.cast("float")).cast("double") * _cos(lat2, radians)
    return F.lit(DEGREE_KM) * F.sqrt(dy * dy + dx * dx)


def direction_angle(
    lon1: Column, lat1: Column, lon2: Column, lat2: Column, radians: bool = False
) -> Column:
    """Whole degrees from point 1 to point 2, in -1..359 (same cosine remark as ``distance``)."""
    dy = (lat2.cast("float") - lat1.cast("float")).cast("double")
    dx = (lon2.cast("float") - lon1.cast("float")).cast("double") * _cos(lat1, radians)
    return F.degrees(F.atan2(dy, dx)).cast("int") + F.lit(179)


def direction_bucket(angle: Column) -> Column:
    """One of 8 buckets; division truncates, so -1 falls in bucket 0."""
    return (angle / DIRECTION_BUCKET_DEGREES).cast("int")


#: A path that passes a cell corner closer than this (in cells) steps diagonally.
CORNER_TOLERANCE = 0.05


def _path_line(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Grid line between two points, from its western end (x0, y0) to (x1, y1).

    ``side`` is 1 or -1 and the y values are multiplied by it, so that y never falls along the line
    and ``slope`` is not negative.
    """
    ends = F.array_sort(
        F.array(
            F.struct(grid_x(lon1).alias("x"), F.lit(0).alias("i"), grid_y(lat1).alias("y")),
            F.struct(grid_x(lon2).alias("x"), F.lit(1).alias("i"), grid_y(lat2).alias("y")),
        )
    )
    def line(e: Column) -> Column:
        west, east = e[0], e[1]
        side = F.when(east["y"] < west["y"], -1).otherwise(1)
        # A vertical line has a slope beyond any grid height.
        width = F.greatest((east["x"] - west["x"]).cast("double"), F.lit(1e-9))
        return F.struct(
            west["x"].alias("x0"),
            (west["y"] * side).alias("y0"),
            east["x"].alias("x1"),
            (east["y"] * side).alias("y1"),
            side.alias("side"),
            (F.abs(east["y"] - west["y"]) / width).alias("slope"),
        )

    return F.transform(F.array(ends), line)[0]


def _column_run(line: Column, x: Column) -> Column:
    """The cells the line crosses in grid column ``x``: one contiguous run of rows."""
    middle = line["y0"] + (x - line["x0"]) * line["slope"]
    entry = F.greatest(middle - line["slope"] / 2, line["y0"].cast("double"))
    leave = F.least(middle + line["slope"] / 2, line["y1"].cast("double"))
    first = F.floor(entry + F.lit(0.5 + CORNER_TOLERANCE))
    last = F.greatest(first, F.floor(leave + F.lit(0.5 - CORNER_TOLERANCE)))
    step = line["side"] * F.lit(GRID_WIDTH)
    return F.sequence((x + step * first).cast("int"), (x + step * last).cast("int"), step)


def grid_cells_on_way(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Cells crossed by the straight line between the two points' cell centres, west to east.

    The line is cut at the column borders, so the list is a run of cells per grid column and needs
    no walk.
    """
    return F.transform(
        F.array(_path_line(lon1, lat1, lon2, lat2)),
        lambda line: F.flatten(
            F.transform(F.sequence(line["x0"], line["x1"]), lambda x: _column_run(line, x))
        ),
    )[0]


def path_cells(
    df: DataFrame, lon1: Column, lat1: Column, lon2: Column, lat2: Column, name: str = "cell"
) -> DataFrame:
    """``grid_cells_on_way`` as rows: one row per crossed cell, by generators in compiled code."""
    return (
        df.withColumn("_line", once(_path_line(lon1, lat1, lon2, lat2)))
        .withColumn("_x", F.explode(F.sequence("_line.x0", "_line.x1")))
        .withColumn(name, F.explode(_column_run(F.col("_line"), F.col("_x"))))
        .drop("_line", "_x")
    )
