"""Nearest taxi per question without pairs of questions and rides.

Time is cut into slices. A task reads the rides of one slice and a block of questions, looks for the
nearest rides through a grid, and returns per question only the rides that were nearer than all before
them in the slice (``heads``) and those that no later ride of the slice is nearer than (``tails``). From
these a question's best is carried over its slices in order. Where an old best is forgotten inside a
slice, that slice is read once more for that question, from there on.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamlab.functions import geo
from streamlab.operators.control import next_time
from streamlab.operators.rides import end_rides, with_event_time
from streamlab.plans.hotkeys import PART, PART_ROWS, split_by_position
from streamlab.plans.intervals import interval_point_join
from streamlab.plans.lineage import cut_lineage

# The functions of this module travel to the executors by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Questions of a task, and parts that endless questions are dealt in to meet their slices.
BLOCK, DEALS = 4_096, 16
#: A slice of time, unless a best is forgotten sooner.
DAY_MS = 86_400_000
#: Cells of a slice's grid along each side; fewer rides than this are compared without one.
SIDE, LEAST_FOR_GRID = 64, 20_000


def located_ends(rides: DataFrame) -> DataFrame:
    """END rows with the place where they ended; rows without one (null, NaN, infinite) report nothing."""
    lon, lat = F.col("endLon").cast("float"), F.col("endLat").cast("float")
    known = (F.abs(lon) < float("inf")) & (F.abs(lat) < float("inf"))
    return end_rides(with_event_time(rides)).where(known).select(
        "rideId", "taxiId", "eventTime", lon.alias("lon"), lat.alias("lat"), F.cos(lat.cast("double")).alias("cosLat")
    )


class Grid:
    """Rides of a slice by cell. A cell's rides lie in a box, which bounds their distance from below."""

    def __init__(self, lon: np.ndarray, lat: np.ndarray, cos: np.ndarray, degree_km: float):
        self.lon, self.lat, self.cos, self.degree_km = lon, lat, cos, degree_km
        cell = self._steps(lon) * SIDE + self._steps(lat)
        self.order = np.argsort(cell, kind="stable")  # by cell, and within a cell by time
        starts = np.flatnonzero(np.diff(cell[self.order], prepend=-1))
        self.starts, self.ends = starts, np.append(starts[1:], len(lon))
        self.first = self.order[starts]
        inside = [np.asarray(x[self.order], np.float64) for x in (lon, lat, np.abs(cos))]
        self.low_lon, self.low_lat, self.low_cos = (np.minimum.reduceat(x, starts) for x in inside)
        self.high_lon, self.high_lat = (np.maximum.reduceat(x, starts) for x in inside[:2])

    @staticmethod
    def _steps(x: np.ndarray) -> np.ndarray:
        low, high = float(x.min()), float(x.max())
        return np.minimum(((x.astype(np.float64) - low) / ((high - low) or 1.0) * SIDE).astype(np.int64), SIDE - 1)

    def km(self, lon: float, lat: float, rows: np.ndarray) -> np.ndarray:
        dy = (np.float32(lat) - self.lat[rows]).astype(np.float64)
        dx = (np.float32(lon) - self.lon[rows]).astype(np.float64) * self.cos[rows]
        return (self.degree_km * np.sqrt(dy * dy + dx * dx)).astype(np.float32)

    def bounds(self, lon: float, lat: float) -> np.ndarray:
        """No ride of a cell is nearer than this (a little less, for what rounding may take)."""
        dy = np.maximum(np.maximum(self.low_lat - lat, lat - self.high_lat), 0)
        dx = np.maximum(np.maximum(self.low_lon - lon, lon - self.high_lon), 0) * self.low_cos
        return self.degree_km * np.sqrt(dy * dy + dx * dx) * (1 - 1e-5) - 1e-4

    def search(self, lon: float, lat: float, lo: int, hi: int) -> "Search":
        return Search(self, lon, lat, lo, hi)


class Plain:
    """The same answers for few rides: the distances to all of them."""

    def __init__(self, lon: np.ndarray, lat: np.ndarray, cos: np.ndarray, degree_km: float):
        self.lon, self.lat, self.cos, self.degree_km = lon, lat, cos, degree_km

    def search(self, lon: float, lat: float, lo: int, hi: int) -> "PlainSearch":
        return PlainSearch(Grid.km(self, lon, lat, slice(lo, hi)), lo)


class PlainSearch:
    def __init__(self, km: np.ndarray, lo: int):
        self.km, self.lo = km, lo

    def _picked(self, places: np.ndarray) -> list[tuple[float, int]]:
        return list(zip(self.km[places].tolist(), (places + self.lo).tolist()))

    def heads(self, lo: int, hi: int) -> list[tuple[float, int]]:
        before = np.minimum.accumulate(np.append(np.float32(np.inf), self.km[:-1]))
        return self._picked(np.flatnonzero(self.km < before))

    def tails(self, lo: int, hi: int) -> list[tuple[float, int]]:
        later = np.minimum.accumulate(np.append(np.float32(np.inf), self.km[:0:-1]))[::-1]
        return self._picked(np.flatnonzero(self.km <= later))


class Search:
    """Nearest rides of one question among the rides lo..hi, cells in the order of their bounds."""

    def __init__(self, grid: Grid, lon: float, lat: float, lo: int, hi: int):
        self.grid, self.lon, self.lat, self.lo, self.hi = grid, lon, lat, lo, hi
        bounds = grid.bounds(lon, lat)
        self.cells = np.argsort(bounds, kind="stable")
        self.bounds = bounds[self.cells]
        self.seen: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def _cell(self, place: int) -> tuple[np.ndarray, np.ndarray]:
        if place not in self.seen:
            c = self.cells[place]
            rows = self.grid.order[self.grid.starts[c] : self.grid.ends[c]]
            rows = rows[np.searchsorted(rows, self.lo) : np.searchsorted(rows, self.hi)]
            self.seen[place] = rows, self.grid.km(self.lon, self.lat, rows)
        return self.seen[place]

    def nearest(self, lo: int, hi: int) -> tuple[float, int] | None:
        """(km, row) of the nearest ride in lo..hi, the earliest of equals; cells further than it are not read."""
        best = None
        for place in range(len(self.cells)):
            if best is not None and self.bounds[place] > best[0]:
                break
            rows, km = self._cell(place)
            a, b = np.searchsorted(rows, lo), np.searchsorted(rows, hi)
            if a < b:
                i = a + int(km[a:b].argmin())
                found = (float(km[i]), int(rows[i]))
                best = found if best is None else min(best, found)
        return best

    def heads(self, lo: int, hi: int) -> list[tuple[float, int]]:
        """Rides nearer than all before them, from the last back to the first."""
        out = []
        while hi > lo and (best := self.nearest(lo, hi)):
            out.append(best)
            hi = best[1]
        return out[::-1]

    def tails(self, lo: int, hi: int) -> list[tuple[float, int]]:
        """Rides that no later one is nearer than."""
        out = []
        while hi > lo and (best := self.nearest(lo, hi)):
            out.append(best)
            lo = best[1] + 1
        return out


_HEAD = "queryId long, hour long, part int, us array<long>, km array<float>, taxiId array<long>, tailUs array<long>, tailKm array<float>"
_FOUND = "queryId long, us long, km float, taxiId long, hour long, part int, after long"


def _slice_of(rides: pa.Table) -> tuple[pa.Table, Grid | Plain, np.ndarray]:
    rides = rides.sort_by([("us", "ascending"), ("rideId", "ascending")])
    columns = (rides.column(name).to_numpy() for name in ("lon", "lat", "cosLat"))
    kind = Plain if rides.num_rows < LEAST_FOR_GRID else Grid
    return rides, kind(*columns, geo.DEGREE_KM), rides.column("us").to_numpy()


def _each(asked: pa.Table, us: np.ndarray, grid: Grid | Plain) -> Iterator[tuple[dict, Search | PlainSearch, int, int]]:
    """Questions with the rides (lo..hi) that come while they are active."""
    ms = us // 1000
    for row in asked.to_pylist():
        lo = int(np.searchsorted(ms, row["askedMs"]))
        hi = len(ms) if row["untilMs"] is None else int(np.searchsorted(ms, row["untilMs"]))
        if row.get("after") is not None:
            lo = max(lo, int(np.searchsorted(us, row["after"], "right")))
        if lo < hi:
            yield row, grid.search(row["lon"], row["lat"], lo, hi), lo, hi


def summarise(key: tuple, asked: pa.Table, rides: pa.Table) -> pa.Table:
    out: list[tuple] = []
    if asked.num_rows and rides.num_rows:
        rides, grid, us = _slice_of(rides)
        taxi = rides.column("taxiId")
        for row, search, lo, hi in _each(asked, us, grid):
            heads, tails = search.heads(lo, hi), search.tails(lo, hi)
            out.append((
                row["queryId"], row["hour"], row["part"], [int(us[i]) for _, i in heads], [km for km, _ in heads],
                [taxi[i].as_py() for _, i in heads], [int(us[i]) for _, i in tails], [km for km, _ in tails],
            ))
    return _table(out, _HEAD)


def restart(key: tuple, asked: pa.Table, rides: pa.Table) -> pa.Table:
    """What improves after an old best was forgotten, for the slices where that happens."""
    out: list[tuple] = []
    if asked.num_rows and rides.num_rows:
        rides, grid, us = _slice_of(rides)
        taxi = rides.column("taxiId")
        for row, search, lo, hi in _each(asked, us, grid):
            out += [(row["queryId"], int(us[i]), km, taxi[i].as_py(), None, None, None) for km, i in search.heads(lo, hi)]
    return _table(out, _FOUND)


def carry_best(ttl_us: int | None):
    """Fold a question's slices in order: its improvements, and where it has to be read from again."""

    def fold(key: tuple, slices: pa.Table) -> pa.Table:
        out: list[tuple] = []
        best = None
        for s in slices.sort_by([("hour", "ascending"), ("part", "ascending")]).to_pylist():
            heads = list(zip(s["km"], s["us"], s["taxiId"]))
            end = None if best is None or ttl_us is None else best[1] + ttl_us
            nearer = heads if best is None else [h for h in heads if h[0] < best[0]]
            if nearer and (end is None or nearer[0][1] <= end):
                out += [(s["queryId"], us, km, taxi, None, None, None) for km, us, taxi in nearer]
                best = nearer[-1][:2]
            elif end is not None and s["tailUs"][-1] > end:
                out.append((s["queryId"], None, None, None, s["hour"], s["part"], end))
                best = next((km, us) for km, us in zip(s["tailKm"], s["tailUs"]) if us > end)
        return _table(out, _FOUND)

    return fold


def _table(rows: list[tuple], ddl: str) -> pa.Table:
    kinds = {"long": pa.int64(), "int": pa.int32(), "float": pa.float32(), "array<long>": pa.list_(pa.int64()), "array<float>": pa.list_(pa.float32())}
    fields = [part.split(" ") for part in ddl.split(", ")]
    columns = list(zip(*rows)) or [()] * len(fields)
    return pa.table({name: pa.array(column, kinds[kind]) for (name, kind), column in zip(fields, columns)})


def _micros(interval: str) -> int:
    count, unit = interval.split()
    return int(count) * {"second": 10**6, "minute": 60 * 10**6, "hour": 3600 * 10**6, "day": 86400 * 10**6}[unit.rstrip("s")]


def _slices(rides: DataFrame, queries: DataFrame, query_ttl: str | None, slice_ms: int, part_rows: int) -> tuple[DataFrame, DataFrame]:
    """Rides with their slice (hour, part) and block; questions with every slice that they are active in."""
    if query_ttl is None:
        asked = queries.withColumn("_until", F.lit(None).cast("long"))
    else:
        asked = next_time(queries, F.unix_millis("ts") + _micros(query_ttl) // 1000, part_rows)
    active = asked.where("lon <> 0").select(
        "queryId", F.col("lon").cast("float").alias("lon"), F.col("lat").cast("float").alias("lat"),
        F.unix_millis("ts").alias("askedMs"), F.col("_until").alias("untilMs"),
    )
    active = cut_lineage(active, "questions") if query_ttl is not None else active
    blocks = max(-(-queries.where("lon <> 0").count() // BLOCK), 1)
    ms = F.unix_millis("eventTime")
    timed = located_ends(rides).withColumn("us", F.unix_micros("eventTime")).withColumn("hour", F.floor(ms / slice_ms))
    timed = split_by_position(timed, ["hour"], F.unix_millis("eventTime"), part_rows).withColumnRenamed(PART, "part")
    timed = timed.select("rideId", "taxiId", "us", "lon", "lat", "cosLat", "hour", "part")
    there = timed.groupBy("hour", "part").agg(F.count(F.lit(1)).alias("_n")).drop("_n")
    first = F.floor(F.col("askedMs") / slice_ms) * slice_ms
    if query_ttl is None:  # no question ends
        deal = F.pmod(F.col("hour"), F.lit(DEALS))
        every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(DEALS - 1).cast("long")))
        dealt = there.withColumn("_deal", deal).join(active.withColumn("_deal", every), "_deal")
        dealt = dealt.where(F.col("hour") * slice_ms >= first)
    else:
        dealt = interval_point_join(active, there, first, F.col("untilMs"), F.col("hour") * slice_ms)
    own = F.pmod(F.xxhash64("queryId"), F.lit(blocks)).cast("int").alias("block")
    # Named anew: these columns come from the rides, which the questions are about to meet.
    dealt = dealt.select(*active.columns, F.col("hour").alias("hour"), F.col("part").alias("part"), own)
    return timed.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))), dealt


_SLICE = ["hour", "part", "block"]


def _summaries(rides: DataFrame, dealt: DataFrame) -> DataFrame:
    return dealt.groupBy(*_SLICE).cogroup(rides.groupBy(*_SLICE)).applyInArrow(summarise, _HEAD)


def nearest_taxi(
    rides: DataFrame, queries: DataFrame, query_ttl: str | None = None, slice_ms: int = DAY_MS, part_rows: int = PART_ROWS
) -> DataFrame:
    """(queryId, taxiId, km, eventTime): the closest END ride while a question is active, the earliest of equals.

    Questions are active as in ``control.taxi_reports``. Rides of one slice are split at ``part_rows`` rows.
    """
    timed, dealt = _slices(rides, queries, query_ttl, slice_ms, part_rows)
    best = _summaries(timed, dealt).select(
        "queryId", F.struct(*(F.element_at(c, -1).alias(c) for c in ("km", "us", "taxiId"))).alias("b")
    )
    return best.groupBy("queryId").agg(F.min("b").alias("b")).select(
        "queryId", "b.taxiId", "b.km", F.timestamp_micros("b.us").alias("eventTime")
    )


def nearest_taxi_improvements(
    rides: DataFrame,
    queries: DataFrame,
    query_ttl: str | None = None,
    report_ttl: str | None = None,
    slice_ms: int = DAY_MS,
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """(queryId, taxiId, km, eventTime): END rides closer than the best so far of a question.

    With ``report_ttl`` the best is forgotten that long after it was set; the next ride then counts at
    any distance. Rides of equal time come in the order of their ids. Questions are active as in
    ``control.taxi_reports``; what is returned per question grows with its slices, not with the rides.
    """
    ttl_us = None if report_ttl is None else _micros(report_ttl)
    if ttl_us is not None:
        slice_ms = min(slice_ms, ttl_us // 1000)  # at most one best is forgotten within a slice
    timed, dealt = _slices(rides, queries, query_ttl, slice_ms, part_rows)
    folded = _summaries(timed, dealt).groupBy("queryId").applyInArrow(carry_best(ttl_us), _FOUND)
    found = folded
    if ttl_us is not None:
        folded = cut_lineage(folded, "improvements")
        again = folded.where("after IS NOT NULL").select("queryId", "hour", "part", "after")
        sought = dealt.join(again, ["queryId", "hour", "part"])
        later = sought.groupBy(*_SLICE).cogroup(timed.groupBy(*_SLICE)).applyInArrow(restart, _FOUND)
        found = folded.where("after IS NULL").unionByName(later)
    return found.select("queryId", "taxiId", "km", F.timestamp_micros("us").alias("eventTime"))
