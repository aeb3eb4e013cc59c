"""Null and bad input, long intervals, many hot keys."""

from __future__ import annotations

import pytest
from conftest import EPOCH, ride, rows, t
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from streamlab.functions import geo
from streamlab.functions import rides as rx
from streamlab.operators import joins, rides
from streamlab.plans.hotkeys import hot_keys, split_by_position
from streamlab.plans.intervals import interval_point_join
from streamlab.sources import etl, readers, sinks

YEAR = 31_556_952_000


@pytest.mark.parametrize("start, end", [(2020, 9999), (2200, 2600), (1500, 1900), (2020, 2300), (1900, None), (-200000, 200000)])
def test_intervals_of_any_length(make, start, end):
    ms = lambda y: None if y is None else (y - 1970) * YEAR
    spans = make.frame([(1, ms(start), ms(end))], "i int, s long, e long")
    points = make.frame([(y, ms(y)) for y in (1400, 1600, 1950, 2020, 2250, 2590, 9000)], "y int, at long")
    found = rows(interval_point_join(spans, points, F.col("s"), F.col("e"), F.col("at")), "y")
    assert found == [(y,) for y in (1400, 1600, 1950, 2020, 2250, 2590, 9000) if start <= y and (end is None or y < end)]


def test_short_fare_line_is_refused(make):
    good = "1,1001,VTS,2020-01-01 00:00:00,CRD,5,0,0.5,1.0,,2.0"
    lines = make.frame([(good,), ("1,1001,VTS",)], "value string")
    with pytest.raises(PySparkException, match="Invalid record"):
        etl.raw_fares_to_fares(lines).collect()


def test_corrupt_lines_are_kept(make):
    good = "1,START,2020-01-01 00:00:00,1970-01-01 00:00:00,-73.9,40.7,,40.8,1,2,3"
    bad = [good.replace("1,START", "x,START"), "1,START", good.replace("START", "MIDDLE"), good.replace("2020-01-01", "2020-99-01"), None]
    lines = make.frame([(good,), *[(b,) for b in bad]], "value string")
    assert rows(readers.parse_rides(lines, strict=False), "rideId") == [(1,)]
    kept = readers.parse_rides(lines, strict=False, corrupt="_corrupt").collect()
    assert len(kept) == 6 and {r._corrupt for r in kept if r.rideId is None} == set(bad)
    fares = make.frame([("1,2,3,2020-01-01 00:00:00,CRD,1,2,3",), ("1,2,3,yesterday,CRD,1,2,3",)], "value string")
    assert [r._corrupt for r in readers.parse_fares(fares, strict=False, corrupt="_corrupt").collect() if r._corrupt] == ["1,2,3,yesterday,CRD,1,2,3"]
    cars = make.frame([("a,b",)], "value string")
    assert rows(readers.parse_car_events(cars, strict=False, corrupt="_corrupt"), "_corrupt") == [("a,b",)]


def test_null_keys_are_split_and_do_not_match(make):
    data = make.frame([(None if i % 3 == 0 else i % 7, i) for i in range(300)], "k int, v long")
    assert (None, 4) in [tuple(r) for r in hot_keys(data, ["k"], 30).collect()]
    parts = rows(split_by_position(data, ["k"], F.col("v"), 30).filter("k IS NULL").groupBy("_part").count(), "count")
    assert len(parts) == 4 and sum(n for (n,) in parts) == 100
    counted = rides.running_count(data, "k", [F.col("v")], F.col("v"), part_rows=30)
    assert max(r.cnt for r in counted.filter("k IS NULL").collect()) == 100
    right = make.frame([(None, t(0), "X"), (1, t(0), "Y")], "k int, ts timestamp, v string")
    left = make.frame([(None, t(5)), (1, t(5))], "k int, ts timestamp")
    assert {r.k: r.v for r in joins.asof_join(left, right, "k", "ts", ["v"]).collect()} == {None: None, 1: "Y"}


def test_thousands_of_hot_keys(spark):
    data = spark.range(40_000).select((F.col("id") % 5000).alias("k"), F.col("id").alias("v"))
    assert hot_keys(data, ["k"], 4).count() == 5000
    counted = rides.running_count(data, "k", [F.col("v")], F.col("v"), part_rows=4)
    assert rows(counted.groupBy("cnt").count(), "cnt", "count") == [(n, 5000) for n in range(1, 9)]


def test_expiry_in_batch(make):
    from conftest import fare

    given = make.rides(ride(1, True, t(0)), ride(2, True, t(0)), ride(3, True, t(0)))
    fares = make.fares(fare(1, t(1)), fare(2, t(30)), fare(4, t(0)))
    found = rows(joins.match_or_expire(given, fares, "2 minutes"), "rideId", "status", "ride.rideId", "fare.rideId")
    assert found == [(1, "matched", 1, 1), (2, "left_only", 2, None), (2, "right_only", None, 2), (3, "left_only", 3, None), (4, "right_only", None, 4)]


def test_places_without_a_cell(make, spark):
    from streamlab.functions import register_functions

    register_functions(spark)
    odd = make.frame([(1e12, 40.7), (-73.9, float("nan")), (float("inf"), 40.7), (None, 40.7), (-73.9, 40.7)], "lon float, lat float")
    cells = [r.c for r in odd.select(geo.cell_id(F.col("lon"), F.col("lat")).alias("c")).collect()]
    assert cells[:4] == [None] * 4 and cells[4] is not None
    assert [r.c for r in odd.selectExpr("toCellId(lon, lat) AS c").collect()] == cells


def test_null_fields_keep_their_places(make):
    nulls = make.frame([(1, True, t(0), None, None, 40.7, None, None, None, 5, None)],
                       "rideId long, isStart boolean, startTime timestamp, endTime timestamp, startLon float, startLat float, endLon float, endLat float, passengerCnt short, taxiId long, driverId long")
    line = nulls.select(rx.ride_text().alias("v")).first().v
    assert line.split(",")[0] == "1" and line.split(",")[5] == "40.7" and line.split(",")[9] == "5" and len(line.split(",")) == 11
    mails = make.frame([("m", "t", None, "s", "b", "r")], "messageId string, time string, sender string, subject string, body string, replyTo string")
    assert rows(readers.split_mails(sinks.encode_mails(mails)), "sender", "subject") == [("", "s")]
    label = make.frame([(None,), (1.0,), (3.0,), (9.0,)], "e double").select(rx.erraticness_label(F.col("e")).alias("x"))
    assert [r.x for r in label.collect()] == [None, "calm", "busy", "crazy"]


@pytest.mark.parametrize("predicate", ["rand() < 2", "rideId", "1 IN (SELECT 1)", "uuid() <> ''"])
def test_predicates_are_checked(make, predicate):
    with pytest.raises(ValueError, match="predicate must"):
        rides.match_predicate(make.rides(ride(1, True, EPOCH)), predicate)


def test_document_batches_do_not_erase_each_other(make, tmp_path):
    docs = make.frame([("a",)], "document string")
    write = sinks.document_writer(str(tmp_path))
    for batch in (0, 1, 1):
        write(docs, batch)
    assert docs.sparkSession.read.text(f"{tmp_path}/{sinks.PLACES_INDEX}").count() == 2
