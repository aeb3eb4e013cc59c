"""Streaming forms give the rows of their batch forms. Input comes in several files, the last of which
holds a far-future row that lets the watermark pass everything else."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

import pytest
from conftest import MOMA, PENN, T0, fare, ride, rows, t
from pyspark.sql import functions as F

from streamlab import schemas
from streamlab.operators import control, joins, rides, rules, segments, travel
from streamlab.streaming import operators as so
from streamlab.streaming.runs import run_available, run_taxi_query, start_with_late

FAR = datetime(2100, 1, 1, tzinfo=timezone.utc)
FLUSH = ride(-1, True, FAR, taxi=-1)


@pytest.fixture
def stream(spark, tmp_path_factory):
    """A file stream that reads the given batches one file at a time."""

    def build(ddl, *batches):
        path = tmp_path_factory.mktemp("in")
        for i, batch in enumerate(batches):
            df = spark.createDataFrame(list(batch), ddl).coalesce(1)
            df.write.mode("append").parquet(str(path))
        return spark.readStream.schema(ddl).option("maxFilesPerTrigger", 1).parquet(str(path))

    return build


RIDES = [
    [ride(1, True, t(0), PENN, MOMA, 1), ride(2, True, t(6), PENN, MOMA, 2), ride(3, True, t(14), PENN, MOMA, 3)],
    [ride(4, False, t(18), PENN, MOMA, 4, began=t(1)), ride(1, False, t(15), PENN, MOMA, 1, began=t(0)),
     ride(2, False, t(15), PENN, MOMA, 2, began=t(6)), ride(5, True, t(15), PENN, MOMA, 5)],
    [ride(3, False, t(150), PENN, MOMA, 3, began=t(14)), ride(4, True, t(17), PENN, MOMA, 4),
     ride(6, True, t(151), MOMA, PENN, 1)],
]
DELAY = "200 minutes"


def all_rides(make):
    return make.rides(*[r for batch in RIDES for r in batch])


def ride_stream(stream):
    return stream(schemas.RIDE, *RIDES, [FLUSH])


def test_popular_places(make, stream):
    timed = rides.with_event_time(ride_stream(stream), DELAY)
    got = run_available(rides.popular_places(timed, min_count=2))
    expected = rides.popular_places(all_rides(make), min_count=2)
    cols = ["windowEnd", "isStart", "cnt"]
    assert rows(got, *cols) == rows(expected, *cols) != []


def test_hourly_tip_max(make, stream):
    tips = [[fare(1, t(0), 1.0), fare(2, t(15), 5.0)], [fare(3, t(90), 10.0), fare(4, t(90), 20.0, 2)]]
    given = stream(schemas.FARE, *tips, [fare(9, FAR, 0.0, -1)]).withWatermark("startTime", "1 hour")
    got = run_available(rides.hourly_tip_max(given))
    assert rows(got, "driverId", "tips") == [(1, 6.0), (2, 20.0)]


def test_ride_count_updates(stream):
    got = run_available(rides.ride_count(ride_stream(stream)), output_mode="update")
    final = got.filter("driverId > 0").groupBy("driverId").agg(F.max("cnt").alias("cnt"))
    assert rows(final) == [(1, 3), (2, 2), (3, 2), (4, 2), (5, 1)]


def test_match_or_expire(make, stream):
    fares = [fare(1, t(0)), fare(3, t(14)), fare(8, t(3))]
    left = rides.with_event_time(ride_stream(stream), DELAY)
    right = stream(schemas.FARE, fares, [fare(-2, FAR)]).withWatermark("startTime", DELAY)
    got = run_available(joins.match_or_expire(left, right, "10 minutes")).filter("rideId > 0")
    expected = joins.match_or_expire(all_rides(make), make.fares(*fares))
    assert rows(got, "rideId", "status") == rows(expected, "rideId", "status")


def test_join_rides_fares(make, stream):
    fares = [fare(1, t(0)), fare(3, t(14)), fare(8, t(3))]
    left = rides.with_event_time(ride_stream(stream), DELAY)
    right = stream(schemas.FARE, fares, [fare(-2, FAR)]).withWatermark("startTime", DELAY)
    got = run_available(joins.join_rides_fares(left, right, "10 minutes"))
    assert rows(got, "rideId", "fare.rideId") == [(1, 1), (3, 3)]


def test_long_rides(make, stream):
    got = run_available(so.long_rides(ride_stream(stream), delay=DELAY))
    expected = joins.long_rides(all_rides(make))
    assert rows(got.drop("batch")) == rows(expected) != []


def test_event_time_sort(make, stream):
    df = ride_stream(stream)
    timed = rides.with_event_time(df)
    tie = (~F.col("isStart")).cast("int")
    got = run_available(so.event_time_sort(timed, "taxiId", "eventTime", tie, DELAY))
    expected = rides.running_count(
        rides.with_event_time(all_rides(make)), "taxiId",
        [F.col("eventTime"), ~F.col("isStart")], F.unix_micros("eventTime"), "seq",
    )
    cols = ["taxiId", "eventTime", "isStart", "seq"]
    assert rows(got, *cols) == rows(expected, *cols)


def test_rolling_count(make, stream):
    ends = rides.dest_cells(rides.end_rides(rides.with_event_time(stream(schemas.RIDE, *RIDES, [ride(9, False, FAR)]))))
    got = run_available(so.rolling_count(ends, "destCell", "eventTime", delay=DELAY))
    expected = rides.ending_rides_rolling_count(all_rides(make))
    assert rows(got.filter("rideId < 9"), "eventTime", "cnt") == rows(expected, "eventTime", "cnt")


def test_asof(make, stream, spark):
    ms = lambda n: T0 + timedelta(milliseconds=n)
    customers = [[(ms(0), 0, "i0"), (ms(1500), 0, "i1500")], [(ms(500), 0, "i500"), (ms(1600), 0, "i1600")]]
    trades = [[(ms(1000), 0, "a"), (ms(1200), 0, "b")], [(ms(1500), 0, "c"), (ms(1700), 0, "d")],
              [(FAR, -1, "flush")]]
    for emit in ("final", "provisional+final"):
        joined = so.asof_join(
            stream(schemas.TRADE, *trades), stream(schemas.CUSTOMER, *customers), "customerId", "ts",
            "customerInfo", joins.NO_CUSTOMER, emit, delay="1 hour",
        )
        got = run_available(joined).filter("customerId = 0")
        last = got.groupBy("tradeInfo").agg(F.max_by("customerInfo", F.struct("batch", "final")))
        assert rows(last) == [("a", "i500"), ("b", "i500"), ("c", "i1500"), ("d", "i1600")]
        if emit == "final":
            assert got.filter("NOT final").count() == 0
        else:
            assert got.filter("NOT final").count() == 4
            assert rows(got.filter("final"), "tradeInfo", "customerInfo")[0] == ("a", "i500")


def test_driving_segments_and_sessions(make, stream):
    given = [(0, 5.0, 10.0), (10, 0.0, 1.0), (5, 6.0, 14.0), (20, 7.9, 20.0), (15, 0.0, 1.0), (25, 0.0, 1.0),
             (25, 4.0, 1.0), (60, 9.0, 5.0)]
    car = lambda i, s, v, th, c="c": (str(i), c, T0 + timedelta(seconds=s), 0.0, 0.0, 0.0, v, th, 0.0)
    events = [car(i, *g) for i, g in enumerate(given)]
    flush = ("x", "flush", FAR, 0.0, 0.0, 0.0, 1.0, 1.0, 0.0)
    batch = make.frame(events, schemas.CAR_EVENT)
    for strict in (False, True):
        cars = stream(schemas.CAR_EVENT, events[:4], events[4:], [flush])
        got = run_available(so.driving_segments(cars, strict, "10 minutes"))
        cols = ["carId", "startTime", "length", "maxSpeed", F.round("erraticness", 9), "label"]
        assert rows(got, *cols) == rows(segments.driving_segments(batch, strict), *cols) != []
    cars = stream(schemas.CAR_EVENT, events[:4], events[4:], [flush]).withWatermark("ts", "10 minutes")
    got = run_available(segments.driving_sessions(cars))
    cols = ["carId", "startTime", "length", "maxSpeed", F.round("erraticness", 9)]
    assert rows(got, *cols) == rows(segments.driving_sessions(batch), *cols)


def test_travel_time(make, stream):
    near, far, dest = (-73.9800, 40.75), (-73.9700, 40.75), (-73.9900, 40.75)
    events = [
        ride(3, False, t(40), far, dest, began=t(20)), ride(1, False, t(10), near, dest, began=t(0)),
        ride(4, True, t(41), near, dest), ride(2, True, t(11), far, dest),
    ]
    got = run_available(so.travel_time_predictions(stream(schemas.RIDE, events, [FLUSH]), DELAY))
    assert rows(got.drop("batch")) == rows(travel.travel_time_predictions(make.rides(*events)))


def test_sequence_rules(make, stream):
    ddl = f"ts TIMESTAMP, {schemas.ITEM}"
    shapes = "RTTCCTRCTT"
    items = [(t(i), i, "GREEN" if i % 2 else "BLUE", s) for i, s in enumerate(shapes)]
    given = [("r1", "R", "T"), ("r2", "T", "T")]
    got = run_available(
        so.match_sequence_rules(
            stream(ddl, items[5:], items[:5], [(FAR, 99, "none", "X")]),
            stream(f"ts TIMESTAMP, {schemas.RULE}", [(t(-1), *g) for g in given]),
            "color", "ts", delay=DELAY, buckets=3,
        )
    )
    expected = rules.match_sequence_rules(
        make.frame([i[1:] for i in items], schemas.ITEM), make.frame(given, schemas.RULE), "color"
    )
    assert rows(got, "rule", "firstItem.seq", "secondItem.seq") == rows(
        expected, "rule", "firstSeq", "secondSeq"
    )


def test_ongoing(make, stream):
    asked = [(1, t(12), 5), (2, t(16), 1), (3, t(140), 100)]
    got = run_available(
        so.ongoing_rides(
            ride_stream(stream), stream(schemas.ONGOING_CONTROL, asked), delay=DELAY, buckets=3
        )
    )
    expected = control.ongoing_rides(all_rides(make), make.frame(asked, schemas.ONGOING_CONTROL))
    cols = ["controlId", "controlTime", "taxiId"]
    assert rows(got, *cols) == rows(expected, *cols) != []


def test_nearest_taxi(make, stream):
    events = [
        ride(i, False, t(m), PENN, (PENN[0], PENN[1] + d), taxi=i)
        for i, (m, d) in enumerate([(1, 0.05), (2, 0.07), (3, 0.03), (4, 0.03), (5, 0.01), (600, 0.09)], 1)
    ]
    asked = [(1, t(0), *PENN)]
    got = run_available(
        so.nearest_taxi(
            stream(schemas.RIDE, events[3:], events[:3], [ride(9, False, FAR, taxi=-1)]),
            stream(schemas.TAXI_QUERY, asked), delay="11 hours", buckets=3,
        )
    )
    # After 8 hours without a better one the best is forgotten, so the report at minute 600 counts.
    assert rows(got, "taxiId")[:4] == [(1,), (3,), (5,), (6,)]


def taxi_answers(spark, rides_in, controls_in, tmp_path, name, **options):
    out = str(tmp_path / name)
    run_taxi_query(rides_in, controls_in, out, f"{out}-checkpoint", once=True, **options).awaitTermination()
    return spark.read.option("basePath", out).parquet(out)


def test_taxi_query(spark, make, stream, tmp_path):
    """Questions that come two batches late, and rides out of order, give the rows of the batch form."""
    asked = [(1, t(3), "isStart"), (2, t(16), "NOT ride.isStart"), (3, t(16), "taxiId = 1"), (4, t(160), "true")]
    expected = control.taxi_query(all_rides(make), make.frame(asked, schemas.PREDICATE_CONTROL))
    cols = ["kind", "at", "controlId", F.coalesce("rideId", F.lit(0)), "text"]
    for name, batches in {"late": [[], [], asked[2:], asked[:2]], "early": [asked]}.items():
        got = taxi_answers(
            spark, ride_stream(stream), stream(schemas.PREDICATE_CONTROL, *batches), tmp_path, name, delay=DELAY, buckets=3
        )
        assert rows(got.filter("rideId IS NULL OR rideId > 0"), *cols) == rows(expected, *cols)
    assert {"PE", "PBE", "QUERY"} == {r["kind"] for r in expected.collect()}


def test_taxi_query_cases(spark, make, stream, tmp_path):
    """A START that is known when the question comes; an END near a place that comes later."""
    given = [ride(1, True, t(0), PENN, MOMA, 1), ride(1, False, t(5), PENN, MOMA, 1, began=t(0))]
    near = f"rideDistance(ride, CAST({MOMA[0]} AS FLOAT), CAST({MOMA[1]} AS FLOAT)) < 1.0"
    got = taxi_answers(
        spark, stream(schemas.RIDE, given, [FLUSH]), stream(schemas.PREDICATE_CONTROL, [(1, t(1), near)]), tmp_path, "near", delay="1 hour"
    )
    assert rows(got.filter("rideId = 1"), "kind", "at") == [("PE", t(5).replace(tzinfo=None))]


def test_restart_continues(spark, make, tmp_path):
    from streamlab.sources.sinks import batch_writer
    from streamlab.streaming.runs import start_query

    src, out, mark = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))

    def run(*batch):
        make.rides(*batch).coalesce(1).write.mode("append").parquet(src)
        df = so.long_rides(spark.readStream.schema(schemas.RIDE).parquet(src), delay="1 minute")
        start_query(df, batch_writer(out, "parquet"), mark, once=True).awaitTermination()
        return spark.read.schema(df.schema).parquet(f"{out}/*").count()

    assert run(ride(1, True, t(0))) == 0
    assert run(ride(2, True, t(121.5)), ride(2, False, t(122), began=t(121.5))) == 1
    assert run(FLUSH) == 1


def test_topic_and_control_sources(spark, make, tmp_path):
    from streamlab.sources import readers, sinks

    given = make.rides(*[r for batch in RIDES for r in batch])
    sinks.encode_rides(given).write.text(str(tmp_path / "topic"))
    values = readers.read_topic(spark, "text", path=str(tmp_path / "topic"))
    got = run_available(readers.decode_rides(values))
    assert rows(got, *given.columns) == rows(given)
    (tmp_path / "controls").mkdir()
    (tmp_path / "controls" / "a.txt").write_text("-73.9947, 40.750626\n0,0\n")
    at = F.lit(T0)
    asked = run_available(readers.read_controls(spark, str(tmp_path / "controls"), "nearest", at))
    assert [round(r.lon, 4) for r in asked.sort("lon").collect()] == [-73.9947, 0.0]
    minutes = spark.createDataFrame([("15",)], "value STRING")
    assert readers.parse_controls(minutes, "ongoing", at).first().minutes == 15
    assert readers.parse_controls(minutes, "predicate", at).first().predicate == "15"
    with pytest.raises(ValueError, match="unknown control kind"):
        readers.parse_controls(minutes, "other", at)


def test_place_documents_stream(make, stream, tmp_path):
    from streamlab.sources import sinks

    timed = rides.with_event_time(ride_stream(stream), DELAY)
    docs = run_available(sinks.to_place_documents(rides.popular_places(timed, min_count=3)))
    expected = sinks.to_place_documents(rides.popular_places(all_rides(make), min_count=3))
    assert rows(docs, "id", "document") == rows(expected)
    sinks.write_documents(expected, str(tmp_path))
    assert docs.sparkSession.read.text(str(tmp_path / sinks.PLACES_INDEX)).count() == expected.count()


def test_sql_on_streams(spark, make, stream):
    from streamlab.sources import readers

    readers.register_rides(spark, ride_stream(stream), "StreamRides", DELAY)
    got = run_available(spark.sql(rides.POPULAR_PLACES_SQL.format(rides="StreamRides", over=2)))
    readers.register_rides(spark, all_rides(make), "BatchRides")
    expected = spark.sql(rides.POPULAR_PLACES_SQL.format(rides="BatchRides", over=2))
    assert rows(got, "span.end", "starting", "events") == rows(expected, "span.end", "starting", "events") != []
    tips = [[fare(1, t(0), 30.0), fare(2, t(15), 25.0)], [fare(9, FAR, 0.0, -1)]]
    readers.register_fares(spark, stream(schemas.FARE, *tips), "StreamFares", "1 hour")
    got = run_available(spark.sql(rides.HOURLY_TIPS_HAVING_SQL.format(fares="StreamFares", over=50)))
    assert rows(got, "driverId", "earned") == [(1, 55.0)]


def test_backlog_costs_linear_time(spark, stream):
    """Rows of one key wait in blocks: a watermark that moves in small steps reads only what is due."""
    import time

    ddl = "id BIGINT, k STRING, ts TIMESTAMP"

    def seconds(n):
        given = [(i, "hot", T0 + timedelta(milliseconds=37 * (i * 7919 % n))) for i in range(n)]
        # After the backlog, every file moves time on by an eighth of it.
        steps = [[(n + s, "other", T0 + timedelta(hours=1, milliseconds=37 * n * s // 8))] for s in range(1, 9)]
        frame = stream(ddl, given, *steps, [(-1, "other", FAR)])
        begun = time.time()
        got = run_available(so.event_time_sort(frame, "k", "ts", delay="1 hour")).filter("k = 'hot'")
        checked = got.agg(F.count("*"), F.max("seq"), F.sum((F.unix_millis("ts") - int(T0.timestamp() * 1000)) / 37 - F.col("seq") + 1)).first()
        assert tuple(checked) == (n, n, 0.0)
        return time.time() - begun

    small, large = seconds(20_000), seconds(100_000)
    assert large < 5 * small + 20


def test_asof_answers_belong_to_rows(make, stream):
    """Equal rows do not share a provisional answer, and versions behind the watermark are gone."""
    ms = lambda n: T0 + timedelta(milliseconds=n)
    trades = [[(ms(1000), 0, "same"), (ms(1000), 0, "same")], [(ms(2000), 0, "late")], [(FAR, -1, "flush")]]
    customers = [[(ms(0), 0, "i0")], [(ms(900), 0, "i900"), (ms(1500), 0, "i1500")]]
    joined = so.asof_join(
        stream(schemas.TRADE, *trades), stream(schemas.CUSTOMER, *customers), "customerId", "ts", "customerInfo", None,
        "provisional+final", delay="1 hour",
    )
    got = run_available(joined).filter("customerId = 0")
    assert rows(got.filter("NOT final"), "tradeInfo", "customerInfo") == [("late", "i1500"), ("same", "i0"), ("same", "i0")]
    assert rows(got.filter("final"), "tradeInfo", "customerInfo") == [("same", "i900"), ("same", "i900")]


def test_null_throttle_does_not_end_the_stream(make, stream):
    car = lambda i, s, v, th: (str(i), "c", T0 + timedelta(seconds=s), 0.0, 0.0, 0.0, v, th, 0.0)
    events = [car(0, 0, 5.0, None), car(1, 5, 6.0, 1e6), car(2, 6, 6.0, 1e6 + 1), car(3, 7, None, 3.0), car(4, 10, 0.0, None),
              car(5, 15, 3.0, None), car(6, 20, 0.0, 1.0)]
    flush = ("x", "flush", FAR, 0.0, 0.0, 0.0, 1.0, 1.0, 0.0)
    got = run_available(so.driving_segments(stream(schemas.CAR_EVENT, events, [flush]), delay="10 minutes"))
    cols = ["carId", "startTime", "length", "maxSpeed", F.round("erraticness", 9), "label"]
    assert rows(got, *cols) == rows(segments.driving_segments(make.frame(events, schemas.CAR_EVENT)), *cols) != []


def test_patterns(spark, make, stream):
    """The streaming form against the batch form, with rows out of order and an END that comes late."""
    from streamlab.operators.patterns import Step, match_pattern

    whole = [Step("start", F.col("isStart")), Step("end", ~F.col("isStart"))]
    late = [ride(7, True, t(0), taxi=7)], [ride(7, False, t(180), taxi=7, began=t(0)), ride(8, True, t(5), taxi=8)]
    timed = rides.with_event_time(stream(schemas.RIDE, *RIDES, *late, [FLUSH]))
    got = run_available(so.match_pattern(timed, ["rideId"], "eventTime", whole, "120 minutes", delay=DELAY))
    given = rides.with_event_time(make.rides(*[r for batch in (*RIDES, *late) for r in batch]))
    expected = match_pattern(given, ["rideId"], "eventTime", whole, "120 minutes")
    cols = ["rideId", "outcome", F.coalesce("rowsBetween", F.lit(-9)), F.coalesce(F.unix_millis("matchedAt"), F.lit(-9))]
    assert rows(got.filter("rideId > 0"), *cols) == rows(expected, *cols)
    # An END within the limit, one after it, and none at all.
    assert {(1, "match"), (7, "timeout"), (8, "timeout")} <= set(rows(got, "rideId", "outcome"))
    ddl = "k STRING, ts TIMESTAMP, s STRING, i BIGINT"
    letters = [("k", t(i / 60), c, i) for i, c in enumerate("abbaabcbbba bccaabbbacab" * 3)]
    steps = [Step("a", F.col("s") == "a"), Step("c", F.col("s") == "c", strict=False), Step("b", F.col("s").isin("b", "a"), repeated=True),
             Step("e", F.col("s").isin("a", " "))]
    for within in (None, "6 seconds"):
        frame = stream(ddl, letters[30:50], letters[:30], letters[50:], [("flush", FAR, "x", -1)])
        got = run_available(so.match_pattern(frame, ["k"], "ts", steps, within, delay="1 hour"))
        expected = match_pattern(spark.createDataFrame(letters, ddl), ["k"], "ts", steps, within)
        cols = ["i", "outcome", F.coalesce("rowsBetween", F.lit(-9)), F.coalesce(F.unix_millis("matchedAt"), F.lit(-9))]
        assert rows(got, *cols) == rows(expected, *cols) != []


def test_change_log_replays(spark, make, stream):
    durations = F.unix_millis("endTime") - F.unix_millis("startTime")
    batches = [[ride(i, False, t(60 + 7 * i), taxi=i) for i in range(k, 20, 4)] for k in range(4)]
    log = run_available(so.average_changes(stream(schemas.RIDE, *batches, [ride(99, False, None)]), "passengerCnt", durations))
    assert rows(log, "version", "change") == sorted([(v, "insert") for v in (1, 2, 3, 4)] + [(v, "delete") for v in (1, 2, 3)])
    expected = rides.avg_duration_by_passengers(make.rides(*[r for b in batches for r in b]))
    assert rows(so.replay(log, ["passengerCnt"]), "passengerCnt", "average") == rows(expected)


def test_late_rows_come_out_on_their_own(spark, stream, tmp_path):
    """Rows at or behind the watermark, rows of a car never seen and rows without a time; nothing is lost."""
    cars = stream(
        "car STRING, ts TIMESTAMP, n INT",
        [("a", t(0), 1), ("a", t(30), 2), ("b", t(31), 3)],
        # The watermark is at 21 minutes: 20 and 21 are late, 22 is not, and a car may begin late.
        [("a", t(20), 4), ("a", t(21), 5), ("a", t(22), 6), ("c", t(5), 7), ("c", None, 8)],
        [("a", t(29), 9), ("b", t(50), 10)],
        [("b", FAR, 99)],
    )
    found = so.event_time_sort_with_late(cars, "car", "ts", F.col("n"), "10 minutes")
    out, late_out, checkpoint = (str(tmp_path / name) for name in ("out", "late", "checkpoint"))
    start_with_late(found, out, late_out, checkpoint, once=True).awaitTermination()
    late = spark.read.parquet(f"{late_out}/*")
    assert {(r["n"], r["behindMs"]) for r in late.collect()} == {(4, 60_000), (5, 0), (7, 960_000), (8, None)}
    on_time = spark.read.parquet(f"{out}/*")
    assert on_time.columns == ["car", "ts", "n", "seq"]
    assert {(r["n"], r["seq"]) for r in on_time.collect() if r["n"] != 99} == {(1, 1), (6, 2), (9, 3), (2, 4), (3, 1), (10, 2)}


def test_no_late_rows_is_the_plain_sort(make, stream):
    timed = rides.with_event_time(ride_stream(stream))
    tie = (~F.col("isStart")).cast("int")
    got = run_available(so.event_time_sort_with_late(timed, "taxiId", "eventTime", tie, DELAY))
    plain = run_available(so.event_time_sort(rides.with_event_time(ride_stream(stream)), "taxiId", "eventTime", tie, DELAY))
    cols = ["taxiId", "eventTime", "isStart", "seq"]
    assert rows(got.where("NOT late"), *cols) == rows(plain, *cols)
    assert got.where("late").isEmpty()
