"""Golden cases: small inputs with known results."""

from __future__ import annotations

from datetime import timedelta

import pytest
from conftest import EPOCH, MOMA, PENN, POLE, T0, at_ms, fare, ride, rows, t
from pyspark.sql import functions as F

from streamlab import schemas
from streamlab.functions import geo
from streamlab.functions import rides as rx
from streamlab.operators import control, graph, joins, mail, rides, rules, segments, travel
from streamlab.sources import etl, readers, sinks


def naive(ts):
    return ts.replace(tzinfo=None)


def test_cleansing(make):
    given = make.rides(
        ride(1, True, t(0), PENN, PENN),
        ride(2, True, t(0), PENN, POLE),
        ride(3, True, t(0), POLE, PENN),
        ride(4, True, t(0), POLE, POLE),
    )
    assert rows(rides.cleanse_rides(given), "rideId") == [(1,)]


def places_input(make):
    return make.rides(
        *[ride(i, True, t(m), PENN, MOMA) for i, m in ((1, 0), (2, 6), (3, 14))],
        *[ride(i, False, t(15), PENN, MOMA) for i in (1, 2, 3)],
    )


def test_popular_places(make):
    found = rides.popular_places(places_input(make), min_count=2)
    got = {(r.windowEnd, r.isStart, r.cnt) for r in found.collect()}
    assert got == {
        (naive(t(10)), True, 2), (naive(t(15)), True, 3), (naive(t(20)), True, 2),
        (naive(t(20)), False, 3), (naive(t(25)), False, 3), (naive(t(30)), False, 3),
    }
    start = found.filter("isStart").first()
    assert (start.lon, start.lat) == pytest.approx(PENN, abs=1e-5)


def test_popular_places_sql_is_strict(spark, make):
    readers.register_rides(spark, places_input(make), "SomeRides")
    got = spark.sql(rides.POPULAR_PLACES_SQL.format(rides="SomeRides", over=2))
    assert {r.events for r in got.collect()} == {3}


TIPS = [fare(1, t(0), 1.0), fare(2, t(15), 5.0), fare(3, t(90), 10.0)]


def test_hourly_tips(make):
    one = rides.hourly_tip_max(make.fares(TIPS[0]))
    assert rows(one, "windowEnd", "driverId", "tips") == [(naive(t(60)), 1, 1.0)]
    sums = rides.hourly_tip_max(make.fares(*TIPS))
    assert rows(sums, "driverId", "tips") == [(1, 6.0), (1, 10.0)]
    best = rides.hourly_tip_max(make.fares(*TIPS, fare(4, t(90), 20.0, driver=2)))
    assert rows(best, "windowEnd", "driverId", "tips") == [
        (naive(t(60)), 1, 6.0), (naive(t(120)), 2, 20.0),
    ]


def test_hourly_tip_max_tie(make):
    tie = make.fares(fare(1, t(0), 5.0, driver=7), fare(2, t(1), 5.0, driver=3))
    assert rows(rides.hourly_tip_max(tie), "driverId") == [(3,)]


@pytest.mark.parametrize("order", [(1, 2), (2, 1)])
def test_rides_and_fares(make, order):
    given = make.rides(ride(1, True, t(0)), ride(2, True, t(1)), ride(1, False, t(5)))
    fares = make.fares(*[fare(i, t(i)) for i in order])
    pairs = joins.join_rides_fares(given, fares)
    assert rows(pairs, "ride.rideId", "fare.rideId") == [(1, 1), (2, 2)]


@pytest.mark.parametrize("order", [(1, 2), (2, 1)])
def test_match_or_expire(make, order):
    fares = make.fares(*[fare(i, EPOCH) for i in order])
    found = joins.match_or_expire(make.rides(ride(1, True, EPOCH)), fares)
    assert rows(found, "rideId", "status") == [(1, "matched"), (2, "right_only")]


def test_repeated_ride_does_not_multiply(make):
    given = make.rides(*[ride(1, True, t(m), taxi=m) for m in range(20)])
    fares = make.fares(*[fare(1, t(m), tip=float(m)) for m in range(20)])
    pairs = joins.join_rides_fares(given, fares)
    assert rows(pairs, "ride.taxiId", "fare.tip") == [(19, 19.0)]


LONG_CASES = {
    "short": ([(True, 0), (False, 1)], []),
    "out of order": ([(False, 1), (True, 0)], []),
    "end only": ([(False, 1)], []),
    "no end": ([(True, 0)], [(1, True)]),
    "late end": ([(True, 0), (False, 180)], [(1, True)]),
    "end at the limit": ([(True, 0), (False, 120)], []),
}


@pytest.mark.parametrize("case", LONG_CASES)
def test_long_rides(make, case):
    events, expected = LONG_CASES[case]
    given = make.rides(*[ride(1, start, t(m)) for start, m in events])
    assert rows(joins.long_rides(given), "rideId", "isStart") == expected
    city = rides.with_event_time(rides.cleanse_rides(given))
    same = joins.sequence_timeout(
        city, "rideId", "eventTime", F.col("isStart"), ~F.col("isStart"), "120 minutes"
    )
    assert rows(same, "rideId", "isStart") == expected


def test_long_rides_horizon(make):
    given = make.rides(ride(1, True, t(0)), ride(2, True, t(100)))
    done = joins.long_rides(given, horizon=F.lit(t(180)))
    assert rows(done, "rideId") == [(1,)]


def test_match_predicate(make):
    given = make.rides(ride(1, True, t(0), PENN, MOMA), ride(1, False, t(5), PENN, MOMA))
    assert rows(rides.match_predicate(given, "ride.isStart"), "isStart") == [(True,)]
    near = f"rideDistance(ride, CAST({MOMA[0]} AS FLOAT), CAST({MOMA[1]} AS FLOAT)) < 1.0"
    assert rows(rides.match_predicate(given, near), "isStart") == [(False,)]
    with pytest.raises(Exception, match="nosuchcolumn"):
        rides.match_predicate(given, "nosuchcolumn = 1")


@pytest.mark.parametrize("part_rows", [1_000_000, 2])
def test_asof(make, part_rows):
    customers = make.frame(
        [(at_ms(ms), 0, f"info {ms}") for ms in (0, 500, 1500, 1600, 2100)], schemas.CUSTOMER
    )
    trades = make.frame(
        [(at_ms(ms), 0, f"trade {ms}") for ms in (1000, 1200, 1500, 1700, 1800, 2000)]
        + [(at_ms(5), 9, "trade 5")],
        schemas.TRADE,
    )
    found = joins.enrich_trades(trades, customers, part_rows=part_rows)
    got = {r.trade.tradeInfo: r.customerInfo for r in found.collect()}
    assert got == {
        "trade 1000": "info 500", "trade 1200": "info 500", "trade 1500": "info 1500",
        "trade 1700": "info 1600", "trade 1800": "info 1600", "trade 2000": "info 1600",
        "trade 5": joins.NO_CUSTOMER,
    }


ITEMS = [
    ("RECTANGLE", "GREEN"), ("TRIANGLE", "BLUE"), ("TRIANGLE", "RED"), ("CIRCLE", "BLUE"),
    ("CIRCLE", "GREEN"), ("TRIANGLE", "BLUE"), ("RECTANGLE", "GREEN"), ("CIRCLE", "GREEN"),
    ("TRIANGLE", "GREEN"),
]


@pytest.mark.parametrize("part_rows", [1_000_000, 1])
def test_sequence_rules(make, part_rows):
    items = make.frame([(i, c, s) for i, (s, c) in enumerate(ITEMS)], schemas.ITEM)
    given = make.frame([("r", "RECTANGLE", "TRIANGLE")], schemas.RULE)
    found = rules.match_sequence_rules(items, given, "color", part_rows=part_rows)
    assert rows(found, "color", "firstSeq", "secondSeq") == [("GREEN", 0, 8), ("GREEN", 6, 8)]


CAR = [(0, 5.0, 10.0), (5, 6.0, 14.0), (10, 0.0, 1.0), (15, 0.0, 1.0), (20, 7.9, 20.0),
       (25, 0.0, 1.0), (30, 9.0, 5.0)]


def cars(make, given=CAR):
    return make.frame(
        [
            (str(i), "c", T0 + timedelta(seconds=s), 0.0, 0.0, 0.0, speed, throttle, 0.0)
            for i, (s, speed, throttle) in enumerate(given)
        ],
        schemas.CAR_EVENT,
    )


@pytest.mark.parametrize("part_rows", [1_000_000, 2])
def test_driving_segments(make, part_rows):
    found = segments.driving_segments(cars(make), part_rows=part_rows)
    start = lambda s: naive(T0 + timedelta(seconds=s))
    first, second = (start(0), 2, 6, 2.0, "calm"), (start(20), 1, 7, 0.0, "calm")
    cols = ["startTime", "length", "maxSpeed", "erraticness", "label"]
    assert rows(found, *cols) == [first, second]
    pattern = segments.driving_segments(cars(make), True, part_rows)
    assert rows(pattern, *cols) == [second]
    text = found.orderBy("startTime").select(rx.segment_text()).first()[0]
    assert text == "946684800000,2 events,6 kph,calm"


def test_row_tied_with_stop_is_in_no_segment(make):
    given = [(0, 5.0, 1.0), (5, 9.0, 1.0), (5, 0.0, 1.0), (9, 0.0, 1.0)]
    found = segments.driving_segments(cars(make, given))
    assert rows(found, "length", "maxSpeed") == [(1, 5)]


@pytest.mark.parametrize("part_rows", [1_000_000, 1])
def test_sessions(make, part_rows):
    assert rows(segments.driving_sessions(cars(make), part_rows=part_rows), "length") == [(7,)]
    edge = cars(make, [(0, 1.0, 1.0), (15, 1.0, 1.0), (31, 1.0, 1.0)])
    found = segments.driving_sessions(edge, part_rows=part_rows)
    assert rows(found, "length") == [(1,), (2,)]


def test_travel_time(make):
    # Four rides of one destination and direction; distances 1x, 2x and durations 10, 20 minutes.
    near, far, dest = (-73.9800, 40.75), (-73.9700, 40.75), (-73.9900, 40.75)
    given = make.rides(
        ride(1, False, t(10), near, dest, began=t(0)),
        ride(2, True, t(11), far, dest),
        ride(3, False, t(40), far, dest, began=t(20)),
        ride(4, True, t(41), near, dest),
    )
    found = travel.travel_time_predictions(given)
    assert rows(found, "rideId", "prediction")[0] == (2, -1)
    assert rows(found, "rideId", "prediction")[1][1] in (9, 10)
    split = travel.travel_time_predictions(given, part_rows=1)
    assert rows(split) == rows(found)


def test_nearest_taxi(make):
    spots = [0.05, 0.07, 0.03, 0.03, 0.01]
    given = make.rides(
        *[
            ride(i, False, t(i), PENN, (PENN[0], PENN[1] + d), taxi=i)
            for i, d in enumerate(spots, start=1)
        ]
    )
    asked = make.frame([(1, t(0), *PENN)], schemas.TAXI_QUERY)
    reports = control.taxi_reports(given, asked)
    assert rows(control.nearest_taxi_improvements(reports), "taxiId") == [(1,), (3,), (5,)]
    assert rows(control.nearest_taxi(reports), "queryId", "taxiId") == [(1, 5)]
    split = control.taxi_reports(given, asked, bucket_ms=60_000)
    assert rows(control.nearest_taxi_improvements(split), "taxiId") == [(1,), (3,), (5,)]


def test_nearest_taxi_query_expiry(make):
    given = make.rides(*[ride(i, False, t(m), PENN, PENN) for i, m in ((1, 10), (2, 30), (3, 50))])
    asked = make.frame(
        [(1, t(0), *PENN), (2, t(20), 0.0, 0.0), (3, t(40), *PENN)], schemas.TAXI_QUERY
    )
    reports = control.taxi_reports(given, asked, query_ttl="15 minutes")
    assert rows(reports, "queryId", "rideId") == [(1, 1), (3, 3)]
    for part_rows in (1, 2):
        again = control.taxi_reports(given, asked, "15 minutes", part_rows=part_rows)
        assert rows(again) == rows(reports)


def test_ongoing(make):
    given = make.rides(
        ride(1, True, t(0), taxi=1), ride(2, True, t(0), taxi=2), ride(2, False, t(5), taxi=2)
    )
    asked = make.frame([(1, t(12), 10), (2, t(12), 13)], schemas.ONGOING_CONTROL)
    assert rows(control.ongoing_rides(given, asked), "controlId", "taxiId") == [(1, 1)]
    assert rows(control.ongoing_rides(given, asked, part_rows=1), "controlId") == [(1,)]


def test_taxi_query(make):
    given = make.rides(
        ride(1, True, t(0), taxi=1), ride(2, True, t(1), taxi=2), ride(2, False, t(5), taxi=2),
        ride(3, True, t(20), taxi=1),
    )
    asked = make.frame(
        [(1, t(3), "isStart"), (2, t(10), "NOT ride.isStart")], schemas.PREDICATE_CONTROL
    )
    found = control.taxi_query(given, asked)
    assert rows(found.fillna(0), "kind", "controlId", "rideId") == [
        ("PBE", 1, 1), ("PBE", 1, 2), ("PBE", 2, 2), ("QUERY", 1, 0), ("QUERY", 2, 0),
    ]


def test_tf_idf(make):
    docs = make.frame([("d1", "the cat sat cat"), ("d2", "Cat dog, dog")], "id STRING, text STRING")
    expected = [("d1", "cat", 2.0), ("d1", "sat", 2.0), ("d2", "cat", 1.0), ("d2", "dog", 2.0)]
    assert rows(mail.tf_idf(docs, "id", "text")) == expected
    assert rows(mail.tf_idf(docs, "id", "text", part_rows=1)) == expected


def mails(make, given):
    """Rows of (id, time, sender, replyTo)."""
    return make.frame([(i, w, s, "", "", r) for i, w, s, r in given], schemas.MAIL)


def test_mail_count(make):
    given = mails(
        make,
        [
            ("1", "2015-01-02-10:00:00", "A <a@x>", "null"),
            ("2", "2015-01-03-10:00:00", "A <a@x>", "null"),
            ("3", "2015-02-03-10:00:00", "a@x", "null"),
        ],
    )
    assert rows(mail.mail_count(given)) == [("2015-01", "a@x", 2), ("2015-02", "a@", 1)]


def test_reply_graph(make):
    given = mails(
        make,
        [
            ("m1", "", "A <a>", "null"), ("m2", "", "B <b>", "m1"), ("m3", "", "A <a>", "m2"),
            ("m4", "", "G <git@git.apache.org>", "m1"),
        ],
    )
    assert rows(mail.reply_graph(given)) == [("a", "b", 1), ("b", "a", 1)]


def test_member_of_month_keeps_ties(make):
    given = mails(
        make,
        [(f"{n}{i}", "2015-01-01", f"X <{n}>", "null") for n in "ab" for i in range(2)]
        + [(f"j{i}", "2015-01-01", "J <jira@apache.org>", "null") for i in range(9)],
    )
    assert rows(mail.member_of_month(given)) == [("2015-01", "a", 2), ("2015-01", "b", 2)]


def test_pagerank(make):
    ring = make.frame([("a", "b", 3.0), ("b", "c", 1.0), ("c", "a", 9.0)], schemas.EDGE)
    even = graph.pagerank(ring, iterations=3, init=1 / 3)
    assert [r.rank for r in even.collect()] == pytest.approx([1 / 3] * 3)
    far = graph.pagerank(ring, iterations=4, init=1.0, checkpoint_every=2)
    assert far.first().rank == pytest.approx(1 / 3 + 0.85**4 * 2 / 3)


def test_pagerank_hot_source(make):
    star = make.frame(
        [("hub", f"v{i}", 1.0) for i in range(30)] + [(f"v{i}", "hub", 2.0) for i in range(30)],
        schemas.EDGE,
    )
    plain = graph.pagerank(star, iterations=3)
    split = graph.pagerank(star, iterations=3, part_rows=4)
    assert rows(split.select("id", F.round("rank", 9))) == rows(plain.select("id", F.round("rank", 9)))


def test_mbox(make, spark, tmp_path):
    text = (
        "From dev-return-1 Thu Apr  3 10:11:12 2014\nMessage-ID: <1>\nFrom: A <a@x>\n"
        "Subject: one\n\nline one=\n cont\nbye\n\n"
        "From dev-return-2 Fri Apr  4 10:11:12 2014\nmessage-id: <2>\nfrom: B <b@x>\n"
        "SUBJECT: two\nIn-Reply-To: <1>\n\nhello\n"
        "From dev-return-3 Fri Apr  4 10:11:12 2014\nMessage-ID: <3>\nFrom: no subject\n\nx\n"
        "From dev-return-4 Fri Apr  4 10:11:12 2014\nMessage-ID: <4>\nFrom: B\nSubject: a#|#b\n\nx\n"
        "From dev-return-5 Wed Apr  2 10:11:12 2014\nMessage-ID: <2>\nFrom: B <b@x>\n"
        "Subject: earlier\n\nhello\n"
    )
    (tmp_path / "archive").write_text(text)
    found = mail.mbox_to_mails(readers.read_mbox(spark, str(tmp_path / "archive")))
    expected = [
        ("<1>", "2014-04-03-10:11:12", "A <a@x>", "one", "\nline one cont\nbye\n", "null"),
        ("<2>", "2014-04-02-10:11:12", "B <b@x>", "earlier", "\nhello\n", "null"),
    ]
    assert rows(found) == expected
    sinks.write_mails(found, str(tmp_path / "mails"))
    assert rows(readers.read_mails(spark, str(tmp_path / "mails"))) == expected
    picked = readers.read_mails(spark, str(tmp_path / "mails"), ["time", "sender"])
    assert picked.columns == ["time", "sender"] and picked.count() == 2


def test_grid(make):
    points = make.frame([PENN, MOMA], "lon FLOAT, lat FLOAT")
    cells = rows(points.select(geo.cell_id(F.col("lon"), F.col("lat")).alias("c")), "c")
    assert cells == [(47551,), (49789,)]
    center = points.sparkSession.sql("SELECT toCoords(49789) AS p").first().p
    penn = points.filter("lon < -73.98").first()
    assert (center.lon, center.lat) == (penn.lon, penn.lat)


def test_sql_functions_equal_columns(spark, make):
    given = make.rides(
        *[
            ride(i, i % 2 == 0, t(i), (-73.7 - i * 0.013, 40.5 + i * 0.017), (-74.0 + i * 0.01, 41.0 - i * 0.02))
            for i in range(30)
        ]
    )
    c = F.col
    args = [c("startLon"), c("startLat"), c("endLon"), c("endLat")]
    names = "startLon, startLat, endLon, endLat"
    both = given.select(
        F.array(F.expr("isInNYC(startLon, startLat)"), geo.is_in_nyc(*args[:2])).alias("a"),
        F.array(F.expr("toCellId(startLon, startLat)"), geo.cell_id(*args[:2])).alias("b"),
        F.array(F.expr(f"geoDistance({names})"), geo.distance(*args)).alias("c"),
        F.array(F.expr(f"directionAngle({names})"), geo.direction_angle(*args)).alias("d"),
    )
    for row in both.collect():
        for pair in row:
            assert pair[0] == pytest.approx(pair[1])


def brute_path(x1, y1, x2, y2):
    """Cells met by dense sampling of the centre line, away from corners."""
    if x1 > x2:
        x1, y1, x2, y2 = x2, y2, x1, y1
    cells = []
    for i in range(20001):
        f = i / 20000
        x, y = x1 + f * (x2 - x1), y1 + f * (y2 - y1)
        near = abs(x - round(x)) > 0.46 and abs(y - round(y)) > 0.4
        cell = (round(x), round(y))
        if not near and cell not in cells:
            cells.append(cell)
    return cells


@pytest.mark.parametrize(
    "a, b", [((10, 10), (17, 13)), ((10, 13), (17, 10)), ((10, 10), (12, 19)), ((17, 3), (10, 5)),
             ((5, 5), (5, 9)), ((5, 9), (5, 5)), ((3, 4), (9, 4)), ((3, 3), (3, 3))],
)
def test_grid_path(spark, a, b):
    def point(p):
        return -(74.05 - p[0] * 0.0014 - 0.0007), 41.0 - p[1] * 0.00125 - 0.000625

    df = spark.createDataFrame([(*point(a), *point(b))], "a FLOAT, b FLOAT, c FLOAT, d FLOAT")
    got = df.select(geo.grid_cells_on_way(*[F.col(c) for c in "abcd"]).alias("w")).first().w
    cells = [(c % 250, c // 250) for c in got]
    for (x, y), (u, v) in zip(cells, cells[1:]):
        assert max(abs(u - x), abs(v - y)) == 1
    assert set(brute_path(*a, *b)) <= set(cells)
    assert {cells[0], cells[-1]} == {a, b}


def test_rides_files_round_trip(spark, make, tmp_path):
    given = make.rides(ride(1, True, t(0), PENN, MOMA), ride(1, False, t(9), PENN, MOMA, began=t(0)))
    sinks.encode_rides(given).write.option("compression", "gzip").text(str(tmp_path / "rides"))
    back = readers.read_rides(spark, str(tmp_path / "rides"))
    assert rows(back) == rows(given)
    sinks.encode_fares(make.fares(*TIPS)).write.text(str(tmp_path / "fares"))
    assert rows(readers.read_fares(spark, str(tmp_path / "fares"))) == rows(make.fares(*TIPS))


def test_bad_lines(spark):
    bad = spark.createDataFrame(
        [("1,START,2000-01-01 00:00:00",), ("1,START,2000-01-01 00:00:00,1970-01-01 00:00:00,,,,,1,2,3",)],
        "value STRING",
    )
    assert rows(readers.parse_rides(bad, strict=False), "rideId", "startLon") == [(1, 0.0)]
    with pytest.raises(Exception, match="Invalid record"):
        readers.parse_rides(bad).collect()


def test_car_lines(spark):
    tokens = ["-"] * 23
    for place, text in {0: "car", 1: "id", 7: "1.5", 9: "", 12: "3", 19: "4", 20: "5", 21: "6",
                        22: "2017-01-01T00:00:01Z"}.items():
        tokens[place] = text
    line = "; ".join(tokens[:10]) + "," + ",".join(tokens[10:])
    df = readers.parse_car_events(spark.createDataFrame([(line,)], "value STRING"))
    row = df.first()
    assert (row.id, row.carId, row.speed, row.throttle, row.consumption) == ("id", "car", 0.0, 3.0, 1.5)


def test_trip_files(spark):
    def line(n, up, down):
        return f"m{n},l{n},VTS,1,N,{up},{down},2,60,1.5,-73.98,40.75,-73.97,40.76\r".replace("m", "").replace("l", "")

    trips = spark.createDataFrame(
        [(line(7, "2013-01-01 00:05:00", "2013-01-01 00:09:00"),),
         (line(8, "2013-01-01 00:01:00", "2013-01-01 00:20:00"),)],
        "value STRING",
    )
    events = etl.trips_to_ride_events(trips).collect()
    assert [(r.rideId, r.isStart, r.taxiId) for r in events] == [
        (1, True, 8), (2, True, 7), (2, False, 7), (1, False, 8),
    ]
    assert events[0].endTime == naive(EPOCH) and events[3].startTime.minute == 1


def test_documents_and_points(make):
    docs = sinks.to_place_documents(rides.popular_places(places_input(make), min_count=3))
    texts = [r.document for r in docs.collect()]
    assert '"location":"40.750626,-73.9947","isStart":"true","cnt":"3"}' in " ".join(texts)
    points = make.frame([("a b", t(0), 1.5)], "k STRING, ts TIMESTAMP, v DOUBLE")
    got = sinks.to_line_protocol(points, "m", F.col("ts"), F.col("v"), key=F.col("k")).first().value
    assert got == "m,key=a\\ b value=1.5 946684800000"
    text = points.select(rx.point_text(F.col("ts"), F.col("v"), F.col("k"))).first()[0]
    assert text == "946684800000,a b,1.5"


def test_edges_files(spark, make, tmp_path):
    (tmp_path / "edges.tsv").write_text("a\tb\t2.0\nb\ta\t1.0\n")
    edges = readers.read_edges(spark, str(tmp_path / "edges.tsv"))
    assert rows(graph.transition_weights(edges)) == [("a", "b", 1.0), ("b", "a", 1.0)]
    sinks.write_ranks(graph.pagerank(edges, iterations=1, init=0.5), str(tmp_path / "ranks"))
    assert spark.read.csv(str(tmp_path / "ranks"), sep="\t").count() == 2


# --- nearest taxi without pairs ------------------------------------------------------------------


def plain_improvements(ends, asked, query_ttl, report_ttl):
    """ends: (ms, ride, taxi, km per query); asked: (query, ms); in a loop over everything."""
    out = []
    for query, begin in asked:
        until = min((m for _, m in asked if query_ttl is not None and m > begin + query_ttl), default=None)
        best = None
        for ms, _, taxi, km in sorted(ends):
            if ms < begin or (until is not None and ms >= until):
                continue
            if best is None or km[query] < best[0] or (report_ttl is not None and ms > best[1] + report_ttl):
                best = (km[query], ms)
                out.append((query, taxi, km[query], ms))
    return sorted(out)


@pytest.mark.parametrize("grid", [0, 1_000])
def test_nearest_taxi_is_a_loop_over_all(spark, make, monkeypatch, grid):
    """Against a loop, with ties, hot slices, both expiries, and through the grid and without it."""
    import random

    from streamlab.operators import nearest

    monkeypatch.setattr(nearest, "LEAST_FOR_GRID", grid)
    monkeypatch.setattr(nearest, "BLOCK", 3)
    rng = random.Random(17)
    places = [(PENN[0] + rng.randrange(9) / 50, PENN[1] + rng.randrange(9) / 50) for _ in range(30)]
    given = [
        ride(i, False, at_ms(rng.randrange(40 * 3_600) * 1000), PENN, rng.choice(places), taxi=i % 50) for i in range(400)
    ]
    odd = [
        ride(900, False, at_ms(5_000_000), PENN, (float("nan"), 40.7), taxi=1), ride(901, True, at_ms(5_000_000), PENN, MOMA),
        (902, False, None, None, None, None, None, 40.7, 1, 1, 1), (903, False, at_ms(0), at_ms(6_000_000), *PENN, -73.9, 40.7, 1, None, 1),
    ]
    rides_in = make.rides(*given, *odd)
    asked = [(q, at_ms(q * 9 * 3_600_000), *places[q]) for q in range(5)]
    queries = make.frame([*asked, (99, at_ms(3_000), 0.0, 0.0)], schemas.TAXI_QUERY)
    ticks = [(q, q * 9 * 3_600_000) for q in range(5)]
    km = {
        r["rideId"]: r
        for r in nearest.located_ends(rides_in).select(
            "rideId", "taxiId", F.unix_millis("eventTime").alias("ms"),
            *[geo.distance(F.lit(a).cast("float"), F.lit(b).cast("float"), F.col("lon"), F.col("lat")).cast("float").alias(f"q{q}") for q, _, a, b in asked],
        ).collect()
    }
    assert 900 not in km and 903 in km
    ends = [(r["ms"], i, r["taxiId"], {q: r[f"q{q}"] for q in range(5)}) for i, r in km.items() if r["ms"] is not None]
    hour = 3_600_000
    for query_ttl, report_ttl in ((None, None), ("10 hours", None), (None, "3 hours"), ("10 hours", "2 hours")):
        got = nearest.nearest_taxi_improvements(rides_in, queries, query_ttl, report_ttl, part_rows=40)
        found = sorted(
            (r["queryId"], r["taxiId"], r["km"], r["ms"]) for r in got.select("*", F.unix_millis("eventTime").alias("ms")).collect()
        )
        ttls = [None if x is None else int(x.split()[0]) * hour for x in (query_ttl, report_ttl)]
        assert found == plain_improvements(ends, ticks, *ttls)
    best = {r["queryId"]: (r["taxiId"], r["km"]) for r in nearest.nearest_taxi(rides_in, queries, part_rows=40).collect()}
    last = {q: (taxi, k) for q, taxi, k, ms in sorted(plain_improvements(ends, ticks, None, None), key=lambda r: (r[0], r[3]))}
    assert best == last
    assert nearest.nearest_taxi_improvements(rides_in.limit(0), queries, "1 hour", "1 hour").collect() == []
    assert nearest.nearest_taxi(rides_in, queries.limit(0)).collect() == []


def test_many_predicates_plan_as_one(spark, make):
    import time

    from streamlab.operators import predicates

    texts = [f"rideId % {i + 2} = 0" for i in range(1_000)]
    given = make.rides(*[ride(i, True, t(i), taxi=i) for i in range(1, 41)])
    scope = predicates.predicate_scope(given, F.lit(0)).withColumn("predicate", F.concat(F.lit("rideId % "), F.col("rideId") % 7 + 2, F.lit(" = 0")))
    begun = time.time()
    predicates.check_predicates(scope, texts)
    got = scope.filter(predicates.one_of(texts, F.col("predicate"))).select("rideId").collect()
    assert time.time() - begun < 60
    assert sorted(r[0] for r in got) == [i for i in range(1, 41) if i % (i % 7 + 2) == 0]
    for refused in ("rand() < 0.5", "current_timestamp() > startTime", "rideId IN (SELECT 1)", "max(rideId) > 1", "rideId", "reflect('java.lang.Math', 'random') IS NULL"):
        with pytest.raises(ValueError, match="predicate must|not a condition"):
            predicates.check_predicates(scope, [*texts[:3], refused])
    predicates.check_predicates(scope, ["extract(hour from startTime) = 3", "ride.startTime BETWEEN '2000-01-01' AND '2001-01-01'"])
    with pytest.raises(ValueError, match="different predicates"):
        predicates.distinct_predicates(spark.range(5).selectExpr("string(id) predicate"), most=4)


# --- sequence patterns ---------------------------------------------------------------------------


def plain_attempts(rows_in, steps, within):
    """rows_in: (us, letters) in order; steps: (letter, strict, repeated). Every attempt followed on its own."""
    out, last = [], len(steps) - 1
    for i, (begin, letters) in enumerate(rows_in):
        if steps[0][0] not in letters:
            continue
        if last == 0:
            out.append((i, "match", begin, -1))
            continue
        at, end = {0}, None
        for j in range(i + 1, len(rows_in)):
            us, fits = rows_in[j]
            if within is not None and us > begin + within:
                break
            after = set()
            for k in at:
                letter, strict, _ = steps[k + 1]
                if steps[k][2] and steps[k][0] in fits:
                    after.add(k)
                if letter in fits:
                    after.add(k + 1)
                elif not strict:
                    after.add(k)
            at = after
            if last in at or not at:
                end = j
                break
        if end is not None and last in at:
            out.append((i, "match", rows_in[end][0], end - i - 1))
        elif end is None and within is not None:
            out.append((i, "timeout", None, None))
    return out


PATTERNS = {
    "one": [("a", True, False)],
    "next": [("a", True, False), ("b", True, False)],
    "run": [("a", True, False), ("b", True, True), ("a", True, False)],
    "later": [("a", True, False), ("c", False, False), ("b", False, True), ("a", True, False)],
    "runs": [("b", True, True), ("a", True, True), ("c", True, False)],
}


@pytest.mark.parametrize("part_rows", [7, 1_000_000])
def test_patterns_are_attempts_one_by_one(spark, monkeypatch, part_rows):
    import random

    from streamlab.operators import patterns

    monkeypatch.setattr(patterns, "CHUNK", 5)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "13")
    rng = random.Random(part_rows)
    keys = {"hot": 120, None: 40, "x": 9, "y": 1}
    data = {k: [(rng.randrange(30 * n), "".join(c for c in "abc" if rng.random() < 0.5)) for _ in range(n)] for k, n in keys.items()}
    listed, number = [], 0
    for k, events in data.items():
        for i, (at, letters) in enumerate(sorted(events)):
            listed.append((k, at_ms(at), i, letters, number))
            events[i] = (at, letters)
            number += 1
        data[k] = sorted(events)
    frame = spark.createDataFrame([*listed, ("x", None, 0, "a", -1)], "k STRING, at TIMESTAMP, i INT, s STRING, id INT").repartition(3)
    try:
        for name, steps in PATTERNS.items():
            given = [patterns.Step(c, F.col("s").contains(c), strict, more) for c, strict, more in steps]
            for within in (None, "2 seconds"):
                got = patterns.match_pattern(frame, ["k"], "at", given, within, [F.col("i")], part_rows)
                found = sorted((r["k"] or "", r["i"], r["outcome"], r["end"], r["rowsBetween"]) for r in got.withColumn("end", F.unix_millis("matchedAt")).collect())
                expected = sorted(
                    (k or "", *x) for k, events in data.items() for x in plain_attempts(events, steps, None if within is None else 2_000)
                )
                assert found == expected, (name, within)
        assert patterns.match_pattern(frame.limit(0), ["k"], "at", given, "2 seconds").collect() == []
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    with pytest.raises(ValueError, match="steps"):
        patterns.compile_steps([])
