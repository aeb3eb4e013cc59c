"""Results must not depend on how hot keys are split: every operator against its unsplit form or a
brute-force replay, on data where one key holds most rows."""

from __future__ import annotations

import random
from datetime import timedelta

import pytest
from conftest import MOMA, PENN, T0, ride, rows
from pyspark.sql import functions as F

from streamlab import schemas
from streamlab.functions import rides as rx
from streamlab.operators import control, graph, joins, rides, rules, segments, travel
from streamlab.plans.hotkeys import hot_keys, hot_keys_by_sketch, salted_join
from streamlab.plans.intervals import interval_point_join
from streamlab.plans.lineage import cut_lineage
from streamlab.plans.numbering import number_rows

SPLIT = 7


@pytest.fixture(scope="module")
def skewed(make):
    rng = random.Random(5)
    spots = [PENN, MOMA, (-73.95, 40.7), (-73.99, 40.72)]
    given = []
    for i in range(300):
        taxi = 1 if rng.random() < 0.7 else rng.randrange(2, 8)
        at = T0 + timedelta(seconds=rng.randrange(0, 40_000))
        began = at - timedelta(minutes=rng.randrange(1, 60))
        given.append(
            ride(rng.randrange(60), rng.random() < 0.5, at, rng.choice(spots), MOMA, taxi, began=began)
        )
    return make.rides(*given).cache()


def test_hot_list(skewed):
    found = hot_keys(skewed, ["taxiId"], 50)
    assert [r.taxiId for r in found.collect()] == [1]


def test_running_count(skewed):
    timed = rides.with_event_time(skewed)
    order = [*rx.ride_order(), F.col("taxiId")]
    position = F.unix_micros("eventTime")
    whole = rides.running_count(timed, "driverId", order, position)
    split = rides.running_count(timed, "driverId", order, position, part_rows=SPLIT)
    cols = ["driverId", "eventTime", "cnt"]
    assert rows(split, *cols) == rows(whole, *cols)


def test_rolling_count_slices(skewed):
    wide = rides.ending_rides_rolling_count(skewed, slice_ms=10**10)
    narrow = rides.ending_rides_rolling_count(skewed, slice_ms=600_000)
    assert rows(narrow) == rows(wide)
    with pytest.raises(ValueError, match="slice_ms"):
        rides.ending_rides_rolling_count(skewed, slice_ms=1000)


def test_long_rides(skewed):
    assert rows(joins.long_rides(skewed, "10 minutes", part_rows=2)) == rows(
        joins.long_rides(skewed, "10 minutes")
    )


def test_travel_time(skewed):
    assert rows(travel.travel_time_predictions(skewed, part_rows=SPLIT)) == rows(
        travel.travel_time_predictions(skewed)
    )


def test_ongoing_and_queries(skewed, make):
    asked = make.frame(
        [(i, T0 + timedelta(minutes=20 * i), i % 5) for i in range(30)], schemas.ONGOING_CONTROL
    )
    split = control.ongoing_rides(skewed, asked, part_rows=SPLIT)
    cols = ["controlId", "taxiId", "eventTime"]
    assert rows(split, *cols) == rows(control.ongoing_rides(skewed, asked), *cols)
    texts = asked.select("controlId", "ts", F.lit("NOT isStart").alias("predicate"))
    a, b = (control.taxi_query(skewed, texts, part_rows=p).fillna(0) for p in (SPLIT, 10**6))
    assert rows(a, "kind", "at", "controlId", "rideId") == rows(b, "kind", "at", "controlId", "rideId")


def test_asof_brute_force(make):
    rng = random.Random(3)
    key = lambda: 0 if rng.random() < 0.7 else rng.randrange(1, 5)
    versions = [(T0 + timedelta(seconds=rng.randrange(500)), key(), f"{i:04d}") for i in range(120)]
    trades = [(T0 + timedelta(seconds=rng.randrange(500)), key(), f"t{i}") for i in range(120)]
    expected = sorted(
        (
            info,
            max(
                ((ts, v) for ts, k, v in versions if k == customer and ts <= at),
                default=(None, joins.NO_CUSTOMER),
            )[1],
        )
        for at, customer, info in trades
    )
    for part_rows in (5, 10**6):
        found = joins.enrich_trades(
            make.frame(trades, schemas.TRADE), make.frame(versions, schemas.CUSTOMER), part_rows
        )
        assert rows(found, "trade.tradeInfo", "customerInfo") == expected


def test_rules_brute_force(make):
    rng = random.Random(4)
    items = [
        (i, "hot" if rng.random() < 0.7 else rng.choice("xyz"), rng.choice("ABC")) for i in range(200)
    ]
    given = [("r1", "A", "B"), ("r2", "C", "C"), ("r3", "B", "A")]
    expected, pending = [], {}
    for seq, color, shape in items:
        for name, first, second in given:
            waiting = pending.setdefault((color, name), [])
            if shape == second and waiting:
                expected += [(name, color, f, seq) for f in waiting]
                waiting.clear()
            if shape == first:
                waiting.append(seq)
    for part_rows in (6, 10**6):
        found = rules.match_sequence_rules(
            make.frame(items, schemas.ITEM), make.frame(given, schemas.RULE), "color",
            part_rows=part_rows,
        )
        assert rows(found, "rule", "color", "firstSeq", "secondSeq") == sorted(expected)


def test_segments_and_sessions_brute_force(make):
    rng = random.Random(6)
    given = [
        (str(i), "hot" if rng.random() < 0.7 else rng.choice("xyz"),
         T0 + timedelta(seconds=rng.randrange(900)), 0.0, 0.0, 0.0,
         rng.choice([0.0, 3.0, 8.5]), float(rng.randrange(9)), 0.0)
        for i in range(300)
    ]
    runs, sessions = [], []
    for car in sorted({g[1] for g in given}):
        mine = sorted((g[2], g[6]) for g in given if g[1] == car)
        stops = sorted({ts for ts, speed in mine if speed == 0})
        last = None
        for stop in stops:
            run = [ts for ts, _ in mine if ts < stop and (last is None or ts > last)]
            if run:
                runs.append((car, len(run)))
            last = stop
        length, before = 0, None
        for ts, _ in mine:
            if before is not None and ts - before > timedelta(seconds=5):
                sessions.append((car, length))
                length = 0
            length, before = length + 1, ts
        sessions.append((car, length))
    df = make.frame(given, schemas.CAR_EVENT)
    for part_rows in (9, 10**6):
        found = segments.driving_segments(df, part_rows=part_rows)
        assert rows(found, "carId", "length") == sorted(runs)
        found = segments.driving_sessions(df, "5 seconds", part_rows)
        assert rows(found, "carId", "length") == sorted(sessions)
        order = segments.event_time_order(df, "carId", "ts", "id", part_rows=part_rows)
        numbers = rows(order.filter("carId = 'hot'"), "seq")
        assert numbers == [(i + 1,) for i in range(len(numbers))]


def test_salted_join(make):
    big = make.frame([("hot", i) for i in range(50)] + [("cold", 1), ("none", 2)], "k STRING, v INT")
    small = make.frame([("hot", 1.0), ("cold", 2.0), ("unused", 3.0)], "k STRING, w DOUBLE")
    for how in ("inner", "left"):
        plain = rows(big.join(small, "k", how).fillna(0.0))
        assert rows(salted_join(big, small, ["k"], ["v"], how, part_rows=5).fillna(0.0)) == plain


def test_intervals_brute_force(make):
    rng = random.Random(8)
    spans = [
        (i, s := rng.randrange(10**9), None if rng.random() < 0.2 else s + rng.choice([0, 1, 5, 10**4, 10**7]))
        for i in range(80)
    ]
    points = [(i, rng.choice(spans)[1] + rng.randrange(-3, 10**6)) for i in range(80)]
    expected = sorted(
        (i, j) for i, s, e in spans for j, p in points if s <= p and (e is None or p < e)
    )
    found = interval_point_join(
        make.frame(spans, "i INT, s BIGINT, e BIGINT"), make.frame(points, "j INT, p BIGINT"),
        F.col("s"), F.col("e"), F.col("p"),
    )
    assert rows(found, "i", "j") == expected


def test_numbering(make):
    rng = random.Random(9)
    df = make.frame([(rng.randrange(10), i) for i in range(60)], "b INT, v INT")
    got = rows(number_rows(df, F.col("b"), [F.col("v")], "n"), "n", "b", "v")
    assert [(n, b, v) for n, (b, v) in enumerate(sorted((b, v) for _, b, v in got), 1)] == got


def test_rolling_count_of_one_cell_and_one_hour(spark):
    """All rows in one key and one hour, bursts, nulls: the split scan and the plain window agree with a loop."""
    import random
    from datetime import datetime, timedelta, timezone

    rng = random.Random(9)
    begin = datetime(2020, 1, 1, tzinfo=timezone.utc)
    times = [rng.randrange(3_600_000) for _ in range(500)] + [1_000_000] * 60 + [1_600_000] * 5 + [400_000] * 3
    listed = [(i, "hot", begin + timedelta(milliseconds=ms)) for i, ms in enumerate(times)]
    listed += [(1_000 + i, None, begin + timedelta(milliseconds=ms)) for i, ms in enumerate(times[:90])]
    listed += [(2_000, "few", begin), (2_001, "few", begin + timedelta(minutes=10)), (2_002, "hot", None), (2_003, "hot", None)]
    frame = spark.createDataFrame(listed, "id INT, k STRING, at TIMESTAMP").repartition(4)
    expected = {
        i: sum(1 for _, k2, at2 in listed if k2 == k and ((at is None and at2 is None) or (at and at2 and timedelta(0) <= at - at2 <= timedelta(minutes=10))))
        for i, k, at in listed
    }
    for part_rows in (20, 1_000_000):
        got = rides.rolling_count(frame, "k", "at", part_rows=part_rows)
        assert got.columns == ["id", "k", "at", "cnt"]
        assert {r["id"]: r["cnt"] for r in got.collect()} == expected


def test_sketch_finds_the_hot_keys(spark):
    """More different keys than all sketches follow, keys of two columns and null keys: the list of the full count."""
    n = 600_000
    i = F.col("id")
    key = F.when(i % 3 == 0, 7).when(i % 50 == 1, None).when(i % 200 == 5, -1).otherwise(i)
    df = spark.range(n).select(key.alias("k"), F.when(i % 3 == 0, "x").alias("s"))
    for keys in (["k"], ["k", "s"]):
        expected = {tuple(r) for r in hot_keys(df, keys, 1500).collect()}
        assert {tuple(r) for r in hot_keys_by_sketch(df, keys, 1500).collect()} == expected
        assert len(expected) >= 3
    assert hot_keys_by_sketch(df.limit(0), ["k"], 1500).isEmpty()


def test_timeout_of_a_hot_key(spark):
    """Repeated starts of one id are split by the sketch's list and keep their rows."""
    starts = spark.range(5000).select(F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id")).alias("k"), F.timestamp_seconds("id").alias("at"))
    ends = spark.sql("SELECT 1L AS k, timestamp_seconds(2000) AS done UNION ALL SELECT 4001L, timestamp_seconds(5000)")
    whole = joins.unmatched_within(starts, ends, "k", "at", "done", "20 minutes")
    split = joins.unmatched_within(starts, ends, "k", "at", "done", "20 minutes", part_rows=100)
    assert sorted(map(tuple, split.collect())) == sorted(map(tuple, whole.collect()))
    # Of id 1 (the even rows and row 1) the starts more than 20 minutes before its end are open, and none after them.
    assert whole.where("k = 1").count() == 401
    assert whole.where("k <> 1").count() == 2499 - 1


def test_pagerank_rounds_keep_their_edges(spark, make, monkeypatch):
    """every round shuffled and sorted all edges by text ids."""
    plans = []

    def cut(df, label):
        if label == "ranks":
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return cut_lineage(df, label)

    monkeypatch.setattr(graph, "cut_lineage", cut)
    edges = make.frame([("a", "b", 1.0), ("a", "c", 3.0), ("b", "a", 2.0), ("b", None, 2.0), (None, "a", 5.0)], "src STRING, dst STRING, weight DOUBLE")
    ranks = {r.id: r.rank for r in graph.pagerank(edges, iterations=2).collect()}
    assert len(plans) == 1 and plans[0].count("InMemoryTableScan") == 2
    assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty()
    base = 0.15 / 4
    first = {"a": base + 0.425, "b": base + 0.2125, "c": base + 0.6375, None: base + 0.425}
    assert ranks == pytest.approx({
        "a": base + 0.425 * first["b"], "b": base + 0.2125 * first["a"], "c": base + 0.6375 * first["a"],
        None: base + 0.425 * first["b"],
    })
    hot = {r.id: r.rank for r in graph.pagerank(edges, iterations=2, part_rows=1).collect()}
    assert hot == pytest.approx(ranks)
