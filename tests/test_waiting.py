"""What streams with state of their own ask of the state store, counted on a store in memory."""

from __future__ import annotations

import json
import random
from types import SimpleNamespace

import pandas as pd
import pytest
from pyspark.sql import functions as F

from streamlab.streaming import operators, processors
from streamlab.workloads import files


class Store:
    """State and timers of one bucket; counts the calls."""

    def __init__(self):
        self.calls, self.listed, self.timers, self.maps = 0, 0, set(), []

    def getMapState(self, name, key, value):  # noqa: N802
        held = {}

        def call(f):
            def counted(*args):
                self.calls += 1
                return f(*args)

            return counted

        self.maps.append(held)
        return SimpleNamespace(
            containsKey=call(held.__contains__), getValue=call(held.__getitem__), updateValue=call(held.__setitem__),
            removeKey=call(held.pop), iterator=call(lambda: iter(list(held.items()))), values=call(lambda: iter(list(held.values()))),
        )

    def listTimers(self):  # noqa: N802
        self.listed += 1
        return iter(sorted(self.timers))

    def registerTimer(self, ms):  # noqa: N802
        self.calls += 1
        self.timers.add(ms)


def run(processor, *batches, watermarks):
    """Rows out of micro-batches of waiting fields, each followed by its watermark and all timers due by then."""
    store, out, mark = Store(), [], 0
    processor.init(store)
    for batch, after in zip(batches, watermarks, strict=True):
        frame = pd.DataFrame({"packed": [json.dumps(row, separators=(",", ":")) for row in batch]})
        times = SimpleNamespace(getCurrentWatermarkInMs=lambda now=mark: now)
        out += processor.handleInputRows((0,), iter([frame]), times)
        mark = after
        times = SimpleNamespace(getCurrentWatermarkInMs=lambda now=mark: now)
        for ms in sorted(t for t in store.timers if t <= mark):
            out += processor.handleExpiredTimer((0,), times, SimpleNamespace(getExpiryTimeInMs=lambda ms=ms: ms))
            store.timers.discard(ms)
    rows = [tuple(row) for frame in out for row in frame.itertuples(index=False)]
    return rows, store


def shuffled(rows):
    random.Random(1).shuffle(rows)
    return rows


def test_backlog_lists_its_timers_once():
    """the timers of a backlog were all listed again for each of them."""
    given = shuffled([{"us": 1000 * i, "tie": 0, "key": "hot", "payload": str(i)} for i in range(50_000)])
    found, store = run(processors.SortedRows(), given, watermarks=[1_000_000])
    assert found == [(str(i), i + 1) for i in range(50_000)]
    assert store.listed == 1
    assert not any(store.maps[:2])


def test_backlog_is_read_in_pieces():
    """All due rows of a key were in memory together."""
    sizes = []

    class Sizes(processors.SortedRows):
        piece_rows, block_rows = 500, 20

        def released(self, key, rows):
            sizes.append(len(rows))
            return super().released(key, rows)

    given = shuffled([{"us": 700 * i, "tie": -i, "key": str(i % 3), "payload": str(i)} for i in range(20_000)])
    # The first watermark cuts blocks in two.
    found, _ = run(Sizes(), given, [], watermarks=[5_001, 1_000_000])
    for k in range(3):
        assert [row for row in found if int(row[0]) % 3 == k] == [(str(i), n + 1) for n, i in enumerate(range(k, 20_000, 3))]
    assert max(sizes) < 5_000


@pytest.mark.parametrize("early", [False, True])
def test_asof_asks_per_bucket(early):
    """every sign-up and every key cost calls of their own."""
    rows = [{"us": 2000 * i + 1000 * tie, "tie": tie, "key": str(i % 1000), "payload": f"p{i}" if tie else None,
             "value": None if tie else f"v{i}", "answered": False} for i in range(5000) for tie in (0, 1)]
    found, store = run(processors.AsOf(early), shuffled(rows), watermarks=[1_000_000])
    assert {row[0]: row[1] for row in found} == {f"p{i}": f"v{i}" for i in range(5000)}
    assert store.calls < 500


def test_open_starts_ask_per_bucket():
    """every ride cost some ten calls."""
    starts = [{"us": 1000 * i, "key": str(i), "isStart": True, "payload": f"p{i}"} for i in range(3000)]
    ends = [{"us": 1000 * i + 500, "key": str(i), "isStart": False} for i in range(0, 3000, 2)]
    late_end = [{"us": 1_000_000 + 1000, "key": "1", "isStart": False}]
    found, store = run(processors.OpenStarts(1_000_000), shuffled(starts + ends + late_end), [], watermarks=[2000, 1_000_000])
    assert sorted(found) == sorted([(f"p{i}",) for i in range(3, 3000, 2)])
    assert store.calls < 300
    assert not any(store.maps)


def test_attempts_ask_per_bucket():
    """every ride cost some ten calls; its timeout comes without a later row of the ride."""
    starts = [{"us": 1000 * i, "tie": 0, "key": str(i), "payload": f"p{i}", "fits": 1} for i in range(3000)]
    ends = [{"us": 1000 * i + 500, "tie": 0, "key": str(i), "payload": "end", "fits": 2} for i in range(0, 3000, 2)]
    # Two states: none (0), begun (1); 2 accepts.
    processor = processors.Attempts([[0, 1, 0, 1], [0, 0, 2, 2]], 1, 1_000_000)
    found, store = run(processor, shuffled(starts + ends), [], [], watermarks=[3500, 3600, 9000])
    assert sorted(row[:2] for row in found) == sorted((f"p{i}", "timeout" if i % 2 else "match") for i in range(3000))
    assert store.calls < 500
    assert not any(store.maps)


def test_late_rows_ask_per_bucket():
    """F8: every car cost some ten calls per micro-batch."""
    first = [{"us": 1000 * i, "tie": 0, "key": str(i % 1500), "payload": str(i)} for i in range(6000)]
    second = [{"us": 1_000_000, "tie": 0, "key": "0", "payload": "late"}, {"tie": 0, "key": "0", "payload": "timeless"}]
    found, store = run(processors.SortedRowsAndLate(), first, second, watermarks=[6000, 6000])
    assert [(r[0], r[2]) for r in found[-2:]] == [("late", True), ("timeless", True)]
    assert found[-2][3] == 5000 and pd.isna(found[-1][3])
    assert sorted((int(r[0]), r[1]) for r in found[:-2]) == [(i, i // 1500 + 1) for i in range(6000)]
    assert store.calls < 300


def test_models_and_rules_do_not_ask_per_row():
    """every row read and wrote state."""
    rows = [{"us": 1000 * i, "tie": 0, "key": "c", "bucket": i % 4, "distance": 2.0, "minutes": 4.0 if i % 2 else None, "rideId": i}
            for i in range(8000)]
    found, store = run(processors.TravelTimes(), rows, watermarks=[10_000])
    assert len(found) == 4000 and store.calls < 200

    rule = {"us": 0, "tie": -1, "rule": "r", "first": "a", "second": "b"}
    items = [{"us": 1000 * i, "tie": i, "item": str(i % 3), "shape": "b" if i % 10 == 9 else "a", "payload": str(i)} for i in range(1, 8000)]
    want, open_items = [], {}
    for row in items:
        if row["shape"] == "b":
            want += [("r", row["item"], p, row["payload"]) for p in open_items.pop(row["item"], [])]
        else:
            open_items.setdefault(row["item"], []).append(row["payload"])
    found, store = run(processors.SequenceRules(), [rule, *items], [], watermarks=[4000, 10_000])
    assert found == want and store.calls < 200

    rides = [{"us": 1000 * i, "tie": 0, "taxiId": i % 50, "isStart": True, "payload": str(i)} for i in range(8000)]
    asked = {"us": 6_000_000, "tie": 9, "controlId": 7, "minutes": 0}
    found, store = run(processors.OngoingRides(), [*rides, asked], watermarks=[10_000])
    assert sorted(int(row[2]) for row in found) == list(range(5951, 6001)) and store.calls < 200


def test_runs_of_rides_cost_little_per_ride(monkeypatch):
    """every ride waited in the state of every bucket of queries."""
    monkeypatch.setattr(processors.RideRuns, "run_rows", 300)
    rides = [{"us": 1_000_000 * i, "tie": i, "taxiId": None if i % 7 == 0 else i, "lon": -73.0 - (i * 37 % 1000) / 1000, "lat": 40.5,
              "cosLat": 0.75} for i in range(6000)]
    asked = [{"us": 1_000_000 * at, "tie": -1, "queryId": at, "lon": -73.2, "lat": 40.5} for at in (500, 1500, 4000)]
    runs, _ = run(processors.RideRuns(300_000_000), shuffled([*rides, *asked]), watermarks=[10_000_000])
    assert len(runs) < 60
    names = ["us", "tie", "rides", "queryId", "lon", "lat"]
    given = [{k: v for k, v in zip(names, row[1:], strict=True) if not pd.isna(v)} | {"mine": True} for row in runs]
    given = [{k: int(v) if k in ("us", "tie", "queryId") else v for k, v in row.items()} for row in given]
    found, store = run(processors.NearestTaxi(1_200_000_000, 600_000_000, 100.0), shuffled(given), watermarks=[10_000_000])
    want, active = [], {}
    for row in sorted([*rides, *asked], key=lambda r: (r["us"], r["tie"])):
        if "queryId" in row:
            active = {q: held for q, held in active.items() if row["us"] - q * 1_000_000 <= 1_200_000_000}
            active[row["queryId"]] = None
            continue
        for q, best in active.items():
            km = abs(row["lon"] + 73.2) * 75
            if best is None or row["us"] > best[1] + 600_000_000 or round(km, 3) < round(best[0], 3):
                active[q] = (km, row["us"])
                want.append((q, row["taxiId"], row["us"]))
    assert sorted((q, -1 if pd.isna(taxi) else taxi, us) for q, taxi, _, us in found) == sorted((q, -1 if t is None else t, us) for q, t, us in want)
    assert store.calls < 100


def test_only_open_rides_wait():
    """the end of the time of every START and END waited, of closed rides too."""
    starts = [{"us": 1000 * i, "key": str(i), "isStart": True, "payload": f"p{i}"} for i in range(4000)]
    ends = [{"us": 1000 * i + at, "key": str(i), "isStart": False} for i in range(0, 4000, 2) for at in (100, 200, 300)]
    processor = processors.OpenStarts(1_000_000)
    waiting = []
    processor._wait = lambda texts, wait=processor._wait: (waiting.extend(texts), wait(texts))
    found, store = run(processor, starts + ends, watermarks=[10_000])
    assert sorted(found) == sorted((f"p{i}",) for i in range(1, 4000, 2))
    assert len(waiting) == 4000
    assert not any(store.maps)


def test_only_rows_that_come_out_have_payloads(spark):
    """whole rows waited as text, and were never read."""
    rides = spark.createDataFrame([(1, True), (1, False)], "rideId long, isStart boolean")
    stamped = rides.withColumn("at", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    timed = operators._timed(stamped, "at", "1 minute", F.col("isStart"))
    assert {r["isStart"]: bool(r["payload"]) for r in timed.collect()} == {True: True, False: False}


def test_halves_of_a_restart_are_not_one_task(spark):
    """each half of the events was written by one task."""
    times = F.timestamp_seconds(F.col("id"))
    halves = files._ranges(spark.range(0, 1000, 1, 6).withColumn("ts", times), 2)
    assert [half.rdd.getNumPartitions() for half in halves] == [6, 6]
    assert sum(half.count() for half in halves) == 1000
