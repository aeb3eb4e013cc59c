"""Stateful processors: the small per-key steps that built-in streaming operators cannot express.

Spark groups, shuffles, times and stores; a processor only says what one key does with its rows.
Rows carry event time as epoch microseconds (``us``) and whole records as JSON text, so the same
processors serve any record type.

``InOrder`` is given buckets of keys: what a micro-batch costs for a key besides its rows (some ten calls
to the state store) it then costs for a bucket. Rows arrive in frames, as one JSON text each (``packed``,
made by Spark), because Python pays for every cell of a row.

Most of them build on ``InOrder``: rows wait in state until the watermark reaches them and are then
seen in event-time order. The results do not depend on arrival order, and equal the batch forms.
"""

from __future__ import annotations

import gc
import json
import math
from base64 import b64decode, b64encode
from bisect import bisect_left, bisect_right
from collections import namedtuple
from collections.abc import Iterator
from itertools import groupby, islice
from json.encoder import encode_basestring_ascii
from operator import attrgetter, itemgetter
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Row
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle


#: Arrow types of the columns of an output.
ARROW = {
    "STRING": pa.string(), "BIGINT": pa.int64(), "INT": pa.int32(), "DOUBLE": pa.float64(), "FLOAT": pa.float32(),
    "BOOLEAN": pa.bool_(), "TIMESTAMP": pa.timestamp("us", "UTC"),
}


class Slots:
    """A value per key of a bucket, as JSON. Keys are dealt to a few slots, of which only those that are asked
    for are read, and only those that changed are written by ``save``."""

    number = 16

    def __init__(self, handle: StatefulProcessorHandle, name: str) -> None:
        self.state = handle.getMapState(name, "slot INT", "held STRING")
        self.read: dict[int, tuple[str, dict]] = {}

    def of(self, key: str) -> dict:
        """The values by key of all keys in the slot of this one; changes last."""
        slot = crc32(key.encode()) % self.number
        if slot not in self.read:
            text = self.state.getValue((slot,))[0] if self.state.containsKey((slot,)) else "{}"
            self.read[slot] = (text, json.loads(text))
        return self.read[slot][1]

    def save(self) -> None:
        for slot, (before, values) in self.read.items():
            text = json.dumps(values)
            if text == before:
                continue
            if values:
                self.state.updateValue((slot,), (text,))
            else:
                self.state.removeKey((slot,))
        self.read = {}


def _uncollected(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The same frames. Rows make no cycles, so while a bucket is read its rows are not searched for them again and again."""
    if not gc.isenabled():
        yield from frames
        return
    gc.disable()
    try:
        yield from frames
    finally:
        gc.enable()


class InOrder(StatefulProcessor):
    """Holds rows back until the watermark reaches them, then passes them on in their order.

    Waiting rows are kept in blocks under the time of their first row, so a timer reads the blocks that
    are due and no others. Only rows that the watermark leaves behind are written again. Due blocks are
    read in the order of their first rows, and rows are passed on in pieces as soon as no later block can
    hold an earlier one, so memory holds a piece and the blocks that overlap it, however long the backlog.
    """

    #: DDL of the waiting rows; starts with us.
    fields = "us BIGINT, tie BIGINT, payload STRING"
    #: Names that rows are sorted by; nulls come first.
    order = ("us", "tie")
    #: Rows of a block at most.
    block_rows = 1024
    #: Rows that are sorted into blocks together, and that are passed on together at least.
    piece_rows = 65_536

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        kinds = [part.split() for part in self.fields.split(", ")]
        self.record = namedtuple("Waiting", [name for name, _ in kinds])
        self.floats = [name for name, kind in kinds if kind in ("DOUBLE", "FLOAT")]
        self.by_order = attrgetter(*self.order)
        self.blocks = handle.getMapState("blocks", "ms BIGINT, n BIGINT", "rows STRING")
        self.counts = handle.getMapState("counts", "ms BIGINT", "n BIGINT")
        self.prepare(handle)

    def prepare(self, handle: StatefulProcessorHandle) -> None:
        """Create further state."""

    def begin(self, key: tuple) -> None:
        """Before the first piece of a key."""

    def released(self, key: tuple, rows: list) -> Iterator[Row]:
        """Rows to emit for input that is now complete and in order; called piece by piece."""
        raise NotImplementedError

    def settle(self, key: tuple, watermark: int) -> Iterator[Row]:
        """After the last piece of a key: write what has to last, and emit what is left to emit."""
        return iter([])

    def arrived(self, texts: Iterator[str], watermark: int) -> Iterator[Row]:
        """Rows to emit for packed rows that arrive; they have to wait."""
        while piece := list(islice(texts, self.piece_rows)):
            self._wait(piece)
        return iter([])

    def handleInputRows(self, key, rows, timerValues):
        texts = (text for frame in rows for text in frame["packed"])
        yield from _uncollected(self._frames(self.arrived(texts, timerValues.getCurrentWatermarkInMs())))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        watermark = timerValues.getCurrentWatermarkInMs()
        yield from _uncollected(self._frames(self._expired(key, watermark, expiredTimerInfo.getExpiryTimeInMs())))

    def _frames(self, rows: Iterator[Row]) -> Iterator[pd.DataFrame]:
        columns = [part.split() for part in self.output.split(", ")]
        while some := list(islice(rows, 10_000)):
            # Arrow keeps nulls apart from NaN.
            arrays = [pa.array(cells, ARROW[kind]) for cells, (_, kind) in zip(zip(*some, strict=True), columns, strict=True)]
            yield pd.DataFrame({name: pd.Series(pd.arrays.ArrowExtensionArray(array)) for array, (name, _) in zip(arrays, columns, strict=True)})

    def _records(self, block: list[dict]) -> list:
        for name in self.floats:
            for values in block:
                if isinstance(values.get(name), str):  # how Spark writes NaN and infinities
                    values[name] = float(values[name])
        make, names = self.record._make, self.record._fields
        return [make(map(values.get, names)) for values in block]

    def _expired(self, key, watermark, fired):
        # The first timer of a key reads all that is due; the other timers then find nothing.
        if not self.counts.containsKey((fired,)):
            return
        due = self._due(fired, watermark)
        self.begin(key)
        held, enough = [], self.piece_rows
        for ms, following in zip(due, [*due[1:], watermark + 1], strict=True):
            held += self._read(ms)
            if len(held) >= enough or following > watermark:
                held = self._sorted(held)
                end = bisect_left(held, following, key=lambda row: row.us // 1000)
                if end:
                    yield from self.released(key, held[:end])
                held = held[end:]
                enough = self.piece_rows + 2 * len(held)
        yield from self.settle(key, watermark)
        self._wait([json.dumps(row._asdict(), separators=(",", ":")) for row in held])

    def _due(self, fired: int, watermark: int) -> list[int]:
        """All times of this key that the watermark has passed, so that blocks which overlap are read together."""
        due = {fired}
        for ms in self.handle.listTimers():
            if ms <= watermark:
                due.add(ms)
        return sorted(due)

    def _read(self, ms: int) -> list:
        """The rows of the blocks of one time, which are taken out."""
        if not self.counts.containsKey((ms,)):
            return []
        found = []
        for n in range(self.counts.getValue((ms,))[0]):
            found += self._records(json.loads(self.blocks.getValue((ms, n))[0]))
            self.blocks.removeKey((ms, n))
        self.counts.removeKey((ms,))
        return found

    def _sorted(self, rows: list) -> list:
        try:
            return sorted(rows, key=self.by_order)
        except TypeError:  # nulls do not compare
            return sorted(rows, key=lambda row: [(x is not None, x) for x in self.by_order(row)])

    @staticmethod
    def _us(text: str) -> int | None:
        """The time of a packed row; a row without one does not begin with it."""
        return int(text[6 : text.index(",")]) if text.startswith('{"us":') else None

    def _wait(self, texts: list[str]) -> None:
        rows = sorted(((self._us(text), text) for text in texts), key=itemgetter(0))
        for lo in range(0, len(rows), self.block_rows):
            block = rows[lo : lo + self.block_rows]
            ms = block[0][0] // 1000
            n = self.counts.getValue((ms,))[0] if self.counts.containsKey((ms,)) else 0
            self.blocks.updateValue((ms, n), (f"[{','.join(text for _, text in block)}]",))
            self.counts.updateValue((ms,), (n + 1,))
            if not n:
                self.handle.registerTimer(ms)


class SortedRows(InOrder):
    """Every row with its place in the order of its key."""

    fields = "us BIGINT, tie BIGINT, key STRING, payload STRING"
    output = "payload STRING, seq BIGINT"

    def prepare(self, handle):
        self.places = Slots(handle, "places")

    def released(self, key, rows):
        for row in rows:
            places = self.places.of(row.key)
            places[row.key] = seq = places.get(row.key, 0) + 1
            yield Row(payload=row.payload, seq=seq)

    def settle(self, key, watermark):
        self.places.save()
        return iter([])


class SortedRowsAndLate(SortedRows):
    """Rows in order as ``SortedRows`` has them; a row at or behind the watermark comes out at once, without a
    place and with how far behind it is. A row without a time has neither."""

    output = "payload STRING, seq BIGINT, late BOOLEAN, behindMs BIGINT"

    def arrived(self, texts, watermark):
        # 0 until the first micro-batch is over: nothing is late before.
        waiting = []
        for text in texts:
            us = self._us(text)
            if us is None:
                yield Row(payload=json.loads(text)["payload"], seq=None, late=True, behindMs=None)
            elif watermark > 0 and us <= watermark * 1000:
                yield Row(payload=json.loads(text)["payload"], seq=None, late=True, behindMs=watermark - us // 1000)
            else:
                waiting.append(text)
                if len(waiting) == self.piece_rows:
                    self._wait(waiting)
                    waiting = []
        self._wait(waiting)

    def released(self, key, rows):
        for row in super().released(key, rows):
            yield Row(payload=row.payload, seq=row.seq, late=False, behindMs=None)


class RollingCount(InOrder):
    """Every row with the number of rows of its key in the last ``within_us``, ties included."""

    fields = "us BIGINT, tie BIGINT, key STRING, payload STRING"
    output = "payload STRING, cnt BIGINT"

    def __init__(self, within_us: int) -> None:
        self.within_us = within_us

    def prepare(self, handle):
        self.recent = Slots(handle, "recent")

    def released(self, key, rows):
        by_key = {}
        for row in rows:
            by_key.setdefault(row.key, []).append(row)
        for name, own in by_key.items():
            recent = self.recent.of(name)
            times = recent.get(name, [])
            known = len(times)
            times += [row.us for row in own]
            first, last = 0, known
            for i, row in enumerate(own, start=known):
                while times[first] < row.us - self.within_us:
                    first += 1
                last = max(last, i)
                while last + 1 < len(times) and times[last + 1] == row.us:
                    last += 1
                yield Row(payload=row.payload, cnt=last - first + 1)
            recent[name] = times[first:]

    def settle(self, key, watermark):
        self.recent.save()
        return iter([])


class DrivingSegments(InOrder):
    """Runs of driving rows closed by a stop. Only the totals of the open run are kept."""

    fields = "us BIGINT, tie BIGINT, key STRING, carId STRING, speed FLOAT, throttle FLOAT"
    output = "carId STRING, startUs BIGINT, length BIGINT, maxSpeed INT, erraticness DOUBLE"

    def __init__(self, require_leading_stop: bool = False) -> None:
        self.require_leading_stop = require_leading_stop

    def prepare(self, handle):
        self.open = Slots(handle, "open")

    def released(self, key, rows):
        by_key = {}
        for row in rows:
            by_key.setdefault(row.key, []).append(row)
        for name, own in by_key.items():
            yield from self._segments(name, own)

    def settle(self, key, watermark):
        self.open.save()
        return iter([])

    def _segments(self, name, rows):
        empty = (0, 0, 0.0, 0, 0.0, 0.0)
        kept = self.open.of(name)
        stopped, *run = kept.get(name, (False, *empty))
        i = 0
        while i < len(rows):
            j = i
            while j < len(rows) and rows[j].us == rows[i].us:
                j += 1
            if any(row.speed == 0 for row in rows[i:j]):
                n, start, top, known, _, m2 = run
                if n > 0 and (stopped or not self.require_leading_stop):
                    yield Row(
                        carId=rows[i].carId, startUs=start, length=n, maxSpeed=int(top),
                        erraticness=math.sqrt(m2 / known) if known else None,
                    )
                stopped, run = True, list(empty)
            else:
                for row in rows[i:j]:
                    run = self._add(run, row) if row.speed is not None else run
            i = j
        kept[name] = (stopped, *run)

    @staticmethod
    def _add(run, row):
        """Totals with one more row; a null throttle counts for nothing (variance by Welford's update)."""
        n, start, top, known, mean, m2 = run
        if row.throttle is not None:
            known += 1
            step = row.throttle - mean
            mean += step / known
            m2 += step * (row.throttle - mean)
        return [n + 1, start if n else row.us, max(top, row.speed) if n else row.speed, known, mean, m2]


class TravelTimes(InOrder):
    """Predictions for START rows from the END rows before them, per direction bucket."""

    fields = "us BIGINT, tie BIGINT, key STRING, bucket INT, distance DOUBLE, minutes DOUBLE, rideId BIGINT"
    output = "rideId BIGINT, prediction INT"

    def prepare(self, handle):
        self.model = Slots(handle, "model")

    def released(self, key, rows):
        for row in rows:
            model = self.model.of(row.key).setdefault(row.key, {})
            n, sxy, sxx = model.get(str(row.bucket), (0, 0.0, 0.0))
            if row.minutes is None:
                known = n >= 2 and sxx > 0
                yield Row(
                    rideId=row.rideId, prediction=int(sxy / sxx * row.distance) if known else -1
                )
            else:
                model[str(row.bucket)] = (n + 1, sxy + row.distance * row.minutes, sxx + row.distance**2)

    def settle(self, key, watermark):
        self.model.save()
        return iter([])


class AsOf(InOrder):
    """Left rows with the newest right value at or before their time.

    Right rows have tie 0 and a value, left rows tie 1. With ``early`` a left row is also answered
    on arrival from what is known by then, and answered again only if that was not final. The first
    answer waits with its row, so equal rows do not share one. Right rows are kept as versions as long
    as the watermark has not passed them, and one older.
    """

    fields = "us BIGINT, tie BIGINT, key STRING, payload STRING, value STRING, answered BOOLEAN"
    output = "payload STRING, value STRING, final BOOLEAN"

    def __init__(self, early: bool = False) -> None:
        self.early = early

    def prepare(self, handle):
        self.newest = Slots(handle, "newest")
        self.versions = Slots(handle, "versions")

    def arrived(self, texts, watermark):
        if not self.early:
            yield from super().arrived(texts, watermark)
            return
        rows = [json.loads(text) for text in texts]
        for row in rows:
            if row["tie"] == 0:
                versions, us, value = self.versions.of(row["key"]).setdefault(row["key"], {}), str(row["us"]), row.get("value")
                versions[us] = max(versions.get(us) or "", value or "") or value
        found = {}
        for row in rows:
            if row["tie"] == 1:
                key = row["key"]
                if key not in found:
                    found[key] = sorted((int(us), value) for us, value in self.versions.of(key).get(key, {}).items())
                at = bisect_right(found[key], row["us"], key=itemgetter(0))
                row["value"] = found[key][at - 1][1] if at else self.newest.of(key).get(key)
                row["answered"] = True
                yield Row(payload=row["payload"], value=row["value"], final=False)
        self.versions.save()
        self.newest.save()
        for lo in range(0, len(rows), self.piece_rows):
            self._wait([json.dumps(row, separators=(",", ":")) for row in rows[lo : lo + self.piece_rows]])

    def begin(self, key):
        self.current = {}

    def released(self, key, rows):
        for row in sorted(rows, key=lambda r: (r.us, r.tie, r.value or "")):
            name = row.key
            if name not in self.current:
                self.current[name] = self.newest.of(name).get(name)
            if row.tie == 0:
                self.current[name] = row.value
                if self.early:
                    held = self.versions.of(name)
                    versions = held.get(name, {})
                    versions.pop(str(row.us), None)
                    if not versions:
                        held.pop(name, None)
            elif not (row.answered and row.value == self.current[name]):
                yield Row(payload=row.payload, value=self.current[name], final=True)

    def settle(self, key, watermark):
        for name, value in self.current.items():
            if value is not None:
                self.newest.of(name)[name] = value
        self.newest.save()
        self.versions.save()
        return iter([])


class OpenStarts(InOrder):
    """START rows that no END of the same key follows within ``within_us``.

    Rows are not held back. What waits is the end of the time of a START or END: then the START comes out,
    and the END is forgotten.
    """

    fields = "us BIGINT, key STRING, isStart BOOLEAN, payload STRING"
    order = ("us",)
    output = "payload STRING"

    def __init__(self, within_us: int) -> None:
        self.within_us = within_us

    def prepare(self, handle):
        #: By key the first END known, and the STARTs that no END follows so far.
        self.open = Slots(handle, "open")

    def arrived(self, texts, watermark):
        while piece := list(islice(texts, self.piece_rows)):
            over, of, within = {}, self.open.of, self.within_us
            for row in json.loads(f"[{','.join(piece)}]"):
                key, us = row["key"], row["us"]
                kept = of(key)
                held = kept.get(key)
                if held is None:
                    held = kept[key] = [None, []]
                first, starts = held
                # A row that is neither counts as an END.
                if not row.get("isStart"):
                    if first is None or us < first:
                        held[0] = us
                        over.setdefault(key, set()).add(us)
                        if starts:
                            held[1] = [start for start in starts if us > start[0] + within]
                elif first is None or first > us + within:
                    starts.append([us, row["payload"]])
                    over.setdefault(key, set()).add(us)
            # Only what is still open has a time that ends.
            looks = []
            for key, times in over.items():
                first, starts = of(key)[key]
                looks += [(us, key) for us in times.intersection([first, *(start[0] for start in starts)])]
            self._wait([f'{{"us":{us + within},"key":{encode_basestring_ascii(key)}}}' for us, key in looks])
        self.open.save()
        return iter([])

    def released(self, key, rows):
        for row in rows:
            kept = self.open.of(row.key)
            held = kept.get(row.key)
            if held is None:
                continue
            first, starts = held
            now = row.us // 1000
            over = [start for start in starts if (start[0] + self.within_us) // 1000 <= now]
            if over:
                yield from ((payload,) for _, payload in over)
                held[1] = starts = [start for start in starts if (start[0] + self.within_us) // 1000 > now]
            if first is not None and (first + self.within_us) // 1000 <= now:
                held[0] = first = None
            if first is None and not starts:
                del kept[row.key]

    def settle(self, key, watermark):
        self.open.save()
        return iter([])


class SequenceRules(InOrder):
    """Two-step rules that arrive as control rows (``rule`` not null) next to the items."""

    fields = (
        "us BIGINT, tie BIGINT, item STRING, shape STRING, payload STRING, "
        "rule STRING, first STRING, second STRING"
    )
    output = "rule STRING, item STRING, firstPayload STRING, secondPayload STRING"

    def prepare(self, handle):
        self.rules = handle.getMapState("rules", "rule STRING", "first STRING, second STRING")
        # Pending first items are in numbered blocks, so that adding some does not rewrite the others.
        self.pending = handle.getMapState(
            "pending", "item STRING, rule STRING, n BIGINT", "payloads STRING"
        )
        self.waits = handle.getMapState("waits", "item STRING, rule STRING", "n BIGINT")

    def begin(self, key):
        self.known = {k[0]: tuple(v) for k, v in self.rules.iterator()}
        # By item and rule the blocks in state, and the items that came since.
        self.held, self.fresh = {}, 0

    def released(self, key, rows):
        for row in rows:
            if row.rule is not None:
                self.known[row.rule] = (row.first, row.second)
                self.rules.updateValue((row.rule,), self.known[row.rule])
                continue
            for rule, (first, second) in self.known.items():
                if row.shape not in (first, second):
                    continue
                slot = (row.item, rule)
                if slot not in self.held:
                    n = self.waits.getValue(slot)[0] if self.waits.containsKey(slot) else 0
                    self.held[slot] = [n, []]
                n, since = held = self.held[slot]
                if row.shape == second:
                    for i in range(n):
                        for payload in json.loads(self.pending.getValue((*slot, i))[0]):
                            yield Row(rule=rule, item=row.item, firstPayload=payload, secondPayload=row.payload)
                        self.pending.removeKey((*slot, i))
                    for payload in since:
                        yield Row(rule=rule, item=row.item, firstPayload=payload, secondPayload=row.payload)
                    if n:
                        self.waits.removeKey(slot)
                    self.fresh -= len(since)
                    held[:] = [0, []]
                if row.shape == first:
                    held[1].append(row.payload)
                    self.fresh += 1
        if self.fresh > 4 * self.piece_rows:
            self._store()

    def _store(self):
        for slot, (n, since) in self.held.items():
            if since:
                self.pending.updateValue((*slot, n), (json.dumps(since),))
                self.waits.updateValue(slot, (n + 1,))
        self.held, self.fresh = {}, 0

    def settle(self, key, watermark):
        self._store()
        return iter([])


class OngoingRides(InOrder):
    """Latest ride per taxi of one bucket; control rows (``minutes`` not null) list the ongoing."""

    fields = (
        "us BIGINT, tie BIGINT, taxiId BIGINT, isStart BOOLEAN, payload STRING, "
        "controlId BIGINT, minutes BIGINT"
    )
    output = "controlId BIGINT, controlUs BIGINT, payload STRING"

    def prepare(self, handle):
        self.latest = handle.getMapState(
            "latest", "taxiId BIGINT", "us BIGINT, isStart BOOLEAN, payload STRING"
        )

    def begin(self, key):
        #: Rides of taxis that came since, and all of them as soon as a control row asks.
        self.fresh, self.all = {}, None

    def released(self, key, rows):
        for row in rows:
            if row.minutes is None:
                self.fresh[row.taxiId] = (row.us, row.isStart, row.payload)
                if self.all is not None:
                    self.all[row.taxiId] = self.fresh[row.taxiId]
                continue
            if self.all is None:
                self.all = {k[0]: tuple(v) for k, v in self.latest.iterator()} | self.fresh
            for us, is_start, payload in self.all.values():
                if is_start and (row.us // 1000 - us // 1000) // 60_000 >= row.minutes:
                    yield Row(controlId=row.controlId, controlUs=row.us, payload=payload)

    def settle(self, key, watermark):
        for taxi, ride in self.fresh.items():
            self.latest.updateValue((taxi,), ride)
        return iter([])


def improvements(us, km, best=None, ttl_us=None):
    """Places of the rows that become the best, and the best at the end, of rows in time order.

    ``best`` is (km, us) or None; it is forgotten ``ttl_us`` after it was set, and the next row then
    counts whatever its distance.
    """
    places, i = [], 0
    while i < len(us):
        if best is not None:
            end = len(us) if ttl_us is None else max(int(np.searchsorted(us, best[1] + ttl_us, "right")), i)
            nearer = km[i:end] < best[0]
            i = i + int(nearer.argmax()) if nearer.any() else end
            if i >= len(us):
                break
        best = (float(km[i]), int(us[i]))
        places.append(i)
        i += 1
    return places, best


def flat_km(lon, lat, to_lon, to_lat, to_cos, degree_km):
    """Distances of one point (single floats) to many, as ``geo.distance`` has them."""
    dy = (np.float32(lat) - to_lat).astype(np.float64)
    dx = (np.float32(lon) - to_lon).astype(np.float64) * to_cos
    return (degree_km * np.sqrt(dy * dy + dx * dx)).astype(np.float32)


class RideRuns(InOrder):
    """Rides in time order as runs: one text with arrays of their fields (``run_of``). A run lies in one slice of time and has no
    query in its time, because the rides and queries of a slice wait together. Queries come out as they are."""

    fields = "us BIGINT, tie BIGINT, taxiId BIGINT, lon FLOAT, lat FLOAT, cosLat DOUBLE, queryId BIGINT"
    output = "_time TIMESTAMP, us BIGINT, tie BIGINT, rides STRING, queryId BIGINT, lon FLOAT, lat FLOAT"
    #: Rides of a run at most.
    run_rows = 4096

    def __init__(self, slice_us: int) -> None:
        self.slice_us = slice_us

    def released(self, key, rows):
        for (_, asked), same in groupby(rows, lambda row: (row.us // self.slice_us, row.queryId is not None)):
            same = list(same)
            if asked:
                yield from ((row.us, row.us, row.tie, None, row.queryId, row.lon, row.lat) for row in same)
                continue
            for lo in range(0, len(same), self.run_rows):
                run = same[lo : lo + self.run_rows]
                yield run[-1].us, run[0].us, run[0].tie, run_of(run), None, None, None


#: The fields of the rides of a run, one array after the other; a taxi that is null is not known.
RUN = {"us": np.int64, "taxiId": np.int64, "cosLat": np.float64, "lon": np.float32, "lat": np.float32, "known": np.bool_}


def run_of(rides: list) -> str:
    columns = {name: [getattr(ride, name) for ride in rides] for name in RUN if name != "known"}
    columns["known"] = [taxi is not None for taxi in columns["taxiId"]]
    columns["taxiId"] = [0 if taxi is None else taxi for taxi in columns["taxiId"]]
    return b64encode(b"".join(np.array(columns[name], kind).tobytes() for name, kind in RUN.items())).decode()


def rides_of(runs: list[str]) -> dict[str, np.ndarray]:
    """The rides of runs by field."""
    parts = {name: [] for name in RUN}
    for run in runs:
        held, at = b64decode(run), 0
        n = len(held) // sum(np.dtype(kind).itemsize for kind in RUN.values())
        for name, kind in RUN.items():
            parts[name].append(np.frombuffer(held, kind, n, at))
            at += n * np.dtype(kind).itemsize
    return {name: np.concatenate(arrays) for name, arrays in parts.items()}


class NearestTaxi(InOrder):
    """New nearest taxis of the queries of one bucket. Every run of rides (``RideRuns``) passes every bucket; what
    comes out is only the improvements. A query row that is not ``mine`` belongs to another bucket, and still drops
    queries that have grown old here."""

    fields = "us BIGINT, tie BIGINT, rides STRING, queryId BIGINT, lon FLOAT, lat FLOAT, mine BOOLEAN"
    output = "queryId BIGINT, taxiId BIGINT, km FLOAT, us BIGINT"
    # A row is a run of up to 4,096 rides.
    block_rows = 16
    piece_rows = 512

    def __init__(self, query_ttl_us: int | None, report_ttl_us: int | None, degree_km: float) -> None:
        self.query_ttl_us, self.report_ttl_us, self.degree_km = query_ttl_us, report_ttl_us, degree_km

    def prepare(self, handle):
        self.queries = handle.getMapState(
            "queries", "queryId BIGINT", "us BIGINT, lon FLOAT, lat FLOAT, km FLOAT, bestUs BIGINT"
        )

    def begin(self, key):
        self.active = {k[0]: tuple(v) for k, v in self.queries.iterator()}
        self.before = dict(self.active)

    def released(self, key, rows):
        for between, same in groupby(rows, lambda row: row.rides is not None):
            if between:
                runs = [row.rides for row in same] if self.active else []
                for lo in range(0, len(runs), 64):
                    yield from self._rides(self.active, rides_of(runs[lo : lo + 64]))
                continue
            for row in same:
                if self.query_ttl_us is not None:
                    self.active = {q: v for q, v in self.active.items() if row.us - v[0] <= self.query_ttl_us}
                if row.mine and row.lon != 0:
                    self.active[row.queryId] = (row.us, row.lon, row.lat, None, None)

    def settle(self, key, watermark):
        for q in self.before.keys() - self.active.keys():
            self.queries.removeKey((q,))
        for q, v in self.active.items():
            if self.before.get(q) != v:
                self.queries.updateValue((q,), v)
        return iter([])

    def _rides(self, active, rides):
        us, taxi, known = rides["us"], rides["taxiId"], rides["known"]
        for q, (asked, q_lon, q_lat, km, best_us) in active.items():
            seen = flat_km(q_lon, q_lat, rides["lon"], rides["lat"], rides["cosLat"], self.degree_km)
            places, best = improvements(us, seen, None if best_us is None else (km, best_us), self.report_ttl_us)
            for i in places:
                yield Row(queryId=q, taxiId=int(taxi[i]) if known[i] else None, km=float(seen[i]), us=int(us[i]))
            if places:
                active[q] = (asked, q_lon, q_lat, *best)


class TaxiQueries(InOrder):
    """User predicates: which ride may answer which question (``controlId`` not null), for one bucket of taxis.

    A question sees the latest row of every taxi (PBE), and is then put to every later row (PE) until a
    later question takes its place. Questions of one millisecond are in force together.
    """

    fields = "us BIGINT, atUs BIGINT, tie BIGINT, rideId BIGINT, taxi STRING, payload STRING, controlId BIGINT, predicate STRING"
    order = ("us", "tie", "rideId", "controlId")
    output = "kind STRING, atUs BIGINT, controlId BIGINT, predicate STRING, payload STRING"

    def prepare(self, handle):
        self.latest = handle.getMapState("latest", "taxi STRING", "payload STRING")
        self.in_force = handle.getValueState("inForce", "ms BIGINT, asked STRING")

    def released(self, key, rows):
        ms, asked = tuple(self.in_force.get()) if self.in_force.exists() else (None, "[]")
        asked, fresh = json.loads(asked), {}
        for row in rows:
            if row.controlId is None:
                fresh[row.taxi] = row.payload
                for control, predicate in asked:
                    yield Row(kind="PE", atUs=row.atUs, controlId=control, predicate=predicate, payload=row.payload)
                continue
            asked = (asked if ms == row.us // 1000 else []) + [(row.controlId, row.predicate)]
            ms = row.us // 1000
            self._store(fresh)
            if key[0] == 0:
                yield Row(kind="QUERY", atUs=row.atUs, controlId=row.controlId, predicate=row.predicate, payload=None)
            for (payload,) in self.latest.values():
                yield Row(kind="PBE", atUs=row.atUs, controlId=row.controlId, predicate=row.predicate, payload=payload)
        self._store(fresh)
        if ms is not None:
            self.in_force.update((ms, json.dumps(asked)))

    def _store(self, fresh):
        for taxi, payload in fresh.items():
            self.latest.updateValue((taxi,), (payload,))
        fresh.clear()


class Attempts(InOrder):
    """Sequence patterns: open attempts by state of the automaton (``table``, see ``operators.patterns``)."""

    fields = "us BIGINT, tie BIGINT, key STRING, payload STRING, fits INT"
    output = "payload STRING, kind STRING, endUs BIGINT, rowsBetween BIGINT"

    def __init__(self, table: list[list[int]], first: int, within_us: int | None) -> None:
        self.table, self.first, self.within_us = table, first, within_us

    def prepare(self, handle):
        #: By key its place, its attempts by state, and the time at which it is looked at again.
        self.open = Slots(handle, "open")

    def begin(self, key):
        self.touched = set()

    def _over(self, attempts, before):
        """Take out the attempts whose time was over before; those of a state stand in the order of their begin."""
        found = []
        for state, begun in list(attempts.items()):
            n = 0
            while n < len(begun) and begun[n][0] + self.within_us < before:
                found.append((begun[n][2], "timeout", None, None))
                n += 1
            if n == len(begun):
                del attempts[state]
            elif n:
                attempts[state] = begun[n:]
        return found

    def released(self, key, rows):
        accept, table, of, timed = len(self.table), self.table, self.open.of, self.within_us is not None
        for row in rows:
            name, us, fits = row.key, row.us, row.fits
            self.touched.add(name)
            # A row that only brings time has no payload.
            if row.payload is None:
                continue
            kept = of(name)
            place, attempts, again = kept.get(name, (0, None, None))
            moved = {}
            if attempts:
                if timed:
                    yield from self._over(attempts, us)
                for state, begun in attempts.items():
                    after = table[int(state)][fits]
                    if after == accept:
                        for _, at, payload in begun:
                            yield payload, "match", us, place - at - 1
                    elif after:
                        after = str(after)
                        moved[after] = sorted(moved.get(after, []) + begun) if after in moved else begun
            if fits & 1:
                if self.first == accept:
                    yield row.payload, "match", us, -1
                else:
                    moved.setdefault(str(self.first), []).append([us, place, row.payload])
            # Without attempts no place is looked back to.
            if moved:
                kept[name] = [place + 1, moved, again]
            elif attempts is not None:
                del kept[name]

    def settle(self, key, watermark):
        looks = []
        for name in self.touched if self.within_us is not None else ():
            kept = self.open.of(name)
            if name not in kept:
                continue
            place, attempts, again = kept[name]
            yield from self._over(attempts, watermark * 1000)
            if not attempts:
                del kept[name]
                continue
            us = min(begun[0][0] for begun in attempts.values()) + self.within_us + 1000
            if us != again:
                looks.append(f'{{"us":{us},"key":{encode_basestring_ascii(name)}}}')
            kept[name] = [place, attempts, us]
        self._wait(looks)
        self.open.save()


class AverageChanges(StatefulProcessor):
    """A change log of averages: when rows change a key's average, the old row is deleted and the new one
    inserted. Replaying the log in order gives the current table."""

    output = "key STRING, change STRING, n BIGINT, average DOUBLE, version BIGINT"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.totals = handle.getValueState("totals", "n BIGINT, total BIGINT, version BIGINT")

    def handleInputRows(self, key, rows, timerValues):
        n, total, version = tuple(self.totals.get()) if self.totals.exists() else (0, 0, 0)
        fresh = [row.value for row in rows if row.value is not None]
        if not fresh:
            return
        if n:
            yield Row(key=key[0], change="delete", n=n, average=total / n, version=version)
        n, total, version = n + len(fresh), total + sum(fresh), version + 1
        self.totals.update((n, total, version))
        yield Row(key=key[0], change="insert", n=n, average=total / n, version=version)
