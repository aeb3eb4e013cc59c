"""Sequence patterns: steps that follow each other in the rows of a key, as one finite automaton.

Every row that fits the first step begins an attempt. An attempt ends at the first row that completes the
pattern (a match), at the first row that fits nothing (nothing comes out), or when its time is over. What
becomes of it depends only on the automaton's state and on the rows to come, so rows are read backwards: after a
row is known, for each state, where an attempt in that state would end. That table is all that an
earlier part of a hot key needs of the later ones, and tables are composed part by part.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamlab.plans.hotkeys import HOT, PART, PART_ROWS, split_by_position

# The functions of this module travel to the executors by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MOST_STEPS = 6
#: Rows of a chunk; the chunks of a batch are worked on side by side.
CHUNK = 256
#: How an attempt ends: with the pattern, without it, or not in the rows seen.
MATCH, DEAD, OPEN = 0, 1, 2


@dataclass(frozen=True)
class Step:
    """One step: ``where`` says which rows fit. ``strict``: it must follow the step before at once, otherwise
    rows in between are passed over. ``repeated``: one or more rows in a row fit it."""

    name: str
    where: Column
    strict: bool = True
    repeated: bool = False


@dataclass(frozen=True)
class Automaton:
    """States are sets of steps that an attempt may have matched last; the pattern's end is ``accept``."""

    table: np.ndarray  # next state by state and fitting steps (bits); dead is 0
    first: int  # state after the row that begins an attempt; accept if there is one step only

    @property
    def accept(self) -> int:
        return len(self.table)


def compile_steps(steps: list[Step]) -> Automaton:
    if not 1 <= len(steps) <= MOST_STEPS:
        raise ValueError(f"a pattern has 1 to {MOST_STEPS} steps")
    last = len(steps) - 1
    states, symbols = 1 << last, 1 << len(steps)
    table = np.zeros((states, symbols), np.int64)
    for state in range(states):
        for fits in range(symbols):
            after = 0
            for i in range(last):
                if state >> i & 1:
                    if steps[i].repeated and fits >> i & 1:
                        after |= 1 << i
                    if fits >> (i + 1) & 1:
                        after |= 1 << (i + 1)
                    elif not steps[i + 1].strict:
                        after |= 1 << i
            table[state, fits] = states if after >> last & 1 else after
    return Automaton(table, 1 if last else states)


class Backwards:
    """Tables of a stretch of rows for every state: how an attempt ends (``kind``), at which time and place
    (``us``, ``place``), or in which state it leaves the stretch (``state``)."""

    def __init__(self, automaton: Automaton):
        self.automaton = automaton
        self.states = len(automaton.table)

    def empty(self) -> dict[str, np.ndarray]:
        """The table after the last row of a key: every attempt is open."""
        n = self.states
        return {"kind": np.full(n, OPEN, np.int8), "us": np.zeros(n, np.int64), "place": np.zeros(n, np.int64), "state": np.arange(n)}

    def chunks(self, fits: np.ndarray, us: np.ndarray, place: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> dict[str, np.ndarray]:
        """Tables before each row, for rows that stand backwards, as if nothing came after their chunk."""
        n, s = len(fits), self.states
        out = {"kind": np.empty((n, s), np.int8), "us": np.empty((n, s), np.int64), "place": np.empty((n, s), np.int64), "state": np.empty((n, s), np.int64)}
        lanes = np.arange(len(starts))
        later = {name: np.tile(value, (len(starts), 1)) for name, value in self.empty().items()}
        for k in range(int((ends - starts).max(initial=0))):
            lanes = lanes[starts[lanes] + k < ends[lanes]]
            rows = starts[lanes] + k
            after = self.automaton.table.T[fits[rows]]
            accept, dead = after == self.automaton.accept, after == 0
            through = np.where(accept, 0, after)
            for name in later:
                carried = np.take_along_axis(later[name][lanes], through, axis=1)
                if name == "kind":
                    carried = np.where(accept, MATCH, np.where(dead, DEAD, carried))
                elif name != "state":
                    own = (us if name == "us" else place)[rows][:, None]
                    carried = np.where(accept | dead, own, carried)
                out[name][rows] = carried
                later[name][lanes] = carried
        return out

    def compose(self, earlier: dict[str, np.ndarray], later: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        """Tables that leave a stretch open go on with the table of the next one."""
        is_open = earlier["kind"] == OPEN
        return {name: np.where(is_open, later[name][earlier["state"]], earlier[name]) for name in earlier}


_TABLE = "kind array<tinyint>, us array<long>, place array<long>, state array<long>"
_LATER_DDL = f"struct<{_TABLE.replace(' array', ': array')}, after: long>"
_LATER = pa.struct([("kind", pa.list_(pa.int8())), *((n, pa.list_(pa.int64())) for n in ("us", "place", "state")), ("after", pa.int64())])
_NAMES = ("kind", "us", "place", "state")


def fitting_steps(steps: list[Step]) -> Column:
    """The steps whose condition holds for a row, as bits."""
    bits = [F.when(step.where, F.lit(1 << i)).otherwise(F.lit(0)) for i, step in enumerate(steps)]
    return sum(bits[1:], bits[0])


def _group_starts(batch: pa.RecordBatch, names: list[str]) -> np.ndarray:
    """Rows whose key or part is not that of the row before."""
    fresh = np.zeros(batch.num_rows, bool)
    fresh[:1] = True
    for name in names:
        codes = pc.fill_null(batch.column(name).dictionary_encode().indices, -1).to_numpy(zero_copy_only=False)
        fresh[1:] |= codes[1:] != codes[:-1]
    return np.flatnonzero(fresh)


def _reader(automaton: Automaton, keys: list[str], summaries: bool) -> Callable:
    """Reads rows of (key, part) backwards. Yields the outcome of every attempt, or with ``summaries`` the table
    of each part. A row's place is the number of rows of its key (or part) after it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = Backwards(automaton)
        held, later, after = None, tables.empty(), 0  # the group that the last batch ended in, and what follows
        for batch in batches:
            if not batch.num_rows:
                continue
            groups = _group_starts(batch, [*keys, PART])
            ends = np.append(groups[1:], batch.num_rows)
            same = held is not None and all(batch.column(n)[0].as_py() == held.column(n)[0].as_py() for n in [*keys, PART])
            if held is not None and not same and summaries:
                yield _summary(held, later, after, keys)
            given = [None if i == 0 and same else batch.column("_later")[a].as_py() for i, a in enumerate(groups.tolist())]
            base = [after if i == 0 and same else (g["after"] if g else 0) for i, g in enumerate(given)]
            fits, us = batch.column("_fits").to_numpy(), batch.column("_us").to_numpy()
            place = np.arange(batch.num_rows) + np.repeat(np.array(base, np.int64) - groups, ends - groups)
            done = []
            cuts = np.unique(np.concatenate([np.arange(a, b, CHUNK) for a, b in zip(groups, ends)]))
            cut_ends = np.append(cuts[1:], batch.num_rows)
            rows = tables.chunks(fits, us, place, cuts, cut_ends)
            begins = {a: i for i, a in enumerate(groups.tolist())}
            for a, b in zip(cuts.tolist(), cut_ends.tolist()):
                i = begins.get(a)
                if i is not None and not (i == 0 and same):
                    if i and summaries:
                        yield _summary(batch.slice(a - 1, 1), later, int(place[a - 1]) + 1, keys)
                    later = {n: np.array(given[i][n]) for n in _NAMES} if given[i] else tables.empty()
                stretch = tables.compose({k: v[a:b] for k, v in rows.items()}, later)
                done.append(_outcome(automaton, fits[a:b], us[a:b], place[a:b], stretch, later))
                later = {k: v[-1] for k, v in stretch.items()}
            held, after = batch.slice(batch.num_rows - 1, 1), int(place[-1]) + 1
            if not summaries:
                begun, kind, end_us, end_place = (np.concatenate(x) for x in zip(*done))
                picked = batch.select(["_us", "_row"]).filter(pa.array(begun))
                numbers = (kind, end_us, place - end_place - 1)
                yield pa.RecordBatch.from_arrays(
                    [*picked.columns, *(pa.array(x[begun]) for x in numbers)], ["_us", "_row", "_kind", "_endUs", "_between"]
                )
        if held is not None and summaries:
            yield _summary(held, later, after, keys)

    return run


def _outcome(automaton, fits, us, place, stretch, later) -> tuple:
    """Of each row, whether an attempt begins in it, and how that ends: it goes on with the rows after it."""
    begun = fits & 1 == 1
    if automaton.first == automaton.accept:
        return begun, np.full(len(fits), MATCH, np.int8), us, place
    ends = {k: np.vstack((later[k][None], v))[:-1, automaton.first] for k, v in stretch.items()}
    return begun, ends["kind"].astype(np.int8), ends["us"], ends["place"]


def _summary(row: pa.RecordBatch, table: dict[str, np.ndarray], rows: int, keys: list[str]) -> pa.RecordBatch:
    columns = [pa.array([table[n].tolist()], _LATER.field(n).type) for n in _NAMES]
    return pa.RecordBatch.from_arrays(
        [*(row.column(k) for k in [*keys, PART]), *columns, pa.array([rows], pa.int64())], [*keys, PART, *_NAMES, "rows"]
    )


def _fold_later(automaton: Automaton, keys: list[str]) -> Callable:
    """For each part of a key the table of all later parts, and how many rows they have."""

    def fold(key: tuple, parts: pa.Table) -> pa.Table:
        tables = Backwards(automaton)
        later, after, out = tables.empty(), 0, []
        for row in parts.sort_by([(PART, "descending")]).to_pylist():
            out.append({**{k: row[k] for k in [*keys, PART]}, "_later": {**{n: v.tolist() for n, v in later.items()}, "after": after}})
            own = {n: np.array(row[n]) for n in _NAMES}
            own["place"] = own["place"] + after
            later, after = tables.compose(own, later), after + row["rows"]
        return pa.Table.from_pylist(out, parts.select([*keys, PART]).schema.append(pa.field("_later", _LATER)))

    return fold


def match_pattern(
    df: DataFrame,
    keys: list[str],
    ts: str,
    steps: list[Step],
    within: str | None = None,
    ties: list[Column] | None = None,
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """Attempts at ``steps`` that matched or ran out of time: the row that began each, ``outcome`` ('match' or
    'timeout'), ``matchedAt`` (time of the row that completed it) and ``rowsBetween``.

    Rows of a key are read in the order of ``ts`` and then ``ties``. With ``within`` a match ends at most
    that much later than it began; an attempt that is
    still going on when its time is over, or when the data end, is a timeout. Without it attempts that never end are left out. Rows without a time take
    no part, and a condition that is null does not hold. A null key is a key. ``ties`` order rows of one
    time, whose order is otherwise not defined. Hot keys are read in parts (by time).
    """
    automaton = compile_steps(steps)
    named = {f"_tie{i}": c for i, c in enumerate(ties or [])}
    rows = df.where(F.col(ts).isNotNull()).select(
        *keys, F.unix_micros(ts).alias("_us"), fitting_steps(steps).alias("_fits"), F.struct(*df.columns).alias("_row"),
        *(c.alias(name) for name, c in named.items()),
    )
    parts = split_by_position(rows, keys, F.col("_us"), part_rows)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keys).schema.fields)

    def backwards(some: DataFrame) -> DataFrame:
        order = [F.desc(c) for c in ("_us", *named)]
        return some.repartition(*keys, PART).sortWithinPartitions(*keys, PART, *order)

    hot = parts.where(HOT).drop("_row").withColumn("_later", F.lit(None).cast(_LATER_DDL))
    summaries = backwards(hot).mapInArrow(_reader(automaton, keys, True), f"{kinds}, {PART} int, {_TABLE}, rows long")
    folded = summaries.groupBy(*keys).applyInArrow(_fold_later(automaton, keys), f"{kinds}, {PART} int, _later {_LATER_DDL}")
    of_part = folded.withColumnsRenamed({k: f"_of_{k}" for k in [*keys, PART]})
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in [*keys, PART]])
    given = parts.join(of_part, same, "left").drop(*[f"_of_{k}" for k in [*keys, PART]])
    found = backwards(given).mapInArrow(
        _reader(automaton, keys, False), f"_us long, _row {df.schema.simpleString()}, _kind tinyint, _endUs long, _between long"
    )
    is_match = F.col("_kind") == MATCH
    if within is None:
        found = found.where(is_match).withColumn("outcome", F.lit("match"))
    else:
        over = (F.col("_kind") == OPEN) | (F.col("_endUs") > F.col("_us") + micros(within))
        found = found.withColumn("outcome", F.when(over, "timeout").when(is_match, "match")).where(F.col("outcome").isNotNull())
    matched = F.col("outcome") == "match"
    return found.select(
        "_row.*", "outcome", F.when(matched, F.timestamp_micros("_endUs")).alias("matchedAt"), F.when(matched, F.col("_between")).alias("rowsBetween")
    )


def micros(interval: str) -> int:
    """Microseconds of text such as '2 hours'."""
    count, unit = interval.split()
    return int(count) * {"second": 10**6, "minute": 60 * 10**6, "hour": 3600 * 10**6, "day": 86_400 * 10**6}[unit.rstrip("s")]
