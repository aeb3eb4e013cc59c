"""Running computations per key (counts, sums, minima, last values) that survive hot keys.

The rows of a key are read in order by ordinary window functions inside one part of the key
(``split_by_position``). What happened in the other parts arrives as a carry: one summary row per
part of a hot key, folded over the earlier parts. Ordinary keys have one part and no carry, so they
cost one shuffle and one sort, the same as a plain window.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from streamlab.plans.hotkeys import HOT, PART

_FOLDS: dict[str, Callable[[str], Column]] = {
    "sum": lambda name: F.sum(name),
    "min": lambda name: F.min(name),
    "max": lambda name: F.max(name),
    "last": lambda name: F.last(name, ignorenulls=True),
}


@dataclass(frozen=True)
class Carry:
    """``summary`` aggregates one part; ``fold`` combines the summaries of the parts before it."""

    summary: Column
    fold: str


def part_window(keys: list[str], *order: Column) -> WindowSpec:
    return Window.partitionBy(*keys, PART).orderBy(*order)


def with_carries(
    local: DataFrame,
    rows: DataFrame,
    keys: list[str],
    carries: dict[str, Carry],
    backwards: bool = False,
) -> DataFrame:
    """Join the carry columns to ``local``; they are null where no earlier part exists.

    ``rows`` are the part-numbered rows to summarise. With ``backwards`` the later parts are folded.
    """
    order = F.desc(PART) if backwards else F.asc(PART)
    before = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    summaries = (
        rows.filter(HOT)
        .groupBy(*keys, PART)
        .agg(*[carry.summary.alias(name) for name, carry in carries.items()])
    )
    folded = summaries.select(
        *keys, PART, *[_FOLDS[c.fold](name).over(before).alias(name) for name, c in carries.items()]
    )
    named = folded.withColumnsRenamed({k: f"_of_{k}" for k in [*keys, PART]})
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys])
    joined = local.join(named, same & (F.col(PART) == F.col(f"_of_{PART}")), "left")
    return joined.drop(*[f"_of_{k}" for k in [*keys, PART]])


def drop_parts(df: DataFrame) -> DataFrame:
    return df.drop(PART, HOT)
