"""Splitting of hot keys.

One key may hold a large share of all rows, so work that is ordered or joined by key must not put a
whole key in one task. ``hot_keys`` finds the keys with many rows by a map-side combined count
(only the key columns are read); a null key counts like any other. A list has no more keys than there
are rows for each ``part_rows``; above ``MAX_HOT_KEYS`` the largest are taken, which bounds the
broadcast (a few numbers per key, some MB), and a key left off holds less than 1/MAX_HOT_KEYS of all
rows, no more than an even share of that many tasks. The list only decides how rows are spread over
tasks, never which rows are in the result.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_HOT_KEYS = 1 << 17
#: A key with more rows than this is split into parts of about this size.
PART_ROWS = 1_000_000

#: Frequent-item sketches: how many, and how many keys each follows and at most returns (half of them).
SKETCHES, SKETCH_KEYS = 64, 4096

PART = "_part"
HOT = "_hot"


def hot_keys(
    df: DataFrame, keys: list[str], part_rows: int, position: Column | None = None
) -> DataFrame:
    """The keys above ``part_rows`` rows with their number of parts (and range of ``position``)."""
    wanted = [F.col(k) for k in keys]
    stats = [F.count(F.lit(1)).alias("_rows")]
    if position is not None:
        wanted.append(position.alias("_at"))
        stats += [F.min("_at").alias("_lo"), F.max("_at").alias("_hi")]
    found = (
        df.select(*wanted)
        .groupBy(*keys)
        .agg(*stats)
        .filter(F.col("_rows") > part_rows)
        .orderBy(F.desc("_rows"), *keys)
        .limit(MAX_HOT_KEYS)
    )
    spread = ["_lo", "_hi"] if position is not None else []
    return found.select(*keys, F.ceil(F.col("_rows") / part_rows).alias("_parts"), *spread)


def hot_keys_by_sketch(df: DataFrame, keys: list[str], part_rows: int) -> DataFrame:
    """The list of ``hot_keys`` for keys that nearly all differ, without a shuffle of them.

    Frequent-item sketches of key hashes, ``SKETCHES`` per task whatever its rows, name the candidates, and only rows of
    candidates are counted exactly. A sketch overrates a key but never underrates it. It leaves off at most
    keys that hold less than about 1/1,000 of the rows of their sketch, 1/64,000 of all rows.
    """
    tag = F.xxhash64(*keys)
    tagged = df.select(*keys, tag.alias("_tag"))
    tops = tagged.groupBy(F.pmod("_tag", F.lit(SKETCHES)).alias("_sketch")).agg(
        F.expr(f"approx_top_k(_tag, {SKETCH_KEYS // 2}, {SKETCH_KEYS})").alias("_tops")
    )
    top = tops.select(F.explode("_tops").alias("_top")).where(F.col("_top.count") > part_rows)
    candidates = top.select(F.col("_top.item").alias("_tag"))
    counted = tagged.join(F.broadcast(candidates), "_tag", "left_semi").groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    return hot_keys_of(counted, keys, "_rows", part_rows)


def hot_keys_of(
    counts: DataFrame, keys: list[str], rows: str, part_rows: int = PART_ROWS
) -> DataFrame:
    """The same list from an existing table of row counts (column ``rows``) per key."""
    top = counts.filter(F.col(rows) > part_rows).orderBy(F.desc(rows), *keys).limit(MAX_HOT_KEYS)
    return top.select(*keys, F.ceil(F.col(rows) / part_rows).alias("_parts"))


def with_hot(df: DataFrame, hot: DataFrame, keys: list[str]) -> DataFrame:
    """Left join with a hot list, in which null keys match null keys."""
    named = hot.withColumnsRenamed({k: f"_key_{k}" for k in keys})
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys])
    return df.join(F.broadcast(named), same, "left").drop(*[f"_key_{k}" for k in keys])


def split_by_position(
    df: DataFrame, keys: list[str], position: Column, part_rows: int = PART_ROWS
) -> DataFrame:
    """Add ``_part``: 0 for ordinary keys, consecutive ranges of ``position`` for hot keys.

    Rows with equal position stay together, and a later part holds later positions only.
    """
    hot = hot_keys(df, keys, part_rows, position)
    # Rows without a position stay in the first part, where their order puts them.
    share = (position - F.col("_lo")) / (F.col("_hi") - F.col("_lo") + F.lit(1)).cast("double")
    part = F.when(share.isNotNull(), F.least(F.floor(share * F.col("_parts")), F.col("_parts") - 1))
    return (
        with_hot(df, hot, keys)
        .withColumn(HOT, F.col("_parts").isNotNull())
        .withColumn(PART, F.coalesce(part, F.lit(0)).cast("int"))
        .drop("_parts", "_lo", "_hi")
    )


def salted_join(
    big: DataFrame,
    small: DataFrame,
    keys: list[str],
    salt_on: list[str],
    how: str = "inner",
    part_rows: int = PART_ROWS,
    hot: DataFrame | None = None,
    hint: str | None = None,
) -> DataFrame:
    """Join on ``keys`` where ``small`` has at most one row per key and ``big`` may have hot keys.

    Rows of a hot key are spread over parts by a hash of ``salt_on``; the one matching row of
    ``small`` is repeated for each part. ``how`` is inner or left; ``hint`` is a join hint for the
    last join, whose size Spark may misjudge after an explode.
    """
    hot = hot_keys(big, keys, part_rows) if hot is None else hot
    spread = (
        with_hot(big, hot, keys)
        .withColumn(
            PART,
            F.coalesce(F.pmod(F.xxhash64(*salt_on), F.col("_parts")), F.lit(0)).cast("int"),
        )
        .drop("_parts")
    )
    repeated = (
        small.join(F.broadcast(hot), keys, "left")
        .withColumn(
            PART,
            F.explode(F.sequence(F.lit(0), (F.coalesce("_parts", F.lit(1)) - 1).cast("int"))),
        )
        .drop("_parts")
    )
    if hint:
        repeated = repeated.hint(hint)
    return spread.join(repeated, [*keys, PART], how).drop(PART)
