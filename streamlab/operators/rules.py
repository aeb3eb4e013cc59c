"""Two-step sequence rules matched per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from streamlab.plans.hotkeys import PART_ROWS, split_by_position
from streamlab.plans.scans import Carry, part_window, with_carries


def match_sequence_rules(
    items: DataFrame,
    rules: DataFrame,
    key: str,
    shape: str = "shape",
    order: str = "seq",
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """Pairs (first item, second item) of ``rules(rule, first, second)`` per key.

    A second item closes every first item that is still pending, so each first item pairs with
    exactly the next second item after it: a forward as-of lookup, with no pairs to search. ``order``
    is a BIGINT that is unique per key. Output: rule, key, firstSeq, secondSeq and both items.
    """
    roles = (
        rules.select(
            "rule",
            F.explode(
                F.array(
                    F.struct(
                        F.col("first").alias(shape), F.lit(1).alias("_f"), F.lit(0).alias("_s")
                    ),
                    F.struct(
                        F.col("second").alias(shape), F.lit(0).alias("_f"), F.lit(1).alias("_s")
                    ),
                )
            ).alias("r"),
        )
        .select("rule", "r.*")
        .groupBy("rule", shape)
        .agg(F.max("_f").alias("_first"), F.max("_s").alias("_second"))
    )
    item = F.struct(*items.columns)
    tagged = items.join(roles, shape).select(
        key, "rule", order, "_first", "_second", item.alias("_item")
    )
    rows = split_by_position(tagged, [key, "rule"], F.col(order), part_rows)
    closing = F.when(F.col("_second") == 1, F.col("_item"))
    after = part_window([key, "rule"], F.col(order)).rowsBetween(1, Window.unboundedFollowing)
    local = rows.withColumn("_next", F.first(closing, ignorenulls=True).over(after)).filter(
        "_first = 1"
    )
    earliest = F.min_by("_item", F.when(F.col("_second") == 1, F.col(order)))
    found = with_carries(
        local, rows, [key, "rule"], {"_later": Carry(earliest, "last")}, backwards=True
    )
    return (
        found.withColumn("_close", F.coalesce("_next", "_later"))
        .filter("_close IS NOT NULL")
        .select(
            "rule",
            key,
            F.col(order).alias("firstSeq"),
            F.col(f"_close.{order}").alias("secondSeq"),
            F.col("_item").alias("firstItem"),
            F.col("_close").alias("secondItem"),
        )
    )
