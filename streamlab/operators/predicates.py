"""User predicates: SQL conditions that arrive as data.

What a predicate may do is decided on its analysed tree, not on its words: every node must be on a list
of repeatable expressions. Many predicates are evaluated by one decision tree over their texts, so a
row passes about log2(n) comparisons to find its own.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamlab.functions.sql import register_functions
from streamlab.schemas import RIDE_COLUMNS

#: Nodes of an analysed predicate: columns and values, logic, comparison, arithmetic, text, time.
ALLOWED = set(
    "AttributeReference Literal Alias Cast GetStructField CreateNamedStruct SQLScalarFunction OuterReference "
    "And Or Not If CaseWhen Coalesce IsNull IsNotNull IsNaN NaNvl NullIf Nvl "
    "EqualTo EqualNullSafe LessThan LessThanOrEqual GreaterThan GreaterThanOrEqual Between In InSet Greatest Least "
    "With CommonExpressionDef CommonExpressionRef CommonExpressionId "
    "Add Subtract Multiply Divide IntegralDivide Remainder Pmod UnaryMinus UnaryPositive Abs Sqrt Pow Exp Log Floor Ceil Round "
    "CeilExpressionBuilder FloorExpressionBuilder Sin Cos Tan Asin Acos Atan Atan2 ToRadians ToDegrees Signum "
    "BitwiseAnd BitwiseOr BitwiseXor BitwiseNot "
    "Upper Lower Length Concat Substring StringTrim Like RLike StartsWith EndsWith Contains "
    "Extract Year Month DayOfMonth DayOfWeek WeekDay Hour Minute Second DateAdd DateSub DateDiff TimestampAddInterval TimeAdd "
    "SubtractTimestamps TruncTimestamp UnixMillis UnixMicros UnixSeconds "
    "Project LogicalRDD LocalRelation GlobalLimit LocalLimit SubqueryAlias OneRowRelation".split()
)


REGISTERED = "spark.streamlab.functionsRegistered"


def predicate_scope(rides: DataFrame, watermark_ms: Column) -> DataFrame:
    """Rides with the names a predicate may use: the columns, ``ride`` (a struct of them), the
    distance to a point as ``rideDistance(ride, lon, lat)`` and ``watermark`` (epoch ms)."""
    spark = rides.sparkSession
    if spark.conf.get(REGISTERED, "") != "true":  # once per session
        register_functions(spark)
        spark.conf.set(REGISTERED, "true")
    ride = F.struct(*RIDE_COLUMNS)
    return rides.withColumn("ride", ride).withColumn("watermark", watermark_ms)


def _nodes(tree: object) -> set[str]:
    """Class names of a plan's JSON, without their packages."""
    if isinstance(tree, list):
        return set().union(*map(_nodes, tree))
    if not isinstance(tree, dict):
        return set()
    own = {tree["class"].rsplit(".", 1)[-1].rstrip("$")} if "class" in tree else set()
    return own.union(*map(_nodes, tree.values()))


def check_predicates(scope: DataFrame, predicates: list[str]) -> None:
    """Refuse what is not a repeatable condition on a ride: a predicate must be BOOLEAN, and its analysed
    tree must hold allowed nodes only (no random numbers, clocks, queries, aggregates or foreign calls).
    All are analysed together, and one by one only to say which is at fault."""
    if not predicates:
        return
    empty = scope.sparkSession.createDataFrame([], scope.schema)
    try:
        found = empty.select(*[F.expr(text).alias(f"_p{i}") for i, text in enumerate(predicates)])
        kinds = {field.dataType.simpleString() for field in found.schema.fields}
        nodes = _nodes(json.loads(found._jdf.queryExecution().analyzed().toJSON()))
    except Exception as exc:
        if len(predicates) > 1:
            for text in predicates:
                check_predicates(scope, [text])
        raise ValueError(f"not a condition on a ride: {predicates[0]}: {exc}") from exc
    refused = sorted(nodes - ALLOWED)
    if not refused and kinds <= {"boolean", "void"}:
        return
    if len(predicates) > 1:
        for text in predicates:
            check_predicates(scope, [text])
    if refused:
        raise ValueError(f"a predicate must not use {', '.join(refused)}: {predicates[0]}")
    raise ValueError(f"a predicate must be BOOLEAN, not {', '.join(sorted(kinds))}: {predicates[0]}")


def one_of(predicates: list[str], text: Column) -> Column:
    """The value of the predicate whose text stands in ``text``; false if it is none of them."""
    predicates = sorted(set(predicates), key=lambda p: p.encode())

    def choose(lo: int, hi: int) -> Column:
        if hi - lo == 1:
            return F.when(text == F.lit(predicates[lo]), F.coalesce(F.expr(predicates[lo]).cast("boolean"), F.lit(False))).otherwise(F.lit(False))
        middle = (lo + hi) // 2
        return F.when(text < F.lit(predicates[middle]), choose(lo, middle)).otherwise(choose(middle, hi))

    return choose(0, len(predicates)) if predicates else F.lit(False)


def distinct_predicates(controls: DataFrame, most: int = 10_000) -> list[str]:
    """The different texts, which become part of the plan; more than ``most`` are an error, not a cut."""
    found = [r[0] for r in controls.where("predicate IS NOT NULL").select("predicate").distinct().limit(most + 1).collect()]
    if len(found) > most:
        raise ValueError(f"more than {most} different predicates at a time")
    return sorted(found)
