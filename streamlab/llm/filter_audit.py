"""How filters interact: what each of them removes at each place of every order.

A document's failures are a mask of five bits. Documents of one part, mask and pair of labels form a
cell, of which a part has at most 128. Each cell folds over all 120 orders with ``transform`` and
``aggregate``, which gives 600 structs weighted by its documents, and the cells of a part merge by
elementwise sums. Everything is DataFrame functions.
"""

from __future__ import annotations

from functools import reduce
from itertools import permutations
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from streamlab.plans.hotkeys import PART_ROWS, hot_keys_of, salted_join
from streamlab.plans.lineage import cut_lineage

FILTERS = "ABCDE"
#: The Java pattern of white space between words.
SPACE = "[\\x20\\x09-\\x0D]+"
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def text_failures(text: Column) -> Column:
    """Bits 0 to 3: too few words, too few different words, too many capitals, a marked character."""
    words = F.filter(F.split(text, SPACE), lambda w: w != "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.char_length(F.regexp_replace(text, "[^A-Z]+", ""))
    tests = (
        n < 200,
        100 * distinct.cast("long") < 50 * n.cast("long"),
        100 * capitals.cast("long") > 3 * F.char_length(text).cast("long"),
        text.rlike("[#$%&*|]"),
    )
    return reduce(or_bits, [test.cast("int") * (1 << bit) for bit, test in enumerate(tests)])


def or_bits(a: Column, b: Column) -> Column:
    return a.bitwiseOR(b)


def _label(labels: DataFrame, name: str) -> Column:
    return F.max(F.coalesce((F.col(name) == 1).cast("int"), F.lit(0))).alias(f"_{name}")


def failing_cells(documents: DataFrame, labels: DataFrame, part_rows: int = PART_ROWS) -> DataFrame:
    """(part, mask, good, toxic, n): the documents of each cell.

    Whether a text was seen before is decided by SHA-256, so only digests are shuffled; the digests of
    frequent texts are dealt in parts.
    """
    text = F.coalesce("text", F.lit(""))
    facts = documents.select(
        F.col("doc_id").cast("long").alias("id"),
        F.coalesce("lang", F.lit("")).alias("part"),
        text_failures(text).alias("mask"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
    )
    facts = cut_lineage(facts, "failures")
    firsts = facts.groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("copies"))
    firsts = cut_lineage(firsts.where("copies > 1"), "repeated-texts")
    hot = hot_keys_of(firsts, ["digest"], "copies", part_rows)
    seen = salted_join(facts, firsts.drop("copies"), ["digest"], ["id"], "left", hot=hot)
    again = F.coalesce(F.col("id") > F.col("first"), F.lit(False)).cast("int") * (1 << FILTERS.index("E"))
    masks = seen.select("id", "part", or_bits(F.col("mask"), again).alias("mask"))
    # Repeated rows are counted together before the join; rows without an id have no label and are spread.
    masks = masks.groupBy("id", "part", "mask").agg(F.count(F.lit(1)).alias("n"))
    marked = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("id")).agg(
        _label(labels, "quality"), _label(labels, "toxic")
    )
    known = masks.join(marked, "id", "left")
    return known.groupBy(
        "part", "mask", F.coalesce("_quality", F.lit(0)).alias("good"), F.coalesce("_toxic", F.lit(0)).alias("toxic")
    ).agg(F.sum("n").alias("n"))


def fold_orders(orders: Column, mask: Column, n: Column, good: Column, toxic: Column) -> Column:
    """600 structs for one cell: its documents at every step of every order."""
    zero = F.lit(0).cast("long")
    steps = ", ".join(f"{name}: bigint" for name in COUNTS)
    nothing = F.array().cast(f"array<struct<{steps}>>")

    def step(state: Column, bit: Column) -> Column:
        alive = state["alive"]
        fails = F.call_function("getbit", mask, bit) == 1
        only = mask == F.call_function("shiftleft", F.lit(1), bit)
        removed = F.when(alive & fails, n).otherwise(zero)
        row = F.struct(
            F.when(alive & ~fails, n).otherwise(zero).alias("kept"),
            removed.alias("removed"),
            F.when(~alive & fails, n).otherwise(zero).alias("redundant"),
            F.when(only, n).otherwise(zero).alias("unique_fails"),
            (removed * good).alias("good_lost"),
            (removed * toxic).alias("toxic_lost"),
        )
        return F.struct((alive & ~fails).alias("alive"), F.concat(state["rows"], F.array(row)).alias("rows"))

    begin = F.struct(F.lit(True).alias("alive"), nothing.alias("rows"))
    return F.flatten(F.transform(orders, lambda order: F.aggregate(order, begin, step, lambda s: s["rows"])))


def filter_audit(documents: DataFrame, labels: DataFrame, part_rows: int = PART_ROWS) -> DataFrame:
    """One row per part (``lang``), order of the filters and step, with counts of documents.

    A null text is empty; a null ``lang`` and an empty one are one part, the empty string. A document
    fails E if any row has its text and a smaller id; a row without an id neither fails E nor makes
    others fail it, and has no labels. Rows that repeat an id are documents of their own, and of labels
    that repeat an id a single 1 counts. White-space-only texts have no words. No documents give no rows. Other
    columns are left out. Documents are only counted here: nothing is removed.
    """
    cells = failing_cells(documents, labels, part_rows)
    every = list(permutations(range(len(FILTERS))))
    orders = F.lit([list(order) for order in every])
    c = F.col
    folded = cells.select(
        "part",
        fold_orders(orders, c("mask"), c("n"), c("good").cast("long"), c("toxic").cast("long")).alias("rows"),
    )

    def plus(a: Column, b: Column) -> Column:
        return F.struct(*((a[name] + b[name]).alias(name) for name in COUNTS))

    # At most 32 masks times 4 pairs of labels meet in a part.
    merged = folded.groupBy("part").agg(F.collect_list("rows").alias("cells")).select(
        "part",
        F.aggregate(
            F.slice("cells", 2, 1 << len(FILTERS) + 2), c("cells")[0], lambda total, rows: F.zip_with(total, rows, plus)
        ).alias("rows"),
    )
    names = F.lit(["".join(FILTERS[bit] for bit in order) for order in every])
    size = len(FILTERS)
    rows = merged.select("part", F.posexplode("rows").alias("place", "row")).select(
        "part",
        F.element_at(names, (c("place") / size).cast("int") + 1).alias("filter_order"),
        (c("place") % size + 1).cast("int").alias("step"),
        *(c("row")[name].alias(name) for name in COUNTS),
    )
    letter = Window.partitionBy("part", F.substring("filter_order", c("step"), F.lit(1)))
    return rows.withColumn("shapley", F.sum("removed").over(letter))


ORACLE = """
WITH t AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words
  FROM documents
), f AS (
  SELECT doc_id, part, [
    len(words) < 200,
    100 * len(list_distinct(words)) < 50 * len(words),
    100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text),
    regexp_matches(text, '[#$%&*|]'),
    coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)] AS fails
  FROM t
), m AS (
  SELECT doc_id, bool_or(quality IS NOT DISTINCT FROM 1) AS good, bool_or(toxic IS NOT DISTINCT FROM 1) AS toxic FROM labels GROUP BY doc_id
), d AS (
  SELECT f.part, f.fails, coalesce(m.good, false) AS good, coalesce(m.toxic, false) AS toxic, count(*) AS n
  FROM f LEFT JOIN m ON f.doc_id = m.doc_id GROUP BY ALL
), l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x), o AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM l a, l b, l c, l d, l e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), s AS (
  SELECT o.filter_order, k.step, d.part, d.n, d.good, d.toxic, filter_order[k.step] AS letter,
    fails[ascii(filter_order[k.step]) - 64] AS fail,
    len(list_filter(range(1, k.step), lambda i: fails[ascii(filter_order[i]) - 64])) > 0 AS gone,
    len(list_filter(fails, lambda x: x)) = 1 AS alone
  FROM o, (SELECT unnest(range(1, 6)) AS step) k, d
), g AS (
  SELECT part, filter_order, step::INTEGER AS step, any_value(letter) AS letter,
    sum(CASE WHEN NOT fail AND NOT gone THEN n ELSE 0 END)::BIGINT AS kept,
    sum(CASE WHEN fail AND NOT gone THEN n ELSE 0 END)::BIGINT AS removed,
    sum(CASE WHEN fail AND gone THEN n ELSE 0 END)::BIGINT AS redundant,
    sum(CASE WHEN fail AND alone THEN n ELSE 0 END)::BIGINT AS unique_fails,
    sum(CASE WHEN fail AND NOT gone AND good THEN n ELSE 0 END)::BIGINT AS good_lost,
    sum(CASE WHEN fail AND NOT gone AND toxic THEN n ELSE 0 END)::BIGINT AS toxic_lost
  FROM s GROUP BY part, filter_order, step
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley
FROM g
"""


def op13_audit(documents: DataFrame, labels: DataFrame) -> DataFrame:
    return filter_audit(documents, labels)
