"""Document fingerprints by one-permutation MinHash, in DataFrame functions only.

The hashes of a text's five-word shingles are sorted once: the top bits of a hash are its bin, so the
first hash of each bin is the bin's minimum. An empty bin borrows from a donor that is drawn for it at
random, and again until one is filled (optimal densification). Of every bin the low bits are kept and
packed; the share of equal bins, less what equal low bits of different minima add, estimates the
Jaccard similarity of the shingle sets.
"""

from __future__ import annotations

import json
import random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHINGLE_WORDS = 5
BINS, BIN_BITS, LOW_BITS = 128, 7, 8
#: Donors that are tried one after the other before all are looked through.
QUICK_DONORS = 8
#: Ranges of ids per shuffle partition, and the fewest there are; the driver holds one number for each.
RANGES_PER_PARTITION, LEAST_RANGES, FINE = 8, 1024, 256


def _donors(seed: int = 11) -> Column:
    """For every bin the other bins in a random order of its own, so a filled one is always found."""
    rows = []
    for b in range(BINS):
        others = [x for x in range(BINS) if x != b]
        random.Random(seed * BINS + b).shuffle(others)
        rows.append(others)
    return F.from_json(F.lit(json.dumps(rows)), "array<array<int>>")  # folded once per query


def shingle_hashes(words: Column) -> Column:
    """Sorted hashes of five words in a row; of fewer words, the hash of them all."""
    return F.sort_array(
        F.transform(
            F.sequence(F.lit(0), F.greatest(F.size(words) - SHINGLE_WORDS, F.lit(0))),
            lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(SHINGLE_WORDS))),
        )
    )


def _bin(h: Column) -> Column:
    """The top bits, numbered as signed numbers sort."""
    return F.shiftright(h, 64 - BIN_BITS).cast("int") + BINS // 2


def with_values(df: DataFrame, text_col: str, out_col: str) -> DataFrame:
    """Add ``out_col``: the low bits of every bin's minimum or of its donor's, as ``BINS`` numbers.

    Words are what white space separates. A null text is empty; an empty text has one shingle, of no
    words. Every step is a projection of its own, so that nothing is computed twice.
    """
    donors, step = _donors(), f"_{out_col}"
    own = F.col(step)
    empty = F.lit(None).cast("long")

    def gap(h: Column, i: Column) -> Column:
        """A minimum after the nulls of the empty bins between it and the minimum before."""
        before = F.when(i == 0, -1).otherwise(_bin(F.get(own, i - 1)))
        return F.concat(F.array_repeat(empty, _bin(h) - before - 1), F.array(h))

    def filled(value: Column, b: Column) -> Column:
        order = F.get(donors, b)
        quick = [F.get(own, F.get(order, F.lit(k))) for k in range(QUICK_DONORS)]
        whole = F.filter(F.transform(order, lambda d: F.get(own, d)), lambda x: x.isNotNull())
        return F.coalesce(value, *quick, F.get(whole, F.lit(0)))

    low = (1 << LOW_BITS) - 1
    behind = F.array_repeat(empty, BINS - 1 - _bin(F.element_at(own, -1)))
    return (
        df.withColumn(step, F.array_remove(F.split(F.coalesce(F.col(text_col), F.lit("")), r"\s+"), ""))
        .withColumn(step, shingle_hashes(own))
        .withColumn(step, F.filter(own, lambda h, i: (i == 0) | (_bin(h) != _bin(F.get(own, i - 1)))))
        .withColumn(step, F.concat(F.flatten(F.transform(own, gap)), behind))
        .withColumn(step, F.transform(own, filled))
        .withColumn(out_col, F.transform(own, lambda h: h.bitwiseAND(low)))
        .drop(step)
    )


def packed(values: Column) -> Column:
    """The numbers as hexadecimal text, ``LOW_BITS`` bits each."""
    return F.array_join(F.transform(values, lambda h: F.lpad(F.hex(h), LOW_BITS // 4, "0")), "")


def with_fingerprint(df: DataFrame, text_col: str, out_col: str) -> DataFrame:
    """Add ``out_col``: the values of ``with_values`` as hexadecimal text."""
    return with_values(df, text_col, out_col).withColumn(out_col, packed(F.col(out_col)))


def likeness_of_values(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of two arrays of values, 0 to 1; equal ones have 1."""
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda equal: equal))
    chance = 2.0**-LOW_BITS
    return F.greatest((same / BINS - chance) / (1 - chance), F.lit(0.0))


def likeness(a: Column, b: Column) -> Column:
    """The same of two fingerprints in hexadecimal text."""
    values = [F.regexp_extract_all(x, F.lit("." * (LOW_BITS // 4)), F.lit(0)) for x in (a, b)]
    return likeness_of_values(*values)


def dealt_by_range(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(_id, _key, _text, _part, _copy): rows in ranges of ascending id, with the first row of the next range.

    Ranges begin at quantiles of the ids, which a mergeable sketch finds; they are ids of rows, so no
    range is empty, and the row that begins one is known by its id. It is also dealt to the range
    before, the first of all to the last, marked as a copy. Rows without an id come first (with the
    smallest long, if that is an id).
    """
    picked = df.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    wanted = max(LEAST_RANGES, RANGES_PER_PARTITION * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    shares = [k / wanted for k in range(1, wanted)]
    key = F.col("_id").cast("long")
    found = picked.select(
        F.min(key).alias("least"), F.count_if(key.isNull()).alias("nulls"), F.percentile_approx(key, shares, 20 * wanted).alias("cuts")
    ).first()
    least = found["least"] if found["least"] is not None else 0
    below = max(least - 1, -(1 << 63))
    edges = sorted({least, *(found["cuts"] or []), *([below] if found["nulls"] else [])})
    fine = F.from_json(F.lit(json.dumps(edges)), "array<bigint>")
    coarse = F.from_json(F.lit(json.dumps(edges[::FINE])), "array<bigint>")
    keyed = picked.withColumn("_key", F.coalesce(key, F.lit(below).cast("long")))
    own = F.col("_key")
    block = F.size(F.filter(coarse, lambda e: e <= own)) - 1
    keyed = keyed.withColumn("_block", block)
    within = F.size(F.filter(F.slice(fine, F.col("_block") * FINE + 1, F.lit(FINE)), lambda e: e <= own)) - 1
    keyed = keyed.withColumn("_own", F.col("_block") * FINE + within)
    one = lambda part, copy: F.struct(part.cast("int").alias("_part"), F.lit(copy).alias("_copy"))
    before = F.when(F.col("_own") == 0, len(edges) - 1).otherwise(F.col("_own") - 1)
    places = F.when(own == F.get(fine, F.col("_own")), F.array(one(F.col("_own"), False), one(before, True))).otherwise(
        F.array(one(F.col("_own"), False))
    )
    return keyed.select("_id", "_key", "_text", F.inline(places))


def edited_texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every text, and the text whose last quarter is replaced by as much of the next document's start.

    The last document's next is the first. Rows of one id follow each other by text. Copies stay in.
    One shuffle of the texts.
    """
    in_order = Window.partitionBy("_part").orderBy("_copy", "_key", "_text")
    return (
        dealt_by_range(df, id_col, text_col)
        .withColumn("_next", F.coalesce(F.lead("_text").over(in_order), F.lit("")))
        .withColumn("_chars", F.char_length("_text"))
        .withColumn("_cut", F.floor(F.col("_chars") / 4).cast("int"))
        .withColumn(
            "_edited",
            F.concat(
                F.substr(F.col("_text"), F.lit(1), F.col("_chars") - F.col("_cut")),
                F.substr(F.col("_next"), F.lit(1), F.col("_cut")),
            ),
        )
        .drop("_next", "_cut")
    )


def op6_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness to each other and the next.

    A null text is empty. Repeated or null ids each give their row; a single row is its own next.
    """
    marked = with_values(edited_texts(docs), "_text", "_values")
    marked = marked.withColumn("_sha", F.sha2(F.col("_edited").cast("binary"), 256))
    marked = with_values(marked, "_edited", "_edited_values").drop("_edited")
    in_order = Window.partitionBy("_part").orderBy("_copy", "_key", "_text")
    marked = marked.withColumn("_following", F.lead("_values").over(in_order)).where(~F.col("_copy"))
    return marked.select(
        F.col("_id").alias("doc_id"),
        F.col("_chars").cast("long").alias("n_chars"),
        F.col("_sha").alias("edited_sha256"),
        packed(F.col("_values")).alias("fingerprint"),
        packed(F.col("_edited_values")).alias("edited_fingerprint"),
        likeness_of_values(F.col("_values"), F.col("_edited_values")).alias("near_edited"),
        likeness_of_values(F.col("_values"), F.col("_following")).alias("near_next"),
    )
