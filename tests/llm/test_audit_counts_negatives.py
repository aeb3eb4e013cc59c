"""Hard negatives, token counts and the filter audit against brute force, and on odd input."""

from __future__ import annotations

import math
import random
from collections import Counter
from itertools import permutations

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from streamlab.llm import filter_audit, hard_negatives, token_counts
from streamlab.llm.queries import BYTE_VOCABULARY, vocabulary_path

VECTORS = "vec_id long, embedding array<double>, label int, id long, codes int, block int, part string"
DOCS = "doc_id long, text string, lang string, id long, mask int, n long, digest string, first int, good int"
LABELS = "doc_id long, quality int, toxic int, id long"


# -- hard negatives


def test_strassen_is_the_plain_product():
    rng = np.random.default_rng(1)
    for m, k, n in [(1, 1, 1), (17, 33, 65), (64, 64, 64), (100, 3, 7), (31, 130, 18), (0, 5, 4), (5, 0, 4)]:
        a, b = rng.integers(-(1 << 28), 1 << 28, (m, k)), rng.integers(-(1 << 28), 1 << 28, (k, n))
        assert (hard_negatives.strassen(a, b) == a @ b).all()


def test_heaps_of_tiles_merge():
    rng = np.random.default_rng(2)
    scores, rows = rng.integers(-4, 4, (3, 60)), np.arange(60) * 2
    whole, parts = hard_negatives.Heaps(5), hard_negatives.Heaps(5)
    whole.push_tile([0, 1, 2], scores, rows)
    for lo in (40, 0, 20):
        parts.push_tile([0, 1, 2], scores[:, lo : lo + 20], rows[lo : lo + 20])
    expected = {(k, int(rows[j]), int(scores[k, j])) for k in range(3) for j in np.lexsort((rows, -scores[k]))[:5]}
    assert set(whole.rows()) == set(parts.rows()) == expected


def plain_negatives(rows, every=50):
    """rows: (id, label, vector) that take part, one per id."""
    coded = {i: (label, [math.floor(256 * x) for x in v]) for i, label, v in rows}
    out = []
    for a, (label, v) in coded.items():
        if a % every:
            continue
        score = {b: sum(x * y for x, y in zip(v, w)) for b, (_, w) in coded.items() if b != a}
        ranked = sorted(score, key=lambda b: (-score[b], b))
        for p in [b for b in ranked if coded[b][0] == label][:5]:
            fits = [b for b in ranked if coded[b][0] != label and 50 * score[p] <= 100 * score[b] <= 95 * score[p]]
            out += [(a, p, k + 1, b, score[p], score[b]) for k, b in enumerate(fits[:3])]
    return sorted(out)


@pytest.fixture
def small_blocks(monkeypatch):
    for name, value in {"ANCHORS": 4, "CANDIDATES": 40, "TILE_ANCHORS": 3, "TILE_CANDIDATES": 16}.items():
        monkeypatch.setattr(hard_negatives, name, value)


def test_negatives_match_brute_force_with_ties(spark, small_blocks):
    rng = random.Random(5)
    rows = [(i, rng.randrange(3), [rng.choice([-0.5, 0.0, 0.25, 1.0]) for _ in range(19)]) for i in range(-60, 300)]
    rows += [(1000 + i, i % 3, [0.25] * 19) for i in range(200)]  # equal vectors: ties by id
    frame = spark.createDataFrame([(i, v, c, 1, 2, 3, "p") for i, c, v in rows], VECTORS).repartition(5)
    got = hard_negatives.hard_negatives(frame, F.col("id") % 10 == 0)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    expected = plain_negatives(rows, 10)
    assert len(expected) > 100
    assert sorted(map(tuple, got.collect())) == expected


def test_negatives_of_odd_vectors(spark, small_blocks):
    good = [(i, i % 2, [1.0 + i / 100, 0.5]) for i in range(0, 40)]
    bad = [
        (None, [1.0, 1.0], 1), (100, None, 1), (150, [1.0, 1.0], None), (200, [1.0, None], 1), (250, [float("nan"), 1.0], 0),
        (300, [float("inf"), 1.0], 0), (350, [1e300, 1.0], 0), (400, [1.0], 0), (450, [], 1),
    ]
    all_rows = [(i, v, c) for i, c, v in good] + bad + [(0, [9.0, 9.0], 1), (0, [1.0, 0.5], 0), (7, [1.07, 0.5], 1)]
    frame = spark.createDataFrame([(i, v, c, 1, 2, 3, "p") for i, v, c in all_rows], VECTORS)
    got = sorted(map(tuple, hard_negatives.hard_negatives(frame).collect()))
    assert got == plain_negatives(good)
    assert hard_negatives.op11_negatives(frame).count() >= 0
    assert hard_negatives.hard_negatives(frame.limit(0)).collect() == []
    floats = frame.withColumn("embedding", F.col("embedding").cast("array<float>"))
    assert hard_negatives.hard_negatives(floats).count() >= 0


# -- token counts


@pytest.fixture(scope="module")
def path():
    pytest.importorskip("tokenizers")
    return vocabulary_path(BYTE_VOCABULARY)


def odd_texts():
    rng = random.Random(7)
    alphabet = list(" \n\t\r'sdm1²é漢🙂ß.,-!a\x1c\x85\xa0 ​́ǅ٣Ⅷ؀अ")
    random_texts = ["".join(rng.choices(alphabet, k=rng.randrange(1, 60))) for _ in range(300)]
    return random_texts + [
        "", None, "one two  three", "<|endoftext|>", "a <|endoftext|>  <|endoftext|>b\n", "<|endoftext", "x" * 50_000, " " * 9_000 + "y",
        "don't can't  we'll 's 's'S", "word " * 40_000, "é漢字🙂" * 400, "12 345 6789\n\n\n  tail  ",
    ]


def test_counts_equal_the_library(spark, path, monkeypatch):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    monkeypatch.setattr(token_counts, "LONG_CHARS", 100_000)
    texts = odd_texts()
    rows = [(i if i % 9 else None, t, "en", 1, 2, 3, "d", 4, 5) for i, t in enumerate(texts)] * 2
    frame = spark.createDataFrame(rows, DOCS).repartition(3)
    got = token_counts.token_counts(frame, path, most=50)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    expected = Counter()
    for i, t in enumerate(texts):
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        expected[(i if i % 9 else None, len((t or "").encode()), n, n > 512)] += 2
    assert Counter(map(tuple, got.collect())) == expected
    assert token_counts.token_counts(frame.limit(0), path).collect() == []
    nulls = frame.withColumn("text", F.lit(None).cast("string"))
    assert {r["n_tokens"] for r in token_counts.token_counts(nulls, path).collect()} == {0}


def test_numpy_cuts_like_the_library(path):
    own = token_counts.Rules(token_counts.read_rules(path))
    texts = [t for t in odd_texts() if t and own.is_plain(t)]
    rng = random.Random(8)
    texts += ["".join(rng.choices(" \n'stmdrevlSA1²é!", k=rng.randrange(1, 12))) for _ in range(5_000)]
    assert len(texts) > 5_000
    pieces = token_counts.cut(texts)
    for i, text in enumerate(texts):
        got = [pieces.different[k] for k in pieces.at[pieces.firsts[i] : pieces.firsts[i + 1]]]
        assert got == [text[a:b] for _, (a, b) in own.library.pre_tokenizer.pre_tokenize_str(text)]


def test_equal_hashes_of_different_pieces_change_nothing(path, monkeypatch):
    rules = token_counts.read_rules(path)
    texts = ["ab\nba\nabba", "", "some words of a text"]
    expected = token_counts.Lengths(rules).of_texts(texts).tolist()
    monkeypatch.setattr(token_counts, "WEIGHTS", np.ones(token_counts.HASHED, np.uint64))
    assert token_counts.cut(texts) is None
    assert token_counts.Lengths(rules).of_texts(texts).tolist() == expected


def test_both_tiers_answer_and_the_cache_is_bounded(path, monkeypatch):
    rules = token_counts.read_rules(path)
    table = token_counts.frequent_table([" the", "漢字", "x"], rules).table()
    lengths = token_counts.Lengths(rules, table)
    assert table == {" the": 1, "漢字": len(lengths.rules.library.encode("漢字").ids), "x": 1}
    monkeypatch.setattr(token_counts, "CACHE_PIECES", 3)
    assert lengths.of_text("x the the x") == 4 and lengths.encoded == 1
    lengths.of_text("one two three four five six")
    assert lengths.of_text(" six") == 1 and lengths.encoded == 7
    assert len(lengths.young) <= 3 and len(lengths.old) <= 3 and lengths.frequent == table


def test_frequent_pieces_are_those_of_all_texts(spark, path, monkeypatch):
    monkeypatch.setattr(token_counts, "LEVELS", (3, 1))
    rows = [(i, "often " * 50 + f"rare{i} ", "en", 1, 2, 3, "d", 4, 5) for i in range(200)] + [(1, "now and again؀", "en", 1, 2, 3, "d", 4, 5)] * 40
    rules = spark.sparkContext.broadcast(token_counts.read_rules(path))
    frame = spark.createDataFrame(rows, DOCS).repartition(7)
    assert token_counts.frequent_pieces(frame, rules, most=1) == [" often"]
    assert " again" in token_counts.frequent_pieces(frame, rules, most=900)
    assert token_counts.frequent_pieces(frame.limit(0), rules) == []


def test_summaries_keep_what_is_frequent():
    rng = random.Random(4)
    stream = ["a"] * 400 + ["b"] * 300 + [f"r{i}" for i in range(900)]
    rng.shuffle(stream)
    counts = Counter()
    for lo in range(0, len(stream), 50):
        counts.update(stream[lo : lo + 50])
        counts = token_counts.thin_out(counts, 8)
        assert len(counts) <= 8
    assert [p for p, _ in counts.most_common(2)] == ["a", "b"]


# -- filter audit


def plain_audit(docs, labels):
    """docs: (id, text, lang); labels: (id, quality, toxic)."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    first: dict[str, int] = {}
    for i, t, _ in docs:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    out: Counter = Counter()
    parts = {lang or "" for _, _, lang in docs}
    for i, t, lang in docs:
        t, part = t or "", lang or ""
        words = [w for w in t.translate({c: " " for c in (9, 10, 11, 12, 13)}).split(" ") if w]
        fails = {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in t) > 3 * len(t), "D": any(c in "#$%&*|" for c in t),
            "E": i is not None and i > first.get(t, i),
        }
        for order in permutations("ABCDE"):
            alive = True
            for step, f in enumerate(order, 1):
                key = (part, "".join(order), step)
                out[key, "kept"] += alive and not fails[f]
                out[key, "removed"] += alive and fails[f]
                out[key, "redundant"] += (not alive) and fails[f]
                out[key, "unique_fails"] += fails[f] and sum(fails.values()) == 1
                out[key, "good_lost"] += alive and fails[f] and i in good
                out[key, "toxic_lost"] += alive and fails[f] and i in toxic
                out[part, f] += alive and fails[f]
                alive = alive and not fails[f]
    keys = [(p, "".join(o), s) for p in parts for o in permutations("ABCDE") for s in range(1, 6)]
    return sorted((*k, *(int(out[k, c]) for c in filter_audit.COUNTS), int(out[k[0], k[1][k[2] - 1]])) for k in keys)


def audit_rows():
    rng = random.Random(3)
    long = lambda k, n=260: " ".join(f"w{rng.randrange(k)}" for _ in range(n))
    docs = [(i, long(rng.choice([20, 4000])) + rng.choice(["", " A" * 30, " 5%", "\n|"]), rng.choice(["en", "de", "", None])) for i in range(60)]
    copy = docs[3][1]
    docs += [(100 + i, copy, "en") for i in range(30)] + [(-5, docs[4][1], None), (4, docs[4][1], "en"), (None, copy, "en"), (None, None, "fr")]
    docs += [(200, None, "en"), (201, "", "en"), (202, " \t\n\x0b", "de"), (203, "\xa0\x85" * 300, "en"), (7, docs[7][1], docs[7][2]), (300, long(30_000, 40_000), "xx")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 120, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1)]
    return docs, labels


def audited(spark, docs, labels, **options):
    frame = spark.createDataFrame([(*d, 1, 2, 3, "d", 4, 5) for d in docs], DOCS).repartition(4)
    return filter_audit.filter_audit(frame, spark.createDataFrame([(*x, 9) for x in labels], LABELS), **options)


def test_audit_matches_brute_force(spark):
    docs, labels = audit_rows()
    got = audited(spark, docs, labels)
    assert got.columns == ["part", "filter_order", "step", *filter_audit.COUNTS, "shapley"]
    expected = plain_audit(docs, labels)
    assert sorted(map(tuple, got.collect())) == expected
    hot = audited(spark, docs, labels, part_rows=5)  # the frequent text is dealt in parts
    assert sorted(map(tuple, hot.collect())) == expected


def test_audit_sql_says_the_same(spark):
    docs, labels = audit_rows()
    con = duckdb.connect()
    con.execute("CREATE TABLE documents(doc_id BIGINT, text VARCHAR, lang VARCHAR)")
    con.execute("CREATE TABLE labels(doc_id BIGINT, quality INT, toxic INT)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", docs)
    con.executemany("INSERT INTO labels VALUES (?, ?, ?)", labels)
    assert sorted(con.execute(filter_audit.ORACLE).fetchall()) == plain_audit(docs, labels)


def test_audit_of_nothing(spark):
    none = spark.createDataFrame([], DOCS)
    labels = spark.createDataFrame([], LABELS)
    assert filter_audit.filter_audit(none, labels).collect() == []
    one = audited(spark, [(None, None, None)], [(None, 1, 1)]).collect()
    assert len(one) == 600 and {r["part"] for r in one} == {""} and sum(r["removed"] for r in one) == 120
