"""Operators against brute force, and on odd input: nulls, empty and long texts, ties, repeated rows, no rows."""

from __future__ import annotations

import hashlib
import random
import re
import time
import zlib
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from streamlab.llm import fingerprints, html_text, licenses, multi_index, ngram_join, packing, quality, substrings, toxicity, word_bpe
from streamlab.llm.queries import vocabulary_path
from streamlab.llm.shingles import shingle_hashes

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, label int, id long, tag long, rep long, other string, bucket int"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()


def words(n, seed):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randrange(30)) for _ in range(n))


def odd_texts():
    """(doc_id, text): every case that an operator must stand."""
    base, long = words(120, 1), words(30_000, 2)
    near = base.split()
    near[60] = "changed"
    passage = words(40, 3)
    return [
        (1, base), (2, base), (3, " ".join(near)), (4, None), (5, ""), (6, "  \n\t "), (7, "one two"), (7, "one two"),
        (8, "one two"), (9, long), (10, passage + " " + words(50, 4)), (11, words(50, 5) + " " + passage), (12, "é漢字🙂" * 80),
        (13, "aaaa" * 200), (14, "<|endoftext|>x\x1cy İΣ don't 12²"), (None, base + " tail"), (None, None),
    ]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "en", "s", 1, 0.5, 1, 2, 3, 4, "o", 5) for i, t in odd_texts()]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def texts_by_row(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


# -- BPE and packing


def library():
    tokenizers = pytest.importorskip("tokenizers")
    return tokenizers.Tokenizer.from_file(vocabulary_path())


def test_bpe_equals_the_library(odd, none):
    lib = library()
    expected = []
    for i, t in odd_texts():
        ids = lib.encode(t or "", add_special_tokens=False).ids
        text = lib.decode(ids, skip_special_tokens=False)
        sha = lambda b: hashlib.sha256(b).hexdigest()
        expected.append((i, len(ids), sha(np.array(ids, "<u4").tobytes()), sha(text.encode())))
    got = texts_by_row(word_bpe.op3_bpe(odd, vocabulary_path()), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert got == sorted(expected, key=repr)
    assert word_bpe.op3_bpe(none, vocabulary_path()).count() == 0


def test_bpe_on_random_strings():
    lib, rng = library(), random.Random(4)
    parts = ["a", "b", "'s", " ", "Z", "é", "é", "1", "!", "#", "\n", "th", "Σ", "՘", "<|endoftext|>", "ing", "\0", "漢", "\x85"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(120))) for _ in range(300)] + ["a" * 3000, "ab" * 900]
    bpe = word_bpe.WordBpe(word_bpe.read_vocabulary(vocabulary_path()))
    ids, ends = bpe.encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:])] == [lib.encode(t, add_special_tokens=False).ids for t in texts]
    kept = word_bpe.CACHE_CHUNKS
    try:
        word_bpe.CACHE_CHUNKS = 1
        again, _ = bpe.encode(texts)
    finally:
        word_bpe.CACHE_CHUNKS = kept
    assert again.tolist() == ids.tolist()


def test_packing_places_every_id_once(odd, none):
    lib = library()
    rows = packing.pack_documents(odd, vocabulary_path()).collect()
    sequences, pieces = {}, {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append(r)
        pieces.setdefault((r["doc_id"], r["doc_tokens"], r["ids_crc32"], r["start"], r["length"]), []).append(r)
    for rs in sequences.values():
        at = 0
        for r in sorted(rs, key=lambda r: r["offset"]):
            assert r["offset"] == at and r["length"] > 0
            at += r["length"]
        assert at == rs[0]["window"] <= 2048 and at & (at - 1) == 0  # full: no padding
    expected = 0
    for i, t in odd_texts():
        ids = np.array([*lib.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        expected += len(ids)
        own = [r for r in rows if r["doc_id"] == i and r["doc_tokens"] == len(ids)]
        if i is not None and i != 7:
            own.sort(key=lambda r: r["start"])
            assert [r["start"] for r in own] == np.cumsum([0, *(r["length"] for r in own)])[:-1].tolist()
            assert sum(r["length"] for r in own) == len(ids)
            for r in own:
                assert r["ids_crc32"] == zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes())
    assert sum(r["length"] for r in rows) == expected
    assert packing.pack_documents(none, vocabulary_path()).count() == 0


# -- licenses


def test_license_phrases_and_templates(spark, odd, none):
    mit = " ".join(licenses.TEMPLATES["mit"][2].replace("{{16}}", "2020 Jane Doe and others").replace("[[", "").replace("]]", "").split())
    cases = {
        "Licensed under the Apache License, Version 2.0.": ("apache", "apache,apache-2.0", 1, 3, 3),
        "GNU General\nPublic License; the MIT license! CC-BY": ("cc-by,gpl,mit", "cc-by,gpl,mit", 3, 0, 7),
        mit.upper(): ("mit", "mit", 1, 1, 1),
        mit.replace("free of charge", "for a fee"): ("mit", "mit", 1, 1, 1),
        "apache licenses, mitlicense": ("", "", 0, None, None),
        "gnu general public license v2 or İ": ("gpl", "gpl,gpl-2.0", 1, 0, 0),
    }
    df = spark.createDataFrame([(k, t) for k, t in enumerate(cases)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in licenses.op1_licenses(df).collect()}
    for k, (base, labels, n, first, last) in enumerate(cases.values()):
        r = got[k]
        assert (r["base_labels"], r["labels"], r["n_base"], r["first_word"], r["last_word"]) == (base, labels, n, first, last), k
        assert 0 <= r["score"] <= 1
    whole = licenses.Scanner().scan(mit)
    assert max(f.length for f in whole) > 80  # the whole text, with its optional title and replaced name
    assert max(f.length for f in licenses.Scanner().scan(mit.replace("free of charge", "for a fee"))) < 10
    lower = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    expected = sorted(((i, len(licenses.WORD.findall(lower(t)))) for i, t in odd_texts()), key=repr)
    assert texts_by_row(licenses.op1_licenses(odd), "doc_id", "n_words") == expected
    assert licenses.op1_licenses(none).count() == 0


def test_long_text_with_many_beginnings():
    found = licenses.Scanner().scan("the word " * 200_000 + "the apache license")
    assert [(f.label, f.start, f.length) for f in found] == [("apache", 400_001, 2)]


def as_regex(template):
    """The template as a pattern over words, each with a blank behind it."""
    out, at = "", 0
    plain = lambda text: "".join(re.escape(w) + " " for w in licenses.words_of(text))
    for m in licenses.MARK.finditer(template):
        out += plain(template[at : m.start()])
        if m[2]:
            out += r"(?:\S+ ){0,%s}" % m[2]
        else:
            out += "(?:" + as_regex(m[1]) + ")?"
        at = m.end()
    return out + plain(template[at:])


ALL_TEMPLATES = [(label, t) for label, ts in licenses.TEMPLATES.items() for t in ts] + [(label, t) for t, label in licenses.PHRASES.items()]


def filled(template, rng, keep):
    """A text that fits the template: optional words or not, other words in the gaps."""
    text = re.sub(r"\{\{(\d+)\}\}", lambda m: " ".join(rng.choices(["some", "owner", "2020", "inc"], k=rng.randint(0, int(m[1])))), template)
    return re.sub(r"\[\[(.*?)\]\]", lambda m: m[1] if keep or rng.random() < 0.5 else " ", text, flags=re.S)


def test_labels_equal_patterns_on_filled_and_damaged_templates():
    """Every template filled in, and with one word lost, changed or added: the labels of plain patterns."""
    rng = random.Random(3)
    patterns = [(label, re.compile(r"(?<!\S)" + as_regex(t))) for label, t in ALL_TEMPLATES]
    scanner, lost = licenses.Scanner(), 0
    for label, template in ALL_TEMPLATES:
        for kind in range(6):
            own = licenses.words_of(filled(template, rng, kind % 2))
            at = rng.randrange(len(own))
            if kind >= 2:
                own[at : at + 1] = [[], ["altered"], [own[at], "added"], [own[at], own[at]]][kind - 2]
            text = "before this " + " ".join(own) + " and after"
            joined = "".join(w + " " for w in licenses.words_of(text))
            expected = {found for found, pattern in patterns if pattern.search(joined)}
            got = {f.label for f in scanner.scan(text)}
            assert got == expected, (label, kind, text)
            assert kind >= 2 or label in got
            lost += kind >= 2 and label not in got
    assert lost > len(ALL_TEMPLATES)


@pytest.mark.parametrize("label", ["mit", "bsd-2-clause", "bsd-3-clause", "isc", "0bsd", "zlib", "bsl-1.0", "unlicense"])
def test_whole_licenses_do_not_take_altered_disclaimers(label):
    whole = " ".join(licenses.words_of(filled(licenses.TEMPLATES[label][-1], random.Random(1), True)))
    assert label in {f.label for f in licenses.Scanner().scan(whole) if f.length > 60}
    for cut in (whole.rsplit(" ", 1)[0], whole.replace(" not ", " ", 1).replace("warrant", "guarant", 1)):
        assert cut != whole and not [f for f in licenses.Scanner().scan(cut) if f.label == label and f.length > 60]


def test_automaton_regions():
    a = licenses.Automaton("one [[two]] {{2}} three")
    assert [a.match(t.split(), 0) for t in ("one three", "one two three", "one x three", "one two x y three z", "one x y z three", "two three")] == [2, 3, 3, 5, 0, 0]


# -- pages

PAGE = """<!DOCTYPE html><html><head><title>T &amp; S</title><style>p{}</style></head><body>
<header><a href="/">Site</a></header><nav><ul><li><a href="/a">A</a><li><a href="/b">B</a></ul></nav>
<div class="cookie-notice">We use cookies, a lot of them, and we tell you so at great length on every page.</div>
%s
<div id="comments"><p>A reader's comment that is long enough to look like text of the article itself.</p></div>
<aside>See also</aside><form>Name <input></form><footer>&copy; us</footer><script>var x = "<p>no</p>";</script></body></html>"""


@pytest.mark.parametrize("wrap", ["<article>%s</article>", "<div id=content>%s</div>", "<main><div>%s</div></main>"])
def test_main_text(wrap):
    body = "<h1>A title &lt;1&gt;</h1><p>First  paragraph\nwith <b>bold</b> words, long enough.<p>Second paragraph, <a href=x>linked</a> and caf&eacute;.<!-- no --></p>"
    expected = "A title <1>\nFirst paragraph with bold words, long enough.\nSecond paragraph, linked and café."
    assert html_text.main_text(PAGE % (wrap % body)) == expected


ARTICLE = (
    "<article><h1>T</h1><p>%s</p><section id=discussion><p>%s</p></section><h2 id=related-work>Related work</h2><p>%s</p></article>"
    % ("word " * 80, "more " * 30, "x y z " * 20)
)


@pytest.mark.parametrize(
    "wrap",
    [
        '<div class="content has-sidebar">%s<div class="sidebar"><p>beside</p></div></div>',
        '<div class="page with-ads">%s<div class="ad">beside</div></div>',
        '<main><div class="tags-and-body">%s</div></main>',
        "<form id=form1>%s</form>",
        '<div style="display:none">%s</div>',
        '<div class="sidebar">%s</div>',
        "%s<section class=comments><article class=comment-body><p>" + "beside " * 400 + "</p></article></section>",
    ],
)
def test_hints_never_take_the_article(wrap):
    """A wrapper that is named after something else keeps its article; what stands beside it goes."""
    text = html_text.main_text(f"<body><nav><a href=x>m</a></nav>{wrap % ARTICLE}<footer>beside</footer></body>")
    assert text.split("\n") == ["T", "word " * 79 + "word", "more " * 29 + "more", "Related work", "x y z " * 19 + "x y z"]


def test_all_articles_stay():
    text = html_text.main_text(f"<body>{ARTICLE}<article><p>short</p></article><aside><article><p>card</p></article></aside></body>")
    assert text.split("\n")[0] == "T" and text.split("\n")[-1] == "short"


def test_density_decides(monkeypatch):
    """A page of plain elements: the densest subtree, not the one with the most elements."""
    menu = "".join(f"<li><a href=/{i}>menu item {i}</a></li>" for i in range(30))
    body = "".join(f"<p>{'text of the article ' * 10}</p>" for _ in range(5))
    page = f"<body><div><ul>{menu}</ul></div><div><div>{body}</div></div><div><span>small print</span> <a href=x>imprint</a></div></body>"
    expected = "\n".join([("text of the article " * 10).strip()] * 5)
    assert html_text.main_text(page) == expected
    monkeypatch.setattr(html_text, "density", lambda chars, *_: float(chars > 0))
    assert html_text.main_text(page) != expected


def test_densities_by_definition():
    """Every node's counts against a walk of its subtree, and the density against the published formula."""
    page = html_text.Page('<body><div><p>one <a href=x><b><i><u><s>two</s></u></i></b></a></p><nav>no</nav></div><p>three<br>four</p></body>')
    body = page.measure()
    div, p = next(n for n in page.nodes if n.tag == "div"), next(n for n in page.nodes if n.tag == "p")
    assert (p.chars, p.tags, p.link_chars, p.link_tags) == (6, 6, 3, 1)
    assert (div.chars, div.tags) == (6, 7) and (body.chars, body.tags, body.link_chars) == (15, 10, 3)
    base = np.log(6 / 3 * 3 + 3 / 15 * 6 + np.e)
    assert p.density == pytest.approx(6 / 6 * np.log(6 / 3 * 6 / 1) / max(np.log(base), 1))
    assert div.sum == p.density and next(n for n in page.nodes if n.tag == "nav").density == 0


@pytest.mark.parametrize("nest", ["<div>", "<b>", "<p><b>x", "<li><ul>"])
def test_deep_pages_take_linear_time(nest):
    begin = time.perf_counter()
    assert html_text.main_text(nest * 100_000 + "deep").endswith("deep")
    assert time.perf_counter() - begin < 30


def test_pages_with_odd_input(spark):
    schema = "page_id long, url string, html string, text string, _html string"
    html = [None, "", "   ", "plain text only", "<p>unclosed", "<<<>>", "<div" * 50, "<p>" * 3000 + "deep", "<script>never closed", "&#x41;&nbsp;&bogus; b"]
    df = spark.createDataFrame([(1, None, h, "x", "y") for h in html] * 2, schema)
    rows = html_text.op2_html(df).collect()
    assert len(rows) == 2 * len(html)
    assert all(r["n_chars"] == len(r["text"]) for r in rows)
    texts = [r["text"] for r in rows]
    assert texts.count("plain text only") == 2 and texts.count("unclosed") == 2 and texts.count("deep") == 2
    assert "A &bogus; b" in texts
    assert html_text.op2_html(df.limit(0)).count() == 0


# -- repeats


def brute_repeats(rows):
    """Kept bytes of (id, text) rows, ids ascending, equal rows taken once."""
    seen, out = set(), {}
    for i, t in rows:
        data = t.encode()
        gone = np.zeros(len(data), bool)
        for s in range(len(data) - 99):
            w = data[s : s + 100]
            if w in seen:
                gone[s : s + 100] = True
            seen.add(w)
        out[i] = bytes(b for b, g in zip(data, gone) if not g)
    return out


def test_repeats_equal_brute_force(spark):
    rng, rows = random.Random(8), []
    passages = [words(30, 100 + k) for k in range(6)]
    for i in range(60):
        parts = [words(rng.randrange(1, 40), 200 + i)] + [rng.choice(passages)[rng.randrange(60) :] for _ in range(rng.randrange(3))]
        rng.shuffle(parts)
        rows.append((i, " ".join(parts)))
    rows += [(60, rows[5][1]), (61, "ab" * 400), (62, "é" * 150), (63, rows[7][1][:99]), (64, rows[7][1][:100])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    expected = brute_repeats(rows)
    got = {r["other"]["doc_id"]: r for r in substrings.remove_repeats(df).collect()}
    assert {k: bytes(r["kept"]) for k, r in got.items()} == expected
    for i, t in rows:
        assert got[i]["n_removed"] == len(t.encode()) - len(expected[i]) == sum(s["end"] - s["start"] for s in got[i]["spans"])


def test_rows_without_id_are_documents_by_text(spark):
    """Different texts without an id see each other's passages, in one order; equal ones share a result."""
    passage = words(40, 77)
    texts = [f"{words(20, 700 + k)} {passage} {words(20, 800 + k)}" for k in range(40)]
    df = spark.createDataFrame([(None, t) for t in texts + texts[:3]] + [(9, "x " + passage)], "doc_id long, text string").repartition(4)
    order = dict(df.where("doc_id IS NULL").select("text", F.shiftrightunsigned(F.xxhash64("text"), 2)).collect())
    expected = brute_repeats([("x " + passage, "x " + passage)] + [(t, t) for t in sorted(texts, key=order.get)])
    got = substrings.remove_repeats(df.withColumn("copy", F.col("text"))).collect()
    assert len(got) == 44
    assert all(bytes(r["kept"]) == expected[r["other"]["copy"]] for r in got)
    assert sum(r["n_removed"] > 0 for r in got) == 43


def test_repeats_with_odd_input(odd, none):
    rows = texts_by_row(substrings.op4_repeats(odd), "doc_id", "n_bytes", "n_removed")
    assert len(rows) == len(odd_texts())
    by_id = {i: (n, gone) for i, n, gone in rows if i is not None}
    assert by_id[1][1] == 0 and by_id[2][1] == by_id[2][0] and by_id[4] == (0, 0) and by_id[7] == (7, 0)
    assert by_id[13] == (800, 799)  # all but the first start repeat it
    assert any(i is None and gone > 0 for i, n, gone in rows)  # without an id: after all others
    assert substrings.op4_repeats(none).count() == 0


# -- n-gram join


def gram_set(text):
    w = re.split(r"[\t\n\f\r ]+", text or "")
    w = [x for x in w if x]
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_join_equals_brute_force(spark, monkeypatch):
    rng, rows = random.Random(9), []
    for g in range(12):
        base = words(rng.randrange(8, 90), 300 + g).split()
        for _ in range(rng.randrange(1, 9)):
            w = list(base)
            for _ in range(rng.randrange(0, 3)):
                w[rng.randrange(len(w))] = f"x{rng.randrange(1000)}"
            rows.append((len(rows), " ".join(w)))
    rows += [(len(rows), "a b c"), (len(rows) + 1, "a b  c"), (len(rows) + 2, "a b c d")]
    sets = {i: gram_set(t) for i, t in rows}
    links = {i: {j for j in sets if j != i and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])} for i in sets}
    assert max(map(len, links.values())) > 3
    expected = []
    for i in sets:
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        expected.append((i, min(seen), len(links[i])))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert texts_by_row(ngram_join.ngram_join(df), "doc_id", "class_id", "n_links") == sorted(expected, key=repr)
    # Small blocks: every group and bucket is dealt in pairs of blocks.
    for name, size in (("BUCKET_BLOCK", 2), ("GROUP_DOCS", 2), ("GROUP_BYTES", 400)):
        monkeypatch.setattr(ngram_join, name, size)
    assert texts_by_row(ngram_join.ngram_join(df), "doc_id", "class_id", "n_links") == sorted(expected, key=repr)


def test_join_with_odd_input(odd, none):
    got = {r["doc_id"]: r for r in ngram_join.ngram_join(odd).collect() if r["doc_id"] is not None}
    assert ngram_join.ngram_join(odd).count() == len(odd_texts())
    assert [got[i]["class_id"] for i in (1, 2, 3)] == [1, 1, 1]
    assert got[1]["n_links"] >= 2 and got[2]["copy_of"] == 1
    assert got[4]["class_id"] == 4 and got[4]["n_links"] == 0 and got[5]["class_id"] == 5 and got[6]["n_links"] == 0
    assert got[7]["class_id"] == got[8]["class_id"] == 7 and got[8]["n_links"] == 2
    assert ngram_join.ngram_join(none).count() == 0


def test_join_with_repeated_ids_that_have_partners(spark):
    """A repeated row adds no links to others; texts of one id keep the links of each."""
    one, two, three = words(80, 21), words(80, 22), words(80, 23)
    rows = [(1, one), (1, one), (2, one + " x"), (3, two), (3, three), (4, two + " x"), (5, three + " x")]
    got = texts_by_row(ngram_join.ngram_join(spark.createDataFrame(rows, "doc_id long, text string")), "doc_id", "class_id", "n_links")
    assert got == [(1, 1, 2), (1, 1, 2), (2, 1, 2), (3, 3, 2), (3, 3, 2), (4, 3, 1), (5, 3, 1)]


def test_bayesian_bounds():
    for n, least in ngram_join.LEAST:
        assert 0 < least < 0.8 * n  # a pair at the threshold stays


def test_shingles_do_not_depend_on_neighbours():
    texts = [t or "" for _, t in odd_texts()]
    one = []
    for t in texts:
        data = np.frombuffer(t.encode(), np.uint8)
        one.append(shingle_hashes(data, np.array([0, len(data)]))[0])
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    hashes, starts = shingle_hashes(data, np.cumsum([0, *(len(t.encode()) for t in texts)]))
    assert all((hashes[a:b] == x).all() and b - a == len(x) for a, b, x in zip(starts[:-1], starts[1:], one))


# -- fingerprints


def test_fingerprints(odd, none, spark):
    out = fingerprints.op6_fingerprints(odd).collect()
    assert len(out) == len(odd_texts()) and all(len(r["fingerprint"]) == 256 for r in out)
    by = {r["doc_id"]: r for r in out}
    assert by[1]["fingerprint"] == by[2]["fingerprint"] and by[4]["fingerprint"] == by[5]["fingerprint"] == by[6]["fingerprint"]
    assert by[1]["near_next"] == 1.0 and all(0 <= r["near_edited"] <= 1 for r in out)
    rows = sorted(((i, t or "") for i, t in odd_texts() if i is not None and i != 7))
    rows = [r for r in rows if r[0] not in (6, 14)]  # their next rows are the repeated id and the rows without one
    follow = {i: t for i, t in odd_texts() if i is not None}
    for i, t in rows:
        if i + 1 in follow:
            n = follow[i + 1] or ""
            cut = len(t) // 4
            edited = t[: len(t) - cut] + n[:cut]
            assert (by[i]["n_chars"], by[i]["edited_sha256"]) == (len(t), hashlib.sha256(edited.encode()).hexdigest()), i
    assert fingerprints.op6_fingerprints(none).count() == 0
    one = fingerprints.op6_fingerprints(spark.createDataFrame([(3, "abcdefgh")], "doc_id long, text string")).first()
    assert one["near_next"] == 1.0 and one["edited_sha256"] == hashlib.sha256(b"abcdefab").hexdigest()


def plain_fingerprint(text):
    """Bins, donors and bits in a loop."""
    xxhash = pytest.importorskip("xxhash")
    split = [w for w in re.split(r"[ \t\n\x0b\f\r]+", text or "") if w]
    hashes = []
    for i in range(max(len(split) - 4, 1)):
        seed = 42
        for word in split[i : i + 5]:
            seed = xxhash.xxh64_intdigest(word.encode(), seed)
        hashes.append(seed - (seed >> 63 << 64))
    least: dict[int, int] = {}
    for h in sorted(hashes):
        least.setdefault((h >> 57) + 64, h)
    out = []
    for b in range(128):
        donors = [x for x in range(128) if x != b]
        random.Random(11 * 128 + b).shuffle(donors)
        filled = next(x for x in [b, *donors] if x in least)
        out.append(least[filled] & 255)
    return bytes(out).hex().upper()


def test_fingerprints_equal_a_plain_loop(spark):
    texts = ["", None, "one", "a b c d e", "a b c d e f", *(words(n, n) for n in (7, 12, 40, 200, 1500)), "x y " * 300]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r["i"]: r["f"] for r in fingerprints.with_fingerprint(frame, "t", "f").collect()}
    assert got == {i: plain_fingerprint(t) for i, t in enumerate(texts)}


def test_fingerprints_of_the_smallest_id(spark):
    rows = [(-(1 << 63), "a b c"), (None, "d e f"), (5, "g h i")]
    assert fingerprints.op6_fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).count() == 3


def test_fingerprints_estimate_jaccard(spark):
    rows = []
    for i in range(40):
        w = words(300, 500 + i).split()
        v = list(w)
        for k in range(i):
            v[(k * 7) % 300] = f"y{k}"
        rows.append((i, " ".join(w), " ".join(v)))
    df = spark.createDataFrame(rows, "i int, a string, b string")
    df = fingerprints.with_fingerprint(fingerprints.with_fingerprint(df, "a", "fa"), "b", "fb")
    got = {r["i"]: r["x"] for r in df.select("i", fingerprints.likeness(F.col("fa"), F.col("fb")).alias("x")).collect()}
    errors = [got[i] - len(gram_set(a) & gram_set(b)) / len(gram_set(a) | gram_set(b)) for i, a, b in rows]
    assert abs(np.mean(errors)) < 0.03 and max(map(abs, errors)) < 0.16


# -- neighbours


def test_double_vectors_have_double_scores(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(60, 6))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    found = multi_index.neighbours(df, k=3).collect()
    assert len(found) == 9
    for r in found:
        assert abs(r["score"] - float(x[r["query_id"]] @ x[r["vec_id"]])) < 1e-12


def test_neighbours_against_brute_force(spark):
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(size=(700, 16)) + 4 * rng.normal(size=(1, 16)) for _ in range(2)]).astype(np.float32)
    x[100:400] = x[100]  # one vector many times
    rows = [(int(i), [float(v) for v in row], 1) for i, row in enumerate(x)]
    bad = [(2000, None, 1), (2020, [0.0] * 16, 1), (2040, [float("nan")] + [1.0] * 15, 1), (2060, [None] + [1.0] * 15, 1), (2080, [float("inf")] * 16, 1), (2100, [1.0], 1)]
    df = spark.createDataFrame(rows + bad + [rows[40]], "vec_id long, embedding array<float>, score int").repartition(4)
    out = {}
    for r in multi_index.neighbours(df).collect():
        out.setdefault(r["query_id"], []).append(r)
    assert sorted(out) == list(range(0, 1400, 20))
    hits = 0
    exact = x.astype(np.float64) @ x.astype(np.float64).T
    for q, rs in out.items():
        rs.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in rs] == list(range(1, 21)) and q not in [r["vec_id"] for r in rs]
        assert all(abs(r["score"] - exact[q, r["vec_id"]]) < 1e-9 for r in rs)
        order = [int(i) for i in np.lexsort((np.arange(1400), -np.round(exact[q], 9))) if i != q][:20]
        hits += len(set(order) & {r["vec_id"] for r in rs})
    assert hits / (20 * len(out)) >= 0.9
    assert multi_index.neighbours(df.limit(0)).count() == 0
    few = multi_index.neighbours(df.where("vec_id < 3")).collect()
    assert sorted((r["query_id"], r["vec_id"]) for r in few) == [(0, 1), (0, 2)]


# -- classifiers


def labelled_docs(spark):
    rng, docs, labels = random.Random(12), [], []
    for i in range(400):
        junk, toxic = rng.random() < 0.3, rng.random() < 0.3
        w = words(60, 900 + i).split()
        if junk:
            w = [x + "***" for x in w]
        if toxic:
            for _ in range(4):
                w.insert(rng.randrange(len(w)), rng.choice(["grobmar", "grobulen", "snivoid", "snivard"]))
        docs.append((i, " ".join(w)))
        labels.append((i, int(not junk), int(toxic)))
    labels += [(None, 1, 1), (1, None, None), (7, 5, 5), (10**6, 1, 0)]
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_quality_on_held_out(spark, odd, none):
    docs, labels = labelled_docs(spark)
    out = {r["doc_id"]: r for r in quality.op8_quality(docs, labels).collect()}
    known = {r["doc_id"]: r["quality"] for r in labels.where("quality in (0, 1) and doc_id < 400").collect()}
    held = [i for i in known if zlib.crc32(str(i).encode()) % 4 == 2]
    assert {i for i, r in out.items() if r["held_out"]} == set(held) | {i for i in out if zlib.crc32(str(i).encode()) % 4 == 2}
    assert np.mean([out[i]["predicted"] == known[i] for i in held]) > 0.95
    assert all((r["score"] >= 0.7) == bool(r["predicted"]) and 0 <= r["score"] <= 1 for r in out.values())
    model = quality.train_quality(docs, labels, F.lit(True))
    scored = quality.with_quality(odd, model)
    assert scored.count() == len(odd_texts()) and set(scored.columns) == set(odd.columns)  # the old score is replaced
    assert quality.with_quality(none, model).count() == 0
    assert len({r["score"] for r in scored.where("text is null or text = ''").collect()}) == 1
    nothing = quality.op8_quality(docs, labels.limit(0)).agg(F.min("predicted"), F.count("*")).first()
    assert tuple(nothing) == (1, 400)


def test_threshold_comes_from_all_strengths(spark):
    """Strengths of all documents in two heaps: the threshold lies in the middle of the gap that the cut is in."""
    rng = np.random.default_rng(4)
    low, high = rng.normal(-6, 1, 1300), rng.normal(5, 1, 8700)
    both = np.concatenate((low, high))
    df = spark.createDataFrame([(float(x),) for x in both], "strength double")
    none = quality.fit_bradley_terry(np.zeros((0, quality.N_FEATURES), np.float32), np.zeros(0, np.int64), 0.0)
    at = lambda df, cut, off=0.0: quality.threshold_of(df, quality.Fitted(none.model._replace(threshold=cut), off))
    for cut in (-1.5, 0.0, 0.5):
        assert abs(at(df, cut) - (low.max() + high.min()) / 2) <= quality.BIN
    # The correction moves the quantile: 10 % of all documents more are below than the cut says, or 5 % fewer.
    assert abs((both < at(df, 0.0, 0.1)).mean() - 0.23) < 0.005 and abs((both < at(df, 0.0, -0.05)).mean() - 0.08) < 0.005
    assert at(df, -100.0) < low.min() and at(df, 100.0) > high.max() and at(df, 0.0, -1.0) < low.min() and at(df, 0.0, 1.0) > high.max()
    assert at(df.limit(0), 0.25) == 0.25
    assert at(df.repartition(7, "strength"), 0.0, 0.1) == at(df.coalesce(1), 0.0, 0.1)


def test_weights_reach_the_plain_minimum():
    """The pairwise logistic loss of the fitted weights is that of full gradient descent over all pairs."""
    rng = np.random.default_rng(2)
    labels = np.repeat([0, 1], 60)
    features = rng.normal(size=(120, 5)).astype(np.float32) + labels[:, None] * np.array([0.8, 0.4, 0, -0.5, 0], np.float32)
    model = quality.fit_bradley_terry(features, labels, 0.5).model
    z = np.clip((features - model.mean) / model.scale, -6, 6).astype(np.float64)
    diff = (z[labels == 1][:, None] - z[labels == 0][None]).reshape(-1, 5)
    loss = lambda w: np.log1p(np.exp(-diff @ w)).mean() + quality.DECAY / 2 * (w**2).sum()
    plain = np.zeros(5)
    for _ in range(2000):
        plain -= 0.3 * (quality.DECAY * plain - diff.T @ (1 / (1 + np.exp(diff @ plain))) / len(diff))
    assert loss(model.weights.astype(np.float64)) < loss(plain) + 0.005 < loss(np.zeros(5)) - 0.1


def test_toxicity_on_held_out_and_hidden_insults(spark, odd, none):
    docs, labels = labelled_docs(spark)
    out = {r["doc_id"]: r for r in toxicity.op10_toxicity(docs, labels).collect()}
    known = {r["doc_id"]: r["toxic"] for r in labels.where("toxic in (0, 1) and doc_id < 400").collect()}
    held = [i for i in known if zlib.crc32(str(i).encode()) % 3 == 1]
    assert np.mean([out[i]["predicted"] == known[i] for i in held]) > 0.95
    machine = toxicity.train_toxicity(docs, labels, F.lit(True))
    hidden = ["grob-mar x", "g r o b m a r", "GROBMAR!!", "grobmxar", "snivoids"]
    texts = [f"{words(20, 40)} {h} {words(10, 41)} {h}" for h in hidden] + [words(60, 50 + k) for k in range(10)]
    scores = toxicity.with_toxicity(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), machine).orderBy("doc_id").collect()
    assert [r["score"] >= 0.7 for r in scores] == [True] * len(hidden) + [False] * 10
    scored = toxicity.with_toxicity(odd, machine)
    assert scored.count() == len(odd_texts()) and set(scored.columns) == set(odd.columns)
    assert toxicity.with_toxicity(none, machine).count() == 0
    nothing = toxicity.op10_toxicity(docs, labels.limit(0)).agg(F.max("predicted"), F.count("*")).first()
    assert tuple(nothing) == (0, 400)


def phi(w):
    """Every reading of a word, enumerated."""
    w, out = f"\x01{w}\x02", {}
    for k in (3, 4):
        for at in combinations(range(len(w)), k):
            if at[-1] - at[0] < toxicity.STRETCH:
                key = "".join(w[i] for i in at)
                out[key] = out.get(key, 0) + toxicity.DECAY ** (at[-1] - at[0] + 1)
    return out


def test_machine_is_the_exact_kernel_machine():
    """With every word a landmark, margins satisfy the optimality conditions of the machine on the plain kernel."""
    bad, good = ["idiot", "idiots", "moron", "scum"], ["radio", "patriot", "more", "on", "scam", "study", "ideal"]
    table, bias = toxicity._fit_words([(w, 1.0 + k) for k, w in enumerate(bad)], [(w, 1.0) for w in good])
    found = toxicity.StringMachine(table, bias, None, None, 0.0).margins(bad + good).astype(float)
    maps = [phi(w) for w in bad + good]
    norms = [sum(v * v for v in m.values()) ** 0.5 for m in maps]
    kernel = np.array([[sum(v * n.get(k, 0) for k, v in m.items()) for n in maps] for m in maps]) / np.outer(norms, norms)
    sign = np.array([1.0] * len(bad) + [-1.0] * len(good))
    share = np.concatenate((np.arange(1, 5) / 10, np.full(len(good), 1 / len(good)))) / 2
    slack = np.maximum(0, 1 - sign * found)
    assert abs((share * sign * slack).sum()) < 1e-4
    # Margins stand near 1, so slacks are small differences; the equation is compared before the division by the penalty.
    target = np.linalg.lstsq(np.hstack([kernel, np.ones((len(sign), 1))]), found, rcond=None)[0]
    assert np.allclose(kernel @ target[:-1] + target[-1], found, atol=1e-3)
    assert np.allclose(target[:-1] * toxicity.PENALTY, share * sign * slack, atol=2e-5)


def test_sentences_and_their_witnesses():
    table, bias = toxicity._fit_words([("idiot", 1.0)], [("clean", 1.0), ("words", 1.0), ("here", 1.0)])
    scorer = toxicity.Scorer(toxicity.StringMachine(table, bias, None, None, 0.0))
    texts = ["clean words here. you id-iot! clean\nwords here", "", "words words. clean", " \n ", "words " * 3, "i d i o t clean"]
    _, doc, sentence, starts = scorer.read(texts)
    assert [int(x) for x in np.bincount(doc[starts], minlength=6)] == [4, 0, 2, 0, 1, 1] and sentence[-1] + 1 == len(starts)
    found = scorer.witnesses(texts, [1, 1, 0, 0, 1, 0])
    assert [(w, y) for w, y, m in found if y] == [("idiot", 1)]  # the clean words of a toxic document say nothing
    assert sorted(w for w, y, m in found if not y) == ["clean", "idiot", "words"]
    together, alone = scorer.features(texts), [scorer.features([t])[0] for t in texts]
    assert np.array_equal(together, np.array(alone))


def test_string_kernel_by_enumeration():
    """The folded sum equals the kernel that enumerates every reading of both words."""
    a, b = phi("stupid"), phi("stxupidly")
    expected = sum(v * b.get(k, 0) for k, v in a.items())
    table = np.zeros(toxicity.SIZE, np.float32)
    _, code, weight = toxicity._subsequences(["stupid"])
    np.add.at(table, code, weight)
    owner, code, weight = toxicity._subsequences(["stxupidly"])
    assert abs(float((table[code] * weight).sum()) - expected) < 1e-3 * expected
    assert abs(toxicity._norms(["stxupidly"], owner, code, weight)[0] ** 2 - sum(v * v for v in b.values())) < 1e-3 * expected
