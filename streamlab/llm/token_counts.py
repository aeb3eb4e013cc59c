"""Token counts of a byte-level BPE vocabulary, looked up in two tiers on the map side.

A text's tokens are those of its pre-tokens, each on its own. The lengths of frequent pre-tokens are
broadcast as one compact table; others are encoded once and kept in the worker's cache, which is bounded.
Nothing is shuffled per pre-token: the frequent ones come from mergeable summaries, one bounded row per
task, and a text is counted in the task that reads it. The summaries cover all texts, and decide only
which pre-tokens are in the table, never a count.

A task cuts a chunk of texts into pre-tokens with numpy, looks up each different one once, and encodes
those that are in neither tier together, in merge rounds.
"""

from __future__ import annotations

import json
import re
import uuid
from collections import Counter
from collections.abc import Iterator
from itertools import islice
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamlab.llm.arrow import ranges, text_chunks
from streamlab.llm.word_bpe import _byte_characters, merge_rounds

#: Pre-tokens of the broadcast table, and of a summary while it counts: bounds for the broadcast (under 1 MB) and for a task.
FREQUENT, COUNTERS = 20_000, 100_000
#: A frequent pre-token is no longer than this; longer ones are left to the caches.
FREQUENT_CHARS = 40
#: Groups of tasks whose summaries are merged, level by level.
LEVELS = (1024, 32, 1)
#: Half of a worker's cache. A half that is full replaces the older one. Memory only, the counts stay the same.
CACHE_PIECES, CACHE_CHARS = 200_000, 6_000_000
#: A longer text is looked up as its pre-tokens are found, others in numpy.
LONG_CHARS = 1 << 21
#: Fixed values of the vocabulary's pre-token pattern.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PIECE = regex.compile(PATTERN)
#: Code points on which every Unicode version of the last years agrees; others take the library's own rules.
SETTLED_CHARS = "\x00-\x1b\x20-ԯḀ-ỿ‐-‧‰-⁞₠-₿ぁ-ゖァ-ヺ一-龥가-힣"
SETTLED = re.compile(f"[{SETTLED_CHARS}]*\\Z")
LETTER, NUMBER, SPACE, OTHER = range(4)
#: Characters that are hashed by position; longer pre-tokens are hashed as strings and encoded by the library.
HASHED = 64


def _kinds() -> np.ndarray:
    """The kind of each settled code point."""
    kinds = np.full(1 << 16, OTHER, np.uint8)
    every = "".join(regex.findall(f"[{SETTLED_CHARS}]", "".join(map(chr, [*range(0xD800), *range(0xE000, 1 << 16)]))))
    for kind, name in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (SPACE, r"\s")):
        kinds[[ord(c) for c in regex.findall(name, every)]] = kind
    return kinds


KINDS = _kinds()
WEIGHTS = np.random.default_rng(12).integers(0, 1 << 63, HASHED, np.uint64) * np.uint64(2) + np.uint64(1)


class Pieces(NamedTuple):
    """The different pre-tokens of a chunk, which of them stands at each place, and each text's first place."""

    different: list[str]
    at: np.ndarray
    firsts: np.ndarray


def piece_starts(codes: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Where pre-tokens begin in settled texts that lie one after another; ``begins`` are the texts' first places."""
    n = len(codes)
    kind = KINDS[codes]
    fresh = np.zeros(n + 1, bool)  # first of a text
    fresh[begins] = True
    fresh[n] = True
    start = fresh[:-1].copy()
    start[1:] |= kind[1:] != kind[:-1]
    inner = ~fresh[1:-1]
    # The last of some white space before other text stands alone, or joins that text if it is a plain space.
    last = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] != SPACE) & inner)
    start[last] = True
    start[last[codes[last] == 32] + 1] = False
    # An apostrophe that begins a pre-token takes the letters of a contraction with it.
    quote = np.flatnonzero((codes[:-1] == 39) & start[:-1] & (kind[1:] == LETTER) & inner)
    one, two = codes[quote + 1], np.where(fresh[np.minimum(quote + 2, n)], 0, codes[np.minimum(quote + 2, n - 1)])
    taken = np.isin(one, [ord(c) for c in "stmd"]) * 1
    for a, b in ("re", "ve", "ll"):
        taken[(one == ord(a)) & (two == ord(b))] = 2
    quote, taken = quote[taken > 0], taken[taken > 0]
    start[quote + 1] = False
    after = quote + taken + 1
    start[after[after < n]] = True
    return np.flatnonzero(start)


def cut(texts: list[str]) -> Pieces | None:
    """Pre-tokens of settled texts without special tokens; None if two different ones share a hash."""
    joined = "".join(texts)
    sizes = np.array([len(t) for t in texts], np.int64)
    begins = np.cumsum(sizes) - sizes
    if not joined:
        return Pieces([], np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64))
    codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    starts = piece_starts(codes, begins[sizes > 0])
    lengths = np.diff(np.append(starts, len(codes)))
    place = np.arange(len(codes)) - np.repeat(starts, lengths)
    keys = np.add.reduceat((codes.astype(np.uint64) + np.uint64(1)) * WEIGHTS[np.minimum(place, HASHED - 1)], starts)
    for i in np.flatnonzero(lengths > HASHED).tolist():
        keys[i] = np.uint64(hash(joined[starts[i] : starts[i] + lengths[i]]) & (1 << 64) - 1)
    _, first, at = np.unique(keys, return_index=True, return_inverse=True)
    same = lengths[first][at] == lengths
    if not same.all() or (codes[ranges(starts[first][at], lengths)] != codes).any():
        return None
    spans = zip(starts[first].tolist(), (starts[first] + lengths[first]).tolist())
    firsts = np.searchsorted(starts, np.append(begins, len(codes)))
    return Pieces([joined[a:b] for a, b in spans], at, firsts)


class Merges:
    """The vocabulary's merges as sorted pair keys, for ``merge_rounds``; a byte is the same token anywhere."""

    def __init__(self, spec: dict):
        vocab = spec["model"]["vocab"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        self.inner = self.final = np.array([vocab[c] for c in _byte_characters()], np.int32)
        self.merged = np.array([vocab[a + b] for a, b in merges], np.int32)
        keys = self.pair_keys(np.array([vocab[a] for a, _ in merges]), np.array([vocab[b] for _, b in merges]))
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int32)

    def pair_keys(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)


class Rules:
    """The library, and how a text falls into pre-tokens."""

    def __init__(self, rules: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(rules)
        self.library.no_truncation()
        self.library.no_padding()
        spec = json.loads(rules)
        special = sorted(t["content"] for t in spec["added_tokens"])
        self.special = re.compile("|".join(map(re.escape, special)) if special else r"(?!)")
        self.merges = Merges(spec)

    def tokens(self, pieces: list[str]) -> list[int]:
        """Numbers of tokens of pre-tokens, all encoded together."""
        coded = [piece.encode() if len(piece) <= HASHED else b"" for piece in pieces]
        sizes = np.array([len(c) for c in coded], np.int64)
        some = np.flatnonzero(sizes)
        n = np.zeros(len(pieces), np.int64)
        if len(some):
            _, piece = merge_rounds(np.frombuffer(b"".join(coded), np.uint8), sizes[some], self.merges)
            n[some] = np.bincount(piece, minlength=len(some))
        for i in np.flatnonzero(sizes == 0).tolist():
            n[i] = len(self.library.encode(pieces[i], add_special_tokens=False).ids)
        return n.tolist()

    def is_plain(self, text: str) -> bool:
        return len(text) <= LONG_CHARS and SETTLED.match(text) is not None and not self.special.search(text)

    def pieces(self, part: str) -> Iterator[str]:
        """Pre-tokens of any text without special tokens, one by one."""
        if SETTLED.match(part):
            return (m[0] for m in PIECE.finditer(part))
        return (part[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(part))


class Lengths:
    """Pre-token to number of tokens: the broadcast table, and behind it a cache of what was not in it."""

    def __init__(self, rules: str, frequent: dict[str, int] | None = None):
        self.rules = Rules(rules)
        self.frequent = frequent or {}
        self.young: dict[str, int] = {}
        self.old: dict[str, int] = {}
        self.held = self.encoded = 0

    def known(self, piece: str) -> int:
        """Length in either tier; -1 if in none."""
        n = self.frequent.get(piece)
        if n is None:
            n = self.young.get(piece)
        if n is None and piece in self.old:
            n = self.old[piece]
            self.remember(piece, n)
        return -1 if n is None else n

    def remember(self, piece: str, n: int) -> None:
        if len(self.young) >= CACHE_PIECES or self.held >= CACHE_CHARS:
            self.old, self.young, self.held = self.young, {}, 0
        self.young[piece] = n
        self.held += len(piece)

    def of_pieces(self, pieces: list[str]) -> np.ndarray:
        """``pieces`` are all different."""
        n = np.fromiter(map(self.known, pieces), np.int64, len(pieces))
        missing = np.flatnonzero(n < 0)
        if len(missing):
            new = [pieces[i] for i in missing.tolist()]
            n[missing] = tokens = self.rules.tokens(new)
            self.encoded += len(new)
            for piece, k in zip(new, tokens):
                self.remember(piece, k)
        return n

    def of_text(self, text: str) -> int:
        """One text, whatever is in it."""
        parts = self.rules.special.split(text)
        n = len(parts) - 1
        for part in parts:
            pieces = self.rules.pieces(part)
            while some := Counter(islice(pieces, LONG_CHARS)):
                n += int(self.of_pieces(list(some)) @ np.array(list(some.values()), np.int64))
        return n

    def of_texts(self, texts: list[str]) -> np.ndarray:
        n = np.zeros(len(texts), np.int64)
        plain = [i for i, text in enumerate(texts) if self.rules.is_plain(text)]
        pieces = cut([texts[i] for i in plain])
        if pieces is None:
            plain = []
        else:
            lengths = self.of_pieces(pieces.different)
            n[plain] = np.diff(np.append(0, np.cumsum(lengths[pieces.at]))[pieces.firsts])
        for i in sorted(set(range(len(texts))) - set(plain)):
            n[i] = self.of_text(texts[i])
        return n


class Frequent(NamedTuple):
    """Pre-tokens one after another, where each ends, and how many tokens each has."""

    characters: str
    ends: np.ndarray
    lengths: np.ndarray

    def table(self) -> dict[str, int]:
        ends = self.ends.tolist()
        pieces = (self.characters[lo:hi] for lo, hi in zip([0, *ends], ends))
        return dict(zip(pieces, self.lengths.tolist()))


_WORKER: dict[str, Lengths] = {}


def worker_lengths(name: str, shared: Broadcast) -> Lengths:
    """The lookup of this worker process; its cache outlives a task."""
    if name not in _WORKER:
        _WORKER.clear()
        rules, frequent = shared.value
        _WORKER[name] = Lengths(rules, frequent.table())
    return _WORKER[name]


def read_rules(path: str) -> str:
    """The vocabulary file, of fixed size (about 2 MB), so it may be broadcast."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def thin_out(counts: Counter, most: int) -> Counter:
    """The summary of at most ``most`` counters: every counter loses what the first one left out has."""
    if len(counts) <= most:
        return counts
    loss = sorted(counts.values(), reverse=True)[most]
    return Counter({piece: n - loss for piece, n in counts.items() if n > loss})


def _texts(data: np.ndarray, offsets: np.ndarray) -> list[str]:
    raw = data.tobytes()
    return [raw[a:b].decode() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]


_SUMMARY = "group int, pieces array<string>, counts array<long>"


def _summary(group: int, counts: Counter, most: int) -> pa.RecordBatch:
    kept = thin_out(counts, most)
    return pa.RecordBatch.from_arrays(
        [pa.array([group], pa.int32()), pa.array([list(kept)], pa.list_(pa.string())), pa.array([list(kept.values())], pa.list_(pa.int64()))],
        ["group", "pieces", "counts"],
    )


def frequent_pieces(docs: DataFrame, rules: Broadcast, text_col: str = "text", most: int = FREQUENT) -> list[str]:
    """Frequent pre-tokens of all texts, at most ``most``: a summary per task, merged in a tree."""

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, counts, group = Rules(rules.value), Counter(), None
        for batch in batches:
            group = batch.column("group")[0].as_py() if batch.num_rows else group
            for _, data, offsets in text_chunks(iter([batch]), "text"):
                texts = _texts(data, offsets)
                plain = [t for t in texts if own.is_plain(t)]
                found = cut(plain)
                if found is None:
                    plain = []
                else:
                    n = np.bincount(found.at, minlength=len(found.different))
                    counts.update({p: k for p, k in zip(found.different, n.tolist()) if len(p) <= FREQUENT_CHARS})
                for text in texts if len(plain) < len(texts) else ():
                    if not (plain and own.is_plain(text)):
                        counts.update(p for part in own.special.split(text) for p in own.pieces(part) if len(p) <= FREQUENT_CHARS)
                        counts = thin_out(counts, COUNTERS)
                counts = thin_out(counts, COUNTERS)
        if group is not None:
            yield _summary(group, counts, most)

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        counts: Counter = Counter()
        for pieces, n in zip(table.column("pieces").to_pylist(), table.column("counts").to_pylist()):
            counts.update(dict(zip(pieces, n)))
            counts = thin_out(counts, COUNTERS)
        return pa.Table.from_batches([_summary(key[0].as_py(), counts, most)])

    found = docs.select(F.col(text_col).alias("text"), F.spark_partition_id().alias("group")).mapInArrow(summarise, _SUMMARY)
    for groups in LEVELS:
        found = found.withColumn("group", F.pmod("group", F.lit(groups))).groupBy("group").applyInArrow(merge, _SUMMARY)
    return [piece for row in found.select("pieces").collect() for piece in row["pieces"]]  # one row


def frequent_table(pieces: list[str], rules: str) -> Frequent:
    own = Rules(rules)
    ends = np.cumsum([len(p) for p in pieces], dtype=np.int64)
    return Frequent("".join(pieces), ends, np.array(own.tokens(pieces), np.int16))


def token_counts(
    docs: DataFrame, path: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text", most: int = FREQUENT
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of each row.

    Tokens are those of the library for the vocabulary at ``path`` (byte-level BPE without a
    normalizer), without added special tokens; a special token's own text inside a text is one token. A null
    text is empty and has no tokens. Ids are only carried along: null and repeated ones have their rows.
    A text of any length is counted whole, an unbroken word of any length too. Other columns are left out.
    """
    context = docs.sparkSession.sparkContext
    rules = read_rules(path)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    frequent = frequent_pieces(docs, context.broadcast(rules), "text", most)
    shared = context.broadcast((rules, frequent_table(frequent, rules)))
    name = uuid.uuid4().hex

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = worker_lengths(name, shared)
        for rows, data, offsets in text_chunks(batches, "text"):
            n = lengths.of_texts(_texts(data, offsets))
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.array(np.diff(offsets)), pa.array(n), pa.array(n > limit)],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return docs.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")


def op12_counts(docs: DataFrame, path: str) -> DataFrame:
    return token_counts(docs, path)
