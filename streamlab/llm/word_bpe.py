"""BPE with word ends: encoding in batched merge rounds, and decoding.

The tokens of a white-space delimited chunk of a text depend on that chunk alone, so a task keeps the
chunks it has met with their ids, and encodes the new ones of a batch together: the symbols of all of
them lie in one flat array; in each round every chunk's lowest-rank pair, found by binary search over
the sorted pair keys, is merged at all its places.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamlab.llm.arrow import ranges, text_chunks

#: Chunks that a task remembers; then it starts anew. Memory only, the ids stay the same.
CACHE_CHUNKS = 400_000
NEVER = np.int32(2**31 - 1)
#: Fixed values of the vocabulary's word pattern.
WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
#: The same, and the line feed that separates chunks.
PIECE = regex.compile("\\n|" + WORD.pattern)
#: Code points on which every Unicode version of the last years agrees; others take the library's own rules.
SETTLED = re.compile(r"[\x00-ԯḀ-ỿ‐-‧‰-⁞₠-₿ぁ-ゖァ-ヺ一-龥가-힣]*\Z")
#: str.split() takes these for white space, the vocabulary does not.
SPLIT_ONLY = re.compile("[\x1c-\x1f]")
SPACE = regex.compile(r"\s+")


def read_vocabulary(path: str) -> dict:
    """The file's content; it is of fixed size (about 2 MB), so it may be broadcast."""
    with open(path, encoding="utf-8") as f:
        raw = f.read()
    return {"json": raw}


def _byte_characters() -> list[str]:
    """The printable character that stands for each byte."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


class WordBpe:
    """Encoder and decoder of one vocabulary, with the chunks met so far."""

    def __init__(self, vocabulary: dict):
        spec = json.loads(vocabulary["json"])
        vocab, suffix = spec["model"]["vocab"], spec["model"]["end_of_word_suffix"]
        byte = _byte_characters()
        self.inner = np.array([vocab[c] for c in byte], np.int32)
        self.final = np.array([vocab[c + suffix] for c in byte], np.int32)
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        left = np.array([vocab[a] for a, _ in merges], np.int64)
        right = np.array([vocab[b] for _, b in merges], np.int64)
        self.pair_type = np.uint32 if max(vocab.values()) < 1 << 16 else np.uint64
        keys = self.pair_keys(left, right)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int32)
        self.merged = np.array([vocab[a + b] for a, b in merges], np.int32)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_pattern = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        names = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        self.tokens = [names.get(i, "").encode() for i in range(max(names) + 1)]
        self.rules = vocabulary["json"]
        self._library = None
        self.forget()

    def pair_keys(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        kind = self.pair_type
        return left.astype(kind) << kind(8 * kind().itemsize // 2) | right.astype(kind)

    def forget(self) -> None:
        self.index: _Chunks = _Chunks()
        self.ids = np.zeros(0, np.int32)
        self.starts = np.zeros(0, np.int64)
        self.lengths = np.zeros(0, np.int64)

    # -- encoding

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and where each text's ids begin and end."""
        if len(self.index) > CACHE_CHUNKS:
            self.forget()
        look = self.index.__getitem__
        chunks, counts = [], np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            parts = SPACE.split(text) if SPLIT_ONLY.search(text) else text.split()
            counts[i] = len(parts)
            chunks.append(np.fromiter(map(look, parts), np.int32, len(parts)))
        self._learn()
        chunks = np.concatenate(chunks) if chunks else np.zeros(0, np.int32)
        lengths = self.lengths[chunks]
        ids = self.ids[ranges(self.starts[chunks], lengths)]
        ends = np.concatenate(([0], np.cumsum(lengths)))[np.cumsum(counts)]
        return ids, np.concatenate(([0], ends))

    def _learn(self) -> None:
        """Encode the chunks met for the first time, all together."""
        new = self.index.new
        if not new:
            return
        self.index.new = []
        joined = "\n".join(new)
        if "\0" in joined or "<|" in joined or not SETTLED.match(joined):
            plain = [i for i, c in enumerate(new) if "\0" not in c and "<|" not in c and SETTLED.match(c)]
            odd = sorted(set(range(len(new))) - set(plain))
            joined = "\n".join(new[i] for i in plain)
        else:
            plain, odd = range(len(new)), []
        if not joined.isascii():
            joined = unicodedata.normalize("NFC", joined).replace("Σ", "σ")
        # Every piece ends with a zero byte, every chunk with a piece that is a line feed.
        text = "\0".join(PIECE.findall(joined.lower() + "\n")) if plain else ""
        data = np.frombuffer(text.encode() + b"\0" * bool(text), np.uint8)
        ends = np.flatnonzero(data == 0)
        begins = np.concatenate(([0], ends[:-1] + 1))[: len(ends)]
        breaks = (ends - begins == 1) & (data[begins] == 10)
        owner = np.asarray(plain, np.int64)[np.minimum(np.cumsum(breaks), max(len(plain) - 1, 0))] if plain else np.zeros(0, np.int64)
        sizes = (ends - begins)[~breaks]
        data, owner = data[ranges(begins[~breaks], sizes)], owner[~breaks]
        fixed: dict[int, int] = {}
        more = []
        for i in odd:
            for part in filter(None, self.special_pattern.split(new[i])):
                if part in self.special:
                    fixed[len(sizes) + len(more)] = self.special[part]
                more += [(i, p) for p in ([b"\0"] if part in self.special else self._library_pieces(part))]
        if more:
            owner = np.concatenate((owner, [i for i, _ in more]))
            sizes = np.concatenate((sizes, [len(p) for _, p in more]))
            data = np.concatenate((data, np.frombuffer(b"".join(p for _, p in more), np.uint8)))
        ids, word = merge_rounds(data, sizes, self)
        counts = np.bincount(word, minlength=len(sizes))
        for piece, token in fixed.items():
            ids[np.searchsorted(word, piece)] = token
        if odd:  # pieces of the odd chunks come last; bring each chunk's ids together
            order = np.argsort(owner[word], kind="stable")
            ids = ids[order]
        lengths = np.bincount(owner, weights=counts, minlength=len(new)).astype(np.int64)
        starts = np.cumsum(lengths) - lengths + len(self.ids)
        self.ids = np.concatenate((self.ids, ids))
        self.starts = np.concatenate((self.starts, starts))
        self.lengths = np.concatenate((self.lengths, lengths))

    def _library_pieces(self, part: str) -> list[bytes]:
        from tokenizers import Tokenizer

        if self._library is None:
            self._library = Tokenizer.from_str(self.rules)
            self._byte = {c: b for b, c in enumerate(_byte_characters())}
        normal = self._library.normalizer.normalize_str(part)
        return [bytes(self._byte[c] for c in p) for p, _ in self._library.pre_tokenizer.pre_tokenize_str(normal)]

    # -- decoding

    def decode(self, ids: np.ndarray) -> bytes:
        """Tokens joined by a space, special ones too, in UTF-8."""
        return b" ".join(map(self.tokens.__getitem__, ids.tolist()))


class _Chunks(dict):
    """Numbers chunks as they come."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, chunk: str) -> int:
        number = self[chunk] = len(self)
        self.new.append(chunk)
        return number


def merge_rounds(data: np.ndarray, sizes: np.ndarray, bpe: WordBpe) -> tuple[np.ndarray, np.ndarray]:
    """Merge all pieces (``sizes`` bytes each, in one array) together; their ids, and each id's piece."""
    symbols = bpe.inner[data]
    last = np.cumsum(sizes) - 1
    symbols[last] = bpe.final[data[last]]
    word = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    done_symbols, done_words = [], []

    def rank_at(i: np.ndarray) -> np.ndarray:
        """Ranks of the pairs that begin at ``i`` (the last symbol of a piece begins none)."""
        keys = bpe.pair_keys(symbols[i], symbols[i + 1])
        at = np.minimum(np.searchsorted(bpe.keys, keys), len(bpe.keys) - 1)
        return np.where((bpe.keys[at] == keys) & (word[i] == word[i + 1]), bpe.ranks[at], NEVER)

    rank = np.full(len(symbols), NEVER)
    rank[:-1] = rank_at(np.arange(len(symbols) - 1))
    while len(symbols):
        begin = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
        lowest = np.minimum.reduceat(rank, begin)
        lowest = np.repeat(lowest, np.diff(np.append(begin, len(symbols))))
        over = lowest == NEVER
        done_symbols.append(symbols[over])
        done_words.append(word[over])
        places = np.flatnonzero((rank == lowest) & ~over)
        if not len(places):
            break
        # Equal symbols in a row (a a a): the pairs overlap, and every second one counts from the left.
        first = np.append(True, np.diff(places) > 1)
        run = np.maximum.accumulate(np.where(first, np.arange(len(places)), 0))
        places = places[(np.arange(len(places)) - run) % 2 == 0]
        symbols[places] = bpe.merged[rank[places]]
        keep = ~over
        keep[places + 1] = False
        symbols, word, rank = symbols[keep], word[keep], rank[keep]
        changed = (np.cumsum(keep) - 1)[places]
        changed = np.concatenate((changed, changed - 1))
        rank[changed[changed == len(symbols) - 1]] = NEVER
        changed = changed[(changed >= 0) & (changed < len(symbols) - 1)]
        rank[changed] = rank_at(changed)
    symbols = np.concatenate(done_symbols) if done_symbols else np.zeros(0, np.int32)
    word = np.concatenate(done_words) if done_words else np.zeros(0, np.int32)
    order = np.argsort(word, kind="stable")
    return symbols[order], word[order]


_ENCODERS: dict[str, WordBpe] = {}


def encoder(vocabulary: Broadcast) -> WordBpe:
    """This process's encoder; it outlives a task, and so do the chunks it knows."""
    key = hashlib.md5(vocabulary.value["json"].encode()).hexdigest()
    if key not in _ENCODERS:
        _ENCODERS[key] = WordBpe(vocabulary.value)
    return _ENCODERS[key]


def share_vocabulary(spark: SparkSession, path: str) -> Broadcast:
    return spark.sparkContext.broadcast(read_vocabulary(path))


def bpe_round_trip(df: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids, decoded) of every whole text.

    No shuffle; one pass over the texts. A null text is empty: no ids, an empty decoded text. Ids
    of rows may be null or repeated; each row gives one row. Other columns are left out.
    """
    shared = share_vocabulary(df.sparkSession, vocabulary_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(shared)
        for rows, _, _ in text_chunks(batches, "text"):
            ids, ends = bpe.encode([t or "" for t in rows.column("text").to_pylist()])
            each = [ids[a:b] for a, b in zip(ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("doc_id"),
                    pa.array(np.diff(ends)),
                    pa.array([x.astype("<u4").tobytes() for x in each], pa.binary()),
                    pa.array([bpe.decode(x) for x in each], pa.binary()).cast(pa.string()),
                ],
                ["doc_id", "n_tokens", "ids", "decoded"],
            )

    kind = df.schema[id_col].dataType.simpleString()
    picked = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return picked.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids binary, decoded string")


def op3_bpe(df: DataFrame, vocabulary_path: str) -> DataFrame:
    """Digest columns of ``bpe_round_trip``; the hashes are taken by Spark."""
    return bpe_round_trip(df, vocabulary_path).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
