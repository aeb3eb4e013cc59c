"""Hierarchical packing of token sequences into windows of several lengths.

A document is cut into whole long windows; what remains is routed to the shortest tier that holds it.
Each tier opens windows with its own pieces and fills their gaps from shorter tiers, whole pieces
first, then cut ones, whose rest is routed again. What a task has left at its end is cut into powers of
two. So every window is full: there is no padding at all.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamlab.llm.arrow import text_chunks
from streamlab.llm.word_bpe import encoder, share_vocabulary

#: Window lengths, longest first; powers of two.
TIERS = (2048, 1024, 512, 256, 128)
#: Tokens of a step group.
STEP_TOKENS = 1 << 17
END_ID = 1


class Piece(NamedTuple):
    doc: object
    start: int
    ids: np.ndarray
    doc_tokens: int


class Packer:
    """The windows of one task. It holds less than one long window between two calls of ``pack``."""

    def __init__(self, tiers: tuple[int, ...] = TIERS, step_tokens: int = STEP_TOKENS):
        self.tiers, self.step_tokens = tiers, step_tokens
        self.waiting: dict[int, deque[Piece]] = {t: deque() for t in tiers}
        self.sequences, self.steps, self.step_of, self.filled = 0, 0, {}, {}
        self.rows: list[tuple] = []

    def add(self, doc: object, ids: np.ndarray) -> None:
        """Cut off whole long windows, route the rest."""
        longest, total = self.tiers[0], len(ids)
        whole = total - total % longest
        for start in range(0, whole, longest):
            self._emit([Piece(doc, start, ids[start : start + longest], total)], longest)
        if whole < total:
            self._route(Piece(doc, whole, ids[whole:], total))

    def pack(self) -> None:
        """Close every window that can be filled; less than one remains waiting."""
        for k, tier in enumerate(self.tiers):
            sources = (*self.tiers[k + 1 :], tier)
            while self.waiting[tier]:
                window = [self.waiting[tier].popleft()]
                gap = tier - len(window[0].ids)
                while gap:
                    piece = self._next(sources, gap)
                    if piece is None:
                        break
                    window.append(piece)
                    gap -= len(piece.ids)
                if gap:  # nothing is left in this tier or below
                    for piece in window:
                        self._route(piece)
                    return
                self._emit(window, tier)

    def close(self) -> None:
        """Cut what is left into powers of two."""
        self.pack()
        left = [p for t in self.tiers for p in self.waiting[t]]
        total, at = sum(len(p.ids) for p in left), 0
        while total:
            size = 1 << (total.bit_length() - 1)
            window, need = [], size
            while need:
                head, rest = _cut(left[at], need)
                window.append(head)
                need -= len(head.ids)
                if rest is None:
                    at += 1
                else:
                    left[at] = rest
            self._emit(window, size)
            total -= size
        self.waiting = {t: deque() for t in self.tiers}

    def _route(self, piece: Piece) -> None:
        self.waiting[min(t for t in self.tiers if t >= len(piece.ids))].append(piece)

    def _next(self, sources: tuple[int, ...], gap: int) -> Piece | None:
        """The longest tier's first piece that fits whole; else the head of the first piece there is."""
        for tier in sources:
            if self.waiting[tier] and len(self.waiting[tier][0].ids) <= gap:
                return self.waiting[tier].popleft()
        for tier in sources:
            if self.waiting[tier]:
                head, rest = _cut(self.waiting[tier].popleft(), gap)
                if rest is not None:
                    self._route(rest)
                return head
        return None

    def _emit(self, window: list[Piece], tier: int) -> None:
        """Step groups have windows of one length and the same number of tokens, but for a task's last ones."""
        if self.filled.get(tier, 0) + tier > self.step_tokens or tier not in self.step_of:
            self.step_of[tier], self.filled[tier] = self.steps, 0
            self.steps += 1
        self.filled[tier] += tier
        offset = 0
        for p in window:
            crc = zlib.crc32(p.ids.astype("<u4").tobytes())
            self.rows.append(
                (p.doc, p.start, len(p.ids), crc, p.doc_tokens, self.sequences, offset, tier, self.step_of[tier])
            )
            offset += len(p.ids)
        self.sequences += 1


def _cut(piece: Piece, size: int) -> tuple[Piece, Piece | None]:
    if len(piece.ids) <= size:
        return piece, None
    return piece._replace(ids=piece.ids[:size]), piece._replace(start=piece.start + size, ids=piece.ids[size:])


def pack_documents(df: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: where its ids come from, and its place in a sequence of at most 2048 ids.

    Every task packs its own documents, so nothing is shuffled and no two tasks share a sequence. A
    null or empty text has the one id that ends a document. Rows with null or repeated ids are packed
    like any other. ``window`` is the sequence's length, ``step_group`` names sequences of one length
    that make up a step. Other columns are left out.
    """
    shared = share_vocabulary(df.sparkSession, vocabulary_path)
    kind = df.schema[id_col].dataType.simpleString()
    schema = (
        f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
        "offset long, window int, step_group long"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, packer = encoder(shared), Packer()
        base = TaskContext.get().partitionId() << 40
        id_type = None
        for rows, _, _ in text_chunks(batches, "text"):
            id_type = rows.column("doc_id").type
            ids, ends = bpe.encode([t or "" for t in rows.column("text").to_pylist()])
            for doc, a, b in zip(rows.column("doc_id").to_pylist(), ends[:-1], ends[1:]):
                packer.add(doc, np.append(ids[a:b], np.int32(END_ID)))
            packer.pack()
            yield _batch(packer, base, id_type)
        packer.close()
        if packer.rows:
            yield _batch(packer, base, id_type)

    picked = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return picked.mapInArrow(run, schema)


def _batch(packer: Packer, base: int, id_type: pa.DataType) -> pa.RecordBatch:
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "window", "step_group"]
    columns = list(zip(*packer.rows)) or [()] * len(names)
    packer.rows = []
    columns[5] = [base + x for x in columns[5]]
    columns[8] = [base + x for x in columns[8]]
    types = [id_type, *[pa.int64()] * 6, pa.int32(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


def op5_pack(df: DataFrame, vocabulary_path: str) -> DataFrame:
    return pack_documents(df, vocabulary_path)
