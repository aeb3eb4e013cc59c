"""Removal of repeated 100-byte strings, by suffix sorting with bucket-pointer refinement.

Every 100-byte window has an anchor: its 32-byte string with the smallest hash (the leftmost of equals).
Equal windows have equal anchors at equal places, so only windows whose anchors occur more than once
can repeat, and all that can be equal meet where their anchor's hash is dealt.

1. Each task finds the anchors of its texts; hashes are dealt to buckets, which tell the documents
   which of their anchors occur again. Of each hash a task sends one place: a hot passage costs as many
   rows as there are tasks.
2. Documents with such anchors send the bytes around them, once per task and content; places with the
   same bytes behind the first one in the task are settled there.
3. In each bucket the windows are suffix-sorted up to 100 bytes: buckets of 32-byte strings are refined
   by sorting on the buckets of later offsets, each refinement with the bucket numbers that the one
   before has left, while single windows drop out. Equal windows are compared byte by byte. All but
   the first by document and start are repeats.
4. The starts go back to the documents, which drop the bytes that they cover.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamlab.llm.arrow import binaries, flat_text, mix, ranges, text_chunks

LENGTH, GRAM = 100, 32
SPAN = LENGTH - GRAM + 1
TABLE = mix(np.arange(77, 77 + 256, dtype=np.uint64))
STEP = np.uint64(0xD6E8FEB86659FD93)
#: Bytes of text per bucket; their number grows with the input.
BUCKET_BYTES, LEAST_BUCKETS = 2 << 20, 64
#: Windows that are compared byte by byte at a time; memory only.
COMPARED = 100_000


def grams(data: np.ndarray) -> np.ndarray:
    """Hash of the ``GRAM`` bytes from every position on, by doubling."""
    h, factor, size = TABLE[data], STEP, 1
    while size < GRAM:
        h = h[:-size] * factor + h[size:] if len(h) > size else h[:0]
        factor, size = np.uint64((int(factor) * int(factor)) % (1 << 64)), size * 2
    return mix(h)


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text, place, first window, last window, hash) of every anchor; places count from the start of ``data``."""
    none = np.zeros(0, np.int64)
    if len(data) < LENGTH:
        return none, none, none, none, none.astype(np.uint64)
    h = grams(data)
    key = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
    least, size = key, 1
    while size * 2 <= SPAN:
        least, size = np.minimum(least[:-size], least[size:]), size * 2
    if size < SPAN:
        least = np.minimum(least[: len(key) - SPAN + 1], least[SPAN - size :][: len(key) - SPAN + 1])
    windows = np.maximum(np.diff(offsets) - LENGTH + 1, 0)
    start = ranges(offsets[:-1], windows)
    if not len(start):
        return none, none, none, none, none.astype(np.uint64)
    text = np.repeat(np.arange(len(windows)), windows)
    place = (least[start] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.append(True, (place[1:] != place[:-1]) | (text[1:] != text[:-1]))
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(start)) - 1
    return text[begin], place[begin], start[begin], start[end], h[place[begin]]


def _packed(bucket: np.ndarray, columns: dict[str, np.ndarray], sizes: dict[str, np.ndarray] | None = None) -> pa.RecordBatch:
    """One row per bucket, each column as the bytes of that bucket's values, in their given order."""
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    begin = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else np.zeros(0, np.int64)
    bounds = np.append(begin, len(bucket))
    arrays, names = [pa.array(bucket[begin].astype(np.int64))], ["bucket"]
    for name, values in columns.items():
        names.append(name)
        if sizes and name in sizes:  # values of several bytes each
            size = sizes[name]
            at = np.cumsum(size) - size
            total = np.concatenate(([0], np.cumsum(size[order])))
            arrays.append(binaries(values[ranges(at[order], size[order])], total[bounds]))
        else:
            arrays.append(binaries(values[order], bounds))
    return pa.RecordBatch.from_arrays(arrays, names)


def _by_document(ids: np.ndarray, values: np.ndarray, tags: np.ndarray | None = None) -> pa.RecordBatch:
    """(id, [tag,] found): one row per document with its values as bytes; ``values`` has a row per entry."""
    keys = [ids] if tags is None else [ids, tags]
    order = np.lexsort(keys[::-1])
    keys, values = [k[order] for k in keys], values[order]
    new = np.zeros(len(ids), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    begin = np.flatnonzero(new)
    width = values.shape[1] if values.ndim == 2 else 1
    found = binaries(values.astype(np.int32).ravel(), np.append(begin, len(ids)) * width)
    return pa.RecordBatch.from_arrays([*(pa.array(k[begin]) for k in keys), found], [*["id", "tag"][: len(keys)], "found"])


def _unpacked(batch: pa.RecordBatch, kinds: dict[str, np.dtype]) -> dict[str, np.ndarray]:
    return {name: flat_text(batch.column(name))[1].view(kind) for name, kind in kinds.items()}


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows of one bucket at a time, from sorted batches."""
    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        bucket = batch.column("bucket").to_numpy()
        cuts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else []
        for a, b in zip(cuts, [*cuts[1:], len(bucket)]):
            if waiting and waiting[-1].column("bucket")[-1].as_py() != bucket[a]:
                yield pa.Table.from_batches(waiting)
                waiting = []
            waiting.append(batch.slice(a, b - a))
    if waiting:
        yield pa.Table.from_batches(waiting)


PLACE = {"id": np.dtype("i8"), "p": np.dtype("i4")}
SETTLED = PLACE | {"tag": np.dtype("i8"), "n": np.dtype("i4")}
CONTEXT = SETTLED | {"lo": np.dtype("i4")}


def _find_anchors(n_buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of each hash its first place in the chunk, dealt by hash; places of hashes that a chunk has twice, by document."""
        for rows, data, offsets in text_chunks(batches, "text"):
            text, place, _, _, h = anchors(data, offsets)
            ids = rows.column("id").to_numpy()[text]
            p = (place - offsets[text]).astype(np.int32)
            order = np.argsort(h, kind="stable")
            hs = h[order]
            first = np.append(True, hs[1:] != hs[:-1]) if len(hs) else np.zeros(0, bool)
            twice = np.zeros(len(hs), bool)
            twice[1:] |= ~first[1:]
            twice[:-1] |= ~first[1:]
            # A hash that the chunk has twice is sent twice, so that its bucket knows. In page order,
            # equal and near numbers stand together and compress.
            send = np.concatenate((np.sort(order[first]), np.sort(order[first & twice])))
            at = (h[send] % np.uint64(n_buckets)).astype(np.int64)
            yield _packed(at, {"h": h[send], "id": ids[send], "p": p[send]})
            known = np.sort(order[twice])
            at = (mix(ids[known].astype(np.uint64)) % np.uint64(n_buckets)).astype(np.int64)
            out = _packed(at, {"id": ids[known], "p": p[known]})
            yield pa.RecordBatch.from_arrays(
                [out.column(0), pa.nulls(out.num_rows, pa.binary()), *out.columns[1:]], ["bucket", "h", "id", "p"]
            )

    return run


def _shared_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, found): places of anchors whose hash came more than once."""
    for table in _buckets(batches):
        for batch in table.combine_chunks().to_batches():
            dealt = batch.filter(batch.column("h").is_valid())
            known = batch.filter(batch.column("h").is_null())
            x = _unpacked(dealt, {"h": np.dtype("u8"), **PLACE})
            _, which, count = np.unique(x["h"], return_inverse=True, return_counts=True)
            more = count[which] > 1
            y = _unpacked(known, PLACE)
            yield _by_document(*(np.concatenate((x[c][more], y[c])) for c in ("id", "p")))


def _send_contexts(n_buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Windows of shared anchors and the bytes they cover, dealt by hash; settled starts, by document.

        ``p`` and ``lo`` are the places of the anchor and of its first window, ``n`` the number of windows.
        Settled starts have no hash: ``p`` is the first of ``n`` starts.
        """
        for chunk, _, _ in text_chunks(batches, "text"):
            rows = chunk.take(pc.sort_indices(chunk, sort_keys=[("id", "ascending"), ("tag", "ascending")]))
            offsets, data = flat_text(rows.column("text"))
            text, place, lo, hi, h = anchors(data, offsets)
            lists = rows.column("places").combine_chunks() if isinstance(rows.column("places"), pa.ChunkedArray) else rows.column("places")
            owner = np.repeat(np.arange(rows.num_rows), np.diff(lists.offsets.to_numpy()))
            values = lists.flatten()
            at, raw = flat_text(values)
            wanted = raw.view(np.int32).astype(np.int64) + np.repeat(offsets[owner], np.diff(at) // 4)
            keep = np.isin(place, wanted)
            text, place, lo, hi, h = (x[keep] for x in (text, place, lo, hi, h))
            ids, tags = rows.column("id").to_numpy()[text], rows.column("tag").to_numpy()[text]
            size = hi - lo + LENGTH
            raw = data[ranges(lo, size)]
            # Same bytes around the same anchor: all but the first in the chunk only repeat it.
            keys = [hashlib.blake2b(raw[a : a + n], digest_size=16).digest() for a, n in zip((np.cumsum(size) - size).tolist(), size.tolist())]
            shape = (place - lo).tolist()
            seen: dict[tuple, int] = {}
            leader = np.array([seen.setdefault((k, s), i) for i, (k, s) in enumerate(zip(keys, shape))], np.int64)
            start = offsets[text]
            same = (ids == ids[leader]) & (tags == tags[leader]) & (place - start == place[leader] - start[leader]) if len(leader) else np.zeros(0, bool)
            first, repeat = leader == np.arange(len(leader)), ~same
            bucket = (h % np.uint64(n_buckets)).astype(np.int64)
            shift = {"id": ids, "tag": tags, "p": (place - start).astype(np.int32), "lo": (lo - start).astype(np.int32), "n": (hi - lo + 1).astype(np.int32)}
            byte_keep = np.repeat(first, size)
            yield _packed(
                bucket[first],
                {"h": h[first], **{k: v[first] for k, v in shift.items()}, "raw": raw[byte_keep]},
                {"raw": size[first]},
            )
            bucket = (mix(ids[repeat].astype(np.uint64)) % np.uint64(n_buckets)).astype(np.int64)
            out = _packed(bucket, {"id": ids[repeat], "tag": tags[repeat], "p": shift["lo"][repeat], "n": shift["n"][repeat]})
            nothing = pa.nulls(out.num_rows, pa.binary())
            yield pa.RecordBatch.from_arrays(
                [out.column("bucket"), nothing, out.column("id"), out.column("tag"), out.column("p"), nothing, out.column("n"), nothing],
                ["bucket", "h", "id", "tag", "p", "lo", "n", "raw"],
            )

    return run


def repeated_windows(raw: np.ndarray, start: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Which windows of ``LENGTH`` bytes from ``start`` in ``raw`` equal a window of lower rank.

    Suffix sorting with bucket pointers: the buckets of the first ``GRAM`` bytes are refined by those
    ``GRAM``, 2 ``GRAM`` and ``LENGTH - GRAM`` bytes further on, each time with the pointers left by the step before.
    """
    first_gram = grams(raw)
    active = np.arange(len(start))
    pointer = first_gram[start]
    repeated = np.zeros(len(start), bool)
    for later in (0, GRAM, 2 * GRAM, LENGTH - GRAM):
        if later:
            pointer = mix(pointer * STEP + first_gram[start[active] + later])
        _, pointer, count = np.unique(pointer, return_inverse=True, return_counts=True)
        shared = count[pointer] > 1
        active, pointer = active[shared], pointer[shared].astype(np.uint64)
        if not len(active):
            return repeated
    order = np.lexsort((rank[active], pointer))
    active, pointer = active[order], pointer[order]
    begin = np.flatnonzero(np.append(True, pointer[1:] != pointer[:-1]))
    leader = np.repeat(active[begin], np.diff(np.append(begin, len(active))))
    reach = np.arange(LENGTH)
    for a in range(0, len(active), COMPARED):
        x, y = active[a : a + COMPARED], leader[a : a + COMPARED]
        equal = (raw[start[x][:, None] + reach] == raw[start[y][:, None] + reach]).all(axis=1)
        if not equal.all():
            raise ArithmeticError("two strings of 100 bytes have the same 64-bit hashes")
        repeated[x] = rank[x] > rank[y]
    return repeated


def _sort_suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, tag, found): first and number of starts in a row whose strings occur earlier."""
    for table in _buckets(batches):
        batch = table.combine_chunks().to_batches()[0]
        dealt = batch.filter(batch.column("h").is_valid())
        settled = batch.filter(batch.column("h").is_null())
        y = _unpacked(settled, SETTLED)
        out_id, out_tag, out = [y["id"]], [y["tag"]], [np.stack((y["p"], y["n"]), axis=1)]
        x = _unpacked(dealt, {"h": np.dtype("u8"), **CONTEXT, "raw": np.dtype("u1")})
        size = x["n"].astype(np.int64) + LENGTH - 1
        at = np.cumsum(size) - size
        _, which, count = np.unique(x["h"], return_inverse=True, return_counts=True)
        keep = np.flatnonzero(count[which] > 1)
        if len(keep):
            # Rank of a document's place among all here; windows of equal bytes lie at equal distance from their anchors.
            order = np.lexsort((x["p"][keep], x["tag"][keep], x["id"][keep]))
            changed = np.zeros(len(keep), np.int64)
            for c in ("id", "tag", "p"):
                v = x[c][keep][order]
                changed[1:] |= v[1:] != v[:-1]
            rank = np.empty(len(keep), np.int64)
            rank[order] = np.cumsum(changed)
            n = x["n"][keep].astype(np.int64)
            entry = np.repeat(np.arange(len(keep)), n)
            repeated = repeated_windows(x["raw"], ranges(at[keep], n), rank[entry])
            start = ranges(x["lo"][keep], n)[repeated]
            entry = entry[repeated]
            new = np.append(True, (start[1:] != start[:-1] + 1) | (entry[1:] != entry[:-1])) if len(start) else np.zeros(0, bool)
            begin = np.flatnonzero(new)
            runs = np.diff(np.append(begin, len(start)))
            out_id.append(x["id"][keep][entry[begin]])
            out_tag.append(x["tag"][keep][entry[begin]])
            out.append(np.stack((start[begin].astype(np.int32), runs.astype(np.int32)), axis=1))
        yield _by_document(np.concatenate(out_id), np.concatenate(out), np.concatenate(out_tag))


def _cover(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Drop what the starts cover; bytes of a character that was cut in part go from ``text`` as well."""
    for rows, data, offsets in text_chunks(batches, "text"):
        lists, tags = rows.column("starts"), rows.column("tag").to_pylist()
        removed, kept, spans = [], [], []
        for i, (a, b) in enumerate(zip(offsets[:-1], offsets[1:])):
            own, parts = data[a:b], [x["found"] for x in lists[i].as_py() or () if x["tag"] == tags[i]]
            if parts:
                runs = np.concatenate([np.frombuffer(x, np.int32) for x in parts]).reshape(-1, 2).astype(np.int64)
                size = len(own) + 1
                edge = np.bincount(runs[:, 0], minlength=size) - np.bincount(runs.sum(axis=1) + LENGTH - 1, minlength=size)
                gone = np.cumsum(edge)[:-1] > 0
                flips = np.flatnonzero(np.diff(np.concatenate(([0], gone.view(np.int8), [0]))))
                own = own[~gone]
                spans.append([{"start": int(x), "end": int(y)} for x, y in zip(flips[::2], flips[1::2])])
            else:
                spans.append([])
            removed.append(b - a - len(own))
            kept.append(own.tobytes())
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        yield pa.RecordBatch.from_arrays(
            [
                rows.column("other"),
                pa.array(np.diff(offsets)),
                pa.array(removed, pa.int64()),
                pa.array(kept, pa.binary()),
                pa.array([k.decode("utf-8", "ignore") for k in kept], pa.string()),
                pa.array(spans, span),
            ],
            ["other", "n_bytes", "n_removed", "kept", "text", "spans"],
        )


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(other, n_bytes, n_removed, kept, text, spans): what is left of every text; ``other`` has the other columns.

    A byte goes if a string of 100 bytes that covers it also starts earlier: in a document with a smaller id,
    or further up in its own. ``kept`` are the bytes that stay, ``text`` the whole characters among them, ``spans``
    what was cut. A null text is empty. Rows without an id come after all ids below 2^62, in an order given by a
    hash of their text, and are a document for each text. Rows that repeat an id (or have none) and a text are
    one document and get the same result; rows with one id and other texts are ordered by a hash of the text.
    """
    total = df.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    n_buckets = max(LEAST_BUCKETS, -(-total // BUCKET_BYTES))
    text = F.coalesce(F.col(text_col), F.lit(""))
    # Both joins take the same columns, so the texts are shuffled once.
    texts = df.select(
        # Rows without an id have keys of their own by text: no key gathers the places of all of them.
        F.coalesce(F.col(id_col).cast("long"), F.lit(1 << 62).bitwiseOR(F.shiftrightunsigned(F.xxhash64(text), 2))).alias("id"),
        F.xxhash64(text).alias("tag"),
        text.alias("text"),
        F.struct(*(F.col(c) for c in df.columns if c != text_col)).alias("other"),
    )
    places = "bucket long, h binary, id binary, p binary"
    dealt = texts.select("id", "text").mapInArrow(_find_anchors(n_buckets), places)
    shared = dealt.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_shared_anchors, "id long, found binary")
    shared = shared.groupBy("id").agg(F.collect_list("found").alias("places"))
    near = texts.join(shared, "id")
    columns = "bucket long, h binary, id binary, tag binary, p binary, lo binary, n binary, raw binary"
    contexts = near.mapInArrow(_send_contexts(n_buckets), columns)
    repeats = contexts.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_sort_suffixes, "id long, tag long, found binary")
    repeats = repeats.groupBy("id").agg(F.collect_list(F.struct("tag", "found")).alias("starts"))
    row = texts.schema["other"].dataType.simpleString()
    out = f"other {row}, n_bytes long, n_removed long, kept binary, text string, spans array<struct<start:bigint,end:bigint>>"
    return texts.join(repeats, "id", "left").mapInArrow(_cover, out)


#: The same rows in DuckDB: every window of 100 bytes (as hexadecimal text) with the first place where it starts.
ORACLE = """
WITH bytes AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents
), windows AS (
  SELECT doc_id, s, substr(h, 2 * s + 1, 200) AS w FROM (SELECT *, unnest(range(0, n - 99)) AS s FROM bytes)
), repeats AS (
  SELECT doc_id, s FROM (SELECT *, row_number() OVER (PARTITION BY w ORDER BY doc_id, s) AS k FROM windows) WHERE k > 1
), runs AS (
  SELECT doc_id, min(s) AS a, max(s) + 100 AS b FROM (
    SELECT *, sum(CASE WHEN s > before + 100 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY s) AS run
    FROM (SELECT *, coalesce(lag(s) OVER (PARTITION BY doc_id ORDER BY s), s) AS before FROM repeats)
  ) GROUP BY doc_id, run
), gaps AS (
  SELECT b.doc_id, coalesce(lag(r.b) OVER (PARTITION BY b.doc_id ORDER BY r.a), 0) AS p, r.a AS q, b.h FROM bytes b JOIN runs r USING (doc_id)
), ends AS (SELECT doc_id, max(b) AS e, sum(b - a) AS gone, count(*) AS k FROM runs GROUP BY doc_id
), kept AS (
  SELECT doc_id, string_agg(substr(h, 2 * p + 1, 2 * (q - p)), '' ORDER BY p) AS h FROM gaps GROUP BY doc_id
)
SELECT b.doc_id, CAST(b.n AS BIGINT) AS n_bytes, CAST(coalesce(e.gone, 0) AS BIGINT) AS n_removed, CAST(coalesce(e.k, 0) AS BIGINT) AS n_spans,
  sha256(unhex(coalesce(k.h, '') || substr(b.h, 2 * coalesce(e.e, 0) + 1))) AS kept_sha256
FROM bytes b LEFT JOIN ends e USING (doc_id) LEFT JOIN kept k USING (doc_id)
"""


def op4_repeats(docs: DataFrame) -> DataFrame:
    found = remove_repeats(docs.select("doc_id", "text"))
    return found.select(
        F.col("other.doc_id").alias("doc_id"),
        "n_bytes",
        "n_removed",
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
