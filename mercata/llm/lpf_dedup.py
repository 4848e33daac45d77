"""Removing repeated passages: longest-previous-factor arrays over the suffixes that can repeat.

Every byte covered by a string of ``LENGTH`` bytes that also starts earlier (smaller document id, or
earlier in the same document) is removed; the first copy stays.  A suffix array of the whole corpus
does not fit one task, so suffixes are dealt out such that equal strings meet:

1. Each window of ``LENGTH`` bytes has an anchor: the place of its smallest 32-byte hash, leftmost of
   equals.  Equal windows have their anchor at the same offset and with the same hash.  Neighbouring
   windows share anchors, about one for 35 windows.
2. Each task asks, once per distinct anchor hash and piece of a few MB, whether the hash stands
   elsewhere; a passage of a third of all documents costs one entry per piece.
3. Only texts with such anchors are read again.  Each such anchor sends the bytes of its windows
   (168 at most) to the bucket of its hash; equal texts send once, for their first document.
4. A bucket sorts its suffixes, cut at ``LENGTH`` bytes, and equal ones by position.  Among suffixes
   whose common prefix reaches ``LENGTH`` the previous smaller position is then the left neighbour
   and a next smaller one does not exist, so a suffix's longest previous factor reaches ``LENGTH``
   if and only if it agrees with its left neighbour.
5. The windows found are merged per text, and the rest of the text is hashed.

A whole copy of an earlier text of ``LENGTH`` bytes or more goes as a whole.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercata.llm.common import pieces, pin, width

LENGTH = 100
GRAM = 32
PIECE = 2 << 20
BROADCAST_ROWS = 1_000_000  # keys of texts to read again up to which they are broadcast (some 60 MB)
SORT_ROWS = 60_000          # anchors sorted together at least; a hash is never torn apart
OUT_ROWS = 100_000          # runs of windows returned at once
_DOC, _TEXT, _KEY, _ROW = "__llm_doc", "__llm_text", "__llm_key", "__llm_row"
_POS_BITS = np.uint64((1 << 31) - 1)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def anchors(data: bytes, starts: np.ndarray, ends: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """Anchors of all windows inside the texts ``data[starts:ends]``: (place, hash, first window, last window)."""
    n = len(data) - length + 1
    if n <= 0:
        return tuple(np.zeros(0, t) for t in (np.int64, np.uint64, np.int64, np.int64))
    word = np.ndarray((len(data) - 7,), "<u8", data, 0, (1,))
    h = _mix(word * np.uint64(0x9E3779B97F4A7C15))
    for gap in (8, 16):  # 8 -> 16 -> 32 bytes
        h = _mix(h[:-gap] * np.uint64(0xC2B2AE3D27D4EB4F) + h[gap:] * np.uint64(0x165667B19E3779F9))
    low = (h & ~_POS_BITS) | np.arange(len(h), dtype=np.uint64)  # smallest hash first, then leftmost
    span, have = length - GRAM + 1, 1
    while have < span:
        step = min(have, span - have)
        low = np.minimum(low[:-step], low[step:])
        have += step
    place = (low & _POS_BITS).astype(np.int64)
    valid = np.zeros(n + 1, np.int32)  # windows inside one text
    some = ends - starts >= length
    np.add.at(valid, starts[some], 1)
    np.add.at(valid, ends[some] - length + 1, -1)
    own = np.flatnonzero(np.cumsum(valid)[:n] > 0)
    if not len(own):
        return tuple(np.zeros(0, t) for t in (np.int64, np.uint64, np.int64, np.int64))
    p = place[own]
    new = np.ones(len(own), bool)
    new[1:] = (p[1:] != p[:-1]) | (own[1:] != own[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(own)) - 1
    return p[first], h[p[first]], own[first], own[last]


def _deltas(values: np.ndarray) -> bytes:
    return zlib.compress(np.diff(values, prepend=0).astype("<i8").tobytes(), 1)


def _summed(blob: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(zlib.decompress(blob), "<i8"))


# ---- step 2: which anchors stand elsewhere

_META = [("starts", pa.binary()), ("known", pa.binary()), ("keys", pa.list_(pa.binary()))]
_ASK = [("bucket", pa.int32()), ("piece", pa.int64()), ("hashes", pa.binary()), ("places", pa.binary()), *_META]
_ANSWER = [("piece", pa.int64()), ("places", pa.binary()), *_META]
_META_DDL = "starts binary, known binary, keys array<binary>"


def _row(values: tuple, types: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([v], t) for v, (_, t) in zip(values, types, strict=True)], schema=pa.schema(types))


def _asked(batches: Iterator[pa.RecordBatch], n_buckets: int, length: int) -> Iterator[pa.RecordBatch]:
    for piece in pieces(batches, _TEXT, PIECE):
        texts = {}
        for t in piece.column(_TEXT).to_pylist():
            raw = (t or "").encode()
            if len(raw) >= length:
                texts.setdefault(hashlib.md5(raw, usedforsecurity=False).digest(), raw)
        if not texts:
            continue
        first = piece.column(_ROW)[0].as_py()
        ends = np.cumsum([len(t) for t in texts.values()])
        starts = ends - np.array([len(t) for t in texts.values()])
        place, h, _, _ = anchors(b"".join(texts.values()), starts, ends, length)
        order = np.argsort(h, kind="stable")
        new = np.ones(len(h), bool)
        new[1:] = h[order][1:] != h[order][:-1]
        at = np.flatnonzero(new)
        times = np.diff(np.append(at, len(h)))
        known = np.sort(place[order][np.repeat(times, times) > 1])
        keep = np.sort(order[at])  # one entry per hash, in the order of the text
        h, place = h[keep], place[keep]
        bucket = ((h >> np.uint64(40)) % np.uint64(n_buckets)).astype(np.uint16 if n_buckets <= 65_535 else np.int64)
        order = np.argsort(bucket, kind="stable")
        h, place = h[order], place[order]
        bounds = np.searchsorted(bucket[order], np.arange(n_buckets + 1))
        meta = first % n_buckets
        for b in range(n_buckets):
            a, z = bounds[b], bounds[b + 1]
            if a == z and b != meta:
                continue
            # 40 bits are enough to ask: a false match only sends a few bytes more
            low = np.ascontiguousarray(h[a:z]).view(np.uint8).reshape(-1, 8)[:, :5].tobytes()
            extra = (_deltas(starts), _deltas(known), list(texts)) if b == meta else (None, None, None)
            yield _row((b, first, low, _deltas(place[a:z]), *extra), _ASK)


def _answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    bucket, held = None, []

    def done() -> Iterator[pa.RecordBatch]:
        parts = []
        for row in held:
            raw = np.zeros((len(row["hashes"]) // 5, 8), np.uint8)
            raw[:, :5] = np.frombuffer(row["hashes"], np.uint8).reshape(-1, 5)
            parts.append(raw.view("<u8").ravel())
        h = np.concatenate(parts)
        order = np.argsort(h)
        same = np.zeros(len(h), bool)
        same[1:] = h[order][1:] == h[order][:-1]
        same[:-1] |= same[1:]
        shared = np.zeros(len(h), bool)
        shared[order] = same
        at = 0
        for row, part in zip(held, parts, strict=True):
            hit = _summed(row["places"])[shared[at:at + len(part)]]
            at += len(part)
            if len(hit) or row["keys"] is not None:
                yield _row((row["piece"], _deltas(hit), *(row[c] for c, _ in _META)), _ANSWER)

    for batch in batches:
        for row in batch.to_pylist():
            if row["bucket"] != bucket and held:
                yield from done()
                held = []
            bucket = row["bucket"]
            held.append(row)
    if held:
        yield from done()


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by piece: per text the anchors that stand elsewhere too."""
    piece, found, meta = None, [], None

    def done() -> pa.RecordBatch:
        starts = _summed(meta["starts"])
        at = np.unique(np.concatenate([*found, _summed(meta["known"])])).astype(np.int64)
        text = np.searchsorted(starts, at, side="right") - 1
        some, first = np.unique(text, return_index=True)
        lists = [x.tolist() for x in np.split(at - starts[text], first[1:])] if len(some) else []
        return pa.RecordBatch.from_arrays([pa.array([meta["keys"][i] for i in some.tolist()], pa.binary()), pa.array(lists, pa.list_(pa.int32()))],
                                          names=[_KEY, "places"])

    for batch in batches:
        for row in batch.to_pylist():
            if row["piece"] != piece:
                if meta is not None:
                    yield done()
                piece, found, meta = row["piece"], [], None
            found.append(_summed(row["places"]))
            if row["keys"] is not None:
                meta = row
    if meta is not None:
        yield done()


# ---- steps 3 and 4: suffixes of the anchors' windows

def _sent(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    for piece in pieces(batches, _TEXT, PIECE):
        raws = [t.encode() for t in piece.column(_TEXT).to_pylist()]
        ends = np.cumsum([len(t) for t in raws])
        starts = ends - np.array([len(t) for t in raws])
        data = b"".join(raws)
        place, h, first, last = anchors(data, starts, ends, length)
        text = np.searchsorted(starts, place, side="right") - 1
        lists = piece.column("places")
        wanted = np.concatenate([np.asarray(x.values, np.int64) + s for x, s in zip(lists, starts.tolist(), strict=True)])
        keep = np.flatnonzero(np.isin(place, wanted))
        if not len(keep):
            continue
        rows = pa.array(text[keep])
        keys = piece.column(_KEY).to_pylist()
        order = [(d is None, d, k) for d, k in zip(piece.column(_DOC).to_pylist(), keys, strict=True)]
        sends = [data[a:b + length] for a, b in zip(first[keep].tolist(), last[keep].tolist(), strict=True)]
        hashes, offset = h[keep].view(np.int64).copy(), (place - first)[keep].astype(np.int32)
        # equal bytes around equal anchors: the first of the piece goes on, for the others all
        # windows start earlier, so a very common passage sends one row per piece
        best: dict[tuple, int] = {}
        for i, same in enumerate(zip(hashes.tolist(), offset.tolist(), sends, strict=True)):
            was = best.setdefault(same, i)
            if was != i:
                late = i
                if (order[text[keep[i]]], first[keep[i]]) < (order[text[keep[was]]], first[keep[was]]):
                    best[same], late = i, was
                sends[late] = b""
        late = np.flatnonzero([not s for s in sends])
        for i in late.tolist():  # no bytes: the windows from first to first + offset are found already
            offset[i] = last[keep[i]] - first[keep[i]]
            hashes[i] = int.from_bytes(keys[text[keep[i]]][:8], "little", signed=True) ^ i
        yield pa.RecordBatch.from_arrays(
            [pa.array(hashes), piece.column(_DOC).take(rows), piece.column(_KEY).take(rows),
             pa.array((first - starts[text])[keep].astype(np.int32)), pa.array(offset), pa.array(sends, pa.binary())],
            names=["hash", _DOC, _KEY, "first", "offset", "bytes"])


def _suffixes(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by hash: runs of windows (text, first start, last start) that also start earlier."""
    held: list[pa.RecordBatch] = []
    rows = 0
    before = None
    for batch in batches:
        if not batch.num_rows:
            continue
        h = batch.column("hash").to_numpy()
        cut = int(np.argmax(h == h[-1]))  # rows before the last hash
        if rows + cut >= SORT_ROWS and (cut or h[0] != before):
            yield from _previous([*held, batch.slice(0, cut)], length)
            held, rows, batch = [], 0, batch.slice(cut)
        held.append(batch)
        rows += batch.num_rows
        before = h[-1]
    if rows:
        yield from _previous(held, length)


def _previous(held: list[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Runs of the windows with an earlier equal; rows without bytes name such a run themselves."""
    table = pa.Table.from_batches(held)
    # 64-bit offsets: with 32-bit ones a hot hash of more than 2 GiB would stay in several chunks
    wide = pa.schema([f.with_type(pa.large_binary()) if f.type == pa.binary() else f for f in table.schema])
    (batch,) = table.cast(wide).combine_chunks().to_batches()
    bare = pa.compute.equal(pa.compute.binary_length(batch.column("bytes")), 0)
    known = batch.filter(bare)
    found = _sorted_runs(batch.filter(pa.compute.invert(bare)), length)
    again = pa.RecordBatch.from_arrays([known.column(_KEY), known.column("first"), pa.compute.add(known.column("first"), known.column("offset"))],
                                       names=[_KEY, "a", "b"])
    for runs in (found, again):
        for at in range(0, runs.num_rows, OUT_ROWS):
            part = runs.slice(at, OUT_ROWS)
            yield pa.RecordBatch.from_arrays([part.column(_KEY).cast(pa.binary()), part.column("a"), part.column("b")], names=[_KEY, "a", "b"])


def _sorted_runs(batch: pa.RecordBatch, length: int) -> pa.RecordBatch:
    n = batch.num_rows
    if not n:
        return pa.RecordBatch.from_arrays([pa.array([], pa.large_binary()), pa.array([], pa.int32()), pa.array([], pa.int32())], names=[_KEY, "a", "b"])
    doc = batch.column(_DOC).fill_null(np.iinfo(np.int64).max).to_numpy()
    key = np.array(batch.column(_KEY).to_pylist(), "S16")
    first = batch.column("first").to_numpy().astype(np.int64)
    offset = batch.column("offset").to_numpy().astype(np.int64)
    position = np.lexsort((first + offset, key, doc))  # by document, then place
    rank = np.empty(n, np.int64)
    rank[position] = np.arange(n)
    column = batch.column("bytes")
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8)
    count = np.diff(bounds) - length + 1  # windows of each anchor
    windows = np.lib.stride_tricks.sliding_window_view(data, length)
    found_row, found_at = [], []
    for o in range(int(offset.max()) + 1):  # windows with their anchor at offset o: only these can be equal
        own = position[(offset[position] - o >= 0) & (offset[position] - o < count[position])]
        if len(own) < 2:
            continue
        suffix = np.ascontiguousarray(windows[bounds[own] + offset[own] - o]).view(f"S{length}").ravel()
        order = np.argsort(suffix, kind="stable")  # equal ones stay by position
        ranked = suffix[order].view(np.uint8).reshape(-1, length)
        again = order[1:][(ranked[1:] == ranked[:-1]).all(axis=1)]
        found_row.append(own[again])
        found_at.append(offset[own[again]] - o)
    if not any(map(len, found_row)):
        return pa.RecordBatch.from_arrays([pa.array([], pa.large_binary()), pa.array([], pa.int32()), pa.array([], pa.int32())], names=[_KEY, "a", "b"])
    row, at = np.concatenate(found_row), np.concatenate(found_at)
    order = np.lexsort((at, row))
    row, at = row[order], at[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (at[1:] != at[:-1] + 1)
    start = np.flatnonzero(new)
    stop = np.append(start[1:], len(row)) - 1
    return pa.RecordBatch.from_arrays(
        [batch.column(_KEY).take(pa.array(row[start])), pa.array((first[row[start]] + at[start]).astype(np.int32)),
         pa.array((first[row[start]] + at[stop]).astype(np.int32))], names=[_KEY, "a", "b"])


# ---- step 5: what is left of each text

def _kept(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    for piece in pieces(batches, _TEXT):
        spans, shas = [], []
        for text, runs in zip(piece.column(_TEXT).to_pylist(), piece.column("runs").to_pylist(), strict=True):
            raw = text.encode()
            merged: list[list[int]] = []
            for r in sorted((r["a"], r["b"] + length) for r in runs):
                if merged and r[0] <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], r[1])
                else:
                    merged.append(list(r))
            rest, at = [], 0
            for a, b in merged:
                rest.append(raw[at:a])
                at = b
            rest.append(raw[at:])
            spans.append([{"start": a, "end": b} for a, b in merged])
            shas.append(hashlib.sha256(b"".join(rest)).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [piece.column(_KEY), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(shas, pa.string())],
            names=[_KEY, "spans", "sha"])


def repeated_spans(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, spans (start, end of removed byte runs), kept_sha256.

    Null texts count as empty; texts shorter than ``length`` lose nothing.  Documents are ordered by
    id, null ids last, then by a hash of the text; rows equal in id and text are one document and
    get one answer.  Other columns are not read; no rows give none.
    """
    spark = docs.sparkSession
    n = width(spark)
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias(_DOC), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias(_TEXT))
    keyed = texts.withColumn(_KEY, F.unhex(F.md5(F.col(_TEXT).cast("binary"))))
    base = pin(keyed.select(_DOC, _KEY, F.octet_length(_TEXT).cast("long").alias("n_bytes"), F.sha2(F.col(_TEXT).cast("binary"), 256).alias("whole")),
               "lpf-base")
    firsts = base.where(F.col("n_bytes") >= length).groupBy(_KEY).agg(F.min(_DOC).alias("first"))

    asked = texts.select(_TEXT, F.monotonically_increasing_id().alias(_ROW)) \
        .mapInArrow(lambda it: _asked(it, n, length), f"bucket int, piece long, hashes binary, places binary, {_META_DDL}")
    answered = asked.repartition(n, "bucket").sortWithinPartitions("bucket").mapInArrow(_answered, f"piece long, places binary, {_META_DDL}")
    placed = answered.repartition(n, "piece").sortWithinPartitions("piece").mapInArrow(_placed, f"{_KEY} binary, places array<int>")
    # a text in several pieces has the same anchors in each
    places = pin(placed.groupBy(_KEY).agg(F.max_by("places", F.size("places")).alias("places")).join(firsts, _KEY), "lpf-places")
    again = places.select(_KEY, F.col("first").alias(_DOC))
    if places.count() <= BROADCAST_ROWS:
        again = F.broadcast(again)
    first_texts = keyed.alias("k").join(again.alias("f"), (F.col(f"k.{_KEY}") == F.col(f"f.{_KEY}")) & F.col(f"k.{_DOC}").eqNullSafe(F.col(f"f.{_DOC}")),
                                        "left_semi")
    # one shuffle of these texts by key serves the join, the distinct and both uses below
    chosen = first_texts.join(places.select(_KEY, "places"), _KEY).dropDuplicates([_KEY]).select(_KEY, _DOC, _TEXT, "places")

    sent = chosen.mapInArrow(lambda it: _sent(it, length), f"hash long, {_DOC} long, {_KEY} binary, first int, offset int, bytes binary")
    runs = sent.repartition(n, "hash").sortWithinPartitions("hash").mapInArrow(lambda it: _suffixes(it, length), f"{_KEY} binary, a int, b int")
    per_text = runs.groupBy(_KEY).agg(F.collect_list(F.struct("a", "b")).alias("runs"))  # at most a text's windows
    cut = chosen.join(per_text, _KEY) \
        .mapInArrow(lambda it: _kept(it, length), f"{_KEY} binary, spans array<struct<start:long,end:long>>, sha string")

    joined = base.join(firsts, _KEY, "left").join(cut, _KEY, "left")
    copy = (F.col("n_bytes") >= length) & ~F.col(_DOC).eqNullSafe(F.col("first"))
    whole = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("end")))
    return joined.select(
        F.col(_DOC).alias("doc_id"), "n_bytes",
        F.when(copy, whole).otherwise(F.coalesce("spans", F.array().cast("array<struct<start:long,end:long>>"))).alias("spans"),
        F.when(copy, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("sha", "whole")).alias("kept_sha256"))
