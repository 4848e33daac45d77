"""Word-shingle Jaccard self-join: size-banded tiles, bitmap bounds, exact intersection.

A document's set is its distinct shingles (64-bit hashes).  Two documents link at a similarity of
``percent`` or more.  The join is exact; every step below only removes pairs that cannot link or
whose ends are known to be connected already.

1. Which shingles stand in more than one document?  Each task sends every distinct shingle of a
   piece of a few MB once (one that stands in several of its documents is known to be shared), so
   a shingle of a third of all documents costs one entry per piece.  The answers come back as
   counts per document.  A document needs ``percent`` of its shingles shared to have any link; the
   others are done.
2. Equal sets become one class.  Classes get their sorted sets and a parity bitmap.
3. Cheap links first: classes that agree in a minimum hash meet with their sets in cells of bounded
   size, one member per label, and connected classes get one label; so for a few rounds.  Groups of
   near copies collapse here: of two that link, most meet in the first round.
4. Tiles: what is left are pairs of different labels.  Shingles that occur under several labels
   are ordered by how rare they are (all others before them); two sets that link share one of the
   first ``n - ceil(t n) + 1``.  A tile is such a shingle and a band of set sizes; large tiles are
   cut into blocks and every pair of blocks is a cell.  In a cell, sizes and the bitmaps' differing
   bits bound the overlap from above.  Classes that may link, directly or over others, are one
   group; each goes to its group with its set once, and pairs there are intersected exactly.
5. Components over all links found.

No cell emits all its pairs: it joins classes as it finds pairs, skips those that are joined, and
emits the joining ones only, fewer than it has classes, however large a group of copies is.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercata.llm.common import pieces, pin, width
from mercata.llm.components import components

SHINGLE_WORDS = 5
PERCENT = 80
PIECE = 8 << 20
PART = 1 << 20  # characters of a piece whose words a task holds at once
ROUNDS = 2              # minimum hashes
BITS = 1024             # parity bitmap, at least; BITS_PER_SHINGLE for larger sets
BITS_PER_SHINGLE = 2    # unrelated sets of n then differ in some 0.86 n bits, linked ones in 0.22 n at most
BLOCK = 1_000           # classes per block of a tile or a round's cell
BLOCK_SHINGLES = 4 << 20  # shingles of a block (32 MB)
_DOC, _TEXT = "__llm_doc", "__llm_text"
_MULT = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def shingle_sets(texts: list[str], k: int = SHINGLE_WORDS) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; words end at ASCII white space, A-Z in lower case."""
    words: list[bytes] = []
    lens = []
    for t in texts:
        w = t.encode().lower().split()  # bytes: ASCII letters and white space only
        lens.append(len(w))
        words += w
    if not words:
        return [np.zeros(0, np.uint64) for _ in texts]
    coded = pa.array(words, pa.binary()).dictionary_encode()
    h = pd.util.hash_array(np.array(coded.dictionary.to_pylist(), dtype=object), categorize=False)[coded.indices.to_numpy()]
    rolled = np.full(max(len(h) - k + 1, 0), np.uint64(k))
    for j in range(k):
        rolled = _mix(rolled * _MULT[0] + h[j:j + len(rolled)] * _MULT[j % len(_MULT)])
    out, at = [], 0
    for n in lens:
        if n >= k:
            out.append(np.unique(rolled[at:at + n - k + 1]))
        elif n:
            one = np.full(1, np.uint64(1_000_003 * n))
            for j in range(n):
                one = _mix(one * _MULT[0] + h[at + j:at + j + 1] * _MULT[j % len(_MULT)])
            out.append(one)
        else:
            out.append(np.zeros(0, np.uint64))
        at += n
    return out


def _sets_by_parts(texts: list[str], k: int) -> list[np.ndarray]:
    """``shingle_sets``, with the words of some ``PART`` characters in memory at a time."""
    out, start, size = [], 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= PART or i + 1 == len(texts):
            out += shingle_sets(texts[start:i + 1], k)
            start, size = i + 1, 0
    return out


def _digest(s: np.ndarray) -> bytes | None:
    return hashlib.md5(s.astype("<u8").tobytes(), usedforsecurity=False).digest() if len(s) else None


# ---- step 1: documents with enough shared shingles

_ASK = [("bucket", pa.int32()), ("piece", pa.int64()), ("n_docs", pa.int64()), ("hashes", pa.binary()), ("owners", pa.binary()),
        ("docs", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())), ("known", pa.list_(pa.int64())), ("digests", pa.list_(pa.binary())),
        ("keys", pa.list_(pa.binary()))]


def _asked(batches: Iterator[pa.RecordBatch], n_buckets: int, k: int) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(_ASK)
    for piece in pieces(batches, _TEXT, PIECE):
        texts = [t or "" for t in piece.column(_TEXT).to_pylist()]
        keys = [hashlib.md5(t.encode(), usedforsecurity=False).digest() for t in texts]
        sets = _sets_by_parts(texts, k)
        first = piece.column("__llm_row")[0].as_py()
        sizes, digests = [len(s) for s in sets], [_digest(s) for s in sets]
        h = np.concatenate(sets)
        del texts, sets  # each array of all shingles goes as soon as it is used
        owner = np.repeat(np.arange(len(sizes), dtype=np.uint32), sizes)
        order = np.argsort(h, kind="stable")
        h, owner = h[order], owner[order]
        del order
        new = np.ones(len(h), bool)
        new[1:] = h[1:] != h[:-1]
        alone = new.copy()
        alone[:-1] &= new[1:]
        known = np.bincount(owner[~alone], minlength=len(sizes))
        h, owner = h[new], np.where(alone[new], owner[new], np.uint32(0xFFFFFFFF))  # no single owner: no answer needed
        bucket = h >> np.uint64(40)
        bucket %= np.uint64(n_buckets)
        bucket = bucket.astype(np.uint16 if n_buckets <= 65_535 else np.int64)
        order = np.argsort(bucket, kind="stable")
        h, owner = h[order], owner[order]
        bounds = np.searchsorted(bucket[order], np.arange(n_buckets + 1))
        del order, bucket
        meta = first % n_buckets
        for b in range(n_buckets):
            a, z = bounds[b], bounds[b + 1]
            if a == z and b != meta:
                continue
            # 40 bits are enough to ask: a false match keeps a document for the exact steps
            low = np.ascontiguousarray(h[a:z]).view(np.uint8).reshape(-1, 8)[:, :5].tobytes()
            extra = (piece.column(_DOC).to_pylist(), sizes, known.tolist(), digests, keys) if b == meta else (None,) * 5
            row = (b, first, len(sizes), low, zlib.compress(owner[a:z].astype("<u4").tobytes(), 1), *extra)
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, (_, t) in zip(row, _ASK, strict=True)], schema=schema)


_ANSWER = [("piece", pa.int64()), ("counts", pa.binary()), *_ASK[5:]]


def _answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by bucket: per piece and bucket how many of each document's shingles others have."""
    bucket, held = None, []

    def low(row: dict) -> np.ndarray:
        raw = np.zeros((len(row["hashes"]) // 5, 8), np.uint8)
        raw[:, :5] = np.frombuffer(row["hashes"], np.uint8).reshape(-1, 5)
        return raw.view("<u8").ravel()

    def done() -> Iterator[pa.RecordBatch]:
        ranked = np.empty(sum(len(row["hashes"]) // 5 for row in held), np.uint64)  # the only array of all hashes
        at = 0
        for row in held:
            part = low(row)
            ranked[at:at + len(part)] = part
            at += len(part)
        ranked.sort()
        twice = np.unique(ranked[1:][ranked[1:] == ranked[:-1]])
        del ranked
        for row in held:
            part = low(row)
            place = np.searchsorted(twice, part)
            shared = place < len(twice)
            shared[shared] = twice[place[shared]] == part[shared]
            owner = np.frombuffer(zlib.decompress(row["owners"]), "<u4")
            hit = owner[shared]
            counts = np.bincount(hit[hit != 0xFFFFFFFF], minlength=row["n_docs"])
            values = (row["piece"], zlib.compress(counts.astype("<u4").tobytes(), 1), *(row[c] for c, _ in _ASK[5:]))
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, (_, t) in zip(values, _ANSWER, strict=True)], schema=pa.schema(_ANSWER))

    for batch in batches:
        for row in batch.to_pylist():
            if row["bucket"] != bucket and held:
                yield from done()
                held = []
            bucket = row["bucket"]
            held.append(row)
    if held:
        yield from done()


def _judged(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by piece: one row per document, ``digest`` null unless it may have a link."""
    piece = total = meta = None

    def done() -> pa.RecordBatch:
        sizes = np.array(meta["sizes"], np.int64)
        alive = (100 * (total + np.array(meta["known"], np.int64)) >= percent * sizes) & (sizes > 0)
        digests = [d if a else None for d, a in zip(meta["digests"], alive.tolist(), strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(meta["docs"], pa.int64()), pa.array(sizes), pa.array(digests, pa.binary()),
                                           pa.array(meta["keys"], pa.binary())], names=["doc_id", "n_shingles", "digest", "text_key"])

    for batch in batches:
        for row in batch.to_pylist():
            counts = np.frombuffer(zlib.decompress(row["counts"]), "<u4").astype(np.int64)
            if row["piece"] != piece:
                if meta is not None:
                    yield done()
                piece, total, meta = row["piece"], np.zeros(len(counts), np.int64), None
            total += counts
            if row["docs"] is not None:
                meta = row
    if meta is not None:
        yield done()


def shared_documents(docs: DataFrame, id_col: str, text_col: str, k: int, percent: int) -> DataFrame:
    """doc_id, n_shingles, digest of the set (null if the document can have no link), text_key (MD5 of the text)."""
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias(_DOC), F.col(f"`{text_col}`").alias(_TEXT),
                       F.monotonically_increasing_id().alias("__llm_row"))
    n = width(docs.sparkSession)
    meta = "docs array<long>, sizes array<long>, known array<long>, digests array<binary>, keys array<binary>"
    asked = rows.mapInArrow(lambda it: _asked(it, n, k),
                            f"bucket int, piece long, n_docs long, hashes binary, owners binary, {meta}")
    answered = asked.repartition(n, "bucket").sortWithinPartitions("bucket").mapInArrow(_answered, f"piece long, counts binary, {meta}")
    return answered.repartition(n, "piece").sortWithinPartitions("piece") \
        .mapInArrow(lambda it: _judged(it, percent), "doc_id long, n_shingles long, digest binary, text_key binary")


# ---- step 2: classes of equal sets

def _parity(s: np.ndarray) -> bytes:
    """Bitmap of a set: a power of two of bits that grows with it."""
    bits = max(BITS, 1 << (BITS_PER_SHINGLE * len(s) - 1).bit_length())
    odd = np.bincount((s % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def _sets(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for piece in pieces(batches, _TEXT):
        sets = [s for s in _sets_by_parts([t or "" for t in piece.column(_TEXT).to_pylist()], k) if len(s)]
        mins = [[int(_mix(s ^ (_MULT[r % 5] + np.uint64(r))).view(np.int64).min()) for r in range(ROUNDS)] for s in sets]
        yield pa.RecordBatch.from_arrays(
            [pa.array([_digest(s) for s in sets], pa.binary()), pa.array([len(s) for s in sets], pa.int64()),
             pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())), pa.array(mins, pa.list_(pa.int64())),
             pa.array([_parity(s) for s in sets], pa.binary())], names=["digest", "n", "hashes", "mins", "bitmap"])


# ---- steps 3 and 4: cells

_CELL_COLUMNS = ["block", "home", "digest", "label", "n", "bitmap"]


class _Cell:
    """The classes of a cell: which pairs may link by sizes and bitmaps, and which labels are joined."""

    def __init__(self, rows: list[dict], crossing: bool, percent: int) -> None:
        self.rows, self.crossing, self.percent = rows, crossing, percent
        self.n = np.array([r["n"] for r in rows], np.int64)
        number: dict[bytes, int] = {}
        self.label = np.array([number.setdefault(r["label"], len(number)) for r in rows])
        self.block = np.array([r["block"] for r in rows])
        self.home = np.array([r["home"] for r in rows])
        self.words = np.array([len(r["bitmap"]) // 8 for r in rows])  # of the bitmap
        self.place = np.zeros(len(rows), np.int64)
        self.bits: dict[int, np.ndarray] = {}  # bitmaps by their size
        for size in set(self.words.tolist()):
            own = np.flatnonzero(self.words == size)
            self.place[own] = np.arange(len(own))
            self.bits[size] = np.frombuffer(b"".join([rows[i]["bitmap"] for i in own.tolist()]), np.uint64).reshape(-1, size)

    def differing(self, i: int, js: np.ndarray) -> np.ndarray:
        """Bits in which the bitmaps of ``js`` differ from that of ``i``; the longer of two is folded, as parities add up."""
        own = self.bits[self.words[i]][self.place[i]]
        if len(self.bits) == 1:
            return np.bitwise_count(self.bits[len(own)][js] ^ own).sum(axis=1, dtype=np.int64)
        out = np.zeros(len(js), np.int64)
        for size in set(self.words[js].tolist()):
            at = np.flatnonzero(self.words[js] == size)
            short = min(size, len(own))
            theirs = np.bitwise_xor.reduce(self.bits[size][self.place[js[at]]].reshape(len(at), -1, short), axis=1)
            mine = np.bitwise_xor.reduce(own.reshape(-1, short), axis=0)
            out[at] = np.bitwise_count(theirs ^ mine).sum(axis=1, dtype=np.int64)
        return out

    def may_link(self, i: int) -> np.ndarray:
        """Later classes of other labels that nothing rules out."""
        n, later = self.n, slice(i + 1, None)
        both = n[later] + n[i]
        ok = (self.label[later] != self.label[i]) & (self.home[i] | self.home[later])  # two guests meet in another band
        ok &= (100 + self.percent) * np.minimum(n[later], n[i]) >= self.percent * both
        if self.crossing:
            ok &= self.block[later] != self.block[i]
        js = np.flatnonzero(ok) + i + 1
        if not len(js):
            return js
        both = n[js] + n[i]
        most = (both - self.differing(i, js)) // 2
        return js[100 * most >= self.percent * (both - most)]

    def _all_pairs(self) -> Iterator[tuple[int, np.ndarray]]:
        """The same for every class of a small cell at once."""
        n, (bits,) = self.n, self.bits.values()
        both = n[:, None] + n
        most = (both - np.bitwise_count(bits[:, None] ^ bits).sum(axis=2, dtype=np.int64)) // 2
        ok = (100 * most >= self.percent * (both - most)) & (self.label[:, None] != self.label) & (self.home[:, None] | self.home)
        if self.crossing:
            ok &= self.block[:, None] != self.block
        for i, of in enumerate(np.triu(ok, 1)):
            if of.any():
                yield i, np.flatnonzero(of)

    def pairs(self) -> Iterator[tuple[int, np.ndarray]]:
        """Each class with the later ones it may link with."""
        if len(self.bits) == 1 and len(self.rows) ** 2 * int(self.words[0]) <= 1 << 18:
            yield from self._all_pairs()
            return
        for i in range(len(self.rows) - 1):
            js = self.may_link(i)
            if len(js):
                yield i, js

    def _forest(self, group: np.ndarray, links) -> list[tuple[bytes, bytes]]:
        """Pairs that joined two groups, of those for which ``links(i, j)`` holds; others of joined groups are not looked at."""
        out = []
        for i, js in self.pairs():
            for j in js.tolist():
                if group[i] != group[j] and links(self.rows[i], self.rows[j]):
                    group[group == group[j]] = group[i]
                    out.append((self.rows[i]["digest"], self.rows[j]["digest"]))
        return out

    def candidates(self) -> list[tuple[bytes, bytes]]:
        """Pairs that connect all classes that may link with each other, directly or not."""
        return self._forest(np.arange(len(self.rows)), lambda a, b: True)

    def _links(self, a: dict, b: dict) -> bool:
        common = len(np.intersect1d(a["hashes"], b["hashes"], assume_unique=True))
        return 100 * common >= self.percent * (a["n"] + b["n"] - common)

    def links(self) -> list[tuple[bytes, bytes]]:
        """Links, by exact intersection, that joined two labels."""
        return self._forest(self.label, self._links)


def _cells(batches: Iterator[pa.RecordBatch], key: list[str], percent: int, confirm: bool) -> Iterator[pa.RecordBatch]:
    """Rows sorted by cell: pairs that connect what may link, or with the sets at hand the links that joined two labels."""
    cell, held = None, []

    def done() -> pa.RecordBatch:
        of = _Cell(held, "row" in key and cell[-2] != cell[-1], percent)
        out = of.links() if confirm else of.candidates()
        return pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.binary()) for k in (0, 1)], names=["a", "b"])

    for batch in batches:
        keys = list(zip(*(batch.column(c).to_pylist() for c in key), strict=True))
        columns = [batch.column(c).to_pylist() for c in _CELL_COLUMNS]
        sets = batch.column("hashes") if confirm else None
        for i, (at, values) in enumerate(zip(keys, zip(*columns, strict=True), strict=True)):
            if at != cell:
                if len(held) > 1:
                    yield done()
                held = []
            cell = at
            row = dict(zip(_CELL_COLUMNS, values, strict=True))
            if confirm:
                row["hashes"] = sets[i].values.to_numpy()
            held.append(row)
    if len(held) > 1:
        yield done()


def _confirmed(cells: DataFrame, key: list[str], percent: int) -> DataFrame:
    """Joining links ``a, b`` of cells whose rows carry their sets."""
    return cells.select(*key, *_CELL_COLUMNS, "hashes").repartition(width(cells.sparkSession), *key).sortWithinPartitions(*key, "digest") \
        .mapInArrow(lambda it: _cells(it, key, percent, True), "a binary, b binary")


def _blocks() -> Column:
    """Blocks that a group of classes is cut into, by their number and the size of their sets."""
    return F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int")


def _round(sets: DataFrame, labels: DataFrame | None, r: int, percent: int) -> DataFrame:
    """Links among the classes that agree in minimum hash ``r``, one class per label, in blocks."""
    m = F.col("mins")[r].alias("m")
    if labels is None:  # every class is a label of its own and meets with its set at once
        large = pin(sets.select(m, "n").groupBy("m").agg(_blocks().alias("blocks")).where("blocks > 1"), "round-large")
        rows = sets.select(m, "digest", F.col("digest").alias("label"), "n", "bitmap", "hashes").join(large, "m", "left")
        blocks = F.coalesce("blocks", F.lit(1))
    else:
        seen = sets.select("digest", "n", m).join(labels, "digest").groupBy("m", "label").agg(F.min(F.struct("digest", "n")).alias("one"))
        seen = seen.select("m", "label", "one.digest", "one.n")
        size = seen.groupBy("m").agg(_blocks().alias("blocks"), F.count("*").alias("k")).where("k > 1").select("m", "blocks")
        # few are left: saved, so that Spark knows, and does not shuffle the sets for them
        placed = pin(seen.join(size, "m").select("m", "digest", "label", "blocks"), "round-placed")
        rows, blocks = placed.join(sets.select("digest", "n", "bitmap", "hashes"), "digest"), F.col("blocks")
    block = F.pmod(F.xxhash64("digest", F.lit(r)), blocks).cast("int")
    return _confirmed(rows.withColumn("block", block).withColumn("cut", F.col("block")).withColumn("home", F.lit(True)), ["m", "cut"], percent)


def _tiles(sets: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Joining links among classes with different labels: every pair that may link meets in a cell."""
    # one row per class and shingle: no wider than it must be (labels as 64-bit hashes, like the shingles)
    each = sets.join(labels, "digest").select("digest", F.xxhash64("label").alias("of"), F.explode("hashes").alias("shingle"))
    mixed = each.groupBy("shingle").agg(F.count("*").cast("int").alias("df"), F.min("of").alias("lo"), F.max("of").alias("hi")) \
        .where("lo <> hi").select("shingle", "df")
    found = each.select("digest", "shingle").join(mixed, "shingle").groupBy("digest").agg(F.sort_array(F.collect_list(F.struct("df", "shingle"))).alias("of")) \
        .join(sets.select("digest", "n"), "digest")
    # how many of the rarest shingles to look at; those under one label come first and find nothing
    prefix = F.col("n") - F.ceil(F.col("n") * percent / 100.0) + 1
    take = prefix - (F.col("n") - F.size("of"))
    taken = found.where(take > 0).select("digest", F.explode(F.slice("of", F.lit(1), take.cast("int"))).alias("x")) \
        .select("digest", F.col("x.shingle").alias("shingle"))
    rows = taken.join(labels.join(sets.select("digest", "n"), "digest"), "digest")
    band = F.floor(F.log(F.col("n")) / math.log(100.0 / percent) + 1e-9).cast("int")
    rows = rows.withColumn("own", band) \
        .select("*", F.explode(F.array(F.col("own"), F.col("own") + 1)).alias("band")) \
        .withColumn("home", F.col("band") == F.col("own"))
    size = rows.groupBy("shingle", "band").agg(_blocks().alias("blocks"), F.min("label").alias("lo"), F.max("label").alias("hi"),
                                               F.max("home").alias("any_home")) \
        .where("lo <> hi and any_home").select("shingle", "band", "blocks")
    # bitmaps join the rows that are left
    rows = rows.join(size, ["shingle", "band"]).join(sets.select("digest", "bitmap"), "digest") \
        .withColumn("block", F.pmod(F.xxhash64("digest"), F.col("blocks")).cast("int")) \
        .select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    cells = rows.select("shingle", "band", F.least("block", "other").alias("row"), F.greatest("block", "other").alias("col"), *_CELL_COLUMNS)
    key = ["shingle", "band", "row", "col"]
    may = pin(cells.repartition(width(sets.sparkSession), *key).sortWithinPartitions(*key, "digest")
              .mapInArrow(lambda it: _cells(it, key, percent, False), "a binary, b binary").distinct(), "cells-may")
    # classes that may link, directly or not, are one group; each goes to it with its set once
    groups = pin(components(may).select(F.col("node").alias("digest"), F.col("label").alias("group")).join(labels, "digest")
                 .join(sets.select("digest", "n"), "digest"), "cells-groups")
    size = groups.groupBy("group").agg(_blocks().alias("blocks"))
    placed = groups.join(size, "group").withColumn("block", F.pmod(F.xxhash64("digest"), F.col("blocks")).cast("int")) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("home", F.lit(True)) \
        .select("group", F.least("block", "other").alias("row"), F.greatest("block", "other").alias("col"), "block", "home", "digest", "label")
    return _confirmed(placed.join(sets.select("digest", "n", "bitmap", "hashes"), "digest"), ["group", "row", "col"], percent)


def _relabel(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels after joining the labels at both ends of every link."""
    a = labels.select(F.col("digest").alias("a"), F.col("label").alias("la"))
    b = labels.select(F.col("digest").alias("b"), F.col("label").alias("lb"))
    ends = links.join(a, "a").join(b, "b").select(F.col("la").alias("a"), F.col("lb").alias("b")).where("a <> b").distinct()
    up = components(ends).select(F.col("node").alias("label"), F.col("label").alias("top"))
    return pin(labels.join(up, "label", "left").select("digest", F.coalesce("top", "label").alias("label")), "class-labels")


def class_components(sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``digest, label``: equal labels for classes connected by links, for every class."""
    labels = sets.select("digest", F.col("digest").alias("label"))
    for r in range(ROUNDS):
        labels = _relabel(labels, pin(_round(sets, labels if r else None, r, percent), "class-links"))
    return _relabel(labels, pin(_tiles(sets, labels, percent), "class-links"))


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE_WORDS,
                    percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id (smallest doc_id connected), and
    text_key (MD5 of the text), stays (is it the document of its component that stays?).

    Null and empty texts and texts of white space have no shingle and link with nothing; a text of
    fewer than ``k`` words is one shingle.  Rows of one id are judged by their own texts.  A
    component whose ids are all null has a null id; other columns are not read; no rows give none.
    Of a component one row stays: the smallest id, of several texts of that id the one of the
    smallest key, and of rows equal in id and text any one.
    """
    base = pin(shared_documents(docs, id_col, text_col, k, percent).withColumn("row", F.monotonically_increasing_id()), "near-base")
    classes = base.where("digest is not null").groupBy("digest") \
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key", "row")).alias("first"))
    classes = pin(classes, "near-classes")
    first = classes.select(F.col("first.doc_id").alias(_DOC)).distinct()
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("__llm_id"), F.col(f"`{text_col}`").alias(_TEXT))
    texts = texts.join(first, F.col("__llm_id").eqNullSafe(F.col(_DOC)), "left_semi").select(_TEXT)
    built = texts.mapInArrow(lambda it: _sets(it, k), "digest binary, n long, hashes array<long>, mins array<long>, bitmap binary")
    # rows of one id may have several texts: only the sets of the classes stay, each once
    kept = built.join(classes.select("digest"), "digest", "left_semi")
    sets = pin(kept.groupBy("digest").agg(*(F.first(c).alias(c) for c in ("n", "hashes", "mins", "bitmap"))), "near-sets")
    labels = class_components(sets, percent)
    groups = classes.join(labels, "digest").groupBy("label").agg(F.min("first").alias("best"))
    of = labels.join(groups, "label").select("digest", "best")
    out = base.join(of, "digest", "left")
    return out.select("doc_id", "n_shingles", F.when(F.col("best").isNull(), F.col("doc_id")).otherwise(F.col("best.doc_id")).alias("component_id"),
                      "text_key", (F.col("best").isNull() | (F.col("best.row") == F.col("row"))).alias("stays"))
