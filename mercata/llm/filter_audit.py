"""Filter interaction audit: what each filter removes in every order, from additive mask counts.

1. One pass gives every document a bit per failing condition of its own text and the MD5 of it.
2. Duplicates need other documents.  A counting Bloom filter over the text keys, ``CELLS`` cells a
   document, is counted by every task for itself and merged by adding cells; it is a table spread
   over the executors and grows with the documents.  A text with a cell of count one is unique, so
   most texts never move.  Cells with more than ``1 / HEAVY`` of the rows are few whatever the data:
   texts of which every cell is one of those are passed on without a join, so a text of a third of
   all rows is no hot key.
3. The keys that may repeat become a bitmap of bounded size (``BITMAP_BITS``, whatever the data),
   which the second scan consults: other texts are not shuffled at all.  Where the bitmap is too
   small for the keys it lets more pass, and the join behind it settles that.
   Only possible repeats are grouped by their whole texts, combined in the tasks before the shuffle,
   for the smallest id.  The text is compared in full; what the filters let through by accident
   turns out to be alone.
4. A document is then one mask.  Documents are counted per (part, mask), at most 2 ** filters rows a
   part, and every order, step and Shapley sum follows from those counts.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercata.llm.common import pieces, pin, width

LETTERS = "ABCDE"
LEAST_WORDS = 200
DISTINCT_PERCENT = 50
UPPER_PERCENT = 3
SIGNS = b"#$%&*|"
CELLS = 16        # cells of the filter per document
HASHES = 3
HEAVY = 100       # a cell is heavy from 1 / HEAVY of all rows on
BITMAP_BITS = 1 << 28  # of the bitmap that tasks consult, at most (32 MB)
_SEGMENT = 1 << 19     # bits of a row of the bitmap
_DOC, _TEXT, _PART = "__llm_doc", "__llm_text", "__llm_part"
_KIND = np.zeros(256, np.uint8)
_KIND[65:91] = 1                        # A-Z
_KIND[list(SIGNS)] = 2
_KIND[128:192] = 4                      # inside a code point


def own_failures(texts: list[bytes]) -> np.ndarray:
    """Bits 1, 2, 4, 8 for the conditions A to D of each text."""
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes)
    kind = _KIND[np.frombuffer(b"".join(texts), np.uint8)]
    upper, sign, inside = (np.diff(np.searchsorted(np.flatnonzero(kind == k), np.concatenate([[0], ends]))) for k in (1, 2, 4))
    words = [t.split() for t in texts]  # bytes are split at blanks and 0x09 to 0x0D only
    n = np.array([len(w) for w in words], np.int64)
    distinct = np.array([len(set(w)) for w in words], np.int64)
    return (n < LEAST_WORDS) | (100 * distinct < DISTINCT_PERCENT * n) << 1 | (100 * upper > UPPER_PERCENT * (sizes - inside)) << 2 | (sign > 0) << 3


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in pieces(batches, _TEXT, 8 << 20):
        texts = [t or b"" for t in piece.column(_TEXT).cast(pa.binary()).to_pylist()]
        keys = [hashlib.md5(t, usedforsecurity=False).digest() for t in texts]
        yield pa.RecordBatch.from_arrays([piece.column(_DOC), piece.column(_PART), pa.array(own_failures(texts).astype(np.int32)),
                                          pa.array(keys, pa.binary())], names=["doc_id", "part", "mask", "key"])


def _spots(keys: list[bytes], bits: int) -> np.ndarray:
    """Place of each text key in a bitmap of ``bits`` (a power of two)."""
    return (np.frombuffer(b"".join(keys), "<u8").reshape(-1, 2)[:, 0] & np.uint64(bits - 1)).astype(np.int64)


def _segments(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """The segments of the bitmap that a batch of keys sets bits in."""
    for batch in batches:
        at = np.unique(_spots(batch.column("key").to_pylist(), bits))
        for s in np.unique(at // _SEGMENT).tolist():
            own = np.zeros(min(bits, _SEGMENT), np.uint8)
            own[at[at // _SEGMENT == s] - s * _SEGMENT] = 1
            yield pa.RecordBatch.from_arrays([pa.array([s]), pa.array([np.packbits(own, bitorder="little").tobytes()], pa.binary())], names=["segment", "own"])


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by segment: each segment once."""
    at = own = None
    for batch in batches:
        for s, b in zip(batch.column("segment").to_pylist(), batch.column("own").to_pylist(), strict=True):
            if s != at and own is not None:
                yield pa.RecordBatch.from_arrays([pa.array([at]), pa.array([own.tobytes()], pa.binary())], names=["segment", "own"])
                own = None
            at, own = s, np.frombuffer(b, np.uint8) if own is None else own | np.frombuffer(b, np.uint8)
    if own is not None:
        yield pa.RecordBatch.from_arrays([pa.array([at]), pa.array([own.tobytes()], pa.binary())], names=["segment", "own"])


def _passed(batches: Iterator[pa.RecordBatch], shared, bits: int) -> Iterator[pa.RecordBatch]:
    """Texts whose key the bitmap holds, with the key."""
    bitmap = shared.value
    for piece in pieces(batches, _TEXT, 8 << 20):
        keys = [hashlib.md5(t or b"", usedforsecurity=False).digest() for t in piece.column(_TEXT).cast(pa.binary()).to_pylist()]
        at = _spots(keys, bits)
        held = (bitmap[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
        yield pa.RecordBatch.from_arrays([*(piece.column(c) for c in (_DOC, _TEXT)), pa.array(keys, pa.binary())],
                                         names=["doc_id", "text", "text_key"]).filter(pa.array(held))


def _cells(key: Column, cells: int) -> list[Column]:
    """The cells of a text key."""
    return [F.pmod(F.xxhash64(key, F.lit(i)), F.lit(cells)) for i in range(HASHES)]


def _every(tests: list[Column]) -> Column:
    out = tests[0]
    for t in tests[1:]:
        out = out & t
    return out


def masks(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """``part, mask, n, good, toxic``: documents per part and set of failing filters (bit 0 is A), and the labelled ones among them."""
    own = docs.select(F.col(f"`{id_col}`").cast("long").alias(_DOC), F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")).alias(_PART),
                      F.col(f"`{text_col}`").alias(_TEXT)).mapInArrow(_measured, "doc_id long, part string, mask int, key binary")
    flags = pin(own, "audit-flags")
    total = flags.count()
    cells = max(CELLS * total, 1)

    # the merged counting filter, without the cells that clear a text
    spots = flags.select(F.explode(F.array(*_cells(F.col("key"), cells))).alias("cell"))
    sketch = pin(spots.groupBy("cell").count().where("count > 1"), "audit-sketch")
    # at most HASHES * HEAVY cells hold so many rows, whatever the data
    heavy = [r.cell for r in sketch.where(F.col("count") * HEAVY > F.lit(total)).select("cell").collect()]

    def is_heavy(key: Column) -> Column:
        return _every([c.isin(heavy) for c in _cells(key, cells)]) if heavy else F.lit(False)

    rows = flags.groupBy("doc_id", "key", "part", "mask").agg(F.count("*").alias("n"))
    light = rows.where(~is_heavy(F.col("key")))
    for i, cell in enumerate(_cells(F.col("key"), cells)):
        hit = sketch.select(F.col("cell").alias(f"cell{i}"), F.lit(True).alias(f"hit{i}"))
        light = light.withColumn("cell", cell).join(hit, F.col("cell") == F.col(f"cell{i}"), "left").drop("cell", f"cell{i}")
    found = _every([F.col(f"hit{i}").isNotNull() for i in range(HASHES)])
    columns = ["doc_id", "key", "part", "mask", "n", "repeats"]
    rows = pin(light.withColumn("repeats", found).select(columns)
               .union(rows.where(is_heavy(F.col("key"))).withColumn("repeats", F.lit(True)).select(columns)), "audit-rows")

    # exact: smallest id of every whole text that may repeat
    asked = pin(rows.where("repeats").select("key").distinct(), "audit-asked")
    bits = 1 << min(BITMAP_BITS.bit_length() - 1, max(16 * asked.count(), 64).bit_length())
    made = asked.mapInArrow(lambda it: _segments(it, bits), "segment long, own binary").repartition(width(docs.sparkSession), "segment") \
        .sortWithinPartitions("segment").mapInArrow(_merged, "segment long, own binary")
    bitmap = np.zeros(bits // 8, np.uint8)
    for r in made.collect():  # BITMAP_BITS at most
        bitmap[r.segment * (_SEGMENT // 8):][:len(r.own)] = np.frombuffer(r.own, np.uint8)
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias(_DOC), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias(_TEXT)) \
        .mapInArrow(lambda it: _passed(it, shared, bits), "doc_id long, text string, text_key binary")
    moved = texts.where(~is_heavy(F.col("text_key"))).join(asked, F.col("text_key") == F.col("key"), "left_semi")
    if heavy:
        moved = moved.union(texts.where(is_heavy(F.col("text_key"))))
    first = moved.groupBy("text").agg(F.min("doc_id").alias("first")) \
        .select("first", F.unhex(F.md5(F.col("text").cast("binary"))).alias("first_key")).where("first is not null")

    fails = F.col("repeats") & F.col("doc_id").isNotNull() & F.col("first").isNull()
    judged = rows.join(first, (F.col("doc_id") == F.col("first")) & (F.col("key") == F.col("first_key")), "left") \
        .select("doc_id", "part", "n", F.when(fails, F.col("mask").bitwiseOR(16)).otherwise(F.col("mask")).alias("mask"))
    marks = labels.select(F.col("doc_id").cast("long").alias("__llm_of"), "quality", "toxic").groupBy("__llm_of").agg(
        F.coalesce(F.max((F.col("quality") == 1).cast("long")), F.lit(0)).alias("good"),
        F.coalesce(F.max((F.col("toxic") == 1).cast("long")), F.lit(0)).alias("toxic"))
    marked = judged.join(marks, F.col("doc_id") == F.col("__llm_of"), "left")
    some = [F.sum(F.col("n") * F.coalesce(c, F.lit(0))).alias(c) for c in ("good", "toxic")]
    return marked.groupBy("part", "mask").agg(F.sum("n").alias("n"), *some)


def report(counts: DataFrame, letters: str = LETTERS) -> DataFrame:
    """Every order and step of the filters, from ``counts(part, mask, n, good, toxic)``."""
    bit = {x: 1 << i for i, x in enumerate(letters)}
    steps = [{"filter_order": "".join(o), "step": k + 1, "own": bit[x], "before": sum(bit[y] for y in o[:k])}
             for o in permutations(letters) for k, x in enumerate(o)]
    of_part = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("masks"))  # 2 ** filters at most
    each = of_part.select("part", "masks", F.explode(F.from_json(
        F.lit(json.dumps(steps)), "array<struct<filter_order: string, step: int, own: int, before: int>>")).alias("s")) \
        .select("part", "masks", "s.*")
    n_orders = len(steps) // len(letters)

    def summed(value: str, when: str) -> Column:
        return F.expr(f"aggregate(masks, 0L, (acc, x) -> acc + if({when}, {value}, 0L))")

    fails, earlier = "x.mask & own != 0", "x.mask & before != 0"
    here = f"{fails} and not ({earlier})"
    return each.select(
        "part", "filter_order", "step", summed("x.n", "x.mask & (own | before) = 0").alias("kept"), summed("x.n", here).alias("removed"),
        summed("x.n", f"{fails} and {earlier}").alias("redundant"), summed("x.n", "x.mask = own").alias("unique_fails"),
        summed("x.good", here).alias("good_lost"), summed("x.toxic", here).alias("toxic_lost"),
        # of the orders, one in each number of failing filters has this one first
        summed(f"x.n * ({n_orders} div bit_count(x.mask))", fails).alias("shapley"))


def filter_audit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """One row per part, order of the filters A to E and step, zeros included.

    A: under 200 words; B: under half of the words distinct; C: over 3 % of the code points in A-Z;
    D: holds one of #$%&*|; E: equal to the text of a smaller id.  Null and empty texts are empty (A
    fails, and E behind a smaller id); a null part is the empty string; a null id is not smaller
    than any and behind none, and has no label; rows equal in id and text count each and are no
    repeats of each other; of several labels of an id any 1 counts; other columns are not read; an
    empty table has no parts and gives no rows.
    """
    return report(masks(docs, labels, id_col=id_col, text_col=text_col, part_col=part_col))


# The same rows in DuckDB's SQL.
ORACLE = r"""
WITH docs AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^ \t\n\x0B\f\r]+') AS words
    FROM documents
), flags AS (
    SELECT doc_id, part,
        (CASE WHEN len(words) < 200 THEN 1 ELSE 0 END) + (CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 2 ELSE 0 END)
        + (CASE WHEN 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 3 * length(t) THEN 4 ELSE 0 END)
        + (CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END)
        + (CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END) AS mask
    FROM docs
), marks AS (
    SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
    FROM labels GROUP BY doc_id
), counts AS (
    SELECT part, mask, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
    FROM flags LEFT JOIN marks USING (doc_id) GROUP BY part, mask
), f(l, b) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)
), orders AS (
    SELECT a.l || b.l || c.l || d.l || e.l AS filter_order, [a.b, b.b, c.b, d.b, e.b] AS bits
    FROM f a, f b, f c, f d, f e WHERE a.b + b.b + c.b + d.b + e.b = 31 AND len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5
), steps AS (
    SELECT filter_order, step, bits[step] AS own, coalesce(list_sum(bits[1:step - 1]), 0)::INTEGER AS before
    FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)
), result AS (
    SELECT part, filter_order, step::INTEGER AS step, any_value(own) AS own,
        sum(CASE WHEN mask & (own | before) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
        sum(CASE WHEN mask & own <> 0 AND mask & before = 0 THEN n ELSE 0 END)::BIGINT AS removed,
        sum(CASE WHEN mask & own <> 0 AND mask & before <> 0 THEN n ELSE 0 END)::BIGINT AS redundant,
        sum(CASE WHEN mask = own THEN n ELSE 0 END)::BIGINT AS unique_fails,
        sum(CASE WHEN mask & own <> 0 AND mask & before = 0 THEN good ELSE 0 END)::BIGINT AS good_lost,
        sum(CASE WHEN mask & own <> 0 AND mask & before = 0 THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
    FROM counts, steps GROUP BY part, filter_order, step
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
    sum(removed) OVER (PARTITION BY part, own)::BIGINT AS shapley
FROM result
"""
