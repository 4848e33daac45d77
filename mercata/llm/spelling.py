"""Spelling variants: words one edit apart, found over a bit-sliced position index.

1. Words are counted in pieces of text inside tasks; only (word, count) of a piece is shuffled.
   Whether a run loses a code point follows from crc32 of its document and itself, so equal runs of
   a document share the answer; the checksum of both is put together from that of each.
2. A pair one edit apart agrees before its first difference and, shifted by one if a code point is
   inserted, behind it.  With ``m`` the shorter length, words are dealt out by what stands outside a
   window ``[lo, hi)``: the first difference lies in one window only, so a pair meets and counts
   once.  Windows are the halves of a word; a group of over ``GROUP`` words halves its window again,
   down to one position, where the alphabet bounds the group.  No group grows with the vocabulary.
3. In a group, one bitset per (position, letter) marks the words with that letter there.  A query
   word walks its letters; one AND per letter carries the set of words without an error and, beside
   it, the sets with one error: a replaced letter, and an inserted one, which reads the bitset of
   the next position.  All words of the group advance at once.
4. A group returns one row per word (near words, best of them), never pairs.  Forms are followed to
   their roots by pointer doubling.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercata.llm.common import pieces, pin, width

MIN_LENGTH = 5
MIN_COUNT = 3
FORM_TIMES = 2   # a form occurs at least so many times as often as the word
GROUP = 2_048    # words of a group that are searched together
DELETE = 97      # runs whose checksum this divides lose a code point
_DOC, _TEXT = "__llm_doc", "__llm_text"
_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_WINDOW = ["m", "lo", "hi", "before", "after"]


@cache
def _shift_tables(n: int) -> np.ndarray:
    """What ``n`` further bytes make of each byte of a checksum (CRC is linear in it)."""
    zeros = bytes(n)
    none = zlib.crc32(zeros, 0)
    bits = [zlib.crc32(zeros, 1 << i) ^ none for i in range(32)]
    out = np.zeros((4, 256), np.uint32)
    for i, b in enumerate(bits):
        out[i // 8][(np.arange(256) >> i % 8 & 1).astype(bool)] ^= np.uint32(b)
    return out


def crc_of_both(first: np.ndarray, second: np.ndarray, n_second: np.ndarray) -> np.ndarray:
    """crc32(a + b) from crc32(a), crc32(b) and the byte lengths of b."""
    out = second.copy()
    for n in np.unique(n_second).tolist():
        at = n_second == n
        c, t = first[at], _shift_tables(n) if n < 4096 else _shift_tables.__wrapped__(n)
        out[at] ^= t[0][c & 255] ^ t[1][c >> 8 & 255] ^ t[2][c >> 16 & 255] ^ t[3][c >> 24]
    return out


def count_piece(ids: list, texts: list[str], min_length: int = MIN_LENGTH) -> Counter:
    """Words of some texts and how often they occur (see ``spelling_variants``)."""
    runs: list[str] = []
    lens = []
    for t in texts:
        r = _RUN.findall(t)
        lens.append(len(r))
        runs += r
    if not runs:
        return Counter()
    coded = pa.array(runs, pa.string()).dictionary_encode()
    # runs hold no code point beyond U+00FF, and bytes.lower changes A-Z only
    lower = pa.array([w.encode("latin-1").lower().decode("latin-1") for w in coded.dictionary.to_pylist()], pa.string()).dictionary_encode()
    words = lower.dictionary.to_pylist()
    code = lower.indices.to_numpy()[coded.indices.to_numpy()].astype(np.int64)
    pair, times = np.unique(np.repeat(np.arange(len(texts)), lens) * len(words) + code, return_counts=True)
    doc, code = pair // len(words), pair % len(words)
    raw = [w.encode() for w in words]
    heads = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) for i in ids], np.uint32)
    h = crc_of_both(heads[doc], np.array([zlib.crc32(w) for w in raw], np.uint32)[code], np.array([len(w) for w in raw])[code])
    cut = h % np.uint32(DELETE) == 0
    n = np.bincount(code[~cut], weights=times[~cut], minlength=len(words)).astype(np.int64)
    out = Counter({w: k for w, k in zip(words, n.tolist(), strict=True) if k and len(w) >= min_length})
    for c, x, k in zip(code[cut].tolist(), h[cut].tolist(), times[cut].tolist(), strict=True):
        w = words[c]
        if len(w) > min_length:
            at = x % len(w)
            out[w[:at] + w[at + 1:]] += k
    return out


def _counted(batches: Iterator[pa.RecordBatch], min_length: int) -> Iterator[pa.RecordBatch]:
    for piece in pieces(batches, _TEXT, 8 << 20):
        found = count_piece(piece.column(_DOC).to_pylist(), [t or "" for t in piece.column(_TEXT).to_pylist()], min_length)
        yield pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.string()), pa.array(found.values(), pa.int64())], names=["word", "n"])


def one_edit_apart(words: list[str], m: int, lo: int, hi: int) -> tuple[list[int], list[int]]:
    """Per word how many near words it has with the first difference in ``[lo, hi)``, and the first of them (or -1).

    ``words`` are distinct, of length m or m + 1, agree before ``lo`` and in their last ``m - hi``
    letters.  If the window reaches the end, a letter behind the last one counts too.
    """
    of: list[dict[str, int]] = [{} for _ in range(hi - lo + 1)]
    long = 0
    for i, w in enumerate(words):
        bit = 1 << i
        if len(w) > m:
            long |= bit
        for place, c in zip(of, w[lo:hi + 1], strict=False):
            place[c] = place.get(c, 0) | bit
    everything = (1 << len(words)) - 1
    short = everything ^ long
    n, best = [0] * len(words), [-1] * len(words)
    for i, q in enumerate(words):
        if len(q) > m:
            continue  # found from the shorter side
        same, replaced, inserted = everything, 0, 0
        for p, c in enumerate(q[lo:hi]):
            here, shifted = of[p].get(c, 0), of[p + 1].get(c, 0)
            differs = same & ~here
            replaced = replaced & here | differs & short
            inserted = (inserted | differs & long) & shifted
            same &= here
        if hi == m:
            inserted |= same & long
        found = replaced | inserted
        if found:
            n[i] += found.bit_count()
            first = (found & -found).bit_length() - 1
            best[i] = first if best[i] < 0 else min(best[i], first)
        while inserted:
            low = inserted & -inserted
            j = low.bit_length() - 1
            inserted ^= low
            n[j] += 1
            best[j] = i if best[j] < 0 else min(best[j], i)
    return n, best


def _searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by window and rank: per word of a group its near words there and the best of them."""
    group, words, counts = None, [], []

    def done() -> pa.RecordBatch:
        n, best = one_edit_apart(words, *group[:3])
        some = [i for i, k in enumerate(n) if k]
        return pa.RecordBatch.from_arrays(
            [pa.array([words[i] for i in some], pa.string()), pa.array([n[i] for i in some], pa.int64()),
             pa.array([counts[best[i]] for i in some], pa.int64()), pa.array([words[best[i]] for i in some], pa.string())],
            names=["word", "n_near", "best_n", "best"])

    for batch in batches:
        for *key, word, n in zip(*(batch.column(c).to_pylist() for c in [*_WINDOW, "word", "n"]), strict=True):
            if key != group:
                if len(words) > 1:
                    yield done()
                group, words, counts = key, [], []
            words.append(word)
            counts.append(n)
    if len(words) > 1:
        yield done()


def _dealt(rows: DataFrame, lo: Column, hi: Column) -> DataFrame:
    """``rows(word, n, m)`` with the window and what stands outside it."""
    return rows.select("word", "n", "m", lo.cast("int").alias("lo"), hi.cast("int").alias("hi")) \
        .withColumn("before", F.expr("left(word, lo)")).withColumn("after", F.expr("right(word, m - hi)"))


def _halves(rows: DataFrame, lo: Column, hi: Column) -> DataFrame:
    """Every row once per half of its window."""
    middle = F.floor((lo + hi) / 2)
    both = rows.select("word", "n", "m", F.explode(F.array(F.struct(lo.alias("a"), middle.alias("b")), F.struct(middle.alias("a"), hi.alias("b")))).alias("w"))
    return _dealt(both, F.col("w.a"), F.col("w.b"))


def _groups(vocabulary: DataFrame, min_length: int, group: int) -> DataFrame:
    """Words by window, every group small or a single position wide."""
    length = F.char_length("word")
    sized = vocabulary.select("word", "n", F.explode(F.array(length, length - 1)).alias("m")).where(F.col("m") >= min_length)
    dealt, settled = _halves(sized, F.lit(0), F.col("m")), None
    while True:
        large = pin(dealt.where("hi - lo > 1").groupBy(*_WINDOW).count().where(F.col("count") > group).select(*_WINDOW), "spelling-large")
        if large.isEmpty():
            return dealt if settled is None else settled.unionByName(dealt)
        small = dealt.join(large, _WINDOW, "left_anti").select(dealt.columns)
        settled = small if settled is None else settled.unionByName(small)
        dealt = _halves(dealt.join(large, _WINDOW, "left_semi").select("word", "n", "m", "lo", "hi"), F.col("lo"), F.col("hi"))


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root`` for every word of ``forms(word, form)``; forms occur more often, so no chain closes."""
    at = pin(forms.select("word", F.coalesce("form", "word").alias("root"), F.col("form").isNull().alias("settled")), "spelling-roots")
    while not at.where("not settled").isEmpty():
        up = at.select(F.col("word").alias("root"), F.col("root").alias("up"), F.col("settled").alias("there"))
        moved = at.where("not settled").join(up, "root").select("word", F.col("up").alias("root"), F.col("there").alias("settled"))
        at = pin(at.where("settled").unionByName(moved), "spelling-roots")
    return at.select("word", "root")


def vocabulary(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
               min_count: int = MIN_COUNT) -> DataFrame:
    """``word, n`` of the words that are long and frequent enough (pinned)."""
    rows = docs.select(F.col(f"`{id_col}`").cast("string").alias(_DOC), F.col(f"`{text_col}`").alias(_TEXT)).where(F.col(_TEXT).isNotNull())
    counted = rows.mapInArrow(lambda it: _counted(it, min_length), "word string, n long")
    return pin(counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count), "spelling-words")


def spelling_variants(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
                      min_count: int = MIN_COUNT, group: int = GROUP) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of the vocabulary.

    Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF, lower-cased in A-Z only; a run whose
    crc32 with its document's id is divisible by 97 loses a code point.  ``n_near``: words exactly
    one inserted, deleted or replaced code point away; ``form``: the most frequent of them (ties:
    the first in code-point order), if at least twice as frequent; ``root``: the last form.

    Null texts have no words; a null id stands as an empty string; repeated rows count each time;
    runs of any length are words; other columns are not read; no words give no rows.
    """
    words = vocabulary(docs, id_col=id_col, text_col=text_col, min_length=min_length, min_count=min_count)
    order = [*_WINDOW, F.desc("n"), "word"]
    dealt = _groups(words, min_length, group).repartition(width(docs.sparkSession), *_WINDOW).sortWithinPartitions(*order) \
        .select(*_WINDOW, "word", "n")
    best = F.min(F.struct((-F.col("best_n")).alias("of"), F.col("best").alias("form"))).alias("best")
    near = dealt.mapInArrow(_searched, "word string, n_near long, best_n long, best string").groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    often = -F.col("best.of") >= FORM_TIMES * F.col("n")
    joined = pin(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(often, F.col("best.form")).alias("form"),
        F.when(often, -F.col("best.of")).alias("form_n")), "spelling-forms")
    return joined.join(_roots(joined.select("word", "form")), "word").select("word", "form", "root", "n", "n_near", "form_n")
