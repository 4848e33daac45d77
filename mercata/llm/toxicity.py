"""Toxicity scores: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are the distinct words, word pairs and pairs one word apart, lower-cased and
without the signs around them, hashed to ``2 ** DIM_BITS`` coordinates.  Training follows the
proximal leader with a rate per coordinate and an L1 term that keeps most coordinates at zero, so
what is broadcast is a short list of (coordinate, weight).

The model is fitted on at most ``TRAIN_ROWS`` labelled rows (smallest hashes of their id; the bound
is a parameter), in one task whose memory that bound limits.  Everything is scored, whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercata.llm.common import drop_held, pieces, release_memory

DIM_BITS = 22
TRAIN_ROWS = 16_384
PIECE = 1 << 20  # bytes of text whose features a task holds at once (some 35 MB)
BLOCK = 1 << 17  # coordinates whose final weights are computed at once
THRESHOLD = 0.3
HELD_OUT = 2  # remainder of crc32(id) mod 4 that is never learned from
_SIGNS = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())
_DOC, _TEXT, _LABEL = "__llm_doc", "__llm_text", "__llm_label"


def held_out(id_col: str) -> Column:
    """Is the row kept from learning?  Null ids are not."""
    return F.coalesce(F.pmod(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")), F.lit(4)) == HELD_OUT, F.lit(False))


def feature_indices(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(text number, coordinate) of every word, pair and skip pair; not yet distinct."""
    words: list[str] = []
    lens = np.zeros(len(texts), np.int64)
    for i, t in enumerate(texts):
        w = t.lower().split()
        lens[i] = len(w)
        words += w
    coded = pa.array(words, pa.string()).dictionary_encode()
    distinct = np.array([w.strip(_SIGNS) for w in coded.dictionary.to_pylist()], dtype=object)
    if not len(distinct):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    h = pd.util.hash_array(distinct, categorize=False)[coded.indices.to_numpy()]
    text = np.repeat(np.arange(len(texts)), lens)
    shift = np.uint64(64 - DIM_BITS)
    out_text, out_at = [text], [((h * np.uint64(0x9E3779B97F4A7C15)) >> shift).astype(np.int64)]
    for gap, (a, b) in ((1, (0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)), (2, (0xD6E8FEB86659FD93, 0xA0761D6478BD642F))):
        same = text[:-gap] == text[gap:]
        pair = ((h[:-gap] * np.uint64(a)) ^ (h[gap:] * np.uint64(b) + np.uint64(gap))) * np.uint64(0x9E3779B97F4A7C15)
        out_text.append(text[:-gap][same])
        out_at.append((pair[same] >> shift).astype(np.int64))
    return np.concatenate(out_text), np.concatenate(out_at)


@dataclass(frozen=True)
class Model:
    index: np.ndarray
    weight: np.ndarray
    bias: float

    def dense(self) -> np.ndarray:
        w = np.zeros(1 << DIM_BITS, np.float32)
        w[self.index] = self.weight
        return w


def fit_ftrl(examples: list[np.ndarray], labels: np.ndarray, *, epochs: int = 3, alpha: float = 0.3, beta: float = 1.0,
             l1: float | None = None, l2: float = 1.0) -> Model:
    """FTRL-proximal on examples given as arrays of distinct coordinates.

    A text has thousands of coordinates and few of them matter, so ``l1`` asks for the evidence of
    several examples: 6 by default, less if there are few toxic ones (1 per 250, 1 at least).
    """
    dim = 1 << DIM_BITS
    if l1 is None:
        l1 = min(6.0, max(1.0, labels.sum() / 250))
    z, n = np.zeros(dim + 1), np.zeros(dim + 1)
    offset = float(np.log((labels.sum() + 1) / (len(labels) - labels.sum() + 99)))  # of no rows: 1 in 100

    def weights(at: np.ndarray) -> np.ndarray:
        zi = z[at]
        limit = np.where(at == dim, 0.0, l1)  # the last coordinate is the bias
        return np.where(np.abs(zi) <= limit, 0.0, (np.sign(zi) * limit - zi) / ((beta + np.sqrt(n[at])) / alpha + l2))

    for _ in range(epochs):
        for at, y in zip(examples, labels, strict=True):
            at = np.append(at, dim).astype(np.int64)
            w = weights(at)
            g = 1.0 / (1.0 + np.exp(-np.clip(w.sum() + offset, -35, 35))) - y
            grown = n[at] + g * g
            z[at] += g - (np.sqrt(grown) - np.sqrt(n[at])) / alpha * w
            n[at] = grown
    some, final = [], []
    for a in range(0, dim, BLOCK):  # not all at once: seven more arrays as large as z
        at = a + np.flatnonzero(n[a:a + BLOCK])  # others were never touched and weigh nothing
        w = weights(at)
        some.append(at[w != 0])
        final.append(w[w != 0].astype(np.float32))
    return Model(np.concatenate(some), np.concatenate(final), float(weights(np.array([dim]))[0]) + offset)


def train(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          max_rows: int = TRAIN_ROWS) -> Model:
    """Fit on labelled rows outside the held-out quarter, at most ``max_rows`` ids.

    Null labels and null ids teach nothing; an id labelled twice is toxic if any label says so;
    without labels every score is that of the bias (0.01).
    """
    teach = labels.select(F.col(f"`{id_col}`").alias(_DOC), F.col(f"`{label_col}`").cast("int").alias(_LABEL)) \
        .where(F.col(_DOC).isNotNull() & F.col(_LABEL).isNotNull() & ~held_out(_DOC)) \
        .groupBy(_DOC).agg(F.max(_LABEL).alias(_LABEL)) \
        .orderBy(F.xxhash64(_DOC), _DOC).limit(max_rows)
    texts = docs.select(F.col(f"`{id_col}`").alias(_DOC), F.col(f"`{text_col}`").alias(_TEXT))
    # the taught ids are at most max_rows pairs of numbers: a bounded broadcast
    shown = texts.join(F.broadcast(teach), _DOC).groupBy(_DOC, _LABEL).agg(F.first(_TEXT, ignorenulls=True).alias(_TEXT)) \
        .select(F.xxhash64(_DOC).alias("turn"), _LABEL, _TEXT)
    found = shown.mapInArrow(_examples, "turn long, label int, at array<int>")
    one = found.repartition(1).sortWithinPartitions("turn")  # at most max_rows examples
    rows = one.mapInArrow(_fit, "at array<int>, weight array<float>, bias double").collect()
    if not rows:
        return fit_ftrl([], np.zeros(0))
    return Model(np.array(rows[0].at, np.int64), np.array(rows[0].weight, np.float32), rows[0].bias)


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in pieces(batches, _TEXT, PIECE):
        text, at = feature_indices([t or "" for t in part.column(_TEXT).to_pylist()])
        both = np.unique(text << DIM_BITS | at)
        cuts = np.searchsorted(both >> DIM_BITS, np.arange(part.num_rows + 1)).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(cuts), pa.array((both & ((1 << DIM_BITS) - 1)).astype(np.int32)))
        yield pa.RecordBatch.from_arrays([part.column("turn"), part.column(_LABEL).cast(pa.int32()), lists], names=["turn", "label", "at"])


def _fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    drop_held()
    examples, labels = [], []
    batch = None
    for batch in batches:
        labels += batch.column("label").to_pylist()
        examples += [x.values.to_numpy() for x in batch.column("at")]  # views of the batch
    if not examples:
        return
    model = fit_ftrl(examples, np.array([min(max(y, 0), 1) for y in labels]))
    del batch, examples
    release_memory()  # the worker scores next
    yield pa.RecordBatch.from_arrays([pa.array([model.index.astype(np.int32)], pa.list_(pa.int32())),
                                      pa.array([model.weight], pa.list_(pa.float32())), pa.array([model.bias])],
                                     names=["at", "weight", "bias"])


def _scores(model: Model, column: pa.Array) -> Iterator[np.ndarray]:
    """Scores of a text column, piece by piece: only a piece's texts become Python strings."""
    named = pa.RecordBatch.from_arrays([column], names=[_TEXT])
    for part in pieces(iter([named]), _TEXT, PIECE):
        yield _piece_scores(model, part.column(0))


def _piece_scores(model: Model, column: pa.Array) -> np.ndarray:
    text, at = feature_indices([t or "" for t in column.to_pylist()])
    place = np.minimum(np.searchsorted(model.index, at), max(len(model.index) - 1, 0))
    live = model.index[place] == at if len(model.index) else np.zeros(len(at), bool)
    both = np.unique(text[live] << DIM_BITS | place[live])
    total = np.bincount(both >> DIM_BITS, model.weight[both & ((1 << DIM_BITS) - 1)], len(column))
    return 1.0 / (1.0 + np.exp(-np.clip(total + model.bias, -35, 35)))


def score_column(spark, model: Model, text_col: str = "text") -> Column:
    """Score of a text column, 0 to 1.  Null and empty texts get the bias; no other column is read."""
    shared = spark.sparkContext.broadcast(model)

    def scores(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in texts:
            yield pa.array(np.concatenate([np.zeros(0), *_scores(shared.value, column)]))

    scores.__annotations__ = {"texts": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(scores, "double")(F.col(f"`{text_col}`"))


def accepted(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with all their columns.

    Rows pass through the tasks piece by piece, so none are queued beside the scoring.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches, at, PIECE):
            yield part.filter(pa.array(_piece_scores(shared.value, part.column(at)) < threshold))

    return docs.mapInArrow(kept, docs.schema)
