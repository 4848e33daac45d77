"""Token counts without ids: pieces per distinct pre-token, joined to per-document frequencies.

The pre-token here is the run between two spaces at which the tokenizer can never merge
(``space_runs``): a whole number of the library's own pre-tokens, so counts add up exactly.

1. Each task cuts its texts and builds, per piece of a few MB, the frequencies (pre-token,
   document, times).  They are dealt by a hash of the pre-token into packed rows, one per piece and
   bucket, so a pre-token that stands in every document still costs one entry per piece.
2. Each bucket holds all frequencies of its pre-tokens: the library counts every distinct one
   once, the join gives each (document, pre-token) its pieces, and sums leave per document, packed
   by the piece the document was in.
3. The sums of a piece's documents are added up over the buckets.  Token ids are never built for
   a document.

A bucket's memory is its distinct pre-tokens; their number falls with the shuffle width.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercata.llm.common import pieces, tokenizer_path, width, with_row_id
from mercata.llm.space_runs import space_runs

PIECE = 12 << 20      # bytes of text whose frequencies are packed together
HEAD = "\x00"         # marks a text's first run, which has no space before it
_ROW, _DOC, _TEXT = "__llm_row", "__llm_doc", "__llm_text"


def _keys(text: str) -> list[str]:
    """Pre-tokens of ``text``; a marked one stands for itself, any other for a space and itself."""
    if HEAD in text:
        return [HEAD + text]
    runs = space_runs(text)
    runs[0] = HEAD + runs[0]
    return runs


def _packed(words: bytes, per_word: np.ndarray, docs: np.ndarray, times: np.ndarray) -> bytes:
    parts = [words, *(a.astype("<u4").tobytes() for a in (per_word, docs, times))]
    return zlib.compress(struct.pack("<4q", *map(len, parts)) + b"".join(parts), 1)


def _unpacked(blob: bytes) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    raw = zlib.decompress(blob)
    at, out = 32, []
    for n in struct.unpack("<4q", raw[:32]):
        out.append(raw[at:at + n])
        at += n
    return (out[0], *(np.frombuffer(x, "<u4") for x in out[1:]))


def _frequencies(batches: Iterator[pa.RecordBatch], n_buckets: int) -> Iterator[pa.RecordBatch]:
    types = [("bucket", pa.int32()), ("piece", pa.int64()), ("n_docs", pa.int64()), ("blob", pa.binary()),
             ("docs", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64()))]
    schema = pa.schema(types)
    for piece in pieces(batches, _TEXT, PIECE):
        texts = [t or "" for t in piece.column(_TEXT).to_pylist()]
        first = piece.column(_ROW)[0].as_py()  # names the piece
        flat: list[str] = []
        lens = np.zeros(len(texts), np.int64)
        for i, t in enumerate(texts):
            keys = _keys(t)
            lens[i] = len(keys)
            flat += keys
        coded = pa.array(flat, pa.string()).dictionary_encode()  # not pandas: it ends a string at NUL
        del flat
        codes, words = coded.indices.to_numpy(), np.array(coded.dictionary.to_pylist(), dtype=object)
        pair, times = np.unique(codes.astype(np.int64) * len(texts) + np.repeat(np.arange(len(texts)), lens), return_counts=True)
        code, doc = pair // len(texts), pair % len(texts)
        bucket = (pd.util.hash_array(words, categorize=False) % np.uint64(n_buckets)).astype(np.int64)
        order = np.argsort(bucket[code], kind="stable")  # code order is kept inside a bucket
        code, doc, times = code[order], doc[order], times[order]
        bounds = np.searchsorted(bucket[code], np.arange(n_buckets + 1))
        meta = first % n_buckets  # one of the buckets also carries the documents themselves
        for b in range(n_buckets):
            a, z = bounds[b], bounds[b + 1]
            if a == z and b != meta:
                continue
            own, per_word = np.unique(code[a:z], return_counts=True)
            blob = _packed(b"\xff".join(w.encode() for w in words[own]), per_word, doc[a:z], times[a:z])
            extra = (piece.column(_DOC).to_pylist(), [len(t.encode()) for t in texts]) if b == meta else (None, None)
            yield pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, (_, t) in zip((b, first, len(texts), blob, *extra), types, strict=True)], schema=schema)


def _joined(batches: Iterator[pa.RecordBatch], vocabulary: str) -> Iterator[pa.RecordBatch]:
    import os

    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    lib = Tokenizer.from_file(tokenizer_path(vocabulary))
    lib.no_truncation()
    lib.no_padding()
    counted: dict[bytes, int] = {}
    bucket = None
    for batch in batches:
        for row in batch.to_pylist():
            if row["bucket"] != bucket:
                bucket = row["bucket"]
                counted.clear()
            raw, per_word, doc, times = _unpacked(row["blob"])
            words = raw.split(b"\xff") if len(per_word) else []
            new = [w for w in words if w not in counted]
            text = [w.decode() for w in new]
            got = lib.encode_batch_fast([w[1:] if w[:1] == HEAD else " " + w for w in text], add_special_tokens=False)
            counted.update(zip(new, map(len, got), strict=True))
            each = np.repeat(np.array([counted[w] for w in words], np.int64), per_word) * times
            total = np.bincount(doc, weights=each, minlength=row["n_docs"])  # exact: far below 2 ** 53
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["piece"]]), pa.array([zlib.compress(total.astype("<u4").tobytes(), 1)]),
                 pa.array([row["docs"]], pa.list_(pa.int64())), pa.array([row["sizes"]], pa.list_(pa.int64()))],
                names=["piece", "sums", "docs", "sizes"])


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by piece: one total per document of each piece."""
    piece = total = docs = sizes = None

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(sizes, pa.int64()), pa.array(total.astype(np.int64))],
                                          names=["doc_id", "n_bytes", "n_tokens"])

    for batch in batches:
        for row in batch.to_pylist():
            sums = np.frombuffer(zlib.decompress(row["sums"]), "<u4").astype(np.int64)
            if row["piece"] != piece:
                if total is not None:
                    yield done()
                piece, total = row["piece"], np.zeros(len(sums), np.int64)
            total += sums
            if row["docs"] is not None:
                docs, sizes = row["docs"], row["sizes"]
    if total is not None:
        yield done()


def token_counts(docs: DataFrame, vocabulary: str = "byte_bpe_50k.json", *, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes (UTF-8), n_tokens.

    Whole texts; null and empty texts have 0 bytes and 0 tokens; rows with equal or null ids stay
    apart; other columns are not read; an empty table gives an empty table.
    """
    spark = docs.sparkSession
    rows = with_row_id(docs.select(F.col(f"`{id_col}`").cast("long").alias(_DOC), F.col(f"`{text_col}`").alias(_TEXT)), _ROW)
    n_buckets = width(spark)
    freq = rows.mapInArrow(lambda it: _frequencies(it, n_buckets),
                           "bucket int, piece long, n_docs long, blob binary, docs array<long>, sizes array<long>")
    dealt = freq.repartition(n_buckets, "bucket").sortWithinPartitions("bucket")
    sums = dealt.mapInArrow(lambda it: _joined(it, vocabulary), "piece long, sums binary, docs array<long>, sizes array<long>")
    return sums.repartition(n_buckets, "piece").sortWithinPartitions("piece") \
        .mapInArrow(_added, "doc_id long, n_bytes long, n_tokens long")
