"""Token-id output: fixed-width bit packing in blocks, read back by numpy.

File format (a Parquet folder, written and committed by Spark, so any store Spark writes will do):
one row per block, blocks of a part in ascending document order.

    part, block        place of the block; parts follow one another in document order
    bits               width of an id: the fewest bits that hold the largest id of the vocabulary
    n_ids              ids in the block
    before             ids of the part's earlier blocks (the block's offset)
    doc_ids, lengths   documents of the block and their numbers of ids
    payload            the ids, ``bits`` bits each, least significant bit first, no gaps

Every id sits at bit ``bits * position``, so one id, one document or a whole block is unpacked
without reading what stands before it.  A block holds whole documents.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mercata.llm.common import held, pieces, tokenizer_path
from mercata.llm.space_runs import split_runs

BLOCK_IDS = 1 << 16
PIECE = 24 << 20  # bytes of text whose distinct runs are encoded together
MEMO_ENTRIES = 1_000_000  # distinct pieces whose ids a worker remembers (some 200 MB); then it starts anew
WORDS = 256  # words the library gets as one text
BLOCK_SCHEMA = ("part int, block int, bits int, n_ids long, before long, doc_ids array<long>, "
                "lengths array<long>, payload binary")
_SHOWN = {" ": "\u0120", "\n": "\u010a"}  # what byte-level vocabularies show a space and a line feed as
_SIGNS = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())
_LETTERS = "^\n?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+$"
_LETTER = "\n" + "".join(c for c in map(chr, range(0x250)) if re.match(_LETTERS, c))
_LETTERS_SIGNS = re.compile(f"{_LETTERS[3:-1]}[{re.escape(_SIGNS)}]+")
_DOC, _TEXT, _TIE, _PART = "__llm_doc", "__llm_text", "__llm_tie", "__llm_part"


def width_of(vocab_size: int) -> int:
    """Fewest bits that hold every id below ``vocab_size``."""
    return max(1, (max(vocab_size, 1) - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids as ``bits``-bit numbers, least significant bit first."""
    ids = np.ascontiguousarray(ids, dtype="<u4")
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    planes = (ids[:, None] >> np.arange(bits, dtype=np.uint32)) & 1
    return np.packbits(planes.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(payload: bytes, bits: int, start: int, count: int) -> np.ndarray:
    """``count`` ids from position ``start`` on, as uint32; touches only their bytes."""
    if bits in (8, 16, 32):
        size = bits // 8
        return np.frombuffer(payload, f"<u{size}", count, start * size).astype(np.uint32)
    first = start * bits
    raw = np.frombuffer(payload, np.uint8)[first // 8: -(-(first + count * bits) // 8)]
    flat = np.unpackbits(raw, bitorder="little")[first % 8: first % 8 + count * bits].reshape(count, bits)
    return (flat.astype(np.uint32) << np.arange(bits, dtype=np.uint32)).sum(axis=1, dtype=np.uint32)


def _strings(column: pa.Array) -> list[str]:
    return column.to_numpy(zero_copy_only=False).tolist()  # much faster than to_pylist()


class PieceEncoder:
    """The library's ids of whole texts, encoding each distinct piece between cuts once.

    A piece of Latin letters with ASCII signs behind them is two pre-tokens, which are remembered
    apart.  Keeps a bounded memory of pieces; what it holds changes no result.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        self.lib.no_truncation()
        self.lib.no_padding()
        self.vocab_size = max(self.lib.get_vocab(with_added_tokens=True).values(), default=0) + 1
        vocab = self.lib.get_vocab(with_added_tokens=False)
        self.begins = {c: np.zeros(self.vocab_size, bool) for c in _SHOWN}  # tokens that begin with a space, or line feed
        for c, shown in _SHOWN.items():
            self.begins[c][[i for t, i in vocab.items() if t.startswith(shown)]] = True
        # a special string of letters and signs could lie across the cut between them
        self.cuts_signs = not any(_LETTERS_SIGNS.fullmatch(t.content) for t in self.lib.get_added_tokens_decoder().values())
        self.memo: dict[str, bytes] = {}
        self.signs: dict[str, bytes] = {"": b""}  # signs behind letters, no space before them

    def _raw(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.lib.encode_batch_fast(texts, add_special_tokens=False)]

    def _words(self, words: list[str], before: str) -> list[bytes]:
        """Ids of words behind a space or line feed (``before``), without such inside or white ends, many as
        one text: a token that begins with that character begins a word."""
        out = []
        for a in range(0, len(words), WORDS):
            some = words[a:a + WORDS]
            ids = np.array(self.lib.encode_batch_fast([before + before.join(some)], add_special_tokens=False)[0].ids, "<u4")
            first = np.flatnonzero(self.begins[before][ids])
            if len(first) != len(some) or first[0]:  # not a vocabulary of that kind
                out += self._raw([before + w for w in some])
                continue
            data, at = ids.tobytes(), [*(4 * first).tolist(), 4 * len(ids)]
            out += [data[x:y] for x, y in zip(at, at[1:], strict=False)]
        return out

    def _distinct(self, runs: pa.Array) -> pa.Array:
        """Ids of each of some distinct runs: one that begins with a line feed as it is, any other behind a space."""
        if len(self.memo) > MEMO_ENTRIES:
            self.memo.clear()
        if len(self.signs) > MEMO_ENTRIES:
            self.signs = {"": b""}
        bare = pa.compute.ascii_rtrim(runs, characters=_SIGNS)
        letters = pa.compute.and_(pa.compute.match_substring_regex(bare, _LETTERS), self.cuts_signs)
        cores = pa.compute.if_else(letters, bare, runs).dictionary_encode()
        tails = pa.compute.if_else(letters, pa.compute.utf8_ltrim(runs, characters=_LETTER), "").dictionary_encode()
        known, words, lines, odd = _strings(cores.dictionary), [], [], []
        for w in known:
            if w in self.memo:
                continue
            if w.isalpha():
                words.append(w)
            elif (bare := w[w[:1] == "\n":]) and not (" " in w or "\n" in bare or bare[0].isspace() or bare[-1].isspace()):
                (words if bare == w else lines).append(w)
            else:
                odd.append(w)
        self.memo.update(zip(words, self._words(words, " "), strict=True))
        self.memo.update(zip(lines, self._words([w[1:] for w in lines], "\n"), strict=True))
        self.memo.update(zip(odd, self._raw([w if w[:1] == "\n" else " " + w for w in odd]), strict=True))
        behind = _strings(tails.dictionary)
        signs = list(set(behind).difference(self.signs))
        self.signs.update(zip(signs, self._raw(signs), strict=True))

        def ids(names: list[str], memo: dict[str, bytes], at: pa.Array) -> pa.Array:
            return pa.array(list(map(memo.__getitem__, names)), pa.large_binary()).take(at)

        return pa.compute.binary_join_element_wise(
            ids(known, self.memo, cores.indices), ids(behind, self.signs, tails.indices), pa.scalar(b"", pa.large_binary()))

    def encode(self, texts: list[str] | pa.Array) -> list[bytes]:
        """Ids of each text, as little-endian 32-bit numbers."""
        heads, runs, ends = split_runs(pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts)
        heads = self._raw(_strings(heads))
        if not len(runs):
            return heads
        coded = runs.dictionary_encode()
        del runs
        ids = self._distinct(coded.dictionary).take(coded.indices)
        _, offsets, data = ids.buffers()  # ids of all runs, one after the other
        at = np.frombuffer(offsets, "<i8", len(ids) + 1, 8 * ids.offset)[ends].tolist()
        held = memoryview(data) if data is not None else b""
        return [h + held[a:z] for h, a, z in zip(heads, at, at[1:], strict=False)]


def encoder(path: str) -> PieceEncoder:
    """One encoder per worker process and vocabulary file."""
    return held(f"pieces {path}", lambda: PieceEncoder(path))


def _blocks(batches: Iterator[pa.RecordBatch], vocabulary: str, end_id: int | None, schema: pa.Schema,
            block_ids: int) -> Iterator[pa.RecordBatch]:
    import gc
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    gc.disable()  # many small objects and no cycles: collections would only walk the memory
    path = tokenizer_path(vocabulary)
    enc = encoder(path)
    bits = width_of(max(enc.vocab_size, (end_id or 0) + 1))
    end = b"" if end_id is None else np.array([end_id], "<u4").tobytes()
    docs: list[int | None] = []
    data: list[bytes] = []
    held = before = block = part = 0

    def flush() -> pa.RecordBatch:
        lengths = [len(x) // 4 for x in data]
        payload = pack(np.frombuffer(b"".join(data), "<u4"), bits)
        return pa.RecordBatch.from_arrays(
            [pa.array([v], t) for v, t in zip((part, block, bits, held, before, docs, lengths, payload), schema.types, strict=True)],
            schema=schema)

    for piece in pieces(batches, _TEXT, PIECE, f"pieces {path}"):
        part = piece.column(_PART)[0].as_py()
        texts = piece.column(_TEXT).fill_null("").cast(pa.large_string())
        for doc, ids in zip(piece.column(_DOC).to_pylist(), enc.encode(texts), strict=True):
            docs.append(doc)
            data.append(ids + end)
            held += len(data[-1]) // 4
            if held >= block_ids:
                yield flush()
                before, block, held, docs, data = before + held, block + 1, 0, [], []
    if docs:
        yield flush()


def write_packed(docs: DataFrame, path: str, vocabulary: str = "byte_bpe_50k.json", *, id_col: str = "doc_id",
                 text_col: str = "text", end_id: int | None = 0, block_ids: int = BLOCK_IDS) -> None:
    """Encode every whole text and write the ids to ``path`` in ascending order of ``id_col``.

    Null ids come first; rows of one id follow a hash of their text, and rows equal in both are
    interchangeable.  Null texts count as empty; an empty text gives the end id alone (nothing if
    ``end_id`` is None); an empty table gives an empty file set.  Other columns are not read.
    """
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias(_DOC), F.col(f"`{text_col}`").alias(_TEXT)) \
        .withColumn(_TIE, F.xxhash64(_TEXT))
    order = [F.col(_DOC).asc_nulls_first(), F.col(_TIE).asc()]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = ranged.select(_DOC, _TEXT, F.spark_partition_id().alias(_PART))
    arrow = _arrow_schema()
    ranged.mapInArrow(lambda it: _blocks(it, vocabulary, end_id, arrow, block_ids), BLOCK_SCHEMA) \
        .write.option("compression", "zstd").parquet(path)


def _arrow_schema() -> pa.Schema:
    return pa.schema([("part", pa.int32()), ("block", pa.int32()), ("bits", pa.int32()), ("n_ids", pa.int64()),
                      ("before", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())),
                      ("payload", pa.binary())])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])
    for batch in batches:
        for row in batch.to_pylist():
            ids = unpack(row["payload"], row["bits"], 0, row["n_ids"]).astype("<u4")
            ends = np.cumsum(np.array(row["lengths"], np.int64))
            starts = ends - np.array(row["lengths"], np.int64)
            crcs = [zlib.crc32(ids[a:b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["doc_ids"], pa.int64()), pa.array(starts + row["before"] + row["part_start"]),
                 pa.array(ends - starts), pa.array(crcs, pa.int64())], schema=schema)


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """The blocks at ``path`` with ``part_start``, the ids of all earlier parts."""
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(path)
    parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))  # one row per written part
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start"))
    return blocks.join(F.broadcast(starts), "part")  # bounded by the shuffle width


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: doc_id, start (ids of all documents before), n_tokens, ids_crc32."""
    return read_blocks(spark, path).select("doc_ids", "lengths", "before", "part_start", "bits", "n_ids", "payload") \
        .mapInArrow(_digests, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int64()))])
    for batch in batches:
        for row in batch.to_pylist():
            at, out = 0, []
            for n in row["lengths"]:
                out.append(unpack(row["payload"], row["bits"], at, n).astype(np.int64))
                at += n
            yield pa.RecordBatch.from_arrays([pa.array(row["doc_ids"], pa.int64()), pa.array(out, pa.list_(pa.int64()))],
                                             schema=schema)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Per document its ids, each unpacked by its offset alone."""
    return spark.read.schema(BLOCK_SCHEMA).parquet(path).select("doc_ids", "lengths", "bits", "payload") \
        .mapInArrow(_documents, "doc_id long, ids array<long>")
