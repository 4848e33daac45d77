"""Benchmark decontamination by latent semantic retrieval.

1. Benchmark items are cut into chunks of at most ``CHUNK`` words; their terms are the vocabulary (a
   matching passage shares terms with the item, so other terms can only lengthen its vector).
   Texts are cut into passages of ``2 * CHUNK`` words, a new one every ``CHUNK`` words, so a copied
   chunk lies wholly in one passage.  Each text is read and split once: what goes on is its
   vocabulary terms with their places.
2. Document frequencies over all passages give TF-IDF weights.  Terms of more than ``COMMON`` of the
   passages weigh nothing in retrieval, but for the ``TELLING`` rarest of each chunk, which weigh as
   much as a term of ``COMMON``: words of an item that stands everywhere are not drowned by rarer ones.
3. A randomised SVD of the passages' and chunks' TF-IDF matrix: two rounds of ``G = A'(A W)``, each
   a pass over all passages whose partial sums are added by blocks of terms; the chunks' rows weigh
   as much as the corpus together, so the latent space keeps the directions that items lie in.
4. Every passage is projected; chunks at a cosine of ``COSINE`` or more are candidates.
5. A candidate is confirmed if its words and the chunk's have a longest common subsequence of
   ``LCS`` of the chunk, and hold words of ``ANSWER`` of the IDF of all its words (rare ones, which
   carry its answer, count most).  That admits paraphrases, gaps and exchanged words, in an item
   that stands in a few passages or in a third of them; what weighs in retrieval plays no part.

The benchmark is worked through in slices of ``SLICE`` chunks, so what is broadcast (vocabulary,
basis) is bounded by the slice, whatever the benchmark's size.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercata.llm.common import pieces, pin, released

CHUNK = 40
COMMON = 0.005
TELLING = 8   # terms of a chunk that weigh at least, however common they are
RANK = 256
COSINE = 0.3
LCS = 0.7
ANSWER = 0.5
SLICE = 4_096
BLOCKS = 16
PART = 1 << 20  # characters of a piece whose words a task holds at once
_DOC, _TEXT = "__llm_doc", "__llm_text"
_SIGNS = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())


def words_of(text: str) -> list[str]:
    """Lower-case words without the signs around them."""
    return [w for w in (x.strip(_SIGNS) for x in text.lower().split()) if w]


@dataclass
class Slice:
    """Chunks of a part of the benchmark."""
    items: list[int | None]
    codes: list[np.ndarray]
    terms: dict[str, int]
    idf: np.ndarray = field(default_factory=lambda: np.zeros(0))  # weights in retrieval
    full: np.ndarray = field(default_factory=lambda: np.zeros(0))  # IDF of all terms
    basis: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    latent: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))  # unit rows of the chunks, projected


def benchmark_slices(rows: list[tuple], chunk: int = CHUNK, size: int = SLICE) -> Iterator[Slice]:
    """Chunks of all items (item id, text); null and wordless texts have none."""
    now = Slice([], [], {})
    for item, text in rows:
        words = words_of(text or "")
        parts = -(-len(words) // chunk)
        for i in range(parts):  # of nearly equal length
            part = words[len(words) * i // parts: len(words) * (i + 1) // parts]
            now.items.append(item)
            now.codes.append(np.array([now.terms.setdefault(w, len(now.terms)) for w in part]))
            if len(now.items) == size:
                yield now
                now = Slice([], [], {})
    if now.items:
        yield now


def _entries(place: np.ndarray, code: np.ndarray, first: np.ndarray, passages: np.ndarray, chunk: int,
             n_terms: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(passage, term, times) of term places; a text has passages ``first`` to ``first + passages - 1``."""
    k = place // chunk  # passage j holds the chunks j and j + 1 of its text
    both = np.concatenate([np.where(k < passages, first + k, -1), np.where(k > 0, first + k - 1, -1)])
    terms = np.concatenate([code, code])
    pair, times = np.unique((both * n_terms + terms)[both >= 0], return_counts=True)
    return pair // n_terms, pair % n_terms, times


def _coded(texts: list[str], vocabulary: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Vocabulary number (-1: none) and text number of each word of ``words_of``, by Arrow: its white space is Python's."""
    split = pa.compute.utf8_split_whitespace(pa.array([t.lower() for t in texts], pa.large_string()))
    words = pa.compute.ascii_trim(split.flatten(), characters=_SIGNS)
    text = pa.compute.list_parent_indices(split).to_numpy()
    some = pa.compute.binary_length(words).to_numpy() > 0
    at = pa.compute.index_in(words, value_set=vocabulary.cast(words.type)).fill_null(-1)
    return at.to_numpy()[some].astype(np.int64), text[some]


def _parts(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    """Consecutive texts of some ``PART`` characters, with the number of the first."""
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= PART or i + 1 == len(texts):
            yield start, texts[start:i + 1]
            start, size = i + 1, 0


def _split(batches: Iterator[pa.RecordBatch], shared, chunk: int) -> Iterator[pa.RecordBatch]:
    terms = shared.value
    vocabulary = pa.array(list(terms), pa.string())  # numbered in order
    for piece in pieces(batches, _TEXT):
        texts = [t or "" for t in piece.column(_TEXT).to_pylist()]
        found, of_parts, df = [], [], np.zeros(len(terms), np.int64)
        for number, part in _parts(texts):
            code, text = _coded(part, vocabulary)
            counts = np.bincount(text, minlength=len(part))
            place = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
            passages = np.maximum(-(-counts // chunk) - 1, (counts > 0).astype(np.int64))
            known = code >= 0
            code, text, place = code[known], text[known], place[known]
            first = np.cumsum(passages) - passages
            _, term, _ = _entries(place, code, first[text], passages[text], chunk, len(terms))
            df += np.bincount(term, minlength=len(terms))
            found.append(np.stack([text + number, place, code]).astype("<i4"))
            of_parts.append(passages)
        text, place, code = np.concatenate(found, axis=1)
        passages, some = np.concatenate(of_parts), np.flatnonzero(df)
        blob = zlib.compress(b"".join([np.diff(text, prepend=0).astype("<i4").tobytes(), place.astype("<i4").tobytes(),
                                       code.astype("<i4").tobytes()]), 1)
        keys = [hashlib.md5(t.encode(), usedforsecurity=False).digest() for t in texts]
        values = (piece.column(_DOC).to_pylist(), keys, passages.tolist(), blob, some.tolist(), df[some].tolist(), int(passages.sum()))
        types = [("docs", pa.list_(pa.int64())), ("keys", pa.list_(pa.binary())), ("passages", pa.list_(pa.int64())), ("blob", pa.binary()),
                 ("terms", pa.list_(pa.int32())), ("df", pa.list_(pa.int64())), ("n", pa.int64())]
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, (_, t) in zip(values, types, strict=True)], schema=pa.schema(types))


def _opened(row: dict) -> tuple[np.ndarray, ...]:
    """(text, place, term) of a piece, and the passage number each text begins at."""
    text, place, code = np.frombuffer(zlib.decompress(row["blob"]), "<i4").astype(np.int64).reshape(3, -1)
    passages = np.array(row["passages"], np.int64)
    return np.cumsum(text), place, code, np.cumsum(passages) - passages, passages


def _weighted(row: dict, idf: np.ndarray, chunk: int) -> tuple[np.ndarray, ...]:
    """TF-IDF rows of a piece's passages: (passage, term, weight of the unit row), by passage."""
    text, place, code, first, passages = _opened(row)
    live = idf[code] > 0
    text, place, code = text[live], place[live], code[live]
    passage, term, times = _entries(place, code, first[text], passages[text], chunk, len(idf))
    weight = (1 + np.log(times)) * idf[term]
    if len(passage):
        rows, start, back = np.unique(passage, return_index=True, return_inverse=True)
        weight = weight / np.sqrt(np.add.reduceat(weight ** 2, start))[back]
    return passage, term, weight


def group_sums(source: np.ndarray, take: np.ndarray, scale: np.ndarray, start: np.ndarray, run: int = 64) -> np.ndarray:
    """Sums of ``source[take] * scale`` over consecutive groups beginning at ``start``.

    Groups are cut into runs; the k-th members of all runs are added at once, longest runs first,
    so no matrix of all members is made.
    """
    if not len(start):
        return np.zeros((0, source.shape[1]), source.dtype)
    size = np.diff(np.append(start, len(take)))
    runs = -(-size // run)
    head = np.cumsum(runs) - runs
    first = np.repeat(start, runs) + run * (np.arange(runs.sum()) - np.repeat(head, runs))
    length = np.minimum(np.repeat(start + size, runs) - first, run)
    order = np.argsort(-length, kind="stable")
    first, length = first[order], length[order]
    out = np.zeros((len(first), source.shape[1]), source.dtype)
    for k in range(int(length[0])):
        n = int(np.searchsorted(-length, -k))  # runs of more than k members
        at = first[:n] + k
        out[:n] += source[take[at]] * scale[at, None]
    back = np.empty_like(out)
    back[order] = out
    return np.add.reduceat(back, head) if len(head) < len(back) else back


def _products(batches: Iterator[pa.RecordBatch], shared, chunk: int) -> Iterator[pa.RecordBatch]:
    """Partial sums of A'(A W), in blocks of terms."""
    idf, w = shared.value
    total = np.zeros(w.shape)
    for batch in batches:
        for row in batch.to_pylist():
            passage, term, weight = _weighted(row, idf, chunk)
            for a in range(0, len(passage), 100_000):  # a cut passage is two rows: allowed in a sketch, kept rare
                p, t, x = passage[a:a + 100_000], term[a:a + 100_000], weight[a:a + 100_000].astype(np.float32)
                _, start, back = np.unique(p, return_index=True, return_inverse=True)
                y = group_sums(w, t, x, start)
                order = np.argsort(t, kind="stable")
                terms, start = np.unique(t[order], return_index=True)
                total[terms] += group_sums(y, back[order], x[order], start)
    for b in range(BLOCKS):
        yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([zlib.compress(total[b::BLOCKS].astype("<f4").tobytes(), 1)])],
                                         names=["block", "sums"])


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[int, np.ndarray] = {}
    for batch in batches:
        for row in batch.to_pylist():
            part = np.frombuffer(zlib.decompress(row["sums"]), "<f4").astype(np.float64)
            totals[row["block"]] = totals[row["block"]] + part if row["block"] in totals else part
    for b, t in totals.items():
        yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([t.tobytes()])], names=["block", "sums"])


def lcs_length(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence, a row of the table as the bits of one number."""
    at: dict[int, int] = {}
    for i, x in enumerate(a):
        at[x] = at.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for y in b:
        m = at.get(y, 0)
        if m:
            u = row & m
            row = (row + u | row - u) & full
    return len(a) - row.bit_count()


def _unit(m: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(m, axis=1, keepdims=True)
    return np.divide(m, norm, out=np.zeros_like(m), where=norm > 1e-9)


def chunk_rows(s: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unit TF-IDF rows of the chunks: (chunk, term, weight), by chunk."""
    chunk = np.repeat(np.arange(len(s.codes)), [len(c) for c in s.codes])
    pair, n = np.unique(chunk * len(s.terms) + np.concatenate(s.codes), return_counts=True)
    chunk, term = pair // len(s.terms), pair % len(s.terms)
    weight = (1 + np.log(n)) * s.idf[term]
    norm = np.sqrt(np.bincount(chunk, weight ** 2, len(s.codes)))[chunk]
    return chunk, term, np.divide(weight, norm, out=np.zeros_like(weight), where=norm > 1e-9).astype(np.float32)


def _projected(rows: tuple[np.ndarray, np.ndarray, np.ndarray], n: int, basis: np.ndarray) -> np.ndarray:
    """``n`` sparse rows times a matrix over the terms."""
    chunk, term, weight = rows
    out = np.zeros((n, basis.shape[1]), np.float32)
    some, start = np.unique(chunk, return_index=True)
    out[some] = group_sums(basis, term, weight, start)
    return out


def _found(batches: Iterator[pa.RecordBatch], shared, chunk: int, cosine: float, lcs: float, answer: float) -> Iterator[pa.RecordBatch]:
    s: Slice = shared.value
    basis, latent = s.basis, s.latent
    codes = [c.tolist() for c in s.codes]
    weighs = [{t: float(s.full[t]) for t in c} for c in codes]
    wanted = [answer * sum(w.values()) - 1e-9 for w in weighs]
    for batch in batches:
        for row in batch.to_pylist():
            passage, term, weight = _weighted(row, s.idf, chunk)
            if not len(passage):
                continue
            text, place, code, first, passages = _opened(row)
            out: dict[tuple[int, int], tuple[float, float]] = {}
            numbers, start = np.unique(passage, return_index=True)
            stop = np.append(start[1:], len(passage))
            ends = np.cumsum(np.bincount(text, minlength=len(passages)))
            for a in range(0, len(numbers), 2_048):
                z = min(a + 2_048, len(numbers))
                span = slice(start[a], stop[z - 1])
                rows = group_sums(basis, term[span], weight[span].astype(np.float32), start[a:z] - start[a])
                score = _unit(rows) @ latent.T
                seen = -1
                for i, j in np.argwhere(score >= cosine).tolist():
                    if i != seen:  # the candidates of a passage follow each other
                        seen = i
                        doc = int(np.searchsorted(first, numbers[a + i], side="right")) - 1
                        k = int(numbers[a + i] - first[doc])
                        lo = ends[doc - 1] if doc else 0
                        of = place[lo:ends[doc]]
                        last = of[-1] + 1 if k + 1 >= passages[doc] else (k + 2) * chunk
                        window = code[lo + np.searchsorted(of, k * chunk): lo + np.searchsorted(of, last)].tolist()
                        held = set(window)
                    weight_of = weighs[j]
                    if sum([weight_of[t] for t in held.intersection(weight_of)]) < wanted[j]:
                        continue
                    share = lcs_length(codes[j], window) / len(codes[j])
                    if share >= lcs:
                        was = out.get((doc, j), (0.0, 0.0))
                        out[doc, j] = max(was[0], float(score[i, j])), max(was[1], share)
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["docs"][d] for d, _ in out], pa.int64()), pa.array([row["keys"][d] for d, _ in out], pa.binary()),
                     pa.array([s.items[j] for _, j in out], pa.int64()), pa.array([v[0] for v in out.values()]),
                     pa.array([v[1] for v in out.values()])], names=["doc_id", "text_key", "item_id", "cosine", "lcs_share"])


def contaminated(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                 item_text_col: str = "text", chunk: int = CHUNK, cosine: float = COSINE, lcs: float = LCS, answer: float = ANSWER,
                 rank: int = RANK, slice_chunks: int = SLICE) -> DataFrame:
    """Documents that hold a benchmark item: doc_id, text_key (MD5 of the text), item_id, cosine, lcs_share.

    One row per document and item found; clean documents have none.  Null and wordless texts of
    either table match nothing; null ids are reported as they are; documents equal in id and text
    are reported once; other columns are not read; no rows give none.
    """
    spark = docs.sparkSession
    found = spark.createDataFrame([], "doc_id long, text_key binary, item_id long, cosine double, lcs_share double")
    items = benchmark.select(F.col(f"`{item_col}`").cast("long").alias("i"), F.col(f"`{item_text_col}`").alias("t"))
    rows = ((r.i, r.t) for r in items.orderBy("i", "t").toLocalIterator())  # slice by slice
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias(_DOC), F.col(f"`{text_col}`").alias(_TEXT))
    for s in benchmark_slices(rows, chunk, slice_chunks):
        found = found.union(_slice_matches(texts, s, chunk, cosine, lcs, answer, rank))
    return found.groupBy("doc_id", "text_key", "item_id").agg(F.max("cosine").alias("cosine"), F.max("lcs_share").alias("lcs_share"))


def _slice_matches(texts: DataFrame, s: Slice, chunk: int, cosine: float, lcs: float, answer: float, rank: int) -> DataFrame:
    spark = texts.sparkSession
    sc = spark.sparkContext
    terms = sc.broadcast(s.terms)
    encoded = pin(texts.mapInArrow(lambda it: _split(it, terms, chunk),
                                   "docs array<long>, keys array<binary>, passages array<long>, blob binary, terms array<int>, df array<long>, n long"),
                  "lsr-terms")
    n = encoded.agg(F.sum("n")).collect()[0][0] or 0
    df = np.zeros(len(s.terms))
    counted = encoded.select(F.explode(F.arrays_zip("terms", "df")).alias("x")).groupBy("x.terms").agg(F.sum("x.df").alias("df"))
    for r in counted.collect():  # a row per vocabulary term
        df[r[0]] = r[1]
    idf = np.log((n + 1) / (df + 1))
    rare = df <= max(COMMON * n, 3)
    for c in s.codes:
        own = np.unique(c)
        rare[own[np.argsort(df[own], kind="stable")[:TELLING]]] = True
    floor = np.log((n + 1) / (max(COMMON * n, 3) + 1))
    s.idf = np.where(rare, np.maximum(idf, max(floor, 1e-3)), 0.0)
    s.full = np.maximum(idf, 0.0)

    own = chunk_rows(s)
    by_term = np.argsort(own[1], kind="stable")
    own_terms, own_start = np.unique(own[1][by_term], return_index=True)
    share = max(n, 1) / len(s.codes)  # as much weight as the corpus together
    rank = min(rank, len(s.terms))
    w = np.random.default_rng(7).standard_normal((len(s.terms), min(rank + 16, len(s.terms)))).astype(np.float32)
    for _ in range(2):
        shared = sc.broadcast((s.idf, w))
        parts = encoded.select("blob", "passages").mapInArrow(lambda it, b=shared: released(_products(it, b, chunk)), "block int, sums binary")
        g = np.zeros(w.shape)
        g[own_terms] = share * group_sums(_projected(own, len(s.codes), w), own[0][by_term], own[2][by_term], own_start)
        for r in parts.repartition(BLOCKS, "block").mapInArrow(_added, "block int, sums binary").collect():  # terms x rank numbers in all
            g[r[0]::BLOCKS] += np.frombuffer(r[1]).reshape(-1, w.shape[1])
        u, _, _ = np.linalg.svd(g, full_matrices=False)
        w = u.astype(np.float32)
    s.basis = np.ascontiguousarray(w[:, :rank])
    s.latent = _unit(_projected(own, len(s.codes), s.basis))
    last = sc.broadcast(s)
    return encoded.mapInArrow(lambda it: released(_found(it, last, chunk, cosine, lcs, answer)),
                              "doc_id long, text_key binary, item_id long, cosine double, lcs_share double")
