"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mercata.config import scratch_path

# Text handled at once inside a task; larger Arrow batches are cut into such pieces (a single
# longer text is a piece of its own), so a task's memory does not follow the batch size.
PIECE_BYTES = 4 << 20
BATCH_BYTES = 8 << 20  # of an Arrow batch between Spark and a task's Python: no smaller than a piece of the pipeline's operators
KEY_BITS = 64            # bits of a bitmap of keys per key
MOST_KEY_BITS = 1 << 28  # and of a whole bitmap, at most (32 MB)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data folder, as Spark's own reader opens it."""
    return spark.read.parquet(f"{str(sf_dir).rstrip('/')}/{name}.parquet")


def pin(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Cuts the lineage and freezes row ids and sampled layouts: an executor that is lost later
    makes its tasks read files again, never assign anything anew.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """From now on the session's Arrow batches hold some ``BATCH_BYTES``, unless the session has a bound of its own.

    Spark's default of 64 MB (or 10,000 rows) stands twice beside a task's work, outside the heap and in its
    Python worker, and neither gives all of it back to the system.  All rows come, in more batches.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name, None) is None:
        spark.conf.set(name, str(BATCH_BYTES))


def width(spark: SparkSession) -> int:
    """The session's shuffle width."""
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def with_row_id(df: DataFrame, name: str) -> DataFrame:
    """Add a unique row number that no key or repeated row can make collide."""
    return df.withColumn(name, F.monotonically_increasing_id())


def fresh(docs: DataFrame, *names: str) -> list[str]:
    """Names that no column of ``docs`` has, upper and lower case alike."""
    taken, out = {c.lower() for c in docs.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def split_by_keys(rows: DataFrame, key: str, keys: DataFrame, of: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose ``key`` certainly is not in column ``of`` of the saved ``keys``, and all others (those it holds, and few more).

    Tells by a bitmap of bounded size that is broadcast, so the rows stay where they are and a join
    with ``keys`` need not shuffle those it cannot find.  More keys than the bitmap can tell apart
    only make the second part larger.  Keys are never null.
    """
    bits = min(max(1 << 15, 1 << (KEY_BITS * keys.count()).bit_length()), MOST_KEY_BITS)
    bucket, bitmap = fresh(rows, "__llm_bucket", "__llm_bitmap")

    def spot(name: str) -> Column:
        return F.pmod(F.xxhash64(name), F.lit(bits)) + 1

    set_bits = keys.select(F.bitmap_bucket_number(spot(of)).alias(bucket), F.bitmap_bit_position(spot(of)).alias(bitmap)) \
        .repartition(bucket).groupBy(bucket).agg(F.bitmap_construct_agg(bitmap).alias(bitmap))
    at = F.bitmap_bit_position(spot(key))
    byte = F.conv(F.hex(F.substring(F.col(bitmap), (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    held = (F.bitmap_bucket_number(spot(key)) == F.col(bucket)) & (F.getbit(byte, (at % 8).cast("int")) == 1)
    set_bits = F.broadcast(set_bits)
    return rows.join(set_bits, held, "left_anti"), rows.join(set_bits, held, "left_semi")


def release_memory() -> None:
    """Give freed memory back to the system: a Python worker is used again by later stages and keeps what it does not return."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What a task gives; after its last batch, when its own objects are gone, their memory goes back to the system."""
    yield from batches
    release_memory()


_HELD: dict[str, object] = {}


def held(name: str, make: Callable[[], object]) -> object:
    """What a Python worker keeps from task to task, such as a loaded vocabulary: one thing at a time."""
    if name not in _HELD:
        drop_held()
        _HELD[name] = make()
    return _HELD[name]


def drop_held(but: str | None = None) -> None:
    """Give up what tasks of other operators kept in this worker (``but`` names a task's own)."""
    others = [name for name in _HELD if name != but]
    for name in others:
        del _HELD[name]
    if others:
        gc.collect()  # automata point at themselves
        release_memory()


def pieces(batches: Iterator[pa.RecordBatch], text: str | int, limit: int = PIECE_BYTES, keeps: str | None = None) -> Iterator[pa.RecordBatch]:
    """Cut record batches into consecutive slices of about ``limit`` bytes of ``text``; ``keeps`` names what the task holds."""
    import numpy as np

    drop_held(keeps)
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pa.compute.binary_length(batch.column(text)).fill_null(0).to_numpy(zero_copy_only=False)
        group = np.concatenate([[0], np.cumsum(sizes.astype(np.int64))[:-1]]) // limit
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            yield batch.slice(a, b - a)
    release_memory()


def tokenizer_path(name: str) -> str:
    """Place of a public vocabulary file on the worker."""
    import public_tokenizers

    return public_tokenizers.path(name)
