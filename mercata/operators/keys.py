"""Deterministic dense surrogate keys and global ranks without a single-partition sort.

``global_positions`` gives every row its 0-based position in a total order:

1. ``repartitionByRange`` on the order (plus a per-row tie-breaker when equal
   rows may be many, so even a hot value or a mass of duplicate rows spreads over
   several ranges) and ``sortWithinPartitions``;
2. in the same task, the range's partition id and each row's index inside it
   (low 33 bits of ``monotonically_increasing_id``) are attached, and the rows
   are written as a parquet table below the shared checkpoint folder: range
   bounds are sampled, so the layout is pinned before positions are derived from
   it (this also cuts the lineage: a lost executor re-reads the files);
3. rows per partition from the pinned table (reads one int column) -> prefix
   sums -> a small offsets table, one row per range;
4. position = offset of the partition (a join on its id) + index inside it.

A dense key is ``position + 1`` (equal to ``row_number()`` over the order).

A rank counts the rows before a value, so rows need not be put in order for it: the
distinct values with their row counts (partially aggregated, a value shared by a third
of the rows is one row per task) are range-partitioned, and prefix sums inside the
ranges and over them give ``rank()`` per value, which is joined to the rows.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mercata.config import key_partitions, scratch_path, shuffles_released
from mercata.plans.concurrency import run_concurrently
from mercata.sources.catalog import delete_folder

POSITION = "__mercata_pos"
_TIE = "__mercata_tie"
_COPY = "__mercata_copy"
_PART = "__mercata_part"
_LOCAL = "__mercata_local"
_ROWS = "__mercata_rows"
_OFFSET = "__mercata_offset"
_LOCAL_BITS = 33  # monotonically_increasing_id keeps the partition id above bit 33
_folders: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()  # of saved frames


@dataclass(frozen=True)
class Positioned:
    frame: DataFrame  # input columns + POSITION
    rows: int          # total row count, known for free from step 3
    scratch: tuple[str, ...] = ()  # folders the frame reads


def global_positions(df: DataFrame, order: Sequence[Column], *, split_ties: bool,
                     partitions: int | None = None, times: str | None = None) -> Positioned:
    """0-based position of every row in ``order`` (see the module docstring), plus the row count.

    ``times`` names a column that says for how many equal rows a row stands: rows are moved and
    sorted as they are, and the copies are made in the task that numbers them.
    """
    spark = df.sparkSession
    n = partitions or key_partitions(spark)
    sort = list(order)
    if split_ties:
        df = df.withColumn(_TIE, F.monotonically_increasing_id())
        sort.append(F.col(_TIE).asc())
    ranged = (df.repartitionByRange(n, *sort) if n else df.repartitionByRange(*sort)).sortWithinPartitions(*sort)
    if times is not None:
        ranged = ranged.select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col(times).cast("long"))).alias(_COPY))
    # partition id and index inside it are taken in the task that sorted the range
    pid = F.spark_partition_id()
    local = F.monotonically_increasing_id() - F.shiftleft(pid.cast("long"), _LOCAL_BITS)
    staged = ranged.select(*[F.col(f"`{c}`") for c in df.columns if c not in (_TIE, times)],
                           pid.alias(_PART), local.alias(_LOCAL))
    path = scratch_path(spark, "pinned")
    with shuffles_released(spark):
        staged.write.parquet(path)  # pins the sampled layout; a lost executor re-reads these files
    pinned = spark.read.parquet(path)

    # one row per range, in a table: its prefix sums never become driver objects or literals
    per_part = pinned.groupBy(_PART).agg(F.count(F.lit(1)).alias(_ROWS))  # reads one int column
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets_path = scratch_path(spark, "offsets")
    per_part.withColumn(_OFFSET, F.coalesce(F.sum(_ROWS).over(before), F.lit(0))).write.parquet(offsets_path)
    offsets = spark.read.parquet(offsets_path)
    total = offsets.agg(F.coalesce(F.sum(_ROWS), F.lit(0))).first()[0]
    # bounded by the number of ranges (the shuffle width), not by the rows
    placed = pinned.join(F.broadcast(offsets.select(_PART, _OFFSET)), _PART)
    out = placed.withColumn(POSITION, F.col(_OFFSET) + F.col(_LOCAL)).drop(_PART, _LOCAL, _OFFSET)
    return Positioned(out, total, (path, offsets_path))


@dataclass(frozen=True)
class Keyed:
    frame: DataFrame
    rows: int
    scratch: tuple[str, ...] = ()


def with_dense_key(df: DataFrame, key: str, natural: Sequence[str], *, unique: bool,
                   partitions: int | None = None, times: str | None = None) -> Keyed:
    """Add ``key`` = 1..n in ``natural`` column order (ascending, NULLS FIRST).

    ``unique=False`` when full duplicates may occur (facts, the manager list);
    duplicates are interchangeable, so the keyed result is still deterministic.
    ``times``: a column with the number of copies a row stands for (``global_positions``).
    """
    order = [F.col(c).asc_nulls_first() for c in natural]
    pos = global_positions(df, order, split_ties=not unique, partitions=partitions, times=times)
    keyed = pos.frame.withColumn(key, F.col(POSITION) + 1).drop(POSITION)
    return Keyed(keyed, pos.rows, pos.scratch)


def saved(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared scratch folder as it lies and read back: what is derived from it twice runs once."""
    path = scratch_path(df.sparkSession, label)
    with shuffles_released(df.sparkSession):
        df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    _folders[out] = path
    return out


def discard(spark: SparkSession, scratch: Sequence[str]) -> None:
    """Delete scratch folders that nothing reads any more."""
    for path in scratch:
        delete_folder(spark, path)


def discard_saved(frame: DataFrame) -> None:
    """Delete the folder of a frame that ``saved`` returned, when nothing reads it any more."""
    discard(frame.sparkSession, [_folders.pop(frame)])


def with_shares(df: DataFrame, shares: Mapping[str, str], share: Callable[[Column, Column], Column]) -> DataFrame:
    """Add ``share(value, total of value)`` per name -> value column.

    The frame is saved first and the totals are scalar subqueries over the saved rows: its own
    plan, with the scans below it, runs once however many shares are taken, and no task sees all rows.
    """
    rows = saved(df, "shares")
    return rows.withColumns({name: share(F.col(value), rows.select(F.sum(value)).scalar()) for name, value in shares.items()})


def value_ranks(df: DataFrame, value: str, *, partitions: int | None = None) -> DataFrame:
    """``value, rank`` of each distinct value: rows with a larger one, plus 1 (NULL comes last).

    Runs one job, which writes the distinct values to the shared scratch folder: range bounds are
    sampled, so the ranges are pinned before sums are taken over them.
    """
    spark = df.sparkSession
    n = partitions or key_partitions(spark)
    order = F.col("value").desc_nulls_last()
    counts = df.groupBy(F.col(value).alias("value")).agg(F.count(F.lit(1)).alias(_ROWS))
    ranged = saved((counts.repartitionByRange(n, order) if n else counts.repartitionByRange(order)).withColumn(_PART, F.spark_partition_id()), "ranks")
    # one row per range, bounded by the shuffle width
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranged.groupBy(_PART).agg(F.sum(_ROWS).alias(_OFFSET)).select(_PART, F.coalesce(F.sum(_OFFSET).over(before), F.lit(0)).alias(_OFFSET))
    inside = Window.partitionBy(_PART).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    placed = ranged.select("value", _PART, F.coalesce(F.sum(_ROWS).over(inside), F.lit(0)).alias(_LOCAL))
    return placed.join(offsets, _PART).select("value", (F.col(_OFFSET) + F.col(_LOCAL) + 1).cast("int").alias("rank"))


def with_ranks_desc(df: DataFrame, ranks: Mapping[str, str], *, partitions: int | None = None) -> DataFrame:
    """``rank() OVER (ORDER BY value DESC NULLS LAST)`` as an int column per name -> value column.

    The frame is saved as it lies, so its plan runs once; only distinct values are shuffled.
    """
    rows = saved(df, "ranked")
    out = rows
    found = run_concurrently({name: (lambda value=value: value_ranks(rows, value, partitions=partitions)) for name, value in ranks.items()})
    for i, (name, value) in enumerate(ranks.items()):
        of, rank = f"{_ROWS}_{i}", f"{_OFFSET}_{i}"
        out = out.join(found[name].select(F.col("value").alias(of), F.col("rank").alias(rank)), F.col(value).eqNullSafe(F.col(of)), "left") \
            .withColumn(name, F.col(rank)).drop(of, rank)
    return out


def with_rank_desc(df: DataFrame, value: str, rank_col: str, *, partitions: int | None = None) -> DataFrame:
    """One rank of ``with_ranks_desc``."""
    return with_ranks_desc(df, {rank_col: value}, partitions=partitions)
