"""Sharding by a hypergeometric communication matrix: a uniform shuffle with exact shard sizes.

1. Every row gets a random bucket (the sending partitions); bucket sizes are counted.
2. The driver draws the matrix ``bucket x shard``: row by row a multivariate hypergeometric draw
   from what is left of the shard sizes.  This is exactly how many rows of each bucket a uniform
   permutation of all rows would put into each shard, so shard sizes are exact, not expected.
3. Each bucket permutes its rows locally and deals the first ``m[b][0]`` to shard 0, the next
   ``m[b][1]`` to shard 1, and so on (the exchange).
4. Each shard permutes what it got; the position is the slot.  A shard may be a large part of all
   data, so it is permuted in random sub-buckets that follow one another.

No task holds more than a bucket, whose size is about ``BUCKET_ROWS`` whatever the keys are.
Buckets, permutations and sub-buckets are seeded hashes of a pinned row number, so a task that
runs again deals alike, and one key or text that fills a third of the table spreads evenly.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mercata.llm.common import pin, with_row_id

BUCKET_ROWS = 50_000
BROADCAST_ROWS = 200_000  # matrix rows (one per bucket) up to which they are broadcast: some 30 MB
_ROW, _BUCKET, _RANK, _CUTS, _SUB, _AT = (f"__llm_{x}" for x in ("row", "bucket", "rank", "cuts", "sub", "at"))


def shard_sizes(rows: int, n_shards: int) -> list[int]:
    """Sizes at most one apart, larger ones first."""
    return [rows // n_shards + (s < rows % n_shards) for s in range(n_shards)]


def communication_matrix(bucket_sizes: list[int], sizes: list[int], seed: int) -> np.ndarray:
    """Counts per bucket (row) and shard (column), with exactly these row and column sums."""
    rng = np.random.default_rng(seed)
    left = np.array(sizes, dtype=np.int64)
    out = np.zeros((len(bucket_sizes), len(sizes)), dtype=np.int64)
    for b, n in enumerate(bucket_sizes):
        todo, behind = n, int(left.sum())
        for s in range(len(sizes)):  # one hypergeometric draw per cell: any sizes, also beyond 1e9
            behind -= int(left[s])
            k = todo if behind == 0 else _hypergeometric(rng, int(left[s]), behind, todo)
            out[b, s] = k
            todo -= k
        left -= out[b]
    return out


def _hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    if draws == 0 or good == 0:
        return 0
    if max(good, bad) < 1_000_000_000:
        return int(rng.hypergeometric(good, bad, draws))
    # numpy stops at 1e9: there the normal limit, cut to the possible range, is exact enough
    total, p = good + bad, good / (good + bad)
    sd = (draws * p * (1 - p) * (total - draws) / (total - 1)) ** 0.5
    return int(min(max(round(rng.normal(draws * p, sd)), draws - bad, 0), good, draws))


def shuffle_into_shards(df: DataFrame, n_shards: int, seed: int = 20_240_229,
                        bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """All rows of ``df`` with ``shard`` (int, 0 to n_shards-1) and ``slot`` (long, gapless from 0).

    Law: rows.  Shard sizes differ by one at most.  Columns of ``df`` named ``shard`` or ``slot``
    are replaced; null keys, null or empty or long texts and repeated rows are rows like any other
    (only a row number decides); an empty table gives an empty table.  Every order is equally
    likely, so equal texts are not held together.
    """
    if n_shards < 1:
        raise ValueError("n_shards must be positive")
    spark = df.sparkSession
    keep = [c for c in df.columns if c.lower() not in ("shard", "slot")]
    rows = pin(with_row_id(df.select(*[F.col(f"`{c}`") for c in keep]), _ROW), "shard")
    total = rows.count()
    n_buckets = max(spark.sparkContext.defaultParallelism, -(-total // bucket_rows))

    def noise(k: int):
        return F.xxhash64(F.lit(seed + k), F.col(_ROW))

    bucketed = rows.withColumn(_BUCKET, F.pmod(noise(1), F.lit(n_buckets)).cast("int"))
    counts = {r[0]: r[1] for r in bucketed.groupBy(_BUCKET).count().collect()}  # one row per bucket
    sizes = [counts.get(b, 0) for b in range(n_buckets)]
    cuts = communication_matrix(sizes, shard_sizes(total, n_shards), seed).cumsum(axis=1)
    matrix = spark.createDataFrame([(b, [int(x) for x in c]) for b, c in enumerate(cuts)],
                                   f"{_BUCKET} int, {_CUTS} array<long>")
    if n_buckets <= BROADCAST_ROWS:
        matrix = F.broadcast(matrix)

    def dealt(part: DataFrame) -> DataFrame:
        local = Window.partitionBy(_BUCKET).orderBy(noise(2), F.col(_ROW))
        ranked = part.withColumn(_RANK, F.row_number().over(local) - 1).join(matrix, _BUCKET)
        shard = F.size(F.filter(F.col(_CUTS), lambda c: c <= F.col(_RANK))).cast("int")
        return ranked.withColumn("shard", shard).drop(_BUCKET, _RANK, _CUTS) \
            .withColumn(_SUB, F.pmod(noise(3), F.lit(n_buckets)).cast("int"))

    # sizes of the sub-buckets, from the row numbers alone
    held = dealt(bucketed.select(_ROW, _BUCKET)).groupBy("shard", _SUB).count()
    before = Window.partitionBy("shard").orderBy(_SUB).rowsBetween(Window.unboundedPreceding, -1)
    starts = held.select("shard", _SUB, F.coalesce(F.sum("count").over(before), F.lit(0)).alias(_AT))
    if n_buckets * n_shards <= BROADCAST_ROWS:
        starts = F.broadcast(starts)
    again = Window.partitionBy("shard", _SUB).orderBy(noise(4), F.col(_ROW))
    out = dealt(bucketed).withColumn(_RANK, F.row_number().over(again) - 1).join(starts, ["shard", _SUB])
    return out.select(*[F.col(f"`{c}`") for c in keep], "shard", (F.col(_AT) + F.col(_RANK)).cast("long").alias("slot"))
