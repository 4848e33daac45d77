"""Left lookup joins of a fact against a dimension.

No broadcast is forced: saved dimensions carry their real size, so Spark
broadcasts one below ``spark.sql.autoBroadcastJoinThreshold`` and shuffles a
larger one, where AQE can still split a hot fact key (left side of a left join).

Where AQE is off or its thresholds do not fit, ``spark.mercata.lookup.salts`` = n splits hot
keys of shuffled lookups explicitly: a partially aggregated count finds the keys with more
than 1 / ``HOT_KEYS`` of the lines (fewer than ``HOT_KEYS``, whatever the data), their lines are
dealt over n salts and their members repeated once per salt.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercata.config import LOOKUP_SALTS
from mercata.operators.keys import saved

ON_DUPLICATE = ("keep", "first")
HOT_KEYS = 200
_SALT, _HOT = "__lk_salt", "__lk_hot"


def hot_keys(fact: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The key values that more than ``1 / HOT_KEYS`` of all rows of ``fact`` share (fewer than ``HOT_KEYS`` rows, saved)."""
    counts = saved(fact.groupBy(*columns).agg(F.count(F.lit(1)).alias(_HOT)), "key-counts")
    total = counts.agg(F.coalesce(F.sum(_HOT), F.lit(0))).first()[0]
    present = [F.col(c).isNotNull() for c in columns]  # a NULL in a key matches nothing and is not looked up
    return saved(counts.where(reduce(and_, present) & (F.col(_HOT) * HOT_KEYS > F.lit(total))).select(*columns), "hot-keys")


def _salted(fact: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]], alias: Mapping[str, str], salts: int) -> tuple[DataFrame, DataFrame]:
    """Both sides with a salt: lines of hot keys take any, their members have all; other keys have salt 0."""
    hot = hot_keys(fact, [f for f, _ in on])
    named = hot.select(*[F.col(f).alias(f"{_HOT}_{i}") for i, (f, _) in enumerate(on)], F.lit(True).alias(_HOT))
    extra = [f"{_HOT}_{i}" for i in range(len(on))] + [_HOT]
    is_hot = F.coalesce(F.col(_HOT), F.lit(False))

    def marked(df: DataFrame, columns: Sequence[str]) -> DataFrame:
        same = reduce(and_, [F.col(c) == F.col(f"{_HOT}_{i}") for i, c in enumerate(columns)])
        return df.join(F.broadcast(named), same, "left")  # fewer than HOT_KEYS rows

    # a NULL key meets no member: such lines are dealt out too, so that they do not gather in one task
    unkeyed = reduce(or_, [F.col(f).isNull() for f, _ in on])
    salt = F.when(is_hot | unkeyed, F.pmod(F.monotonically_increasing_id(), F.lit(salts))).otherwise(0).cast("int")
    left = marked(fact, [f for f, _ in on]).withColumn(_SALT, salt).drop(*extra)
    every = F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    return left, marked(right, [alias[d] for _, d in on]).withColumn(_SALT, F.explode(every)).drop(*extra)


def left_lookup(fact: DataFrame, dim: DataFrame,
                on: Sequence[tuple[str, str]], take: Sequence[str], on_duplicate: str = "keep") -> DataFrame:
    """Attach ``take`` columns of ``dim`` to every fact row.

    ``on`` pairs (fact column, dim column); equality is NULL-intolerant, so a
    NULL in any key column leaves the looked-up columns NULL.  Several dim rows
    per key fan the fact row out (``on_duplicate="keep"``, the source
    warehouse's semantics); ``"first"`` keeps only the lowest value of each
    ``take`` column per key (one row per key, no fan-out).
    """
    if on_duplicate not in ON_DUPLICATE:
        raise ValueError(f"on_duplicate must be one of {ON_DUPLICATE}")
    alias = {d: f"__lk_{i}" for i, (_, d) in enumerate(on)}
    right = dim.select(*[F.col(d).alias(alias[d]) for _, d in on], *take)
    if on_duplicate == "first":
        right = right.groupBy(*alias.values()).agg(*[F.min(c).alias(c) for c in take])
    salts = int(fact.sparkSession.conf.get(LOOKUP_SALTS, "") or 0)
    if salts > 1:
        fact, right = _salted(fact, right, on, alias, salts)
        right = right.withColumnRenamed(_SALT, f"{_SALT}_r")
        cond = fact[_SALT] == right[f"{_SALT}_r"]
    else:
        cond = F.lit(True)
    for f_col, d_col in on:
        cond = cond & (fact[f_col] == right[alias[d_col]])
    return fact.join(right, cond, "left").drop(*alias.values(), _SALT, f"{_SALT}_r")
