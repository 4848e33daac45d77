"""Sums of doubles that do not depend on the order of addition.

A double is split into integer limbs of ``BITS`` bits at fixed powers of two, each summed as a
long: integer sums commute and associate, so partial sums may meet in any order, on any number of
tasks, and give the same total to the last bit.  Scaling by powers of two, rounding to an integer
and the differences below are exact in double precision, so limbs lose nothing above 2 ** -72.

A limb is at most 2 ** 23 in size, so a group may hold 2 ** 40 values.  What has no limb (NaN,
infinities, sizes of 2 ** 70 and more) is summed beside them as an ordinary double.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

BITS = 24
POWERS = (48, 24, 0, -24, -48, -72)  # limb i counts units of 2 ** POWERS[i]
LARGEST = 2.0 ** 70


def is_inexact(kind: T.DataType) -> bool:
    """Does a sum of this type depend on the order of addition?"""
    return isinstance(kind, (T.DoubleType, T.FloatType))


def _within(x: Column) -> Column:
    return F.abs(x) < LARGEST  # false for NaN, which is larger than anything


def limbs(value: str) -> list[Column]:
    """The integer limbs of a double column: NULL for NULL, zero for what has none."""
    x = F.col(value).cast("double")
    units = [F.rint(x * F.lit(2.0 ** -p)) for p in POWERS]
    own = [units[0], *(u - above * F.lit(2.0 ** BITS) for above, u in zip(units, units[1:], strict=False))]
    return [F.when(_within(x), u.cast("long")).when(x.isNotNull(), F.lit(0).cast("long")) for u in own]


def outside(value: str) -> Column:
    """The value if it has no limbs."""
    x = F.col(value).cast("double")
    return F.when(~_within(x), x)


def from_limbs(sums: Sequence[Column], rest: Column) -> Column:
    """The double that summed limbs stand for, smallest unit first, plus the sum of the rest."""
    out = None
    for p, s in reversed(list(zip(POWERS, sums, strict=True))):
        part = s.cast("double") * F.lit(2.0 ** p)
        out = part if out is None else out + part
    return F.when(rest.isNull(), out).otherwise(out + rest)
