"""Calendar attributes of the date dimension and the yyyyMMdd integer key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_date_col(col: Column | str, formats: Sequence[str] | None = None) -> Column:
    """Cast to date.  With ``formats``, the first format that parses wins and
    unparseable text becomes NULL instead of failing the job."""
    c = F.col(col) if isinstance(col, str) else col
    if not formats:
        return c.cast("date")
    return F.coalesce(*[F.try_to_date(c.cast("string"), f) for f in formats])


def date_key(date: Column) -> Column:
    """``yyyyMMdd`` as int, computed arithmetically (no string formatting)."""
    return F.year(date) * 10000 + F.month(date) * 100 + F.dayofmonth(date)


def calendar_attributes(date: Column) -> dict[str, Column]:
    """Columns of the date dimension, in output order (after ``date``)."""
    dow = F.dayofweek(date)  # 1 = Sunday ... 7 = Saturday
    return {
        "year": F.year(date),
        "quarter": F.quarter(date),
        "month": F.month(date),
        "month_name": F.date_format(date, "MMMM"),
        "day": F.dayofmonth(date),
        "day_of_week": dow,
        "day_name": F.date_format(date, "EEEE"),
        "week_of_year": F.weekofyear(date),
        # NULL date -> False (a CASE with no match falls to the default)
        "is_weekend": F.when(dow.isin(1, 7), F.lit(True)).otherwise(F.lit(False)),
    }
