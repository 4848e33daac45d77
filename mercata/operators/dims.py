"""Dimension builders (raw orders / people -> star dimensions).

A dimension is declared as a spec: output columns taken from raw columns, the
columns later used by fact lookups, and optional derived columns.  The build is
``select -> distinct -> dense key``; distinct runs with map-side partial
aggregation, so only distinct tuples reach the range shuffle of the key step.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercata.functions.calendar import calendar_attributes, date_key, to_date_col
from mercata.operators.keys import with_dense_key


@dataclass(frozen=True)
class DimensionSpec:
    name: str
    key: str
    columns: tuple[tuple[str, str], ...]            # (output name, raw column)
    lookup_on: tuple[str, ...]                       # output columns a fact looks up by
    derived: tuple[tuple[str, Callable[[], Column]], ...] = field(default=())
    distinct: bool = True
    key_order: tuple[str, ...] = ()                  # key order if not the column order

    @property
    def natural(self) -> list[str]:
        return [out for out, _ in self.columns]

    @property
    def ordering(self) -> list[str]:
        return list(self.key_order) or self.natural


@dataclass(frozen=True)
class Dimension:
    spec: DimensionSpec
    frame: DataFrame
    rows: int
    scratch: tuple[str, ...] = ()

    @property
    def name(self) -> str:
        return self.spec.name


# Ship-mode descriptions of the source warehouse, in its order;
# anything else (and NULL) is "Unknown".
SHIP_MODE_DESCRIPTIONS: tuple[tuple[str, str], ...] = (
    ("First Class", "Priority shipping (1-2 business days)"),
    ("Second Class", "Standard priority (2-4 business days)"),
    ("Standard Class", "Regular shipping (4-7 business days)"),
    ("Same Day", "Same day delivery"),
)
UNKNOWN_SHIP_MODE = "Unknown"


def ship_mode_description(mode: Column) -> Column:
    """Description of a ship mode from the fixed table; anything else is Unknown."""
    expr = None
    for value, text in SHIP_MODE_DESCRIPTIONS:
        expr = F.when(mode == value, text) if expr is None else expr.when(mode == value, text)
    return expr.otherwise(UNKNOWN_SHIP_MODE)


CUSTOMER = DimensionSpec(
    "dim_customer", "customer_key",
    (("customer_id", "customer_id"), ("customer_name", "customer_name"), ("segment", "segment")),
    lookup_on=("customer_id",),
)
PRODUCT = DimensionSpec(
    "dim_product", "product_key",
    (("product_id", "product_id"), ("category", "category"), ("sub_category", "sub_category"),
     ("product_name", "product_name")),
    lookup_on=("product_id",),
)
GEOGRAPHY = DimensionSpec(
    "dim_geography", "geography_key",
    (("country", "country/region"), ("state", "state/province"), ("city", "city"),
     ("postal_code", "postal_code"), ("region", "region")),
    lookup_on=("country", "state", "city", "postal_code"),  # region is not a lookup column
)
SHIP_MODE = DimensionSpec(
    "dim_ship_mode", "ship_mode_key", (("ship_mode", "ship_mode"),),
    lookup_on=("ship_mode",),
    derived=(("ship_mode_description", lambda: ship_mode_description(F.col("ship_mode"))),),
)
REGIONAL_MANAGER = DimensionSpec(
    "dim_regional_manager", "manager_key",
    (("manager_name", "regional_manager"), ("region", "region")),
    lookup_on=("region",),
    distinct=False,  # the people list is taken as is: two managers for a region stay two rows
    key_order=("region", "manager_name"),
)

ORDER_DIMENSIONS = (CUSTOMER, PRODUCT, GEOGRAPHY, SHIP_MODE)


def build_dimension(raw: DataFrame, spec: DimensionSpec) -> Dimension:
    """Project, de-duplicate (if the spec says so) and key one dimension."""
    projected = raw.select(*[F.col(f"`{src}`").alias(out) for out, src in spec.columns])
    if spec.distinct:
        projected = projected.distinct()
    keyed = with_dense_key(projected, spec.key, spec.ordering, unique=spec.distinct)
    frame = keyed.frame
    for name, make in spec.derived:
        frame = frame.withColumn(name, make())
    out_cols = [spec.key, *spec.natural, *[n for n, _ in spec.derived]]
    return Dimension(spec, frame.select(*out_cols), keyed.rows, keyed.scratch)


DATE_COLUMNS = ("date_key", "date", "year", "quarter", "month", "month_name", "day",
                "day_of_week", "day_name", "week_of_year", "is_weekend")


def build_dim_date(orders: DataFrame, date_columns: Sequence[str] = ("order_date", "ship_date"),
                   formats: Sequence[str] | None = None) -> DataFrame:
    """Every observed order or ship date once (no gap fill), with calendar attributes."""
    parts = [orders.select(to_date_col(c, formats).alias("date")) for c in date_columns]
    dates = parts[0]
    for p in parts[1:]:
        dates = dates.union(p)
    dates = dates.distinct()
    d = F.col("date")
    return dates.select(date_key(d).alias("date_key"), d,
                        *[c.alias(n) for n, c in calendar_attributes(d).items()]).orderBy("date")
