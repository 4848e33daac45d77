"""Fact builders: transaction grain + looked-up surrogate keys + measures.

Lookups are left joins (a failed lookup leaves a NULL key, never drops the
row) on a subset of the dimension's columns, so a business id with several
dimension members fans the fact row out, as in the source warehouse.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercata.functions.calendar import date_key, to_date_col
from mercata.operators.dims import CUSTOMER, GEOGRAPHY, PRODUCT, SHIP_MODE, Dimension
from mercata.operators.keys import Keyed, discard_saved, saved, with_dense_key
from mercata.operators.lookup import left_lookup

FACT_SALES_COLUMNS = ("sales_key", "order_id", "order_date_key", "ship_date_key", "customer_key",
                      "product_key", "geography_key", "ship_mode_key", "revenue", "quantity",
                      "discount", "profit", "cost", "profit_margin")
FACT_RETURNS_COLUMNS = ("return_key", "order_id", "order_date_key", "customer_key", "product_key")

COPIES = 10_000  # copies of a return line that one row stands for, at most
_TIMES = "__times"

# Raw orders columns that feed each lookup (fact column, dimension column).  The dimensions that grow least come
# first: where Spark broadcasts them, their wide columns do not go through the shuffles of the other lookups.
_RETURNS_LOOKUPS = (
    (CUSTOMER, (("customer_id", "customer_id"),)),
    (PRODUCT, (("product_id", "product_id"),)),
)
_LOOKUPS = (
    (GEOGRAPHY, (("country/region", "country"), ("state/province", "state"), ("city", "city"),
                 ("postal_code", "postal_code"))),
    (SHIP_MODE, (("ship_mode", "ship_mode"),)),
    *_RETURNS_LOOKUPS,
)


def _lookup_all(df: DataFrame, dims: Mapping[str, Dimension], which, on_duplicate: str = "keep") -> DataFrame:
    for spec, on in which:
        dim = dims[spec.name]
        df = left_lookup(df, dim.frame, on, [spec.key], on_duplicate)
    return df


def build_fact_sales(orders: DataFrame, dims: Mapping[str, Dimension],
                     date_formats: Sequence[str] | None = None, on_duplicate: str = "keep") -> Keyed:
    """Order lines with date keys, looked-up dimension keys, measures and a dense key.

    The looked-up lines are saved before they are put in order: the lookups run once although range
    bounds are sampled first, and their shuffles are gone before the lines are shuffled again.
    Measures that follow from others are made after the order.
    """
    needed = ["order_id", "order_date", "ship_date", "customer_id", "product_id", "country/region",
              "state/province", "city", "postal_code", "ship_mode", "sales", "quantity", "discount",
              "profit"]
    base = orders.select(*[F.col(f"`{c}`") for c in needed]).select(
        "*",
        date_key(to_date_col("order_date", date_formats)).alias("order_date_key"),
        date_key(to_date_col("ship_date", date_formats)).alias("ship_date_key"),
    )
    looked = _lookup_all(base, dims, _LOOKUPS, on_duplicate)
    order = ["order_id", "order_date_key", "ship_date_key", "customer_key", "product_key",
             "geography_key", "ship_mode_key", "revenue", "quantity", "discount", "profit"]
    lines = saved(looked.withColumnRenamed("sales", "revenue").select(*order), "sales-lines")
    keyed = with_dense_key(lines, "sales_key", order, unique=False)
    discard_saved(lines)
    revenue, profit = F.col("revenue"), F.col("profit")
    measured = keyed.frame.withColumns({
        "cost": revenue - profit,
        "profit_margin": F.when(revenue != 0, F.try_divide(profit.cast("double"), revenue.cast("double")))
                          .otherwise(F.lit(0.0)),
    })
    return Keyed(measured.select(*FACT_SALES_COLUMNS), keyed.rows, keyed.scratch)


def returned_orders(returns: DataFrame, flag_value: str = "Yes") -> DataFrame:
    """Return events flagged as returned (case-sensitive; NULL is not returned)."""
    return returns.filter(F.col("returned") == flag_value)


def build_fact_returns(orders: DataFrame, returns: DataFrame, dims: Mapping[str, Dimension],
                       date_formats: Sequence[str] | None = None, on_duplicate: str = "keep") -> Keyed:
    """One row per (return event, distinct order line of that order).

    Events are counted per order first, so lines meet one row per returned order, the lookups run
    over distinct lines, and the copies that several events of an order ask for are made last, in
    the tasks that number them; a line asked for very often is split into rows of ``COPIES``.
    The distinct lines are saved once: events without a line are those whose order is not among
    them.  The join to the lines is an inner join, in which AQE can split a hot order.
    """
    events = returned_orders(returns).where(F.col("order_id").isNotNull()).groupBy("order_id").agg(F.count(F.lit(1)).alias(_TIMES))
    lines = orders.select("order_id", "customer_id", "product_id", "order_date", "region")
    matched = saved(lines.join(events, "order_id").distinct(), "returned-lines")
    alone = events.join(matched.select("order_id").distinct(), "order_id", "left_anti") \
        .unionByName(returned_orders(returns).where(F.col("order_id").isNull()).groupBy("order_id").agg(F.count(F.lit(1)).alias(_TIMES)))
    missing = [F.lit(None).cast(matched.schema[c].dataType).alias(c) for c in matched.columns if c not in ("order_id", _TIMES)]
    looked = _lookup_all(matched.unionByName(alone.select("order_id", _TIMES, *missing)), dims, _RETURNS_LOOKUPS, on_duplicate)
    part = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(_TIMES) - 1) / COPIES)))
    shaped = looked.select(
        "order_id",
        date_key(to_date_col("order_date", date_formats)).alias("order_date_key"),
        "customer_key", "product_key", _TIMES, part.alias("__part"),
    ).withColumn(_TIMES, F.least(F.lit(COPIES).cast("long"), F.col(_TIMES) - F.col("__part") * COPIES)).drop("__part")
    keyed = with_dense_key(shaped, "return_key", list(FACT_RETURNS_COLUMNS[1:]), unique=False, times=_TIMES)
    discard_saved(matched)
    return Keyed(keyed.frame.select(*FACT_RETURNS_COLUMNS), keyed.rows, keyed.scratch)
