"""Toy raw tables with the source warehouse's column names (a handful of rows each)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

ORDERS_DDL = (
    "order_id string, order_date date, ship_date date, ship_mode string, customer_id string, "
    "customer_name string, segment string, `country/region` string, `state/province` string, city string, "
    "postal_code string, region string, product_id string, category string, sub_category string, "
    "product_name string, sales double, quantity int, discount double, profit double"
)
_COLS = [c.strip().split(" ")[0].strip("`") for c in ORDERS_DDL.split(", ")]

DEFAULT = dict(
    order_id="O-1", order_date=dt.date(2021, 3, 1), ship_date=dt.date(2021, 3, 4), ship_mode="First Class",
    customer_id="C-1", customer_name="Ann", segment="Consumer", **{"country/region": "US"},
    **{"state/province": "CA"}, city="LA", postal_code="90001", region="West", product_id="P-1",
    category="Furniture", sub_category="Chairs", product_name="Chair", sales=100.0, quantity=2,
    discount=0.1, profit=20.0,
)


def orders(spark: SparkSession, rows: list[dict]) -> DataFrame:
    data = [tuple({**DEFAULT, **r}[c] for c in _COLS) for r in rows]
    return spark.createDataFrame(data, ORDERS_DDL)


def people(spark: SparkSession, rows: list[tuple[str, str]]) -> DataFrame:
    return spark.createDataFrame(rows, "regional_manager string, region string")


def returns(spark: SparkSession, rows: list[tuple[str, str]]) -> DataFrame:
    return spark.createDataFrame(rows, "order_id string, returned string")
