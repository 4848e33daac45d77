"""The star schema as a set of DataFrames, with the row counts known for its tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class StarTables:
    """Star schema tables as DataFrames, with known row counts where available."""

    fact_sales: DataFrame
    fact_returns: DataFrame
    dim_customer: DataFrame
    dim_product: DataFrame
    dim_geography: DataFrame
    dim_date: DataFrame
    dim_ship_mode: DataFrame
    dim_regional_manager: DataFrame
    rows: dict | None = None

    def lookup(self, table: str, *cols: str) -> DataFrame:
        """Projection of a dimension; Spark broadcasts it if its size allows."""
        return getattr(self, table).select(*cols)
