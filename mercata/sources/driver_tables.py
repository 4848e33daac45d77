"""Retail inputs (orders, people, returns) derived from the TPC-H-like test tables.

The test tables have no ship mode, city, state, postal code, profit, manager or
return event, so these are derived by fixed rules.  The rules are written once
as SQL text with ``{table}`` placeholders: Spark runs it with DataFrame
arguments (``spark.sql(text, lineitem=df, ...)``), and the DuckDB oracle runs
the same text on its registered views, so both engines see identical inputs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

TPCH_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")

# Fixed values of the fixture mapping: ship mode per order priority, price tiers
# per customer (so all four lifetime-value tiers occur), derived geography.
ORDERS_SQL = """
SELECT
  concat('O-', CAST(l.l_orderkey AS STRING)) AS order_id,
  CASE WHEN l.l_orderkey % 211 = 0 THEN NULL ELSE CAST(o.o_orderdate AS DATE) END AS order_date,
  CAST(l.l_shipdate AS DATE) AS ship_date,
  CASE o.o_orderpriority
    WHEN '1-URGENT' THEN 'Same Day'
    WHEN '2-HIGH' THEN 'First Class'
    WHEN '3-MEDIUM' THEN 'Second Class'
    WHEN '5-LOW' THEN 'Standard Class'
    ELSE 'Freight' END AS ship_mode,
  concat('C-', CAST(c.c_custkey AS STRING)) AS customer_id,
  c.c_name AS customer_name,
  c.c_mktsegment AS segment,
  n.n_name AS country,
  concat(n.n_name, '-S', CAST(c.c_custkey % 4 AS STRING)) AS state,
  concat(n.n_name, '-C', CAST(c.c_custkey % 16 AS STRING)) AS city,
  CASE WHEN c.c_custkey % 37 = 0 THEN NULL ELSE CAST(10000 + c.c_custkey % 16 AS STRING) END AS postal_code,
  r.r_name AS region,
  concat('P-', CAST(p.p_partkey AS STRING)) AS product_id,
  p.p_type AS category,
  p.p_brand AS sub_category,
  CASE WHEN p.p_partkey % 50 = 0 AND l.l_linenumber = 7 THEN concat(p.p_name, ' v2') ELSE p.p_name END AS product_name,
  CAST(CAST(l.l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l.l_discount AS DECIMAL(4,2)))
       * CASE WHEN l.l_linenumber = 2 AND l.l_orderkey % 97 = 0 THEN 0 ELSE 1 END
       * CASE c.c_custkey % 4 WHEN 0 THEN 0.00500 WHEN 1 THEN 0.00160 WHEN 2 THEN 0.00050 ELSE 0.00016 END
       AS DECIMAL(18,9)) AS sales,
  CAST(l.l_quantity AS INT) AS quantity,
  CAST(l.l_discount AS DECIMAL(4,2)) AS discount,
  CAST((CAST(l.l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l.l_discount AS DECIMAL(4,2)))
        - CAST(l.l_quantity AS DECIMAL(6,0)) * CAST(p.p_retailprice AS DECIMAL(12,2)))
       * CASE c.c_custkey % 4 WHEN 0 THEN 0.00500 WHEN 1 THEN 0.00160 WHEN 2 THEN 0.00050 ELSE 0.00016 END
       AS DECIMAL(18,9)) AS profit
FROM {lineitem} l
JOIN {orders} o ON l.l_orderkey = o.o_orderkey
JOIN {customer} c ON o.o_custkey = c.c_custkey
JOIN {nation} n ON c.c_nationkey = n.n_nationkey
JOIN {region} r ON n.n_regionkey = r.r_regionkey
JOIN {part} p ON l.l_partkey = p.p_partkey
"""

# Lowest and highest supplier name of each region as its managers.
PEOPLE_SQL = """
SELECT CASE k WHEN 1 THEN lowest ELSE highest END AS regional_manager, region
FROM (
  SELECT min(s.s_name) AS lowest, max(s.s_name) AS highest, r.r_name AS region
  FROM {supplier} s
  JOIN {nation} n ON s.s_nationkey = n.n_nationkey
  JOIN {region} r ON n.n_regionkey = r.r_regionkey
  GROUP BY r.r_name) m
CROSS JOIN (SELECT 1 AS k UNION ALL SELECT 2 AS k) two
"""

# One event per order line: R is a return, any other flag is not; not de-duplicated.
RETURNS_SQL = """
SELECT concat('O-', CAST(l.l_orderkey AS STRING)) AS order_id,
       CASE l.l_returnflag WHEN 'R' THEN 'Yes' ELSE 'No' END AS returned
FROM {lineitem} l
"""

# The raw orders table of the source warehouse names these two columns with a slash.
RAW_RENAMES = {"country": "country/region", "state": "state/province"}


@dataclass(frozen=True)
class RetailInputs:
    orders: DataFrame
    people: DataFrame
    returns: DataFrame


def read_tables(spark: SparkSession, sf_dir: str, names: tuple[str, ...] = TPCH_TABLES) -> dict[str, DataFrame]:
    """The TPC-H-like tables of ``sf_dir``."""
    return {n: spark.read.parquet(f"{str(sf_dir).rstrip('/')}/{n}.parquet") for n in names}


def retail_inputs(spark: SparkSession, sf_dir: str) -> RetailInputs:
    """Raw orders, people and returns derived from the test tables."""
    t = read_tables(spark, sf_dir)
    orders = spark.sql(ORDERS_SQL, **t).withColumnsRenamed(RAW_RENAMES)
    people = spark.sql(PEOPLE_SQL, **t)
    returns = spark.sql(RETURNS_SQL, **t)
    return RetailInputs(orders, people, returns)


def duckdb_text(sql: str) -> str:
    """The same rule text for DuckDB views named after the tables."""
    return sql.format(**{n: n for n in TPCH_TABLES})
