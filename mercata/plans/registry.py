"""The registered query set: one callable (spark, sf_dir) -> DataFrame per operator.

All queries read the driver's TPC-H-like tables (through the retail adapter)
and share one saved star schema per (application, data folder), so the 28
entries do not rebuild it each time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercata.config import scratch_path
from mercata.functions.naming import clean_name_col
from mercata.operators import marts, quality
from mercata.operators.facts import returned_orders
from mercata.operators.star_tables import StarTables
from mercata.plans.layers import materialize_raw, parquet_sink
from mercata.plans.star import STAR_TABLES, build_star
from mercata.sources.catalog import ensure_namespace, qualified
from mercata.sources.delimited import read_delimited
from mercata.sources.driver_tables import RetailInputs, read_tables, retail_inputs
from mercata.sources.landing import ingest_landing, move_single_part

# Saved layers per (application id, data folder); each points at parquet in the shared folder.
_RAW: dict[tuple[str, str], RetailInputs] = {}
_STARS: dict[tuple[str, str], StarTables] = {}
_STAR_ROOTS: dict[tuple[str, str], str] = {}


def _key(spark: SparkSession, sf_dir) -> tuple[str, str]:
    return spark.sparkContext.applicationId, str(sf_dir).rstrip("/")


def raw_for(spark: SparkSession, sf_dir: str) -> RetailInputs:
    """Raw layer (orders, people, returns) derived once and saved as parquet."""
    key = _key(spark, sf_dir)
    if key not in _RAW:
        _RAW[key] = materialize_raw(retail_inputs(spark, key[1]), scratch_path(spark, "raw"))
    return _RAW[key]


def star_for(spark: SparkSession, sf_dir: str) -> StarTables:
    """Star layer built from the saved raw layer and itself saved as parquet."""
    key = _key(spark, sf_dir)
    if key not in _STARS:
        raw = raw_for(spark, sf_dir)
        _STAR_ROOTS[key] = scratch_path(spark, "star")
        _STARS[key] = build_star(raw.orders, raw.people, raw.returns, sink=parquet_sink(_STAR_ROOTS[key]))
    return _STARS[key]


def _star_table(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: getattr(star_for(spark, sf_dir), name)


def _mart(fn) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: fn(star_for(spark, sf_dir))


def clean_identifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Identifier rule over names made of every part's columns: edge blanks, hyphens, parentheses."""
    part = spark.read.parquet(f"{str(sf_dir).rstrip('/')}/part.parquet")
    raw_name = F.concat(F.lit(" "), "p_name", F.lit(" ("), "p_brand", F.lit(")-"), "p_type", F.lit("\t"))
    raw_type = F.concat(F.lit("("), "p_type", F.lit(") - "), F.col("p_size").cast("string"), F.lit("  "))
    named = part.select("p_partkey", raw_name.alias("raw_name"), raw_type.alias("raw_type"))
    return named.select("*", clean_name_col("raw_name").alias("name_identifier"),
                        clean_name_col("raw_type").alias("type_identifier"))


def filter_returned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Return events flagged as returned."""
    return returned_orders(raw_for(spark, sf_dir).returns)


def ingest_delimited_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw orders landed as a CSV file set, then ingested with header + inferred types."""
    path = scratch_path(spark, "landing-orders")
    raw_for(spark, sf_dir).orders.write.option("header", "true").csv(path)
    return read_delimited(spark, path)


STAR_CHECK_DB = "mercata_star_check"


def _database(spark: SparkSession, sf_dir: str, prefix: str) -> str:
    """Name of a database of one application and data folder, the same at each call."""
    return f"{prefix}_{hashlib.md5(' '.join(_key(spark, sf_dir)).encode(), usedforsecurity=False).hexdigest()[:12]}"


def star_database(spark: SparkSession, sf_dir: str) -> str:
    """Namespace of one data folder's star: the saved tables, registered where they lie."""
    application, folder = _key(spark, sf_dir)
    name = _database(spark, sf_dir, STAR_CHECK_DB)
    star_for(spark, sf_dir)
    ensure_namespace(spark, name, scratch_path(spark, "star-db"))
    for t in STAR_TABLES:
        spark.sql(f"CREATE TABLE IF NOT EXISTS {qualified(name, t)} USING PARQUET LOCATION '{_STAR_ROOTS[application, folder]}/{t}'")
    return name


def layer_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit of the saved star layer, table by table."""
    return quality.layer_row_counts(spark, star_database(spark, sf_dir))


def layer_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Health verdict of the saved star layer (listing and every count must succeed)."""
    return quality.health_check(spark, star_database(spark, sf_dir)).withColumn("database", F.lit(STAR_CHECK_DB))


def landing_dispatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers per nation from a landing folder with one table as a file and one as a folder.

    ``nation.csv`` lands as a single file, ``supplier.csv`` as the folder of part files that a
    distributed writer leaves; both are ingested by their entry names and read back by table name.
    """
    tables = read_tables(spark, sf_dir, ("nation", "supplier"))
    landing = scratch_path(spark, "landing")
    tables["supplier"].select("s_suppkey", "s_nationkey", "s_name").write.option("header", "true").csv(f"{landing}/supplier.csv")
    one = scratch_path(spark, "one-file")
    tables["nation"].select("n_nationkey", "n_name").coalesce(1).write.option("header", "true").csv(one)
    move_single_part(spark, one, f"{landing}/nation.csv")
    database = _database(spark, sf_dir, "mercata_landing")
    ensure_namespace(spark, database, scratch_path(spark, "landing-db"))
    ingest_landing(spark, landing, database)
    nation, supplier = (spark.table(qualified(database, t)) for t in ("nation", "supplier"))
    return nation.join(supplier, nation["n_nationkey"] == supplier["s_nationkey"], "left") \
        .groupBy("n_name").agg(F.count("s_suppkey").alias("suppliers"), F.min("s_name").alias("first_supplier"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """All registered queries by name."""
    q: dict[str, Callable[[SparkSession, str], DataFrame]] = {
        "clean_identifiers": clean_identifiers,
        "ingest_delimited_roundtrip": ingest_delimited_roundtrip,
        "landing_dispatch": landing_dispatch,
        "layer_row_counts": layer_row_counts,
        "layer_health": layer_health,
        "filter_returned": filter_returned,
    }
    for t in STAR_TABLES:
        q[t] = _star_table(t)
    q.update({
        "agg_monthly_sales": _mart(marts.agg_monthly_sales),
        "customer_sales": _mart(marts.customer_sales),
        "customer_returns": _mart(marts.customer_returns),
        "agg_customer_lifetime_value": _mart(marts.agg_customer_lifetime_value),
        "product_sales": _mart(marts.product_sales),
        "product_returns": _mart(marts.product_returns),
        "agg_product_performance": _mart(marts.agg_product_performance),
        "agg_regional_summary": _mart(marts.agg_regional_summary),
        "category_quarterly": _mart(marts.category_quarterly),
        "agg_category_trends": _mart(marts.agg_category_trends),
        "agg_shipping_analysis": _mart(marts.agg_shipping_analysis),
        "agg_state_performance": _mart(marts.agg_state_performance),
        "duplicate_lookup_keys": _mart(quality.duplicate_lookup_keys),
        "unmatched_lookups": _mart(quality.unmatched_lookups),
    })
    return q
