"""Layer namespaces and the overwrite sink (one database per layer)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from mercata.config import shuffles_released


def ensure_namespace(spark: SparkSession, name: str, location: str | None = None) -> str:
    """Create the layer's database if missing (``CREATE CATALOG`` does not exist in open Spark)."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{loc}")
    return name


def qualified(database: str, table: str) -> str:
    """Back-quoted ``database.table``."""
    return f"`{database}`.`{table}`"


def table_location(spark: SparkSession, database: str, table: str) -> str:
    """Folder of a table below its database's location."""
    return f"{spark.catalog.getDatabase(database).locationUri.rstrip('/')}/{table}"


def _hadoop(spark: SparkSession, path: str):
    """File system and path object of a folder, as Spark itself opens it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), where


def delete_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder if it is there."""
    fs, where = _hadoop(spark, path)
    fs.delete(where, True)


def _delete_others(spark: SparkSession, folder: str, keep: str) -> None:
    fs, where = _hadoop(spark, folder)
    for f in fs.listStatus(where):
        if f.getPath().getName() != keep:
            fs.delete(f.getPath(), True)


def _kinds(schema: StructType) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in schema.fields]


def overwrite_table(df: DataFrame, database: str, table: str) -> int:
    """Replace the table; the row count is observed during the write (no second job).

    The rows go to a new version folder below ``<database location>/<table>``; only when all of
    them are written is the table pointed at it, and then the older versions are deleted.  A write
    that fails or is killed leaves the table as it was (its unfinished folder goes with the next
    overwrite).  ``ALTER TABLE ... SET LOCATION`` is one step of the catalog; a table whose columns
    change is dropped and created over the finished folder instead.  A re-run also replaces the
    files of a table that the catalog has forgotten (a session-local catalog).
    """
    spark = df.sparkSession
    obs = Observation(f"rows_{table}_{uuid.uuid4().hex}")  # unique: writes run concurrently
    folder, version, name = table_location(spark, database, table), f"v-{uuid.uuid4().hex}", qualified(database, table)
    with shuffles_released(spark):
        df.observe(obs, F.count(F.lit(1)).alias("rows")).write.parquet(f"{folder}/{version}")
    new = spark.read.parquet(f"{folder}/{version}")
    place = f"{folder}/{version}".replace("'", "\\'")
    if spark.catalog.tableExists(name) and _kinds(spark.table(name).schema) == _kinds(new.schema):
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{place}'")
    else:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(f"CREATE TABLE {name} USING PARQUET LOCATION '{place}'")
    spark.catalog.refreshTable(name)
    _delete_others(spark, folder, version)
    return int(obs.get["rows"])
