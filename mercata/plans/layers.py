"""Ordered materialisation of the three layers: landing -> raw -> star -> reporting.

Each layer reads only the saved tables of the layer before it (so a failed run
restarts from the last saved layer, and lineage never spans layers).  Two
flavours share the builders: catalog databases (``run_bronze/silver/gold``) and
path-based parquet folders below the shared checkpoint root (used by the
registered queries and the bench, which must not touch the user's catalog).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from mercata.config import run_scratch, shuffles_released
from mercata.functions.naming import clean_names
from mercata.operators import marts
from mercata.operators.star_tables import StarTables
from mercata.plans.concurrency import run_concurrently
from mercata.plans.star import STAR_TABLES, build_star, star_from_tables
from mercata.sources.catalog import delete_folder, ensure_namespace, overwrite_table, qualified
from mercata.sources.driver_tables import RetailInputs
from mercata.sources.landing import ingest_landing

RAW_TABLES = ("orders", "people", "returns")


@dataclass(frozen=True)
class Layers:
    raw: str = "raw"
    star: str = "star_schema"
    reporting: str = "reporting"


# ------------------------------------------------------------------ path-based layers
def write_parquet(df: DataFrame, path: str) -> int:
    """Write ``df`` to ``path``; the row count is observed during the write."""
    obs = Observation(f"rows_{uuid.uuid4().hex}")  # unique: writes run concurrently
    with shuffles_released(df.sparkSession):
        df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
    return int(obs.get["rows"])


def save_frames(frames: Mapping[str, DataFrame], root: str, max_workers: int = 8) -> tuple[dict, dict]:
    """Write every frame to ``root/<name>``; return the re-read frames and their row counts."""
    spark = next(iter(frames.values())).sparkSession
    rows = run_concurrently({n: (lambda n=n, df=df: write_parquet(df, f"{root}/{n}"))
                             for n, df in frames.items()}, max_workers)
    return {n: spark.read.parquet(f"{root}/{n}") for n in frames}, rows


def materialize_raw(inputs: RetailInputs, root: str) -> RetailInputs:
    """Save the raw tables below ``root`` and return them re-read."""
    frames, _ = save_frames({"orders": inputs.orders, "people": inputs.people, "returns": inputs.returns}, root)
    return RetailInputs(frames["orders"], frames["people"], frames["returns"])


def parquet_sink(root: str):
    """Sink for ``build_star``: one parquet folder per table below ``root``."""
    def sink(name: str, df: DataFrame) -> tuple[DataFrame, int]:
        n = write_parquet(df, f"{root}/{name}")
        return df.sparkSession.read.parquet(f"{root}/{name}"), n
    return sink


def catalog_sink(database: str):
    """Sink for ``build_star``: overwrite ``database.<name>``."""
    def sink(name: str, df: DataFrame) -> tuple[DataFrame, int]:
        n = overwrite_table(df, database, name)
        return df.sparkSession.table(qualified(database, name)), n
    return sink


# ------------------------------------------------------------------ catalog layers
def run_bronze(spark: SparkSession, landing_dir: str, layers: Layers = Layers(),
               overrides: Mapping[str, Mapping[str, str]] | None = None,
               schemas: Mapping[str, str] | None = None):
    """Landing folder -> raw tables (one per CSV file or non-empty sheet)."""
    ensure_namespace(spark, layers.raw)
    return ingest_landing(spark, landing_dir, layers.raw, overrides=overrides, schemas=schemas)


def run_silver(spark: SparkSession, layers: Layers = Layers(),
               date_formats: Sequence[str] | None = None, on_duplicate: str = "keep") -> dict[str, int]:
    """Raw tables -> star tables; each table is written as soon as it is built."""
    ensure_namespace(spark, layers.star)
    # sheet columns are cleaned at ingest, CSV headers are not; cleaning again is a no-op
    raw = {t: (lambda df, t=t: df.toDF(*clean_names(df.columns, what=f"raw table {t!r} column")))(
        spark.table(qualified(layers.raw, t))) for t in RAW_TABLES}
    star = build_star(raw["orders"], raw["people"], raw["returns"], date_formats, on_duplicate,
                      sink=catalog_sink(layers.star))
    return dict(star.rows)


def saved_star(spark: SparkSession, database: str) -> StarTables:
    """The star tables of ``database``."""
    return star_from_tables({t: spark.table(qualified(database, t)) for t in STAR_TABLES})


def run_gold(spark: SparkSession, layers: Layers = Layers(), max_workers: int = 8) -> dict[str, int]:
    """Star tables -> the seven reporting marts, written concurrently."""
    ensure_namespace(spark, layers.reporting)
    star = saved_star(spark, layers.star)
    return run_concurrently({name: (lambda name=name, fn=fn: overwrite_table(fn(star), layers.reporting, name))
                             for name, fn in marts.MARTS.items()}, max_workers)


def run_all(spark: SparkSession, landing_dir: str, layers: Layers = Layers(),
            overrides: Mapping[str, Mapping[str, str]] | None = None,
            date_formats: Sequence[str] | None = None, on_duplicate: str = "keep",
            schemas: Mapping[str, str] | None = None) -> dict:
    """Landing -> raw -> star -> reporting; returns the rows written per layer and table.  The run's scratch is deleted."""
    with run_scratch(spark, delete_folder):
        bronze = run_bronze(spark, landing_dir, layers, overrides, schemas)
        silver = run_silver(spark, layers, date_formats, on_duplicate=on_duplicate)
        gold = run_gold(spark, layers)
    return {"bronze": bronze, "silver": silver, "gold": gold}
