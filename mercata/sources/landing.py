"""Landing folder dispatch: ``.xlsx`` -> workbook ingest, ``.csv`` -> delimited ingest.

The direct entries of the folder are dispatched by their own names: files, and
folders as distributed writers leave them (``orders.csv/part-*``).  Suffix tests
are case-sensitive, as in the source warehouse; every other entry is skipped with
a message, hidden ones included.  Unlike the source, target names are planned for
*all* entries first, and two entries or sheets that clean to one table name stop
the run before anything is written (the source would silently overwrite one with
the other).  Legacy ``.xls`` is not decoded (binary format); it stops the run with
a clear error.
"""

from __future__ import annotations

import logging
import posixpath
from collections.abc import Mapping

from pyspark.sql import SparkSession

from mercata.sources.catalog import overwrite_table
from mercata.sources.delimited import IngestResult, ingest_delimited, table_name_for
from mercata.config import scratch_path
from mercata.sources.workbook import decoded_rows, pin_decoded, plan_sheets, sheet_frame

log = logging.getLogger(__name__)

WORKBOOK_SUFFIXES = (".xlsx", ".xls")
DELIMITED_SUFFIX = ".csv"


def _file_system(spark: SparkSession, path: str):
    """The file system of ``path`` and its path class, as Spark's own readers use them."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    return hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration()), hadoop.Path


def list_landing(spark: SparkSession, directory: str) -> list[str]:
    """Full paths of the entries (files and folders) directly inside ``directory``."""
    fs, path = _file_system(spark, directory)
    return sorted(s.getPath().toString() for s in fs.listStatus(path(directory)))


def move_single_part(spark: SparkSession, written: str, target: str) -> None:
    """Move the one part file of the folder ``written`` to the file ``target``."""
    fs, path = _file_system(spark, written)
    parts = [s.getPath() for s in fs.listStatus(path(written)) if s.getPath().getName().startswith("part-")]
    if len(parts) != 1 or not fs.rename(parts[0], path(target)):
        raise ValueError(f"{written!r} does not hold one part file that can become {target!r}")


def ingest_landing(spark: SparkSession, directory: str, database: str,
                   overrides: Mapping[str, Mapping[str, str]] | None = None,
                   schemas: Mapping[str, str] | None = None) -> list[IngestResult]:
    """Ingest every supported entry; ``overrides`` / ``schemas`` are keyed by raw table name."""
    entries = list_landing(spark, directory)
    seen = [p for p in entries if not posixpath.basename(p).startswith(("_", "."))]  # Spark reads no hidden ones
    csvs = [p for p in seen if p.endswith(DELIMITED_SUFFIX)]
    books = [p for p in seen if p.endswith(WORKBOOK_SUFFIXES)]
    for p in entries:
        if p not in csvs and p not in books:
            log.warning("skipping %s entry: %s", "unsupported" if p in seen else "hidden", posixpath.basename(p))
    legacy = [p for p in books if not p.endswith(".xlsx")]
    if legacy:
        raise ValueError(f"legacy .xls workbooks are not supported: {legacy}")

    rows, sheets = None, []
    if books:
        rows = pin_decoded(decoded_rows(spark, books), scratch_path(spark, "workbooks"))
        sheets = plan_sheets(rows)
    planned: dict[str, str] = {}
    for source, table in [(p, table_name_for(p)) for p in csvs] + [(f"{s.workbook}#{s.sheet}", s.table) for s in sheets]:
        if table in planned:
            raise ValueError(f"{planned[table]!r} and {source!r} both land in raw table {table!r}")
        planned[table] = source

    results = []
    for s in sheets:
        df = sheet_frame(rows, s)
        if df is None:
            log.info("skipping empty sheet %r of %s", s.sheet, posixpath.basename(s.workbook))
            continue
        n = overwrite_table(df, database, s.table)
        results.append(IngestResult(f"{s.workbook}#{s.sheet}", s.table, n, len(df.columns)))
    for p in csvs:
        t = table_name_for(p)
        results.append(ingest_delimited(spark, p, database, (overrides or {}).get(t), (schemas or {}).get(t)))
    return results

