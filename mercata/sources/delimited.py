"""Delimited (CSV) landing files -> raw tables named after the cleaned file stem.

Header and inferred types, as in the source warehouse.  Column names are kept
as in the header (only the table name is cleaned).

Two passes over the file run at the same time: Spark's own inference, which stops testing a column
once its type is settled, and the landing, which saves the values as strings.  The saved strings are
then projected to the types found, so nothing after that reads the file again.
``overrides`` re-types chosen columns from the same strings (e.g. postal codes as
strings, so leading zeros survive); ``zeros_are_text`` does so for every column of
whole numbers with a leading zero.
"""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

from mercata.functions.naming import clean_name
from mercata.operators.keys import saved
from mercata.plans.concurrency import run_concurrently
from mercata.sources.catalog import overwrite_table


@dataclass(frozen=True)
class IngestResult:
    source: str
    table: str
    rows: int
    columns: int


def table_name_for(path: str) -> str:
    """Raw table name for a landed file: its cleaned stem."""
    return clean_name(os.path.splitext(os.path.basename(path.rstrip("/")))[0])


def inferred_types(reader: DataFrameReader, path: str) -> list[str]:
    """The type of each column, as Spark's inference finds it over the whole file."""
    return [f.dataType.simpleString() for f in reader.option("inferSchema", "true").csv(path).schema.fields]


def with_leading_zeros(landed: DataFrame, columns: Sequence[str]) -> set[str]:
    """Those of ``columns`` that hold a whole number with a leading zero."""
    if not columns:
        return set()
    found = landed.agg(*[F.max(F.col(f"`{c}`").rlike("^[+-]?0[0-9]+$")).alias(f"z{i}") for i, c in enumerate(columns)]).first()
    return {c for c, zero in zip(columns, found, strict=True) if zero}


def read_delimited(spark: SparkSession, path: str, *, overrides: Mapping[str, str] | None = None,
                   schema: str | None = None, sep: str = ",", zeros_are_text: bool = False) -> DataFrame:
    """Header + inferred types (the default), re-typed columns, or a full DDL schema.

    The landing file is read by two jobs that run together; the values stand as strings in the scratch folder until the
    run's scratch is deleted.  A full ``schema`` needs no inference and reads the file directly.
    """
    def reader() -> DataFrameReader:  # options stay on a reader
        return spark.read.option("header", "true").option("sep", sep)

    if schema:
        if overrides:
            raise ValueError("give either a full schema or per-column overrides, not both")
        return reader().schema(schema).csv(path)
    strings = reader().csv(path)  # reads the header only
    missing = set(overrides or {}) - set(strings.columns)
    if missing:
        raise ValueError(f"override for unknown column(s) {sorted(missing)} in {path}")
    if not strings.columns:
        return strings
    both = run_concurrently({"landed": lambda: saved(strings, "landed"), "types": lambda: inferred_types(reader(), path)})
    landed, types = both["landed"], dict(zip(strings.columns, both["types"], strict=True))
    if zeros_are_text:
        types |= dict.fromkeys(with_leading_zeros(landed, [c for c, t in types.items() if t != "string"]), "string")
    types |= overrides or {}
    return landed.select(*[(F.col(f"`{c}`").try_cast(t) if t != "string" else F.col(f"`{c}`")).alias(c) for c, t in types.items()])


def ingest_delimited(spark: SparkSession, path: str, database: str,
                     overrides: Mapping[str, str] | None = None, schema: str | None = None) -> IngestResult:
    """Read one delimited file and overwrite its raw table."""
    df = read_delimited(spark, path, overrides=overrides, schema=schema)
    table = table_name_for(path)
    rows = overwrite_table(df, database, table)
    return IngestResult(path, table, rows, len(df.columns))
