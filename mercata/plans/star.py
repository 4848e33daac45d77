"""Raw inputs -> star schema (6 dimensions, 2 facts), in dependency order.

Dimensions are built (and pinned by their key step) before the facts look them
up, which is the ordering the source warehouse gets by saving and re-reading
the dimension tables.  Independent builds (and, with a sink, the table writes)
run concurrently.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercata.operators.dims import (CUSTOMER, ORDER_DIMENSIONS, PRODUCT, REGIONAL_MANAGER, Dimension,
                                    DimensionSpec, build_dim_date, build_dimension)
from mercata.operators.facts import build_fact_returns, build_fact_sales
from mercata.operators.keys import discard
from mercata.operators.star_tables import StarTables
from mercata.plans.concurrency import run_graph

def nan_as_null(df: DataFrame) -> DataFrame:
    """Missing numbers are NULL: NaN (how pandas marks them) would *match* NaN in a
    lookup join, whereas a missing value must never match."""
    fix = {f.name: F.nanvl(F.col(f"`{f.name}`"), F.lit(None).cast(f.dataType))
           for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.withColumns(fix) if fix else df


STAR_TABLES = ("dim_customer", "dim_product", "dim_geography", "dim_ship_mode", "dim_date",
               "dim_regional_manager", "fact_sales", "fact_returns")


# A sink writes one star table and returns it re-read, with its row count.
Sink = Callable[[str, DataFrame], tuple[DataFrame, int]]


def _frame(built) -> DataFrame:
    return built if isinstance(built, DataFrame) else built.frame


def _save(sink: Sink, name: str, built) -> tuple[DataFrame, int]:
    """The table by the sink; the pinned layout it was read from goes."""
    out = sink(name, _frame(built))
    if not isinstance(built, DataFrame):
        discard(out[0].sparkSession, built.scratch)
    return out


def build_star(orders: DataFrame, people: DataFrame, returns: DataFrame,
               date_formats: Sequence[str] | None = None, on_duplicate: str = "keep",
               sink: Sink | None = None) -> StarTables:
    """Build (and with ``sink``, save) the star.

    Each fact starts as soon as the dimensions it looks up are keyed, with a sink
    saved: Spark knows the real size of a saved table, and its pinned layout is
    deleted then.  With a sink the sales fact also waits until the returns fact is
    saved, so that the disk holds the shuffles of one fact at a time.  ``on_duplicate="keep"`` fans a fact row out over
    every member of a business id (the source warehouse); ``"first"`` looks up
    only the lowest key per id.
    """
    orders, people, returns = nan_as_null(orders), nan_as_null(people), nan_as_null(returns)
    tasks: dict = {}
    saved = "" if sink is None else "saved:"

    def add(name: str, needs: tuple[str, ...], build) -> None:
        tasks[name] = (needs, build)
        if saved:
            tasks[saved + name] = ((name,), lambda d: _save(sink, name, d[name]))

    def dims(d: dict) -> dict[str, Dimension]:
        """The dimensions that a fact looks up, with a sink in the saved tables."""
        return {s.name: replace(d[s.name], frame=d[saved + s.name][0]) if saved else d[s.name] for s in ORDER_DIMENSIONS if s.name in d}

    def needs_of(*specs: DimensionSpec) -> tuple[str, ...]:
        return tuple(dict.fromkeys(p + s.name for s in specs for p in ("", saved)))

    for spec in ORDER_DIMENSIONS:
        add(spec.name, (), lambda _, spec=spec: build_dimension(orders, spec))
    add(REGIONAL_MANAGER.name, (), lambda _: build_dimension(people, REGIONAL_MANAGER))
    add("dim_date", (), lambda _: build_dim_date(orders, formats=date_formats))
    add("fact_returns", needs_of(CUSTOMER, PRODUCT), lambda d: build_fact_returns(orders, returns, dims(d), date_formats, on_duplicate))
    add("fact_sales", (*needs_of(*ORDER_DIMENSIONS), *(["saved:fact_returns"] if saved else [])),
        lambda d: build_fact_sales(orders, dims(d), date_formats, on_duplicate))
    built = run_graph(tasks)
    if sink is not None:
        frames = {t: built[f"saved:{t}"][0] for t in STAR_TABLES}
        rows = {t: built[f"saved:{t}"][1] for t in STAR_TABLES}
    else:
        frames = {t: _frame(built[t]) for t in STAR_TABLES}
        rows = {t: built[t].rows for t in STAR_TABLES if not isinstance(built[t], DataFrame)}
    return star_from_tables(frames, rows)


def star_from_tables(tables: dict[str, DataFrame], rows: dict | None = None) -> StarTables:
    """Wrap saved star tables (e.g. read back from the catalog or from paths)."""
    return StarTables(**{t: tables[t] for t in STAR_TABLES}, rows=rows)
