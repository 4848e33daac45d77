"""Run the layers as a job: ``python -m mercata --landing DIR [--raw raw --star star_schema --reporting reporting]``.

Uses the active session's settings (master, ``spark.checkpoint.dir``) when launched
with spark-submit; prints one JSON line with the rows written per table.
"""

from __future__ import annotations

import argparse
import json
from dataclasses import asdict

from pyspark.sql import SparkSession

from mercata.config import ensure_checkpoint_dir
from mercata.operators.quality import health_check
from mercata.plans.layers import Layers, run_all


def main(argv: list[str] | None = None) -> None:
    """Parse arguments, run all layers, print one JSON line."""
    ap = argparse.ArgumentParser(prog="mercata")
    ap.add_argument("--landing", required=True, help="folder with the landed .csv / .xlsx files")
    ap.add_argument("--raw", default="raw", help="database of the raw tables (default: raw)")
    ap.add_argument("--star", default="star_schema", help="database of the star tables (default: star_schema)")
    ap.add_argument("--reporting", default="reporting", help="database of the marts (default: reporting)")
    ap.add_argument("--date-format", action="append", dest="date_formats",
                    help="text date format to try (repeatable), e.g. M/d/yyyy")
    ap.add_argument("--on-duplicate", choices=("keep", "first"), default="keep",
                    help="keep: fan fact rows out over every member of an id (default); first: lowest key only")
    args = ap.parse_args(argv)
    spark = SparkSession.builder.appName("mercata").getOrCreate()
    ensure_checkpoint_dir(spark)
    layers = Layers(args.raw, args.star, args.reporting)
    out = run_all(spark, args.landing, layers, date_formats=args.date_formats, on_duplicate=args.on_duplicate)
    verdicts = {db: health_check(spark, db).first().asDict() for db in (layers.raw, layers.star, layers.reporting)}
    print(json.dumps({"bronze": [asdict(r) for r in out["bronze"]], "silver": out["silver"], "gold": out["gold"],
                      "health": verdicts}, default=str))


if __name__ == "__main__":
    main()
