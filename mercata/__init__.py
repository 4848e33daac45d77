"""mercata: a layered retail-sales warehouse (raw -> star -> reporting) on Spark.

Subpackages
-----------
functions  Column-level helpers (identifier cleaning, calendar, guarded ratios).
operators  DataFrame operators: dense keys, distributed rank, lookups,
           dimension / fact / mart builders, quality audits.
sources    Landing-file ingest (delimited, workbook), catalog namespaces and sinks,
           and the adapter that derives retail inputs from the TPC-H-like tables.
plans      Ordered materialisation of the layers and the registered query set.
"""

__all__ = ["functions", "operators", "sources", "plans"]
