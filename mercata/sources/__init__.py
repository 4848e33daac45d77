"""Sources and sinks: landing dispatch (``landing``), delimited and workbook ingest
(``delimited``, ``workbook``), layer databases and the overwrite sink (``catalog``), and the
adapter deriving retail raw tables from the TPC-H-like test data (``driver_tables``)."""
